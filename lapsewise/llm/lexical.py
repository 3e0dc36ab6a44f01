"""Ranked lexical search turned round: the items are the index, the documents stream through it.

The terms of all items form an inverted index (term -> items and repeats) that every task holds.
A first pass counts documents, terms and, for the items' terms, the documents that hold them. A second
pass takes each document's term counts through the index, adds up its score for every item it shares a
term with and keeps the best ``k`` per item and task; those lists are merged in two steps.

The index is broadcast. Its size is bounded: items are taken in blocks of at most ``BLOCK_CHARS``
characters of text (one item alone may be longer), each block against all documents.

Null texts have no terms; a document without terms has no score, an item without terms finds nothing.
Rows without doc_id count in the statistics but cannot be returned; each repeated row is a document of
its own. Of several texts with one item_id the smallest counts; rows without item_id take no part.
Equal scores are ordered by doc_id. Other columns are not read. Texts of any length are taken
whole. An empty table on either side gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapsewise.llm.terms import byte_table, terms

BLOCK_CHARS = 16_000_000
#: Scores held at once by a task: documents of a batch times items.
SCORES_AT_ONCE = 2_000_000
#: Parts over which the lists of one item are dealt in the first merge.
MERGE_PARTS = 32
_TABLE = byte_table(digits=True)
HITS = "item_id long, doc_id long, score long"


@dataclass
class Index:
    """Items of one block: term numbers, and for each term the items that hold it and how often."""

    ids: np.ndarray
    number: dict[bytes, int]
    first: np.ndarray
    holders: np.ndarray
    repeats: np.ndarray


def build_index(items: list[tuple[int, str]]) -> Index:
    number: dict[bytes, int] = {}
    pairs = [
        (number.setdefault(term, len(number)), place)
        for place, (_, text) in enumerate(items) for term in terms(text.encode("utf-8", "surrogatepass"), _TABLE)
    ]
    held, repeats = np.unique(np.array(pairs, dtype=np.int64).reshape(-1, 2), axis=0, return_counts=True)
    first = np.searchsorted(held[:, 0], np.arange(len(number) + 1))
    ids = np.array([i for i, _ in items], dtype=np.int64)
    return Index(ids, number, first, held[:, 1], repeats.astype(np.int64))


def statistics(docs: DataFrame, number: dict[bytes, int]) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and the documents that hold each numbered term."""
    shared = docs.sparkSession.sparkContext.broadcast(number)

    def count(batches):
        get, size = shared.value.get, len(shared.value)
        holding, n_docs, n_terms = np.zeros(size, dtype=np.int64), 0, 0
        for batch in batches:
            for data in batch.column("data").to_pylist():
                found = terms(data, _TABLE)
                n_docs, n_terms = n_docs + bool(found), n_terms + len(found)
                seen = set(map(get, found))
                seen.discard(None)
                holding[np.fromiter(seen, dtype=np.int64, count=len(seen))] += 1
        at = np.flatnonzero(holding)
        yield pa.RecordBatch.from_pydict({
            "term": np.concatenate([at, [-1, -2]]), "n": np.concatenate([holding[at], [n_docs, n_terms]]),
        })

    counted = docs.select("data").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n"))
    sums = dict(map(tuple, counted.collect()))  # one row per term of the index
    return sums.get(-1, 0), sums.get(-2, 0), np.array([sums.get(i, 0) for i in range(len(number))], dtype=np.int64)


def weights(n_docs: int, holding: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in holding], dtype=np.int64)


def score_batch(index: Index, weight: np.ndarray, found: list[list[int]], lengths: list[int]) -> np.ndarray:
    """Scores of some documents (rows, by length factor) for all items (columns)."""
    size, n_items = len(index.number), len(index.ids)
    sizes = [len(f) for f in found]
    numbers = np.fromiter((i for f in found for i in f), dtype=np.int64, count=sum(sizes))
    keys, times = np.unique(np.repeat(np.arange(len(found)), sizes) * size + numbers, return_counts=True)
    doc, term = keys // max(size, 1), keys % max(size, 1)
    part = weight[term] * ((1_000_000_000 * times) // (1000 * times + 12 * np.array(lengths, dtype=np.int64)[doc]))
    # Every (document, term) meets the items that hold the term.
    width = index.first[term + 1] - index.first[term]
    at = np.repeat(index.first[term] - (np.cumsum(width) - width), width) + np.arange(width.sum())
    scores = np.zeros(len(found) * n_items, dtype=np.int64)
    np.add.at(scores, np.repeat(doc, width) * n_items + index.holders[at], np.repeat(part, width) * index.repeats[at])
    return scores.reshape(len(found), n_items)


def best(item: np.ndarray, score: np.ndarray, doc: np.ndarray, k: int) -> list[np.ndarray]:
    """The ``k`` best (item, score, doc) of each item, by item."""
    order = np.lexsort((doc, -score, item))
    item, score, doc = item[order], score[order], doc[order]
    place = np.arange(len(item)) - np.searchsorted(item, item)
    return [a[place < k] for a in (item, score, doc)]


def search_block(docs: DataFrame, index: Index, k: int) -> DataFrame:
    """The best ``k`` documents per item of every task."""
    n_docs, n_terms, holding = statistics(docs, index.number)
    plain = (index.ids, index.number, index.first, index.holders, index.repeats)
    shared = docs.sparkSession.sparkContext.broadcast((plain, weights(n_docs, holding), n_docs, n_terms))

    def stream(batches):
        plain, weight, n_docs, n_terms = shared.value
        index = Index(*plain)
        get, n_items = index.number.get, len(index.ids)
        kept = [np.zeros(0, dtype=np.int64)] * 3
        least = np.ones(n_items, dtype=np.int64)
        at_once = max(1, SCORES_AT_ONCE // max(1, n_items))
        for batch in batches:
            rows, ids = batch.column("data").to_pylist(), batch.column("doc_id").to_numpy()
            for i in range(0, len(rows), at_once):
                found, lengths = [], []
                for data in rows[i : i + at_once]:
                    all_terms = terms(data, _TABLE)
                    found.append([n for n in map(get, all_terms) if n is not None])
                    lengths.append(75 + 25 * len(all_terms) * n_docs // n_terms if n_terms else 100)
                scores = score_batch(index, weight, found, lengths)
                doc, item = np.nonzero(scores >= least)
                new = (item, scores[doc, item], ids[i : i + at_once][doc])
                kept = best(*(np.concatenate(both) for both in zip(kept, new)), k)
                # An item whose list is full asks for the score of its last entry from now on.
                full = np.bincount(kept[0], minlength=n_items) >= k
                last = np.searchsorted(kept[0], np.arange(n_items), side="right") - 1
                least[full] = kept[1][last[full]]
        yield pa.RecordBatch.from_pydict({"item_id": index.ids[kept[0]], "doc_id": kept[2], "score": kept[1]})

    return docs.where("doc_id is not null").select("doc_id", "data").mapInArrow(stream, HITS)


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best documents with a score above 0."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("data"))
    items = items.where("item_id is not null and text is not null").groupBy(F.col("item_id").cast("long").alias("item_id"))
    items = items.agg(F.min("text").alias("text"))
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = -(-chars // BLOCK_CHARS)
    hits = spark.createDataFrame([], HITS)
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).orderBy("item_id").collect()
        index = build_index([tuple(r) for r in mine])
        if index.number:
            hits = hits.unionByName(search_block(docs, index, k)) if block else search_block(docs, index, k)
    order = [F.desc("score"), F.asc("doc_id")]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(MERGE_PARTS))
    near = hits.withColumn("_part", part).withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "_part").orderBy(*order)))
    near = near.where(F.col("rank") <= k).drop("rank", "_part")
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
