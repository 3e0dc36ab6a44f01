"""Quality rules with a hashed n-gram log-likelihood ratio of trusted text against the raw corpus.

Two multinomials over hashed character n-grams are counted: at most ``TRUSTED_ROWS`` rows labelled good are the trusted
target, all rows are the raw corpus. A text's score is the mean log ratio of its
n-grams. The threshold comes from the scores of the labelled rows and every text is judged by it.
Null and empty texts have no words, fail the base rule and score 0. Repeated rows are judged alike.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.llm import common
from lapsewise.storage import write_and_reload

SIZES, DIMS = (2, 3), 8192
#: Rows labelled good that form the trusted target, at most, by a hash of their ids.
TRUSTED_ROWS = 20_000
#: Share of the trusted rows that the threshold must keep.
LEAST_TRUSTED = 0.99
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOL = re.compile(r"[#*$%&|<>]")


def text_rules(text: str) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, words in repeated windows of three."""
    words = _WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    often = Counter(windows)
    repeated = np.zeros(len(words), dtype=bool)
    for i, window in enumerate(windows):
        if often[window] > 1:
            repeated[i : i + 3] = True
    lines = Counter(line for line in text.split("\n") if _WORD.search(line))
    return (
        len(words), sum(map(len, words)), len(_SYMBOL.findall(text)),
        sum(lines.values()) - len(lines), int(repeated.sum()),
    )


def count_ngrams(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Bucket counts over all documents: row 0 the raw corpus, row 1 the trusted target."""
    trusted = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("_trusted")).distinct()
    # A bounded sample: its ids go to every task, so that no text moves.
    trusted = F.broadcast(trusted.orderBy(F.xxhash64(F.lit(3), "_trusted"), "_trusted").limit(TRUSTED_ROWS))
    marked = docs.select("doc_id", "text").join(trusted, F.col("doc_id") == F.col("_trusted"), "left")

    def count(batches):
        sums = np.zeros((2, DIMS), dtype=np.int64)
        for batch in batches:
            for text, good in zip(batch["text"], batch["good"]):
                if text:
                    counts = np.bincount(common.ngram_buckets(text, SIZES, DIMS), minlength=DIMS)
                    sums[0] += counts
                    if good:
                        sums[1] += counts
        yield pd.DataFrame({"bucket": np.arange(DIMS), "raw": sums[0], "good": sums[1]})

    counted = marked.select("text", F.col("_trusted").isNotNull().alias("good")).mapInPandas(
        count, "bucket int, raw long, good long"
    )
    totals = np.zeros((2, DIMS))
    for r in counted.groupBy("bucket").agg(F.sum("raw"), F.sum("good")).collect():  # DIMS rows
        totals[:, r[0]] = r[1], r[2]
    return totals


def log_ratio(counts: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    shares = (counts + smooth) / (counts + smooth).sum(axis=1, keepdims=True)
    return np.log(shares[1]) - np.log(shares[0])


def score(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """Rule figures and score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    @F.pandas_udf(
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double"
    )
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            text = text or ""
            buckets = common.ngram_buckets(text, SIZES, DIMS)
            value = float(shared.value[buckets].mean()) if len(buckets) else 0.0
            rows.append((*text_rules(text), round(value, 6)))
        return pd.DataFrame(
            rows, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score"]
        )

    return docs.select("doc_id", run("text").alias("r")).select("doc_id", "r.*")


def best_threshold(scored: DataFrame, labels: DataFrame) -> float:
    """Threshold with the best balanced accuracy that keeps ``LEAST_TRUSTED`` of the trusted rows."""
    given = labels.where("quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    bins = (
        scored.join(given, "doc_id").where("n_words > 0")
        .groupBy(F.round("score", 3).alias("bin"))
        .agg(F.sum((F.col("quality") == 1).cast("long")), F.sum((F.col("quality") != 1).cast("long")))
        .collect()  # scores lie within +-20, so at most 40,000 bins
    )
    good, bad = sum(r[1] for r in bins) or 1, sum(r[2] for r in bins) or 1
    best, result, lost, cut = -1.0, -1e9, 0, 0
    for r in sorted(bins):
        if lost / good <= 1 - LEAST_TRUSTED and (value := cut / bad - lost / good) > best:
            best, result = value, r[0] - 0.0005
        lost, cut = lost + r[1], cut + r[2]
    return float(result)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Figures, score, base_failed and kept of every document."""
    common.small_batches(docs.sparkSession)
    scored = write_and_reload(score(docs, log_ratio(count_ngrams(docs, labels))), "quality")
    limit = best_threshold(scored, labels)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= F.lit(limit))
    )
