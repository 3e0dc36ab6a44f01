"""Near duplicates by BagMinHash signatures, banding and verified multiset overlap.

A text is the multiset of its five-word shingles; a shorter text is one shingle of all its words.
Shingle weights are cut into levels that double ([0,1), [1,2), [2,4), ...). Each level of each
shingle has a Poisson process of points in time, every point with a place within the level and a
register; a point counts if its place lies below the shingle's weight. A register keeps the earliest
point, so registers of two texts agree with the probability of their weighted Jaccard similarity,
and a process stops once it is later than all registers of its text.

Equal word sequences are grouped first. Texts that share a band are compared with
one leader per band, then components that still share a band are compared in full, so no candidate
is lost; in large buckets by their parities, block by block, without a row per pair. A pair's items are moved only if the parities of its shingles, a few hundred bytes, leave it
open whether the texts are alike. Texts
without words (null, empty) stand alone. Repeated rows fall into one class; the class is its
smallest doc_id. Rows with a null doc_id take no part; of
several texts with one doc_id the one with the smallest digest counts. An empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsewise.storage import write_and_reload, write_bucketed

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 25, 5
REGISTERS = BANDS * ROWS
#: Longs that hold the parities of a text's items.
PARITY_LONGS = 32
#: Parts over which the rows of one key are dealt.
SALTS = 16
#: Edges of one text that go to one task.
EDGES_PER_PART = 512
#: Texts of a bucket, at most, that are joined with each other; those of a larger one are compared in blocks of this size.
JOINED, BLOCK = 32, 2048
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_hashes(text: str) -> np.ndarray:
    """Hash of each run of five words, repeats included."""
    words = _WORD.findall(text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    codes = np.array([xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words], dtype=np.uint64)
    size = min(WORDS, len(codes))
    out = np.full(len(codes) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        out = mix(out ^ codes[i : i + len(out)])
    return out


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def levels(values: np.ndarray, weights: np.ndarray, owner: np.ndarray):
    """Every weight level that a shingle reaches: seed, length, part covered, owner."""
    found, low, high, level = [], 0, 1, 0
    while len(values):
        covered = np.minimum(weights, high) - low
        found.append((mix(values ^ np.uint64(level + 1)), np.full(len(values), high - low), covered, owner))
        more = weights > high
        values, weights, owner = values[more], weights[more], owner[more]
        low, high, level = high, 2 * high, level + 1
    return [np.concatenate(part) for part in zip(*found)]


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], registers: int = REGISTERS) -> np.ndarray:
    """One row of registers per bag of (shingles, whole weights); each bag has at least one shingle."""
    owner = np.repeat(np.arange(len(bags)), [len(v) for v, _ in bags])
    seed, length, covered, owner = levels(
        np.concatenate([v for v, _ in bags]), np.concatenate([w for _, w in bags]), owner
    )
    best = np.full(len(bags) * registers, np.inf)
    holder = np.zeros(len(bags) * registers, dtype=np.uint64)
    time, step = np.zeros(len(seed)), 0
    while len(seed):
        step += 1
        state = mix(seed + np.uint64(step * 0x9E3779B97F4A7C15 % (1 << 64)))
        time = time - np.log(_uniform(state)) / length
        place = mix(state ^ np.uint64(0xA5A5A5A5A5A5A5A5))
        slot = owner * registers + (place % np.uint64(registers)).astype(np.int64)
        inside = (_uniform(mix(place)) * length < covered) & (time < best[slot])
        # Later writes win: the earliest point comes last.
        at, when, what = slot[inside], time[inside], state[inside]
        order = np.argsort(-when, kind="stable")
        best[at[order]], holder[at[order]] = when[order], what[order]
        if step % 4 == 0 or len(seed) > 4096:
            latest = best.reshape(len(bags), registers).max(axis=1)
            going = time < latest[owner]
            seed, length, covered, owner, time = (a[going] for a in (seed, length, covered, owner, time))
    return holder.reshape(len(bags), registers)


def band_hashes(signature: np.ndarray) -> np.ndarray:
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(signature), BANDS)).copy()
    for i in range(ROWS):
        out = mix(out ^ signature[:, i::ROWS])
    return out.astype(np.int64)


def items(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """A multiset as a set: the n-th time of a shingle is an item of its own."""
    nth = np.arange(weights.sum()) - np.repeat(np.cumsum(weights) - weights, weights)
    return mix(np.repeat(values, weights) + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.int64)


def parities(found: np.ndarray) -> np.ndarray:
    """Number of items, then for each of ``64 * PARITY_LONGS`` cells whether it holds an odd number of them."""
    cells = np.bincount((found.view(np.uint64) >> np.uint64(32)).astype(np.int64) % (64 * PARITY_LONGS), minlength=64 * PARITY_LONGS)
    bits = np.packbits((cells & 1).astype(np.uint8)).view(np.int64)
    return np.concatenate([[len(found)], bits]).astype(np.int64)


def most_alike(a: Column, b: Column) -> Column:
    """No less than the similarity of two texts: cells of different parity hold an item of one of them alone."""
    sizes = a[0] + b[0]
    apart = F.aggregate(
        F.zip_with(F.slice(a, 2, PARITY_LONGS), F.slice(b, 2, PARITY_LONGS), lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        F.lit(0), lambda n, one: n + one,
    )
    common = F.least(F.floor((sizes - apart) / 2), a[0], b[0])
    return common / (sizes - common)


def _bags(texts) -> list[tuple[np.ndarray, np.ndarray]]:
    return [np.unique(shingle_hashes(t), return_counts=True) for t in texts]


def _sketched(batches):
    """Bands and parities of every row; none of a text without words. Equal texts of a batch are sketched once."""
    for batch in batches:
        for i in range(0, len(batch), 512):
            part = batch.iloc[i : i + 512]
            texts = dict(zip(part["digest"], part["text"].fillna("")))
            bags = {d: bag for d, bag in zip(texts, _bags(texts.values())) if len(bag[0])}
            bands = dict(zip(bags, band_hashes(signatures(list(bags.values()))))) if bags else {}
            parity = {d: parities(items(v, w)) for d, (v, w) in bags.items()}
            yield pd.DataFrame({
                "id": part["id"].to_numpy(), "digest": part["digest"].to_numpy(),
                "bands": [bands.get(d) for d in part["digest"]], "parities": [parity.get(d) for d in part["digest"]],
            })


def _itemized(batches):
    for batch in batches:
        found = [items(v, w) for v, w in _bags(batch["text"])]
        yield pd.DataFrame({"rep": batch["rep"].to_numpy(), "items": found})


def _spread_join(rows: DataFrame, lookup: DataFrame, on: list[str], by: str, how: str = "inner") -> DataFrame:
    """Join with a narrow table that has one row per key; one key's rows are dealt over ``SALTS`` parts."""
    spread = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    return salted.join(spread, [*on, "_salt"], how).drop("_salt")


def _pairs(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _shared(buckets: DataFrame) -> DataFrame:
    """Bucket rows of the buckets that hold several texts, with the smallest of them."""
    lead = buckets.groupBy("band", "hash").agg(F.min("rep").alias("lead"), F.max("rep").alias("_last"))
    lead = lead.where("lead < _last").drop("_last")
    return write_and_reload(_spread_join(buckets, lead, ["band", "hash"], "rep"), "dedup-buckets")


def _stars(shared: DataFrame) -> DataFrame:
    """Pairs of each bucket's smallest text with the rest; mostly the same leader in all bands."""
    return shared.where("rep <> lead").select(*_pairs("rep", "lead")).distinct()


def _near_stars(placed: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """Pairs of another leader, different in each band, with the texts of other components, that may be alike."""
    lead = placed.groupBy("band", "hash").agg(
        F.min_by(F.struct("rep", "comp"), F.xxhash64("band", "rep")).alias("lead")
    )
    joined = _spread_join(placed, lead, ["band", "hash"], "rep").where("comp <> lead.comp")
    pairs = joined.select("rep", F.col("lead.rep").alias("lead")).select(*_pairs("rep", "lead")).distinct()
    return _near(pairs, sketches, least)


def _near_open(placed: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """All pairs of different components, within the buckets that still hold several, that may be alike by their parities."""
    some = placed.where(F.col("texts") <= JOINED)
    other = some.select("band", "hash", F.col("rep").alias("rep2"), F.col("comp").alias("comp2"))
    joined = some.join(other, ["band", "hash"]).where("rep < rep2 and comp <> comp2")
    pairs = joined.select(F.col("rep").alias("a"), F.col("rep2").alias("b")).distinct()
    many = write_and_reload(_near_in_blocks(placed.where(F.col("texts") > JOINED), sketches, least), "dedup-near")
    return _near(pairs, sketches, least).union(many).distinct()


def _near_in_blocks(placed: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """Those pairs of large buckets: two blocks of texts at a time meet in one task, so that pairs become rows only
    if they may be alike."""
    blocks = F.ceil(F.col("texts") / BLOCK).cast("int")
    held = placed.join(sketches.select("rep", "parities"), "rep").withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int"))
    dealt = held.withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        "band", "hash", "rep", "comp", "block", "parities",
        F.least("block", "_other").alias("low"), F.greatest("block", "_other").alias("high"),
    )

    def compare(cell: pd.DataFrame) -> pd.DataFrame:
        return near_pairs(cell, least)

    return dealt.groupBy("band", "hash", "low", "high").applyInPandas(compare, "a long, b long")


def near_pairs(cell: pd.DataFrame, least: float) -> pd.DataFrame:
    """The pairs of different components, of one block or between two, whose ``most_alike`` is large enough."""
    cell = cell.sort_values(["block", "comp"])
    rep, comp, block = (cell[c].to_numpy() for c in ("rep", "comp", "block"))
    held = np.stack(cell["parities"].to_numpy())
    n, bits = held[:, 0].copy(), held[:, 1:].copy().view(np.uint64)
    # Within a block the components after one's own, otherwise the other block.
    first = np.searchsorted(block, block, side="right")
    if len(block) and block[0] == block[-1]:
        first = np.searchsorted(comp, comp, side="right")
    a, b = [], []
    for i in np.flatnonzero(first < len(rep)):
        j = first[i]
        sizes = n[i] + n[j:]
        apart = np.bitwise_count(bits[j:] ^ bits[i]).sum(axis=1, dtype=np.int64)
        common = np.minimum(np.minimum((sizes - apart) // 2, n[j:]), n[i])
        found = rep[j:][(common / (sizes - common) >= least) & (comp[j:] != comp[i])]
        a.append(np.minimum(found, rep[i])), b.append(np.maximum(found, rep[i]))
    none = np.zeros(0, dtype=np.int64)
    return pd.DataFrame({"a": np.concatenate([none, *a]), "b": np.concatenate([none, *b])})


def _still_open(buckets: DataFrame, comps: DataFrame) -> DataFrame:
    """Bucket rows of the buckets that hold texts of several components, with the bucket's number of texts."""
    placed = buckets.join(comps.withColumnRenamed("node", "rep"), "rep", "left").select(
        "rep", "band", "hash", F.coalesce("comp", "rep").alias("comp")
    )
    several = placed.groupBy("band", "hash").agg(
        F.min("comp").alias("_x"), F.max("comp").alias("_y"), F.count("*").alias("texts")
    )
    several = several.where("_x <> _y").drop("_x", "_y")
    return write_and_reload(_spread_join(placed, several, ["band", "hash"], "rep"), "dedup-open")


def similarity(a: Column, b: Column) -> Column:
    common = F.size(F.array_intersect(a, b))
    return common / (F.size(a) + F.size(b) - common)


def _busy(pairs: DataFrame) -> DataFrame:
    """(rep, parts) of the texts in so many pairs that they are handed to several parts."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("rep"))
    parts = ends.groupBy("rep").agg(F.ceil(F.count("*") / EDGES_PER_PART).cast("int").alias("_parts"))
    return write_and_reload(parts.where("_parts > 1"), "dedup-busy")


def _with_items(rows: DataFrame, pairs: DataFrame, busy: DataFrame, side: str, sketches: DataFrame) -> DataFrame:
    """Attach the items of one side to ``rows`` of the pairs; a text in many pairs is handed to several parts."""
    other = "b" if side == "a" else "a"
    parts = busy.withColumnRenamed("rep", side)
    held = pairs.select(side).distinct().join(sketches.select(F.col("rep").alias(side), F.col("items").alias(f"{side}_items")), side)
    held = held.join(parts, side, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
    dealt = _spread_join(rows, parts, [side], other, "left").withColumn(
        "_part", F.pmod(F.xxhash64(other), F.coalesce("_parts", F.lit(1))).cast("int")
    )
    return dealt.drop("_parts").join(held.drop("_parts"), [side, "_part"]).drop("_part")


def _with_both(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs with the items of both sides."""
    busy = _busy(pairs)
    return _with_items(_with_items(pairs, pairs, busy, "a", sketches), pairs, busy, "b", sketches)


def verified(pairs: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    both = _with_both(pairs, sketches)
    return both.where(similarity(F.col("a_items"), F.col("b_items")) >= least).select("a", "b")


def _near(pairs: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """The pairs that may be alike by their parities."""
    held = sketches.select("rep", F.col("parities").alias("items"))
    pairs = write_and_reload(pairs, "dedup-pairs")
    both = _with_both(pairs, held)
    return write_and_reload(both.where(most_alike(F.col("a_items"), F.col("b_items")) >= least).select("a", "b"), "dedup-near")


def components(edges: DataFrame, name: str = "dedup-components") -> DataFrame:
    """(node, comp) of the nodes in ``edges`` (a < b): every node hangs on its smallest neighbour, then
    larger and smaller neighbours are relinked in turn until nothing moves; each round is written."""
    def mark(pairs: DataFrame):
        return pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1000003)).first()

    before = mark(edges)
    while True:
        both = edges.union(edges.select("b", "a"))
        # Large star: larger neighbours hang on the smallest of the neighbourhood.
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # Dealt once, for the sums and the join of the next step.
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").repartition("b")
        # Small star: smaller neighbours hang on the smallest.
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b").select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y"))
        small = small.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
        edges = write_and_reload(small, name)
        after = mark(edges)
        if before == after:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("comp"))
        before = after


def _spaced(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "))


def digest(key: Column, text: Column) -> Column:
    """Equal word sequences share a digest; texts without words get one of their own."""
    return F.when(_spaced(text) == "", F.concat(F.lit("id "), key.cast("long").cast("string"))).otherwise(
        F.sha2(_spaced(text).cast("binary"), 256)
    )


def classes(docs: DataFrame, least: float = SIMILARITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, class_id) of every row with a key."""
    docs = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    marked = docs.select("id", digest(F.col("id"), F.col("text")).alias("digest"), "text")
    marked = write_and_reload(
        marked.mapInPandas(_sketched, "id long, digest string, bands array<long>, parities array<long>"), "dedup-digests"
    )
    # One digest per id, then one id per digest: a representative stands for one text only.
    counted = marked.groupBy("id").agg(F.min("digest").alias("digest"), (F.min("digest") < F.max("digest")).alias("several"))
    reps = counted.groupBy("digest").agg(F.min("id").alias("rep"), F.min_by("several", "id").alias("several"))
    placed = _spread_join(counted.select("id", "digest"), reps, ["digest"], "id")
    # The representative's own row tells what is meant by it.
    own = [F.when(F.col("id") == F.col("rep"), F.col(name)).alias(name) for name in ("digest", "several")]
    members = write_and_reload(placed.select("id", "rep", *own), "dedup-members")
    texts = members.where("id = rep and digest not like 'id %'").select("rep", F.col("digest").alias("counted"), "several")
    kept = marked.join(texts, marked["id"] == texts["rep"]).where("digest = counted").dropDuplicates(["rep"])
    # Only an id with several texts needs its digests once more to tell which one is meant.
    meant = F.when(F.col("several"), F.col("digest")).alias("counted")
    sketches = write_bucketed(kept.select("rep", "bands", "parities", meant), "dedup-sketches", "rep")
    buckets = _shared(sketches.select("rep", F.posexplode("bands").alias("band", "hash")))
    held = _items_of(docs, sketches.select("rep", "counted").join(buckets.select("rep").distinct(), "rep"))
    edges = write_and_reload(verified(_near(_stars(buckets), sketches, least), held, least), "dedup-edges")
    comps = components(edges)
    for further in (_near_stars, _near_open):
        near = further(_still_open(buckets.drop("lead"), comps), sketches, least)
        found = write_and_reload(verified(near, held, least), "dedup-edges")
        if not found.isEmpty():
            comps = components(comps.select(F.col("comp").alias("a"), F.col("node").alias("b")).union(found))
    out = _spread_join(members.select("id", "rep"), comps.withColumnRenamed("node", "rep"), ["rep"], "id", "left")
    return out.select(F.col("id").alias(key), F.coalesce("comp", "rep").alias("class_id"))


def _items_of(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """(rep, items) of the texts that share a bucket with another, one row each."""
    reps = write_and_reload(reps, "dedup-compared")
    meant = F.col("counted").isNull() | (digest(F.col("id"), F.col("text")) == F.col("counted"))
    texts = docs.join(reps, docs["id"] == reps["rep"]).where(meant).dropDuplicates(["rep"]).select("rep", "text")
    return write_bucketed(texts.mapInPandas(_itemized, "rep long, items array<long>"), "dedup-items", "rep")
