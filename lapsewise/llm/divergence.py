"""Divergence audit: how far the sources of a language stand apart, term by term and pair by pair.

Each language has a vocabulary of its own: the terms in at least ``MIN_DOCS`` of its documents, by
CountVectorizer with the largest vocabSize. One fit serves all languages, as every term carries its
language, so that document counts are counts within the language and no language costs a pass of its own.
What the fit reads is reduced first: of the documents of a task that hold a term, at most ``MIN_DOCS`` are
handed on, which decides alike. The exact sparse count vectors over that vocabulary are
built where the documents are and added up sparsely per (language, source), never as dense sums. Pairs are
evaluated from the terms that both sources hold, and the rest in closed form: with z the p of a term
that a source does not hold, f(p, q) over all V terms is

    V f(za, zb) + sum over a (f(pa, zb) - f(za, zb)) + sum over b (f(za, qb) - f(za, zb))
                + sum over both (f(pa, qb) - f(pa, zb) - f(za, qb) + f(za, zb)),

whole numbers throughout, exact up to 9 * 10**13 terms (beyond, Spark raises an overflow error). The sums over one
source depend on its counts only, so they run over its distinct counts.

CountVectorizer holds its vocabulary on the driver and in each task. That is bounded: the vocabulary's size is
estimated from a hash slice of all terms, and terms are dealt by hash into as many models as keep
each at about ``MODEL_TERMS``; every term is in exactly one. Results do not depend on the split.

Null text, lang and source count as empty strings. Each repeated row is a document of its own. A group or language
without kept terms has pairs of value 0 and no terms; a language with one source has no pairs. Equal values are
ordered by item. Other columns are not read. Texts of any length are taken whole. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapsewise.llm import common
from lapsewise.llm.terms import byte_table, terms
from lapsewise.storage import new_path, write_and_reload

MIN_DOCS, TOP_TERMS = 3, 200
#: Terms per model, about; the slice of all terms that the estimate counts.
MODEL_TERMS, SLICE = 1_500_000, 64
#: Terms or counts that a task holds before it hands them on, terms per row it writes, pairs it adds up.
TERMS_AT_ONCE, TERMS_A_ROW, COUNTS_AT_ONCE, PAIRS_AT_ONCE = 400_000, 20_000, 400_000, 1_000_000
_TABLE = byte_table(digits=False)
_NONE = np.zeros(0, dtype=np.int64)


def term_rows(docs: DataFrame) -> DataFrame:
    """(terms): rows of terms, each led by its language's bytes in hex and a colon. A term stands in as many rows as
    documents of the task hold it, but in no more than ``MIN_DOCS`` each time the task hands on."""

    def flushed(holding: dict[bytes, Counter]):
        for times in range(MIN_DOCS):
            row = [tag + t for tag, counts in holding.items() for t, n in counts.items() if n > times]
            for i in range(0, len(row), TERMS_A_ROW):
                values = pa.array(row[i : i + TERMS_A_ROW], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays([0, len(values)], values)], ["terms"])

    def count(batches):
        holding: dict[bytes, Counter] = {}
        for batch in batches:
            for tag, data in zip(batch.column("tag").to_pylist(), batch.column("data").to_pylist()):
                holding.setdefault(tag, Counter()).update(set(terms(data, _TABLE)))
            if sum(map(len, holding.values())) > TERMS_AT_ONCE:
                yield from flushed(holding)
                holding = {}
        yield from flushed(holding)

    return docs.select("tag", "data").mapInArrow(count, "terms array<string>")


def n_models(rows: DataFrame) -> int:
    """Models needed to hold the vocabulary, from the terms of one hash slice."""
    one = rows.select(F.explode("terms").alias("term")).where(F.pmod(F.xxhash64("term"), F.lit(SLICE)) == 0)
    kept = one.groupBy("term").count().where(F.col("count") >= MIN_DOCS).count()
    return max(1, -(-kept * SLICE // MODEL_TERMS))


def vocabulary(rows: DataFrame, parts: int, part: int) -> bytes:
    """The kept terms of one part, one per line."""
    if parts > 1:
        mine = lambda t: F.pmod(F.xxhash64(F.lit(1), t), F.lit(parts)) == part
        rows = rows.select(F.filter("terms", mine).alias("terms"))
    # CountVectorizer refuses an empty vocabulary: an empty term, in three rows, is always in it.
    extra = rows.sparkSession.range(MIN_DOCS, numPartitions=1).select(F.array(F.lit("")).alias("terms"))
    model = CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(MIN_DOCS), vocabSize=2**31 - 1).fit(
        rows.unionByName(extra)
    )
    # Through a file, as one value: the terms as a Python list would take several times their size on the driver.
    path = new_path(rows.sparkSession, "divergence-model")
    model.write().save(path)
    saved = rows.sparkSession.read.parquet(f"{path}/data")
    joined = F.array_join(F.array_remove("vocabulary", F.lit("")), "\n").cast("binary")
    return bytes(saved.select(joined).first()[0])


_lines: dict[int, pa.Array] = {}


def term_lines(words: bytes) -> pa.Array:
    """The terms of a vocabulary, in order; a worker keeps those of the last one."""
    key = hash(words)
    if key not in _lines:
        _lines.clear()
        _lines[key] = pa.array(words.split(b"\n") if words else [], pa.binary())
    return _lines[key]


def group_counts(docs: DataFrame, words: bytes, part: int) -> tuple[DataFrame, DataFrame]:
    """(place, no, n): counts of one part's terms per group, and (no, tag, term) of its terms."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(words)
    base = part << 32

    def add_up(batches):
        # Per group the counts of its terms, kept or not.
        vectors: dict[tuple[int, bytes], Counter] = {}
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("place", "tag", "data"))
            for place, tag, data in zip(*columns):
                vector = vectors.get((place, tag))
                if vector is None:
                    vector = vectors[place, tag] = Counter()
                vector.update(terms(data, _TABLE))
            if sum(map(len, vectors.values())) > COUNTS_AT_ONCE:
                yield out(vectors)
                vectors = {}
        yield out(vectors)

    def out(vectors):
        """The counts of the kept terms; all terms are looked up at once."""
        tagged = pa.array((tag + t for (_, tag), vector in vectors.items() for t in vector), pa.binary())
        no = pc.index_in(tagged, value_set=term_lines(shared.value))
        sizes = [len(vector) for vector in vectors.values()]
        place = np.repeat(np.array([place for place, _ in vectors], dtype=np.int64), np.array(sizes, dtype=np.int64))
        n = np.fromiter(chain.from_iterable(v.values() for v in vectors.values()), dtype=np.int64, count=sum(sizes))
        kept = no.is_valid().to_numpy(zero_copy_only=False)
        no = no.drop_null().to_numpy(zero_copy_only=False).astype(np.int64) + base
        return pa.RecordBatch.from_pydict({"place": place[kept], "no": no, "n": n[kept]})

    def name(batches):
        for _ in batches:
            lines = shared.value.split(b"\n") if shared.value else []
            for i in range(0, len(lines), 100_000):
                words = [w.partition(b":") for w in lines[i : i + 100_000]]
                tags, found = (pa.array([w[k] for w in words], pa.binary()).cast(pa.string()) for k in (0, 2))
                yield pa.RecordBatch.from_pydict({"no": np.arange(i, i + len(words)) + base, "tag": tags, "term": found})

    # A task hands on a group's term once, so adding up before the shuffle would find nothing to add.
    sums = docs.select("place", "tag", "data").mapInArrow(add_up, "place long, no long, n long").repartition("no")
    return sums.groupBy("place", "no").agg(F.sum("n").alias("n")), spark.range(1, numPartitions=1).mapInArrow(
        name, "no long, tag string, term string"
    )


def f_value(p: str, q: str) -> str:
    return f"(({p}) - ({q})) * (({p}) - ({q})) div ({q})"


def p_value(n: str, total: str, size: str = "v") -> str:
    """1 + floor(10**9 * (n + 1) / (total + size)) by two long divisions, whose products fit in 64 bits."""
    a, m = f"(100000 * ({n} + 1))", f"({total} + {size})"
    return f"1 + 10000 * ({a} div {m}) + (10000 * ({a} % {m})) div {m}"


def both_terms(held: DataFrame) -> DataFrame:
    """(a, b, both): the sum over the terms that two sources hold; a term's holders stand together."""

    def add_up(batches):
        sums, rest = (_NONE, _NONE), [_NONE] * 4
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("no", "place", "p", "z")]
            columns = [np.concatenate(both) for both in zip(rest, columns)]
            starts = np.flatnonzero(np.diff(columns[0], prepend=-1))
            # The last term may go on in the next batch.
            rest = [c[starts[-1] :] for c in columns] if len(starts) else columns
            sums = added(sums, columns, starts)
            if len(sums[0]) > PAIRS_AT_ONCE:
                yield pairs_batch(sums)
                sums = (_NONE, _NONE)
        yield pairs_batch(added(sums, [*rest], np.zeros(1, dtype=np.int64), whole=True))

    def added(sums, columns, starts, whole=False):
        sizes = np.diff(starts, append=len(columns[0])) if whole else np.diff(starts)
        found = pair_sums(*columns[1:], starts[: len(sizes)], sizes)
        return _summed(*(np.concatenate(both) for both in zip(sums, found)))

    def pairs_batch(sums):
        return pa.RecordBatch.from_pydict({"a": sums[0] >> 32, "b": sums[0] & 0xFFFFFFFF, "both": sums[1]})

    spread = held.select("no", "place", "p", "z").repartition("no").sortWithinPartitions("no", "place")
    return spread.mapInArrow(add_up, "a long, b long, both long").groupBy("a", "b").agg(F.sum("both").alias("both"))


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(keys, return_inverse=True)
    out = np.zeros(len(found), dtype=np.int64)
    np.add.at(out, at, values)
    return found, out


def pair_sums(place: np.ndarray, p: np.ndarray, z: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
    """Per ordered pair of sources (the first in the upper half of the key) the sum over some terms, whose holders
    stand at ``starts``; terms with equally many holders are taken together."""
    f = lambda p, q: (p - q) * (p - q) // q
    keys, values = [_NONE], [_NONE]
    for size in np.unique(sizes[sizes > 1]).tolist():
        of_size, step = starts[sizes == size], max(1, 400_000 // (size * size))
        for i in range(0, len(of_size), step):
            at = of_size[i : i + step, None] + np.arange(size)
            first = [x[at][:, :, None] for x in (place, p, z)]
            second = [x[at][:, None, :] for x in (place, p, z)]
            (a, pa_, za), (b, qb, zb) = first, second
            value = f(pa_, qb) - f(pa_, zb) - f(za, qb) + f(za, zb)
            apart = np.broadcast_to(a != b, value.shape)
            found = _summed(((a << 32) | b)[apart], value[apart])
            keys.append(found[0]), values.append(found[1])
    return _summed(np.concatenate(keys), np.concatenate(values))


def audit(docs: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank) for parts ``pair`` and ``term``."""
    spark, rows_a_batch = docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(rows_a_batch)
    # Batches of whole texts are small; those of the sums over pairs need not be.
    common.small_batches(spark)
    try:
        sums, names, numbered = counted(docs)
    finally:
        spark.conf.set(rows_a_batch, before)

    totals = sums.groupBy("place").agg(F.sum("n").alias("total"))
    sizes = names.groupBy(F.unhex("tag").cast("string").alias("lang")).agg(F.count("*").alias("v"))
    groups = numbered.join(sizes, "lang", "left").join(totals, "place", "left")
    groups = groups.select(
        "lang", "source", F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("total", F.lit(0)).alias("total"), "place"
    )
    groups = write_and_reload(groups.withColumn("z", F.expr(f"if(v > 0, {p_value('0', 'total')}, 1)")), "divergence-groups")
    held = sums.join(groups, "place").select("no", "place", "n", F.expr(p_value("n", "total")).alias("p"), "z")
    held = write_and_reload(held, "divergence-held")
    return pairs(held, groups).unionByName(top_terms(held, names, groups))


def counted(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(place, no, n), (no, tag, term) and (lang, source, place), all written."""
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("lang", "source", "text")}
    docs = docs.select(
        text["lang"].alias("lang"), text["source"].alias("source"), text["text"].cast("binary").alias("data"),
        F.concat(F.hex(text["lang"].cast("binary")), F.lit(":")).cast("binary").alias("tag"),
    )
    # One row per source of a language.
    numbered = docs.select("lang", "source").distinct().withColumn(
        "place", (F.row_number().over(Window.orderBy("lang", "source")) - 1).cast("long")
    )
    numbered = write_and_reload(numbered, "divergence-places")
    placed = docs.join(numbered, ["lang", "source"])
    rows = write_and_reload(term_rows(docs), "divergence-rows")
    parts = n_models(rows)
    sums = names = None
    for part in range(parts):
        counts, named = group_counts(placed, vocabulary(rows, parts, part), part)
        # Each part is written before the next one takes its memory.
        counts, named = write_and_reload(counts, "divergence-counts"), write_and_reload(named, "divergence-terms")
        sums, names = (sums.unionByName(counts), names.unionByName(named)) if part else (counts, named)
    return sums, names, numbered


def pairs(held: DataFrame, groups: DataFrame) -> DataFrame:
    """Every ordered pair of sources of a language; ``held`` has one row per source and term that it holds."""
    mine = groups.select("lang", "source", F.col("place").alias("a"), "z", "v")
    other = groups.select("lang", F.col("source").alias("item"), F.col("place").alias("b"), F.col("z").alias("zb"))
    # Terms with equal p count together.
    alike = held.groupBy(F.col("place").alias("a"), "p").agg(F.count("*").alias("terms"))
    one_sided = alike.join(mine, "a").join(other, "lang").where("a <> b").groupBy("a", "b").agg(
        F.sum(F.expr(f"terms * ({f_value('p', 'zb')} - {f_value('z', 'zb')})")).alias("own"),
        F.sum(F.expr(f"terms * ({f_value('zb', 'p')} - {f_value('zb', 'z')})")).alias("others"),
    )
    one_sided = write_and_reload(one_sided, "divergence-sides")
    own = one_sided.select("a", "b", "own")
    others = one_sided.select(F.col("b").alias("a"), F.col("a").alias("b"), "others")
    value = mine.join(other, "lang").where("a <> b")
    for part in (both_terms(held), own, others):
        value = value.join(part, ["a", "b"], "left")
    sums = [F.coalesce(c, F.lit(0).cast("long")) for c in ("both", "own", "others")]
    value = value.select(
        "lang", "source", F.lit("pair").alias("part"), "item",
        (F.expr(f"v * ({f_value('z', 'zb')})") + sums[0] + sums[1] + sums[2]).alias("value"),
    )
    return _ranked(value)


def top_terms(held: DataFrame, names: DataFrame, groups: DataFrame, most: int = TOP_TERMS) -> DataFrame:
    """The terms of each source whose p is above that of its language, best first."""
    of_lang = F.sum("n").over(Window.partitionBy("no"))
    all_of = F.sum("total").over(Window.partitionBy("lang"))
    sized = groups.select("lang", "source", "place", "v", all_of.alias("lang_total"))
    rows = held.select("no", "place", "p", of_lang.alias("lang_n")).join(sized, "place")
    rows = rows.withColumn("q", F.expr(p_value("lang_n", "lang_total"))).where("p > q")
    rows = rows.select("lang", "source", "place", "no", F.expr(f_value("p", "q")).alias("value"))
    # Those whose value is among the best, ties included; only they need their names.
    best = F.rank().over(Window.partitionBy("place").orderBy(F.desc("value")))
    rows = rows.withColumn("_best", best).where(F.col("_best") <= most).join(names, "no")
    rows = rows.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    return _ranked(rows).where(F.col("rank") <= most)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return rows.withColumn("rank", F.row_number().over(order))
