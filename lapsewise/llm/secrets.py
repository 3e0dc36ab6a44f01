"""Secret scan with character Markov models, in SQL functions alone.

Fixed rules find labelled samples: the values of assignments, access keys and long hex runs are the
random strings, the ASCII runs of all remaining text the ordinary ones, identifiers of the form being
judged among them (other candidates with a digit train neither side). Two first-order Markov
models are counted over all documents; a run that no rule covers is a secret if its mean
log-likelihood ratio exceeds ``limit``, more for short runs. Runs joined by dots or equal signs are
judged as one, then each by itself. Null and empty texts have no spans. Without samples the rules
alone decide. Repeated rows get equal spans. Offsets are code points, the end exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rules that label samples.
ASSIGN = (
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ["assign", "access", "hex", "random"]
LEAST = {"assign": 12, "access": 18, "hex": 16}
#: Runs of these characters may be random strings, by themselves or joined by dots and equal signs.
LEAST_RUN = 12
CHARS = "A-Za-z0-9+/_-"
RUN = rf"[{CHARS}]{{{LEAST_RUN},}}"
JOINED = rf"[{CHARS}][.={CHARS}]{{{LEAST_RUN - 1},}}(?<=[{CHARS}])"
#: Paths, slugs and versioned names: words and short numbers between separators.
_PART = r"(?:[A-Za-z]++[0-9]{0,4}|[0-9]{1,8})"
IDENTIFIER = rf"{_PART}(?:[+/_-]{_PART})+(?![{CHARS}])"
#: Bigrams of the models: both characters within a run.
BIGRAM = r"(?=([A-Za-z0-9+/_-]{2}))"
#: Runs with a digit that are no identifiers.
CANDIDATE = rf"(?<![{CHARS}])(?=[A-Za-z+/_-]*[0-9])(?!{IDENTIFIER}){RUN}"
FIRST_CODE, CODES, ALPHABET = 43, 80, 66
#: Limit of runs of FULL_RUN characters and more; the mean of a shorter one strays with the root of its length.
LIMIT, FULL_RUN = 0.7, 20


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, value) of all leftmost matches, from the lengths of matches and gaps."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    pairs = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("value"))

    def step(done: Column, pair: Column) -> Column:
        start = F.coalesce(F.get(done, F.size(done) - 1)["end"], F.lit(0)) + F.length(pair["gap"])
        span = F.struct(start.alias("start"), (start + F.length(pair["value"])).alias("end"), pair["value"].alias("value"))
        return F.concat(done, F.array(span))

    return F.when(F.size(found) > 0, F.aggregate(pairs, none, step)).otherwise(none)


def _named(kind: str, found: Column) -> Column:
    order = KINDS.index(kind)
    return F.transform(
        found,
        lambda m: F.struct(
            m["start"].alias("start"), F.lit(order).alias("rank"), F.lit(kind).alias("kind"),
            m["end"].alias("end"), m["value"].alias("value"),
        ),
    )


def base_spans(text: Column) -> Column:
    """Spans of the fixed rules, by start, then kind."""
    assigned = F.filter(
        matches(text, ASSIGN), lambda m: F.length(F.regexp_extract(m["value"], ASSIGN, 2)) >= LEAST["assign"]
    )
    # A run shorter than the least length cannot contain a longer one, so the length can be in the pattern.
    access = matches(text, ACCESS[:-1] + f"{{{LEAST['access'] - 4},}}")
    hexes = matches(text, HEX[:-1] + f"{{{LEAST['hex']},}}")
    return F.array_sort(F.concat(_named("assign", assigned), _named("access", access), _named("hex", hexes)))


def _scan(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_text", F.coalesce("text", F.lit(""))).withColumn("_base", base_spans(F.col("_text")))


def _log_shares(counts: dict[str, int], smooth: float) -> list[float]:
    """Log chance of each transition; rare contexts lean on how common the next character is at all."""
    first: dict[str, int] = {}
    after: dict[str, int] = {}
    for pair, n in counts.items():
        first[pair[0]] = first.get(pair[0], 0) + n
        after[pair[1]] = after.get(pair[1], 0) + n
    total = sum(counts.values()) + ALPHABET
    chars = [chr(code) for code in range(FIRST_CODE, FIRST_CODE + CODES)]
    common = {c: (after.get(c, 0) + 1) / total for c in chars}
    return [
        math.log((counts.get(a + b, 0) + smooth * common[b]) / (first.get(a, 0) + smooth)) for a in chars for b in chars
    ]


def fit(docs: DataFrame, smooth: float = 20.0) -> list[float] | None:
    """Log-likelihood ratio of each bigram, random against ordinary, counted over all documents."""
    rules = "|".join([ASSIGN, ACCESS[:-1] + "{14,}", HEX[:-1] + "{16,}", CANDIDATE])
    samples = _scan(docs.select("text")).select(
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("random"), F.regexp_replace("_text", rules, " ").alias("sample")),
                F.struct(
                    F.lit(1).alias("random"),
                    F.array_join(
                        F.transform("_base", lambda s: F.regexp_replace(s["value"], "^.*[:=\"' ]", "")), " "
                    ).alias("sample"),
                ),
            )
        ).alias("s")
    )
    counted = (
        samples.select("s.random", F.explode(F.regexp_extract_all("s.sample", F.lit(BIGRAM), F.lit(1))).alias("pair"))
        .groupBy("random", "pair").count().collect()  # at most two rows per pair of alphabet characters
    )
    sides = [{r.pair: r["count"] for r in counted if r.random == side} for side in (0, 1)]
    if not sides[1]:
        return None
    ordinary, random = (_log_shares(side, smooth) for side in sides)
    # The joints of a run say nothing.
    joints = {ord(c) - FIRST_CODE for c in ".="}
    return [
        0.0 if joints & {*divmod(i, CODES)} else r - o for i, (r, o) in enumerate(zip(random, ordinary))
    ]


def likelihood_ratio(run: Column, model: list[float]) -> Column:
    """Mean log-likelihood ratio of the transitions of a run."""
    table = F.split(F.lit(",".join(f"{v:.5f}" for v in model)), ",").cast("array<double>")
    codes = F.transform(F.split(run, ""), lambda c: F.ascii(c) - FIRST_CODE)
    steps = F.zip_with(
        F.slice(codes, F.lit(1), F.length(run) - 1), F.slice(codes, F.lit(2), F.length(run) - 1),
        lambda a, b: F.get(table, a * CODES + b),
    )
    return F.aggregate(steps, F.lit(0.0), lambda total, v: total + v) / (F.length(run) - 1)


def scan(docs: DataFrame, model: list[float] | None, limit: float = LIMIT) -> DataFrame:
    """``docs`` with ``spans``: array of (start, rank, kind, end, value) of the rules and the models."""
    found = _scan(docs)
    if model is None:
        return found.withColumn("spans", F.col("_base")).drop("_text", "_base")

    def is_secret(m: Column) -> Column:
        least = limit * F.sqrt(F.greatest(F.lit(1.0), FULL_RUN / F.length(m["value"])))
        free = ~F.exists("_base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))
        return free & m["value"].rlike("[A-Za-z0-9]") & (likelihood_ratio(m["value"], model) > least)

    def pieces(m: Column) -> Column:
        return F.transform(
            matches(m["value"], RUN),
            lambda p: F.struct(
                (m["start"] + p["start"]).alias("start"), (m["start"] + p["end"]).alias("end"), p["value"].alias("value")
            ),
        )

    found = found.withColumn("_runs", matches(F.col("_text"), JOINED))
    found = found.withColumn("_whole", F.filter("_runs", is_secret))
    rest = F.filter(F.array_except("_runs", "_whole"), lambda m: m["value"].rlike("[.=]"))
    found = found.withColumn("_pieces", F.filter(F.flatten(F.transform(rest, pieces)), is_secret))
    fresh = F.concat("_whole", "_pieces")
    return found.withColumn("spans", F.array_sort(F.concat("_base", _named("random", fresh)))).drop(
        "_text", "_base", "_runs", "_whole", "_pieces"
    )


def as_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(text: Column, spans: Column, mask: str = "<SECRET>") -> Column:
    """The text with every stretch that spans cover replaced by one mask."""
    def step(done: Column, s: Column) -> Column:
        gap = F.concat(
            done["out"], F.substring(text, done["at"] + 1, F.greatest(s["start"] - done["at"], F.lit(0))),
            F.when((s["start"] < done["at"]), F.lit("")).otherwise(F.lit(mask)),
        )
        return F.struct(gap.alias("out"), F.greatest(done["at"], s["end"]).alias("at"))

    empty = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    return F.when(F.size(spans) == 0, text).otherwise(
        F.aggregate(spans, empty, step, lambda d: F.concat(d["out"], F.substring(text, d["at"] + 1, F.length(text))))
    )
