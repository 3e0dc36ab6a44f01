"""Exact quantiles of large groups."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsewise.operators.ranking import counts_below
from lapsewise.storage import write_and_reload

#: Rank error of the sketch is at most the group's size divided by this.
ACCURACY = 100_000
#: Ranks by which a bracket may reach beyond the wanted one, as shares of the group, from narrow to all.
SLACKS = [3.0 / ACCURACY, 1e-3, 0.05, 1.0]


def exact_quantiles(df: DataFrame, by: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact quantiles with linear interpolation, one column per entry of ``probs``.

    ``percentile`` keeps all distinct values of a group in one task. Here a group may be most of
    the data: a quantile sketch brackets each wanted rank, values below the bracket are only
    counted, and only values inside it are put in order, over ranges of values. The counts prove whether a bracket
    holds its rank. One that does not is replaced by the whole group, so a wrong sketch costs time,
    never a wrong result. Groups are few: a label, a metric or page name.
    """
    data = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    wanted = write_and_reload(brackets(data, by, probs), "brackets")
    found = _inside(data, wanted, by)
    failed = wanted.join(_proven(found, by), [*by, "name"], "left_anti")
    if failed.limit(1).count():
        whole = failed.withColumns({"low": F.lit(float("-inf")), "high": F.lit(float("inf"))})
        proven = found.join(failed.select(*by, "name"), [*by, "name"], "left_anti")
        found = proven.unionByName(_inside(data, whole, by))
    return _at_ranks(found, by, probs)


def brackets(data: DataFrame, by: list[str], probs: dict[str, float]) -> DataFrame:
    """Per group and quantile: the ranks to find (from 0) and a value range that should hold them."""
    edges = sorted({min(max(p + s, 0.0), 1.0) for p in probs.values() for slack in SLACKS for s in (-slack, slack)})
    sketches = data.groupBy(*by).agg(
        F.count("*").alias("_n"), F.percentile_approx("_v", edges, ACCURACY).alias("_edges")
    )
    rows = []
    for name, p in probs.items():
        rank = F.lit(p) * (F.col("_n") - 1)
        rows.append(
            F.struct(
                F.lit(name).alias("name"),
                F.floor(rank).alias("rank_below"),
                F.ceil(rank).alias("rank_above"),
                (rank - F.floor(rank)).alias("fraction"),
                _edge(edges, p, -1).alias("low"),
                _edge(edges, p, 1).alias("high"),
            )
        )
    return sketches.select(*by, F.explode(F.array(*rows)).alias("_q")).select(*by, "_q.*")


def _edge(edges: list[float], p: float, side: int) -> Column:
    """The sketch's value at the narrowest slack that is worth three ranks of the group."""
    at = lambda slack: F.col("_edges")[edges.index(min(max(p + side * slack, 0.0), 1.0))]
    value = at(SLACKS[-1])
    for slack in reversed(SLACKS[:-1]):
        value = F.when(F.col("_n") * slack >= 3, at(slack)).otherwise(value)
    return value


def _inside(data: DataFrame, wanted: DataFrame, by: list[str]) -> DataFrame:
    """Per group and quantile the values up to the bracket's end and how often they occur, those below it as one row."""
    lower = F.col("_v") < F.col("low")
    rows = data.join(wanted, by).where(F.col("_v") <= F.col("high"))
    rows = rows.withColumns({"_lower": lower, "_v": F.when(lower, float("-inf")).otherwise(F.col("_v"))})
    counted = rows.groupBy(*by, "name", "rank_below", "rank_above", "fraction", "_lower", "_v")
    return write_and_reload(counted.agg(F.count("*").alias("_c")), "quantiles")


def _proven(found: DataFrame, by: list[str]) -> DataFrame:
    """Brackets whose inside holds the wanted ranks, by the counts below and up to its end."""
    sums = found.groupBy(*by, "name").agg(
        F.max("rank_below").alias("rank_below"), F.max("rank_above").alias("rank_above"),
        F.sum(F.when(F.col("_lower"), F.col("_c")).otherwise(0)).alias("_before"), F.sum("_c").alias("_upto"),
    )
    return sums.where("_before <= rank_below and rank_above < _upto").select(*by, "name")


def _at_ranks(found: DataFrame, by: list[str], probs: dict[str, float]) -> DataFrame:
    ranked = counts_below(found, [*by, "name"], "_v", ["_c"])
    upto = F.col("below__c") + F.col("_c")

    def at(rank: str):
        return F.max(F.when((F.col("below__c") <= F.col(rank)) & (F.col(rank) < upto), F.col("_v")))

    of_rank = ranked.groupBy(*by, "name").agg(
        at("rank_below").alias("_below"), at("rank_above").alias("_above"), F.max("fraction").alias("fraction")
    )
    value = F.col("_below") + (F.col("_above") - F.col("_below")) * F.col("fraction")
    columns = [F.max(F.when(F.col("name") == n, value)).alias(n) for n in probs]
    return of_rank.groupBy(*by).agg(*columns)
