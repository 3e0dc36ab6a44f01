"""Ranks over a whole table without putting it through one task."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapsewise.storage import write_and_reload


def counts_below(df: DataFrame, by: list[str], value: str, counts: list[str]) -> DataFrame:
    """For rows that are unique by (by, value): ``below_<c>``, the sum of each count over the group's smaller values.

    Rows are dealt into ranges of (by, value). Each range adds up its own rows, and the sums of the
    ranges, few numbers, give every range its start. The ranges are written once, so that both
    steps see the same ones.
    """
    dealt = df.repartitionByRange(*by, value).withColumn("_range", F.spark_partition_id())
    dealt = write_and_reload(dealt, "ranges")
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy(*by, "_range").agg(*[F.sum(c).alias(f"_sum_{c}") for c in counts])
    starts = sums.select(*by, "_range", *[_or_0(F.sum(f"_sum_{c}").over(earlier)).alias(f"_start_{c}") for c in counts])
    within = Window.partitionBy(*by, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.join(starts, [*by, "_range"])
    below = {f"below_{c}": F.col(f"_start_{c}") + _or_0(F.sum(c).over(within)) for c in counts}
    return placed.withColumns(below).drop("_range", *[f"_start_{c}" for c in counts])


def _or_0(count: Column) -> Column:
    return F.coalesce(count, F.lit(0).cast("long"))


def area_under_curve(scored: DataFrame, score: str, label: str = "churn", by: list[str] | None = None) -> DataFrame:
    """Area under the ROC curve of a score, by average ranks: a tie of the two classes counts half.

    One row per group with its class sizes; the area is null where a class is missing. Rows without
    score or label do not count.
    """
    by = by or []
    known = scored.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    known = known.select(*by, F.col(score).cast("double").alias("_score"), (F.col(label) == 1).alias("_positive"))
    if not by:
        known, by = known.withColumn("_all", F.lit(1)), ["_all"]
    counts = known.groupBy(*by, "_score").agg(
        F.count_if("_positive").alias("_pos"), F.count_if(~F.col("_positive")).alias("_neg")
    )
    ranked = counts_below(counts, by, "_score", ["_neg"])
    # Twice the number of ordered pairs, to stay with whole numbers.
    pairs = F.col("_pos").cast("decimal(20,0)") * (2 * F.col("below__neg") + F.col("_neg"))
    sums = ranked.groupBy(*by).agg(
        F.sum("_pos").alias("n_positive"), F.sum("_neg").alias("n_negative"), F.sum(pairs).alias("_pairs")
    )
    both = 2.0 * F.col("n_positive") * F.col("n_negative")
    return sums.select(
        *[c for c in by if c != "_all"], "n_positive", "n_negative", F.try_divide(F.col("_pairs").cast("double"), both).alias("auc")
    )
