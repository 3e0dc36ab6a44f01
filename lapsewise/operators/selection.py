"""Feature correlation, pruning, chi-square scores and scaling on the feature table."""

from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PAIRS = T.StructType(
    [
        T.StructField("feature_a", T.StringType()),
        T.StructField("feature_b", T.StringType()),
        T.StructField("r", T.DoubleType()),
    ]
)


def correlation_pairs(table: DataFrame, columns: list[str]) -> list[tuple[str, str, float | None]]:
    """Pearson r of every column with every earlier one; None where a column is constant.

    Columns are centred and scaled first: the one-pass Gramian then loses no digits to large means.
    The matrix has one cell per pair of columns, whatever the number of rows. The columns are kept
    in memory or on executor disks meanwhile, because the statistics and the matrix take a few passes.
    """
    table = table.select(*columns).persist()
    try:
        return _correlation_pairs(table, columns)
    finally:
        table.unpersist()


def _correlation_pairs(table: DataFrame, columns: list[str]) -> list[tuple[str, str, float | None]]:
    stats = table.agg(
        *[f(F.col(c)).alias(f"{c}_{n}") for c in columns for n, f in (("avg", F.avg), ("std", F.stddev_samp))],
        *[(F.min(c) < F.max(c)).alias(f"{c}_varies") for c in columns],
    ).first()
    varying = [c for c in columns if stats[f"{c}_varies"]]
    matrix = None
    if len(varying) > 1:
        scaled = table.select(
            *[((F.col(c) - F.lit(stats[f"{c}_avg"])) / F.lit(stats[f"{c}_std"])).alias(c) for c in varying]
        )
        vectors = VectorAssembler(inputCols=varying, outputCol="v").transform(scaled).select("v")
        matrix = Correlation.corr(vectors, "v").first()[0].toArray()
    place = {c: i for i, c in enumerate(varying)}
    pairs = []
    for j, b in enumerate(columns):
        for a in columns[:j]:
            known = matrix is not None and a in place and b in place
            pairs.append((a, b, float(matrix[place[a], place[b]]) if known else None))
    return pairs


def feature_correlation(table: DataFrame, columns: list[str]) -> DataFrame:
    """Lower triangle of the correlation matrix in long form; ``feature_a`` comes first in order."""
    return table.sparkSession.createDataFrame(correlation_pairs(table, columns), _PAIRS)


def correlated_features(
    table: DataFrame,
    feature_cols: list[str],
    include_label: bool = False,
    related: float = 0.5,
    redundant: float = 0.8,
) -> list[str]:
    """Columns to drop: those closely correlated with a later column.

    Only columns with some |r| of at least ``related`` are compared; of those, a column goes if its
    signed r with a later one reaches ``redundant``. ``include_label`` puts churn in front.
    """
    columns = (["churn"] if include_label else []) + list(feature_cols)
    pairs = [(a, b, r) for a, b, r in correlation_pairs(table, columns) if r is not None]
    connected = {c for a, b, r in pairs if abs(r) >= related for c in (a, b)}
    dropped = {a for a, b, r in pairs if r >= redundant and a in connected and b in connected}
    return [c for c in columns if c in dropped]


def features_to_keep(table: DataFrame, feature_cols: list[str], **options) -> list[str]:
    dropped = set(correlated_features(table, feature_cols, **options))
    return [c for c in feature_cols if c not in dropped]


def names_table(spark: SparkSession, names: list[str], column: str) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], T.StructType([T.StructField(column, T.StringType())]))


def chi2_scores(table: DataFrame, feature_cols: list[str]) -> DataFrame:
    """Chi-square score of each non-negative feature against the label, best first.

    Users with a negative feature are left out. Class sums are one aggregation of the table; the
    score is then arithmetic on one row per class and feature. A feature that is 0 for everyone has
    no score and comes last.
    """
    usable = table.where(reduce(lambda a, b: a & b, [F.col(c) >= 0 for c in feature_cols]))
    sums = usable.groupBy("churn").agg(
        F.count("*").alias("class_size"), *[F.sum(F.col(c).cast("double")).alias(c) for c in feature_cols]
    )
    observed = sums.unpivot(["churn", "class_size"], feature_cols, "feature", "observed")
    per_feature = observed.groupBy("feature").agg(
        F.sum("class_size").alias("n"),
        F.sum("observed").alias("total"),
        F.collect_list(F.struct("class_size", "observed")).alias("classes"),
    )

    def term(c: Column) -> Column:
        expected = c["class_size"] / F.col("n") * F.col("total")
        return F.try_divide((c["observed"] - expected) * (c["observed"] - expected), expected)

    # One entry per label value.
    score = F.aggregate("classes", F.lit(0.0), lambda acc, c: acc + term(c))
    return per_feature.select("feature", score.alias("score")).orderBy(F.desc_nulls_last("score"), "feature")


def select_k_best(table: DataFrame, feature_cols: list[str], k: int) -> DataFrame:
    return chi2_scores(table, feature_cols).limit(k)


def best_features(table: DataFrame, feature_cols: list[str], k: int) -> list[str]:
    return [row.feature for row in select_k_best(table, feature_cols, k).collect()]


def min_max_scaled(table: DataFrame, feature_cols: list[str]) -> DataFrame:
    """Every feature scaled to 0..1; a constant feature becomes 0.5."""
    ranges = table.agg(
        *[F.min(c).cast("double").alias(f"{c}_min") for c in feature_cols],
        *[F.max(c).cast("double").alias(f"{c}_max") for c in feature_cols],
    ).first()

    def scaled(c: str) -> Column:
        low, high = ranges[f"{c}_min"], ranges[f"{c}_max"]
        if low is None or low == high:
            return F.lit(0.5).alias(c)
        return ((F.col(c) - F.lit(low)) / F.lit(high - low)).alias(c)

    return table.select("userId", "churn", *[scaled(c) for c in feature_cols])
