"""Report tables made from the segment and metric summaries."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.operators.numeric import numeric_summary
from lapsewise.operators.segments import churn_rates

# Contents of the two published statistics tables.
TABLE_FEATURES = ["gender", "level", "browser", "status"]
TABLE_METRICS = [
    "num_sessions",
    "session_interval_hours",
    "avg_session_length",
    "count_songs",
    "count_unique_artists",
]


def churn_rate_table(log: DataFrame, dataset: str, features: list[str] = TABLE_FEATURES) -> DataFrame:
    """Churn rates of several features under each other."""
    rates = churn_rates(log, features).select("feature", "category", "churn_rate")
    return rates.withColumn("dataset", F.lit(dataset)).orderBy("feature", "category")


def numeric_summary_table(log: DataFrame, dataset: str, metrics: list[str] = TABLE_METRICS) -> DataFrame:
    """One row per metric, statistics of both groups side by side as whole numbers."""
    summary = numeric_summary(log, metrics)
    columns = [
        F.max(F.when(F.col("churn") == group, F.bround(F.round(stat, 6), 0))).cast("long").alias(f"{stat}_{group}")
        for stat in ("q1", "median", "mean", "q3", "std")
        for group in (0, 1)
    ]
    return summary.groupBy("metric").agg(*columns).withColumn("dataset", F.lit(dataset)).orderBy("metric")


def _side_by_side(tables: dict[str, DataFrame], keys: list[str], values: list[str]) -> DataFrame:
    """Union of the tables of several datasets, then one column per value and dataset."""
    stacked = reduce(DataFrame.unionByName, tables.values())
    cells = [
        F.max(F.when(F.col("dataset") == d, F.col(v))).alias(f"{v}_{d}") for v in values for d in tables
    ]
    return stacked.groupBy(*keys).agg(*cells).orderBy(*keys)


def compare_numeric(tables: dict[str, DataFrame]) -> DataFrame:
    """Means and deviations of each metric in several datasets."""
    return _side_by_side(tables, ["metric"], ["mean_0", "mean_1", "std_0", "std_1"])


def compare_categories(tables: dict[str, DataFrame]) -> DataFrame:
    """Churn rate of each category in several datasets, one digit."""
    wide = _side_by_side(tables, ["feature", "category"], ["churn_rate"])
    return wide.select("feature", "category", *[F.round(f"churn_rate_{d}", 1).alias(f"churn_rate_{d}") for d in tables])


def metric_curves(metrics: DataFrame, models: list[str], by: str = "num_best_features") -> DataFrame:
    """Mean F1 and training time by number of features (or seed), one column per model."""
    cells = [
        F.avg(F.when(F.col("model") == m, F.col(v))).alias(f"{v}_{m}")
        for v in ("f1_score", "training_time")
        for m in models
    ]
    return metrics.groupBy(by).agg(*cells).orderBy(by)


def time_per_param(metrics: DataFrame) -> DataFrame:
    """Training time divided by the number of parameter combinations."""
    return metrics.withColumn("training_time", F.col("training_time") / F.col("num_params"))


def best_model(metrics: DataFrame) -> DataFrame:
    ranked = metrics.orderBy(F.desc("f1_score"), "model", "num_best_features")
    return ranked.select("model", "best_params", "num_best_features", "f1_score").limit(1)


def cumulative_importance(importance: DataFrame) -> DataFrame:
    """Running total of importances, largest first; one row per feature of a model."""
    from pyspark.sql import Window

    running = Window.orderBy(F.desc("coefficient"), "feature").rowsBetween(Window.unboundedPreceding, 0)
    return importance.withColumn("cumulative_coefficient", F.sum("coefficient").over(running))
