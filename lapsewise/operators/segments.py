"""Logs, users and churn rate per category of one or more attributes.

All reports work on the long form (feature, category): one scan serves every attribute, and counts
are combined before the shuffle, so neither a busy user nor a dominant category makes a large task.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapsewise.operators.labels import mark_churn


def categories_long(log: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """One row per event and feature: ``keep`` columns, feature, category as text."""
    texts = [F.col(c).cast("string").alias(c) for c in features]
    return log.select(*keep, *texts).unpivot(keep, features, "feature", "category")


def log_counts(log: DataFrame, features: list[str]) -> DataFrame:
    """Events per category, largest first."""
    long = categories_long(log, features, [])
    counts = long.groupBy("feature", "category").agg(F.count("*").alias("n_logs"))
    return counts.orderBy("feature", F.desc("n_logs"), "category")


def user_counts(log: DataFrame, features: list[str]) -> DataFrame:
    """Distinct users per category, largest first."""
    long = categories_long(log, features, ["userId"])
    counts = long.groupBy("feature", "category").agg(F.count_distinct("userId").alias("n_users"))
    return counts.orderBy("feature", F.desc("n_users"), "category")


def churn_rates(log: DataFrame, features: list[str]) -> DataFrame:
    """Users with and without churn and the churn rate in percent, per feature and category.

    A user counts once in every category ever seen. Rows without a category are left out.
    """
    pairs = (
        categories_long(log, features, ["userId"])
        .where(F.col("category").isNotNull())
        .groupBy("userId", "feature", "category")
        .agg(F.count("*").alias("n"))
    )
    per_category = (
        mark_churn(pairs, log)
        .groupBy("feature", "category")
        .agg(
            F.count_if(F.col("churn") == 0).alias("non_churners"),
            F.count_if(F.col("churn") == 1).alias("churners"),
        )
    )
    rate = 100.0 * F.col("churners") / (F.col("churners") + F.col("non_churners"))
    return per_category.withColumn("churn_rate", rate)


def churn_rate(log: DataFrame, feature: str, sort_by_users: bool = True) -> DataFrame:
    """Churn rate per category of one feature, most non-churners first or in category order."""
    rates = churn_rates(log, [feature]).drop("feature")
    order = [F.desc("non_churners"), "category"] if sort_by_users else ["category"]
    return rates.orderBy(*order)


def churn_log_counts(log: DataFrame, features: list[str]) -> DataFrame:
    """Events per feature, category and churn group."""
    per_user = (
        categories_long(log, features, ["userId"])
        .groupBy("userId", "feature", "category")
        .agg(F.count("*").alias("n"))
    )
    return (
        mark_churn(per_user, log)
        .groupBy("feature", "category", "churn")
        .agg(F.sum("n").alias("n_logs"))
        .orderBy("feature", "churn", "category")
    )


def page_mix(log: DataFrame, digits: int | None = None) -> DataFrame:
    """Share of each page in all page views of churners and of others, and the difference.

    Pages that only one of the groups has seen are left out before the shares are taken.
    ``digits`` rounds the churners' share.
    """
    per_user = log.groupBy("userId", "page").agg(F.count("*").alias("n"))
    counts = (
        mark_churn(per_user, log)
        .groupBy("page")
        .agg(
            F.sum(F.when(F.col("churn") == 1, F.col("n")).otherwise(0)).alias("count_churners"),
            F.sum(F.when(F.col("churn") == 0, F.col("n")).otherwise(0)).alias("count_non_churners"),
        )
        .where("count_churners > 0 and count_non_churners > 0")
    )
    # One row per page by now, so a window over all of them is small.
    all_pages = Window.partitionBy()
    share_1 = 100.0 * F.col("count_churners") / F.sum("count_churners").over(all_pages)
    share_0 = 100.0 * F.col("count_non_churners") / F.sum("count_non_churners").over(all_pages)
    if digits is not None:
        share_1 = F.round(share_1, digits)
    return (
        counts.withColumns({"ratio_churners": share_1, "ratio_non_churners": share_0})
        .withColumn("delta", F.col("ratio_churners") - F.col("ratio_non_churners"))
        .orderBy(F.desc("count_churners"), "page")
    )
