"""Churn and downgrade labels."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsewise.operators.skew import join_on_skewed_key
from lapsewise.schema import CHURN_PAGE, DOWNGRADE_PAGE
from lapsewise.storage import write_and_reload


def page_flag(page: str) -> Column:
    """1 on events of ``page``, else 0."""
    return F.when(F.col("page") == page, 1).otherwise(0)


def churn_labels(log: DataFrame) -> DataFrame:
    """One row per user; churn is 1 if the user ever confirmed a cancellation."""
    return log.groupBy("userId").agg(F.max(page_flag(CHURN_PAGE)).alias("churn"))


def page_users(log: DataFrame, page: str) -> DataFrame:
    return log.where(F.col("page") == page).select("userId").distinct()


def churned_users(log: DataFrame) -> DataFrame:
    return page_users(log, CHURN_PAGE)


def downgraded_users(log: DataFrame) -> DataFrame:
    return page_users(log, DOWNGRADE_PAGE)


def cancelled_and_downgraded(log: DataFrame) -> DataFrame:
    return downgraded_users(log).intersect(churned_users(log))


def user_flags(log: DataFrame) -> DataFrame:
    """Rows, churn and number of downgrades per user."""
    return log.groupBy("userId").agg(
        F.count("*").alias("n_logs"),
        F.max(page_flag(CHURN_PAGE)).alias("churn"),
        F.sum(page_flag(DOWNGRADE_PAGE)).alias("downgrade_count"),
    )


def churn_flagged_log(log: DataFrame) -> DataFrame:
    """The log with event flags and, on every row, the user's churn and downgrade count.

    A window over the user would bring all events of a user to one task and sort them. The flags
    need one value per user, so they are aggregated (combined before the shuffle), written, and joined back
    with the busiest users split up. The log is read twice: for the flags and for the rows.
    """
    flags = write_and_reload(user_flags(log), "flags")
    sizes = flags.select("userId", F.col("n_logs").alias("n"))
    spread_by = [c for c in ("ts", "page", "sessionId") if c in log.columns]
    return join_on_skewed_key(log, flags.drop("n_logs"), "userId", spread_by, sizes).withColumns(
        {"churn_event": page_flag(CHURN_PAGE), "downgrade_event": page_flag(DOWNGRADE_PAGE)}
    )


def mark_churn(per_user: DataFrame, log: DataFrame) -> DataFrame:
    """Add ``churn`` to a table that is already reduced to few rows per user.

    The right side is only the users with a cancellation event, read with the page filter pushed
    into the scan.
    """
    churned = churned_users(log).withColumn("_churned", F.lit(1))
    return (
        per_user.join(churned, "userId", "left")
        .withColumn("churn", F.coalesce("_churned", F.lit(0)))
        .drop("_churned")
    )


def downgrade_logs(log: DataFrame) -> DataFrame:
    """Log rows by churn and downgrade count."""
    return user_flags(log).groupBy("churn", "downgrade_count").agg(F.sum("n_logs").alias("n_logs"))


def downgrade_users(log: DataFrame) -> DataFrame:
    """Users by churn and downgrade count."""
    return user_flags(log).groupBy("churn", "downgrade_count").agg(F.count("*").alias("n_users"))


def churn_summary(log: DataFrame) -> DataFrame:
    """Users, cancelled, downgraded, both, and the churn rate in percent."""
    downgraded = F.col("downgrade_count") > 0
    return (
        user_flags(log)
        .agg(
            F.count("*").alias("n_users"),
            F.count_if(F.col("churn") == 1).alias("n_cancelled"),
            F.count_if(downgraded).alias("n_downgraded"),
            F.count_if(downgraded & (F.col("churn") == 1)).alias("n_both"),
        )
        .withColumn("churn_rate", F.round(F.try_divide(100.0 * F.col("n_cancelled"), F.col("n_users")), 1))
    )
