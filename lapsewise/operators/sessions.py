"""Session and per-user activity tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsewise import functions as L
from lapsewise.operators.labels import page_flag
from lapsewise.schema import CHURN_PAGE


def session_table(log: DataFrame) -> DataFrame:
    """One row per user and session number."""
    return log.groupBy("userId", "sessionId").agg(
        F.min("ts").alias("start_ts"),
        F.max("ts").alias("end_ts"),
        F.count("*").alias("n_logs"),
        F.count("song").alias("n_songs"),
        F.max(page_flag(CHURN_PAGE)).alias("churn"),
    )


def interactions_per_user(log: DataFrame) -> DataFrame:
    return log.groupBy("userId").agg(F.count("*").alias("n_logs"))


def sessions_per_user(log: DataFrame) -> DataFrame:
    return session_table(log).groupBy("userId").agg(F.count("*").alias("n_sessions"))


def session_duration(log: DataFrame) -> DataFrame:
    """Minutes between first and last event of each session."""
    return session_table(log).select("userId", "sessionId", minutes_per_session().alias("duration"))


# Times are summed as whole milliseconds and divided once, so totals do not depend on the order in
# which tasks finish.


def ms_per_session() -> Column:
    return F.col("end_ts") - F.col("start_ts")


def minutes_per_session() -> Column:
    return ms_per_session() / F.lit(float(L.MS_PER_MINUTE))


def average_minutes() -> Column:
    """Mean session length, from per-session rows of one user."""
    return F.avg(ms_per_session()) / F.lit(float(L.MS_PER_MINUTE))


def total_hours() -> Column:
    """Time in all sessions, from per-session rows of one user."""
    return F.sum(ms_per_session()) / F.lit(float(L.MS_PER_HOUR))


def pause_between_sessions(unit_ms: int) -> Column:
    """Average gap between sessions, from per-session rows of one user: the observed time outside
    sessions over the number of gaps. Null for users with one session."""
    sessions = F.count("*")
    outside = F.max("end_ts") - F.min("start_ts") - F.sum(ms_per_session())
    return F.when(sessions > 1, outside / F.lit(float(unit_ms)) / (sessions - 1))


def session_stats(log: DataFrame) -> DataFrame:
    """Songs and minutes per session and hours in total, per user."""
    return (
        session_table(log)
        .groupBy("userId")
        .agg(
            F.avg("n_songs").alias("avg_songs_per_session"),
            average_minutes().alias("avg_session_length"),
            total_hours().alias("total_hours"),
        )
        .fillna(0)
    )


def session_interval(log: DataFrame) -> DataFrame:
    """Minutes between sessions; 0 for users with a single session."""
    pause = F.coalesce(pause_between_sessions(L.MS_PER_MINUTE), F.lit(0.0))
    return session_table(log).groupBy("userId").agg(pause.alias("session_interval"))
