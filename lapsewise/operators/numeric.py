"""Per-user activity metrics compared between churners and others."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapsewise import functions as L
from lapsewise.operators.labels import churn_flagged_log, page_flag
from lapsewise.operators.quantiles import exact_quantiles
from lapsewise.operators.sessions import (
    average_minutes,
    minutes_per_session,
    pause_between_sessions,
    session_table,
)
from lapsewise.schema import BOXED_PAGES, CHURN_PAGE, page_slug
from lapsewise.storage import write_and_reload

METRICS = [
    "num_sessions",
    "session_interval_hours",
    "avg_session_length",
    "count_songs",
    "count_unique_artists",
    "count_unique_songs",
    "max_days_since_registration",
]


def _churn() -> Column:
    return F.max(page_flag(CHURN_PAGE)).alias("churn")


def _distinct_with_null(column: str) -> Column:
    """Distinct values where a missing value counts as one more."""
    return F.count_distinct(column) + F.max(F.col(column).isNull().cast("int"))


def num_sessions(log: DataFrame) -> DataFrame:
    return session_table(log).groupBy("userId").agg(
        F.max("churn").alias("churn"), F.count("*").alias("num_sessions")
    )


def unique_songs(log: DataFrame) -> DataFrame:
    return log.groupBy("userId").agg(_churn(), _distinct_with_null("song").alias("count_unique_songs"))


def unique_artists(log: DataFrame) -> DataFrame:
    return log.groupBy("userId").agg(_churn(), _distinct_with_null("artist").alias("count_unique_artists"))


def count_songs(log: DataFrame) -> DataFrame:
    """All log rows of a user: the exploratory count does not look at the song column."""
    return log.groupBy("userId").agg(_churn(), F.count("*").alias("count_songs"))


def _account_age() -> Column:
    return F.max(L.whole_days_between(F.col("registration"), F.col("ts")))


def days_since_registration(log: DataFrame) -> DataFrame:
    return log.groupBy("userId").agg(_churn(), _account_age().alias("max_days_since_registration"))


def avg_session_length(log: DataFrame) -> DataFrame:
    return session_table(log).groupBy("userId").agg(
        F.max("churn").alias("churn"), average_minutes().alias("avg_session_length")
    )


def session_interval_hours(log: DataFrame) -> DataFrame:
    """Whole hours between sessions, for users with more than one."""
    pause = pause_between_sessions(L.MS_PER_HOUR).cast("int")
    per_user = session_table(log).groupBy("userId").agg(
        F.max("churn").alias("churn"), pause.alias("session_interval_hours")
    )
    return per_user.where(F.col("session_interval_hours").isNotNull())


def user_metrics(log: DataFrame) -> DataFrame:
    """All of METRICS per user, from two passes: sessions, and distinct songs and artists."""
    by_session = log.groupBy("userId", "sessionId").agg(
        F.min("ts").alias("start_ts"),
        F.max("ts").alias("end_ts"),
        F.count("*").alias("n_logs"),
        F.max(page_flag(CHURN_PAGE)).alias("churn"),
        _account_age().alias("age"),
        F.max(F.col("song").isNull().cast("int")).alias("no_song"),
        F.max(F.col("artist").isNull().cast("int")).alias("no_artist"),
    )
    by_user = by_session.groupBy("userId").agg(
        F.max("churn").alias("churn"),
        F.count("*").alias("num_sessions"),
        pause_between_sessions(L.MS_PER_HOUR).cast("int").alias("session_interval_hours"),
        average_minutes().alias("avg_session_length"),
        F.sum("n_logs").alias("count_songs"),
        F.max("age").alias("max_days_since_registration"),
        F.max("no_song").alias("no_song"),
        F.max("no_artist").alias("no_artist"),
    )
    distinct = distinct_media(log)
    artists = F.coalesce("count_distinct_artists", F.lit(0)) + F.col("no_artist")
    songs = F.coalesce("count_distinct_songs", F.lit(0)) + F.col("no_song")
    return (
        by_user.join(distinct, "userId", "left")
        .withColumns({"count_unique_artists": artists, "count_unique_songs": songs})
        .select("userId", "churn", *METRICS)
    )


def distinct_media(log: DataFrame) -> DataFrame:
    """Distinct artists and songs of users who played any."""
    played = log.where(F.col("artist").isNotNull() | F.col("song").isNotNull())
    return played.groupBy("userId").agg(
        F.count_distinct("artist").alias("count_distinct_artists"),
        F.count_distinct("song").alias("count_distinct_songs"),
    )


def metrics_long(per_user: DataFrame, metrics: list[str]) -> DataFrame:
    """(churn, metric, value) rows without missing values."""
    values = [F.col(m).cast("double").alias(m) for m in metrics]
    long = per_user.select("churn", *values).unpivot(["churn"], metrics, "metric", "value")
    return long.where(F.col("value").isNotNull())


def summarize(long: DataFrame, by: list[str], value: str) -> DataFrame:
    """Count, mean, standard deviation, min, quartiles and max of a value per group.

    The groups (a label, a metric or page name) are few, so the joined statistics are too. The values are written
    once, as several passes read them.
    """
    return _summarize(write_and_reload(long.select(*by, value), "values"), by, value)


def _summarize(long: DataFrame, by: list[str], value: str) -> DataFrame:
    moments = long.groupBy(*by).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    quartiles = exact_quantiles(long, by, value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    return moments.join(quartiles, by)


def numeric_summary(log: DataFrame, metrics: list[str] = METRICS) -> DataFrame:
    return summarize(metrics_long(user_metrics(log), metrics), ["metric", "churn"], "value")


def length_by_churn(log: DataFrame, digits: int = 1) -> DataFrame:
    """Track length in each churn group; the sum is in hours."""
    flagged = churn_flagged_log(log.select("userId", "page", "ts", "length")).where("length is not null")
    tracks = write_and_reload(flagged.select("churn", "length"), "tracks")
    moments = tracks.groupBy("churn").agg(
        F.avg("length").alias("avg_length"),
        F.stddev_samp("length").alias("stddev_length"),
        F.max("length").alias("max_length"),
        F.min("length").alias("min_length"),
        (F.sum("length") / 3600.0).alias("sum_length"),
    )
    medians = exact_quantiles(tracks, ["churn"], "length", {"median_length": 0.5})
    joined = moments.join(medians, "churn")
    return joined.select("churn", *[F.round(c, digits).alias(c) for c in joined.columns if c != "churn"])


def activity_long(log: DataFrame) -> DataFrame:
    """(metric, value) rows: events and sessions per user, minutes per session."""
    sessions = session_table(log)
    per_user = sessions.groupBy("userId").agg(
        F.sum("n_logs").cast("double").alias("interactions"), F.count("*").cast("double").alias("sessions")
    )
    minutes = sessions.select(F.lit("session_minutes").alias("metric"), minutes_per_session().alias("value"))
    return per_user.unpivot([], ["interactions", "sessions"], "metric", "value").unionByName(minutes)


def histogram(long: DataFrame, bins: dict[str, int], by: str | None = "churn") -> DataFrame:
    """Equal-width histogram of each metric, percent within the group ``by`` if given.

    ``bins`` gives the number of bins per metric; the range of a metric spans all groups.
    """
    group = ["metric", *([by] if by else [])]
    long = write_and_reload(long.select(*group, "value"), "values")
    bin_count = F.create_map(*[F.lit(x) for pair in bins.items() for x in pair])
    ranges = long.groupBy("metric").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    placed = long.join(ranges, "metric").withColumn("n_bins", bin_count[F.col("metric")])
    width = (F.col("high") - F.col("low")) / F.col("n_bins")
    position = F.floor(F.coalesce(F.try_divide(F.col("value") - F.col("low"), width), F.lit(0.0)))
    counts = (
        placed.withColumn("bin", F.least(position, F.col("n_bins") - 1).cast("int"))
        .groupBy(*group, "bin")
        .agg(F.count("*").alias("n"))
    )
    # One row per bin.
    size = F.sum("n").over(Window.partitionBy(*group))
    return counts.withColumn("percent", 100.0 * F.col("n") / size)


def page_pivot(log: DataFrame, pages: list[str]) -> DataFrame:
    """Events per user and page, one column per page, with the user's churn."""
    counts = [F.count_if(F.col("page") == p).alias(page_slug(p)) for p in pages]
    return log.groupBy("userId").agg(_churn(), *counts)


def page_box_stats(log: DataFrame, pages: list[str] = BOXED_PAGES) -> DataFrame:
    """Box-plot numbers of the events per user, for each page and churn group."""
    columns = [page_slug(p) for p in pages]
    wide = page_pivot(log, pages).select("churn", *[F.col(c).cast("double").alias(c) for c in columns])
    return box_stats(wide.unpivot(["churn"], columns, "page", "views"), ["page", "churn"], "views")


def box_stats(long: DataFrame, by: list[str], value: str) -> DataFrame:
    """Size, quartiles, range and whiskers of a value in each of a few groups.

    Whiskers end at the last value within 1.5 quartile distances of the box.
    """
    long = write_and_reload(long.select(*by, value), "values")
    boxes = write_and_reload(_summarize(long, by, value).select(*by, "n", "min", "q1", "median", "q3", "max"), "boxes")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    limits = boxes.select(*by, (F.col("q1") - reach).alias("lo"), (F.col("q3") + reach).alias("hi"))
    whiskers = (
        long.join(limits, by)
        .where(F.col(value).between(F.col("lo"), F.col("hi")))
        .groupBy(*by)
        .agg(F.min(value).alias("whisker_low"), F.max(value).alias("whisker_high"))
    )
    return boxes.join(whiskers, by)
