"""The feature table: one row per user, built from two passes over the cleaned log.

Pass one reduces the log to one row per session and then per user. Every feature but the distinct
counts is a sum, a count, a minimum or a maximum, so all of them ride on that one aggregation.
Pass two counts distinct artists and songs among the plays. Both end hashed by user, so the join
that puts them together moves nothing.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise import functions as L
from lapsewise.operators import categories as C
from lapsewise.operators.categories import Category
from lapsewise.operators.cleaning import clean
from lapsewise.operators.labels import page_flag
from lapsewise.operators.numeric import distinct_media
from lapsewise.operators.sessions import average_minutes, pause_between_sessions, total_hours
from lapsewise.operators.usage import share, usage_table
from lapsewise.schema import (
    BROWSERS,
    CHURN_PAGE,
    DEVICES,
    FEATURES,
    PAGE_RATE_FEATURES,
    PAGES,
    RATED_PAGES,
    UNRATED_PAGES,
    page_slug,
)
from lapsewise.sources.tables import read_feature_table, write_json_table, write_parquet_table

Categories = dict[str, Category]
#: Columns of the listed values alone, whatever the log holds.
LISTED: Categories = {
    "device": C.listed(DEVICES), "browser": C.listed(BROWSERS), "page": C.listed(RATED_PAGES, page_slug),
}


def find_categories(log: DataFrame, most: int | None = None) -> Categories:
    """Devices, browsers and rated pages that become columns: the listed ones and those that the log holds beside them."""
    page = F.when(~F.col("page").isin(UNRATED_PAGES), F.col("page"))
    sources = {
        "device": (L.device(F.col("userAgent")), DEVICES, str),
        "browser": (L.browser(F.col("userAgent")), BROWSERS, str),
        "page": (page, RATED_PAGES, page_slug),
    }
    return C.find(log, sources, taken=["userId", "churn", *_NOT_CATEGORIES], most=most)


_NOT_CATEGORIES = [c for c in FEATURES if c not in {*DEVICES, *BROWSERS, *PAGE_RATE_FEATURES}]


def feature_names(categories: Categories) -> list[str]:
    """Features in the order of the table: found values after the listed ones of their kind."""
    device, browser, page = (categories[c].names for c in ("device", "browser", "page"))
    head = [c for c in _NOT_CATEGORIES if c in ("gender", "level")]
    tail = [c for c in _NOT_CATEGORIES if c == "session_interval"]
    middle = [c for c in _NOT_CATEGORIES if c not in (*head, *tail)]
    return [*head, *device, *browser, *middle, *[f"{c}_hourly" for c in page], *tail]


def table_features(table: DataFrame) -> list[str]:
    """Features of a written feature table."""
    return [c for c in table.columns if c not in ("userId", "churn")]


def _code(column: str, first: str, second: str) -> Column:
    """1 for ``first``, 2 for ``second``, 0 for anything else."""
    return F.when(F.col(column) == first, 1).when(F.col(column) == second, 2).otherwise(0)


def latest_profile() -> Column:
    """Gender and level of a user's last event, as one number that a plain max can find.

    The event time leads, then level, then gender, so events at the same time always give the same
    answer. A max over a struct would make Spark sort the log by user before the first shuffle.
    """
    return F.max(F.col("ts") * 16 + _code("level", "free", "paid") * 4 + _code("gender", "M", "F"))


def profile_gender(profile: str) -> Column:
    """M is 0, F is 1, anything else null."""
    code = F.pmod(F.col(profile), F.lit(4)).cast("int")
    return F.when(code > 0, code - 1)


def profile_level(profile: str) -> Column:
    """free is 0, paid is 1, anything else null."""
    code = F.pmod(F.floor(F.col(profile) / 4), F.lit(4)).cast("int")
    return F.when(code > 0, code - 1)


def user_info(log: DataFrame) -> DataFrame:
    return log.groupBy("userId").agg(latest_profile().alias("p")).select(
        "userId", profile_gender("p").alias("gender"), profile_level("p").alias("level")
    )


def _usage(log: DataFrame, values: list[str] | None, category: str, column: Column, known: list[str], **options) -> DataFrame:
    name = options.get("name", str)
    found = C.find(log, {category: (column, known, name)})[category] if values is None else values
    return usage_table(log, column, found, **options)


def device_usage(log: DataFrame, values: list[str] | None = None) -> DataFrame:
    """Share of each device; without ``values`` the listed ones and those that the log holds beside them."""
    return _usage(log, values, "device", L.device(F.col("userAgent")), DEVICES)


def browser_usage(log: DataFrame, values: list[str] | None = None) -> DataFrame:
    return _usage(log, values, "browser", L.browser(F.col("userAgent")), BROWSERS)


def page_counts(log: DataFrame, values: list[str] | None = None) -> DataFrame:
    """Views per rated page, for users with any page outside the unrated ones."""
    rated = log.where(~F.col("page").isin(UNRATED_PAGES))
    return _usage(rated, values, "page", F.col("page"), RATED_PAGES, kind="count", name=page_slug)


def page_pivot(log: DataFrame, values: list[str] | None = None) -> DataFrame:
    """Views per page, all pages; without ``values`` the listed ones and those that the log holds beside them."""
    return _usage(log, values, "page", F.col("page"), PAGES, kind="count", name=page_slug)


def _session_sums(log: DataFrame, categories: Categories) -> DataFrame:
    agents = log.select(
        "userId", "sessionId", "ts", "registration", "page", "level", "gender", "song", "length",
        L.device(F.col("userAgent")).alias("device"),
        L.browser(F.col("userAgent")).alias("browser"),
    )
    return agents.groupBy("userId", "sessionId").agg(
        F.max(page_flag(CHURN_PAGE)).alias("churn"),
        latest_profile().alias("profile"),
        F.min("ts").alias("start_ts"),
        F.max("ts").alias("end_ts"),
        F.max("registration").alias("registration"),
        F.count("*").alias("n_logs"),
        F.count("song").alias("n_songs"),
        F.sum("length").alias("sum_length"),
        *categories["device"].counts(F.col("device")),
        *categories["browser"].counts(F.col("browser")),
        *categories["page"].counts(_rated_page()),
        F.count_if(~F.col("page").isin(UNRATED_PAGES)).alias("n_rated"),
    )


def _rated_page() -> Column:
    return F.when(~F.col("page").isin(UNRATED_PAGES), F.col("page"))


def _user_sums(sessions: DataFrame, categories: Categories) -> DataFrame:
    return sessions.groupBy("userId").agg(
        F.max("churn").alias("churn"),
        F.max("profile").alias("profile"),
        F.sum("n_logs").alias("count_logs"),
        F.count("sessionId").alias("count_sessions"),
        F.sum("n_songs").alias("count_songs"),
        (F.sum("sum_length") / 60000.0).alias("sum_length_minutes"),
        ((F.max("end_ts") - F.max("registration")) / F.lit(float(L.MS_PER_DAY))).alias("days_since_registration"),
        F.avg("n_songs").alias("avg_songs_per_session"),
        average_minutes().alias("avg_session_length"),
        total_hours().alias("total_hours"),
        pause_between_sessions(L.MS_PER_MINUTE).alias("session_interval"),
        *[F.sum(c).alias(c) for category in categories.values() for c in category.names],
        F.sum("n_rated").alias("n_rated"),
    )


def _hourly(slug: str) -> Column:
    """Views per hour online; 0 for users whose sessions have no length."""
    return share(slug, "total_hours").alias(slug + "_hourly")


def overall_stats(log: DataFrame) -> DataFrame:
    """The seven whole-history features."""
    sums = log.groupBy("userId").agg(
        F.count("*").alias("count_logs"),
        F.count_distinct("sessionId").alias("count_sessions"),
        F.count("song").alias("count_songs"),
        (F.sum("length") / 60000.0).alias("sum_length_minutes"),
        ((F.max("ts") - F.max("registration")) / F.lit(float(L.MS_PER_DAY))).alias("days_since_registration"),
    )
    distinct = F.coalesce("count_distinct_artists", F.lit(0)), F.coalesce("count_distinct_songs", F.lit(0))
    return sums.join(distinct_media(log), "userId", "left").select(
        "userId",
        "count_logs",
        "count_sessions",
        distinct[0].alias("count_distinct_artists"),
        "count_songs",
        distinct[1].alias("count_distinct_songs"),
        "sum_length_minutes",
        "days_since_registration",
    )


def page_rates_hourly(log: DataFrame, categories: Categories | None = None) -> DataFrame:
    """Views per hour of each rated page, for users with any page outside the unrated ones."""
    pages = (categories or find_categories(log))["page"]
    sessions = log.groupBy("userId", "sessionId").agg(
        F.min("ts").alias("start_ts"),
        F.max("ts").alias("end_ts"),
        *pages.counts(_rated_page()),
        F.count_if(~F.col("page").isin(UNRATED_PAGES)).alias("n_rated"),
    )
    users = sessions.groupBy("userId").agg(
        total_hours().alias("total_hours"),
        *[F.sum(c).alias(c) for c in [*pages.names, "n_rated"]],
    )
    return users.where("n_rated > 0").select("userId", *[_hourly(c) for c in pages.names])


def feature_table(log: DataFrame, join: str = "left", categories: Categories | None = None) -> DataFrame:
    """userId, churn and the features, nulls filled with 0.

    The devices, browsers and pages that become columns are ``categories``; without it they are found in a pass over
    two columns of the log. ``left`` keeps every user of the log, which is what a full outer join of the single
    feature tables gives. ``inner`` drops users who only ever saw unrated pages.
    """
    categories = categories or find_categories(log)
    users = _user_sums(_session_sums(log, categories), categories)
    if join == "inner":
        users = users.where("n_rated > 0")
    elif join != "left":
        raise ValueError(f"unknown join: {join}")
    computed = {
        "gender": profile_gender("profile"),
        "level": profile_level("profile"),
        "count_distinct_artists": F.col("count_distinct_artists"),
        "count_distinct_songs": F.col("count_distinct_songs"),
        **{c: share(c, "count_logs") for c in [*categories["device"].names, *categories["browser"].names]},
        **{c + "_hourly": _hourly(c) for c in categories["page"].names},
    }
    columns = [computed.get(c, F.col(c)).alias(c) for c in feature_names(categories)]
    return users.join(distinct_media(log), "userId", "left").select("userId", "churn", *columns).fillna(0)


def create_features(log: DataFrame, path: str, policy: str = "identified", fmt: str = "parquet") -> None:
    """Clean a raw log, build the feature table and write it, its categories beside it in ``path``-categories."""
    cleaned = clean(log, policy)
    categories = find_categories(cleaned)
    table = feature_table(cleaned, categories=categories)
    if fmt == "parquet":
        write_parquet_table(table, path)
    elif fmt == "json":
        write_json_table(table, path)
    else:
        raise ValueError(f"unknown format: {fmt}")
    write_parquet_table(C.to_table(log.sparkSession, categories), f"{path}-categories")


def load_categories(spark: SparkSession, path: str) -> Categories:
    """Categories of a written feature table, to give later logs the same columns."""
    return C.from_table(spark.read.parquet(f"{path}-categories"))


def load_features(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_feature_table(spark, path, fmt)
