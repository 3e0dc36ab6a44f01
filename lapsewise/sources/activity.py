"""The star-schema ``events`` table seen as an activity log."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise.operators.skew import join_on_skewed_key
from lapsewise.schema import EVENT_SCHEMA

# Fixed values of the event mapping.
AGENTS = [
    "Mozilla/5.0 (Windows NT 6.1; WOW64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/36.0 Safari/537.36",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10.9; rv:31.0) Gecko/20100101 Firefox/31.0",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 7_1 like Mac OS X) AppleWebKit/537.51 (KHTML, like Gecko) Safari/9537.53",
    "Mozilla/5.0 (compatible; MSIE 9.0; Windows NT 6.1; Trident/5.0)",
]
FIRST_REGISTRATION_MS = 1703980800000
PROFILE_COLUMNS = ["firstName", "lastName", "location"]


def activity_log(spark: SparkSession, sf_dir: str, profile: bool = True) -> DataFrame:
    """One row per event, in the log schema.

    ``profile=False`` leaves out the names and the location. Those three columns are the only ones
    that need the customer join, so the queries that do not use them are a scan of ``events`` alone.
    """
    # k feeds five columns: parsed once, in a projection of its own.
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn(
        "k", F.get_json_object("props", "$.k").cast("int")
    )
    kind, value, k = F.col("event_type"), F.col("value"), F.col("k")
    anonymous = F.col("event_id") % 50 == 0
    identified = lambda column: F.when(~anonymous, column)
    on_view = lambda column: F.when(kind == "view", column)

    page = (
        F.when((kind == "purchase") & (value > 200), "Cancellation Confirmation")
        .when(kind == "purchase", "Add to Playlist")
        .when(kind == "view", "NextSong")
        .when(kind == "click", "Thumbs Up")
        .when(kind == "error", "Error")
        .when((kind == "signup") & (k < 10), "Submit Downgrade")
        .otherwise("Home")
    )
    agent = F.element_at(F.array(*[F.lit(a) for a in AGENTS]), k % 4 + 1)
    log = events.select(
        F.col("user_id"),
        F.when(anonymous, "").otherwise(F.col("user_id").cast("string")).alias("userId"),
        F.dayofmonth("ts").cast("long").alias("sessionId"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
        identified(F.lit(FIRST_REGISTRATION_MS) - (F.col("user_id") % 60) * 86400000).alias("registration"),
        page.alias("page"),
        F.when(anonymous, "Logged Out")
        .when(page == "Cancellation Confirmation", "Cancelled")
        .otherwise("Logged In")
        .alias("auth"),
        F.when(kind == "view", "PUT").otherwise("GET").alias("method"),
        F.when(kind == "error", 404).when(kind == "click", 307).otherwise(200).alias("status"),
        F.when(k >= 50, "paid").otherwise("free").alias("level"),
        identified(F.when(F.col("user_id") % 2 == 0, "M").otherwise("F")).alias("gender"),
        identified(agent).alias("userAgent"),
        on_view(F.concat(F.lit("artist_"), k % 20)).alias("artist"),
        on_view(F.concat(F.lit("song_"), k)).alias("song"),
        on_view(value + 100).alias("length"),
    )
    if not profile:
        return log.drop("user_id")

    # nation and region hold one row per country and per continent.
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    places = nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"),
        F.concat_ws(", ", "n_name", "r_name").alias("place"),
    )
    customers = (
        spark.read.parquet(f"{sf_dir}/customer.parquet")
        .join(F.broadcast(places), "c_nationkey")
        .select(F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment", "place")
    )
    named = F.col("userId") != ""
    # Events of a user without a customer row stay, without names and location.
    joined = join_on_skewed_key(log, customers, "user_id", spread_by=["ts", "page"], how="left")
    return joined.select(
        *[c for c in log.columns if c != "user_id"],
        F.when(named, F.col("c_name")).alias("firstName"),
        F.when(named, F.col("c_mktsegment")).alias("lastName"),
        F.when(named, F.col("place")).alias("location"),
    ).select(*EVENT_SCHEMA.names)
