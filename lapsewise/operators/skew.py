"""Joining a log to one row per key when a few keys hold much of the log."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Parts of a hot key are a quarter of a partition each: parts that meet in one partition by chance
# then do little harm.
PARTS_PER_PARTITION = 4


def hot_keys(sizes: DataFrame, key: str, rows: str = "n") -> DataFrame:
    """Keys too large for one shuffle partition, and into how many parts to split each.

    With P shuffle partitions, a key is hot when it holds more than 1/P of all rows, and it gets
    PARTS_PER_PARTITION parts for every 1/P it holds. So there are fewer than P hot keys and fewer
    than 5 P parts, whatever the size of the data.
    """
    partitions = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = sizes.agg(F.sum(rows)).scalar()
    parts = F.ceil(F.col(rows) * PARTS_PER_PARTITION * partitions / total).cast("int")
    return sizes.where(F.col(rows) * partitions > total).select(key, parts.alias("_parts"))


def join_on_skewed_key(
    log: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: list[str],
    sizes: DataFrame | None = None,
    how: str = "inner",
) -> DataFrame:
    """Equi-join of a log with a table of unique keys, hot keys split over several tasks.

    Rows of a hot key get a salt from a hash of ``spread_by`` and meet a copy of their lookup row
    for each salt; all other rows keep salt 0. The hash makes a re-run task send its rows to the
    same places. Only the list of hot keys is broadcast.
    ``sizes`` (key, n) saves the counting pass when the caller has it. ``how`` is inner or left;
    in a left join rows without a key, which match nothing, are spread as well.
    """
    if sizes is None:
        sizes = log.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    hot = F.broadcast(hot_keys(sizes, key))
    row_hash = F.xxhash64(*spread_by)
    salt = (
        F.when(F.col(key).isNull(), row_hash)
        .when(F.col("_parts").isNotNull(), F.pmod(row_hash, F.col("_parts")))
        .otherwise(0)
    )
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
    salted_log = log.join(hot, key, "left").withColumn("_salt", salt).drop("_parts")
    salted_lookup = lookup.join(hot, key, "left").withColumn("_salt", F.explode(copies)).drop("_parts")
    return salted_log.join(
        salted_lookup.withColumn("_salt", F.col("_salt").cast("long")), [key, "_salt"], how
    ).drop("_salt")
