"""Profiling and data-quality tables. Each is one pass over the log."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.schema import USER_ATTRIBUTES


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def _one_row_to_long(row: DataFrame, columns: list[str], value: str) -> DataFrame:
    """One row of per-column results to one row per column."""
    return row.unpivot([], columns, "column_name", value)


def schema_table(df: DataFrame) -> DataFrame:
    """Name, type and nullability of every column, with how many rows have a value."""
    types = F.create_map(*[F.lit(x) for f in df.schema for x in (f.name, f.dataType.simpleString())])
    nullable = F.create_map(*[F.lit(x) for f in df.schema for x in (f.name, f.nullable)])
    filled = df.agg(*[F.count(c).alias(c) for c in df.columns])
    return _one_row_to_long(filled, df.columns, "n_filled").select(
        "column_name",
        types[F.col("column_name")].alias("data_type"),
        nullable[F.col("column_name")].alias("nullable"),
        "n_filled",
    )


def duplicate_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Groups of equal rows (or equal in ``columns``) and their size."""
    keys = columns or df.columns
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def missing_values(df: DataFrame) -> DataFrame:
    """Missing values per column, most first."""
    missing = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return _one_row_to_long(missing, df.columns, "n_missing").orderBy(F.desc("n_missing"), "column_name")


def null_attribute_users(df: DataFrame, attributes: list[str] = USER_ATTRIBUTES) -> DataFrame:
    """Keys of rows where every user attribute is missing."""
    all_null = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in attributes])
    return df.where(all_null).select("userId").distinct()


def auth_by_anonymity(df: DataFrame) -> DataFrame:
    anonymous = (F.col("userId") == "").alias("anonymous")
    return df.where(F.col("userId").isNotNull()).groupBy(anonymous, "auth").agg(F.count("*").alias("n_logs"))


_MEDIA = ["artist", "song", "length"]


def pages_without_media(df: DataFrame) -> DataFrame:
    """Pages with a row that lacks artist, song or length."""
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in _MEDIA])).select("page").distinct()


def pages_with_media(df: DataFrame) -> DataFrame:
    """Pages with a row that has all of artist, song and length."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in _MEDIA])).select("page").distinct()


def range_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, min and max of each column, as text so that all column types fit one table."""
    parts = df.agg(
        *[
            F.struct(
                F.count(c).alias("n"),
                F.min(c).cast("string").alias("min_value"),
                F.max(c).cast("string").alias("max_value"),
            ).alias(c)
            for c in columns
        ]
    )
    return _one_row_to_long(parts, columns, "s").select("column_name", "s.n", "s.min_value", "s.max_value")


def activity_totals(df: DataFrame) -> DataFrame:
    """Users, session numbers, rows and rows per user."""
    return df.agg(
        F.count_distinct("userId").alias("n_users"),
        F.count_distinct("sessionId").alias("n_sessions"),
        F.count("*").alias("n_logs"),
    ).withColumn("logs_per_user", F.try_divide(F.col("n_logs").cast("double"), F.col("n_users")))


def sample_column(df: DataFrame, column: str, n: int, seed: int, keys: list[str]) -> DataFrame:
    """Values of one column in ``n`` random rows: those with the smallest hash of seed and ``keys``.

    The choice depends on the rows alone, not on partitions or retries, and each task hands on at most ``n``.
    """
    told = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    drawn = F.md5(F.concat_ws("|", F.lit(str(seed)), *told).cast("binary"))
    return df.select(column, drawn.alias("_drawn")).orderBy("_drawn", column).limit(n).select(column)


def preview(df: DataFrame, order_by: list[str], n: int) -> DataFrame:
    """First rows in a stated order: a top-n, not a full sort."""
    return df.orderBy(*order_by).limit(n)
