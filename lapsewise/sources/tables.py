"""File scans and sinks. Paths may point to any store Spark can reach (``s3a://``, ``hdfs://``, ...)."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lapsewise.schema import EVENT_SCHEMA


_UNREADABLE = "_unreadable"


def _json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All lines; one that is no record of the schema has its text in ``_unreadable``."""
    with_text = StructType([*schema.fields, StructField(_UNREADABLE, StringType())])
    record = F.from_json("value", with_text, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _UNREADABLE})
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.input_file_name().alias("_file"), record.alias("_record")).select("_file", "_record.*")


def read_json_log(
    spark: SparkSession, path: str, schema: StructType = EVENT_SCHEMA, unreadable: str = "drop"
) -> DataFrame:
    """JSON-lines log with a declared schema, so no inference pass over the input.

    Lines that are no record of the schema are left out (``drop``, see ``unreadable_lines``) or end the read (``fail``).
    """
    if unreadable == "fail":
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if unreadable != "drop":
        raise ValueError(f"unknown treatment of unreadable lines: {unreadable}")
    return _json_lines(spark, path, schema).where(F.col(_UNREADABLE).isNull()).select(*schema.names)


def unreadable_lines(spark: SparkSession, path: str, schema: StructType = EVENT_SCHEMA) -> DataFrame:
    """(file, line) of every line of a JSON log that ``read_json_log`` leaves out."""
    lines = _json_lines(spark, path, schema).where(F.col(_UNREADABLE).isNotNull())
    return lines.select(F.col("_file").alias("file"), F.col(_UNREADABLE).alias("line"))


def read_parquet_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True, enforceSchema=False)


def write_json_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_parquet_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """``partition_by`` makes one folder per value. Rows are brought together by value first, so that
    not every task writes a file into every folder; AQE splits values that are too large for a task."""
    if partition_by:
        df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def write_csv_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_feature_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None
) -> DataFrame:
    """Feature table with ``userId`` and ``churn`` moved to the front."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    table = reader.load(path)
    rest = [c for c in table.columns if c not in ("userId", "churn")]
    return table.select("userId", "churn", *rest)
