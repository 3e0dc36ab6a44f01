"""Written tables in the cluster's shared folder.

Tables that several later jobs read (the feature table, the metric table) are written once and
read back, so a lost executor costs a re-read and not a recomputation of the whole log.
"""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="lapsewise-")
    return _local_roots[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/lapsewise/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` from Spark's checkpoint in the shared folder: for small tables that very many short jobs read."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_root(df.sparkSession)}/lapsewise/checkpoints")
    return df.checkpoint()


def write_bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """Like ``write_and_reload``, dealt by ``key`` as a join on it asks, so that such a join does not move the rows again."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.mode("overwrite").bucketBy(buckets, key).option("path", path).saveAsTable(table)
    return spark.table(table)


def write_and_reload(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage of ``df`` through a Parquet table in the shared folder."""
    path = new_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
