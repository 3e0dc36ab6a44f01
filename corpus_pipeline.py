"""Corpus pipeline: toxic documents go, near duplicates go, secrets are masked, the mix is set, the rest is encoded.

Every stage takes all that the one before kept, written as Parquet and read again. All stages but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise.llm import bpe, catalog, common, dedup, mixing, secrets, toxicity
from lapsewise.storage import write_and_reload

#: The models decide, so SQL cannot express the rows.
ORACLE_SQL = None
#: Share of the tokens that the mix keeps.
KEPT_TOKENS = 0.9


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5; null and empty texts stay."""
    model = toxicity.fit(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).where("toxic_score < 0.5").drop("toxic_score")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each class of near duplicates, once; rows without doc_id stay.

    Of an id with several texts one takes part; its other texts stay, each once, unless they are copies.
    """
    marked = docs.where("doc_id is not null").withColumn("_digest", dedup.digest(F.col("doc_id"), F.col("text")))
    digests = write_and_reload(marked.select("doc_id", "_digest"), "pipeline-digests")
    counted = digests.groupBy("doc_id").agg(F.min("_digest").alias("_digest"))
    first = dedup.classes(docs).where("doc_id = class_id").select(F.col("doc_id").cast(docs.schema["doc_id"].dataType))
    own = counted.withColumnRenamed("_digest", "_counted")
    further = digests.join(own, "doc_id").where("_digest <> _counted")
    further = further.join(counted.select("_digest"), "_digest", "left_anti").groupBy("_digest").agg(F.min("doc_id").alias("doc_id"))
    kept = counted.join(first, "doc_id").unionByName(further)
    named = marked.join(kept, ["doc_id", "_digest"], "left_semi").dropDuplicates(["doc_id", "_digest"])
    return named.select(docs.columns).unionByName(docs.where("doc_id is null"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced by a mask and n_chars counted anew."""
    found = secrets.scan(docs, secrets.fit(docs))
    masked = found.withColumn("text", secrets.redact(F.col("text"), F.col("spans")))
    changed = F.when(F.size("spans") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.withColumn("n_chars", F.coalesce(changed, F.col("n_chars"))).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the token budgets of domains, languages and sources take, each at most once."""
    worded = docs.withColumn("domain", mixing.length_domain(F.col("text"))).withColumn(
        "n_tokens", mixing.n_words(F.col("text"))
    )
    taken = mixing.select(worded, catalog.MIX_WEIGHTS, KEPT_TOKENS).select("doc_id").distinct()
    return docs.join(taken, docs["doc_id"].eqNullSafe(taken["doc_id"]), "left_semi")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and their count."""
    common.small_batches(spark)
    path, pattern = catalog.default_vocabulary()
    rows = bpe.encode(docs, path, pattern)
    return rows.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_and_reload(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
