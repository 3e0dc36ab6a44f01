"""The registered queries of the numbered operators: whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise.llm import (
    bpe, common, dedup, divergence, html_text, language, lexical, licenses, mixing, neighbours, pii, quality, secrets,
    sql, toxicity,
)


#: Target weights of the mix by tree path; paths not listed weigh 1.
MIX_WEIGHTS = {
    ("works",): 2.0, ("notes",): 1.0,
    ("works", "en"): 2.0, ("notes", "en"): 2.0,
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def default_vocabulary() -> tuple[str, str]:
    """Path and pre-token pattern of the default vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op1_neighbours(spark, sf_dir):
    return neighbours.search(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op2_secrets(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.fit(docs))
    base = F.filter("spans", lambda s: s["kind"] != "random")
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in secrets.KINDS
    ]
    return found.select(
        "doc_id", *counts, F.sha2(secrets.as_text(base).cast("binary"), 256).alias("base_sha256"),
        secrets.as_text(F.col("spans")).alias("spans"),
    )


def op3_bpe(spark, sf_dir):
    common.small_batches(spark)
    path, pattern = default_vocabulary()
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(docs, path, pattern).select("doc_id", "digests.*")


def op4_quality(spark, sf_dir):
    return quality.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_licenses(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan(docs, licenses.build_index(docs))
    names = F.transform("templates", lambda t: t["template"])
    best = F.array_max(F.transform("templates", lambda t: t["share"]))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base_labels"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_labels", names)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
    )


def op6_html(spark, sf_dir):
    common.small_batches(spark)
    pages = html_text.main_text(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_language(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = language.predict(docs.select("doc_id", "text"), language.fit(docs))
    return out.select("doc_id", (common.fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score")


def op8_minhash(spark, sf_dir):
    return dedup.classes(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_mixing(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", mixing.length_domain(F.col("text")).alias("domain"),
        mixing.n_words(F.col("text")).alias("n_tokens"),
    )
    return mixing.select(docs, MIX_WEIGHTS, share=0.8, epochs=2)


def op10_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))
    return out.select(
        "doc_id", (common.fold(F.col("doc_id")) == 0).alias("held_out"), F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"),
    )


def op11_divergence(spark, sf_dir):
    return divergence.audit(_table(spark, sf_dir, "documents").select("lang", "source", "text"))


def op12_pii(spark, sf_dir):
    found = pii.find(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["kind"].isin(*pii.PLAIN))
    return found.select(
        "doc_id", *(pii.n_of(F.col("pii"), kind).alias(f"n_{kind}") for kind in pii.PLAIN),
        F.sha2(pii.as_text(base).cast("binary"), 256).alias("base_sha256"), pii.as_text(F.col("pii")).alias("spans"),
    )


def op13_lexical(spark, sf_dir):
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def queries():
    return {
        f.__name__: f for f in (
            op1_neighbours, op2_secrets, op3_bpe, op4_quality, op5_licenses, op6_html, op7_language, op8_minhash,
            op9_mixing, op10_toxicity, op11_divergence, op12_pii, op13_lexical,
        )
    }


def oracle_sql() -> dict[str, str]:
    return dict(sql.SQL)
