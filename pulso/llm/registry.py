"""Registered queries of the training-data operators: thin calls over the provided tables.

``ORACLE_SQL`` has DuckDB SQL where SQL can express the operator; the other
queries are tested against brute force or held-out accuracy in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (best_fit_packing, centroid_cluster, conversation_repair, decontaminate, language_id, lm_score, main_text, secret_scan, simhash_dedup,
               token_count, topk_search, toxicity, warc_derive)
from .common import id_fold, table
from .oracles import OP2_SQL, OP3_SQL, OP7_SQL, OP8_SQL, OP11_SQL, OP13_SQL


def _held_out(buckets: int, held: int):
    return F.coalesce(id_fold("doc_id", buckets) == held, F.lit(False))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs.filter((id_fold("doc_id", 5) != 0) & F.col("text").isNotNull()))
    found = docs.withColumn("found", language_id.predict(docs, model))
    return found.select("doc_id", _held_out(5, 0).alias("held_out"), F.col("found.lang").alias("lang_pred"),
                        F.col("found.score").alias("score"), F.col("found.ambiguous").alias("ambiguous"))


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_score.lm_score(table(spark, sf_dir, "documents"))
    return scored.withColumns({c: F.round(c, 6) for c in ("base_score", "score")})


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["rank"] < 3)

    def of_kind(rank: int):
        return F.filter("secrets", lambda s: s["rank"] == rank)

    count = {k: F.size(of_kind(rank)).cast("long").alias(f"n_{k}") for rank, k in enumerate(secret_scan.KINDS)}
    return found.select("doc_id", count["assign"], count["access"], count["hex"],
                        F.sha2(secret_scan.labels(base), 256).alias("base_sha256"),
                        secret_scan.labels(F.col("secrets")).alias("spans"), count["entropy"])


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(id_fold("doc_id", 3) != 1)
    scored = docs.withColumn("score", toxicity.predict(docs, toxicity.fit(docs, labels)))
    return scored.select("doc_id", _held_out(3, 1).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op5_warc_derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_derive.derive(warc_derive.responses(table(spark, sf_dir, "pages")), keep=("page_id",))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return best_fit_packing.pack(docs, best_fit_packing.words_and_end(), F.col("source"), best_fit_packing.same_text())


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.annotate(docs, table(spark, sf_dir, "benchmark"), window=10)
    return found.select("doc_id", F.col("found.n_words").alias("n_words"), F.col("found.n_hit").alias("n_hit"),
                        F.size("found.items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
                        (F.col("found.n_hit") > 0).alias("contaminated"))


def op8_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.topk(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").withColumn("__main", main_text.extract("html"))
    return pages.select("page_id", "url", F.col("__main").alias("text"), F.length("__main").cast("long").alias("n_chars"))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.simhash_components(table(spark, sf_dir, "documents"), shingle=3, radius=2)


def op11_centroid_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroid_cluster.cluster(table(spark, sf_dir, "embeddings"), k=8, rounds=10, seed="3", dim=64, scale=1024)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                        F.sha2(F.array_join("centroid", ","), 256).alias("centroid_sha256"))


def op12_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn(
        "n_tokens", token_count.n_tokens(spark, "text", public_tokenizers.path("byte_bpe_50k.json")))
    return counted.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "n_tokens",
                          (F.col("n_tokens") > 1024).alias("over_limit"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.report(conversation_repair.damage(table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_lm_score": op2_lm_score,
    "op3_secret_scan": op3_secret_scan,
    "op4_toxicity": op4_toxicity,
    "op5_warc_derive": op5_warc_derive,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_decontaminate": op7_decontaminate,
    "op8_topk_search": op8_topk_search,
    "op9_main_text": op9_main_text,
    "op10_simhash_dedup": op10_simhash_dedup,
    "op11_centroid_cluster": op11_centroid_cluster,
    "op12_token_count": op12_token_count,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE_SQL: dict[str, str] = {
    "op2_lm_score": OP2_SQL,
    "op3_secret_scan": OP3_SQL,
    "op7_decontaminate": OP7_SQL,
    "op8_topk_search": OP8_SQL,
    "op11_centroid_cluster": OP11_SQL,
    "op13_conversation_repair": OP13_SQL,
}
