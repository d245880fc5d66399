"""Corpus pipeline: from raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on everything its predecessor
kept; between stages the rows are a written table in the shared stage folder, so a lost executor
costs one stage at most. All stages but the last return the columns of ``documents``.

1. language_id       drops texts without a language: NULL, letterless, or nearest to no learned codeword
2. simhash_dedup     keeps one document, of the smallest id, of each near-duplicate component
3. decontaminate     cuts benchmark passages out and drops documents that consist of them for the most part
4. secret_scan       replaces secrets with a mask
5. best_fit_packing  places the documents in training sequences

Clean documents pass stages 1 to 4 unchanged. NULL and empty texts end in stage 1, repeated rows in stage 2;
an empty table gives an empty result. Columns beyond those of ``documents`` are carried through stages 1 to 4.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulso.llm import best_fit_packing, decontaminate, language_id, secret_scan, simhash_dedup
from pulso.llm.common import id_fold, table
from pulso.session import materialize
from pulso.sources.letters import quoted

# A text whose nearest codeword is hardly nearer than any other has no language that was learned.
MIN_LANGUAGE_SCORE = 0.3


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.fit(docs.filter((id_fold("doc_id", 5) != 0) & F.col("text").isNotNull()))
    packed = docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row"), "text")
    found = packed.select("row", language_id.predict(packed, model).alias("language"))
    known = found.filter((F.col("language.lang") != language_id.UNDETERMINED) & (F.col("language.score") >= MIN_LANGUAGE_SCORE))
    return known.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.keep_one(docs, shingle=3, radius=2)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"), window=10, max_share=0.5)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs, overlaps=True)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return best_fit_packing.pack(docs, best_fit_packing.words_and_end(), F.col("source"), best_fit_packing.same_text())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_known_languages),
    ("simhash_dedup", keep_one_of_each_group),
    ("decontaminate", remove_benchmark),
    ("secret_scan", mask_secrets),
    ("best_fit_packing", pack_sequences),
]

# Codeword decoding, near-duplicate components and packing have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
