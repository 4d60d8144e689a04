"""Queries of the operators on the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ball_search, fill_middle, language, toxicity
from .common import crc_fold, table
from .decontaminate import contaminated
from .lines import line_report
from .near_vectors import near_vectors
from .ngram_join import ngram_join
from .packing import packed_documents
from .pseudonyms import KINDS, pseudonymise
from .secret_scan import report_sql, secret_report
from .suffix_dedup import passage_report
from .token_files import document_token_counts


def op1_near_vectors(spark: SparkSession, d: str) -> DataFrame:
    return near_vectors(table(spark, d, "embeddings"))


def op2_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    return line_report(table(spark, d, "documents"))


def op3_ngram_join(spark: SparkSession, d: str) -> DataFrame:
    return ngram_join(table(spark, d, "documents"))


def op4_secrets(spark: SparkSession, d: str) -> DataFrame:
    return secret_report(table(spark, d, "documents"))


def op5_decontaminate(spark: SparkSession, d: str) -> DataFrame:
    return contaminated(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op6_language(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    held = crc_fold("doc_id", 4) == 2
    found = language.identify(docs, language.profiles(docs.where(~held)))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op7_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    held = crc_fold("doc_id", 5) == 0
    learned = toxicity.learn(docs, table(spark, d, "labels").where(~held))
    found = toxicity.score(docs, learned)
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_packing(spark: SparkSession, d: str) -> DataFrame:
    return packed_documents(table(spark, d, "documents"))


def op9_pseudonyms(spark: SparkSession, d: str) -> DataFrame:
    found = pseudonymise(table(spark, d, "documents").select("doc_id", "text"), b"catalogue key")
    return found.select("doc_id", "text", *[F.coalesce(F.col("found")[k], F.lit(0)).alias(f"n_{k}") for k in KINDS])


def op10_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return document_token_counts(table(spark, d, "documents"))


def op11_fill_middle(spark: SparkSession, d: str) -> DataFrame:
    return fill_middle.fill_middle_report(table(spark, d, "documents"))


def op12_ball_search(spark: SparkSession, d: str) -> DataFrame:
    return ball_search.search(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op13_suffix_dedup(spark: SparkSession, d: str) -> DataFrame:
    return passage_report(table(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


def oracle_sql() -> dict[str, str]:
    return {"op4_secrets": report_sql(), "op11_fill_middle": fill_middle.report_sql(), "op12_ball_search": ball_search.report_sql()}
