"""From documents to training sequences: five stages, each one operator of `orograd.llm`.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last
return the columns of `documents`. NULL texts pass every filter and are packed as the end id alone;
rows without an id are kept, rows of one id count as one document from the third stage on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orograd.llm import decontaminate as leaks
from orograd.llm import toxicity
from orograd.llm.common import crc_fold, fresh, table, written
from orograd.llm.lines import dedup_lines
from orograd.llm.ngram_join import ngram_join
from orograd.llm.packing import packed_documents


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents without those ids; the ids are written first, so Spark knows how many they are before it joins."""
    key = fresh(docs, "gone")
    gone = written(ids.select(F.col("doc_id").alias(key)).where(F.col(key).isNotNull()).distinct(), "gone")
    return docs.join(gone, docs["doc_id"] == F.col(key), "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity of 0.5 or more go. It is learned from the labelled rows outside fold 0 of 5."""
    labels = table(spark, sf_dir, "labels")
    learned = toxicity.learn(docs, labels.where(crc_fold("doc_id", 5) != 0))
    return _without(docs, toxicity.score(docs, learned).where("score >= 0.5"))


def dedup_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One line stays of each group of near-equal lines; documents that lose all their lines go. `n_chars` follows the text."""
    blank = fresh(docs, "was_blank")
    marked = docs.withColumn(blank, F.coalesce(F.trim("text") == "", F.lit(True)))
    out = dedup_lines(marked).where(F.col(blank) | ~F.rlike("text", F.lit(r"^\s*$"))).drop(blank)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def dedup_near_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each class that similarities of 0.8 on five-word n-grams connect: the one with the smallest id."""
    joined = written(ngram_join(docs), "classes")
    out = _without(docs, joined.where(F.col("doc_id") != F.col("class_id")))
    repeated = joined.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count()
    if repeated:
        out = out.where("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(out.where("doc_id is null"))
    return out


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item or its template go."""
    return _without(docs, leaks.contaminated(docs, table(spark, sf_dir, "benchmark")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of at most 4096 tokens."""
    return packed_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_repeated_lines),
    ("ngram_join", dedup_near_documents),
    ("decontamination", drop_leaked),
    ("packing", pack),
]

ORACLE_SQL = None  # learned scores, signatures and packing have no SQL twin; tests compare stages with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
