"""Token counts of flat, unindexed token files by a vectorised scan for the end-of-document id."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_folder
from ..sources.flat import fixed_records
from .common import written
from .tokens import default_path, encoder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

END_OF_TEXT = 49407      # <|endoftext|> of the default vocabulary
BLOCK_TOKENS = 1 << 18
SPAN = 1024              # blocks whose figures are first put together, so that no file is one task's


def write_flat(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
               end_id: int = END_OF_TEXT, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Token ids of all texts, each followed by `end_id`, as flat files of uint16 in shared storage.

    One file per task, cut into blocks of equal size wherever documents end: rows (file, block,
    ids). Apart from them the order of the documents is kept, rows (file, first, docs) without
    ids, but no place or length of any. NULL and empty texts are the end id alone. Strings of
    special tokens are ordinary text, so the end id ends documents only.
    """
    path = path or default_path()
    kind = docs.schema[id_col].dataType.simpleString()

    def flat(batches):
        from pyspark import TaskContext

        encode, file = encoder(path, plain_specials=True), TaskContext.get().partitionId()
        if not 0 <= end_id < 1 << 16:
            raise ValueError("flat files here hold ids of 16 bits")
        end, held, block, first, limit = np.array([end_id], dtype="<u2").tobytes(), bytearray(), 0, 0, 2 * block_tokens

        def row(block=None, ids=None, first=None, docs=None):
            return pd.DataFrame({"file": [file], "block": pd.array([block], dtype="Int64"), "ids": [ids], "first": pd.array([first], dtype="Int64"), "docs": [docs]})

        for pdf in batches:
            yield row(first=first, docs=[None if pd.isna(k) else k for k in pdf["id"].astype(object)])
            first += len(pdf)
            for text in pdf["text"].array:
                ids = np.frombuffer(encode(text if isinstance(text, str) else None), dtype="<u4")
                if len(ids) and ids.max() >= 1 << 16:
                    raise ValueError("the vocabulary has ids of more than 16 bits")
                held += ids.astype("<u2").tobytes() + end
                while len(held) >= limit:
                    yield row(block, bytes(held[:limit]))
                    del held[:limit]
                    block += 1
        if held:
            yield row(block, bytes(held))

    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInPandas(
        flat, f"file long, block long, ids binary, first long, docs array<{kind}>")
    folder = scratch_folder(docs.sparkSession, "flat")
    out.write.option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.schema(out.schema).parquet(folder)


def read_flat(spark: SparkSession, path: str, *, width: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks (file, block, ids) of flat files of any size that other programs wrote, read by byte ranges."""
    raw = fixed_records(spark, path, record_bytes=width, records=block_tokens)
    return raw.select(F.xxhash64("file").alias("file"), "block", F.col("data").alias("ids"))


def token_counts(blocks: DataFrame, *, end_id: int = END_OF_TEXT, dtype: str = "<u2") -> DataFrame:
    """One row per document of flat files: (file, ordinal, start, n_tokens, ended).

    Each block is searched on its own for `end_id`. A prefix scan over the blocks' lengths, counts
    and last ends then places every end in its file and stitches documents that cross blocks.
    Tokens after a file's last end are a document with `ended` false. Empty blocks and files give
    no rows; other columns are ignored.
    """
    def search(batches):
        for pdf in batches:
            rows = []
            for file, block, ids in zip(pdf["file"], pdf["block"], pdf["ids"]):
                a = np.frombuffer(ids, dtype=dtype)
                rows.append((file, block, len(a), np.flatnonzero(a == end_id).astype(np.int64)))
            yield pd.DataFrame(rows, columns=["file", "block", "length", "ends"])

    found = written(blocks.where("ids is not null").select("file", "block", "ids").mapInPandas(
        search, "file long, block long, length long, ends array<long>"), "ends")
    sums = found.select("file", "block", "length", F.size("ends").cast("long").alias("n"), F.get("ends", F.size("ends") - 1).alias("last"),
                        F.expr(f"block div {SPAN}").alias("span"))
    inside = Window.partitionBy("file", "span").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("at", F.coalesce(F.sum("length").over(inside), F.lit(0)))
    sums = sums.withColumn("end_at", F.col("at") + F.col("last"))
    sums = written(sums.withColumn("n_before", F.coalesce(F.sum("n").over(inside), F.lit(0)))
                   .withColumn("end_before", F.max("end_at").over(inside)), "ends-inside")
    spans = sums.groupBy("file", "span").agg(F.sum("length").alias("length"), F.sum("n").alias("n"), F.max("end_at").alias("last"))
    over = Window.partitionBy("file").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("at0", F.coalesce(F.sum("length").over(over), F.lit(0))).withColumn("n0", F.coalesce(F.sum("n").over(over), F.lit(0)))
    spans = spans.withColumn("end0", F.max(F.col("at0") + F.col("last")).over(over)).select("file", "span", "at0", "n0", "end0")
    placed = sums.join(spans, ["file", "span"]).select(
        "file", "block", (F.col("at") + F.col("at0")).alias("at"), (F.col("n_before") + F.col("n0")).alias("n_before"),
        F.coalesce(F.col("end_before") + F.col("at0"), F.col("end0"), F.lit(-1)).alias("end_before"))
    docs = found.where(F.size("ends") > 0).join(placed, ["file", "block"]).select("file", "at", "n_before", "end_before", F.posexplode("ends"), "ends")
    before = F.when(F.col("pos") == 0, F.col("end_before")).otherwise(F.col("at") + F.expr("ends[greatest(pos - 1, 0)]"))
    docs = docs.select("file", (F.col("n_before") + F.col("pos")).alias("ordinal"), (before + 1).alias("start"),
                       (F.col("at") + F.col("col") - before - 1).alias("n_tokens"), F.lit(True).alias("ended"))
    whole = sums.join(spans, ["file", "span"]).groupBy("file").agg(
        F.max(F.col("at") + F.col("at0") + F.col("length")).alias("size"), F.sum("n").alias("ordinal"),
        F.coalesce(F.max(F.col("end_at") + F.col("at0")), F.lit(-1)).alias("last"))
    tail = whole.where("size > last + 1").select("file", "ordinal", (F.col("last") + 1).alias("start"),
                                                 (F.col("size") - F.col("last") - 1).alias("n_tokens"), F.lit(False).alias("ended"))
    return docs.unionByName(tail)


def document_token_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Token counts of documents through flat files: write, scan, and name each counted document by its order.

    Repeated rows are counted one by one, an id may be NULL; NULL and empty texts have 0 tokens.
    """
    flat = write_flat(docs, id_col=id_col, text_col=text_col, path=path)
    order = flat.where("docs is not null").select("file", "first", F.posexplode("docs").alias("k", id_col))
    order = order.select("file", (F.col("first") + F.col("k")).alias("ordinal"), id_col)
    return order.join(token_counts(flat), ["file", "ordinal"]).select(id_col, "n_tokens", "file", "ordinal", "start")
