"""Helpers of the operators: written intermediates, connected components, bounded block pairs."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_folder

# functions that run in tasks travel with their code: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_STAR_ROUNDS = 100
SOME_ROWS = 256


def written(df: DataFrame, name: str) -> DataFrame:
    """The table after a round through shared storage: lineage is cut and nothing is computed twice."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread_scan(df: DataFrame, *cols: str) -> DataFrame:
    """Deal rows over all tasks in whole rows, for per-row work that is heavier than its input is large."""
    return df.repartition(tasks(df.sparkSession), *cols)


def some_rows(batch: pa.Array | pa.RecordBatch) -> Iterator:
    """Slices of some rows, so that few texts of an Arrow batch are Python strings at once."""
    for lo in range(0, len(batch) if isinstance(batch, pa.Array) else batch.num_rows, SOME_ROWS):
        yield batch.slice(lo, SOME_ROWS)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc_fold(key: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; NULL ids go to fold 0."""
    c = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(folds)), F.lit(0)).cast("int")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of `edges` (a, b): rows (id, component_id) for every id that has an edge.

    Large-star and small-star steps in turn. Each node's minimum is an aggregate with map-side
    combining and is written before it is joined back, so that adaptive execution can split a hub.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    e, before = written(e, name), None
    for _ in range(MAX_STAR_ROUNDS):
        now = tuple(e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first())
        if now == before or now[0] == 0:
            return e.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionByName(
                e.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct())
        before = now
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = written(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), name)
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.distinct(), name)
        low = written(large.groupBy("u").agg(F.min("v").alias("m")), name)
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("x"))
        e = written(small.select("x.u", "x.v").where("u <> v").distinct(), name)
    raise RuntimeError("connected components did not settle")


def block_pairs(items: DataFrame, key: str, by: Column, rows: int) -> DataFrame:
    """Deal each group of `key` into blocks of about `rows` rows and give every pair of blocks a group of its own.

    Adds `block`, `block_a`, `block_b`; groups of one row go. A group of any size becomes tasks of
    at most two blocks, so no group has to fit in one task.
    """
    sizes = items.groupBy(key).agg(F.count("*").alias("group_rows")).where("group_rows > 1")
    blocks = F.ceil(F.col("group_rows") / rows).cast("int")
    dealt = items.join(sizes, key).withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64(by), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return dealt.withColumn("other", other).withColumn("block_a", F.least("block", "other")).withColumn(
        "block_b", F.greatest("block", "other")).drop("other", "blocks", "group_rows")


def forest(pairs_a: np.ndarray, pairs_b: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id reachable from each position over the given links (positions into `ids`)."""
    low = ids.copy()
    while len(pairs_a):
        m = np.minimum(low[pairs_a], low[pairs_b])
        new = low.copy()
        np.minimum.at(new, pairs_a, m)
        np.minimum.at(new, pairs_b, m)
        if (new == low).all():
            break
        low = new
    return low


def compared(pairs: DataFrame, key: str, fn: Callable, once: bool = False) -> DataFrame:
    """Run `fn(pdf_a, pdf_b or None)` on every pair of blocks; rows (id, n, root) of ids that have a link.

    `fn` returns link positions (i into a, j into b) and, per id, what the links weigh. Only a
    spanning forest leaves the task, never the pairs. `once` drops rows of an id that came twice.
    """
    def run(pdf):
        pdf = pdf.drop_duplicates(["block", "id"]) if once else pdf
        a = pdf[pdf["block"] == pdf["block_a"].iloc[0]]
        same = pdf["block_a"].iloc[0] == pdf["block_b"].iloc[0]
        b = a if same else pdf[pdf["block"] == pdf["block_b"].iloc[0]]
        return _summed(fn(a, b, same), a, b, same)

    return pairs.groupBy(key, "block_a", "block_b").applyInPandas(run, "id long, n long, root long")


def _summed(links, a, b, same):
    import pandas as pd

    i, j = links
    ids = a["id"].to_numpy() if same else np.concatenate([a["id"].to_numpy(), b["id"].to_numpy()])
    weight = a["weight"].to_numpy() if same else np.concatenate([a["weight"].to_numpy(), b["weight"].to_numpy()])
    j = j if same else j + len(a)
    n = np.zeros(len(ids), dtype=np.int64)
    np.add.at(n, i, weight[j])
    np.add.at(n, j, weight[i])
    low = forest(i, j, ids)
    keep = n > 0
    return pd.DataFrame({"id": ids[keep], "n": n[keep], "root": low[keep]})
