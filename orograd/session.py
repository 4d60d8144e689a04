"""Session settings, reliable checkpoints and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A broadcast hint is given only to tables counted to hold at most this many rows.
MAX_BROADCAST_ROWS = 100_000


def local_session(cpus: int | str = "*", app: str = "orograd") -> SparkSession:
    """Session for tests and the local bench; on a cluster the caller brings its own."""
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared `spark.checkpoint.dir`; make a folder only for local runs."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    path = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        path = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    sc.setCheckpointDir(path)


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage through reliable storage, so a lost executor does not restart the iteration."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder beside the checkpoints, hence shared by all executors."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Hash rows over all tasks before a step that turns each into many.

    The count is explicit, so adaptive execution does not merge the small input back together.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cols)


def bounded_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
                 max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Join per-grid or per-group figures back onto the rows they came from.

    `small` is computed once and counted. Within `max_rows` it is broadcast, so a key that holds
    most of `big` causes no shuffle. Beyond, it is an ordinary join: shuffled, hot partitions
    split by adaptive execution.
    """
    small = checkpoint(small)
    if small.count() <= max_rows:
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)
