"""Status of running streams that outlives them: a listener that appends what happened to a table."""

from __future__ import annotations

import datetime as dt
import json
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..sources.flat import _opened

SCHEMA = ("event string, query_id string, run_id string, name string, at timestamp, batch_id long, num_rows long, duration_ms double, "
          "latest timestamp, error string")
_TYPES = pa.schema([("event", pa.string()), ("query_id", pa.string()), ("run_id", pa.string()), ("name", pa.string()), ("at", pa.timestamp("us", "UTC")),
                    ("batch_id", pa.int64()), ("num_rows", pa.int64()), ("duration_ms", pa.float64()), ("latest", pa.timestamp("us", "UTC")), ("error", pa.string())])


def _time(text: str | None) -> dt.datetime | None:
    return dt.datetime.fromisoformat(text.replace("Z", "+00:00")) if text else None


class HealthListener(StreamingQueryListener):
    """Appends every start, batch with rows, stop and failure of the session's streams to Parquet under `path`.

    Rows are small files of their own, written without a Spark job, so a busy cluster doesn't hold the listener up. `path` is a
    local folder or a URI.
    """

    def __init__(self, path: str) -> None:
        self.path, self.names = path, {}

    def _append(self, event: str, query_id, run_id, at: dt.datetime | None = None, **more) -> None:
        row = {"event": event, "query_id": str(query_id), "run_id": str(run_id), "name": self.names.get(str(run_id)),
               "at": at or dt.datetime.now(dt.timezone.utc), "batch_id": None, "num_rows": None, "duration_ms": None, "latest": None, "error": None} | more
        system, path = _opened(self.path)
        system.create_dir(path, recursive=True)
        name, hidden = f"{path}/{event}-{uuid.uuid4().hex}.parquet", f"{path}/_{uuid.uuid4().hex}"
        with system.open_output_stream(hidden) as f:
            pq.write_table(pa.Table.from_pylist([row], schema=_TYPES), f)
        system.move(hidden, name)   # readers see whole files only

    def onQueryStarted(self, event) -> None:
        self.names[str(event.runId)] = event.name
        self._append("started", event.id, event.runId, _time(event.timestamp))

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        if p.get("numInputRows"):
            self._append("batch", p["id"], p["runId"], _time(p["timestamp"]), batch_id=p["batchId"], num_rows=p["numInputRows"],
                         duration_ms=float(p.get("durationMs", {}).get("triggerExecution", 0)), latest=_time(p.get("eventTime", {}).get("max")))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        error = event.exception
        self._append("failed" if error else "stopped", event.id, event.runId, error=error[:2000] if error else None)


def watched(spark: SparkSession, path: str) -> HealthListener:
    """A listener on the session's streams; `spark.streams.removeListener` ends it."""
    listener = HealthListener(path)
    spark.streams.addListener(listener)
    return listener


def stream_health(spark: SparkSession, path: str) -> DataFrame:
    """One row per stream over all its runs: batches and rows processed, failed cycles, last cycle, uptime.

    A stream keeps its id over restarts through its checkpoint. A batch that a restart repeated counts once. A run's uptime is from
    its start to its last event, so a run that was killed counts up to its last batch.
    """
    rows = spark.read.schema(SCHEMA).parquet(path)
    runs = rows.groupBy("query_id", "run_id").agg((F.unix_timestamp(F.max("at")) - F.unix_timestamp(F.min("at"))).alias("up"))
    runs = runs.groupBy("query_id").agg(F.count(F.lit(1)).alias("num_runs"), F.sum("up").alias("uptime_s"))
    done = rows.where("event = 'batch'").groupBy("query_id", "batch_id").agg(*[F.max_by(k, "at").alias(k) for k in ("num_rows", "duration_ms", "latest")], F.max("at").alias("at"))
    done = done.groupBy("query_id").agg(F.count(F.lit(1)).alias("num_processed"), F.sum("num_rows").alias("num_rows"), F.max("batch_id").alias("last_batch"),
                                        F.max("at").alias("last_cycle_at"), F.max("latest").alias("latest_event"), F.avg("duration_ms").alias("mean_duration_ms"))
    ends = rows.groupBy("query_id").agg(F.max("name").alias("name"), F.count(F.when(F.col("event") == "failed", 1)).alias("num_failed"),
                                        F.max_by("error", F.when(F.col("event") == "failed", F.col("at"))).alias("last_error"), F.max_by("event", "at").alias("last_event"))
    return (ends.join(runs, "query_id").join(done, "query_id", "left").withColumn("num_processed", F.coalesce("num_processed", F.lit(0)))
            .withColumn("running", ~F.col("last_event").isin("failed", "stopped")).drop("last_event"))
