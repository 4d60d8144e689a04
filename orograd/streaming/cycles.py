"""Hourly cycles as Structured Streaming queries over landed files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.cols import kelvin_to_f
from ..functions.degree_days import hourly_hdd
from ..operators.cubes import hourly_cube, zip_terrain
from ..operators.quality import findings
from ..session import checkpoint
from ..functions.cols import c

POLL_SECONDS = 300
LOOKBACK = "2 hours"
RETENTION_HOURS = 48


def cycle_source(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    """New hourly files as they land."""
    return spark.readStream.schema(schema).parquet(folder)


def dedup_cycles(stream: DataFrame, *, lookback: str = LOOKBACK) -> DataFrame:
    """One row per hour and ZIP; repeats within the look-back are dropped, later ones are too late."""
    return stream.withWatermark("ts", lookback).dropDuplicatesWithinWatermark(["ts", "zip_code"])


def newest_cycles(stream: DataFrame, *, sequence: str, lookback: str = LOOKBACK) -> DataFrame:
    """One row per hour and ZIP: of repeats within the look-back the one with the highest `sequence`.

    An hour's rows come out when the look-back has passed, so totals behind this count each hour once and with its last value.
    """
    rest = [k for k in stream.columns if k not in ("ts", "zip_code")]
    last = stream.withWatermark("ts", lookback).groupBy("ts", "zip_code").agg(F.max_by(F.struct(*rest), sequence).alias("_row"))
    return last.select("ts", "zip_code", "_row.*").select(*stream.columns)


def cycle_cube_stream(stream: DataFrame, static: DataFrame, *, bias: float = 0.0) -> DataFrame:
    """Cube rows of each cycle: a stateless stream-static join."""
    return hourly_cube(stream, static, bias=bias)


def daily_hdd_stream(stream: DataFrame, *, lookback: str = LOOKBACK) -> DataFrame:
    """Daily mean temperature and HDD per ZIP in event time."""
    temp = kelvin_to_f(F.col("t2m_k"))
    return _daily(stream.withWatermark("ts", lookback), temp)


def newest_daily_hdd_stream(stream: DataFrame, *, sequence: str, lookback: str = LOOKBACK) -> DataFrame:
    """Daily totals of the newest value of each hour; for append mode, as a day closes when all its hours have."""
    return _daily(newest_cycles(stream, sequence=sequence, lookback=lookback), kelvin_to_f(F.col("t2m_k")))


def _daily(stream: DataFrame, temp: Column) -> DataFrame:
    return (stream.groupBy(F.window("ts", "1 day"), "zip_code")
            .agg(F.avg(temp).alias("mean_temp_f"), F.sum(hourly_hdd(temp)).alias("daily_hdd"),
                 F.count(F.lit(1)).alias("num_hours"))
            .select(F.col("window.start").cast("date").alias("date"), "zip_code", "mean_temp_f", "daily_hdd",
                    "num_hours"))


def write_days(days: DataFrame, path: str, checkpoint: str, *, once: bool = False) -> StreamingQuery:
    """Write the running totals of `daily_hdd_stream`, the open day's too, one folder per batch.

    A repeated batch replaces its own folder; `latest_days` reads the newest total of each day and ZIP.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path))

    w = days.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime=f"{POLL_SECONDS} seconds")).start()


def latest_days(spark: SparkSession, path: str) -> DataFrame:
    """Newest total of each day and ZIP among the batches written."""
    rows = spark.read.schema("date date, zip_code string, mean_temp_f double, daily_hdd double, num_hours long, batch long").parquet(path)
    return rows.groupBy("date", "zip_code").agg(*[F.max_by(k, "batch").alias(k) for k in ("mean_temp_f", "daily_hdd", "num_hours")])


def build_static(terrain: DataFrame, path: str) -> None:
    """Write the static feature table: one row per ZIP with what every cycle needs of the normals."""
    zip_terrain(terrain).write.mode("overwrite").parquet(path)


def load_static(spark: SparkSession, path: str) -> DataFrame:
    """The written feature table. A micro-batch joins this file and does not derive the normals again."""
    return spark.read.parquet(path)


def cycle_status(cycles: DataFrame, *, ts: str = "ts", keys: tuple[str, ...] = ("zip_code",)) -> DataFrame:
    """What a cycle table holds: per hour its rows and places, and how many hours it lies behind the newest."""
    hour = F.date_trunc("hour", F.col(ts))
    newest = F.date_trunc("hour", cycles.agg(F.max(ts)).scalar())
    out = cycles.groupBy(hour.alias("hour")).agg(F.count(F.lit(1)).alias("num_rows"), F.count_distinct(*keys).alias("num_places"))
    return out.withColumn("hours_behind", ((F.unix_timestamp(newest) - F.unix_timestamp("hour")) / 3600).cast("int"))


def validate_stream(cube: DataFrame) -> DataFrame:
    """Rules of one written cycle."""
    need = ["datetime_utc", "zip_code", "altitude_ft", "temp_adjusted_f", "wind_speed_kt", "turbulence_flag"]
    rules = [("warning", "unusual temperature", (c("temp_adjusted_f") < -80) | (c("temp_adjusted_f") > 120))] if (
        "temp_adjusted_f" in cube.columns) else []
    return findings(cube, required=need, rules=rules)


def write_cycles(cube: DataFrame, path: str, checkpoint: str, *, once: bool = False) -> StreamingQuery:
    """Write each cycle under its date and hour.

    A repeated batch replaces the folders it wrote before, so a restart neither loses nor repeats
    rows. `checkpoint` must be a folder all executors share.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("date", F.to_date("datetime_utc")).withColumn("hour", F.hour("datetime_utc"))
         .withColumn("batch", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("date", "hour", "batch").parquet(path))

    w = cube.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime=f"{POLL_SECONDS} seconds")).start()


def retention_split(cube: DataFrame, *, ts: str = "datetime_utc", hours: int = RETENTION_HOURS) -> DataFrame:
    """Add `archive`: rows whose hour is older than the newest by more than the retention; hours expire whole."""
    newest = F.date_trunc("hour", cube.agg(F.max(ts)).scalar())
    return cube.withColumn("archive", F.date_trunc("hour", F.col(ts)) < newest - F.expr(f"interval {hours} hours"))


def rotate(cube: DataFrame, archive_path: str, *, ts: str = "datetime_utc", hours: int = RETENTION_HOURS) -> DataFrame:
    """Append expired rows to the archive by date and return those to keep.

    Rows that the archive has already are not written again, so a repeated pass and late rows of an
    archived hour both leave it whole. Only the dates that expire are read back.
    """
    spark = cube.sparkSession
    split = retention_split(cube, ts=ts, hours=hours)
    gone = split.where("archive").drop("archive").withColumn("date", F.to_date(ts))
    path = spark._jvm.org.apache.hadoop.fs.Path(archive_path)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        ends = gone.agg(F.min("date"), F.max("date")).first()
        old = spark.read.schema(gone.schema).parquet(archive_path).where(F.col("date").between(ends[0], ends[1]))
        gone = checkpoint(gone.exceptAll(old))
    gone.write.mode("append").partitionBy("date").parquet(archive_path)
    return split.where("not archive").drop("archive")


def stream_status(query: StreamingQuery) -> DataFrame:
    """Progress of the batches that the engine still remembers; `cycle_status` reads the written table instead."""
    rows = [(int(p.batchId), str(p.timestamp), int(p.numInputRows), float(p.durationMs.get("triggerExecution", 0)))
            for p in query.recentProgress]
    return SparkSession.active().createDataFrame(
        rows, "batch_id long, started_at string, num_input_rows long, duration_ms double")
