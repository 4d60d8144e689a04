"""Writers and the table shapes they produce."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cols import zfill5
from ..operators.registry import geojson_features
from ..types import (LIDAR_VINTAGE, NLCD_VINTAGE, PIPELINE_VERSION, PRISM_PERIOD, TERRAIN_COLUMNS,
                     require_columns)

NUMERIC = ("effective_hdd effective_cdd cell_area_sqm hdd_terrain_mult hdd_elev_addition hdd_uhi_reduction "
           "mean_elevation_ft mean_wind_ms wind_infiltration_mult prism_annual_hdd lst_summer_c "
           "mean_impervious_pct surface_albedo uhi_offset_f road_heat_flux_wm2 road_temp_offset_f").split()


def terrain_attributes(cells: DataFrame, *, region_code: str, run_date: str | None = None,
                       pipeline_version: str = PIPELINE_VERSION, lidar_vintage: int = LIDAR_VINTAGE,
                       nlcd_vintage: int = NLCD_VINTAGE, prism_period: str = PRISM_PERIOD) -> DataFrame:
    """Cell rows with ids and version columns, plus one aggregate row per ZIP, in the fixed order."""
    require_columns(cells, ["zip_code", "cell_id", "base_station", "effective_hdd", "cell_area_sqm"])
    stamp = run_date or dt.datetime.now(dt.timezone.utc).isoformat()
    have = [k for k in NUMERIC if k in cells.columns]
    version = {"run_date": F.lit(stamp), "pipeline_version": F.lit(pipeline_version),
               "lidar_vintage": F.lit(lidar_vintage), "nlcd_vintage": F.lit(nlcd_vintage),
               "prism_period": F.lit(prism_period)}
    df = cells.withColumns({k: F.expr(f"try_cast(`{k}` as double)") for k in have}).withColumns(
        {"zip_code": zfill5("zip_code"), **version})
    ident = F.concat_ws("_", F.lit(region_code), "zip_code", "base_station", F.lit("cell"), "cell_id")
    rows = df.withColumn("microclimate_id", ident)
    special = {"zip_code", "cell_id", "cell_type", "cell_area_sqm", "effective_hdd", "base_station", *version}
    other = [k for k in df.columns if k not in special and k not in have]
    agg = df.groupBy("zip_code").agg(
        F.min_by("base_station", "cell_id").alias("base_station"),
        F.avg("effective_hdd").alias("effective_hdd"), F.count(F.lit(1)).alias("num_cells"),
        F.min("effective_hdd").alias("cell_hdd_min"), F.max("effective_hdd").alias("cell_hdd_max"),
        F.stddev_samp("effective_hdd").alias("cell_hdd_std"),
        *[F.avg(k).alias(k) for k in have if k not in ("effective_hdd", "cell_area_sqm")],
        *[F.min_by(k, "cell_id").alias(k) for k in other if k != "num_cells"]).withColumns(version)
    agg = agg.withColumn("cell_id", F.lit("aggregate")).withColumn(
        "microclimate_id", F.concat_ws("_", F.lit(region_code), "zip_code", "base_station", F.lit("aggregate")))
    return ordered(rows.unionByName(agg, allowMissingColumns=True))


def ordered(df: DataFrame) -> DataFrame:
    """Known columns in the fixed order, all others after them."""
    known = [k for k in TERRAIN_COLUMNS if k in df.columns]
    return df.select(*known, *[k for k in df.columns if k not in known])


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_terrain(cells: DataFrame, path: str, *, region_code: str, **version) -> None:
    write_csv(terrain_attributes(cells, region_code=region_code, **version), path)


def write_daily(daily: DataFrame, path: str, *, output_format: str = "parquet") -> None:
    """Daily rows, the date as text; `parquet`, `csv` or `both`."""
    if output_format not in ("parquet", "csv", "both"):
        raise ValueError(f"unknown format {output_format}")
    out = daily.withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    if output_format in ("parquet", "both"):
        out.write.mode("overwrite").option("compression", "snappy").parquet(f"{path}/parquet")
    if output_format in ("csv", "both"):
        write_csv(out, f"{path}/csv")


def write_by_date(df: DataFrame, path: str, *, ts: str | None = None) -> None:
    """One folder per date; the whole dataset is the combined output.

    Only the dates present are replaced, so repeating a run leaves the same result. The rebalance
    keeps files few per date and still splits a date that holds much of the data.
    """
    if ts is not None:
        df = df.withColumn("date", F.to_date(ts))
    (df.hint("rebalance", "date").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").option("compression", "snappy").partitionBy("date").parquet(path))


def write_hourly(cube: DataFrame, path: str) -> None:
    write_by_date(cube, path, ts="datetime_utc")


def write_cube(cube: DataFrame, path: str) -> None:
    write_by_date(cube, path)


def _csv_by_date(df: DataFrame, path: str, ts: str, form: str) -> None:
    """CSV with header, one folder per date; only the dates present are replaced. Times are text in `form`."""
    out = df.withColumn("day", F.to_date(ts)).withColumn(ts, F.date_format(ts, form))
    (out.hint("rebalance", "day").write.mode("overwrite").option("header", True).option("partitionOverwriteMode", "dynamic").partitionBy("day").csv(path))


def write_hourly_csv(cube: DataFrame, path: str) -> None:
    """The hourly cube as CSV by date, hours as ISO text."""
    _csv_by_date(cube, path, "datetime_utc", "yyyy-MM-dd'T'HH:mm:ss")


def write_cube_csv(cube: DataFrame, path: str) -> None:
    """The daily safety cube as CSV by date."""
    _csv_by_date(cube, path, "date", "yyyy-MM-dd")


def write_features(cells: DataFrame, path: str, *, properties: list[str], rings: str = "rings") -> None:
    geojson_features(cells, properties=properties, rings=rings).select("feature").write.mode("overwrite").text(path)


def write_zips(zips: DataFrame, path: str) -> None:
    """ZIP table as CSV and as feature rows."""
    write_csv(zips.select("zip_code", "state", "po_name", "region_code", "centroid_lon", "centroid_lat"), f"{path}/csv")
    write_features(zips, f"{path}/geojson", properties=["zip_code", "state", "po_name", "region_code", "source"])


def write_registry(registry: DataFrame, path: str) -> None:
    write_csv(registry, path)


def run_label(region: str, weather_year: int | None, at: dt.datetime) -> str:
    return f"{region}__{weather_year or 'normal'}__{at:%Y%m%dT%H%M}"


def run_manifest(outputs: DataFrame, *, region: str, mode: str, start: str | None = None, end: str | None = None,
                 timings: dict[str, float] | None = None) -> DataFrame:
    """One JSON row that describes a run. `outputs(file)` lists what one run wrote, a handful of paths."""
    t = timings or {}
    head = outputs.agg(F.array_sort(F.collect_list("file")).alias("files"))
    body = F.struct(F.lit(region).alias("region"), F.lit(mode).alias("mode"), F.lit(start).alias("start_date"),
                    F.lit(end).alias("end_date"), F.lit(PIPELINE_VERSION).alias("pipeline_version"),
                    F.lit(PRISM_PERIOD).alias("prism_period"), "files",
                    F.struct(*[F.lit(float(v)).alias(k) for k, v in t.items()] or [F.lit(0).alias("steps")]).alias("timings"))
    return head.select(F.to_json(body).alias("manifest"))


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of every file under a path, each file hashed where it is read."""
    return spark.read.format("binaryFile").load(path).select(
        F.element_at(F.split("path", "/"), -1).alias("source"), F.sha2("content", 256).alias("sha256"), "length")


def manifest_stale(current: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Per source whether its stored hash is outdated. Without a manifest everything is stale; a
    source that no longer exists is skipped."""
    if stored is None:
        return current.select("source", F.lit(True).alias("stale"))
    old = stored.select("source", F.col("sha256").alias("_old"))
    return current.join(old, "source", "left").select(
        "source", F.coalesce(F.col("sha256") != F.col("_old"), F.lit(True)).alias("stale"))


def manifest_verify(stored: DataFrame, current: DataFrame) -> DataFrame:
    """Per stored source: present now, and unchanged."""
    now = current.select("source", F.col("sha256").alias("_now"))
    return stored.join(now, "source", "left").select(
        "source", F.col("_now").isNotNull().alias("present"),
        F.coalesce(F.col("sha256") == F.col("_now"), F.lit(False)).alias("matches"))
