"""Ingest: typed, cleaned tables from Parquet and CSV."""

from __future__ import annotations

import datetime as dt
import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import air, surface
from ..functions.cols import floor_zero_or_null, nan_to_null, zfill5
from ..operators.geometry import line_length
from ..types import (BILLING_SCHEMA, CENTROID_SCHEMA, EARLIEST_ANALYSIS_DATE, GB_PER_HOUR, MONTH_DAYS,
                     REGISTRY_SCHEMA, STATIONS, WEATHER_SCHEMA, require_columns)


def dem_ingest(px: DataFrame, *, nodata: float | Column | None = None, value: str = "value") -> DataFrame:
    """Elevation as double; exactly the declared nodata value becomes missing."""
    v = F.col(value).cast("double")
    if nodata is not None:
        v = F.when(v != (nodata if isinstance(nodata, Column) else F.lit(float(nodata))), v)
    return px.withColumn(value, nan_to_null(v))


def impervious_ingest(px: DataFrame, *, value: str = "value") -> DataFrame:
    return px.withColumn(value, surface.impervious_clean(value))


def wind_ingest(px: DataFrame, *, nodata: float | None = None, value: str = "value") -> DataFrame:
    return dem_ingest(px, nodata=nodata, value=value).withColumn(value, air.wind_power_law(value))


def lst_ingest(px: DataFrame | None, *, value: str = "value") -> DataFrame | None:
    """Surface temperature in Celsius; without a source there is no calibration."""
    return None if px is None else px.withColumn(value, surface.lst_celsius(F.col(value).cast("double")))


def month_days(month: Column | str) -> Column:
    """Days per month, February always 28."""
    return F.element_at(F.array(*map(F.lit, MONTH_DAYS)), F.col(month).cast("int") if isinstance(month, str) else month)


def require_months(months: DataFrame, month: str = "month") -> None:
    present = {r[0] for r in months.select(F.col(month).cast("int").alias("m")).where("m between 1 and 12").distinct().collect()}
    absent = sorted(set(range(1, 13)) - present)
    if absent:
        raise ValueError(f"missing months: {absent}")


def hdd_monthly(temps: DataFrame, *, temp_c: str = "temp_c", check: bool = True) -> DataFrame:
    """Monthly HDD grids from monthly mean temperature: max(0, 65 - F) * days."""
    if check:
        require_months(temps)
    f = F.col(temp_c) * 9.0 / 5.0 + 32.0
    return temps.withColumn("hdd", floor_zero_or_null(65.0 - f) * month_days("month"))


def hdd_annual(temps: DataFrame, *, keys: tuple[str, ...] = ("grid_id", "row", "col"), check: bool = True) -> DataFrame:
    """Annual HDD grid: the sum over twelve months, missing if any month is."""
    m = hdd_monthly(temps, check=check)
    return m.groupBy(*keys).agg(F.when(F.count("hdd") == 12, F.sum("hdd")).alias("hdd"))


def csv_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with header, matched by column name and typed explicitly; ZIP codes stay text.

    A file that holds only a header gives an empty table; `df.isEmpty()` tells.
    """
    raw = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    cols = [part.split() for part in schema.split(", ")]
    return raw.select(*[
        (F.expr(f"try_cast(`{n}` as {t})") if n in raw.columns else F.lit(None).cast(t)).alias(n) for n, t in cols])


def zip_centroids(spark: SparkSession, path: str) -> DataFrame:
    return csv_table(spark, path, CENTROID_SCHEMA).withColumn("zip_code", zfill5("zip_code"))


def registry(spark: SparkSession, path: str) -> DataFrame:
    return csv_table(spark, path, REGISTRY_SCHEMA).withColumn("zip_code", zfill5("zip_code"))


def weather_year(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("header", True).csv(path)
    require_columns(raw, ["station_code", "actual_hdd"])
    return csv_table(spark, path, WEATHER_SCHEMA)


def billing(spark: SparkSession, path: str) -> DataFrame | None:
    """Billing reference, or None if the file or its columns are absent (the check is skipped)."""
    if _csv_if_present(spark, path, ["zip_code", "therms_per_customer"]) is None:
        return None
    return csv_table(spark, path, BILLING_SCHEMA)


def terrain_table(spark: SparkSession, path: str) -> DataFrame:
    """A written terrain table as lookup: text keys, everything else double where it is numeric."""
    raw = spark.read.option("header", True).csv(path)
    text = {"microclimate_id", "zip_code", "cell_id", "cell_type", "base_station", "terrain_position", "region_code",
            "run_date", "pipeline_version", "prism_period"}
    return raw.select(*[F.col(k) if k in text else F.expr(f"try_cast(`{k}` as double)").alias(k) for k in raw.columns])


def _csv_if_present(spark: SparkSession, path: str, need: list[str]) -> DataFrame | None:
    """The CSV as text columns, or None if the file or a needed column is absent."""
    try:
        raw = spark.read.option("header", True).csv(path)
    except AnalysisException as e:  # raised while planning, before anything is read
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    return raw if set(need) <= set(raw.columns) else None


def station_observations(spark: SparkSession, folder: str) -> DataFrame:
    """Readings of all known stations, one CSV (or folder of CSVs) per station, named by it.

    A missing file or column gives a warning and is skipped. The loop runs over the fixed stations
    and only plans; Spark reads the files.
    """
    out = spark.createDataFrame([], "station_id string, ts timestamp, wind_speed_set_1 string")
    for s, *_ in STATIONS:
        raw = _csv_if_present(spark, f"{folder}/{s}.csv", ["date_time", "wind_speed_set_1"])
        if raw is None:
            warnings.warn(f"no usable wind readings for {s}", stacklevel=2)
            continue
        out = out.unionByName(raw.select(F.lit(s).alias("station_id"), F.expr("try_cast(date_time as timestamp)").alias("ts"),
                                         "wind_speed_set_1"))
    return out


def road_heat_flux(*sources: DataFrame) -> DataFrame:
    """Road segments of all states with traffic, their length and heat flux per area."""
    roads = None
    for df in sources:
        require_columns(df, ["road_id", "aadt", "pts"])
        roads = df if roads is None else roads.unionByName(df, allowMissingColumns=True)
    return (roads.where("aadt > 0").withColumn("length_m", line_length(F.col("pts")))
            .withColumn("heat_flux_wm2", (F.col("aadt") / 86400.0) * 150000.0
                        / F.nullif(F.col("length_m") * 3.7, F.lit(0.0))))


HOUR_ALIASES = {  # accepted names of each hourly field (fixed values)
    "t2m_k": ["t2m_k", "TMP_2maboveground", "t2m"], "u10": ["u10", "u10m", "UGRD_10maboveground"],
    "v10": ["v10", "v10m", "VGRD_10maboveground"], "sp_pa": ["sp_pa", "PRES_surface", "sp"]}


def check_date_range(start: str, end: str) -> tuple[dt.date, dt.date]:
    a, b = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    if a < dt.date.fromisoformat(EARLIEST_ANALYSIS_DATE):
        raise ValueError(f"start {start} is before {EARLIEST_ANALYSIS_DATE}")
    if b < a:
        raise ValueError(f"end {end} is before start {start}")
    return a, b


def expand_month(month: str) -> tuple[str, str]:
    """'YYYY-MM' -> first and last day."""
    first = dt.date.fromisoformat(f"{month}-01")
    last = (first.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
    return first.isoformat(), last.isoformat()


def month_bounds(df: DataFrame, date: str = "date") -> DataFrame:
    return df.withColumn("month_start", F.trunc(date, "MM")).withColumn("month_end", F.last_day(date))


def canonical_hour(df: DataFrame) -> DataFrame:
    """Resolve alternative field names to one set."""
    for name, options in HOUR_ALIASES.items():
        have = [k for k in options if k in df.columns]
        if have:
            df = df.withColumn(name, F.coalesce(*have).cast("double")).drop(*[k for k in have if k != name])
    if "sp_pa" in df.columns and "sp_mb" not in df.columns:  # the plans take surface pressure in millibars
        df = df.withColumn("sp_mb", F.col("sp_pa") / 100.0)
    return df


LEVEL_ALIASES = {  # accepted names of each pressure-level field (fixed values)
    "level_mb": ["level_mb", "level", "isobaricInhPa", "pressure_level"], "t_k": ["t_k", "t", "TMP"],
    "u": ["u", "UGRD", "u_ms"], "v": ["v", "VGRD", "v_ms"]}


def canonical_levels(df: DataFrame) -> DataFrame:
    """Pressure-level rows (ts, place, level_mb, t_k, u, v) whatever their source calls the fields."""
    for name, options in LEVEL_ALIASES.items():
        have = [k for k in options if k in df.columns]
        if not have:
            raise ValueError(f"no {name} among {options}")
        df = df.withColumn(name, F.coalesce(*[F.col(k).cast("double") for k in have])).drop(*[k for k in have if k != name])
    return df.withColumn("level_mb", F.col("level_mb").cast("int"))


def hourly_scan(hourly: DataFrame, start: str, end: str, *, require: bool = True) -> DataFrame:
    """Hours from the first hour of `start` to the last hour of `end`, both days whole.

    The bounds are plain comparisons on `ts` (and on `date` where the table is partitioned by it),
    so partitions and row groups outside the range are never read.
    """
    a, b = check_date_range(start, end)
    out = hourly
    if "date" in hourly.columns:
        out = out.where(F.col("date").between(F.lit(a), F.lit(b)))
    lo, hi = F.lit(a.isoformat()).cast("timestamp"), F.lit((b + dt.timedelta(days=1)).isoformat()).cast("timestamp")
    out = canonical_hour(out.where((F.col("ts") >= lo) & (F.col("ts") < hi)))
    if require and out.isEmpty():
        raise ValueError(f"no hours between {start} and {end}")
    return out


def expected_hours(spark: SparkSession, start: str, end: str) -> DataFrame:
    a, b = check_date_range(start, end)
    return spark.sql(f"select explode(sequence(timestamp'{a} 00:00:00', timestamp'{b} 23:00:00', interval 1 hour)) as ts")


def missing_hours(expected: DataFrame, manifest: DataFrame) -> DataFrame:
    """Expected hours that the manifest does not list as cached, with their estimated volume."""
    cached = manifest.where(F.col("status") == "cached").select(F.try_to_timestamp("datetime_utc").alias("ts"))
    return expected.join(cached, "ts", "left_anti").withColumn("estimated_gb", F.lit(GB_PER_HOUR))


def manifest_upsert(manifest: DataFrame, updates: DataFrame, *, seq: str = "seq") -> DataFrame:
    """Latest entry per hour. The newest row is an aggregate, so repeated hours combine before the shuffle."""
    both = manifest.unionByName(updates, allowMissingColumns=True)
    rest = [k for k in both.columns if k != "datetime_utc"]
    newest = both.groupBy("datetime_utc").agg(F.max_by(F.struct(*rest), seq).alias("r"))
    return newest.select("datetime_utc", "r.*")


ZIP_ALIASES = ["zip_code", "ZIPCODE", "code", "ZCTA5CE20", "ZCTA5CE23"]


def zip_normalize(df: DataFrame, source: str) -> DataFrame:
    """One ZIP column whatever the source calls it, padded to five digits, with its source."""
    have = [k for k in ZIP_ALIASES if k in df.columns]
    if not have:
        raise ValueError(f"no ZIP column among {ZIP_ALIASES}")
    return (df.withColumn("_z", zfill5(F.coalesce(*have))).drop(*have).withColumnRenamed("_z", "zip_code")
            .withColumn("source", F.lit(source)))

