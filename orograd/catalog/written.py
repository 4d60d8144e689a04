"""Catalogue: what is written and read back, stored sketches, and checks that find planted faults."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality, registry, sketches, stations, zonal
from ..session import scratch_folder
from ..sources import sinks, tables
from ..streaming import cycles
from . import hourly as h
from . import views as v
from .base import cte, query, table
from .rasters import obs
from .zips import actual


@query("csv_centroids", "SELECT zip_code, state, 'R' || CAST(s_suppkey % 5 AS VARCHAR) AS region_code, centroid_lon, centroid_lat FROM centroids", use="centroids", doubles="centroid_lon centroid_lat")
def _(spark, d):
    out = scratch_folder(spark, "centroids")
    zips = v.centroids(spark, d).select("zip_code", "state", F.lit("").alias("po_name"), F.concat(F.lit("R"), (F.col("s_suppkey") % 5).cast("string")).alias("region_code"),
                                        "centroid_lon", "centroid_lat", F.array(v._ring([(F.col("centroid_lon"), F.col("centroid_lat"))])).alias("rings"), F.lit("x").alias("source"))
    sinks.write_zips(zips, out)
    return tables.zip_centroids(spark, f"{out}/csv").select("zip_code", "state", "region_code", "centroid_lon", "centroid_lat")


@query("csv_features", "SELECT zip_code, state FROM centroids", use="centroids")
def _(spark, d):
    out = scratch_folder(spark, "features")
    zips = v.centroids(spark, d).withColumns({"po_name": F.lit("p"), "region_code": F.lit("R"), "source": F.lit("x"), "rings": F.array(v._ring([(F.lit(0.0), F.lit(0.0)), (F.lit(1.0), F.lit(0.0)), (F.lit(1.0), F.lit(1.0))]))})
    sinks.write_zips(zips, out)
    made = spark.read.text(f"{out}/geojson")
    return made.select(*[F.get_json_object("value", f"$.properties.{k}").alias(k) for k in ("zip_code", "state")])


@query("csv_registry", "SELECT zip_code, region_code, region_name, base_station, lidar_vintage FROM registry WHERE region_name = 'region_1'", use="registry")
def _(spark, d):
    out = scratch_folder(spark, "registry")
    sinks.write_registry(v.registry(spark, d), out)
    return registry.find_region(tables.registry(spark, out), "region_1").select("zip_code", "region_code", "region_name", "base_station", "lidar_vintage")


@query("csv_weather_year", "SELECT * FROM actual", use="actual", doubles="actual_hdd")
def _(spark, d):
    out = scratch_folder(spark, "weather")
    sinks.write_csv(actual(spark, d), out)
    return tables.weather_year(spark, out)


@query("csv_billing", "SELECT * FROM billing", use="billing", doubles="therms_per_customer")
def _(spark, d):
    out = scratch_folder(spark, "billing")
    sinks.write_csv(v.billing(spark, d), out)
    return tables.billing(spark, out)


@query("csv_terrain", "SELECT zip_code, cell_id, terrain_position, effective_hdd FROM cells UNION ALL SELECT zip_code, 'aggregate', arg_min(terrain_position, cell_id), avg(effective_hdd) FROM cells GROUP BY zip_code",
       use="cells", doubles="effective_hdd")
def _(spark, d):
    out = scratch_folder(spark, "terrain")
    cells = v.cells(spark, d, with_bounds=False).withColumn("cell_area_sqm", F.lit(250000.0))
    sinks.write_terrain(cells, out, region_code="R1", run_date="2024-02-01")
    return tables.terrain_table(spark, out).select("zip_code", "cell_id", "terrain_position", "effective_hdd")


@query("csv_station_wind", "SELECT station_id, mean_wind_ms, num_obs FROM station_mean", use="station_mean", doubles="mean_wind_ms")
def _(spark, d):
    out, readings = scratch_folder(spark, "readings"), obs(spark, d)
    for s in v.IDS:  # a file per fixed station, as the source has them
        readings.where(F.col("station_id") == s).select(F.col("ts").alias("date_time"), "wind_speed_set_1").write.option("header", True).csv(f"{out}/{s}.csv")
    return stations.station_wind(tables.station_observations(spark, out), with_p90=False)


DAY = "date zip_code daily_effective_hdd adjusted_temp_f".split()


@query("written_daily", "SELECT strftime(date, '%Y-%m-%d') AS date, zip_code, daily_effective_hdd, k.kind FROM daily, (VALUES ('csv'), ('parquet')) k(kind)", use="daily", doubles="daily_effective_hdd")
def _(spark, d):
    out = scratch_folder(spark, "daily")
    sinks.write_daily(h.daily(spark, d)[0].select(*DAY), out, output_format="both")
    csv = spark.read.option("header", True).csv(f"{out}/csv").withColumn("daily_effective_hdd", F.col("daily_effective_hdd").cast("double"))
    both = csv.withColumn("kind", F.lit("csv")).unionByName(spark.read.parquet(f"{out}/parquet").withColumn("kind", F.lit("parquet")), allowMissingColumns=True)
    return both.select("date", "zip_code", "daily_effective_hdd", "kind")


HOUR = "datetime_utc zip_code altitude_ft hourly_hdd".split()


@query("written_hourly", "SELECT datetime_utc, zip_code, altitude_ft, hourly_hdd FROM hcube", use="hcube", doubles="hourly_hdd")
def _(spark, d):
    out = scratch_folder(spark, "hourly")
    sinks.write_hourly(h.hcube(spark, d), out)
    return spark.read.parquet(out).select(*HOUR)


@query("written_hourly_csv", "SELECT strftime(datetime_utc, '%Y-%m-%dT%H:%M:%S') AS datetime_utc, zip_code, altitude_ft, hourly_hdd FROM hcube", use="hcube", doubles="hourly_hdd")
def _(spark, d):
    out = scratch_folder(spark, "hourly-csv")
    sinks.write_hourly_csv(h.hcube(spark, d), out)
    return spark.read.option("header", True).csv(out).select("datetime_utc", "zip_code", F.col("altitude_ft").cast("int"), F.col("hourly_hdd").cast("double"))


@query("written_cube", "SELECT date, zip_code, altitude_ft, temp_adjusted_f FROM cube", use="cube", doubles="temp_adjusted_f")
def _(spark, d):
    out = scratch_folder(spark, "cube")
    sinks.write_cube(h.daily(spark, d)[1], out)
    return spark.read.parquet(out).select("date", "zip_code", "altitude_ft", "temp_adjusted_f")


@query("written_cube_csv", "SELECT strftime(date, '%Y-%m-%d') AS date, zip_code, altitude_ft, temp_adjusted_f FROM cube", use="cube", doubles="temp_adjusted_f")
def _(spark, d):
    out = scratch_folder(spark, "cube-csv")
    sinks.write_cube_csv(h.daily(spark, d)[1], out)
    return spark.read.option("header", True).csv(out).select("date", "zip_code", F.col("altitude_ft").cast("int"), F.col("temp_adjusted_f").cast("double"))


@query("file_hashes", "SELECT sha256(c_name || chr(10)) AS sha256, CAST(strlen(c_name) + 1 AS BIGINT) AS length FROM customer WHERE c_custkey <= 40")
def _(spark, d):
    out = scratch_folder(spark, "files")
    names = table(spark, d, "customer").where("c_custkey <= 40").select("c_custkey", F.col("c_name").alias("value"))   # a few files: hashing files is the feature
    names.write.partitionBy("c_custkey").text(out)
    return sinks.file_hashes(spark, f"{out}/*/*.txt").select("sha256", "length")


@query("neutral_bands", "SELECT zip_code, cell_id, hdd_terrain_mult, 1.0::DOUBLE AS wind_infiltration_mult, 1.0::DOUBLE AS cold_air_mult, 0.0::DOUBLE AS road_heat_flux_wm2 FROM cells",
       use="cells", doubles="hdd_terrain_mult")
def _(spark, d):
    full = zonal.with_bands(v.cells(spark, d, with_bounds=False), ["hdd_terrain_mult", "wind_infiltration_mult", "cold_air_mult", "road_heat_flux_wm2"])
    return full.select("zip_code", "cell_id", "hdd_terrain_mult", "wind_infiltration_mult", "cold_air_mult", "road_heat_flux_wm2")


@query("st_written_cycles", "SELECT datetime_utc, zip_code, altitude_ft, count(*) AS n FROM rcube GROUP BY ALL", use="rcube")
def _(spark, d):
    out, hours = scratch_folder(spark, "cycles"), v.raw_hours(spark, d)
    hours.write.parquet(f"{out}/in")
    stream = cycles.cycle_cube_stream(cycles.cycle_source(spark, f"{out}/in", hours.schema), v.terrain(spark, d))
    cycles.write_cycles(stream, f"{out}/out", f"{out}/state", once=True).awaitTermination()
    return spark.read.parquet(f"{out}/out").groupBy("datetime_utc", "zip_code", "altitude_ft").agg(F.count(F.lit(1)).alias("n"))


# sketches per station and day, merged over all days: counts are exact, quantiles lie within the sketch's bound of the rank
@query("wind_sketches", "SELECT station_id, num_obs AS num_values, true AS within FROM station_mean", use="station_mean")
def _(spark, d):
    w = obs(spark, d).select("station_id", F.to_date("ts").alias("date"), F.expr("try_cast(wind_speed_set_1 as double)").alias("v")).where("v is not null")
    stored = scratch_folder(spark, "sketches")
    sketches.quantile_sketches(w, "v", keys=("station_id", "date")).write.parquet(stored)
    q = sketches.merged_quantiles(spark.read.parquet(stored), {"p50": 0.5, "p90": 0.9}, keys=("station_id",))
    share = [F.avg((F.col("v") <= F.col(k)).cast("double")).alias(f"r{k}") for k in ("p50", "p90")]
    below = [F.avg((F.col("v") < F.col(k)).cast("double")).alias(f"b{k}") for k in ("p50", "p90")]
    ranks = w.join(q, "station_id").groupBy("station_id", "num_values").agg(*share, *below)
    off = 2 * sketches.rank_error()
    ok = (F.col("bp50") <= 0.5 + off) & (F.col("rp50") >= 0.5 - off) & (F.col("bp90") <= 0.9 + off) & (F.col("rp90") >= 0.9 - off)
    return ranks.select("station_id", "num_values", ok.alias("within"))


# faults planted by the ZIP's last digit
cte("bad_daily", """SELECT * REPLACE (CASE WHEN zip_code LIKE '%3' THEN -daily_effective_hdd - 1 WHEN zip_code LIKE '%4' THEN 20000.0::DOUBLE WHEN zip_code LIKE '%5' THEN NULL ELSE daily_effective_hdd END AS daily_effective_hdd,
    CASE WHEN zip_code LIKE '%6' THEN 200.0::DOUBLE ELSE adjusted_temp_f END AS adjusted_temp_f) FROM daily""", "daily")


@query("daily_validate_planted", h._findings(
    ("warning", "missing values in daily_effective_hdd", "bad_daily", "daily_effective_hdd IS NULL"), ("error", "negative daily_effective_hdd", "bad_daily", "daily_effective_hdd < 0"),
    ("warning", "very high daily_effective_hdd", "bad_daily", "daily_effective_hdd > 10000"), ("warning", "unusual surface temperature", "bad_daily", "adjusted_temp_f < -50 OR adjusted_temp_f > 120"),
    *[("warning", f"unusual temperature at {a} ft", "bad_daily", f"temp_{a}ft_adjusted_f < -80 OR temp_{a}ft_adjusted_f > 100") for a in (3000, 6000, 9000, 12000, 18000)]), use="bad_daily")
def _(spark, d):
    z, hdd = F.col("zip_code"), F.col("daily_effective_hdd")
    day = h.daily(spark, d)[0]
    day = day.withColumn("daily_effective_hdd", F.when(z.endswith("3"), -hdd - 1).when(z.endswith("4"), 20000.0).when(z.endswith("5"), F.lit(None)).otherwise(hdd))
    return quality.daily_validate(day.withColumn("adjusted_temp_f", F.when(z.endswith("6"), 200.0).otherwise(F.col("adjusted_temp_f"))))


BAD = """SELECT * REPLACE (CASE WHEN zip_code LIKE '%3' THEN -90.0::DOUBLE ELSE temp_adjusted_f END AS temp_adjusted_f, CASE WHEN zip_code LIKE '%4' THEN 300.0::DOUBLE ELSE wind_speed_kt END AS wind_speed_kt)
    FROM {} WHERE NOT (zip_code LIKE '%7' AND altitude_ft = 500)"""
cte("bad_cube", BAD.format("cube"), "cube")
cte("bad_rcube", BAD.format("rcube"), "rcube")


def _spoilt(cube):
    z = F.col("zip_code")
    return (cube.withColumn("temp_adjusted_f", F.when(z.endswith("3"), -90.0).otherwise(F.col("temp_adjusted_f")))
            .withColumn("wind_speed_kt", F.when(z.endswith("4"), 300.0).otherwise(F.col("wind_speed_kt"))).where(~(z.endswith("7") & (F.col("altitude_ft") == 500))))


@query("cube_validate_planted", h._findings(
    ("warning", "unusual temperature", "bad_cube", "temp_adjusted_f < -80 OR temp_adjusted_f > 120"), ("warning", "very high wind", "bad_cube", "wind_speed_kt > 200"),
    ("warning", "very high TKE", "bad_cube", "tke_m2s2 > 10"),
    ("warning", "not 8 altitudes per ZIP and date", "(SELECT date, zip_code, count(DISTINCT altitude_ft) AS n FROM bad_cube GROUP BY 1, 2)", "n <> 8")), use="bad_cube")
def _(spark, d):
    return quality.cube_validate(_spoilt(h.daily(spark, d)[1]))


@query("st_validate_planted", h._findings(("warning", "unusual temperature", "bad_rcube", "temp_adjusted_f < -80 OR temp_adjusted_f > 120")), use="bad_rcube")
def _(spark, d):
    out, hours = scratch_folder(spark, "spoilt"), v.raw_hours(spark, d)
    hours.write.parquet(f"{out}/in")
    stream = _spoilt(cycles.cycle_cube_stream(cycles.cycle_source(spark, f"{out}/in", hours.schema), v.terrain(spark, d)))
    cycles.write_cycles(stream, f"{out}/out", f"{out}/state", once=True).awaitTermination()
    return cycles.validate_stream(spark.read.parquet(f"{out}/out"))
