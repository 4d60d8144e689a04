"""Daily rows and ZIP x time x altitude cubes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import air, degree_days
from ..functions.cols import c, kelvin_to_f, ms_to_kt
from ..types import ALTITUDES_FT
from .zonal import with_default

UPPER_FT = [a for a in ALTITUDES_FT if a > 0]
# neutral values of absent terrain columns (fixed values)
TERRAIN_DEFAULTS = {"hdd_terrain_mult": 1.0, "hdd_elev_addition": 0.0, "hdd_uhi_reduction": 0.0,
                    "hdd_traffic_reduction": 0.0, "z0_m": 0.1, "wind_shear_correction_sfc_kt": 0.0, "albedo": 0.15, "emissivity": 0.95,
                    "roughness_transition": 0.0, "nlcd_class": 0.0}


def zip_terrain(terrain: DataFrame) -> DataFrame:
    """The aggregate row of each ZIP, with neutral values for absent columns."""
    t = terrain.where(F.col("cell_id") == "aggregate") if "cell_id" in terrain.columns else terrain
    for name, value in TERRAIN_DEFAULTS.items():
        t = with_default(t, name, value).withColumn(name, F.coalesce(F.col(name).cast("double"), F.lit(value)))
    return t.select("zip_code", *TERRAIN_DEFAULTS)


def profile_wide(profile: DataFrame, *, keys: tuple[str, ...] = ("zip_code", "date")) -> DataFrame:
    """One row per key; columns temp_/wind_speed_/wind_dir_/hdd_ per altitude, `sfc` at 0 ft."""
    aggs = []
    for a in ALTITUDES_FT:
        at = F.col("altitude_ft") == a
        tag = "sfc" if a == 0 else f"{a}ft"
        names = {"temp_adjusted_f": f"temp_{tag}_adjusted_f", "wind_speed_kt": f"wind_speed_{tag}_kt",
                 "wind_dir_deg": f"wind_dir_{tag}_deg", "hdd": f"hdd_{tag}", "temp_raw_f": f"temp_{tag}_raw_f"}
        aggs += [F.first(F.when(at, F.col(k)), ignorenulls=True).alias(v)
                 for k, v in names.items() if k in profile.columns]
    return profile.groupBy(*keys).agg(*aggs)


def daily_combine(adjusted: DataFrame, profiles: DataFrame, terrain: DataFrame, *, apply_bl: bool = False) -> DataFrame:
    """Daily rows per ZIP: effective HDD of the day, altitude columns, surface properties.

    `adjusted(date, zip_code, temp_f, bias_f, adjusted_f)`; `profiles(date, zip_code, altitude_ft,
    wind_speed_ms, wind_direction_deg, temperature_f)`. ZIPs without a terrain row are skipped.
    """
    prof = profiles.join(adjusted.select("date", "zip_code", "bias_f"), ["date", "zip_code"])
    prof = (prof.withColumn("temp_raw_f", F.col("temperature_f"))
            .withColumn("temp_adjusted_f", F.col("temperature_f") + F.col("bias_f"))
            .withColumn("wind_speed_kt", ms_to_kt("wind_speed_ms"))
            .withColumn("wind_dir_deg", F.col("wind_direction_deg"))
            .withColumn("hdd", degree_days.altitude_hdd("temp_adjusted_f")))
    wide = profile_wide(prof, keys=("date", "zip_code")).drop("temp_sfc_adjusted_f", "temp_sfc_raw_f", "hdd_sfc")
    day = (adjusted.join(zip_terrain(terrain), "zip_code")
           .withColumn("raw_temp_f", F.col("temp_f")).withColumn("adjusted_temp_f", F.col("adjusted_f"))
           .withColumn("daily_effective_hdd", degree_days.daily_effective_hdd(
               "adjusted_temp_f", "hdd_terrain_mult", "hdd_elev_addition", "hdd_uhi_reduction",
               "hdd_traffic_reduction"))
           .withColumn("hdd_sfc", degree_days.altitude_hdd("adjusted_temp_f"))
           .drop("temp_f", "adjusted_f"))
    out = day.join(wide, ["date", "zip_code"], "left")
    cooled, shear = F.col("adjusted_temp_f"), F.lit(0.0)
    if apply_bl:
        cooled, shear = air.boundary_layer("adjusted_temp_f", F.col("wind_speed_sfc_kt") / 1.94384, 0.0, "z0_m", 0.03,
                                           F.col("nlcd_class") == 11)
    return (out.withColumn("wind_shear_correction_sfc_kt", shear)
            .withColumn("thermal_correction_sfc_f", cooled - F.col("adjusted_temp_f")))


def _cube_columns(df: DataFrame, pressure_mb: float) -> DataFrame:
    return (df.withColumn("tke_m2s2", air.tke(F.col("wind_speed_kt") / 1.94384, "z0_m"))
            .withColumn("density_altitude_ft", air.density_altitude("temp_adjusted_f", pressure_mb))
            .withColumn("turbulence_flag", air.turbulence("tke_m2s2")))


def cube_unpivot(daily: DataFrame) -> DataFrame:
    """Wide daily rows to one row per altitude; levels without temperature or wind are dropped."""
    def level(a: int):
        tag = "sfc" if a == 0 else f"{a}ft"
        temp = "adjusted_temp_f" if a == 0 else f"temp_{tag}_adjusted_f"
        names = {"temp_adjusted_f": temp, "wind_speed_kt": f"wind_speed_{tag}_kt",
                 "wind_dir_deg": f"wind_dir_{tag}_deg", "hdd": f"hdd_{tag}"}
        if a == 0:
            names["shear_kt"] = "wind_shear_correction_sfc_kt"
        cols = [(F.col(v) if v in daily.columns else F.lit(None)).cast("double").alias(k) for k, v in names.items()]
        if a:
            cols.append(F.lit(0.0).alias("shear_kt"))
        return F.struct(F.lit(a).alias("altitude_ft"), *cols)

    keep = ["date", "zip_code"] + [k for k in ("z0_m", "region_code") if k in daily.columns]
    return (daily.select(*keep, F.explode(F.array(*[level(a) for a in ALTITUDES_FT])).alias("lv"))
            .select(*keep, "lv.*").where("temp_adjusted_f is not null and wind_speed_kt is not null"))


def safety_cube(daily: DataFrame, *, pressure_mb: float = 1013.25) -> DataFrame:
    """Turbulence, density altitude and shear per ZIP, date and altitude."""
    long = cube_unpivot(daily)
    long = with_default(long, "z0_m", 0.1).withColumn("z0_m", F.coalesce("z0_m", F.lit(0.1)))
    out = _cube_columns(long, pressure_mb).withColumn(
        "wind_shear_kt_per_100ft", air.shear_per_100ft("shear_kt", "altitude_ft"))
    return out.select("date", "zip_code", "altitude_ft", "temp_adjusted_f", "wind_speed_kt", "wind_dir_deg",
                      "tke_m2s2", "wind_shear_kt_per_100ft", "hdd", "density_altitude_ft", "turbulence_flag")


def hourly_profile(df: DataFrame) -> DataFrame:
    """Altitude rows by the fixed lapse rate and wind growth, from surface temp_f, speed and bearing."""
    k = F.col("altitude_ft") / 1000.0
    return (df.withColumn("altitude_ft", F.explode(F.array(*[F.lit(a) for a in ALTITUDES_FT])))
            .withColumn("temp_adjusted_f", F.col("temp_f") - k * 3.5)
            .withColumn("wind_speed_kt", F.col("wind_speed_kt") * (1.0 + 0.1 * k)))


def hourly_cube(hourly: DataFrame, terrain: DataFrame, *, bias: float | str = 0.0, pressure_mb: float = 1013.25,
                profiles: DataFrame | None = None) -> DataFrame:
    """ZIP x hour x altitude cube from `hourly(ts, zip_code, t2m_k, u10, v10)`.

    Altitude levels come from an array per row, so nothing is shuffled but the terrain lookup.
    Given `profiles` (pressure-level interpolation), they replace the fixed lapse rate.
    """
    base = hourly.join(zip_terrain(terrain), "zip_code")
    if profiles is None:
        lv = hourly_profile(
            base.withColumn("temp_f", kelvin_to_f("t2m_k") + c(bias))
            .withColumn("u10", F.coalesce("u10", F.lit(0.0))).withColumn("v10", F.coalesce("v10", F.lit(0.0)))
            .withColumn("wind_speed_kt", ms_to_kt(air.wind_speed("u10", "v10")))
            .withColumn("wind_dir_deg", air.wind_direction("u10", "v10")))
    else:
        lv = (base.join(profiles, ["ts", "zip_code"])
              .withColumn("temp_adjusted_f", F.col("temperature_f") + c(bias))
              .withColumn("wind_speed_kt", ms_to_kt("wind_speed_ms"))
              .withColumn("wind_dir_deg", F.col("wind_direction_deg")))
    shear = F.when(F.col("altitude_ft") > 1000, 0.0).otherwise(F.col("wind_shear_correction_sfc_kt"))
    out = (_cube_columns(lv, pressure_mb).withColumn("hourly_hdd", degree_days.hourly_hdd("temp_adjusted_f"))
           .withColumn("wind_shear_kt_per_100ft", air.shear_per_100ft(shear, "altitude_ft")))
    return out.select(F.col("ts").alias("datetime_utc"), "zip_code", "altitude_ft", "temp_adjusted_f",
                      "wind_speed_kt", "wind_dir_deg", "tke_m2s2", "wind_shear_kt_per_100ft", "hourly_hdd",
                      "density_altitude_ft", "turbulence_flag")


def hourly_to_daily_hdd(cube: DataFrame) -> DataFrame:
    """Sum of hourly HDD per day, ZIP and altitude."""
    return (cube.groupBy(F.to_date("datetime_utc").alias("date"), "zip_code", "altitude_ft")
            .agg(F.sum("hourly_hdd").alias("daily_hdd"), F.count(F.lit(1)).alias("num_hours")))
