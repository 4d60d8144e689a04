"""Cell and ZIP summaries: zonal means, effective degree days, aggregate rows, weather years."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import degree_days as dd
from ..functions.cols import zfill5
from ..types import HDD_PER_DEGREE_F, MONTHS, SIGMAS, require_columns, stations

CORRECTIONS = ["prism_annual_hdd", "hdd_terrain_mult", "hdd_elev_addition", "uhi_offset_f", "hdd_uhi_reduction",
               "road_temp_offset_f", "hdd_traffic_reduction", "wind_infiltration_mult", "mean_wind_ms",
               "mean_elevation_ft", "mean_impervious_pct", "surface_albedo", "base_cdd", "uhi_cdd_addition",
               "traffic_cdd_addition"]
METADATA = ["run_date", "pipeline_version", "lidar_vintage", "nlcd_vintage", "prism_period"]


def with_default(df: DataFrame, name: str, value) -> DataFrame:
    """Add a column with a neutral value where it is absent."""
    return df if name in df.columns else df.withColumn(name, F.lit(value))


def neutral_default(name: str) -> float:
    """What an absent band stands for: 1 for multipliers, 0 for everything else."""
    return 1.0 if "mult" in name or "infiltration" in name else 0.0


def with_bands(df: DataFrame, names: list[str]) -> DataFrame:
    """Add every absent band with its neutral value."""
    for name in names:
        df = with_default(df, name, neutral_default(name))
    return df


def cell_zonal(px: DataFrame, *, bands: list[str], keys: tuple[str, ...] = ("zip_code", "cell_id"),
               count_band: str = "prism_annual_hdd") -> DataFrame:
    """Mean of every band per cell and the number of valid base pixels.

    One aggregation with map-side combining, so a cell holding a third of all pixels still costs
    one row per task. All means are missing where no base pixel is valid.
    """
    n = F.count(count_band)
    return px.groupBy(*keys).agg(*[F.when(n > 0, F.avg(b)).alias(b) for b in bands], n.alias("num_valid_pixels"))


def with_effective_hdd(cells: DataFrame, *, with_bounds: bool = True, with_cdd: bool = False,
                       apply_stagnation: bool = False) -> DataFrame:
    """Reductions from offsets, effective HDD, and optionally the one-sigma bounds and CDD."""
    cells = with_default(cells, "cold_air_mult", 1.0)
    uhi = F.col("uhi_offset_f")
    if apply_stagnation:
        uhi = uhi * F.coalesce("stagnation_mult", F.lit(1.0))
    out = (cells.withColumn("hdd_uhi_reduction", dd.offset_to_degree_days(uhi))
           .withColumn("hdd_traffic_reduction", dd.offset_to_degree_days("road_temp_offset_f")))
    terms = ("prism_annual_hdd", "hdd_terrain_mult", "hdd_elev_addition", "hdd_uhi_reduction", "hdd_traffic_reduction")
    out = out.withColumn("effective_hdd", dd.cell_effective_hdd(*terms, "cold_air_mult"))
    if with_bounds:
        out = hdd_bounds(out)
    if with_cdd:
        out = (out.withColumn("uhi_cdd_addition", F.coalesce(uhi * HDD_PER_DEGREE_F, F.lit(0.0)))
               .withColumn("traffic_cdd_addition", dd.offset_to_degree_days("road_temp_offset_f"))
               .withColumn("effective_cdd", dd.effective_cdd(
                   "base_cdd", "hdd_terrain_mult", F.coalesce("hdd_elev_addition", F.lit(0.0)),
                   "uhi_cdd_addition", "traffic_cdd_addition")))
    return out


def hdd_bounds(df: DataFrame, *, base: str = "prism_annual_hdd", mult: str = "hdd_terrain_mult",
               elev: str = "hdd_elev_addition", uhi: str = "hdd_uhi_reduction",
               traffic: str = "hdd_traffic_reduction", sigmas: dict[str, float] = SIGMAS) -> DataFrame:
    """Add effective_hdd_low and effective_hdd_high."""
    require_columns(df, [base, mult, elev, uhi, traffic])
    low, high = dd.hdd_bounds(base, mult, elev, uhi, traffic, sigmas)
    return df.withColumn("effective_hdd_low", low).withColumn("effective_hdd_high", high)


def bounds_aggregate(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg("effective_hdd_low").alias("effective_hdd_low"),
                                 F.avg("effective_hdd_high").alias("effective_hdd_high"))


def bounds_valid(df: DataFrame, *, tolerance: float = 1e-6) -> DataFrame:
    """One row: do low <= nominal <= high hold everywhere within the tolerance?"""
    low, mid, high = (F.col(k) for k in ("effective_hdd_low", "effective_hdd", "effective_hdd_high"))
    ok = (low <= mid + tolerance) & (high >= mid - tolerance) & (low <= high + tolerance)
    return df.agg(F.coalesce(F.bool_and(F.coalesce(ok, F.lit(False))), F.lit(True)).alias("valid"))


def cell_monthly(px: DataFrame, cells: DataFrame, *, keys: tuple[str, ...] = ("zip_code", "cell_id")) -> DataFrame:
    """Monthly effective HDD per cell and their annual sum.

    `px(keys, month, base_hdd)` holds the monthly grids. The annual elevation, urban and traffic
    terms apply in full to every month. The sum skips missing months.
    """
    base = px.groupBy(*keys).pivot("month", list(range(1, 13))).agg(F.avg("base_hdd"))
    joined = cells.join(base, list(keys), "left")
    terms = ("hdd_terrain_mult", "hdd_elev_addition", "hdd_uhi_reduction", "hdd_traffic_reduction")
    names = [f"effective_hdd_{m}" for m in MONTHS]
    for i, name in enumerate(names, 1):
        joined = joined.withColumn(name, dd.cell_effective_hdd(F.col(f"`{i}`"), *terms))
    return (joined.withColumn("effective_hdd_annual", sum_present(names))
            .drop(*[str(i) for i in range(1, 13)]))


def sum_present(names: list[str]) -> Column:
    """Sum of the non-missing columns, missing only when all are."""
    total = F.lit(0.0)
    for k in names:
        total = total + F.coalesce(F.col(k), F.lit(0.0))
    return F.when(F.coalesce(*names).isNotNull(), total)


def zip_aggregate(cells: DataFrame, *, region_code: str | None = None,
                  keys: tuple[str, ...] = ("zip_code", "base_station")) -> DataFrame:
    """One aggregate row per ZIP and station.

    The region comes from a `region_code` column, or the argument where the table has none.
    """
    cells = with_default(cells, "region_code", region_code)
    keys = ("region_code", *keys)
    aggs = []
    for k in CORRECTIONS:
        if k in cells.columns:
            aggs.append(F.avg(k).alias(k))
    for kind in ("hdd", "cdd"):
        name = f"effective_{kind}"
        if name in cells.columns:
            aggs += [F.avg(name).alias(name), F.min(name).alias(f"cell_{kind}_min"),
                     F.max(name).alias(f"cell_{kind}_max"), F.stddev_samp(name).alias(f"cell_{kind}_std")]
    for k in ("effective_hdd_low", "effective_hdd_high"):
        if k in cells.columns:
            aggs.append(F.avg(k).alias(k))
    months = [f"effective_hdd_{m}" for m in MONTHS if f"effective_hdd_{m}" in cells.columns]
    aggs += [F.avg(k).alias(k) for k in months]
    aggs += [F.min_by(k, "cell_id").alias(k) for k in METADATA if k in cells.columns]
    aggs.append(F.count(F.lit(1)).alias("num_cells"))
    if "num_valid_pixels" in cells.columns:
        aggs.append(F.sum("num_valid_pixels").alias("num_valid_pixels"))
    out = cells.groupBy(*keys).agg(*aggs)
    if months:
        out = out.withColumn("effective_hdd_annual", sum_present(months))
    return out.select(
        F.concat_ws("_", "region_code", "zip_code", "base_station", F.lit("aggregate")).alias("microclimate_id"),
        F.lit("aggregate").alias("cell_id"), "*")


def with_zip_aggregates(cells: DataFrame, *, region_code: str | None = None) -> DataFrame:
    """Cell rows followed by one aggregate row per ZIP and station, in one table."""
    cells = with_default(cells, "region_code", region_code)
    named = cells.withColumn("microclimate_id", F.concat_ws(
        "_", "region_code", "zip_code", "base_station", F.lit("cell"), "cell_id"))
    return named.unionByName(zip_aggregate(cells), allowMissingColumns=True)


def zip_rollup(cells: DataFrame, *, value: str = "effective_hdd") -> DataFrame:
    """Cell and ZIP means in one pass, as grouping sets; the ZIP row is named `aggregate`."""
    g = cells.groupingSets([["zip_code", "cell_id"], ["zip_code"]], "zip_code", "cell_id").agg(
        F.avg(value).alias(value), F.count(value).alias("num_values"), F.grouping("cell_id").alias("_g"))
    return g.withColumn("cell_id", F.when(F.col("_g") == 1, "aggregate").otherwise(F.col("cell_id"))).drop("_g")


def weather_factors(actual: DataFrame) -> DataFrame:
    """Adjustment factor per known station; a station without a value is an error."""
    require_columns(actual, ["station_code", "actual_hdd"])
    dim = F.broadcast(stations(actual.sparkSession).select(F.col("station_id").alias("station_code"), "hdd_normal"))
    one = (actual.where("actual_hdd is not null").join(dim, "station_code")
           .groupBy("station_code", "hdd_normal").agg(F.min("actual_hdd").alias("actual_hdd")))
    # at most one row per known station
    present = {r["station_code"] for r in one.select("station_code").collect()}
    absent = sorted({r["station_id"] for r in stations(actual.sparkSession).select("station_id").collect()} - present)
    if absent:
        raise ValueError(f"no actual HDD for stations {absent}")
    return one.select("station_code", dd.weather_ratio("actual_hdd", "hdd_normal").alias("factor"))


def adjust_effective_hdd(cells: DataFrame, actual: DataFrame | None = None) -> DataFrame:
    """Add weather_adjustment_factor and effective_hdd_adjusted for one weather year.

    Without weather data the table is returned unchanged; the normal value always stays.
    """
    if actual is None:
        return cells
    require_columns(cells, ["base_station", "effective_hdd"])
    factors = weather_factors(actual)
    unknown = cells.select("base_station").distinct().join(
        factors, F.col("base_station") == F.col("station_code"), "left_anti")
    names = sorted(str(r[0]) for r in unknown.limit(20).collect())
    if names:
        more = unknown.count() - len(names)
        raise ValueError(f"no adjustment factor for stations {names}" + (f" and {more} more" if more else ""))
    # one row per fixed station
    return (cells.join(F.broadcast(factors), F.col("base_station") == F.col("station_code"))
            .drop("station_code").withColumnRenamed("factor", "weather_adjustment_factor")
            .withColumn("effective_hdd_adjusted", F.col("effective_hdd") * F.col("weather_adjustment_factor")))


def uhi_calibrate(px: DataFrame, *, keys: tuple[str, ...] = ("zip_code",), impervious: str = "impervious_pct",
                  lst: str = "lst_c", offset: str = "uhi_offset_f") -> DataFrame:
    """Blend the modelled urban offset with the observed one, per key.

    Where at least ten urban (>= 50 %) and ten rural (<= 10 %) pixels have a surface temperature,
    every valid pixel gets 0.7 * mean modelled + 0.3 * observed; otherwise pixels stay as they are.
    `calibration_warning` tells when both differ by more than 1.5 degrees C.
    """
    urban = (F.col(impervious) >= 50.0) & F.col(lst).isNotNull()
    rural = (F.col(impervious) <= 10.0) & F.col(lst).isNotNull()
    stats = px.groupBy(*keys).agg(
        F.count(F.when(urban, 1)).alias("_nu"), F.count(F.when(rural, 1)).alias("_nr"),
        F.avg(F.when(urban, F.col(lst))).alias("_lu"), F.avg(F.when(rural, F.col(lst))).alias("_lr"),
        F.avg(offset).alias("_model"))
    gap = F.col("_lu") - F.col("_lr")
    enough = (F.col("_nu") >= 10) & (F.col("_nr") >= 10)
    diff = F.abs(gap - F.coalesce(F.col("_model") * 5.0 / 9.0, F.lit(0.0)))
    stats = stats.select(
        *keys, F.when(enough, 0.7 * F.col("_model") + 0.3 * gap * 9.0 / 5.0).alias("_cal"),
        F.when(enough & (diff > 1.5), F.format_string(
            "observed urban offset %.2f C differs from modelled by %.2f C", gap, diff)).alias("calibration_warning"))
    from ..session import bounded_join
    return (bounded_join(px, stats, list(keys), "left")
            .withColumn(offset, F.when(F.col(offset).isNotNull(), F.coalesce("_cal", F.col(offset)))).drop("_cal"))


def thermal(px: DataFrame, *, keys: tuple[str, ...] = ("zip_code",), lst: str | None = None,
            irradiance: float = 200.0) -> DataFrame:
    """Albedo, solar aspect multiplier and urban offset; calibrated where `lst` is given."""
    from ..functions import surface
    out = (px.withColumn("surface_albedo", surface.surface_albedo("impervious_pct"))
           .withColumn("solar_aspect_mult", surface.solar_aspect("aspect_deg"))
           .withColumn("uhi_offset_f", surface.uhi_offset("surface_albedo", irradiance)))
    if lst is None:
        return out.withColumn("calibration_warning", F.lit(None).cast("string"))
    return uhi_calibrate(out, keys=keys, lst=lst)


def canonical_names(df: DataFrame) -> DataFrame:
    """Map older column names onto the one set used here."""
    alias = {"base_hdd": "prism_annual_hdd", "terrain_multiplier": "hdd_terrain_mult",
             "elevation_hdd_addition": "hdd_elev_addition", "uhi_hdd_reduction": "hdd_uhi_reduction",
             "traffic_heat_offset_f": "road_temp_offset_f", "traffic_heat_hdd_reduction": "hdd_traffic_reduction",
             "traffic_hdd_reduction": "hdd_traffic_reduction", "cell_effective_hdd": "effective_hdd",
             "cell_effective_cdd": "effective_cdd"}
    for old, new in alias.items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    return df.withColumn("zip_code", zfill5("zip_code")) if "zip_code" in df.columns else df
