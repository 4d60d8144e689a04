"""The composed runs: normals, daily, hourly, realtime."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import air, surface
from ..functions.cols import m_to_ft
from ..operators import cubes, geometry, hydrology, quality, raster, stations, timeseries, zonal
from ..operators.placing import with_placement
from ..session import checkpoint
from ..sources import tables
from ..streaming import cycles
from ..types import ALTITUDES_FT, CELL_SIZE_M, Grid


def pixel_stack(dem: DataFrame, grid: Grid, *, impervious: DataFrame, base_hdd: DataFrame, wind: DataFrame,
                roads: DataFrame, station_wind: DataFrame, station_elevation_ft: float, base_station: str,
                lst: DataFrame | None = None, drainage: bool = False, tile: int = raster.TILE) -> DataFrame:
    """All correction bands on the elevation grid, one row per pixel.

    Bands arrive as `(grid_id, row, col, value)` on the grid of `dem`; use `raster.bilinear` first
    where they are not.
    """
    on = ["grid_id", "row", "col"]

    def band(df: DataFrame, name: str) -> DataFrame:
        return df.select("grid_id", F.col("row").cast("long"), F.col("col").cast("long"), F.col("value").alias(name))

    px = raster.terrain(dem.withColumn("row", F.col("row").cast("long")).withColumn("col", F.col("col").cast("long")),
                        station_elevation_ft=station_elevation_ft, pixel_size_m=abs(grid.a), tile=tile)
    px = (px.join(band(impervious, "impervious_pct"), on, "left").join(band(base_hdd, "prism_annual_hdd"), on, "left")
          .join(band(wind, "grid_wind"), on, "left"))
    px = zonal.thermal(px if lst is None else px.join(band(lst, "lst_c"), on, "left"), keys=("grid_id",),
                       lst=None if lst is None else "lst_c")
    px = stations.wind_steering(px, grid, station_wind, value="grid_wind", base_station=base_station)
    px = geometry.road_heat(px, grid, roads)
    px = (px.withColumn("mean_elevation_ft", m_to_ft("elev_m"))
          .withColumn("hdd_terrain_mult", F.coalesce(surface.terrain_multiplier("terrain_position"), F.lit(1.0))))
    if drainage:
        cold = hydrology.cold_air_drainage(dem, tile=tile).select(*on, "cold_air_mult")
        px = px.join(cold, on, "left")
    return px


BANDS = ("prism_annual_hdd", "hdd_terrain_mult", "hdd_elev_addition", "uhi_offset_f", "road_temp_offset_f", "road_heat_flux_wm2",
         "wind_infiltration_mult", "mean_wind_ms", "mean_elevation_ft", "impervious_pct", "surface_albedo", "lst_c", "cold_air_mult", "base_cdd")


def _celled(px: DataFrame, grid: Grid | DataFrame, zips: DataFrame, cell_size_m: float) -> DataFrame:
    """Pixels in ZIP polygons `(id, rings)` with their ZIP and the indexes of their cell: arithmetic on the ZIP's box."""
    at, p = with_placement(geometry.pixels_in_polygons(px, grid, zips).withColumnRenamed("id", "zip_code"), grid)
    box = geometry.with_bounds(zips).select(F.col("id").alias("zip_code"), "minx", "maxy")
    at = at.withColumns({"_x": p.x(F.col("col")), "_y": p.y(F.col("row"))}).drop(*p.carried)
    return (at.join(box, "zip_code").withColumn("ix", F.floor((F.col("_x") - F.col("minx")) / float(cell_size_m)).cast("int"))
            .withColumn("iy", F.floor((F.col("maxy") - F.col("_y")) / float(cell_size_m)).cast("int")).drop("_x", "_y", "minx", "maxy"))


def _means(at: DataFrame, cells: DataFrame, *, with_cdd: bool) -> DataFrame:
    """Cells `(zip_code, ix, iy, ...)` with the means of their pixels' bands and effective HDD; cells without pixels stay."""
    if with_cdd and "base_cdd" not in at.columns:
        raise ValueError("with_cdd needs the band base_cdd")
    means = zonal.cell_zonal(at, bands=[b for b in BANDS if b in at.columns], keys=("zip_code", "ix", "iy"))
    out = (cells.join(means, ["zip_code", "ix", "iy"], "left").withColumnRenamed("impervious_pct", "mean_impervious_pct")
           .withColumnRenamed("lst_c", "lst_summer_c").withColumn("num_valid_pixels", F.coalesce("num_valid_pixels", F.lit(0))))
    return zonal.with_effective_hdd(out, with_cdd=with_cdd)


def normals_run(px: DataFrame, grid: Grid, zips: DataFrame, *, region_code: str, base_station: str,
                cell_size_m: float = CELL_SIZE_M, with_cdd: bool = False) -> DataFrame:
    """Pixel stack and ZIP polygons `(id, rings)` -> cell rows plus aggregate rows.

    The cell of a pixel is arithmetic on its ZIP's bounding box; only ZIP membership needs the
    polygons, and those go through scan-line spans. `with_cdd` needs the band `base_cdd`.
    """
    at = _celled(px, grid, zips, cell_size_m)
    shapes = geometry.create_cells(zips, cell_size_m=cell_size_m).select(
        F.col("id").alias("zip_code"), "ix", "iy", "cell_id", "cell_area_sqm", F.lit(base_station).alias("base_station"))
    # the cell table is tiny beside the pixels; written once, the aggregates do not read pixels again
    cells = checkpoint(_means(at, shapes, with_cdd=with_cdd).drop("ix", "iy"))
    return zonal.with_zip_aggregates(cells, region_code=region_code)


def regions_run(px: DataFrame, grids: DataFrame, zips: DataFrame, regions: DataFrame, *, cell_size_m: float = CELL_SIZE_M,
                with_cdd: bool = False) -> DataFrame:
    """The normals of all regions in one plan: cell rows plus aggregate rows with `region_code`.

    `px` holds the bands of all grids, `grids` is their placement table, `zips(id, region_code, rings)` and
    `regions(region_code, grid_id, base_station)` say where each ZIP belongs. Parameters of a region are columns, so no region
    waits for another and one with most of the ZIPs spreads over all tasks. Where grids overlap, a ZIP takes the
    pixels of its own region's grid alone; a ZIP of an unknown region is left out.
    """
    of = zips.select(F.col("id").alias("zip_code"), "region_code").join(regions.select("region_code", "grid_id", "base_station"), "region_code")
    of = checkpoint(of)
    at = _celled(px, grids, zips.select("id", "rings"), cell_size_m).join(of.select("zip_code", "grid_id"), ["zip_code", "grid_id"], "left_semi")
    shapes = geometry.create_cells(zips.select("id", "rings"), cell_size_m=cell_size_m).select(F.col("id").alias("zip_code"), "ix", "iy", "cell_id", "cell_area_sqm")
    shapes = shapes.join(of.select("zip_code", "region_code", "base_station"), "zip_code")
    return zonal.with_zip_aggregates(checkpoint(_means(at, shapes, with_cdd=with_cdd).drop("ix", "iy")))


def normals_full(dem: DataFrame, grid: Grid, zips: DataFrame, *, region_code: str, base_station: str, station_elevation_ft: float,
                 layers: dict[str, tuple[DataFrame, Grid]], landcover: DataFrame, roads: DataFrame, station_wind: DataFrame,
                 monthly: DataFrame | None = None, actual: DataFrame | None = None, billing: DataFrame | None = None,
                 cell_size_m: float = CELL_SIZE_M, with_cdd: bool = False, drainage: bool = False,
                 tile: int = raster.TILE) -> tuple[DataFrame, DataFrame]:
    """The normals of a region from raw layers to checked rows: (table, results of the checks).

    `layers` names `(grid_id, row, col, value)` tables with their own placements: `impervious`, `base_hdd`, `wind`, and where
    there are any `lst` and `base_cdd`. Each is resampled to the elevation grid where it lies on another one; the stack is then
    clipped to the ZIP polygons. `landcover` on `grid` gives each cell its type, its pixels the most frequent terrain class.
    `monthly(grid_id, row, col, month, base_hdd)` adds the months, `actual(station_code, actual_hdd)` a weather year, and all quality checks run
    over the table.
    """
    rim = dem.select("grid_id", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"))

    def on_dem(name: str) -> DataFrame:
        df, own = layers[name]
        if (own.a, own.c, own.e, own.f) == (grid.a, grid.c, grid.e, grid.f):
            return df.select("grid_id", "row", "col", "value")
        return raster.bilinear(df, own, rim, grid).select("grid_id", "row", "col", "value")

    px = pixel_stack(dem, grid, impervious=on_dem("impervious"), base_hdd=on_dem("base_hdd"), wind=on_dem("wind"), roads=roads, station_wind=station_wind,
                     station_elevation_ft=station_elevation_ft, base_station=base_station, lst=on_dem("lst") if "lst" in layers else None,
                     drainage=drainage, tile=tile)
    if "base_cdd" in layers:
        cdd = on_dem("base_cdd").select("grid_id", F.col("row").cast("long"), F.col("col").cast("long"), F.col("value").alias("base_cdd"))
        px = px.join(cdd, ["grid_id", "row", "col"], "left")
    at = checkpoint(_celled(geometry.clip(px, grid, zips, value="prism_annual_hdd"), grid, zips, cell_size_m))  # used three times
    made = geometry.create_cells(zips, cell_size_m=cell_size_m)
    typed = geometry.cell_dominant(made, landcover, grid).select("id", "cell_id", "cell_type")
    shapes = made.join(typed, ["id", "cell_id"], "left").select(
        F.col("id").alias("zip_code"), "ix", "iy", "cell_id", "cell_area_sqm", "cell_type", F.lit(base_station).alias("base_station"))
    # the most frequent class of a cell's pixels, the first by name on a tie
    classes = at.where("terrain_position is not null").groupBy("zip_code", "ix", "iy", "terrain_position").agg(F.count(F.lit(1)).alias("_n"))
    classes = classes.groupBy("zip_code", "ix", "iy").agg(F.min_by("terrain_position", F.struct(-F.col("_n"), "terrain_position")).alias("terrain_position"))
    cells = _means(at, shapes.join(classes, ["zip_code", "ix", "iy"], "left"), with_cdd=with_cdd)
    if monthly is not None:
        months = monthly.select("grid_id", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), "month", "base_hdd")
        where = at.where("prism_annual_hdd is not null").select("grid_id", "row", "col", "zip_code", "ix", "iy")
        cells = zonal.cell_monthly(months.join(where, ["grid_id", "row", "col"]), cells, keys=("zip_code", "ix", "iy"))
    cells = cells.drop("ix", "iy")
    if actual is not None:
        cells = zonal.adjust_effective_hdd(cells, actual)
    table = checkpoint(zonal.with_zip_aggregates(checkpoint(cells), region_code=region_code))
    return table, quality.run_all_checks(table, billing=billing)[0]


def daily_run(hourly: DataFrame, prs: DataFrame, normals: DataFrame, terrain: DataFrame, *,
              clim: DataFrame | None = None, profile_hour: str = "first",
              apply_bl: bool = False, levels_unique: bool = False) -> tuple[DataFrame, DataFrame]:
    """Hourly rows per ZIP -> daily rows and the safety cube, for all days in one plan.

    `hourly(ts, zip_code, t2m_k, u10, v10, sp_mb)`, `prs(ts, zip_code, level_mb, u, v, t_k)`,
    `normals(zip_code, month, normal_f)`. The profile is that of each day's first hour, or with
    `profile_hour='mean'` the daily mean of the hourly ones.
    """
    day = timeseries.daily_mean(hourly, keys=("zip_code",))
    adj = timeseries.bias_correct(day, normals, clim, keys=("zip_code",), strict=False)
    adj = adj.withColumn("bias_f", F.coalesce("bias_f", F.lit(0.0))).withColumn(
        "adjusted_f", F.col("temp_f") + F.col("bias_f"))
    h, p = hourly.withColumn("date", F.to_date("ts")), prs.withColumn("date", F.to_date("ts"))
    if profile_hour == "first":
        first = h.groupBy("date").agg(F.min("ts").alias("ts"))  # one row per date
        h, p = h.join(first, ["date", "ts"]), p.join(first, ["date", "ts"])
    keys = ("zip_code", "date", "ts")
    prof = timeseries.wind_profiles(h, p, keys=keys, levels_unique=levels_unique)
    if profile_hour == "mean":
        # bearings have no mean: the components are averaged, speed and bearing follow from them
        toward = F.radians("wind_direction_deg")
        u, v = F.avg(F.col("wind_speed_ms") * F.sin(toward)), F.avg(F.col("wind_speed_ms") * F.cos(toward))
        prof = prof.groupBy("zip_code", "date", "altitude_ft").agg(u.alias("u"), v.alias("v"), *[F.avg(k).alias(k) for k in ("temperature_k", "temperature_f")])
        prof = prof.withColumn("wind_speed_ms", air.wind_speed("u", "v")).withColumn("wind_direction_deg", air.wind_direction("u", "v")).drop("u", "v")
    daily = cubes.daily_combine(adj, prof.drop("ts"), terrain, apply_bl=apply_bl)
    return daily, cubes.safety_cube(daily)


def grid_to_zips(hourly: DataFrame, prs: DataFrame | None, points: DataFrame, *, curvilinear: bool = False,
                 cells: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Hourly grid fields and pressure levels `(ts, gy, gx, ...)` -> rows per ZIP, for `daily_run` and `hourly_run`.

    `points(zip_code, lat, lon)`; `cells(gy, gx, lat, lon)` places the grid. Field names may be any
    that the sources use; surface pressure may be in Pa.
    """
    place = stations.nearest_curvilinear if curvilinear else stations.nearest_grid
    at = checkpoint(place(points, cells).select("zip_code", "gy", "gx"))  # one narrow row per ZIP, used twice
    sfc = stations.sample_grid(tables.canonical_hour(hourly), at)
    return sfc, None if prs is None else stations.sample_grid(tables.canonical_levels(prs), at)


def hourly_run(hourly: DataFrame, terrain: DataFrame, *, prs: DataFrame | None = None,
               bias: float | str = 0.0, levels_unique: bool = False) -> DataFrame:
    """Hourly rows per ZIP -> cube; with `prs` the profile is interpolated from pressure levels."""
    if prs is None:
        return cubes.hourly_cube(hourly, terrain, bias=bias)
    prof = timeseries.wind_profiles(hourly, prs, altitudes=ALTITUDES_FT, levels_unique=levels_unique)
    return cubes.hourly_cube(hourly, terrain, bias=bias, profiles=prof)


def combined_run(px: DataFrame, grid: Grid, zips: DataFrame, hourly: DataFrame, prs: DataFrame, normals: DataFrame, *, region_code: str,
                 base_station: str, cell_size_m: float = CELL_SIZE_M, clim: DataFrame | None = None, bias: float | str = 0.0,
                 levels_unique: bool = False) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The normals once, then daily and hourly rows from their table: (cells, daily, daily cube, hourly cube).

    The cell table is written before it is used three times, so the pixels are read once.
    """
    cells = checkpoint(normals_run(px, grid, zips, region_code=region_code, base_station=base_station, cell_size_m=cell_size_m))
    daily, cube = daily_run(hourly, prs, normals, cells, clim=clim, levels_unique=levels_unique)
    return cells, daily, cube, hourly_run(hourly, cells, bias=bias)


def realtime_run(spark: SparkSession, landing: str, schema: str, terrain: DataFrame, out: str, checkpoint_folder: str, *,
                 bias: float = 0.0, once: bool = False) -> StreamingQuery:
    """Landed hourly files -> cube rows per date and hour, each hour and ZIP once.

    `terrain` is the static feature table; repeats within the look-back are dropped. `once` drains
    what has landed and stops.
    """
    stream = cycles.dedup_cycles(cycles.cycle_source(spark, landing, schema))
    return cycles.write_cycles(cycles.cycle_cube_stream(stream, terrain, bias=bias), out, checkpoint_folder, once=once)
