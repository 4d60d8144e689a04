"""Focal and resampling operators on long pixel tables `(grid_id, row, col, value...)`.

3x3 operators cut the grid into square tiles with a one-pixel halo. One exchange on
`(grid_id, tile_r, tile_c)` then serves both the row and the column window, a task never holds
more than a few tiles, and one huge grid spreads over all tasks. Box means use prefix sums along
each row and each column, so their cost does not depend on the radius.

The grid must be dense: every (row, col) present, NULL where the value is missing. A neighbour
that is absent from the table counts as lying outside the grid.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import degree_days, surface
from ..functions.cols import c
from ..functions.geodesy import lonlat_to_utm, utm_to_lonlat
from ..session import bounded_join, checkpoint
from ..types import LAPSE_HDD_PER_1000FT, PREVAILING_WIND_DEG, ROUGHNESS_THRESHOLD, Z0_RURAL, Grid, landcover

TILE = 512
MAX_QUADS = 1_000_000  # 48 bytes each


def with_xy(px: DataFrame, grid: Grid) -> DataFrame:
    """Add the pixel-centre coordinates."""
    return (px.withColumn("x", grid.c + grid.a * (F.col("col") + 0.5))
            .withColumn("y", grid.f + grid.e * (F.col("row") + 0.5)))


def tiled(px: DataFrame, tile: int = TILE, halo: int = 1) -> DataFrame:
    """Copy border pixels into the tiles they touch; `core` marks each pixel's own tile."""
    def tiles(axis: str) -> Column:
        return F.array_distinct(F.array(*[
            F.floor((F.col(axis) + d) / F.lit(tile)).cast("long") for d in (-halo, 0, halo)]))

    own = ((F.col("tile_r") == F.floor(F.col("row") / F.lit(tile)))
           & (F.col("tile_c") == F.floor(F.col("col") / F.lit(tile))))
    return (px.withColumn("tile_r", F.explode(tiles("row")))
            .withColumn("tile_c", F.explode(tiles("col")))
            .withColumn("core", own)
            .repartition("grid_id", "tile_r", "tile_c"))


def _neighbour(cell: Column, axis: str, step: int, w) -> Column:
    """The cell `step` places along `axis`, NULL if that position is not in the table."""
    return F.when(F.lead(axis, step).over(w) == F.col(axis) + step, F.lead(cell, step).over(w))


def with_neighbours(px: DataFrame, value: str, *, reflect: bool = False, tile: int = TILE) -> DataFrame:
    """Add nw,n,ne,w,e,sw,s,se of `value`; `reflect` repeats the border outward."""
    keys = ["grid_id", "tile_r", "tile_c"]
    along_row = Window.partitionBy(*keys, "row").orderBy("col")
    along_col = Window.partitionBy(*keys, "col").orderBy("row")
    cell = F.struct(F.col(value).alias("v"))
    west, east = (_neighbour(cell, "col", d, along_row) for d in (-1, 1))
    if reflect:
        west, east = F.coalesce(west, cell), F.coalesce(east, cell)
    px = tiled(px, tile).withColumn(
        "_mid", F.struct(west["v"].alias("w"), F.col(value).alias("c"), east["v"].alias("e")))
    north, south = (_neighbour(F.col("_mid"), "row", d, along_col) for d in (-1, 1))
    if reflect:
        north, south = F.coalesce(north, F.col("_mid")), F.coalesce(south, F.col("_mid"))
    px = px.withColumn("_north", north).withColumn("_south", south).where("core")
    return px.select(
        *[k for k in px.columns if not k.startswith("_") and k not in ("tile_r", "tile_c", "core")],
        F.col("_north.w").alias("nw"), F.col("_north.c").alias("n"), F.col("_north.e").alias("ne"),
        F.col("_mid.w").alias("w"), F.col("_mid.e").alias("e"),
        F.col("_south.w").alias("sw"), F.col("_south.c").alias("s"), F.col("_south.e").alias("se"))


_NEIGHBOURS = ["nw", "n", "ne", "w", "e", "sw", "s", "se"]


def grid_stats(px: DataFrame, value: str) -> DataFrame:
    """Mean value and extent per grid, one row each."""
    return px.groupBy("grid_id").agg(
        F.avg(value).alias("_mean"), (F.max("row") + 1).alias("_rows"), (F.max("col") + 1).alias("_cols"))


def _with_grid_stats(px: DataFrame, value: str, stats: DataFrame | None) -> DataFrame:
    """Add the grid's mean value and its extent to every pixel."""
    return bounded_join(px, grid_stats(px, value) if stats is None else stats, ["grid_id"], "left")


def aspect_slope(dem: DataFrame, *, value: str = "elev_m", tile: int = TILE, stats: DataFrame | None = None) -> DataFrame:
    """Add aspect_deg and slope_deg from central differences in pixel units.

    `stats` takes the result of `grid_stats` where it is already known. Missing cells are filled with the grid mean for the differences and come out missing, as does
    the outermost row and column.
    """
    filled = _with_grid_stats(dem, value, stats).withColumn("_fill", F.coalesce(value, "_mean"))
    filled = filled.withColumnRenamed("_fill", "fill_").drop("_mean", "_rows", "_cols")
    px = with_neighbours(filled, "fill_", tile=tile)
    dy, dx = (F.col("s") - F.col("n")) / 2.0, (F.col("e") - F.col("w")) / 2.0
    known = F.col(value).isNotNull()
    return (px.withColumn("aspect_deg", F.when(known, F.pmod(90.0 - F.degrees(F.atan2(dy, dx)), F.lit(360.0))))
            .withColumn("slope_deg", F.when(known, F.degrees(F.atan(F.sqrt(dx * dx + dy * dy)))))
            .drop("fill_", *_NEIGHBOURS))


def _half_width(radius_px: float) -> int:
    """Half width of the odd box that stands for a circle of this radius."""
    return math.ceil(int(2 * radius_px) / 2)


def _box_sum(df: DataFrame, value: str, out: str, along: str, across: str, half: int) -> DataFrame:
    """Sum over 2*half+1 cells along one axis: the difference of two running totals."""
    w = Window.partitionBy("grid_id", across).orderBy(along)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumn("_cum", F.sum(value).over(running))
    before = F.when(F.col(along) <= half, 0.0).otherwise(F.lag("_cum", half + 1).over(w))
    return df.withColumn(out, F.lead("_cum", half).over(w) - before).drop("_cum")


def tpi(dem: DataFrame, *, value: str = "elev_m", pixel_size_m: float = 1.0,
        inner_m: float = 300.0, outer_m: float = 1000.0, stats: DataFrame | None = None) -> DataFrame:
    """Add `tpi`: height above the mean of the surrounding ring.

    The ring mean comes from two square box means weighted by circle areas. Cells nearer to the
    border than the outer radius come out missing.
    """
    r_in, r_out = inner_m / pixel_size_m, outer_m / pixel_size_m
    h_in, h_out = _half_width(r_in), _half_width(r_out)
    px = _with_grid_stats(dem, value, stats).withColumn("_z", F.coalesce(value, "_mean"))
    px = _box_sum(px, "_z", "_row_in", "col", "row", h_in)
    px = _box_sum(px, "_z", "_row_out", "col", "row", h_out)
    px = _box_sum(px, "_row_in", "_in", "row", "col", h_in)
    px = _box_sum(px, "_row_out", "_out", "row", "col", h_out)
    a_in, a_out = math.pi * r_in**2, math.pi * r_out**2
    ring = (F.col("_out") / float((2 * h_out + 1) ** 2) * a_out
            - F.col("_in") / float((2 * h_in + 1) ** 2) * a_in) / (a_out - a_in)
    edge = math.ceil(r_out)
    inside = ((F.col("row") >= edge) & (F.col("row") < F.col("_rows") - edge)
              & (F.col("col") >= edge) & (F.col("col") < F.col("_cols") - edge))
    return (px.withColumn("tpi", F.when(inside & F.col(value).isNotNull(), F.col(value) - ring))
            .drop("_z", "_row_in", "_row_out", "_in", "_out", "_mean", "_rows", "_cols"))


def surface_properties(px: DataFrame, *, class_col: str = "nlcd_class") -> DataFrame:
    """Attach roughness, albedo, emissivity and displacement height; unknown classes give NULL."""
    dim = landcover(px.sparkSession).withColumnRenamed("nlcd_class", class_col)
    return px.join(F.broadcast(dim), class_col, "left")


def surface_mask(px: DataFrame, *, class_col: str = "nlcd_class", tile: int = TILE) -> DataFrame:
    """Surface properties plus the roughness gradient and the transition-zone flag.

    The gradient is the Sobel magnitude of ln(z0) with reflected borders. A missing cell in the
    window makes it missing; an unknown class stands for rural roughness.
    """
    props = surface_properties(px, class_col=class_col)
    log_z0 = F.when(F.col(class_col).isNotNull(),
                    F.ln(F.when(F.col("z0_m") > 0, F.col("z0_m")).otherwise(Z0_RURAL)))
    g = with_neighbours(props.withColumn("logz0_", log_z0), "logz0_", reflect=True, tile=tile)
    # all nine cells take part, so any missing one makes the gradient missing
    whole = F.col("logz0_") * 0.0 + F.col("n") * 0.0 + F.col("s") * 0.0 + F.col("w") * 0.0 + F.col("e") * 0.0
    # opposite cells are subtracted first, which keeps flat ground at exactly zero
    gx = (F.col("ne") - F.col("nw")) + 2 * (F.col("e") - F.col("w")) + (F.col("se") - F.col("sw"))
    gy = (F.col("sw") - F.col("nw")) + 2 * (F.col("s") - F.col("n")) + (F.col("se") - F.col("ne"))
    return (g.withColumn("roughness_gradient", F.sqrt(gx * gx + gy * gy) + whole)
            .withColumn("roughness_transition",
                        F.coalesce(F.col("roughness_gradient") > ROUGHNESS_THRESHOLD, F.lit(False)))
            .drop("logz0_", *_NEIGHBOURS))


def terrain(dem: DataFrame, *, station_elevation_ft: float, value: str = "elev_m", pixel_size_m: float = 1.0,
            wind_deg: float = PREVAILING_WIND_DEG, lapse: float = LAPSE_HDD_PER_1000FT,
            tile: int = TILE) -> DataFrame:
    """Aspect, slope, TPI, wind shadow, terrain class and the lapse-rate addition of each pixel."""
    stats = checkpoint(grid_stats(dem, value))  # one scan for both
    px = aspect_slope(dem, value=value, tile=tile, stats=stats)
    px = tpi(px, value=value, pixel_size_m=pixel_size_m, stats=stats)
    return (px.withColumn("wind_shadow", surface.wind_shadow("tpi", "aspect_deg", wind_deg))
            .withColumn("terrain_position", surface.terrain_position("tpi", "slope_deg", "aspect_deg", wind_deg))
            .withColumn("hdd_elev_addition", degree_days.lapse_addition(value, station_elevation_ft, lapse)))


def _to_crs(x: Column, y: Column, src: str, dst: str) -> tuple[Column, Column]:
    if src == dst:
        return x, y
    return lonlat_to_utm(x, y) if dst == "utm10" else utm_to_lonlat(x, y)


def project_points(df: DataFrame, *, src: str, dst: str, x: str = "x", y: str = "y") -> DataFrame:
    """Add `px, py`: the point in the other reference system ("lonlat" or "utm10")."""
    px, py = _to_crs(F.col(x), F.col(y), src, dst)
    return df.withColumn("px", px).withColumn("py", py)


def bilinear(src: DataFrame, src_grid: Grid, dst: DataFrame, dst_grid: Grid, *, value: str = "value",
             out: str = "value", keys: tuple[str, ...] = ()) -> DataFrame:
    """Sample `src` at the pixel centres of `dst`; outside the source -> missing.

    `keys` (grid_id, band, month) name layers that both tables have: each is sampled on its own. A
    source with several layers that are not named is refused when the plan runs.

    Each source pixel is offered to the four 2x2 quads it belongs to, so the usually far larger
    target table is joined once and never exploded. Missing corners drop out and the remaining
    weights are rescaled. This is the interpolating kernel; to go to a coarser grid use
    `area_average`.
    """
    corners = F.array(*[F.struct(F.lit(dr).alias("dr"), F.lit(dc).alias("dc")) for dr in (0, 1) for dc in (0, 1)])
    unnamed = [k for k in ("grid_id", "band", "month") if k in src.columns and k not in keys]
    offered = (src.where(F.col(value).isNotNull())
               .select("row", "col", *keys, *unnamed, F.col(value).alias("_v"), F.explode(corners).alias("k")))

    def corner(dr: int, dc: int) -> Column:
        return F.max(F.when((F.col("k.dr") == dr) & (F.col("k.dc") == dc), F.col("_v")))

    layers = F.lit(True)
    for k in unnamed:
        layers = layers & F.min(k).eqNullSafe(F.max(k))

    quads = (offered.groupBy((F.col("row") - F.col("k.dr")).cast("long").alias("_r0"),
                             (F.col("col") - F.col("k.dc")).cast("long").alias("_c0"), *keys)
             .agg(F.when(layers, corner(0, 0)).otherwise(F.raise_error(F.lit(f"several layers of {unnamed}: name them in keys"))).alias("_v00"), corner(0, 1).alias("_v01"),
                  corner(1, 0).alias("_v10"), corner(1, 1).alias("_v11")))
    at = with_xy(dst, dst_grid)
    sx, sy = _to_crs(F.col("x"), F.col("y"), dst_grid.crs, src_grid.crs)
    at = (at.withColumn("_fc", (sx - src_grid.c) / src_grid.a).withColumn("_fr", (sy - src_grid.f) / src_grid.e)
          .withColumn("_c0", F.floor(F.col("_fc") - 0.5)).withColumn("_r0", F.floor(F.col("_fr") - 0.5)))
    # counted first: a coarse source is broadcast and the target is not shuffled at all
    joined = bounded_join(at, quads, ["_r0", "_c0", *keys], "left", max_rows=MAX_QUADS)
    dx, dy = F.col("_fc") - 0.5 - F.col("_c0"), F.col("_fr") - 0.5 - F.col("_r0")
    weights = {"_v00": (1 - dx) * (1 - dy), "_v01": dx * (1 - dy), "_v10": (1 - dx) * dy, "_v11": dx * dy}
    total = weighted = F.lit(0.0)
    for k, w in weights.items():
        total = total + F.when(F.col(k).isNotNull(), w).otherwise(0.0)
        weighted = weighted + F.coalesce(F.col(k) * w, F.lit(0.0))
    inside = ((F.col("_fr") >= 0) & (F.col("_fr") < src_grid.n_rows)
              & (F.col("_fc") >= 0) & (F.col("_fc") < src_grid.n_cols))
    result = F.when(inside & (total > 0), weighted / total)
    keep = [k for k in dst.columns if k != out]
    return joined.select(*keep, result.alias(out))


def area_average(src: DataFrame, src_grid: Grid, dst_grid: Grid, *, value: str = "value") -> DataFrame:
    """Mean of the source pixels whose centre falls into each (coarser) target pixel."""
    at = with_xy(src, src_grid)
    x, y = _to_crs(F.col("x"), F.col("y"), src_grid.crs, dst_grid.crs)
    row, col = F.floor((y - dst_grid.f) / dst_grid.e), F.floor((x - dst_grid.c) / dst_grid.a)
    return (at.groupBy("grid_id", row.alias("row"), col.alias("col")).agg(F.avg(value).alias(value)))


def grid_max_share(px: DataFrame, value: str, out: str) -> DataFrame:
    """`value` as a share of its grid's maximum; 0 where the maximum is not positive."""
    peak = px.groupBy("grid_id").agg(F.max(value).alias("_max"))
    return (bounded_join(px, peak, ["grid_id"], "left")
            .withColumn(out, F.when(F.col("_max") <= 0, F.when(c(value).isNotNull(), 0.0))
                        .otherwise(c(value) / F.col("_max"))).drop("_max"))
