"""Stations: nearest station, wind summaries, and station values spread over a grid."""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..functions import air
from ..functions.cols import c
from ..functions.geodesy import haversine_km, lonlat_to_utm
from ..session import checkpoint
from ..types import STATIONS, Grid, stations
from .nearest import nearest
from .placing import fixed, on_grids
from .quantiles import exact_quantiles


def nearest_station(points: DataFrame, *, lat: str = "centroid_lat", lon: str = "centroid_lon",
                    out: str = "base_station", sites: DataFrame | None = None) -> DataFrame:
    """Add the nearest station by great circle and `distance_km`; the first listed wins a tie.

    A missing coordinate gives a missing station. The fixed eleven are a plain expression: no join, no shuffle. Another station
    table `sites(station_id, lat, lon)` may have any size; of its stations at equal distance the first by name wins.
    """
    if sites is not None:
        named = sites.select(F.col("station_id").alias(out), "lat", "lon")
        return nearest(points, named, lat=lat, lon=lon, take=(out,), out_km="distance_km")
    ranked = F.array_min(F.array(*[
        F.struct(haversine_km(lat, lon, la, lo).alias("km"), F.lit(i).alias("ord"), F.lit(s).alias("id"))
        for i, (s, _, _, la, lo) in enumerate(STATIONS)]))
    ranked = F.when(F.col(lat).isNotNull() & F.col(lon).isNotNull(), ranked)
    return (points.withColumn("_near", ranked).withColumn(out, F.col("_near.id"))
            .withColumn("distance_km", F.col("_near.km")).drop("_near"))


def station_wind(obs: DataFrame, *, with_p90: bool = True) -> DataFrame:
    """Mean and exact 90th percentile (linear interpolation) of each known station's wind.

    Text that is no number and missing readings are dropped. Without `with_p90` one aggregation
    is enough; the merge with gridded wind needs only the mean.
    """
    known = [s for s, *_ in STATIONS]
    clean = (obs.withColumn("wind_ms", F.expr("try_cast(wind_speed_set_1 as double)"))
             .where(F.col("station_id").isin(*known) & F.col("wind_ms").isNotNull() & ~F.isnan("wind_ms")))
    mean = clean.groupBy("station_id").agg(F.avg("wind_ms").alias("mean_wind_ms"), F.count(F.lit(1)).alias("num_obs"))
    if not with_p90:
        return mean
    return mean.join(exact_quantiles(clean, "wind_ms", {"p90_wind_ms": 0.9}, keys=("station_id",)), "station_id")


def nearest_on_axis(points: DataFrame, axis: DataFrame, *, at: str, index: str, coord: str) -> DataFrame:
    """Add `index` of the axis value nearest to `at`; the lower index wins a tie, a missing coordinate has none.

    Points stay rows of their own: each looks its bucket's few axis values up in one array. The axis is one coordinate of a grid. Buckets as wide as its largest step make the nearest
    value always lie in the point's bucket or a neighbour; points beyond the ends use the end.
    """
    from pyspark.sql import Window

    step = axis.select((F.lead(coord).over(Window.orderBy(coord)) - F.col(coord)).alias("_s"))
    rng = axis.agg(F.min(coord).alias("lo"), F.max(coord).alias("hi")).first()
    width = step.agg(F.max("_s")).first()[0] or 1.0
    inside = F.greatest(F.lit(rng["lo"]), F.least(F.lit(rng["hi"]), F.col(at)))
    probe = points.withColumn("_b", F.floor((inside - rng["lo"]) / width))
    spread = (axis.select(F.col(index).alias("_i"), F.col(coord).alias("_v"))
              .withColumn("_home", F.floor((F.col("_v") - rng["lo"]) / width))
              .withColumn("_b", F.explode(F.array(F.col("_home") - 1, F.col("_home"), F.col("_home") + 1))))
    near = spread.groupBy("_b").agg(F.collect_list(F.struct("_v", "_i")).alias("_near"))
    ranked = F.array_min(F.transform("_near", lambda k: F.struct(F.abs(k["_v"] - F.col(at)).alias("d"), k["_i"].alias("i"))))
    return probe.join(near, "_b", "left").select(*points.columns, F.when(F.col(at).isNotNull(), ranked["i"]).alias(index))


def nearest_grid(points: DataFrame, grid_axes: DataFrame, *, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Add gy, gx of the nearest grid row and column, each axis on its own."""
    for need in ("gy", "gx", "lat", "lon"):
        if need not in grid_axes.columns:
            raise ValueError(f"grid has no {need} column")
    gy = grid_axes.groupBy("gy").agg(F.min("lat").alias("glat"))
    gx = grid_axes.groupBy("gx").agg(F.min("lon").alias("glon"))
    out = nearest_on_axis(points, gy, at=lat, index="gy", coord="glat")
    return nearest_on_axis(out, gx, at=lon, index="gx", coord="glon")


def nearest_curvilinear(points: DataFrame, cells: DataFrame, *, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Add gy, gx of the nearest grid cell by great circle, for grids whose rows and columns are no parallels.

    `cells(gy, gx, lat, lon)` of any number; the lowest (gy, gx) wins a tie. However far a point lies, it has a cell; without
    coordinates it has none. Points stay rows of their own.
    """
    return nearest(points, cells, lat=lat, lon=lon, take=("gy", "gx"))


def sample_grid(fields: DataFrame, points: DataFrame, *, key: str = "zip_code") -> DataFrame:
    """Field rows (ts, gy, gx, ...) of each point's cell: one row per time and `key`, other columns kept.

    `points(key, gy, gx)` come from `nearest_grid`. The few wanted cells prune the fields, whichever
    side Spark moves for it; points without a cell give no rows.
    """
    wanted = points.where("gy is not null and gx is not null").select(key, "gy", "gx").distinct()
    return fields.join(wanted, ["gy", "gx"]).drop("gy", "gx")


def _triangles(xy: np.ndarray) -> list[tuple[int, int, int]]:
    """Delaunay triangles of a handful of points: no other point inside the circumcircle."""
    out = []
    for i, j, k in combinations(range(len(xy)), 3):
        (ax, ay), (bx, by), (cx, cy) = xy[[i, j, k]]
        area = (bx - ax) * (cy - ay) - (cx - ax) * (by - ay)
        if abs(area) < 1e-12:
            continue
        d = xy - xy[[i]]
        m = np.array([[bx - ax, by - ay], [cx - ax, cy - ay]])
        centre = np.linalg.solve(2 * m, (m**2).sum(axis=1))
        r2 = (centre**2).sum()
        others = np.delete(((d - centre) ** 2).sum(axis=1), [i, j, k])
        if (others >= r2 * (1 - 1e-12)).all():
            out.append((i, j, k))
    return out


def _interpolated(x: Column, y: Column, pts: list[tuple[float, float, float | Column]]) -> Column | None:
    """Piecewise linear surface through (x, y, value); NULL outside the convex hull."""
    xy = np.array([(p[0], p[1]) for p in pts])
    pieces = []
    for i, j, k in _triangles(xy):
        (ax, ay, av), (bx, by, bv), (cx, cy, cv) = pts[i], pts[j], pts[k]
        det = (by - cy) * (ax - cx) + (cx - bx) * (ay - cy)
        wa = ((by - cy) * (x - cx) + (cx - bx) * (y - cy)) / det
        wb = ((cy - ay) * (x - cx) + (ax - cx) * (y - cy)) / det
        wc = 1.0 - wa - wb
        eps = -1e-9
        pieces.append(F.when((wa >= eps) & (wb >= eps) & (wc >= eps), wa * av + wb * bv + wc * cv))
    return F.coalesce(*pieces) if pieces else None


def _placed(dim: DataFrame, grid: Grid) -> DataFrame:
    """Station positions in the grid's reference system."""
    if grid.crs == "lonlat":
        return dim.withColumn("sx", F.col("lon")).withColumn("sy", F.col("lat"))
    sx, sy = lonlat_to_utm("lon", "lat")
    return dim.withColumn("sx", sx).withColumn("sy", sy)


def _origin_xy(grid: Grid) -> tuple[Column, Column]:
    return F.col("col") * grid.a + grid.c, F.col("row") * grid.e + grid.f


def _station_pixels(px: DataFrame, grid: Grid, value: str, *more: str) -> list[tuple[Row, Row]]:
    """(station, pixel) pairs for the grid pixel nearest to each of the eleven stations.

    The positions become a literal filter on row and column, so the scan, or the grouping behind
    it, reads little more than those pixels.
    """
    sites = (_placed(stations(px.sparkSession), grid)
             .withColumn("col", F.rint((F.col("sx") - grid.c) / grid.a).cast("long"))
             .withColumn("row", F.rint((F.col("sy") - grid.f) / grid.e).cast("long")).orderBy("station_id").collect())
    here = F.lit(False)
    for s in sites:
        here = here | ((F.col("row") == s["row"]) & (F.col("col") == s["col"]))
    rows = (px.where(F.col("row").isin(*[s["row"] for s in sites]) & F.col("col").isin(*[s["col"] for s in sites]) & here)
            .select("row", "col", F.col(value).alias("v"), *more, *[k for k in ("grid_id",) if k in px.columns]).collect())
    if "grid_id" in px.columns and len({p["grid_id"] for p in rows}) > 1:
        raise ValueError("the table holds several grids, a placement is that of one")
    return [(s, p) for s in sites for p in rows if (p["row"], p["col"]) == (s["row"], s["col"])]


def _sites_on(grid: Grid | DataFrame, sites: DataFrame) -> DataFrame:
    """Stations `(station_id, lat, lon, ...)` in the reference system of each grid, with the nearest pixel's row and column."""
    if isinstance(grid, Grid):
        at, p = _placed(sites, grid), fixed(grid)
    else:
        # few grids, few stations: every station is placed on the grids whose extent it lies in
        utm = lonlat_to_utm("lon", "lat")
        both = sites.withColumns({"_ux": utm[0], "_uy": utm[1]}).withColumn("crs", F.explode(F.array(F.lit("lonlat"), F.lit("utm10"))))
        both = both.withColumn("sx", F.when(F.col("crs") == "lonlat", F.col("lon")).otherwise(F.col("_ux"))).withColumn(
            "sy", F.when(F.col("crs") == "lonlat", F.col("lat")).otherwise(F.col("_uy"))).drop("_ux", "_uy")
        at, p = on_grids(both, grid, (F.col("sx"), F.col("sy"), F.col("sx"), F.col("sy")))
        at = at.join(grid.select("grid_id", F.col("crs").alias("_crs")), "grid_id").where("crs = _crs").drop("crs", "_crs")
    return (at.withColumn("col", F.rint((F.col("sx") - p.c) / p.a).cast("long"))
            .withColumn("row", F.rint((F.col("sy") - p.f) / p.e).cast("long")).drop(*p.carried))


def station_bias(px: DataFrame, grid: Grid | DataFrame, *, value: str = "value", out: str = "corrected", sites: DataFrame | None = None) -> DataFrame:
    """Shift an HDD grid toward the station normals.

    Each station gives the offset between its normal and the grid pixel nearest to it. Offsets are
    interpolated linearly between stations and are 0 outside their hull; fewer than three stations
    on the grid leave it unchanged. The fixed eleven on one grid are a plain expression, of which at most eleven
    station pixels reach the driver. A station table `sites(station_id, hdd_normal, lat, lon)` of any
    size, or a placement table of several grids, goes through the triangle index.
    """
    if sites is not None or not isinstance(grid, Grid):
        from .triangles import interpolate
        on = ["row", "col"] if isinstance(grid, Grid) else ["grid_id", "row", "col"]
        at = _sites_on(grid, stations(px.sparkSession) if sites is None else sites)
        own = px.select(*[F.col(k).cast("long") if k != "grid_id" else F.col(k) for k in on], F.col(value).alias("_own"))
        offsets = at.join(own, on).select(*[k for k in on if k == "grid_id"], "station_id", "sx", "sy", (F.col("hdd_normal") - F.col("_own")).alias("_offset"))
        made = interpolate(px, grid, checkpoint(offsets), ["_offset"], ["_shift"])
        return made.withColumn(out, c(value) + F.coalesce("_shift", F.lit(0.0))).drop("_shift")
    hits = [(s["sx"], s["sy"], s["hdd_normal"] - p["v"]) for s, p in _station_pixels(px, grid, value) if p["v"] is not None]
    x, y = _origin_xy(grid)
    surface = _interpolated(x, y, hits) if len(hits) >= 3 else None
    offset = F.lit(0.0) if surface is None else F.coalesce(surface, F.lit(0.0))
    return px.withColumn(out, c(value) + offset)


def station_bias_monthly(px: DataFrame, grid: Grid, *, value: str = "hdd", out: str = "corrected",
                         mode: str = "annual") -> DataFrame:
    """Station correction of twelve monthly HDD grids `(grid_id, row, col, month, value)`.

    `annual` takes every month's offset against the annual normal, so the months no longer sum to
    the annual grid. `scaled` shares the annual offset out by each month's part of the year.
    """
    if mode not in ("annual", "scaled"):
        raise ValueError(f"unknown mode {mode}")
    series: dict[str, dict] = {}
    for site, p in _station_pixels(px, grid, value, "month"):  # at most 11 stations x 12 months
        s = series.setdefault(site["station_id"], {"xy": (site["sx"], site["sy"]), "normal": site["hdd_normal"], "v": {}})
        s["v"][p["month"]] = p["v"]
    whole = {k: s for k, s in series.items() if len(s["v"]) == 12 and None not in s["v"].values()}
    if len(whole) < 3:
        return px.withColumn(out, c(value))
    pts = []
    for s in whole.values():
        year = sum(s["v"].values())
        offset = {m: (s["normal"] - v if mode == "annual" else (s["normal"] - year) * v / year if year else 0.0)
                  for m, v in s["v"].items()}
        by_month = F.element_at(F.array(*[F.lit(float(offset[m])) for m in range(1, 13)]), F.col("month").cast("int"))
        pts.append((*s["xy"], by_month))
    x, y = _origin_xy(grid)
    return px.withColumn(out, c(value) + F.coalesce(_interpolated(x, y, pts), F.lit(0.0)))


def wind_merge(px: DataFrame, grid: Grid | DataFrame, wind: DataFrame, *, value: str = "value", out: str = "wind_ms",
               sites: DataFrame | None = None) -> DataFrame:
    """Station wind where it can be interpolated, gridded wind elsewhere.

    `sites(station_id, lat, lon)` of any size, or a placement table of several grids, go through the triangle index.
    """
    if sites is not None or not isinstance(grid, Grid):
        from .triangles import interpolate
        at = _sites_on(grid, stations(px.sparkSession) if sites is None else sites).join(wind.select("station_id", "mean_wind_ms"), "station_id")
        made = interpolate(px, grid, checkpoint(at.drop("row", "col")), ["mean_wind_ms"], ["_blown"])
        return made.withColumn(out, F.coalesce("_blown", c(value))).drop("_blown")
    rows = (_placed(stations(px.sparkSession), grid).join(wind, "station_id")
            .where("mean_wind_ms is not null").select("station_id", "sx", "sy", "mean_wind_ms")
            .orderBy("station_id").collect())
    x, y = _origin_xy(grid)
    surface = _interpolated(x, y, [(r["sx"], r["sy"], r["mean_wind_ms"]) for r in rows]) if len(rows) >= 3 else None
    return px.withColumn(out, c(value) if surface is None else F.coalesce(surface, c(value)))


def wind_steering(px: DataFrame, grid: Grid, wind: DataFrame, *, value: str, base_station: str,
                  shadow: str = "wind_shadow") -> DataFrame:
    """Merged wind with its infiltration and stagnation multipliers."""
    merged = wind_merge(px, grid, wind, value=value, out="mean_wind_ms")
    return (merged.withColumn("wind_infiltration_mult", air.infiltration("mean_wind_ms", F.lit(base_station)))
            .withColumn("stagnation_mult", air.stagnation("mean_wind_ms", shadow)))
