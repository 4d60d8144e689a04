"""Catalogue: several grids in one table, runs over regions, and the whole normals run."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..operators import geometry, overlay, stations
from ..plans import runs
from ..sources import tables
from ..types import Grid, placements
from ..types import stations as station_table
from . import views as v
from .base import cte, query
from .formulas import _boxes, _regions
from .rasters import obs
from .zips import actual

# two grids with origins and pixel sizes of their own, cut from the columns of the one
TWO = {"w": Grid(a=100.0, c=0.0, e=-100.0, f=4000.0, n_cols=25), "e": Grid(a=90.0, c=2530.0, e=-85.0, f=3990.0, n_cols=25)}
cte("placed", "SELECT * FROM (VALUES " + ", ".join(f"('{k}', {g.a}::DOUBLE, {g.c}::DOUBLE, {g.e}::DOUBLE, {g.f}::DOUBLE)" for k, g in TWO.items()) + ") v(grid_id, a, c, e, f)")
cte("two", """SELECT *, c + a * (col + 0.5) AS x, f + e * (row + 0.5) AS y FROM (SELECT CASE WHEN col < 25 THEN 'w' ELSE 'e' END AS grid_id, row, col % 25 AS col, elev_m, p_size
    FROM pixels) JOIN placed USING (grid_id)""", "pixels", "placed")
cte("two_inside", """SELECT g.grid_id, g.row, g.col, e.id FROM two g JOIN edges e ON (e.y1 > g.y) <> (e.y2 > g.y) AND g.x < e.x1 + (g.y - e.y1) / (e.y2 - e.y1) * (e.x2 - e.x1)
    GROUP BY g.grid_id, g.row, g.col, e.id HAVING count(*) % 2 = 1""", "two", "edges")


def two(spark, d):
    """(pixels of two grids, their placement table)."""
    px = v.pixels(spark, d)
    n = px.agg(F.max("row")).first()[0] + 1
    px = px.withColumn("grid_id", F.when(F.col("col") < 25, "w").otherwise("e")).withColumn("col", F.col("col") % 25)
    return px, placements(spark, {k: replace(g, n_rows=n) for k, g in TWO.items()})


@query("pixels_two_grids", "SELECT grid_id, row, col, id FROM two_inside", use="two_inside")
def _(spark, d):
    px, grids = two(spark, d)
    return geometry.pixels_in_polygons(px.select("grid_id", "row", "col"), grids, v.polygons(spark, d))


@query("clip_two_grids", """SELECT p.grid_id, p.row, p.col, CASE WHEN i.row IS NOT NULL THEN elev_m END AS elev_m
    FROM two p, (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM points WHERE id % 3 = 0) b
    LEFT JOIN (SELECT DISTINCT grid_id, row, col FROM two_inside WHERE id % 3 = 0) i ON i.grid_id = p.grid_id AND i.row = p.row AND i.col = p.col
    WHERE p.row >= floor((y1 - f) / e) AND p.row < ceil((y0 - f) / e) AND p.col >= floor((x0 - c) / a) AND p.col < ceil((x1 - c) / a)""",
       use="two points two_inside", doubles="elev_m")
def _(spark, d):
    px, grids = two(spark, d)
    return geometry.clip(px.select("grid_id", "row", "col", "elev_m"), grids, v.polygons(spark, d).where("id % 3 = 0"), value="elev_m")


@query("roads_two_grids", """SELECT p.grid_id, p.row, p.col, coalesce(f2, 0) AS road_heat_flux_wm2, coalesce(f2 / 5.5 * 9 / 5, 0) AS road_temp_offset_f FROM two p LEFT JOIN (
    SELECT grid_id, row, col, sum(heat_flux_wm2) AS f2 FROM (SELECT grid_id, row, col, buf, heat_flux_wm2, x, y, x1, y1, x2, y2,
        greatest(0.0::DOUBLE, least(1.0::DOUBLE, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + pow(y2 - y1, 2)))) AS t
      FROM two g JOIN segments s ON x >= least(x1, x2) - buf AND x <= greatest(x1, x2) + buf AND y >= least(y1, y2) - buf AND y <= greatest(y1, y2) + buf)
    WHERE pow(x - x1 - t * (x2 - x1), 2) + pow(y - y1 - t * (y2 - y1), 2) <= buf * buf GROUP BY grid_id, row, col) USING (grid_id, row, col)""",
       use="two segments", doubles="road_heat_flux_wm2 road_temp_offset_f", digits=4)
def _(spark, d):
    px, grids = two(spark, d)
    return geometry.road_heat(px.select("grid_id", "row", "col"), grids, tables.road_heat_flux(v.roads(spark, d)))


# the union of a region's overlapping shapes holds the pixels that any of them holds
@query("region_boundary", "SELECT DISTINCT 'g' AS grid_id, row, col, 'R' || CAST(id % 5 AS VARCHAR) AS id FROM inside", use="inside")
def _(spark, d):
    whole = overlay.dissolve_rings(_regions(spark, d).select("id", "region_code", "rings"))
    return geometry.pixels_in_polygons(v.pixels(spark, d).select("grid_id", "row", "col"), v.GRID, whole.withColumnRenamed("region_code", "id"))


# the same surfaces through the triangle index, with the stations as a table
@query("station_bias_table", """SELECT h.grid_id, h.row, h.col, h.hdd,
    h.hdd + coalesce(wa * a.offset_ + wb * b.offset_ + (1 - wa - wb) * c.offset_, 0) AS corrected
    FROM annual_hdd h LEFT JOIN weights w USING (row, col) LEFT JOIN on_grid a ON a.station_id = ia
    LEFT JOIN on_grid b ON b.station_id = ib LEFT JOIN on_grid c ON c.station_id = ic""",
       use="weights annual_hdd on_grid", doubles="hdd corrected")
def _(spark, d):
    return stations.station_bias(tables.hdd_annual(v.temps(spark, d)), v.LONLAT, value="hdd", sites=station_table(spark))


@query("wind_merge_table", "SELECT grid_id, row, col, wind AS wind_ms FROM merged", use="merged", doubles="wind_ms")
def _(spark, d):
    px = v.pixels(spark, d).select("grid_id", "row", "col", (F.col("elev_m") / 200).alias("value"))
    return stations.wind_merge(px, v.LONLAT, stations.station_wind(obs(spark, d), with_p90=False), sites=station_table(spark)).drop("value")


cte("rcells", """SELECT a.id, CASE WHEN a.id % 2 = 0 THEN 'R1' ELSE 'R2' END AS region_code, CASE WHEN a.id % 2 = 0 THEN 'KPDX' ELSE 'KEUG' END AS base_station, n,
    'cell_' || lpad(CAST(row_number() OVER (PARTITION BY a.id ORDER BY a.iy, a.ix) AS VARCHAR), 3, '0') AS cell_id, base + elev - coalesce(uhi * 180, 0) AS effective_hdd
    FROM cell_area a LEFT JOIN (SELECT i.id, CAST(floor((x - minx) / 200) AS INTEGER) AS ix, CAST(floor((maxy - y) / 200) AS INTEGER) AS iy,
      CASE WHEN count(elev_m) > 0 THEN avg(elev_m * 3) END AS base, CASE WHEN count(elev_m) > 0 THEN avg(p_size * 2.0::DOUBLE) END AS elev,
      CASE WHEN count(elev_m) > 0 THEN avg(p_size / 50.0::DOUBLE) END AS uhi, count(elev_m) AS n FROM two_inside i JOIN two t USING (grid_id, row, col)
      JOIN (SELECT id, min(x) AS minx, max(y) AS maxy FROM points GROUP BY id) b ON b.id = i.id
      WHERE (i.id % 2 = 0) = (i.grid_id = 'w') GROUP BY 1, 2, 3) z ON z.id = a.id AND z.ix = a.ix AND z.iy = a.iy""", "cell_area", "two_inside", "two", "points")


@query("regions_run", """SELECT region_code, CAST(id AS VARCHAR) AS zip_code, base_station, cell_id, effective_hdd, coalesce(n, 0) AS num_valid_pixels FROM rcells
    UNION ALL SELECT region_code, CAST(id AS VARCHAR), base_station, 'aggregate', avg(effective_hdd), sum(coalesce(n, 0))::BIGINT FROM rcells GROUP BY ALL""",
       use="rcells", doubles="effective_hdd", digits=4)
def _(spark, d):
    px, grids = two(spark, d)
    px = px.select("grid_id", "row", "col", (F.col("elev_m") * 3).alias("prism_annual_hdd"), F.lit(1.0).alias("hdd_terrain_mult"),
                   (F.col("p_size") * 2.0).alias("hdd_elev_addition"), (F.col("p_size") / 50.0).alias("uhi_offset_f"), F.lit(0.0).alias("road_temp_offset_f"))
    regions = spark.createDataFrame([("R1", "w", "KPDX"), ("R2", "e", "KEUG")], "region_code string, grid_id string, base_station string")
    zips = v.polygons(spark, d).select(F.col("id").cast("string"), F.when(F.col("id") % 2 == 0, "R1").otherwise("R2").alias("region_code"), "rings")
    return runs.regions_run(px, grids, zips, regions, cell_size_m=200.0).select("region_code", "zip_code", "base_station", "cell_id", "effective_hdd", "num_valid_pixels")


# the whole run on rectangles; base degree days lie on a coarser grid
cte("coarse", "SELECT DISTINCT row // 2 AS row, col // 2 AS col, 2000.0::DOUBLE + (row // 2 * 7 + col // 2 * 13) % 50 * 80 AS value FROM pixels", "pixels")
cte("cbase", """SELECT t.row, t.col, sum(w * q.value) / nullif(sum(CASE WHEN q.value IS NOT NULL THEN w END), 0) AS base FROM (
    SELECT *, (dr * (fr - r0) + (1 - dr) * (1 - (fr - r0))) * (dc * (fc - c0) + (1 - dc) * (1 - (fc - c0))) AS w
    FROM (SELECT *, floor(fr) AS r0, floor(fc) AS c0 FROM (SELECT row, col, (row + 0.5) / 2 - 0.5 AS fr, (col + 0.5) / 2 - 0.5 AS fc FROM pixels)),
      (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) k(dr, dc)) t LEFT JOIN coarse q ON q.row = r0 + dr AND q.col = c0 + dc GROUP BY t.row, t.col""", "coarse", "pixels")
cte("fbox", """SELECT s_suppkey AS id, (s_suppkey * 37 % 480) * 10.0::DOUBLE + 3 AS x0, 3950 - (s_suppkey * 53 % 390) * 10.0::DOUBLE + 7 AS y0,
    150 + (s_suppkey % 17) * 20.0::DOUBLE AS w, 100 + (s_suppkey % 13) * 30.0::DOUBLE AS h FROM supplier""")
cte("fcell", """SELECT *, x0 + ix * 200.0::DOUBLE AS xa, least(x0 + w, x0 + (ix + 1) * 200.0::DOUBLE) AS xb, y0 - iy * 200.0::DOUBLE AS ya,
    greatest(y0 - h, y0 - (iy + 1) * 200.0::DOUBLE) AS yb, 'cell_' || lpad(CAST(row_number() OVER (PARTITION BY id ORDER BY iy, ix) AS VARCHAR), 3, '0') AS cell_id
    FROM fbox, (SELECT unnest(range(0, 4)) AS ix), (SELECT unnest(range(0, 4)) AS iy) WHERE ix * 200 < w AND iy * 200 < h""", "fbox")
cte("fpix", """SELECT b.id, CAST(floor((x - x0) / 200) AS INTEGER) AS ix, CAST(floor((y0 - y) / 200) AS INTEGER) AS iy, g.row, g.col, cbase.base, mult, elev_add, uhi, coalesce(road_f, 0) AS road_f, pos
    FROM (SELECT row, col, 100.0::DOUBLE * (col + 0.5) AS x, 4000.0 - 100.0::DOUBLE * (row + 0.5) AS y FROM pixels) g JOIN fbox b ON x >= x0 AND x < x0 + w AND y >= y0 - h AND y < y0
    JOIN cbase USING (row, col) JOIN nterrain USING (row, col) JOIN nsteer USING (row, col) JOIN fposition USING (row, col)""", "fbox", "cbase", "nterrain", "nsteer", "fposition")
cte("fposition", """SELECT p.row, p.col, CASE WHEN tpi IS NULL OR aspect_deg IS NULL OR slope_deg IS NULL THEN NULL WHEN tpi > 0 AND slope_deg > 25 THEN 'ridge'
    WHEN least(abs(aspect_deg - 225), 360 - abs(aspect_deg - 225)) <= 90 THEN 'windward' WHEN tpi < 0 THEN 'valley' ELSE 'leeward' END AS pos
    FROM aspect p LEFT JOIN ring r ON r.row = p.row AND r.col = p.col""", "aspect", "ring")
cte("fmean", """SELECT id, ix, iy, CASE WHEN count(base) > 0 THEN avg(base) END AS base, avg(mult) AS mult, avg(elev_add) AS elev_add, avg(uhi) AS uhi, avg(road_f) AS road_f, count(base) AS n
    FROM fpix GROUP BY 1, 2, 3""", "fpix")
cte("fpos", """SELECT id, ix, iy, arg_min(pos, (-k, pos)) AS pos FROM (SELECT id, ix, iy, pos, count(*) AS k FROM fpix WHERE pos IS NOT NULL GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3""", "fpix")
cte("fmonth", """SELECT id, ix, iy, month, avg(hdd) AS hdd FROM fpix JOIN month_hdd m ON m.row = fpix.row AND m.col = fpix.col WHERE base IS NOT NULL GROUP BY 1, 2, 3, 4""", "fpix", "month_hdd")
cte("fyear", """SELECT f.id, f.ix, f.iy, sum(hdd * mult + elev_add - coalesce(uhi * 180, 0) - coalesce(road_f * 180, 0)) AS year,
    max(CASE WHEN month = 1 THEN hdd * mult + elev_add - coalesce(uhi * 180, 0) - coalesce(road_f * 180, 0) END) AS jan
    FROM fmonth f JOIN fmean z ON z.id = f.id AND z.ix = f.ix AND z.iy = f.iy GROUP BY 1, 2, 3""", "fmonth", "fmean")


@query("normals_full", """SELECT CAST(c.id AS VARCHAR) AS zip_code, cell_id, CAST(p.nlcd_class AS VARCHAR) AS cell_type, pos AS terrain_position, (xb - xa) * (ya - yb) AS cell_area_sqm,
      coalesce(z.n, 0) AS num_valid_pixels, base * mult + elev_add - coalesce(uhi * 180, 0) - coalesce(road_f * 180, 0) AS effective_hdd, jan AS effective_hdd_jan, year AS effective_hdd_annual,
      (base * mult + elev_add - coalesce(uhi * 180, 0) - coalesce(road_f * 180, 0)) * (SELECT factor FROM factors WHERE station_code = 'KPDX') AS effective_hdd_adjusted
    FROM fcell c LEFT JOIN fmean z ON z.id = c.id AND z.ix = c.ix AND z.iy = c.iy LEFT JOIN fpos q ON q.id = c.id AND q.ix = c.ix AND q.iy = c.iy
    LEFT JOIN fyear y ON y.id = c.id AND y.ix = c.ix AND y.iy = c.iy LEFT JOIN pixels p ON p.col = floor((xa + xb) / 2 / 100) AND p.row = floor((4000 - (ya + yb) / 2) / 100)""",
       use="fcell fmean fpos fyear pixels factors", doubles="cell_area_sqm effective_hdd effective_hdd_jan effective_hdd_annual effective_hdd_adjusted", digits=3)
def _(spark, d):
    return normals_full(spark, d)[0].where("cell_id <> 'aggregate'").select(
        "zip_code", "cell_id", "cell_type", "terrain_position", "cell_area_sqm", "num_valid_pixels", "effective_hdd", "effective_hdd_jan", "effective_hdd_annual", "effective_hdd_adjusted")


def normals_full(spark, d):
    px = v.pixels(spark, d)
    n_rows = px.agg(F.max("row")).first()[0] + 1
    grid = replace(v.GRID, n_rows=n_rows, n_cols=50)

    def band(value):
        return px.select("grid_id", "row", "col", value.alias("value"))

    coarse = px.select("grid_id", F.expr("row div 2").alias("row"), F.expr("col div 2").alias("col")).distinct()
    coarse = coarse.withColumn("value", 2000.0 + (F.col("row") * 7 + F.col("col") * 13) % 50 * 80)
    layers = {"impervious": (tables.impervious_ingest(band(F.col("imperv_raw"))), grid), "wind": (band(F.col("p_size") / 10.0), grid),
              "base_hdd": (coarse, Grid(a=200.0, c=0.0, e=-200.0, f=4000.0, n_rows=-(-n_rows // 2), n_cols=25))}
    months = tables.hdd_monthly(v.temps(spark, d)).withColumnRenamed("hdd", "base_hdd")
    return runs.normals_full(
        px.select("grid_id", "row", "col", "elev_m"), grid, _boxes(spark, d).withColumn("id", F.col("id").cast("string")), region_code="R1", base_station="KPDX",
        station_elevation_ft=30.0, layers=layers, landcover=px.select("grid_id", "row", "col", F.col("nlcd_class").alias("value")), roads=tables.road_heat_flux(v.roads(spark, d)),
        station_wind=stations.station_wind(obs(spark, d), with_p90=False), monthly=months, actual=actual(spark, d), cell_size_m=200.0, tile=64)
