"""Catalogue: focal operators, drainage and station surfaces."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import hydrology, raster, stations, zonal
from . import views as v
from .base import cte, query

KEY = "grid_id, row, col"
cte("extent", "SELECT max(row) + 1 AS nr, max(col) + 1 AS nc, avg(elev_m) AS mean_z FROM pixels", "pixels")
cte("filled", "SELECT row, col, coalesce(elev_m, mean_z) AS z FROM pixels, extent", "pixels", "extent")
# border cells join no neighbour on one side, which leaves their differences NULL
cte("gradient", """SELECT p.row, p.col, (s.z - n.z) / 2 AS dy, (e.z - w.z) / 2 AS dx FROM pixels p
    LEFT JOIN filled n ON n.row = p.row - 1 AND n.col = p.col LEFT JOIN filled s ON s.row = p.row + 1 AND s.col = p.col
    LEFT JOIN filled w ON w.row = p.row AND w.col = p.col - 1 LEFT JOIN filled e ON e.row = p.row AND e.col = p.col + 1
    WHERE p.elev_m IS NOT NULL""", "pixels", "filled")
cte("aspect", """SELECT p.grid_id, p.row, p.col, p.elev_m, ((90 - degrees(atan2(dy, dx))) % 360 + 360) % 360 AS aspect_deg,
    degrees(atan(sqrt(dx * dx + dy * dy))) AS slope_deg FROM pixels p LEFT JOIN gradient g ON g.row = p.row AND g.col = p.col""",
    "pixels", "gradient")
cte("ring", """SELECT p.row, p.col, p.elev_m - (avg(q.z) * pi() * 100 - avg(CASE WHEN abs(q.row - p.row) <= 3 AND abs(q.col - p.col) <= 3 THEN q.z END)
      * pi() * 9) / (pi() * 91) AS tpi FROM pixels p, extent, filled q WHERE p.elev_m IS NOT NULL AND p.row >= 10 AND p.row < nr - 10
      AND p.col >= 10 AND p.col < nc - 10 AND q.row BETWEEN p.row - 10 AND p.row + 10 AND q.col BETWEEN p.col - 10 AND p.col + 10
    GROUP BY p.row, p.col, p.elev_m""", "pixels", "extent", "filled")


def dem(spark, d):
    return v.pixels(spark, d).select("grid_id", "row", "col", "elev_m")


@query("aspect_slope", "SELECT * FROM aspect", use="aspect", doubles="elev_m aspect_deg slope_deg")
def _(spark, d):
    return raster.aspect_slope(dem(spark, d), tile=64)


@query("tpi", "SELECT p.grid_id, p.row, p.col, p.elev_m, tpi FROM pixels p LEFT JOIN ring r ON r.row = p.row AND r.col = p.col",
       use="pixels ring", doubles="elev_m tpi")
def _(spark, d):
    return raster.tpi(dem(spark, d), pixel_size_m=100.0)


@query("terrain", """SELECT a.*, tpi, CASE WHEN tpi IS NULL OR aspect_deg IS NULL THEN NULL WHEN tpi < 0 AND least(abs(aspect_deg - 45),
      360 - abs(aspect_deg - 45)) <= 90 THEN 1 ELSE 0 END AS wind_shadow,
    CASE WHEN tpi IS NULL OR aspect_deg IS NULL OR slope_deg IS NULL THEN NULL WHEN tpi > 0 AND slope_deg > 25 THEN 'ridge'
      WHEN least(abs(aspect_deg - 225), 360 - abs(aspect_deg - 225)) <= 90 THEN 'windward' WHEN tpi < 0 THEN 'valley' ELSE 'leeward' END AS terrain_position,
    (a.elev_m * 3.28084 - 30) / 1000 * 630 AS hdd_elev_addition FROM aspect a LEFT JOIN ring r ON r.row = a.row AND r.col = a.col""",
       use="aspect ring", doubles="elev_m aspect_deg slope_deg tpi hdd_elev_addition")
def _(spark, d):
    return raster.terrain(dem(spark, d), station_elevation_ft=30.0, pixel_size_m=100.0, tile=64)


cte("log_z0", """SELECT p.row, p.col, CASE WHEN p.nlcd_class IS NOT NULL THEN ln(CASE WHEN z0_m > 0 THEN z0_m ELSE 0.03 END) END AS z
    FROM pixels p LEFT JOIN landcover USING (nlcd_class)""", "pixels", "landcover")
cte("sobel", """SELECT p.row, p.col, sum(q.z * dc * (2 - abs(dr))) AS gx, sum(q.z * dr * (2 - abs(dc))) AS gy, count(q.z) AS n
    FROM pixels p, extent, (SELECT unnest([-1,-1,-1,0,0,0,1,1,1]) AS dr, unnest([-1,0,1,-1,0,1,-1,0,1]) AS dc) k, log_z0 q
    WHERE q.row = greatest(0, least(nr - 1, p.row + dr)) AND q.col = greatest(0, least(nc - 1, p.col + dc)) GROUP BY p.row, p.col""",
    "pixels", "extent", "log_z0")


@query("surface_mask", """SELECT p.nlcd_class, p.grid_id, p.row, p.col, z0_m, albedo, emissivity, displacement_height_m,
    CASE WHEN n = 9 THEN sqrt(gx * gx + gy * gy) END AS roughness_gradient,
    coalesce(n = 9 AND sqrt(gx * gx + gy * gy) > 0.3, false) AS roughness_transition
    FROM pixels p LEFT JOIN landcover USING (nlcd_class) JOIN sobel s ON s.row = p.row AND s.col = p.col""",
       use="pixels landcover sobel", doubles="z0_m albedo emissivity displacement_height_m roughness_gradient")
def _(spark, d):
    return raster.surface_mask(v.pixels(spark, d).select("grid_id", "row", "col", "nlcd_class"), tile=64)


cte("step", "SELECT unnest([1,2,4,8,16,32,64,128]) AS code, unnest([0,1,1,1,0,-1,-1,-1]) AS dr, unnest([1,1,0,-1,-1,-1,0,1]) AS dc, unnest(range(8)) AS ord")
cte("drop_", """SELECT p.row, p.col, code, p.row + dr AS to_row, p.col + dc AS to_col,
    row_number() OVER (PARTITION BY p.row, p.col ORDER BY (p.elev_m - q.elev_m) / CASE WHEN dr <> 0 AND dc <> 0 THEN sqrt(2) ELSE 1 END DESC, ord) AS k
    FROM pixels p, step, pixels q WHERE q.row = p.row + dr AND q.col = p.col + dc AND q.elev_m < p.elev_m""", "pixels", "step")
cte("flow", "SELECT row, col, code, to_row, to_col FROM drop_ WHERE k = 1", "drop_")
cte("walk", """SELECT row AS from_row, col AS from_col, row, col FROM pixels WHERE elev_m IS NOT NULL
    UNION ALL SELECT w.from_row, w.from_col, f.to_row, f.to_col FROM walk w JOIN flow f ON f.row = w.row AND f.col = w.col""", "pixels", "flow")
cte("acc", "SELECT row, col, count(*)::DOUBLE AS acc FROM walk GROUP BY row, col", "walk")
cte("acc_all", """SELECT p.grid_id, p.row, p.col, CAST(coalesce(code, 0) AS INTEGER) AS flow_dir, acc AS flow_accumulation,
    acc / (SELECT max(acc) FROM acc) AS drainage_intensity FROM pixels p LEFT JOIN flow f ON f.row = p.row AND f.col = p.col
    LEFT JOIN acc a ON a.row = p.row AND a.col = p.col""", "pixels", "flow", "acc")


@query("flow_direction", f"SELECT {KEY}, flow_dir FROM acc_all", use="acc_all", recursive=True)
def _(spark, d):
    return hydrology.flow_direction(dem(spark, d), tile=64).select("grid_id", "row", "col", "flow_dir")


@query("flow_accumulation", f"SELECT {KEY}, flow_dir, flow_accumulation FROM acc_all", use="acc_all", recursive=True, doubles="flow_accumulation")
def _(spark, d):
    return _accumulated(spark, d)


def _accumulated(spark, d):
    flow = hydrology.flow_direction(dem(spark, d), tile=64)
    return hydrology.flow_accumulation(flow.withColumn("valid", F.col("elev_m").isNotNull()), tile=64)


@query("drainage_intensity", f"SELECT {KEY}, flow_dir, flow_accumulation, drainage_intensity FROM acc_all", use="acc_all", recursive=True,
       doubles="flow_accumulation drainage_intensity")
def _(spark, d):
    return hydrology.drainage_intensity(_accumulated(spark, d))


@query("cold_air_drainage", "SELECT *, 1 + drainage_intensity * 0.15 AS cold_air_mult FROM acc_all", use="acc_all", recursive=True,
       doubles="flow_accumulation drainage_intensity cold_air_mult")
def _(spark, d):
    return hydrology.cold_air_drainage(dem(spark, d), tile=64)


# a pixel band in percent, cut into zones of ten columns
cte("clean", """SELECT grid_id, row, col, 'z' || CAST(col // 10 AS VARCHAR) AS zip_code, CASE WHEN imperv_raw NOT IN (127, 255)
    THEN least(100.0::DOUBLE, greatest(0.0::DOUBLE, imperv_raw)) END AS impervious_pct, (p_size * 7.0::DOUBLE) % 360 AS aspect_deg, lst_c FROM pixels""", "pixels")
cte("modelled", """SELECT *, least(0.20, greatest(0.05, 0.20 - impervious_pct / 100 * 0.15)) AS alb FROM clean WHERE impervious_pct IS NOT NULL
    UNION ALL SELECT *, NULL FROM clean WHERE impervious_pct IS NULL""", "clean")
cte("offset_", "SELECT *, (0.20 - alb) * 200 / 5.5 * 9 / 5 AS off FROM modelled", "modelled")
cte("calib", """SELECT zip_code, CASE WHEN nu >= 10 AND nr >= 10 THEN 0.7 * m + 0.3 * (lu - lr) * 9 / 5 END AS cal,
    nu >= 10 AND nr >= 10 AND abs(lu - lr - m * 5 / 9) > 1.5 AS warn FROM (SELECT zip_code, count(*) FILTER (impervious_pct >= 50 AND lst_c IS NOT NULL) AS nu,
      count(*) FILTER (impervious_pct <= 10 AND lst_c IS NOT NULL) AS nr, avg(lst_c) FILTER (impervious_pct >= 50) AS lu,
      avg(lst_c) FILTER (impervious_pct <= 10) AS lr, avg(off) AS m FROM offset_ GROUP BY zip_code)""", "offset_")


def _clean(spark, d):
    from ..functions.surface import impervious_clean
    return v.pixels(spark, d).select(
        "grid_id", "row", "col", F.concat(F.lit("z"), F.expr("col div 10").cast("string")).alias("zip_code"),
        impervious_clean("imperv_raw").alias("impervious_pct"), (F.col("p_size") * 7.0 % 360).alias("aspect_deg"), "lst_c")


@query("uhi_calibrate", f"""SELECT {KEY}, zip_code, CASE WHEN off IS NOT NULL THEN coalesce(cal, off) END AS uhi_offset_f, warn AS warned
    FROM offset_ JOIN calib USING (zip_code)""", use="offset_ calib", doubles="uhi_offset_f")
def _(spark, d):
    return zonal.thermal(_clean(spark, d), lst="lst_c").select(
        "grid_id", "row", "col", "zip_code", "uhi_offset_f", F.col("calibration_warning").isNotNull().alias("warned"))


@query("thermal", f"""SELECT {KEY}, zip_code, alb AS surface_albedo, 1 + 0.2 * cos(radians(aspect_deg - 180)) AS solar_aspect_mult, off AS uhi_offset_f
    FROM offset_""", use="offset_", doubles="surface_albedo solar_aspect_mult uhi_offset_f")
def _(spark, d):
    return zonal.thermal(_clean(spark, d)).select("grid_id", "row", "col", "zip_code", "surface_albedo", "solar_aspect_mult", "uhi_offset_f")


# station readings from events, some of them no numbers
cte("obs", f"""SELECT {v.sql_list(v.IDS)}[user_id % 11 + 1] AS station_id, CASE WHEN event_type = 'error' THEN NULL ELSE value / 25 END AS wind_ms FROM events""")
cte("station_mean", """SELECT station_id, avg(wind_ms) AS mean_wind_ms, quantile_cont(wind_ms, 0.9) AS p90_wind_ms, count(*) AS num_obs
    FROM obs WHERE wind_ms IS NOT NULL GROUP BY station_id""", "obs")


def obs(spark, d):
    from .base import table
    return table(spark, d, "events").select(
        F.element_at(v.array_of(v.IDS), (F.col("user_id") % 11 + 1).cast("int")).alias("station_id"), "ts",
        F.when(F.col("event_type") == "error", "n/a").otherwise((F.col("value") / 25).cast("string")).alias("wind_speed_set_1"))


@query("station_wind", "SELECT * FROM station_mean", use="station_mean", doubles="mean_wind_ms p90_wind_ms")
def _(spark, d):
    return stations.station_wind(obs(spark, d))


def _tables():
    from .formulas import TRIANGLES, WEIGHTS
    cte("windy", "SELECT s.station_id, s.lon AS x, s.lat AS y, mean_wind_ms FROM stations s JOIN station_mean m USING (station_id)", "stations", "station_mean")
    cte("wind_tri", TRIANGLES.format(site="windy"), "windy")
    cte("wind_weights", f"""SELECT * FROM ({WEIGHTS.format(tri='wind_tri')}) WHERE wa >= -1e-9 AND wb >= -1e-9 AND 1 - wa - wb >= -1e-9
        QUALIFY row_number() OVER (PARTITION BY row, col ORDER BY tri) = 1""", "wind_tri", "pixels")
    cte("merged", """SELECT p.grid_id, p.row, p.col, coalesce(wa * a.mean_wind_ms + wb * b.mean_wind_ms + (1 - wa - wb) * c.mean_wind_ms,
        elev_m / 200) AS wind FROM pixels p LEFT JOIN wind_weights w ON w.row = p.row AND w.col = p.col LEFT JOIN windy a ON a.station_id = ia
        LEFT JOIN windy b ON b.station_id = ib LEFT JOIN windy c ON c.station_id = ic""", "pixels", "wind_weights", "windy")


_tables()


def _wind_px(spark, d):
    return v.pixels(spark, d).select("grid_id", "row", "col", (F.col("elev_m") / 200).alias("value"), (F.col("row") % 2).alias("wind_shadow"))


@query("wind_merge", "SELECT grid_id, row, col, wind AS wind_ms FROM merged", use="merged", doubles="wind_ms")
def _(spark, d):
    return stations.wind_merge(_wind_px(spark, d).drop("wind_shadow"), v.LONLAT, stations.station_wind(obs(spark, d), with_p90=False)).drop("value")


@query("wind_steering", """SELECT grid_id, row, col, wind AS mean_wind_ms, greatest(1.15, 1 + 0.015 * greatest(0, wind - 3))
      * CASE WHEN wind IS NOT NULL THEN 1 END AS wind_infiltration_mult,
    CASE WHEN wind IS NULL THEN NULL WHEN wind > 5 AND row % 2 = 0 THEN 0.7::DOUBLE WHEN wind < 3 AND row % 2 = 1 THEN 1.3::DOUBLE ELSE 1.0::DOUBLE END AS stagnation_mult
    FROM merged""", use="merged", doubles="mean_wind_ms wind_infiltration_mult stagnation_mult")
def _(spark, d):
    return stations.wind_steering(_wind_px(spark, d), v.LONLAT, stations.station_wind(obs(spark, d), with_p90=False), value="value",
                                  base_station="KTTD").drop("value", "wind_shadow")
