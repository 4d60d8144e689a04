"""Catalogue: hourly analyses, profiles, cubes, composed runs and streaming."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..operators import cubes, quality, timeseries
from ..plans import runs
from ..session import scratch_folder
from ..sources import sinks, tables
from ..streaming import cycles
from ..types import ALTITUDES_FT, PRESSURE_LEVELS_MB
from . import views as v
from .base import cte, query, table

TF = "((t2m_k - 273.15) * 9 / 5 + 32)"
cte("day", "SELECT CAST(ts AS DATE) AS date, zip_code, (avg(t2m_k) - 273.15) * 9 / 5 + 32 AS temp_f, count(t2m_k) AS num_hours FROM hours GROUP BY 1, 2", "hours")
ZIP = ("zip_code",)


@query("daily_mean_temp", "SELECT * FROM day", use="day", doubles="temp_f")
def _(spark, d):
    return timeseries.daily_mean(v.hours(spark, d), keys=ZIP)


cte("clim", """SELECT month, zip_code, avg(y) AS clim_f, count(*) AS num_years FROM (SELECT CAST(month(date) AS INTEGER) AS month, year(date) AS yr, zip_code, avg(temp_f) AS y
    FROM daily_temp GROUP BY ALL) GROUP BY month, zip_code""", "daily_temp")


def clim(spark, d):
    return timeseries.climatology(v.daily_temp(spark, d).withColumnRenamed("date", "ts"), keys=ZIP, check=False)


@query("climatology", "SELECT * FROM clim", use="clim", doubles="clim_f")
def _(spark, d):
    return clim(spark, d)


@query("bias_field", "SELECT month, zip_code, normal_f - clim_f AS bias_f FROM normals JOIN clim USING (month, zip_code)", use="normals clim", doubles="bias_f")
def _(spark, d):
    return timeseries.bias_field(v.normals(spark, d), clim(spark, d), keys=ZIP)


cte("own", "SELECT zip_code, avg(temp_f) AS own_f FROM daily_temp GROUP BY 1", "daily_temp")
cte("corrected", """SELECT CAST(month(date) AS INTEGER) AS month, t.zip_code, date, temp_f, normal_f, normal_f - coalesce(clim_f, own_f) AS bias_f, temp_f + (normal_f - coalesce(clim_f, own_f)) AS adjusted_f
    FROM daily_temp t LEFT JOIN normals n ON n.zip_code = t.zip_code AND n.month = month(date) LEFT JOIN (SELECT * FROM clim WHERE month <> 6) c ON c.zip_code = t.zip_code AND c.month = month(date)
    LEFT JOIN own o ON o.zip_code = t.zip_code""", "daily_temp", "normals", "clim", "own")


def corrected(spark, d):
    # June has no climatology, so the mean of the daily field stands in
    return timeseries.bias_correct(v.daily_temp(spark, d), v.normals(spark, d), clim(spark, d).where("month <> 6"), keys=ZIP, strict=False)


@query("bias_correct", "SELECT month, zip_code, date, temp_f, bias_f, adjusted_f FROM corrected", use="corrected", doubles="temp_f bias_f adjusted_f")
def _(spark, d):
    return corrected(spark, d)


@query("bias_correct_fallback", """SELECT CAST(month(date) AS INTEGER) AS month, t.zip_code, date, temp_f, normal_f - own_f AS bias_f, temp_f + (normal_f - own_f) AS adjusted_f
    FROM daily_temp t LEFT JOIN normals n ON n.zip_code = t.zip_code AND n.month = month(date) LEFT JOIN own o ON o.zip_code = t.zip_code""", use="daily_temp normals own",
       doubles="temp_f bias_f adjusted_f")
def _(spark, d):
    return timeseries.bias_correct(v.daily_temp(spark, d), v.normals(spark, d), keys=ZIP, strict=False)


@query("bias_validate", """SELECT avg(x) AS mean_diff, max(abs(x)) AS max_diff, 100.0 * count(*) FILTER (abs(x) <= 20) / count(*) AS pct_within_tolerance,
    count(*) - count(*) FILTER (abs(x) <= 20) AS num_outliers, coalesce(avg(x) < 20 AND 100.0 * count(*) FILTER (abs(x) <= 20) / count(*) > 95, false) AS passed FROM (SELECT adjusted_f - normal_f AS x FROM corrected)""",
       use="corrected", doubles="mean_diff max_diff pct_within_tolerance")
def _(spark, d):
    c = corrected(spark, d).join(v.normals(spark, d), ["zip_code", "month"], "left")
    return timeseries.bias_validate(c, tolerance=20.0)


# --- vertical profiles ----------------------------------------------------------
cte("alts", f"SELECT CAST(unnest({v.sql_list(ALTITUDES_FT)}) AS INTEGER) AS altitude_ft")
cte("target", """SELECT *, ln(greatest(500.0, least(1000.0, sp_mb * exp(-9.81 * (altitude_ft / 3.28084) / (287.05 * (t2m_k - 0.0065 * (altitude_ft / 3.28084))))))) AS q
    FROM hours, alts""", "hours", "alts")
# the bracketing pair: the last level at or below the target and the first one at or above it
cte("interp", """SELECT t.ts, t.zip_code, altitude_ft, t2m_k, u10, v10,
    lo.u + CASE WHEN hi.level_mb = lo.level_mb THEN 0 ELSE (q - ln(lo.level_mb)) / (ln(hi.level_mb) - ln(lo.level_mb)) * (hi.u - lo.u) END AS ui,
    lo.v + CASE WHEN hi.level_mb = lo.level_mb THEN 0 ELSE (q - ln(lo.level_mb)) / (ln(hi.level_mb) - ln(lo.level_mb)) * (hi.v - lo.v) END AS vi,
    lo.t_k + CASE WHEN hi.level_mb = lo.level_mb THEN 0 ELSE (q - ln(lo.level_mb)) / (ln(hi.level_mb) - ln(lo.level_mb)) * (hi.t_k - lo.t_k) END AS ti
    FROM (SELECT *, list_max(list_filter(lv, lambda x: ln(x) <= q + 1e-13)) AS l0, list_min(list_filter(lv, lambda x: ln(x) >= q - 1e-13)) AS l1 FROM target, (SELECT list(DISTINCT level_mb) AS lv FROM levels)) t
    JOIN prs lo ON lo.ts = t.ts AND lo.zip_code = t.zip_code AND lo.level_mb = l0 JOIN prs hi ON hi.ts = t.ts AND hi.zip_code = t.zip_code AND hi.level_mb = l1""", "target", "levels", "prs")
cte("wind", """SELECT ts, zip_code, altitude_ft, sqrt(u * u + v * v) AS wind_speed_ms, (degrees(atan2(u, v)) + 360) % 360 AS wind_direction_deg, t AS temperature_k,
    (t - 273.15) * 9 / 5 + 32 AS temperature_f FROM (SELECT ts, zip_code, altitude_ft, CASE altitude_ft WHEN 0 THEN u10 ELSE ui END AS u, CASE altitude_ft WHEN 0 THEN v10 ELSE vi END AS v,
      CASE altitude_ft WHEN 0 THEN t2m_k ELSE ti END AS t FROM interp)""", "interp")


def profiles(spark, d):
    h = v.hours(spark, d)
    return timeseries.wind_profiles(h, v.prs(h), levels_unique=True)  # hours hold one row per ZIP


# a level's values are arithmetic on the hour's, so the brackets need no join here
cte("bracket", f"""SELECT *, list_max(list_filter({v.sql_list(PRESSURE_LEVELS_MB)}, lambda x: ln(x) <= q + 1e-13)) AS l0,
    list_min(list_filter({v.sql_list(PRESSURE_LEVELS_MB)}, lambda x: ln(x) >= q - 1e-13)) AS l1 FROM target""", "target")


@query("profile_interp", """SELECT ts, zip_code, altitude_ft, t0 + CASE WHEN l1 = l0 THEN 0 ELSE (q - ln(l0)) / (ln(l1) - ln(l0)) * (t1 - t0) END AS t_k
    FROM (SELECT *, t2m_k - (1000 - l0) / 15.0::DOUBLE AS t0, t2m_k - (1000 - l1) / 15.0::DOUBLE AS t1 FROM bracket) WHERE altitude_ft > 0""", use="bracket", doubles="t_k")
def _(spark, d):
    return profiles(spark, d).where("altitude_ft > 0").select("ts", "zip_code", "altitude_ft", F.col("temperature_k").alias("t_k"))


@query("wind_profiles", "SELECT * FROM wind", use="wind", doubles="wind_speed_ms wind_direction_deg temperature_k temperature_f")
def _(spark, d):
    return profiles(spark, d)


cte("alt_hdd", "SELECT zip_code, ts, altitude_ft, temperature_f + 1.5 AS temp_adjusted_f, greatest(0, 60 - (temperature_f + 1.5)) AS hdd FROM wind", "wind")


def altitude(spark, d):
    return timeseries.altitude_process(profiles(spark, d), bias=1.5, base_f=60.0).select("zip_code", "ts", "altitude_ft", "temp_adjusted_f", "hdd")


@query("altitude_process", "SELECT * FROM alt_hdd", use="alt_hdd", doubles="temp_adjusted_f hdd")
def _(spark, d):
    return altitude(spark, d)


WIDE = [(a, "sfc" if a == 0 else f"{a}ft") for a in ALTITUDES_FT]
WIDE_COLS = [n for _, t in WIDE for n in (f"temp_{t}_adjusted_f", f"hdd_{t}")]


@query("profile_wide", "SELECT zip_code, ts, " + ", ".join(
    f"max(temp_adjusted_f) FILTER (altitude_ft = {a}) AS temp_{t}_adjusted_f, max(hdd) FILTER (altitude_ft = {a}) AS hdd_{t}" for a, t in WIDE)
    + " FROM alt_hdd GROUP BY zip_code, ts", use="alt_hdd", doubles=" ".join(WIDE_COLS))
def _(spark, d):
    return cubes.profile_wide(altitude(spark, d), keys=("zip_code", "ts"))


@query("profile_monotonic", """SELECT zip_code, ts, count(*) FILTER (dt > 0) AS temp_rises, count(*) FILTER (dh < 0) AS hdd_falls FROM (SELECT zip_code, ts,
    temp_adjusted_f - lag(temp_adjusted_f) OVER w AS dt, hdd - lag(hdd) OVER w AS dh FROM alt_hdd WINDOW w AS (PARTITION BY zip_code, ts ORDER BY altitude_ft)) GROUP BY zip_code, ts""", use="alt_hdd")
def _(spark, d):
    return timeseries.profile_monotonic(altitude(spark, d), keys=("zip_code", "ts"))


# --- daily rows and cubes ----------------------------------------------------------
cte("hclim", "SELECT zip_code, avg(temp_f) AS own_f FROM day GROUP BY 1", "day")
cte("adj", """SELECT d.date, d.zip_code, temp_f, coalesce(normal_f - own_f, 0) AS bias_f, temp_f + coalesce(normal_f - own_f, 0) AS adjusted_f FROM day d JOIN hclim USING (zip_code)
    LEFT JOIN normals n ON n.zip_code = d.zip_code AND n.month = month(d.date)""", "day", "hclim", "normals")
cte("first_hour", "SELECT CAST(ts AS DATE) AS date, min(ts) AS ts FROM hours GROUP BY 1", "hours")
cte("prof", """SELECT f.date, w.zip_code, altitude_ft, temperature_f AS raw_f, temperature_f + bias_f AS temp_adjusted_f, wind_speed_ms * 1.94384 AS wind_speed_kt, wind_direction_deg AS wind_dir_deg,
    greatest(0, 65 - (temperature_f + bias_f)) AS hdd FROM wind w JOIN first_hour f USING (ts) JOIN adj a ON a.date = f.date AND a.zip_code = w.zip_code""", "wind", "first_hour", "adj")
cte("zt", "SELECT zip_code, hdd_terrain_mult, hdd_elev_addition, hdd_uhi_reduction, hdd_traffic_reduction FROM terrain WHERE cell_id = 'aggregate'", "terrain")
UP = [a for a in ALTITUDES_FT if a]
cte("daily", """SELECT a.date, a.zip_code, a.bias_f, temp_f AS raw_temp_f, adjusted_f AS adjusted_temp_f, greatest(0, greatest(0, 65 - adjusted_f) * hdd_terrain_mult + hdd_elev_addition - hdd_uhi_reduction
      - hdd_traffic_reduction) AS daily_effective_hdd, greatest(0, 65 - adjusted_f) AS hdd_sfc, p.* EXCLUDE (date, zip_code) FROM adj a JOIN zt USING (zip_code) LEFT JOIN (SELECT date, zip_code,
      max(wind_speed_kt) FILTER (altitude_ft = 0) AS wind_speed_sfc_kt, max(wind_dir_deg) FILTER (altitude_ft = 0) AS wind_dir_sfc_deg, """
    + ", ".join(f"max(raw_f) FILTER (altitude_ft = {a}) AS temp_{a}ft_raw_f, max(temp_adjusted_f) FILTER (altitude_ft = {a}) AS temp_{a}ft_adjusted_f, max(wind_speed_kt) FILTER (altitude_ft = {a}) AS wind_speed_{a}ft_kt, "
                f"max(wind_dir_deg) FILTER (altitude_ft = {a}) AS wind_dir_{a}ft_deg, max(hdd) FILTER (altitude_ft = {a}) AS hdd_{a}ft" for a in UP)
    + " FROM prof GROUP BY date, zip_code) p ON p.date = a.date AND p.zip_code = a.zip_code", "adj", "zt", "prof")
DAILY = ["raw_temp_f", "adjusted_temp_f", "daily_effective_hdd", "hdd_sfc", "wind_speed_sfc_kt", "wind_dir_sfc_deg"] + [
    n for a in UP for n in (f"temp_{a}ft_raw_f", f"temp_{a}ft_adjusted_f", f"wind_speed_{a}ft_kt", f"wind_dir_{a}ft_deg", f"hdd_{a}ft")]


def daily(spark, d):
    h = v.hours(spark, d)
    return runs.daily_run(h, v.prs(h), v.normals(spark, d), v.terrain(spark, d), levels_unique=True)


@query("daily_combine", f"SELECT date, zip_code, bias_f, {', '.join(DAILY)} FROM daily", use="daily", doubles="bias_f " + " ".join(f"{k}" for k in DAILY))
def _(spark, d):
    return daily(spark, d)[0].select("date", "zip_code", "bias_f", *DAILY)


DA = "greatest(0, {pa} + 120 * (temp_adjusted_f - ((15 - {pa} / 1000 * 0.0065 * 1000 / 0.3048) * 9 / 5 + 32)))".format(pa="(145442 * (1 - pow(1013.25 * 0.02953 / 29.92126, 0.190263)))")
TKE = "CASE WHEN wind_speed_kt <= 0 THEN 0 ELSE 0.5 * pow(wind_speed_kt / 1.94384 * 0.41 / ln(10 / 0.1), 2) * (1 + 2 * 0.1 / 0.03) END"
FLAG = "CASE WHEN tke_m2s2 < 0.5 THEN 'smooth' WHEN tke_m2s2 < 1.5 THEN 'light' WHEN tke_m2s2 < 3 THEN 'moderate' ELSE 'severe' END AS turbulence_flag"
cte("long", "SELECT date, zip_code, 0 AS altitude_ft, adjusted_temp_f AS temp_adjusted_f, wind_speed_sfc_kt AS wind_speed_kt, wind_dir_sfc_deg AS wind_dir_deg, hdd_sfc AS hdd FROM daily WHERE wind_speed_sfc_kt IS NOT NULL"
    + "".join(f" UNION ALL SELECT date, zip_code, {a}, temp_{a}ft_adjusted_f, wind_speed_{a}ft_kt, wind_dir_{a}ft_deg, hdd_{a}ft FROM daily WHERE temp_{a}ft_adjusted_f IS NOT NULL AND wind_speed_{a}ft_kt IS NOT NULL" for a in UP), "daily")
cte("cube", f"SELECT *, {FLAG} FROM (SELECT *, {TKE} AS tke_m2s2, 0.0::DOUBLE AS wind_shear_kt_per_100ft, {DA} AS density_altitude_ft FROM long)", "long")


@query("cube_unpivot", "SELECT date, zip_code, altitude_ft, temp_adjusted_f, wind_speed_kt, wind_dir_deg, hdd FROM long", use="long", doubles="temp_adjusted_f wind_speed_kt wind_dir_deg hdd")
def _(spark, d):
    return cubes.cube_unpivot(daily(spark, d)[0]).drop("z0_m", "shear_kt", "region_code")


CUBE = "temp_adjusted_f wind_speed_kt wind_dir_deg hdd tke_m2s2 wind_shear_kt_per_100ft density_altitude_ft"


@query("safety_cube", "SELECT * FROM cube", use="cube", doubles=CUBE)
def _(spark, d):
    return daily(spark, d)[1]


cte("hprof", f"""SELECT ts, zip_code, altitude_ft, {TF} - altitude_ft / 1000.0 * 3.5 AS temp_adjusted_f, sqrt(u10 * u10 + v10 * v10) * 1.94384 * (1 + 0.1 * (altitude_ft / 1000.0)) AS wind_speed_kt,
    (degrees(atan2(u10, v10)) + 360) % 360 AS wind_dir_deg FROM hours, alts""", "hours", "alts")
cte("hcube", f"""SELECT ts AS datetime_utc, *, {FLAG} FROM (SELECT h.*, {TKE} AS tke_m2s2, 0.0::DOUBLE AS wind_shear_kt_per_100ft, greatest(0, 65 - temp_adjusted_f) / 24 AS hourly_hdd, {DA} AS density_altitude_ft
    FROM hprof h JOIN zt USING (zip_code))""", "hprof", "zt")


@query("hourly_profile", "SELECT * FROM hprof", use="hprof", doubles="temp_adjusted_f wind_speed_kt wind_dir_deg")
def _(spark, d):
    from ..functions import air
    from ..functions.cols import kelvin_to_f, ms_to_kt
    base = v.hours(spark, d).select("ts", "zip_code", kelvin_to_f("t2m_k").alias("temp_f"), ms_to_kt(air.wind_speed("u10", "v10")).alias("wind_speed_kt"),
                                    air.wind_direction("u10", "v10").alias("wind_dir_deg"))
    return cubes.hourly_profile(base).drop("temp_f")


def hcube(spark, d):
    return runs.hourly_run(v.hours(spark, d), v.terrain(spark, d))


HCUBE = "temp_adjusted_f wind_speed_kt wind_dir_deg tke_m2s2 wind_shear_kt_per_100ft hourly_hdd density_altitude_ft:5"


@query("hourly_cube", "SELECT * EXCLUDE (ts) FROM hcube", use="hcube", doubles=HCUBE)
def _(spark, d):
    return hcube(spark, d)


@query("hourly_cube_pressure", f"""SELECT *, {FLAG} FROM (SELECT ts AS datetime_utc, zip_code, altitude_ft, temp_adjusted_f, wind_speed_kt, wind_dir_deg, {TKE} AS tke_m2s2, 0.0::DOUBLE AS wind_shear_kt_per_100ft,
    greatest(0, 65 - temp_adjusted_f) / 24 AS hourly_hdd, {DA} AS density_altitude_ft FROM (SELECT ts, zip_code, altitude_ft, temperature_f AS temp_adjusted_f, wind_speed_ms * 1.94384 AS wind_speed_kt,
      wind_direction_deg AS wind_dir_deg FROM wind JOIN zt USING (zip_code)))""", use="wind zt", doubles=HCUBE)
def _(spark, d):
    h = v.hours(spark, d)
    return runs.hourly_run(h, v.terrain(spark, d), prs=v.prs(h), levels_unique=True)


@query("hourly_to_daily_hdd", "SELECT CAST(datetime_utc AS DATE) AS date, zip_code, altitude_ft, sum(hourly_hdd) AS daily_hdd, count(*) AS num_hours FROM hcube GROUP BY 1, 2, 3", use="hcube", doubles="daily_hdd")
def _(spark, d):
    return cubes.hourly_to_daily_hdd(hcube(spark, d))


@query("cube_completeness", """SELECT CAST(datetime_utc AS DATE) AS date, count(DISTINCT datetime_utc) AS num_hours, count(*) FILTER (n <> 8) AS incomplete_zip_hours
    FROM (SELECT datetime_utc, zip_code, count(DISTINCT altitude_ft) AS n FROM hcube GROUP BY 1, 2) GROUP BY 1""", use="hcube")
def _(spark, d):
    return quality.cube_completeness(hcube(spark, d))


def _findings(*rows):
    return "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{sev}' AS severity, '{rule}' AS rule, count(*) AS num_rows FROM {src} WHERE {cond}" for sev, rule, src, cond in rows) + ") WHERE num_rows > 0"


@query("hourly_validate", _findings(
    ("error", "negative hourly_hdd", "hcube", "hourly_hdd < 0"), ("warning", "very high hourly_hdd", "hcube", "hourly_hdd > 2.5"),
    ("warning", "unusual temperature", "hcube", "temp_adjusted_f < -80 OR temp_adjusted_f > 120"),
    ("warning", "not 8 altitudes per ZIP and hour", "(SELECT datetime_utc, zip_code, count(DISTINCT altitude_ft) AS n FROM hcube GROUP BY 1, 2)", "n <> 8"),
    ("warning", "not 24 hours per date", "(SELECT CAST(datetime_utc AS DATE) AS date, count(DISTINCT datetime_utc) AS n FROM hcube GROUP BY 1)", "n <> 24")), use="hcube")
def _(spark, d):
    return quality.hourly_validate(hcube(spark, d))


@query("daily_validate", _findings(
    ("warning", "missing values in daily_effective_hdd", "daily", "daily_effective_hdd IS NULL"), ("error", "negative daily_effective_hdd", "daily", "daily_effective_hdd < 0"),
    ("warning", "very high daily_effective_hdd", "daily", "daily_effective_hdd > 10000"), ("warning", "unusual surface temperature", "daily", "adjusted_temp_f < -50 OR adjusted_temp_f > 120"),
    *[("warning", f"unusual temperature at {a} ft", "daily", f"temp_{a}ft_adjusted_f < -80 OR temp_{a}ft_adjusted_f > 100") for a in (3000, 6000, 9000, 12000, 18000)]), use="daily")
def _(spark, d):
    return quality.daily_validate(daily(spark, d)[0])


@query("cube_validate", _findings(
    ("warning", "unusual temperature", "cube", "temp_adjusted_f < -80 OR temp_adjusted_f > 120"), ("warning", "very high wind", "cube", "wind_speed_kt > 200"),
    ("warning", "very high TKE", "cube", "tke_m2s2 > 10"),
    ("warning", "not 8 altitudes per ZIP and date", "(SELECT date, zip_code, count(DISTINCT altitude_ft) AS n FROM cube GROUP BY 1, 2)", "n <> 8")), use="cube")
def _(spark, d):
    return quality.cube_validate(daily(spark, d)[1])


# --- composed normals run on the derived pixel grid ---------------------------------------
cte("nbox", "SELECT id, min(x) AS minx, max(y) AS maxy FROM points GROUP BY id", "points")
cte("nsteer", """SELECT p.grid_id, p.row, p.col, elev_m, p_size * 100.0::DOUBLE AS base, CASE WHEN off IS NOT NULL THEN off END AS uhi, road_f, off FROM pixels p
    JOIN offset_ o ON o.row = p.row AND o.col = p.col LEFT JOIN pixel_flux f ON f.row = p.row AND f.col = p.col""", "pixels", "offset_", "pixel_flux")
cte("pixel_flux", """SELECT row, col, sum(heat_flux_wm2) / 5.5 * 9 / 5 AS road_f FROM (SELECT row, col, buf, heat_flux_wm2, x, y, x1, y1, x2, y2,
      greatest(0.0::DOUBLE, least(1.0::DOUBLE, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + pow(y2 - y1, 2)))) AS t
      FROM (SELECT row, col, 100.0::DOUBLE * (col + 0.5) AS x, 4000.0 + -100.0::DOUBLE * (row + 0.5) AS y FROM pixels) g
      JOIN segments s ON x >= least(x1, x2) - buf AND x <= greatest(x1, x2) + buf AND y >= least(y1, y2) - buf AND y <= greatest(y1, y2) + buf)
    WHERE pow(x - x1 - t * (x2 - x1), 2) + pow(y - y1 - t * (y2 - y1), 2) <= buf * buf GROUP BY row, col""", "pixels", "segments")
cte("nterrain", """SELECT p.row, p.col, p.elev_m, coalesce(CASE WHEN tpi IS NULL OR aspect_deg IS NULL THEN NULL WHEN tpi > 0 AND slope_deg > 25 THEN 1.15
      WHEN least(abs(aspect_deg - 225), 360 - abs(aspect_deg - 225)) <= 90 THEN 1.08 WHEN tpi < 0 THEN 1.02 ELSE 0.98 END, 1.0)::DOUBLE AS mult,
    (p.elev_m * 3.28084 - 30) / 1000 * 630 AS elev_add FROM aspect p LEFT JOIN ring r ON r.row = p.row AND r.col = p.col""", "aspect", "ring")
cte("nstack", """SELECT i.id, CAST(floor((100.0 * (i.col + 0.5) - minx) / 200) AS INTEGER) AS ix, CAST(floor((maxy - (4000.0 - 100.0 * (i.row + 0.5))) / 200) AS INTEGER) AS iy, base, mult, elev_add, uhi, coalesce(road_f, 0) AS road_f
    FROM inside i JOIN nbox b USING (id) JOIN nsteer s ON s.row = i.row AND s.col = i.col JOIN nterrain t ON t.row = i.row AND t.col = i.col""", "inside", "nbox", "nsteer", "nterrain")
cte("nzonal", "SELECT id, ix, iy, avg(base) AS base, avg(mult) AS mult, avg(elev_add) AS elev_add, avg(uhi) AS uhi, avg(road_f) AS road_f, count(base) AS n FROM nstack GROUP BY id, ix, iy", "nstack")
cte("ncells", """SELECT CAST(a.id AS VARCHAR) AS zip_code, 'cell_' || lpad(CAST(row_number() OVER (PARTITION BY a.id ORDER BY a.iy, a.ix) AS VARCHAR), 3, '0') AS cell_id, cell_area_sqm,
    base * mult + elev_add - coalesce(uhi * 180, 0) - coalesce(road_f * 180, 0) AS effective_hdd, coalesce(n, 0) AS num_valid_pixels
    FROM cell_area a LEFT JOIN nzonal z ON z.id = a.id AND z.ix = a.ix AND z.iy = a.iy""", "cell_area", "nzonal")


@query("normals_run", """SELECT zip_code, cell_id, cell_area_sqm, effective_hdd, num_valid_pixels FROM ncells UNION ALL
    SELECT zip_code, 'aggregate', NULL, avg(effective_hdd), sum(num_valid_pixels)::BIGINT FROM ncells GROUP BY zip_code""", use="ncells", doubles="cell_area_sqm effective_hdd", digits=3)
def _(spark, d):
    stack, grid, zips = normals_inputs(spark, d)
    out = runs.normals_run(stack, grid, zips, region_code="R1", base_station="KPDX", cell_size_m=200.0)
    return out.select("zip_code", "cell_id", "cell_area_sqm", "effective_hdd", "num_valid_pixels")


def normals_inputs(spark, d):
    from .rasters import obs
    from ..operators import stations
    px = v.pixels(spark, d)
    n_rows = px.agg(F.max("row")).first()[0] + 1
    grid = replace(v.GRID, n_rows=n_rows, n_cols=50)

    def band(value):
        return px.select("grid_id", "row", "col", value.alias("value"))

    stack = runs.pixel_stack(
        px.select("grid_id", "row", "col", "elev_m"), grid,
        impervious=tables.impervious_ingest(band(F.col("imperv_raw"))), base_hdd=band(F.col("p_size") * 100.0),
        wind=band(F.col("p_size") / 10.0), roads=tables.road_heat_flux(v.roads(spark, d)),
        station_wind=stations.station_wind(obs(spark, d), with_p90=False), station_elevation_ft=30.0, base_station="KPDX", tile=64)
    return stack, grid, v.polygons(spark, d).withColumn("id", F.col("id").cast("string"))


# polygons named after ZIPs of the hourly table; the normals' aggregate rows carry the terrain of the later runs
cte("cnorm", """SELECT CAST(97000 + CAST(zip_code AS BIGINT) AS VARCHAR) AS zip_code, avg(mult) AS mult, avg(elev_add) AS elev_add, avg(coalesce(uhi * 180, 0)) AS uhi, avg(coalesce(road_f * 180, 0)) AS road
    FROM (SELECT CAST(a.id AS VARCHAR) AS zip_code, mult, elev_add, uhi, road_f FROM cell_area a LEFT JOIN nzonal z ON z.id = a.id AND z.ix = a.ix AND z.iy = a.iy) GROUP BY 1""", "cell_area", "nzonal")


@query("combined_run", """SELECT a.date, a.zip_code, greatest(0, greatest(0, 65 - adjusted_f) * coalesce(mult, 1) + coalesce(elev_add, 0) - uhi - road) AS daily_effective_hdd, n_hours
    FROM adj a JOIN cnorm USING (zip_code) JOIN (SELECT CAST(ts AS DATE) AS date, zip_code, count(*) AS n_hours FROM hours GROUP BY 1, 2) h ON h.date = a.date AND h.zip_code = a.zip_code""",
       use="adj cnorm hours", doubles="daily_effective_hdd", digits=3)
def _(spark, d):
    stack, grid, zips = normals_inputs(spark, d)
    zips = zips.withColumn("id", (F.col("id").cast("long") + 97000).cast("string"))
    h = v.hours(spark, d)
    _, day, _, hourly = runs.combined_run(stack, grid, zips, h, v.prs(h), v.normals(spark, d), region_code="R1", base_station="KPDX", cell_size_m=200.0, levels_unique=True)
    counts = hourly.where("altitude_ft = 0").groupBy(F.to_date("datetime_utc").alias("date"), "zip_code").agg(F.count(F.lit(1)).alias("n_hours"))
    return day.select("date", "zip_code", "daily_effective_hdd").join(counts, ["date", "zip_code"])


# --- grids sampled at ZIPs ---------------------------------------------------------------------
cte("gpoints", "SELECT zip_code, CAST(zip_code AS INTEGER) - 97000 AS n FROM (SELECT DISTINCT zip_code FROM hours)", "hours")
cte("gcell", "SELECT zip_code, n // 10 AS gy, n % 10 AS gx FROM gpoints", "gpoints")


def grid_inputs(spark, d):
    """The hourly table as fields on a 10 x 10 grid under other names and in Pa, and points near the cells' middles."""
    h = v.hours(spark, d)
    n = F.col("zip_code").cast("int") - 97000
    cell = [F.expr("(cast(zip_code as int) - 97000) div 10").alias("gy"), (n % 10).alias("gx")]
    fields = h.select("ts", *cell, F.col("t2m_k").alias("t2m"), F.col("u10").alias("u10m"), F.col("v10").alias("v10m"), (F.col("sp_mb") * 100).alias("sp"))
    p = v.prs(h)
    levels = p.select("ts", *cell, F.col("level_mb").alias("isobaricInhPa"), F.col("t_k").alias("t"), "u", "v")
    k = F.col("id")
    cells = spark.range(100).select(F.expr("id div 10").alias("gy"), (k % 10).alias("gx"), (42 + F.expr("id div 10") * 0.17).alias("lat"), (-124.5 + (k % 10) * 0.15).alias("lon"))
    points = h.select("zip_code").distinct().select("zip_code", (42.02 + F.expr("(cast(zip_code as int) - 97000) div 10") * 0.17).alias("lat"), (-124.48 + (n % 10) * 0.15).alias("lon"))
    return fields, levels, points, cells


def from_grid(spark, d, **kw):
    fields, levels, points, cells = grid_inputs(spark, d)
    return runs.grid_to_zips(fields, levels, points, cells=cells, **kw)


@query("sample_grid", "SELECT ts, zip_code, t2m_k, u10, v10, sp_mb FROM hours", use="hours", doubles="t2m_k u10 v10 sp_mb")
def _(spark, d):
    return from_grid(spark, d)[0].select("ts", "zip_code", "t2m_k", "u10", "v10", "sp_mb")


@query("nearest_curvilinear", "SELECT zip_code, gy, gx FROM gcell", use="gcell")
def _(spark, d):
    from ..operators.stations import nearest_curvilinear
    _, _, points, cells = grid_inputs(spark, d)
    return nearest_curvilinear(points, cells).select("zip_code", "gy", "gx")


@query("hourly_from_grid", "SELECT ts, zip_code, altitude_ft, temp_adjusted_f, wind_speed_kt FROM hcube", use="hcube", doubles="temp_adjusted_f wind_speed_kt")
def _(spark, d):
    return runs.hourly_run(from_grid(spark, d)[0], v.terrain(spark, d)).select(F.col("datetime_utc").alias("ts"), "zip_code", "altitude_ft", "temp_adjusted_f", "wind_speed_kt")


@query("daily_from_grid", f"SELECT date, zip_code, bias_f, {', '.join(DAILY)} FROM daily", use="daily", doubles="bias_f " + " ".join(DAILY))
def _(spark, d):
    h, p = from_grid(spark, d, curvilinear=True)
    return runs.daily_run(h, p, v.normals(spark, d), v.terrain(spark, d), levels_unique=True)[0].select("date", "zip_code", "bias_f", *DAILY)


# profiles of all hours of a day: components averaged before speed and bearing
cte("mwind", """SELECT date, zip_code, altitude_ft, sqrt(u * u + v * v) * 1.94384 AS wind_speed_kt, (degrees(atan2(u, v)) + 360) % 360 AS wind_dir_deg, t AS raw_f FROM (SELECT CAST(ts AS DATE) AS date, zip_code, altitude_ft,
    avg(wind_speed_ms * sin(radians(wind_direction_deg))) AS u, avg(wind_speed_ms * cos(radians(wind_direction_deg))) AS v, avg(temperature_f) AS t FROM wind GROUP BY 1, 2, 3)""", "wind")


@query("daily_combine_mean", """SELECT a.date, a.zip_code, adjusted_f AS adjusted_temp_f, max(wind_speed_kt) FILTER (altitude_ft = 0) AS wind_speed_sfc_kt, max(wind_dir_deg) FILTER (altitude_ft = 0) AS wind_dir_sfc_deg,
    max(raw_f) FILTER (altitude_ft = 3000) AS temp_3000ft_raw_f, max(wind_speed_kt) FILTER (altitude_ft = 3000) AS wind_speed_3000ft_kt FROM adj a JOIN zt USING (zip_code) JOIN mwind m ON m.date = a.date AND m.zip_code = a.zip_code GROUP BY ALL""",
       use="adj zt mwind", doubles="adjusted_temp_f wind_speed_sfc_kt wind_dir_sfc_deg temp_3000ft_raw_f wind_speed_3000ft_kt")
def _(spark, d):
    h = v.hours(spark, d)
    out = runs.daily_run(h, v.prs(h), v.normals(spark, d), v.terrain(spark, d), levels_unique=True, profile_hour="mean")[0]
    return out.select("date", "zip_code", "adjusted_temp_f", "wind_speed_sfc_kt", "wind_dir_sfc_deg", "temp_3000ft_raw_f", "wind_speed_3000ft_kt")


@query("rotate_twice", "SELECT event_id, ts FROM raw_hours WHERE ts < (SELECT max(ts) FROM raw_hours) - INTERVAL 48 HOUR", use="raw_hours")
def _(spark, d):
    # the archive after two passes and a repeated one, over rows that arrive in two parts
    cube, out = v.raw_hours(spark, d).select("event_id", "ts"), scratch_folder(spark, "archive")
    early = cube.where(F.col("ts") < cube.agg(F.expr("percentile(cast(ts as double), 0.6)")).scalar().cast("timestamp"))
    for rows in (early, cube, cube):
        cycles.rotate(rows, out, ts="ts")
    return spark.read.schema("event_id long, ts timestamp").parquet(out).select("event_id", "ts")


# --- streaming ----------------------------------------------------------------------------
EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def _stream(spark, d):
    src = spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(d)
    return v.hours_from(src)


def _drained(stream, name):
    """Run a stream over what has landed and read its output table back."""
    spark = stream.sparkSession
    out = scratch_folder(spark, name)
    q = (stream.writeStream.format("parquet").option("path", f"{out}/data").option("checkpointLocation", f"{out}/state")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/data"), q


@query("st_dedup", "SELECT DISTINCT ts, zip_code FROM raw_hours", use="raw_hours")
def _(spark, d):
    return _drained(cycles.dedup_cycles(_stream(spark, d)), "dedup")[0].select("ts", "zip_code")


cte("rcube", f"""SELECT *, {FLAG} FROM (SELECT h.*, {TKE} AS tke_m2s2, 0.0::DOUBLE AS wind_shear_kt_per_100ft, greatest(0, 65 - temp_adjusted_f) / 24 AS hourly_hdd, {DA} AS density_altitude_ft
    FROM (SELECT ts AS datetime_utc, zip_code, altitude_ft, {TF} - altitude_ft / 1000.0 * 3.5 AS temp_adjusted_f, sqrt(u10 * u10 + v10 * v10) * 1.94384 * (1 + 0.1 * (altitude_ft / 1000.0)) AS wind_speed_kt,
      (degrees(atan2(u10, v10)) + 360) % 360 AS wind_dir_deg FROM raw_hours, alts) h JOIN zt USING (zip_code))""", "raw_hours", "alts", "zt")


@query("st_cycle_cube", "SELECT * FROM rcube", use="rcube", doubles=HCUBE)
def _(spark, d):
    return _drained(cycles.cycle_cube_stream(_stream(spark, d), v.terrain(spark, d)), "cycles")[0]


@query("st_daily_hdd", f"""SELECT CAST(ts AS DATE) AS date, zip_code, avg({TF}) AS mean_temp_f, sum(greatest(0, 65 - {TF}) / 24) AS daily_hdd, count(*) AS num_hours FROM raw_hours
    GROUP BY 1, 2""", use="raw_hours", doubles="mean_temp_f daily_hdd")
def _(spark, d):
    # running totals: the open day is there too
    out = scratch_folder(spark, "days")
    cycles.write_days(cycles.daily_hdd_stream(_stream(spark, d)), f"{out}/data", f"{out}/state", once=True).awaitTermination()
    return cycles.latest_days(spark, f"{out}/data")


@query("static_features", "SELECT * FROM zt", use="zt", doubles="hdd_terrain_mult hdd_elev_addition hdd_uhi_reduction hdd_traffic_reduction")
def _(spark, d):
    out = scratch_folder(spark, "static")
    cycles.build_static(v.terrain(spark, d), out)
    return cycles.load_static(spark, out).select("zip_code", "hdd_terrain_mult", "hdd_elev_addition", "hdd_uhi_reduction", "hdd_traffic_reduction")


@query("st_validate", _findings(("warning", "unusual temperature", "rcube", "temp_adjusted_f < -80 OR temp_adjusted_f > 120")), use="rcube")
def _(spark, d):
    return cycles.validate_stream(_drained(cycles.cycle_cube_stream(_stream(spark, d), v.terrain(spark, d)), "checked")[0])


@query("st_status", """SELECT ts AS hour, count(*) AS num_rows, count(DISTINCT zip_code) AS num_places, CAST(date_diff('hour', ts, (SELECT max(ts) FROM raw_hours)) AS INTEGER) AS hours_behind
    FROM (SELECT DISTINCT ts, zip_code FROM raw_hours) GROUP BY ts""", use="raw_hours")
def _(spark, d):
    return cycles.cycle_status(_drained(cycles.dedup_cycles(_stream(spark, d)), "status")[0].select("ts", "zip_code"))


@query("retention_split", "SELECT event_id, ts, ts < (SELECT max(ts) FROM raw_hours) - INTERVAL 48 HOUR AS archive FROM raw_hours", use="raw_hours")
def _(spark, d):
    return cycles.retention_split(v.raw_hours(spark, d).select("event_id", "ts"), ts="ts")


def _hashes(spark, d, changed):
    text = F.when((F.col("doc_id") % 5 == 0) & F.lit(changed), F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    return table(spark, d, "documents").select(F.col("doc_id").alias("source"), F.sha2(text, 256).alias("sha256"))


cte("now_hash", "SELECT doc_id AS source, sha256(text) AS h FROM documents")
cte("old_hash", "SELECT doc_id AS source, sha256(CASE WHEN doc_id % 5 = 0 THEN text || '!' ELSE text END) AS h FROM documents WHERE doc_id % 7 <> 0")


@query("manifest_stale", "SELECT n.source, coalesce(n.h <> o.h, true) AS stale FROM now_hash n LEFT JOIN old_hash o USING (source)", use="now_hash old_hash")
def _(spark, d):
    return sinks.manifest_stale(_hashes(spark, d, False), _hashes(spark, d, True).where("source % 7 <> 0"))


@query("manifest_verify", "SELECT o.source, n.h IS NOT NULL AS present, coalesce(n.h = o.h, false) AS matches FROM (SELECT * FROM now_hash) o LEFT JOIN old_hash n USING (source)", use="now_hash old_hash")
def _(spark, d):
    return sinks.manifest_verify(_hashes(spark, d, False), _hashes(spark, d, True).where("source % 7 <> 0"))
