"""Domain tables derived from the given tables by plain arithmetic, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import zonal
from ..types import LANDCOVER, PRESSURE_LEVELS_MB, STATIONS, Grid
from .base import cte, table

GRID = Grid(a=100.0, c=0.0, e=-100.0, f=4000.0)
LONLAT = Grid(a=0.1, c=-125.0, e=-0.1, f=47.0, crs="lonlat")
IDS = [s for s, *_ in STATIONS]
CLASSES = [r[0] for r in LANDCOVER]


def sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


def array_of(values):
    return F.array(*map(F.lit, values))


def code(key: str):
    """A key as a ZIP of at most five digits: longer keys give their first five, as lpad does in the SQL; the padding is the operator's."""
    return F.substring(F.col(key).cast("string"), 1, 5)


cte("stations", "SELECT * FROM (VALUES " + ", ".join(
    f"('{s}', {n}, {ft}, {la}::DOUBLE, {lo}::DOUBLE, {i})" for i, (s, n, ft, la, lo) in enumerate(STATIONS))
    + ") v(station_id, hdd_normal, elevation_ft, lat, lon, ord)")
cte("landcover", "SELECT * FROM (VALUES " + ", ".join(
    f"({c}, {z}::DOUBLE, {a}::DOUBLE, {e}::DOUBLE, {d}::DOUBLE)" for c, z, a, e, d in LANDCOVER)
    + ") v(nlcd_class, z0_m, albedo, emissivity, displacement_height_m)")

cte("pixels", f"""SELECT 'g' AS grid_id, p_partkey // 50 AS row, p_partkey % 50 AS col,
    CASE WHEN p_partkey % 97 <> 0 THEN p_retailprice + p_size * 2.0::DOUBLE END AS elev_m,
    CAST(p_size * 3 + p_partkey % 7 AS INTEGER) AS imperv_raw,
    CASE WHEN p_partkey % 97 <> 0 THEN CAST({sql_list(CLASSES)}[p_partkey % 20 + 1] AS INTEGER) END AS nlcd_class,
    CASE WHEN p_partkey % 89 <> 0 THEN p_size * 1.5 + 5 ELSE NULL END AS lst_c,
    p_size FROM part""")


def pixels(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, d, "part").select(
        F.lit("g").alias("grid_id"), F.expr("p_partkey div 50").alias("row"), (k % 50).alias("col"),
        F.when(k % 97 != 0, F.col("p_retailprice") + F.col("p_size") * 2.0).alias("elev_m"),
        (F.col("p_size") * 3 + k % 7).cast("int").alias("imperv_raw"),
        F.when(k % 97 != 0, F.element_at(array_of(CLASSES), (k % 20 + 1).cast("int"))).alias("nlcd_class"),
        F.when(k % 89 != 0, F.col("p_size") * 1.5 + 5).alias("lst_c"), "p_size")


cte("temps", """SELECT grid_id, row, col, CAST(m.month AS INTEGER) AS month,
    p_size / 2.0 - 5 + 10 - abs(m.month - 7) * 2.0::DOUBLE AS temp_c
    FROM pixels, (SELECT unnest(range(1, 13)) AS month) m""", "pixels")


def temps(spark: SparkSession, d: str) -> DataFrame:
    return (pixels(spark, d).select("grid_id", "row", "col", "p_size", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
            .select("grid_id", "row", "col", "month",
                    (F.col("p_size") / 2.0 - 5 + 10 - F.abs(F.col("month") - 7) * 2.0).alias("temp_c")))


cte("stack", """SELECT CAST(97000 + l_suppkey AS VARCHAR) AS zip_code,
    'cell_' || lpad(CAST(l_linenumber AS VARCHAR), 3, '0') AS cell_id, l_suppkey,
    CASE WHEN l_orderkey % 53 <> 0 THEN 4000 + sqrt(l_extendedprice) * 5 END AS prism_annual_hdd,
    0.95 + sqrt(l_tax) / 3 AS hdd_terrain_mult, sqrt(l_quantity) * 80 - 100 AS hdd_elev_addition,
    sqrt(l_discount) * 12 AS uhi_offset_f, sqrt(l_discount) * 1.5::DOUBLE AS road_temp_offset_f, sqrt(l_quantity) * 150 AS mean_elevation_ft,
    sqrt(l_extendedprice) / 6 AS impervious, l_shipdate FROM lineitem""")


def stack(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        (97000 + F.col("l_suppkey")).cast("string").alias("zip_code"),
        F.format_string("cell_%03d", "l_linenumber").alias("cell_id"), "l_suppkey",
        F.when(F.col("l_orderkey") % 53 != 0, 4000 + F.sqrt("l_extendedprice") * 5).alias("prism_annual_hdd"),
        (0.95 + F.sqrt("l_tax") / 3).alias("hdd_terrain_mult"), (F.sqrt("l_quantity") * 80 - 100).alias("hdd_elev_addition"),
        (F.sqrt("l_discount") * 12).alias("uhi_offset_f"), (F.sqrt("l_discount") * 1.5).alias("road_temp_offset_f"),
        (F.sqrt("l_quantity") * 150).alias("mean_elevation_ft"), (F.sqrt("l_extendedprice") / 6).alias("impervious"),
        "l_shipdate")


BANDS = ["prism_annual_hdd", "hdd_terrain_mult", "hdd_elev_addition", "uhi_offset_f", "road_temp_offset_f",
         "mean_elevation_ft", "impervious"]
cte("zonal", "SELECT zip_code, cell_id, min(l_suppkey) AS l_suppkey, " + ", ".join(
    f"CASE WHEN count(prism_annual_hdd) > 0 THEN avg({b}) END AS {b}" for b in BANDS)
    + ", count(prism_annual_hdd) AS num_valid_pixels FROM stack GROUP BY zip_code, cell_id", "stack")
cte("cells", f"""SELECT *, {sql_list(IDS)}[l_suppkey % 11 + 1] AS base_station,
    'R' || CAST(l_suppkey % 5 AS VARCHAR) AS region_code,
    CASE WHEN impervious >= 35.5 THEN 'urban' WHEN impervious <= 34.5 THEN 'rural' ELSE 'suburban' END AS cell_type,
    CASE CAST(substr(cell_id, 6) AS INTEGER) % 4 WHEN 0 THEN 'windward' WHEN 1 THEN 'leeward'
         WHEN 2 THEN 'valley' ELSE 'ridge' END AS terrain_position,
    coalesce(uhi_offset_f * 180, 0) AS hdd_uhi_reduction, coalesce(road_temp_offset_f * 180, 0) AS hdd_traffic_reduction,
    prism_annual_hdd * hdd_terrain_mult + hdd_elev_addition - coalesce(uhi_offset_f * 180, 0)
        - coalesce(road_temp_offset_f * 180, 0) AS effective_hdd FROM zonal""", "zonal")
cte("bounded", """SELECT *, prism_annual_hdd * hdd_terrain_mult + hdd_elev_addition - hdd_uhi_reduction - hdd_traffic_reduction
      - sqrt(pow(200 * hdd_terrain_mult, 2) + pow(prism_annual_hdd * 0.05, 2) + 18125) AS effective_hdd_low,
    prism_annual_hdd * hdd_terrain_mult + hdd_elev_addition - hdd_uhi_reduction - hdd_traffic_reduction
      + sqrt(pow(200 * hdd_terrain_mult, 2) + pow(prism_annual_hdd * 0.05, 2) + 18125) AS effective_hdd_high FROM cells""", "cells")


def cells(spark: SparkSession, d: str, *, with_bounds: bool = True) -> DataFrame:
    # the supplier number is the ZIP's tail, so it need not travel through the aggregation
    z = zonal.cell_zonal(stack(spark, d), bands=BANDS).withColumn("l_suppkey", F.col("zip_code").cast("long") - 97000)
    n = F.substring("cell_id", 6, 10).cast("int") % 4
    z = (z.withColumn("base_station", F.element_at(array_of(IDS), (F.col("l_suppkey") % 11 + 1).cast("int")))
         .withColumn("region_code", F.concat(F.lit("R"), (F.col("l_suppkey") % 5).cast("string")))
         .withColumn("cell_type", F.when(F.col("impervious") >= 35.5, "urban").when(F.col("impervious") <= 34.5, "rural")
                     .otherwise("suburban"))
         .withColumn("terrain_position", F.when(n == 0, "windward").when(n == 1, "leeward").when(n == 2, "valley")
                     .otherwise("ridge")))
    return zonal.with_effective_hdd(z, with_bounds=with_bounds)


cte("agg", """SELECT region_code, zip_code, base_station, 'aggregate' AS cell_id, avg(effective_hdd) AS effective_hdd,
    count(*) AS num_cells, avg(mean_elevation_ft) AS mean_elevation_ft, sum(num_valid_pixels)::BIGINT AS num_valid_pixels,
    avg(hdd_terrain_mult) AS hdd_terrain_mult, avg(hdd_elev_addition) AS hdd_elev_addition,
    avg(hdd_uhi_reduction) AS hdd_uhi_reduction, avg(hdd_traffic_reduction) AS hdd_traffic_reduction
    FROM cells GROUP BY region_code, zip_code, base_station""", "cells")
# the QA table: every seventh ZIP's aggregate is off by one, and one station's ZIPs are far too warm
cte("terrain", """SELECT zip_code, cell_id, cell_type, terrain_position, mean_elevation_ft, num_valid_pixels,
    NULL::BIGINT AS num_cells, base_station, region_code, hdd_terrain_mult, hdd_elev_addition, hdd_uhi_reduction, hdd_traffic_reduction,
    CASE WHEN base_station = 'KOTH' THEN effective_hdd - 6000 WHEN base_station = 'KDLS' THEN effective_hdd + 12000
         ELSE effective_hdd END AS effective_hdd FROM cells
  UNION ALL SELECT zip_code, cell_id, NULL, NULL, mean_elevation_ft, num_valid_pixels, num_cells, base_station, region_code,
    hdd_terrain_mult, hdd_elev_addition, hdd_uhi_reduction, hdd_traffic_reduction,
    CASE WHEN CAST(zip_code AS INTEGER) % 7 = 0 THEN effective_hdd + 1 WHEN base_station = 'KOTH' THEN effective_hdd - 6000
         WHEN base_station = 'KDLS' THEN effective_hdd + 12000 ELSE effective_hdd END FROM agg""", "cells", "agg")
TERRAIN_COLS = ["zip_code", "cell_id", "cell_type", "terrain_position", "mean_elevation_ft", "num_valid_pixels", "num_cells",
                "base_station", "region_code", "hdd_terrain_mult", "hdd_elev_addition", "hdd_uhi_reduction",
                "hdd_traffic_reduction", "effective_hdd"]


def terrain(spark: SparkSession, d: str) -> DataFrame:
    t = zonal.with_zip_aggregates(cells(spark, d, with_bounds=False))
    is_agg, e = F.col("cell_id") == "aggregate", F.col("effective_hdd")
    return t.withColumn("effective_hdd", F.when(is_agg & (F.col("zip_code").cast("int") % 7 == 0), e + 1)
                        .when(F.col("base_station") == "KOTH", e - 6000).when(F.col("base_station") == "KDLS", e + 12000)
                        .otherwise(e)).select(*TERRAIN_COLS)


cte("billing", """SELECT CAST(97000 + s_suppkey AS VARCHAR) AS zip_code,
    CASE WHEN s_suppkey % 10 = 0 THEN 0.0::DOUBLE ELSE 3000 + s_acctbal / 3 END AS therms_per_customer FROM supplier""")


def billing(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").select(
        (97000 + F.col("s_suppkey")).cast("string").alias("zip_code"),
        F.when(F.col("s_suppkey") % 10 == 0, 0.0).otherwise(3000 + F.col("s_acctbal") / 3).alias("therms_per_customer"))


cte("centroids", """SELECT CAST(97000 + s_suppkey AS VARCHAR) AS zip_code, s_suppkey,
    CASE WHEN s_nationkey % 2 = 0 THEN 'OR' ELSE 'WA' END AS state,
    42 + (s_suppkey * 37 % 700) / 100.0::DOUBLE AS centroid_lat,
    -124.5 + (s_suppkey * 53 % 750) / 100.0::DOUBLE AS centroid_lon FROM supplier""")


def centroids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").select(
        (97000 + F.col("s_suppkey")).cast("string").alias("zip_code"), "s_suppkey",
        F.when(F.col("s_nationkey") % 2 == 0, "OR").otherwise("WA").alias("state"),
        (42 + (F.col("s_suppkey") * 37 % 700) / 100.0).alias("centroid_lat"),
        (-124.5 + (F.col("s_suppkey") * 53 % 750) / 100.0).alias("centroid_lon"))


cte("registry", f"""SELECT CAST(97000 + s_suppkey AS VARCHAR) AS zip_code, 'R' || CAST(s_nationkey % 5 AS VARCHAR) AS region_code,
    'region_' || CAST(s_nationkey % 5 AS VARCHAR) AS region_name, 2021 AS lidar_vintage,
    CASE WHEN s_suppkey % 10 = 9 THEN 'KXXX' ELSE {sql_list(IDS)}[(s_nationkey % 5) * 2 + s_suppkey % 3 + 1] END AS base_station
    FROM supplier""")


def registry(spark: SparkSession, d: str) -> DataFrame:
    n, k = F.col("s_nationkey") % 5, F.col("s_suppkey")
    # station 11 does not exist for (4, 2): index 11 is the last one
    return table(spark, d, "supplier").select(
        (97000 + k).cast("string").alias("zip_code"), F.concat(F.lit("R"), n.cast("string")).alias("region_code"),
        F.concat(F.lit("region_"), n.cast("string")).alias("region_name"), F.lit(2021).alias("lidar_vintage"),
        F.when(k % 10 == 9, "KXXX").otherwise(
            F.element_at(array_of(IDS), (n * 2 + k % 3 + 1).cast("int"))).alias("base_station"))


cte("raw_hours", """SELECT event_id, date_trunc('hour', ts) AS ts, CAST(97000 + user_id % 100 AS VARCHAR) AS zip_code,
    255 + sqrt(value) * 2.2::DOUBLE AS t2m_k, sqrt(value) / 2 - 6 AS u10, 6 - sqrt(value) / 3 AS v10, 1013.0::DOUBLE - user_id % 20 AS sp_mb
    FROM events""")
cte("hours", """SELECT ts, zip_code, avg(t2m_k) AS t2m_k, avg(u10) AS u10, avg(v10) AS v10, avg(sp_mb) AS sp_mb
    FROM raw_hours GROUP BY ts, zip_code""", "raw_hours")
cte("levels", "SELECT CAST(unnest(" + sql_list(PRESSURE_LEVELS_MB) + ") AS INTEGER) AS level_mb")
cte("prs", """SELECT ts, zip_code, level_mb, t2m_k - (1000 - level_mb) / 15.0::DOUBLE AS t_k,
    u10 * (1 + (1000 - level_mb) / 500.0::DOUBLE) AS u, v10 * (1 + (1000 - level_mb) / 500.0::DOUBLE) AS v
    FROM hours, levels""", "hours", "levels")


def raw_hours(spark: SparkSession, d: str) -> DataFrame:
    return hours_from(table(spark, d, "events"))


def hours_from(events: DataFrame) -> DataFrame:
    v, u = F.col("value"), F.col("user_id")
    return events.select(
        "event_id", F.date_trunc("hour", "ts").alias("ts"), (97000 + u % 100).cast("string").alias("zip_code"),
        (255 + F.sqrt(v) * 2.2).alias("t2m_k"), (F.sqrt(v) / 2 - 6).alias("u10"), (6 - F.sqrt(v) / 3).alias("v10"),
        (1013.0 - u % 20).alias("sp_mb"))


def hours(spark: SparkSession, d: str) -> DataFrame:
    return raw_hours(spark, d).groupBy("ts", "zip_code").agg(
        *[F.avg(k).alias(k) for k in ("t2m_k", "u10", "v10", "sp_mb")])


def prs(hourly: DataFrame) -> DataFrame:
    p = F.col("level_mb")
    gain = 1 + (1000 - p) / 500.0
    return (hourly.withColumn("level_mb", F.explode(array_of(PRESSURE_LEVELS_MB)))
            .select("ts", "zip_code", "level_mb", (F.col("t2m_k") - (1000 - p) / 15.0).alias("t_k"),
                    (F.col("u10") * gain).alias("u"), (F.col("v10") * gain).alias("v")))


cte("normals", """SELECT zip_code, CAST(m.month AS INTEGER) AS month, 30 + (s_suppkey % 25) + m.month * 1.5::DOUBLE AS normal_f
    FROM centroids, (SELECT unnest(range(1, 13)) AS month) m""", "centroids")


def normals(spark: SparkSession, d: str) -> DataFrame:
    return (centroids(spark, d).withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))
            .select("zip_code", "month", (30 + (F.col("s_suppkey") % 25) + F.col("month") * 1.5).alias("normal_f")))


cte("daily_temp", """SELECT CAST(o_orderdate AS DATE) AS date, CAST(97000 + o_custkey % 100 AS VARCHAR) AS zip_code,
    avg(20 + sqrt(o_totalprice) / 15) AS temp_f FROM orders GROUP BY 1, 2""")


def daily_temp(spark: SparkSession, d: str) -> DataFrame:
    return (table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("date"),
                                              (97000 + F.col("o_custkey") % 100).cast("string").alias("zip_code"))
            .agg(F.avg(20 + F.sqrt("o_totalprice") / 15).alias("temp_f")))


cte("roads", """SELECT o_orderkey AS road_id, CASE WHEN o_orderkey % 29 = 0 THEN 0.0::DOUBLE ELSE o_totalprice / 5 END AS aadt,
    (o_orderkey * 37 % 5000)::DOUBLE AS x1, 4000 - (o_orderkey * 53 % 4000)::DOUBLE AS y1,
    (o_orderkey * 37 % 5000 + 40 + o_orderkey % 7 * 30)::DOUBLE AS x2,
    4000 - (o_orderkey * 53 % 4000)::DOUBLE + (o_orderkey % 5 - 2) * 70 AS y2 FROM orders""")
cte("flux", """SELECT *, sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2)) AS length_m,
    (aadt / 86400.0) * 150000.0 / (sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2)) * 3.7) AS heat_flux_wm2
    FROM roads WHERE aadt > 0""", "roads")


def roads(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    x1, y1 = (k * 37 % 5000).cast("double"), 4000 - (k * 53 % 4000).cast("double")
    x2, y2 = (k * 37 % 5000 + 40 + k % 7 * 30).cast("double"), y1 + (k % 5 - 2) * 70
    return table(spark, d, "orders").select(
        k.alias("road_id"), F.when(k % 29 == 0, 0.0).otherwise(F.col("o_totalprice") / 5).alias("aadt"),
        F.array(F.struct(x1.alias("x"), y1.alias("y")), F.struct(x2.alias("x"), y2.alias("y"))).alias("pts"))


# L-shapes (odd) and diamonds (even, every second with a diamond hole), one per supplier
cte("shapes", """SELECT s_suppkey AS id, 100 + (s_suppkey * 37 % 480) * 10.0::DOUBLE AS cx,
    3950 - (s_suppkey * 53 % 390) * 10.0::DOUBLE AS cy, 150 + (s_suppkey % 17) * 20.0::DOUBLE AS s FROM supplier""")
cte("points", """SELECT id, 0 AS ring_no, unnest(range(6)) AS i, unnest([cx - s, cx + s, cx + s, cx, cx, cx - s]) AS x,
      unnest([cy - s, cy - s, cy, cy, cy + s, cy + s]) AS y, 6 AS n FROM shapes WHERE id % 2 = 1
    UNION ALL SELECT id, 0, unnest(range(4)), unnest([cx - s, cx, cx + s, cx]), unnest([cy, cy + s, cy, cy - s]), 4 FROM shapes WHERE id % 2 = 0
    UNION ALL SELECT id, 1, unnest(range(4)), unnest([cx - s / 2, cx, cx + s / 2, cx]),
      unnest([cy, cy + s / 2, cy, cy - s / 2]), 4 FROM shapes WHERE id % 4 = 0""", "shapes")
cte("edges", """SELECT a.id, a.ring_no, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM points a JOIN points b
    ON a.id = b.id AND a.ring_no = b.ring_no AND b.i = (a.i + 1) % a.n""", "points")


def _ring(points) -> object:
    return F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in points])


def polygons(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    cx, cy = 100 + (k * 37 % 480) * 10.0, 3950 - (k * 53 % 390) * 10.0
    s = 150 + (k % 17) * 20.0
    ell = _ring([(cx - s, cy - s), (cx + s, cy - s), (cx + s, cy), (cx, cy), (cx, cy + s), (cx - s, cy + s)])
    diamond = _ring([(cx - s, cy), (cx, cy + s), (cx + s, cy), (cx, cy - s)])
    h = s / 2
    hole = _ring([(cx - h, cy), (cx, cy + h), (cx + h, cy), (cx, cy - h)])
    return table(spark, d, "supplier").select(
        k.alias("id"), F.when(k % 2 == 1, F.array(ell)).when(k % 4 == 0, F.array(diamond, hole))
        .otherwise(F.array(diamond)).alias("rings"))
