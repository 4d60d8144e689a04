"""Cases in which rows were once lost, merged or mixed."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orograd.functions import degree_days
from orograd.operators import geometry, raster, registry, stations
from orograd.plans import runs
from orograd.sources import tables
from orograd.streaming import cycles
from orograd.types import Grid


def test_archive_keeps_all_hours_over_several_passes(spark, tmp_path):
    path = str(tmp_path / "archive")

    def cube(hours):
        rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), h) for h in hours]
        return spark.createDataFrame(rows, "datetime_utc timestamp, n int")

    live = cycles.rotate(cube(range(58)), path)
    live = cycles.rotate(live.unionByName(cube(range(58, 68))), path)
    assert sorted(r["n"] for r in spark.read.parquet(path).collect()) == list(range(19))
    cycles.rotate(cube([3, 500]), path)   # a repeated row and a late hour
    assert sorted(r["n"] for r in spark.read.parquet(path).collect()) == list(range(19))
    assert sorted(r["n"] for r in live.collect()) == list(range(19, 68))


def test_equal_and_missing_points_stay_rows(spark):
    axes = spark.createDataFrame([(y, x, 45.0 + y, -120.0 + x) for y in range(3) for x in range(3)], "gy int, gx int, lat double, lon double")
    points = spark.createDataFrame([(46.2, -119.4), (46.2, -119.4), (None, -119.0), (44.0, -130.0)], "lat double, lon double")
    got = sorted(tuple(r) for r in stations.nearest_grid(points, axes).select("gy", "gx").fillna(-1).collect())
    assert got == [(-1, 1), (0, 0), (1, 1), (1, 1)]
    near = stations.nearest_station(spark.createDataFrame([(None, -122.0)], "centroid_lat double, centroid_lon double")).first()
    assert near["base_station"] is None and near["distance_km"] is None


def test_curvilinear_equals_brute_force(spark):
    import math
    cells = [(y, x, 44 + 0.1 * y + 0.02 * x, -123 + 0.13 * x - 0.015 * y) for y in range(12) for x in range(12)]
    points = [(k, 44 + 0.083 * k % 1.3, -123 + 0.121 * k % 1.5) for k in range(40)] + [(99, None, -122.0), (98, 10.0, 10.0)]

    def km(a, b, c, d):
        a, b, c, d = map(math.radians, (a, b, c, d))
        return 2 * math.asin(math.sqrt(math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2))

    got = stations.nearest_curvilinear(spark.createDataFrame(points, "k int, lat double, lon double"), spark.createDataFrame(cells, "gy int, gx int, lat double, lon double"))
    for r in got.collect():
        if r["k"] == 99:
            assert r["gy"] is None
        else:  # the farthest point, 98, too
            assert (r["gy"], r["gx"]) == min((km(r["lat"], r["lon"], a, b), y, x) for y, x, a, b in cells)[1:]
    assert got.where("gy is not null").count() == 41 and got.count() == 42


def test_layers_do_not_mix(spark):
    g = Grid(1.0, 0.0, -1.0, 4.0, n_rows=4, n_cols=4)
    px = spark.createDataFrame([(k, r, c, z) for k, z in (("a", 10.0), ("b", 90.0)) for r in range(4) for c in range(4)], "grid_id string, row long, col long, value double")
    got = {(r["grid_id"], r["value"]) for r in raster.bilinear(px, g, px.drop("value"), g, keys=("grid_id",)).collect()}
    assert got == {("a", 10.0), ("b", 90.0)}
    with pytest.raises(PySparkException, match="several layers"):
        raster.bilinear(px, g, px.drop("value"), g).collect()
    lonlat = Grid(1.0, -125.0, -1.0, 49.0, crs="lonlat")
    many = spark.createDataFrame([(k, r, c, 1.0) for k in "ab" for r in range(9) for c in range(9)], "grid_id string, row long, col long, value double")
    with pytest.raises(ValueError, match="several grids"):
        stations.station_bias(many, lonlat)


def test_second_part_inside_counts(spark):
    def ring(x, y, s):
        return [{"x": x + dx * s, "y": y + dy * s} for dx, dy in ((0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0))]

    schema = "id int, rings array<array<struct<x:double,y:double>>>"
    left = spark.createDataFrame([(1, [ring(0.0, 0.0, 100.0)]), (2, [ring(500.0, 500.0, 10.0)])], schema)
    right = spark.createDataFrame([(7, [ring(300.0, 300.0, 5.0), ring(40.0, 40.0, 5.0)]), (8, [ring(505.0, 505.0, 50.0)])], schema)
    assert {tuple(r) for r in geometry.polygons_intersect(left, right).collect()} == {(1, 7), (2, 8)}


def test_mean_profile_averages_components(spark):
    hours = [(dt.datetime(2024, 1, 1, h), "97201", 280.0, u, v, 1000.0) for h, u, v in ((0, -1.0, 5.0), (1, 1.0, 5.0))]
    h = spark.createDataFrame(hours, "ts timestamp, zip_code string, t2m_k double, u10 double, v10 double, sp_mb double")
    prs = h.select("ts", "zip_code", F.explode(F.array(F.lit(500), F.lit(1000))).alias("level_mb"), F.col("u10").alias("u"), F.col("v10").alias("v"), F.col("t2m_k").alias("t_k"))
    normals = spark.createDataFrame([("97201", 1, 40.0)], "zip_code string, month int, normal_f double")
    terrain = spark.createDataFrame([("97201", "aggregate", 1.0, 0.0, 0.0, 0.0)], "zip_code string, cell_id string, hdd_terrain_mult double, hdd_elev_addition double, hdd_uhi_reduction double, hdd_traffic_reduction double")
    row = runs.daily_run(h, prs, normals, terrain, profile_hour="mean")[0].first()
    assert min(row["wind_dir_sfc_deg"], 360 - row["wind_dir_sfc_deg"]) < 1e-6 and abs(row["wind_speed_sfc_kt"] - 5 * 1.94384) < 1e-6


def test_missing_elevation_term_is_missing(spark):
    df = spark.createDataFrame([(None, None), (5.0, None)], "elev double, uhi double")
    got = [r[0] for r in df.select(degree_days.cell_effective_hdd(F.lit(100.0), F.lit(1.0), "elev", "uhi", F.lit(None).cast("double"))).collect()]
    assert got == [None, 105.0]


def test_months_beyond_many_bad_values(spark):
    tables.require_months(spark.createDataFrame([(m,) for m in [*range(100, 200), *range(1, 13)]], "month int"))
    with pytest.raises(ValueError, match=r"\[7\]"):
        tables.require_months(spark.createDataFrame([(m,) for m in range(1, 13) if m != 7], "month int"))


def test_hour_and_level_names(spark):
    h = tables.canonical_hour(spark.createDataFrame([(1, 280.0, 1.0, 2.0, 101300.0)], "k int, t2m double, u10m double, v10m double, sp double")).first()
    assert (h["t2m_k"], h["u10"], h["v10"], h["sp_mb"]) == (280.0, 1.0, 2.0, 1013.0)
    p = tables.canonical_levels(spark.createDataFrame([(500.0, 250.0, 1.0, 2.0)], "isobaricInhPa double, t double, UGRD double, VGRD double")).first()
    assert (p["level_mb"], p["t_k"], p["u"], p["v"]) == (500, 250.0, 1.0, 2.0)


def test_map_shapes_are_closed_and_nested(spark):
    def ring(x, s):
        return [{"x": x, "y": 0.0 + x}, {"x": x + s, "y": 0.0 + x}, {"x": x + s, "y": s + x}, {"x": x, "y": s + x}]

    df = spark.createDataFrame([(1, [ring(0.0, 100.0), ring(10.0, 50.0), ring(20.0, 5.0), ring(500.0, 9.0)]), (2, [])], "id int, rings array<array<struct<x:double,y:double>>>")
    import json
    rows = [json.loads(r["feature"]) for r in registry.geojson_features(df, properties=["id"]).collect()]
    assert len(rows) == 1 and rows[0]["geometry"]["type"] == "MultiPolygon"
    parts = rows[0]["geometry"]["coordinates"]
    assert [len(p) for p in parts] == [2, 1, 1] and all(r[0] == r[-1] for p in parts for r in p)
