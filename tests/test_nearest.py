import random

import pytest

from orograd.operators.nearest import nearest
from orograd.operators.stations import nearest_curvilinear, nearest_station
from pyspark.sql import functions as F
from orograd.functions.geodesy import haversine_km


def brute(points, sites):
    pairs = points.crossJoin(sites).withColumn("km", haversine_km("lat", "lon", "slat", "slon"))
    return {r["k"]: (r["b"]["km"], r["b"]["gy"], r["b"]["gx"]) for r in pairs.groupBy("k").agg(F.min(F.struct("km", "gy", "gx")).alias("b")).collect()}


@pytest.mark.parametrize("kind", ["regional", "global", "one square"])
def test_equal_to_brute_force(spark, kind):
    rng = random.Random(3)
    if kind == "regional":
        cells = [(y, x, 42 + y * 0.031 + x * 0.002, -124 + x * 0.042 - y * 0.003) for y in range(40) for x in range(40)]
    elif kind == "global":
        cells = [(k, 0, rng.uniform(-90, 90), rng.uniform(-180, 180)) for k in range(300)]
    else:
        cells = [(k, 0, 45.0 + k * 1e-9, -120.0) for k in range(200)]
    points = [(k, rng.uniform(41, 45), rng.uniform(-125, -121)) for k in range(60)]
    points += [(100, -45.0, 60.0), (101, 89.99, 10.0), (102, -90.0, 0.0), (103, 10.0, 179.99), (104, 10.0, -179.99), (105, 60.0, -122.0), (106, 42.0, -124.0)]
    p = spark.createDataFrame([*points, (200, None, 1.0), (201, 1.0, None)], "k int, lat double, lon double")
    c = spark.createDataFrame(cells, "gy int, gx int, lat double, lon double")
    got = {r["k"]: (r["km"], r["gy"], r["gx"]) for r in nearest(p, c, lat="lat", lon="lon", take=("gy", "gx"), out_km="km").collect()}
    assert len(got) == len(points) + 2 and got.pop(200) == got.pop(201) == (None, None, None)
    want = brute(p.where("lat is not null and lon is not null"), c.withColumnsRenamed({"lat": "slat", "lon": "slon"}))
    for k, (km, gy, gx) in want.items():
        assert abs(got[k][0] - km) < 1e-6 and got[k][1:] == (gy, gx), (k, got[k], km, gy, gx)


def test_repeated_places_ties_and_empty_tables(spark):
    c = spark.createDataFrame([(5, 1, 45.0, -120.0), (2, 9, 45.0, -120.0), (3, 3, 45.0, -121.0), (1, 1, None, 0.0)], "gy int, gx int, lat double, lon double")
    p = spark.createDataFrame([("a", 45.0, -120.1), ("a", 45.0, -120.1), ("b", -45.0, 60.0)], "k string, lat double, lon double")
    got = sorted((r["k"], r["gy"], r["gx"]) for r in nearest_curvilinear(p, c).collect())
    assert got[:2] == [("a", 2, 9)] * 2 and got[2][0] == "b"
    assert [r["gy"] for r in nearest_curvilinear(p, c.limit(0)).collect()] == [None] * 3
    assert nearest_curvilinear(p.limit(0), c).count() == 0


def test_stations_of_a_table(spark):
    sites = spark.createDataFrame([("A", 45.0, -120.0), ("B", 46.0, -120.0)], "station_id string, lat double, lon double")
    p = spark.createDataFrame([(1, 45.2, -120.0), (2, 45.9, -119.0), (3, None, 1.0)], "k int, centroid_lat double, centroid_lon double")
    got = {r["k"]: (r["base_station"], r["distance_km"]) for r in nearest_station(p, sites=sites).collect()}
    assert got[1][0] == "A" and abs(got[1][1] - 22.239) < 0.01 and got[2][0] == "B" and got[3] == (None, None)
