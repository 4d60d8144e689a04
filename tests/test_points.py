import numpy as np
import pytest
from pyspark.sql import functions as F

from orograd.operators import quantiles, stations
from orograd.operators.registry import registry_bbox, registry_generate, zip_priority_merge, find_region
from orograd.types import STATIONS, Grid


def cross(a, b):
    return a[0] * b[1] - a[1] * b[0]


def test_delaunay_covers_hull_once():
    xy = np.array([(s[4], s[3]) for s in STATIONS])
    tri = stations._triangles(xy)
    areas = [abs(cross(xy[b] - xy[a], xy[c] - xy[a])) / 2 for a, b, c in tri]
    pts = sorted(map(tuple, xy))
    hull = []
    for part in (pts, pts[::-1]):
        chain = []
        for p in part:
            while len(chain) > 1 and cross(np.subtract(chain[-1], chain[-2]), np.subtract(p, chain[-2])) <= 0:
                chain.pop()
            chain.append(p)
        hull += chain[:-1]
    shoelace = abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(hull, hull[1:] + hull[:1]))) / 2
    assert sum(areas) == pytest.approx(shoelace)


def lonlat_grid(spark, value):
    rows = [("g", r, c, value(r, c)) for r in range(60) for c in range(60)]
    return spark.createDataFrame(rows, "grid_id string, row int, col int, value double"), Grid(0.1, -125.5, -0.1, 47.5, 60, 60, "lonlat")


def test_station_bias_meets_normals(spark):
    px, grid = lonlat_grid(spark, lambda r, c: 4000.0)
    out = stations.station_bias(px, grid)
    assert out.where("corrected = value").count() > 0  # outside the hull
    offsets = out.select((F.col("corrected") - F.col("value")).alias("o")).agg(F.min("o"), F.max("o")).first()
    assert offsets[0] >= 0 and offsets[1] <= 1800


def test_scaled_months_sum_to_the_corrected_year(spark):
    year, grid = lonlat_grid(spark, lambda r, c: 3900.0)
    months = year.withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12)))).withColumn("hdd", F.col("month") * 50.0).drop("value")
    total = stations.station_bias_monthly(months, grid, mode="scaled").groupBy("row", "col").agg(F.sum("corrected").alias("s"))
    both = total.join(stations.station_bias(year, grid), ["row", "col"])
    assert both.select(F.max(F.abs(F.col("s") - F.col("corrected")))).first()[0] < 1e-6
    annual = stations.station_bias_monthly(months, grid)
    assert annual.where("month = 1 and corrected > 3000").count() > 0  # each month alone is raised to the annual normal
    with pytest.raises(ValueError):
        stations.station_bias_monthly(months, grid, mode="x")


def test_too_few_stations_leave_grid(spark):
    px, _ = lonlat_grid(spark, lambda r, c: 1.0)
    far = Grid(0.1, 10.0, -0.1, 47.5, 60, 60, "lonlat")
    assert stations.station_bias(px, far).where("corrected <> value").count() == 0


def test_wind_merge_linear_surface(spark):
    px, grid = lonlat_grid(spark, lambda r, c: -1.0)
    wind = spark.createDataFrame([(s, 2 * lo + 3 * la) for s, _, _, la, lo in STATIONS], "station_id string, mean_wind_ms double")
    out = stations.wind_merge(px, grid, wind)
    got = out.where("wind_ms <> value").withColumn("want", 2 * (F.col("col") * 0.1 - 125.5) + 3 * (47.5 - F.col("row") * 0.1))
    assert got.count() > 100
    assert got.select(F.max(F.abs(F.col("wind_ms") - F.col("want")))).first()[0] < 1e-6


def test_station_wind(spark):
    obs = spark.createDataFrame([("KPDX", "2.5"), ("KPDX", "3.0"), ("KPDX", "2.8"), ("KPDX", "x"), ("KPDX", "NaN"), ("ZZZZ", "1")],
                                "station_id string, wind_speed_set_1 string")
    r = stations.station_wind(obs).collect()
    assert len(r) == 1 and r[0]["mean_wind_ms"] == pytest.approx(8.3 / 3) and r[0]["num_obs"] == 3
    assert r[0]["p90_wind_ms"] == pytest.approx(np.quantile([2.5, 2.8, 3.0], 0.9))


def test_exact_quantiles_with_a_hot_key(spark):
    rng = np.random.default_rng(5)
    data = {"hot": rng.integers(0, 50, 4000) / 7.0, "few": np.array([1.0, 2, 3, 10]), "one": np.array([5.0])}
    df = spark.createDataFrame([(k, float(x)) for k, xs in data.items() for x in xs], "k string, v double")
    got = {r["k"]: r for r in quantiles.exact_quantiles(df, "v", {"q1": 0.25, "q2": 0.5, "q9": 0.9}, keys=("k",), buckets=16).collect()}
    for k, xs in data.items():
        np.testing.assert_allclose([got[k]["q1"], got[k]["q2"], got[k]["q9"]], np.quantile(xs, [0.25, 0.5, 0.9]), rtol=1e-12)


CENTROIDS = [("97201", "OR", 45.52, -122.69), ("97202", "OR", 45.48, -122.63), ("98001", "WA", 47.30, -122.26)]


def centroids(spark):
    return spark.createDataFrame(CENTROIDS, "zip_code string, state string, centroid_lat double, centroid_lon double")


def test_registry(spark):
    reg = registry_generate(centroids(spark))
    box = registry_bbox(reg, centroids(spark)).first()
    assert (box["minx"], box["miny"], box["maxx"], box["maxy"]) == pytest.approx((-123.19, 44.98, -121.76, 47.80))
    assert box["num_zips"] == 3 and box["lidar_vintage"] == 2021
    with pytest.raises(ValueError):
        find_region(reg, "nowhere")


def test_nearest_station_matches_direct_distance(spark):
    for z, _, la, lo in CENTROIDS:
        def km(s):
            a = np.radians([la, s[3]])
            h = np.sin((a[1] - a[0]) / 2) ** 2 + np.cos(a[0]) * np.cos(a[1]) * np.sin(np.radians(s[4] - lo) / 2) ** 2
            return 2 * 6371 * np.arcsin(np.sqrt(h))
        best = min(STATIONS, key=km)
        got = stations.nearest_station(centroids(spark)).where(F.col("zip_code") == z).first()
        assert got["base_station"] == best[0] and got["distance_km"] == pytest.approx(km(best))


def test_nearest_axis_beyond_ends_and_ties(spark):
    axis = spark.createDataFrame([(i, float(x)) for i, x in enumerate([0, 1, 2, 10])], "gy long, v double")
    pts = spark.createDataFrame([(-5.0,), (0.5,), (6.0,), (7.0,), (99.0,)], "at double")
    got = {r["at"]: r["gy"] for r in stations.nearest_on_axis(pts, axis, at="at", index="gy", coord="v").collect()}
    assert got == {-5.0: 0, 0.5: 0, 6.0: 2, 7.0: 3, 99.0: 3}


def test_priority_merge(spark):
    a = spark.createDataFrame([("1", "a")], "zip_code string, source string")
    b = spark.createDataFrame([("1", "b"), ("2", "b")], "zip_code string, source string")
    c = spark.createDataFrame([("2", "c"), ("3", "c"), ("3", "c")], "zip_code string, source string")
    got = sorted(tuple(r) for r in zip_priority_merge(a, b, c).select("zip_code", "source").collect())
    assert got == [("1", "a"), ("2", "b"), ("3", "c"), ("3", "c")]
