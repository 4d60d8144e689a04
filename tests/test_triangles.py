import numpy as np
import pytest
from pyspark.sql import functions as F

from orograd.operators import stations
from orograd.operators.triangles import delaunay, interpolate
from orograd.types import Grid, placements


def brute(xy):
    """Triangles with no other point inside their circle, by definition."""
    n, out = len(xy), set()
    for i in range(n):
        for j in range(i + 1, n):
            for k in range(j + 1, n):
                a, b, c = xy[[i, j, k]]
                area = (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
                m = np.array([b - a, c - a])
                centre = a + np.linalg.solve(2 * m, (m ** 2).sum(axis=1)) if abs(area) > 1e-12 else None
                if centre is not None and (((xy - centre) ** 2).sum(axis=1) >= ((a - centre) ** 2).sum() * (1 - 1e-10)).all():
                    out.add((i, j, k))
    return out


@pytest.mark.parametrize("n", [3, 4, 9, 26])
def test_triangles_by_definition(n):
    xy = np.random.default_rng(n).uniform(size=(n, 2)) * [3, 1] + 100
    assert {tuple(sorted(t)) for t in delaunay(xy).tolist()} == brute(xy)


def test_degenerate_points():
    line = np.array([[k, 2.0 * k] for k in range(6)])
    assert len(delaunay(line)) == 0 and len(delaunay(line[:2])) == 0
    grid = np.array([[x, y] for x in range(6) for y in range(5)], dtype=float)
    t = delaunay(grid)
    a, b, c = grid[t[:, 0]], grid[t[:, 1]], grid[t[:, 2]]
    area = ((b - a)[:, 0] * (c - a)[:, 1] - (b - a)[:, 1] * (c - a)[:, 0]) / 2
    assert (area > 0).all() and area.sum() == 20


def test_five_thousand_points_cover_the_hull():
    xy = np.random.default_rng(1).uniform(size=(5000, 2))
    t = delaunay(xy)
    a, b, c = xy[t[:, 0]], xy[t[:, 1]], xy[t[:, 2]]
    area = ((b - a)[:, 0] * (c - a)[:, 1] - (b - a)[:, 1] * (c - a)[:, 0]) / 2
    assert (area > 0).all() and 0.98 < area.sum() < 1
    edges = np.sort(np.concatenate([t[:, [0, 1]], t[:, [1, 2]], t[:, [2, 0]]]), axis=1)
    times = np.unique(edges, axis=0, return_counts=True)[1]
    hull = int((times == 1).sum())
    assert times.max() == 2 and len(t) == 2 * 5000 - 2 - hull


def test_a_plane_comes_back_on_two_grids(spark):
    rng = np.random.default_rng(4)
    grids = {"a": Grid(1.0, 0.0, -1.0, 40.0, n_rows=40, n_cols=40), "b": Grid(2.0, 200.0, -2.0, 90.0, n_rows=30, n_cols=30)}
    px = spark.createDataFrame([(g, r, c, 1.0) for g, n in (("a", 40), ("b", 30)) for r in range(n) for c in range(n)], "grid_id string, row long, col long, value double")
    sites = [("a", f"s{k}", float(x), float(y)) for k, (x, y) in enumerate(rng.uniform(2.3, 37.6, size=(300, 2)))]
    sites += [("b", f"t{k}", float(x), float(y)) for k, (x, y) in enumerate(rng.uniform([203, 33], [257, 87], size=(50, 2)))]
    s = spark.createDataFrame(sites, "grid_id string, station_id string, sx double, sy double").withColumn("v", F.expr("3 * sx - 2 * sy + 1"))
    s = s.unionByName(s.limit(1).withColumn("station_id", F.lit("z again"))).unionByName(s.limit(1).withColumn("v", F.lit(None).cast("double")))
    got = interpolate(px, placements(spark, grids), s, ["v"], ["out"]).collect()
    inside = [r for r in got if r["out"] is not None]
    assert len(got) == 2500 and len(inside) > 1500
    for r in inside:
        g = grids[r["grid_id"]]
        assert abs(r["out"] - (3 * (g.c + g.a * r["col"]) - 2 * (g.f + g.e * r["row"]) + 1)) < 1e-8


def test_wind_of_a_station_table(spark):
    grid = Grid(0.1, -125.0, -0.1, 47.0, crs="lonlat")
    px = spark.createDataFrame([(r, c, 9.0) for r in range(20) for c in range(20)], "row long, col long, value double")
    sites = spark.createDataFrame([("A", 46.9, -124.9), ("B", 46.9, -123.6), ("C", 45.6, -124.2)], "station_id string, lat double, lon double")
    wind = spark.createDataFrame([("A", 2.0), ("B", 2.0), ("C", 2.0)], "station_id string, mean_wind_ms double")
    got = {(r["row"], r["col"]): r["wind_ms"] for r in stations.wind_merge(px, grid, wind, sites=sites).collect()}
    assert abs(got[5, 8] - 2.0) < 1e-9 and got[19, 19] == 9.0 and len(got) == 400
