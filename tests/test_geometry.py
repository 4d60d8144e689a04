import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from orograd.operators import geometry
from orograd.sources import tables
from orograd.types import Grid

POLY = "id string, rings array<array<struct<x:double,y:double>>>"


def polys(spark, shapes):
    return spark.createDataFrame([(k, [[(float(x), float(y)) for x, y in r] for r in rings]) for k, rings in shapes.items()], POLY)


def box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]


SQUARE = {"z": [box(0, 0, 1000, 1000)]}


@pytest.mark.parametrize("shape,size,count", [
    (box(0, 0, 1000, 1000), 500, 4), (box(0, 0, 2000, 2000), 500, 16), (box(0, 0, 2000, 2000), 1000, 4),
    (box(0, 0, 2000, 2000), 250, 64), (box(250, 250, 750, 750), 500, 1), (box(0, 0, 10, 10), 500, 1)])
def test_cell_counts(spark, shape, size, count):
    cells = geometry.create_cells(polys(spark, {"z": [shape]}), cell_size_m=size).collect()
    assert len(cells) == count
    area = (shape[1][0] - shape[0][0]) * (shape[2][1] - shape[0][1])
    assert sum(c["cell_area_sqm"] for c in cells) == pytest.approx(area)
    assert sorted(c["cell_id"] for c in cells) == [f"cell_{i:03d}" for i in range(1, count + 1)]


def test_cells_of_odd_shapes(spark):
    shapes = {"cut": [[(0, 0), (1000, 0), (1000, 1000), (500, 1000), (0, 500)]],
              "hole": [box(0, 0, 1000, 1000), box(250, 250, 750, 750)],
              "closed": [box(0, 0, 1000, 1000) + [(0, 0)]]}
    cells = geometry.create_cells(polys(spark, shapes))
    got = {r["id"]: r["a"] for r in cells.groupBy("id").agg(F.sum("cell_area_sqm").alias("a")).collect()}
    assert got == {"cut": pytest.approx(875000), "hole": pytest.approx(750000), "closed": pytest.approx(1000000)}
    assert cells.where("cell_area_sqm > 250000.001").count() == 0
    first = cells.where("id = 'hole' and cell_id = 'cell_001'").first()
    assert (first["ix"], first["iy"]) == (0, 0)


def test_empty_geometry_is_an_error(spark):
    with pytest.raises(ValueError):
        geometry.create_cells(polys(spark, {"z": []}))


def test_numbering_in_two_steps(spark):
    df = spark.createDataFrame([("a", i, j) for i in range(7) for j in range(5) if (i + j) % 3], "k string, iy int, ix int")
    got = geometry.number_rows(df, ["k"], "iy", "ix").orderBy("iy", "ix").select("cell_no").collect()
    assert [r[0] for r in got] == list(range(1, len(got) + 1))


def test_pixels_in_polygon_concave_with_hole(spark):
    rings = [[(1.3, 1.1), (18.2, 2.7), (9.9, 9.3), (17.4, 18.8), (2.2, 17.1)], [(4, 6), (7, 6), (7, 12), (4, 12)]]
    px = spark.createDataFrame([("g", r, c) for r in range(21) for c in range(21)], "grid_id string, row int, col int")
    grid = Grid(1.0, 0.0, -1.0, 21.0, 21, 21)
    got = {(r["row"], r["col"]) for r in geometry.pixels_in_polygons(px, grid, polys(spark, {"p": rings}), block=4).collect()}

    def inside(x, y):
        odd = False
        for ring in rings:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
                if (y1 > y) != (y2 > y) and x < x1 + (y - y1) / (y2 - y1) * (x2 - x1):
                    odd = not odd
        return odd

    assert got == {(r, c) for r in range(21) for c in range(21) if inside(c + 0.5, 20.5 - r)}


def test_clip_crops_and_masks(spark):
    px = spark.createDataFrame([("g", r, c, 1.0) for r in range(10) for c in range(10)], "grid_id string, row int, col int, value double")
    tri = {"t": [[(2, 2), (8, 2), (2, 8)]]}
    out = geometry.clip(px, Grid(1.0, 0.0, -1.0, 10.0), polys(spark, tri))
    assert out.count() == 36 and 10 < out.where("value is not null").count() < 36


def test_overlapping_parts_neither_copy_nor_cancel(spark):
    px = spark.createDataFrame([("g", r, c, 1.0) for r in range(10) for c in range(10)], "grid_id string, row int, col int, value double")
    parts = polys(spark, {"a": [box(0, 0, 6, 6)], "b": [box(3, 3, 9, 9)], "c": [box(6, 0, 9, 3)]})
    out = geometry.clip(px, Grid(1.0, 0.0, -1.0, 10.0), parts, block=4)
    assert out.count() == 81 and out.where("value is not null").count() == 36 + 36 - 9 + 9


def test_centroid_and_area(spark):
    p = polys(spark, {"s": [box(0, 0, 4, 2)], "h": [box(0, 0, 4, 4), list(reversed(box(1, 1, 2, 3)))]})
    got = {r["id"]: (r["centroid_x"], r["centroid_y"]) for r in geometry.polygon_centroid(p).collect()}
    assert got["s"] == (2, 1) and got["h"] == pytest.approx((29 / 14, 2))
    assert {r["id"]: r["area"] for r in geometry.polygon_area(p).collect()} == {"s": 8, "h": 14}


def roads(spark, rows):
    return spark.createDataFrame([(i, float(a), float(f), [(float(x), float(y)) for x, y in pts]) for i, (a, f, pts) in enumerate(rows)],
                                 "road_id long, aadt double, heat_flux_wm2 double, pts array<struct<x:double,y:double>>")


def test_road_buffer_and_overlap(spark):
    n = 100
    px = spark.createDataFrame([("g", r, c) for r in range(n) for c in range(n)], "grid_id string, row int, col int")
    lines = [(5000, 100, [(10, 50), (50, 52), (90, 50)]), (25000, 50, [(48, 10), (48, 15)])]
    out = geometry.road_heat(px, Grid(1.0, 0.0, -1.0, 100.0, n, n), roads(spark, lines))

    def dist(x, y, pts):
        best = math.inf
        for (x1, y1), (x2, y2) in zip(pts, pts[1:]):
            t = max(0, min(1, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2)))
            best = min(best, math.hypot(x - x1 - t * (x2 - x1), y - y1 - t * (y2 - y1)))
        return best

    want = np.zeros((n, n))
    for (aadt, flux, pts), buf in zip(lines, (50, 100)):
        for r, c in np.ndindex(n, n):
            want[r, c] += flux * (dist(c + 0.5, 99.5 - r, pts) <= buf)
    got = np.zeros((n, n))
    for r in out.collect():
        got[r["row"], r["col"]] = r["road_heat_flux_wm2"]
    np.testing.assert_allclose(got, want)


def test_road_heat_flux_formula(spark):
    src = roads(spark, [(43200, 0, [(0, 0), (0, 200)]), (0, 0, [(0, 0), (1, 1)])]).drop("heat_flux_wm2")
    out = tables.road_heat_flux(src).collect()
    assert len(out) == 1 and out[0]["heat_flux_wm2"] == pytest.approx(0.5 * 150000 / (200 * 3.7))


def test_intersections(spark):
    left = polys(spark, {"a": [box(0, 0, 2, 2)], "b": [box(10, 10, 11, 11)], "c": [box(4, 4, 5, 5)]})
    right = polys(spark, {"x": [box(1, 1, 9, 9)], "y": [box(20, 20, 30, 30)]})
    got = {(r[0], r[1]) for r in geometry.polygons_intersect(left, right, bucket=3.0).collect()}
    assert got == {("a", "x"), ("c", "x")}
    assert {(r[0], r[1]) for r in geometry.polygons_intersect(left, right).collect()} == got


def test_strips_of_a_ring_of_many_edges(spark):
    """A star of 20,000 edges in 60 strips: the cells add up to its area, and no row holds a whole ring per strip."""
    import math
    n = 20_000
    pts = [{"x": (500 + 30 * (k % 2)) * math.cos(2 * math.pi * k / n), "y": (500 + 30 * (k % 2)) * math.sin(2 * math.pi * k / n)} for k in range(n)]
    p = spark.createDataFrame([("a", [pts])], "id string, rings array<array<struct<x: double, y: double>>>")
    strips = geometry._strips(p, 1060 / 60)
    held = strips.selectExpr("size(pts) AS n").agg({"n": "sum", "*": "count"}).first()
    assert held[0] < 4 * n or held[1] < 4 * n
    cells = geometry.create_cells(p, cell_size_m=1060 / 60)
    area = geometry.polygon_area(p).first()["area"]
    assert abs(cells.agg({"cell_area_sqm": "sum"}).first()[0] - area) < 1e-6 * area


def test_road_seen_in_several_blocks_and_by_several_segments_counts_once(spark):
    n = 2 * geometry.SPAN_BLOCK + 40
    px = spark.range(n * 3).selectExpr("'g' AS grid_id", "id div 3 AS row", "id % 3 AS col")
    there_and_back = [(1.5, 10.2), (1.5, n - 10.2), (1.5, 15.2)]
    lines = [(5000, 100, there_and_back), (5000, 7, [(1.5, 20.2), (1.5, n - 20.2)]), (5000, 3, [(1.2, 30.2), (1.2, 30.2)])]
    out = geometry.road_heat(px, Grid(1.0, 0.0, -1.0, float(n), n, 3), roads(spark, lines)).collect()
    for r in out:
        y = n - r["row"] - 0.5
        x = r["col"] + 0.5
        want = 100.0 * (math.hypot(x - 1.5, max(0, 10.2 - y, y - (n - 10.2))) <= 50) + 7.0 * (math.hypot(x - 1.5, max(0, 20.2 - y, y - (n - 20.2))) <= 50)
        assert r["road_heat_flux_wm2"] == want + 3.0 * (math.hypot(x - 1.2, y - 30.2) <= 50)


def test_the_loop_over_road_pixels_is_short_enough_to_be_compiled(spark, capsys):
    """The JVM never compiles methods of more than 8,000 bytes; a loop in one is interpreted."""
    px = spark.range(100).selectExpr("'g' AS grid_id", "id div 10 AS row", "id % 10 AS col")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        geometry.road_heat(px, Grid(1.0, 0.0, -1.0, 10.0, 10, 10), roads(spark, [(5000, 1, [(1, 1), (5, 3)])])).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(k) for k in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000
