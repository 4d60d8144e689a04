import random

import pytest
from pyspark.sql import functions as F

from orograd.operators import geometry, overlay
from orograd.session import checkpoint
from orograd.types import Grid

GRID = Grid(a=1.0, c=0.0, e=-1.0, f=60.0, n_rows=60, n_cols=60)


def rect(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]


CASES = {
    "touching": [("p", [rect(5.2, 5.2, 20.2, 20.2)]), ("q", [rect(20.2, 5.2, 30.2, 12.2)]), ("r", [rect(20.2, 12.2, 33.2, 20.2)])],
    "nested": [("p", [rect(5.2, 5.2, 40.2, 40.2), rect(10.2, 10.2, 30.2, 30.2)]), ("q", [rect(15.2, 15.2, 20.2, 20.2)]), ("r", [rect(6.2, 6.2, 8.2, 8.2)])],
    "disjoint": [("p", [rect(1.2, 1.2, 5.2, 5.2)]), ("q", [rect(40.2, 40.2, 50.2, 55.2)])],
    "overlapping": [("p", [rect(5.2, 5.2, 20.2, 20.2)]), ("q", [rect(12.2, 12.2, 30.2, 30.2)]), ("r", [[(3.2, 3.2), (28.7, 9.1), (14.6, 33.3)]])],
    "hole filled": [("p", [rect(5.2, 5.2, 40.2, 40.2), rect(10.2, 10.2, 30.2, 30.2)]), ("q", [rect(10.2, 10.2, 30.2, 30.2)])],
    "corner": [("p", [rect(5.2, 5.2, 20.2, 20.2)]), ("q", [rect(20.2, 20.2, 30.2, 30.2)])],
    "twice the same": [("p", [rect(5.2, 5.2, 20.2, 20.2)]), ("q", [rect(5.2, 5.2, 20.2, 20.2)[::-1]])],
}


def table(spark, parts, region="R"):
    rows = [(i, region, [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings]) for i, rings in parts]
    return spark.createDataFrame(rows, "id string, region_code string, rings array<array<struct<x: double, y: double>>>")


def held(spark, polygons, key):
    px = spark.range(3600).selectExpr("'g' AS grid_id", "id div 60 AS row", "id % 60 AS col")
    return {(r["row"], r["col"]) for r in geometry.pixels_in_polygons(px, GRID, polygons.select(F.col(key).alias("id"), "rings")).collect()}


@pytest.mark.parametrize("name", sorted(CASES))
def test_union_holds_what_the_parts_hold(spark, name):
    parts = table(spark, CASES[name])
    whole = overlay.dissolve_rings(parts)
    assert whole.count() == 1
    assert held(spark, whole, "region_code") == held(spark, parts, "id")
    if name in ("touching", "nested", "disjoint", "corner"):
        area = geometry.polygon_area(whole.select(F.col("region_code").alias("id"), "rings")).first()["area"]
        apart = [p for p in CASES[name] if not (name == "nested" and p[0] == "r")]
        want = geometry.polygon_area(table(spark, apart)).agg(F.sum("area")).first()[0]
        assert abs(area - want) < 1e-6
    if name == "touching":
        assert len(whole.first()["rings"]) == 1


def test_random_parts_of_two_regions(spark):
    rng = random.Random(5)
    parts = []
    for k in range(24):
        x, y, w, h = rng.randint(1, 40) + 0.2, rng.randint(1, 40) + 0.2, rng.randint(2, 15), rng.randint(2, 15)
        ring = rect(x, y, x + w, y + h) if k % 3 else [(x, y), (x + w + 0.3, y + 0.7), (x + w / 2, y + h + 0.1)]
        parts.append((f"p{k}", [ring]))
    one, two = table(spark, parts[:12], "A"), table(spark, parts[12:], "B")
    whole = overlay.dissolve_rings(one.unionByName(two))
    for region, own in (("A", one), ("B", two)):
        assert held(spark, whole.where(F.col("region_code") == region), "region_code") == held(spark, own, "id")
    assert overlay.dissolve_rings(one.limit(0), bucket=1.0).count() == 0


def pairs_met(spark, monkeypatch, n):
    """Checks the union of `n` shapes in one place; returns how many pairs of edges shared a square on the way."""
    met = []
    cut = overlay.cut_edges

    def counted(e, *, keys, bucket):
        a = e.withColumn("q", F.explode(overlay._squares(bucket))).groupBy(*keys, "q").count()
        met.append(a.agg(F.sum(F.col("count") * F.col("count"))).first()[0] or 0)
        return cut(e, keys=keys, bucket=bucket)

    monkeypatch.setattr(overlay, "cut_edges", counted)
    rng = random.Random(7)
    parts = []
    for k in range(n):
        x, y, w, h = rng.randint(1, 40) + 0.2, rng.randint(1, 40) + 0.2, rng.randint(4, 15), rng.randint(4, 15)
        parts.append((f"p{k}", [rect(x, y, x + w, y + h) if k % 3 else [(x, y), (x + w + 0.3, y + 0.7), (x + w / 2, y + h + 0.1)]]))
    parts = table(spark, parts)
    whole = checkpoint(overlay.dissolve_rings(parts))
    assert whole.count() == 1
    assert held(spark, whole, "region_code") == held(spark, parts, "id")
    return sum(met)


def test_crowded_shapes_compare_no_more_edges_each(spark, monkeypatch):
    few = pairs_met(spark, monkeypatch, 60)
    monkeypatch.undo()
    assert pairs_met(spark, monkeypatch, 600) < 20 * few
