import os

from pyspark.sql import functions as F

from orograd.plans import refresh
from orograd.operators import geometry
from orograd.types import Grid

GRID = Grid(1.0, 0.0, -1.0, 40.0, n_rows=40, n_cols=40)


def zips(spark, boxes):
    rows = [(k, [[{"x": float(x), "y": float(y)} for x, y in ((a, b), (a + 8, b), (a + 8, b + 8), (a, b + 8))]]) for k, (a, b) in boxes.items()]
    return spark.createDataFrame(rows, "id string, rings array<array<struct<x: double, y: double>>>")


def test_only_stale_zips_are_made_anew(spark, tmp_path):
    boxes = {"97001": (1.2, 1.2), "97002": (12.2, 1.2), "97003": (20.2, 25.2), "97004": (30.2, 30.2)}
    px = spark.range(1600).selectExpr("'g' AS grid_id", "id div 40 AS row", "id % 40 AS col", "cast(id * 7 % 31 AS double) AS v").cache()
    built = []

    def build(some, own):
        built.append(sorted(r["id"] for r in own.collect()))
        at = geometry.pixels_in_polygons(some, GRID, own)
        return at.groupBy(F.col("id").alias("zip_code")).agg(F.sum("v").alias("total"), F.count(F.lit(1)).alias("n"))

    def full(px, z):
        return sorted(map(tuple, build(px, z).select("zip_code", "total", "n").collect()))

    def held():
        return sorted(map(tuple, refresh.refreshed_table(spark, path).select("zip_code", "total", "n").collect()))

    path, z = str(tmp_path / "normals"), zips(spark, boxes)
    assert sorted(r["zip_code"] for r in refresh.refresh(px, GRID, z, path, build, tile=10).collect()) == sorted(boxes)
    assert held() == full(px, z)
    before = {k: os.stat(f"{path}/table/zip_code={k}").st_mtime_ns for k in boxes}
    assert refresh.refresh(px, GRID, z, path, build, tile=10).count() == 0 and len(built) == 2
    # one pixel of the tile in the lower left, inside 97001, changes
    now = px.withColumn("v", F.when((F.col("row") == 35) & (F.col("col") == 3), 1000.0).otherwise(F.col("v")))
    assert [r["zip_code"] for r in refresh.refresh(now, GRID, z, path, build, tile=10).collect()] == ["97001"]
    assert built[-1] == ["97001"] and held() == full(now, z)
    after = {k: os.stat(f"{path}/table/zip_code={k}").st_mtime_ns for k in boxes}
    assert {k for k in boxes if before[k] != after[k]} == {"97001"}
    # one polygon moves, one goes, one comes
    z = zips(spark, {"97001": (1.2, 1.2), "97002": (13.2, 2.2), "97003": (20.2, 25.2), "01005": (5.2, 20.2)})
    assert sorted(r["zip_code"] for r in refresh.refresh(now, GRID, z, path, build, tile=10).collect()) == ["01005", "97002"]
    assert held() == full(now, z)
