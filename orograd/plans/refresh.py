"""A table of normals that refreshes only what is stale: hashes of pixel tiles, the ZIPs that use them, partitions by ZIP."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.geometry import pixels_in_polygons
from ..operators.raster import TILE
from ..session import checkpoint
from ..types import Grid

TILE_KEYS = ["grid_id", "tile_r", "tile_c"]


def _tiled(px: DataFrame, tile: int) -> DataFrame:
    return px.withColumns({f"tile_{k[0]}": F.floor(F.col(k) / F.lit(tile)).cast("long") for k in ("row", "col")})


def tile_hashes(px: DataFrame, *, tile: int = TILE) -> DataFrame:
    """(grid_id, tile_r, tile_c, num_pixels, hash_a, hash_b): what each tile's pixels hold, whatever their order.

    All columns count, in the order of their names; one aggregation with map-side combining.
    """
    cols = [F.col(k).cast("long") if k in ("row", "col") else F.col(k) for k in sorted(px.columns)]
    marks = [F.coalesce(c.cast("string"), F.lit("\x00")) for c in cols]
    return _tiled(px, tile).groupBy(*TILE_KEYS).agg(F.count(F.lit(1)).alias("num_pixels"), F.bit_xor(F.xxhash64(*marks)).alias("hash_a"),
                                                    F.bit_xor(F.xxhash64(F.lit("b"), *marks)).alias("hash_b"))


def zip_hashes(zips: DataFrame) -> DataFrame:
    return zips.select(F.col("id").alias("zip_code"), F.xxhash64("rings").alias("rings_hash"))


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return spark.read.parquet(path) if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p) else None


def refresh(px: DataFrame, grid: Grid | DataFrame, zips: DataFrame, path: str, build: Callable[[DataFrame, DataFrame], DataFrame], *, tile: int = TILE) -> DataFrame:
    """Bring the table under `path` up to date and return the ZIPs (zip_code) that were made anew.

    `build(px, zips)` gives rows with `zip_code` from the bands of pixels and ZIP polygons `(id, rings)`; each ZIP's rows must follow from
    the pixels inside it alone. A ZIP is stale when a tile that holds a pixel of it changed, came or went, or its polygon did. Only
    stale ZIPs are built, from the tiles that they touch, and only their partitions are replaced; ZIPs that are gone lose
    theirs. Hashes are written last, so a run that fails half way is simply repeated.
    """
    spark = px.sparkSession
    new_tiles, new_zips = checkpoint(tile_hashes(px, tile=tile)), checkpoint(zip_hashes(zips))
    where = px.select("grid_id", "row", "col")
    uses = checkpoint(_tiled(pixels_in_polygons(where, grid, zips), tile).select(F.col("id").alias("zip_code"), *TILE_KEYS).distinct())
    old_tiles, old_zips, old_uses = (_stored(spark, f"{path}/{k}") for k in ("tiles", "zips", "uses"))
    if old_tiles is None:
        stale, gone = new_zips.select("zip_code"), new_zips.select("zip_code").limit(0)
    else:
        moved = new_tiles.exceptAll(old_tiles.select(new_tiles.columns)).unionByName(old_tiles.select(new_tiles.columns).exceptAll(new_tiles)).select(*TILE_KEYS).distinct()
        touched = uses.unionByName(old_uses.select(uses.columns)).join(moved, TILE_KEYS, "left_semi").select("zip_code")
        redrawn = new_zips.exceptAll(old_zips.select(new_zips.columns)).select("zip_code")
        stale = touched.unionByName(redrawn).distinct().join(new_zips, "zip_code", "left_semi")
        gone = old_zips.select("zip_code").join(new_zips, "zip_code", "left_anti")
    stale, gone = checkpoint(stale), [r["zip_code"] for r in checkpoint(gone).collect()]   # ZIPs removed at once are few names
    if stale.limit(1).count():
        tiles = uses.join(stale, "zip_code", "left_semi").select(*TILE_KEYS).distinct()
        some = _tiled(px, tile).join(tiles, TILE_KEYS, "left_semi").drop("tile_r", "tile_c")
        own = zips.join(stale, F.col("id") == F.col("zip_code"), "left_semi")
        made = build(some, own).join(stale, "zip_code", "left_semi")
        made.repartition("zip_code").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("zip_code").parquet(f"{path}/table")
    for name in gone:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/table/zip_code={name}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    for k, df in (("uses", uses), ("zips", new_zips), ("tiles", new_tiles)):
        df.write.mode("overwrite").parquet(f"{path}/{k}")
    return stale


def refreshed_table(spark: SparkSession, path: str) -> DataFrame:
    """The table; ZIP codes stay text, leading zeros too."""
    found = spark.read.parquet(f"{path}/table").schema
    text = T.StructType([T.StructField(f.name, T.StringType()) if f.name == "zip_code" else f for f in found.fields])
    return spark.read.schema(text).parquet(f"{path}/table")
