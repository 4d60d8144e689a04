"""Exact nearest join on the sphere: cubes around points, and a descent through larger cubes for points far from all."""

from __future__ import annotations

from math import asin

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geodesy import haversine_km
from ..session import checkpoint, spread

MAX_PER_CUBE = 48        # sites of a cube, if places differ enough
FINEST = 24              # halvings of the globe's box; a cube is some 0.8 m wide then
STEP = 2                 # halvings that one step of the descent goes down
SLACK = 1e-12            # of a squared chord: more than its rounding, so equal distances stay


def _xyz(lat: str, lon: str) -> dict[str, Column]:
    """A place on the unit sphere; chords order places as great circles do, without seams at poles or the date line."""
    la, lo = F.radians(F.col(lat)), F.radians(F.col(lon))
    return {"_x": F.cos(la) * F.cos(lo), "_y": F.cos(la) * F.sin(lo), "_z": F.sin(la)}


def _side(level: int) -> float:
    return 2.0 / (1 << level)


def _cube(level: int) -> Column:
    """The cube at a level: three indexes."""
    def at(k: str) -> Column:
        return F.greatest(F.lit(0), F.least(F.lit((1 << level) - 1), F.floor((F.col(k) + 1.0) / _side(level)))).cast("long")
    return _packed(at("_x"), at("_y"), at("_z"))


def _packed(i: Column, j: Column, k: Column) -> Column:
    return F.struct(i.alias("i"), j.alias("j"), k.alias("k"))


def _leaf_level(sites: DataFrame) -> int:
    """The coarsest level whose fullest cube holds MAX_PER_CUBE sites at most; sites at one place are one."""
    for level in range(4, FINEST + 1, 2):
        most = sites.groupBy(_cube(level).alias("q")).count().agg(F.max("count")).first()[0]
        if most is None or most <= MAX_PER_CUBE:
            return level
    return FINEST


def nearest(points: DataFrame, sites: DataFrame, *, lat: str, lon: str, site_lat: str = "lat", site_lon: str = "lon",
            take: tuple[str, ...], out_km: str | None = None) -> DataFrame:
    """Add columns `take` of the site nearest by great circle to each point, of sites at equal distance the least by `take`.

    Both tables may have any size. Points first ask the 27 cubes around them; a site nearer than a cube is wide settles a point. The
    others go down from the largest cubes, where a cube is kept only while it can hold a nearer site than
    another is sure to: as exact for a point on the far side of the globe. A missing coordinate has no nearest site,
    nor has any point where there are no sites. Points stay rows of their own, other columns are kept.
    """
    kept = list(points.columns)
    key = F.struct(*[F.col(k) for k in take])
    s = (sites.where(F.col(site_lat).isNotNull() & F.col(site_lon).isNotNull()).groupBy(F.col(site_lat).alias("_la"), F.col(site_lon).alias("_lo"))
         .agg(F.min(key).alias("_site")).withColumns(_xyz("_la", "_lo")))
    s = checkpoint(s)
    level = _leaf_level(s)
    p = checkpoint(points.withColumn("_pid", F.monotonically_increasing_id()))
    asked = p.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select("_pid", F.col(lat).alias("_pla"), F.col(lon).alias("_plo")).withColumns(_xyz("_pla", "_plo"))
    leaves = checkpoint(s.groupBy(_cube(level).alias("_q")).agg(F.collect_list(F.struct("_la", "_lo", "_site")).alias("_held")))

    def best(rows: DataFrame) -> DataFrame:
        """The best site of each point over the leaves that it asks."""
        own = F.array_min(F.transform("_held", lambda h: F.struct(haversine_km(F.col("_pla"), F.col("_plo"), h["_la"], h["_lo"]).alias("km"), h["_site"].alias("site"))))
        return rows.join(leaves, "_q").select("_pid", own.alias("_own")).groupBy("_pid").agg(F.min("_own").alias("_best"))

    steps = F.array(*[F.lit(k) for k in (-1, 0, 1)])
    home = _cube(level)
    around = F.flatten(F.transform(steps, lambda a: F.flatten(F.transform(steps, lambda b: F.transform(steps, lambda c: _packed(
        (F.col("_h.i") + a).cast("long"), (F.col("_h.j") + b).cast("long"), (F.col("_h.k") + c).cast("long")))))))
    wide = spread(asked.withColumn("_h", home), "_pid").withColumn("_q", F.explode(around)).drop("_h")
    first = checkpoint(best(wide))
    # a chord as long as a cube is wide, as kilometres on the sphere
    reach = 2 * 6371.0 * asin(min(_side(level) / 2.0, 1.0))
    sure = first.where(F.col("_best.km") <= reach * (1 - 1e-9))
    open_ = checkpoint(asked.join(sure.select("_pid"), "_pid", "left_anti"))
    found = sure
    if open_.limit(1).count():
        found = found.unionByName(best(_descended(open_, s, level)))
    chosen = found.select("_pid", F.col("_best.km").alias("_km"), *[F.col(f"_best.site.{k}").alias(f"_take_{n}") for n, k in enumerate(take)])
    joined = p.join(chosen, "_pid", "left")
    extra = [F.col(f"_take_{n}").alias(k) for n, k in enumerate(take)] + ([F.col("_km").alias(out_km)] if out_km else [])
    return joined.select(*[k for k in kept if k not in (*take, out_km)], *extra)


def _descended(points: DataFrame, sites: DataFrame, level: int) -> DataFrame:
    """Rows (point, leaf) of the leaves that may hold a point's nearest site."""
    at = level % STEP or STEP
    tops = [r["_q"] for r in sites.select(_cube(at).alias("_q")).distinct().collect()]  # at most 64 cubes
    cubes = F.array(*[_packed(*[F.lit(q[k]).cast("long") for k in "ijk"]) for q in tops])
    rows = points.withColumn("_q", F.explode(cubes)) if tops else points.withColumn("_q", _cube(at)).limit(0)
    while True:
        side = _side(at)

        def gaps(k: str, i: str) -> tuple[Column, Column]:
            lo = F.col(f"_q.{i}") * side - 1.0
            return F.greatest(F.lit(0.0), lo - F.col(k), F.col(k) - lo - side), F.greatest(F.abs(F.col(k) - lo), F.abs(F.col(k) - lo - side))

        each = [gaps(k, i) for k, i in (("_x", "i"), ("_y", "j"), ("_z", "k"))]
        low, high = (sum((g[n] * g[n] for g in each), F.lit(0.0)) for n in (0, 1))
        rows = rows.withColumn("_low", low).withColumn("_high", high)
        bound = rows.groupBy("_pid").agg((F.min("_high") + SLACK).alias("_bound"))
        rows = checkpoint(rows.join(bound, "_pid").where("_low <= _bound").drop("_low", "_high", "_bound"))
        if at == level:
            return rows
        below = sites.select(_cube(at).alias("_q"), _cube(at + STEP).alias("_child")).distinct()
        rows = rows.join(below, "_q").drop("_q").withColumnRenamed("_child", "_q")
        at += STEP
