"""Union of polygons by planar edges: edges are cut where they meet, inner ones cancel, the rest are stitched to rings.

Crowded regions go through batches of neighbours first, so that edges deep inside a region never meet all the others.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cols import bind
from ..session import bounded_join, checkpoint, spread
from .geometry import _cross, _ring_fold, edges, signed_rings, with_bounds

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIGITS = 6     # decimals to which cut points are rounded, so that coinciding pieces are equal
BATCH = 8      # about so many parts are united at a time
LAST = 32      # a region of at most so many parts is united at once
ROUNDS = 8     # a rounded cut bends its edge, which may then meet another; cutting ends when nothing meets


def inner_left(polygons: DataFrame, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """Polygons whose shells run counter-clockwise and whose holes clockwise: the inside is left of every edge."""
    r = signed_rings(polygons, keep=keep)
    turn = F.signum(_ring_fold(F.col("pts"), _cross)) * F.col("sign")
    r = r.withColumn("pts", F.when(turn < 0, F.reverse("pts")).otherwise(F.col("pts")))
    return r.groupBy("id", *keep).agg(F.collect_list("pts").alias("rings"))


def _squares(bucket: float) -> Column:
    """Array of the squares that an edge's box covers."""
    def along(a: str, b: str) -> Column:
        return F.sequence(F.floor(F.least(a, b) / bucket), F.floor(F.greatest(a, b) / bucket))
    return F.flatten(F.transform(along("x1", "x2"), lambda x: F.transform(along("y1", "y2"), lambda y: F.struct(x.alias("sx"), y.alias("sy")))))


def cut_edges(e: DataFrame, *, keys: tuple[str, ...], bucket: float) -> DataFrame:
    """Edges `(*keys, id, x1, y1, x2, y2)` cut until edges of the same keys meet in common ends alone.

    Edges meet on coarse squares. Cut points are rounded, so pieces that coincide have equal ends.
    """
    e = e.withColumns({k: F.round(k, DIGITS) + 0.0 for k in ("x1", "y1", "x2", "y2")}).where("x1 <> x2 or y1 <> y2")
    for n in range(ROUNDS):
        e = checkpoint(e.withColumn("edge", F.monotonically_increasing_id()))
        cuts = checkpoint(_cuts(e, keys, bucket / min(n + 1, 2)))
        if cuts.isEmpty():
            break
        e = _pieces(e, cuts, keys)
    return e.drop("edge")


def _cuts(e: DataFrame, keys: tuple[str, ...], bucket: float) -> DataFrame:
    """`(edge, cuts)`: where other edges of the same keys cross, touch or overlap an edge, along it."""
    at = spread(e.select(*keys, "edge", "x1", "y1", "x2", "y2", F.explode(_squares(bucket)).alias("q")), *keys, "q")
    o = at.select(*keys, "q", F.col("edge").alias("other"), *[F.col(k).alias(f"o{k}") for k in ("x1", "y1", "x2", "y2")])
    met = at.join(o, [*keys, "q"]).where("edge <> other and greatest(x1, x2) >= least(ox1, ox2) and greatest(ox1, ox2) >= least(x1, x2) "
                                       "and greatest(y1, y2) >= least(oy1, oy2) and greatest(oy1, oy2) >= least(y1, y2)")
    met = met.drop("q").dropDuplicates(["edge", "other"])
    met = met.withColumns({"dx": F.expr("x2 - x1"), "dy": F.expr("y2 - y1"), "ox": F.expr("ox2 - ox1"), "oy": F.expr("oy2 - oy1")})
    det = F.expr("dx * oy - dy * ox")
    long2 = F.expr("dx * dx + dy * dy")
    flat = F.abs(det) <= 1e-12 * F.sqrt(long2 * F.expr("ox * ox + oy * oy"))
    t = F.expr("(ox1 - x1) * oy - (oy1 - y1) * ox") / F.nullif(det, F.lit(0.0))
    u = F.expr("(ox1 - x1) * dy - (oy1 - y1) * dx") / F.nullif(det, F.lit(0.0))
    near = 10.0 ** -DIGITS

    def touches(px: str, py: str) -> Column:
        """Place on the edge of a point within rounding of it."""
        s = ((F.col(px) - F.col("x1")) * F.col("dx") + (F.col(py) - F.col("y1")) * F.col("dy")) / long2
        off = F.abs((F.col(px) - F.col("x1")) * F.col("dy") - (F.col(py) - F.col("y1")) * F.col("dx")) / F.sqrt(long2)
        return F.when((off <= near) & (s > 0) & (s < 1), F.struct(s.alias("t"), F.col(px).alias("x"), F.col(py).alias("y")))

    crossing = F.when(~flat & (t > 0) & (t < 1) & (u > 0) & (u < 1), F.struct(
        t.alias("t"), (F.round(F.expr("x1") + t * F.col("dx"), DIGITS) + 0.0).alias("x"), (F.round(F.expr("y1") + t * F.col("dy"), DIGITS) + 0.0).alias("y")))
    ends = F.coalesce(touches("ox1", "oy1"), F.lit(None)), F.coalesce(touches("ox2", "oy2"), F.lit(None))
    # a touching end counts and not the crossing beside it, so both edges are cut at one point
    cuts = F.when(ends[0].isNull() & ends[1].isNull(), F.array(crossing)).otherwise(F.array(*ends))
    inner = "c is not null and (c.x <> x1 or c.y <> y1) and (c.x <> x2 or c.y <> y2)"
    return met.select("edge", "x1", "y1", "x2", "y2", F.explode(cuts).alias("c")).where(inner).groupBy("edge").agg(F.sort_array(F.collect_set("c")).alias("cuts"))


def _pieces(e: DataFrame, cuts: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    both = e.join(cuts, "edge", "left")
    path = F.concat(F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y"))),
                    F.coalesce(F.transform("cuts", lambda c: F.struct(c["x"].alias("x"), c["y"].alias("y"))), F.array().cast("array<struct<x:double,y:double>>")),
                    F.array(F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))))
    pieces = bind(path, lambda p: F.transform(F.sequence(F.lit(1), F.size(p) - 1), lambda i: F.struct(
        F.element_at(p, i)["x"].alias("x1"), F.element_at(p, i)["y"].alias("y1"), F.element_at(p, i + 1)["x"].alias("x2"), F.element_at(p, i + 1)["y"].alias("y2"))))
    return both.select(*keys, "id", F.explode(pieces).alias("p")).select(*keys, "id", "p.*").where("x1 <> x2 or y1 <> y2")


def _stitched(pdf: pd.DataFrame) -> pd.DataFrame:
    """Rings of a group's boundary edges, by pointer doubling over the edges; the result is one row that holds them all."""
    start, end = pdf[["x1", "y1"]].to_numpy(), pdf[["x2", "y2"]].to_numpy()
    n = len(pdf)
    points, at = np.unique(np.concatenate([start, end]), axis=0, return_inverse=True)
    at = at.reshape(-1)
    tail, head = at[:n], at[n:]
    out = np.arctan2(*(end - start).T[::-1])
    # at a point where rings touch, an edge goes on with the sharpest left turn, so that rings stay simple
    by_tail = np.lexsort((out, tail))
    first, last = np.searchsorted(tail[by_tail], np.arange(len(points))), np.searchsorted(tail[by_tail], np.arange(len(points)), side="right")
    follow = np.empty(n, dtype=np.int64)
    for k in range(n):
        ways = by_tail[first[head[k]]:last[head[k]]]
        if len(ways) == 1:
            follow[k] = ways[0]
        elif len(ways):
            turn = (out[ways] - out[k] + np.pi) % (2 * np.pi)
            follow[k] = ways[np.argmax(np.where(turn < 1e-12, -1.0, turn))]
        else:
            raise ValueError("the boundary is not closed")
    low, jump = np.minimum(np.arange(n), follow), follow.copy()
    for _ in range(max(1, int(np.ceil(np.log2(max(n, 2)))))):
        low, jump = np.minimum(low, low[jump]), jump[jump]
    # distance to the ring's first edge, the chain cut before it
    stop = follow == low
    far, jump = np.where(stop, 0, 1), np.where(stop, np.arange(n), follow)
    for _ in range(max(1, int(np.ceil(np.log2(max(n, 2))))) + 1):
        far, jump = far + far[jump], jump[jump]
    order = np.lexsort((-far, low))
    cuts = np.flatnonzero(np.diff(low[order])) + 1
    rings = [[{"x": float(x), "y": float(y)} for x, y in start[part]] for part in np.split(order, cuts)]
    return pd.DataFrame({k: [pdf[k].iloc[0]] for k in pdf.columns if k not in ("x1", "y1", "x2", "y2")} | {"rings": [rings]})


def _bucket(own: DataFrame) -> float | None:
    """Width of the squares on which edges meet: some lengths of a usual edge, at least the extent / 256; None without edges."""
    r = own.agg(F.avg(F.greatest(F.abs(F.expr("x2 - x1")), F.abs(F.expr("y2 - y1")))).alias("long"), F.min("x1").alias("a"), F.max("x1").alias("b"),
                F.min("y1").alias("c"), F.max("y1").alias("d")).first()
    return None if r["long"] is None else max(2 * r["long"], max(r["b"] - r["a"], r["d"] - r["c"]) / 256)


def _union(parts: DataFrame, keys: tuple[str, ...], bucket: float | None) -> DataFrame:
    """`(*keys, rings)`: the union of the parts `(*keys, id, rings)` of equal keys, inside left of every edge in both."""
    own = edges(parts, keys=(*keys, "id")).drop("ring_no")
    bucket = bucket or _bucket(own) or 1.0
    own = checkpoint(cut_edges(own, keys=keys, bucket=bucket))
    ahead = F.expr("x1 < x2 or (x1 = x2 and y1 < y2)")
    low = [F.when(ahead, F.col(a)).otherwise(F.col(b)) for a, b in (("x1", "x2"), ("y1", "y2"), ("x2", "x1"), ("y2", "y1"))]
    pieces = own.select(*keys, "id", F.when(ahead, 1).otherwise(-1).alias("way"), *[c.alias(n) for c, n in zip(low, ("x1", "y1", "x2", "y2"))])
    # the parts that lie left of a piece or right of it; where two rings of one part meet, it counts by crossings as the others do
    sides = pieces.groupBy(*keys, "x1", "y1", "x2", "y2", "id").agg(F.sum("way").alias("way"))
    whole = sides.where("way <> 0").groupBy(*keys, "x1", "y1", "x2", "y2").agg(
        F.max((F.col("way") > 0).cast("int")).alias("left"), F.max((F.col("way") < 0).cast("int")).alias("right"), F.collect_set("id").alias("ids"))
    # a piece with parts on both sides is inner whatever the others cover
    open_ = checkpoint(whole.where("left <> right").withColumn("piece", F.monotonically_increasing_id()))
    mid = open_.select(*keys, "piece", "ids", F.expr("(x1 + x2) / 2").alias("mx"), F.expr("(y1 + y2) / 2").alias("my"))
    wide = 16 * bucket
    box = own.groupBy(*keys, "id").agg(F.min(F.least("x1", "x2")).alias("minx"), F.min(F.least("y1", "y2")).alias("miny"),
                                       F.max(F.greatest("x1", "x2")).alias("maxx"), F.max(F.greatest("y1", "y2")).alias("maxy"))
    for k, lo, hi in (("sx", "minx", "maxx"), ("sy", "miny", "maxy")):
        box = box.withColumn(k, F.explode(F.sequence(F.floor(F.col(lo) / wide), F.floor(F.col(hi) / wide))))
    near = mid.withColumn("sx", F.floor(F.col("mx") / wide)).withColumn("sy", F.floor(F.col("my") / wide)).join(box, [*keys, "sx", "sy"])
    near = near.where("mx between minx and maxx and my between miny and maxy and not array_contains(ids, id)").select(*keys, "piece", "id", "mx", "my")
    rows = own.where("y1 <> y2").withColumn("by", F.explode(F.sequence(F.floor(F.least("y1", "y2") / bucket), F.floor(F.greatest("y1", "y2") / bucket))))
    right = near.withColumn("by", F.floor(F.col("my") / bucket)).join(rows, [*keys, "id", "by"]).where(
        "(y1 > my) <> (y2 > my) and mx < x1 + (my - y1) / (y2 - y1) * (x2 - x1)")
    covered = right.groupBy("piece", "id").agg((F.count(F.lit(1)) % 2).alias("odd")).where("odd = 1").select("piece").distinct()
    rim = open_.join(covered, "piece", "left_anti")
    ends = [F.when(F.col("left") == 1, F.col(a)).otherwise(F.col(b)).alias(a) for a, b in (("x1", "x2"), ("y1", "y2"), ("x2", "x1"), ("y2", "y1"))]
    kinds = ", ".join(f"{k} {parts.schema[k].dataType.simpleString()}" for k in keys)
    return rim.select(*keys, *ends).groupBy(*keys).applyInPandas(_stitched, f"{kinds}, rings array<array<struct<x: double, y: double>>>")


def _in_batches(parts: DataFrame, size: float) -> DataFrame:
    """The parts with the square of width `size` that holds the middle of their box, and a batch of about `BATCH` within it."""
    at = with_bounds(parts).select("key", "id", "rings", F.floor(F.expr("(minx + maxx) / 2") / size).alias("qx"), F.floor(F.expr("(miny + maxy) / 2") / size).alias("qy"))
    crowd = at.groupBy("key", "qx", "qy").agg(F.count(F.lit(1)).alias("_n"))
    batches = F.ceil(F.coalesce("_n", F.lit(1)) / BATCH)
    return bounded_join(at, crowd, ["key", "qx", "qy"], "left").withColumn("batch", F.pmod(F.xxhash64("id"), batches)).drop("_n")


def dissolve_rings(polygons: DataFrame, *, region: str = "region_code", bucket: float | None = None) -> DataFrame:
    """`(region, rings)`: the union of each region's polygons `(id, region, rings)` as rings under the even-odd rule.

    Parts may touch, overlap, nest or lie apart. A piece of an edge is boundary where one side of it lies in some part and the other in
    none: parts that have the piece count by its direction, the others by crossings to the right of its middle. Polygons without
    area vanish; a region of such polygons alone gives no row.

    Edges that overlap densely meet each other as often as the square of their number. A region of many parts is therefore united
    in batches of near parts, whose unions are the parts of the next round on wider squares, until few are left.
    """
    parts = checkpoint(inner_left(polygons.select(F.struct(region, "id").alias("id"), "rings", F.col(region).alias("key")), keep=("key",)))
    size = with_bounds(parts).agg(F.avg(F.greatest(F.expr("maxx - minx"), F.expr("maxy - miny")))).first()[0]
    near = ("key", "qx", "qy", "batch")
    while (parts.groupBy("key").count().agg(F.max("count")).first()[0] or 0) > LAST:
        parts = checkpoint(_union(checkpoint(_in_batches(parts, size)), near, bucket).select("key", F.struct("qx", "qy", "batch").alias("id"), "rings"))
        size *= 4
    return _union(parts, ("key",), bucket).withColumnRenamed("key", region)
