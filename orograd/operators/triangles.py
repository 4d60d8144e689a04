"""Linear interpolation between scattered sites: a Delaunay index whose triangles meet pixels through scan lines."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import MAX_BROADCAST_ROWS, checkpoint
from ..types import Grid
from .geometry import pixels_in_polygons
from .placing import with_placement

cloudpickle.register_pickle_by_value(sys.modules[__name__])

OUTSIDE = -1     # third corner of the triangle beyond an edge of the hull


def _turn(a: np.ndarray, b: np.ndarray, p: np.ndarray) -> np.ndarray:
    return (b[..., 0] - a[..., 0]) * (p[..., 1] - a[..., 1]) - (b[..., 1] - a[..., 1]) * (p[..., 0] - a[..., 0])


def delaunay(xy: np.ndarray) -> np.ndarray:
    """Corners of the Delaunay triangles of distinct points, counter-clockwise; none where all lie on a line.

    Points are put in one by one: the triangles whose circle holds the new point make a hole, whose
    rim is joined with it. Beyond each edge of the hull stands a triangle with one corner OUTSIDE, whose circle is the half
    plane there, so the hull is exact and no far helping points are needed.
    """
    n = len(xy)
    if n < 3:
        return np.zeros((0, 3), dtype=np.int64)
    xy = xy - xy.mean(axis=0)
    size = np.abs(xy).max() or 1.0
    far = np.abs(_turn(xy[0], xy[1], xy))
    third = int(far.argmax())
    if far[third] <= 1e-14 * size * size:
        return np.zeros((0, 3), dtype=np.int64)
    a, b, c = (0, 1, third) if _turn(xy[0], xy[1], xy[third]) > 0 else (1, 0, third)
    tri = np.array([(a, b, c), (b, a, OUTSIDE), (c, b, OUTSIDE), (a, c, OUTSIDE)], dtype=np.int64)
    for k in range(n):
        if k in (0, 1, third):
            continue
        p = xy[k]
        ghost = tri[:, 2] == OUTSIDE
        u, v, w = xy[tri[:, 0]] - p, xy[tri[:, 1]] - p, xy[tri[:, 2]] - p
        beyond = u[:, 0] * v[:, 1] - u[:, 1] * v[:, 0]        # twice the area of (u, v, p)
        between = (u * v).sum(axis=1) < 0
        uu, vv, ww = (u * u).sum(axis=1), (v * v).sum(axis=1), (w * w).sum(axis=1)
        circle = uu * (v[:, 0] * w[:, 1] - v[:, 1] * w[:, 0]) - vv * (u[:, 0] * w[:, 1] - u[:, 1] * w[:, 0]) + ww * beyond
        flat = 1e-13 * np.sqrt(uu * vv)
        bad = np.where(ghost, (beyond > flat) | ((np.abs(beyond) <= flat) & between), circle > 1e-13 * (uu + vv + ww) ** 2)
        hole = tri[bad]
        rim = np.concatenate([hole[:, [0, 1]], hole[:, [1, 2]], hole[:, [2, 0]]])
        back = {(j, i) for i, j in rim.tolist()}
        new = []
        for i, j in rim.tolist():
            if (i, j) not in back:
                new.append((k, i, OUTSIDE) if j == OUTSIDE else (j, k, OUTSIDE) if i == OUTSIDE else (i, j, k))
        tri = np.concatenate([tri[~bad], np.array(new, dtype=np.int64)])
    return tri[tri[:, 2] != OUTSIDE]


def _triangulated(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("site").drop_duplicates(["sx", "sy"]).reset_index(drop=True)
    # near points one after the other keep holes small
    order = np.lexsort((pdf["sy"], np.floor((pdf["sx"] - pdf["sx"].min()) / max(pdf["sx"].max() - pdf["sx"].min(), 1e-300) * max(1, len(pdf)) ** 0.5)))
    pdf = pdf.iloc[order].reset_index(drop=True)
    t = delaunay(pdf[["sx", "sy"]].to_numpy())
    out = {"grid": pdf["grid"].iloc[0] if len(pdf) else None, "tri": np.arange(len(t), dtype=np.int64)}
    for n, corner in enumerate("abc"):
        own = pdf.iloc[t[:, n]]
        out |= {f"{corner}x": own["sx"].to_numpy(), f"{corner}y": own["sy"].to_numpy(), f"{corner}v": own["v"].to_list()}
    return pd.DataFrame(out)


def triangles(sites: DataFrame) -> DataFrame:
    """Delaunay triangles of each grid's sites `(grid, site, sx, sy, v array<double>)`, with corners and values.

    Of sites at one place the first by name counts. A grid's sites are one group: stations are few beside pixels.
    """
    corners = ", ".join(f"{k}x double, {k}y double, {k}v array<double>" for k in "abc")
    return sites.groupBy("grid").applyInPandas(_triangulated, f"grid string, tri long, {corners}")


def interpolate(px: DataFrame, grid: Grid | DataFrame, sites: DataFrame, values: list[str], outs: list[str]) -> DataFrame:
    """Add `outs`: the linear surface through each of the sites' `values`; missing outside the hull of the sites.

    `sites(station_id, sx, sy, ...)` lie in the grid's reference system; with a placement table they have `grid_id` too. Any
    number of sites: pixels join the triangle around their corner through scan-line spans, so a pixel meets one.
    The hull's left and lower edges are inside, its right and upper ones outside. Sites that lack a value are left out.
    """
    several = not isinstance(grid, Grid)
    name = F.col("grid_id") if several else F.lit("")
    known = F.lit(True)
    for k in values:
        known = known & F.col(k).isNotNull()
    s = sites.where(known).select(name.alias("grid"), F.col("station_id").cast("string").alias("site"), F.col("sx").cast("double"), F.col("sy").cast("double"),
                                  F.array(*[F.col(k).cast("double") for k in values]).alias("v"))
    tri = checkpoint(triangles(s))
    # a pixel stands at its corner here, and spans ask its centre: the triangles move by half a pixel
    shapes, p = with_placement(tri.withColumnRenamed("grid", "grid_id"), grid)
    ring = F.array(*[F.struct((F.col(f"{k}x") + p.a * 0.5).alias("x"), (F.col(f"{k}y") + p.e * 0.5).alias("y")) for k in "abc"])
    shapes = shapes.select(F.struct("grid_id", "tri").alias("id"), F.array(ring).alias("rings"))
    on = [*(["grid_id"] if several else []), "row", "col"]
    keys = px.select(*on).withColumn("row", F.col("row").cast("long")).withColumn("col", F.col("col").cast("long")).distinct()
    hit = pixels_in_polygons(keys, grid, shapes).select(*on, F.col("id.grid_id").alias("grid"), F.col("id.tri").alias("tri"))
    if several:
        hit = hit.where("grid = grid_id")
    few = tri.count() <= MAX_BROADCAST_ROWS
    hit = hit.join(F.broadcast(tri) if few else tri, ["grid", "tri"])
    hit, p = with_placement(hit, grid)
    x, y = F.col("col") * p.a + p.c, F.col("row") * p.e + p.f
    det = F.expr("(by - cy) * (ax - cx) + (cx - bx) * (ay - cy)")
    wa = ((F.col("by") - F.col("cy")) * (x - F.col("cx")) + (F.col("cx") - F.col("bx")) * (y - F.col("cy"))) / det
    wb = ((F.col("cy") - F.col("ay")) * (x - F.col("cx")) + (F.col("ax") - F.col("cx")) * (y - F.col("cy"))) / det
    hit = hit.withColumn("_wa", wa).withColumn("_wb", wb)

    def value(n: int) -> Column:
        return F.col("_wa") * F.col("av")[n] + F.col("_wb") * F.col("bv")[n] + (1.0 - F.col("_wa") - F.col("_wb")) * F.col("cv")[n]

    made = hit.select(*on, *[value(n).alias(o) for n, o in enumerate(outs)])
    return px.withColumn("row", F.col("row").cast("long")).withColumn("col", F.col("col").cast("long")).join(made, on, "left")
