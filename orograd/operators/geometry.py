"""Polygons and road lines against the pixel grid.

Polygon tables are `(id, rings array<array<struct<x,y>>>)`. Membership follows the even-odd rule,
so holes and several parts need no special form. Rings may be open or closed. A polygon meets the
grid through scan lines: each grid row cuts the polygon into column spans, and pixels join the
spans on `(row, column block)`. No pixel is ever paired with a polygon it cannot lie in.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cols import bind
from ..functions.surface import road_buffer_m, road_temp_offset
from ..session import bounded_join, spread
from ..types import CELL_SIZE_M, Grid
from .placing import Placed, carried, fixed, on_grids, with_placement

SPAN_BLOCK = 256


def _ring_fold(pts: Column, term) -> Column:
    """Sum `term(p, next p)` over the edges of a ring."""
    def fold(ring: Column) -> Column:
        n = F.size(ring)
        return F.aggregate(F.sequence(F.lit(1), n), F.lit(0.0), lambda acc, i: acc + term(
            F.element_at(ring, i), F.element_at(ring, F.when(i == n, F.lit(1)).otherwise(i + 1))))
    return bind(pts, fold)


def _cross(p: Column, q: Column) -> Column:
    return p["x"] * q["y"] - q["x"] * p["y"]


def ring_area(pts: Column) -> Column:
    """Shoelace area, positive for either orientation; fewer than three points give 0."""
    return bind(pts, lambda r: F.when(F.size(r) < 3, 0.0).otherwise(F.abs(_ring_fold(r, _cross)) / 2.0))


def edges(polygons: DataFrame, *, keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """One row per edge: keys, ring_no, x1, y1, x2, y2.

    Edges are paired up inside the array, so no row carries a whole ring along.
    """
    rings = polygons.select(*keys, F.posexplode("rings").alias("ring_no", "pts"))

    def edge(p: Column, i: Column) -> Column:
        q = F.get("pts", (i + 1) % F.size("pts"))
        return F.struct(p["x"].alias("x1"), p["y"].alias("y1"), q["x"].alias("x2"), q["y"].alias("y2"))

    return (rings.select(*keys, "ring_no", F.explode(F.transform("pts", edge)).alias("e"))
            .select(*keys, "ring_no", "e.*").where("x1 <> x2 or y1 <> y2"))


def ring_contains(pts: Column, p: Column) -> Column:
    """Whether a point lies inside a ring, by counting edges to its right."""
    crossings = _ring_fold(pts, lambda a, b: F.when(
        ((a["y"] > p["y"]) != (b["y"] > p["y"]))
        & (p["x"] < a["x"] + (p["y"] - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) * (b["x"] - a["x"])),
        1.0).otherwise(0.0))
    return F.pmod(crossings, F.lit(2.0)) == 1.0


def shells_with_holes(rings: str) -> Column:
    """Array of polygons of a row's rings: each a closed shell followed by its closed holes.

    Rings at even nesting depth are shells; a hole belongs to the shell around it one level up.
    """
    def within(inner: Column, outer: Column) -> Column:
        """Two of three spread vertices decide, so a ring that touches another in one point is still placed right."""
        n = F.size(inner)
        votes = [F.when(ring_contains(outer, F.get(inner, F.floor(n * k / 3).cast("int"))), 1).otherwise(0) for k in range(3)]
        return votes[0] + votes[1] + votes[2] >= 2

    def closed(r: Column) -> Column:
        ends = (r[0]["x"] == F.get(r, F.size(r) - 1)["x"]) & (r[0]["y"] == F.get(r, F.size(r) - 1)["y"])
        return F.when(ends, r).otherwise(F.concat(r, F.array(r[0])))

    col = F.filter(rings, lambda r: F.size(r) > 0)
    placed = F.transform(col, lambda r, i: F.struct(r.alias("pts"), F.size(F.filter(col, lambda o, j: (i != j) & within(r, o))).alias("depth")))

    def polygons_of(all_: Column) -> Column:
        shells = F.filter(all_, lambda s: s["depth"] % 2 == 0)
        return F.transform(shells, lambda s: F.concat(F.array(closed(s["pts"])), F.transform(
            F.filter(all_, lambda h: (h["depth"] == s["depth"] + 1) & within(h["pts"], s["pts"])), lambda h: closed(h["pts"]))))

    return bind(placed, polygons_of)


def signed_rings(polygons: DataFrame, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per ring with `sign`: +1 for shells, -1 for holes, by nesting depth."""
    rings = polygons.select("id", *keep, "rings", F.posexplode("rings").alias("ring_no", "pts"))
    n = F.size("pts")
    # two of three spread vertices decide, so a ring that touches another in one point is still placed right
    probes = F.array(F.get("pts", F.lit(0)), F.get("pts", F.floor(n / 3).cast("int")), F.get("pts", F.floor(2 * n / 3).cast("int")))

    def around(r: Column) -> Column:
        return F.size(F.filter(probes, lambda p: ring_contains(r, p))) >= 2

    depth = F.size(F.filter("rings", lambda r, i: (i != F.col("ring_no")) & around(r)))
    return rings.select("id", *keep, "ring_no", "pts", F.when(F.size("rings") == 1, F.lit(1.0)).otherwise(
        F.when(depth % 2 == 0, 1.0).otherwise(-1.0)).alias("sign"))


def spans(polygons: DataFrame, grid: Grid | DataFrame) -> DataFrame:
    """`(id, row, x_from, x_to)`: the pieces of each grid row inside each polygon.

    A pixel centre lies inside when `x_from <= x < x_to`. With a placement table the pieces have `grid_id` and
    the placement's columns too.
    """
    e = edges(polygons).where("y1 <> y2")
    # an edge reaches over the rows between its ends, whatever its columns: the crossings beside a grid count as well
    far = F.lit(float("inf"))
    e, p = on_grids(e, grid, (-far, F.least("y1", "y2"), far, F.greatest("y1", "y2")))
    first, last = p.rows_between(F.least("y1", "y2"), F.greatest("y1", "y2"))
    cut = (e.withColumn("_first", first).withColumn("_last", last).where("_first <= _last")
           .withColumn("row", F.explode(F.sequence("_first", "_last")))
           .withColumn("_y", p.y(F.col("row")))
           .where((F.col("y1") > F.col("_y")) != (F.col("y2") > F.col("_y")))
           .withColumn("xc", F.col("x1") + (F.col("_y") - F.col("y1")) / (F.col("y2") - F.col("y1"))
                       * (F.col("x2") - F.col("x1"))))
    w = Window.partitionBy(*p.keys, "id", "row").orderBy("xc")
    return (cut.withColumn("_n", F.row_number().over(w)).withColumn("x_to", F.lead("xc").over(w))
            .where("_n % 2 = 1 and x_to > xc").select(*p.keys, *p.carried, "id", "row", F.col("xc").alias("x_from"), "x_to"))


def merged_spans(sp: DataFrame) -> DataFrame:
    """Union of the spans of all polygons: disjoint pieces per grid row."""
    keys = [k for k in sp.columns if k not in ("id", "row", "x_from", "x_to")]
    by = ["grid_id", "row"] if "grid_id" in keys else ["row"]
    w = Window.partitionBy(*by).orderBy("x_from", "x_to")
    reach = F.max("x_to").over(w.rowsBetween(Window.unboundedPreceding, -1))
    started = sp.withColumn("_new", F.when(F.col("x_from") <= reach, 0).otherwise(1))
    island = started.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    rest = [F.first(k).alias(k) for k in keys if k != "grid_id"]
    return island.groupBy(*by, "_island").agg(F.min("x_from").alias("x_from"), F.max("x_to").alias("x_to"), *rest).drop("_island")


def _span_blocks(sp: DataFrame, p: Placed, block: int) -> DataFrame:
    lo, hi = p.cols_between(F.col("x_from"), F.col("x_to"))
    return (sp.withColumn("_lo", lo).withColumn("_hi", hi).where("_lo <= _hi")
            .withColumn("_block", F.explode(F.sequence(F.floor(F.col("_lo") / F.lit(block)),
                                                       F.floor(F.col("_hi") / F.lit(block))))))


def _placed(grid: Grid | DataFrame) -> Placed:
    return fixed(grid) if isinstance(grid, Grid) else carried()


def pixels_in_polygons(px: DataFrame, grid: Grid | DataFrame, polygons: DataFrame, *, block: int = SPAN_BLOCK) -> DataFrame:
    """Pixels with the `id` of each polygon whose interior holds their centre.

    `grid` is one grid's placement or a placement table for pixels of several, told apart by `grid_id`.
    """
    p = _placed(grid)
    sp = _span_blocks(spans(polygons, grid), p, block).select(*p.keys, *p.carried, "id", "row", "_block", "x_from", "x_to")
    at = (px.withColumn("row", F.col("row").cast("long")).withColumn("_block", F.floor(F.col("col") / F.lit(block))))
    return (at.join(sp, [*p.keys, "row", "_block"]).withColumn("_x", p.x(F.col("col"))).where("_x >= x_from and _x < x_to")
            .select(*px.columns, "id"))


def clip(px: DataFrame, grid: Grid | DataFrame, polygons: DataFrame, *, value: str = "value",
         block: int = SPAN_BLOCK) -> DataFrame:
    """Crop to the bounding box of the polygons; pixels of the box outside every polygon -> missing.

    With a placement table every grid is cropped to the box on its own rows and columns; grids that no polygon
    reaches give no rows.
    """
    box = bounds(polygons).agg(*[f(k).alias(k) for f, k in (
        (F.min, "minx"), (F.min, "miny"), (F.max, "maxx"), (F.max, "maxy"))]).first()
    if box is None or box["minx"] is None:
        raise ValueError("no polygon to clip to")
    at = px.withColumn("row", F.col("row").cast("long"))
    if isinstance(grid, Grid):
        cols, rows = [(box[k] - grid.c) / grid.a for k in ("minx", "maxx")], [(box[k] - grid.f) / grid.e for k in ("miny", "maxy")]
        lim = [F.lit(math.floor(min(rows))), F.lit(math.ceil(max(rows))), F.lit(math.floor(min(cols))), F.lit(math.ceil(max(cols)))]
        p = fixed(grid)   # literal range bounds reach the scan and skip row groups
    else:
        at, p = with_placement(at, grid)
        cols, rows = [(F.lit(box[k]) - p.c) / p.a for k in ("minx", "maxx")], [(F.lit(box[k]) - p.f) / p.e for k in ("miny", "maxy")]
        lim = [F.floor(F.least(*rows)), F.ceil(F.greatest(*rows)), F.floor(F.least(*cols)), F.ceil(F.greatest(*cols))]
    crop = at.where((F.col("row") >= lim[0]) & (F.col("row") < lim[1]) & (F.col("col") >= lim[2]) & (F.col("col") < lim[3]))
    crop = crop.withColumn("_x", p.x(F.col("col"))).withColumn("_block", F.floor(F.col("col") / F.lit(block))).drop(*p.carried)
    sp = _span_blocks(merged_spans(spans(polygons, grid)), p, block).select(
        *[F.col(k).alias(f"_of_{k}") for k in p.keys], F.col("row").alias("_row"), F.col("_block").alias("_at"), "x_from", "x_to")
    same = (F.col("row") == F.col("_row")) & (F.col("_block") == F.col("_at"))
    for k in p.keys:
        same = same & (F.col(k) == F.col(f"_of_{k}"))
    # merged spans are disjoint: a pixel meets one at most, so one join neither copies nor drops it
    hit = crop.join(sp, same & (F.col("_x") >= F.col("x_from")) & (F.col("_x") < F.col("x_to")), "left")
    return hit.withColumn(value, F.when(F.col("x_from").isNotNull(), F.col(value))).select(*px.columns)


def with_bounds(polygons: DataFrame) -> DataFrame:
    """Add minx, miny, maxx, maxy of each row's own rings; nothing is shuffled."""
    def ends(axis: str) -> Column:
        return F.transform(F.flatten("rings"), lambda p: p[axis])
    return polygons.withColumns({"minx": F.array_min(ends("x")), "miny": F.array_min(ends("y")),
                                 "maxx": F.array_max(ends("x")), "maxy": F.array_max(ends("y"))})


def bounds(polygons: DataFrame, *, keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """Bounding box per key."""
    return with_bounds(polygons).groupBy(*keys).agg(F.min("minx").alias("minx"), F.min("miny").alias("miny"),
                                                    F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"))


def polygon_area(polygons: DataFrame) -> DataFrame:
    return signed_rings(polygons).groupBy("id").agg(F.sum(F.col("sign") * ring_area(F.col("pts"))).alias("area"))


def polygon_centroid(polygons: DataFrame) -> DataFrame:
    """Area-weighted centroid per polygon; holes count negative."""
    r = signed_rings(polygons)
    pts = F.col("pts")
    twice = _ring_fold(pts, _cross)
    mx = _ring_fold(pts, lambda p, q: (p["x"] + q["x"]) * _cross(p, q))
    my = _ring_fold(pts, lambda p, q: (p["y"] + q["y"]) * _cross(p, q))
    orient = F.signum(twice) * F.col("sign")
    m = r.select("id", (twice * orient).alias("a"), (mx * orient).alias("mx"), (my * orient).alias("my"))
    return m.groupBy("id").agg((F.sum("mx") / (3 * F.sum("a"))).alias("centroid_x"),
                               (F.sum("my") / (3 * F.sum("a"))).alias("centroid_y"))


def dissolve(polygons: DataFrame, *, region: str = "region_code") -> DataFrame:
    """Region extent and part count. Parts stay rows: a point is in a region if in any part."""
    return bounds(polygons, keys=(region,)).join(
        polygons.groupBy(region).agg(F.count(F.lit(1)).alias("num_parts")), region)


def as_region(polygons: DataFrame, *, region: str = "region_code") -> DataFrame:
    """The parts of every region, keyed by region, for use with `pixels_in_polygons`."""
    return polygons.select(F.col(region).alias("id"), "rings")


def _half_plane(pts: Column, axis: str, limit: Column, keep_above: bool) -> Column:
    """Cut a ring at a vertical or horizontal line (one Sutherland-Hodgman pass)."""
    other = "y" if axis == "x" else "x"
    empty = F.array().cast("array<struct<x:double,y:double>>")

    def inside(p: Column) -> Column:
        return p[axis] >= limit if keep_above else p[axis] <= limit

    def cut(p: Column, q: Column) -> Column:
        t = (limit - p[axis]) / F.nullif(q[axis] - p[axis], F.lit(0.0))
        along = p[other] + t * (q[other] - p[other])
        xy = (limit, along) if axis == "x" else (along, limit)
        return F.struct(xy[0].cast("double").alias("x"), xy[1].cast("double").alias("y"))

    def pass_(ring: Column) -> Column:
        n = F.size(ring)

        def step(i: Column) -> Column:
            p, q = F.element_at(ring, i), F.element_at(ring, F.when(i == n, F.lit(1)).otherwise(i + 1))
            end = F.struct(q["x"].alias("x"), q["y"].alias("y"))
            return (F.when(inside(p) & inside(q), F.array(end)).when(inside(p), F.array(cut(p, q)))
                    .when(inside(q), F.array(cut(p, q), end)).otherwise(empty))

        return F.when(n < 1, empty).otherwise(F.flatten(F.transform(F.sequence(F.lit(1), n), step)))

    return bind(F.coalesce(pts, empty), pass_)


def _strips(polygons: DataFrame, size: float) -> DataFrame:
    """`(id, minx, maxy, sign, ix, pts)`: every ring cut to column strips of `size` from its polygon's left.

    Edges are rows that go to the strips they touch. What an edge leaves in a strip follows from the edge alone, so no strip
    gets the whole ring and a polygon of very many edges spreads over all tasks; a strip's pieces in ring order are its ring.
    """
    rings = signed_rings(with_bounds(polygons), keep=("minx", "maxx", "maxy"))
    n = F.size("pts")
    edge = F.transform("pts", lambda p, i: F.struct(i.alias("at"), p["x"].alias("px"), p["y"].alias("py"), F.get("pts", (i + 1) % n)["x"].alias("qx"), F.get("pts", (i + 1) % n)["y"].alias("qy")))
    e = rings.where(n > 0).select("id", "minx", "maxx", "maxy", "ring_no", "sign", F.explode(edge).alias("e")).select("id", "minx", "maxx", "maxy", "ring_no", "sign", "e.*")
    most = F.greatest(F.ceil((F.col("maxx") - F.col("minx")) / size) - 1, F.lit(0))
    # an edge on the line between two strips counts for both, as cutting a ring at either side does
    lo = F.ceil((F.least("px", "qx") - F.col("minx")) / size) - 1
    hi = F.floor((F.greatest("px", "qx") - F.col("minx")) / size)
    e = e.withColumn("_lo", F.greatest(lo, F.lit(0))).withColumn("_hi", F.least(hi, most)).where("_lo <= _hi")
    e = e.withColumn("ix", F.explode(F.sequence(F.col("_lo").cast("int"), F.col("_hi").cast("int")))).withColumn("_l", F.col("minx") + F.col("ix") * size).withColumn("_r", F.col("_l") + size)
    p_in, q_in = F.expr("px >= _l and px <= _r"), F.expr("qx >= _l and qx <= _r")

    def cut(limit: str) -> Column:
        t = (F.col(limit) - F.col("px")) / F.nullif(F.col("qx") - F.col("px"), F.lit(0.0))
        return F.struct(F.col(limit).cast("double").alias("x"), (F.col("py") + t * (F.col("qy") - F.col("py"))).cast("double").alias("y"))

    end, left, right = F.struct(F.col("qx").alias("x"), F.col("qy").alias("y")), cut("_l"), cut("_r")
    kept = (F.when(p_in & q_in, F.array(end)).when(p_in, F.array(F.when(F.expr("qx < _l"), left).otherwise(right)))
            .when(q_in, F.array(F.when(F.expr("px < _l"), left).otherwise(right), end))
            .when(F.expr("px < _l and qx > _r"), F.array(left, right)).when(F.expr("px > _r and qx < _l"), F.array(right, left)))
    pieces = e.select("id", "minx", "maxy", "ring_no", "sign", "ix", "at", kept.alias("kept")).where("kept is not null")
    # what a ring goes around outside a strip leaves no piece there; its ends join along the strip's side
    whole = pieces.groupBy("id", "ring_no", "ix").agg(F.first("minx").alias("minx"), F.first("maxy").alias("maxy"), F.first("sign").alias("sign"),
                                                      F.sort_array(F.collect_list(F.struct("at", "kept"))).alias("k"))
    return whole.withColumn("pts", F.flatten(F.transform("k", lambda x: x["kept"]))).drop("k").where("size(pts) >= 3")


def create_cells(polygons: DataFrame, *, cell_size_m: float = CELL_SIZE_M) -> DataFrame:
    """Square cells clipped to each polygon: id, ix, iy, cell_id, cell_area_sqm, cell_rings.

    Cells start at the top-left corner of the polygon's own bounding box and are numbered row by
    row. A polygon is cut into column strips first, edge by edge, and each strip into cells, so a cell only
    handles the few edges of its strip, and the strips of one huge polygon spread over all tasks.
    """
    size = float(cell_size_m)
    if polygons.where("rings is null or size(rings) = 0 or exists(rings, r -> size(r) = 0)").limit(1).count():
        raise ValueError("empty polygon geometry")
    strip = _strips(spread(polygons, "id"), size)
    # only now: the strips are no larger than the ring they came from
    strip = spread(strip, "id", "ix")
    ys = F.transform("pts", lambda p: p["y"])
    lowest = F.floor((F.col("maxy") - F.array_max(ys)) / size).cast("int")
    highest = F.ceil((F.col("maxy") - F.array_min(ys)) / size).cast("int")
    cell = strip.withColumn("iy", F.explode(F.sequence(lowest, F.greatest(highest - 1, lowest))))
    top = F.col("maxy") - F.col("iy") * size
    cell = (cell.withColumn("pts", _half_plane(F.col("pts"), "y", top, False))
            .withColumn("pts", _half_plane(F.col("pts"), "y", top - size, True))
            .withColumn("_area", ring_area(F.col("pts"))))
    cells = (cell.where("_area > 0").groupBy("id", "iy", "ix")
             .agg(F.sum(F.col("sign") * F.col("_area")).alias("cell_area_sqm"),
                  F.collect_list("pts").alias("cell_rings")).where("cell_area_sqm > 1e-9"))
    return number_rows(cells, ["id"], "iy", "ix").withColumn(
        "cell_id", F.format_string("cell_%03d", "cell_no")).drop("cell_no")


def number_rows(df: DataFrame, keys: list[str], outer: str, inner: str, out: str = "cell_no") -> DataFrame:
    """Consecutive numbers per key in (outer, inner) order.

    Row counts per `outer` give each one its start, so no task sorts a whole key.
    """
    counts = df.groupBy(*keys, outer).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(outer).rowsBetween(Window.unboundedPreceding, -1)
    start = counts.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    within = Window.partitionBy(*keys, outer).orderBy(inner)
    return (df.withColumn("_k", F.row_number().over(within)).join(start, [*keys, outer])
            .withColumn(out, F.col("_start") + F.col("_k")).drop("_k", "_start"))


def cell_dominant(cells: DataFrame, px: DataFrame, grid: Grid, *, value: str = "value") -> DataFrame:
    """`cell_type`: raster value at each cell's centroid, as text; missing outside the raster."""
    shapes = cells.select(F.struct("id", "cell_id").alias("id"), F.col("cell_rings").alias("rings"))
    at = polygon_centroid(shapes).select(
        F.col("id.id").alias("id"), F.col("id.cell_id").alias("cell_id"),
        F.floor((F.col("centroid_x") - grid.c) / grid.a).alias("col"),
        F.floor((F.col("centroid_y") - grid.f) / grid.e).alias("row"))
    hit = px.select(F.col("row").cast("long"), F.col("col").cast("long"),
                    F.col(value).cast("int").cast("string").alias("cell_type"), *[k for k in ("grid_id",) if k in px.columns])
    # the few centroids are looked up in the many pixels, not the other way round
    found = bounded_join(hit, at, ["row", "col"])
    if "grid_id" in px.columns:  # one row per cell; a placement is that of one grid
        one = F.min("grid_id").eqNullSafe(F.max("grid_id"))
        found = found.groupBy("id", "cell_id").agg(F.when(one, F.min("cell_type")).otherwise(
            F.raise_error(F.lit("the table holds several grids, a placement is that of one"))).alias("cell_type"))
    found = found.select("id", "cell_id", "cell_type")
    return cells.join(found, ["id", "cell_id"], "left")


def cell_mode(px: DataFrame, *, keys: tuple[str, ...] = ("zip_code", "cell_id"), value: str = "value") -> DataFrame:
    """The more robust alternative: most frequent class per cell, the smallest on a tie."""
    n = px.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("int").alias("_v")).agg(
        F.count(F.lit(1)).alias("_n"))
    return n.groupBy(*keys).agg(F.max_by(F.col("_v").cast("string"), F.struct("_n", -F.col("_v"))).alias("cell_type"))


def polygons_intersect(left: DataFrame, right: DataFrame, *, bucket: float | None = None) -> DataFrame:
    """Pairs (left_id, right_id) of polygons that share at least one point.

    Candidates meet on coarse squares. Two polygons touch when two edges cross, or one holds a
    vertex of the other; both tests run on edge rows that share a square, never on all pairs.
    `bucket` is the square's side, by default a small part of the common extent.
    """
    bucket = bucket or region_bucket(left)
    def bucketed(e: DataFrame, side: str) -> DataFrame:
        def seq(a: str, b: str) -> Column:
            lo, hi = F.least(a, b), F.greatest(a, b)
            return F.sequence(F.floor(lo / bucket), F.floor(hi / bucket))
        e = e.withColumn("bx", F.explode(seq("x1", "x2"))).withColumn("by", F.explode(seq("y1", "y2")))
        return e.select("bx", "by", *[F.col(k).alias(f"{side}_{k}") for k in ("id", "x1", "y1", "x2", "y2")])

    le, re = edges(left), edges(right)
    pairs = bucketed(le, "l").join(bucketed(re, "r"), ["bx", "by"])

    def side(ax: str, ay: str, bx: str, by: str, px: str, py: str) -> Column:
        return F.signum((F.col(bx) - F.col(ax)) * (F.col(py) - F.col(ay))
                        - (F.col(by) - F.col(ay)) * (F.col(px) - F.col(ax)))

    d1 = side("l_x1", "l_y1", "l_x2", "l_y2", "r_x1", "r_y1")
    d2 = side("l_x1", "l_y1", "l_x2", "l_y2", "r_x2", "r_y2")
    d3 = side("r_x1", "r_y1", "r_x2", "r_y2", "l_x1", "l_y1")
    d4 = side("r_x1", "r_y1", "r_x2", "r_y2", "l_x2", "l_y2")
    boxes = F.expr("greatest(l_x1,l_x2) >= least(r_x1,r_x2) and greatest(r_x1,r_x2) >= least(l_x1,l_x2) and "
                   "greatest(l_y1,l_y2) >= least(r_y1,r_y2) and greatest(r_y1,r_y2) >= least(l_y1,l_y2)")
    crossing = (pairs.where(boxes & (d1 * d2 <= 0) & (d3 * d4 <= 0))
                .select(F.col("l_id").alias("left_id"), F.col("r_id").alias("right_id")))

    def holds(outer: DataFrame, inner: DataFrame, outer_name: str, inner_name: str) -> DataFrame:
        """The first vertex of one of inner's rings lies in outer: odd number of outer edges to its right.

        Only outers whose bounding box holds the vertex are asked; they meet on coarse squares.
        """
        first = inner.select(F.col("id").alias("i_id"), F.posexplode("rings").alias("ring", "pts")).where(F.size("pts") > 0)
        first = first.select("i_id", "ring", F.col("pts")[0]["x"].alias("x"), F.col("pts")[0]["y"].alias("y"))
        wide = 16 * bucket

        def squares(lo: str, hi: str) -> Column:
            return F.explode(F.sequence(F.floor(F.col(lo) / wide), F.floor(F.col(hi) / wide)))

        boxes_ = bounds(outer).withColumn("sx", squares("minx", "maxx")).withColumn("sy", squares("miny", "maxy"))
        first = (first.withColumn("sx", F.floor(F.col("x") / wide)).withColumn("sy", F.floor(F.col("y") / wide)).join(boxes_, ["sx", "sy"])
                 .where("x between minx and maxx and y between miny and maxy").select("id", "i_id", "ring", "x", "y"))
        first = first.withColumn("by", F.floor(F.col("y") / bucket))
        rows = (edges(outer).where("y1 <> y2").withColumn("by", F.explode(F.sequence(
            F.floor(F.least("y1", "y2") / bucket), F.floor(F.greatest("y1", "y2") / bucket)))))
        hit = (first.join(rows.drop("ring_no"), ["id", "by"])
               .where(((F.col("y1") > F.col("y")) != (F.col("y2") > F.col("y")))
                      & (F.col("x") < F.col("x1") + (F.col("y") - F.col("y1")) / (F.col("y2") - F.col("y1"))
                         * (F.col("x2") - F.col("x1")))))
        odd = hit.groupBy("id", "i_id", "ring").agg((F.count(F.lit(1)) % 2).alias("_odd")).where("_odd = 1")
        return odd.select(F.col("id").alias(outer_name), F.col("i_id").alias(inner_name))

    return (crossing.unionByName(holds(left, right, "left_id", "right_id"))
            .unionByName(holds(right, left, "right_id", "left_id")).distinct())


def zips_in_states(zips: DataFrame, states: DataFrame, *, wanted: list[str], bucket: float | None = None) -> DataFrame:
    """ZIP polygons that touch a wanted state, each with the first such state by name."""
    target = states.where(F.col("state").isin(*wanted)).select(F.col("state").alias("id"), "rings")
    pairs = polygons_intersect(zips.select("id", "rings"), target, bucket=bucket)
    first = pairs.groupBy(F.col("left_id").alias("id")).agg(F.min("right_id").alias("state"))
    return zips.join(first, "id")


def _segments(roads: DataFrame, keep: list[str]) -> DataFrame:
    parts = roads.select(*keep, "pts", F.explode(F.sequence(F.lit(1), F.size("pts") - 1)).alias("i"))
    p, q = F.element_at("pts", F.col("i")), F.element_at("pts", F.col("i") + 1)
    return parts.select(*keep, p["x"].alias("x1"), p["y"].alias("y1"), q["x"].alias("x2"), q["y"].alias("y2"))


def line_length(pts: Column) -> Column:
    return F.aggregate(F.sequence(F.lit(1), F.size(pts) - 1), F.lit(0.0), lambda acc, i: acc + F.sqrt(
        F.pow(F.element_at(pts, i + 1)["x"] - F.element_at(pts, i)["x"], 2)
        + F.pow(F.element_at(pts, i + 1)["y"] - F.element_at(pts, i)["y"], 2)))


def road_heat(px: DataFrame, grid: Grid | DataFrame, roads: DataFrame) -> DataFrame:
    """Add road_heat_flux_wm2 and road_temp_offset_f: the summed flux of all buffers over a pixel.

    A buffer is the set of points within the tier distance of the line (round caps, exact circle).
    Pixels come from each segment's own rows and columns, so a segment costs what it covers; a
    pixel met by several segments of one road counts that road once. `grid` is the placement of the
    one grid in `px`, or the placement table of several.

    Roads are dealt in blocks of rows. One with a single segment in its block meets no pixel twice, so its flux is
    summed before the shuffle; only the others travel as rows per road and pixel.
    """
    seg = _segments(roads.where("size(pts) >= 2 and heat_flux_wm2 is not null")
                    .withColumn("_d", road_buffer_m("aadt")), ["road_id", "heat_flux_wm2", "_d"])
    d = F.col("_d")

    ends = ["x1", "y1", "x2", "y2", "_d"]
    # what a segment needs for each of its pixels is made here, and without nulls: a longer loop would be too long to be compiled
    seg = seg.where(" and ".join(f"{k} is not null" for k in ends)).withColumns({k: F.coalesce(k, F.lit(0.0)) for k in ends})
    seg = (seg.withColumn("_lo", F.least("y1", "y2") - d).withColumn("_hi", F.greatest("y1", "y2") + d)
           .withColumn("_dx", F.col("x2") - F.col("x1")).withColumn("_dy", F.col("y2") - F.col("y1"))
           .withColumn("_len2", F.col("_dx") * F.col("_dx") + F.col("_dy") * F.col("_dy")))
    flat = F.nullif(F.col("_dy"), F.lit(0.0))
    seg = (seg.withColumn("_len2", F.when(F.col("_len2") > 0, F.col("_len2")).otherwise(1.0))
           .withColumn("_per", F.coalesce(1.0 / flat, F.lit(0.0))).withColumn("_part", F.coalesce(d / F.abs(flat), F.lit(1.0))))
    seg, p = on_grids(seg, grid, (F.least("x1", "x2") - d, F.col("_lo"), F.greatest("x1", "x2") + d, F.col("_hi")))

    def each_index(df: DataFrame, out: str, ends: tuple[Column, Column]) -> DataFrame:
        return (df.withColumn("_first", ends[0]).withColumn("_last", ends[1]).where("_first <= _last")
                .withColumn(out, F.explode(F.sequence("_first", "_last"))))

    ends = p.rows_between(F.col("_lo"), F.col("_hi"))
    seg = seg.withColumn("_r0", ends[0]).withColumn("_r1", ends[1])
    seg = each_index(seg, "_block", (F.floor(F.col("_r0") / SPAN_BLOCK), F.floor(F.col("_r1") / SPAN_BLOCK))).drop("_first", "_last")
    one_road = [*p.keys, "_block", "road_id", "heat_flux_wm2"]
    seg = spread(seg, *one_road).withColumn("_many", F.count(F.lit(1)).over(Window.partitionBy(*one_road)) > 1)
    # every step is a column of its own: inlined into one expression they would multiply
    seg = each_index(seg, "row", (F.greatest("_r0", F.col("_block") * SPAN_BLOCK), F.least("_r1", (F.col("_block") + 1) * SPAN_BLOCK - 1)))
    # only the part of the segment within reach of this row can touch its pixels
    def share(x: Column) -> Column:
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))

    near = (seg.withColumn("_py", p.y(F.col("row")) - F.col("y1")).withColumn("_mid", F.col("_py") * F.col("_per"))
            .withColumn("_xa", F.col("x1") + share(F.col("_mid") - F.col("_part")) * F.col("_dx"))
            .withColumn("_xb", F.col("x1") + share(F.col("_mid") + F.col("_part")) * F.col("_dx")))
    near = near.withColumn("_lo", F.least("_xa", "_xb") - d).withColumn("_hi", F.greatest("_xa", "_xb") + d).drop("_xa", "_xb", "_mid")
    near = each_index(near, "col", p.cols_between(F.col("_lo"), F.col("_hi")))
    dx, dy = F.col("_dx"), F.col("_dy")
    near = near.withColumn("_px", p.x(F.col("col")) - F.col("x1"))
    near = near.withColumn("_t", share((F.col("_px") * dx + F.col("_py") * dy) / F.col("_len2")))
    near = near.withColumn("_gx", F.col("_px") - F.col("_t") * dx).withColumn("_gy", F.col("_py") - F.col("_t") * dy)
    gap2 = F.col("_gx") * F.col("_gx") + F.col("_gy") * F.col("_gy")
    on = [*p.keys, "row", "col"]
    own = [F.when(F.col("_many"), F.col(k)).alias(f"_{k}") for k in ("road_id", "heat_flux_wm2")]
    touched = near.where(gap2 <= d * d).groupBy(*on, "_many", *own).agg(F.sum("heat_flux_wm2").alias("_all"), F.max("heat_flux_wm2").alias("_once"))
    flux = touched.groupBy(*on).agg(F.sum(F.when(F.col("_many"), F.col("_once")).otherwise(F.col("_all"))).alias("_flux"))
    return (px.withColumn("row", F.col("row").cast("long")).withColumn("col", F.col("col").cast("long"))
            .join(flux, on, "left")
            .withColumn("road_heat_flux_wm2", F.coalesce("_flux", F.lit(0.0)))
            .withColumn("road_temp_offset_f", road_temp_offset("road_heat_flux_wm2")).drop("_flux"))


def region_bucket(polygons: DataFrame, target: int = 256) -> float:
    """A bucket width that cuts the common extent into about `target` columns."""
    box = bounds(polygons).agg(F.min("minx").alias("a"), F.max("maxx").alias("b")).first()
    return max((box["b"] - box["a"]) / target, math.ulp(1.0))
