"""One grid as literals or many as a table: what operators need of where a grid lies."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import MAX_BROADCAST_ROWS, checkpoint
from ..types import Grid

NAMES = ("a", "c", "e", "f", "n_rows", "n_cols")
COARSE = 16      # squares along the longer side of the common extent, for pairing shapes with grids


@dataclass(frozen=True)
class Placed:
    """Columns a, c, e, f, n_rows, n_cols for the rows at hand, and the keys that tell grids apart."""

    a: Column
    c: Column
    e: Column
    f: Column
    n_rows: Column
    n_cols: Column
    keys: tuple[str, ...]
    carried: tuple[str, ...]

    def rows_between(self, lo: Column, hi: Column) -> tuple[Column, Column]:
        """Rows whose centres may lie in [lo, hi], one spare on either side, within the grid."""
        return self._between(lo, hi, self.f, self.e, self.n_rows)

    def cols_between(self, lo: Column, hi: Column) -> tuple[Column, Column]:
        return self._between(lo, hi, self.c, self.a, self.n_cols)

    @staticmethod
    def _between(lo: Column, hi: Column, origin: Column, step: Column, n: Column) -> tuple[Column, Column]:
        a, b = (lo - origin) / step - 0.5, (hi - origin) / step - 0.5
        first, last = F.floor(F.least(a, b)), F.ceil(F.greatest(a, b))
        # a missing size bounds nothing
        return F.when(n.isNull(), first).otherwise(F.greatest(first, F.lit(0).cast("long"))), F.when(n.isNull(), last).otherwise(F.least(last, n - 1))

    def x(self, col: Column) -> Column:
        return self.c + self.a * (col + 0.5)

    def y(self, row: Column) -> Column:
        return self.f + self.e * (row + 0.5)


def fixed(grid: Grid) -> Placed:
    size = [F.lit(n).cast("long") for n in (grid.n_rows, grid.n_cols)]
    return Placed(*[F.lit(float(k)) for k in (grid.a, grid.c, grid.e, grid.f)], *size, (), ())


def carried() -> Placed:
    """The placement in columns that `on_grids` or `with_placement` added."""
    return Placed(*[F.col(f"_{k}") for k in NAMES], ("grid_id",), tuple(f"_{k}" for k in NAMES))


def _table(grids: DataFrame) -> DataFrame:
    return grids.select("grid_id", *[F.col(k).alias(f"_{k}") for k in NAMES])


def with_placement(px: DataFrame, grid: Grid | DataFrame) -> tuple[DataFrame, Placed]:
    """Pixels with the placement of their grid; a grid without one is an error, not a guess."""
    if isinstance(grid, Grid):
        return px, fixed(grid)
    small = checkpoint(_table(grid))
    joined = px.join(F.broadcast(small) if small.count() <= MAX_BROADCAST_ROWS else small, "grid_id", "left")
    known = F.when(F.col("_a").isNotNull(), F.col("_a")).otherwise(F.raise_error(F.concat(F.lit("no placement of grid "), F.coalesce("grid_id", F.lit("NULL")))))
    return joined.withColumn("_a", known), carried()


def on_grids(shapes: DataFrame, grid: Grid | DataFrame, box: tuple[Column, Column, Column, Column]) -> tuple[DataFrame, Placed]:
    """Shapes with the placement of each grid that their box (minx, miny, maxx, maxy) can touch.

    Several grids are paired with shapes through coarse squares, so a shape meets the grids around it and no
    others; a shape on two overlapping grids becomes a row for each. Grids need their sizes then.
    """
    if isinstance(grid, Grid):
        return shapes, fixed(grid)
    p = carried()
    g = checkpoint(_table(grid))
    if g.where("_n_rows is null or _n_cols is null").limit(1).count():
        raise ValueError("a placement table needs n_rows and n_cols")
    ends = [(F.col("_c"), F.col("_c") + F.col("_a") * F.col("_n_cols")), (F.col("_f"), F.col("_f") + F.col("_e") * F.col("_n_rows"))]
    g = g.withColumns({"_gx0": F.least(*ends[0]), "_gx1": F.greatest(*ends[0]), "_gy0": F.least(*ends[1]), "_gy1": F.greatest(*ends[1])})
    whole = g.agg(F.min("_gx0"), F.max("_gx1"), F.min("_gy0"), F.max("_gy1")).first()
    if whole[0] is None:
        return shapes.join(g.drop("_gx0", "_gx1", "_gy0", "_gy1").limit(0), F.lit(False)), p
    side = max(whole[1] - whole[0], whole[3] - whole[2]) / COARSE or 1.0

    def squares(lo: Column, hi: Column, low: float, high: float) -> Column:
        def at(v: Column) -> Column:
            return F.floor((F.greatest(F.lit(low), F.least(F.lit(high), v)) - low) / side)
        return F.explode(F.sequence(at(lo), at(hi)))

    g = g.withColumn("_sx", squares(F.col("_gx0"), F.col("_gx1"), whole[0], whole[1])).withColumn("_sy", squares(F.col("_gy0"), F.col("_gy1"), whole[2], whole[3]))
    minx, miny, maxx, maxy = box
    s = shapes.withColumns({"_bx0": minx, "_by0": miny, "_bx1": maxx, "_by1": maxy}).where(
        (F.col("_bx1") >= whole[0]) & (F.col("_bx0") <= whole[1]) & (F.col("_by1") >= whole[2]) & (F.col("_by0") <= whole[3]))
    s = s.withColumn("_sx", squares(F.col("_bx0"), F.col("_bx1"), whole[0], whole[1])).withColumn("_sy", squares(F.col("_by0"), F.col("_by1"), whole[2], whole[3]))
    meet = (F.col("_bx1") >= F.col("_gx0")) & (F.col("_bx0") <= F.col("_gx1")) & (F.col("_by1") >= F.col("_gy0")) & (F.col("_by0") <= F.col("_gy1"))
    # of the squares that both cover, the first alone counts, so nothing has to be made distinct
    def corner(lo: str, other: str, low: float) -> Column:
        return F.floor((F.greatest(F.lit(low), F.greatest(lo, other)) - low) / side)
    first = (F.col("_sx") == corner("_bx0", "_gx0", whole[0])) & (F.col("_sy") == corner("_by0", "_gy0", whole[2]))
    paired = s.join(g, ["_sx", "_sy"]).where(meet & first)
    return paired.drop("_sx", "_sy", "_bx0", "_by0", "_bx1", "_by1", "_gx0", "_gx1", "_gy0", "_gy1"), p
