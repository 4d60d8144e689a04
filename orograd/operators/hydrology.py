"""D8 flow direction, flow accumulation and cold-air drainage.

Accumulation over a whole grid needs no pass per elevation level and no join of the full pixel
table with itself. Every tile is summed on its own; only the cells on tile borders form a graph
across tiles, about `4 / tile` of the pixels. Tiles are contracted to tiles of tiles, level by level:
a block keeps what leaves it and where what enters it comes out, so each level holds a fraction of
the one below. The top is solved at once, and totals go down the levels as inflow of blocks, then of pixels.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.surface import drainage_multiplier
from ..session import checkpoint
from .raster import TILE, grid_max_share, with_neighbours

# the tile functions travel with their code: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FACTOR = 8            # blocks along a side that one block of the next level takes in
TOP_ROWS = 500_000    # border cells that one task solves at the top

# direction code -> (row step, column step), in tie-breaking order (fixed values)
D8 = {1: (0, 1), 2: (1, 1), 4: (1, 0), 8: (1, -1), 16: (0, -1), 32: (-1, -1), 64: (-1, 0), 128: (-1, 1)}
_NAMES = {1: "e", 2: "se", 4: "s", 8: "sw", 16: "w", 32: "nw", 64: "n", 128: "ne"}


def flow_direction(dem: DataFrame, *, value: str = "elev_m", tile: int = TILE) -> DataFrame:
    """Add `flow_dir`: code of the steepest strictly lower neighbour, 0 for sinks and missing cells."""
    px = with_neighbours(dem, value, tile=tile)
    slope = {}
    for code, (dr, dc) in D8.items():
        drop = F.col(value) - F.col(_NAMES[code])
        slope[code] = drop / F.lit(2.0) ** 0.5 if dr and dc else drop
    steepest = F.greatest(*slope.values())
    pick = F.when(F.coalesce(steepest, F.lit(0.0)) <= 0, 0)
    for code, s in slope.items():  # the first of equal slopes wins
        pick = pick.when(s == steepest, code)
    return px.withColumn("flow_dir", pick.otherwise(0).cast("int")).drop(*_NAMES.values())


def _downstream(row: np.ndarray, col: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    dr, dc = np.zeros(129, dtype=np.int64), np.zeros(129, dtype=np.int64)
    for k, (r, s) in D8.items():
        dr[k], dc[k] = r, s
    return row + dr[code], col + dc[code]


def _tile_sums(pdf: pd.DataFrame, tile: int):
    """Sum weights down the flow lines of one tile by pointer doubling.

    Returns the summed cells, the flat index of each cell's last in-tile cell, and the downstream
    coordinates of every cell.
    """
    r0, c0 = int(pdf["tile_r"].iloc[0]) * tile, int(pdf["tile_c"].iloc[0]) * tile
    flat = ((pdf["row"].to_numpy() - r0) * tile + (pdf["col"].to_numpy() - c0)).astype(np.int64)
    size = tile * tile
    total = np.bincount(flat, weights=pdf["weight"].to_numpy(dtype=float), minlength=size)
    code = np.zeros(size, dtype=np.int64)
    own = pdf["flow_dir"].notna().to_numpy()  # rows that carry only inflow have no direction
    code[flat[own]] = pdf["flow_dir"].to_numpy()[own].astype(np.int64)
    cells = np.arange(size)
    to_r, to_c = _downstream(cells // tile, cells % tile, code)
    inside = (code > 0) & (to_r >= 0) & (to_r < tile) & (to_c >= 0) & (to_c < tile)
    jump = np.where(inside, to_r * tile + to_c, -1)
    last = np.where(inside, jump, cells)
    while (jump >= 0).any():
        live = jump >= 0
        total = total + np.bincount(jump[live], weights=total[live], minlength=size)
        last = last[last]
        jump = np.where(live, jump[np.where(live, jump, 0)], -1)
    return flat[own], total, last, code, to_r + r0, to_c + c0, r0, c0


RIM = ("grid_id string, row long, col long, weight double, leaves boolean, to_row long, to_col long, "
       "end_row long, end_col long, end_leaves boolean")


def _key(row: np.ndarray, col: np.ndarray) -> np.ndarray:
    return (row.astype(np.int64) << 32) | col.astype(np.int64)


class _Block:
    """Border cells of a block's parts: exits with their weights, and for each cell the exit that its inflow takes."""

    def __init__(self, pdf: pd.DataFrame) -> None:
        pdf = pdf.reset_index(drop=True)
        self.pdf, n = pdf, len(pdf)
        keys = _key(pdf["row"].to_numpy(), pdf["col"].to_numpy())
        order = np.argsort(keys, kind="stable")
        self.sorted, self.order = keys[order], order
        self.leaves = pdf["leaves"].to_numpy(dtype=bool)
        to = self.find(_key(pdf["to_row"].to_numpy(), pdf["to_col"].to_numpy()))
        # the border cells at hand are all of the block, so a target that is not there lies outside or swallows the flow
        self.ends = np.where(pdf["end_leaves"].to_numpy(dtype=bool), self.find(_key(pdf["end_row"].to_numpy(), pdf["end_col"].to_numpy())), -1)
        inside = self.leaves & (to >= 0)
        self.into = np.where(inside, to, -1)                                   # cell of the block that an exit flows to
        self.next = np.where(inside, self.ends[np.maximum(to, 0)], -1)          # exit that it takes from there
        self.outside = self.leaves & (to < 0)
        self.last = np.where(self.next >= 0, self.next, np.arange(n))
        while True:
            further = self.last[self.last]
            if (further == self.last).all():
                break
            self.last = further

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.sorted, keys), max(len(self.sorted) - 1, 0))
        return np.where(self.sorted[at] == keys, self.order[at], -1) if len(self.sorted) else np.full(len(keys), -1)

    def totals(self, extra: np.ndarray | float = 0.0) -> np.ndarray:
        """Weight through every exit, by pointer doubling over the exits."""
        total = np.where(self.leaves, self.pdf["weight"].to_numpy(dtype=float), 0.0) + extra
        jump = self.next.copy()
        while (jump >= 0).any():
            live = jump >= 0
            total = total + np.bincount(jump[live], weights=total[live], minlength=len(total))
            jump = np.where(live, jump[np.maximum(jump, 0)], -1)
        return total


def _contract(pdf: pd.DataFrame, span: int) -> pd.DataFrame:
    """A block of blocks as one block: its outer border cells, what leaves by them, and where inflow comes out."""
    b = _Block(pdf)
    total, rows, cols = b.totals(), b.pdf["row"].to_numpy(), b.pdf["col"].to_numpy()
    rim = np.flatnonzero((rows % span == 0) | (rows % span == span - 1) | (cols % span == 0) | (cols % span == span - 1))
    out = b.pdf.iloc[rim].copy()
    out["leaves"] = b.outside[rim]
    out["weight"] = np.where(b.outside[rim], total[rim], 0.0)
    start = b.ends[rim]
    end = np.where(start >= 0, b.last[np.maximum(start, 0)], 0)
    comes_out = (start >= 0) & b.outside[end]
    out["end_leaves"] = comes_out
    out["end_row"], out["end_col"] = np.where(comes_out, rows[end], -1), np.where(comes_out, cols[end], -1)
    return out


def _contraction(span: int):
    return lambda pdf: _contract(pdf, span)


def _inflow(pdf: pd.DataFrame) -> pd.DataFrame:
    """What flows into each border cell of a block's parts; rows without `leaves` are inflow from outside the block."""
    cells = pdf["leaves"].notna()
    came, b = pdf[~cells], _Block(pdf[cells])
    extra = np.zeros(len(b.pdf))
    if len(came):
        at = b.find(_key(came["row"].to_numpy(), came["col"].to_numpy()))
        start = np.where(at >= 0, b.ends[np.maximum(at, 0)], -1)
        np.add.at(extra, start[start >= 0], came["weight"].to_numpy()[start >= 0])
    total, own = b.totals(extra), np.flatnonzero(b.into >= 0)
    rows, cols = b.pdf["row"].to_numpy(), b.pdf["col"].to_numpy()
    inner = pd.DataFrame({"grid_id": b.pdf["grid_id"].to_numpy()[own], "row": rows[b.into[own]], "col": cols[b.into[own]], "weight": total[own]})
    return pd.concat([inner, came[["grid_id", "row", "col", "weight"]]], ignore_index=True)


def flow_accumulation(flow: DataFrame, *, tile: int = TILE, factor: int = FACTOR, top_rows: int = TOP_ROWS) -> DataFrame:
    """Add `flow_accumulation`: number of cells draining through each cell, itself included.

    `flow` holds one row per cell with `flow_dir`; `valid` (optional boolean) marks cells with an
    elevation, others come out missing. A level has `factor` times fewer blocks along a side than the one below; as soon as
    no grid has more than `top_rows` border cells left, a task solves each grid's.
    """
    if "valid" not in flow.columns:
        flow = flow.withColumn("valid", F.lit(True))
    # written once: both tile passes read it
    cells = checkpoint(flow.select(
        "grid_id", F.col("row").cast("long"), F.col("col").cast("long"), "flow_dir", "valid",
        F.floor(F.col("row") / F.lit(tile)).cast("long").alias("tile_r"),
        F.floor(F.col("col") / F.lit(tile)).cast("long").alias("tile_c")))
    weighted = cells.select("grid_id", "tile_r", "tile_c", "row", "col", "flow_dir", "valid",
                            F.lit(1.0).alias("weight"))

    def border(pdf: pd.DataFrame) -> pd.DataFrame:
        own, total, last, code, to_r, to_c, r0, c0 = _tile_sums(pdf, tile)
        r, s = own // tile, own % tile
        rim = own[(r == 0) | (r == tile - 1) | (s == 0) | (s == tile - 1)]
        end = last[rim]
        return pd.DataFrame({
            "grid_id": pdf["grid_id"].iloc[0], "row": rim // tile + r0, "col": rim % tile + c0,
            "weight": total[rim], "leaves": (code[rim] > 0) & (end == rim), "to_row": to_r[rim], "to_col": to_c[rim],
            "end_row": end // tile + r0, "end_col": end % tile + c0, "end_leaves": code[end] > 0})

    rim = checkpoint(weighted.groupBy("grid_id", "tile_r", "tile_c").applyInPandas(border, RIM))
    levels, span = [], tile
    while (rim.groupBy("grid_id").count().agg(F.max("count")).first()[0] or 0) > top_rows:
        span *= factor
        levels.append((rim, span))
        if rim.agg(F.max("row"), F.max("col")).first() < (span, span):  # one block a grid: the level is its top
            break
        rim = checkpoint(_in_blocks(rim, span).applyInPandas(_contraction(span), RIM))
    if not levels or levels[-1][0] is not rim:
        levels.append((rim, None))
    inflow = None
    for own, span in reversed(levels):
        rows = own if inflow is None else own.unionByName(inflow, allowMissingColumns=True)
        grouped = rows.groupBy("grid_id") if span is None else _in_blocks(rows, span)
        inflow = checkpoint(grouped.applyInPandas(_inflow, "grid_id string, row long, col long, weight double"))
    inflow = inflow.groupBy("grid_id", "row", "col").agg(F.sum("weight").alias("weight"))
    inflow = inflow.select(
        "grid_id", F.floor(F.col("row") / F.lit(tile)).cast("long").alias("tile_r"),
        F.floor(F.col("col") / F.lit(tile)).cast("long").alias("tile_c"), "row", "col",
        F.lit(None).cast("int").alias("flow_dir"), F.lit(None).cast("boolean").alias("valid"), "weight")

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        _, total, _, _, _, _, r0, c0 = _tile_sums(pdf, tile)
        own = pdf[pdf["flow_dir"].notna()]
        at = ((own["row"] - r0) * tile + (own["col"] - c0)).to_numpy()
        return pd.DataFrame({
            "grid_id": own["grid_id"], "row": own["row"], "col": own["col"],
            "flow_dir": own["flow_dir"].astype("int32"),
            "flow_accumulation": np.where(own["valid"].astype(bool), total[at], np.nan)})

    done = weighted.unionByName(inflow).groupBy("grid_id", "tile_r", "tile_c").applyInPandas(
        finish, "grid_id string, row long, col long, flow_dir int, flow_accumulation double")
    return done.withColumn("flow_accumulation", F.nullif("flow_accumulation", F.lit(float("nan"))))


def _in_blocks(rows: DataFrame, span: int):
    return rows.groupBy("grid_id", F.floor(F.col("row") / span).alias("block_r"), F.floor(F.col("col") / span).alias("block_c"))


def drainage_intensity(acc: DataFrame) -> DataFrame:
    """Accumulation scaled by the grid's largest value."""
    return grid_max_share(acc, "flow_accumulation", "drainage_intensity")


def cold_air_drainage(dem: DataFrame, *, value: str = "elev_m", max_increase: float = 0.15,
                      tile: int = TILE) -> DataFrame:
    """Flow direction, accumulation, intensity and the HDD multiplier of every cell."""
    flow = flow_direction(dem, value=value, tile=tile).withColumn("valid", F.col(value).isNotNull())
    acc = drainage_intensity(checkpoint(flow_accumulation(flow, tile=tile)))  # read for the maximum and for the shares
    return acc.withColumn("cold_air_mult", drainage_multiplier("drainage_intensity", max_increase))
