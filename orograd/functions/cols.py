"""Shared helpers for column functions: argument coercion, unit conversions, clamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str | int | float


def c(x: ColumnLike | None) -> Column:
    """Column from a name, a number or a Column."""
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(None if x is None else float(x))


def bind(value: ColumnLike, body) -> Column:
    """`body(value)` with `value` computed once; plain reuse would compute it per mention."""
    return F.element_at(F.transform(F.array(c(value)), body), 1)


def nan_to_null(x: ColumnLike) -> Column:
    """Missing values are NULL inside the library; NaN is converted once, at ingest."""
    return F.nullif(c(x).cast("double"), F.lit(float("nan")))


def floor_zero(x: ColumnLike) -> Column:
    """max(0, x); a missing x gives 0."""
    return F.greatest(F.lit(0.0), c(x))


def floor_zero_or_null(x: ColumnLike) -> Column:
    """max(0, x); a missing x stays missing."""
    return F.when(c(x).isNotNull(), F.greatest(F.lit(0.0), c(x)))


def clip(x: ColumnLike, lo: float, hi: float) -> Column:
    """Clamp into [lo, hi], keeping missing values missing."""
    return F.when(c(x).isNotNull(), F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), c(x))))


def celsius_to_f(x: ColumnLike) -> Column:
    return c(x) * 9.0 / 5.0 + 32.0


def kelvin_to_f(x: ColumnLike) -> Column:
    return (c(x) - 273.15) * 9.0 / 5.0 + 32.0


def m_to_ft(x: ColumnLike) -> Column:
    return c(x) * 3.28084


def ms_to_kt(x: ColumnLike) -> Column:
    return c(x) * 1.94384


def angle_diff(a: ColumnLike, b: ColumnLike) -> Column:
    """Smallest angle between two bearings, 0..180."""
    d = F.abs(c(a) - c(b))
    return F.least(d, 360.0 - d)


def zfill5(x: ColumnLike) -> Column:
    """Left-pad to five characters; longer strings are kept whole (lpad would cut them)."""
    s = c(x).cast("string")
    return F.when(F.length(s) < 5, F.lpad(s, 5, "0")).otherwise(s)
