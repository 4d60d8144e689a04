"""Mergeable quantiles: KLL sketches per key and day, stored, and merged for any period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 400     # size of a sketch


def rank_error(k: int = K) -> float:
    """How far the rank of a quantile may be off, as a share of the rows, with 99 % confidence: the sketch's published fit."""
    return 2.446 / k ** 0.9433


def quantile_sketches(df: DataFrame, value: str, *, keys: tuple[str, ...], k: int = K) -> DataFrame:
    """(keys, sketch, num_values): one bounded sketch per key, built with map-side combining in one scan; missing and NaN values are left out."""
    v = df.select(*keys, F.col(value).cast("double").alias("_v")).where("_v is not null and not isnan(_v)")
    return v.groupBy(*keys).agg(F.kll_sketch_agg_double("_v", k).alias("sketch"), F.count(F.lit(1)).alias("num_values"))


def merged_quantiles(sketches: DataFrame, qs: dict[str, float], *, keys: tuple[str, ...], k: int = K) -> DataFrame:
    """(keys, num_values, one column per name in `qs`) over all stored sketches of a key, as of the days of a period.

    The values are within `rank_error` of the wanted rank; `exact_quantiles` is the exact way.
    """
    m = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", k).alias("_s"), F.sum("num_values").alias("num_values"))
    return m.select(*keys, "num_values", *[F.kll_sketch_get_quantile_double("_s", F.lit(float(q))).alias(n) for n, q in qs.items()])
