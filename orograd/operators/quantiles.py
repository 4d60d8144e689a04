"""Exact quantiles that never gather a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import bounded_join, checkpoint


def exact_quantiles(df: DataFrame, value: str, qs: dict[str, float], *, keys: tuple[str, ...] = (),
                    buckets: int = 256) -> DataFrame:
    """Linear-interpolation quantiles of `value` per key, one column per name in `qs`.

    The built-in exact percentile keeps every distinct value of a group in one task's memory. Here
    a sketch proposes cut points, rows are counted per value and per bucket, and only the buckets
    that hold a wanted rank are ordered. The sketch affects speed alone: ranks are counted exactly.
    """
    if buckets & (buckets - 1):
        raise ValueError("buckets must be a power of two")
    keys = keys or ("_all",)
    v = df.withColumn("_all", F.lit(0)).where(F.col(value).isNotNull()).select(
        *keys, F.col(value).cast("double").alias("_v"))
    cuts = F.percentile_approx("_v", [i / buckets for i in range(1, buckets)], 2000)
    shape = v.groupBy(*keys).agg(cuts.alias("_cuts"), F.count(F.lit(1)).alias("_total"))
    counts = v.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    # the bucket of a value is the number of cuts below it, found by halving
    placed = bounded_join(counts, shape, list(keys)).withColumn("_b", F.lit(0))
    half = buckets // 2
    while half:
        placed = placed.withColumn("_b", F.col("_b") + F.when(F.get("_cuts", F.col("_b") + (half - 1)) < F.col("_v"), half).otherwise(0))
        half //= 2
    placed = checkpoint(placed.drop("_cuts"))  # used twice; computed again, a value may end in other digits and in another bucket

    def position(q: float) -> Column:
        return q * (F.col("_total") - 1)

    ranks = {(n, end): fn(position(q)) for n, q in qs.items() for end, fn in (("lo", F.floor), ("hi", F.ceil))}
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    start = (placed.groupBy(*keys, "_b").agg(F.sum("_c").alias("_n"), F.max("_total").alias("_total"))
             .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))))
    holds = F.lit(False)
    for r in ranks.values():
        holds = holds | ((r >= F.col("_start")) & (r < F.col("_start") + F.col("_n")))
    kept = placed.join(start.where(holds).select(*keys, "_b", "_start"), [*keys, "_b"])
    running = Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = kept.withColumn("_to", F.col("_start") + F.sum("_c").over(running))
    hit = at.groupBy(*keys).agg(F.max("_total").alias("_total"), *[
        F.max(F.when((r >= F.col("_to") - F.col("_c")) & (r < F.col("_to")), F.col("_v"))).alias(f"_{n}_{end}")
        for (n, end), r in ranks.items()])
    out = [(F.col(f"_{n}_lo") + (position(q) - F.floor(position(q))) * (F.col(f"_{n}_hi") - F.col(f"_{n}_lo"))).alias(n)
           for n, q in qs.items()]
    return hit.select(*[k for k in keys if k != "_all"], *out)
