"""Plans and results when one key holds most of the rows."""

import numpy as np
from pyspark.sql import functions as F

from orograd.operators import quality, raster, zonal
from orograd.operators.quantiles import exact_quantiles
from orograd.session import bounded_join


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_cell_is_combined_before_the_shuffle(spark):
    px = spark.range(30000).select(F.when(F.col("id") % 3 < 2, "hot").otherwise(F.col("id").cast("string")).alias("zip_code"),
                                   F.lit("c").alias("cell_id"), (F.col("id") % 100).cast("double").alias("prism_annual_hdd"))
    out = zonal.cell_zonal(px, bands=["prism_annual_hdd"])
    assert "partial_avg" in plan(out)
    hot = out.where("zip_code = 'hot'").first()
    ids = np.arange(30000)
    assert hot["num_valid_pixels"] == 20000
    np.testing.assert_allclose(hot["prism_annual_hdd"], (ids[ids % 3 < 2] % 100).mean())


def test_one_grid_is_not_shuffled_by_its_id(spark):
    px = spark.range(1000).select(F.lit("g").alias("grid_id"), F.expr("id div 40").alias("row"), (F.col("id") % 40).alias("col"), F.col("id").cast("double").alias("v"))
    out = raster.grid_max_share(px, "v", "share")
    assert "Exchange hashpartitioning" not in plan(out)
    assert out.agg(F.max("share")).first()[0] == 1.0


def test_large_side_is_not_broadcast(spark):
    big = spark.range(1000).withColumn("k", F.col("id") % 50)
    small = spark.range(50).select(F.col("id").alias("k"), F.lit(1).alias("x"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(bounded_join(big, small, ["k"], max_rows=50))
        other = bounded_join(big, small, ["k"], max_rows=49)
        assert "BroadcastHashJoin" not in plan(other) and other.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_median_split_with_one_dominant_value(spark):
    t = spark.range(999).select(F.lit("z").alias("zip_code"), F.lit("c").alias("cell_id"), F.when(F.col("id") < 600, 5.0).otherwise(F.col("id").cast("double")).alias("mean_elevation_ft"),
                                F.col("id").cast("double").alias("effective_hdd"))
    r = quality.directional(t).first()
    assert r["low_hdd"] == np.arange(600).mean() and r["high_hdd"] == np.arange(600, 999).mean()
    assert not r["elevation_issue"]


def test_median_row_stays_low_when_a_mean_is_computed_again(spark):
    """Means whose last digits differ from one computation to the next, as after another order of adding up."""
    def again(frames):
        rng = np.random.default_rng()
        for f in frames:
            f["mean_elevation_ft"] = f["mean_elevation_ft"] * (1 + rng.integers(-3, 4, len(f)) * 2.0 ** -51)
            yield f

    rows = spark.range(1500).select(F.expr("cast(id div 5 as string)").alias("zip_code"), (100.1 + F.col("id") % 5).alias("mean_elevation_ft"),
                                    (F.col("id") % 5).cast("double").alias("effective_hdd"))
    out = quality.directional(rows.mapInPandas(again, rows.schema), keys=("zip_code",))
    assert [tuple(r) for r in out.select("low_hdd", "high_hdd").distinct().collect()] == [(1.0, 3.5)]
    med = exact_quantiles(rows.mapInPandas(again, rows.schema), "mean_elevation_ft", {"m": 0.5}, keys=("zip_code",))
    assert med.count() == 300 and med.where("m is null or abs(m - 102.1) > 1e-9").count() == 0
