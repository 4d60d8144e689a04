import datetime as dt

import numpy as np

from orograd.operators import sketches
from orograd.sources import sinks
from orograd.streaming import cycles

SCHEMA = "ts timestamp, zip_code string, t2m_k double, seq long"


def test_totals_take_each_hour_once_with_its_newest_value(spark, tmp_path):
    src, out, state = (str(tmp_path / k) for k in ("in", "out", "state"))
    t = [dt.datetime(2024, 1, 1) + dt.timedelta(hours=h) for h in range(30)]
    rows = [(x, "97201", 280.0, 1) for x in t] + [(t[5], "97201", 290.0, 3), (t[5], "97201", 300.0, 2), (t[5], "97201", 290.0, 3)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(src)
    days = cycles.newest_daily_hdd_stream(cycles.cycle_source(spark, src, SCHEMA), sequence="seq")
    (days.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start().awaitTermination())
    r, = spark.read.parquet(out).collect()
    f = [(k - 273.15) * 9 / 5 + 32 for k in [280.0] * 23 + [290.0]]
    assert r["num_hours"] == 24 and abs(r["mean_temp_f"] - sum(f) / 24) < 1e-9 and abs(r["daily_hdd"] - sum(max(0, 65 - x) / 24 for x in f)) < 1e-9


def test_merged_sketches_are_within_their_bound(spark):
    rng = np.random.default_rng(2)
    values = rng.gamma(2.0, 3.0, 40_000)
    df = spark.createDataFrame([(k % 20, float(x)) for k, x in enumerate(values)], "day int, v double")
    r = sketches.merged_quantiles(sketches.quantile_sketches(df, "v", keys=("day",)), {"a": 0.1, "b": 0.5, "c": 0.99}, keys=()).first()
    order = np.sort(values)
    for name, q in (("a", 0.1), ("b", 0.5), ("c", 0.99)):
        assert abs(np.searchsorted(order, r[name]) / len(order) - q) <= 2 * sketches.rank_error()
    assert r["num_values"] == 40_000
    assert sketches.quantile_sketches(df.limit(0), "v", keys=("day",)).count() == 0


def test_run_labels():
    at = dt.datetime(2024, 3, 5, 7, 9)
    assert sinks.run_label("r1", None, at) == "r1__normal__20240305T0709" and sinks.run_label("r1", 2021, at).startswith("r1__2021__")
