import datetime as dt

from pyspark.sql import functions as F

from orograd.operators.cubes import hourly_cube
from orograd.plans import runs
from orograd.sources import sinks
from orograd.streaming import cycles

SCHEMA = "ts timestamp, zip_code string, t2m_k double, u10 double, v10 double"


def rows(hours, day=1):
    return [(dt.datetime(2024, 1, day, h), z, 280.0 + h, 3.0, 4.0) for h in hours for z in ("97201", "97202")]


def terrain(spark):
    return spark.createDataFrame([("97201", "aggregate"), ("97202", "aggregate")], "zip_code string, cell_id string")


def land(spark, path, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_cycles_equal_batch_and_survive_restart(spark, tmp_path):
    src, out, state = (str(tmp_path / k) for k in ("in", "out", "state"))
    for hours in (range(0, 6), range(6, 12)):
        land(spark, src, rows(hours))
        stream = cycles.cycle_cube_stream(cycles.cycle_source(spark, src, SCHEMA), terrain(spark))
        cycles.write_cycles(stream, out, state, once=True).awaitTermination()
    got = spark.read.parquet(out)
    want = hourly_cube(spark.createDataFrame(rows(range(12)), SCHEMA), terrain(spark))
    cols = want.columns
    assert got.count() == want.count() == 12 * 2 * 8
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0
    assert cycles.validate_stream(got).count() == 0


def test_realtime_run_repeats_nothing(spark, tmp_path):
    src, out, state = (str(tmp_path / k) for k in ("in", "out", "state"))
    for data in (rows(range(0, 4)), rows(range(3, 6)), rows([5])):
        land(spark, src, data)
        runs.realtime_run(spark, src, SCHEMA, terrain(spark), out, state, once=True).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == got.select("datetime_utc", "zip_code", "altitude_ft").distinct().count() == 6 * 2 * 8


def test_dedup_and_late_rows(spark, tmp_path):
    src, out, state = (str(tmp_path / k) for k in ("in", "out", "state"))
    batches = [rows(range(0, 6)) + rows([5]), rows([4, 6]), rows(range(10, 14)), rows([1])]
    for data in batches:
        land(spark, src, data)
        q = (cycles.dedup_cycles(cycles.cycle_source(spark, src, SCHEMA)).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", state).trigger(availableNow=True).start())
        q.awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == got.select("ts", "zip_code").distinct().count() == 2 * len([*range(0, 7), *range(10, 14)])


def test_daily_totals_equal_batch_for_closed_days(spark, tmp_path):
    src, out, state = (str(tmp_path / k) for k in ("in", "out", "state"))
    land(spark, src, rows(range(24)) + rows(range(5), day=2))
    q = (cycles.daily_hdd_stream(cycles.cycle_source(spark, src, SCHEMA)).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(out).collect()
    want = sum(max(0, 65 - ((280.0 + h - 273.15) * 9 / 5 + 32)) / 24 for h in range(24))
    assert {r["date"] for r in got} == {dt.date(2024, 1, 1)} and len(got) == 2
    assert all(abs(r["daily_hdd"] - want) < 1e-9 and r["num_hours"] == 24 for r in got)
    assert cycles.stream_status(q).agg(F.sum("num_input_rows")).first()[0] == 58


def test_retention(spark, tmp_path):
    cube = spark.createDataFrame([(dt.datetime(2024, 1, d, 0), d) for d in range(1, 6)], "datetime_utc timestamp, n int")
    kept = cycles.rotate(cube, str(tmp_path / "archive"))
    assert {r["n"] for r in kept.collect()} == {3, 4, 5}
    assert spark.read.parquet(str(tmp_path / "archive")).count() == 2


def test_hashes(spark, tmp_path):
    (tmp_path / "src").mkdir()
    for k in "ab":
        (tmp_path / "src" / f"{k}.bin").write_text(k)
    stored = spark.createDataFrame(sinks.file_hashes(spark, str(tmp_path / "src")).collect())
    assert sinks.manifest_stale(sinks.file_hashes(spark, str(tmp_path / "src")), stored).where("stale").count() == 0
    assert sinks.manifest_stale(stored, None).where("not stale").count() == 0
    (tmp_path / "src" / "a.bin").write_text("changed")
    now = sinks.file_hashes(spark, str(tmp_path / "src"))
    assert [r["source"] for r in sinks.manifest_stale(now, stored).where("stale").collect()] == ["a.bin"]
    assert sinks.manifest_verify(stored, now).where("not matches").count() == 1
