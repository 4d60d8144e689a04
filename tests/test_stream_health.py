import datetime as dt

import pytest

from orograd.streaming import cycles, health, missed

SCHEMA = "ts timestamp, zip_code string, v double"


def land(spark, path, schema, rows):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_counts_survive_a_failure_and_a_restart(spark, tmp_path):
    src, state, log = (str(tmp_path / k) for k in ("in", "state", "log"))
    t = dt.datetime(2024, 1, 1)
    listener = health.watched(spark, log)
    try:
        for n in range(4):
            land(spark, src, SCHEMA, [(t + dt.timedelta(hours=n), "97201", 1.0)])

            def sink(batch, batch_id, n=n):
                batch.count()
                if n == 2:
                    raise RuntimeError("disk is full")

            q = (cycles.cycle_source(spark, src, SCHEMA).withWatermark("ts", "1 hour").writeStream.queryName("cubes").foreachBatch(sink)
                 .option("checkpointLocation", state).trigger(availableNow=True).start())
            if n == 2:
                with pytest.raises(Exception, match="disk is full"):
                    q.awaitTermination()
            else:
                q.awaitTermination()
        # events arrive on a thread of their own
        import time
        for _ in range(100):
            rows = [r for r in health.stream_health(spark, log).collect() if r["num_failed"] == 1 and not r["running"]]
            if rows and rows[0]["num_runs"] == 4 and rows[0]["num_rows"] == 4:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    r, = rows
    assert (r["name"], r["num_runs"], r["num_failed"], r["num_processed"], r["num_rows"]) == ("cubes", 4, 1, 4, 4)
    assert "disk is full" in r["last_error"] and r["uptime_s"] >= 0 and r["last_batch"] >= 2 and r["latest_event"] is not None
    assert health.stream_health(spark, log).count() == 1      # read again, as after a new start of the program


def test_missed_hours_are_reported_and_withdrawn(spark, tmp_path):
    src, out, state = (str(tmp_path / k) for k in ("in", "out", "state"))
    day = dt.datetime(2024, 1, 1)
    hour = dt.timedelta(hours=1)
    # (arrival hour, feed, data hours): b falls silent after hour 3, a leaves 2 and 5 out and sends 2 late
    batches = [[(1, "a", [0]), (1, "b", [0])], [(2, "a", [1]), (2, "b", [1])], [(4, "a", [3]), (4, "b", [2, 3])], [(5, "a", [4, 4])], [(7, "a", [6])],
               [(9, "a", [8, 7, 2])], [(10, "a", [9])], [(14, "a", [10, 11, 12, 13])]]
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", missed.ROCKS)
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        for rows in batches:
            land(spark, src, "feed string, ts timestamp, arrived timestamp", [(f, day + h * hour, day + at * hour) for at, f, hs in rows for h in hs] + [(None, day, day)])
            stream = missed.missed_hours(spark.readStream.schema("feed string, ts timestamp, arrived timestamp").parquet(src))
            (stream.writeStream.outputMode("update").foreachBatch(lambda b, k: b.write.mode("append").parquet(out)).option("checkpointLocation", state)
             .trigger(availableNow=True).start().awaitTermination())
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    changes = spark.read.schema(missed.OUT).parquet(out)
    rows = [(r["feed"], r["hour"].hour, r["status"]) for r in changes.collect()]
    assert len(rows) == len(set(rows)) and ("a", 2, "missed") in rows and ("a", 2, "came") in rows
    gaps = {(r["feed"], r["hour"].hour) for r in missed.open_gaps(changes).collect()}
    # by hour 14, what ended two hours before and has not come
    sent = {(f, h) for b in batches for _, f, hs in b for h in hs}
    assert gaps == {(f, h) for f in "ab" for h in range(0, 12) if (f, h) not in sent} and ("a", 5) in gaps and ("b", 11) in gaps
