import datetime as dt

import pytest
from pyspark.sql import functions as F

from orograd.functions.cols import c
from orograd.operators import cubes, quality, timeseries, zonal
from orograd.sources import sinks, tables
from orograd.types import ALTITUDES_FT, PRESSURE_LEVELS_MB, STATIONS, TERRAIN_COLUMNS


def cells(spark):
    rows = [("97201", "cell_001", "KPDX", 4500.0), ("97201", "cell_002", "KPDX", 4600.0),
            ("97202", "cell_001", "KPDX", 4700.0), ("97202", "cell_002", "KPDX", 4800.0)]
    return spark.createDataFrame(rows, "zip_code string, cell_id string, base_station string, effective_hdd double").withColumn(
        "cell_area_sqm", F.lit("250000"))


def test_sink_rows_order_and_ids(spark, tmp_path):
    out = sinks.terrain_attributes(cells(spark), region_code="R1", run_date="2024-01-01")
    rows = {(r["zip_code"], r["cell_id"]): r for r in out.collect()}
    assert len(rows) == 6
    assert rows["97201", "aggregate"]["effective_hdd"] == 4550 and rows["97202", "aggregate"]["effective_hdd"] == 4750
    assert rows["97201", "cell_001"]["microclimate_id"] == "R1_97201_KPDX_cell_cell_001"
    assert rows["97201", "aggregate"]["microclimate_id"] == "R1_97201_KPDX_aggregate"
    assert rows["97201", "aggregate"]["cell_area_sqm"] is None
    known = [k for k in TERRAIN_COLUMNS if k in out.columns]
    assert out.columns[:len(known)] == known
    sinks.write_terrain(cells(spark), str(tmp_path / "t"), region_code="R1")
    back = tables.terrain_table(spark, str(tmp_path / "t"))
    assert dict(back.dtypes)["zip_code"] == "string" and back.count() == 6
    with pytest.raises(ValueError):
        sinks.terrain_attributes(cells(spark).drop("base_station"), region_code="R1")


def test_zip_aggregate_single_cell_has_no_std(spark):
    one = cells(spark).limit(1)
    assert zonal.zip_aggregate(one, region_code="R1").first()["cell_hdd_std"] is None


def test_zonal_means_missing_without_base(spark):
    px = spark.createDataFrame([("a", "c1", None, 5.0), ("a", "c2", 10.0, None), ("a", "c2", 20.0, 4.0)],
                               "zip_code string, cell_id string, prism_annual_hdd double, b double")
    got = {r["cell_id"]: r for r in zonal.cell_zonal(px, bands=["prism_annual_hdd", "b"]).collect()}
    assert got["c1"]["b"] is None and got["c1"]["num_valid_pixels"] == 0
    assert got["c2"]["prism_annual_hdd"] == 15 and got["c2"]["b"] == 4 and got["c2"]["num_valid_pixels"] == 2


def test_absent_bands_are_neutral(spark):
    r = zonal.with_bands(cells(spark), ["wind_infiltration_mult", "uhi_offset_f"]).first()
    assert r["wind_infiltration_mult"] == 1 and r["uhi_offset_f"] == 0


def test_bounds_need_their_columns(spark):
    with pytest.raises(ValueError):
        zonal.hdd_bounds(cells(spark))


def test_weather_year(spark):
    full = spark.createDataFrame([(s, float(n) * 1.1) for s, n, *_ in STATIONS], "station_code string, actual_hdd double")
    out = zonal.adjust_effective_hdd(cells(spark), full).where("cell_id = 'cell_001' and zip_code = '97201'").first()
    assert out["effective_hdd_adjusted"] == pytest.approx(4950) and out["effective_hdd"] == 4500
    assert zonal.adjust_effective_hdd(cells(spark)).columns == cells(spark).columns
    with pytest.raises(ValueError):
        zonal.weather_factors(full.where("station_code <> 'KPDX'"))
    with pytest.raises(ValueError):
        zonal.adjust_effective_hdd(cells(spark).withColumn("base_station", F.lit("KXXX")), full)


def test_hdd_months(spark):
    t = spark.createDataFrame([("g", 0, 0, m, 10.0) for m in range(1, 13)], "grid_id string, row int, col int, month int, temp_c double")
    got = {r["month"]: r["hdd"] for r in tables.hdd_monthly(t).collect()}
    assert got[1] == pytest.approx(465) and got[2] == pytest.approx(420)
    assert tables.hdd_annual(t).first()["hdd"] == pytest.approx(5475)
    with pytest.raises(ValueError, match="2"):
        tables.hdd_monthly(t.where("month <> 2"))


def test_dates():
    assert tables.expand_month("2024-02") == ("2024-02-01", "2024-02-29")
    assert tables.expand_month("2023-12") == ("2023-12-01", "2023-12-31")
    for bad in (("2014-07-29", "2015-01-01"), ("2024-01-02", "2024-01-01"), ("x", "2024-01-01")):
        with pytest.raises(ValueError):
            tables.check_date_range(*bad)


def test_hours_and_manifest(spark):
    exp = tables.expected_hours(spark, "2024-01-01", "2024-01-02")
    log = spark.createDataFrame([("2024-01-01 00:00:00", "cached"), ("2024-01-01 01:00:00", "missing")], "datetime_utc string, status string")
    gap = tables.missing_hours(exp, log)
    assert exp.count() == 48 and gap.count() == 47
    old = spark.createDataFrame([("h", "missing", 1), ("k", "cached", 2)], "datetime_utc string, status string, seq long")
    new = spark.createDataFrame([("h", "downloaded", 3)], "datetime_utc string, status string, seq long")
    got = {r["datetime_utc"]: r["status"] for r in tables.manifest_upsert(old, new).collect()}
    assert got == {"h": "downloaded", "k": "cached"}


def test_hourly_scan_takes_whole_days_and_aliases(spark):
    rows = [(dt.datetime(2024, 1, d, h), 280.0) for d in (1, 2, 3) for h in range(24)]
    df = spark.createDataFrame(rows, "ts timestamp, TMP_2maboveground double")
    out = tables.hourly_scan(df, "2024-01-01", "2024-01-02")
    assert out.count() == 48 and "t2m_k" in out.columns
    with pytest.raises(ValueError):
        tables.hourly_scan(df, "2025-01-01", "2025-01-02")


def test_hourly_scan_prunes(spark, tmp_path):
    rows = [(dt.datetime(2024, 1, d, h), 280.0, "x" * 10) for d in (1, 2, 3) for h in range(24)]
    df = spark.createDataFrame(rows, "ts timestamp, t2m_k double, unused string").withColumn("date", F.to_date("ts"))
    sinks.write_by_date(df, str(tmp_path / "h"))
    out = tables.hourly_scan(spark.read.parquet(str(tmp_path / "h")), "2024-01-02", "2024-01-02").groupBy().agg(F.avg("t2m_k"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "GreaterThanOrEqual(ts" in plan and "unused" not in plan


def test_csv_sources(spark, tmp_path):
    f = tmp_path / "zips.csv"
    f.write_text("state,zip_code,centroid_lon,centroid_lat\nOR,01001,-122.5,x\n")
    r = tables.zip_centroids(spark, str(f)).first()
    assert r["zip_code"] == "01001" and r["centroid_lat"] is None and r["centroid_lon"] == -122.5
    f.write_text("zip_code,state\n")
    assert tables.registry(spark, str(f)).isEmpty()
    assert tables.billing(spark, str(tmp_path / "none.csv")) is None
    d = tmp_path / "wind"
    d.mkdir()
    (d / "KPDX.csv").write_text("date_time,wind_speed_set_1\n2024-01-01 00:00:00,2.5\n2024-01-01 01:00:00,bad\n")
    (d / "ZZZZ.csv").write_text("date_time,wind_speed_set_1\n2024-01-01 00:00:00,9\n")
    (d / "KEUG.csv").write_text("date_time,gust\n2024-01-01 00:00:00,9\n")
    with pytest.warns(UserWarning, match="KEUG"):
        obs = tables.station_observations(spark, str(d))
    assert {r["station_id"] for r in obs.collect()} == {"KPDX"} and obs.count() == 2


def test_dated_output_is_idempotent(spark, tmp_path):
    cube = spark.createDataFrame([(dt.datetime(2024, 1, d, 0), "z", a) for d in (1, 2) for a in ALTITUDES_FT], "datetime_utc timestamp, zip_code string, altitude_ft int")
    for part in (cube, cube.where(F.to_date("datetime_utc") == "2024-01-02")):
        sinks.write_hourly(part, str(tmp_path / "h"))
    back = spark.read.parquet(str(tmp_path / "h"))
    assert back.count() == 16 and back.select("date").distinct().count() == 2
    with pytest.raises(ValueError):
        sinks.write_daily(cube, str(tmp_path / "x"), output_format="xml")


def test_climatology_weighs_years_equally(spark):
    rows = [(dt.datetime(2020, 1, d), 0, 0, 10.0) for d in range(1, 11)] + [(dt.datetime(2021, 1, 1), 0, 0, 20.0)]
    df = spark.createDataFrame(rows, "ts timestamp, gy int, gx int, temp_f double")
    with pytest.warns(UserWarning):
        assert timeseries.climatology(df).first()["clim_f"] == 15
    with pytest.raises(ValueError):
        timeseries.climatology(df.limit(0))


def test_bias_correction(spark):
    daily = spark.createDataFrame([(dt.date(2024, 1, 5), 0, 0, 50.0)], "date date, gy int, gx int, temp_f double")
    normals = spark.createDataFrame([(1, 0, 0, 48.0)], "month int, gy int, gx int, normal_f double")
    clim = spark.createDataFrame([(1, 0, 0, 49.0)], "month int, gy int, gx int, clim_f double")
    assert timeseries.bias_correct(daily, normals, clim).first()["adjusted_f"] == 49
    assert timeseries.bias_correct(daily, normals).first()["adjusted_f"] == 48
    with pytest.raises(ValueError):
        timeseries.bias_correct(daily, normals.withColumn("gx", F.lit(1)), clim)


def test_profile_between_levels(spark):
    sfc = spark.createDataFrame([("z", 1, 288.15, 1.0, 1.0, 1013.0)], "zip_code string, ts long, t2m_k double, u10 double, v10 double, sp_mb double")
    lv = [(1000, 5.0, 2.0, 288.15), (850, 10.0, 4.0, 280.0), (700, 15.0, 6.0, 270.0), (500, 20.0, 8.0, 250.0)]
    prs = spark.createDataFrame([("z", 1, *r) for r in lv], "zip_code string, ts long, level_mb int, u double, v double, t_k double")
    out = {r["altitude_ft"]: r for r in timeseries.wind_profiles(sfc, prs).collect()}
    assert len(out) == 8 and out[0]["temperature_k"] == 288.15
    assert 250 <= out[5000 if 5000 in out else 6000]["temperature_k"] <= 288.15
    assert out[18000]["temperature_k"] < out[3000]["temperature_k"]
    # no pressure data: only the surface is known
    bare = {r["altitude_ft"]: r["temperature_k"] for r in timeseries.wind_profiles(sfc, prs.limit(0)).collect()}
    assert bare[0] == 288.15 and bare[3000] is None
    assert len(PRESSURE_LEVELS_MB) == 16


def test_cube_skips_levels_without_data(spark):
    alts = (3000, 6000, 9000, 12000, 18000)
    row = {"date": dt.date(2024, 1, 1), "adjusted_temp_f": 50.0, "wind_speed_sfc_kt": 10.0, "wind_dir_sfc_deg": 90.0, "hdd_sfc": 15.0,
           "wind_shear_correction_sfc_kt": 0.0, "z0_m": 0.1}
    for a in alts:
        row |= {f"temp_{a}ft_adjusted_f": 40.0, f"wind_speed_{a}ft_kt": 20.0, f"wind_dir_{a}ft_deg": 90.0, f"hdd_{a}ft": 25.0}
    df = spark.createDataFrame([row | {"zip_code": z} for z in ("97201", "97202")])
    assert cubes.safety_cube(df).count() == 12


def hourly(spark):
    rows = [(dt.datetime(2024, 1, 1, h), z, 280.0 + h, 3.0, 4.0) for h in range(24) for z in ("97201", "97202")]
    return spark.createDataFrame(rows, "ts timestamp, zip_code string, t2m_k double, u10 double, v10 double")


def test_hourly_cube_is_complete(spark):
    terrain = spark.createDataFrame([("97201", "aggregate"), ("97202", "aggregate"), ("97201", "cell_001")], "zip_code string, cell_id string")
    cube = cubes.hourly_cube(hourly(spark), terrain)
    assert cube.count() == 384
    assert quality.hourly_validate(cube).where("severity = 'error'").count() == 0
    assert quality.hourly_validate(cube.where("altitude_ft < 18000")).where("rule like 'not 8%'").first()["num_rows"] == 48
    total = cubes.hourly_to_daily_hdd(cube).where("altitude_ft = 0 and zip_code = '97201'").first()
    want = sum(max(0, 65 - ((280.0 + h - 273.15) * 9 / 5 + 32)) / 24 for h in range(24))
    assert total["daily_hdd"] == pytest.approx(want)
    bad = cube.withColumn("turbulence_flag", F.lit("wild")).withColumn("date", F.to_date("datetime_utc"))
    assert quality.passed(quality.cube_validate(bad, complete=False)).first()["passed"] is False


def qa_table(spark):
    rows = [("97201", "cell_001", 4500.0), ("97201", "cell_002", 4700.0), ("97201", "aggregate", 4600.0), ("97202", "cell_001", 5200.0), ("97202", "aggregate", 5200.0)]
    return spark.createDataFrame(rows, "zip_code string, cell_id string, effective_hdd double")


def test_quality_checks(spark):
    good = qa_table(spark)
    res, issues = quality.run_all_checks(good)
    assert res.count() == 8 and res.where("not passed").count() == 0 and issues.count() == 0
    bad = good.withColumn("effective_hdd", F.when(F.col("cell_id") == "cell_001", -1.0).otherwise(c("effective_hdd")))
    failed = {r["check_name"]: r for r in quality.run_all_checks(bad)[0].where("not passed").collect()}
    assert failed["Hard Failure Check"]["is_hard_failure"] and failed["Hard Failure Check"]["num_issues"] == 2
    assert failed["Effective HDD Range"]["severity"] == "warning" and failed["Aggregate HDD Consistency"]["num_issues"] == 2
    lost = quality.consistency_issues(good.where("cell_id <> 'aggregate' or zip_code = '97202'")).collect()
    assert [r["detail"] for r in lost] == ["no aggregate row"]


def test_monthly_profile_counts_negative_twice(spark):
    t = qa_table(spark).limit(1)
    for m in ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"):
        t = t.withColumn(f"effective_hdd_{m}", F.lit(-5.0 if m == "jul" else 400.0))
    t = t.withColumn("effective_hdd_annual", F.lit(4395.0))
    got = quality.row_issues(t).where("check_name = 'Monthly HDD Profiles'").collect()
    assert sorted(r["detail"] for r in got) == ["negative", "outside range"]


def test_billing(spark):
    bill = spark.createDataFrame([("97201", 4600.0), ("97202", 0.0)], "zip_code string, therms_per_customer double")
    s = quality.billing_summary(qa_table(spark), bill).first()
    assert (s["num_matched"], s["num_divergent"], s["passed"]) == (2, 1, False) and s["max_divergence"] == float("inf")
    none = quality.billing_summary(qa_table(spark), None).first()
    assert none["passed"] and none["num_matched"] == 0


def test_top_issues_of_a_hot_check(spark):
    issues = spark.range(5000).select(F.lit("Effective HDD Range").alias("check_name"), F.format_string("%05d", "id").alias("zip_code"),
                                      F.lit("c").alias("cell_id"), F.lit("m").alias("metric"), F.col("id").cast("double").alias("value"), F.lit("d").alias("detail"))
    assert [r["zip_code"] for r in quality.top_issues(issues).orderBy("issue_no").collect()] == [f"{i:05d}" for i in range(10)]


def test_terrain_validation(spark):
    t = qa_table(spark).withColumn("microclimate_id", F.concat_ws("_", "zip_code", "cell_id"))
    assert quality.terrain_validate(t).count() == 0
    off = t.withColumn("effective_hdd", F.when((F.col("cell_id") == "aggregate") & (F.col("zip_code") == "97201"), 4601.0).otherwise(c("effective_hdd")))
    assert [r["issue"] for r in quality.terrain_validate(off).collect()] == ["aggregate effective_hdd differs from mean of cells"]
    assert quality.terrain_validate(t.drop("cell_id")).where("issue like 'missing column%'").count() == 1


def test_calibration_flattens(spark):
    rows = [("z", 60.0, 30.0, 4.0)] * 10 + [("z", 5.0, 25.0, 2.0)] * 10 + [("few", 60.0, 30.0, 4.0)]
    px = spark.createDataFrame(rows, "zip_code string, impervious_pct double, lst_c double, uhi_offset_f double")
    out = zonal.uhi_calibrate(px)
    vals = {round(r[0], 9) for r in out.where("zip_code = 'z'").select("uhi_offset_f").collect()}
    assert vals == {round(0.7 * 3 + 0.3 * 5 * 9 / 5, 9)}
    assert out.where("zip_code = 'few'").first()["uhi_offset_f"] == 4
    assert out.where("zip_code = 'z'").first()["calibration_warning"] is not None
