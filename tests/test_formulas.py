import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orograd.functions import air, degree_days as dd, geodesy, surface
from orograd.functions.cols import nan_to_null, zfill5


def test_daily_effective_hdd(one):
    assert one(dd.daily_effective_hdd(50, 1, 100, 50, 25)) == 40
    assert one(dd.daily_effective_hdd(70, 1, 0, 0, 0)) == 0
    assert one(dd.daily_effective_hdd(F.lit(None).cast("double"), 1, 0, 0, 0)) == 0


@pytest.mark.parametrize("raw,clean", [(126, 100), (127, None), (128, 100), (254, 100), (255, None), (-3, 0), (55, 55)])
def test_impervious_sentinels(one, raw, clean):
    assert one(surface.impervious_clean(F.lit(raw))) == clean


def test_lst_and_wind(one):
    assert one(surface.lst_celsius(0)) == pytest.approx(-124.15)
    assert one(air.wind_power_law(10)) == pytest.approx(10 * (10 / 80) ** 0.143)


@pytest.mark.parametrize("aspect,mult", [(180, 1.2), (0, 0.8), (90, 1.0), (270, 1.0), (-180, 1.2)])
def test_solar_aspect(one, aspect, mult):
    assert one(surface.solar_aspect(aspect)) == pytest.approx(mult)


def test_albedo_limits(one):
    assert one(surface.surface_albedo(0)) == pytest.approx(0.20)
    assert one(surface.surface_albedo(100)) == pytest.approx(0.05)
    assert one(surface.surface_albedo(F.lit(None).cast("double"))) is None


@pytest.mark.parametrize("aadt,buf", [(9999, 50), (10000, 100), (50000, 100), (50001, 200)])
def test_road_tiers(one, aadt, buf):
    assert one(surface.road_buffer_m(aadt)) == buf


def test_tke(one):
    u = 5 * 0.41 / math.log(10 / 0.1)
    assert one(air.tke(5, 0.1)) == pytest.approx(0.5 * u * u * (1 + 2 * 0.1 / 0.03))
    assert one(air.tke(0, 0.1)) == 0 and one(air.tke(5, 0)) == 0
    assert one(air.tke_from_friction(-1, 0.1)) == 0


@pytest.mark.parametrize("tke,flag", [(0.49, "smooth"), (0.5, "light"), (1.5, "moderate"), (3.0, "severe")])
def test_turbulence(one, tke, flag):
    assert one(air.turbulence(tke)) == flag


def test_shear_zero_cases(one):
    assert one(air.wind_shear_kt(5, 1001, 1.0, 0.03)) == 0
    assert one(air.wind_shear_kt(5, 500, 0.2, 0.03)) == 0
    u = 5 * 0.41 / math.log(10 / 0.03)
    z = 500 * 0.3048
    want = u / 0.41 * (math.log(z / 1.0) - math.log(z / 0.03)) * 1.944
    assert one(air.wind_shear_kt(5, 500, 1.0, 0.03)) == pytest.approx(want)


def test_forest_and_decay(one):
    assert one(air.forest_wind(5, 10.0, 1.5, 15)) == 0
    assert one(air.forest_wind(5, 20.0, 1.5, 15)) == 0  # reference height lies in the canopy
    assert one(air.forest_wind(5, 20.0, 1.5, 5)) > 0
    assert one(air.uhi_decay(6, 1000)) == 0
    assert one(air.uhi_decay(6, 300)) == pytest.approx(6 / math.e)


def test_wind_direction(one):
    assert one(air.wind_direction(0, 0)) == 0
    assert one(air.wind_direction(1, 0)) == pytest.approx(90)
    assert one(air.wind_direction(-1, 0)) == pytest.approx(270)


def test_wind_shadow(one):
    assert one(surface.wind_shadow(-1, 45)) == 1
    assert one(surface.wind_shadow(1, 45)) == 0
    assert one(surface.wind_shadow(-1, 225)) == 0


def test_text_and_nan(one):
    assert one(zfill5(F.lit("501"))) == "00501"
    assert one(zfill5(F.lit("9720112"))) == "9720112"
    assert one(nan_to_null(float("nan"))) is None


def test_projection_round_trip(spark):
    pts = [(lon / 10, lat / 10) for lon in range(-1245, -1165, 11) for lat in range(420, 491, 7)]
    df = spark.createDataFrame(pts, "lon double, lat double")
    x, y = geodesy.lonlat_to_utm("lon", "lat")
    df = df.withColumn("x", x).withColumn("y", y)
    lon2, lat2 = geodesy.utm_to_lonlat("x", "y")
    worst = df.select(F.max(F.abs(lon2 - F.col("lon")) + F.abs(lat2 - F.col("lat")))).first()[0]
    assert worst < 1e-7
    # the central meridian maps to the false easting; its northing is the meridian arc
    mid = spark.createDataFrame([(-123.0, 45.0)], "lon double, lat double").select(*geodesy.lonlat_to_utm("lon", "lat")).first()
    assert mid[0] == pytest.approx(500000.0) and mid[1] == pytest.approx(4982950.4, abs=0.5)


AIR = st.tuples(st.floats(0, 60), st.floats(0.001, 3), st.floats(0, 20000), st.floats(-60, 120), st.floats(-40, 40), st.floats(-40, 40))


@settings(max_examples=3, deadline=None)
@given(st.lists(AIR, min_size=40, max_size=80))
def test_air_properties(spark, rows):
    df = spark.createDataFrame(rows, "wind double, z0 double, alt double, t double, u double, v double")
    d = air.wind_direction("u", "v")
    high = F.col("alt") > 1000
    bad = df.where((air.tke("wind", "z0") < 0) | (air.density_altitude("t") < 0) | (d < 0) | (d >= 360)
                   | (high & (air.wind_shear_kt("wind", "alt", "z0", 0.03) != 0))
                   | (high & (air.subsidence(5, "alt", F.lit(True)) != 0)) | (high & (air.uhi_decay(5, "alt") != 0))
                   | (air.forest_wind("wind", "alt", "z0", 2.0) < 0) | (air.infiltration("wind", F.lit("KDLS")) < 1.15)).count()
    assert bad == 0


ROW = st.tuples(st.floats(-50, 120), st.floats(0.5, 2), st.floats(0, 500), st.floats(0, 200), st.floats(0, 100))


@settings(max_examples=3, deadline=None)
@given(st.lists(ROW, min_size=40, max_size=80))
def test_hdd_properties(spark, rows):
    df = spark.createDataFrame(rows, "t double, mult double, elev double, uhi double, traffic double")
    low, high = dd.hdd_bounds(F.col("t") * 100, "mult", "elev", "uhi", "traffic")
    nominal = dd.effective_hdd(F.col("t") * 100, "mult", "elev", "uhi", "traffic")
    bad = df.where((dd.daily_effective_hdd("t", "mult", "elev", "uhi", "traffic") < 0)
                   | (dd.altitude_hdd("t") < dd.altitude_hdd(F.col("t") + 1)) | (low > nominal) | (high < nominal)).count()
    assert bad == 0
