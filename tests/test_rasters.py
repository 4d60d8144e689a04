import pandas as pd
import numpy as np
import pytest
from pyspark.sql import functions as F

from orograd.operators import hydrology, raster
from orograd.types import Grid


def table(spark, z, name="elev_m"):
    rows = [("g", r, c, None if np.isnan(z[r, c]) else float(z[r, c])) for r in range(z.shape[0]) for c in range(z.shape[1])]
    return spark.createDataFrame(rows, f"grid_id string, row int, col int, {name} double")


def grid(df, name, shape):
    out = np.full(shape, np.nan)
    for r in df.select("row", "col", name).collect():
        out[r["row"], r["col"]] = np.nan if r[name] is None else r[name]
    return out


@pytest.fixture(scope="module")
def rough():
    z = np.random.default_rng(3).integers(0, 40, (33, 41)).astype(float)
    z[4, 7] = z[20, 20] = np.nan
    return z


@pytest.mark.parametrize("tile", [8, 512])
def test_aspect_slope(spark, rough, tile):
    z = np.where(np.isnan(rough), np.nanmean(rough), rough)
    dy, dx = np.gradient(z)
    want_a, want_s = np.mod(90 - np.degrees(np.arctan2(dy, dx)), 360), np.degrees(np.arctan(np.hypot(dx, dy)))
    hide = np.isnan(rough)
    hide[[0, -1], :] = hide[:, [0, -1]] = True
    out = raster.aspect_slope(table(spark, rough), tile=tile)
    for name, want in (("aspect_deg", want_a), ("slope_deg", want_s)):
        np.testing.assert_allclose(grid(out, name, z.shape), np.where(hide, np.nan, want), atol=1e-9)


def test_flat_is_flat(spark):
    out = raster.aspect_slope(table(spark, np.full((6, 6), 7.0)))
    s = grid(out, "slope_deg", (6, 6))
    assert np.isnan(s[0]).all() and (s[1:-1, 1:-1] == 0).all()


def test_tpi_against_direct_means(spark, rough):
    z = np.where(np.isnan(rough), np.nanmean(rough), rough)
    want = np.full(z.shape, np.nan)
    for i in range(10, 23):
        for j in range(10, 31):
            if not np.isnan(rough[i, j]):
                outer, inner = z[i - 10:i + 11, j - 10:j + 11].mean(), z[i - 3:i + 4, j - 3:j + 4].mean()
                want[i, j] = z[i, j] - (outer * 100 - inner * 9) / 91
    got = grid(raster.tpi(table(spark, rough), pixel_size_m=100.0), "tpi", z.shape)
    np.testing.assert_allclose(got, want, atol=1e-9)


@pytest.mark.parametrize("sign", [1, -1])
def test_tpi_sign_of_peak_and_pit(spark, sign):
    r, c = np.mgrid[0:60, 0:60]
    z = 100 - sign * np.hypot(r - 30, c - 30)
    out = raster.tpi(table(spark, z), pixel_size_m=50.0).where("row = 30 and col = 30").first()
    assert out["tpi"] * sign > 0


def test_roughness_gradient(spark):
    cls = np.full((6, 6), 71.0)
    cls[:, 3:] = 42.0
    cls[0, 0] = np.nan
    px = table(spark, cls, "v").withColumn("nlcd_class", F.col("v").cast("int"))
    out = raster.surface_mask(px.drop("v"), tile=4)
    g = grid(out, "roughness_gradient", (6, 6))
    assert g[4, 0] == 0 and g[4, 5] == 0
    assert g[4, 2] == pytest.approx(4 * np.log(1.8 / 0.1))
    assert np.isnan(g[0, 0]) and np.isnan(g[1, 1])
    assert out.where("roughness_transition").count() == 12


def brute_flow(z):
    acc = np.where(np.isnan(z), np.nan, 1.0)
    code = np.zeros(z.shape, int)
    for i, j in np.ndindex(z.shape):
        best = 0.0
        for k, (a, b) in hydrology.D8.items():
            y, x = i + a, j + b
            if 0 <= y < z.shape[0] and 0 <= x < z.shape[1] and z[i, j] - z[y, x] > 0:
                s = (z[i, j] - z[y, x]) / (np.sqrt(2) if a and b else 1)
                if s > best:
                    best, code[i, j] = s, k
    for flat in np.argsort(-np.nan_to_num(z, nan=-1), axis=None, kind="stable"):
        i, j = divmod(int(flat), z.shape[1])
        if code[i, j]:
            a, b = hydrology.D8[code[i, j]]
            acc[i + a, j + b] += acc[i, j]
    return code, acc


@pytest.mark.parametrize("tile", [5, 16, 512])
def test_flow_accumulation(spark, rough, tile):
    code, acc = brute_flow(rough)
    out = hydrology.cold_air_drainage(table(spark, rough), tile=tile)
    assert (grid(out, "flow_dir", rough.shape) == code).all()
    np.testing.assert_array_equal(grid(out, "flow_accumulation", rough.shape), acc)
    assert out.agg(F.max("cold_air_mult")).first()[0] == pytest.approx(1.15)


def test_one_long_river_crosses_every_tile(spark):
    # a snake through all tiles: the deepest possible path, and one sink for every cell
    n = 24
    z = np.zeros((n, n))
    for r in range(n):
        cols = range(n) if r % 2 == 0 else range(n - 1, -1, -1)
        for k, c in enumerate(cols):
            z[r, c] = n * n - (r * n + k)
    code, acc = brute_flow(z)
    out = hydrology.flow_accumulation(hydrology.flow_direction(table(spark, z), tile=6), tile=6)
    np.testing.assert_array_equal(grid(out, "flow_accumulation", z.shape), acc)


def test_ramp_and_flat_drainage(spark):
    ramp = np.tile(np.arange(10.0) * 10, (10, 1))
    out = hydrology.cold_air_drainage(table(spark, ramp), tile=4)
    assert (grid(out, "flow_dir", ramp.shape)[1:-1, 1:-1] == 16).all()
    flat = hydrology.cold_air_drainage(table(spark, np.ones((5, 5))))
    assert flat.where("flow_dir <> 0 or flow_accumulation <> 1").count() == 0


def test_bilinear_identity_and_outside(spark, rough):
    src = table(spark, rough, "value")
    g = Grid(1.0, 0.0, -1.0, 33.0, 33, 41)
    same = grid(raster.bilinear(src, g, src.drop("value"), g), "value", rough.shape)
    # a missing pixel takes no part, and its place has no weight of its own
    np.testing.assert_allclose(same, rough)
    far = raster.bilinear(src, g, src.drop("value"), Grid(1.0, 500.0, -1.0, 33.0))
    assert far.where("value is not null").count() == 0


def test_bilinear_half_step(spark):
    z = np.arange(12.0).reshape(3, 4)
    src = table(spark, z, "value")
    g = Grid(1.0, 0.0, -1.0, 3.0, 3, 4)
    out = grid(raster.bilinear(src, g, src.drop("value"), Grid(1.0, 0.5, -1.0, 3.0)), "value", z.shape)
    np.testing.assert_allclose(out[:, :3], z[:, :3] + 0.5)


def test_area_average(spark):
    z = np.arange(16.0).reshape(4, 4)
    out = raster.area_average(table(spark, z, "value"), Grid(1.0, 0.0, -1.0, 4.0), Grid(2.0, 0.0, -2.0, 4.0))
    np.testing.assert_allclose(grid(out, "value", (2, 2)), z.reshape(2, 2, 2, 2).mean(axis=(1, 3)))


def test_tiles_are_one_exchange(spark, rough):
    plan = hydrology.flow_direction(table(spark, rough))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("sizes", [{"tile": 8}, {"tile": 4, "factor": 2, "top_rows": 20}, {"tile": 4, "factor": 3, "top_rows": 200}])
def test_levels_of_tiles_equal_one_pass(spark, sizes):
    """Accumulation over several levels of blocks, on two grids, against a walk from every cell."""
    rng = np.random.default_rng(7)
    n, parts = 37, []
    for g in ("a", "b"):
        z = np.cumsum(np.cumsum(rng.normal(size=(n, n)), 0), 1) + 2.0 * np.arange(n)[:, None]
        parts.append(pd.DataFrame({"grid_id": g, "row": np.repeat(np.arange(n), n), "col": np.tile(np.arange(n), n), "elev_m": z.ravel()}))
    flow = hydrology.flow_direction(spark.createDataFrame(pd.concat(parts)), tile=8)
    rows = flow.collect()
    code = {(r["grid_id"], r["row"], r["col"]): r["flow_dir"] for r in rows}
    want = dict.fromkeys(code, 0)
    for at in code:
        while True:
            want[at] += 1
            if not code[at]:
                break
            dr, dc = hydrology.D8[code[at]]
            at = (at[0], at[1] + dr, at[2] + dc)
    got = {(r["grid_id"], r["row"], r["col"]): r["flow_accumulation"] for r in hydrology.flow_accumulation(flow, **sizes).collect()}
    assert got == want and max(got.values()) > 100
