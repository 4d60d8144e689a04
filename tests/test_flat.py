import os

import numpy as np
import pytest

from orograd.sources.flat import fixed_records, read_bil


def header(path, **more):
    keys = {"BYTEORDER": "I", "LAYOUT": "BIL", "NROWS": 7, "NCOLS": 5, "NBANDS": 1, "NBITS": 32, "PIXELTYPE": "FLOAT", "ULXMAP": -124.5, "ULYMAP": 46.0,
            "XDIM": 0.5, "YDIM": 0.25, "NODATA": -9999} | more
    path.with_suffix(".hdr").write_text("".join(f"{k:<14}{v}\n" for k, v in keys.items()))


def values(df, shape):
    out = np.full(shape, -1.0)
    for r in df.collect():
        out[r["row"], r["col"]] = np.nan if r["value"] is None else r["value"]
    return out


@pytest.mark.parametrize("dtype, more", [("<f4", {}), (">f4", {"BYTEORDER": "M"}), ("<i2", {"NBITS": 16, "PIXELTYPE": "SIGNEDINT"}), ("<u1", {"NBITS": 8, "PIXELTYPE": "UNSIGNEDINT", "NODATA": 255})])
def test_bil_comes_back(spark, tmp_path, dtype, more):
    z = np.arange(35).reshape(7, 5).astype(dtype)
    z[2, 3] = 255 if dtype == "<u1" else -9999
    path = tmp_path / "tmean.bil"
    path.write_bytes(z.tobytes())
    header(path, **more)
    px, grid = read_bil(spark, str(path), grid_id="t")
    want = z.astype(float)
    want[2, 3] = np.nan
    np.testing.assert_array_equal(values(px, (7, 5)), want)
    assert (grid.a, grid.c, grid.e, grid.f, grid.n_rows, grid.n_cols) == (0.5, -124.75, -0.25, 46.125, 7, 5)
    part, _ = read_bil(spark, f"file://{path}", grid_id="t", rows=(5, 99))
    assert sorted({r["row"] for r in part.collect()}) == [5, 6]


def test_bands_and_skipped_bytes(spark, tmp_path):
    z = np.arange(2 * 3 * 4, dtype="<f4").reshape(3, 2, 4)     # rows, bands, columns
    path = tmp_path / "two.bil"
    path.write_bytes(b"head" + z.tobytes())
    header(path, NROWS=3, NCOLS=4, NBANDS=2, SKIPBYTES=4)
    np.testing.assert_array_equal(values(read_bil(spark, str(path), grid_id="t", band=2)[0], (3, 4)), z[:, 1].astype(float))
    with pytest.raises(ValueError):
        read_bil(spark, str(path), grid_id="t", band=3)


def test_a_file_of_five_gigabytes_in_several_tasks(spark, tmp_path):
    path = tmp_path / "large.bin"
    size = 5 << 30
    with open(path, "wb") as f:
        f.truncate(size)      # sparse: it takes no room
        f.seek(size - 3)
        f.write(b"end")
    df = fixed_records(spark, str(path), record_bytes=4, records=1 << 20)
    assert df.rdd.getNumPartitions() == -(-size // (32 << 20))
    last = size // (4 << 20) - 1
    tail = fixed_records(spark, str(path), record_bytes=4, records=1 << 20, blocks=(last, last + 5)).collect()
    assert [(r["block"], len(r["data"]), r["data"][-3:]) for r in tail] == [(last, 4 << 20, b"end")]


def test_folders_short_blocks_and_missing_files(spark, tmp_path):
    for k, data in enumerate((b"abcdefg", b"", b"xy")):
        (tmp_path / f"f{k}.bin").write_bytes(data)
    (tmp_path / "_SUCCESS").write_bytes(b"")
    rows = fixed_records(spark, str(tmp_path), record_bytes=1, records=3).collect()
    assert sorted((os.path.basename(r["file"]), r["block"], bytes(r["data"])) for r in rows) == [("f0.bin", 0, b"abc"), ("f0.bin", 1, b"def"), ("f0.bin", 2, b"g"), ("f2.bin", 0, b"xy")]
    with pytest.raises(Exception, match="nowhere"):
        fixed_records(spark, str(tmp_path / "nowhere"), record_bytes=1).collect()
