"""Flat binary files of fixed-length records, read by byte ranges: rasters row by row, token files block by block."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..types import Grid

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPLIT_BYTES = 32 << 20      # what one task reads of a file
NAME = "fixed_records"


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or a local path."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class _Split(InputPartition):
    def __init__(self, path: str, first: int, last: int, size: int) -> None:
        self.path, self.first, self.last, self.size = path, first, last, size


class _Reader(DataSourceReader):
    """Blocks of records of all files below a path, in splits of consecutive blocks."""

    def __init__(self, options: dict) -> None:
        self.path, self.block_bytes, self.skip = options["path"], int(options["block_bytes"]), int(options.get("skip_bytes", "0"))
        self.first, self.last = int(options.get("first_block", "0")), int(options.get("last_block", str(1 << 62)))

    def _files(self) -> list[tuple[str, int]]:
        system, path = _opened(self.path)
        info = system.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        if info.type == fs.FileType.File:
            return [(self.path, info.size)]
        prefix = self.path[:len(self.path) - len(path)] if self.path.endswith(path) else ""
        found = system.get_file_info(fs.FileSelector(path, recursive=True))
        return sorted((prefix + f.path, f.size) for f in found if f.type == fs.FileType.File and not f.base_name.startswith(("_", ".")))

    def partitions(self) -> list[_Split]:
        out, step = [], max(1, SPLIT_BYTES // self.block_bytes)
        for path, size in self._files():
            blocks = -(-max(size - self.skip, 0) // self.block_bytes)
            end = min(blocks, self.last + 1)
            out += [_Split(path, k, min(k + step, end), size) for k in range(self.first, end, step)]
        return out

    def read(self, split: _Split):
        system, path = _opened(split.path)
        with system.open_input_file(path) as f:
            for k in range(split.first, split.last):
                at = self.skip + k * self.block_bytes
                f.seek(at)
                data = f.read(min(self.block_bytes, split.size - at))
                yield pa.RecordBatch.from_pydict({"file": [split.path], "block": pa.array([k], pa.int64()), "data": pa.array([data], pa.binary())})


class FixedRecords(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "file string, block long, data binary"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def fixed_records(spark: SparkSession, path: str, *, record_bytes: int, records: int = 1, skip_bytes: int = 0,
                  blocks: tuple[int, int] | None = None) -> DataFrame:
    """Rows (file, block, data): stretches of `records` records of files of any size, the last of a file may be shorter.

    A file is cut into byte ranges that tasks read on their own; nothing is listed or opened but the files under `path`, a local
    path or a URI that all executors reach. `skip_bytes` at the begin of each file are passed over; `blocks` (first, last) reads those blocks alone.
    """
    spark.dataSource.register(FixedRecords)
    read = spark.read.format(NAME).option("path", path).option("block_bytes", record_bytes * records).option("skip_bytes", skip_bytes)
    if blocks is not None:
        read = read.option("first_block", blocks[0]).option("last_block", blocks[1])
    return read.load()


def bil_header(path: str) -> dict[str, str]:
    """Keys in upper case and values of a raster's `.hdr` beside the `.bil`."""
    system, at = _opened(path.rsplit(".", 1)[0] + ".hdr")
    with system.open_input_file(at) as f:
        lines = [x.split(None, 1) for x in f.read().decode("latin-1").splitlines()]
    return {x[0].upper(): x[1].strip() for x in lines if len(x) == 2}


def read_bil(spark: SparkSession, path: str, *, grid_id: str, band: int = 1, rows: tuple[int, int] | None = None, crs: str = "lonlat") -> tuple[DataFrame, Grid]:
    """(pixels, placement) of a band-interleaved raster: `(grid_id, row, col, value)`, nodata and NaN missing.

    Every file row is a record, so a raster of any size is read by many tasks; `rows` (first, last) reads those rows alone. The placement's origin
    is the outer corner of the first pixel.
    """
    h = bil_header(path)
    n_rows, n_cols, bits, bands = int(h["NROWS"]), int(h["NCOLS"]), int(h.get("NBITS", "8")), int(h.get("NBANDS", "1"))
    if h.get("LAYOUT", "BIL").upper() != "BIL":
        raise ValueError(f"not interleaved by line: {h['LAYOUT']}")
    kind = h.get("PIXELTYPE", "UNSIGNEDINT").upper()
    letter = "f" if kind == "FLOAT" else "i" if kind == "SIGNEDINT" else "u"
    dtype = f"{'>' if h.get('BYTEORDER', 'I').upper() in ('M', 'MSBFIRST') else '<'}{letter}{bits // 8}"
    nodata = float(h["NODATA"]) if "NODATA" in h else None
    width = n_cols * bits // 8
    if not 1 <= band <= bands:
        raise ValueError(f"no band {band} of {bands}")
    lo, hi = rows if rows is not None else (0, n_rows - 1)
    raw = fixed_records(spark, path, record_bytes=width * bands, skip_bytes=int(h.get("SKIPBYTES", "0")), blocks=(max(lo, 0), min(hi, n_rows - 1)))
    at = (band - 1) * width

    def decode(batches):
        for pdf in batches:
            for row, data in zip(pdf["block"], pdf["data"]):
                v = np.frombuffer(data[at:at + width], dtype=dtype).astype(np.float64)
                if nodata is not None:
                    v = np.where(v == np.float64(np.array(nodata).astype(dtype)), np.nan, v)
                yield pd.DataFrame({"row": row, "col": np.arange(len(v), dtype=np.int64), "value": v})

    px = raw.select("block", "data").mapInPandas(decode, "row long, col long, value double")
    px = px.select(F.lit(grid_id).alias("grid_id"), "row", "col", F.nullif("value", F.lit(float("nan"))).alias("value"))
    dx, dy = float(h["XDIM"]), float(h["YDIM"])
    return px, Grid(a=dx, c=float(h["ULXMAP"]) - dx / 2, e=-dy, f=float(h["ULYMAP"]) + dy / 2, n_rows=n_rows, n_cols=n_cols, crs=crs)
