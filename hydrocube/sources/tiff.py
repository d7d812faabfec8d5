"""Single-band GeoTIFF rasters as pixel rows, and back, without a raster library.

Strips and tiles, uncompressed or deflated, without a predictor or with the
horizontal one, in unsigned and signed integers and floats. One file is one
task's work, so a file has to fit in an executor's memory.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .retry import retried

NODATA = 255
#: Fixed values of the format: sizes of field types, and the tags used here.
FIELD = {1: "B", 2: "c", 3: "H", 4: "I", 12: "d", 16: "Q"}
WIDTH, HEIGHT, BITS, COMPRESSION, OFFSETS, SAMPLES, STRIP_ROWS, COUNTS, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS, SAMPLE_FORMAT = 256, 257, 258, 259, 273, 277, 278, 279, 317, 322, 323, 324, 325, 339
PHOTOMETRIC, SCALE, TIEPOINT, NODATA_TEXT = 262, 33550, 33922, 42113
PIXELS = "path string, west double, north double, res double, row_ int, col_ int, v double"


def encode(values: np.ndarray, west: float = -180.0, north: float = 90.0, res: float = 1 / 60, nodata: int | None = NODATA, strip: int = 256) -> bytes:
    """A deflated strip TIFF of a matrix of uint8, uint16 or float32."""
    kind = {"u": 1, "i": 2, "f": 3}[values.dtype.kind]
    little = np.ascontiguousarray(values, values.dtype.newbyteorder("<"))
    strips = [zlib.compress(little[at : at + strip].tobytes()) for at in range(0, len(little), strip)]
    text = f"{nodata}\0".encode() if nodata is not None else b"\0"
    offsets, at = [], 8
    for s in strips:
        offsets.append(at)
        at += len(s)
    fields = [
        (WIDTH, 4, [values.shape[1]]), (HEIGHT, 4, [values.shape[0]]), (BITS, 3, [8 * values.itemsize]), (COMPRESSION, 3, [8]), (PHOTOMETRIC, 3, [1]), (OFFSETS, 4, offsets), (SAMPLES, 3, [1]), (STRIP_ROWS, 4, [strip]),
        (COUNTS, 4, [len(s) for s in strips]), (SAMPLE_FORMAT, 3, [kind]), (SCALE, 12, [res, res, 0.0]), (TIEPOINT, 12, [0.0, 0.0, 0.0, west, north, 0.0]), (NODATA_TEXT, 2, [bytes([b]) for b in text]),
    ]
    at += at % 2
    table, more, room = struct.pack("<H", len(fields)), b"", at + 2 + 12 * len(fields) + 4
    for tag, form, numbers in fields:
        body = struct.pack(f"<{len(numbers)}{FIELD[form]}", *numbers)
        held = body.ljust(4, b"\0")
        if len(body) > 4:
            held = struct.pack("<I", room + len(more))
            more += body + b"\0" * (len(body) % 2)
        table += struct.pack("<HHI", tag, form, len(numbers)) + held
    head = struct.pack("<2sHI", b"II", 42, at)
    return (head + b"".join(strips)).ljust(at, b"\0") + table + b"\0\0\0\0" + more


def _fields(data: bytes) -> tuple[str, dict[int, list]]:
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or len(data) < 8 or struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ValueError("this is not a TIFF file")
    at = struct.unpack_from(order + "I", data, 4)[0]
    found = {}
    for k in range(struct.unpack_from(order + "H", data, at)[0]):
        tag, form, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * k)
        if form in FIELD:
            size = struct.calcsize(FIELD[form]) * count
            place = at + 10 + 12 * k if size <= 4 else struct.unpack_from(order + "I", data, at + 10 + 12 * k)[0]
            found[tag] = list(struct.unpack_from(f"{order}{count}{FIELD[form]}", data, place))
    return order, found


def decode(data: bytes) -> tuple[np.ndarray, dict]:
    """(values, {west, north, res, nodata}) of a file's first image."""
    order, f = _fields(data)
    width, height = f[WIDTH][0], f[HEIGHT][0]
    dtype = np.dtype(order + {1: "u", 2: "i", 3: "f"}[f.get(SAMPLE_FORMAT, [1])[0]] + str(f.get(BITS, [8])[0] // 8))
    how, ahead = f.get(COMPRESSION, [1])[0], f.get(PREDICTOR, [1])[0]
    if how not in (1, 8, 32946) or ahead not in (1, 2) or f.get(SAMPLES, [1])[0] != 1:
        raise ValueError(f"compression {how}, predictor {ahead} or several bands are not read here")
    tiled = TILE_OFFSETS in f
    block = (f[TILE_HEIGHT][0], f[TILE_WIDTH][0]) if tiled else (min(f.get(STRIP_ROWS, [height])[0], height), width)
    out, across = np.zeros((height, width), dtype.newbyteorder("=")), -(-width // block[1])
    for k, (at, n) in enumerate(zip(f[TILE_OFFSETS if tiled else OFFSETS], f[TILE_COUNTS if tiled else COUNTS])):
        row, col = k // across * block[0], k % across * block[1]
        raw = data[at : at + n] if how == 1 else zlib.decompress(data[at : at + n])
        part = np.frombuffer(raw, dtype).reshape(-1, block[1]).astype(out.dtype)
        part = np.cumsum(part, axis=1, dtype=out.dtype) if ahead == 2 else part
        part = part[: height - row, : width - col]
        out[row : row + len(part), col : col + part.shape[1]] = part
    scale, tie = f.get(SCALE, [1.0, 1.0, 0.0]), f.get(TIEPOINT, [0.0] * 6)
    text = b"".join(f.get(NODATA_TEXT, [])).strip(b"\0 ").decode()
    return out, {"west": tie[3] - tie[0] * scale[0], "north": tie[4] + tie[1] * scale[1], "res": scale[0], "nodata": float(text) if text else None}


def read_rasters(spark: SparkSession, uri: str, glob: str = "*.tif") -> DataFrame:
    """Pixels (path, west, north, res, row_, col_, v) of every file under a folder; nodata is null. row_ and col_ count within the file."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                values, at = decode(content)
                row, col = np.indices(values.shape, np.int32)
                v = values.astype(float).ravel()
                gone = np.isnan(v) if at["nodata"] is None else np.isnan(v) | (v == at["nodata"])
                yield pd.DataFrame({"path": path, "west": at["west"], "north": at["north"], "res": at["res"], "row_": row.ravel(), "col_": col.ravel(), "v": np.where(gone, np.nan, v)})

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(uri).select("path", "content")
    return files.mapInPandas(rows, PIXELS).withColumn("v", F.nanvl("v", F.lit(None).cast("double")))


def load_item(items: DataFrame, item: str, bands: list[str], attempts: int = 3, wait: float = 1.0) -> DataFrame:
    """An item's pixels (row_, col_ and the named bands) of a pixel table: only those columns and rows are read. The read is tried again where the store fails."""
    missing = [b for b in bands if b not in items.columns]
    if missing:
        raise KeyError(f"the item has no bands {missing}")
    found = items.where(F.col("item") == item).select("row_", "col_", *bands)
    if not retried(lambda: found.limit(1).count(), attempts, wait, on=(Exception,)):
        raise KeyError(f"no item {item!r}")
    return found


def cube_rows(rasters: DataFrame, source: str, layer: str | None = None) -> DataFrame:
    """read_rasters' pixels as rows for Cube.write: the date and, without a given layer, the layer's name come from the file's, percents are kept as they are.

    Files that lie on the canonical grid are shifted onto it; others have to go through resample.to_grid first and are an error here.
    """
    name = F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1)
    day = F.try_to_timestamp(F.regexp_extract("path", r"(\d{8})[^/]*$", 1), F.lit("yyyyMMdd")).cast("date")
    row, col = (F.lit(90.0) - F.col("north")) * 60, (F.col("west") + 180.0) * 60
    fits = (F.abs(F.col("res") * 60 - 1) < 1e-6) & (F.abs(row - F.round(row)) < 1e-4) & (F.abs(col - F.round(col)) < 1e-4)
    at = lambda c, start: F.when(fits, F.col(c) + F.round(start)).otherwise(F.raise_error(F.concat("path", F.lit(" is not on the grid")))).cast("int")
    dated = rasters.where(day.isNotNull())
    return dated.select(
        F.lit(source).alias("source"), (F.lit(layer) if layer else F.regexp_replace(name, r"^.*?\d{8}_?", "")).alias("layer"), day.alias("date"), at("row_", row).alias("row_"), at("col_", col).alias("col_"),
        F.coalesce(F.col("v").cast("int"), F.lit(NODATA)).alias("v"), F.xxhash64("path").alias("seq"),
    )


def checked(layer: Column, value: Column) -> Column:
    """A layer's value as it is stored: fractions 0-100 with nodata for missing ones, counts and codes as they are; a likelihood out of range is an error."""
    percent = F.coalesce(F.bround(100 * F.nanvl(value, F.lit(None).cast("double"))), F.lit(NODATA))
    in_range = value.between(0, 100) | (value == NODATA)
    likely = F.when(in_range | value.isNull(), F.coalesce(value, F.lit(NODATA))).otherwise(F.raise_error(F.concat(F.lit("a likelihood out of 0-100: "), value.cast("string"))).cast("double"))
    return F.when(layer.endswith("_fraction"), percent).when(layer.contains("likelihood"), likely).otherwise(F.coalesce(value, F.when(layer.endswith("_count"), 0).otherwise(NODATA))).cast("double")


def as_rasters(pixels: DataFrame, by: list[str]) -> DataFrame:
    """(name, content): one TIFF for each group of pixels (by, layer, row_, col_, v) on the canonical grid, over the group's extent."""

    def one(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        row, col = frame["row_"].to_numpy(), frame["col_"].to_numpy()
        counted = str(key[-1]).endswith("_count")
        grid = np.full((row.max() - row.min() + 1, col.max() - col.min() + 1), np.nan if counted else NODATA, np.float32 if counted else np.uint8)
        grid[row - row.min(), col - col.min()] = frame["v"]
        content = encode(grid, -180 + col.min() / 60, 90 - row.min() / 60, nodata=None if counted else NODATA)
        return pd.DataFrame({"name": ["_".join(str(k).replace("-", "") for k in key) + ".tif"], "content": [content]})

    stored = pixels.select(*by, "layer", "row_", "col_", checked(F.col("layer"), F.col("v").cast("double")).alias("v"))
    return stored.groupBy(*by, "layer").applyInPandas(one, "name string, content binary")


def save_rasters(rasters: DataFrame, folder: str) -> DataFrame:
    """Writes each (name, content) to the folder, a shared one, and gives (name, size); a task that runs again writes the same file."""

    def put(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        for frame in frames:
            for name, content in zip(frame["name"], frame["content"]):
                with store.open_output_stream(f"{root}/{name}") as out:
                    out.write(content)
            yield pd.DataFrame({"name": frame["name"], "size": [len(c) for c in frame["content"]]})

    return rasters.mapInPandas(put, "name string, size long")
