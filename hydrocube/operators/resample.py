"""Resampling and tiling: a pixel's target cell is a grouping key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.grid import NORTH, RES, WEST, group_of

METHODS = {
    "average": lambda v: F.avg(v),
    "mode": lambda v: F.mode(v, True),
    "max": lambda v: F.max(v),
    "min": lambda v: F.min(v),
    "med": lambda v: F.percentile(v, 0.5),
    "q1": lambda v: F.percentile(v, 0.25),
    "q3": lambda v: F.percentile(v, 0.75),
}


def coarsen(df: DataFrame, factor: int, value: str = "v", method: str = "average", by: tuple[str, ...] = (), trim: bool = False, nodata: int | None = None, phase: tuple[int, int] = (0, 0)) -> DataFrame:
    """Cells of factor x factor pixels; missing values do not count. trim drops cells with fewer pixels than a full one."""
    if method not in METHODS and method != "nearest":
        raise ValueError(f"unknown resampling {method!r}; known are {sorted([*METHODS, 'nearest', 'bilinear', 'cubic'])}")
    row, col = group_of(F.col("row_"), factor, phase[0]), group_of(F.col("col_"), factor, phase[1])
    if method == "nearest":
        middle = factor // 2
        return df.where((F.pmod(F.col("row_") - phase[0], F.lit(factor)) == middle) & (F.pmod(F.col("col_") - phase[1], F.lit(factor)) == middle)).select(*by, row.alias("trow"), col.alias("tcol"), F.col(value))
    v = F.col(value) if nodata is None else F.when(F.col(value) != nodata, F.col(value))
    out = df.groupBy(*by, row.alias("trow"), col.alias("tcol")).agg(METHODS[method](v).alias(value), F.count("*").alias("_n"))
    if nodata is not None:
        out = out.withColumn(value, F.coalesce(value, F.lit(nodata)))
    return (out.where(F.col("_n") >= factor * factor) if trim else out).drop("_n")


def on_grid(crs: str, res: float, west: float, north: float) -> bool:
    """Whether a raster lies on the canonical grid already, so that its pixels need a shift of indices only."""
    steps = ((west - WEST) / RES, (NORTH - north) / RES)
    return crs.upper() in ("EPSG:4326", "OGC:CRS84") and abs(res - RES) < 1e-9 and all(abs(s - round(s)) < 1e-6 for s in steps)


def to_grid(df: DataFrame, res: float, west: float, north: float, value: str = "v", method: str = "average", by: tuple[str, ...] = (), crs: str = "EPSG:4326") -> DataFrame:
    """A raster (row_, col_ from its north-west corner, any resolution in degrees) on the canonical grid.

    On the grid already, indices are shifted. Finer pixels are reduced by method
    in the cell of their centre; of coarser ones each cell takes the pixel that
    its centre lies in, so a pixel is sent to ceil(res / RES) + 1 cells an axis.
    """
    if crs.upper() not in ("EPSG:4326", "OGC:CRS84"):
        raise ValueError(f"{crs} is not in degrees")
    if method not in METHODS and method != "nearest":
        raise ValueError(f"unknown resampling {method!r}; known are {sorted([*METHODS, 'nearest'])}")
    if on_grid(crs, res, west, north):
        down, right = round((NORTH - north) / RES), round((west - WEST) / RES)
        return df.select(*by, (F.col("row_") + down).cast("int").alias("row_"), (F.col("col_") + right).cast("int").alias("col_"), value)
    at = lambda start, index: (F.lit(start) + index * F.lit(res)) / F.lit(RES)
    top, left = NORTH - north, west - WEST
    if res < RES:
        cells = [F.floor(at(top, F.col("row_") + 0.5)).cast("int").alias("row_"), F.floor(at(left, F.col("col_") + 0.5)).cast("int").alias("col_")]
        reduce = METHODS.get(method, F.first)
        if method == "nearest":
            off = lambda start, c: F.abs(at(start, F.col(c) + 0.5) - F.floor(at(start, F.col(c) + 0.5)) - 0.5)
            far = F.struct(off(top, "row_") + off(left, "col_"), F.col("row_"), F.col("col_"))
            return df.select(*by, *cells, far.alias("_far"), value).groupBy(*by, "row_", "col_").agg(F.min_by(value, "_far").alias(value))
        return df.select(*by, *cells, value).groupBy(*by, "row_", "col_").agg(reduce(F.col(value)).alias(value))
    cells = lambda start, c: F.sequence(F.ceil(at(start, F.col(c)) - 0.5).cast("int"), F.ceil(at(start, F.col(c) + 1) - 0.5).cast("int") - 1)
    return df.select(*by, F.explode(cells(top, "row_")).alias("row_"), F.col("col_").alias("_col"), value).select(*by, "row_", F.explode(cells(left, "_col")).alias("col_"), value)


def tile_bbox(tile_row: Column, tile_col: Column, height: int, width: int, size: int, overlap: int, west: float, north: float, res: float = RES) -> tuple[Column, ...]:
    """(west, south, east, north) of a tile of tiles(); ragged ones end with the raster, and a tile out of range is null."""
    stride = size - overlap
    inside = tile_row.between(0, max(0, (height - 1) // stride)) & tile_col.between(0, max(0, (width - 1) // stride))
    row0, col0 = tile_row * stride, tile_col * stride
    row1, col1 = F.least(row0 + size, F.lit(height)), F.least(col0 + size, F.lit(width))
    return tuple(F.when(inside, v) for v in (west + col0 * res, north - row1 * res, west + col1 * res, north - row0 * res))


def downsample(df: DataFrame, factor: int, offset: int = 0) -> DataFrame:
    return df.where((F.col("row_") % factor == offset) & (F.col("col_") % factor == offset))


def interpolated(df: DataFrame, scale: int, value: str = "v", method: str = "bilinear", shape: tuple[int, int] | None = None) -> DataFrame:
    """scale-fold finer pixels from 2 x 2 (bilinear) or 4 x 4 (cubic, Catmull-Rom) neighbours; missing ones' weight is shared out.

    Each source pixel is sent to the fine pixels that it reaches, a fixed number, and their weighted values are summed.
    shape: rows and columns of the source raster; without it the extent is that of its pixels.
    """
    reach = 1 if method == "bilinear" else 2
    offsets = F.sequence(F.lit(-reach * scale), F.lit((reach + 1) * scale - 1))
    out = df.where(F.col(value).isNotNull()).withColumn("_i", F.explode(offsets)).withColumn("_j", F.explode(offsets))

    def weight(step: Column) -> Column:
        d = F.abs((step + 0.5) / scale - 0.5)
        if method == "bilinear":
            return F.greatest(1 - d, F.lit(0.0))
        return F.when(d < 1, 1.5 * d**3 - 2.5 * d**2 + 1).when(d < 2, -0.5 * d**3 + 2.5 * d**2 - 4 * d + 2).otherwise(0.0)

    w = weight(F.col("_i")) * weight(F.col("_j"))
    out = out.select((F.col("row_") * scale + F.col("_i")).alias("row_"), (F.col("col_") * scale + F.col("_j")).alias("col_"), w.alias("w"), F.col(value)).where("w != 0")
    bounds = df.sparkSession.range(1).select(*(F.lit(x).alias(n) for n, x in (("r0", 0), ("r1", shape[0] - 1), ("c0", 0), ("c1", shape[1] - 1)))) if shape else df.agg(F.min("row_").alias("r0"), F.max("row_").alias("r1"), F.min("col_").alias("c0"), F.max("col_").alias("c1"))
    inside = F.col("row_").between(F.col("r0") * scale, (F.col("r1") + 1) * scale - 1) & F.col("col_").between(F.col("c0") * scale, (F.col("c1") + 1) * scale - 1)
    summed = out.groupBy("row_", "col_").agg(F.sum(F.col("w") * F.col(value)).alias("s"), F.sum("w").alias("w"))
    return summed.join(F.broadcast(bounds), inside).select("row_", "col_", F.when(F.abs("w") > 1e-9, F.col("s") / F.col("w")).alias(value))


def mosaic(tiles: DataFrame, keys: list[str], value: str, order: str, nodata: int) -> DataFrame:
    """The first value in tile order that is not nodata."""
    ok = F.col(value) != nodata
    return tiles.groupBy(*keys).agg(F.coalesce(F.min_by(F.when(ok, F.col(value)), F.when(ok, F.col(order))), F.lit(nodata)).alias(value))


def clip(df: DataFrame, row0: int, row1: int, col0: int, col1: int) -> DataFrame:
    return df.where(F.col("row_").between(row0, row1 - 1) & F.col("col_").between(col0, col1 - 1))


def tiles(df: DataFrame, height: int, width: int, size: int, overlap: int, value: str = "v") -> DataFrame:
    """(tile_row, tile_col, n_pixels, valid_pixels) of overlapping tiles, ragged ones at the edges kept.

    A pixel lies in at most ceil(size / stride) tiles along an axis, so it is sent to those only.
    """
    stride = size - overlap
    if stride <= 0:
        raise ValueError("overlap must be smaller than the tile size")

    def of(axis: str, length: int) -> Column:
        first = F.greatest(F.lit(0), F.floor((F.col(axis) - size) / stride).cast("int") + 1)
        return F.sequence(first, F.least(F.floor(F.col(axis) / stride).cast("int"), F.lit(max(0, (length - 1) // stride))))

    out = df.withColumn("tile_row", F.explode(of("row_", height))).withColumn("tile_col", F.explode(of("col_", width)))
    return out.groupBy("tile_row", "tile_col").agg(F.count("*").alias("n_pixels"), F.count(value).alias("valid_pixels"))


def padded(df: DataFrame, rows: int, cols: int, value: str = "v") -> DataFrame:
    """A full rows x cols grid; cells without a pixel are null."""
    grid = df.sparkSession.range(rows * cols).select(F.expr(f"CAST(id DIV {cols} AS INT)").alias("row_"), F.expr(f"CAST(id % {cols} AS INT)").alias("col_"))
    return grid.join(df.select("row_", "col_", value), ["row_", "col_"], "left")
