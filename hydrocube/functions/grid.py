"""The canonical one-minute grid: windows, blocks, tiles and box predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RES = 1.0 / 60.0
WEST, NORTH, ROWS, COLS = -180.0, 90.0, 10800, 21600


def _in_range(west: Column, south: Column, east: Column, north: Column) -> Column:
    fine = lambda c, top: c.isNotNull() & ~F.isnan(c) & c.between(-top, top)
    return fine(west, 180) & fine(east, 180) & fine(south, 90) & fine(north, 90)


def valid_bbox(west: Column, south: Column, east: Column, north: Column) -> Column:
    """Finite, in range and ordered; a box may be a line or a point, and none may cross the dateline."""
    return _in_range(west, south, east, north) & (west <= east) & (south <= north)


def valid_event(west: Column, south: Column, east: Column, north: Column, start: Column, end: Column) -> Column:
    """A valid box, or one that crosses the dateline from the east to the west half, and dates that do not run backwards."""
    crossing = (west > 0) & (east < 0)
    return _in_range(west, south, east, north) & ((west <= east) | crossing) & (south <= north) & F.coalesce(end >= start, F.lit(False))


def meets_closed(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Boxes (west, south, east, north) that share a point, edges included."""
    return (a[0] <= b[2]) & (b[0] <= a[2]) & (a[1] <= b[3]) & (b[1] <= a[3])


def meets_open(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Boxes that share an area."""
    return (a[0] < b[2]) & (b[0] < a[2]) & (a[1] < b[3]) & (b[1] < a[3])


def bbox_area(west: Column, south: Column, east: Column, north: Column) -> Column:
    return (east - west) * (north - south)


def snapped(west: Column, south: Column, east: Column, north: Column) -> tuple[Column, ...]:
    """Bounds moved outward to grid lines and clipped to the globe."""
    low = lambda c, origin: F.floor((c - origin) / F.lit(RES)).cast("double") * F.lit(RES) + origin
    high = lambda c, origin: F.ceil((c - origin) / F.lit(RES)).cast("double") * F.lit(RES) + origin
    return F.greatest(low(west, -180.0), F.lit(-180.0)), F.greatest(low(south, -90.0), F.lit(-90.0)), F.least(high(east, -180.0), F.lit(180.0)), F.least(high(north, -90.0), F.lit(90.0))


def trimmed(snap: tuple[Column, ...], raw: tuple[Column, ...], res: float = RES) -> tuple[Column, ...]:
    """Snapped bounds less one cell on each side that snapping moved, unless an axis would vanish."""
    tol = res * 1e-6
    west, south, east, north = snap
    w = F.when(west < raw[0] - tol, west + res).otherwise(west)
    e = F.when(east > raw[2] + tol, east - res).otherwise(east)
    n = F.when(north > raw[3] + tol, north - res).otherwise(north)
    s = F.when(south < raw[1] - tol, south + res).otherwise(south)
    return F.when(w < e, w).otherwise(west), F.when(s < n, s).otherwise(south), F.when(w < e, e).otherwise(east), F.when(s < n, n).otherwise(north)


def window(west: Column, south: Column, east: Column, north: Column) -> tuple[Column, ...]:
    """Half-open (row0, row1, col0, col1) of snapped bounds."""
    at = lambda v: F.bround(v / F.lit(RES)).cast("int")
    return at(F.lit(NORTH) - north), at(F.lit(NORTH) - south), at(west - F.lit(WEST)), at(east - F.lit(WEST))


def centre(row: Column, col: Column) -> tuple[Column, Column]:
    """(x, y) of a pixel's centre."""
    return F.lit(WEST) + (col + 0.5) / 60, F.lit(NORTH) - (row + 0.5) / 60


def aligned(x: Column, y: Column, tolerance: float = 1e-6) -> Column:
    """Whether an upper-left pixel edge lies on the grid."""
    a, b = (x - WEST) / F.lit(RES), (F.lit(NORTH) - y) / F.lit(RES)
    return (F.abs(a - F.bround(a)) <= tolerance) & (F.abs(b - F.bround(b)) <= tolerance)


def blocks(boxes: DataFrame, size: int = 512) -> DataFrame:
    """boxes (row0, row1, col0, col1) with a row for each block that covers them: block_row, block_col, block_id."""
    last = lambda c: F.floor((F.col(c) - 1) / size).cast("int")
    first = lambda c: F.floor(F.col(c) / size).cast("int")
    out = boxes.withColumn("block_row", F.explode(F.sequence(first("row0"), last("row1")))).withColumn("block_col", F.explode(F.sequence(first("col0"), last("col1"))))
    return out.withColumn("block_id", F.format_string(f"a{size}_r%02dc%03d", "block_row", "block_col"))


def modis_tiles(boxes: DataFrame) -> DataFrame:
    """boxes (west, south, east, north) with a row for each ten-degree tile (h, v); boxes across the dateline give none."""
    step = lambda c, top: F.least(F.greatest(F.floor(c / 10).cast("int"), F.lit(0)), F.lit(top))
    whole = boxes.where((F.col("west") <= F.col("east")) & (F.col("south") <= F.col("north")))
    out = whole.withColumn("h", F.explode(F.sequence(step(F.col("west") + 180, 35), step(F.col("east") + 180, 35))))
    return out.withColumn("v", F.explode(F.sequence(step(90 - F.col("north"), 17), step(90 - F.col("south"), 17))))


def tile_bounds(h: Column, v: Column) -> tuple[Column, ...]:
    """(west, south, east, north) of a ten-degree tile."""
    return h * 10.0 - 180, 80 - v * 10.0, h * 10.0 - 170, 90 - v * 10.0


def subdomains(boxes: DataFrame, degrees: float) -> DataFrame:
    """boxes cut into cells of fixed size: sub_west, sub_south, sub_east, sub_north, clipped to the box."""
    steps = lambda a, b: F.sequence(F.lit(0), F.greatest(F.ceil((F.col(b) - F.col(a)) / degrees).cast("int") - 1, F.lit(0)))
    out = boxes.withColumn("i", F.explode(steps("west", "east"))).withColumn("j", F.explode(steps("south", "north")))
    west, south = F.col("west") + F.col("i") * degrees, F.col("south") + F.col("j") * degrees
    return out.select(*boxes.columns, west.alias("sub_west"), south.alias("sub_south"), F.least(west + degrees, F.col("east")).alias("sub_east"), F.least(south + degrees, F.col("north")).alias("sub_north"))


def native_windows(length: int, size: int, factor: int, phase: int = 0) -> list[tuple[int, int]]:
    """Gap-free windows over an axis whose bounds fall at `phase` modulo `factor`; outer ones may overshoot to complete a group."""
    if factor < 1:
        raise ValueError(f"factor must be positive, got {factor}")
    if size <= 0 or size % factor:
        raise ValueError(f"size {size} must be a positive multiple of factor {factor}")
    first = phase % factor - factor if phase % factor else 0
    end = length + (first - length) % factor
    return [(s, min(s + size, end)) for s in range(first, end, size)] if length > 0 else []


def group_of(index: Column, factor: int, phase: int = 0) -> Column:
    """The coarse cell of a native index under a phase."""
    return F.floor((index - phase) / factor).cast("int")
