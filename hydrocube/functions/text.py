"""Names, dates, locators and nested cells, as column expressions."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH = date(2020, 1, 1)


def tile_of_name(name: Column) -> tuple[Column, Column]:
    """(h, v) of a file name with .hNNvNN. in it."""
    part = lambda k: F.regexp_extract(name, r"\.h(\d{2})v(\d{2})\.", k)
    number = lambda k: F.when(part(k) != "", part(k).cast("int"))
    return number(1), number(2)


def production_stamp(name: Column) -> Column:
    found = F.regexp_extract(name, r"\.(\d{13})\.", 1)
    return F.when(found != "", found)


def area_of_name(name: Column) -> Column:
    """The area number of a GLBnnn_ file name."""
    found = F.regexp_extract(name, r"GLB(\d{3})_", 1)
    return F.when(found != "", found.cast("int"))


def date_of_name(name: Column) -> Column:
    """The first run of eight digits that is a date."""
    found = F.regexp_extract(name, r"(\d{8})", 1)
    return F.when(found != "", F.try_to_timestamp(found, F.lit("yyyyMMdd")).cast("date"))


def date_of_token(token: Column) -> Column:
    """yyyymmdd as a date; other tokens give null."""
    return F.when(token.rlike(r"^\d{8}$"), F.try_to_timestamp(token, F.lit("yyyyMMdd")).cast("date"))


def days_since(day: Column, epoch: date = EPOCH) -> Column:
    return F.datediff(day, F.lit(epoch)).cast("long")


def day_at(days: Column, epoch: date = EPOCH) -> Column:
    return F.date_add(F.lit(epoch), days.cast("int"))


def epoch_units(epoch: date = EPOCH) -> str:
    return f"days since {epoch.isoformat()}"


def modis_task_id(day: Column, h: Column, v: Column) -> Column:
    return F.format_string("modis-%s-h%02dv%02d", F.date_format(day, "yyyyMMdd"), h, v)


def gfm_task_id(day: Column, tile: Column) -> Column:
    return F.concat(F.lit("gfm-"), F.date_format(day, "yyyyMMdd"), F.lit("-"), F.regexp_replace(tile, "[^A-Za-z0-9_]", ""))


def listing_path(product: str, day: Column) -> Column:
    """product/year/day of year."""
    return F.concat_ws("/", F.lit(product), F.date_format(day, "yyyy"), F.lpad(F.dayofyear(day).cast("string"), 3, "0"))


def valid_tile_id(tile: Column) -> Column:
    return F.coalesce(tile.rlike("^[A-Z0-9_]{4,32}$"), F.lit(False))


def cache_key(url: Column) -> Column:
    """md5 of a URL with its suffix."""
    return F.concat(F.md5(url), F.regexp_extract(F.regexp_replace(url, r"[?#].*$", ""), r"(\.[A-Za-z0-9]+)$", 1))


def list_cell(text: Column) -> Column:
    """A legacy comma-joined cell as an array; null gives an empty one."""
    return F.coalesce(F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != ""), F.array().cast("array<string>"))


def polygon(west: Column, south: Column, east: Column, north: Column) -> Column:
    """A box as GeoJSON, counter-clockwise."""
    ring = F.array(F.array(west, south), F.array(east, south), F.array(east, north), F.array(west, north), F.array(west, south))
    return F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")))


def from_mercator(x: Column, y: Column, radius: float = 6378137.0) -> tuple[Column, Column]:
    """(lon, lat) in degrees of spherical web-mercator metres."""
    return F.degrees(x / radius), F.degrees(2 * F.atan(F.exp(y / radius)) - F.lit(3.141592653589793 / 2))


def wkt_points(wkt: Column) -> Column:
    """The coordinate pairs of a WKT text as array<array<double>>."""
    return F.transform(F.regexp_extract_all(wkt, F.lit(r"(-?[0-9.]+ -?[0-9.]+)"), 1), lambda p: F.transform(F.split(p, " "), lambda v: v.cast("double")))


def asset_key(href: Column) -> Column:
    """The file stem of an asset's href."""
    return F.regexp_extract(href, r"([^/]+?)(?:\.[A-Za-z0-9]+)?$", 1)


def prefill_year(path: Column) -> Column:
    found = F.regexp_extract(F.regexp_replace(path, "/+$", ""), r"(?:^|/)zarr/(\d{4})$", 1)
    return F.when(found != "", found.cast("int"))


def memory_bytes(text: Column) -> Column:
    """'12GB' or '2500 MB' as bytes; other texts give null."""
    clean, pattern = F.trim(text), r"(?i)^(\d+(?:\.\d+)?)\s*(B|KB|MB|GB|TB)?$"
    unit = F.upper(F.regexp_extract(clean, pattern, 2))
    power = F.when(unit == "KB", 1e3).when(unit == "MB", 1e6).when(unit == "GB", 1e9).when(unit == "TB", 1e12).otherwise(1.0)
    return F.when(clean.rlike(pattern), (F.regexp_extract(clean, pattern, 1).try_cast("double") * power).cast("long"))


def parse_bbox(text: str) -> tuple[float, float, float, float]:
    parts = re.split(r"[,\s]+", text.strip())
    if len(parts) != 4:
        raise ValueError("a box is four numbers: west south east north")
    west, south, east, north = map(float, parts)
    return west, south, east, north


def days_between(df: DataFrame, start: str, end: str, name: str = "date") -> DataFrame:
    """A row for each day from start to end, both included; none if they are reversed."""
    fine = F.col(end) >= F.col(start)
    return df.where(fine).withColumn(name, F.explode(F.sequence(F.col(start), F.col(end))))


def sampled_days(df: DataFrame, start: str, end: str, most: int, name: str = "date") -> DataFrame:
    """At most `most` evenly spaced days of each row's span, both ends among them."""
    span = F.datediff(F.col(end), F.col(start))
    count = F.least(F.lit(most), span + 1)
    at = F.array_distinct(F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.when(count > 1, F.floor(i * span / F.greatest(count - 1, F.lit(1)))).otherwise(0).cast("int")))
    return df.where(F.col(end) >= F.col(start)).withColumn("_at", F.explode(at)).withColumn(name, F.expr(f"date_add({start}, _at)")).drop("_at")
