"""Catalogue documents: collections by source and items by date, from the cube's populated extents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VERSION = "1.0.0"


def items(pixels: DataFrame, href: str = "cube") -> DataFrame:
    """(id, source, date, west, south, east, north, n_valid) of each source and date with valid pixels (source, date, row_, col_, v)."""
    valid = pixels.where(F.col("v").isNotNull() & (F.col("v") != 255))
    ext = valid.groupBy("source", "date").agg(F.min("row_").alias("r0"), F.max("row_").alias("r1"), F.min("col_").alias("c0"), F.max("col_").alias("c1"), F.count("*").alias("n_valid"))
    six = lambda c: F.bround(c, 6)
    return ext.select(
        F.concat_ws("-", "source", F.date_format("date", "yyyyMMdd")).alias("id"), "source", "date",
        six(-180 + F.col("c0") / 60).alias("west"), six(90 - (F.col("r1") + 1) / 60).alias("south"), six(-180 + (F.col("c1") + 1) / 60).alias("east"), six(90 - F.col("r0") / 60).alias("north"), "n_valid",
    )


def collections(rows: DataFrame) -> DataFrame:
    """(source, extent, interval, n_items) over items."""
    return rows.groupBy("source").agg(F.min("west").alias("west"), F.min("south").alias("south"), F.max("east").alias("east"), F.max("north").alias("north"), F.min("date").alias("first"), F.max("date").alias("last"), F.count("*").alias("n_items"))


def documents(rows: DataFrame, href: str = "cube") -> DataFrame:
    """(id, body): each item as a JSON feature."""
    box = F.array("west", "south", "east", "north")
    ring = F.array(*(F.array(F.col(x), F.col(y)) for x, y in (("west", "south"), ("east", "south"), ("east", "north"), ("west", "north"), ("west", "south"))))
    asset = F.struct(F.concat(F.lit(f"{href}/source="), F.col("source"), F.lit("/date="), F.col("date").cast("string")).alias("href"), F.lit("application/vnd.apache.parquet").alias("type"))
    body = F.struct(
        F.lit("Feature").alias("type"), F.lit(VERSION).alias("stac_version"), F.col("id"), F.col("source").alias("collection"), box.alias("bbox"),
        F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"), F.struct(F.concat(F.col("date").cast("string"), F.lit("T00:00:00Z")).alias("datetime")).alias("properties"), F.struct(asset.alias("data")).alias("assets"),
    )
    return rows.select("id", F.to_json(body).alias("body"))


#: Fixed values of the SAR extension for these scenes.
SAR = {"sar:instrument_mode": "IW", "sar:frequency_band": "C", "sar:center_frequency": 5.405, "sar:product_type": "GRD", "sar:observation_direction": "right"}


def sar_properties(patches: DataFrame, polarisations: dict[str, str]) -> DataFrame:
    """patches with a map of SAR properties; their polarisations are those that the band names (bands: array<string>) stand for, in the dictionary's order."""
    have = F.array(*(F.when(F.array_contains("bands", band), F.lit(name)) for band, name in polarisations.items()))
    fixed = [x for k, v in SAR.items() for x in (F.lit(k), F.lit(str(v)))]
    return patches.withColumn("properties", F.map_concat(F.create_map(*fixed), F.create_map(F.lit("sar:polarizations"), F.array_join(F.filter(have, lambda x: x.isNotNull()), ","))))


def write_catalogue(rows: DataFrame, uri: str) -> None:
    documents(rows).write.mode("overwrite").json(uri)


def write_index(rows: DataFrame, uri: str, href: str | None = None) -> None:
    """Items as Parquet, with the href of their cube; an index without items is an error."""
    if rows.limit(1).count() == 0:
        raise ValueError("there are no items to export")
    (rows.withColumn("href", F.lit(href)) if href else rows).write.mode("overwrite").parquet(uri)


def scenes(patches: DataFrame) -> DataFrame:
    """Scenes of an activation by source date: the union of JSON id lists, sorted, and total bounds."""
    ids = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.from_json("ids", "array<string>")))))
    return patches.groupBy("source_date").agg(ids.alias("ids"), F.min("west").alias("west"), F.min("south").alias("south"), F.max("east").alias("east"), F.max("north").alias("north"))


def with_assets(rows: DataFrame, keys: DataFrame, names: tuple[str, ...] = ("mask", "dem", "info")) -> DataFrame:
    """rows (prefix) with the assets whose key exists."""
    have = keys.groupBy(F.regexp_extract("key", r"^(.*/)[^/]+$", 1).alias("prefix")).agg(F.collect_set("key").alias("_keys"))
    wanted = F.array(*(F.struct(F.lit(n).alias("name"), F.concat("prefix", F.lit(f"{n}.json" if n == "info" else f"{n}.tif")).alias("key")) for n in names))
    return rows.join(have, "prefix").withColumn("assets", F.filter(wanted, lambda a: F.array_contains("_keys", a["key"]))).drop("_keys")
