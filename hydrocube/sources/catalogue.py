"""Catalogue, metadata and listing sources, and the sinks beside them."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import date

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import require_columns, schema
from . import files
from .retry import retried

POINTER = "version https://git-lfs"


def load_catalogue(spark: SparkSession, uri: str, source: str | None = None) -> DataFrame:
    """A Parquet catalogue by URI; with a source its declared columns are read and nothing else."""
    return spark.read.schema(schema(f"{source}_catalogue")).parquet(uri) if source else spark.read.parquet(uri)


def write_catalogue(df: DataFrame, uri: str) -> None:
    df.write.mode("overwrite").parquet(uri)


def load_metadata(spark: SparkSession, uri: str, needed: list[str], dates: tuple[str, ...] = ("date_start", "date_end"), order: str | None = None) -> DataFrame:
    """A CSV table with a header, its dates parsed, required columns checked."""
    df = require_columns(spark.read.option("header", True).csv(uri), needed, uri)
    for d in dates:
        df = df.withColumn(d, F.try_to_timestamp(d, F.lit("yyyy-MM-dd")).cast("date"))
    return df.orderBy(order) if order else df


def write_metadata(df: DataFrame, uri: str) -> None:
    """One CSV file with a header; metadata tables have a row for each event."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(uri)


def reject_pointer(spark: SparkSession, uri: str) -> str:
    """uri, or an error if the file is only a large-file pointer."""
    first = spark.read.text(uri).limit(1).collect()
    if first and first[0].value.startswith(POINTER):
        raise ValueError(f"{uri} is a large-file pointer: fetch the file itself")
    return uri


def load_bookmarks(spark: SparkSession, uri: str) -> DataFrame:
    """Bookmarks, or an empty typed table where there is no file."""
    return spark.read.schema(schema("bookmarks")).parquet(uri) if files.exists(spark, uri) else spark.createDataFrame([], schema("bookmarks"))


def add_bookmark(bookmarks: DataFrame, new: DataFrame, overwrite: bool = False) -> DataFrame:
    """bookmarks with the new rows; an event that is there already is an error unless it is to be overwritten."""
    if not overwrite and bookmarks.join(new.select("event_id"), "event_id", "left_semi").limit(1).count():
        raise ValueError("a bookmark of that event exists")
    return remove_bookmark(bookmarks, new.select("event_id")).unionByName(new)


def remove_bookmark(bookmarks: DataFrame, events: DataFrame) -> DataFrame:
    return bookmarks.join(events.select("event_id"), "event_id", "left_anti")


def listing_names(body: Column) -> Column:
    """File names of a JSON listing in either shape: {content: [{name}]} or {items: [{name}]}; other texts give none."""
    parsed = F.from_json(body, "content array<struct<name:string>>, items array<struct<name:string>>")
    return F.coalesce(F.transform(F.coalesce(parsed["content"], parsed["items"]), lambda x: x["name"]), F.array().cast("array<string>"))


def href_names(html: Column) -> Column:
    """Distinct link targets of an HTML listing."""
    return F.array_distinct(F.regexp_extract_all(html, F.lit(r'(?i)href="([^"]+)"'), 1))


def xml_keys(xml: Column) -> Column:
    """Object keys of an S3 listing."""
    return F.xpath(xml, F.lit("//Key/text()"))


def xml_years(xml: Column) -> Column:
    """Four-digit years among an S3 listing's common prefixes."""
    found = F.xpath(xml, F.lit("//CommonPrefixes/Prefix/text()"))
    return F.array_sort(F.array_distinct(F.transform(F.filter(found, lambda p: p.rlike(r"(^|/)\d{4}/$")), lambda p: F.regexp_extract(p, r"(\d{4})/$", 1).cast("int"))))


def box_of_wkb(wkb: Column) -> Column:
    """(west, south, east, north) of a WKB polygon or multipolygon in either byte order, without a geometry library."""
    def bounds(data: bytes | None):
        if data is None:
            return None
        points: list[np.ndarray] = []

        def walk(at: int) -> int:
            order = "<" if data[at] == 1 else ">"
            kind, count = np.frombuffer(data, order + "u4", 2, at + 1)
            at += 9
            if kind % 1000 == 3:
                for _ in range(count):
                    n = int(np.frombuffer(data, order + "u4", 1, at)[0])
                    points.append(np.frombuffer(data, order + "f8", 2 * n, at + 4).reshape(-1, 2))
                    at += 4 + 16 * n
            elif kind % 1000 == 6:
                for _ in range(count):
                    at = walk(at)
            else:
                raise ValueError(f"WKB kind {kind} is not a polygon")
            return at

        walk(0)
        xy = np.concatenate(points)
        return {"west": xy[:, 0].min(), "south": xy[:, 1].min(), "east": xy[:, 0].max(), "north": xy[:, 1].max()}

    @F.pandas_udf("struct<west: double, south: double, east: double, north: double>")
    def box(column: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([bounds(x) or dict.fromkeys(("west", "south", "east", "north")) for x in column], columns=["west", "south", "east", "north"])

    return box(wkb)


def scan_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """Files under <folder>/<event>/<source>/ as a summary: event, sources, n_files, dates."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    parts = F.split("path", "/")
    named = files.select(F.element_at(parts, -3).alias("event"), F.element_at(parts, -2).alias("source"), F.regexp_extract("path", r"(\d{8})[^/]*$", 1).alias("day"))
    return named.groupBy("event").agg(F.array_sort(F.collect_set("source")).alias("sources"), F.count("*").alias("n_files"), F.array_sort(F.collect_set(F.when(F.col("day") != "", F.col("day")))).alias("dates"))


def write_manifest(spark: SparkSession, uri: str, run_id: str, body: dict) -> str:
    """An immutable JSON manifest; a name that is taken gets -2, -3 and so on."""
    name, k = run_id, 1
    while files.exists(spark, f"{uri.rstrip('/')}/{name}.json"):
        k += 1
        name = f"{run_id}-{k}"
    files.write_text(spark, f"{uri.rstrip('/')}/{name}.json", json.dumps(body, sort_keys=True, default=str))
    return f"{name}.json"


def save_bookmarks(bookmarks: DataFrame, uri: str) -> None:
    """Replaces the bookmarks as a whole, once the new ones are written."""
    spark, staged = bookmarks.sparkSession, f"{uri.rstrip('/')}-{uuid.uuid4().hex}"
    bookmarks.coalesce(1).write.parquet(staged)
    files.swap(spark, staged, uri, spark.read.parquet(staged).count())


def scan_patches(spark: SparkSession, uri: str) -> DataFrame:
    """A patch catalogue, exported to Parquet; a pointer in its place is an error."""
    for name in files.names(spark, uri):
        if name.endswith(".parquet"):
            reject_pointer(spark, f"{uri.rstrip('/')}/{name}")
    return spark.read.parquet(uri)


def search_day(spark: SparkSession, search: Callable[[date], list[dict]], days: list[date], attempts: int = 5, wait: float = 1.0) -> DataFrame:
    """Rows of the gfm catalogue for whole days of an item API, one task a day, with retries; items without a tile or a box are left out.

    search(day) gives STAC items as dictionaries; it is pickled to the executors.
    """

    form = schema("gfm_catalogue")
    names = form.names

    def rows(frames):
        for frame in frames:
            for day in frame["day"]:
                found = []
                for item in retried(lambda: search(day), attempts, wait, on=(Exception,)):
                    tile, box = (item.get("properties") or {}).get("Equi7Tile"), item.get("bbox")
                    if tile and box:
                        found.append((day.isoformat(), tile, item["id"], item.get("href"), *map(float, box[:4])))
                yield pd.DataFrame(found, columns=names)

    asked = spark.createDataFrame([(d,) for d in days], "day date").repartition(max(len(days), 1), "day")
    return asked.mapInPandas(rows, form)


def zip_members(spark: SparkSession, uri: str, suffix: str = ".tif") -> DataFrame:
    """(path, member, content): the first member of each archive under a folder whose name ends so, by name."""
    import io
    import zipfile

    def rows(frames):
        for frame in frames:
            out = []
            for path, content in zip(frame["path"], frame["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    named = sorted(n for n in z.namelist() if n.lower().endswith(suffix))
                    if not named:
                        raise FileNotFoundError(f"{path} holds no {suffix} member")
                    out.append((path, named[0], z.read(named[0])))
            yield pd.DataFrame(out, columns=["path", "member", "content"])

    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", True).load(uri)
    return found.select("path", "content").mapInPandas(rows, "path string, member string, content binary")


def open_indexed(spark: SparkSession, index: str, item: str) -> DataFrame:
    """The pixels of an index's item, read by its source and date from the cube that its href names."""
    rows = spark.read.parquet(index).where(F.col("id") == item).limit(2).collect()
    if len(rows) != 1:
        raise KeyError(f"the index holds {len(rows) or 'no'} items {item!r}")
    row = rows[0]
    return spark.read.parquet(row.href).where((F.col("source") == row.source) & (F.col("date") == F.lit(row.date)))
