"""The datacube: a Parquet table partitioned by source and date, with masked upserts and windowed reads."""

from __future__ import annotations

import json
import uuid
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.grid import COLS, NORTH, RES, ROWS, WEST
from ..operators.select import islands
from ..sources import files as fs

NODATA, SHARD, CHUNK = 255, 2048, 256
KEYS = ["source", "layer", "date", "row_", "col_"]


class ConfigMismatch(ValueError):
    """The cube was made with other settings."""


def masked_upsert(old: DataFrame, new: DataFrame, keys: list[str], value: str = "v", order: str = "seq") -> DataFrame:
    """Valid values overwrite, nodata never does; of several new values the last valid one counts.

    Union and one aggregation with partial sums on the map side: no join, and one shuffle.
    """
    rows = old.select(*keys, value, F.lit(0).alias("_new"), F.lit(0).cast("long").alias(order)).unionByName(new.select(*keys, value, F.lit(1).alias("_new"), F.col(order).cast("long").alias(order)))
    ranked = F.struct((F.col(value) != NODATA).alias("ok"), "_new", order, value)
    return rows.groupBy(*keys).agg(F.max(ranked).alias("_x")).select(*keys, F.col(f"_x.{value}").alias(value))


def prefill(spark: SparkSession, year: int) -> DataFrame:
    """Every day of a year."""
    return spark.sql(f"SELECT explode(sequence(DATE'{year}-01-01', DATE'{year}-12-31')) AS date")


def reindexed(pixels: DataFrame, expected: DataFrame, cells: DataFrame, value: str = "v") -> DataFrame:
    """The cube on the sorted union of its dates and the expected ones; new slots hold nodata. cells: the pixels of the grid in use."""
    axis = pixels.select("date").union(expected.select("date")).distinct()
    days = axis.agg(F.collect_set("date").alias("_days"))  # one row, bounded by the calendar
    grid = cells.crossJoin(F.broadcast(days)).select(*cells.columns, F.explode("_days").alias("date"))
    return grid.join(pixels, ["date", *cells.columns], "left").select("date", *cells.columns, F.coalesce(value, F.lit(NODATA)).alias(value))


def time_slots(pixels: DataFrame) -> DataFrame:
    """(date, slot): slots number the dates in order. The dates are few, so one window over them is bounded by the calendar."""
    from pyspark.sql import Window

    days = pixels.select("date").distinct()
    return days.withColumn("slot", (F.row_number().over(Window.orderBy("date")) - 1).cast("long"))


def fingerprint(**settings) -> str:
    return json.dumps(settings, sort_keys=True)


class Cube:
    """A cube in a folder: <path>/cube partitioned by source and date, and small side tables."""

    def __init__(self, spark: SparkSession, path: str, scale: float = 0.01, epoch: str = "2020-01-01"):
        self.spark, self.path = spark, path.rstrip("/")
        self.config = fingerprint(chunk=CHUNK, shard=SHARD, scale=scale, epoch=epoch)

    def _table(self, name: str, schema: str) -> DataFrame:
        where = f"{self.path}/{name}"
        return self.spark.read.schema(schema).parquet(where) if fs.exists(self.spark, where) else self.spark.createDataFrame([], schema)

    def _check(self) -> None:
        held = self._table("config", "body string").head()
        if held is None:
            self.spark.createDataFrame([(self.config,)], "body string").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/config")
        elif held.body != self.config:
            raise ConfigMismatch(f"the cube has {held.body}, the caller {self.config}")

    def read_all(self) -> DataFrame:
        return self._table("cube", "source string, layer string, date date, row_ int, col_ int, v int")

    def write(self, new: DataFrame) -> None:
        """Upserts (source, layer, date, row_, col_, v, seq): only the touched (source, date) partitions are rewritten.

        The new state of a partition depends on its old files, so it is written
        to a folder of this write first and then over them. The second step is
        whole for each partition, not over all of them; if it breaks off, or
        leaves another number of rows, the staged folder stays and the write can
        be run again, which gives the same state.
        """
        self._check()
        touched = new.select("source", "date").distinct()
        old = self.read_all().join(F.broadcast(touched) if touched.limit(10_001).count() <= 10_000 else touched, ["source", "date"], "left_semi")
        stage = f"{self.path}/_staged-{uuid.uuid4().hex}"
        merged = masked_upsert(old, new, KEYS)
        shard = F.struct(F.floor(F.col("row_") / SHARD), F.floor(F.col("col_") / SHARD), "row_", "col_")
        merged.repartition("source", "date", F.floor(F.col("row_") / SHARD)).sortWithinPartitions("source", "date", shard).write.mode("overwrite").parquet(stage)
        staged = self.spark.read.schema(merged.schema).parquet(stage)
        staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source", "date").parquet(f"{self.path}/cube")
        self.spark.catalog.refreshByPath(f"{self.path}/cube")
        parts = F.broadcast(touched) if touched.limit(10_001).count() <= 10_000 else touched
        there = self.read_all().join(parts, ["source", "date"], "left_semi").count()
        if there != (due := staged.count()):
            raise RuntimeError(f"the cube's partitions hold {there} rows, not {due}; the staged ones are in {stage}")
        fs.delete(self.spark, stage)

    def read(self, source: str, bbox: tuple[float, float, float, float] | None = None, start: str | None = None, end: str | None = None, event: str | None = None, tiles: list[tuple[int, int]] | None = None) -> DataFrame:
        """Decoded pixels of a source: by box and inclusive dates (open ends allowed), by ten-degree tiles (h, v), or by an event's bookmark."""
        if event is not None:
            if bbox or start or end or tiles:
                raise ValueError("an event fixes the box and the dates")
            mark = self.bookmarks().where((F.col("event_id") == event) & (F.col("source") == source)).head()
            if mark is None:
                raise KeyError(f"no bookmark {event!r} for {source!r}")
            out = self.read(source, (mark.west, mark.south, mark.east, mark.north))
            return out.where(F.col("date").isin(list(mark.dates)))
        out = self.read_all().where(F.col("source") == source)
        if start:
            out = out.where(F.col("date") >= F.lit(start).cast("date"))
        if end:
            out = out.where(F.col("date") <= F.lit(end).cast("date"))
        if bbox:
            out = out.where(in_window(*index_window(*bbox)))
        if tiles is not None:
            if bbox:
                raise ValueError("a box and tiles exclude each other")
            side = ROWS // 18
            out = out.where(reduce(or_, (in_window(v * side, (v + 1) * side, h * side, (h + 1) * side) for h, v in tiles), F.lit(False)))
        return out.withColumn("value", F.when(F.col("v") != NODATA, F.col("v") * F.lit(0.01)))

    def bookmarks(self) -> DataFrame:
        return self._table("bookmarks", "event_id string, source string, west double, south double, east double, north double, dates array<date>")

    def bookmark(self, event: str, source: str, bbox: tuple[float, float, float, float], dates: list) -> None:
        """Records an event; its dates are joined with those recorded before."""
        new = self.spark.createDataFrame([(event, source, *map(float, bbox), dates)], self.bookmarks().schema)
        both = self.bookmarks().withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1))).groupBy("event_id", "source")
        rows = both.agg(*(F.max_by(c, "_new").alias(c) for c in ("west", "south", "east", "north")), F.array_sort(F.array_distinct(F.flatten(F.collect_list("dates")))).alias("dates"))
        stage = f"{self.path}/_bookmarks-{uuid.uuid4().hex}"
        rows.coalesce(1).write.parquet(stage)
        fs.swap(self.spark, stage, f"{self.path}/bookmarks")

    def dates(self, source: str) -> DataFrame:
        return self.read_all().where(F.col("source") == source).select("date").distinct()

    def sources(self) -> DataFrame:
        return self.read_all().select("source").distinct()

    def events(self) -> DataFrame:
        """(event_id, sources) of the bookmarks."""
        return self.bookmarks().groupBy("event_id").agg(F.array_sort(F.collect_set("source")).alias("sources"))

    def gaps(self, source: str, year: int) -> DataFrame:
        """Runs of days of the year without data."""
        return islands(prefill(self.spark, year).join(self.dates(source), "date", "left_anti"))


def index_window(west: float, south: float, east: float, north: float) -> tuple[int, int, int, int]:
    """Half-open (row0, row1, col0, col1) of a box, snapped outward and clipped."""
    from math import ceil, floor

    row0, row1 = floor((NORTH - north) / RES + 1e-6), ceil((NORTH - south) / RES - 1e-6)
    col0, col1 = floor((west - WEST) / RES + 1e-6), ceil((east - WEST) / RES - 1e-6)
    return max(row0, 0), min(row1, ROWS), max(col0, 0), min(col1, COLS)


def in_window(row0: int, row1: int, col0: int, col1: int) -> Column:
    return F.col("row_").between(row0, row1 - 1) & F.col("col_").between(col0, col1 - 1)
