"""Fetchers as Spark data sources: a registry of readers, and one over saved listings."""

from __future__ import annotations

from abc import ABC, abstractmethod
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .retry import retried

_FETCHERS: dict[str, type[DataSource]] = {}


def register_fetcher(kind: type[DataSource]) -> type[DataSource]:
    """Adds a data source by its name; a name that is taken is an error."""
    name = kind.name()
    if name in _FETCHERS:
        raise ValueError(f"fetcher {name!r} is registered twice")
    _FETCHERS[name] = kind
    return kind


def get_fetcher(name: str) -> type[DataSource]:
    if name not in _FETCHERS:
        raise KeyError(f"unknown fetcher {name!r}; known are {sorted(_FETCHERS)}")
    return _FETCHERS[name]


def list_fetchers() -> list[str]:
    return sorted(_FETCHERS)


def use_fetchers(spark: SparkSession) -> None:
    """Makes every registered fetcher readable: spark.read.format(name)."""
    for kind in _FETCHERS.values():
        spark.dataSource.register(kind)


class Backend(ABC):
    """Where a source's granules are listed and fetched: what a listing fetcher asks of each backend."""

    @abstractmethod
    def location(self, day: date) -> str:
        """The place of a day's listing."""

    @abstractmethod
    def entries(self, location: str) -> list[str]:
        """The names in a listing."""

    @abstractmethod
    def matching(self, tile: str, entries: list[str]) -> str | None:
        """The name of a tile's granule among a listing's, if it is there."""

    @abstractmethod
    def url(self, location: str, name: str) -> str:
        """Where a granule is fetched from."""

    def years(self) -> set[int] | None:
        """The years that are published, or None where that is not known."""
        return None


def listed(spark: SparkSession, backend: Backend, days: list[date], tiles: list[str], attempts: int = 5, wait: float = 1.0) -> DataFrame:
    """(date, tile, url) of the granules that a backend lists; a day's listing is read once, in one task, with retries."""
    years = backend.years()

    def rows(frames):
        for frame in frames:
            found = []
            for day in frame["day"]:
                place = backend.location(day)
                names = retried(lambda: backend.entries(place), attempts, wait, on=(Exception,))
                found += [(day, t, backend.url(place, n)) for t in tiles if (n := backend.matching(t, names)) is not None]
            yield pd.DataFrame(found, columns=["date", "tile", "url"])

    asked = [(d,) for d in days if years is None or d.year in years]
    return spark.createDataFrame(asked, "day date").repartition(max(1, len(asked)), "day").mapInPandas(rows, "date date, tile string, url string")


@register_fetcher
class CalendarFetcher(DataSource):
    """Expected granules by rule: one row for each date and ten-degree tile, a partition for each date.

    Options: start, end (yyyy-mm-dd), tiles ('h18v04,h19v04'), product.
    """

    @classmethod
    def name(cls) -> str:
        return "granule_calendar"

    def schema(self) -> str:
        return "date string, h int, v int, task_id string, source_uri string"

    def reader(self, schema) -> DataSourceReader:
        return _CalendarReader(self.options)


class _Day(InputPartition):
    def __init__(self, day: str):
        self.day = day


class _CalendarReader(DataSourceReader):
    def __init__(self, options):
        self.options = dict(options)

    def partitions(self):
        from datetime import date, timedelta

        first, last = (date.fromisoformat(self.options[k]) for k in ("start", "end"))
        return [_Day((first + timedelta(days=k)).strftime("%Y%m%d")) for k in range((last - first).days + 1)]

    def read(self, partition):
        product = self.options.get("product", "daily")
        for tile in self.options["tiles"].split(","):
            h, v = int(tile[1:3]), int(tile[4:6])
            yield partition.day, h, v, f"modis-{partition.day}-{tile}", f"{product}/{partition.day}/{tile}.tif"
