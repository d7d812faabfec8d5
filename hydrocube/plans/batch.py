"""Batches of tasks: produce on the executors, write once, then mark as done."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import pending
from ..sources import files
from ..sources.retry import retried
from .cube import Cube
from .tracker import mark

PAYLOAD = "array<struct<layer: string, date: date, row_: int, col_: int, v: int>>"
RESULT = f"task_id string, status string, error string, attempts int, pixels {PAYLOAD}"
TRACKER = "task_id string, status string, attempts int"

#: Layers that each source writes to the cube.
SOURCES = {
    "viirs": ("water_fraction", "flood_fraction", "reference_water", "exclusion_mask"),
    "modis": ("water_fraction", "flood_fraction", "recurring_flood", "exclusion_mask"),
    "gfm": ("water_fraction", "flood_fraction", "reference_water", "exclusion_mask", "advisory_flags", "ensemble_likelihood"),
}


def produced(tasks: DataFrame, produce: Callable[[dict], list[tuple]], attempts: int = 3, wait: float = 1.0) -> DataFrame:
    """RESULT rows: produce(task) -> [(layer, date, row_, col_, v)] on the executors; a task that fails to the last is FAILED with its error.

    produce is any function that can be pickled. A row holds one task's payload.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for task in frame.to_dict("records"):
                tries, pixels, error = 0, [], None

                def call() -> list[tuple]:
                    nonlocal tries
                    tries += 1
                    return produce(task)

                try:
                    pixels = [dict(zip(("layer", "date", "row_", "col_", "v"), p)) for p in retried(call, attempts, wait, on=(Exception,))]
                except Exception as e:  # noqa: BLE001 - the task's own failure is its result
                    error = repr(e)
                yield pd.DataFrame([(str(task["task_id"]), "FAILED" if error else "DONE", error, tries, pixels)], columns=["task_id", "status", "error", "attempts", "pixels"])

    return tasks.mapInPandas(run, RESULT)


def probe(tasks: DataFrame, fetch: Callable[[dict], object]) -> None:
    """Fetches the first pending task's data before a batch starts; what it raises stops the run."""
    first = tasks.orderBy("task_id").limit(1).collect()
    if first:
        try:
            fetch(first[0].asDict())
        except Exception as e:
            raise RuntimeError(f"the probe of {first[0].task_id} failed: {e!r}") from e


def rate_and_eta(done: int, total: int, seconds: float) -> tuple[float, float | None]:
    """(tasks a second, seconds that the rest will take, or None before the first one)."""
    rate = done / seconds if seconds > 0 else 0.0
    return rate, (max(total - done, 0) / rate if rate > 0 else None)


@dataclass
class Tracker:
    """Task states as a table that each batch replaces as a whole."""

    spark: SparkSession
    path: str

    def read(self) -> DataFrame:
        return self.spark.read.schema(TRACKER).parquet(self.path) if files.exists(self.spark, self.path) else self.spark.createDataFrame([], TRACKER)

    def write(self, rows: DataFrame) -> None:
        staged = f"{self.path.rstrip('/')}-{uuid.uuid4().hex}"
        rows.select("task_id", "status", "attempts").write.parquet(staged)
        files.swap(self.spark, staged, self.path, self.spark.read.schema(TRACKER).parquet(staged).count())


def run_batch(tasks: DataFrame, tracker: Tracker, produce: Callable[[dict], list[tuple]], consume: Callable[[DataFrame], None], attempts: int = 3, wait: float = 1.0) -> dict:
    """Produces pending tasks, hands their pixels to consume, and only then marks them: {total, done, failed, rate, eta}.

    Results are written once, so neither consume nor the marks produce a task
    again; a run that breaks off before the marks repeats its tasks.
    """
    todo, began = pending(tasks.withColumn("task_id", F.col("task_id").cast("string")), tracker.read()), time.time()
    stage = f"{tracker.path.rstrip('/')}-results-{uuid.uuid4().hex}"
    produced(todo, produce, attempts, wait).write.parquet(stage)
    results = tracker.spark.read.schema(RESULT).parquet(stage)
    consume(results.where("status = 'DONE'").select("task_id", F.explode("pixels").alias("p")).select("task_id", "p.*"))
    tracker.write(mark(tracker.read(), results.select("task_id", "status", "attempts")))
    n = results.agg(F.count("*").alias("total"), F.count_if(F.col("status") == "DONE").alias("done")).first()
    files.delete(tracker.spark, stage)
    rate, eta = rate_and_eta(n.done, n.total, time.time() - began)
    return {"total": n.total, "done": n.done, "failed": n.total - n.done, "rate": rate, "eta": eta}


def run_cube_batch(source: str, tasks: DataFrame, cube: Cube, tracker: Tracker, produce: Callable[[dict], list[tuple]], layers: tuple[str, ...] | None = None, **more) -> dict:
    """A batch into the cube: the source's layers only; a pixel's later task, by id, wins among valid values."""
    if source not in SOURCES:
        raise ValueError(f"unknown source {source!r}; known are {sorted(SOURCES)}")
    wanted = layers or SOURCES[source]

    def consume(pixels: DataFrame) -> None:
        rows = pixels.where(F.col("layer").isin(*wanted)).withColumn("task", F.struct("task_id"))
        latest = rows.groupBy("layer", "date", "row_", "col_").agg(F.max(F.struct((F.col("v") != 255).alias("ok"), "task_id", "v")).alias("x"))
        cube.write(latest.select(F.lit(source).alias("source"), "layer", "date", "row_", "col_", F.col("x.v").alias("v"), F.lit(1).cast("long").alias("seq")))

    return run_batch(tasks, tracker, produce, consume, **more)
