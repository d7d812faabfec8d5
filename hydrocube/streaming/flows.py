"""Streaming flows: cube upserts by micro-batch, and dates released in order."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..plans.cube import Cube


def upsert_stream(new: DataFrame, cube: Cube, checkpoint: str) -> StreamingQuery:
    """Writes a stream of (source, layer, date, row_, col_, v, seq) into a cube, all that is there, then stops.

    The driver is the single writer. Replaying a batch writes the same state,
    as an upsert by seq is idempotent.
    """
    return new.writeStream.foreachBatch(lambda batch, _: cube.write(batch)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def track_stream(results: DataFrame, consume: Callable[[DataFrame], None], mark: Callable[[DataFrame], None], checkpoint: str) -> StreamingQuery:
    """Consumes each batch and only then marks its tasks done."""

    def step(batch: DataFrame, _: int) -> None:
        consume(batch)
        mark(batch.select("task_id"))

    return results.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _first_open(tasks: DataFrame) -> DataFrame:
    """One row: the first date with a task that is neither done nor failed, or null."""
    return tasks.agg(F.min(F.when(~F.coalesce(F.col("status").isin("DONE", "FAILED"), F.lit(False)), F.col("date"))).alias("_open"))


def released(tasks: DataFrame) -> DataFrame:
    """Batch form of ordered release: done tasks of dates before which every date is settled, all its tasks done or failed."""
    first = F.broadcast(_first_open(tasks))  # one row
    return tasks.crossJoin(first).where((F.col("status") == "DONE") & (F.col("_open").isNull() | (F.col("date") <= F.col("_open")))).drop("_open")


def drained(tasks: DataFrame) -> DataFrame:
    """What a run's end releases besides: done tasks behind a date that never settled, to be taken in the order of dates."""
    return tasks.crossJoin(F.broadcast(_first_open(tasks))).where((F.col("status") == "DONE") & (F.col("date") > F.col("_open"))).drop("_open")


def ordered_release(results: DataFrame, expected: dict[str, list[str]]) -> DataFrame:
    """Streaming form: done tasks of a stream (run, date, task_id, status), each once all earlier expected dates are settled.

    expected: the run's dates and their task ids; other tasks are passed over. A
    task that is retried, or replayed, counts once, and is released once, even
    where a later failure arrives. State holds ids of the run's tasks and no more.
    """
    days = sorted(expected)
    known = {task: day for day, tasks in expected.items() for task in tasks}

    def step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        at, seen, held, gone = json.loads(state.get[0]) if state.exists else (0, {}, {}, {})
        for f in frames:
            for task, status in zip(f["task_id"], f["status"]):
                day = known.get(task)
                if day is None or status not in ("DONE", "FAILED"):
                    continue
                if status == "DONE" and task not in gone.get(day, ()):
                    held.setdefault(day, {})[task] = 1
                if days.index(day) >= at:
                    seen.setdefault(day, {})[task] = 1
        while at < len(days) and len(seen.get(days[at], ())) >= len(set(expected[days[at]])):
            seen.pop(days[at], None)
            at += 1
        free = sorted(d for d in held if at >= len(days) or d <= days[at])
        out = [(key[0], day, task) for day in free for task in sorted(held[day])]
        for day in free:
            gone.setdefault(day, {}).update(held.pop(day))
        state.update((json.dumps((at, seen, held, gone)),))
        yield pd.DataFrame(out, columns=["run", "date", "task_id"])

    return results.groupBy("run").applyInPandasWithState(step, "run string, date string, task_id string", "body string", "append", GroupStateTimeout.NoTimeout)


def windowed_counts(events: DataFrame, window: str = "1 day", late: str = "2 days") -> DataFrame:
    """Ours, not the reference's: events by tumbling window and type, under a watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
