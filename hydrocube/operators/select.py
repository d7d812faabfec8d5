"""Ranking and selection of dates: peaks, windows, subsamples and completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .order import before, running

PRIORITIES = ("post", "pre", "balanced")


def flood_count(fraction: Column) -> Column:
    """Pixels with flood; a missing value is not one."""
    return F.count_if(F.when(~F.isnan(fraction), fraction) > 0)


def raw_flood(source: str, code: Column, recurring: bool = False) -> Column:
    if source == "viirs":
        return code.between(101, 200)
    if source == "modis":
        return code.isin(*((2, 3) if recurring else (3,)))
    return code == 1


def peak(dates: DataFrame, by: list[str] | None = None, count: str = "n", day: str = "date") -> DataFrame:
    """The date with the highest count in each group, the earliest among equals; dates without a count are no candidates."""
    by = by or []
    best = F.max(F.struct(F.col(count), (-F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))).alias("_early"), F.col(day)))
    return dates.where(F.col(count).isNotNull()).groupBy(*by).agg(best.alias("_x")).select(*by, F.col(f"_x.{day}").alias(day), F.col(f"_x.{count}").alias(count))


def peak_window(dates: DataFrame, before: int, after: int, by: list[str] | None = None, count: str = "n", day: str = "date") -> DataFrame:
    """Dates within the days around the peak; 0 and 0 keep all dates."""
    if before < 0 or after < 0:
        raise ValueError("window days must not be negative")
    dated = dates.where(F.col(day).isNotNull())
    if before == after == 0:
        return dated
    top = peak(dated, by, count, day).select(*(by or []), F.col(day).alias("_peak"))
    joined = dated.join(top, by) if by else dated.crossJoin(F.broadcast(top))  # one row
    return joined.where(F.col(day).between(F.date_sub("_peak", before), F.date_add(F.col("_peak"), after))).drop("_peak")


def subsample(dates: DataFrame, most: int, priority: str = "balanced", by: list[str] | None = None, count: str = "n", day: str = "date") -> DataFrame:
    """At most `most` dates: the peak and then its neighbours by list position; 0 or less keeps all. Without by, dates are bounded by the calendar."""
    if priority not in PRIORITIES:
        raise ValueError(f"unknown priority {priority!r}; known are {PRIORITIES}")
    if most <= 0:
        return dates
    by = by or []
    group = [F.col(c) for c in by] or [F.lit(0)]
    in_order, whole = Window.partitionBy(*group).orderBy(day), Window.partitionBy(*group)
    placed = dates.withColumn("_rn", F.row_number().over(in_order)).withColumn("_top", F.max(F.struct(count, -F.col("_rn"))).over(whole))
    d = F.col("_rn") + F.col("_top.col2")
    keys = {"post": [d < 0, F.abs(d)], "pre": [d > 0, F.abs(d)], "balanced": [F.abs(d), d < 0]}[priority]
    return placed.withColumn("_k", F.row_number().over(Window.partitionBy(*group).orderBy(*keys))).where(F.col("_k") <= most).drop("_rn", "_top", "_k")


def cloud_aware_score(flood: Column, missing: Column, total: Column, least_valid: float = 0.05) -> Column:
    """Flooded share of valid pixels, times the share that is not missing; too few valid ones score minus infinity."""
    valid = total - missing
    low = F.lit(float("-inf"))
    return F.when(total == 0, low).when(valid / total < least_valid, low).otherwise(F.coalesce(flood / F.when(valid > 0, valid), F.lit(0.0)) * (1 - missing / total))


def strategy(dates: DataFrame, name: str, by: list[str] | None = None, count: str = "n", day: str = "date") -> DataFrame:
    """peak: the best date; all: every date; aggregate: one row of the span."""
    if name == "peak":
        return peak(dates, by, count, day)
    if name == "all":
        return dates
    if name == "aggregate":
        return dates.groupBy(*(by or [])).agg(F.min(day).alias("first"), F.max(day).alias("last"), F.count("*").alias("n_dates"), F.sum(count).alias(count))
    raise ValueError(f"unknown strategy {name!r}; known are peak, aggregate, all")


def best_result(results: DataFrame, count: str = "n", order: str = "date") -> DataFrame:
    """The result with the highest positive count, else the first one."""
    return results.orderBy(F.desc(F.when(F.col(count) > 0, F.col(count)).otherwise(0)), F.asc(order)).limit(1)


def row_slice(df: DataFrame, part: str, keys: list[str]) -> DataFrame:
    """Rows start:stop of the sorted table; a malformed or empty range is an error."""
    try:
        start, stop = (int(x) for x in part.split(":"))
    except ValueError as e:
        raise ValueError(f"a slice is start:stop, got {part!r}") from e
    if start < 0 or stop <= start or stop > df.count():
        raise ValueError(f"slice {part!r} is out of range")
    return df.orderBy(*keys).offset(start).limit(stop - start)


def islands(days: DataFrame, by: list[str] | None = None, day: str = "date") -> DataFrame:
    """Runs of consecutive dates: first, last, n_days."""
    by = by or []
    w = Window.partitionBy(*([F.col(c) for c in by] or [F.lit(0)])).orderBy(day)
    run = F.date_sub(F.col(day), F.row_number().over(w))
    return days.select(*by, day).distinct().withColumn("_run", run).groupBy(*by, "_run").agg(F.min(day).alias("first"), F.max(day).alias("last"), F.count("*").alias("n_days")).drop("_run")


def unsorted_spans(axis: DataFrame, index: str = "i", value: str = "t") -> DataFrame:
    """Places of an axis whose value does not exceed the one before, as runs: first, last."""
    broken = before(axis, index, value).where(F.col(value) <= F.col("_before"))
    numbered = running(broken, index, F.lit(1), "_n")
    return numbered.withColumn("_run", F.col(index) - F.col("_n")).groupBy("_run").agg(F.min(index).alias("first"), F.max(index).alias("last")).drop("_run")


def date_states(tasks: DataFrame, by: tuple[str, ...] = ("date",)) -> DataFrame:
    """done if all tasks are, else failed if any is, else pending."""
    done, failed = F.col("status") == "DONE", F.col("status") == "FAILED"
    state = F.when(F.min(F.coalesce(done, F.lit(False))), "done").when(F.max(F.coalesce(failed, F.lit(False))), "failed").otherwise("pending")
    return tasks.groupBy(*by).agg(state.alias("state"), F.count("*").alias("n_tasks"))


def watermark(tasks: DataFrame, day: str = "date") -> DataFrame:
    """The last date before the first one that is not wholly done, as one row; null if there is none.

    The first incomplete date is an aggregate, so no running window over all dates is needed.
    """
    states = tasks.groupBy(day).agg(F.min(F.coalesce(F.col("status") == "DONE", F.lit(False))).alias("_done"))
    first_open = states.agg(F.min(F.when(~F.col("_done"), F.col(day))).alias("_open"))
    return states.crossJoin(F.broadcast(first_open)).agg(F.max(F.when(F.col("_open").isNull() | (F.col(day) < F.col("_open")), F.col(day))).alias("watermark"))


def monthly_state(days: DataFrame) -> DataFrame:
    """A month's state from its days' (state null: not covered)."""
    covered = F.count("state")
    state = F.when(covered == 0, "empty").when(F.count_if(F.col("state") == "done") == covered, "done").when(F.count_if(F.col("state") == "failed") > 0, "failed").otherwise("pending")
    return days.groupBy(F.trunc("date", "month").alias("month")).agg(state.alias("state"), covered.alias("n_days"))


def sample_done(tasks: DataFrame, n: int) -> DataFrame:
    """The first done task of each of the first n dates."""
    return tasks.where("status = 'DONE'").groupBy("date").agg(F.min("task_id").alias("task_id")).orderBy("date").limit(n)


def cap_by_event(tasks: DataFrame, most: int) -> DataFrame:
    """Whole events in order while the running number of tasks stays within `most`."""
    events = running(tasks.groupBy("event_id").agg(F.count("*").alias("n")), "event_id", F.col("n"), "_sum")
    return tasks.join(events.where(F.col("_sum") <= most).select("event_id"), "event_id", "left_semi")


def sample_events(events: DataFrame, bands: int = 3) -> DataFrame:
    """The two smallest, the two largest, and the largest of each latitude band not chosen yet: event_id, pick."""
    small = events.orderBy("area", "event_id").limit(2).withColumn("pick", F.lit("small"))
    large = events.orderBy(F.desc("area"), "event_id").limit(2).withColumn("pick", F.lit("large"))
    chosen = small.unionByName(large).select("event_id")
    edges = events.agg(F.percentile("lat", [k / bands for k in range(1, bands)]).alias("edges"))
    banded = events.crossJoin(F.broadcast(edges)).withColumn("band", F.size(F.filter("edges", lambda e: e < F.col("lat")))).join(chosen, "event_id", "left_anti")
    best = banded.groupBy("band").agg(F.max(F.struct("area", -F.col("event_id"))).alias("x")).select((-F.col("x.col2")).alias("event_id"), F.concat(F.lit("band"), "band").alias("pick"))
    return small.unionByName(large).select("event_id", "pick").unionByName(best)
