"""Exploratory aggregates: shares, bins, gaps, pivots and distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..layers import find_layer


def normalise(df: DataFrame, value: str, low: float = 0.0, high: float = 1.0, fill: float | None = None, clip: bool = True, source: str | None = None) -> DataFrame:
    """The column stretched from its own range to [low, high]; registered layers, constants and empty columns stay as they are."""
    if find_layer(value, source):
        return df
    v = F.when(~F.isnan(value) & (F.lit(True) if fill is None else F.col(value) != fill), F.col(value))
    bounds = F.broadcast(df.agg(F.min(v).alias("_lo"), F.max(v).alias("_hi")))  # one row
    width = F.col("_hi") - F.col("_lo")
    out = F.when(F.abs(width) <= 1e-8, v).otherwise((v - F.col("_lo")) / F.when(F.abs(width) > 1e-8, width) * (high - low) + low)
    return df.crossJoin(bounds).withColumn(value, F.when(v.isNotNull(), F.least(F.greatest(out, F.lit(low)), F.lit(high))) if clip else out).drop("_lo", "_hi")


def share(condition: Column) -> Column:
    return F.count_if(condition) / F.count("*")


def class_bins(value: Column, edges: tuple[float, ...] = (5, 50)) -> Column:
    """'0', '(0,a]', '(a,b]', '>b'; a missing value has no bin."""
    out, low = F.when(value == 0, "0"), "0"
    for e in edges:
        out, low = out.when(value <= e, f"({low},{e:g}]"), f"{e:g}"
    return out.when(value > edges[-1], f">{low}")


def distribution(df: DataFrame, by: list[str], value: str) -> DataFrame:
    v = F.col(value)
    return df.groupBy(*by).agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("lowest"), F.median(v).alias("median"), F.max(v).alias("highest"), F.count_if(v > 0).alias("n_nonzero"), (100 * F.count_if(v > 0) / F.count("*")).alias("pct_nonzero"),
    )


def code_shares(df: DataFrame, by: list[str], code: str) -> DataFrame:
    """Counts and percentages of every code, nodata among them. The totals are an aggregate of the counts, not of the pixels again."""
    counts = df.groupBy(*by, code).agg(F.count("*").alias("n"))
    totals = counts.groupBy(*by).agg(F.sum("n").alias("total")) if by else counts.agg(F.sum("n").alias("total"))
    both = counts.join(totals, by) if by else counts.crossJoin(F.broadcast(totals))
    return both.withColumn("pct", 100 * F.col("n") / F.col("total")).drop("total")


def agreement(a: DataFrame, b: DataFrame, keys: list[str], value: str = "v") -> DataFrame:
    """Jointly valid pixels by class (both, none, a_only, b_only) and their shares."""
    both = a.select(*keys, F.col(value).alias("a")).join(b.select(*keys, F.col(value).alias("b")), keys).where("a IS NOT NULL AND b IS NOT NULL")
    x, y = F.col("a") > 0, F.col("b") > 0
    named = both.select(F.when(x & y, "both").when(x, "a_only").when(y, "b_only").otherwise("none").alias("class"))
    return code_shares(named, [], "class")


def role_gaps(df: DataFrame, by: str, role: Column, day: str) -> DataFrame:
    """Per event: last date before, first date after, their gap in days and whether the order is broken; events with an empty side go."""
    out = df.groupBy(by).agg(F.max(F.when(~role, F.col(day))).alias("last_pre"), F.min(F.when(role, F.col(day))).alias("first_flood")).where("last_pre IS NOT NULL AND first_flood IS NOT NULL")
    return out.withColumn("gap_days", F.datediff("first_flood", "last_pre")).withColumn("broken", F.col("last_pre") >= F.col("first_flood"))


def size_histogram(df: DataFrame, by: list[str], item: str) -> DataFrame:
    """How many groups have each number of distinct items."""
    return df.groupBy(*by).agg(F.countDistinct(item).alias("size")).groupBy("size").agg(F.count("*").alias("n_groups"))


def retention(df: DataFrame, row: str, kind: str, kinds: list[str], value: str) -> DataFrame:
    """Sums by row and kind side by side, and each kind's share of the first one; a zero base gives null."""
    wide = df.groupBy(row).pivot(kind, kinds).agg(F.sum(value))
    base = F.nullif(F.col(f"`{kinds[0]}`"), F.lit(0))
    return wide.select(row, *(F.col(f"`{k}`").alias(f"sum_{k}") for k in kinds), *(F.try_divide(F.col(f"`{k}`"), base).alias(f"kept_{k}") for k in kinds[1:]))


def aligned_codes(a: DataFrame, b: DataFrame, code: str) -> DataFrame:
    """Code frequencies of two sources side by side, 0 where one lacks the code, with percentages."""
    count = lambda df, n: df.groupBy(code).agg(F.count("*").alias(n))
    both = count(a, "n_a").join(count(b, "n_b"), code, "full_outer").fillna(0, ["n_a", "n_b"])
    total = F.broadcast(both.agg(F.sum("n_a").alias("ta"), F.sum("n_b").alias("tb")))
    return both.crossJoin(total).select(code, "n_a", "n_b", (100 * F.col("n_a") / F.col("ta")).alias("pct_a"), (100 * F.col("n_b") / F.col("tb")).alias("pct_b"))
