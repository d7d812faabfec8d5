"""Order-dependent columns over a whole table, without one task that holds it all.

A numeric index is cut into bins of about equal size by quantiles; windows run
within a bin, and what must cross from bin to bin is one row for each bin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS = 64


def _binned(df: DataFrame, index: str, bins: int) -> DataFrame:
    edges = sorted(set(df.approxQuantile(index, [k / bins for k in range(1, bins)], 0.5 / bins))) if bins > 1 else []
    below = sum((F.when(F.col(index) > e, 1).otherwise(0) for e in edges), F.lit(0)) if edges else F.lit(0)
    return df.withColumn("_bin", below)


def before(df: DataFrame, index: str, value: str, name: str = "_before", bins: int = BINS) -> DataFrame:
    """df with the value of the row before, by a numeric index without ties."""
    rows = _binned(df, index, bins)
    last = rows.groupBy("_bin").agg(F.max(F.struct(index, value)).alias("_last"))
    carried = last.select("_bin", F.lag(F.col("_last")[value]).over(Window.orderBy("_bin")).alias("_carried"))  # a row for each bin
    own = F.lag(value).over(Window.partitionBy("_bin").orderBy(index))
    first = F.row_number().over(Window.partitionBy("_bin").orderBy(index)) == 1
    placed = rows.withColumns({"_own": own, "_first": first})
    return placed.join(F.broadcast(carried), "_bin").withColumn(name, F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_own"))).drop("_bin", "_own", "_first", "_carried")


def running(df: DataFrame, index: str, amount: Column, name: str, bins: int = BINS) -> DataFrame:
    """df with the sum of amount over the rows up to each one, by a numeric index without ties; an amount of 1 numbers the rows."""
    rows = _binned(df.withColumn("_amount", amount), index, bins)
    total = rows.groupBy("_bin").agg(F.sum("_amount").alias("_sum"))
    carried = total.select("_bin", F.coalesce(F.sum("_sum").over(Window.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_carried"))  # a row for each bin
    own = F.sum("_amount").over(Window.partitionBy("_bin").orderBy(index))
    return rows.withColumn("_own", own).join(F.broadcast(carried), "_bin").withColumn(name, F.col("_own") + F.col("_carried")).drop("_bin", "_amount", "_own", "_carried")
