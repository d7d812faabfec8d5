"""Aggregation over time: nodata-aware reducers as aggregate columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..layers import REGISTRIES


def _missing_as_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def nanmean(value: Column, **_) -> Column:
    return F.avg(_missing_as_null(value.cast("double")))


def mean(value: Column, **_) -> Column:
    return F.avg(value.cast("double"))


def mode(value: Column, **_) -> Column:
    """The commonest value, the lowest among equals; nodata counts as a value."""
    return F.mode(value, True)


def highest(value: Column, **_) -> Column:
    return F.max(value)


def masked_max(value: Column, nodata: int | None = None, **_) -> Column:
    return F.coalesce(F.max(F.when(value != nodata, value)), F.lit(nodata))


def masked_or(value: Column, nodata: int | None = None, **_) -> Column:
    return F.coalesce(F.bit_or(F.when(value != nodata, value)), F.lit(nodata))


def all_true(value: Column, **_) -> Column:
    return F.min((value > 0).cast("int"))


def majority(value: Column, valid: Column | None = None, **_) -> Column:
    """1 where over half of the valid observations are set; none valid gives 0."""
    ok = F.coalesce(valid, F.lit(False))
    return (2 * F.count_if((value > 0) & ok) > F.count_if(ok)).cast("int")


REDUCERS: dict[str, Callable[..., Column]] = {"nanmean": nanmean, "mean": mean, "mode": mode, "max": highest, "masked_max": masked_max, "masked_or": masked_or, "all_true": all_true, "majority": majority}


def reducer(operator: str, value: Column, nodata: int | None = None, valid: Column | None = None) -> Column:
    """The aggregate column of an operator; unknown operators and missing arguments are errors."""
    if operator not in REDUCERS:
        raise ValueError(f"unknown aggregation {operator!r}; known are {sorted(REDUCERS)}")
    if operator in ("masked_max", "masked_or") and nodata is None:
        raise ValueError(f"{operator} needs a nodata value")
    if operator == "majority" and valid is None:
        raise ValueError("majority needs a validity column")
    return REDUCERS[operator](value, nodata=nodata, valid=valid)


def pairwise_max(a: Column, b: Column, nodata: int) -> Column:
    """Of two observations, the higher that is not nodata."""
    return F.coalesce(F.greatest(F.when(a != nodata, a), F.when(b != nodata, b)), F.lit(nodata))


def pairwise_or(a: Column, b: Column, nodata: int) -> Column:
    x, y = F.when(a != nodata, a), F.when(b != nodata, b)
    return F.coalesce(x.bitwiseOR(y), x, y, F.lit(nodata))


def temporal(df: DataFrame, source: str, keys: list[str], layers: list[str], valid: Column | None = None) -> DataFrame:
    """Every layer reduced over time by its declared operator, in one grouping."""
    registry = REGISTRIES[source]
    columns = []
    for name in layers:
        spec = registry.layers[name]
        operator = "mode" if spec.aggregation == "majority" and valid is None else spec.aggregation
        columns.append(reducer(operator, F.col(name), spec.nodata, valid).alias(name))
    return df.groupBy(*keys).agg(*columns)


def mean_cloud_fraction(df: DataFrame, tile: str, cloudy: Column, valid: Column, by: list[str] | None = None) -> DataFrame:
    """The mean over tiles of each one's share of cloudy pixels among its valid ones; a tile without valid pixels counts as 0."""
    each = df.groupBy(*(by or []), tile).agg(F.coalesce(F.count_if(cloudy & valid) / F.nullif(F.count_if(valid), F.lit(0)), F.lit(0.0)).alias("_share"))
    return each.groupBy(*(by or [])).agg(F.avg("_share").alias("cloud_fraction"))


def missing_fraction(reduced: DataFrame, value: Column, by: list[str] | None = None) -> DataFrame:
    """The share of pixels of a reduced raster that stayed without a value, 1 where there are none."""
    return reduced.groupBy(*(by or [])).agg(F.coalesce(1 - F.count(value) / F.nullif(F.count("*"), F.lit(0)), F.lit(1.0)).alias("cloud_fraction"))


def gfm_temporal(df: DataFrame, keys: list[str], native: bool = False) -> DataFrame:
    """GFM layers reduced over time: codes as they come where native, else fractions from summed counts."""
    if native:
        return temporal(df, "gfm", keys, ["ensemble_flood_extent", "reference_water_mask", "advisory_flags", "ensemble_likelihood"])
    out = accumulate(df, keys).withColumnRenamed("reference", "reference_water_mask")
    return REGISTRIES["gfm"].derive_all(out, {n: n for n in ("flood_count", "water_count", "valid_count", "reference_water_mask")}, ["water_fraction", "flood_fraction", "reference_water"])


def accumulate(items: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of item fractions and counts by pixel, highest codes, flags together and likelihood to the nearest percent."""
    nodata = 255
    return items.groupBy(*keys).agg(
        F.sum("flood").alias("flood_count"),
        F.sum("water").alias("water_count"),
        F.sum("valid").alias("valid_count"),
        masked_max(F.col("reference"), nodata).alias("reference"),
        masked_or(F.col("flags"), nodata).alias("flags"),
        F.when(F.count("likelihood") == 0, nodata).otherwise(F.least(F.greatest(F.bround(F.max("likelihood")), F.lit(0.0)), F.lit(100.0)).cast("int")).alias("likelihood"),
    )


def populated_extent(pixels: DataFrame, valid: Column, by: list[str]) -> DataFrame:
    """Row and column bounds of valid pixels."""
    return pixels.where(valid).groupBy(*by).agg(*(f(c).alias(f"{n}_{c}") for c in ("row_", "col_") for f, n in ((F.min, "min"), (F.max, "max"))))
