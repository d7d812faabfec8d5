"""Pixel algebra: raw sensor codes to layers, as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

NODATA = 255
#: The VIIRS codes of each exclusion category, and the categories excluded by default.
VIIRS_CATEGORIES = {"fill": (0, 1), "cloud": (30,), "snow_ice": (20,), "shadow": (50,), "bareland": (16,), "vegetation": (17,)}
VIIRS_DEFAULT = ("fill", "cloud", "snow_ice", "shadow")
VIIRS_WATER, VIIRS_UNQUANTIFIED = 99, 15
MODIS_SURFACE, MODIS_RECURRING, MODIS_UNUSUAL, MODIS_MISSING = 1, 2, 3, 255


def _flag(condition: Column) -> Column:
    return condition.cast("int")


def excluded_codes(categories: Iterable[str] = VIIRS_DEFAULT, extra: Iterable[int] = ()) -> list[int]:
    """The sorted codes of exclusion categories and extra ones; an unknown category is an error."""
    unknown = [c for c in categories if c not in VIIRS_CATEGORIES]
    if unknown:
        raise ValueError(f"unknown exclusion categories {unknown}; known are {sorted(VIIRS_CATEGORIES)}")
    return sorted({code for c in categories for code in VIIRS_CATEGORIES[c]} | set(extra))


def split_list(text: Column) -> Column:
    """The trimmed, non-empty parts of a comma-separated text."""
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")


def viirs_fraction(code: Column, excluded: list[int], water: bool) -> Column:
    """Water or flood fraction. Decoded codes win over the exclusion set, which wins over dry."""
    out = F.when(code.isin(VIIRS_WATER, VIIRS_UNQUANTIFIED), 1.0) if water else F.when(F.lit(False), 0.0)
    out = out.when(code.between(100, 200), (code - 100) / 100.0)
    return out.when(code.isin(excluded), F.lit(None).cast("double")).when(code.isNotNull(), 0.0)


def viirs_mask(code: Column, codes: Iterable[int]) -> Column:
    return _flag(code.isin(list(codes)))


def modis_fraction(code: Column, codes: Iterable[int]) -> Column:
    return F.when(code != MODIS_MISSING, code.isin(list(codes)).cast("double"))


def modis_mask(code: Column, codes: Iterable[int]) -> Column:
    return _flag(code.isin(list(codes)))


def fraction_from_count(part: Column, valid: Column) -> Column:
    return F.when(valid > 0, part / valid)


def valid_or_null(value: Column, nodata: int = NODATA) -> Column:
    return F.when(value != nodata, value)


def encode_percent(fraction: Column) -> Column:
    """[0, 1] to 0..100, half to even, clipped; missing is 255."""
    percent = F.least(F.greatest(F.bround(fraction * 100), F.lit(0.0)), F.lit(100.0))
    return F.when(fraction.isNull() | F.isnan(fraction), NODATA).otherwise(percent.cast("int"))


def decode_percent(value: Column, scale: float = 0.01) -> Column:
    return F.when(value != NODATA, value * F.lit(scale))


def exclusion_from_value(value: Column) -> Column:
    return _flag(value.isNull() | F.isnan(value))


def exclusion_from_quality(quality: Column) -> Column:
    return F.when(quality > 0, 0).otherwise(1)


def reference_water(*candidates: Column) -> Column:
    return F.coalesce(*candidates, F.lit(0)).cast("int")


def legacy_quality(exclusion: Column, cloud_fraction: Column) -> Column:
    """The old mask: usable pixels of a cloudy scene are marked 2."""
    return F.when((exclusion == 0) & (cloud_fraction > 0.1), 2).otherwise(exclusion)


def discovered_nodata(metadata: dict) -> int | None:
    """The first nodata value that a field's metadata declares."""
    return next((int(metadata[k]) for k in ("_FillValue", "nodata", "missing_value", "rio_nodata") if metadata.get(k) is not None), None)


def collapse_legend(code: Column) -> Column:
    return F.when(code.between(101, 200), 100).otherwise(code)
