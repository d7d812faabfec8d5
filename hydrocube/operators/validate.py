"""Raster parity, domain checks and skill scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NODATA = 255
#: The acceptance limits of a raster comparison.
LIMITS = {"overlap_ratio": 0.95, "mismatch_ratio": 0.03, "mean_abs_diff": 0.5, "active_recall": 0.30}
#: The codes that each layer may hold besides nodata.
DOMAINS: dict[str, tuple[int, ...] | None] = {"flood_fraction": tuple(range(101)), "water_fraction": tuple(range(101)), "ensemble_likelihood": tuple(range(101)), "reference_water": (0, 1, 2), "reference_water_mask": (0, 1, 2), "ensemble_flood_extent": (0, 1)}


def compare_rasters(a: DataFrame, b: DataFrame, keys: list[str], value: str = "v") -> DataFrame:
    """One row: overlap, mismatch, mean difference and recall of active pixels, nodata read as 0, and whether all limits hold."""
    clean = lambda df, n: df.select(*keys, F.when(F.col(value) != NODATA, F.col(value)).otherwise(0).alias(n))
    both = clean(a, "a").join(clean(b, "b"), keys, "full_outer")
    joint = F.col("a").isNotNull() & F.col("b").isNotNull()
    n = F.count_if(joint)
    active = F.count_if(joint & (F.col("a") > 0))
    out = both.agg(
        (n / F.greatest(F.least(F.count("a"), F.count("b")), F.lit(1))).alias("overlap_ratio"),
        F.avg(F.when(joint, (F.col("a") != F.col("b")).cast("double"))).alias("mismatch_ratio"),
        F.avg(F.when(joint, F.abs(F.col("a") - F.col("b")).cast("double"))).alias("mean_abs_diff"),
        F.coalesce(F.count_if(joint & (F.col("a") > 0) & (F.col("b") > 0)) / F.when(active > 0, active), F.lit(1.0)).alias("active_recall"),
    )
    passed = (F.col("overlap_ratio") >= LIMITS["overlap_ratio"]) & (F.col("mismatch_ratio") <= LIMITS["mismatch_ratio"]) & (F.col("mean_abs_diff") <= LIMITS["mean_abs_diff"]) & (F.col("active_recall") >= LIMITS["active_recall"])
    return out.withColumn("passed", F.coalesce(passed, F.lit(False)))


def in_domain(layer: str, value: Column) -> Column:
    """Whether all values but nodata are in the layer's domain; layers without one pass."""
    allowed = DOMAINS.get(layer)
    return F.lit(True) if allowed is None else F.coalesce(F.bool_and(F.when(value != NODATA, value.isin(list(allowed)))), F.lit(True))


def raster_stats(df: DataFrame, by: list[str], value: str = "v") -> DataFrame:
    v = F.when(F.col(value) != NODATA, F.col(value))
    return df.groupBy(*by).agg(F.count("*").alias("total"), F.count(v).alias("valid"), F.count_if(F.col(value) == NODATA).alias("nodata"), F.count_if(v == 0).alias("zero"), F.count_if(v > 0).alias("positive"), F.min(v).alias("lowest"), F.max(v).alias("highest"), F.countDistinct(v).alias("distinct_values"))


def report(checks: list[DataFrame]) -> DataFrame:
    """Check rows (name, passed, required) with the verdict over the required ones."""
    rows = checks[0]
    for c in checks[1:]:
        rows = rows.unionByName(c)
    verdict = rows.agg(F.coalesce(F.bool_and(F.when(F.col("required"), F.col("passed"))), F.lit(True)).alias("accepted"))
    return rows.crossJoin(F.broadcast(verdict))  # one row


def parity(a: DataFrame, b: DataFrame, keys: list[str], value: str = "v", exact: float = 0.005) -> DataFrame:
    """Pixels valid in both or one, and the differences of those in both."""
    both = a.select(*keys, F.col(value).alias("a")).join(b.select(*keys, F.col(value).alias("b")), keys, "full_outer")
    d = F.abs(F.col("a") - F.col("b"))
    return both.agg(
        F.count(d).alias("valid_both"), F.count_if(F.col("a").isNotNull() & F.col("b").isNull()).alias("only_a"), F.count_if(F.col("a").isNull() & F.col("b").isNotNull()).alias("only_b"),
        F.max(d).alias("max_abs"), F.avg(d).alias("mean_abs"), F.sqrt(F.avg(d * d)).alias("rmse"), F.count_if(d <= exact).alias("n_exact"),
    )


def lsb_classes(a: DataFrame, b: DataFrame, keys: list[str], by: list[str], value: str = "v") -> DataFrame:
    """By granule: exact, within one step, or different, after a round trip."""
    both = a.select(*keys, F.col(value).alias("a")).join(b.select(*keys, F.col(value).alias("b")), keys)
    worst = both.groupBy(*by).agg(F.max(F.abs(F.col("a") - F.col("b"))).alias("worst"), F.count("*").alias("n_pixels"))
    return worst.withColumn("class", F.when(F.col("worst") == 0, "exact").when(F.col("worst") <= 1, "one_step").otherwise("different"))


def exceeding(a: DataFrame, b: DataFrame, keys: list[str], tolerance: float, value: str = "v") -> DataFrame:
    """Keys of pixels that differ by more than the tolerance."""
    return a.select(*keys, F.col(value).alias("a")).join(b.select(*keys, F.col(value).alias("b")), keys).where(F.abs(F.col("a") - F.col("b")) > tolerance).select(*keys)


def same_set(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: whether both hold the same rows as often."""
    return a.exceptAll(b).unionAll(b.exceptAll(a)).agg((F.count("*") == 0).alias("same"), F.count("*").alias("n_different"))


def contingency(forecast: DataFrame, observed: DataFrame, keys: list[str], threshold: float = 0.1, value: str = "v") -> DataFrame:
    """Hits, false alarms, misses, correct negatives and the scores from them; pixels missing on either side do not count."""
    both = forecast.select(*keys, F.col(value).alias("f")).join(observed.select(*keys, F.col(value).alias("o")), keys).where("f IS NOT NULL AND o IS NOT NULL")
    f, o = F.col("f") > threshold, F.col("o") > threshold
    counted = both.agg(F.count_if(f & o).alias("tp"), F.count_if(f & ~o).alias("fp"), F.count_if(~f & o).alias("fn"), F.count_if(~f & ~o).alias("tn"))
    return counted.select("*", F.try_divide("tp", F.col("tp") + F.col("fp") + F.col("fn")).alias("csi"), F.try_divide("fp", F.col("tp") + F.col("fp")).alias("far"), F.try_divide("tp", F.col("tp") + F.col("fn")).alias("hr"))


def joint_diagnostics(pixels: DataFrame) -> DataFrame:
    """Raw against classified layers (flood, water, raw_flood, reference, raw_reference), as counts."""
    ok = lambda *names: [F.col(n) != NODATA for n in names]
    both = lambda c: c[0] & c[1]
    jf, jr, fw = both(ok("flood", "raw_flood")), both(ok("reference", "raw_reference")), both(ok("flood", "water"))
    f, r = F.col("flood") > 0, F.col("raw_flood") > 0
    return pixels.agg(
        F.count_if(jf).alias("joint_flood"), F.count_if(jf & f).alias("classified_positive"), F.count_if(jf & r).alias("raw_positive"), F.count_if(jf & f & r).alias("flood_intersection"),
        F.count_if(jf & r & (F.col("flood") == 0)).alias("raw_only"), F.count_if(fw & (F.col("flood") > F.col("water"))).alias("flood_over_water"), F.count_if(jr).alias("joint_reference"), F.count_if(jr & (F.col("reference") == F.col("raw_reference"))).alias("reference_agreement"),
    )


def search_diagnostics(wanted: DataFrame, listed: DataFrame) -> DataFrame:
    """Why dates yield nothing: (n_dates, n_listed, listings_empty, no_match)."""
    per = wanted.join(listed.groupBy("date").agg(F.count("*").alias("n"), F.count_if("matches").alias("m")), "date", "left")
    return per.agg(F.count("*").alias("n_dates"), F.count("n").alias("n_listed"), F.count_if(F.col("n").isNull()).alias("listings_empty"), F.count_if((F.col("n") > 0) & (F.col("m") == 0)).alias("no_match"))
