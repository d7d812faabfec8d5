"""Queries of the aggregations and resampling operators (A, R)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..layers import GFM, MODIS, VIIRS
from ..operators import reduce as rd, relational as rel, resample as rs
from .base import query, table, view

C = F.col
BY = "GROUP BY row_, col_"


def _px(spark, sf):
    return view(spark, sf, "obs").groupBy("row_", "col_")


@query("a01_nanmean", f"SELECT row_, col_, round(avg(CASE WHEN gfm_flood <> 255 THEN value END), 6) AS v FROM {{obs}} {BY}")
def a01(spark, sf):
    value = F.when(C("gfm_flood") == 255, F.lit(float("nan"))).otherwise(C("value"))
    return _px(spark, sf).agg(F.round(rd.reducer("nanmean", value), 6).alias("v"))


@query("a02_mean", f"SELECT row_, col_, round(avg(value), 6) AS v FROM {{obs}} {BY}")
def a02(spark, sf):
    return _px(spark, sf).agg(F.round(rd.reducer("mean", C("value")), 6).alias("v"))


@query("a03_mode", "SELECT row_, col_, viirs_code AS v FROM (SELECT row_, col_, viirs_code, row_number() OVER (PARTITION BY row_, col_ ORDER BY count(*) DESC, viirs_code) AS r FROM {obs} GROUP BY row_, col_, viirs_code) WHERE r = 1")
def a03(spark, sf):
    return _px(spark, sf).agg(rd.reducer("mode", C("viirs_code")).alias("v"))


@query("a04_max", f"SELECT row_, col_, max(viirs_code) AS v FROM {{obs}} {BY}")
def a04(spark, sf):
    return _px(spark, sf).agg(rd.reducer("max", C("viirs_code")).alias("v"))


@query("a05_masked_max", f"SELECT row_, col_, coalesce(max(nullif(gfm_ref, 255)), 255) AS v FROM {{obs}} {BY}")
def a05(spark, sf):
    return _px(spark, sf).agg(rd.reducer("masked_max", C("gfm_ref"), nodata=255).alias("v"))


@query("a06_masked_or", f"SELECT row_, col_, coalesce(bit_or(nullif(gfm_flags, 255)), 255) AS v FROM {{obs}} {BY}")
def a06(spark, sf):
    return _px(spark, sf).agg(rd.reducer("masked_or", C("gfm_flags"), nodata=255).alias("v"))


@query("a07_all_true", f"SELECT row_, col_, bool_and(gfm_ref > 0)::INT AS v FROM {{obs}} {BY}")
def a07(spark, sf):
    return _px(spark, sf).agg(rd.reducer("all_true", C("gfm_ref")).alias("v"))


@query("a08_majority", f"SELECT row_, col_, (2 * count(*) FILTER (gfm_water = 1 AND gfm_flood <> 255) > count(*) FILTER (gfm_flood <> 255))::INT AS v FROM {{obs}} {BY}")
def a08(spark, sf):
    return _px(spark, sf).agg(rd.reducer("majority", (C("gfm_water") == 1).cast("int"), valid=C("gfm_flood") != 255).alias("v"))


@query("a09_dispatch_registry", f"""SELECT row_, col_, coalesce(max(nullif(gfm_flood, 255)), 255) AS ensemble_flood_extent, coalesce(bit_or(nullif(gfm_flags, 255)), 255) AS advisory_flags, coalesce(max(nullif(gfm_likelihood, 255)), 255) AS ensemble_likelihood FROM {{obs}} {BY}""")
def a09(spark, sf):
    named = view(spark, sf, "obs").withColumnsRenamed({"gfm_flood": "ensemble_flood_extent", "gfm_flags": "advisory_flags", "gfm_likelihood": "ensemble_likelihood"})
    return rd.temporal(named, "gfm", ["row_", "col_"], ["ensemble_flood_extent", "advisory_flags", "ensemble_likelihood"])


@query("a10_pairwise", "SELECT seq, coalesce(greatest(nullif(gfm_ref, 255), nullif(gfm_flags, 255)), 255) AS hi, coalesce(nullif(gfm_ref, 255) | nullif(gfm_flags, 255), nullif(gfm_ref, 255), nullif(gfm_flags, 255), 255) AS ored FROM {obs}")
def a10(spark, sf):
    a, b = C("gfm_ref"), C("gfm_flags")
    return view(spark, sf, "obs").select("seq", rd.pairwise_max(a, b, 255).alias("hi"), rd.pairwise_or(a, b, 255).alias("ored"))


@query("a11_viirs_temporal", """WITH d AS (SELECT row_, col_, CASE WHEN viirs_code IN (15, 99) THEN 1.0 WHEN viirs_code BETWEEN 100 AND 200 THEN (viirs_code - 100) / 100.0 WHEN viirs_code IN (0, 1, 20, 30, 50) THEN NULL ELSE 0.0 END::DOUBLE AS w,
 viirs_code IN (0, 1, 20, 30, 50) AS x, viirs_code = 99 AS r, (viirs_code = 30)::INT AS c FROM {obs}),
 m AS (SELECT row_, col_, c AS cloud_mask FROM (SELECT row_, col_, c, row_number() OVER (PARTITION BY row_, col_ ORDER BY count(*) DESC, c) AS k FROM d GROUP BY row_, col_, c) WHERE k = 1)
 SELECT row_, col_, round(avg(w), 9) AS water_fraction, bool_and(x)::INT AS exclusion_mask, (2 * count(*) FILTER (r AND NOT x) > count(*) FILTER (NOT x))::INT AS reference_water, any_value(cloud_mask) AS cloud_mask FROM d JOIN m USING (row_, col_) GROUP BY row_, col_""")
def a11(spark, sf):
    names = ["water_fraction", "exclusion_mask", "reference_water", "cloud_mask"]
    out = rd.temporal(VIIRS.derive_all(view(spark, sf, "obs"), {"raw": "viirs_code"}, names), "viirs", ["row_", "col_"], names, valid=C("exclusion_mask") == 0)
    return out.withColumn("water_fraction", F.round("water_fraction", 9))


@query("a11_cloud_fraction", "SELECT round(avg(coalesce(c / nullif(n, 0), 0)), 9) AS cloud_fraction FROM (SELECT date, count(*) FILTER (viirs_code = 30) AS c, count(*) FILTER (viirs_code NOT IN (0, 1)) AS n FROM {obs} GROUP BY date)")
def a11b(spark, sf):
    out = rd.mean_cloud_fraction(view(spark, sf, "obs"), "date", C("viirs_code") == 30, ~C("viirs_code").isin(0, 1))
    return out.select(F.round("cloud_fraction", 9).alias("cloud_fraction"))


@query("a12_modis_temporal", """WITH d AS (SELECT row_, col_, CASE WHEN modis_code <> 255 THEN (modis_code = 3)::INT END AS f, (modis_code = 255)::INT AS x FROM {obs}),
 m AS (SELECT row_, col_, x FROM (SELECT row_, col_, x, row_number() OVER (PARTITION BY row_, col_ ORDER BY count(*) DESC, x) AS k FROM d GROUP BY row_, col_, x) WHERE k = 1)
 SELECT row_, col_, round(avg(f), 6) AS flood_fraction, any_value(m.x) AS exclusion_mask FROM d JOIN m USING (row_, col_) GROUP BY row_, col_""")
def a12(spark, sf):
    names = ["flood_fraction", "exclusion_mask"]
    out = rd.temporal(MODIS.derive_all(view(spark, sf, "obs"), {"raw": "modis_code"}, names), "modis", ["row_", "col_"], names)
    return out.withColumn("flood_fraction", F.round("flood_fraction", 6))


_GFM_ITEMS = "(SELECT date, row_, col_, seq, CASE WHEN gfm_flood <> 255 THEN gfm_flood END AS flood, CASE WHEN gfm_water <> 255 THEN gfm_water END AS water, (gfm_flood <> 255 OR gfm_water <> 255)::INT AS valid, gfm_ref AS reference, gfm_flags AS flags, CASE WHEN gfm_likelihood <> 255 THEN gfm_likelihood END AS likelihood FROM {obs})"


def _items(spark, sf):
    ok = lambda c: F.when(C(c) != 255, C(c))
    return view(spark, sf, "obs").select("date", "row_", "col_", "seq", ok("gfm_flood").alias("flood"), ok("gfm_water").alias("water"), ((C("gfm_flood") != 255) | (C("gfm_water") != 255)).cast("int").alias("valid"), C("gfm_ref").alias("reference"), C("gfm_flags").alias("flags"), ok("gfm_likelihood").cast("double").alias("likelihood"))


@query("a13_native_temporal", f"""SELECT row_, col_, coalesce(max(nullif(gfm_flood, 255)), 255) AS ensemble_flood_extent, coalesce(max(nullif(gfm_ref, 255)), 255) AS reference_water_mask, coalesce(bit_or(nullif(gfm_flags, 255)), 255) AS advisory_flags, coalesce(max(nullif(gfm_likelihood, 255)), 255) AS ensemble_likelihood FROM {{obs}} {BY}""")
def a13b(spark, sf):
    named = view(spark, sf, "obs").withColumnsRenamed({"gfm_flood": "ensemble_flood_extent", "gfm_ref": "reference_water_mask", "gfm_flags": "advisory_flags", "gfm_likelihood": "ensemble_likelihood"})
    return rd.gfm_temporal(named, ["row_", "col_"], native=True)


@query("a13_cloud_fraction", f"SELECT row_, round(1 - count(w) / count(*), 9) AS cloud_fraction FROM (SELECT row_, col_, CASE WHEN sum(valid) > 0 THEN sum(water) / sum(valid) END AS w FROM {_GFM_ITEMS} {BY}) GROUP BY row_")
def a13c(spark, sf):
    out = rd.missing_fraction(rd.gfm_temporal(_items(spark, sf), ["row_", "col_"]), C("water_fraction"), ["row_"])
    return out.select("row_", F.round("cloud_fraction", 9).alias("cloud_fraction"))


@query("a13_gfm_temporal", f"SELECT row_, col_, round(CASE WHEN sum(valid) > 0 THEN sum(water) / sum(valid) END, 6) AS water_fraction, coalesce(max(nullif(reference, 255)), 255) AS reference_water FROM {_GFM_ITEMS} {BY}")
def a13(spark, sf):
    out = rd.accumulate(_items(spark, sf), ["row_", "col_"]).withColumnRenamed("reference", "reference_water_mask")
    out = GFM.derive_all(out, {n: n for n in ("flood_count", "water_count", "valid_count", "reference_water_mask")}, ["water_fraction", "reference_water"])
    return out.select("row_", "col_", F.round("water_fraction", 6).alias("water_fraction"), "reference_water")


@query("a14_date_accumulation", f"""SELECT date, row_, col_, sum(flood)::BIGINT AS flood_count, sum(water)::BIGINT AS water_count, sum(valid)::BIGINT AS valid_count, coalesce(max(nullif(reference, 255)), 255) AS reference, coalesce(bit_or(nullif(flags, 255)), 255) AS flags,
 coalesce(max(likelihood), 255)::INT AS likelihood FROM {_GFM_ITEMS} GROUP BY date, row_, col_""")
def a14(spark, sf):
    return rd.accumulate(_items(spark, sf), ["date", "row_", "col_"])


@query("a15_native_max_pool", "SELECT date, row_ // 4 AS trow, col_ // 4 AS tcol, coalesce(max(nullif(gfm_flood, 255)), 255) AS flood FROM {obs} GROUP BY ALL")
def a15(spark, sf):
    key = lambda c: F.floor(C(c) / 4).cast("int")
    return view(spark, sf, "obs").groupBy("date", key("row_").alias("trow"), key("col_").alias("tcol")).agg(rd.masked_max(C("gfm_flood"), 255).alias("flood"))


@query("a16_valid_mask", f"SELECT date, sum(valid)::BIGINT AS n_valid, count(*) AS n FROM {_GFM_ITEMS} GROUP BY date")
def a16(spark, sf):
    return _items(spark, sf).groupBy("date").agg(F.sum("valid").alias("n_valid"), F.count("*").alias("n"))


@query("a17_coverage_counters", f"SELECT date, count(DISTINCT seq % 50) AS n_items, count(DISTINCT CASE WHEN valid = 1 THEN seq % 50 END) AS usable_items, count(*) FILTER (flood IS NULL) AS no_flood FROM {_GFM_ITEMS} GROUP BY date")
def a17(spark, sf):
    item = C("seq") % 50
    return _items(spark, sf).groupBy("date").agg(F.countDistinct(item).alias("n_items"), F.countDistinct(F.when(C("valid") == 1, item)).alias("usable_items"), F.count_if(C("flood").isNull()).alias("no_flood"))


@query("a18_group_to_tasks", "SELECT date, tile, list(item ORDER BY item) AS items, min(west) AS west, min(south) AS south, max(east) AS east, max(north) AS north FROM {catalogue} GROUP BY date, tile")
def a18(spark, sf):
    return rel.to_tasks(view(spark, sf, "catalogue"))


@query("a19_row_to_task", "SELECT item, 'modis-' || strftime(date, '%Y%m%d') || '-' || tile AS task_id FROM {catalogue}")
def a19(spark, sf):
    return view(spark, sf, "catalogue").select("item", F.concat_ws("-", F.lit("modis"), F.date_format("date", "yyyyMMdd"), C("tile").cast("string")).alias("task_id"))


@query("a20_items_by_date", "SELECT strftime(date, '%Y%m%d') AS token, count(*) AS n FROM {catalogue} GROUP BY ALL")
def a20(spark, sf):
    return view(spark, sf, "catalogue").groupBy(F.date_format("date", "yyyyMMdd").alias("token")).agg(F.count("*").alias("n"))


@query("a21_scenes", """SELECT source_date, list_sort(list_distinct(flatten(list([('s' || (patch % 9)), ('s' || (patch % 4))])))) AS ids, min(west) AS west, min(south) AS south, max(east) AS east, max(north) AS north FROM {patches} GROUP BY source_date""")
def a21(spark, sf):
    from ..plans.stac import scenes

    return scenes(view(spark, sf, "patches").withColumn("ids", F.format_string('["s%d","s%d"]', C("patch") % 9, C("patch") % 4)))


@query("a22_event_metadata", """SELECT actid, min(CASE WHEN NOT coalesce(master, FALSE) THEN source_date END) AS date_start, min(CASE WHEN master THEN source_date END) AS date_end, round_even(min(south), 4) AS lat_min, round_even(max(north), 4) AS lat_max, round_even(min(west), 4) AS lon_min, round_even(max(east), 4) AS lon_max,
 round_even(coalesce(sum(CASE WHEN coalesce(master, FALSE) AND crank = 1 AND pflood > 0 THEN area_km2 * pflood / 100 END), 0), 1) AS extent_km2 FROM {patches} GROUP BY actid""")
def a22(spark, sf):
    return rel.event_metadata(view(spark, sf, "patches"), 1)


_TILES = "(SELECT actid AS event_id, (patch % 3)::INT AS aoi_id, patch AS tile, source_date AS pre, CAST(source_date + CAST(patch % 9 - 2 AS INT) AS DATE) AS post, west, east, CASE WHEN patch % 2 = 0 THEN 'train' ELSE 'test' END AS split, patch % 5 > 0 AS is_valid, (patch % 11) / 11.0::DOUBLE AS invalid_frac FROM {patches})"


def _tiles(spark, sf):
    return view(spark, sf, "patches").select(C("actid").alias("event_id"), (C("patch") % 3).cast("int").alias("aoi_id"), C("patch").alias("tile"), C("source_date").alias("pre"), F.expr("date_add(source_date, CAST(patch % 9 - 2 AS INT))").alias("post"), "west", "east", F.when(C("patch") % 2 == 0, "train").otherwise("test").alias("split"), (C("patch") % 5 > 0).alias("is_valid"), ((C("patch") % 11) / 11.0).alias("invalid_frac"))


@query("a23_area_metadata", f"SELECT event_id, aoi_id, min(pre) AS date_start, max(post) AS date_end, min(west) AS west, max(east) AS east, count(*) AS n_tiles, arg_min(split, tile) AS split, bool_and(is_valid) AS is_valid, round_even(avg(invalid_frac), 4) AS invalid_frac_mean FROM {_TILES} WHERE post >= pre AND year(post) <= 2027 GROUP BY ALL")
def a23(spark, sf):
    return rel.area_metadata(_tiles(spark, sf))


@query("a24_status_counts", "SELECT coalesce(status, 'PENDING') AS status, count(*) AS n FROM {tasks} GROUP BY ALL UNION ALL SELECT 'total', count(*) FROM {tasks}")
def a24(spark, sf):
    from ..plans.tracker import status_counts

    return status_counts(view(spark, sf, "tasks"))


@query("a25_distinct_counts", "SELECT count(DISTINCT date) AS dates, count(DISTINCT tile) AS tiles, count(DISTINCT (date, tile)) AS cells FROM {catalogue}")
def a25(spark, sf):
    return view(spark, sf, "catalogue").agg(F.countDistinct("date").alias("dates"), F.countDistinct("tile").alias("tiles"), F.countDistinct("date", "tile").alias("cells"))


@query("a26_code_frequency_top8", "SELECT viirs_code, n, round(100.0 * n / sum(n) OVER (), 6) AS pct FROM (SELECT viirs_code, count(*) AS n FROM {obs} GROUP BY ALL) ORDER BY n DESC, viirs_code LIMIT 8")
def a26(spark, sf):
    from ..operators.explore import code_shares

    return code_shares(view(spark, sf, "obs"), [], "viirs_code").orderBy(F.desc("n"), "viirs_code").limit(8).select("viirs_code", "n", F.round("pct", 6).alias("pct"))


@query("a27_classified_stats", "SELECT min(v) AS lowest, max(v) AS highest, round(avg(v), 6) AS mean, count(*) FILTER (v > 0.5) AS flooded FROM {scene_px}")
def a27(spark, sf):
    return view(spark, sf, "scene_px").agg(F.min("v").alias("lowest"), F.max("v").alias("highest"), F.round(F.avg("v"), 6).alias("mean"), F.count_if(C("v") > 0.5).alias("flooded"))


@query("a28_raster_stats", """SELECT date, count(*) AS total, count(*) FILTER (gfm_ref <> 255) AS valid, count(*) FILTER (gfm_ref = 255) AS nodata, count(*) FILTER (gfm_ref = 0) AS zero, count(*) FILTER (gfm_ref > 0 AND gfm_ref <> 255) AS positive,
 min(nullif(gfm_ref, 255)) AS lowest, max(nullif(gfm_ref, 255)) AS highest, count(DISTINCT nullif(gfm_ref, 255)) AS distinct_values FROM {obs} GROUP BY date""")
def a28(spark, sf):
    from ..operators.validate import raster_stats

    return raster_stats(view(spark, sf, "obs"), ["date"], "gfm_ref")


@query("a29_populated_extent", "SELECT date, min(row_) AS min_row_, max(row_) AS max_row_, min(col_) AS min_col_, max(col_) AS max_col_ FROM {obs} WHERE gfm_flood <> 255 AND viirs_code > 100 GROUP BY date")
def a29(spark, sf):
    return rd.populated_extent(view(spark, sf, "obs"), (C("gfm_flood") != 255) & (C("viirs_code") > 100), ["date"])


@query("a30_total_extent", "SELECT min(west) AS west, min(south) AS south, max(east) AS east, max(north) AS north FROM {catalogue}")
def a30(spark, sf):
    return view(spark, sf, "catalogue").agg(F.min("west").alias("west"), F.min("south").alias("south"), F.max("east").alias("east"), F.max("north").alias("north"))


_KEYS = "(SELECT CASE WHEN patch % 4 = 0 THEN 'k/7/00/' || (patch % 10) || 'x/h' || (patch % 13) ELSE 'k/7/0' || (1 + patch % 3) || '/h' || (patch % 17) END || '/' || CASE patch % 3 WHEN 0 THEN 'info.json' WHEN 1 THEN 'mask.tif' ELSE 'dem.tif' END AS key FROM {patches} UNION ALL SELECT 'k/7/readme/x/info.json')"


def _keys(spark, sf):
    p = C("patch")
    folder = F.when(p % 4 == 0, F.format_string("k/7/00/%dx/h%d", p % 10, p % 13)).otherwise(F.format_string("k/7/0%d/h%d", 1 + p % 3, p % 17))
    name = F.when(p % 3 == 0, "info.json").when(p % 3 == 1, "mask.tif").otherwise("dem.tif")
    return view(spark, sf, "patches").select(F.concat_ws("/", folder, name).alias("key")).union(spark.createDataFrame([("k/7/readme/x/info.json",)], "key string"))


@query("a31_tile_prefixes", f"""WITH k AS (SELECT key, string_split(key[5:], '/') AS p FROM {_KEYS}), d AS (SELECT key, 'k/7/' || array_to_string(CASE WHEN p[1]::INT = 0 THEN p[1:3] ELSE p[1:2] END, '/') || '/' AS tile_prefix FROM k WHERE regexp_matches(p[1], '^\\d+$') AND ((p[1] = '00' AND len(p) >= 4) OR (p[1] <> '00' AND len(p) >= 3)))
 SELECT tile_prefix, list_sort(list(DISTINCT key)) AS keys FROM d GROUP BY tile_prefix HAVING count(*) FILTER (key = tile_prefix || 'info.json') > 0""")
def a31(spark, sf):
    return rel.tile_prefixes(_keys(spark, sf), "k/7/")


@query("a32_event_bands", "SELECT quantile_cont(south, 1 / 3.0) AS low, quantile_cont(south, 2 / 3.0) AS high, min((west + east) / 2) AS first_centre FROM {aoi}")
def a32(spark, sf):
    q = F.percentile("south", [1 / 3.0, 2 / 3.0])
    return view(spark, sf, "aoi").agg(q.alias("q"), F.min((C("west") + C("east")) / 2).alias("first_centre")).select(C("q")[0].alias("low"), C("q")[1].alias("high"), "first_centre")


@query("a33_wall_times", "SELECT event_type, round(avg(value), 6) AS mean, median(value) AS median, max(value) AS highest, round(count(*) / sum(value), 6) AS throughput FROM events GROUP BY event_type")
def a33(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.round(F.avg("value"), 6).alias("mean"), F.median("value").alias("median"), F.max("value").alias("highest"), F.round(F.count("*") / F.sum("value"), 6).alias("throughput"))


@query("a34_worker_memory", """SELECT user_id % 10 AS worker, max(value) AS peak, median(value) AS median, arg_max(value, event_id) AS last, max(CASE WHEN ts >= TIMESTAMP '2024-01-25' THEN value END) AS recent_peak, count(DISTINCT user_id) > 1 AS restarted FROM events GROUP BY worker""")
def a34(spark, sf):
    recent = F.when(C("ts") >= F.expr("TIMESTAMP_NTZ'2024-01-25'"), C("value"))
    return table(spark, sf, "events").groupBy((C("user_id") % 10).alias("worker")).agg(F.max("value").alias("peak"), F.median("value").alias("median"), F.max_by("value", "event_id").alias("last"), F.max(recent).alias("recent_peak"), (F.countDistinct("user_id") > 1).alias("restarted"))


@query("a35_block_max_then_sum", """WITH b AS (SELECT date, row_ // 4 AS trow, col_ // 4 AS tcol, max(nullif(gfm_flood, 255)) AS f FROM {obs} GROUP BY ALL) SELECT trow, tcol, sum(f)::BIGINT AS flood, max((f IS NOT NULL)::INT) AS observed FROM b GROUP BY ALL""")
def a35(spark, sf):
    b = rs.coarsen(view(spark, sf, "obs").withColumn("f", F.when(C("gfm_flood") != 255, C("gfm_flood"))), 4, "f", "max", by=("date",))
    return b.groupBy("trow", "tcol").agg(F.sum("f").alias("flood"), F.max(C("f").isNotNull().cast("int")).alias("observed"))


@query("a35b_mosaic_max", "SELECT row_, col_, coalesce(max(nullif(gfm_likelihood, 255)), 255) AS v FROM {obs} GROUP BY ALL")
def a35b(spark, sf):
    return _px(spark, sf).agg(rd.masked_max(C("gfm_likelihood"), 255).alias("v"))


@query("a36_time_fields", f"SELECT row_, col_, max(value) AS highest, round(avg(value), 6) AS mean FROM {{obs}} {BY}")
def a36(spark, sf):
    return _px(spark, sf).agg(F.max("value").alias("highest"), F.round(F.avg("value"), 6).alias("mean"))


def _coarse(method: str, sql: str, name: str, **more):
    @query(name, f"SELECT row_ // 8 AS trow, col_ // 8 AS tcol, {sql} AS v FROM {{scene_px}} GROUP BY ALL")
    def run(spark, sf):
        out = rs.coarsen(view(spark, sf, "scene_px"), 8, "v", method, **more)
        return out.withColumn("v", F.round("v", 6))

    return run


for _m, _sql in {"average": "avg(v)", "max": "max(v)", "min": "min(v)", "med": "median(v)", "q1": "quantile_cont(v, 0.25)", "q3": "quantile_cont(v, 0.75)"}.items():
    _coarse(_m, f"round({_sql}, 6)", f"r02_{_m}")


@query("r01_registry_methods", "SELECT row_ // 8 AS trow, col_ // 8 AS tcol, round(avg(v), 6) AS flood_fraction FROM {scene_px} GROUP BY ALL")
def r01(spark, sf):
    from ..layers import resampling_for

    named = view(spark, sf, "scene_px").withColumnRenamed("v", "flood_fraction")
    return rs.coarsen(named, 8, "flood_fraction", resampling_for("flood_fraction", "viirs")).withColumn("flood_fraction", F.round("flood_fraction", 6))


@query("r02_mode", "SELECT trow, tcol, code FROM (SELECT row_ // 8 AS trow, col_ // 8 AS tcol, code, row_number() OVER (PARTITION BY row_ // 8, col_ // 8 ORDER BY count(*) DESC, code) AS k FROM {scene_px} GROUP BY row_ // 8, col_ // 8, code) WHERE k = 1")
def r02_mode(spark, sf):
    return rs.coarsen(view(spark, sf, "scene_px"), 8, "code", "mode")


@query("r02_nearest", "SELECT row_ // 8 AS trow, col_ // 8 AS tcol, code FROM {scene_px} WHERE row_ % 8 = 4 AND col_ % 8 = 4")
def r02_nearest(spark, sf):
    return rs.coarsen(view(spark, sf, "scene_px"), 8, "code", "nearest")


_CELLS = "(SELECT row_ // 8 AS row_, col_ // 8 AS col_, avg(v) AS v FROM {scene_px} GROUP BY ALL)"


def _cells(spark, sf):
    return rs.coarsen(view(spark, sf, "scene_px"), 8, "v", "average").withColumnsRenamed({"trow": "row_", "tcol": "col_"})


@query("r02_bilinear", f"""WITH c AS {_CELLS}, o AS (SELECT unnest(generate_series(-2, 3)) AS k), w AS (SELECT k, greatest(1 - abs((k + 0.5) / 2 - 0.5), 0) AS w FROM o)
 SELECT row_, col_, round(sum(w * v) / sum(w), 6) AS v FROM (SELECT row_ * 2 + a.k AS row_, col_ * 2 + b.k AS col_, a.w * b.w AS w, v FROM c, w a, w b WHERE v IS NOT NULL AND a.w * b.w > 0) WHERE row_ BETWEEN 0 AND 15 AND col_ BETWEEN 0 AND 15 GROUP BY row_, col_""")
def r02_bilinear(spark, sf):
    return rs.interpolated(_cells(spark, sf), 2, shape=(8, 8)).select(C("row_").cast("long").alias("row_"), C("col_").cast("long").alias("col_"), F.round("v", 6).alias("v"))


@query("r02_cubic", f"""WITH c AS {_CELLS}, o AS (SELECT unnest(generate_series(-4, 5)) AS k), d AS (SELECT k, abs((k + 0.5) / 2 - 0.5)::DOUBLE AS d FROM o), w AS (SELECT k, CASE WHEN d < 1 THEN 1.5 * d ** 3 - 2.5 * d ** 2 + 1 WHEN d < 2 THEN -0.5 * d ** 3 + 2.5 * d ** 2 - 4 * d + 2 ELSE 0 END AS w FROM d)
 SELECT row_, col_, round(sum(w * v) / sum(w), 6) AS v FROM (SELECT row_ * 2 + a.k AS row_, col_ * 2 + b.k AS col_, a.w * b.w AS w, v FROM c, w a, w b WHERE v IS NOT NULL AND a.w * b.w <> 0) WHERE row_ BETWEEN 0 AND 15 AND col_ BETWEEN 0 AND 15 GROUP BY row_, col_""")
def r02_cubic(spark, sf):
    return rs.interpolated(_cells(spark, sf), 2, method="cubic", shape=(8, 8)).select(C("row_").cast("long").alias("row_"), C("col_").cast("long").alias("col_"), F.round("v", 6).alias("v"))


@query("r03_nodata_rules", "SELECT row_ // 4 AS trow, col_ // 4 AS tcol, coalesce(max(nullif(gfm_ref, 255)), 255) AS gfm_ref FROM {obs} GROUP BY ALL")
def r03(spark, sf):
    return rs.coarsen(view(spark, sf, "obs"), 4, "gfm_ref", "max", nodata=255)


@query("r05_binarise_coarsen", "SELECT row_ // 4 AS trow, col_ // 4 AS tcol, round(avg((gfm_flood = 1)::INT), 6) AS b FROM {obs} GROUP BY ALL HAVING count(*) >= 16")
def r05(spark, sf):
    return rs.coarsen(view(spark, sf, "obs").withColumn("b", (C("gfm_flood") == 1).cast("int")), 4, "b", "average", trim=True).withColumn("b", F.round("b", 6))


@query("r06_codes_and_likelihood", "SELECT row_ // 4 AS trow, col_ // 4 AS tcol, round(coalesce(avg(nullif(gfm_likelihood, 255)), 255), 6) AS gfm_likelihood FROM {obs} GROUP BY ALL")
def r06(spark, sf):
    return rs.coarsen(view(spark, sf, "obs"), 4, "gfm_likelihood", "average", nodata=255).withColumn("gfm_likelihood", F.round("gfm_likelihood", 6))


@query("r07_harmonise", """WITH c AS (SELECT row_ // 8 AS trow, col_ // 8 AS tcol, avg(v) AS v FROM {scene_px} GROUP BY ALL) SELECT trow, tcol, CASE WHEN v IS NULL THEN 255 ELSE least(greatest(round_even(v * 100, 0), 0), 100) END::INT AS percent, (v IS NULL)::INT AS exclusion_mask FROM c""")
def r07(spark, sf):
    from ..functions.pixels import encode_percent, exclusion_from_value

    return view(spark, sf, "scene_px").transform(rs.coarsen, 8).select("trow", "tcol", encode_percent(C("v")).alias("percent"), exclusion_from_value(C("v")).alias("exclusion_mask"))


@query("r08_mosaic_first_valid", "SELECT row_, col_, coalesce(arg_min(nullif(gfm_ref, 255), seq) FILTER (gfm_ref <> 255), 255) AS gfm_ref FROM {obs} GROUP BY row_, col_")
def r08(spark, sf):
    return rs.mosaic(view(spark, sf, "obs"), ["row_", "col_"], "gfm_ref", "seq", 255)


@query("r09_clip", "SELECT count(*) AS n, sum(value) > 0 AS some FROM {obs} WHERE row_ BETWEEN 2 AND 9 AND col_ BETWEEN 4 AND 11")
def r09(spark, sf):
    return rs.clip(view(spark, sf, "obs"), 2, 10, 4, 12).agg(F.count("*").alias("n"), (F.sum("value") > 0).alias("some"))


@query("r10_ml_tiles", """WITH t AS (SELECT a.k AS tile_row, b.k AS tile_col FROM (SELECT unnest(generate_series(0, 5)) AS k) a, (SELECT unnest(generate_series(0, 5)) AS k) b)
 SELECT tile_row::INT AS tile_row, tile_col::INT AS tile_col, count(*) AS n_pixels, count(v) AS valid_pixels FROM t JOIN {scene_px} p ON row_ >= tile_row * 12 AND row_ < tile_row * 12 + 16 AND col_ >= tile_col * 12 AND col_ < tile_col * 12 + 16 GROUP BY ALL""")
def r10(spark, sf):
    return rs.tiles(view(spark, sf, "scene_px"), 64, 64, 16, 4)


@query("r11_padded_tile", "SELECT r.k::INT AS row_, c.k::INT AS col_, n AS v FROM (SELECT unnest(generate_series(0, 19)) AS k) r CROSS JOIN (SELECT unnest(generate_series(0, 19)) AS k) c LEFT JOIN (SELECT row_, col_, count(*) AS n FROM {obs} GROUP BY ALL) o ON o.row_ = r.k AND o.col_ = c.k")
def r11(spark, sf):
    return rs.padded(_px(spark, sf).agg(F.count("*").alias("v")), 20, 20)


@query("r12_subdomains", """SELECT event_id, west + i * 4 AS sub_west, south + j * 4 AS sub_south, least(west + i * 4 + 4, east) AS sub_east, least(south + j * 4 + 4, north) AS sub_north FROM (SELECT *, unnest(generate_series(0, 2)) AS j FROM (SELECT *, unnest(generate_series(0, 2)) AS i FROM {aoi}))""")
def r12(spark, sf):
    from ..functions.grid import subdomains

    return subdomains(view(spark, sf, "aoi"), 4.0).select("event_id", "sub_west", "sub_south", "sub_east", "sub_north")


@query("r13_downsample", "SELECT row_, col_, count(*) AS n FROM {obs} WHERE row_ % 3 = 1 AND col_ % 3 = 1 GROUP BY ALL")
def r13(spark, sf):
    return rs.downsample(view(spark, sf, "obs"), 3, 1).groupBy("row_", "col_").agg(F.count("*").alias("n"))
