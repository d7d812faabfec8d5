"""Queries of the scalar operators (P1 to P38)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import grid, pixels as px, text as tx
from ..layers import GFM, MODIS, VIIRS, layer_table
from .base import query, table, view

C = F.col


@query("p01_viirs_fractions", """SELECT seq,
 CASE WHEN viirs_code IN (15, 99) THEN 1.0 WHEN viirs_code BETWEEN 100 AND 200 THEN (viirs_code - 100) / 100.0 WHEN viirs_code IN (0, 1, 20, 30, 50) THEN NULL ELSE 0.0 END::DOUBLE AS water_fraction,
 CASE WHEN viirs_code BETWEEN 100 AND 200 THEN (viirs_code - 100) / 100.0 WHEN viirs_code IN (0, 1, 20, 30, 50) THEN NULL ELSE 0.0 END::DOUBLE AS flood_fraction FROM {obs}""")
def p01(spark, sf):
    return VIIRS.derive_all(view(spark, sf, "obs"), {"raw": "viirs_code"}, ["water_fraction", "flood_fraction"]).select("seq", "water_fraction", "flood_fraction")


@query("p02_viirs_masks", """SELECT seq, (viirs_code IN (0, 1, 20, 30, 50))::INT AS exclusion_mask, (viirs_code = 99)::INT AS reference_water,
 (viirs_code = 30)::INT AS cloud_mask, (viirs_code = 20)::INT AS snow_ice, (viirs_code = 50)::INT AS shadow FROM {obs}""")
def p02(spark, sf):
    names = ["exclusion_mask", "reference_water", "cloud_mask", "snow_ice", "shadow"]
    return VIIRS.derive_all(view(spark, sf, "obs"), {"raw": "viirs_code"}, names).select("seq", *names)


@query("p03_category_lists", "SELECT r_regionkey, [x FOR x IN [trim(y) FOR y IN string_split(r_name || ', ,cloud , fill', ',')] IF x <> ''] AS parts FROM region")
def p03(spark, sf):
    return table(spark, sf, "region").select("r_regionkey", px.split_list(F.concat("r_name", F.lit(", ,cloud , fill"))).alias("parts"))


@query("p03_extra_codes_precedence", """SELECT seq, CASE WHEN viirs_code IN (15, 99) THEN 1.0 WHEN viirs_code BETWEEN 100 AND 200 THEN (viirs_code - 100) / 100.0 WHEN viirs_code IN (0, 1, 15, 16, 30, 150) THEN NULL ELSE 0.0 END::DOUBLE AS water_fraction,
 (viirs_code IN (0, 1, 15, 16, 30, 150))::INT AS exclusion_mask FROM {obs}""")
def p03b(spark, sf):
    return VIIRS.derive_all(view(spark, sf, "obs"), {"raw": "viirs_code"}, ["water_fraction", "exclusion_mask"], categories=("fill", "cloud", "bareland"), extra_codes=(15, 150)).select("seq", "water_fraction", "exclusion_mask")


@query("p04_modis_layers", """SELECT seq, CASE WHEN modis_code = 255 THEN NULL ELSE (modis_code IN (1, 2, 3))::INT END::DOUBLE AS water_fraction, CASE WHEN modis_code = 255 THEN NULL ELSE (modis_code = 3)::INT END::DOUBLE AS flood_fraction,
 (modis_code = 255)::INT AS exclusion_mask, (modis_code IN (1, 2))::INT AS reference_water, (modis_code = 2)::INT AS recurring_flood FROM {obs}""")
def p04(spark, sf):
    names = ["water_fraction", "flood_fraction", "exclusion_mask", "reference_water", "recurring_flood"]
    return MODIS.derive_all(view(spark, sf, "obs"), {"raw": "modis_code"}, names).select("seq", *names)


@query("p05_gfm_fractions", """WITH c AS (SELECT row_, col_, count(*) FILTER (gfm_flood = 1) AS f, count(*) FILTER (gfm_water = 1) AS w, count(*) FILTER (gfm_flood <> 255 OR gfm_water <> 255) AS n FROM {obs} GROUP BY ALL)
 SELECT row_, col_, round(CASE WHEN n > 0 THEN w / n END, 6) AS water_fraction, round(CASE WHEN n > 0 THEN f / n END, 6) AS flood_fraction FROM c""")
def p05(spark, sf):
    counts = view(spark, sf, "obs").groupBy("row_", "col_").agg(F.count_if(C("gfm_flood") == 1).alias("flood_count"), F.count_if(C("gfm_water") == 1).alias("water_count"), F.count_if((C("gfm_flood") != 255) | (C("gfm_water") != 255)).alias("valid_count"))
    out = GFM.derive_all(counts, {n: n for n in ("flood_count", "water_count", "valid_count")}, ["water_fraction", "flood_fraction"])
    return out.select("row_", "col_", F.round("water_fraction", 6).alias("water_fraction"), F.round("flood_fraction", 6).alias("flood_fraction"))


@query("p06_viirs_cloud_fraction", "SELECT date, round(count(*) FILTER (viirs_code = 30) / count(*) FILTER (viirs_code NOT IN (0, 1)), 6) AS cloud_fraction FROM {obs} GROUP BY date")
def p06(spark, sf):
    filled = F.count_if(~C("viirs_code").isin(0, 1))
    return view(spark, sf, "obs").groupBy("date").agg(F.round(F.count_if(C("viirs_code") == 30) / filled, 6).alias("cloud_fraction"))


@query("p07_cloud_fraction_valid", "SELECT date, round(1 - count(*) FILTER (modis_code <> 255) / count(*), 6) AS modis_cloud, round(1 - count(*) FILTER (gfm_flood <> 255 OR gfm_water <> 255) / count(*), 6) AS gfm_cloud FROM {obs} GROUP BY date")
def p07(spark, sf):
    share = lambda ok, n: F.round(1 - F.count_if(ok) / F.count("*"), 6).alias(n)
    return view(spark, sf, "obs").groupBy("date").agg(share(C("modis_code") != 255, "modis_cloud"), share((C("gfm_flood") != 255) | (C("gfm_water") != 255), "gfm_cloud"))


@query("p08_encode_percent", "SELECT seq, CASE WHEN value IS NULL OR seq % 10 = 0 THEN 255 ELSE least(greatest(round_even(value / 400.0 * 100, 0), 0), 100) END::INT AS encoded FROM {obs}")
def p08(spark, sf):
    return view(spark, sf, "obs").select("seq", px.encode_percent(F.when(C("seq") % 10 != 0, C("value") / 400.0)).alias("encoded"))


@query("p09_decode_percent", "SELECT seq, CASE WHEN gfm_likelihood <> 255 THEN gfm_likelihood * 0.01::DOUBLE END AS decoded FROM {obs}")
def p09(spark, sf):
    return view(spark, sf, "obs").select("seq", px.decode_percent(C("gfm_likelihood")).alias("decoded"))


@query("p10_normalise", """WITH b AS (SELECT min(v) lo, max(v) hi FROM (SELECT CASE WHEN value <> 100.0 THEN value END v FROM {obs}))
 SELECT seq, round(CASE WHEN value <> 100.0 THEN least(greatest((value - lo) / (hi - lo) * 2 - 1, -1), 1) END, 6) AS normalised FROM {obs}, b""")
def p10(spark, sf):
    from ..operators.explore import normalise

    return normalise(view(spark, sf, "obs"), "value", -1.0, 1.0, fill=100.0).select("seq", F.round("value", 6).alias("normalised"))


@query("p11_exclusion_mask", "SELECT row_, col_, code, (v IS NULL)::INT AS from_value, CASE WHEN code % 3 > 0 THEN 0 ELSE 1 END AS from_quality FROM {scene_px}")
def p11(spark, sf):
    return view(spark, sf, "scene_px").select("row_", "col_", "code", px.exclusion_from_value(C("v")).alias("from_value"), px.exclusion_from_quality(C("code") % 3).alias("from_quality"))


@query("p12_reference_water", "SELECT seq, coalesce(CASE WHEN seq % 3 = 0 THEN gfm_ref END, CASE WHEN seq % 3 = 1 THEN modis_code END, 0)::INT AS reference FROM {obs}")
def p12(spark, sf):
    return view(spark, sf, "obs").select("seq", px.reference_water(F.when(C("seq") % 3 == 0, C("gfm_ref")), F.when(C("seq") % 3 == 1, C("modis_code"))).alias("reference"))


@query("p13_legacy_quality", "SELECT seq, CASE WHEN seq % 2 = 0 AND (seq % 5) / 10.0 > 0.1 THEN 2 ELSE seq % 2 END::BIGINT AS quality FROM {obs}")
def p13(spark, sf):
    return view(spark, sf, "obs").select("seq", px.legacy_quality(C("seq") % 2, (C("seq") % 5) / 10.0).alias("quality"))


#: Every layer with its type, missing value, resampling, aggregation over time and inputs.
_LAYERS = """(VALUES
 ('viirs', 'raw', 'native', 'int', 1, 'nearest', 'mode', []::VARCHAR[]),
 ('viirs', 'water_fraction', 'derived', 'double', NULL, 'average', 'nanmean', ['raw']),
 ('viirs', 'flood_fraction', 'derived', 'double', NULL, 'average', 'nanmean', ['raw']),
 ('viirs', 'exclusion_mask', 'derived', 'int', 0, 'mode', 'all_true', ['raw']),
 ('viirs', 'reference_water', 'derived', 'int', 0, 'mode', 'majority', ['raw']),
 ('viirs', 'cloud_mask', 'derived', 'int', 0, 'mode', 'mode', ['raw']),
 ('viirs', 'snow_ice', 'derived', 'int', 0, 'mode', 'mode', ['raw']),
 ('viirs', 'shadow', 'derived', 'int', 0, 'mode', 'mode', ['raw']),
 ('modis', 'raw', 'native', 'int', 255, 'nearest', 'mode', []::VARCHAR[]),
 ('modis', 'TotalCounts_1Day', 'native', 'int', 255, 'average', 'mean', []::VARCHAR[]),
 ('modis', 'ValidCounts_1Day', 'native', 'int', 255, 'average', 'mean', []::VARCHAR[]),
 ('modis', 'WaterCounts_1Day', 'native', 'int', 255, 'average', 'mean', []::VARCHAR[]),
 ('modis', 'TotalCounts_2Day', 'native', 'int', 255, 'average', 'mean', []::VARCHAR[]),
 ('modis', 'ValidCounts_2Day', 'native', 'int', 255, 'average', 'mean', []::VARCHAR[]),
 ('modis', 'WaterCounts_2Day', 'native', 'int', 255, 'average', 'mean', []::VARCHAR[]),
 ('modis', 'WaterCountsCS_2Day', 'native', 'int', 255, 'average', 'mean', []::VARCHAR[]),
 ('modis', 'TotalCounts_3Day', 'native', 'int', 255, 'average', 'mean', []::VARCHAR[]),
 ('modis', 'ValidCounts_3Day', 'native', 'int', 255, 'average', 'mean', []::VARCHAR[]),
 ('modis', 'WaterCounts_3Day', 'native', 'int', 255, 'average', 'mean', []::VARCHAR[]),
 ('modis', 'WaterCountsCS_3Day', 'native', 'int', 255, 'average', 'mean', []::VARCHAR[]),
 ('modis', 'water_fraction', 'derived', 'double', NULL, 'average', 'nanmean', ['raw']),
 ('modis', 'flood_fraction', 'derived', 'double', NULL, 'average', 'nanmean', ['raw']),
 ('modis', 'exclusion_mask', 'derived', 'int', 0, 'mode', 'mode', ['raw']),
 ('modis', 'reference_water', 'derived', 'int', 0, 'mode', 'mode', ['raw']),
 ('modis', 'recurring_flood', 'derived', 'int', 0, 'mode', 'mode', ['raw']),
 ('gfm', 'ensemble_flood_extent', 'native', 'int', 255, 'nearest', 'masked_max', []::VARCHAR[]),
 ('gfm', 'ensemble_water_extent', 'native', 'int', 255, 'nearest', 'masked_max', []::VARCHAR[]),
 ('gfm', 'reference_water_mask', 'native', 'int', 255, 'nearest', 'masked_max', []::VARCHAR[]),
 ('gfm', 'exclusion_mask', 'native', 'int', 255, 'nearest', 'masked_max', []::VARCHAR[]),
 ('gfm', 'ensemble_likelihood', 'native', 'int', 255, 'average', 'masked_max', []::VARCHAR[]),
 ('gfm', 'advisory_flags', 'native', 'int', 255, 'nearest', 'masked_or', []::VARCHAR[]),
 ('gfm', 'water_fraction', 'derived', 'double', NULL, 'average', 'nanmean', ['water_count', 'valid_count']),
 ('gfm', 'flood_fraction', 'derived', 'double', NULL, 'average', 'nanmean', ['flood_count', 'valid_count']),
 ('gfm', 'reference_water', 'derived', 'int', 255, 'nearest', 'masked_max', ['reference_water_mask'])
) t(source, name, kind, dtype, nodata, resampling, aggregation, inputs)"""


@query("p14_layer_catalogue", f"SELECT * FROM {_LAYERS}")
def p14(spark, sf):
    return layer_table(spark)


@query("p15_bbox_predicates", """SELECT a.event_id AS a, b.event_id AS b, (a.west <= b.east AND b.west <= a.east AND a.south <= b.north AND b.south <= a.north) AS closed,
 (a.west < b.east AND b.west < a.east AND a.south < b.north AND b.south < a.north) AS open_, (a.east - a.west) * (a.north - a.south) AS area FROM {aoi} a JOIN {aoi} b ON a.event_id % 5 = b.event_id % 5""")
def p15(spark, sf):
    box = lambda t: tuple(C(f"{t}.{n}") for n in ("west", "south", "east", "north"))
    aoi = view(spark, sf, "aoi")
    both = aoi.alias("a").join(aoi.alias("b"), F.expr("a.event_id % 5 = b.event_id % 5"))
    return both.select(C("a.event_id").alias("a"), C("b.event_id").alias("b"), grid.meets_closed(box("a"), box("b")).alias("closed"), grid.meets_open(box("a"), box("b")).alias("open_"), grid.bbox_area(*box("a")).alias("area"))


# boxes of no width, crossing the dateline, out of range and upside down, and dates that run backwards
_BOXES = """(SELECT o_orderkey AS id, CAST(o_custkey % 37 AS DOUBLE) * 10 - 180 AS w, CAST(o_custkey % 41 AS DOUBLE) * 5 - 100 AS s, CAST(o_orderkey % 37 AS DOUBLE) * 10 - 180 AS e, CAST(o_orderkey % 43 AS DOUBLE) * 5 - 110 AS n,
 CAST(o_orderdate AS DATE) AS d0, DATE '1998-01-01' AS d1 FROM orders)"""


def _boxes(spark, sf):
    d = lambda x: x.cast("double")
    k, c = C("o_orderkey"), C("o_custkey")
    return table(spark, sf, "orders").select(k.alias("id"), (d(c % 37) * 10 - 180).alias("w"), (d(c % 41) * 5 - 100).alias("s"), (d(k % 37) * 10 - 180).alias("e"), (d(k % 43) * 5 - 110).alias("n"), C("o_orderdate").cast("date").alias("d0"), F.to_date(F.lit("1998-01-01")).alias("d1"))


@query("p15_bbox_validity", f"SELECT id, NOT (w < -180 OR w > 180 OR e < -180 OR e > 180 OR s < -90 OR s > 90 OR n < -90 OR n > 90 OR w > e OR s > n) AS valid FROM {_BOXES}")
def p15b(spark, sf):
    return _boxes(spark, sf).select("id", grid.valid_bbox(C("w"), C("s"), C("e"), C("n")).alias("valid"))


@query("p16_event_validation", f"SELECT id, NOT (w < -180 OR w > 180 OR e < -180 OR e > 180 OR s < -90 OR s > 90 OR n < -90 OR n > 90 OR (w > e AND NOT (w > 0 AND e < 0)) OR s > n OR d1 < d0) AS valid FROM {_BOXES}")
def p16(spark, sf):
    return _boxes(spark, sf).select("id", grid.valid_event(*(C(x) for x in ("w", "s", "e", "n", "d0", "d1"))).alias("valid"))


@query("p17_tile_id_validity", "SELECT p_partkey, regexp_matches(upper(replace(p_brand, '#', '_')), '^[A-Z0-9_]{4,32}$') AS as_id, regexp_matches(p_name, '^[A-Z0-9_]{4,32}$') AS as_name FROM part")
def p17(spark, sf):
    return table(spark, sf, "part").select("p_partkey", tx.valid_tile_id(F.upper(F.regexp_replace("p_brand", "#", "_"))).alias("as_id"), tx.valid_tile_id(C("p_name")).alias("as_name"))


_ODD = "west + 0.013 AS w, south + 0.004 AS s, east - 0.007 AS e, north + 0.021 AS n"
_SNAP = "greatest(floor((w + 180) / (1.0::DOUBLE / 60)) * (1.0::DOUBLE / 60) - 180, -180) AS sw, greatest(floor((s + 90) / (1.0::DOUBLE / 60)) * (1.0::DOUBLE / 60) - 90, -90) AS ss, least(ceil((e + 180) / (1.0::DOUBLE / 60)) * (1.0::DOUBLE / 60) - 180, 180) AS se, least(ceil((n + 90) / (1.0::DOUBLE / 60)) * (1.0::DOUBLE / 60) - 90, 90) AS sn"


def _odd(spark, sf):
    return view(spark, sf, "aoi").select("event_id", (C("west") + 0.013).alias("w"), (C("south") + 0.004).alias("s"), (C("east") - 0.007).alias("e"), (C("north") + 0.021).alias("n"))


def _snapped(spark, sf):
    odd = _odd(spark, sf)
    return odd.select("*", *(c.alias(n) for c, n in zip(grid.snapped(C("w"), C("s"), C("e"), C("n")), ("sw", "ss", "se", "sn"))))


@query("p18_snap_bounds", f"SELECT event_id, round(sw, 6) AS west, round(ss, 6) AS south, round(se, 6) AS east, round(sn, 6) AS north FROM (SELECT event_id, {_SNAP} FROM (SELECT event_id, {_ODD} FROM {{aoi}}))")
def p18(spark, sf):
    return _snapped(spark, sf).select("event_id", *(F.round(a, 6).alias(b) for a, b in (("sw", "west"), ("ss", "south"), ("se", "east"), ("sn", "north"))))


@query("p19_index_window", f"SELECT event_id, round_even((90 - sn) * 60, 0)::INT AS row0, round_even((90 - ss) * 60, 0)::INT AS row1, round_even((sw + 180) * 60, 0)::INT AS col0, round_even((se + 180) * 60, 0)::INT AS col1 FROM (SELECT event_id, {_SNAP} FROM (SELECT event_id, {_ODD} FROM {{aoi}}))")
def p19(spark, sf):
    w = grid.window(C("sw"), C("ss"), C("se"), C("sn"))
    return _snapped(spark, sf).select("event_id", *(c.alias(n) for c, n in zip(w, ("row0", "row1", "col0", "col1"))))


@query("p20_pixel_centres", "SELECT DISTINCT row_, col_, round(-180 + (col_ + 0.5) / 60, 6) AS x, round(90 - (row_ + 0.5) / 60, 6) AS y FROM {obs}")
def p20(spark, sf):
    x, y = grid.centre(C("row_"), C("col_"))
    return view(spark, sf, "obs").select("row_", "col_", F.round(x, 6).alias("x"), F.round(y, 6).alias("y")).distinct()


@query("p21_block_cover", """WITH b AS (SELECT event_id, ((90 - north) * 60)::INT AS row0, ((90 - south) * 60)::INT AS row1, ((west + 180) * 60)::INT AS col0, ((east + 180) * 60)::INT AS col1 FROM {aoi})
 SELECT event_id, r AS block_row, c AS block_col, printf('a512_r%02dc%03d', r, c) AS block_id FROM (SELECT event_id, r, unnest(generate_series(col0 // 512, (col1 - 1) // 512))::INT AS c FROM (SELECT *, unnest(generate_series(row0 // 512, (row1 - 1) // 512))::INT AS r FROM b))""")
def p21(spark, sf):
    boxes = view(spark, sf, "aoi").select("event_id", *(c.alias(n) for c, n in zip(grid.window(C("west"), C("south"), C("east"), C("north")), ("row0", "row1", "col0", "col1"))))
    return grid.blocks(boxes).select("event_id", "block_row", "block_col", "block_id")


@query("p22_trim_margin", f"""WITH t AS (SELECT *, CASE WHEN sw < w - 1e-6 / 60 THEN sw + 1.0::DOUBLE / 60 ELSE sw END tw, CASE WHEN se > e + 1e-6 / 60 THEN se - 1.0::DOUBLE / 60 ELSE se END te,
 CASE WHEN sn > n + 1e-6 / 60 THEN sn - 1.0::DOUBLE / 60 ELSE sn END tn, CASE WHEN ss < s - 1e-6 / 60 THEN ss + 1.0::DOUBLE / 60 ELSE ss END ts FROM (SELECT *, {_SNAP} FROM (SELECT event_id, {_ODD} FROM {{aoi}})))
 SELECT event_id, round(CASE WHEN tw < te THEN tw ELSE sw END, 6) AS west, round(CASE WHEN ts < tn THEN ts ELSE ss END, 6) AS south, round(CASE WHEN tw < te THEN te ELSE se END, 6) AS east, round(CASE WHEN ts < tn THEN tn ELSE sn END, 6) AS north FROM t""")
def p22(spark, sf):
    out = grid.trimmed((C("sw"), C("ss"), C("se"), C("sn")), (C("w"), C("s"), C("e"), C("n")))
    return _snapped(spark, sf).select("event_id", *(F.round(c, 6).alias(n) for c, n in zip(out, ("west", "south", "east", "north"))))


@query("p23_tiles_of_bbox", """SELECT event_id, h, v, (h * 10 - 180)::DOUBLE AS tile_west, (80 - v * 10)::DOUBLE AS tile_south FROM (SELECT event_id, h, unnest(generate_series(least(greatest(floor((90 - north) / 10)::INT, 0), 17), least(greatest(floor((90 - south) / 10)::INT, 0), 17)))::INT AS v
 FROM (SELECT *, unnest(generate_series(least(greatest(floor((west + 180) / 10)::INT, 0), 35), least(greatest(floor((east + 180) / 10)::INT, 0), 35)))::INT AS h FROM {aoi} WHERE west <= east))""")
def p23(spark, sf):
    out = grid.modis_tiles(view(spark, sf, "aoi"))
    west, south, _, _ = grid.tile_bounds(C("h"), C("v"))
    return out.select("event_id", "h", "v", west.cast("double").alias("tile_west"), south.cast("double").alias("tile_south"))


_NAME = "printf('MCDWD.A%s.h%02dv%02d.061.%s%06d.GLB%03d_x_%s.tif', strftime(o_orderdate, '%Y%j'), (o_custkey % 36)::INT, (o_orderkey % 18)::INT, strftime(o_orderdate, '%Y%j'), (o_orderkey % 1000000)::INT, (o_custkey % 137)::INT, strftime(o_orderdate, '%Y%m%d'))"


def _names(spark, sf):
    o = table(spark, sf, "orders")
    day = F.date_format("o_orderdate", "yyyyDDD")
    return o.select("o_orderkey", "o_orderdate", F.format_string("MCDWD.A%s.h%02dv%02d.061.%s%06d.GLB%03d_x_%s.tif", day, C("o_custkey") % 36, C("o_orderkey") % 18, day, C("o_orderkey") % 1000000, C("o_custkey") % 137, F.date_format("o_orderdate", "yyyyMMdd")).alias("name"))


@query("p24_parse_names", f"""SELECT o_orderkey, regexp_extract(name, '\\.h(\\d{{2}})v(\\d{{2}})\\.', 1)::INT AS h, regexp_extract(name, '\\.h(\\d{{2}})v(\\d{{2}})\\.', 2)::INT AS v, regexp_extract(name, '\\.(\\d{{13}})\\.', 1) AS stamp, regexp_extract(name, 'GLB(\\d{{3}})_', 1)::INT AS area FROM (SELECT o_orderkey, {_NAME} AS name FROM orders)""")
def p24(spark, sf):
    h, v = tx.tile_of_name(C("name"))
    return _names(spark, sf).select("o_orderkey", h.alias("h"), v.alias("v"), tx.production_stamp(C("name")).alias("stamp"), tx.area_of_name(C("name")).alias("area"))


@query("p25_match_names", f"SELECT o_orderkey, contains(name, printf('.h%02dv%02d.', (o_orderkey % 36)::INT, (o_orderkey % 18)::INT)) AS matches FROM (SELECT o_orderkey, {_NAME} AS name FROM orders)")
def p25(spark, sf):
    pattern = F.format_string(r"\.h%02dv%02d\.", C("o_orderkey") % 36, C("o_orderkey") % 18)
    return _names(spark, sf).select("o_orderkey", F.regexp_like("name", pattern).alias("matches"))


@query("p26_listing_paths", "SELECT o_orderkey, 'daily/' || strftime(o_orderdate, '%Y/%j') AS path FROM orders")
def p26(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", tx.listing_path("daily", C("o_orderdate")).alias("path"))


@query("p27_task_ids", "SELECT o_orderkey, printf('modis-%s-h%02dv%02d', strftime(o_orderdate, '%Y%m%d'), (o_custkey % 36)::INT, (o_orderkey % 18)::INT) AS modis_id, 'gfm-' || strftime(o_orderdate, '%Y%m%d') || '-' || regexp_replace(o_orderpriority, '[^A-Za-z0-9_]', '', 'g') AS gfm_id FROM orders")
def p27(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", tx.modis_task_id(C("o_orderdate"), C("o_custkey") % 36, C("o_orderkey") % 18).alias("modis_id"), tx.gfm_task_id(C("o_orderdate"), C("o_orderpriority")).alias("gfm_id"))


@query("p28_date_arithmetic", "SELECT task_id, date_diff('day', DATE '2020-01-01', date)::BIGINT AS days, date AS back, CAST(date + 14 AS DATE) AS padded FROM {tasks}")
def p28(spark, sf):
    days = tx.days_since(C("date"))
    return view(spark, sf, "tasks").select("task_id", days.alias("days"), tx.day_at(days).alias("back"), F.date_add("date", 14).alias("padded"))


@query("p28_date_tokens", "SELECT s_suppkey, try_strptime(tok, '%Y%m%d')::DATE AS date FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'aggregated' WHEN s_suppkey % 7 = 0 THEN '20231345' ELSE '2024' || lpad((s_suppkey % 12 + 1)::VARCHAR, 2, '0') || lpad((s_suppkey % 28 + 1)::VARCHAR, 2, '0') END AS tok FROM supplier)")
def p28b(spark, sf):
    two = lambda k: F.lpad((C("s_suppkey") % k + 1).cast("string"), 2, "0")
    token = F.when(C("s_suppkey") % 3 == 0, "aggregated").when(C("s_suppkey") % 7 == 0, "20231345").otherwise(F.concat(F.lit("2024"), two(12), two(28)))
    return table(spark, sf, "supplier").select("s_suppkey", tx.date_of_token(token).alias("date"))


@query("p29_expand_dates", "SELECT event_id, unnest(generate_series(d0, d0 + CAST(event_id AS INT), INTERVAL 1 DAY))::DATE AS date FROM {aoi}")
def p29(spark, sf):
    return tx.days_between(view(spark, sf, "aoi").withColumn("stop", F.expr("date_add(d0, event_id)")), "d0", "stop").select("event_id", "date")


@query("p30_sample_dates", """WITH a AS (SELECT event_id, d0, event_id AS span, least(5, event_id + 1) AS n FROM {aoi})
 SELECT DISTINCT event_id, (d0 + CASE WHEN n > 1 THEN floor(i * span / greatest(n - 1, 1))::INT ELSE 0 END)::DATE AS date FROM (SELECT *, unnest(generate_series(0, n - 1)) AS i FROM a)""")
def p30(spark, sf):
    return tx.sampled_days(view(spark, sf, "aoi").withColumn("stop", F.expr("date_add(d0, event_id)")), "d0", "stop", 5).select("event_id", "date")


@query("p31_list_cells", "SELECT n_nationkey, CASE WHEN n_nationkey % 4 = 0 THEN []::VARCHAR[] ELSE [x FOR x IN [trim(y) FOR y IN string_split('viirs, ' || n_name || ',,gfm ', ',')] IF x <> ''] END AS sources FROM nation")
def p31(spark, sf):
    return table(spark, sf, "nation").select("n_nationkey", tx.list_cell(F.when(C("n_nationkey") % 4 != 0, F.concat(F.lit("viirs, "), "n_name", F.lit(",,gfm ")))).alias("sources"))


@query("p32_mercator_inverse", "SELECT event_id, round(degrees(west * 100000 / 6378137.0), 6) AS lon, round(degrees(2 * atan(exp(south * 100000 / 6378137.0)) - pi() / 2), 6) AS lat FROM {aoi}")
def p32(spark, sf):
    points = tx.wkt_points(F.format_string("POINT(%.1f %.1f)", C("west") * 100000, C("south") * 100000))
    lon, lat = tx.from_mercator(points[0][0], points[0][1])
    return view(spark, sf, "aoi").select("event_id", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


@query("p32_asset_keys", "SELECT page_id, regexp_extract(url, '([^/]+?)(?:\\.[A-Za-z0-9]+)?$', 1) AS key FROM pages")
def p32b(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.asset_key(C("url")).alias("key"))


@query("p33_geojson", "SELECT event_id, (w || ',' || s) AS first_point, 5 AS n_points FROM (SELECT event_id, west::INT w, south::INT s FROM {aoi})")
def p33(spark, sf):
    made = view(spark, sf, "aoi").select("event_id", tx.polygon(*(C(n).cast("int") for n in ("west", "south", "east", "north"))).alias("g"))
    ring = F.from_json("g", "type string, coordinates array<array<array<int>>>")["coordinates"][0]
    return made.select("event_id", F.concat_ws(",", ring[0]).alias("first_point"), F.size(ring).alias("n_points"))


@query("p34_parse_settings", """SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN 2000 + n_nationkey END::INT AS year, CASE n_nationkey % 4 WHEN 0 THEN n_nationkey::BIGINT * 1000000000 WHEN 1 THEN n_nationkey::BIGINT * 1000000 WHEN 2 THEN n_nationkey END::BIGINT AS bytes FROM nation""")
def p34(spark, sf):
    k = C("n_nationkey")
    path = F.when(k % 3 == 0, F.concat(F.lit("s3://data/zarr/"), 2000 + k, F.lit("/"))).otherwise(F.lit("data/viirs_2020_cube"))
    size = F.concat(k.cast("string"), F.element_at(F.array(F.lit("GB"), F.lit(" mb"), F.lit(""), F.lit(" apples")), (k % 4 + 1).cast("int")))
    return table(spark, sf, "nation").select("n_nationkey", tx.prefill_year(path).alias("year"), tx.memory_bytes(size).alias("bytes"))


@query("p35_native_windows", "SELECT * FROM (VALUES (0, -1, 7), (1, 7, 15), (2, 15, 23), (3, 23, 31)) t(k, first, stop)")
def p35(spark, sf):
    rows = [(k, a, b) for k, (a, b) in enumerate(grid.native_windows(30, 8, 4, 3))]
    return spark.createDataFrame(rows, "k int, first int, stop int")


@query("p35_window_groups", "SELECT row_, col_, floor((row_ - 3) / 4.0)::INT AS grow, floor((col_ - 1) / 4.0)::INT AS gcol, count(*) AS n FROM {scene_px} GROUP BY ALL")
def p35b(spark, sf):
    return view(spark, sf, "scene_px").groupBy("row_", "col_", grid.group_of(C("row_"), 4, 3).alias("grow"), grid.group_of(C("col_"), 4, 1).alias("gcol")).agg(F.count("*").alias("n"))


@query("p36_rounded_boxes", "SELECT event_id, round_even(west / 7, 4) AS west, round_even(south / 7, 4) AS south FROM {aoi}")
def p36(spark, sf):
    return view(spark, sf, "aoi").select("event_id", F.bround(C("west") / 7, 4).alias("west"), F.bround(C("south") / 7, 4).alias("south"))


@query("p37_cache_keys", "SELECT page_id, md5(url || '/x.tif?y=1') || regexp_extract(regexp_replace(url || '/x.tif?y=1', '[?#].*$', ''), '(\\.[A-Za-z0-9]+)$', 1) AS key FROM pages")
def p37(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.cache_key(F.concat("url", F.lit("/x.tif?y=1"))).alias("key"))


@query("p38_collapse_legend", "SELECT CASE WHEN viirs_code BETWEEN 101 AND 200 THEN 100 ELSE viirs_code END AS code, count(*) AS n FROM {obs} GROUP BY ALL")
def p38(spark, sf):
    return view(spark, sf, "obs").groupBy(px.collapse_legend(C("viirs_code")).alias("code")).agg(F.count("*").alias("n"))
