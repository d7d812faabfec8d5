"""Queries of joins, set operations, selection, cube, tracking and validation (J, U, F, W, K, C, T, V, N)."""

from __future__ import annotations

import tempfile
from datetime import date

from pyspark.sql import functions as F

from ..functions import grid, text as tx
from ..operators import explore as ex, relational as rel, select as sl, validate as va
from .. import session
from ..plans import batch as bt, cube as cb, stac, tracker as tk, update as up
from ..sources import catalogue as src
from ..streaming import flows
from .base import query, table, view

C = F.col
_VIIRS = "CASE WHEN viirs_code BETWEEN 101 AND 200 THEN 1 ELSE 0 END"


# --- joins -----------------------------------------------------------------


@query("j01_area_enrichment", "SELECT task_id, n_name AS geometry FROM {tasks} t JOIN nation n ON t.event_id % 40 = n.n_nationkey")
def j01(spark, sf):
    areas = table(spark, sf, "nation").select(C("n_nationkey").cast("int").alias("aoi_id"), C("n_name").alias("geometry"))
    return rel.attach_areas(view(spark, sf, "tasks").withColumn("aoi_id", C("event_id") % 40), areas).select("task_id", "geometry")


@query("j02_item_counts", "SELECT event_id, coalesce(n, 0) AS n FROM {aoi} a LEFT JOIN (SELECT tile, count(*) AS n FROM {catalogue} GROUP BY tile) c ON a.event_id = c.tile")
def j02(spark, sf):
    n = view(spark, sf, "catalogue").groupBy(C("tile").alias("event_id")).agg(F.count("*").alias("n"))
    return view(spark, sf, "aoi").select("event_id").join(n, "event_id", "left").select("event_id", F.coalesce("n", F.lit(0)).alias("n"))


_MEETS = "c.date BETWEEN a.d0 AND a.d1 AND a.west < c.east AND c.west < a.east AND a.south < c.north AND c.south < a.north"


@query("j03_bbox_range_join", f"SELECT a.event_id, c.item, c.date, c.tile FROM {{aoi}} a JOIN {{catalogue}} c ON {_MEETS}")
def j03(spark, sf):
    return rel.box_join(view(spark, sf, "aoi"), view(spark, sf, "catalogue")).select("event_id", "item", "date", "tile")


@query("j04_item_counts_per_area", f"SELECT a.event_id, count(c.item) AS n_items, count(DISTINCT c.date) AS n_dates, count(DISTINCT CASE WHEN c.item IS NOT NULL THEN (c.date, c.tile) END) AS n_cells FROM {{aoi}} a LEFT JOIN {{catalogue}} c ON {_MEETS} GROUP BY a.event_id")
def j04(spark, sf):
    return rel.count_items(view(spark, sf, "aoi"), view(spark, sf, "catalogue"))


@query("j05_areas_meeting_bbox", "SELECT event_id FROM {aoi} WHERE west <= 20 AND east >= -100 AND south <= 50 AND north >= -20 ORDER BY event_id")
def j05(spark, sf):
    box = tuple(F.lit(float(x)) for x in (-100, -20, 20, 50))
    return view(spark, sf, "aoi").where(grid.meets_closed(tuple(C(n) for n in ("west", "south", "east", "north")), box)).select("event_id").orderBy("event_id")


@query("j06_listing_match", "SELECT d.date, t.tile, count(c.item) AS n FROM (SELECT DISTINCT date FROM {catalogue}) d CROSS JOIN (SELECT unnest(generate_series(0, 23))::INT AS tile) t LEFT JOIN {catalogue} c ON c.date = d.date AND c.tile = t.tile GROUP BY ALL")
def j06(spark, sf):
    cat = view(spark, sf, "catalogue")
    wanted = cat.select("date").distinct().withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(23))))
    return wanted.join(cat.select("date", "tile", "item"), ["date", "tile"], "left").groupBy("date", "tile").agg(F.count("item").alias("n"))


def _half(spark, sf, odd: int, value: str = "gfm_ref"):
    obs = view(spark, sf, "obs").where(F.floor(C("seq") / 16) % 2 == odd)
    return obs.groupBy("row_", "col_").agg(F.coalesce(F.max(F.when(C(value) != 255, C(value))), F.lit(255)).alias("v"))


def _half_sql(odd: int, value: str = "gfm_ref") -> str:
    return f"(SELECT row_, col_, coalesce(max(nullif({value}, 255)), 255) AS v FROM {{obs}} WHERE seq // 16 % 2 = {odd} GROUP BY row_, col_)"


@query("j07_inner_align", f"SELECT row_, col_, a.v AS a, b.v AS b FROM {_half_sql(0)} a JOIN {_half_sql(1)} b USING (row_, col_)")
def j07(spark, sf):
    return _half(spark, sf, 0).withColumnRenamed("v", "a").join(_half(spark, sf, 1).withColumnRenamed("v", "b"), ["row_", "col_"])


@query("j08_overlap_crop", f"SELECT count(*) AS n FROM {_half_sql(0)} a JOIN {_half_sql(1)} b USING (row_, col_) WHERE row_ BETWEEN 4 AND 11")
def j08(spark, sf):
    return _half(spark, sf, 0).where(cb.in_window(4, 12, 0, 16)).join(_half(spark, sf, 1), ["row_", "col_"]).agg(F.count("*").alias("n"))


@query("j09_pending_tasks", "SELECT task_id FROM {tasks} WHERE status IS DISTINCT FROM 'DONE'")
def j09(spark, sf):
    tasks = view(spark, sf, "tasks")
    return rel.pending(tasks.select("task_id"), tasks)


@query("j10_missing_dates", "SELECT DISTINCT date FROM {tasks} EXCEPT SELECT date FROM {tasks} WHERE status = 'DONE'")
def j10(spark, sf):
    tasks = view(spark, sf, "tasks")
    return rel.missing_dates(tasks, tasks.where("status = 'DONE'"))


@query("j11_complete_dates", "SELECT date, bool_and(coalesce(status = 'DONE', FALSE)) AS complete FROM {quarters} GROUP BY date")
def j11(spark, sf):
    t = view(spark, sf, "quarters")
    return rel.complete_dates(t.select("date", "task_id"), t.where("status = 'DONE'"))


@query("j12_seed_rows", "SELECT task_id, CASE WHEN status IS NOT NULL THEN status ELSE 'DONE' END AS status, 1 AS attempts FROM {tasks} WHERE status IS NOT NULL OR year(date) = 1996")
def j12(spark, sf):
    t = view(spark, sf, "tasks")
    return tk.seed(t.where("status IS NOT NULL").withColumn("attempts", F.lit(1)), t.select("task_id", "date"), t.where("year(date) = 1996"))


@query("j13_live_events", "SELECT DISTINCT event_id % 50 AS event_id FROM {tasks} WHERE year(date) NOT IN (1995, 1996, 1997)")
def j13(spark, sf):
    return view(spark, sf, "tasks").where(~F.year("date").isin(1995, 1996, 1997)).select((C("event_id") % 50).alias("event_id")).distinct()


@query("j14_bookmark_dates", "SELECT date, count(*) AS n FROM {obs} WHERE row_ BETWEEN 2 AND 9 AND col_ BETWEEN 0 AND 7 AND date IN (DATE '2024-01-03', DATE '2024-01-09') GROUP BY date")
def j14(spark, sf):
    marked = spark.sql("SELECT explode(array(DATE'2024-01-03', DATE'2024-01-09')) AS date")
    return view(spark, sf, "obs").where(cb.in_window(2, 10, 0, 8)).join(F.broadcast(marked), "date", "left_semi").groupBy("date").agg(F.count("*").alias("n"))


@query("j15_event_filter", "SELECT task_id FROM {tasks} WHERE event_id % 30 = 7 OR (event_id % 30 = 9 AND task_id % 4 = 2)")
def j15(spark, sf):
    rows = view(spark, sf, "tasks").select("task_id", (C("event_id") % 30).alias("event_id"), (C("task_id") % 4).alias("aoi_id"))
    return rel.select_events(rows, ["7", "9-2"]).select("task_id")


@query("j16_joint_diagnostics", """SELECT count(*) FILTER (f <> 255 AND rf <> 255) AS joint_flood, count(*) FILTER (f <> 255 AND rf <> 255 AND f > 0) AS classified_positive, count(*) FILTER (f <> 255 AND rf <> 255 AND rf > 0) AS raw_positive, count(*) FILTER (f <> 255 AND rf <> 255 AND f > 0 AND rf > 0) AS flood_intersection,
 count(*) FILTER (f <> 255 AND rf <> 255 AND rf > 0 AND f = 0) AS raw_only, count(*) FILTER (f <> 255 AND w <> 255 AND f > w) AS flood_over_water, count(*) FILTER (r <> 255 AND rr <> 255) AS joint_reference, count(*) FILTER (r <> 255 AND rr <> 255 AND r = rr) AS reference_agreement FROM (SELECT gfm_likelihood AS f, gfm_water * 50 AS w, gfm_flood AS rf, gfm_ref AS r, modis_code AS rr FROM {obs})""")
def j16(spark, sf):
    return va.joint_diagnostics(view(spark, sf, "obs").select(C("gfm_likelihood").alias("flood"), (C("gfm_water") * 50).alias("water"), C("gfm_flood").alias("raw_flood"), C("gfm_ref").alias("reference"), C("modis_code").alias("raw_reference")))


# --- set operations and filters --------------------------------------------


@query("u01_last_wins", "SELECT date, tile, max(item) FILTER (b = m) AS item FROM (SELECT *, max(b) OVER (PARTITION BY date, tile) AS m FROM (SELECT date, tile, min(item) AS item, 0 AS b FROM {catalogue} GROUP BY ALL UNION ALL SELECT date, tile, max(item), 1 FROM {catalogue} WHERE item % 3 = 0 GROUP BY ALL)) GROUP BY date, tile")
def u01(spark, sf):
    cat = view(spark, sf, "catalogue")
    old = cat.groupBy("date", "tile").agg(F.min("item").alias("item"))
    new = cat.where("item % 3 = 0").groupBy("date", "tile").agg(F.max("item").alias("item"))
    return rel.last_wins(new, old, ["date", "tile"])


@query("u02_first_wins", "SELECT date, tile, min(item) FILTER (b = m) AS item FROM (SELECT *, min(b) OVER (PARTITION BY date, tile) AS m FROM (SELECT date, tile, item, item % 3 AS b FROM {catalogue})) GROUP BY date, tile")
def u02(spark, sf):
    cat = view(spark, sf, "catalogue").select("date", "tile", "item")
    return rel.first_wins([cat.where(C("item") % 3 == k) for k in range(3)], ["date", "tile"])


@query("u03_replace_bookmarks", "SELECT event_id, d0 AS start_date FROM {aoi} WHERE event_id % 5 <> 0 UNION ALL SELECT event_id, DATE '2000-01-01' FROM {aoi} WHERE event_id % 5 = 0")
def u03(spark, sf):
    marks = view(spark, sf, "aoi").select("event_id", C("d0").alias("start_date"))
    return src.add_bookmark(marks, marks.where("event_id % 5 = 0").select("event_id", F.lit("2000-01-01").cast("date").alias("start_date")), overwrite=True)


@query("u04_axis_union", "SELECT date FROM {obs} UNION SELECT unnest(generate_series(DATE '2024-01-20', DATE '2024-02-05', INTERVAL 1 DAY))::DATE")
def u04(spark, sf):
    expected = spark.sql("SELECT explode(sequence(DATE'2024-01-20', DATE'2024-02-05')) AS date")
    return view(spark, sf, "obs").select("date").union(expected).distinct()


@query("u05_token_union", "SELECT event_id, list_sort(list_distinct(list_concat([d0, d1], [d0, CAST(d0 + CAST(event_id AS INT) AS DATE)]))) AS dates FROM {aoi}")
def u05(spark, sf):
    return view(spark, sf, "aoi").select("event_id", F.array_sort(F.array_union(F.array("d0", "d1"), F.array(C("d0"), F.expr("date_add(d0, event_id)")))).alias("dates"))


@query("u06_temporal_concat", "SELECT date, count(*) AS n FROM {obs} GROUP BY date")
def u06(spark, sf):
    obs = view(spark, sf, "obs")
    return obs.where("seq % 2 = 0").unionByName(obs.where("seq % 2 = 1")).groupBy("date").agg(F.count("*").alias("n"))


@query("f01_index_search", "SELECT item FROM {catalogue} WHERE west <= 30 AND east >= -20 AND south <= 40 AND north >= 0 AND date BETWEEN DATE '1996-01-01' AND DATE '1996-06-30'")
def f01(spark, sf):
    return rel.search(view(spark, sf, "catalogue"), (-20, 0, 30, 40), "1996-01-01", "1996-06-30").select("item")


@query("f02_property_filters", "SELECT patch FROM {patches} WHERE coalesce(pflood, 0) BETWEEN 10 AND 60 AND crank >= 1")
def f02(spark, sf):
    return rel.property_filter(view(spark, sf, "patches"), pflood=(10, 60), crank=(1, None)).select("patch")


@query("f03_first_cases", "SELECT actid, count(*) AS n FROM {patches} GROUP BY actid ORDER BY actid LIMIT 5")
def f03(spark, sf):
    return rel.first_cases(view(spark, sf, "patches").groupBy("actid").agg(F.count("*").alias("n")), limit=5, key="actid")


@query("f04_valid_delineation", "SELECT patch FROM {patches} WHERE patch % 9 - 2 >= 0 AND year(source_date) <= 2020")
def f04(spark, sf):
    post = F.expr("date_add(source_date, CAST(patch % 9 - 2 AS INT))")
    return view(spark, sf, "patches").where((post >= C("source_date")) & (F.year("source_date") <= 2020)).select("patch")


@query("f05_year_pruning", "SELECT count(*) AS n FROM {catalogue} WHERE year(date) IN (1996, 1998)")
def f05(spark, sf):
    return view(spark, sf, "catalogue").where(F.year("date").isin(1996, 1998)).agg(F.count("*").alias("n"))


@query("f06_layer_lookup", "SELECT * FROM (VALUES ('water_fraction', 'gfm', 'gfm', 'average'), ('raw', 'modis', 'modis', 'nearest'), ('shadow', 'modis', 'viirs', 'mode'), ('advisory_flags', 'viirs', 'gfm', 'nearest')) t(name, asked, found, resampling)")
def f06(spark, sf):
    from ..layers import find_layer, resampling_for

    rows = [(n, s, find_layer(n, s).source, resampling_for(n, s)) for n, s in (("water_fraction", "gfm"), ("raw", "modis"), ("shadow", "modis"), ("advisory_flags", "viirs"))]
    return spark.createDataFrame(rows, "name string, asked string, found string, resampling string")


# --- selection ---------------------------------------------------------------

_DAILY = f"(SELECT date, sum({_VIIRS})::BIGINT AS n FROM {{obs}} GROUP BY date)"


def _daily(spark, sf):
    return view(spark, sf, "obs").groupBy("date").agg(F.count_if(sl.raw_flood("viirs", C("viirs_code"))).alias("n"))


_MONTHLY = "(SELECT event_id % 12 AS event_id, date, count(*) AS n FROM {tasks} WHERE status = 'DONE' GROUP BY ALL)"


def _monthly(spark, sf):
    return view(spark, sf, "tasks").where("status = 'DONE'").groupBy((C("event_id") % 12).alias("event_id"), "date").agg(F.count("*").alias("n"))


@query("w01_flood_signal", "SELECT date, count(*) FILTER (viirs_code BETWEEN 101 AND 200) AS viirs, count(*) FILTER (modis_code = 3) AS modis, count(*) FILTER (modis_code IN (2, 3)) AS modis_recurring, count(*) FILTER (gfm_flood = 1) AS gfm FROM {obs} GROUP BY date")
def w01(spark, sf):
    n = lambda s, c, name, r=False: F.count_if(sl.raw_flood(s, C(c), r)).alias(name)
    return view(spark, sf, "obs").groupBy("date").agg(n("viirs", "viirs_code", "viirs"), n("modis", "modis_code", "modis"), n("modis", "modis_code", "modis_recurring", True), n("gfm", "gfm_flood", "gfm"))


@query("w01_fraction_signal", "SELECT date, count(*) FILTER (viirs_code BETWEEN 101 AND 200) AS n FROM {obs} GROUP BY date")
def w01b(spark, sf):
    from ..layers import VIIRS

    return VIIRS.derive_all(view(spark, sf, "obs"), {"raw": "viirs_code"}, ["flood_fraction"]).groupBy("date").agg(sl.flood_count(C("flood_fraction")).alias("n"))


@query("w02_peak_date", f"SELECT date, n FROM {_DAILY} ORDER BY n DESC, date LIMIT 1")
def w02(spark, sf):
    return sl.peak(_daily(spark, sf))


@query("w02_peak_per_event", f"SELECT event_id, date, n FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY n DESC, date) AS r FROM {_MONTHLY}) WHERE r = 1")
def w02b(spark, sf):
    return sl.peak(_monthly(spark, sf), ["event_id"])


@query("w03_peak_window", f"WITH d AS {_DAILY}, p AS (SELECT date AS p FROM d ORDER BY n DESC, date LIMIT 1) SELECT date, n FROM d, p WHERE date BETWEEN p - 3 AND p + 5")
def w03(spark, sf):
    return sl.peak_window(_daily(spark, sf), 3, 5).select("date", "n")


for _p, _key in {"post": "(d < 0), abs(d)", "pre": "(d > 0), abs(d)", "balanced": "abs(d), (d < 0)"}.items():

    @query(f"w04_subsample_{_p}", f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY date) AS rn FROM {_MONTHLY}), p AS (SELECT event_id, rn AS prn FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY n DESC, rn) AS k FROM r) WHERE k = 1),
 o AS (SELECT *, rn - prn AS d FROM r JOIN p USING (event_id)) SELECT event_id, date, n FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY {_key}) AS q FROM o) WHERE q <= 5""")
    def w04(spark, sf, p=_p):
        return sl.subsample(_monthly(spark, sf), 5, p, ["event_id"]).select("event_id", "date", "n")


@query("w05_cloud_aware_score", """WITH s AS (SELECT date, count(*) AS t, count(*) FILTER (modis_code = 255 OR seq % 40 > 1) AS m, count(*) FILTER (modis_code = 3 AND seq % 40 <= 1) AS f FROM {obs} GROUP BY date)
 SELECT date, round(CASE WHEN (t - m) / t < 0.05 THEN '-Infinity'::DOUBLE ELSE f / (t - m) * (1 - m / t) END, 6) AS score FROM s""")
def w05(spark, sf):
    gone = (C("modis_code") == 255) | (C("seq") % 40 > 1)
    s = view(spark, sf, "obs").groupBy("date").agg(F.count("*").alias("t"), F.count_if(gone).alias("m"), F.count_if((C("modis_code") == 3) & (C("seq") % 40 <= 1)).alias("f"))
    return s.select("date", F.round(sl.cloud_aware_score(C("f"), C("m"), C("t")), 6).alias("score"))


@query("w06_window_then_subsample", f"""WITH d AS {_DAILY}, p AS (SELECT date AS p FROM d ORDER BY n DESC, date LIMIT 1), w AS (SELECT *, row_number() OVER (ORDER BY date) AS rn FROM d, p WHERE date BETWEEN p - 4 AND p + 6), k AS (SELECT rn AS prn FROM w WHERE date = p)
 SELECT date, n FROM w, k ORDER BY abs(rn - prn), rn < prn LIMIT 4""")
def w06(spark, sf):
    return sl.subsample(sl.peak_window(_daily(spark, sf), 4, 6), 4).select("date", "n")


@query("w07_strategies", f"SELECT min(date) AS first, max(date) AS last, count(*) AS n_dates, sum(n)::BIGINT AS n FROM {_DAILY}")
def w07(spark, sf):
    return sl.strategy(_daily(spark, sf), "aggregate")


@query("w07_best_result", f"SELECT date, n FROM {_DAILY} ORDER BY CASE WHEN n > 0 THEN n ELSE 0 END DESC, date LIMIT 1")
def w07b(spark, sf):
    return sl.best_result(_daily(spark, sf))


@query("w08_row_slice", "SELECT item FROM {catalogue} ORDER BY date, item LIMIT 15 OFFSET 10")
def w08(spark, sf):
    return sl.row_slice(view(spark, sf, "catalogue").select("date", "item"), "10:25", ["date", "item"]).select("item")


@query("w09_recent_failures", "SELECT task_id FROM {tasks} WHERE status = 'FAILED' ORDER BY date DESC, task_id LIMIT 5")
def w09(spark, sf):
    return tk.recent_failures(view(spark, sf, "tasks").withColumnRenamed("date", "finished_at")).select("task_id")


_DONE_DAYS = "(SELECT DISTINCT date FROM {tasks} WHERE status = 'DONE')"


@query("w10_date_ranges", f"SELECT min(date) AS first, max(date) AS last, count(*) AS n_days FROM (SELECT date, date - row_number() OVER (ORDER BY date)::INT AS g FROM {_DONE_DAYS}) GROUP BY g")
def w10(spark, sf):
    return sl.islands(view(spark, sf, "tasks").where("status = 'DONE'").select("date"))


@query("w11_unsorted_spans", "WITH a AS (SELECT task_id AS i, event_id AS t FROM {tasks}), b AS (SELECT i, t <= lag(t) OVER (ORDER BY i) AS bad FROM a), c AS (SELECT i, i - row_number() OVER (ORDER BY i) AS g FROM b WHERE bad) SELECT min(i) AS first, max(i) AS last FROM c GROUP BY g")
def w11(spark, sf):
    return sl.unsorted_spans(view(spark, sf, "tasks").select(C("task_id").alias("i"), C("event_id").alias("t")))


@query("w12_watermark", "WITH s AS (SELECT date, bool_and(coalesce(status = 'DONE', FALSE)) AS d FROM {quarters} GROUP BY date) SELECT max(date) AS watermark FROM s WHERE date < coalesce((SELECT min(date) FROM s WHERE NOT d), DATE '9999-01-01')")
def w12(spark, sf):
    return sl.watermark(view(spark, sf, "quarters"))


_STATES = "(SELECT date, CASE WHEN bool_and(coalesce(status = 'DONE', FALSE)) THEN 'done' WHEN bool_or(coalesce(status = 'FAILED', FALSE)) THEN 'failed' ELSE 'pending' END AS state, count(*) AS n_tasks FROM {tasks} GROUP BY date)"


@query("w13_date_states", f"SELECT date, state, n_tasks FROM {_STATES}")
def w13(spark, sf):
    return sl.date_states(view(spark, sf, "tasks"))


@query("w13_year_summary", f"WITH c AS (SELECT unnest(generate_series(DATE '1997-01-01', DATE '1997-12-31', INTERVAL 1 DAY))::DATE AS date) SELECT coalesce(state, 'empty') AS state, count(*) AS n_days FROM c LEFT JOIN {_STATES} s USING (date) GROUP BY ALL")
def w13b(spark, sf):
    states = sl.date_states(view(spark, sf, "tasks"))
    return cb.prefill(spark, 1997).join(states, "date", "left").groupBy(F.coalesce("state", F.lit("empty")).alias("state")).agg(F.count("*").alias("n_days"))


@query("w14_sample_done", "SELECT date, min(task_id) AS task_id FROM {tasks} WHERE status = 'DONE' GROUP BY date ORDER BY date LIMIT 7")
def w14(spark, sf):
    return sl.sample_done(view(spark, sf, "tasks"), 7)


@query("w15_cap_by_event", "WITH e AS (SELECT event_id, sum(n) OVER (ORDER BY event_id) AS s FROM (SELECT event_id, count(*) AS n FROM {tasks} GROUP BY event_id)) SELECT task_id, event_id FROM {tasks} WHERE event_id IN (SELECT event_id FROM e WHERE s <= 100)")
def w15(spark, sf):
    return sl.cap_by_event(view(spark, sf, "tasks"), 100).select("task_id", "event_id")


@query("w16_monthly_state", f"SELECT CAST(date_trunc('month', date) AS DATE) AS month, CASE WHEN count(state) = 0 THEN 'empty' WHEN count(*) FILTER (state = 'done') = count(state) THEN 'done' WHEN count(*) FILTER (state = 'failed') > 0 THEN 'failed' ELSE 'pending' END AS state, count(state) AS n_days FROM {_STATES} GROUP BY ALL")
def w16(spark, sf):
    return sl.monthly_state(sl.date_states(view(spark, sf, "tasks")))


@query("w17_sample_events", """WITH e AS (SELECT actid AS event_id, sum(area_km2) AS area, avg(south) AS lat FROM {patches} GROUP BY actid), s AS (SELECT event_id, 'small' AS pick FROM e ORDER BY area, event_id LIMIT 2), l AS (SELECT event_id, 'large' AS pick FROM e ORDER BY area DESC, event_id LIMIT 2),
 q AS (SELECT quantile_cont(lat, 1 / 3.0) AS a, quantile_cont(lat, 2 / 3.0) AS b FROM e), r AS (SELECT *, (lat > a)::INT + (lat > b)::INT AS band FROM e, q WHERE event_id NOT IN (SELECT event_id FROM s UNION SELECT event_id FROM l)),
 t AS (SELECT event_id, 'band' || band AS pick FROM (SELECT *, row_number() OVER (PARTITION BY band ORDER BY area DESC, event_id) AS k FROM r) WHERE k = 1) SELECT * FROM s UNION ALL SELECT * FROM l UNION ALL SELECT * FROM t""")
def w17(spark, sf):
    e = view(spark, sf, "patches").groupBy(C("actid").alias("event_id")).agg(F.sum("area_km2").alias("area"), F.avg("south").alias("lat"))
    return sl.sample_events(e)


# --- cube --------------------------------------------------------------------

_CUBE = "(SELECT date, row_, col_, arg_max(gfm_ref, CASE WHEN gfm_ref <> 255 THEN seq ELSE -1e9 + seq END) AS v FROM {obs} GROUP BY ALL)"


def _new(df):
    return df.select("date", "row_", "col_", C("gfm_ref").alias("v"), "seq")


def _cube(spark, sf):
    new = _new(view(spark, sf, "obs"))
    return cb.masked_upsert(new.select("date", "row_", "col_", "v").limit(0), new, ["date", "row_", "col_"])


@query("k06_masked_upsert", """WITH o AS (SELECT date, row_, col_, arg_max(gfm_ref, CASE WHEN gfm_ref <> 255 THEN seq ELSE -1e9 + seq END) AS v FROM {obs} WHERE seq // 16 % 2 = 0 GROUP BY ALL), n AS (SELECT date, row_, col_, arg_max(gfm_ref, CASE WHEN gfm_ref <> 255 THEN seq ELSE -1e9 + seq END) AS v FROM {obs} WHERE seq // 16 % 2 = 1 GROUP BY ALL)
 SELECT date, row_, col_, CASE WHEN n.v IS NULL OR (n.v = 255 AND o.v IS NOT NULL) THEN o.v ELSE n.v END AS v FROM o FULL JOIN n USING (date, row_, col_)""")
def k06(spark, sf):
    obs, keys = view(spark, sf, "obs"), ["date", "row_", "col_"]
    first = _new(obs.where("seq DIV 16 % 2 = 0"))
    old = cb.masked_upsert(first.select(*keys, "v").limit(0), first, keys)
    return cb.masked_upsert(old, _new(obs.where("seq DIV 16 % 2 = 1")), keys)


@query("k09_time_slots", "SELECT date, row_number() OVER (ORDER BY date) - 1 AS slot FROM (SELECT DISTINCT date FROM {obs})")
def k09(spark, sf):
    return cb.time_slots(view(spark, sf, "obs"))


@query("k10_prefill_year", "SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-12-31', INTERVAL 1 DAY))::DATE AS date")
def k10(spark, sf):
    return cb.prefill(spark, 2024)


@query("k11_reindex_axis", f"""WITH c AS (SELECT DISTINCT row_, col_ FROM {{obs}}), a AS (SELECT DISTINCT date FROM {_CUBE} UNION SELECT unnest(generate_series(DATE '2024-01-20', DATE '2024-02-10', INTERVAL 1 DAY))::DATE) SELECT date, row_, col_, coalesce(v, 255) AS v FROM a CROSS JOIN c LEFT JOIN {_CUBE} p USING (date, row_, col_)""")
def k11(spark, sf):
    cells = view(spark, sf, "obs").select("row_", "col_").distinct()
    return cb.reindexed(_cube(spark, sf), spark.sql("SELECT explode(sequence(DATE'2024-01-20', DATE'2024-02-10')) AS date"), cells)


@query("k14_bookmark_union", "SELECT event_id % 12 AS event_id, list_sort(list_distinct(list(date))) AS dates FROM {tasks} WHERE status = 'DONE' GROUP BY ALL")
def k14(spark, sf):
    return view(spark, sf, "tasks").where("status = 'DONE'").groupBy((C("event_id") % 12).alias("event_id")).agg(F.array_sort(F.collect_set("date")).alias("dates"))


@query("k16_remove_bookmarks", "SELECT event_id FROM {aoi} WHERE event_id % 4 <> 1")
def k16(spark, sf):
    marks = view(spark, sf, "aoi").select("event_id")
    return src.remove_bookmark(marks, marks.where("event_id % 4 = 1"))


@query("c01_read_window", f"SELECT date, row_, col_, CASE WHEN v <> 255 THEN v * 0.01::DOUBLE END AS value FROM {_CUBE} WHERE date BETWEEN DATE '2024-01-03' AND DATE '2024-01-08' AND row_ BETWEEN 2 AND 9 AND col_ BETWEEN 4 AND 11")
def c01(spark, sf):
    from ..functions.pixels import decode_percent

    return _cube(spark, sf).where(C("date").between("2024-01-03", "2024-01-08") & cb.in_window(2, 10, 4, 12)).select("date", "row_", "col_", decode_percent(C("v")).alias("value"))


def _written(spark, sf):
    """All observations through the cube's own writes: even batches first, then odd ones."""
    cube = cb.Cube(spark, session.scratch(spark))
    rows = _new(view(spark, sf, "obs")).select(F.lit("gfm").alias("source"), F.lit("reference_water").alias("layer"), "date", "row_", "col_", "v", "seq")
    for odd in (0, 1):
        cube.write(rows.where(f"seq DIV 16 % 2 = {odd}"))
    return cube


_TWICE = """(WITH o AS (SELECT date, row_, col_, arg_max(gfm_ref, CASE WHEN gfm_ref <> 255 THEN seq ELSE -1e9 + seq END) AS v FROM {obs} WHERE seq // 16 % 2 = 0 GROUP BY ALL), n AS (SELECT date, row_, col_, arg_max(gfm_ref, CASE WHEN gfm_ref <> 255 THEN seq ELSE -1e9 + seq END) AS v FROM {obs} WHERE seq // 16 % 2 = 1 GROUP BY ALL)
 SELECT date, row_, col_, CASE WHEN n.v IS NULL OR (n.v = 255 AND o.v IS NOT NULL) THEN o.v ELSE n.v END AS v FROM o FULL JOIN n USING (date, row_, col_))"""


@query("k07_cube_writes", f"SELECT 'gfm' AS source, date, row_, col_, v FROM {_TWICE}")
def k07(spark, sf):
    return _written(spark, sf).read_all().select("source", "date", "row_", "col_", "v")


@query("c01_cube_read", f"SELECT date, row_, col_, CASE WHEN v <> 255 THEN v * 0.01::DOUBLE END AS value FROM {_TWICE} WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND row_ BETWEEN 3 AND 9 AND col_ BETWEEN 2 AND 12")
def c01b(spark, sf):
    box = (-180 + 2 / 60, 90 - 10 / 60, -180 + 13 / 60, 90 - 3 / 60)
    return _written(spark, sf).read("gfm", box, "2024-01-05", "2024-01-20").select("date", "row_", "col_", "value")


@query("c02_event_read", f"SELECT date, row_, col_, CASE WHEN v <> 255 THEN v * 0.01::DOUBLE END AS value FROM {_TWICE} WHERE date IN (DATE '2024-01-04', DATE '2024-01-09', DATE '2024-01-21') AND row_ BETWEEN 0 AND 7 AND col_ BETWEEN 4 AND 15")
def c02(spark, sf):
    cube, box = _written(spark, sf), (-180 + 4 / 60, 90 - 8 / 60, -180 + 16 / 60, 90.0)
    cube.bookmark("flood", "gfm", box, [date(2024, 1, 9), date(2024, 1, 4)])
    cube.bookmark("flood", "gfm", box, [date(2024, 1, 21), date(2024, 1, 9)])
    return cube.read("gfm", event="flood").select("date", "row_", "col_", "value")


@query("c03_tile_read", f"SELECT count(*) AS n, count(*) FILTER (v <> 255) AS n_valid, 0::BIGINT AS elsewhere FROM {_TWICE}")
def c03(spark, sf):
    cube = _written(spark, sf)
    here, other = cube.read("gfm", tiles=[(0, 0), (20, 9)]), cube.read("gfm", tiles=[(1, 0), (0, 1)])
    return here.agg(F.count("*").alias("n"), F.count("value").alias("n_valid")).crossJoin(other.agg(F.count("*").alias("elsewhere")))


@query("c04_sources_events", "SELECT 'flood' AS event_id, ['gfm', 'modis'] AS sources, 'gfm' AS source")
def c04(spark, sf):
    cube = _written(spark, sf)
    for source in ("modis", "gfm"):
        cube.bookmark("flood", source, (0, 0, 1, 1), [date(2024, 1, 1)])
    return cube.events().crossJoin(cube.sources())


@query("c05_axis_dates", f"SELECT DISTINCT date FROM {_CUBE}")
def c05(spark, sf):
    return _cube(spark, sf).select("date").distinct()


@query("c06_all_nodata_dates", f"SELECT date, bool_and(v = 255) AS empty_ FROM {_CUBE} GROUP BY date")
def c06(spark, sf):
    return _cube(spark, sf).groupBy("date").agg(F.bool_and(C("v") == 255).alias("empty_"))


_ITEMS = f"(SELECT 'gfm-' || strftime(date, '%Y%m%d') AS id, 'gfm' AS source, date, round_even(-180 + min(col_) / 60, 6) AS west, round_even(90 - (max(row_) + 1) / 60, 6) AS south, round_even(-180 + (max(col_) + 1) / 60, 6) AS east, round_even(90 - min(row_) / 60, 6) AS north, count(*) AS n_valid FROM {_CUBE} WHERE v <> 255 GROUP BY date)"


def _stac(spark, sf):
    return stac.items(_cube(spark, sf).withColumn("source", F.lit("gfm")))


@query("c07_stac_items", f"SELECT * FROM {_ITEMS}")
def c07(spark, sf):
    return _stac(spark, sf)


@query("c07_stac_collections", f"SELECT source, min(west) AS west, min(south) AS south, max(east) AS east, max(north) AS north, min(date) AS first, max(date) AS last, count(*) AS n_items FROM {_ITEMS} GROUP BY source")
def c07b(spark, sf):
    return stac.collections(_stac(spark, sf))


@query("k17_stac_documents", f"""SELECT id, id AS body_id, 'Feature' AS kind, source AS collection, [west, south, east, north] AS bbox, 'Polygon' AS shape, [[west, south], [east, south], [east, north], [west, north], [west, south]] AS ring,
 CAST(date AS VARCHAR) || 'T00:00:00Z' AS at, 'cube/source=' || source || '/date=' || CAST(date AS VARCHAR) AS href FROM {_ITEMS}""")
def k17(spark, sf):
    got = lambda path, name, kind="string": F.from_json(F.get_json_object("body", path), kind).alias(name) if kind != "string" else F.get_json_object("body", path).alias(name)
    return stac.documents(_stac(spark, sf)).select("id", got("$.id", "body_id"), got("$.type", "kind"), got("$.collection", "collection"), got("$.bbox", "bbox", "array<double>"), got("$.geometry.type", "shape"), got("$.geometry.coordinates[0]", "ring", "array<array<double>>"), got("$.properties.datetime", "at"), got("$.assets.data.href", "href"))


@query("c08_items_with_assets", "SELECT prefix, list_sort(list(DISTINCT name)) AS names FROM (SELECT 'k/' || (patch % 40) || '/' AS prefix, CASE patch % 3 WHEN 0 THEN 'info' WHEN 1 THEN 'mask' ELSE 'dem' END AS name FROM {patches}) GROUP BY prefix")
def c08(spark, sf):
    p = C("patch")
    prefix = F.format_string("k/%d/", p % 40)
    keys = view(spark, sf, "patches").select(F.concat(prefix, F.when(p % 3 == 0, "info.json").when(p % 3 == 1, "mask.tif").otherwise("dem.tif")).alias("key"))
    rows = view(spark, sf, "patches").select(prefix.alias("prefix")).distinct()
    return stac.with_assets(rows, keys).select("prefix", F.array_sort(F.transform("assets", lambda a: a["name"])).alias("names"))


# --- sources -----------------------------------------------------------------


@query("s11_listing_json", "SELECT o_orderkey, [o_orderpriority, o_orderstatus || '.tif'] AS names FROM orders")
def s11(spark, sf):
    entries = F.format_string('[{"name":"%s"},{"name":"%s.tif"}]', "o_orderpriority", "o_orderstatus")
    body = F.concat(F.when(C("o_orderkey") % 2 == 0, '{"content":').otherwise('{"items":'), entries, F.lit("}"))
    return table(spark, sf, "orders").select("o_orderkey", src.listing_names(body).alias("names"))


@query("s12_listing_html", "SELECT page_id, list_sort(list_distinct(regexp_extract_all(html, '(?i)href=\"([^\"]+)\"', 1))) AS names FROM pages")
def s12(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.array_sort(src.href_names(C("html"))).alias("names"))


@query("s13_listing_xml", "SELECT n_nationkey, [n_name || '.tif', 'b.tif'] AS keys, [2012, 2013 + n_nationkey % 3] AS years FROM nation")
def s13(spark, sf):
    xml = F.concat(F.lit("<L><Key>"), "n_name", F.lit(".tif</Key><Key>b.tif</Key><CommonPrefixes><Prefix>x/"), (2013 + C("n_nationkey") % 3).cast("string"), F.lit("/</Prefix></CommonPrefixes><CommonPrefixes><Prefix>x/2012/</Prefix></CommonPrefixes><CommonPrefixes><Prefix>x/docs/</Prefix></CommonPrefixes></L>"))
    return table(spark, sf, "nation").select("n_nationkey", src.xml_keys(xml).alias("keys"), src.xml_years(xml).alias("years"))


@query("s21_fetcher_source", "SELECT strftime(d, '%Y%m%d') AS date, h, v, 'modis-' || strftime(d, '%Y%m%d') || '-' || t AS task_id, 'daily/' || strftime(d, '%Y%m%d') || '/' || t || '.tif' AS source_uri FROM (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-05', INTERVAL 1 DAY)) AS d), (VALUES (18, 4, 'h18v04'), (19, 5, 'h19v05')) x(h, v, t)")
def s21(spark, sf):
    from ..sources.fetchers import use_fetchers

    use_fetchers(spark)
    return spark.read.format("granule_calendar").options(start="2024-01-01", end="2024-01-05", tiles="h18v04,h19v05").load()


# --- tracking ----------------------------------------------------------------


@query("t04_ordered_release", "SELECT t.task_id FROM {quarters} t WHERE t.status = 'DONE' AND NOT EXISTS (SELECT 1 FROM {quarters} e WHERE e.date < t.date AND (e.status IS NULL OR e.status NOT IN ('DONE', 'FAILED')))")
def t04(spark, sf):
    return flows.released(view(spark, sf, "quarters")).select("task_id")


@query("t04_drain", "SELECT t.task_id FROM {quarters} t WHERE t.status = 'DONE' AND EXISTS (SELECT 1 FROM {quarters} e WHERE e.date < t.date AND (e.status IS NULL OR e.status NOT IN ('DONE', 'FAILED')))")
def t04b(spark, sf):
    return flows.drained(view(spark, sf, "quarters")).select("task_id")


@query("t05_tracker_upsert", "SELECT task_id, CASE WHEN task_id % 3 = 0 THEN 'DONE' WHEN task_id % 3 = 1 THEN 'FAILED' ELSE status END AS status, CASE WHEN task_id % 3 = 0 THEN coalesce(CASE WHEN status IS NOT NULL THEN event_id % 4 END, 0) + 1 WHEN task_id % 3 = 1 THEN 9 ELSE event_id % 4 END::INT AS attempts FROM {tasks} WHERE status IS NOT NULL OR task_id % 3 < 2")
def t05(spark, sf):
    t = view(spark, sf, "tasks")
    new = t.where("task_id % 3 < 2").select("task_id", F.when(C("task_id") % 3 == 0, "DONE").otherwise("FAILED").alias("status"), F.lit(9).alias("attempts"))
    return tk.mark(t.where("status IS NOT NULL").select("task_id", "status", (C("event_id") % 4).alias("attempts")), new)


@query("t05_requeue", "SELECT task_id, status FROM {tasks} WHERE status <> 'FAILED'")
def t05b(spark, sf):
    t = view(spark, sf, "tasks").where("status IS NOT NULL").select("task_id", "status")
    return tk.requeue(t, t.where("status = 'FAILED'"))


@query("t06_reconcile", """WITH c AS (SELECT date, bool_and(coalesce(status = 'DONE', FALSE)) AS d FROM {tasks} WHERE year(date) < 2000 GROUP BY date), a AS (SELECT DISTINCT date FROM {tasks} WHERE event_id % 3 = 0)
 SELECT date, 'requeue' AS action FROM c WHERE d AND date NOT IN (SELECT date FROM a) UNION ALL SELECT date, 'orphan' FROM a WHERE date NOT IN (SELECT date FROM c)""")
def t06(spark, sf):
    t = view(spark, sf, "tasks")
    return tk.reconcile(t.where("year(date) < 2000").select("task_id", "date"), t, t.where("event_id % 3 = 0").select("date"))


@query("t07_update_windows", "SELECT * FROM (VALUES (1, 2023, DATE '2023-11-06', DATE '2023-12-06', 'weekly'), (1, 2024, DATE '2024-01-01', DATE '2024-01-18', 'catch-up'), (2, 2024, DATE '2024-03-27', DATE '2024-04-08', 'weekly'), (3, 2023, DATE '2023-12-20', DATE '2023-12-31', 'reconciliation'), (3, 2024, DATE '2024-01-01', DATE '2024-01-05', 'reconciliation')) t(run, year, start, stop, kind)")
def t07(spark, sf):
    runs = [
        (1, tk.update_windows(date(2024, 1, 20), {2023: date(2023, 11, 5), 2024: None})),
        (2, tk.update_windows(date(2024, 4, 10), {2024: date(2024, 4, 2)})),
        (3, tk.update_windows(date(2024, 4, 10), {}, start=date(2023, 12, 20), end=date(2024, 1, 5))),
    ]
    return spark.createDataFrame([(k, w.year, w.start, w.end, w.kind) for k, ws in runs for w in ws], "run int, year int, start date, stop date, kind string")


@query("t09_hole_check", "SELECT d::DATE AS date FROM (SELECT unnest(generate_series(DATE '2001-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS d) WHERE d::DATE NOT IN (SELECT date FROM {tasks})")
def t09(spark, sf):
    return rel.missing_dates(cb.prefill(spark, 2001), view(spark, sf, "tasks"))


@query("t11_status_report", """WITH t AS (SELECT task_id, date, status FROM {quarters}), s AS (SELECT date, CASE WHEN bool_and(coalesce(status = 'DONE', FALSE)) THEN 'done' WHEN bool_or(coalesce(status = 'FAILED', FALSE)) THEN 'failed' ELSE 'pending' END AS state FROM t GROUP BY date),
 m AS (SELECT date FROM s WHERE date NOT IN (SELECT date FROM t WHERE status = 'DONE' AND year(date) < 1997)), g AS (SELECT min(date) AS first, max(date) AS last, count(*) AS n FROM (SELECT date, date - row_number() OVER (ORDER BY date)::INT AS g FROM m) GROUP BY g)
 SELECT count(*) AS total, count(*) FILTER (status = 'DONE') AS done, count(*) FILTER (status = 'FAILED') AS failed, count(*) FILTER (status IS DISTINCT FROM 'DONE') AS remaining,
 (SELECT count(*) FROM s WHERE state = 'done') AS days_done, (SELECT count(*) FROM s WHERE state = 'pending') AS days_pending, (SELECT count(*) FROM s WHERE state = 'failed') AS days_failed,
 (SELECT count(*) FROM g) AS n_gaps, (SELECT min(first) FROM g) AS first_gap, (SELECT count(DISTINCT date) FROM t WHERE status = 'DONE' AND year(date) < 1997) AS archive_dates,
 (SELECT max(date) FROM s WHERE date < coalesce((SELECT min(date) FROM s WHERE state <> 'done'), DATE '9999-01-01')) AS watermark,
 (SELECT list(i ORDER BY i) FROM (SELECT CAST(task_id AS VARCHAR) AS i FROM t WHERE status = 'FAILED' ORDER BY i LIMIT 5)) AS recent_failed FROM t""")
def t11(spark, sf):
    tasks = view(spark, sf, "quarters").withColumn("task_id", C("task_id").cast("string"))
    tracker = tasks.where("status IS NOT NULL").withColumn("attempts", F.lit(1))
    out = up.status_report(tasks.select("task_id", "date"), tracker, tasks.where("status = 'DONE' AND year(date) < 1997").select("date"))
    days = lambda state: F.coalesce(F.try_element_at("state_counts", F.lit(state)), F.lit(0)).cast("long").alias(f"days_{state}")
    return out.select("total", "done", "failed", "remaining", days("done"), days("pending"), days("failed"), F.size("missing_ranges").cast("long").alias("n_gaps"), C("missing_ranges")[0]["first"].alias("first_gap"), "archive_dates", "watermark", "recent_failed")


@query("t15_catalogue_refresh", """WITH o AS (SELECT CAST(item AS VARCHAR) AS task_id, date, CAST(tile AS VARCHAR) AS tile, 'old' AS uri, row_number() OVER (PARTITION BY date, tile ORDER BY item) AS r FROM {catalogue} WHERE item % 2 = 0),
 n AS (SELECT CAST(item AS VARCHAR) AS task_id, date, CAST(tile AS VARCHAR) AS tile, 'new' AS uri, row_number() OVER (PARTITION BY date, tile ORDER BY item) AS r FROM {catalogue} WHERE item % 2 = 1)
 SELECT coalesce(n.task_id, o.task_id) AS task_id, date, tile, coalesce(n.uri, o.uri) AS uri FROM (SELECT * FROM o WHERE r = 1) o FULL JOIN (SELECT * FROM n WHERE r = 1) n USING (date, tile) WHERE year(date) = 1996""")
def t15(spark, sf):
    at = f"{session.scratch(spark)}/catalogue"
    first = view(spark, sf, "catalogue").groupBy("date", C("tile").cast("string").alias("tile"), (C("item") % 2).alias("odd")).agg(F.min("item").cast("string").alias("task_id"))
    for odd, uri in ((0, "old"), (1, "new")):
        found, _ = up.refresh_catalogue(spark, at, first.where(C("odd") == odd).select("task_id", "date", "tile", F.lit(uri).alias("uri")), 1996)
    return found


@query("t02_tracked_batch", """SELECT CAST(task_id AS VARCHAR) AS task_id, CASE WHEN status = 'DONE' OR task_id % 5 <> 0 THEN 'DONE' ELSE 'FAILED' END AS status, CASE WHEN status = 'DONE' THEN 1 WHEN task_id % 5 <> 0 THEN 1 ELSE 2 END::INT AS attempts FROM {tasks} WHERE year(date) = 1996""")
def t02(spark, sf):
    tasks = view(spark, sf, "tasks").where("year(date) = 1996").select(C("task_id").cast("string").alias("task_id"), "date", "status")
    tracker = bt.Tracker(spark, f"{session.scratch(spark)}/tracker")
    tracker.write(tasks.where("status = 'DONE'").withColumn("attempts", F.lit(1)))
    bt.run_batch(tasks.select("task_id", "date"), tracker, _made, lambda pixels: None, attempts=2, wait=0.0)
    return tracker.read()


def _made(task):
    """A toy granule of one pixel; every fifth task fails."""
    if int(task["task_id"]) % 5 == 0:
        raise OSError("no granule")
    return [("water_fraction", task["date"], int(task["task_id"]) % 8, int(task["task_id"]) // 8 % 8, int(task["task_id"]) % 101)]


@query("t03_cube_batch", """SELECT 'modis' AS source, 'water_fraction' AS layer, date, CAST(task_id % 8 AS INT) AS row_, CAST(task_id // 8 % 8 AS INT) AS col_, CAST(arg_max(task_id % 101, CAST(task_id AS VARCHAR)) AS INT) AS v FROM {tasks} WHERE year(date) = 1996 AND task_id % 5 <> 0 GROUP BY ALL""")
def t03(spark, sf):
    at = session.scratch(spark)
    cube, tracker = cb.Cube(spark, f"{at}/archive"), bt.Tracker(spark, f"{at}/tracker")
    bt.run_cube_batch("modis", view(spark, sf, "tasks").where("year(date) = 1996").select(C("task_id").cast("string").alias("task_id"), "date"), cube, tracker, _made, attempts=1)
    return cube.read_all()


@query("t08_update_run", """WITH d AS (SELECT task_id, date FROM {tasks} WHERE year(date) = 1996 AND date <= DATE '1996-02-15'), c AS (SELECT date, task_id % 24 AS tile, max(task_id) AS task_id FROM d GROUP BY ALL)
 SELECT CASE WHEN date <= DATE '1996-01-31' THEN 1 ELSE 2 END AS run, count(*) AS total, count(*) FILTER (task_id % 5 <> 0) AS done, count(*) FILTER (task_id % 5 = 0) AS failed FROM c GROUP BY 1""")
def t08(spark, sf):
    at = session.scratch(spark)
    rows = view(spark, sf, "tasks").groupBy("date", (C("task_id") % 24).cast("string").alias("tile")).agg(F.max("task_id").cast("string").alias("task_id")).withColumn("uri", F.lit("u"))
    update = up.Update(spark, "modis", at, tempfile.mkdtemp(prefix="hydrocube-lock-"), lambda w: rows.where(C("date").between(F.lit(w.start), F.lit(w.end))), _made, attempts=1)
    windows = [tk.YearWindow(1996, date(1996, 1, 1), date(1996, 1, 31), "catch-up"), tk.YearWindow(1996, date(1996, 2, 1), date(1996, 2, 15), "catch-up")]
    years = update.run(windows)["years"]
    return spark.createDataFrame([(k, y["total"], y["done"], y["failed_tasks"]) for k, y in enumerate(years, 1)], "run int, total long, done long, failed long")


@query("t16_axis_checks", "SELECT 'sorted' AS name, FALSE AS passed UNION ALL SELECT 'whole', count(DISTINCT date) = 30 FROM {obs} UNION ALL SELECT 'in_year', bool_and(year(date) = 2024) FROM {obs}")
def t16(spark, sf):
    return tk.validate_axis(view(spark, sf, "obs").select(C("seq").alias("i"), "date"), 2024, 30)


# --- validation --------------------------------------------------------------


@query("v01_compare_rasters", f"""WITH x AS (SELECT CASE WHEN a.v <> 255 THEN a.v ELSE 0 END AS a, CASE WHEN b.v <> 255 THEN b.v ELSE 0 END AS b FROM {_half_sql(0, 'gfm_likelihood')} a JOIN {_half_sql(1, 'gfm_likelihood')} b USING (row_, col_)), n AS (SELECT (SELECT count(*) FROM {_half_sql(0, 'gfm_likelihood')}) AS na, (SELECT count(*) FROM {_half_sql(1, 'gfm_likelihood')}) AS nb)
 SELECT round(count(*) / least(any_value(na), any_value(nb)), 6) AS overlap_ratio, round(avg((a <> b)::INT), 6) AS mismatch_ratio, round(avg(abs(a - b)), 6) AS mean_abs_diff, round(count(*) FILTER (a > 0 AND b > 0) / count(*) FILTER (a > 0), 6) AS active_recall, overlap_ratio >= 0.95 AND mismatch_ratio <= 0.03 AND mean_abs_diff <= 0.5 AND active_recall >= 0.30 AS passed FROM x, n""")
def v01(spark, sf):
    out = va.compare_rasters(_half(spark, sf, 0, "gfm_likelihood"), _half(spark, sf, 1, "gfm_likelihood"), ["row_", "col_"])
    return out.select(*(F.round(c, 6).alias(c) for c in out.columns if c != "passed"), "passed")


@query("v02_domain_checks", "SELECT date, bool_and(gfm_ref IN (0, 1, 2, 255)) AS reference_ok, bool_and(gfm_flags IN (0, 1, 255)) AS flags_as_flood_ok FROM {obs} GROUP BY date")
def v02(spark, sf):
    return view(spark, sf, "obs").groupBy("date").agg(va.in_domain("reference_water", C("gfm_ref")).alias("reference_ok"), va.in_domain("ensemble_flood_extent", C("gfm_flags")).alias("flags_as_flood_ok"))


@query("v03_grid_alignment", "SELECT event_id, event_id % 3 <> 1 AS aligned FROM {aoi}")
def v03(spark, sf):
    x = C("west") + F.when(C("event_id") % 3 == 1, 0.01).otherwise(1 / 60)
    return view(spark, sf, "aoi").select("event_id", grid.aligned(x, C("north")).alias("aligned"))


@query("v04_report", "SELECT *, FALSE AS accepted FROM (SELECT 'domain' AS name, bool_and(gfm_ref IN (0, 1, 2, 255)) AS passed, TRUE AS required FROM {obs} UNION ALL SELECT 'flags', bool_and(gfm_flags IN (0, 1, 255)), TRUE FROM {obs} UNION ALL SELECT 'note', FALSE, FALSE)")
def v04(spark, sf):
    obs = view(spark, sf, "obs")
    row = lambda name, layer, c: obs.agg(va.in_domain(layer, C(c)).alias("passed")).select(F.lit(name).alias("name"), "passed", F.lit(True).alias("required"))
    return va.report([row("domain", "reference_water", "gfm_ref"), row("flags", "ensemble_flood_extent", "gfm_flags"), spark.createDataFrame([("note", False, False)], "name string, passed boolean, required boolean")])


_A = "(SELECT row_, col_, avg(value) AS v FROM {obs} WHERE seq // 16 % 2 = 0 GROUP BY row_, col_)"
_B = "(SELECT row_, col_, avg(value) AS v FROM {obs} WHERE seq // 16 % 2 = 1 AND row_ <> 3 GROUP BY row_, col_)"


def _means(spark, sf):
    obs = view(spark, sf, "obs")
    mean = lambda df: df.groupBy("row_", "col_").agg(F.avg("value").alias("v"))
    return mean(obs.where("seq DIV 16 % 2 = 0")), mean(obs.where("seq DIV 16 % 2 = 1 AND row_ <> 3"))


@query("v05_parity", f"SELECT count(a.v - b.v) AS valid_both, count(*) FILTER (a.v IS NOT NULL AND b.v IS NULL) AS only_a, count(*) FILTER (a.v IS NULL AND b.v IS NOT NULL) AS only_b, round(max(abs(a.v - b.v)), 6) AS max_abs, round(avg(abs(a.v - b.v)), 6) AS mean_abs, round(sqrt(avg((a.v - b.v) ** 2)), 6) AS rmse, count(*) FILTER (abs(a.v - b.v) <= 20) AS n_exact FROM {_A} a FULL JOIN {_B} b USING (row_, col_)")
def v05(spark, sf):
    out = va.parity(*_means(spark, sf), ["row_", "col_"], exact=20)
    return out.select("valid_both", "only_a", "only_b", *(F.round(c, 6).alias(c) for c in ("max_abs", "mean_abs", "rmse")), "n_exact")


@query("v06_lsb_classes", f"SELECT row_, max(abs(a.v - b.v)) AS worst, count(*) AS n_pixels, CASE WHEN max(abs(a.v - b.v)) = 0 THEN 'exact' WHEN max(abs(a.v - b.v)) <= 1 THEN 'one_step' ELSE 'different' END AS class FROM {_half_sql(0)} a JOIN {_half_sql(1)} b USING (row_, col_) GROUP BY row_")
def v06(spark, sf):
    return va.lsb_classes(_half(spark, sf, 0), _half(spark, sf, 1), ["row_", "col_"], ["row_"])


@query("v07_exceeding_pixels", f"SELECT row_, col_ FROM {_A} a JOIN {_B} b USING (row_, col_) WHERE abs(a.v - b.v) > 5")
def v07(spark, sf):
    return va.exceeding(*_means(spark, sf), ["row_", "col_"], 5)


@query("v07_same_set", f"SELECT FALSE AS same, (SELECT count(*) FROM (SELECT row_, col_ FROM {_A} EXCEPT SELECT row_, col_ FROM {_B})) + (SELECT count(*) FROM (SELECT row_, col_ FROM {_B} EXCEPT SELECT row_, col_ FROM {_A})) AS n_different")
def v07b(spark, sf):
    a, b = _means(spark, sf)
    return va.same_set(a.select("row_", "col_"), b.select("row_", "col_"))


@query("v08_contingency", f"WITH c AS (SELECT count(*) FILTER (a.v > 40 AND b.v > 40) AS tp, count(*) FILTER (a.v > 40 AND b.v <= 40) AS fp, count(*) FILTER (a.v <= 40 AND b.v > 40) AS fn, count(*) FILTER (a.v <= 40 AND b.v <= 40) AS tn FROM {_A} a JOIN {_B} b USING (row_, col_)) SELECT *, round(tp / nullif(tp + fp + fn, 0), 6) AS csi, round(fp / nullif(tp + fp, 0), 6) AS far, round(tp / nullif(tp + fn, 0), 6) AS hr FROM c")
def v08(spark, sf):
    out = va.contingency(*_means(spark, sf), ["row_", "col_"], 40)
    return out.select("tp", "fp", "fn", "tn", *(F.round(c, 6).alias(c) for c in ("csi", "far", "hr")))


@query("v09_search_diagnostics", "WITH w AS (SELECT unnest(generate_series(DATE '1996-01-01', DATE '1996-12-31', INTERVAL 1 DAY))::DATE AS date), l AS (SELECT date, count(*) AS n, count(*) FILTER (tile = 3) AS m FROM {catalogue} GROUP BY date) SELECT count(*) AS n_dates, count(n) AS n_listed, count(*) FILTER (n IS NULL) AS listings_empty, count(*) FILTER (n > 0 AND m = 0) AS no_match FROM w LEFT JOIN l USING (date)")
def v09(spark, sf):
    return va.search_diagnostics(cb.prefill(spark, 1996), view(spark, sf, "catalogue").select("date", (C("tile") == 3).alias("matches")))


# --- exploratory -------------------------------------------------------------


@query("n01_shares", "SELECT count(*) AS n, count(DISTINCT actid) AS events, min(source_date) AS first, max(source_date) AS last, round(count(*) FILTER (master) / count(*), 6) AS master_share FROM {patches}")
def n01(spark, sf):
    return view(spark, sf, "patches").agg(F.count("*").alias("n"), F.countDistinct("actid").alias("events"), F.min("source_date").alias("first"), F.max("source_date").alias("last"), F.round(ex.share(C("master")), 6).alias("master_share"))


@query("n02_class_bins", "SELECT CASE WHEN pflood = 0 THEN '0' WHEN pflood <= 5 THEN '(0,5]' WHEN pflood <= 50 THEN '(5,50]' WHEN pflood > 50 THEN '>50' END AS bin, count(*) AS n FROM {patches} GROUP BY ALL")
def n02(spark, sf):
    return view(spark, sf, "patches").groupBy(ex.class_bins(C("pflood")).alias("bin")).agg(F.count("*").alias("n"))


@query("n03_conditional_counts", "SELECT actid, count(*) FILTER (master) AS masters, count(*) FILTER (NOT master) AS others, count(*) FILTER (pflood > 0) AS flooded, count(*) FILTER (pflood IS NULL) AS unlabelled, count(*) FILTER (crank = 1) AS ranked FROM {patches} GROUP BY actid")
def n03(spark, sf):
    n = lambda c, name: F.count_if(c).alias(name)
    return view(spark, sf, "patches").groupBy("actid").agg(n(C("master"), "masters"), n(~C("master"), "others"), n(C("pflood") > 0, "flooded"), n(C("pflood").isNull(), "unlabelled"), n(C("crank") == 1, "ranked"))


@query("n04_top_n", "SELECT patch, area_km2 FROM {patches} ORDER BY area_km2 DESC, patch LIMIT 10")
def n04(spark, sf):
    return view(spark, sf, "patches").select("patch", "area_km2").orderBy(F.desc("area_km2"), "patch").limit(10)


@query("n05_size_histogram", "SELECT size, count(*) AS n_groups FROM (SELECT actid, crank, count(DISTINCT source_date) AS size FROM {patches} GROUP BY ALL) GROUP BY size")
def n05(spark, sf):
    return ex.size_histogram(view(spark, sf, "patches"), ["actid", "crank"], "source_date")


@query("n06_across_events", "SELECT master, min(n) AS lowest, max(n) AS highest, median(n) AS median FROM (SELECT actid, master, count(DISTINCT source_date) AS n FROM {patches} GROUP BY ALL) GROUP BY master")
def n06(spark, sf):
    per = view(spark, sf, "patches").groupBy("actid", "master").agg(F.countDistinct("source_date").alias("n"))
    return per.groupBy("master").agg(F.min("n").alias("lowest"), F.max("n").alias("highest"), F.median("n").alias("median"))


_GAPS = "(SELECT actid, max(CASE WHEN NOT coalesce(master, FALSE) THEN source_date END) AS last_pre, min(CASE WHEN coalesce(master, FALSE) THEN source_date END) AS first_flood FROM {patches} GROUP BY actid)"


def _role_gaps(spark, sf):
    return ex.role_gaps(view(spark, sf, "patches"), "actid", F.coalesce("master", F.lit(False)), "source_date")


@query("n07_order_violations", f"SELECT actid, date_diff('day', last_pre, first_flood)::INT AS gap_days FROM {_GAPS} WHERE last_pre >= first_flood")
def n07(spark, sf):
    return _role_gaps(spark, sf).where("broken").select("actid", "gap_days")


@query("n08_distribution", "SELECT actid, count(pflood) AS n, round(avg(pflood), 6) AS mean, round(stddev_samp(pflood), 6) AS std, min(pflood) AS lowest, median(pflood) AS median, max(pflood) AS highest, count(*) FILTER (pflood > 0) AS n_nonzero, round(100 * count(*) FILTER (pflood > 0) / count(*), 6) AS pct_nonzero FROM {patches} GROUP BY actid")
def n08(spark, sf):
    out = ex.distribution(view(spark, sf, "patches"), ["actid"], "pflood")
    return out.select(*(F.round(c, 6).alias(c) if c in ("mean", "std", "pct_nonzero") else c for c in out.columns))


@query("n09_dedupe_correlation", "SELECT count(*) AS n, round(corr(pflood, area_km2), 6) AS r FROM (SELECT *, row_number() OVER (PARTITION BY actid, source_date ORDER BY patch) AS k FROM {patches}) WHERE k = 1")
def n09(spark, sf):
    one = view(spark, sf, "patches").groupBy("actid", "source_date").agg(F.min_by(F.struct("pflood", "area_km2"), "patch").alias("x"))
    return one.agg(F.count("*").alias("n"), F.round(F.corr("x.pflood", "x.area_km2"), 6).alias("r"))


@query("n10_weighted_areas", "SELECT actid, round(sum(CASE WHEN master THEN area_km2 * pflood / 100 END), 4) AS wet, round(sum(CASE WHEN NOT master THEN area_km2 * pflood / 100 END), 4) AS dry FROM {patches} GROUP BY actid")
def n10(spark, sf):
    part = lambda c, n: F.round(F.sum(F.when(c, C("area_km2") * C("pflood") / 100)), 4).alias(n)
    return view(spark, sf, "patches").groupBy("actid").agg(part(C("master"), "wet"), part(~C("master"), "dry"))


@query("n11_shared_keys", "SELECT source_date, count(DISTINCT actid) AS events FROM {patches} GROUP BY source_date HAVING count(DISTINCT actid) > 1")
def n11(spark, sf):
    return view(spark, sf, "patches").groupBy("source_date").agg(F.countDistinct("actid").alias("events")).where("events > 1")


@query("n12_area_variation", "SELECT actid, round(stddev_samp(area_km2) / avg(area_km2), 6) AS cv, round(sum(area_km2) / ((max(east) - min(west)) * (max(north) - min(south))), 6) AS fill FROM {patches} GROUP BY actid")
def n12(spark, sf):
    box = (F.max("east") - F.min("west")) * (F.max("north") - F.min("south"))
    return view(spark, sf, "patches").groupBy("actid").agg(F.round(F.try_divide(F.stddev_samp("area_km2"), F.avg("area_km2")), 6).alias("cv"), F.round(F.try_divide(F.sum("area_km2"), box), 6).alias("fill"))


@query("n13_role_means", "SELECT actid, round(avg(pflood) FILTER (master) - avg(pflood) FILTER (NOT master), 6) AS difference FROM {patches} GROUP BY actid")
def n13(spark, sf):
    return view(spark, sf, "patches").groupBy("actid").agg(F.round(F.avg(F.when(C("master"), C("pflood"))) - F.avg(F.when(~C("master"), C("pflood"))), 6).alias("difference"))


@query("n14_temporal_gap", f"SELECT count(*) AS n, round(avg(g), 6) AS mean, median(g) AS median, max(g)::INT AS longest, count(*) FILTER (g > -180) AS over FROM (SELECT date_diff('day', last_pre, first_flood) AS g FROM {_GAPS} WHERE last_pre IS NOT NULL AND first_flood IS NOT NULL)")
def n14(spark, sf):
    return _role_gaps(spark, sf).agg(F.count("*").alias("n"), F.round(F.avg("gap_days"), 6).alias("mean"), F.median("gap_days").alias("median"), F.max("gap_days").alias("longest"), F.count_if(C("gap_days") > -180).alias("over"))


@query("n15_code_breakdown", "SELECT date, modis_code, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY date), 6) AS pct FROM {obs} GROUP BY date, modis_code")
def n15(spark, sf):
    return ex.code_shares(view(spark, sf, "obs"), ["date"], "modis_code").withColumn("pct", F.round("pct", 6))


@query("n16_pivot_retention", "SELECT date, sum(CASE WHEN gfm_ref = 0 THEN seq END)::BIGINT AS sum_0, sum(CASE WHEN gfm_ref = 1 THEN seq END)::BIGINT AS sum_1, sum(CASE WHEN gfm_ref = 2 THEN seq END)::BIGINT AS sum_2, round(sum_1 / nullif(sum_0, 0), 6) AS kept_1, round(sum_2 / nullif(sum_0, 0), 6) AS kept_2 FROM {obs} GROUP BY date")
def n16(spark, sf):
    out = ex.retention(view(spark, sf, "obs").withColumn("kind", C("gfm_ref").cast("string")), "date", "kind", ["0", "1", "2"], "seq")
    return out.select("date", "sum_0", "sum_1", "sum_2", F.round("kept_1", 6).alias("kept_1"), F.round("kept_2", 6).alias("kept_2"))


@query("n17_agreement", f"SELECT class, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM (SELECT CASE WHEN a.v > 0 AND b.v > 0 THEN 'both' WHEN a.v > 0 THEN 'a_only' WHEN b.v > 0 THEN 'b_only' ELSE 'none' END AS class FROM {_half_sql(0)} a JOIN {_half_sql(1)} b USING (row_, col_)) GROUP BY class")
def n17(spark, sf):
    return ex.agreement(_half(spark, sf, 0), _half(spark, sf, 1), ["row_", "col_"]).withColumn("pct", F.round("pct", 6))


@query("n18_paired_differences", "SELECT date, round(avg(value) FILTER (gfm_ref = 1) - avg(value) FILTER (gfm_ref = 0), 6) AS d10, round(avg(value) FILTER (gfm_ref = 2) - avg(value) FILTER (gfm_ref = 1), 6) AS d21 FROM {obs} GROUP BY date")
def n18(spark, sf):
    wide = view(spark, sf, "obs").groupBy("date").pivot("gfm_ref", [0, 1, 2]).agg(F.avg("value"))
    return wide.select("date", F.round(C("1") - C("0"), 6).alias("d10"), F.round(C("2") - C("1"), 6).alias("d21"))


@query("n19_aligned_codes", "WITH a AS (SELECT viirs_code, count(*) AS n FROM {obs} WHERE row_ < 8 GROUP BY ALL), b AS (SELECT viirs_code, count(*) AS n FROM {obs} WHERE col_ < 2 GROUP BY ALL) SELECT viirs_code, coalesce(a.n, 0) AS n_a, coalesce(b.n, 0) AS n_b, round(100.0 * coalesce(a.n, 0) / (SELECT sum(n) FROM a), 6) AS pct_a, round(100.0 * coalesce(b.n, 0) / (SELECT sum(n) FROM b), 6) AS pct_b FROM a FULL JOIN b USING (viirs_code)")
def n19(spark, sf):
    obs = view(spark, sf, "obs")
    return ex.aligned_codes(obs.where("row_ < 8"), obs.where("col_ < 2"), "viirs_code").withColumn("pct_a", F.round("pct_a", 6)).withColumn("pct_b", F.round("pct_b", 6))


@query("n20_confidence_bands", "SELECT CASE WHEN viirs_code BETWEEN 101 AND 130 THEN 'low' WHEN viirs_code BETWEEN 131 AND 160 THEN 'medium' WHEN viirs_code BETWEEN 161 AND 190 THEN 'high' WHEN viirs_code > 190 THEN 'full' ELSE 'none' END AS band, count(*) AS n FROM {obs} GROUP BY ALL")
def n20(spark, sf):
    code = C("viirs_code")
    band = F.when(code.between(101, 130), "low").when(code.between(131, 160), "medium").when(code.between(161, 190), "high").when(code > 190, "full").otherwise("none")
    return view(spark, sf, "obs").groupBy(band.alias("band")).agg(F.count("*").alias("n"))


@query("x01_windowed_counts", "SELECT event_type, date_trunc('day', ts)::DATE AS day, count(*) AS n FROM events GROUP BY ALL")
def x01(spark, sf):
    """Ours: the batch form of the streaming window counts."""
    out = flows.windowed_counts(table(spark, sf, "events").withColumn("ts", C("ts").cast("timestamp")))
    return out.select("event_type", C("window.start").cast("date").alias("day"), "n")
