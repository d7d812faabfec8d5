"""The engine's operators on small exact cases, and every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os
import sys
from datetime import date

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from hydrocube import layers
from hydrocube.functions import grid, pixels as px, text as tx
from hydrocube.operators import explore as ex, reduce as rd, relational as rel, resample as rs, select as sl, validate as va
from hydrocube.plans import cube as cb, stac, tracker as tk
from hydrocube.sources import catalogue as src, fetchers, retry
from hydrocube.streaming import flows

DATA = "/root/testdata/sf0.001"
C = F.col
cloudpickle.register_pickle_by_value(sys.modules[__name__])  # this module's functions go to the workers by value


def values(df, *names):
    return [tuple(r[n] for n in names) if len(names) > 1 else r[names[0]] for r in df.collect()]


def reduced(spark, operator, rows, **more):
    return spark.createDataFrame([(v, k) for v, k in rows], "v double, ok boolean").agg(rd.reducer(operator, C("v"), valid=C("ok"), **more).alias("r")).first().r


def test_reducers_on_ties_nodata_and_halves(spark):
    ok = lambda *v: [(float(x), True) for x in v]
    assert reduced(spark, "mode", ok(3, 1, 3, 1, 2)) == 1
    assert reduced(spark, "nanmean", ok(1, float("nan"), 3)) == 2 and reduced(spark, "nanmean", ok(float("nan"))) is None
    assert str(reduced(spark, "mean", ok(1, float("nan")))) == "nan"
    assert reduced(spark, "masked_max", ok(255, 2, 1), nodata=255) == 2 and reduced(spark, "masked_max", ok(255, 255), nodata=255) == 255
    assert reduced(spark, "all_true", ok(1, 2)) == 1 and reduced(spark, "all_true", ok(1, 0)) == 0
    assert reduced(spark, "majority", [(1.0, True), (0.0, True)]) == 0 and reduced(spark, "majority", [(1.0, True), (0.0, False)]) == 1 and reduced(spark, "majority", [(1.0, False)]) == 0
    flags = spark.createDataFrame([(1,), (4,), (255,)], "v int")
    assert flags.agg(rd.reducer("masked_or", C("v"), 255).alias("r")).first().r == 5
    for bad in ({"operator": "median"}, {"operator": "masked_max"}, {"operator": "majority"}):
        with pytest.raises(ValueError):
            rd.reducer(value=C("v"), **bad)


def test_viirs_decoding_precedence(spark):
    df = spark.createDataFrame([(c,) for c in (1, 15, 16, 17, 20, 30, 50, 99, 100, 150, 200)], "raw int")
    out = layers.VIIRS.derive_all(df, {"raw": "raw"}, ["water_fraction", "flood_fraction", "exclusion_mask"])
    assert values(out, "water_fraction") == [None, 1, 0, 0, None, None, None, 1, 0, 0.5, 1]
    assert values(out, "flood_fraction") == [None, 0, 0, 0, None, None, None, 0, 0, 0.5, 1]
    extra = layers.VIIRS.derive_all(df, {"raw": "raw"}, ["water_fraction", "exclusion_mask"], extra_codes=(15, 150))
    assert [r for r in values(extra, "raw", "water_fraction", "exclusion_mask") if r[0] in (15, 150)] == [(15, 1.0, 1), (150, 0.5, 1)]
    with pytest.raises(ValueError):
        px.excluded_codes(("fog",))


def test_registry_guards_and_discovery(spark):
    registry = layers.Registry("toy")
    registry.native("raw", nodata=0)
    with pytest.raises(ValueError):
        registry.native("raw", nodata=0)

    @registry.derived("double", inputs=("raw",), nodata=None, aggregation="mean")
    def double(columns, params):
        return columns["raw"] * params.get("by", 2)

    df = spark.createDataFrame([(3,)], "raw int")
    assert registry.derive_all(df, {"raw": "raw"}, by=5).first()["double"] == 15
    with pytest.raises(KeyError, match="other"):
        registry.layers["double"].column({"other": C("raw")})
    assert layers.find_layer("water_fraction", "gfm").source == "gfm" and layers.find_layer("nope") is None
    assert layers.layer_table(spark).count() == sum(len(r.layers) for r in layers.REGISTRIES.values()) == 34
    assert "| advisory_flags | native | 255 | nearest | masked_or |" in layers.layer_docs()


def test_codec_rounds_half_to_even_and_clips(spark):
    df = spark.createDataFrame([(0.005,), (0.015,), (1.7,), (-0.2,), (None,), (float("nan"),)], "v double")
    assert values(df.select(px.encode_percent(C("v")).alias("e")), "e") == [0, 2, 100, 0, 255, 255]


def test_grid_round_trip_windows_and_tiles(spark):
    assert grid.native_windows(30, 8, 4, 3) == [(-1, 7), (7, 15), (15, 23), (23, 31)] and grid.native_windows(16, 8, 4) == [(0, 8), (8, 16)]
    for size, factor in ((8, 0), (9, 4), (0, 4)):
        with pytest.raises(ValueError):
            grid.native_windows(30, size, factor)
    assert cb.index_window(-180, -90, 180, 90) == (0, 10800, 0, 21600) and cb.index_window(0.0, 0.0, 1.0, 1.0) == (5340, 5400, 10800, 10860)
    box = spark.createDataFrame([(-5.0, -5.0, 15.0, 5.0), (170.0, 0.0, -170.0, 5.0)], "west double, south double, east double, north double")
    assert sorted(values(grid.modis_tiles(box), "h", "v")) == [(h, v) for h in (17, 18, 19) for v in (8, 9)]
    closed, open_ = (f(tuple(F.lit(x) for x in (0, 0, 1, 1)), tuple(F.lit(x) for x in (1, 0, 2, 1))) for f in (grid.meets_closed, grid.meets_open))
    assert spark.range(1).select(closed.alias("c"), open_.alias("o")).first()[:] == (True, False)


def test_resampling_rules(spark):
    df = spark.createDataFrame([(r, c, float(r * 4 + c) if (r, c) != (0, 0) else None) for r in range(4) for c in range(4)] + [(4, 0, 1.0)], "row_ int, col_ int, v double")
    assert sorted(values(rs.coarsen(df, 2, trim=True), "trow", "tcol", "v")) == [(0, 0, 10 / 3), (0, 1, 4.5), (1, 0, 10.5), (1, 1, 12.5)]
    assert rs.coarsen(df, 2).count() == 5
    flat = df.where("row_ < 4").withColumn("v", F.lit(7.0))
    for method in ("bilinear", "cubic"):
        fine = rs.interpolated(flat, 2, method=method)
        assert fine.count() == 64 and fine.agg(F.max(F.abs(C("v") - 7))).first()[0] < 1e-9
    assert rs.tiles(df.where("row_ < 4"), 4, 4, 3, 1).count() == 4
    with pytest.raises(ValueError):
        rs.coarsen(df, 2, method="spline")
    with pytest.raises(ValueError):
        rs.tiles(df, 4, 4, 2, 2)


def days(spark, counts):
    return spark.createDataFrame([(date(2024, 1, 1 + k), n) for k, n in enumerate(counts)], "date date, n long")


def plain_subsample(counts, most, priority):
    peak = counts.index(max(counts))
    key = {"post": lambda i: (i < peak, abs(i - peak)), "pre": lambda i: (i > peak, abs(i - peak)), "balanced": lambda i: (abs(i - peak), i < peak)}[priority]
    return sorted(sorted(range(len(counts)), key=key)[:most])


def test_peak_window_and_subsample(spark):
    df = days(spark, [1, 5, 5, 0, 2])
    assert values(sl.peak(df), "date") == [date(2024, 1, 2)] and values(sl.peak(days(spark, [0, 0])), "date") == [date(2024, 1, 1)]
    assert sl.peak_window(df, 0, 0).count() == 5 and sorted(d.day for d in values(sl.peak_window(df, 1, 2), "date")) == [1, 2, 3, 4]
    with pytest.raises(ValueError):
        sl.peak_window(df, -1, 0)
    for counts in ([1, 5, 5, 0, 2], [9, 1, 1, 1], [0, 0, 3]):
        for priority in sl.PRIORITIES:
            for most in (1, 2, 4):
                assert sorted(d.day - 1 for d in values(sl.subsample(days(spark, counts), most, priority), "date")) == plain_subsample(counts, most, priority)


def test_states_watermark_and_islands(spark):
    tasks = spark.createDataFrame([(1, date(2024, 1, 1), "DONE"), (2, date(2024, 1, 2), "DONE"), (3, date(2024, 1, 2), "DONE"), (4, date(2024, 1, 3), "FAILED"), (5, date(2024, 1, 3), "DONE"), (6, date(2024, 1, 4), None), (7, date(2024, 1, 5), "DONE")], "task_id long, date date, status string")
    assert sorted(values(sl.date_states(tasks), "date", "state")) == [(date(2024, 1, d), s) for d, s in ((1, "done"), (2, "done"), (3, "failed"), (4, "pending"), (5, "done"))]
    assert values(sl.watermark(tasks), "watermark") == [date(2024, 1, 2)] and values(sl.watermark(tasks.where("date > '2024-01-02'")), "watermark") == [None]
    assert sorted(values(flows.released(tasks), "task_id")) == [1, 2, 3, 5] and values(flows.drained(tasks), "task_id") == [7]
    three = spark.createDataFrame([(1, date(2024, 1, 1), "DONE"), (2, date(2024, 1, 2), "DONE"), (3, date(2024, 1, 2), None), (4, date(2024, 1, 3), "DONE")], "task_id long, date date, status string")
    assert sorted(values(flows.released(three), "task_id")) == [1, 2] and values(flows.drained(three), "task_id") == [4]
    assert sorted(values(sl.islands(tasks.where("task_id != 4 AND task_id != 5")), "first", "n_days")) == [(date(2024, 1, 1), 2), (date(2024, 1, 4), 2)]
    with pytest.raises(ValueError):
        sl.row_slice(tasks, "0:99", ["task_id"])
    with pytest.raises(ValueError):
        sl.row_slice(tasks, "bad", ["task_id"])


def test_update_windows():
    got = tk.update_windows(date(2024, 1, 20), {2023: date(2023, 11, 5), 2024: None})
    assert [(w.year, w.start, w.end, w.kind) for w in got] == [(2023, date(2023, 11, 6), date(2023, 12, 6), "weekly"), (2024, date(2024, 1, 1), date(2024, 1, 18), "catch-up")]
    assert tk.update_windows(date(2024, 1, 20), {2023: date(2023, 12, 31), 2024: date(2024, 1, 10)})[0].start == date(2024, 1, 4)
    assert tk.update_windows(date(2024, 1, 20), {}, start=date(2024, 2, 1), end=date(2024, 1, 1)) == []


def test_order_over_bins(spark):
    from hydrocube.operators import order

    rows = [(k, (k * 37) % 101) for k in range(300)]
    df = spark.createDataFrame(rows[::-1], "i long, t long").repartition(4)
    for bins in (1, 7, 64):
        assert sorted(values(order.before(df, "i", "t", bins=bins), "i", "_before")) == [(k, rows[k - 1][1] if k else None) for k, _ in rows] or bins == 0
        assert sorted(values(order.running(df, "i", C("t"), "s", bins=bins), "i", "s")) == [(k, sum(t for _, t in rows[: k + 1])) for k, _ in rows]
    assert order.before(df.limit(0), "i", "t").count() == 0
    assert sl.subsample(days(spark, [1, 2, 3]), 0).count() == 3 and sl.subsample(days(spark, [1, 2, 3]), -1).count() == 3
    assert sorted(values(sl.unsorted_spans(spark.createDataFrame([(0, 5), (1, 4), (2, 4), (3, 9), (4, 1)], "i long, t long")), "first", "last")) == [(1, 2), (4, 4)]


def test_boxes_and_events(spark):
    boxes = spark.createDataFrame([(1.0, 0.0, 1.0, 5.0), (0.0, 3.0, 4.0, 3.0), (170.0, -10.0, -170.0, 10.0), (10.0, 0.0, 5.0, 1.0), (0.0, 5.0, 1.0, 4.0), (-190.0, 0.0, 1.0, 1.0), (0.0, 0.0, 1.0, 91.0), (None, 0.0, 1.0, 1.0)], "w double, s double, e double, n double")
    box = [C(x) for x in ("w", "s", "e", "n")]
    on = lambda a, b: [F.to_date(F.lit(a)), F.to_date(F.lit(b))]
    assert values(boxes.select(grid.valid_bbox(*box).alias("v")), "v") == [True, True, False, False, False, False, False, False]
    assert values(boxes.select(grid.valid_event(*box, *on("2024-01-01", "2024-01-01")).alias("v")), "v") == [True, True, True, False, False, False, False, False]
    assert not any(values(boxes.select(grid.valid_event(*box, *on("2024-01-02", "2024-01-01")).alias("v")), "v"))


def test_box_join_equals_nested_loops(spark):
    rows = [(k, float((k * 37) % 60 - 30), float((k * 17) % 40 - 20)) for k in range(60)]
    items = spark.createDataFrame([(date(2020 + k % 3, 12, 31), k % 5, k, w, s, w + k % 25 + 0.5, s + k % 13 + 0.5) for k, w, s in rows], "date date, tile int, item long, west double, south double, east double, north double")
    events = spark.createDataFrame([(e, -10.0 * e, -5.0, -10.0 * e + 20, 15.0, date(2020, 6, 1), date(2021, 12, 31)) for e in range(4)], "event_id int, west double, south double, east double, north double, d0 date, d1 date")
    i, e = items.collect(), events.collect()
    want = sorted((x.event_id, y.item) for x in e for y in i if x.d0 <= y.date <= x.d1 and x.west < y.east and y.west < x.east and x.south < y.north and y.south < x.north)
    assert sorted(values(rel.box_join(events, items), "event_id", "item")) == want and want


def test_bookmarks_tracker_and_errors(spark):
    marks = spark.createDataFrame([("a", 1), ("b", 2)], "event_id string, n int")
    with pytest.raises(ValueError):
        src.add_bookmark(marks, marks.limit(1))
    assert sorted(values(src.add_bookmark(marks, spark.createDataFrame([("a", 9)], marks.schema), True), "event_id", "n")) == [("a", 9), ("b", 2)]
    tracker = spark.createDataFrame([("x", "FAILED", 2)], "task_id string, status string, attempts int")
    new = spark.createDataFrame([("x", "DONE", 0), ("y", "DONE", 0), ("z", "FAILED", 4)], tracker.schema)
    assert sorted(values(tk.mark(tracker, new), "task_id", "status", "attempts")) == [("x", "DONE", 3), ("y", "DONE", 1), ("z", "FAILED", 4)]
    with pytest.raises(ValueError):
        rel.first_cases(marks, limit=0, key="event_id")
    with pytest.raises(KeyError):
        rel.first_cases(marks, ["q"], key="event_id")
    with pytest.raises(ValueError):
        rel.first_wins([], ["a"])


def test_cube_round_trip_and_masked_write(spark, tmp_path):
    cube = cb.Cube(spark, f"file://{tmp_path}/c")
    row = "source string, layer string, date date, row_ int, col_ int, v int, seq long"
    d = date(2024, 1, 3)
    cube.write(spark.createDataFrame([("viirs", "water", d, 10, 20, 50, 1), ("viirs", "water", d, 10, 21, 60, 1), ("modis", "water", d, 0, 0, 9, 1)], row))
    cube.write(spark.createDataFrame([("viirs", "water", d, 10, 20, 255, 2), ("viirs", "water", d, 10, 21, 70, 2), ("viirs", "water", date(2024, 1, 5), 10, 20, 255, 2)], row))
    assert sorted(values(cube.read("viirs"), "date", "col_", "v")) == [(d, 20, 50), (d, 21, 70), (date(2024, 1, 5), 20, 255)]
    assert sorted(values(cube.sources(), "source")) == ["modis", "viirs"]
    x, y = -180 + 20 / 60, 90 - 10 / 60
    assert values(cube.read("viirs", (x, y - 1 / 60, x + 1 / 60, y), "2024-01-01", "2024-01-04"), "v", "value") == [(50, 0.5)]
    cube.bookmark("flood", "viirs", (x, y - 1 / 60, x + 2 / 60, y), [date(2024, 1, 5)])
    cube.bookmark("flood", "viirs", (x, y - 1 / 60, x + 2 / 60, y), [d])
    assert cube.read("viirs", event="flood").count() == 3 and cube.bookmarks().first().dates == [d, date(2024, 1, 5)]
    assert sorted(values(cube.gaps("viirs", 2024), "n_days")) == [1, 2, 361]
    with pytest.raises(KeyError):
        cube.read("viirs", event="none")
    with pytest.raises(ValueError):
        cube.read("viirs", (0, 0, 1, 1), event="flood")
    with pytest.raises(cb.ConfigMismatch):
        cb.Cube(spark, f"file://{tmp_path}/c", scale=0.1).write(spark.createDataFrame([], row))
    items = stac.items(cube.read_all())
    stac.write_index(items, f"file://{tmp_path}/index")
    assert spark.read.parquet(f"file://{tmp_path}/index").count() == 2
    with pytest.raises(ValueError):
        stac.write_index(items.limit(0), f"file://{tmp_path}/none")


def test_streams_upsert_and_release(spark, tmp_path):
    spark.createDataFrame([("viirs", "water", date(2024, 1, 3), 1, c, c, 1) for c in range(5)], "source string, layer string, date date, row_ int, col_ int, v int, seq long").write.parquet(f"file://{tmp_path}/in")
    cube = cb.Cube(spark, f"file://{tmp_path}/cube")
    stream = spark.readStream.schema(spark.read.parquet(f"file://{tmp_path}/in").schema).parquet(f"file://{tmp_path}/in")
    flows.upsert_stream(stream, cube, f"file://{tmp_path}/check").awaitTermination()
    assert cube.read("viirs").count() == 5
    rows = [("r", "20240102", "b", "DONE"), ("r", "20240101", "a1", "FAILED"), ("r", "20240101", "a1", "DONE"), ("r", "20240103", "c", "DONE"), ("r", "20240101", "zzz", "DONE")]
    more = [("r", "20240101", "a2", "FAILED"), ("r", "20240102", "b", "DONE"), ("r", "20240105", "e", "DONE")]
    schema, expected = "run string, date string, task_id string, status string", {"20240101": ["a1", "a2"], "20240102": ["b"], "20240103": ["c", "d"], "20240105": ["e"]}
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"file://{tmp_path}/res")
    run = lambda: flows.ordered_release(spark.readStream.schema(schema).parquet(f"file://{tmp_path}/res"), expected).writeStream.format("parquet").option("path", f"file://{tmp_path}/out").option("checkpointLocation", f"file://{tmp_path}/check2").trigger(availableNow=True).start().awaitTermination()
    run()
    got = lambda: sorted(values(spark.read.parquet(f"file://{tmp_path}/out"), "date", "task_id"))
    assert got() == [("20240101", "a1")]  # a2 is open: a task that is retried counts once
    spark.createDataFrame(more, schema).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/res")
    run()
    assert got() == [("20240101", "a1"), ("20240102", "b"), ("20240103", "c")]  # c's own date is open, the earlier ones are settled; e waits for d


def test_sources(spark, tmp_path):
    df = spark.createDataFrame([("b", "2024-01-02", "bad"), ("a", "2024-01-01", "2024-02-01")], "flood_case string, date_start string, date_end string")
    src.write_metadata(df, f"file://{tmp_path}/m")
    got = src.load_metadata(spark, f"file://{tmp_path}/m", ["flood_case"], order="flood_case")
    assert values(got, "flood_case", "date_end") == [("a", date(2024, 2, 1)), ("b", None)]
    with pytest.raises(ValueError):
        src.load_metadata(spark, f"file://{tmp_path}/m", ["lat_min"])
    assert src.load_bookmarks(spark, f"file://{tmp_path}/none").count() == 0
    (tmp_path / "p.txt").write_text("version https://git-lfs.github.com/spec/v1\n")
    with pytest.raises(ValueError):
        src.reject_pointer(spark, f"file://{tmp_path}/p.txt")
    import struct

    ring = [(0.0, 1.0), (4.0, 1.0), (4.0, 3.0), (0.0, 1.0)]
    wkb = struct.pack("<BIII", 1, 3, 1, 4) + b"".join(struct.pack("<dd", *p) for p in ring)
    box = spark.createDataFrame([(wkb,), (None,)], "g binary").select(src.box_of_wkb(C("g")).alias("b")).collect()
    assert tuple(box[0].b) == (0.0, 1.0, 4.0, 3.0)
    assert src.write_manifest(spark, f"file://{tmp_path}/runs", "r", {"a": 1}) == "r.json" and src.write_manifest(spark, f"file://{tmp_path}/runs", "r", {}) == "r-2.json"
    with pytest.raises(ValueError):
        fetchers.register_fetcher(fetchers.CalendarFetcher)
    with pytest.raises(KeyError):
        fetchers.get_fetcher("none")
    assert "granule_calendar" in fetchers.list_fetchers()


def test_retries_and_locks(tmp_path):
    seen, waits = [], []

    def flaky():
        seen.append(1)
        if len(seen) < 3:
            raise OSError("later")
        return 7

    assert retry.retried(flaky, sleep=waits.append) == 7 and waits == [1.0, 2.0]
    with pytest.raises(OSError):
        retry.retried(lambda: (_ for _ in ()).throw(OSError()), attempts=2, sleep=waits.append)
    with retry.year_lock(str(tmp_path), 2024), pytest.raises(RuntimeError), retry.year_lock(str(tmp_path), 2024):
        pass
    (tmp_path / "2024.lock").write_text("999999999")
    with retry.year_lock(str(tmp_path), 2024):
        assert (tmp_path / "2024.lock").exists()
    assert retry.looks_like_html(b"  <!DOCTYPE html>") and not retry.looks_like_html(b"II*")
    assert retry.cache_path("/c", "http://a/x.tif?y").name.endswith(".tif")


def test_rasters_round_trip(spark, tmp_path):
    import numpy as np

    from hydrocube.sources import tiff

    a = (np.arange(600 * 5) % 200).reshape(600, 5).astype(np.uint8)
    for dtype in (np.uint8, np.uint16, np.float32):
        back, at = tiff.decode(tiff.encode(a.astype(dtype), 10.0, 20.0, 0.5, strip=7))
        assert (back == a).all() and back.dtype == dtype and (at["west"], at["north"], at["res"], at["nodata"]) == (10.0, 20.0, 0.5, 255.0)
    with pytest.raises(ValueError):
        tiff.decode(b"GIF89a..")
    d = date(2024, 1, 3)
    rows = [("viirs", d, "water_fraction", 10, 20, 0.5), ("viirs", d, "water_fraction", 11, 21, None), ("viirs", d, "valid_count", 10, 20, 7.0), ("viirs", d, "flags", 10, 20, 3.0)]
    pixels = spark.createDataFrame(rows, "source string, date date, layer string, row_ int, col_ int, v double")
    saved = tiff.save_rasters(tiff.as_rasters(pixels, ["source", "date"]), f"file://{tmp_path}/out")
    assert sorted(values(saved, "name")) == ["viirs_20240103_flags.tif", "viirs_20240103_valid_count.tif", "viirs_20240103_water_fraction.tif"]
    got = tiff.read_rasters(spark, f"file://{tmp_path}/out", "*water*").orderBy("row_", "col_").collect()
    assert [(r.row_, r.col_, r.v) for r in got] == [(0, 0, 50.0), (0, 1, None), (1, 0, None), (1, 1, None)] and abs(got[0].west - (-180 + 20 / 60)) < 1e-9
    cube = cb.Cube(spark, f"file://{tmp_path}/cube")
    cube.write(tiff.cube_rows(tiff.read_rasters(spark, f"file://{tmp_path}/out", "*water*"), "viirs"))
    assert sorted(values(cube.read("viirs"), "layer", "date", "row_", "col_", "v")) == [("water_fraction", d, 10, 20, 50), ("water_fraction", d, 10, 21, 255), ("water_fraction", d, 11, 20, 255), ("water_fraction", d, 11, 21, 255)]
    (tmp_path / "odd").mkdir()
    (tmp_path / "odd/x_20240103_a.tif").write_bytes(tiff.encode(a, 10.0, 20.0, 0.5))
    with pytest.raises(Exception, match="not on the grid"):
        tiff.cube_rows(tiff.read_rasters(spark, f"file://{tmp_path}/odd"), "viirs").collect()
    items = spark.createDataFrame([("i", 0, 0, 1, 2, 3)], "item string, row_ int, col_ int, b1 int, b2 int, b3 int")
    assert tiff.load_item(items, "i", ["b3", "b1"], wait=0).columns == ["row_", "col_", "b3", "b1"]
    for item, bands in (("none", ["b1"]), ("i", ["b9"])):
        with pytest.raises(KeyError):
            tiff.load_item(items, item, bands, wait=0)
    bad = pixels.withColumns({"layer": F.lit("ensemble_likelihood"), "v": F.lit(101.0)})
    with pytest.raises(Exception, match="likelihood"):
        tiff.as_rasters(bad, ["source"]).collect()


def granule(task):
    if task["task_id"] == "t3":
        raise OSError("gone")
    return [("water_fraction", task["date"], 1, int(task["task_id"][1:]), 40), ("unknown", task["date"], 0, 0, 1)]


def test_batches_and_updates(spark, tmp_path):
    from hydrocube.plans import batch as bt, update as up

    root = f"file://{tmp_path}"
    tasks = spark.createDataFrame([(f"t{k}", date(2024, 1, 1 + k // 2)) for k in range(6)], "task_id string, date date")
    cube, tracker = cb.Cube(spark, f"{root}/a"), bt.Tracker(spark, f"{root}/t")
    done = bt.run_cube_batch("viirs", tasks, cube, tracker, granule, attempts=2, wait=0)
    assert (done["total"], done["done"], done["failed"]) == (6, 5, 1) and done["rate"] > 0 and done["eta"] > 0
    assert sorted(values(cube.read_all(), "col_")) == [0, 1, 2, 4, 5] and values(cube.read_all().select("layer").distinct(), "layer") == ["water_fraction"]
    assert values(tracker.read().where("status = 'FAILED'"), "task_id", "attempts") == [("t3", 2)]
    assert bt.run_cube_batch("viirs", tasks, cube, tracker, granule, attempts=1)["total"] == 1  # done tasks are not produced again
    with pytest.raises(ValueError):
        bt.run_cube_batch("nobody", tasks, cube, tracker, granule)
    with pytest.raises(RuntimeError, match="t0"):
        bt.probe(tasks, lambda task: 1 / 0)
    assert bt.probe(tasks, lambda task: 1) is None and bt.rate_and_eta(0, 5, 2.0) == (0.0, None) and bt.rate_and_eta(4, 10, 2.0) == (2.0, 3.0)
    assert not up.is_checkpointed(spark, root, "e", "viirs", "fetch")
    up.write_checkpoint(spark, root, "e", "viirs", "fetch")
    assert up.is_checkpointed(spark, root, "e", "viirs", "fetch")

    listing = tasks.withColumns({"tile": C("task_id"), "uri": F.lit("u")})
    update = up.Update(spark, "viirs", f"{root}/u", str(tmp_path / "locks"), lambda w: listing, granule, attempts=1)
    first = tk.YearWindow(2024, date(2024, 1, 1), date(2024, 1, 2), "catch-up")
    out = update.run([first])
    assert out["status"] == "ok" and out["years"][0]["failed_tasks"] == 1 and out["years"][0]["watermark"] == date(2024, 1, 1)
    assert update.last_manifest(2024)["status"] == "ok" and update.run([])["status"] == "noop"
    assert (tmp_path / "u/backup/2024/catalogue").is_dir()
    broken = up.Update(spark, "viirs", f"{root}/u", str(tmp_path / "locks"), lambda w: listing.limit(0), granule)
    held = spark.read.parquet(update.place(2024, "catalogue")).count()
    with pytest.raises(up.UpdateError):
        broken.run([tk.YearWindow(2025, date(2025, 1, 1), date(2025, 1, 2), "weekly")])
    assert broken.last_manifest(2025)["status"] == "failed" and spark.read.parquet(update.place(2024, "catalogue")).count() == held == 6
    with pytest.raises(ValueError):
        up.refresh_catalogue(spark, f"{root}/c", listing.drop("uri"), 2024)
    _, one = up.refresh_catalogue(spark, f"{root}/c", listing, 2024)
    assert one == up.checksum(listing.select(*up.NEEDED).repartition(5))


def test_swap_restores_what_was_there(spark, tmp_path):
    from hydrocube.sources import files

    at = f"file://{tmp_path}"
    spark.range(3).write.parquet(f"{at}/held")
    spark.range(5).write.parquet(f"{at}/new")
    with pytest.raises(ValueError):
        files.swap(spark, f"{at}/new", f"{at}/held", rows=4)
    assert spark.read.parquet(f"{at}/held").count() == 3 and files.names(spark, at) == ["held"]
    spark.range(5).write.parquet(f"{at}/new")
    files.swap(spark, f"{at}/new", f"{at}/held", rows=5)
    assert spark.read.parquet(f"{at}/held").count() == 5 and files.is_remote("s3a://b/x") and not files.is_remote(at)


def stac_search(day):
    items = [{"id": f"i{day.day}", "href": "h", "bbox": [0, 1, 2, 3], "properties": {"Equi7Tile": "T"}}, {"id": "no tile", "bbox": [0, 1, 2, 3], "properties": {}}, {"id": "no box", "properties": {"Equi7Tile": "T"}}]
    return items if day.day != 2 else []


class Folder(fetchers.Backend):
    def location(self, day):
        return f"{day:%Y/%j}"

    def entries(self, location):
        return [f"x_{location[-3:]}_h18v04.tif", "readme"]

    def matching(self, tile, entries):
        return next((e for e in entries if tile in e), None)

    def url(self, location, name):
        return f"http://host/{location}/{name}"

    def years(self):
        return {2024}


def test_more_sources(spark, tmp_path):
    import zipfile

    found = src.search_day(spark, stac_search, [date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)], wait=0)
    assert sorted(values(found, "date", "item_id", "north")) == [("2024-01-01", "i1", 3.0), ("2024-01-03", "i3", 3.0)]
    got = fetchers.listed(spark, Folder(), [date(2024, 1, 2), date(2023, 1, 2)], ["h18v04", "h00v00"], wait=0)
    assert values(got, "date", "tile", "url") == [(date(2024, 1, 2), "h18v04", "http://host/2024/002/x_002_h18v04.tif")]
    (tmp_path / "z").mkdir()
    with zipfile.ZipFile(tmp_path / "z/a.zip", "w") as z:
        z.writestr("b.tif", b"second"), z.writestr("a.TIF", b"first"), z.writestr("0.txt", b"no")
    assert [(m, bytes(c)) for m, c in values(src.zip_members(spark, f"file://{tmp_path}/z"), "member", "content")] == [("a.TIF", b"first")]
    calls = []
    fetch = lambda url, etag: (calls.append(etag), (None, "e1") if etag == "e1" else (b"II*data", "e1"))[1]
    for _ in range(2):
        assert retry.download("http://a/x.tif", str(tmp_path / "cache"), fetch, wait=0).read_bytes() == b"II*data"
    assert calls == [None, "e1"]
    with pytest.raises(ValueError):
        retry.download("http://a/y.tif", str(tmp_path / "cache"), lambda u, e: (b"<html>login", None), wait=0)
    d = date(2024, 1, 3)
    cube = cb.Cube(spark, f"file://{tmp_path}/c")
    cube.write(spark.createDataFrame([("viirs", "water", d, 1, 2, 50, 1), ("viirs", "water", date(2024, 1, 4), 1, 2, 60, 1)], "source string, layer string, date date, row_ int, col_ int, v int, seq long"))
    stac.write_index(stac.items(cube.read_all()), f"file://{tmp_path}/index", f"file://{tmp_path}/c/cube")
    assert values(src.open_indexed(spark, f"file://{tmp_path}/index", "viirs-20240103"), "v") == [50]
    with pytest.raises(KeyError):
        src.open_indexed(spark, f"file://{tmp_path}/index", "none")
    marks = spark.createDataFrame([("e", None, None, ["viirs"], None, None, None)], src.schema("bookmarks"))
    src.save_bookmarks(marks, f"file://{tmp_path}/marks")
    src.save_bookmarks(src.add_bookmark(src.load_bookmarks(spark, f"file://{tmp_path}/marks"), marks.withColumn("event_id", F.lit("f"))), f"file://{tmp_path}/marks")
    assert sorted(values(src.load_bookmarks(spark, f"file://{tmp_path}/marks"), "event_id")) == ["e", "f"]
    assert src.scan_patches(spark, f"file://{tmp_path}/marks").count() == 2
    sar = stac.sar_properties(spark.createDataFrame([(["b2", "b1"],), ([],)], "bands array<string>"), {"b1": "VV", "b2": "VH"})
    assert [r.properties["sar:polarizations"] for r in sar.collect()] == ["VV,VH", ""] and sar.first().properties["sar:frequency_band"] == "C"


def test_to_grid(spark):
    px_ = spark.createDataFrame([(0, 0, 1.0), (0, 1, 3.0), (1, 0, 5.0), (1, 1, 7.0)], "row_ int, col_ int, v double")
    res, west, north = 1 / 60, 10.0, 50.0
    assert rs.on_grid("EPSG:4326", res, west, north) and not rs.on_grid("EPSG:3857", res, west, north) and not rs.on_grid("EPSG:4326", res, west + res / 3, north)
    assert sorted(values(rs.to_grid(px_, res, west, north), "row_", "col_", "v")) == [(2400, 11400, 1.0), (2400, 11401, 3.0), (2401, 11400, 5.0), (2401, 11401, 7.0)]
    assert values(rs.to_grid(px_, res / 2, west, north), "row_", "col_", "v") == [(2400, 11400, 4.0)]
    assert values(rs.to_grid(px_, res / 2, west, north, method="max"), "v") == [7.0]
    fine = rs.to_grid(px_, 2 * res, west, north)
    assert fine.count() == 16 and sorted(values(fine.where("row_ = 2402 AND col_ = 11402"), "v")) == [7.0]
    odd = spark.createDataFrame([(r, c, 1.0) for r in range(7) for c in range(7)], "row_ int, col_ int, v double")
    for ratio in (0.4, 1.7):
        out = rs.to_grid(odd, ratio * res, west, north)
        assert out.count() == out.select("row_", "col_").distinct().count() == round(7 * ratio) ** 2
    with pytest.raises(ValueError):
        rs.to_grid(px_, res, west, north, crs="EPSG:3857")
    box = spark.range(1).select(*(x.alias(n) for n, x in zip("wsen", rs.tile_bbox(F.lit(1), F.lit(1), 5, 4, 3, 1, 0.0, 10.0, 1.0)))).first()
    assert tuple(box) == (2.0, 5.0, 4.0, 8.0)
    assert spark.range(1).select(rs.tile_bbox(F.lit(3), F.lit(0), 5, 4, 3, 1, 0.0, 10.0, 1.0)[0].alias("w")).first().w is None


def test_text_helpers(spark):
    got = spark.range(1).select(tx.memory_bytes(F.lit("2.5GB")).alias("a"), tx.memory_bytes(F.lit("x")).alias("b"), tx.date_of_token(F.lit("aggregated")).alias("c"), tx.valid_tile_id(F.lit("AF020M_E030N066T3")).alias("d"), tx.valid_tile_id(F.lit("af-1")).alias("e")).first()
    assert got[:] == (2500000000, None, None, True, False)
    assert tx.parse_bbox("1, 2 3,4") == (1, 2, 3, 4) and tx.epoch_units() == "days since 2020-01-01"
    with pytest.raises(ValueError):
        tx.parse_bbox("1 2 3")


def test_scores_and_explore(spark):
    a = spark.createDataFrame([(1, 0.5), (2, 0.0), (3, None)], "k int, v double")
    b = spark.createDataFrame([(1, 0.0), (2, 0.6), (4, 1.0)], "k int, v double")
    assert va.contingency(a, b, ["k"]).first()[:] == (0, 1, 1, 0, 0.0, 1.0, 0.0)
    assert va.same_set(a, a).first().same and not va.same_set(a, b).first().same
    assert values(ex.normalise(a, "v", -1, 1), "v") == [1.0, -1.0, None] and values(ex.normalise(a.withColumnRenamed("v", "raw"), "raw"), "raw") == [0.5, 0.0, None]


def _registered():
    import __spark_entry__ as entry

    sql = entry.oracle_sql()
    return sorted(n for n in entry.queries() if n in sql and not n.startswith(("op", "pipeline")))


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return tuple(map(_norm, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", _registered())
def test_queries_equal_sql(spark, name):
    import duckdb

    import __spark_entry__ as entry

    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    df = entry.queries()[name](spark, DATA)
    found = con.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in found.description]
    want = [tuple(_norm(v) for _, v in sorted(zip(cols, r))) for r in found.fetchall()]
    got = [tuple(_norm(r[c]) for c in sorted(df.columns)) for r in df.collect()]
    assert sorted(cols) == sorted(df.columns) and sorted(map(repr, got)) == sorted(map(repr, want))


def test_every_query_has_its_sql():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert set(entry.oracle_sql()) <= names
    assert names - set(entry.oracle_sql()) <= {"p14_layer_catalogue", "f06_layer_lookup", "pipeline", *(n for n in names if n.startswith("op"))}
