"""Catalogue joins, task building, set operations and filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELL = 10.0


def attach_areas(catalogue: DataFrame, areas: DataFrame, key: str = "aoi_id") -> DataFrame:
    """Catalogue rows with their area's geometry; rows without one go."""
    return catalogue.join(areas, key, "left").where(F.col("geometry").isNotNull())


def box_join(events: DataFrame, items: DataFrame, how: str = "inner", cell: float = CELL) -> DataFrame:
    """Events x items by date window and open box intersection, as an equi-join.

    Both sides are sent to the (month, cell) bins that they reach; a pair that
    meets in several bins is kept in the one that holds the corner of its
    intersection, so no deduplication is needed. events: event_id, west, south,
    east, north, d0, d1; items: date and a box.
    """
    bins = lambda a, b: F.sequence(F.floor(F.col(a) / cell).cast("int"), F.floor(F.col(b) / cell).cast("int"))
    cells = lambda df: df.withColumn("_bx", F.explode(bins("west", "east"))).withColumn("_by", F.explode(bins("south", "north")))
    month = lambda d: F.year(d) * 12 + F.month(d)
    e = cells(events.where("d0 <= d1").withColumn("_month", F.explode(F.sequence(month("d0"), month("d1"))))).alias("e")
    i = cells(items.withColumn("_month", month("date"))).alias("i")
    c = lambda n: F.col(n)
    corner = (c("e._bx") == F.floor(F.greatest(c("e.west"), c("i.west")) / cell)) & (c("e._by") == F.floor(F.greatest(c("e.south"), c("i.south")) / cell))
    meets = (c("e.west") < c("i.east")) & (c("i.west") < c("e.east")) & (c("e.south") < c("i.north")) & (c("i.south") < c("e.north"))
    on = (c("e._month") == c("i._month")) & (c("e._bx") == c("i._bx")) & (c("e._by") == c("i._by")) & c("i.date").between(c("e.d0"), c("e.d1")) & meets & corner
    picked = [c(f"e.{n}") for n in events.columns if n == "event_id"] + [c(f"i.{n}").alias(n) for n in items.columns]
    return e.join(i, on, how).select(*picked)


def count_items(events: DataFrame, items: DataFrame) -> DataFrame:
    """(event_id, n_items, n_dates, n_cells) of every event; without items the counts are 0."""
    met = box_join(events, items).groupBy("event_id").agg(F.count("*").alias("n_items"), F.countDistinct("date").alias("n_dates"), F.countDistinct("date", "tile").alias("n_cells"))
    return events.select("event_id").join(met, "event_id", "left").fillna(0, ["n_items", "n_dates", "n_cells"])


def to_tasks(items: DataFrame) -> DataFrame:
    """One task for each (date, tile): sorted items and the union of boxes."""
    return items.groupBy("date", "tile").agg(F.array_sort(F.collect_list("item")).alias("items"), F.min("west").alias("west"), F.min("south").alias("south"), F.max("east").alias("east"), F.max("north").alias("north"))


def last_wins(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """The union of both with new rows before old ones of the same key."""
    both = old.withColumn("_batch", F.lit(0)).unionByName(new.withColumn("_batch", F.lit(1)))
    return _newest(both, keys, F.desc("_batch"))


def first_wins(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """The union of frames; of equal keys the first frame's row stays."""
    if not frames:
        raise ValueError("no tree could be fetched")
    both = None
    for k, f in enumerate(frames):
        f = f.withColumn("_batch", F.lit(k))
        both = f if both is None else both.unionByName(f)
    return _newest(both, keys, F.asc("_batch"))


def _newest(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    rest = [F.asc(c) for c in df.columns if c not in keys and c != "_batch"]
    w = Window.partitionBy(*keys).orderBy(order, *rest)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "_batch")


def pending(tasks: DataFrame, tracker: DataFrame) -> DataFrame:
    return tasks.join(tracker.where("status = 'DONE'").select("task_id"), "task_id", "left_anti")


def missing_dates(expected: DataFrame, have: DataFrame) -> DataFrame:
    return expected.select("date").distinct().join(have.select("date"), "date", "left_anti")


def complete_dates(expected: DataFrame, done: DataFrame) -> DataFrame:
    """(date, complete): whether every expected task of the date is done."""
    marks = done.select("task_id").distinct().withColumn("_done", F.lit(True))
    return expected.join(marks, "task_id", "left").groupBy("date").agg(F.bool_and(F.coalesce("_done", F.lit(False))).alias("complete"))


def select_events(rows: DataFrame, wanted: list[str]) -> DataFrame:
    """Rows of events ('A') or of single areas ('A-7'); names that match nothing are errors."""
    joined = F.concat_ws("-", "event_id", "aoi_id")
    known = rows.select(F.explode(F.array(F.col("event_id").cast("string"), joined)).alias("k")).where(F.col("k").isin(wanted)).distinct()
    unknown = sorted(set(wanted) - {r.k for r in known.collect()})  # the caller's list bounds it
    if unknown:
        raise ValueError(f"unknown events {unknown}")
    return rows.where(F.col("event_id").cast("string").isin(wanted) | joined.isin(wanted))


def search(index: DataFrame, box: tuple[float, float, float, float], start: str, end: str, limit: int | None = None) -> DataFrame:
    """Items whose box meets the given one and whose time is from start to the end of the last day."""
    west, south, east, north = box
    hit = (F.col("west") <= east) & (F.col("east") >= west) & (F.col("south") <= north) & (F.col("north") >= south)
    when = (F.col("date") >= F.lit(start).cast("date")) & (F.col("date") < F.date_add(F.lit(end).cast("date"), 1))
    out = index.where(hit & when)
    return out.orderBy("date", "item").limit(limit) if limit else out


def property_filter(items: DataFrame, **bounds: tuple[float | None, float | None]) -> DataFrame:
    """Rows whose properties lie within (low, high); a null counts as 0."""
    for name, (low, high) in bounds.items():
        value = F.coalesce(F.col(name), F.lit(0))
        if low is not None:
            items = items.where(value >= low)
        if high is not None:
            items = items.where(value <= high)
    return items


def first_cases(events: DataFrame, cases: list[str] | None = None, limit: int | None = None, key: str = "flood_case") -> DataFrame:
    if limit is not None and limit <= 0:
        raise ValueError("limit must be positive")
    if cases is not None:
        known = {r[0] for r in events.where(F.col(key).isin(cases)).select(key).distinct().collect()}
        if set(cases) - known:
            raise KeyError(f"unknown cases {sorted(set(cases) - known)}")
        events = events.where(F.col(key).isin(cases))
    events = events.orderBy(key)
    return events.limit(limit) if limit else events


def event_metadata(patches: DataFrame, extent_rank: int) -> DataFrame:
    """Bounds, first dates by role and flooded area of each event; a null role is not the master."""
    master = F.coalesce(F.col("master"), F.lit(False))
    flooded = master & (F.col("crank") == extent_rank) & (F.col("pflood") > 0)
    four = lambda c: F.bround(c, 4)
    return patches.groupBy("actid").agg(
        F.min(F.when(~master, F.col("source_date"))).alias("date_start"),
        F.min(F.when(master, F.col("source_date"))).alias("date_end"),
        *(four(f(c)).alias(n) for f, c, n in ((F.min, "south", "lat_min"), (F.max, "north", "lat_max"), (F.min, "west", "lon_min"), (F.max, "east", "lon_max"))),
        F.bround(F.coalesce(F.sum(F.when(flooded, F.col("area_km2") * F.col("pflood") / 100)), F.lit(0.0)), 1).alias("extent_km2"),
    )


def area_metadata(tiles: DataFrame, last_year: int = 2027) -> DataFrame:
    """Areas of tiles whose delineation times are valid: post not before pre, and not beyond last_year."""
    fine = tiles.where((F.col("post") >= F.col("pre")) & (F.year("post") <= last_year))
    return fine.groupBy("event_id", "aoi_id").agg(
        F.min("pre").alias("date_start"), F.max("post").alias("date_end"), F.min("west").alias("west"), F.max("east").alias("east"), F.count("*").alias("n_tiles"), F.min_by("split", "tile").alias("split"),
        F.bool_and("is_valid").alias("is_valid"), F.bround(F.avg("invalid_frac"), 4).alias("invalid_frac_mean"),
    )


def tile_prefixes(keys: DataFrame, prefix: str) -> DataFrame:
    """Tile folders under a prefix that hold an info.json, with their sorted keys.

    Labelled areas keep tiles at depth two, area 0 at depth three.
    """
    parts = F.split(F.expr(f"substring(key, {len(prefix) + 1})"), "/")
    under = keys.where(F.col("key").startswith(prefix)).withColumn("p", parts).where(F.col("p")[0].rlike(r"^\d+$"))
    zero = F.col("p")[0].cast("int") == 0
    depth = F.when(zero & (F.size("p") >= 4), 3).when(~zero & (F.size("p") >= 3), 2)
    named = under.withColumn("d", depth).where("d IS NOT NULL").withColumn("tile_prefix", F.concat(F.lit(prefix), F.array_join(F.slice("p", F.lit(1), F.col("d")), "/"), F.lit("/")))
    out = named.groupBy("tile_prefix").agg(F.array_sort(F.collect_set("key")).alias("keys"))
    return out.where(F.array_contains("keys", F.concat("tile_prefix", F.lit("info.json"))))
