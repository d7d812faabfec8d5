"""Registration of queries with their SQL, and the pixel views that both read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Pixel views over the driver's tables; {name} stands for a table.
VIEWS = {
    "obs": """SELECT CAST(ts AS DATE) AS date, CAST(event_id % 16 AS INT) AS row_, CAST(user_id % 16 AS INT) AS col_, event_id AS seq,
        CAST(CASE event_type WHEN 'click' THEN 100 + event_id % 101 WHEN 'view' THEN 17 WHEN 'signup' THEN 99
          WHEN 'error' THEN CASE event_id % 4 WHEN 0 THEN 30 WHEN 1 THEN 20 WHEN 2 THEN 50 ELSE 1 END
          ELSE CASE event_id % 2 WHEN 0 THEN 15 ELSE 16 END END AS INT) AS viirs_code,
        CAST(CASE event_id % 5 WHEN 4 THEN 255 ELSE event_id % 5 END AS INT) AS modis_code,
        CAST(CASE event_id % 7 WHEN 0 THEN 255 ELSE event_id % 2 END AS INT) AS gfm_flood,
        CAST(CASE event_id % 9 WHEN 0 THEN 255 ELSE event_id % 2 END AS INT) AS gfm_water,
        CAST(CASE event_id % 4 WHEN 3 THEN 255 ELSE event_id % 4 END AS INT) AS gfm_ref,
        CAST(CASE event_id % 11 WHEN 0 THEN 255 ELSE event_id % 8 END AS INT) AS gfm_flags,
        CAST(CASE event_id % 13 WHEN 0 THEN 255 ELSE event_id % 101 END AS INT) AS gfm_likelihood, value FROM {events}""",
    "scene_px": "SELECT CAST(l_partkey % 64 AS INT) AS row_, CAST(l_suppkey % 64 AS INT) AS col_, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity / 50.0 END AS v, CAST(l_quantity AS INT) AS code FROM {lineitem}",
    "catalogue": """SELECT CAST(o_orderdate AS DATE) AS date, CAST(o_custkey % 24 AS INT) AS tile, o_orderkey AS item,
        CAST(o_orderkey % 340 AS DOUBLE) - 180.0 AS west, CAST(o_orderkey % 340 AS DOUBLE) - 179.0 + CAST(o_custkey % 5 AS DOUBLE) AS east,
        CAST(o_custkey % 150 AS DOUBLE) - 80.0 AS south, CAST(o_custkey % 150 AS DOUBLE) - 79.0 + CAST(o_orderkey % 5 AS DOUBLE) AS north FROM {orders}""",
    "aoi": """SELECT CAST(n_nationkey AS INT) AS event_id, CAST(n_nationkey * 13 % 340 AS DOUBLE) - 180.0 AS west, CAST(n_nationkey * 13 % 340 AS DOUBLE) - 170.0 AS east,
        CAST(n_nationkey * 7 % 150 AS DOUBLE) - 80.0 AS south, CAST(n_nationkey * 7 % 150 AS DOUBLE) - 70.0 AS north, DATE '1995-01-01' AS d0, DATE '1998-12-31' AS d1 FROM {nation}""",
    "tasks": "SELECT o_orderkey AS task_id, CAST(o_orderdate AS DATE) AS date, CASE o_orderstatus WHEN 'F' THEN 'DONE' WHEN 'O' THEN 'FAILED' ELSE NULL END AS status, CAST(o_custkey AS INT) AS event_id FROM {orders}",
    "quarters": """SELECT o_orderkey AS task_id, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS date,
        CASE WHEN CAST(o_orderdate AS DATE) < DATE '1998-01-01' OR o_orderkey % 3 > 0 THEN 'DONE' WHEN o_orderstatus = 'O' THEN 'FAILED' ELSE NULL END AS status FROM {orders}""",
    "patches": """SELECT CAST(c_nationkey AS INT) AS actid, c_custkey AS patch, CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN TRUE WHEN 2 THEN TRUE ELSE FALSE END AS master, CAST(c_custkey % 3 AS INT) AS crank,
        date_add_days AS source_date, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(c_custkey % 101 AS DOUBLE) END AS pflood, abs(c_acctbal) / 100.0 AS area_km2,
        CAST(c_custkey % 300 AS DOUBLE) / 2.0 - 90.0 AS west, CAST(c_custkey % 300 AS DOUBLE) / 2.0 - 89.5 AS east, CAST(c_custkey % 120 AS DOUBLE) / 2.0 - 40.0 AS south, CAST(c_custkey % 120 AS DOUBLE) / 2.0 - 39.5 AS north
        FROM (SELECT *, DATE '2020-01-01' + CAST(c_custkey % 400 AS INT) AS date_add_days FROM {customer})""",
}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A pixel view as a DataFrame."""
    text = VIEWS[name]
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text})


def in_sql(text: str) -> str:
    """SQL with {view} names put in as subqueries over the registered tables."""
    for name, body in VIEWS.items():
        for t in TABLES:
            body = body.replace("{" + t + "}", t)
        text = text.replace("{" + name + "}", f"({body})")
    return text


def query(name: str, sql: str | None = None):
    """Registers (spark, sf_dir) -> DataFrame with its SQL; {view} names in the SQL stand for pixel views."""

    def keep(build: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = in_sql(sql)
        return build

    return keep
