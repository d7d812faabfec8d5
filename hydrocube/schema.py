"""Table schemas: catalogues, events, tracker, cube and metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _schema(text: str) -> T.StructType:
    return T._parse_datatype_string(text)


BBOX = "struct<west: double, south: double, east: double, north: double>"
SCHEMAS = {
    "viirs_catalogue": "date string, aoi_id int, s3_key string, geometry binary",
    "modis_catalogue": "date string, h int, v int, task_id string, source_uri string",
    "gfm_catalogue": "date string, equi7_tile string, item_id string, item_href string, west double, south double, east double, north double",
    "flood_event": f"event_id string, bbox {BBOX}, start_date date, end_date date, sources array<string>",
    "tile_metadata": f"source string, tile_id string, date date, bbox {BBOX}, cloud_fraction double, quality_bitmask int",
    "search_result": "source string, date date, url string, properties map<string, string>",
    "gfm_task": f"task_id string, date string, equi7_tile string, item_hrefs array<string>, bbox {BBOX}",
    "tracker": "task_id string, status string, output_uri string, error string, attempts int, finished_at timestamp",
    "bookmarks": f"event_id string, start_date date, end_date date, sources array<string>, label string, updated_at timestamp, geometry {BBOX}",
    "cube": "source string, date date, row int, col int, layer string, value int",
    "checkpoints": "event_id string, source string, stage string, finished_at timestamp",
    "manifest": "run_id string, source string, year int, written_at timestamp, body string",
}


def schema(name: str) -> T.StructType:
    return _schema(SCHEMAS[name])


def require_columns(df: DataFrame, needed: list[str], what: str = "table") -> DataFrame:
    """df, or a loud error that lists what is missing."""
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}; it has {df.columns}")
    return df
