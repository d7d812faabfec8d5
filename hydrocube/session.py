"""Session settings that the engine's results depend on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Results depend on the time zone; the rest lets Spark re-plan joins and skew while it runs.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def scratch(spark: SparkSession) -> str:
    """A new folder for what a query writes on its way: shared on a cluster, a local one only under a local master."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="hydrocube-")
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def session(app: str = "hydrocube", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
