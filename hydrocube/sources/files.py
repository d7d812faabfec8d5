"""Files and folders of any file system that Spark reads."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def is_remote(uri: str) -> bool:
    """A URI whose scheme is not that of local files."""
    return "://" in uri and not uri.startswith("file://")


def exists(spark: SparkSession, uri: str) -> bool:
    path, fs = _at(spark, uri)
    return fs.exists(path)


def delete(spark: SparkSession, uri: str) -> None:
    path, fs = _at(spark, uri)
    fs.delete(path, True)


def names(spark: SparkSession, folder: str) -> list[str]:
    path, fs = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def write_text(spark: SparkSession, uri: str, text: str) -> None:
    """A new small file; one that is there is an error."""
    path, fs = _at(spark, uri)
    out = fs.create(path, False)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, uri: str) -> str:
    return "\n".join(r.value for r in spark.read.option("wholetext", True).text(uri).collect())  # one small file


def copy(spark: SparkSession, source: str, target: str) -> None:
    (a, fa), (b, fb) = _at(spark, source), _at(spark, target)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fa, a, fb, b, False, True, spark._jsc.hadoopConfiguration())


def swap(spark: SparkSession, staged: str, target: str, rows: int | None = None) -> None:
    """Puts a staged table in a table's place; what was there comes back unless the new one holds `rows` rows."""
    (new, fs), (old, _) = _at(spark, staged), _at(spark, target)
    aside, _ = _at(spark, f"{target.rstrip('/')}-{uuid.uuid4().hex}")
    had = fs.exists(old)
    if had and not fs.rename(old, aside):
        raise OSError(f"{target} cannot be moved")
    try:
        if not fs.rename(new, old):
            raise OSError(f"{staged} cannot be moved to {target}")
        spark.catalog.refreshByPath(target)
        if rows is not None and (found := spark.read.parquet(target).count()) != rows:
            raise ValueError(f"{target} holds {found} rows, not {rows}")
    except Exception:
        if fs.exists(old):
            fs.delete(old, True)
        if had:
            fs.rename(aside, old)
        raise
    if had:
        fs.delete(aside, True)
