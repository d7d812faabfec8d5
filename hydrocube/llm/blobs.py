"""Packing of number arrays into binary cells, and shard sizing.

Operators that would shuffle one row per word window shuffle packed arrays
instead: a shard of documents sends each bucket of the hash space one cell.
Sorted hashes are stored as differences with their bytes transposed, so only
the bits that carry information cost anything after compression.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHARD_BYTES, BUCKET_BYTES = 8 << 20, 256 << 20

_DTYPES = (np.uint8, np.uint16, np.uint32, np.uint64)


def pack(values: np.ndarray, ascending: bool = False) -> bytes:
    """Unsigned integers to bytes; ascending ones are stored as differences."""
    v = values.astype(np.uint64)
    if ascending and len(v):
        v = np.diff(v, prepend=np.uint64(0))
    head = bytes([ascending]) + len(v).to_bytes(8, "little")
    return head + zstandard.ZstdCompressor(level=1).compress(v.view(np.uint8).reshape(-1, 8).T.tobytes())


def unpack(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[1:9], "little")
    raw = zstandard.ZstdDecompressor().decompress(blob[9:], max_output_size=max(8 * n, 1))
    v = np.frombuffer(raw, np.uint8).reshape(8, n).T.copy().view(np.uint64).ravel()
    return np.cumsum(v, dtype=np.uint64) if blob[0] else v


def pack_bits(flags: np.ndarray) -> bytes:
    return len(flags).to_bytes(8, "little") + np.packbits(flags).tobytes()


def unpack_bits(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    return np.unpackbits(np.frombuffer(blob, np.uint8, offset=8), count=n).astype(bool)


def signed(ids: pa.Array) -> np.ndarray:
    """Integer ids as numpy; a null sorts after every id."""
    if isinstance(ids, pa.ChunkedArray):
        ids = ids.combine_chunks()
    return ids.cast(pa.int64()).fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)


def texts_of(values: bytes, bounds: np.ndarray) -> pa.Array:
    """A string array over one byte string, from n + 1 bounds."""
    return pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(values))


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def shard_count(df: DataFrame, text: str = "text", shard_bytes: int = SHARD_BYTES, bucket_bytes: int = BUCKET_BYTES) -> tuple[int, int]:
    """(shards of documents, buckets of the hash space) for the text of df.

    Every shard may send each bucket a cell, so shards grow with the square root
    of the text and buckets cover more text than shards: cells stay well filled.
    """
    total, least = df.agg(F.sum(F.octet_length(text))).first()[0] or 0, shuffle_partitions(df.sparkSession)
    return max(least, int(total // max(shard_bytes, 6.4 * total**0.5)) + 1), max(least, int(total // bucket_bytes) + 1)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share. Where none is set it is a local one under a local master, as in tests, and an error on a cluster."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        import tempfile

        spark.conf.set("spark.checkpoint.dir", found := "file://" + tempfile.mkdtemp(prefix="hydrocube-"))
    return found


def written(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder: cuts lineage, and lost executors cost no recomputation."""
    return Tables().write(df)


class Tables:
    """Tables in the shared folder that can go once nothing reads them any more."""

    def __init__(self) -> None:
        self.paths: list[tuple[SparkSession, str]] = []

    def write(self, df: DataFrame) -> DataFrame:
        path = f"{shared_folder(df.sparkSession).rstrip('/')}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        self.paths.append((df.sparkSession, path))
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def drop(self, keep: int = 0) -> None:
        """Deletes all tables but the last `keep`."""
        gone, self.paths = self.paths[: len(self.paths) - keep], self.paths[len(self.paths) - keep :]
        for spark, path in gone:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
