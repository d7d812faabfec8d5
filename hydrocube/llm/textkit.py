"""Vectorised word tools over UTF-8 buffers, shared by the text operators.

A batch of texts is handled in chunks of a few megabytes: the texts are laid
end to end with a separator byte behind each, words are found with byte masks
and hashed eight bytes at a time, so no Python object is made per word.
"""

from __future__ import annotations

import ctypes
import functools
import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES, CHUNK_ROWS = 1 << 20, 2048

_U = np.uint64
#: Words of up to LONG bytes are hashed eight bytes at a time, longer ones by a digest.
LONG = 64


def is_space_table() -> np.ndarray:
    """True for the bytes that part words: space and tab to carriage return."""
    t = np.zeros(256, bool)
    t[[0x20, *range(0x09, 0x0E)]] = True
    return t


SPACE = is_space_table()

LOWER_AZ = np.arange(256, dtype=np.uint8)
LOWER_AZ[0x41:0x5B] += 0x20

#: Multipliers of the words of a window, by place.
_PLACES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_HEAD_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of n + 1) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), off


class Chunk:
    """Texts first .. last - 1 of a batch: word bounds, counts and hashes."""

    def __init__(self, data: np.ndarray, off: np.ndarray, first: int, last: int, lower: bool, gap: np.ndarray = SPACE):
        lengths = np.diff(off[first : last + 1])
        total = int(lengths.sum()) + (last - first)
        buf = np.full(total, 0x20, np.uint8)
        self.starts = np.cumsum(lengths + 1) - (lengths + 1)
        body = np.ones(total, bool)
        body[self.starts + lengths] = False
        buf[body] = data[off[first] : off[last]]
        if lower:
            buf = LOWER_AZ[buf]
        self.buf, self.lengths, self.first, self.last = buf, lengths, first, last
        edge = np.flatnonzero(np.diff(np.concatenate(([True], gap[buf]))))
        self.word_start, self.word_end = edge[0::2], edge[1::2]
        self.word_doc_end = np.searchsorted(self.word_start, self.starts + lengths)
        self.n_words = np.diff(np.concatenate(([0], self.word_doc_end)))
        self.word_doc_start = self.word_doc_end - self.n_words

    def word_hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes, mixed after every eight bytes."""
        start, size = self.word_start, self.word_end - self.word_start
        padded = np.concatenate([self.buf, np.zeros(8, np.uint8)])
        eight = np.ndarray(len(self.buf) + 1, "<u8", padded, strides=(1,))
        out = mix(size.astype(np.uint64) + _PLACES[0])
        rest, at = np.arange(len(start)), start
        for done in range(0, LONG, 8):
            left = size[rest] - done
            out[rest] = mix((out[rest] ^ (eight[at] & _HEAD_BYTES[np.minimum(left, 8)])) * _PLACES[1])
            more = left > 8
            rest, at = rest[more], at[more] + 8
            if not len(rest):
                break
        for k in rest:
            out[k] = int.from_bytes(hashlib.blake2b(self.buf[start[k] : start[k] + size[k]], digest_size=8).digest(), "little")
        return out

    def window_hashes(self, hashes: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
        """Hash of the words i .. i + width - 1 for each i up to len - width, across document bounds too."""
        n = len(hashes) - width + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        values = hashes if not seed else mix(hashes + _U(seed))
        out = np.zeros(n, np.uint64)
        for k in range(width):
            out += values[k : k + n] * _PLACES[2 + k % 254]
            if k % 254 == 253:
                out = mix(out)
        return mix(out)

    def doc_of_words(self) -> np.ndarray:
        return np.repeat(np.arange(self.last - self.first), self.n_words)


def chunks(column: pa.Array, lower: bool = False, limit: int = CHUNK_BYTES, gap: np.ndarray = SPACE) -> Iterator[Chunk]:
    """Chunks of about limit bytes and CHUNK_ROWS texts at most; one longer text is a chunk of its own."""
    data, off = text_buffers(column)
    n, first = len(off) - 1, 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(off, off[first] + limit, "right")) - 1)
        last = min(last, n, first + CHUNK_ROWS)
        yield Chunk(data, off, first, last, lower, gap)
        first = last


def lean(run: Callable) -> Callable:
    """run over a task's batches, which then hands freed memory back: workers are used again by later stages."""

    @functools.wraps(run)
    def freed(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return freed


def small_batches(df, size: int = 4 << 20):
    """df, in whose session Arrow batches of text have no more than size bytes from here on; a longer text is a batch of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = df.sparkSession.conf.get(key, None)
    if held is None or int(re.sub(r"\D", "", held) or 0) > size:
        df.sparkSession.conf.set(key, str(size))
    return df
