"""Exact top-k search by inner product over an impact-ordered index.

Vectors are held in blocks. A block's postings (vector, dimension, value) are
ordered by descending impact, the absolute value, and cut into segments of equal
quantised impact. For each query the segments are processed from the highest
impact down, adding value * weight to the scores of the vectors they name. What
is still unread can change no score by more than the weights times the largest
unread impact of each dimension: that bound proves which vectors cannot be among
the best k, and the others, the possible members, are scored exactly. A query
stops reading when its possible members are few, or when reading on would cost
more than scoring them; as the proof decides who is scored, the result is exact
wherever it stops. A query takes the blocks of a span in turn and carries its
k-th best score so far from one to the next: where the bounds show that reading
could only fall below that score after more work than scoring the block takes,
it reads nothing of that block. Each span's best k are then merged.

Queries and vectors both travel as packed cells of bounded size, in the smallest
integers that hold them. A span of vectors gets one copy of the queries' cells:
no join brings the two together, so nothing can be broadcast to meet, and no
row of one side is repeated for a row of the other.

Defined cases: vectors that are null or hold a null or non-finite component,
and rows with a null id, take no part; only vectors of the query's length are
scored; rows with the query's id are not its candidates; of repeated query ids
the row with the smallest vector asks; repeated candidate ids are candidates
each; ties go to the smaller id; other columns are ignored.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .textkit import small_batches

BLOCK, QUERY_BLOCK, STEPS = 4096, 512, 2
#: Vectors of a span, and of a cell of it.
SPAN, CELL = 16 * BLOCK, 1024
#: Queries that are added to scores together, and how many times an exact product's work a posting costs.
TOGETHER, COST = 32, 16


def quantised(column: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component; null where a component is null or not finite."""
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(fine, F.transform(column, lambda x: F.floor(x.cast("double") * scale)))


def _norm(vectors: np.ndarray) -> float:
    """The largest norm of a row, rounded up."""
    return float(np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1).max(initial=0))) * (1 + 1e-9)


def _below(x: np.ndarray, kind: type) -> np.ndarray:
    """x in another type, not above x."""
    return np.nextafter(x.astype(kind), kind(-np.inf))


class Index:
    """A block's postings by descending quantised impact."""

    def __init__(self, vectors: np.ndarray):
        self.vectors, self.norm = vectors, _norm(vectors)
        impact = np.abs(vectors)
        self.level = np.floor(STEPS * np.log2(np.maximum(impact, 1))).astype(np.int16)  # impacts quantised by their logarithms
        top, width = int(self.level.max(initial=0)) + 1, vectors.shape[1]
        flat = (self.level.astype(np.int64) * width + np.arange(width)).ravel()
        most = np.zeros(top * width, impact.dtype)
        np.maximum.at(most, flat, impact.ravel())
        most, n = np.maximum.accumulate(most.reshape(top, width)), np.bincount(self.level[vectors != 0], minlength=top)
        levels = np.flatnonzero(n)[::-1]
        # the largest impact of each dimension that is unread before and after each segment, and the postings read by then
        self.unread = np.array([most[-1], *(most[k - 1] if k else 0 * most[0] for k in levels)], np.float64)
        self.upto = np.append(0, np.cumsum(n[levels]))
        self.read = 0  # postings added to scores so far, times queries
        self._turned: dict = {}

    @cached_property
    def segments(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        vec, dim = np.nonzero(self.vectors)
        order = np.argsort(-self.level[vec, dim], kind="stable")  # by level, and by vector within one
        vec, dim = vec[order].astype(np.int32), dim[order].astype(np.int32)
        value = self.vectors[vec, dim]
        return [(vec[a:b], dim[a:b], value[a:b]) for a, b in zip(self.upto, self.upto[1:])]

    def _add(self, score: np.ndarray, weights: np.ndarray, segment: tuple, rows: np.ndarray) -> None:
        """score: vectors by queries, so that a posting adds to neighbouring cells."""
        vec, dim, value = segment
        first = np.flatnonzero(np.diff(vec, prepend=-1))
        value = value.astype(score.dtype)[:, None]
        for at in range(0, len(rows), TOGETHER):
            some = rows[at : at + TOGETHER]
            score[np.ix_(vec[first], some)] += np.add.reduceat(weights[some].T.copy()[dim] * value, first, axis=0)
        self.read += len(vec) * len(rows)

    def _narrowed(self, weights: np.ndarray, own: tuple[np.ndarray, np.ndarray], k: int, floor: np.ndarray) -> np.ndarray:
        """Which vectors (columns) each query's reading leaves possible. own: pairs (row, place) that are no candidates."""
        n, m = len(self.vectors), len(weights)
        score, possible = np.zeros((n, m), weights.dtype), np.ones((n, m), bool)
        possible[own[1], own[0]] = False
        reading, spent = np.arange(m), 0
        for segment, unread in zip(self.segments, self.unread[1:]):
            # reading on pays while it costs less than scoring the possible members
            left = np.count_nonzero(possible[:, reading], axis=0)
            spent += COST * len(segment[0])
            reading = reading[(left > 4 * k) & (spent <= left * weights.shape[1])]
            if not len(reading):
                break
            self._add(score, weights, segment, reading)
            bound = np.abs(weights[reading]).astype(np.float64) @ unread
            some = score[:, reading]
            low, high = some.min(axis=0), some.max(axis=0)
            drops = np.flatnonzero(np.maximum(floor[reading] - bound, high - 2 * bound if n > k else -np.inf) > low)
            if not len(drops):  # no score lies so far below another
                continue
            rows, bound, some = reading[drops], bound[drops], some[:, drops]
            least = floor[rows]
            if n > k:
                held = np.where(possible[:, rows], some, -np.inf)
                least = np.maximum(least, np.partition(held, n - k, axis=0)[n - k] - bound)
            possible[:, rows] &= some >= _below(least - bound, weights.dtype.type)
        return possible.T

    def _worth(self, weights: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """Queries for which what is unread may fall below the floor before reading has cost as much as scoring the block; all without a floor."""
        bounds = np.abs(weights).astype(np.float64) @ self.unread.T
        first = np.argmax(bounds < floor[:, None], axis=1)
        falls = bounds[np.arange(len(first)), first] < floor
        return np.isneginf(floor) | falls & (COST * self.upto[first] <= self.vectors.size)

    def members(self, queries: np.ndarray, own: tuple[np.ndarray, np.ndarray], k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, place, score) of the queries' possible members, scored exactly, but those that the score shows to be none.

        own: pairs (row, place) that are no candidates. floor: for each query, a
        score that k candidates reach elsewhere, or minus infinity.
        """
        n, m, top = len(self.vectors), len(queries), self.norm * _norm(queries)
        if top >= 1 << 53:
            score = queries.astype(object) @ self.vectors.T.astype(object)
            kept = np.array(score >= floor[:, None], bool).reshape(m, n)
            kept[own] = False
            row, place = np.nonzero(kept)
            return row, place, score[row, place]
        # no sum of products, in whatever order, exceeds the norms' product: below 2^24 every step is exact in 32 bits
        kind = np.float32 if top < 1 << 24 else np.float64
        weights, out = queries.astype(kind), []
        if kind not in self._turned:
            self._turned[kind] = np.ascontiguousarray(self.vectors.T.astype(kind))
        reads = np.flatnonzero(self._worth(weights, floor))
        whole = np.ones(m, bool)
        if len(reads):
            at = np.searchsorted(reads, own[0])
            mine = reads[np.minimum(at, len(reads) - 1)] == own[0]
            possible = self._narrowed(weights[reads], (at[mine], own[1][mine]), k, floor[reads])
            few = np.count_nonzero(possible, axis=1) * 8 <= n
            whole[reads[few]] = False
            for row, these in zip(reads[few], possible[few]):
                place = np.flatnonzero(these)
                score = self.vectors[place].astype(np.int64) @ queries[row].astype(np.int64)
                kept = score >= floor[row]
                out.append((np.full(kept.sum(), row), place[kept], score[kept]))
        rows, held = np.flatnonzero(whole), whole[own[0]]
        for at in range(0, len(rows), 128):
            some = rows[at : at + 128]
            score = weights[some] @ self._turned[kind]
            mine = held & (own[0] >= some[0]) & (own[0] <= some[-1])
            mine = np.searchsorted(some, own[0][mine]), own[1][mine]
            score[mine] = -np.inf
            least, new = floor[some], np.isneginf(floor[some])
            if n > k and new.any():
                least[new] = np.partition(score[new], n - k, axis=1)[:, n - k]
            kept = score >= _below(least, kind)[:, None]
            kept[mine] = False
            row, place = np.divmod(np.flatnonzero(kept), n)
            out.append((some[row], place, score[row, place].astype(np.int64)))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3

    def search(self, queries: np.ndarray, own: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(places, scores) of each query's possible members, scored exactly. own: for each query, which places are not its candidates."""
        row, place, score = self.members(queries, np.nonzero(own), k, np.full(len(queries), -np.inf))
        return [(place[row == q], score[row == q]) for q in range(len(queries))]


class Span:
    """Vectors of one length, in blocks with an index each."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.blocks, cuts = [], [0]
        while cuts[-1] < len(ids):  # the first, which has no floor yet, is small, and the next ones grow as the floor does
            cuts.append(min(len(ids), cuts[-1] + min(BLOCK, max(BLOCK // 8, cuts[-1]))))
        for a, b in zip(cuts, cuts[1:]):
            order = np.argsort(ids[a:b], kind="stable")
            self.blocks.append((ids[a:b][order], Index(vectors[a:b][order])))

    def best(self, qids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, id, score) of each query's best k, in their order."""
        best, floor, more = (np.zeros(0, np.int64),) * 3, np.full(len(qids), -np.inf), []
        for n, (ids, index) in enumerate(self.blocks, 1):
            a, b = np.searchsorted(ids, qids, "left"), np.searchsorted(ids, qids, "right")
            own = np.repeat(np.arange(len(qids)), b - a)
            at = np.arange(len(own)) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + a[own]
            row, place, score = index.members(queries, (own, at), k, floor)
            more.append((row, ids[place], score))
            if n < len(self.blocks) and 2 * sum(len(x[0]) for x in more) < k * len(qids):
                continue  # the floor would hardly rise
            row, found, score = (np.concatenate(x) for x in zip(best, *more))
            order = np.lexsort((found, -score, row))
            row, found, score = row[order], found[order], score[order]
            starts = np.flatnonzero(np.diff(row, prepend=-1))
            rank = np.arange(len(row)) - np.repeat(starts, np.diff(np.append(starts, len(row))))
            best, last, more = tuple(x[rank < k] for x in (row, found, score)), rank == k - 1, []
            floor[row[last]] = _below(score[last], np.float64)
        return best


def _packed(ids: np.ndarray, vectors: np.ndarray) -> bytes:
    most, least = int(vectors.max(initial=0)), int(vectors.min(initial=0))
    size = next(s for s in (2, 4, 8) if s == 8 or max(most, -least) < 1 << 8 * s - 1)  # the absolute values fit as well
    head = np.array([len(ids), vectors.shape[1], size], "<i8")
    return head.tobytes() + ids.astype("<i8").tobytes() + vectors.astype(f"<i{size}").tobytes()


def _unpacked(cell: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, width, size = (int(x) for x in np.frombuffer(cell, "<i8", 3))
    return np.frombuffer(cell, "<i8", n, 24), np.frombuffer(cell, f"<i{size}", n * width, 24 + 8 * n).reshape(n, width)


def _cells(rows: DataFrame, n_spans: int, size: int) -> DataFrame:
    """(span, data) of packed cells of one length each, dealt over the spans in turn."""

    def pack(batches):
        from pyspark import TaskContext

        turn = TaskContext.get().partitionId() * 0x9E3779B1 >> 8
        waiting: dict[int, list] = {}

        def cell(parts):
            nonlocal turn
            turn += 1
            ids, vectors = (np.concatenate(x) for x in zip(*parts))
            return pa.RecordBatch.from_pydict({"span": pa.array([turn % n_spans], pa.int32()), "data": pa.array([_packed(ids, vectors)], pa.binary())})

        for batch in batches:
            ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            ends = lists.offsets.to_numpy()
            values, widths = lists.values.to_numpy(zero_copy_only=False), np.diff(ends)
            for width in np.unique(widths):
                here = np.flatnonzero(widths == width)
                for at in range(0, len(here), size):
                    some = here[at : at + size]
                    parts = waiting.setdefault(int(width), [])
                    parts.append((ids[some], values[ends[some][:, None] + np.arange(width)]))
                    if sum(len(x[0]) for x in parts) >= size:
                        yield cell(waiting.pop(int(width)))
        for parts in waiting.values():
            yield cell(parts)

    return small_batches(rows).select("vec_id", "v").mapInArrow(pack, "span int, data binary")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score) from frames (vec_id long, v array<long>)."""
    usable = F.col("v").isNotNull() & F.col("vec_id").isNotNull()
    rows, asked = vectors.where(usable), queries.where(usable).groupBy("vec_id").agg(F.min("v").alias("v"))
    n_spans = max(16, -(-vectors.count() // SPAN))
    held = _cells(rows, n_spans, CELL).withColumn("asks", F.lit(False))
    asking = _cells(asked, 1, QUERY_BLOCK).select(F.explode(F.sequence(F.lit(0), F.lit(n_spans - 1))).alias("span"), "data", F.lit(True).alias("asks"))

    def search(batches):
        at, parts, spans, waiting = None, [], {}, {}

        def answer(width):
            ids, weights = (np.concatenate(x) for x in zip(*waiting.pop(width)))
            row, found, score = spans[width].best(ids, weights, k)
            return pa.RecordBatch.from_pydict({"query_id": pa.array(ids[row], pa.int64()), "vec_id": pa.array(found, pa.int64()), "score": pa.array(score.astype(np.int64), pa.int64())})

        for batch in batches:
            for span, asks, data in zip(*(batch.column(c) for c in ("span", "asks", "data"))):
                if span.as_py() != at:  # the cells of a span stand together, its vectors before the queries
                    for width in list(waiting):
                        yield answer(width)
                    at, parts, spans = span.as_py(), [], {}
                ids, matrix = _unpacked(data.as_py())
                if not asks.as_py():
                    parts.append((ids, matrix))
                    continue
                for width in {m.shape[1] for _, m in parts}:
                    spans[width] = Span(*(np.concatenate(x) for x in zip(*((i, m) for i, m in parts if m.shape[1] == width))))
                parts = []
                if (width := matrix.shape[1]) in spans:
                    waiting.setdefault(width, []).append((ids, matrix))
                    if sum(len(x[0]) for x in waiting[width]) >= QUERY_BLOCK:
                        yield answer(width)
        for width in list(waiting):
            yield answer(width)

    met = held.unionByName(asking).repartitionById(n_spans, F.col("span")).sortWithinPartitions("span", "asks")
    best = met.mapInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
