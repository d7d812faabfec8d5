"""Exact removal of repeated word passages, by difference-cover anchors.

A window is `width` consecutive words of one document. Every word covered by a
window whose word sequence also starts earlier (smaller doc_id, or the same
document and an earlier start) is removed, judged on the input.

Two occurrences of a window at word positions i and j share an anchor: a short
run of `anchor` words at the same offset in both whose positions lie in a
difference cover modulo `period`. So only the cover positions, 4 of 13, are
hashed and exchanged to find where repeats can be (step 1); what extends from
anchors that occur twice, all windows that can hold one of them, is then hashed
with 96 bits, mixed every eight bytes of a word and by the place in the window,
and exchanged to find each window's first document (step 2). Both exchanges carry packed arrays
with one entry per shard and distinct hash, so a passage that a third of all
documents share costs one entry per shard, never one per occurrence.

Defined cases: a null or empty text has no words, and its kept text is empty;
of rows that share a doc_id none is earlier than another, whatever their starts;
a null doc_id sorts after all others, and rows without one share it; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blobs import pack, pack_bits, shard_count, signed, texts_of, unpack, unpack_bits
from .textkit import chunks

#: A perfect difference set: each non-zero residue modulo 13 is the difference of two of these.
PERIOD, COVER = 13, (0, 1, 3, 9)
FILTER_BITS = 48


class Shard:
    """One shard's words, its anchors and, from flags on them, its candidate windows."""

    def __init__(self, table: pa.Table, width: int):
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        self.ids, self.width, self.anchor = signed(table.column("doc_id")), width, width + 1 - PERIOD
        self.doc_ids = table.column("doc_id")
        self.parts = list(chunks(table.column("text")))
        self.words = [c.word_hashes() for c in self.parts]
        base, anchors, places = 0, [], []
        for c, w in zip(self.parts, self.words):
            pos = np.arange(len(w)) - np.repeat(c.word_doc_start, c.n_words)
            left = np.repeat(c.word_doc_end, c.n_words) - np.arange(len(w))
            at = np.flatnonzero(np.isin(pos % PERIOD, COVER) & (left >= self.anchor) & (np.repeat(c.n_words, c.n_words) >= width))
            anchors.append(c.window_hashes(w, self.anchor)[at] >> np.uint64(64 - FILTER_BITS) if len(at) else np.zeros(0, np.uint64))
            places.append(at + base)
            base += len(w)
        self.n_words = base
        self.places = np.concatenate(places or [np.zeros(0, np.int64)])
        self.hashes, self.which, self.count = np.unique(np.concatenate(anchors or [np.zeros(0, np.uint64)]), return_inverse=True, return_counts=True)

    def windows(self, repeated: np.ndarray) -> None:
        """Windows around repeated anchors: places, and 96 bits of hash sorted with the first place of each."""
        spots = self.places[(repeated | (self.count > 1))[self.which]] if len(self.places) else self.places
        cover = np.zeros(self.n_words + 1, np.int32)
        np.add.at(cover, np.maximum(spots - (PERIOD - 1), 0), 1)
        np.add.at(cover, spots + 1, -1)
        near = np.cumsum(cover[:-1]) > 0
        base, one, two, at, doc = 0, [], [], [], []
        for c, w in zip(self.parts, self.words):
            left = np.repeat(c.word_doc_end, c.n_words) - np.arange(len(w))
            here = np.flatnonzero(near[base : base + len(w)] & (left >= self.width))
            if len(here):
                one.append(c.window_hashes(w, self.width)[here])
                two.append(c.window_hashes(w, self.width, seed=77)[here] >> np.uint64(32))
                doc.append(c.first + np.searchsorted(c.word_doc_end, here, "right"))
                at.append(here + base)
            base += len(w)
        none = np.zeros(0, np.uint64)
        one, two = np.concatenate(one or [none]), np.concatenate(two or [none])
        at, doc = np.concatenate(at or [none.astype(np.int64)]), np.concatenate(doc or [none.astype(np.int64)])
        order = np.lexsort((at, two, one))
        one, two, at, doc = one[order], two[order], at[order], doc[order]
        new = np.ones(len(one), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        first = np.flatnonzero(new)
        self.one, self.two, self.group = one[first], two[first], np.cumsum(new) - 1
        self.at, self.first_doc, self.is_first = at, self.ids[doc[first]] if len(first) else np.zeros(0, np.int64), new
        # of rows that share the least doc_id none is earlier: the first occurrence in each of them stays
        if len(first) and len(np.unique(self.ids)) < len(self.ids):
            own = new.copy()
            own[1:] |= doc[1:] != doc[:-1]
            self.is_first = own & (self.ids[doc] == self.ids[doc[first[self.group]]])

    def kept(self, elsewhere: np.ndarray) -> pa.Table:
        """Texts without the words of windows that start earlier, here or elsewhere."""
        gone = self.at[~self.is_first | elsewhere[self.group]] if len(self.at) else self.at
        cover = np.zeros(self.n_words + 1, np.int32)
        np.add.at(cover, gone, 1)
        np.add.at(cover, gone + self.width, -1)
        stay = np.cumsum(cover[:-1]) <= 0
        base, out = 0, []
        for c, w in zip(self.parts, self.words):
            k = stay[base : base + len(w)]
            base += len(w)
            edge = np.zeros(len(c.buf) + 2, np.int8)
            edge[c.word_start[k]] += 1
            edge[c.word_end[k] + 1] -= 1
            data = c.buf[np.cumsum(edge[: len(c.buf)]) > 0]
            ends = np.cumsum(c.word_end[k] - c.word_start[k] + 1)
            data[ends - 1] = 0x20
            kept = np.add.reduceat(np.append(k, False).astype(np.int64), c.word_doc_start) * (c.n_words > 0) if len(c.n_words) else c.n_words
            last = np.cumsum(kept)
            stop = np.append(0, ends)[last]
            drop = np.unique(stop[kept > 0] - 1)
            data = np.delete(data, drop)
            bounds = np.concatenate(([0], stop - np.cumsum(kept > 0)))
            out.append(pa.table({"n_words": c.n_words.astype(np.int64), "n_removed": c.n_words.astype(np.int64) - kept, "kept_text": texts_of(data.tobytes(), bounds)}))
        if not out:
            return pa.table({"doc_id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()), "kept_text": pa.array([], pa.string())})
        rest = pa.concat_tables(out)
        return rest.add_column(0, "doc_id", self.doc_ids.cast(pa.int64()))


def _cuts(hashes: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Bounds of each bucket's slice of sorted hashes."""
    edges = [(b << bits) // buckets for b in range(buckets)]
    return np.append(np.searchsorted(hashes, np.array(edges, np.uint64)), len(hashes))


def _masks(flags: pa.Table, kind: int, cuts: np.ndarray) -> np.ndarray:
    """The flags of one kind that buckets sent back, over all of a shard's hashes."""
    out = np.zeros(cuts[-1], bool)
    for k, b, m in zip(*(flags.column(n).to_pylist() for n in ("kind", "bucket", "mask"))):
        if k == kind:
            out[cuts[b] : cuts[b + 1]] = unpack_bits(m)
    return out


def _shared(table: pa.Table) -> pa.Table:
    """Of one bucket: which of each shard's anchor hashes other shards have too."""
    parts = [unpack(x) for x in table.column("hashes").to_pylist()]
    _, which, count = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    flags, at = count[which] > 1, np.cumsum([0, *map(len, parts)])
    return _answer(table, 1, [flags[at[k] : at[k + 1]] for k in range(len(parts))])


def _first(table: pa.Table) -> pa.Table:
    """Of one bucket: which of each shard's windows occur in a smaller doc_id of another shard."""
    one = [unpack(x) for x in table.column("hashes").to_pylist()]
    two = np.concatenate([unpack(x) for x in table.column("more").to_pylist()])
    doc = np.concatenate([unpack(t)[unpack(w).astype(np.int64)].view(np.int64) for t, w in zip(table.column("docs").to_pylist(), table.column("doc_at").to_pylist())])
    flat = np.concatenate(one)
    order = np.lexsort((doc, two, flat))
    new = np.ones(len(flat), bool)
    new[1:] = (flat[order][1:] != flat[order][:-1]) | (two[order][1:] != two[order][:-1])
    least = doc[order][np.flatnonzero(new)][np.cumsum(new) - 1] if len(flat) else doc
    later = np.zeros(len(flat), bool)
    later[order] = doc[order] > least
    at = np.cumsum([0, *map(len, one)])
    return _answer(table, 2, [later[at[k] : at[k + 1]] for k in range(len(one))])


def _answer(table: pa.Table, kind: int, masks: list[np.ndarray]) -> pa.Table:
    rows = [(s, b, m) for s, b, m in zip(table.column("shard").to_pylist(), table.column("bucket").to_pylist(), masks) if m.any()]
    return pa.table({"shard": pa.array([r[0] for r in rows], pa.int64()), "kind": pa.array([kind] * len(rows), pa.int32()), "bucket": pa.array([r[1] for r in rows], pa.int32()), "mask": pa.array([pack_bits(r[2]) for r in rows], pa.binary())})


ANSWER = "shard long, kind int, bucket int, mask binary"


def remove_repeats(docs: DataFrame, width: int = 20) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) of every document; kept words are joined by one space."""
    if width <= PERIOD:
        raise ValueError(f"width must be over {PERIOD}")
    shards, buckets = shard_count(docs)
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)))
    by_shard = dealt.groupBy("shard")

    def anchors(key, table):
        s = Shard(table.select(["doc_id", "text"]), width)
        cuts = _cuts(s.hashes, FILTER_BITS, buckets)
        rows = [(b, pack(s.hashes[cuts[b] : cuts[b + 1]], True)) for b in range(buckets) if cuts[b] < cuts[b + 1]]
        return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int32()), "shard": pa.array([key[0].as_py()] * len(rows), pa.int64()), "hashes": pa.array([r[1] for r in rows], pa.binary())})

    def windows(key, table, flags):
        if not table.num_rows:
            return pa.table({n: pa.array([], t) for n, t in (("bucket", pa.int32()), ("shard", pa.int64()), ("hashes", pa.binary()), ("more", pa.binary()), ("docs", pa.binary()), ("doc_at", pa.binary()))})
        s = Shard(table.select(["doc_id", "text"]), width)
        s.windows(_masks(flags, 1, _cuts(s.hashes, FILTER_BITS, buckets)))
        cuts, rows = _cuts(s.one, 64, buckets), []
        for b in range(buckets):
            part = slice(cuts[b], cuts[b + 1])
            if part.start < part.stop:
                docs_here, doc_at = np.unique(s.first_doc[part], return_inverse=True)
                rows.append((b, pack(s.one[part], True), pack(s.two[part]), pack(docs_here.view(np.uint64), True), pack(doc_at)))
        return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int32()), "shard": pa.array([key[0].as_py()] * len(rows), pa.int64())} | {n: pa.array([r[k] for r in rows], pa.binary()) for k, n in enumerate(("hashes", "more", "docs", "doc_at"), 1)})

    def keep(key, table, flags):
        if not table.num_rows:
            return Shard(table.select(["doc_id", "text"]), width).kept(np.zeros(0, bool))
        s = Shard(table.select(["doc_id", "text"]), width)
        s.windows(_masks(flags, 1, _cuts(s.hashes, FILTER_BITS, buckets)))
        return s.kept(_masks(flags, 2, _cuts(s.one, 64, buckets)))

    shared = by_shard.applyInArrow(anchors, "bucket int, shard long, hashes binary").groupBy("bucket").applyInArrow(_shared, ANSWER)
    later = (
        by_shard.cogroup(shared.groupBy("shard"))
        .applyInArrow(windows, "bucket int, shard long, hashes binary, more binary, docs binary, doc_at binary")
        .groupBy("bucket")
        .applyInArrow(_first, ANSWER)
    )
    return by_shard.cogroup(shared.unionByName(later).groupBy("shard")).applyInArrow(keep, "doc_id long, n_words long, n_removed long, kept_text string")
