"""Language-model scores by masked pseudo-likelihood.

Every token is predicted from the two tokens on either side by a small network
(embeddings of the four neighbours, one hidden layer, a two-level softmax); a
document's score is the sum of the log-probabilities. Words are runs without
white space, lower case for A-Z. The commonest words of the whole corpus are
symbols of their own; all others are dealt to bucket symbols by hash, and such a
word's log-probability also has that of one word among the bucket's distinct
ones, counted over the whole corpus.

The network is trained in numpy on the windows of all positions. Texts are dealt
by hash into shards of SHARD_BYTES on average; each shard is one pass from the
same start, over its texts in the order of doc_id and text, in steps of STEP
windows. The shards' parameters are averaged, weighted by windows, in groups in
the order of shards until one is left. So what is gathered grows with the
corpus, nothing is gathered in one place but parameters of fixed size, and the
model does not depend on how the table is partitioned, ordered or batched.

Defined cases: a null or empty text has no tokens, score 0 and a null mean;
places beyond a text's ends are a symbol of their own; repeated rows and rows
with a null doc_id are scored and trained on as often as they occur; without any
word the network is the untrained one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import Chunk, chunks, lean, small_batches

COMMON, CLUSTERS, MEMBERS, WIDTH, GROUP = 1024, 32, 64, 16, 32
SHARD_BYTES, STEP = 16 << 20, 1 << 16
SYMBOLS = CLUSTERS * MEMBERS
BUCKETS = SYMBOLS - COMMON
EDGE = SYMBOLS
SIDES = (-2, -1, 1, 2)


class Network:
    """Parameters, as one flat array, and what they compute."""

    def __init__(self, flat: np.ndarray | None = None):
        shapes = [(len(SIDES), SYMBOLS + 1, WIDTH), (WIDTH,), (WIDTH, CLUSTERS), (CLUSTERS,), (CLUSTERS, WIDTH, MEMBERS), (CLUSTERS, MEMBERS)]
        sizes = [int(np.prod(s)) for s in shapes]
        if flat is None:
            flat = np.random.default_rng(3).normal(0, 0.1, sum(sizes)).astype(np.float32)
        self.flat = flat.copy()
        ends = np.cumsum(sizes)
        self.embed, self.bias, self.top, self.top_bias, self.low, self.low_bias = (self.flat[e - n : e].reshape(s) for e, n, s in zip(ends, sizes, shapes))

    def hidden(self, near: np.ndarray) -> np.ndarray:
        """near: the symbols on each side, one row for each token."""
        return np.tanh(sum(self.embed[k].take(near[:, k], axis=0) for k in range(len(SIDES))) + self.bias)

    def log_probability(self, near: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        h, cluster, member = self.hidden(near), symbol // MEMBERS, symbol % MEMBERS
        out = _log_softmax(h @ self.top + self.top_bias, cluster)
        order = np.argsort(cluster, kind="stable")
        ends = np.searchsorted(cluster[order], np.arange(CLUSTERS + 1))
        for c in range(CLUSTERS):
            part = order[ends[c] : ends[c + 1]]
            if len(part):
                out[part] += _log_softmax(h[part] @ self.low[c] + self.low_bias[c], member[part])
        return out

    def train(self, near: np.ndarray, symbol: np.ndarray, rate: float = 0.2, size: int = 1024) -> None:
        """One pass of gradient steps."""
        order = np.random.default_rng(len(symbol)).permutation(len(symbol))
        sides = np.arange(len(SIDES)) * (SYMBOLS + 1)
        embed = self.embed.reshape(-1, WIDTH)
        for at in range(0, len(order), size):
            pick = order[at : at + size]
            pick = pick[np.argsort((symbol[pick] // MEMBERS).astype(np.int16), kind="stable")]
            n, s = near[pick], symbol[pick]
            h, cluster, member = self.hidden(n), s // MEMBERS, s % MEMBERS
            each = np.arange(len(s))
            d_top = -_softmax(h @ self.top + self.top_bias)
            d_top[each, cluster] += 1
            # rows of one cluster stand together
            first = np.flatnonzero(np.diff(cluster, prepend=-1))
            groups = [(c, slice(x, y)) for c, x, y in zip(cluster[first].tolist(), first.tolist(), [*first[1:].tolist(), len(s)])]
            d_low, below = np.empty((len(s), MEMBERS), np.float32), np.empty_like(h)
            for c, rows in groups:
                np.matmul(h[rows], self.low[c], out=d_low[rows])
            d_low = -_softmax(d_low + self.low_bias[cluster])
            d_low[each, member] += 1
            step = np.float32(rate / max(len(s), 1) ** 0.5)
            turned = (step * h).T
            for c, rows in groups:
                low, d = self.low[c], d_low[rows]
                np.matmul(d, low.T, out=below[rows])
                low += turned[:, rows] @ d
            d_h = d_top @ self.top.T + below
            self.low_bias[cluster[first]] += step * np.add.reduceat(d_low, first)
            d_h *= 1 - h**2
            self.top += step * (h.T @ d_top)
            self.top_bias += step * d_top.sum(axis=0)
            place = (n + sides).ravel()
            by = np.argsort(place.astype(np.int16), kind="stable")
            place = place[by]
            first = np.flatnonzero(np.diff(place, prepend=-1))
            embed[place[first]] += step * np.add.reduceat(d_h.take(by // len(SIDES), axis=0), first)
            self.bias += step * d_h.sum(axis=0)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = x - x.max(axis=1, keepdims=True)
    np.exp(e, out=e)
    e /= e.sum(axis=1, keepdims=True)
    return e


def _log_softmax(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    top = x.max(axis=1)
    return (x[np.arange(len(x)), at] - top - np.log(np.exp(x - top[:, None]).sum(axis=1))).astype(np.float64)


class Vocabulary:
    """Hash to symbol, and the log-probability of a word within its symbol."""

    def __init__(self, common: np.ndarray, distinct: np.ndarray):
        self.common = np.sort(common)
        self.within = np.concatenate([np.zeros(COMMON), -np.log(np.maximum(distinct, 1))])

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        out = COMMON + (hashes % np.uint64(BUCKETS)).astype(np.int64)
        if len(self.common):
            at = np.minimum(np.searchsorted(self.common, hashes), len(self.common) - 1)
            own = self.common[at] == hashes
            out[own] = at[own]
        return out


def windows(c: Chunk, symbols: np.ndarray) -> np.ndarray:
    """The neighbours of each word of the chunk."""
    doc = c.doc_of_words()
    out = np.full((len(symbols), len(SIDES)), EDGE)
    for k, s in enumerate(SIDES):
        a, b = (slice(-s, None), slice(None, s)) if s < 0 else (slice(None, -s), slice(s, None))
        if len(symbols) > abs(s):
            out[a, k] = np.where(doc[a] == doc[b], symbols[b], EDGE)
    return out


@lean
def _counts(batches):
    for batch in batches:
        hashes = [c.word_hashes() for c in chunks(batch.column("text"), lower=True)]
        word, n = np.unique(np.concatenate(hashes or [np.zeros(0, np.uint64)]), return_counts=True)
        yield pa.RecordBatch.from_pydict({"word": pa.array(word.view(np.int64)), "n": pa.array(n, pa.int64())})


def vocabulary(docs: DataFrame) -> tuple[Vocabulary, DataFrame]:
    """Symbols from the counts of all words, and those counts."""
    from .blobs import written

    counts = written(small_batches(docs).select("text").mapInArrow(_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))
    common = [r.word for r in counts.orderBy(F.desc("n"), "word").limit(COMMON).collect()]
    top = np.array(common, np.int64).view(np.uint64)
    # bucket numbers as unsigned remainders: the buckets are a power of two
    rest = counts.groupBy(F.col("word").bitwiseAND(F.lit(BUCKETS - 1)).alias("b")).agg(F.count("*").alias("n")).collect()
    distinct = np.zeros(BUCKETS)
    for r in rest:
        distinct[r.b] = r.n
    np.subtract.at(distinct, (top % np.uint64(BUCKETS)).astype(np.int64), 1)
    return Vocabulary(top, distinct), counts


class _Passes:
    """Networks of the shards that go by, each trained in steps of a fixed number of windows."""

    def __init__(self, step: int):
        self.step, self.shard, self.net, self.seen, self.near, self.symbol = step, None, None, 0, [], []

    def feed(self, shard: int, near: np.ndarray, symbol: np.ndarray) -> Iterator[pa.RecordBatch]:
        if shard != self.shard:
            yield from self.end()
            self.shard, self.net, self.seen = shard, Network(), 0
        self.near.append(near)
        self.symbol.append(symbol)
        if sum(map(len, self.symbol)) >= self.step:
            self._train(whole=False)

    def _train(self, whole: bool) -> None:
        near, symbol = np.concatenate(self.near), np.concatenate(self.symbol)
        ends = range(self.step, len(symbol) + 1, self.step)
        for at in [*ends, *([len(symbol)] if whole and len(symbol) % self.step else [])]:
            first = (at - 1) // self.step * self.step
            self.net.train(near[first:at], symbol[first:at])
            self.seen += at - first
        rest = len(symbol) if whole else len(symbol) // self.step * self.step
        self.near, self.symbol = [near[rest:]], [symbol[rest:]]

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.net is not None:
            self._train(whole=True)
            if self.seen:
                yield pa.RecordBatch.from_pydict({"shard": pa.array([self.shard], pa.int64()), "seen": pa.array([self.seen], pa.int64()), "flat": pa.array([self.net.flat.tobytes()], pa.binary())})
            self.net = None


def _mean(table: pa.Table) -> pa.Table:
    table = table.sort_by("shard")
    seen = np.array(table.column("seen").to_pylist(), np.float64)
    mean = sum(np.frombuffer(f, np.float32) * (n / seen.sum()) for f, n in zip(table.column("flat").to_pylist(), seen))
    return pa.table({"shard": pa.array([table.column("shard")[0].as_py() // GROUP], pa.int64()), "seen": pa.array([int(seen.sum())], pa.int64()), "flat": pa.array([mean.astype(np.float32).tobytes()], pa.binary())})


def fit(docs: DataFrame, shard_bytes: int = SHARD_BYTES, step: int = STEP) -> tuple[Network, Vocabulary]:
    """The network and the symbols, from every window of every text."""
    from .blobs import Tables

    tables, (words, _) = Tables(), vocabulary(docs)
    shared = docs.sparkSession.sparkContext.broadcast(words)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.length("text") > 0)
    dealt = texts.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(size // shard_bytes + 1)))

    @lean
    def train(batches):
        passes = _Passes(step)
        for batch in batches:
            of = batch.column("shard").to_numpy()
            for c in chunks(batch.column("text"), lower=True):
                symbol = shared.value.symbols(c.word_hashes())
                near, shard = windows(c, symbol), np.repeat(of[c.first : c.last], c.n_words)
                ends = np.append(np.flatnonzero(np.diff(shard)) + 1, len(shard)) if len(shard) else []
                for first, last in zip([0, *ends], ends):
                    yield from passes.feed(int(shard[first]), near[first:last], symbol[first:last])
        yield from passes.end()

    form = "shard long, seen long, flat binary"
    ordered = small_batches(dealt).repartition("shard").sortWithinPartitions("shard", "doc_id", "text").select("shard", "text")
    parts = tables.write(ordered.mapInArrow(train, form))
    while parts.count() > 1:
        parts = tables.write(parts.groupBy(F.expr(f"shard DIV {GROUP}")).applyInArrow(_mean, form))
    found = parts.head()
    tables.drop()
    return Network(np.frombuffer(found.flat, np.float32) if found else None), words


def score(docs: DataFrame, network: Network, words: Vocabulary) -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, mean): the summed conditional log-probabilities."""
    shared = docs.sparkSession.sparkContext.broadcast((network.flat, words))

    @lean
    def run(batches):
        flat, vocab = shared.value
        net = Network(flat)
        for batch in batches:
            at = 0
            for c in chunks(batch.column("text"), lower=True, limit=1 << 18):
                s = vocab.symbols(c.word_hashes())
                each = net.log_probability(windows(c, s), s) + vocab.within[s] if len(s) else np.zeros(0)
                total = np.bincount(c.doc_of_words(), weights=each, minlength=c.last - c.first)
                ids = batch.column("doc_id").slice(at, c.last - c.first)
                at += c.last - c.first
                mean = pa.array(total / np.maximum(c.n_words, 1), pa.float64(), mask=c.n_words == 0)
                yield pa.RecordBatch.from_pydict({"doc_id": ids, "n_tokens": pa.array(c.n_words, pa.int64()), "log_likelihood": pa.array(total), "mean": mean})

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, log_likelihood double, mean double")
