"""Quality scores by nearest-neighbour voting in a latent-semantic space.

A text's terms are its trigrams of character shapes (letters by case, digits,
white space, each punctuation mark), hashed to 1,024, and three events of word
repetition: a word equal to the one before, to the one before that, and a word
seen earlier in the text. Square roots of term shares, weighted by rarity in the
sample, are projected on the sample's leading singular directions.

The sample is the labelled rows with the least hash of doc_id, `sample` at most
(a documented parameter: the model is fitted on it, whatever the corpus size).
Their latent vectors, a megabyte, are broadcast; each document's cosines with
all of them are exact, computed in blocks, and its `neighbours` nearest, with all
that tie with the last of them, vote with weight cosine ** `sharpness`.

Learning uses no row that is held out (crc32(doc_id as text) mod 4 = 2), and a
score uses the text alone.

Defined cases: a null or empty text, like any without a neighbour of positive
cosine, scores the share of label 1 in the sample; without labelled rows every
score is 1; of several labels of a doc_id the largest counts, and of several
texts one; a null doc_id is not held out; labels other than 0 and 1 are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textkit import SPACE, Chunk, chunks, lean, small_batches

TERMS, EVENTS, KINDS = 1024, 3, 40
DIMENSIONS, SAMPLE, NEIGHBOURS, SHARPNESS, THRESHOLD = 48, 4096, 15, 8, 0.7
#: Rows of a block of cosines, and the difference within which cosines are ties.
BLOCK, TIE = 512, 1e-6


def _kinds() -> np.ndarray:
    """The shape of each byte; continuation bytes are left out before."""
    t = np.zeros(256, np.int64)
    t[0x80:] = 1
    t[ord("a") : ord("z") + 1] = 1
    t[ord("A") : ord("Z") + 1] = 2
    t[ord("0") : ord("9") + 1] = 3
    t[SPACE] = 4
    t[ord("\n")] = 5
    marks = [b for b in range(0x21, 0x7F) if not chr(b).isalnum()]
    t[marks] = 6 + np.arange(len(marks))
    return t


_KIND = _kinds()


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def term_shares(c: Chunk) -> np.ndarray:
    """Square roots of the shares of each term, one row for each document of the chunk."""
    n = c.last - c.first
    whole = (c.buf & 0xC0) != 0x80
    kind, doc = _KIND[c.buf[whole]], np.repeat(np.arange(n), c.lengths + 1)[whole]
    out = np.zeros((n, TERMS + EVENTS))
    if len(kind) > 2:
        code = (kind[:-2] * KINDS + kind[1:-1]) * KINDS + kind[2:]
        term = (code * 2654435761 & 0xFFFFFFFF) >> 22
        same = doc[:-2] == doc[2:]
        count = np.bincount(doc[:-2][same] * TERMS + term[same], minlength=n * TERMS).reshape(n, TERMS)
        out[:, :TERMS] = count / np.maximum(count.sum(axis=1, keepdims=True), 1)
    words, of = c.word_hashes(), c.doc_of_words()
    total = np.maximum(c.n_words, 1)
    for k in (1, 2):
        again = of[k:][(words[k:] == words[:-k]) & (of[k:] == of[:-k])]
        out[:, TERMS + k - 1] = np.bincount(again, minlength=n) / total
    order = np.lexsort((words, of))
    later = (words[order][1:] == words[order][:-1]) & (of[order][1:] == of[order][:-1])
    out[:, TERMS + 2] = np.bincount(of[order][1:][later], minlength=n) / total / 4
    return np.sqrt(out)


class Model:
    """Latent vectors of labelled texts."""

    def __init__(self, shares: np.ndarray, labels: np.ndarray, dimensions: int = DIMENSIONS):
        self.labels, self.prior = labels.astype(np.float64), float(labels.mean()) if len(labels) else 1.0
        self.weight = np.log1p(len(shares) / np.maximum((shares > 0).sum(axis=0), 1)) * ((shares > 0).sum(axis=0) > 0)
        x = shares * self.weight
        values, axes = np.linalg.eigh(x.T @ x)
        self.axes = axes[:, np.argsort(values)[::-1][:dimensions]].astype(np.float32)
        self.vectors = self.latent(shares)

    def latent(self, shares: np.ndarray) -> np.ndarray:
        v = (shares * self.weight).astype(np.float32) @ self.axes
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)

    def score(self, shares: np.ndarray, neighbours: int = NEIGHBOURS, sharpness: float = SHARPNESS) -> np.ndarray:
        if not len(self.labels):
            return np.ones(len(shares))
        each, k = [], min(neighbours, len(self.labels))
        for at in range(0, len(shares), BLOCK):
            cosine = self.latent(shares[at : at + BLOCK]) @ self.vectors.T
            least = np.partition(cosine, -k, axis=1)[:, -k]
            row, near = np.nonzero(cosine >= least[:, None] - TIE)
            vote = np.maximum(cosine[row, near], 0).astype(np.float64) ** sharpness
            total, good = (np.bincount(row, w, len(cosine)) for w in (vote, vote * self.labels[near]))
            each.append(np.where(total > 1e-9, good / np.maximum(total, 1e-9), self.prior).clip(0, 1))
        return np.concatenate(each) if each else np.zeros(0)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Model:
    """A model of the labelled texts that are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    @lean
    def describe(batches):
        for batch in batches:
            at = 0
            for c in chunks(batch.column("text")):
                rows = term_shares(c).astype(np.float32)
                part = batch.slice(at, len(rows))
                at += len(rows)
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "y": part.column("y"), "shares": pa.array([r.tobytes() for r in rows], pa.binary())})

    texts = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id")
    found = texts.mapInArrow(describe, "doc_id long, y int, shares binary").groupBy("doc_id").agg(F.max("y").alias("y"), F.min("shares").alias("shares"))
    rows = sorted(found.collect())  # `sample` rows at most
    return Model(np.array([np.frombuffer(r.shares, np.float32) for r in rows], np.float64).reshape(len(rows), TERMS + EVENTS), np.array([r.y for r in rows]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with a column score, 0 to 1: higher where label 1 is likelier."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    from pyspark.sql.types import DoubleType, StructField, StructType

    kept = [f for f in docs.schema.fields if f.name != "score"]

    @lean
    def run(batches):
        for batch in batches:
            at = 0
            for c in chunks(batch.column("text")):
                scores = shared.value.score(term_shares(c))
                part = batch.slice(at, len(scores))
                at += len(scores)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], [*part.schema.names, "score"])

    return small_batches(docs).select(*(F.col(f"`{f.name}`") for f in kept)).mapInArrow(run, StructType([*kept, StructField("score", DoubleType())]))
