"""Toxicity grades by cumulative-link ordinal regression.

P(grade <= k) = logistic(threshold_k - weights . x): one weight vector shared by
all ordered thresholds, fitted here by gradient ascent. x marks which of the
selected words a text holds. Words are runs of letters and digits, lower case
for A-Z; those are selected whose presence tells the labels apart most (z-score
of the log-odds, 2 at least) in the sample, `sample` labelled rows at most (a documented
parameter), those with the least hash of doc_id and not held out.

Labels are binary, so grades are made from them: 0 for label 0; for label 1 the
third (1 to 3) of the toxic texts by how many words of toxic odds they hold.
The expected grade is the severity.

Defined cases: null and empty texts have no words, and the severity of the
intercepts alone; without labelled rows of both kinds every severity is 0; of
several labels of a doc_id the largest counts, and of several texts one; a null
doc_id is graded, not learned from; repeated rows each give a row; other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blobs import Tables
from .quality import held_out
from .textkit import Chunk, chunks, lean, small_batches

SAMPLE, WORDS, GRADES, LEAST = 8192, 1500, 3, 2.0

GAP = np.ones(256, bool)
GAP[0x80:] = False
GAP[ord("0") : ord("9") + 1] = GAP[ord("A") : ord("Z") + 1] = GAP[ord("a") : ord("z") + 1] = False


def distinct_words(c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(document, word hash) of each document's distinct words."""
    h, d = c.word_hashes(), c.doc_of_words()
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return d[new], h[new]


class Model:
    """Selected words, shared weights and ordered thresholds."""

    def __init__(self, words: np.ndarray, z: np.ndarray, rows: list[np.ndarray], labels: np.ndarray, rounds: int = 600):
        """words: sorted hashes, z: how toxic each is, rows: each text's places in words."""
        self.words, self.weights, self.cuts = words, np.zeros(len(words)), np.full(GRADES, 30.0)
        toxic = int(labels.sum())
        if not 0 < toxic < len(labels):
            return
        x = np.zeros((len(rows), len(words)), np.float32)
        x[np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate(rows)] = 1
        strong = x @ (z > 0).astype(np.float32)
        grade = np.zeros(len(rows), int)
        ranks = np.argsort(np.argsort(strong[labels == 1], kind="stable"), kind="stable")
        grade[labels == 1] = 1 + GRADES * ranks // toxic
        self._fit(x, grade, rounds)

    def _fit(self, x: np.ndarray, grade: np.ndarray, rounds: int, rate: float = 0.3, decay: float = 3e-4) -> None:
        n = len(x)
        w, base, steps = np.zeros(x.shape[1], np.float32), 0.0, np.zeros(GRADES - 1)
        memory = [np.full_like(w, 1e-8), 1e-8, np.full(GRADES - 1, 1e-8)]
        balance = np.where(grade > 0, (grade == 0).sum() / max((grade > 0).sum(), 1), 1.0) ** 0.5
        for _ in range(rounds):
            cuts = base + np.concatenate(([0], np.cumsum(np.exp(steps))))
            edge = 1 / (1 + np.exp(-(np.append(cuts, np.inf)[grade] - x @ w)))
            under = np.where(grade > 0, 1 / (1 + np.exp(-(cuts[np.maximum(grade - 1, 0)] - x @ w))), 0.0)
            top, low = edge * (1 - edge), under * (1 - under)
            p = np.maximum(edge - under, 1e-9)
            g_cut = np.zeros(GRADES)
            np.add.at(g_cut, np.minimum(grade, GRADES - 1), np.where(grade < GRADES, balance * top / p, 0))
            np.add.at(g_cut, np.maximum(grade - 1, 0), np.where(grade > 0, -balance * low / p, 0))
            g_w = -(x.T @ (balance * (top - low) / p).astype(np.float32)) / n - decay * w
            g_base = g_cut.sum() / n
            g_steps = np.exp(steps) * (np.cumsum(g_cut[::-1])[::-1][1:]) / n
            memory[0] += g_w**2
            memory[1] += g_base**2
            memory[2] += g_steps**2
            w += rate * g_w / np.sqrt(memory[0])
            base += rate * g_base / np.sqrt(memory[1])
            steps += rate * g_steps / np.sqrt(memory[2])
        self.weights, self.cuts = w.astype(float), base + np.concatenate(([0], np.cumsum(np.exp(steps))))

    def over(self, c: Chunk) -> np.ndarray:
        """P(grade >= k), k = 1 .. GRADES, for each document of the chunk."""
        score = np.zeros(c.last - c.first)
        if len(self.words):
            d, h = distinct_words(c)
            at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
            hit = self.words[at] == h
            score = np.bincount(d[hit], weights=self.weights[at[hit]], minlength=len(score))
        return 1 / (1 + np.exp(self.cuts[None, :] - score[:, None]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE, words: int = WORDS) -> Model:
    """A model of the labelled texts that are not held out. The driver gets `words` words, and of each sampled text its places among them."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    @lean
    def describe(batches):
        for batch in batches:
            at = 0
            for c in chunks(batch.column("text"), lower=True, gap=GAP):
                d, h = distinct_words(c)
                ends = np.searchsorted(d, np.arange(c.last - c.first + 1))
                part = batch.slice(at, c.last - c.first)
                at += part.num_rows
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "y": part.column("y"), "words": pa.array([h[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary())})

    def each(batches):
        for batch in batches:
            for y, held in zip(batch.column("y").to_pylist(), batch.column("words")):
                h = np.frombuffer(held.as_py(), np.int64)
                yield pa.RecordBatch.from_pydict({"y": pa.array(np.full(len(h), y), pa.int64()), "word": pa.array(h)})

    tables = Tables()
    texts = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id")
    described = tables.write(texts.mapInArrow(describe, "doc_id long, y int, words binary").groupBy("doc_id").agg(F.max("y").alias("y"), F.min("words").alias("words")))
    n = described.agg(F.count("*").alias("all"), F.coalesce(F.sum("y"), F.lit(0)).alias("toxic")).first()
    toxic, clean = n.toxic, n["all"] - n.toxic
    said = described.mapInArrow(each, "y long, word long").groupBy("word").agg(F.sum("y").alias("bad"), (F.count("*") - F.sum("y")).alias("good"))
    b, g = F.col("bad") + 0.5, F.col("good") + 0.5
    z = (F.log(b / (toxic + 1 - b)) - F.log(g / (clean + 1 - g))) / F.sqrt(1 / b + 1 / g)
    picked = said.withColumn("z", z).where((F.col("bad") + F.col("good") >= 3) & (F.abs("z") >= LEAST)).orderBy(F.desc(F.abs("z")), "word").limit(words).collect()
    found = sorted((int(np.int64(r.word).view(np.uint64)), r.z) for r in picked)
    names, odds = np.array([w for w, _ in found], np.uint64), np.array([x for _, x in found])

    def places(batches):
        for batch in batches:
            out = []
            for held in batch.column("words"):
                out.append(np.flatnonzero(np.isin(names, np.frombuffer(held.as_py(), np.uint64))).astype(np.uint16).tobytes())
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "y": batch.column("y"), "at": pa.array(out, pa.binary())})

    rows = sorted(described.mapInArrow(places, "doc_id long, y int, at binary").collect())  # `sample` rows of `words` places at most
    tables.drop()
    return Model(names, odds, [np.frombuffer(r.at, np.uint16) for r in rows], np.array([r.y for r in rows], int))


def grade(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, severity, grade, toxic): the expected grade, the likeliest one, and whether grade 0 is the less likely."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @lean
    def run(batches):
        for batch in batches:
            at = 0
            for c in chunks(batch.column("text"), lower=True, gap=GAP):
                over = shared.value.over(c)
                each = np.concatenate([np.ones((len(over), 1)), over], 1) - np.concatenate([over, np.zeros((len(over), 1))], 1)
                ids = batch.column("doc_id").slice(at, len(over))
                at += len(over)
                yield pa.RecordBatch.from_pydict({"doc_id": ids, "severity": pa.array(over.sum(axis=1)), "grade": pa.array(each.argmax(axis=1), pa.int32()), "toxic": pa.array(over[:, 0] >= 0.5)})

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, severity double, grade int, toxic boolean")
