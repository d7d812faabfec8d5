"""Near-duplicate groups by a signature-coordinate inverted join.

A document is the set of its distinct 5-word shingles; two documents link when
their sets' Jaccard similarity is 0.75 or more, confirmed on the full sets.

* Documents with equal sets are one class from the start; only one set for each
  class goes on.
* A signature has 240 min-hash values. Three of the first 144 make a
  coordinate, 48 in all, so that a coordinate's list holds pairs of similarity s
  with chance s^3 and a passage that many texts share does not fill it with
  unrelated ones. Each class is posted under its coordinate-value pairs. Pairs
  that link share at least 4 of 48 coordinates but for a chance of 3e-8, so the
  first 45 are the whole prefix to post: a pair with 4 in common has one among
  them.
* First each class is paired with one hub, the least member of the lists that
  they share most, and tested on the full sets; links give components.
* Lists whose members are then of one component are skipped. In the others the
  collisions of pairs across components are counted. A pair is retained at 4
  collisions and the match threshold, 143 of the 240 values (a chance of 2e-8 to
  lose a pair of similarity 0.75), if the set sizes allow the similarity. A
  list gives its retained pairs as a forest, one pair fewer than it has members
  at most, so the parts that hold together by retained pairs are known without
  a table of pairs.
* Each part is sent, once, with its members' full sets to one task, or to
  one for each two blocks of a large part, and every retained pair in it that
  could still join two components is tested there on the full sets; the links
  found come out as a forest again. No pair is dropped and none is listed twice.

Shingles are compared as 64-bit hashes of their words, which mix every eight
bytes.

Defined cases: a null or empty text has no shingle and is its own component;
fewer words than 5 are one shingle; rows that share a doc_id are one node, which
links with whatever any of its rows links with; a null doc_id has a null component, is kept
and links with nothing; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blobs import Tables, written
from .components import components
from .textkit import Chunk, chunks, lean, mix, small_batches

WORDS, VALUES, FOLD, COORDINATES, SHARED, ALIKE = 5, 240, 3, 48, 4, 143
PREFIX = COORDINATES - SHARED + 1
#: Members and bytes of a block, and how many blocks a group has before they grow to the full bytes.
BLOCK, BLOCK_BYTES, BLOCKS = 512, 64 << 20, 32
TESTED = 1 << 22
PAIRS = "a long, b long"
_RANDOM = np.random.default_rng(7)
_A = _RANDOM.integers(0, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RANDOM.integers(0, 1 << 63, VALUES, dtype=np.uint64)


def shingle_sets(c: Chunk, width: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, sizes): the sorted distinct shingle hashes of each of the chunk's documents, end to end."""
    words, n = c.word_hashes(), c.n_words
    each, doc = [], []
    left = np.repeat(c.word_doc_end, n) - np.arange(len(words))
    of = c.doc_of_words()
    at = np.flatnonzero(left >= width)
    if len(at):
        each.append(c.window_hashes(words, width)[at])
        doc.append(of[at])
    for short in range(1, width):
        some = np.flatnonzero(n == short)
        if len(some):
            each.append(c.window_hashes(words, short, seed=short)[c.word_doc_start[some]])
            doc.append(some)
    if not each:
        return np.zeros(0, np.uint64), np.zeros(len(n), np.int64)
    h, d = np.concatenate(each), np.concatenate(doc)
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return h[new], np.bincount(d[new], minlength=len(n))


def set_hashes(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each set, 0 for an empty one."""
    filled = sizes > 0
    starts = (np.cumsum(sizes) - sizes)[filled]
    one, two = np.zeros(len(sizes), np.uint64), np.zeros(len(sizes), np.uint64)
    if len(starts):
        one[filled] = np.add.reduceat(mix(hashes ^ np.uint64(0x1234567)), starts)
        two[filled] = np.add.reduceat(mix(hashes + np.uint64(0x7654321)), starts)
    return one, two


def signatures(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The low 16 bits of VALUES minima for each non-empty set."""
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    out = np.zeros((len(starts), VALUES), np.uint16)
    if len(starts):
        for k in range(VALUES):
            out[:, k] = np.minimum.reduceat(hashes * _A[k] + _B[k], starts).astype(np.uint16)
    return out


def coordinates(sig: np.ndarray) -> np.ndarray:
    """Keys (coordinate number and folded value) of each signature's coordinates."""
    parts = sig[:, : COORDINATES * FOLD].reshape(len(sig), COORDINATES, FOLD).astype(np.uint64)
    folded = mix((parts[:, :, 0] << np.uint64(32)) | (parts[:, :, 1] << np.uint64(16)) | parts[:, :, 2]) >> np.uint64(8)
    return (folded | (np.arange(COORDINATES, dtype=np.uint64) << np.uint64(56))).view(np.int64)


@lean
def _describe(batches):
    for batch in batches:
        at = 0
        for c in chunks(batch.column("text"), lower=True):
            hashes, sizes = shingle_sets(c)
            filled = sizes > 0
            sig = signatures(hashes, sizes)
            one, two = set_hashes(hashes, sizes)
            blobs: list = [None] * len(sizes)
            for k, s in zip(np.flatnonzero(filled), sig):
                blobs[k] = s.tobytes()
            ids = batch.column("doc_id").slice(at, len(sizes))
            at += len(sizes)
            yield pa.RecordBatch.from_pydict({"doc_id": ids, "n_shingles": pa.array(sizes, pa.int64()), "s1": pa.array(one.view(np.int64)), "s2": pa.array(two.view(np.int64)), "sig": pa.array(blobs, pa.binary())})


@lean
def _post(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            keys = coordinates(_sigs(part.column("sig")))[:, :PREFIX]
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys.ravel()), "rep": pa.array(np.repeat(part.column("rep").to_numpy(), PREFIX))})


def _sigs(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, VALUES)


@lean
def _sets(batches):
    for batch in batches:
        at = 0
        for c in chunks(batch.column("text"), lower=True):
            hashes, sizes = shingle_sets(c)
            ends, (one, two) = np.cumsum(sizes), set_hashes(hashes, sizes)
            ids = batch.column("doc_id").slice(at, len(sizes))
            at += len(sizes)
            yield pa.RecordBatch.from_pydict({"doc_id": ids, "s1": pa.array(one.view(np.int64)), "s2": pa.array(two.view(np.int64)), "found": pa.array([hashes[e - n : e].tobytes() for e, n in zip(ends, sizes)], pa.binary())})


@lean
def _linked(batches):
    for batch in batches:
        ok = []
        for x, y in zip(batch.column("set_a"), batch.column("set_b")):
            a, b = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
            both = len(a) + len(b) - len(np.union1d(a, b))
            ok.append(100 * both >= 75 * (len(a) + len(b) - both))
        yield pa.RecordBatch.from_pydict({"a": batch.column("a").filter(pa.array(ok, pa.bool_())), "b": batch.column("b").filter(pa.array(ok, pa.bool_()))})


class _Group:
    """Members of a list or a part, or of two of its blocks: left ones meet each other, or the right ones if there are any."""

    def __init__(self, left: pa.Table, right: pa.Table | None):
        table = left if right is None else pa.concat_tables([left, right])
        self.rep, self.comp, self.size = (table.column(c).to_numpy() for c in ("rep", "comp", "size"))
        self.sig, self.table = _sigs(table.column("sig")), table
        self.keys = coordinates(self.sig)
        self.split = len(left) if right is not None else None

    def retained(self, k: int, part: np.ndarray) -> np.ndarray:
        """The members that k meets, at another place of part, and that pass the counts."""
        some = np.arange(k + 1 if self.split is None else self.split, len(self.rep))
        n = self.size[k]
        some = some[(part[some] != part[k]) & (self.comp[some] != self.comp[k]) & (4 * np.minimum(self.size[some], n) >= 3 * np.maximum(self.size[some], n))]
        some = some[(self.keys[some] == self.keys[k]).sum(axis=1) >= SHARED]
        return some[(self.sig[some] == self.sig[k]).sum(axis=1) >= ALIKE]

    def forest(self, part: np.ndarray, of: callable) -> pa.Table:
        """The pairs of (k, what of gives for it) that join two numbers of part."""
        a, b = [], []
        for k in range(len(self.rep) if self.split is None else self.split):
            for j in of(k, part):
                if part[j] != part[k]:
                    a.append(self.rep[k]), b.append(self.rep[j])
                    part[part == part[j]] = part[k]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _list_forest(key, left, right=None):
    """Retained pairs that first meet in this list, as a forest."""
    group, here = _Group(left, right), int(np.int64(key[0].as_py()).view(np.uint64) >> np.uint64(56))

    def met(k, part):
        some = group.retained(k, part)
        return some[(group.keys[some, :PREFIX] == group.keys[k, :PREFIX]).argmax(axis=1) == here]

    return group.forest(np.arange(len(group.rep)), met)


def _part_forest(key, left, right=None):
    """Links between the components of a part, tested on the full sets, as a forest."""
    group = _Group(left, right)
    if not len(group.rep):
        return group.forest(group.comp, lambda k, part: ())
    ends = np.cumsum(group.size)
    all_ = np.frombuffer(b"".join(group.table.column("found").to_pylist()), np.uint64)
    distinct, code = np.unique(all_, return_inverse=True)
    marked = np.zeros(len(distinct), bool)

    def linked(k, part):
        own = code[ends[k] - group.size[k] : ends[k]]
        marked[own] = True
        some = group.retained(k, part)
        for now in np.split(some, np.flatnonzero(np.diff(np.cumsum(group.size[some]) // TESTED)) + 1) if len(some) else ():
            size = group.size[now]
            first = np.cumsum(size) - size
            at = np.repeat(ends[now] - size - first, size) + np.arange(size.sum())
            both = np.add.reduceat(marked[code[at]], first, dtype=np.int64)
            yield from now[100 * both >= 75 * (size + group.size[k] - both)]
        marked[own] = False

    return group.forest(np.unique(group.comp, return_inverse=True)[1], linked)


def _by_blocks(rows: DataFrame, key: str, held: list[str], forest: callable, tables: Tables) -> DataFrame:
    """forest over each key's rows, or over each two blocks of them where they are many. rows: key, n and bytes of the key, rep and held."""
    blocks = F.greatest(F.least(F.ceil(F.col("n") / BLOCK), F.lit(BLOCKS)), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
    at = rows.withColumn("blocks", blocks)
    pairs = at.where("blocks = 1").select(key, *held).groupBy(key).applyInArrow(lambda key, table: forest(key, table), PAIRS)
    long = at.where("blocks > 1")
    if long.limit(1).count():
        long = tables.write(long.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")))
        each = long.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        ends = [F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q")]
        inside, low, high = (each.where(f"block {sign} other").select(key, *ends, *held) for sign in "=<>")
        high = high.toDF(*(f"{c}_" for c in high.columns)).toDF(*high.columns)  # columns of its own, for the cogroup
        pairs = pairs.unionByName(inside.groupBy(key, "p", "q").applyInArrow(lambda key, table: forest(key, table), PAIRS))
        pairs = pairs.unionByName(low.groupBy(key, "p", "q").cogroup(high.groupBy(key, "p", "q")).applyInArrow(lambda key, left, right: forest(key, left, right), PAIRS))
    return pairs


@lean
def _alike(batches):
    for batch in batches:
        if batch.num_rows:
            size_a, size_b = (batch.column(c).to_numpy() for c in ("size_a", "size_b"))
            same = (_sigs(batch.column("sig_a")) == _sigs(batch.column("sig_b"))).sum(axis=1) >= ALIKE
            same = pa.array(same & (4 * np.minimum(size_a, size_b) >= 3 * np.maximum(size_a, size_b)))
            yield pa.RecordBatch.from_pydict({"a": batch.column("a").filter(same), "b": batch.column("b").filter(same)})


def _hub_pairs(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Each class with the hub of the lists that they share most, if they are alike."""
    hubs = members.where("rep != hub").groupBy("rep", "hub").count().groupBy("rep").agg(F.max(F.struct("count", -F.col("hub"))).alias("best"))
    pairs = hubs.select((-F.col("best.col2")).alias("a"), F.col("rep").alias("b"))
    for x in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("rep").alias(x), F.col("sig").alias(f"sig_{x}"), F.col("size").alias(f"size_{x}")), x)
    return pairs.mapInArrow(_alike, PAIRS)


def _full_sets(texts: DataFrame, classes: DataFrame, reps: DataFrame) -> DataFrame:
    """(rep, found): the sorted shingle hashes of the classes named in reps."""
    wanted = classes.join(reps, "rep").select("rep", F.col("least").alias("doc_id"), "s1", "s2")
    sets = texts.join(wanted.select("doc_id").distinct(), "doc_id").mapInArrow(_sets, "doc_id long, s1 long, s2 long, found binary").where(F.length("found") > 0)
    # rows that share a doc_id may be of several classes, and of one class repeatedly
    return sets.join(wanted, ["doc_id", "s1", "s2"]).groupBy("doc_id", "rep").agg(F.first("found").alias("found")).select("rep", "found")


def _part_rows(forest: DataFrame, classes: DataFrame, labels: DataFrame, sets: DataFrame, tables: Tables) -> DataFrame:
    """The members of each part with their components, signatures and full sets."""
    parts = tables.write(components(forest).select(F.col("node").alias("rep"), F.col("component").alias("part")))
    of = parts.join(classes.select("rep", "sig", "size"), "rep").join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left")
    sized = of.groupBy("part").agg(F.count("*").alias("n"), (8 * F.sum("size")).alias("bytes"))
    return of.join(sized, "part").join(sets, "rep").select("part", "n", "bytes", "rep", F.coalesce("component", "rep").alias("comp"), "sig", "size", "found")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    texts, tables = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text"), Tables()
    all_docs = written(texts.mapInArrow(_describe, "doc_id long, n_shingles long, s1 long, s2 long, sig binary"))
    filled = all_docs.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    described = filled.groupBy("s1", "s2").agg(F.first("sig").alias("sig"), F.first("n_shingles").alias("size"), F.min("doc_id").alias("least"))
    classes = written(described.withColumn("rep", F.monotonically_increasing_id()))
    posted = classes.select("rep", "sig").mapInArrow(_post, "key long, rep long")
    lists = posted.groupBy("key").agg(F.count("*").alias("n"), F.min("rep").alias("hub")).where("n > 1")
    members = tables.write(posted.join(lists, "key"))
    # classes that a repeated doc_id joins, and those that link with their hubs
    ids = tables.write(filled.join(classes.select("s1", "s2", "rep"), ["s1", "s2"]).select("doc_id", "rep").distinct())
    several = ids.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("last")).where("a != last").select("doc_id", "a")
    own = ids.join(several, "doc_id").where("rep != a").select("a", F.col("rep").alias("b"))
    hub_pairs = tables.write(_hub_pairs(members, classes))
    hub_sets = tables.write(_full_sets(texts, classes, hub_pairs.select(F.col("a").alias("rep")).union(hub_pairs.select("b")).distinct()))
    for x in ("a", "b"):
        hub_pairs = hub_pairs.join(hub_sets.select(F.col("rep").alias(x), F.col("found").alias(f"set_{x}")), x)
    links = tables.write(hub_pairs.mapInArrow(_linked, PAIRS).union(own.select("a", "b")))
    labels = components(links)
    # lists that still hold several components
    of = members.join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left").select("key", "n", "rep", F.coalesce("component", "rep").alias("comp"))
    mixed = of.groupBy("key").agg(F.min("comp").alias("first"), F.max("comp").alias("last")).where("first != last").select("key")
    rows = of.join(mixed, "key").join(classes.select("rep", "sig", "size"), "rep").withColumn("bytes", F.col("n") * 2 * VALUES)
    forest = tables.write(_by_blocks(rows, "key", ["rep", "comp", "sig", "size"], _list_forest, tables))
    # the parts that retained pairs hold together, tested on the full sets
    known = hub_sets.select("rep").withColumn("known", F.lit(True))
    new = forest.select(F.col("a").alias("rep")).union(forest.select("b")).distinct().join(known, "rep", "left_anti")
    sets = hub_sets.unionByName(tables.write(_full_sets(texts, classes, new)))
    held = tables.write(_part_rows(forest, classes, labels, sets, tables))
    links = tables.write(links.unionByName(_by_blocks(held, "part", ["rep", "comp", "sig", "size", "found"], _part_forest, tables)))
    group = classes.join(components(links).withColumnRenamed("node", "rep"), "rep", "left").select("rep", "least", F.coalesce("component", "rep").alias("component"))
    named = group.join(group.groupBy("component").agg(F.min("least").alias("component_id")), "component")
    by_id = written(ids.join(named.select("rep", "component_id"), "rep").groupBy("doc_id").agg(F.min("component_id").alias("component_id")))
    tables.drop()
    out = all_docs.select("doc_id", "n_shingles").join(by_id, "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
