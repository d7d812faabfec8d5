"""Token counts by greedy longest match, with a linear-time automaton.

The vocabulary is a trie. Each node has a failure link, the node to go on from
when no edge fits, and the number of tokens that taking it pops off the front
of what was read: both are worked out once, from the parents down. A text's
count is the sum of pops, so each character is read once and no piece is built.

Words are runs without white space, each with the vocabulary's mark of a word's
beginning in front; a word that the vocabulary cannot spell is one unknown
token. Word counts are kept in a bounded table from one text to the next.

Defined cases: null and empty texts have 0 tokens; texts are counted whole;
repeated rows and rows with a null doc_id each give a row; other columns are
ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_symbols

KEPT_WORDS = 300_000


class Automaton:
    """Longest-match counts over a set of tokens."""

    def __init__(self, tokens: Iterable[str]):
        self.edges: list[dict[str, int]] = [{}]
        final, parent = [False], [(-1, "")]
        for token in tokens:
            at = 0
            for c in token:
                nxt = self.edges[at].get(c)
                if nxt is None:
                    nxt = self.edges[at][c] = len(self.edges)
                    self.edges.append({})
                    final.append(False)
                    parent.append((at, c))
                at = nxt
            final[at] = bool(token)
        self.link, self.pops = [-1] * len(self.edges), [0] * len(self.edges)
        level = list(self.edges[0].values())
        while level:
            for v in level:
                if final[v]:
                    self.link[v], self.pops[v] = 0, 1
                    continue
                u, c = parent[v]
                z, popped = self.link[u], self.pops[u]
                while z >= 0 and c not in self.edges[z]:
                    popped += self.pops[z]
                    z = self.link[z]
                if z >= 0:
                    self.link[v], self.pops[v] = self.edges[z][c], popped
            level = [w for v in level for w in self.edges[v].values()]

    def count(self, word: str) -> int | None:
        """Tokens of the word, or None if it cannot be spelled."""
        edges, link, pops, at, total = self.edges, self.link, self.pops, 0, 0
        for c in word:
            while (nxt := edges[at].get(c)) is None:
                if link[at] < 0:
                    return None
                total += pops[at]
                at = link[at]
            at = nxt
        while at:
            if link[at] < 0:
                return None
            total += pops[at]
            at = link[at]
        return total


class Counter:
    """Counts texts by a byte-level vocabulary whose words begin with a mark."""

    def __init__(self, tokens: Iterable[str]):
        self.symbols = byte_symbols()
        self.start, self.automaton, self.known = self.symbols[0x20], Automaton(tokens), {}

    def word(self, word: str) -> int:
        n = self.automaton.count(self.start + "".join(self.symbols[b] for b in word.encode()))
        return 1 if n is None else n

    def text(self, text: str | None) -> int:
        known, total = self.known, 0
        if len(known) > KEPT_WORDS:
            known.clear()
        for w in (text or "").split():
            n = known.get(w)
            if n is None:
                n = known[w] = self.word(w)
            total += n
        return total


_made: dict[int, Counter] = {}


def count_tokens(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_tokens); vocabulary: the path on the driver of a JSON file with model.vocab, a few megabytes, broadcast."""
    tokens = sorted(json.loads(Path(vocabulary).read_text(encoding="utf-8"))["model"]["vocab"])
    shared, key = docs.sparkSession.sparkContext.broadcast(tokens), hash(tuple(tokens))

    def run(batches):
        for batch in batches:
            if key not in _made:
                _made[key] = Counter(shared.value)
            counts = [_made[key].text(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_tokens": pa.array(counts, pa.int64())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long")
