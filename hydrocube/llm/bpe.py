"""Byte-pair encoding and decoding with forced boundaries.

The vocabulary file is that of the tokenizers library: merges over byte-level
symbols whose last one in a word carries an end-of-word suffix. Two adjacent
symbols that stand side by side inside no vocabulary token can never be merged
across, so every such place is a certain cut: the fragments between cuts are
encoded alone and their ids laid end to end. White space is also such a cut,
since no word holds any; so a text's runs between white space are fragments
whose ids are kept in a bounded table from one text to the next.

Defined cases: a null text is encoded as an empty one (no ids); special tokens
written out in a text become their ids, as the library does; texts are encoded
whole, whatever their length. Other columns are ignored.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import lean, small_batches

#: Unicode's White_Space characters.
WHITE_SPACE = "".join(map(chr, (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: str.split() also parts words at these, which are no white space for the tokenizer.
ODD_SPACE = regex.compile("[\x1c-\x1f]")
#: Letters and numbers after Unicode 16, which are marks for the tokenizer, and its lower case of letters new in 16 and 17.
NEWER = "".join(f"{chr(a)}-{chr(b)}" for a, b in (
    (0x558, 0x558), (0x58b, 0x58c), (0x88f, 0x88f), (0xc5c, 0xc5c), (0xcdc, 0xcdc), (0x208f, 0x208f), (0x209d, 0x209f), (0xa7ce, 0xa7cf), (0xa7d2, 0xa7d2), (0xa7d4, 0xa7d4), (0xa7dd, 0xa7dd), (0xa7e2, 0xa7e2), (0xa7f1, 0xa7f1), (0xab6c, 0xab6d), (0x107bb, 0x107bf), (0x10940, 0x10959), (0x10ec5, 0x10ec7), (0x10ed9, 0x10eee), (0x11b0a, 0x11b0a), (0x11db0, 0x11ddb), (0x11de0, 0x11de9), (0x11df1, 0x11df1), (0x1246f, 0x1246f), (0x12475, 0x1247f), (0x12550, 0x12686), (0x16ea0, 0x16eb8), (0x16ebb, 0x16ed3), (0x16ff2, 0x16ff6), (0x187f8, 0x187ff), (0x18cd6, 0x18cda), (0x18d09, 0x18d20), (0x18d80, 0x18df2), (0x18e00, 0x19191), (0x191a0, 0x191d2), (0x1b123, 0x1b128), (0x1b168, 0x1b168), (0x1d6a6, 0x1d6a6), (0x1df1f, 0x1df24), (0x1df2b, 0x1df81), (0x1df90, 0x1df96), (0x1dfcd, 0x1dfff), (0x1e6c0, 0x1e6de), (0x1e6e0, 0x1e6e2), (0x1e6e4, 0x1e6e5), (0x1e6e7, 0x1e6ed), (0x1e6f0, 0x1e6f4), (0x1e6fe, 0x1e6ff), (0x2b73a, 0x2b73f), (0x2b81e, 0x2b81e), (0x2cea2, 0x2cead), (0x323b0, 0x33479), (0x3d000, 0x3fc3f),
))
LOWER_NEW = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B} | {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {0x3A3: 0x3C3}
LOWER_NEW |= {0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}
KEPT = 160_000
ROWS_OUT = 256


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else the next unused code point from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in out:
            out[b] = chr(spare)
            spare += 1
    return [out[b] for b in range(256)]


class Kept:
    """A bounded table: when its newer half is full it becomes the older half, and what is asked for again moves up."""

    def __init__(self, make, size: int = KEPT, longest: int = 60):
        self.make, self.size, self.longest, self.new, self.old = make, size, longest, {}, {}

    def get(self, key: str) -> bytes:
        found = self.new.get(key)
        if found is None:
            found = self.old.get(key)
            if found is None:
                found = self.make(key)
                if len(key) > self.longest:
                    return found
            if len(self.new) >= self.size:
                self.old, self.new = self.new, {}
            self.new[key] = found
        return found


class Encoder:
    """Encodes and decodes by one vocabulary file of the tokenizers library."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {m: k for k, m in enumerate(merges)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens: dict[int, str] = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.ascii_piece = regex.compile(split)
        for name in (r"\p{L}", r"\p{N}"):
            split = split.replace(name, f"[{name}--[{NEWER}]]")
        self.piece = regex.compile(split.replace(r"\s", WHITE_SPACE), regex.VERSION1)
        self.gap = regex.compile(f"[{WHITE_SPACE}]+")
        self.symbols = byte_symbols()
        self.joined = self._joined()
        self.words, self.pieces = Kept(self._word), Kept(self._piece)

    def _split(self, token: str) -> list[str]:
        """A token's symbols; the last one keeps the end-of-word suffix."""
        if self.suffix and token.endswith(self.suffix) and len(token) > len(self.suffix):
            body = list(token[: -len(self.suffix)])
            body[-1] += self.suffix
            return body
        return list(token)

    def _joined(self) -> set[tuple[str, str]]:
        """Symbol pairs that stand side by side inside some token: all others are certain cuts."""
        return {pair for t in self.vocab for s in [self._split(t)] for pair in zip(s, s[1:])}

    def fragments(self, symbols: list[str]) -> Iterator[list[str]]:
        joined, begin = self.joined, 0
        for k, pair in enumerate(zip(symbols, symbols[1:]), 1):
            if pair not in joined:
                yield symbols[begin:k]
                begin = k
        yield symbols[begin:] if begin else symbols

    def merged(self, parts: list[str]) -> list[str]:
        """The merges of one fragment: the best-ranked pair first, the leftmost among equals."""
        get, none = self.rank.get, len(self.rank)
        ranks = [get(p, none) for p in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            k = ranks.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del ranks[k]
            if k:
                ranks[k - 1] = get((parts[k - 1], parts[k]), none)
            if k < len(ranks):
                ranks[k] = get((parts[k], parts[k + 1]), none)
        return parts

    def _piece(self, piece: str) -> bytes:
        """Ids of one piece of the pre-tokenizer, as little-endian 32-bit integers."""
        ids, symbols = array("I"), [self.symbols[b] for b in piece.encode()]
        symbols[-1] += self.suffix
        for part in self.fragments(symbols):
            ids.extend(self.vocab[t] for t in self.merged(part) if t in self.vocab)
        return ids.tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of a run without white space."""
        if word.isascii():
            text = word.lower()
            pieces = [text] if text.isalpha() else self.ascii_piece.findall(text)
        else:
            text = unicodedata.normalize("NFC", word).translate(LOWER_NEW).lower()
            pieces = self.piece.findall(text)
        return b"".join(map(self.pieces.get, pieces))

    def _run(self, text: str) -> list[bytes]:
        words = self.gap.split(text) if ODD_SPACE.search(text) else text.split()
        fresh = self.words.new
        return [fresh.get(w) or self.words.get(w) for w in words]

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.at_special is None or not any(s in text for s in self.special):
            return b"".join(self._run(text))
        out: list[bytes] = []
        for part in self.at_special.split(text):
            out += [self.special[part].to_bytes(4, "little")] if part in self.special else self._run(part)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The tokens of the ids, special ones too, joined by one space."""
        numbers = array("I")
        numbers.frombytes(ids)
        return " ".join(map(self.tokens.__getitem__, numbers))


_loaded: dict[int, Encoder] = {}


def _encoder(definition: str) -> Encoder:
    """One encoder for each worker process, whichever task it runs."""
    key = hash(definition)
    if key not in _loaded:
        _loaded[key] = Encoder(definition)
    return _loaded[key]


def encode(docs: DataFrame, vocabulary: str, with_text: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids[, decoded]): ids are little-endian 32-bit integers; decoded is their text again.

    vocabulary: the path of the definition file on the driver, of a few
    megabytes at any corpus size, which is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_text(encoding="utf-8"))

    @lean
    def run(batches):
        coder = _encoder(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(at, ROWS_OUT)
                ids = [coder.encode(t) for t in part.column("text").to_pylist()]
                out = {"doc_id": part.column("doc_id"), "n_tokens": pa.array([len(i) // 4 for i in ids], pa.int64()), "ids": pa.array(ids, pa.binary())}
                if with_text:
                    out["decoded"] = pa.array([coder.decode(i) for i in ids], pa.string())
                yield pa.RecordBatch.from_pydict(out)

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids binary" + ", decoded string" * with_text)


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """Adds decoded to rows that have ids; null ids decode to an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(Path(vocabulary).read_text(encoding="utf-8"))

    @lean
    def run(batches):
        coder = _encoder(shared.value)
        for batch in batches:
            texts = [coder.decode(i or b"") for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    from pyspark.sql.types import StringType, StructField, StructType

    kept = [f for f in encoded.schema.fields if f.name != "decoded"]
    return small_batches(encoded).select(*(f.name for f in kept)).mapInArrow(run, StructType([*kept, StructField("decoded", StringType())]))
