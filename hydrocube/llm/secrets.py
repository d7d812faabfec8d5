"""Secret scans: fixed patterns, and spans tagged by a conditional random field.

Base spans follow fixed patterns (below), leftmost and non-overlapping for each
kind. The method adds spans of kind `crf`: runs of ASCII letters and digits are
tokens, tagged as secret begin (B), inside (I) or outside (O) by a linear-chain
conditional random field over token shape, the two words before and the three
behind, marks, and features of the file. Open tokens are those of eight or more
characters with a digit or with capitals inside, those of 24 or more, those
behind an assignment mark, and the three before and two behind a cue word. All
others are O by structure unless one mark joins them to an open token; as I may
only follow B or I, Viterbi decoding splits exactly at such tokens, so it runs
over the short chains in between and plain prose costs a few byte masks. The field is trained here, in numpy, on lines made by rule from a
fixed seed. Added spans never overlap base spans.

Defined cases: a null text is an empty one (no spans); texts are scanned whole;
offsets are code points, end exclusive; repeated rows each give a row; other
columns are kept, but for one named spans, which the new one replaces.
"""

from __future__ import annotations

import functools
import random
import re
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textkit import Chunk, chunks, lean, small_batches

#: Fixed patterns of the contract.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "crf")

_WORD, _DIGIT, _UPPER, _LOWER = (np.zeros(256, bool) for _ in range(4))
_DIGIT[ord("0") : ord("9") + 1] = True
_UPPER[ord("A") : ord("Z") + 1] = True
_LOWER[ord("a") : ord("z") + 1] = True
_WORD |= _DIGIT | _UPPER | _LOWER
_JOINT = frozenset(b"+/_.=-")
_CUES = ("password", "passwd", "pwd", "pass", "secret", "token", "key", "apikey", "auth", "bearer", "credential", "private", "access", "client")
_PLAIN = ("id", "order", "phone", "tel", "version", "isbn", "iban", "card", "http", "https", "www", "uuid", "date", "ref", "commit", "md5")
_ASSIGNED = re.compile(rb"""[:=]\x20*["']?(?=[A-Za-z0-9])""")
B, I, O = 0, 1, 2  # noqa: E741


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _cues(lower: bytes) -> list[tuple[int, int]]:
    """Bounds of the cue words that end a run of letters."""
    out = []
    for cue in (c.encode() for c in _CUES):
        at = lower.find(cue)
        while at >= 0:
            end = at + len(cue)
            if not _LOWER[lower[end]]:
                out.append((at, end))
            at = lower.find(cue, end)
    return out


class Tokens:
    """A chunk's letter and digit runs, and the chains of them to decode."""

    def __init__(self, c: Chunk):
        buf = c.buf
        edge = np.flatnonzero(np.diff(np.concatenate(([False], _WORD[buf], [False])).astype(np.int8)))
        self.start, self.end = edge[0::2], edge[1::2]
        sums = lambda mask: np.concatenate(([0], np.cumsum(mask[buf])))
        self.digits, self.uppers, self.lowers = ((s := sums(m))[self.end] - s[self.start] for m in (_DIGIT, _UPPER, _LOWER))
        size = self.end - self.start
        self.buf, self.raw = buf, buf.tobytes()
        mixed = (self.lowers > 0) & (self.uppers > _UPPER[buf[self.start]])
        self.open = (size >= 8) & ((self.digits > 0) | mixed) | (size >= 24)
        self.doc = np.searchsorted(c.starts, self.start, "right") - 1
        self.floor, self.stop = c.starts[self.doc], (c.starts + c.lengths)[self.doc]
        # runs of letters: how many begin before each token, and before its end
        letters = _UPPER[buf] | _LOWER[buf]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], letters, [False])).astype(np.int8)))
        self.word_start, self.word_end = edge[0::2], edge[1::2]
        self.words_before, self.words_within = (np.searchsorted(self.word_start, x) for x in (self.start, self.end))
        # what an assignment mark leads to, and three tokens before and two behind a cue word, in the same text
        for found, reach in (([m.span() for m in _ASSIGNED.finditer(self.raw)], range(1)), (_cues(self.raw.lower()), (-4, -3, -2, 0, 1))):
            bounds = np.array(found, np.int64).reshape(-1, 2)
            of, at = np.searchsorted(c.starts, bounds[:, 0], "right") - 1, np.searchsorted(self.start, bounds[:, 1])
            for k in reach:
                some = np.flatnonzero((at + k >= 0) & (at + k < len(size)))
                some = some[self.doc[at[some] + k] == of[some]]
                self.open[at[some] + k] = True
        digits, marks, stop = sums(_DIGIT), sums(~_WORD), c.starts + c.lengths
        self.file = np.stack([digits[stop] - digits[c.starts], marks[stop] - marks[c.starts]], 1) / np.maximum(c.lengths, 1)[:, None]

    def chains(self) -> list[list[int]]:
        """Token numbers of each chain: open tokens and what one joining mark ties to them."""
        out, seen, n = [], -1, len(self.start)
        tied = lambda k: k + 1 < n and self.start[k + 1] - self.end[k] == 1 and self.raw[self.end[k]] in _JOINT
        for k in np.flatnonzero(self.open):
            if k <= seen:
                continue
            first = last = int(k)
            while first > seen + 1 and tied(first - 1):
                first -= 1
            while tied(last):
                last += 1
            out.append(list(range(first, last + 1)))
            seen = last
        return out

    def word(self, k: int, n: int) -> str:
        """The n-th run of letters in lower case, or nothing outside token k's text."""
        if not 0 <= n < len(self.word_start) or self.word_start[n] < self.floor[k] or self.word_end[n] > self.stop[k]:
            return ""
        return self.raw[self.word_start[n] : self.word_end[n]].decode().lower()

    def features(self, k: int, first: bool) -> list[str]:
        s, e = int(self.start[k]), int(self.end[k])
        size, raw = e - s, self.raw
        digits, uppers, lowers = int(self.digits[k]), int(self.uppers[k]), int(self.lowers[k])
        body = raw[s:e]
        kinds = ("d" if digits else "") + ("u" if uppers else "") + ("l" if lowers else "")
        floor, at = int(self.floor[k]), int(self.words_before[k])
        words, behind = [self.word(k, at - 2), self.word(k, at - 1)], self.word(k, int(self.words_within[k]))
        behind = [behind, self.word(k, int(self.words_within[k]) + 1), self.word(k, int(self.words_within[k]) + 2)]
        turns = sum((_DIGIT[x] != _DIGIT[y]) or (_UPPER[x] != _UPPER[y]) for x, y in zip(body, body[1:]))
        f = ["bias", f"kinds={kinds}", f"size={min(size // 4, 12)}", f"digits={min(4 * digits // size, 3)}", f"turns={min(6 * turns // size, 5)}", f"kinds={kinds},size={min(size // 8, 6)}", f"varied={min(len(set(body)) // 4, 5)}"]
        # a text's first token is marked as one behind a space
        mark = raw[s - 1] if s > floor else 0x20
        f.append(f"mark={chr(mark) if mark < 128 else ''}")
        f.append(f"after={chr(raw[e]) if e < len(raw) and raw[e] < 128 else ''}")
        cue, plain = any(w.endswith(_CUES) for w in words), any(w in _PLAIN for w in words)
        f += [f"cue={cue}", f"plain={plain}", f"cue={cue},mark={f[-2][5:] in '=:'}", f"first={first}"]
        if digits and set(body) <= set(b"0123456789abcdefABCDEF"):
            f.append("hex")
        if body[:2] in (b"sk", b"pk", b"gh", b"ey", b"AK"):
            f.append(f"head={body[:2].decode()}")
        f += [f"cue behind={(told := any(w and w.endswith(_CUES) for w in behind))}", f"cue behind={told},size={min(size // 4, 4)}", f"plain behind={any(w in _PLAIN for w in behind)}"]
        d, m = self.file[self.doc[k]]
        return [*f, f"file digits={int(min(d * 20, 4))}", f"file marks={int(min(m * 10, 5))}"]


def _lines(count: int, rng: random.Random) -> list[tuple[str, list[tuple[int, int]]]]:
    """Lines made by rule, with the spans of their secrets."""
    alnum, out = string.ascii_letters + string.digits, []
    pick = lambda chars, low, high: "".join(rng.choices(chars, k=rng.randint(low, high)))
    short = lambda: rng.choice([pick("etaoinshrdlu", 1, 4) + pick("0123456789", 1, 3), pick("etaoin", 1, 2) + pick("0123456789", 1, 2) + pick("abc", 1, 2), pick("0123456789", 1, 6), pick(string.ascii_uppercase, 1, 3) + pick("0123456789", 1, 3)])
    words = lambda: " ".join(short() if rng.random() < 0.2 else pick("etaoinshrdlu", 2, 9) for _ in range(rng.randint(1, 8)))
    for _ in range(count):
        secret = rng.choice([pick("0123456789abcdef", 16, 20), pick(alnum, 16, 48), pick("0123456789abcdef", 24, 64), pick(alnum + "+/", 32, 60) + rng.choice(["", "="]), "AKIA" + pick(string.ascii_uppercase + string.digits, 16, 16), "ghp_" + pick(alnum, 36, 36), "sk-" + pick(alnum, 24, 48), "eyJ" + pick(alnum, 20, 30) + "." + pick(alnum, 20, 40), pick(alnum, 10, 16), pick(string.ascii_letters, 12, 23)])
        cue = rng.choice(["password", "secret", "api_key", "token", "Authorization: Bearer", "client_secret", "private_key", "AWS_SECRET_ACCESS_KEY", "pwd", "auth"])
        plain = rng.choice([pick("0123456789", 8, 16), f"version {rng.randint(1, 9)}.{rng.randint(0, 99)}.{pick('0123456789', 8, 10)}", f"https://example.com/{pick('etaoin', 4, 9)}/{pick('0123456789', 8, 10)}", f"order {pick('0123456789', 8, 12)}", f"{pick('etaoin', 4, 8)}{rng.randint(1, 9999)}@example.org", f"+{pick('0123456789', 11, 13)}", pick("etaoinshrdlu", 24, 36), f"DE{pick('0123456789', 20, 20)}", f"2024{pick('0123456789', 4, 4)}T{pick('0123456789', 6, 6)}", f"{pick('etaoinshr', 5, 9)}{rng.randint(10, 2030)}", f"{pick('etaoin', 5, 9)}_{rng.randint(100, 999)}-{pick('etaoinshr', 8, 12)}{rng.randint(1, 9)}", pick(string.ascii_uppercase, 24, 30), f"{rng.choice(_CUES)} {words()}", f"{rng.choice(_CUES)}: {words()}", f"{pick('etaoinshr', 3, 9)}: {words()}", f"{pick('etaoin', 3, 7)}{pick('etaoin', 4, 8).title()}{pick('etaoin', 3, 7).title()}"])
        kind, behind = rng.random(), rng.choice(["is the", "as the", "for the", "is my", "is our"])
        if kind < 0.05 and len(secret) > 11:
            head = f"{words()} " if rng.random() < 0.7 else ""
            text, spans = f"{head}{secret} {behind} {rng.choice(_CUES[:8])}", [(len(head), len(head) + len(secret))]
        elif kind > 0.95:
            text, spans = rng.choice([f"{words()} {pick('0123456789', 8, 16)} {behind} {rng.choice(_PLAIN)}", f"{words()} {short()} {behind} {rng.choice(_CUES[:8])}", f"{words()} {short()} {rng.choice(_CUES)} {words()}"]), []
        elif kind < 0.3:
            head = f"{words()} {cue}{rng.choice(['=', ': ', ' = ', '='])}{rng.choice(['', chr(34), chr(39)])}"
            text, spans = f"{head}{secret} {words()}", [(len(head), len(head) + len(secret))]
        elif kind < 0.5 and len(secret) > 17:
            head = words() + " "
            text, spans = f"{head}{secret} {words()}", [(len(head), len(head) + len(secret))]
        else:
            text, spans = f"{words()} {plain} {words()}", []
        out.append((text, spans))
    return out


class Field:
    """Weights of a linear-chain conditional random field over B, I and O."""

    def __init__(self, sequences: list[list[list[str]]], tags: list[list[int]], rounds: int = 250, rate: float = 0.5, decay: float = 1e-3):
        names = sorted({f for s in sequences for t in s for f in t})
        self.number = {f: k for k, f in enumerate(names)}
        self.emit, self.pass_ = np.zeros((len(names), 3)), np.zeros((3, 3))
        self.start = np.array([0.0, -1e9, 0.0])
        self.barred = np.zeros((3, 3))
        self.barred[O, I] = -1e9
        longest = max(map(len, sequences))
        n = len(sequences)
        x = np.zeros((n, longest, len(names)), np.float32)
        gold, real = np.full((n, longest), O), np.zeros((n, longest), bool)
        for a, (s, t) in enumerate(zip(sequences, tags)):
            real[a, : len(s)], gold[a, : len(s)] = True, t
            for b, f in enumerate(s):
                x[a, b, [self.number[k] for k in f]] = 1
        flat = x.reshape(-1, len(names))
        hot = np.eye(3)[gold] * real[..., None]
        hot_pairs = np.einsum("ntj,ntk->jk", hot[:, :-1] * real[:, 1:, None], hot[:, 1:])
        memory_e, memory_p = np.zeros_like(self.emit), np.zeros_like(self.pass_)
        for _ in range(rounds):
            node, pair = self._expected((flat @ self.emit.astype(np.float32)).reshape(n, longest, 3).astype(np.float64), real)
            grad_e = flat.T @ (hot - node).reshape(-1, 3).astype(np.float32) / n - decay * self.emit
            grad_p = (hot_pairs - pair) / n - decay * self.pass_
            memory_e += grad_e**2
            memory_p += grad_p**2
            self.emit += rate * grad_e / np.sqrt(memory_e + 1e-8)
            self.pass_ += rate * grad_p / np.sqrt(memory_p + 1e-8)

    def _expected(self, score: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected tags and tag pairs by the forward and backward sums."""
        n, longest, _ = score.shape
        move = self.pass_ + self.barred
        add = lambda a, axis: (m := a.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(np.exp(a - m).sum(axis=axis))
        front, back = np.zeros_like(score), np.zeros_like(score)
        front[:, 0] = self.start + score[:, 0]
        for t in range(1, longest):
            front[:, t] = np.where(real[:, t, None], add(front[:, t - 1, :, None] + move, 1) + score[:, t], front[:, t - 1])
        for t in range(longest - 2, -1, -1):
            back[:, t] = np.where(real[:, t + 1, None], add(move + (score[:, t + 1] + back[:, t + 1])[:, None, :], 2), 0)
        total = add(front[:, -1], 1)
        node = np.exp(front + back - total[:, None, None]) * real[..., None]
        pair = np.zeros((3, 3))
        for t in range(1, longest):
            joint = front[:, t - 1, :, None] + move + (score[:, t] + back[:, t])[:, None, :] - total[:, None, None]
            pair += (np.exp(joint) * real[:, t, None, None]).sum(axis=0)
        return node, pair

    def decode(self, features: list[list[str]]) -> list[int]:
        """The best tags (Viterbi)."""
        move, best, steps = self.pass_ + self.barred, None, []
        for f in features:
            score = self.emit[[self.number[k] for k in f if k in self.number]].sum(axis=0)
            if best is None:
                best = self.start + score
            else:
                paths = best[:, None] + move
                steps.append(paths.argmax(axis=0))
                best = paths.max(axis=0) + score
        tags = [int(best.argmax())]
        for step in reversed(steps):
            tags.append(int(step[tags[-1]]))
        return tags[::-1]


@functools.cache
def trained(lines: int = 2000, seed: int = 11) -> Field:
    """The field, fitted to lines made by rule; the same in every process."""
    made = _lines(lines, random.Random(seed))
    sequences, tags = [], []
    for c in chunks(pa.array([t for t, _ in made])):
        tokens = Tokens(c)
        for chain in tokens.chains():
            spans, at = made[c.first + tokens.doc[chain[0]]][1], c.starts[tokens.doc[chain[0]]]
            inside = [any(s <= tokens.start[k] - at < e for s, e in spans) for k in chain]
            sequences.append([tokens.features(k, j == 0) for j, k in enumerate(chain)])
            tags.append([O if not y else I if j and inside[j - 1] else B for j, y in enumerate(inside)])
    return Field(sequences, tags)


def tagged_spans(c: Chunk, field: Field) -> list[list[tuple[int, int]]]:
    """For each document of the chunk, the byte spans of its runs of B and I."""
    tokens, out = Tokens(c), [[] for _ in range(c.last - c.first)]
    for chain in tokens.chains():
        tags = field.decode([tokens.features(k, j == 0) for j, k in enumerate(chain)])
        begin = None
        for k, tag in zip([*chain, None], [*tags, O]):
            if begin is not None and tag != I:
                out[tokens.doc[begin]].append((int(tokens.start[begin] - c.starts[tokens.doc[begin]]), int(tokens.end[last] - c.starts[tokens.doc[begin]])))
                begin = None
            if tag == B:
                begin = k
            last = k
    return out


SPAN = "array<struct<kind:string,start:int,end:int>>"


def scan(docs: DataFrame) -> DataFrame:
    """docs with a column spans: (kind, start, end) by start, then kind as listed in KINDS."""
    from pyspark.sql.types import StructField, StructType, _parse_datatype_string

    kept = [f for f in docs.schema.fields if f.name != "spans"]
    shared = docs.sparkSession.sparkContext.broadcast(trained())
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    @lean
    def run(batches):
        field = shared.value
        for batch in batches:
            at = 0
            for c in chunks(batch.column("text")):
                part = batch.slice(at, c.last - c.first)
                at += part.num_rows
                added, rows = tagged_spans(c, field), []
                for text, more in zip(part.column("text").to_pylist(), added):
                    spans = base_spans(text or "")
                    if more:
                        data = text.encode()
                        plain = len(data) == len(text)
                        for s, e in more:
                            if not plain:
                                s, e = len(data[:s].decode()), len(data[:e].decode())
                            if not any(s < y and x < e for x, _, y in spans):
                                spans.append((s, 3, e))
                    rows.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(spans)])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(rows, arrow)], [*part.schema.names, "spans"])

    return small_batches(docs).select(*(F.col(f"`{f.name}`") for f in kept)).mapInArrow(run, StructType([*kept, StructField("spans", _parse_datatype_string(SPAN))]))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each run of overlapping spans replaced by the mark."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(a, s):
        fresh = s["start"] >= a["at"]
        head = F.concat(a["out"], F.substring(text, a["at"] + 1, F.greatest(s["start"] - a["at"], F.lit(0))), F.lit(mark))
        return F.struct(F.when(fresh, head).otherwise(a["out"]).alias("out"), F.greatest(a["at"], s["end"]).alias("at"))

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))).otherwise(text)
