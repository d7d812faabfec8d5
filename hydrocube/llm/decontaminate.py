"""Benchmark decontamination: a prefix-filtered join of word windows, in DataFrame operations only.

An item's windows are its runs of `width` consecutive words; an item of fewer
words is one window. A window occurs in a document only if all its words do,
so one word of each window, its rarest, is the whole prefix that has to be
joined (overlap needed = window size, prefix length = 1). Rarity is how often the
word occurs in all documents, counted in a pass of its own, for the items' words
only; ties go by length, longer first, then by the word. The documents' words stream once past a broadcast table of the prefix words; a
match gives the window's place by the word's offset, the bounds 0 <= start and
start + size <= n_words prune, and the words themselves are then compared.

The broadcast side is bounded: a benchmark of more than `broadcast_bytes` of
text is dealt by window hash into as many parts as keep each within the bound,
and the documents stream once past each part.

Defined cases: null texts have no words; an item without words has no window;
a null item_id stands as the empty string; repeated document rows each give a
row; other columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the contract: what parts words, once A-Z have become a-z (A-Z count as letters here).
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WIDTH = 13
BROADCAST_BYTES = 2 << 20


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def occurrences(docs: DataFrame, words: DataFrame, small: bool) -> DataFrame:
    """(word, n): how often each of the words, lower-cased, occurs in the documents."""
    said = docs.select(F.explode(words_of(F.col("text"))).alias("word")).select(F.lower("word").alias("word"))
    return said.join(F.broadcast(words) if small else words, "word", "left_semi").groupBy("word").agg(F.count("*").alias("n"))


def window_table(items: DataFrame, docs: DataFrame, width: int = WIDTH, small: bool = True) -> DataFrame:
    """(body, size, key, offset, items): each distinct window, its rarest word among the documents' and who has it."""
    words = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of(ascii_lower(F.col("text"))).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (width - 1)))
    windows = words.select("item", "w", F.explode(starts).alias("at")).select("item", F.slice("w", F.col("at"), F.lit(width)).alias("w"))
    windows = windows.groupBy("w").agg(F.sort_array(F.collect_set("item")).alias("items"))
    each = windows.select("w", F.posexplode("w").alias("offset", "word"))
    common = occurrences(docs, each.select(F.lower("word").alias("word")).distinct(), small).select(F.col("word").alias("lower"), "n")
    known = each.join(common, F.lower("word") == F.col("lower"), "left")
    rarest = known.groupBy("w").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), -F.length("word"), "word", "offset")).alias("least"))
    return windows.join(rarest, "w").select(
        F.array_join("w", "\n").alias("body"), F.size("w").alias("size"), F.lower("least.word").alias("key"), F.col("least.offset").alias("offset"), "items"
    )


def find_overlap(docs: DataFrame, items: DataFrame, width: int = WIDTH, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, spans, items) of every document.

    spans: the occurrences as (start, size) in words, sorted; items: the ids of
    the items with occurring windows, sorted as strings; n_hit: words inside
    any occurrence.
    """
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    table = window_table(items, docs, width, small=total <= broadcast_bytes)
    parts = int(total // broadcast_bytes) + 1
    # each document also sends one empty word, which a row without a window meets: it carries n_words
    end = table.sparkSession.range(1).select(F.lit(None).cast("string").alias("body"), F.lit(0).alias("size"), F.lit("").alias("key"), F.lit(0).alias("offset"), F.array().cast("array<string>").alias("items"))
    found = None
    for part in range(parts):
        side = table.where(F.pmod(F.xxhash64("body"), F.lit(parts)) == part) if parts > 1 else table
        side = F.broadcast(side.unionByName(end) if part == 0 else side)
        words = docs.select("doc_id", F.xxhash64("text").alias("row"), words_of(F.col("text")).alias("words"))
        each = words.select("doc_id", "row", "words", F.posexplode(F.concat("words", F.array(F.lit("")))).alias("pos", "word"))
        start = F.col("pos") - F.col("offset")
        here = ascii_lower(F.array_join(F.slice("words", F.greatest(start + 1, F.lit(1)), F.col("size")), "\n"))
        meets = (F.lower("word") == F.col("key")) & (F.col("body").isNull() | ((start >= 0) & (start + F.col("size") <= F.size("words")) & (here == F.col("body"))))
        met = each.join(side, meets).select("doc_id", "row", F.when(F.col("body").isNull(), F.size("words")).alias("n_words"), F.when(F.col("body").isNotNull(), F.struct(start.alias("start"), "size")).alias("span"), "items")
        found = met if found is None else found.unionByName(met)
    by_doc = found.groupBy("doc_id", "row").agg(
        F.max("n_words").cast("long").alias("n_words"), F.count("n_words").alias("copies"), F.sort_array(F.collect_set("span")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")
    )
    stop = lambda x: x["start"] + x["size"]
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0), stop(x) - F.greatest(a["end"], x["start"]))).alias("n"), F.greatest(a["end"], stop(x)).alias("end")),
    )
    out = by_doc.withColumn("n_hit", covered["n"].cast("long"))
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc_id", "n_words", "n_hit", "spans", "items")


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """The contract's rule: a twentieth of the words or more are hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)
