"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, lm_score, near_dup, quality, secrets, substring_dedup, token_count, topk, toxicity


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """The place of a public vocabulary file, as the package that holds them tells it."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode(_read(spark, sf_dir, "documents"), tokenizer_path(), with_text=True)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = secrets.scan(_read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["kind"] != "crf")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return spans.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return lm_score.score(docs, *lm_score.fit(docs))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(_read(spark, sf_dir, "documents"), width=20)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(_read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.grade(docs, toxicity.fit(docs, _read(spark, sf_dir, "labels")))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.find_overlap(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), decontaminate.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated")
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.fit(docs, _read(spark, sf_dir, "labels")))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op9_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_read(spark, sf_dir, "documents"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings").select("vec_id", topk.quantised(F.col("embedding")).alias("v"))
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), k=10)


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_secret_scan": op2_secret_scan,
    "op3_lm_score": op3_lm_score,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_token_count": op5_token_count,
    "op6_toxicity": op6_toxicity,
    "op7_decontamination": op7_decontamination,
    "op8_quality": op8_quality,
    "op9_near_dup": op9_near_dup,
    "op10_top_k": op10_top_k,
}

_OP4 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, s, list_slice(w, s, s + 19) AS q FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS s FROM d)),
later AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY q ORDER BY doc_id, s) AS r FROM win) WHERE r > 1),
gone AS (SELECT doc_id, list(DISTINCT p) AS g FROM (SELECT doc_id, unnest(generate_series(s, s + 19)) AS p FROM later) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(len(g), 0) AS n_removed,
       sha256(array_to_string(CASE WHEN g IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(g, i)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)"""

_OP7 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, list_slice(w, s, s + 12) AS q FROM (SELECT item, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(q) AS n FROM bw),
dw AS (SELECT doc_id, s, n, list_slice(w, s, s + n - 1) AS q FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s FROM d, sizes)),
hit AS (SELECT doc_id, s, n, item FROM dw JOIN bw USING (q)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

_OP9 = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, list_slice(w, k, k + 4) AS q FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.q = b.q AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM d LEFT JOIN n USING (doc_id) JOIN comp USING (doc_id)"""

_OP10 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(r AS INTEGER) AS "rank", vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s) WHERE r <= 10"""

SQL = {"op4_substring_dedup": _OP4, "op7_decontamination": _OP7, "op9_near_dup": _OP9, "op10_top_k": _OP10}
