"""The corpus pipeline: documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept; its result is written as Parquet in the shared folder and read again.

1. quality: rows that the classifier scores under its threshold go.
2. near_dup: of each group of near-duplicates the smallest doc_id stays.
3. decontaminate: documents with a twentieth of their words or more inside
   benchmark windows go. (Rows with a null doc_id stand or fall together.)
4. secrets: every secret span is replaced by a mark; no row goes.
5. bpe: the texts become token ids, and their decoded text is digested.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrocube.llm import bpe, decontaminate, near_dup, quality, secrets
from hydrocube.llm.blobs import written
from hydrocube.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: As many ids as this are broadcast to drop their rows, 16 MB; of more, texts and ids are shuffled.
BROADCAST_IDS = 1 << 20


def without(docs: DataFrame, gone: DataFrame, null_too: bool = False) -> DataFrame:
    """docs but the rows whose doc_id is in gone."""
    gone = written(gone.select(F.col("doc_id").alias("gone")).distinct())
    ids = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    same = F.col("doc_id").eqNullSafe(F.col("gone")) if null_too else F.col("doc_id") == F.col("gone")
    return docs.select(COLUMNS).join(ids, same, "left_anti")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs.select(COLUMNS), model).where(F.col("score") >= quality.THRESHOLD).select(COLUMNS)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without(docs, near_dup.near_duplicates(docs).where(~F.col("kept")))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.find_overlap(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without(docs, found.where(decontaminate.contaminated(F.col("n_hit"), F.col("n_words"))), null_too=True)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.scan(docs.select(COLUMNS)).withColumn("text", secrets.redacted(F.col("text"), F.col("spans")))
    return clean.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = bpe.encode(docs, tokenizer_path(), with_text=True)
    return out.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality", quality_stage),
    ("near_dup", near_dup_stage),
    ("decontaminate", decontamination_stage),
    ("secrets", secrets_stage),
    ("bpe", bpe_stage),
]

#: SQL cannot express the classifier and the encoder: tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
