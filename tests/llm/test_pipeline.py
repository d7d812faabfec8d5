"""The pipeline against a brute-force version of its stages on a small folder of tables."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from hydrocube.llm import bpe, quality, secrets
from hydrocube.llm.queries import tokenizer_path
from hydrocube.llm.textkit import chunks
from test_operators import WORDS, jaccard_groups  # tests/llm is on the path of its own tests


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng, rows, labels = random.Random(12), [], []
    item = " ".join(rng.choice(WORDS) + "q" for _ in range(20))
    for k in range(220):
        w = [rng.choice(WORDS) + rng.choice("abc") for _ in range(rng.randint(20, 60))]
        good = rng.random() < 0.75
        if not good:
            w = [x.upper() + "!!" for x in w]
        elif k % 11 == 0:
            w += item.split()
        elif k % 7 == 0:
            w.insert(3, 'password="Zk39xQ77pLm2"')
        rows.append((k, " ".join(w), "en", "s", 0))
        labels.append((k, int(good), 0))
    rows += [(300, rows[5][1] + " end", "en", "s", 0), (301, rows[5][1], "en", "s", 0), (302, None, None, None, None), (303, "", "en", "s", 0)]
    rows = [(i, t, a, b, len(t or "")) for i, t, a, b, _ in rows]
    at = f"file://{tmp_path_factory.mktemp('sf')}"
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, item), (2, "never seen at all")], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at, rows, labels, item


def shares(texts):
    return np.concatenate([quality.term_shares(c) for c in chunks(pa.array(texts, pa.string()))])


def test_run_equals_brute_force(spark, folder):
    at, rows, labels, item = folder
    model = quality.fit(spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet"))
    kept = [(r[0], r[1]) for r, s in zip(rows, model.score(shares([r[1] for r in rows]))) if s >= quality.THRESHOLD]
    good = dict((k, y) for k, y, _ in labels)
    assert sum(good.get(i, 1) for i, _ in kept) >= 0.98 * sum(good.values()) and len(kept) < len(rows) - 20
    groups = jaccard_groups(kept)
    kept = [(i, t) for i, t in kept if groups[i][1] == i]
    assert not {300, 301} & {i for i, _ in kept}
    target = {tuple(item.split()[k : k + 13]) for k in range(8)}

    def hit(t):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
        return len({p for k in range(len(w) - 12) if tuple(w[k : k + 13]) in target for p in range(k, k + 13)}), len(w)

    kept = [(i, t) for i, t in kept if not (hit(t)[0] > 0 and 20 * hit(t)[0] >= hit(t)[1])]
    coder = bpe.Encoder(open(tokenizer_path(), encoding="utf-8").read())
    want = {i: coder.encode(secrets.ASSIGN.sub("[SECRET]", t) if t else t) for i, t in kept}
    got = {r.doc_id: bytes(r.ids) for r in corpus_pipeline.run(spark, at).collect()}
    assert got == want and any("password" in (t or "") for _, t in kept) and len(want) > 60


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder[0])
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in docs.schema]


def test_stages_on_no_rows(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder[0]).count() == 0
