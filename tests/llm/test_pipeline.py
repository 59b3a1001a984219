"""The pipeline against a plain version of each stage's decisions."""

from __future__ import annotations

import re
from collections import defaultdict

import pytest

pytest.importorskip("ledgerline.llm")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from ledgerline.llm.toxicity import score_toxicity, train
from ledgerline.tables import table
from test_operators import brute_components


def test_pipeline_against_plain_version(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    toxic = {r.doc_id for r in score_toxicity(docs, train(docs, table(spark, sf_dir, "labels"))).where("score >= 0.7").collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id not in toxic}
    holders = defaultdict(set)
    fold = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s.strip(" \t\n\x0b\f\r"))
    for i, t in texts.items():
        for line in t.split("\n"):
            if len(fold(line)) >= 20:
                holders[fold(line)].add(i)
    lost = {k: max(v) for k, v in holders.items() if len(v) >= 3}
    texts = {i: "\n".join(x for x in t.split("\n") if lost.get(fold(x), i) == i) for i, t in texts.items()}
    texts = {i: texts[i] for i, _, c in brute_components(sorted(texts.items()), 5, 4, 5) if i == c}
    plain = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    items = [plain(r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    want = {i for i, t in texts.items() if not any(x in plain(t) for x in items)}
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in out} == want
    per = defaultdict(list)
    for r in out:
        per[r.doc_id].append(r)
    assert all(sum(r.length for r in rows) == rows[0].doc_tokens for rows in per.values())


def test_stages_keep_the_columns_of_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).dtypes == docs.dtypes


def test_toxic_rows_go_one_by_one(spark, sf_dir):
    """A toxic row takes no other row with it, whether ids are null, shared or repeated; nulls and empty texts stay."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score_toxicity(docs, train(docs, labels), carry=True)
    assert scored.select("row.*").schema.simpleString() == docs.schema.simpleString()
    toxic, clean = (scored.where(c).orderBy(o).first()["row"]["text"] for c, o in (("score > 0.95", "doc_id"), ("score < 0.05", "doc_id")))
    rows = [(None, toxic), (None, clean), (2, toxic), (2, clean), (2, clean), (-1, None), (-2, "")]
    made = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], docs.schema)
    kept = corpus_pipeline.toxicity(spark, docs.unionByName(made), sf_dir).where("doc_id is null or doc_id in (2, -1, -2)")
    plain = docs.where("doc_id = 2").first()["text"]
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect() if r["text"] != plain or r["text"] in (toxic, clean)), key=repr)
    assert got == sorted([(None, clean), (2, clean), (2, clean), (-1, None), (-2, "")], key=repr)


def test_stages_on_empty_tables(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0
