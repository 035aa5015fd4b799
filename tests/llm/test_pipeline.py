"""The corpus pipeline: each stage on its own input, and the whole on the smallest tables."""

import os
from collections import Counter

import pytest

import corpus_pipeline as pipeline
from marquee.llm import quality_classifier, secrets, simhash

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


def test_stages_hand_over_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        out.write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        if name == "quality_classifier":
            scores = quality_classifier.score(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
            assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in scores.filter("predicted = 1").collect()}
        if name == "simhash_near_dedup":
            found = simhash.near_duplicates(docs).collect()
            assert sorted(r["doc_id"] for r in out.collect()) == sorted({r["component_id"] for r in found})
        if name == "secret_scan":
            spans = {r["doc_id"]: [(s["start"], s["end"], s["kind"]) for s in r["spans"]] for r in secrets.find_secrets(docs).collect()}
            texts = {r["doc_id"]: r["text"] for r in docs.collect()}
            for r in out.collect():
                assert r["text"] == secrets.masked(texts[r["doc_id"]], spans[r["doc_id"]]) and r["n_chars"] == len(r["text"])
        if name == "source_mixing":
            taken = Counter(r["doc_id"] for r in out.collect())
            assert max(taken.values()) <= 2 and set(taken) <= {r["doc_id"] for r in docs.collect()}
        if name == "best_fit_packing":
            pieces = Counter(r["doc_id"] for r in out.filter("piece = 0").collect())
            assert pieces == Counter(r["doc_id"] for r in docs.collect())
        else:
            assert out.columns == columns
        docs = out


def test_awkward_rows_pass_through(spark):
    long = " ".join(f"word{i}" for i in range(3000))
    rows = [(1, "", "a"), (2, None, None), (None, long, "b"), (None, None, "b"), (5, long, "b"), (5, long, "b"), (7, "some other text", "c")]
    docs = spark.createDataFrame([(i, t, "en", s, len(t or ""), 1, 2, "x") for i, t, s in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint, score int, copies int, row_key string")
    for name, stage in pipeline.STAGES:
        for df in (docs, docs.limit(0)):
            out = stage(spark, df, FOLDER)
            out.collect()
            if name != "best_fit_packing":
                assert out.columns == docs.columns
    kept = pipeline.drop_near_copies(spark, docs, FOLDER).collect()
    assert sorted((r["doc_id"] for r in kept), key=str) == [1, 5, 7]


def test_one_id_with_unlike_texts(spark):
    one, other = (" ".join(f"{c}{i}" for i in range(200)) for c in "ab")
    rows = [(1, one, "a"), (1, other, "a"), (2, one, "b"), (3, other, "c"), (4, "some  text", "z"), (4, "Some text", "y"), (4, "Some text", "y")]
    kept = []
    for some in (rows, rows[::-1]):
        docs = spark.createDataFrame(some, "doc_id bigint, text string, source string").repartition(3)
        kept.append(sorted(tuple(r) for r in pipeline.drop_near_copies(spark, docs, "").collect()))
    assert kept[0] == kept[1] and len(kept[0]) == 3
    assert [r for r in kept[0] if r[0] == 1] == sorted([(1, one, "a"), (1, other, "a")])
