"""Trained and hashed operators recomputed by plain loops: word vectors and scores, URL verdicts, sketches."""

import math
import os
import re
import struct
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from marquee.llm import fingerprints, quality_classifier as qc, url_filter
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
here = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
HALF, FULL = 1 << 63, 1 << 64


def signed(h):
    return h - FULL if h >= HALF else h


# --- op3 --------------------------------------------------------------------------------------


def plain_vectors(texts):
    import zlib

    plus, minus = qc.index_places()
    context, n = defaultdict(lambda: [0] * qc.DIMS), Counter()
    for text in texts:
        cells = [zlib.crc32(w) % qc.CELLS for w in text.encode().split()]
        n.update(cells)
        for i, cell in enumerate(cells):
            for j in range(max(0, i - qc.SPAN), min(len(cells), i + qc.SPAN + 1)):
                if j != i:
                    context[cell][plus[cells[j]]] += 1
                    context[cell][minus[cells[j]]] -= 1
    unit = {}
    for cell in n:
        v = [math.copysign(math.sqrt(abs(x)), x) for x in context[cell]]
        size = max(math.sqrt(sum(x * x for x in v)), 1e-9)
        unit[cell] = [x / size for x in v]
    mean = [sum(unit[c][d] * n[c] for c in n) / sum(n.values()) for d in range(qc.DIMS)]
    out = {}
    for cell in n:
        v = [x - m for x, m in zip(unit[cell], mean)]
        size = max(math.sqrt(sum(x * x for x in v)), 1e-9)
        out[cell] = [x / size for x in v]
    return out


def plain_features(text, vectors):
    import zlib

    words = text.encode().split()
    if not words:
        return [0.0] * qc.FEATURES
    mine = [vectors[zlib.crc32(w) % qc.CELLS] for w in words]
    means = [sum(v[d] for v in mine) / len(words) for d in range(qc.DIMS)]
    spread = [math.sqrt(sum(v[d] ** 2 for v in mine) / len(words)) for d in range(qc.DIMS)]
    shapes = Counter(qc.Cells()[w] % qc.SHAPES for w in words)
    return [*means, *spread, *(shapes[s] / len(words) for s in range(qc.SHAPES))]


def test_word_vectors_pooling_and_network(spark):
    texts = ["the cat sat on the mat", "THE dog 42 sat", "", "über cat, cat; cat!", "one", "a b c d e f g h " * 5]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(9, None)], "doc_id bigint, text string")
    vectors = qc.word_vectors(qc.context_counts(docs))
    want = plain_vectors(texts)
    assert set(np.flatnonzero(np.abs(vectors).sum(axis=1))) <= set(want)
    for cell, v in want.items():
        assert np.allclose(vectors[cell], v, atol=1e-5)
    pooled = qc.pool(texts, vectors)
    for row, text in zip(pooled, texts):
        assert np.allclose(row, plain_features(text, want), atol=1e-5)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, qc.FEATURES))
    net = qc.Network(x, (x[:, 0] > 0).astype(float))
    w1, b1, w2, b2 = net.layers
    for row, got in zip(x[:10], net.score(x[:10])):
        z = [max(-10.0, min(10.0, (v - m) / s)) for v, m, s in zip(row, net.mean, net.scale)]
        hidden = [math.tanh(sum(a * w1[i][k] for i, a in enumerate(z)) + b1[k]) for k in range(qc.HIDDEN)]
        logit = sum(a * w2[k] for k, a in enumerate(hidden)) + b2[0]
        assert got == pytest.approx(1 / (1 + math.exp(-logit / net.temperature)), abs=1e-9)


# --- op7 --------------------------------------------------------------------------------------


def plain_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    fit = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def plain_score(host, path, weights, intercept):
    cells = []
    for tag, part in (("host", host), ("path", path)):
        marked = f"^{part}$"
        for n in url_filter.NGRAMS:
            for i in range(len(marked) - n + 1):
                h = xxhash.xxh64_intdigest(marked[i:i + n].encode(), xxhash.xxh64_intdigest(tag.encode(), 42))
                cells.append(signed(h) % url_filter.FEATURES)
    margin = intercept + sum(weights[c] for c in cells) / math.sqrt(max(1, len(cells)))
    return 1 / (1 + math.exp(-margin))


@here
def test_every_page(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "url")
    odd = [(10 ** 6, None), (10 ** 6 + 1, ""), (10 ** 6 + 2, "://"), (10 ** 6 + 3, "a://b://c/d?e#f"), (10 ** 6 + 4, "HTTP://ÉX.Net?x"), (10 ** 6 + 4, "HTTP://ÉX.Net?x"),
           (None, "http://" + "x" * 50_000 + ".org/fr/")]
    df = pages.unionByName(spark.createDataFrame(odd, "page_id bigint, url string"))
    weights, intercept = url_filter.train(spark)
    got = Counter((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"], round(r["score"], 9)) for r in url_filter.judge(df, weights, intercept).collect())
    want = Counter()
    for r in df.collect():
        host, path = plain_url(r["url"])
        rule, verdict = plain_rule(host, path)
        score = plain_score(host, path, weights, intercept)
        want[r["page_id"], host, path, rule, verdict or ("block" if score >= url_filter.BLOCK_AT else "allow"), round(score, 9)] += 1
    assert got == want


def test_no_pages(spark):
    assert url_filter.filter_urls(spark.createDataFrame([], "page_id bigint, url string, rule string")).collect() == []


# --- op10 -------------------------------------------------------------------------------------


def plain_sketch(text):
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in WORD.findall(text)]
    windows = [hashes[i:i + 5] for i in range(len(hashes) - 4)] or ([hashes] if hashes else [])
    out = set()
    for window in windows:
        h = 42
        for part in window:
            h = xxhash.xxh64_intdigest(struct.pack("<Q", part), h)
        out.add(signed(h))
    return sorted(out)[: fingerprints.K]


def plain_likeness(a, b):
    both = sorted(set(a) | set(b))[: fingerprints.K]
    return len(set(both) & set(a) & set(b)) / len(both) if both else 1.0


@here
def test_every_sketch(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = sorted(docs.collect(), key=lambda r: r["doc_id"])
    got = {r["doc_id"]: r for r in fingerprints.compare_with_edits(docs).collect()}
    for i, r in enumerate(rows):
        text, after = r["text"] or "", rows[(i + 1) % len(rows)]["text"] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        mine = got[r["doc_id"]]
        assert mine["edited"] == edited and mine["n_chars"] == len(text)
        assert mine["sketch"] == plain_sketch(text) and mine["edited_sketch"] == plain_sketch(edited)
        assert mine["near_edited"] == pytest.approx(plain_likeness(plain_sketch(text), plain_sketch(edited)))
        assert mine["near_next"] == pytest.approx(plain_likeness(plain_sketch(text), plain_sketch(after)))


def test_awkward_sketches(spark):
    texts = ["", None, " \t\n", "one", "one two three four", "one two three four five", "same " * 400, "é\x0bü a\x1cb", "w " * 200_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in fingerprints.fingerprint(docs).collect():
        assert r["sketch"] == plain_sketch(texts[r["doc_id"]] or "")
    assert F.col("sketch") is not None
