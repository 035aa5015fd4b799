"""Min-max near-duplicates against a plain comparison of all pairs."""

import os
import random
import re
from collections import Counter

import numpy as np
import pytest

from marquee.llm import minmax

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, n bigint, keys string, digest string, rid int, root string"


def plain_set(text):
    found = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(found[i:i + 2]) for i in range(len(found) - 1)} or ({tuple(found)} if found else set())


def plain(rows):
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both) and root[i] != root[j]:
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    out = Counter()
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        least = doc_id if not sets[i] else min(ids, default=None)
        out[doc_id, len(sets[i]), least, doc_id == least] += 1
    return out


def found(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, 1, "k", "d", 2, "r") for i, t in rows], SCHEMA).repartition(3)
    return Counter(tuple(r) for r in minmax.near_duplicates(docs, **options).select("doc_id", "n_shingles", "component_id", "kept").collect())


def edited(rng, base, share):
    some = list(base)
    for p in rng.sample(range(len(base)), len(base)):
        trial = list(some)
        trial[p] = f"x{rng.randrange(10 ** 9)}"
        a, b = plain_set(" ".join(base)), plain_set(" ".join(trial))
        if len(a & b) < share * len(a | b):
            break
        some = trial
    return some


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
def test_whole_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(spark, rows) == plain(rows)


def test_awkward_rows(spark):
    long = " ".join(f"w{i % 7000}" for i in range(60_000))
    rows = [(1, ""), (2, None), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "two one"), (8, "One\x0btwo"), (None, "one"), (None, None),
            (None, "only here"), (None, "only here"), (11, long), (12, long + " end"), (13, long.upper()), (14, "É é"), (15, "é é"), (4, "one"),
            (4, "another text"), (20, "a b a b a b"), (21, "b a b"), (22, "x" * 500_000)]
    assert found(spark, rows) == plain(rows)
    assert not found(spark, [])


@pytest.mark.parametrize("few", [minmax.FEW, 0])
def test_planted_copies(spark, few):
    rng = random.Random(3)
    rows = []
    for i, share in enumerate((0.8, 0.82, 0.9, 0.95, 0.7) * 12):
        base = [f"w{rng.randrange(10 ** 6)}" for _ in range(rng.choice((12, 60, 200)))]
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(edited(rng, base, share)))]
    assert found(spark, rows, few=few) == plain(rows)


@pytest.mark.parametrize("few", [minmax.FEW, 0])
def test_texts_of_one_template(spark, few, monkeypatch):
    """Texts that share most of a template resemble each other, but link only with their own copy."""
    monkeypatch.setattr(minmax, "CELL_ROWS", 64)
    rng = random.Random(4)
    template = [f"t{i}" for i in range(100)]
    rows = []
    for i in range(120):
        base = template + [f"u{rng.randrange(10 ** 9)}" for _ in range(30)]
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(edited(rng, base, 0.8)))]
    rows += [(1000 + i, " ".join(template + ["v"] * i)) for i in range(40)]  # a group of copies in the same buckets
    want = plain(rows)
    assert len({c for _, _, c, _ in want}) > 20
    assert found(spark, rows, few=few) == want


def test_cells_find_what_a_plain_loop_finds(monkeypatch):
    monkeypatch.setattr(minmax, "COLUMNS", 16)
    rng = np.random.default_rng(5)
    for _ in range(20):
        sets = [np.unique(rng.integers(0, 40, rng.integers(1, 40)).astype(np.uint64)) for _ in range(30)]
        root = rng.integers(0, 3, 30)
        first = rng.random(30) < 0.5
        for side in (None, first):
            pairs = [(i, j) for i in range(30) for j in range(30) if root[i] != root[j] and (i < j if side is None else side[i] and not side[j])
                     and 180 * len(np.intersect1d(sets[i], sets[j])) >= 80 * (len(sets[i]) + len(sets[j]))]
            got = minmax.cell_links(np.arange(30), root, sets, side)
            assert groups(30, zip(*got)) == groups(30, pairs)


def test_bitmaps_rule_out_no_link(monkeypatch):
    monkeypatch.setattr(minmax, "COLUMNS", 64)
    rng = np.random.default_rng(8)
    pool = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
    for _ in range(20):
        sets = [np.unique(rng.choice(pool[: rng.integers(10, 150)], rng.integers(1, 130))) for _ in range(25)]
        bits, size = [minmax.bitmap(s) for s in sets], np.array([len(s) for s in sets])
        root = rng.integers(0, 9, 25)
        got = minmax.cell_candidates(root, size, bits, None)
        for i in range(25):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                assert both <= minmax.most_shared(size[i], bits[i], size[j], bits[j]) <= min(size[i], size[j])
                if root[i] != root[j] and minmax.alike(size[i], size[j], both):
                    assert got[i] and got[j]


def groups(n, pairs):
    root = list(range(n))
    for i, j in pairs:
        old, new = max(root[i], root[j]), min(root[i], root[j])
        root = [new if r == old else r for r in root]
    return root


def test_signature_is_unbiased():
    rng = np.random.default_rng(6)
    for share in (0.5, 0.8):
        agree = []
        for _ in range(60):
            a = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
            b = np.concatenate([a[: int(300 * 2 * share / (1 + share))], rng.integers(0, 1 << 63, 300 - int(300 * 2 * share / (1 + share)), dtype=np.uint64)])
            x, y = (minmax.band_keys(np.unique(s), 120, 2) for s in (a, b))
            agree.append(np.mean(np.array(x) == np.array(y)))
        assert abs(np.mean(agree) - share ** 2) < 0.02


def test_shingles_are_whole_words():
    known = minmax.WordHashes()
    rng = random.Random(7)
    for _ in range(300):
        text = "".join(rng.choice("abAB \t\n\x0b\x1cé") for _ in range(rng.randrange(40)))
        assert len(minmax.shingle_set(text, known)) == len(plain_set(text))
