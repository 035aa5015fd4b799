"""The Merkle manifest against a plain recursion over lists."""

import os
import random
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import pytest

from marquee.llm import merkle

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, tree string, place int, leaf string, digest int, size string"
COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(digests):
    """Root, and for each digest its siblings (left, right) level by level."""
    if len(digests) == 1:
        return digests[0], [[]]
    runs = [digests[i:i + 16] for i in range(0, len(digests), 16)]
    root, above = climb([h(*r) for r in runs])
    return root, [[("".join(r[:i]), "".join(r[i + 1:])), *above[k]] for k, r in enumerate(runs) for i in range(len(r))]


def plain(rows):
    by_source = defaultdict(list)
    for doc_id, source, lang, n_chars, text in rows:
        leaf = h(*map(field, (doc_id, source, lang, n_chars, text)))
        changed = leaf
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0:
            lower = text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            changed = h(*map(field, (doc_id, source, lang, n_chars, lower)))
        by_source[source].append((doc_id is not None, doc_id or 0, leaf, changed, doc_id))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    if not names:
        return Counter()
    trees = {s: climb([r[2] for r in sorted(by_source[s])]) for s in names}
    root, tops = climb([trees[s][0] for s in names])
    out = Counter()
    for s, top in zip(names, tops):
        for (_, _, leaf, changed, doc_id), proof in zip(sorted(by_source[s]), trees[s][1]):
            proof, now = [*proof, *top], changed
            for left, right in proof:
                now = h(left, now, right)
            out[doc_id, leaf, trees[s][0], root, h(*(a + b for a, b in proof)), now, now == root] += 1
    return out


def found(spark, rows, depth=merkle.DEPTH):
    docs = spark.createDataFrame([(*r, "t", 1, "l", 2, "s") for r in rows], SCHEMA).repartition(3)
    return Counter(tuple(r) for r in merkle.manifest(docs, depth).select(*COLUMNS).collect())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
@pytest.mark.parametrize("depth", [1, 3])
def test_whole_table(spark, depth):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = found(spark, rows, depth)
    assert got == plain(rows)
    assert 0 < sum(n for k, n in got.items() if not k[-1]) < len(rows)


@pytest.mark.parametrize("depth", [1, 2])
def test_several_rounds_and_sources(spark, depth):
    rng = random.Random(1)
    rows = [(i * 3 - 2000, rng.choice(["a", "a", "a", "b", "ß", "z z"]), "en", i, f"Text {i}") for i in range(1200)]
    rows += [(i, f"own {i}", None, None, None) for i in range(40)] + [(7, None, "en", 1, "A"), (2 ** 53 + 1, "b", "x", 2 ** 60 + 1, "B")]
    assert found(spark, rows, depth) == plain(rows)


def test_awkward_rows(spark):
    same = (5, "s", "en", 3, "ABC")
    rows = [same, same, same, (5, "s", "en", 3, "abd"), (None, "s", "en", 1, "Q"), (None, "s", "en", 1, "Q"), (None, None, None, None, None),
            (0, "", "", 0, ""), (-10, "s", "en", 3, "É\U0001F600Z"), (2 ** 62 + 1, "s", "en", 5, "L" * 3_000_000)]
    assert found(spark, rows) == plain(rows)
    for some in ([], [same], [same, same], [(None, None, None, None, None)], [(i, "only", "en", 1, "T") for i in range(17)]):
        assert found(spark, some) == plain(some)


def test_order_of_labels():
    digests = [h(str(i)) for i in range(300)]
    done = merkle.sweep_up(list(range(300)), digests, merkle.levels_of(300))
    root, proofs = climb(digests)
    assert list(done[-1].values()) == [root]
    below = merkle.sweep_down(done, [])
    assert [below[i] for i in range(300)] == proofs
    assert all(merkle.folded(d, below[i]) == root for i, d in enumerate(digests))
