"""Each operator against a brute-force version, on the smallest tables and on awkward rows."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from marquee.llm import (common, components, fingerprints, mixing, packing, quality_classifier, quality_rules, secrets,
                         sharding, simhash, suffix_dedup, url_filter)
from marquee.llm.queries import QUERIES
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
MANY = (1 << 64) - 1
WORD = re.compile(r"[^\x20\x09-\x0D]+")
here = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def awkward(spark):
    rng = random.Random(5)
    some = ["alpha", "beta", "gamma", "Δelta", "épée", "zeta", "ETA!!", "theta."]
    text = lambda n: " ".join(rng.choice(some) for _ in range(n))
    long = text(6000)
    passage = text(60)
    rows = [(1, "", "a"), (2, None, "a"), (3, "one", None), (4, "one two", "b"), (5, long, "b"), (6, long, "b"),
            (7, text(40) + "\n\n" + passage, "c"), (8, passage + "\t" + text(50), "c"), (9, passage, None), (10, "  \n\t ", "a"),
            (None, passage, "d"), (None, None, None), (12, "token = 'abcdefgh12345678' AKIA" + "Q" * 16, "a"),
            (13, "same " * 50, "a"), (13, "same " * 50, "a"), (14, text(300), "e"), (15, "a" * 900, "e")]
    return spark.createDataFrame([(i, t, s, len(t or ""), 1, "x") for i, t, s in rows],
                                 "doc_id bigint, text string, source string, n_chars bigint, size int, fp string")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").withColumn("spans", F.lit(1)).withColumn("n", F.lit(2))


def inputs(request, spark, name):
    return request.getfixturevalue(name)


both = pytest.mark.parametrize("table", [pytest.param("docs", marks=here), "awkward"])


def near(a: int, b: int) -> bool:
    return ((a ^ b) & MANY).bit_count() <= 3


def plain_simhash(text):
    import xxhash

    found = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not found:
        return 0
    grams = [" ".join(found[i:i + 3]) for i in range(len(found) - 2)] or [" ".join(found)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@both
@pytest.mark.parametrize("block", [simhash.BLOCK, 8])
def test_simhash(request, spark, table, block):
    df = inputs(request, spark, table)
    got = simhash.near_duplicates(df, block=block).collect()
    rows = df.collect()
    assert len(got) == len(rows)
    prints = [(r["doc_id"], plain_simhash(r["text"])) for r in rows]
    assert Counter((r["doc_id"], r["fp"] & MANY) for r in got) == Counter(prints)
    root = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if near(prints[i][1], prints[j][1]):
                old, new = root[i], root[j]
                root = [new if x == old else x for x in root]
    least = {}
    for (doc_id, _), r in zip(prints, root):
        if doc_id is not None:
            least[r] = min(least.get(r, doc_id), doc_id)
    want = Counter((d, least.get(r)) for (d, _), r in zip(prints, root))
    assert Counter((r["doc_id"], r["component_id"]) for r in got) == want


def test_close_pairs_finds_all():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    some = np.concatenate([base ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, k, replace=False))) for k in range(6)])
    i, j = simhash.close_pairs(some, some)
    want = {(a, b) for a in range(len(some)) for b in range(len(some)) if near(int(some[a]), int(some[b]))}
    assert set(zip(i.tolist(), j.tolist())) == want


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 501), (7, 7)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in components.components(edges).collect()}
    assert got == {**{i: 0 for i in range(101)}, 500: 500, 501: 500}


def plain_stats(text):
    text = text or ""
    found = WORD.findall(text)
    seen = defaultdict(list)
    for i in range(len(found) - 7):
        seen[tuple(found[i:i + 8])].append(i)
    covered = {p for places in seen.values() if len(places) > 1 for i in places for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(found) < 20 or 100 * len(covered) > 30 * len(found)
    return (len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


@both
def test_quality_rules(request, spark, table):
    df = inputs(request, spark, table)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(1, 9)], "doc_id bigint, quality int, toxic int")
    got = quality_rules.judge(df, quality_rules.trusted_ids(labels)).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert Counter((r["doc_id"], *[r[n] for n in names]) for r in got) == Counter(
        (r["doc_id"], *plain_stats(r["text"])) for r in df.collect())
    assert all(r["kept"] == (not r["base_failed"] and r["score"] >= quality_rules.THRESHOLD) for r in got)


def test_quality_ratio_against_plain_counts(spark, awkward):
    trusted = spark.createDataFrame([(5,), (14,)], "doc_id bigint")
    table = quality_rules.log_ratios(awkward, trusted, cells=64)
    cells = {r["doc_id"]: r["c"] for r in awkward.filter("doc_id is not null").dropDuplicates(["doc_id"]).select(
        "doc_id", quality_rules.ngram_cells(quality_rules.word_hashes(F.col("text")), 64).alias("c")).collect()}
    every = awkward.select(quality_rules.ngram_cells(quality_rules.word_hashes(F.col("text")), 64).alias("c")).collect()
    raw = Counter(c for r in every for c in r["c"])
    target = Counter(cells[5] + cells[14])
    share = sum(target.values()) / sum(raw.values())
    for c in raw:
        want = math.log((target[c] + quality_rules.SMOOTHING) / (raw[c] * share + quality_rules.SMOOTHING))
        assert abs(table[c] - want) < 1e-3


def test_quality_ratio_is_the_same_without_broadcast(spark, awkward):
    trusted = spark.createDataFrame([(5,), (14,)], "doc_id bigint")
    small = quality_rules.log_ratios(awkward, trusted, cells=64)
    assert any(small) and quality_rules.log_ratios(awkward, trusted, cells=64, most_broadcast=0) == small


def test_every_label_counts(spark):
    labels = spark.range(60_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    ids = quality_rules.trusted_ids(labels.unionByName(labels))
    assert ids.count() == 30_000 == ids.distinct().count()


def test_quality_rules_without_trusted_rows(spark, awkward):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    got = quality_rules.judge(awkward, quality_rules.trusted_ids(none)).collect()
    assert all(r["score"] == 0 and r["kept"] == (not r["base_failed"]) for r in got)


@here
def test_quality_classifier_on_held_out_rows(spark):
    folder = FOLDER.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = quality_classifier.score(spark.read.parquet(f"{folder}/documents.parquet"), labels)
    rows = got.join(labels, "doc_id").filter("held_out").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.95


def test_quality_classifier_on_awkward_rows(spark, awkward):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 15)] + [(None, 1, 0), (3, None, 0)], "doc_id bigint, quality int, toxic int")
    got = quality_classifier.score(awkward, labels).collect()
    assert len(got) == awkward.count() and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] == 13}) == 1
    bare = quality_classifier.score(awkward, labels.limit(0)).collect()
    assert {r["score"] for r in bare} == {0.5}


def plain_base(text):
    found = []
    word = "(?:" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in (
        "password", "passwd", "secret", "token", "api_key", "apikey")) + ")"
    for m in re.finditer(word + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[1]) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(secrets.KINDS[k], a, b) for a, k, b in sorted(found)]


@both
def test_secret_patterns(request, spark, table):
    df = inputs(request, spark, table)
    got = secrets.find_secrets(df).collect()
    want = Counter((r["doc_id"], tuple(plain_base(r["text"] or ""))) for r in df.collect())
    assert Counter((r["doc_id"], tuple((s["kind"], s["start"], s["end"]) for s in r["base"])) for r in got) == want
    for r in got:
        assert [tuple(s) for s in r["spans"] if s["kind"] != "random"] == [tuple(s) for s in r["base"]]


def test_secret_battery_finds_random_strings(spark):
    rng = random.Random(1)
    alphabet = secrets.ENCODINGS["base64"][0][:62]
    keys = ["".join(rng.choice(alphabet) for _ in range(48)) for _ in range(20)]
    rows = [(i, f"the key {k} is here") for i, k in enumerate(keys)]
    rows += [(100 + i, "internationalisationandsoforthandsoon abcdefghijklmnopqrstuvwxyz0123456789 ABABABABABABABABABABABAB") for i in range(20)]
    got = secrets.find_secrets(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    hits = {r["doc_id"] for r in got if any(s["kind"] == "random" for s in r["spans"])}
    assert len([h for h in hits if h < 100]) >= 18 and not [h for h in hits if h >= 100]


def test_masking():
    assert secrets.masked("ab token=abcdef cd", [(3, 15, "assign"), (5, 9, "hex")]) == "ab <assign> cd"


def test_step_up():
    counts = {(0, 100): 3, (0, 0): 97, (1, 0): 5}
    assert secrets.thresholds(counts) == {0: 100, 1: secrets.BINS}


@both
def test_packing(request, spark, table):
    from tokenizers import Tokenizer

    df = inputs(request, spark, table)
    rows = packing.pack_documents(df).collect()
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    want = Counter()
    for r in df.collect():
        ids = np.array(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0], dtype="<u4")
        cuts = [0, *range((len(ids) - 1) % 2048 + 1, len(ids) + 1, 2048)]
        want.update((r["doc_id"], n, a, b - a, zlib.crc32(ids[a:b].tobytes())) for n, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    fill = defaultdict(list)
    for r in rows:
        fill[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_sweep_equals_best_fit_decreasing():
    rng = random.Random(2)
    for _ in range(20):
        lengths = [rng.randint(1, 100) for _ in range(rng.randint(1, 400))]
        bins: list[int] = []
        for x in sorted(lengths, reverse=True):
            fits = [i for i, gap in enumerate(bins) if gap >= x]
            if fits:
                best = min(fits, key=lambda i: bins[i])
                bins[best] -= x
            else:
                bins.append(100 - x)
        plan = packing.sweep(Counter(lengths), 100)
        used = {first + i for _, _, n, first, each, _ in plan for i in range(-(-n // each))}
        assert sum(m[2] for m in plan) == len(lengths) and len(used) == len(bins)


def plain_jump(key, shards, hash_of):
    at, step, jump = -1, 0, 0
    while jump < shards:
        at = jump
        jump = int((at + 1) * ((1 << 31) / ((hash_of(key, step) >> 33) + 1)))
        step += 1
    return at


@both
def test_sharding(request, spark, table):
    df = inputs(request, spark, table)
    got = sharding.shard(df).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (r["doc_id"], len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode())) for r in df.collect())
    slots = defaultdict(list)
    for r in got:
        assert 0 <= r["shard"] < 40 and r["grown_shard"] in (r["shard"], 40)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_jump_hash_against_the_plain_loop(spark):
    keys = spark.range(300).select(F.xxhash64("id").alias("key"))
    draws = {(r["key"], i): r[f"d{i}"] & MANY for r in keys.select(
        "key", *[F.xxhash64("key", F.lit(i)).alias(f"d{i}") for i in range(60)]).collect() for i in range(60)}
    for shards in (1, 2, 40, 41):
        for r in keys.select("key", sharding.jump_hash(F.col("key"), shards)["at"].alias("at")).collect():
            assert r["at"] == plain_jump(r["key"], shards, lambda k, s: draws[k, s])


@pytest.mark.parametrize("url, host, path, rule, verdict", [
    ("http://A.Net/x?y", "a.net", "/x", "net/", "block"), ("https://www.example.net/en/1#t", "www.example.net", "/en/1", "example.net/en/", "allow"),
    ("http://example.com/de/9", "example.com", "/de/9", "example.com/de/", "block"), ("http://x.org/fr/", "x.org", "/fr/", "org/fr/", "allow"),
    ("http://casino-bonus.example.org/en/1", "casino-bonus.example.org", "/en/1", None, "block"),
    ("http://library.example.org/en/1", "library.example.org", "/en/1", None, "allow"),
    ("http://magnet/x", "magnet", "/x", None, None), ("http://a.net", "a.net", "", None, None), ("no scheme", "", "", None, None), (None, "", "", None, None)])
def test_url_filter(spark, url_model, url, host, path, rule, verdict):
    df = spark.createDataFrame([(1, url, "h")], "page_id bigint, url string, host string")
    r = url_filter.judge(df, *url_model).first()
    assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
    assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")


@pytest.fixture(scope="module")
def url_model(spark):
    return url_filter.train(spark)


@both
def test_mixing(request, spark, table):
    df = inputs(request, spark, table)
    got = mixing.mix(df).collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((r["doc_id"], len(WORD.findall(r["text"] or ""))) for r in df.collect())
    sizes = Counter()
    for r in got:
        sizes[r["source"]] += r["size"]
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    level = {s: 0.0 for s in names}
    rest, open_ = 1.5 * sum(sizes.values()), set(names)
    while rest > 1e-9 and open_:
        unit = rest / sum(weight[s] for s in open_)
        for s in list(open_):
            level[s] += unit * weight[s]
        rest = 0.0
        for s in list(open_):
            if level[s] >= 2 * sizes[s]:
                rest, level[s] = rest + level[s] - 2 * sizes[s], 2.0 * sizes[s]
                open_.discard(s)
    taken, largest = Counter(), Counter()
    for r in got:
        assert abs(r["target"] - level[r["source"]]) < 1e-6 * max(1, level[r["source"]])
        assert r["taken"] <= 2 * r["size"] and r["source_size"] == sizes[r["source"]]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert all(abs(taken[s] - level[s]) <= largest[s] + 1e-6 for s in names)
    again = mixing.mix(df.repartition(3)).collect()
    assert Counter((r["doc_id"], r["taken"]) for r in again) == Counter((r["doc_id"], r["taken"]) for r in got)


def test_mixing_over_several_levels(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 50 + 1).cast("int")).alias("text"),
                                  F.when(F.col("id") % 3 > 0, "big").otherwise("small").alias("source"))
    got = mixing.mix(df, block=8).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g"), F.count("*").alias("n")).collect()
    assert sum(r["n"] for r in got) == 3000 and all(abs(r["t"] - r["g"]) <= 50 for r in got)


def test_equal_rows_are_made_again_from_their_count(spark):
    rows = [("a", 1, 5)] * 7 + [("a", None, 5)] * 25 + [(None, None, 5)] * 10 + [("b", 2, 0)]
    df = spark.createDataFrame(rows, "source string, doc_id bigint, size bigint")
    got = [tuple(r) for r in mixing.one_by_one(df, run=10).select("source", "doc_id", "size", "nth").collect()]
    want, seen = [], Counter()
    for row in rows:
        want.append((*row, seen[row]))
        seen[row] += 1
    assert Counter(got) == Counter(want)


def test_mixing_spreads_equal_rows_over_blocks(spark):
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit("one two three four").alias("text"),
        F.when(F.col("id") % 4 > 0, "big").otherwise("small").alias("source"))
    start = mixing.one_by_one(rows.select("doc_id", "source", F.lit(4).cast("bigint").alias("size")))
    open_rows = start.select("*", F.lit(1.0).alias("mass"), F.lit(6000).cast("bigint").alias("blocks"))
    level = mixing._level(open_rows, "bigint", 0, 64)
    assert level.agg(F.max(F.size("out"))).first()[0] < 200
    got = mixing.mix(rows)
    sums = got.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g"), F.count("*").alias("n")).collect()
    assert sum(r["n"] for r in sums) == 6000 and all(abs(r["t"] - r["g"]) <= 4 for r in sums)
    again = mixing.mix(rows.repartition(7))
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, got.collect()))


@both
def test_suffix_dedup(request, spark, table):
    df = inputs(request, spark, table)
    got = suffix_dedup.remove_repeats(df).collect()
    texts = [(r["doc_id"], (r["text"] or "").encode()) for r in df.collect()]
    seen = Counter(b[i:i + 200] for _, b in texts for i in range(len(b) - 199))
    want = Counter()
    for doc_id, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if seen[b[i:i + 200]] > 1:
                gone[i:i + 200] = b"\1" * 200
        kept = bytes(x for x, g in zip(b, gone) if not g)
        want[doc_id, len(b), sum(gone), len([1 for x in bytes(gone).split(b"\0") if x]), kept] += 1
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got) == want


def test_suffix_dedup_across_segments(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 700)
    rng = random.Random(4)
    letters = lambda n: "".join(rng.choice("abcdef ") for _ in range(n))
    shared = letters(900)
    df = spark.createDataFrame([(1, letters(500) + shared + letters(800)), (2, letters(1100) + shared[:650] + letters(20))], "doc_id bigint, text string")
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.remove_repeats(df).collect()}
    assert got == {1: 650, 2: 650}


@both
def test_fingerprints(request, spark, table):
    df = inputs(request, spark, table)
    rows = df.collect()
    got = fingerprints.compare_with_edits(df).collect()
    assert len(got) == len(rows)
    line = sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
    for i, r in enumerate(line):
        text, after = r["text"] or "", line[(i + 1) % len(line)]["text"] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        mine = [g for g in got if g["doc_id"] == r["doc_id"] and g["n_chars"] == len(text)]
        assert mine
        if r["doc_id"] not in (None, 15, 13):
            assert mine[0]["edited"] == edited
    shingles = lambda t: {tuple(w[i:i + 5]) for w in [WORD.findall(t)] for i in range(max(1, len(w) - 4)) if w}
    prints = {}
    for g, text in ((g, r["text"] or "") for r in rows for g in got if g["doc_id"] == r["doc_id"] and g["n_chars"] == len(r["text"] or "")):
        assert prints.setdefault(text, g["sketch"]) == g["sketch"]
        if len(shingles(text)) < fingerprints.K and len(shingles(g["edited"])) < fingerprints.K:
            a, b = shingles(text), shingles(g["edited"])
            assert len(g["sketch"]) == len(a)
            assert abs(g["near_edited"] - (len(a & b) / len(a | b) if a | b else 1.0)) < 0.35


def test_sketch_estimates(spark):
    words = [f"w{i}" for i in range(3000)]
    df = spark.createDataFrame([(1, " ".join(words[:2000]), " ".join(words[1000:]))], "i int, a string, b string")
    a, b = fingerprints.sketch(F.col("a"), 512), fingerprints.sketch(F.col("b"), 512)
    r = df.select(fingerprints.resemblance(a, b, 512).alias("r"), fingerprints.containment(a, b, 512).alias("c"),
                  fingerprints.distinct_shingles(a, 512).alias("n"), fingerprints.distinct_shingles(fingerprints.merge(a, b, 512), 512).alias("u")).first()
    assert abs(r["r"] - 1 / 3) < 0.08 and abs(r["c"] - 0.5) < 0.12 and abs(r["n"] / 1996 - 1) < 0.15 and abs(r["u"] / 2996 - 1) < 0.15


def test_next_document_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "DOCS_A_BUCKET", 8)
    df = spark.range(200).select((F.col("id") * F.col("id")).alias("doc_id"), F.col("id").cast("string").alias("text"))
    got = {r["doc_id"]: r["next_text"] for r in fingerprints.with_next(df, ["text"]).collect()}
    assert got == {i * i: str((i + 1) % 200) for i in range(200)}


@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith("op")])
def test_empty_tables(spark, tmp_path, name):
    spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    spark.createDataFrame([], "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert QUERIES[name](spark, str(tmp_path)).collect() == []


@here
@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith("op")])
def test_query_returns_its_whole_table(spark, name):
    rows = QUERIES[name](spark, FOLDER)
    key, table = next((k, t) for k, t in (("page_id", "pages"), ("vec_id", "embeddings"), ("doc_id", "documents")) if k in rows.columns)
    assert {r[key] for r in rows.select(key).collect()} == {r[key] for r in spark.read.parquet(f"{FOLDER}/{table}.parquet").select(key).collect()}


def test_kept_digest(spark):
    r = suffix_dedup.remove_repeats(spark.createDataFrame([(1, "abc")], "doc_id bigint, text string")).select(F.sha2("kept", 256).alias("h")).first()
    assert r["h"] == hashlib.sha256(b"abc").hexdigest()


def test_numbering_does_not_depend_on_the_number_of_buckets(spark, monkeypatch):
    monkeypatch.setattr(common, "ROWS_A_BUCKET", 10)
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), "id")
    got = common.numbered(df, ["g"], ["id"], [F.asc("id")], "n", 1000).groupBy("g").agg(
        F.min("n").alias("a"), F.max("n").alias("b"), F.count_distinct("n").alias("n")).collect()
    assert common.buckets_for(1000) == 100 and {tuple(r)[1:] for r in got} == {(0, 999, 1000)} and len(got) == 3
