"""Stored posting index, prefix index, pivot cells, masked items, bucketed star tables: rows and plans."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import DATA
from marquee.functions.spread import parts_for
from marquee.operators import posting_index, star, terms, text_vectors, vectors
from marquee.plans import queries_similarity, queries_star

FOLDER = f"{DATA}/sf0.001"
here = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def found(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


# --- stored postings --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def movies(spark):
    rng = random.Random(3)
    words = [f"word{i}" for i in range(60)]
    rows = [(i, f"title {i % 40}", ", ".join(rng.sample(["Drama", "War", "Crime", "Music"], 2)),
             " ".join(rng.choice(words) for _ in range(rng.randrange(12))) or None, ", ".join(rng.sample(words, 3)) if i % 9 else None) for i in range(150)]
    return spark.createDataFrame(rows, "id bigint, title string, genres string, overview string, keywords string")


@pytest.mark.parametrize("nearest", [None, 20])
def test_index_gives_what_a_full_scan_gives(spark, movies, tmp_path, monkeypatch, nearest):
    monkeypatch.setattr(posting_index, "BUCKET_ROWS", 40)
    monkeypatch.setattr(posting_index, "FILE_ROWS", 15)
    index = posting_index.build_index(movies, f"{tmp_path}/index")
    assert index.buckets["postings-overview"] > 10
    titles = ["title 3", "title 7", "no such", 5, "title 39"]
    seeds, problems = index.seeds_by_title(titles)
    plain_seeds, plain_problems = terms.seeds_by_title(movies, titles)
    assert found(seeds, "seed_id", "title", "matches") == found(plain_seeds, "seed_id", "title", "matches")
    assert found(problems, "title", "message") == found(plain_problems, "title", "message")
    want = terms.similar_to_seeds(terms.blended_features(movies), movies, plain_seeds.select("seed_id"), 6, nearest)
    columns = ("seed_id", "rank", "item_id", "score")
    assert found(index.similar(seeds.select("seed_id"), 6, nearest), *columns) == found(want, *columns)
    monkeypatch.setattr(posting_index, "MOST_TERMS", 2)
    monkeypatch.setattr(posting_index, "MOST_SEEDS", 1)
    assert found(index.similar(seeds.select("seed_id"), 6, nearest), *columns) == found(want, *columns)
    by_id, wrong = index.seeds_by_id([4, "9", "x", -1])
    assert found(by_id, "seed_id") == [(4,), (9,)] and wrong.count() == 2
    none, _ = index.seeds_by_id([-1])
    assert index.similar(none.select("seed_id"), 5).collect() == []


def test_long_lists_of_a_bucket_are_divided(spark, tmp_path, monkeypatch):
    """What a task writes follows the elements of the lists too, not the rows alone."""
    monkeypatch.setattr(posting_index, "FILE_ROWS", 100)
    rows = spark.range(20).selectExpr("id", "transform(sequence(1, 49), x -> named_struct('term', 't' || x, 'w', 1.0D)) AS terms")
    assert posting_index._write(rows, "id", f"{tmp_path}/vectors") == 1
    written = spark.read.parquet(f"{tmp_path}/vectors")
    most = written.groupBy(F.input_file_name()).agg(F.sum(F.size("terms") + 1).alias("n")).agg(F.max("n")).first()[0]
    assert written.count() == 20 and len(written.inputFiles()) > 3 and most < 1_000


def test_vectors_of_an_index_are_written_once_where_they_lie(spark, movies, tmp_path, monkeypatch):
    kept = []
    for module in (terms, posting_index):
        monkeypatch.setattr(module, "keep", lambda df, label, keep=module.keep: kept.append((label, df.columns)) or keep(df, label))
    monkeypatch.setattr(posting_index, "BUCKET_ROWS", 40)
    index = posting_index.build_index(movies, f"{tmp_path}/index")
    assert not [label for label, columns in kept if {"overview", "terms"} & set(columns)]
    for name in ("overview", "keywords"):
        stored = spark.read.parquet(f"{tmp_path}/index/vectors-{name}")
        assert index.buckets[f"vectors-{name}"] == 4 == stored.select("bucket").distinct().count()
        assert len(stored.inputFiles()) <= parts_for(movies)  # a part holds rows of one bucket


@here
def test_a_request_reads_its_terms_only(spark):
    index = queries_similarity._index(spark, FOLDER)
    assert queries_similarity._index(spark, FOLDER) is index  # built once for these files
    seeds, _ = index.seeds_by_title(["red bolt"])
    text = plan(index.similar(seeds.select("seed_id"), 10))
    scans = [line for line in text.splitlines() if "FileScan parquet" in line and "term#" in line]
    assert len(scans) == 3  # the postings of genres, overview and keywords
    for line in scans:
        assert "bucket" in line.split("PartitionFilters")[1].split("PushedFilters")[0] and "(term" in line.split("PushedFilters")[1]
    assert all("bucket" in line.split("PartitionFilters")[1] for line in text.splitlines() if "FileScan" in line and "terms" in line.split("ReadSchema")[1])
    assert "HashingTF" not in text and "regexp_extract_all" not in text and "documents.parquet" not in text and "part.parquet" not in text


# --- prefix index -----------------------------------------------------------------------------


@pytest.mark.parametrize("measure", [terms.COSINE, terms.JACCARD])
@pytest.mark.parametrize("words", [12, 80])
def test_nearest_items_equal_all_pairs(spark, measure, words):
    rng = random.Random(words)
    sets = {i: {f"t{min(rng.randrange(words), rng.randrange(words))}" for _ in range(rng.randrange(1, 9))} for i in range(120)}
    if measure is terms.COSINE:
        data = {i: {t: rng.choice([0.5, 1.0, 3.0]) for t in s} for i, s in sets.items()}
        data = {i: {t: w / np.sqrt(sum(x * x for x in d.values())) for t, w in d.items()} for i, d in data.items()}
    else:
        data = {i: dict.fromkeys(s, 1.0) for i, s in sets.items()}

    def score(a, b):
        shared = sum(w * data[b][t] for t, w in data[a].items() if t in data[b])
        return shared if measure is terms.COSINE else shared / (len(data[a]) + len(data[b]) - shared)

    rows = [(i, [{"term": t, "w": float(w)} for t, w in sorted(d.items())]) for i, d in data.items()]
    df = spark.createDataFrame(rows, "id bigint, terms array<struct<term:string,w:double>>")
    got = {}
    for r in terms.nearest_items(df, 4, measure).orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append((r["other"], r["score"]))
    for i in data:
        best = sorted(((-round(score(i, j), 9), j) for j in data if j != i and score(i, j) > 0))[:4]
        assert [round(s, 6) for _, s in got.get(i, [])] == [round(-s, 6) for s, _ in best]
        assert {j for j, _ in got.get(i, [])} == {j for _, j in best} or len({s for s, _ in best}) < len(best)


@pytest.mark.skipif(not os.path.isdir(f"{DATA}/sf0.01"), reason="test tables are not here")
def test_fewer_postings_are_met(spark):
    """Rows of the postings join, against a look-up of a query's rarer terms in all postings; README has the figures."""
    texts = queries_similarity._item_texts(spark, f"{DATA}/sf0.01")
    vectors_ = terms.tfidf_vectors(texts, "id", "text", queries_similarity.STOP_WORDS)
    distinct = vectors_.groupBy("terms").agg(F.min("id").alias("id"))
    shown = terms.keep(terms._prefix_plan(terms.keep(distinct.select("id", "terms"), "distinct"), 5, terms.COSINE), "plan")
    full = shown.filter("not dropped").agg(F.sum(F.col("df") - 1)).first()[0]
    assert terms._meetings(shown).count() < 0.6 * full


# --- pivot cells ------------------------------------------------------------------------------


def clustered(spark, n=1200, groups=12, width=8, seed=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 20, (groups, width))
    points = centres[np.arange(n) % groups] + rng.normal(0, 0.5, (n, width))
    return spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id bigint, vector array<double>"), points


@pytest.mark.parametrize("measure", ["l2", "cosine", "dot"])
def test_cells_give_what_a_full_scan_gives(spark, measure):
    items, _ = clustered(spark)
    queries = items.filter("id % 3 = 0").select(F.col("id").alias("query_id"), "vector")
    columns = ("query_id", "rank", "item_id", "score")
    want = found(vectors.vector_topk(queries, items, 7, measure).withColumn("score", F.round("score", 6)), *columns)
    got = found(vectors.vector_topk(queries, items, 7, measure, broadcast_queries=0, cell_rows=60).withColumn("score", F.round("score", 6)), *columns)
    assert got == want


def test_few_cells_are_met_on_clustered_vectors(spark):
    items, _ = clustered(spark)
    rows = items.select(F.col("id").alias("_id"), F.col("vector").alias("_vec"))
    cells = vectors.Cells(rows, "l2", 30)
    own = terms.keep(cells.own(items.select(F.col("id").alias("_q"), F.col("vector").alias("_vec"))), "own")
    first = terms.keep(cells.search(own, 5, None), "first")
    worst = first.groupBy("_q").agg(F.get(F.sort_array(F.collect_list("_s")), F.lit(4)).alias("_worst"))
    met = cells.others(own.join(worst, "_q", "left")).count()
    assert len(cells.pivots) == 40
    assert met < 1200 * 39 / 4  # of all further cells


@pytest.mark.parametrize("cell_rows", [50, 10**6])
def test_seen_items_are_masked(spark, cell_rows):
    """One user has seen all but three items, one nothing; copies of an item are told apart."""
    items, points = clustered(spark, 300, 6)
    items = items.unionByName(items.filter("id < 20").withColumn("id", F.col("id") + 1000))
    users = spark.createDataFrame([(u, points[u].tolist()) for u in range(8)], "user_id bigint, vector array<double>")
    seen = {0: set(range(300)) - {5, 6, 7} | set(range(1000, 1020)), 1: set(), **{u: {u, u + 1000, u + 12} for u in range(2, 8)}}
    pairs = spark.createDataFrame([(u, i) for u, s in seen.items() for i in s], "user_id bigint, item_id bigint")
    got = {}
    for r in vectors.vector_topk(users, items, 6, "dot", query_id="user_id", seen=pairs, cell_rows=cell_rows).orderBy("user_id", "rank").collect():
        got.setdefault(r["user_id"], []).append(r["item_id"])
    every = {**{i: points[i] for i in range(300)}, **{i + 1000: points[i] for i in range(20)}}
    for u in range(8):
        best = sorted((-round(float(points[u] @ v), 9), i) for i, v in every.items() if i not in seen[u])[:6]
        assert got[u] == [i for _, i in best]
    assert len(got[0]) == 3


# --- vectors from text ------------------------------------------------------------------------


def test_projection_keeps_products_on_average(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(f"w{rng.randrange(40)}" for _ in range(30))) for i in range(40)] + [(100, ""), (101, None)]
    df = spark.createDataFrame(rows, "id bigint, text string")
    exact = {r["id"]: {t["term"]: t["w"] for t in r["terms"]} for r in terms.tfidf_vectors(df, "id", "text", []).collect()}
    dense = {r["id"]: np.array(r["vector"]) for r in text_vectors.text_vectors(df, "id", "text", [], dimensions=256).collect()}
    assert set(dense) == set(range(40))
    errors = [dense[a] @ dense[b] - sum(w * exact[b].get(t, 0) for t, w in exact[a].items()) for a in range(40) for b in range(a)]
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.15
    assert "UDF" not in plan(text_vectors.text_vectors(df, "id", "text", []))


# --- bucketed star tables ---------------------------------------------------------------------


@here
def test_enriched_view_joins_buckets_where_they_lie(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # dimensions are broadcast by a counted size, movies never
    try:
        text = plan(star.enriched_view(queries_star.star_built(spark, FOLDER)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("FileScan") == 12
    assert "Exchange hashpartitioning" not in text and "Exchange rangepartitioning" not in text


def test_term_counts_stay_where_their_texts_are(spark):
    df = spark.createDataFrame(
        [(1, "ab ab cd"), (1, "cd ef"), (None, "ab zz zz"), (None, "qq ab"), (2, "ab cd ef"), (3, None), (4, "ab yy")], "id bigint, text string")
    found = plan(terms.tfidf_vectors(df, "id", "text", []))
    assert "hashpartitioning" not in found and "SortMergeJoin" not in found


@pytest.mark.parametrize("most", [1, 2, 3])
def test_rare_terms_are_looked_up_by_shuffle(spark, monkeypatch, most):
    df = spark.createDataFrame(
        [(1, "ab ab cd"), (1, "cd ef"), (None, "ab zz zz"), (None, "qq ab"), (2, "ab cd ef"), (3, None), (4, "ab yy")], "id bigint, text string")
    found = lambda: {(r["id"], t["term"]): t["w"] for r in terms.tfidf_vectors(df, "id", "text", []).collect() for t in r["terms"]}
    whole, with_frequency = found(), terms._with_frequency
    monkeypatch.setattr(terms, "_with_frequency", lambda *given: with_frequency(*given, most))
    assert found() == whole and len(whole) == 11
    idf = {t: np.log(8 / (1 + n)) + 1 for t, n in {"ab": 4, "zz": 1, "qq": 1}.items()}  # texts without an id are one
    weights = {"ab": 2 * idf["ab"], "zz": 2 * idf["zz"], "qq": idf["qq"]}
    assert whole[(None, "zz")] == pytest.approx(weights["zz"] / np.sqrt(sum(w * w for w in weights.values())))


def test_parts_follow_the_bytes_of_the_files(spark, tmp_path):
    spark.range(1000).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    assert parts_for(df, 100) > 4 * parts_for(df) >= 8


@pytest.mark.parametrize("measure", list(vectors.MEASURES))
@pytest.mark.parametrize("k", [1, 7])
def test_search_kernel_keeps_little_and_is_exact(monkeypatch, measure, k):
    import tracemalloc

    monkeypatch.setattr(vectors, "FIRST_TILE", 16)
    rng = np.random.default_rng(k)
    items = np.round(rng.normal(size=(6000, 8)), 1)
    queries = np.vstack([items[:200], rng.normal(size=(100, 8)) * 1e-9, rng.normal(size=(100, 8)) * 1e6])
    scores = vectors._scores(queries, items, measure)
    order = np.lexsort((np.broadcast_to(np.arange(6000), scores.shape), scores))[:, :k]
    expected = np.take_along_axis(scores, order, 1)
    tracemalloc.start()
    for limit in (None, np.full(400, np.inf), expected[:, -1]):
        best = vectors._Best(np.arange(400), queries, k, measure, None, limit)
        for at in range(0, 6000, 1500):
            best.add(np.arange(at, at + 1500), items[at:at + 1500])
        assert np.allclose(best.found, expected, rtol=1e-12, atol=2e-9)
        assert len(best.rows()) == 400 * k
    assert (best.found_ids[:200] == order[:200]).all()
    tracemalloc.reset_peak()
    one = vectors._Best(np.arange(2000), np.repeat(queries, 5, axis=0), k, measure)
    one.add(np.arange(30_000), np.tile(items, (5, 1)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6  # 240 MB before: whole rows of scores


def test_left_out_items_hide_one_row_over_all_tiles(monkeypatch):
    monkeypatch.setattr(vectors, "FIRST_TILE", 4)
    ids, items = np.concatenate([np.arange(50), np.arange(50)]), np.tile(np.arange(50.0)[:, None], (2, 2))
    best = vectors._Best(np.array([0]), np.zeros((1, 2)), 3, "l2", [np.array([1, 99])])
    best.add(ids, items)
    assert best.rows()["_id"].tolist() == [0, 0, 1]  # the other row of item 1 stays, as it did before there were tiles


# --- what a search moves ----------------------------------------------------------------------


def test_searches_move_items_once_a_group(spark, monkeypatch):
    """Vectors are no key of a look-up, queries move once a pass, and cells that share a task share the items sent to it."""
    keys, sent = [], []
    lookup, meet = vectors.salted_lookup, vectors.Cells.meet
    monkeypatch.setattr(vectors, "salted_lookup", lambda left, right, on, *a, **k: keys.append(on) or lookup(left, right, on, *a, **k))
    monkeypatch.setattr(vectors.Cells, "meet", lambda self, asked, cells, k: sent.append((asked.count(), asked.select("_group").distinct().count())) or meet(
        self, asked, cells, k))
    items, _ = clustered(spark, 600, 6)
    items = items.unionByName(items.filter("id < 30").withColumn("id", F.col("id") + 1000))  # copies
    queries = items.select(F.col("id").alias("query_id"), "vector")
    columns = ("query_id", "rank", "item_id", "score")
    got = found(vectors.vector_topk(queries, items, 4, "l2", broadcast_queries=0, cell_rows=30).withColumn("score", F.round("score", 6)), *columns)
    assert ["_vec"] not in keys and sent == [(600, 1), (600, 1)]
    assert got == found(vectors.vector_topk(queries, items, 4, "l2").withColumn("score", F.round("score", 6)), *columns)


@pytest.mark.parametrize("size", [10**9, 900])
def test_groups_of_any_size_find_the_same(spark, monkeypatch, size):
    """Crowded cells are dealt over several groups; batches that end inside a cell or between two rows of one item change nothing."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    monkeypatch.setattr(vectors, "GROUP_BYTES", size)
    monkeypatch.setattr(vectors, "LEAST_GROUP", 1)
    items, points = clustered(spark, 90, 3)
    items = items.unionByName(items.filter("id < 20"))  # rows that come twice
    users = spark.createDataFrame([(u, points[u].tolist()) for u in range(12)], "user_id bigint, vector array<double>")
    pairs = spark.createDataFrame([(u, i) for u in range(12) for i in (u, u + 3, 10**6)], "user_id bigint, item_id bigint")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = vectors.vector_topk(users, items, 5, "l2", query_id="user_id", seen=pairs, cell_rows=20).orderBy("user_id", "rank").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    listed = {u: [r["item_id"] for r in got if r["user_id"] == u] for u in range(12)}
    for u in range(12):
        rows = list(range(90)) + list(range(20))
        for i in (u, u + 3):
            rows.remove(i)  # a left-out item hides one of its rows
        assert listed[u] == sorted(rows, key=lambda i: (round(float(((points[u] - points[i]) ** 2).sum()), 9), i))[:5]


def test_one_id_with_two_vectors_and_hashes_that_meet(spark, monkeypatch):
    items, points = clustered(spark, 60, 3)
    columns = ("query_id", "rank", "item_id")
    queries = items.select(F.col("id").alias("query_id"), "vector")
    want = found(vectors.vector_topk(queries, items, 3), *columns)
    monkeypatch.setattr(vectors.F, "xxhash64", lambda *c, real=F.xxhash64: F.lit(7).cast("bigint") if c == ("_vec",) else real(*c))
    assert found(vectors.vector_topk(queries, items, 3, broadcast_queries=0, cell_rows=20), *columns) == want
    twice = queries.unionByName(queries.filter("query_id = 1").withColumn("query_id", F.lit(2).cast("bigint")))
    assert found(vectors.vector_topk(twice, items, 3, broadcast_queries=0, cell_rows=20), *columns) == found(vectors.vector_topk(twice, items, 3), *columns)


def test_marks_are_found_eight_at_a_time():
    rng = np.random.default_rng(0)
    for shape, share in (((5, 16), 0.1), ((3, 7), 0.5), ((4, 8), 0.0), ((2, 8), 1.0), ((256, 512), 0.001)):
        marks = rng.random(shape) < share
        assert (vectors._marked(marks) == np.flatnonzero(marks)).all()
