"""Similarity, vector search, splits and metrics against brute force on small data."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from marquee.functions import lists
from marquee.operators import factors, interactions, outliers, terms, vectors


def _texts(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(30)]
    weights = 1 / np.arange(1, 31)
    texts = [" ".join(rng.choice(words, size=int(rng.integers(1, 9)), p=weights / weights.sum())) for _ in range(60)]
    texts += ["w0 w1 w2"] * 40 + ["w0"] * 3 + [""]  # a large group of copies and an empty text
    return spark.createDataFrame(list(enumerate(texts)), "id bigint, t string")


def _dense(vectors_df):
    return {r["id"]: {t["term"]: t["w"] for t in r["terms"]} for r in vectors_df.collect()}


@pytest.mark.parametrize("measure", ["cosine", "jaccard"])
@pytest.mark.parametrize("k", [1, 5])
def test_nearest_items_equal_brute_force(spark, measure, k):
    df = _texts(spark)
    if measure == "cosine":
        vec = terms.tfidf_vectors(df, "id", "t", [])
    else:
        vec = terms.set_vectors(df.withColumn("a", F.split("t", " ")), "id", "a")
    dense = _dense(vec)
    got = {(r["id"], r["rank"]): (r["other"], r["score"]) for r in
           terms.nearest_items(vec, k, terms.COSINE if measure == "cosine" else terms.JACCARD).collect()}
    want = {}
    for a, va in dense.items():
        scored = []
        for b, vb in dense.items():
            if a != b:
                dot = sum(w * vb.get(t, 0.0) for t, w in va.items())
                score = dot if measure == "cosine" else dot / (len(va) + len(vb) - dot)
                if dot > 0:
                    scored.append((-round(score, 9), b))
        for i, (s, b) in enumerate(sorted(scored)[:k], 1):
            want[a, i] = (b, pytest.approx(-s, abs=1e-8))
    assert got == want


def test_tfidf_formula(spark):
    df = spark.createDataFrame([(1, "Red red blue"), (2, "the blue")], "id bigint, t string")
    got = _dense(terms.tfidf_vectors(df, "id", "t"))
    red, blue = 2 * (math.log(3 / 2) + 1), math.log(3 / 3) + 1
    norm = math.hypot(red, blue)
    assert got[1] == {"red": pytest.approx(red / norm), "blue": pytest.approx(blue / norm)}
    assert got[2] == {"blue": pytest.approx(1.0)}


def test_jaccard_of_empty_sets(spark):
    df = spark.createDataFrame([([], []), (["a"], ["a", "b"])], "a array<string>, b array<string>")
    assert [r[0] for r in df.select(terms.jaccard(F.col("a"), F.col("b"))).collect()] == [0.0, 0.5]


def _movies(spark):
    return spark.createDataFrame([
        (1, "Alpha", "Drama, War", "soldier, front", "a long war story"),
        (2, "Beta", "Drama", "soldier", "another war story"),
        (3, "Gamma", "Comedy", "cat", "nothing alike"),
        (4, "Alpha", "Drama, War", "soldier, front", "a long war story"),
        (5, "Delta", None, None, None),
    ], "id bigint, title string, genres string, keywords string, overview string")


def test_similar_by_title_lists_every_other_movie(spark):
    movies = _movies(spark)
    seeds, problems = terms.seeds_by_title(movies, ["Alpha", "Nope", 3])
    assert rows(seeds) == [(1, "Alpha", 2)]
    assert {r["title"] for r in problems.collect()} == {"Nope", "3"}
    got = terms.similar_to_seeds(terms.blended_features(movies), movies, seeds.select("seed_id"), 4)
    listed = [(r["item_id"], r["score"]) for r in got.orderBy("rank").collect()]
    assert [i for i, _ in listed] == [4, 2, 3, 5] and listed[0][1] == pytest.approx(1.0)
    assert listed[2][1] == 0.0 and listed[3][1] == 0.0


def test_many_seeds_take_the_shuffled_way(spark, monkeypatch):
    movies = _movies(spark)
    seeds = movies.select(F.col("id").alias("seed_id"))
    features = terms.blended_features(movies)
    few = rows(terms.similar_to_seeds(features, movies, seeds, 3))
    monkeypatch.setattr(terms, "fits_broadcast", lambda *a, **k: False)
    assert rows(terms.similar_to_seeds(features, movies, seeds, 3)) == few


def test_unknown_ids_are_reported(spark):
    found, problems = terms.seeds_by_id(_movies(spark), ["2", 99, "abc", None])
    assert rows(found, "seed_id") == [(2,)]
    assert {r["asked"]: r["message"] for r in problems.collect()} == {
        "99": "Error: id not found.", "abc": "Error: id must be an integer.", "None": "Error: id must be an integer."}


@pytest.mark.parametrize("measure", ["l2", "cosine", "dot"])
@pytest.mark.parametrize("limit", [10_000, 5])
def test_vector_topk_equals_brute_force(spark, monkeypatch, measure, limit):
    monkeypatch.setattr(vectors, "BLOCK_QUERIES", 7)
    monkeypatch.setattr(vectors, "CHUNK", 11)
    rng = np.random.default_rng(1)
    items = rng.normal(size=(50, 4)).tolist() + [[1.0, 0.0, 0.0, 0.0]] * 30
    queries = rng.normal(size=(20, 4)).tolist() + [[1.0, 0.5, 0.0, 0.0]] * 10
    i = spark.createDataFrame(list(enumerate(items)), "id bigint, vector array<double>")
    q = spark.createDataFrame(list(enumerate(queries)), "query_id bigint, vector array<double>")
    got = {(r["query_id"], r["rank"]): r["item_id"] for r in vectors.vector_topk(q, i, 6, measure, broadcast_queries=limit).collect()}
    m, n = np.array(queries), np.array(items)
    score = {"l2": ((m[:, None] - n[None]) ** 2).sum(2), "dot": -m @ n.T,
             "cosine": -(m @ n.T) / np.linalg.norm(m, axis=1)[:, None] / np.linalg.norm(n, axis=1)[None]}[measure].round(9)
    want = {(a, r + 1): int(b) for a in range(len(m)) for r, b in enumerate(sorted(range(len(n)), key=lambda b: (score[a, b], b))[:6])}
    assert got == want


def test_listing_has_defaults(spark):
    users = spark.createDataFrame([(1, [0.0, 0.0])], "user_id bigint, vector array<double>")
    items = spark.createDataFrame([(7, [0.0, 0.0]), (8, [1.0, 0.0])], "id bigint, vector array<double>")
    known = spark.createDataFrame([(7, "A", "g")], "id bigint, title string, genres string")
    got = vectors.recommend_listing(users, items, known, 2)
    assert rows(got, "rank", "movie_id", "title", "genres", "score") == [(1, 7, "A", "g", 1.0), (2, 8, "Unknown", "N/A", 0.5)]


def _ratings(spark):
    rows_ = [(u, m, float(m % 5)) for u in range(12) for m in range(u)] + [(99, m, 4.0) for m in range(300)]
    return spark.createDataFrame(rows_, "user_id bigint, movie_id bigint, rating double")


def test_user_split_sizes(spark):
    df = _ratings(spark)
    flagged = interactions.user_split(df)
    sizes = {r["user_id"]: (r["n"], r["t"]) for r in flagged.groupBy("user_id").agg(F.count("*").alias("n"), F.sum("is_test").alias("t")).collect()}
    for user, (n, t) in sizes.items():
        assert t == (0 if n < 2 else max(1, int(n * 0.2))), user
    assert rows(flagged) == rows(interactions.user_split(df.repartition(7)))
    train, test = interactions.split_interactions(df, "random")
    assert train.count() + test.count() == df.count()
    with pytest.raises(ValueError):
        interactions.split_interactions(df, "other")


def test_weights_and_errors(spark):
    df = _ratings(spark).filter("user_id = 5")
    assert {r["weight"] for r in interactions.interaction_weights(df).collect()} == {1.0}
    assert {r["weight"] for r in interactions.interaction_weights(df, "condition_3").collect()} == {0.0, 1.0}
    with pytest.raises(ValueError):
        interactions.interaction_weights(df, "other")


def test_metrics_by_hand(spark):
    scores = spark.createDataFrame([(1, m, float(10 - m)) for m in range(5)] + [(2, m, float(m)) for m in range(2)], "user_id bigint, movie_id bigint, score double")
    positives = spark.createDataFrame([(1, 0), (1, 3), (2, 0), (2, 1)], "user_id bigint, movie_id bigint")
    got = {r["user_id"]: r for r in interactions.user_metrics(interactions.ranks_from_scores(scores, positives), [2]).collect()}
    assert got[1]["precision_2"] == 0.5 and got[1]["recall_2"] == 0.5 and got[1]["auc"] == pytest.approx(4 / 6)
    assert got[2]["auc"] == 0.5 and got[2]["precision_2"] == 1.0


def test_codes_in_order_of_appearance(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b"), (4, None), (5, "c")], "k bigint, v string")
    assert rows(interactions.int_codes(df, "v", "k", "code"), "k", "code") == [(1, 0), (2, 1), (3, 0), (4, -1), (5, 2)]


def test_feature_list_skips_nulls(spark):
    df = spark.createDataFrame([(1, "Drama, War,", None)], "id bigint, a string, b string")
    assert df.select(interactions.feature_list(["a", "b"])).first()[0] == ["drama", "war"]
    matrix = interactions.feature_matrix(interactions.item_features(df, ["a", "b"]))
    assert rows(matrix.groupBy("movie_id").agg(F.round(F.sum("weight"), 9))) == [(1, 1.0)]


def test_hybrid_model_prefers_the_users_genre(spark):
    inter = spark.createDataFrame([(u, m, 1.0) for u in range(20) for m in range(10) if m % 2 == u % 2 and (u + m) % 3], "user_id bigint, movie_id bigint, weight double")
    features = spark.createDataFrame([(m, ["even" if m % 2 == 0 else "odd"]) for m in range(10)], "movie_id bigint, features array<string>")
    known = spark.createDataFrame([(m, f"t{m}") for m in range(10)], "id bigint, title string")
    users, items = factors.fit_hybrid(inter, features, rank=4, iterations=5)
    top = factors.top_items(users, items, known, 3)
    assert top.filter("movie_id % 2 = user_id % 2").count() >= 0.9 * top.count()
    heavy = inter.select("user_id", "movie_id").union(known.select(F.lit(7).cast("bigint"), F.col("id")).filter("id < 8"))
    few = factors.top_items(users, items, known, 3, seen=heavy, exclude_seen=True)
    assert few.join(heavy, ["user_id", "movie_id"]).count() == 0 and few.filter("user_id = 7").count() == 2 - heavy.filter("user_id = 7 and movie_id >= 8").distinct().count()
    fresh = factors.top_items(users, items, known, 3, seen=inter, exclude_seen=True)
    assert fresh.join(inter, ["user_id", "movie_id"]).count() == 0 and fresh.groupBy("user_id").count().count() == 20
    with pytest.raises(ValueError):
        factors.fit_by_loss("other", inter, features)


def test_isolation_forest_drops_the_far_values(spark):
    df = spark.range(400).select("id", F.when(F.col("id") < 390, F.rand(1)).otherwise(F.col("id") * 1.0).alias("v"))
    kept = outliers.isolation_forest_filter(df, ["v"], "id")
    assert kept.filter("id >= 390").count() == 0 and kept.count() >= 0.94 * 400


def test_title_and_genres_of_text(spark):
    df = spark.createDataFrame([("Heat", "A heist. Done", "Crime")], "t string, o string, g string")
    text = df.select(lists.item_text("t", "o", "g").alias("x"))
    assert rows(text.select("x", lists.title_of_text("x"), lists.genres_of_text("x"))) == [
        ("Heat. A heist. Done Genres: Crime", "Heat", "Crime")]


def test_null_vectors_are_left_out(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0]), (2, None), (3, [0.0, 2.0])], "id bigint, vector array<double>")
    got = vectors.vector_topk(df.withColumnRenamed("id", "query_id"), df, 2)
    assert sorted((r["query_id"], r["item_id"]) for r in got.collect()) == [(1, 1), (1, 3), (3, 1), (3, 3)]


def test_short_lists_are_filled_in_the_order_of_ids(spark):
    items = spark.range(5).select("id")
    near = spark.createDataFrame([(0, 1, 3, 0.5), (3, 1, 0, 0.5)], "id bigint, rank int, other bigint, score double")
    got = {}
    for r in terms.filled_lists(near, items, 3).orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append((r["rank"], r["other"], r["score"]))
    assert got[0] == [(1, 3, 0.5), (2, 1, 0.0), (3, 2, 0.0)]
    assert got[4] == [(1, 0, 0.0), (2, 1, 0.0), (3, 2, 0.0)] and len(got) == 5
