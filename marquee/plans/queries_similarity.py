"""Similarity and recommendation queries on catalog, documents and embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.functions import lists
from marquee.functions.spread import rank_within
from marquee.operators import cleaning, factors, interactions, posting_index, terms, text_vectors, vectors
from marquee.plans.registry import query
from marquee.sources import derived
from marquee.sources.derived import CATALOG_SQL, RATINGS_SQL, catalog, ratings, table
from marquee.sources.scratch import built_once, keep

# Spark's English stop words, stated for the check engine.
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers "
    "herself it its itself they them their theirs themselves what which who whom this that these those am is are "
    "was were be been being have has had having do does did doing a an the and but if or because as until while of "
    "at by for with about against between into through during before after above below to from up down in out on "
    "off over under again further then once here there when where why how all any both each few more most other "
    "some such no nor not only own same so than too very can will just don should now cannot could ought would"
).split()
STOPS_SQL = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"


def _tfidf_sql(rel: str, key: str, column: str, name: str, idf: bool = True) -> str:
    """CTEs {name}_tf and {name}(id, term, w) with unit vectors."""
    weight = "n * (ln((1.0 + (SELECT count(*) FROM {r})) / (1 + df)) + 1)".format(r=rel) if idf else "CAST(n AS DOUBLE)"
    return f"""{name}_tf AS (
  SELECT id, term, count(*) AS n FROM (
    SELECT {key} AS id, unnest(regexp_extract_all(lower({column}), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM {rel})
  WHERE NOT list_contains({STOPS_SQL}, term) GROUP BY 1, 2),
{name}_df AS (SELECT term, count(*) AS df FROM {name}_tf GROUP BY 1),
{name}_w AS (SELECT id, term, {weight} AS w FROM {name}_tf JOIN {name}_df USING (term)),
{name} AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM {name}_w)"""


@query("tfidf_weights", f"""WITH {_tfidf_sql('documents', 'doc_id', 'text', 'v')}
SELECT id, count(*) AS terms, round(max(w), 6) AS top_weight, round(sum(w), 4) AS total FROM v GROUP BY id""")
def tfidf_weights(spark, folder):
    docs = table(spark, folder, "documents")
    posted = terms.postings(terms.tfidf_vectors(docs, "doc_id", "text", STOP_WORDS))
    return posted.groupBy("id").agg(
        F.count("*").alias("terms"), F.round(F.max("w"), 6).alias("top_weight"), F.round(F.sum("w"), 4).alias("total"))


@query("tfidf_terms", f"""WITH {_tfidf_sql('conversations', "conv_id * 1000 + turn", 'text', 'v')}
SELECT id, term, round(w, 6) AS w FROM v""")
def tfidf_terms(spark, folder):
    said = table(spark, folder, "conversations").withColumn("id", F.col("conv_id") * 1000 + F.col("turn"))
    return terms.postings(terms.tfidf_vectors(said, "id", "text", STOP_WORDS)).select("id", "term", F.round("w", 6).alias("w"))


@query("count_vectors", f"""WITH {CATALOG_SQL}, t AS (SELECT id, keywords || ' ' || title || ' ' || title AS text FROM catalog),
{_tfidf_sql('t', 'id', 'text', 'v', idf=False)} SELECT id, term, round(w, 6) AS w FROM v""")
def count_vectors(spark, folder):
    df = catalog(spark, folder).select("id", F.concat_ws(" ", "keywords", "title", "title").alias("text"))
    return terms.postings(terms.count_vectors(df, "id", "text", STOP_WORDS)).select("id", "term", F.round("w", 6).alias("w"))


def _item_texts(spark: SparkSession, folder: str) -> DataFrame:
    return catalog(spark, folder).select("id", F.concat_ws(" ", "title", "keywords").alias("text"), "genres")


_ITEM_TEXTS_SQL = CATALOG_SQL + ", t AS (SELECT id, title || ' ' || keywords AS text, genres FROM catalog)"


@query("cosine_topk", f"""WITH {_ITEM_TEXTS_SQL}, {_tfidf_sql('t', 'id', 'text', 'v')},
p AS (SELECT a.id, b.id AS other, round(sum(a.w * b.w), 9) AS score FROM v a JOIN v b ON a.term = b.term AND a.id <> b.id GROUP BY 1, 2),
p0 AS (SELECT * FROM p UNION ALL SELECT a.id, b.id, 0 FROM t a JOIN (SELECT id FROM t ORDER BY id LIMIT 11) b ON a.id <> b.id
  WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.id = a.id AND p.other = b.id))
SELECT id, rank, other, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, other) AS rank FROM p0) WHERE rank <= 5""")
def cosine_topk(spark, folder):
    texts = _item_texts(spark, folder)
    near = terms.nearest_items(terms.tfidf_vectors(texts, "id", "text", STOP_WORDS), 5)
    return terms.filled_lists(near, texts, 5).withColumn("score", F.round("score", 6))


@query("jaccard_topk", f"""WITH {CATALOG_SQL},
s AS (SELECT DISTINCT id, lower(trim(unnest(string_split(genres || ', ' || keywords, ',')))) AS term FROM catalog),
n AS (SELECT id, count(*) AS size FROM s GROUP BY 1),
c AS (SELECT a.id, b.id AS other, count(*) AS c FROM s a JOIN s b ON a.term = b.term AND a.id <> b.id GROUP BY 1, 2),
p AS (SELECT c.id, other, round(c / CAST(x.size + y.size - c AS DOUBLE), 9) AS score FROM c JOIN n x ON c.id = x.id JOIN n y ON c.other = y.id),
p0 AS (SELECT * FROM p UNION ALL SELECT a.id, b.id, 0 FROM catalog a JOIN (SELECT id FROM catalog ORDER BY id LIMIT 11) b ON a.id <> b.id
  WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.id = a.id AND p.other = b.id))
SELECT id, rank, other, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, other) AS rank FROM p0) WHERE rank <= 5""")
def jaccard_topk(spark, folder):
    df = catalog(spark, folder).select(
        "id", lists.squash(lists.split_list(F.concat_ws(", ", "genres", "keywords"))).alias("set"))
    near = terms.nearest_items(terms.set_vectors(df, "id", "set"), 5, terms.JACCARD)
    return terms.filled_lists(near, df, 5).withColumn("score", F.round("score", 6))


@query("jaccard_score", f"""WITH {CATALOG_SQL}, p AS (SELECT id,
  list_distinct(list_transform(string_split(production_countries, ','), lambda x: trim(x))) AS a,
  list_distinct(list_transform(string_split(genres, ','), lambda x: trim(x))) AS b,
  lag(list_distinct(list_transform(string_split(genres, ','), lambda x: trim(x)))) OVER (ORDER BY id) AS c FROM catalog)
SELECT id, CAST(0 AS DOUBLE) AS unlike, coalesce(round(CAST(len(list_intersect(b, c)) AS DOUBLE) / len(list_distinct(list_concat(b, c))), 6), 0) AS like_previous FROM p""")
def jaccard_score(spark, folder):
    df = catalog(spark, folder).select(
        "id", lists.parse_list("production_countries").alias("a"), lists.parse_list("genres").alias("b"))
    before = df.select((F.col("id") + 1).alias("id"), F.col("b").alias("c"))
    both = df.join(before, "id", "left").withColumn("c", F.coalesce("c", F.array().cast("array<string>")))
    return both.select("id", F.round(terms.jaccard(F.col("a"), F.col("b")), 6).alias("unlike"),
                       F.round(terms.jaccard(F.col("b"), F.col("c")), 6).alias("like_previous"))


# --- similar to seeds: every seed is compared with the whole catalog -------------------------


def _seed_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """The whole catalog; overview is the document of the same id, null where there is none."""
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("overview"))
    parts = catalog(spark, folder).select("id", "title", "genres", "keywords")
    return parts.join(docs, "id", "left")


def _index(spark: SparkSession, folder: str) -> posting_index.PostingIndex:
    """The stored index of the catalog, built by the first request that finds none for the present files."""
    sources = [table(spark, folder, name) for name in ("part", "documents", "lineitem", "supplier", "nation")]
    return built_once("posting-index", sources, lambda path: posting_index.build_index(_seed_catalog(spark, folder), path))


_PAIR_SQL = """
  SELECT a.id AS seed_id, b.id AS item_id, round(sum(a.w * b.w), 9) AS score FROM {v} a JOIN {v} b ON a.term = b.term
  WHERE a.id IN (SELECT seed_id FROM seeds) GROUP BY 1, 2"""


def _blend_sql(seeds: str, nearest: int | None = None) -> str:
    def pairs(v: str) -> str:
        base = _PAIR_SQL.format(v=v)
        if nearest is None:
            return base
        return f"""SELECT seed_id, item_id, score FROM (SELECT *, row_number() OVER (PARTITION BY seed_id ORDER BY score DESC, item_id) AS near
          FROM ({base})) WHERE near <= {nearest}"""

    return f"""WITH {CATALOG_SQL}, m AS (
  SELECT id, title, genres, keywords, text AS overview FROM catalog LEFT JOIN documents ON id = doc_id),
seeds AS ({seeds}),
k AS (SELECT id, array_to_string(list_transform(string_split(keywords, ','), lambda x: lower(replace(x, ' ', ''))), ' ') AS text FROM m),
{_tfidf_sql('m', 'id', 'overview', 'o')}, {_tfidf_sql('k', 'id', 'text', 'w', idf=False)},
g AS (SELECT DISTINCT id, lower(replace(unnest(string_split(genres, ',')), ' ', '')) AS term FROM m),
gn AS (SELECT id, count(*) AS size FROM g GROUP BY 1),
gc AS (SELECT a.id AS seed_id, b.id AS item_id, count(*) AS c FROM g a JOIN g b ON a.term = b.term WHERE a.id IN (SELECT seed_id FROM seeds) GROUP BY 1, 2),
p AS (
  SELECT seed_id, item_id, 0.2 * c / CAST(x.size + y.size - c AS DOUBLE) AS score FROM gc JOIN gn x ON seed_id = x.id JOIN gn y ON item_id = y.id
  UNION ALL SELECT seed_id, item_id, 0.5 * score FROM ({pairs('o')})
  UNION ALL SELECT seed_id, item_id, 0.3 * score FROM ({pairs('w')})
  UNION ALL SELECT seed_id, m.id, 0 FROM seeds, m),
b AS (SELECT seed_id, item_id, round(sum(score), 6) AS score FROM p WHERE seed_id <> item_id GROUP BY 1, 2)
SELECT seed_id, rank, item_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY seed_id ORDER BY score DESC, item_id) AS rank FROM b) WHERE rank <= 10"""


@query("similar_by_title", _blend_sql("SELECT min(id) AS seed_id FROM m WHERE title IN ('red bolt', 'small gear', 'blue ring') GROUP BY title"))
def similar_by_title(spark, folder):
    index = _index(spark, folder)
    seeds, _ = index.seeds_by_title(["red bolt", "small gear", "blue ring", "no such title", 7])
    return index.similar(seeds.select("seed_id"), 10)


@query("similar_by_id", _blend_sql("SELECT id AS seed_id FROM m WHERE id IN (3, 17, 42)"))
def similar_by_id(spark, folder):
    index = _index(spark, folder)
    seeds, _ = index.seeds_by_id([3, "17", 42, "abc", -1])
    return index.similar(seeds.select("seed_id"), 10)


@query("similar_truncated50", _blend_sql("SELECT id AS seed_id FROM m WHERE id IN (3, 17, 42)", nearest=50))
def similar_truncated50(spark, folder):
    index = _index(spark, folder)
    seeds, _ = index.seeds_by_id([3, 17, 42])
    return index.similar(seeds.select("seed_id"), 10, nearest=terms.NEAREST)


@query("similar_without_index", _blend_sql("SELECT id AS seed_id FROM m WHERE id IN (5, 8)"))
def similar_without_index(spark, folder):
    """A single request on a catalog that is not indexed."""
    movies = _seed_catalog(spark, folder)
    seeds, _ = terms.seeds_by_id(movies, [5, 8])
    return terms.similar_to_seeds(terms.blended_features(movies), movies, seeds.select("seed_id"), 10)


@query("seed_titles", f"""WITH {CATALOG_SQL}
SELECT title, min(id) AS seed_id, count(*) AS matches, NULL AS message FROM catalog WHERE title IN ('red bolt', 'small gear') GROUP BY 1
UNION ALL SELECT 'no such title', NULL, 0, 'Error: title not found.' UNION ALL SELECT '7', NULL, 0, 'Error: title must be a string.'""")
def seed_titles(spark, folder):
    seeds, problems = terms.seeds_by_title(catalog(spark, folder), ["red bolt", "small gear", "no such title", 7])
    return seeds.select("title", "seed_id", "matches", F.lit(None).cast("string").alias("message")).unionByName(
        problems.select("title", F.lit(None).cast("bigint").alias("seed_id"), F.lit(0).cast("bigint").alias("matches"), "message"))


@query("seed_ids", f"""WITH {CATALOG_SQL}
SELECT CAST(id AS VARCHAR) AS asked, title, NULL AS message FROM catalog WHERE id IN (3, 17) UNION ALL
SELECT '-1', NULL, 'Error: id not found.' UNION ALL SELECT 'abc', NULL, 'Error: id must be an integer.'""")
def seed_ids(spark, folder):
    seeds, problems = terms.seeds_by_id(catalog(spark, folder), [3, "17", "abc", -1])
    return seeds.select(F.col("seed_id").cast("string").alias("asked"), "title", F.lit(None).cast("string").alias("message")).unionByName(
        problems.select("asked", F.lit(None).cast("string").alias("title"), "message"))


@query("sorted_by_title", f"""WITH {CATALOG_SQL} SELECT id, title, row_number() OVER (ORDER BY title, id) AS position
FROM catalog ORDER BY position""")
def sorted_by_title(spark, folder):
    """The catalog in the order of titles with each title's position; ids are kept."""
    titles = catalog(spark, folder).select("id", "title", F.lit(1).alias("all"))
    order = [F.col("title").asc_nulls_last(), F.col("id").asc()]
    placed = rank_within(titles, ["all"], F.lit(0), order, "position")
    return placed.select("id", "title", F.col("position").cast("bigint").alias("position")).orderBy("position")


@query("pinned_union", f"""WITH {CATALOG_SQL}, f AS (SELECT *, 1 AS src FROM catalog),
b AS (SELECT *, 0 AS src FROM catalog WHERE title IN ('red bolt', 'hot gear') UNION ALL SELECT * FROM f)
SELECT id, title FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY src) AS r FROM b) WHERE r = 1""")
def pinned_union(spark, folder):
    df = catalog(spark, folder)
    pinned = cleaning.where_in(df, "title", ["red bolt", "hot gear"])
    return terms.pinned_union(pinned, df, "id", "id").select("id", "title")


# --- dense vectors ------------------------------------------------------------------------

_DISTANCE_SQL = "round(list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) ** 2, 9)"


@query("vector_knn", f"""SELECT query_id, rank, item_id, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, item_id) AS rank FROM (
    SELECT a.vec_id AS query_id, b.vec_id AS item_id, {_DISTANCE_SQL} AS score FROM embeddings a, embeddings b)) WHERE rank <= 5""")
def vector_knn(spark, folder):
    items = derived.vectors(spark, folder)
    hits = vectors.vector_topk(items.select(F.col("id").alias("query_id"), "vector"), items, 5)
    return hits.withColumn("score", F.round("score", 6))


@query("vector_neighbours_cosine", """SELECT query_id, rank, item_id, round(score, 5) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank FROM (
    SELECT a.vec_id AS query_id, b.vec_id AS item_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 9) AS score
    FROM embeddings a, embeddings b)) WHERE rank <= 100""")
def vector_neighbours_cosine(spark, folder):
    return vectors.neighbours(derived.vectors(spark, folder), 100, "cosine").withColumn("score", F.round("score", 5))


_PROJECTED_SQL = f"""{_tfidf_sql('documents', 'doc_id', 'text', 'v')},
spots AS (SELECT id, w, CAST('0x' || substr(md5(term), 4 * j + 1, 2) AS INT) % 64 AS pos,
  CASE WHEN CAST('0x' || substr(md5(term), 4 * j + 3, 2) AS INT) % 2 = 0 THEN 1.0 ELSE -1.0 END AS sign FROM v, (SELECT unnest(range(4)) AS j)),
coords AS (SELECT id, pos, sum(w * sign) / 2 AS x FROM spots GROUP BY 1, 2),
dense AS MATERIALIZED (SELECT id, list(coalesce(x, 0) ORDER BY pos) AS vec FROM (SELECT DISTINCT id FROM coords) CROSS JOIN (SELECT unnest(range(64)) AS pos)
  LEFT JOIN coords USING (id, pos) GROUP BY id)"""


@query("text_vectors", f"WITH {_PROJECTED_SQL} SELECT id, unnest(range(64)) AS pos, unnest(list_transform(vec, lambda x: round(x, 6) + 0.0)) AS x FROM dense")
def projected_texts(spark, folder):
    """Every coordinate of every document's vector."""
    found = text_vectors.text_vectors(table(spark, folder, "documents"), "doc_id", "text", STOP_WORDS)
    return found.select("id", F.posexplode("vector").alias("pos", "x")).select("id", F.col("pos").cast("bigint").alias("pos"), (F.round("x", 6) + 0.0).alias("x"))


@query("similar_texts", f"""WITH {_PROJECTED_SQL} SELECT query_id, rank, item_id, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank FROM (
    SELECT a.id AS query_id, b.id AS item_id, round(list_cosine_similarity(a.vec, b.vec), 9) AS score FROM dense a, dense b)) WHERE rank <= 5""")
def similar_texts(spark, folder):
    """From the texts of documents to vectors to the nearest documents."""
    items = keep(text_vectors.text_vectors(table(spark, folder, "documents"), "doc_id", "text", STOP_WORDS), "text-vectors")
    hits = vectors.vector_topk(items.select(F.col("id").alias("query_id"), "vector"), items, 5, "cosine")
    return hits.withColumn("score", F.round("score", 6))


_USER_VECTORS_SQL = f"""{RATINGS_SQL}, uv AS (SELECT user_id, pos, avg(v) AS v FROM (
    SELECT user_id, unnest(CAST(embedding AS DOUBLE[])) AS v, generate_subscripts(embedding, 1) AS pos
    FROM ratings JOIN embeddings ON movie_id = vec_id) GROUP BY 1, 2)"""


def _user_vectors(spark: SparkSession, folder: str, rated: DataFrame | None = None) -> DataFrame:
    return vectors.user_vectors(ratings(spark, folder) if rated is None else rated, derived.vectors(spark, folder), 64)


@query("user_vectors", f"""WITH {_USER_VECTORS_SQL}
SELECT user_id, CAST(pos AS BIGINT) AS pos, round(v, 6) AS v FROM uv""")
def user_vectors(spark, folder):
    """Every position of every user's vector."""
    return _user_vectors(spark, folder).select("user_id", F.posexplode("vector").alias("at", "x")).select(
        "user_id", (F.col("at") + 1).cast("bigint").alias("pos"), F.round("x", 6).alias("v"))


_USER_HITS_SQL = f"""{_USER_VECTORS_SQL}, u AS (SELECT user_id, list(v ORDER BY pos) AS vec FROM uv GROUP BY 1),
hits AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY d, movie_id) AS rank FROM (
  SELECT user_id, vec_id AS movie_id, round(list_distance(vec, CAST(embedding AS DOUBLE[])) ** 2, 9) AS d FROM u, embeddings)) WHERE rank <= 10)"""


@query("recommend_listing", f"""WITH {CATALOG_SQL}, {_USER_HITS_SQL}
SELECT user_id, rank, movie_id, coalesce(title, 'Unknown') AS title, coalesce(genres, 'N/A') AS genres, coalesce(keywords, 'N/A') AS keywords,
       round(1 / (1 + d), 4) AS score FROM hits LEFT JOIN (SELECT * FROM catalog WHERE title <> 'red bolt') c ON movie_id = c.id""")
def recommend_listing(spark, folder):
    known = catalog(spark, folder).filter("title <> 'red bolt'")
    return vectors.recommend_listing(_user_vectors(spark, folder), derived.vectors(spark, folder), known, 10)


@query("shuffled_vector_search", f"""SELECT query_id, rank, item_id, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, item_id) AS rank FROM (
    SELECT a.vec_id AS query_id, b.vec_id AS item_id, {_DISTANCE_SQL} AS score FROM embeddings a, embeddings b)) WHERE rank <= 3""")
def shuffled_vector_search(spark, folder):
    """The way of many queries: blocks of queries meet chunks of items by shuffle."""
    items = derived.vectors(spark, folder)
    hits = vectors.vector_topk(items.select(F.col("id").alias("query_id"), "vector"), items, 3, broadcast_queries=0)
    return hits.withColumn("score", F.round("score", 6))


@query("unseen_topn", f"""WITH {CATALOG_SQL}, {_USER_VECTORS_SQL}, u AS (SELECT user_id, list(v ORDER BY pos) AS vec FROM uv GROUP BY 1),
s AS (SELECT user_id, vec_id AS movie_id, round(list_dot_product(vec, CAST(embedding AS DOUBLE[])), 9) AS d FROM u, embeddings
  WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.user_id = u.user_id AND r.movie_id = vec_id))
SELECT user_id, rank, movie_id, coalesce(title, 'Unknown') AS title, round(d, 4) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY d DESC, movie_id) AS rank FROM s) LEFT JOIN catalog ON movie_id = id WHERE rank <= 5""")
def unseen_topn(spark, folder):
    """Best items by product of vectors, without those the user has seen."""
    seen = keep(ratings(spark, folder), "ratings")
    listed = factors.top_items(_user_vectors(spark, folder, seen), derived.vectors(spark, folder), catalog(spark, folder), 5, seen=seen, exclude_seen=True)
    return listed.select("user_id", "rank", "movie_id", "title", "score")


@query("known_positives", f"""WITH {CATALOG_SQL}, {RATINGS_SQL}
SELECT user_id, rank, movie_id, rating, coalesce(title, 'Unknown') AS title FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, movie_id) AS rank FROM ratings)
LEFT JOIN catalog ON movie_id = id WHERE rank <= 10""")
def known_positives(spark, folder):
    users = table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"))
    return interactions.known_positives(ratings(spark, folder), users, catalog(spark, folder), 10)


@query("unknown_users", f"""WITH {RATINGS_SQL}
SELECT c_custkey AS user_id, 'Error: user not found.' AS message FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM ratings WHERE rating = 50)""")
def unknown_users(spark, folder):
    users = table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"))
    return interactions.unknown_users(users, ratings(spark, folder).filter("rating = 50"))


@query("precision_recall_at_k", f"""WITH {_USER_HITS_SQL}, truth AS (SELECT * FROM ratings WHERE rating >= 30),
h AS (SELECT user_id, count(*) AS h FROM hits JOIN truth USING (user_id, movie_id) GROUP BY 1)
SELECT round(avg(coalesce(h, 0) / 10.0), 6) AS precision, round(avg(coalesce(h, 0) / CAST(n AS DOUBLE)), 6) AS recall
FROM (SELECT user_id, count(*) AS n FROM truth GROUP BY 1) LEFT JOIN h USING (user_id)""")
def precision_recall_at_k(spark, folder):
    rated = keep(ratings(spark, folder), "ratings")
    hits = vectors.vector_topk(_user_vectors(spark, folder, rated), derived.vectors(spark, folder), 10, query_id="user_id")
    truth = interactions.relevant(rated, 30).filter("relevant = 1")
    means = interactions.precision_recall_at_k(hits.withColumnRenamed("item_id", "movie_id"), truth, 10)
    return means.select(F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


# --- interactions ---------------------------------------------------------------------------

_DRAW_SQL = "md5('42|' || user_id || '|' || movie_id)"
_SPLIT_SQL = f"""{RATINGS_SQL}, flagged AS (SELECT user_id, movie_id, rating,
  CAST(n >= 2 AND r <= greatest(1, floor(n * CAST(0.2 AS DOUBLE))) AS INT) AS is_test FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {_DRAW_SQL}) AS r, count(*) OVER (PARTITION BY user_id) AS n FROM ratings))"""


@query("user_split", f"WITH {_SPLIT_SQL} SELECT * FROM flagged")
def user_split(spark, folder):
    return interactions.user_split(ratings(spark, folder))


@query("random_split", f"""WITH {RATINGS_SQL}
SELECT user_id, movie_id, CAST(CAST('0x' || substr({_DRAW_SQL}, 1, 8) AS BIGINT) / 4294967296.0 < 0.2 AS INT) AS is_test FROM ratings""")
def random_split(spark, folder):
    return interactions.random_split(ratings(spark, folder)).select("user_id", "movie_id", "is_test")


@query("train_rows", f"WITH {_SPLIT_SQL} SELECT user_id, movie_id, rating FROM flagged WHERE is_test = 0")
def train_rows(spark, folder):
    df = ratings(spark, folder)
    _, test = interactions.split_interactions(df, "user")
    return interactions.without(df, test, ["user_id", "movie_id"]).select("user_id", "movie_id", "rating")


@query("random_train_rows", f"""WITH {RATINGS_SQL} SELECT user_id, movie_id, rating FROM ratings
WHERE CAST('0x' || substr({_DRAW_SQL}, 1, 8) AS BIGINT) / 4294967296.0 >= 0.2""")
def random_train_rows(spark, folder):
    train, _ = interactions.split_interactions(ratings(spark, folder), "random")
    return train.select("user_id", "movie_id", "rating")


@query("interaction_weights", f"""WITH {RATINGS_SQL}
SELECT user_id, movie_id, CAST(1 AS DOUBLE) AS by_default, rating AS by_rating, CAST(rating >= 30 AS INT) * CAST(1 AS DOUBLE) AS by_condition FROM ratings""")
def interaction_weights(spark, folder):
    df = ratings(spark, folder)
    for strategy, name in (("default", "by_default"), ("ratings", "by_rating"), ("condition_30", "by_condition")):
        df = interactions.interaction_weights(df, strategy, out=name)
    return df.drop("rating")


@query("relevance_flag", f"WITH {RATINGS_SQL} SELECT user_id, movie_id, CAST(rating >= 25 AS INT) AS relevant FROM ratings")
def relevance_flag(spark, folder):
    return interactions.relevant(ratings(spark, folder), 25).drop("rating")


@query("position_in_group", """SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS position,
  count(*) OVER (PARTITION BY user_id) AS group_size FROM events""")
def position_in_group(spark, folder):
    return interactions.position_in_group(table(spark, folder, "events").select("event_id", "user_id"), "user_id", "event_id")


@query("int_codes", """WITH f AS (SELECT event_type, min(event_id) AS first FROM events GROUP BY 1)
SELECT event_id, CASE WHEN event_id % 10 = 0 THEN -1 ELSE code END AS code FROM events JOIN (
  SELECT event_type, row_number() OVER (ORDER BY first) - 1 AS code FROM (
    SELECT event_type, min(event_id) AS first FROM events WHERE event_id % 10 <> 0 GROUP BY 1)) USING (event_type)""")
def int_codes(spark, folder):
    events = table(spark, folder, "events").select("event_id", F.when(F.col("event_id") % 10 != 0, F.col("event_type")).alias("event_type"))
    return interactions.int_codes(events, "event_type", "event_id", "code").select("event_id", "code")


@query("user_codes", f"""WITH {RATINGS_SQL}, r AS (SELECT 'u' || user_id AS user_name, user_id * 100000 + movie_id AS row_key FROM ratings),
c AS (SELECT user_name, row_number() OVER (ORDER BY min(row_key)) - 1 AS user_code FROM r GROUP BY 1)
SELECT row_key, user_code FROM r JOIN c USING (user_name)""")
def user_codes(spark, folder):
    df = ratings(spark, folder).select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user_name"),
        (F.col("user_id") * 100000 + F.col("movie_id")).alias("row_key"))
    return interactions.int_codes(df, "user_name", "row_key", "user_code").select("row_key", "user_code")


_FEATURES_SQL = """features AS (SELECT id AS movie_id, list_filter(list_transform(string_split(
  concat_ws(',', genres, CASE WHEN id % 7 <> 0 THEN keywords END), ','), lambda x: lower(trim(x))), lambda x: x <> '') AS features FROM catalog)"""


def _features(spark: SparkSession, folder: str) -> DataFrame:
    df = catalog(spark, folder).withColumn("keywords", F.when(F.col("id") % 7 != 0, F.col("keywords")))
    return interactions.item_features(df, ["genres", "keywords"])


@query("item_features", f"WITH {CATALOG_SQL}, {_FEATURES_SQL} SELECT movie_id, array_to_string(features, '|') AS features FROM features")
def item_features(spark, folder):
    return _features(spark, folder).select("movie_id", F.array_join("features", "|").alias("features"))


@query("feature_matrix", f"""WITH {CATALOG_SQL}, {_FEATURES_SQL},
x AS (SELECT movie_id, len(features) + 1 AS n, unnest(list_concat(['item:' || movie_id], features)) AS feature FROM features)
SELECT movie_id, feature, round(count(*) / CAST(n AS DOUBLE), 6) AS weight FROM x GROUP BY movie_id, feature, n""")
def feature_matrix(spark, folder):
    return interactions.feature_matrix(_features(spark, folder)).withColumn("weight", F.round("weight", 6))


@query("feature_vocabulary", f"WITH {CATALOG_SQL} SELECT DISTINCT lower(trim(unnest(string_split(genres || ',' || keywords, ',')))) AS feature FROM catalog")
def feature_vocabulary(spark, folder):
    return interactions.feature_vocabulary(catalog(spark, folder), ["genres", "keywords"])


@query("simple_features", f"WITH {CATALOG_SQL} SELECT DISTINCT lower(trim(title)) AS feature FROM catalog UNION SELECT CAST(runtime AS VARCHAR) FROM catalog")
def simple_features(spark, folder):
    return interactions.simple_features(catalog(spark, folder), ["title", "runtime"])


@query("seen_items", f"""WITH {CATALOG_SQL}, {RATINGS_SQL}
SELECT user_id, movie_id, coalesce(title, 'Unknown') AS title FROM ratings
LEFT JOIN (SELECT * FROM catalog WHERE title <> 'hot gear') c ON movie_id = c.id
WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')""")
def seen_items(spark, folder):
    users = table(spark, folder, "customer").filter("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("user_id"))
    return interactions.seen_items(ratings(spark, folder), users, catalog(spark, folder).filter("title <> 'hot gear'"))


# --- ranking metrics on a fixed score table: what the parts of each customer's lines cost -----


def _scores(spark: SparkSession, folder: str) -> DataFrame:
    line = table(spark, folder, "lineitem").join(
        table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return line.groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("movie_id")).agg(
        F.max(F.floor(F.col("l_extendedprice") / 500)).cast("double").alias("score"))


_RANKS_SQL = f"""{_SPLIT_SQL}, scores AS (SELECT o_custkey AS user_id, l_partkey AS movie_id, max(floor(l_extendedprice / 500)) AS score
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
train AS (SELECT user_id, movie_id FROM flagged WHERE is_test = 0 AND rating >= 25),
test AS (SELECT user_id, movie_id FROM flagged WHERE is_test = 1 AND rating >= 25),
test_ranks AS (SELECT * FROM (SELECT user_id, movie_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, movie_id) - 1 AS rank,
  count(*) OVER (PARTITION BY user_id) AS ranked FROM scores ANTI JOIN train USING (user_id, movie_id)) SEMI JOIN test USING (user_id, movie_id)),
train_ranks AS (SELECT * FROM (SELECT user_id, movie_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, movie_id) - 1 AS rank,
  count(*) OVER (PARTITION BY user_id) AS ranked FROM scores) SEMI JOIN train USING (user_id, movie_id))"""


def _split(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    flagged = keep(interactions.user_split(ratings(spark, folder)).filter("rating >= 25"), "flagged")
    return flagged.filter("is_test = 0"), flagged.filter("is_test = 1")


@query("ranks_from_scores", f"WITH {_RANKS_SQL} SELECT user_id, movie_id, rank, ranked FROM test_ranks")
def ranks_from_scores(spark, folder):
    train, test = _split(spark, folder)
    return interactions.ranks_from_scores(_scores(spark, folder), test, train)


@query("precision_at_k_by_rank", f"""WITH {_RANKS_SQL}
SELECT c_custkey AS user_id, round(coalesce(p, 0), 6) AS precision FROM customer LEFT JOIN (
  SELECT user_id, count(*) FILTER (rank < 10) / 10.0 AS p FROM test_ranks GROUP BY 1) ON c_custkey = user_id""")
def precision_at_k_by_rank(spark, folder):
    train, test = _split(spark, folder)
    ranks = interactions.ranks_from_scores(_scores(spark, folder), test, train)
    users = table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"))
    return interactions.precision_at_k(ranks, 10, users, preserve_rows=True).withColumn("precision", F.round("precision", 6))


def _metrics_sql(rel: str, split: str) -> str:
    ks = ", ".join(f"round(avg(p{k}), 6) AS precision_{k}, round(avg(r{k}), 6) AS recall_{k}" for k in (3, 5, 10))
    per = ", ".join(f"count(*) FILTER (rank < {k}) / {k}.0 AS p{k}, count(*) FILTER (rank < {k}) / CAST(count(*) AS DOUBLE) AS r{k}" for k in (3, 5, 10))
    return f"""SELECT '{split}' AS split, {ks}, round(avg(auc), 6) AS auc FROM (SELECT user_id, {per},
      CASE WHEN max(ranked) = count(*) THEN 0.5 ELSE (count(*) * max(ranked) - sum(rank + 1) - count(*) * (count(*) - 1) / 2.0)
        / CAST(count(*) * (max(ranked) - count(*)) AS DOUBLE) END AS auc FROM {rel} GROUP BY 1)"""


@query("auc_from_scores", f"WITH {_RANKS_SQL} {_metrics_sql('train_ranks', 'train')} UNION ALL {_metrics_sql('test_ranks', 'test')}")
def auc_from_scores(spark, folder):
    train, test = _split(spark, folder)
    df = interactions.evaluate_scores(_scores(spark, folder), train, test)
    return df.withColumns({c: F.round(c, 6) for c in df.columns if c != "split"})


# --- factor models --------------------------------------------------------------------------


@query("hybrid_factor_topn")
def hybrid_factor_topn(spark, folder):
    weighted = interactions.interaction_weights(ratings(spark, folder), "condition_25")
    users, items = factors.fit_hybrid(weighted, _features(spark, folder), rank=10, iterations=5)
    return factors.top_items(users, items, catalog(spark, folder), 5)


_FM_FACTORS, _FM_ROUNDS, _FM_RATE = 4, 4, 0.2


def _fm_sql(factors: int, rounds: int, rate: float) -> str:
    """The same descent in SQL: factors are columns, tokens and users tables, each round a group of CTEs."""
    ks = range(factors)

    def start(name: str) -> str:
        return ", ".join(f"(CAST(CAST('0x' || substr(md5('42|' || {name} || '|{k + 1}'), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 - 0.5) * 0.1 AS v{k}"
                         for k in ks)

    zeros = ", ".join(f"CAST(0 AS DOUBLE) AS a{k}" for k in ks)
    v, s = ", ".join(f"v{k}" for k in ks), ", ".join(f"s{k}" for k in ks)
    sums = ", ".join(f"sum(v{k}) AS s{k}" for k in ks)
    half = "(" + " + ".join(f"sum(v{k}) * sum(v{k})" for k in ks) + " - sum(" + " + ".join(f"v{k} * v{k}" for k in ks) + ")) / 2"
    dot = " + ".join(f"v{k} * s{k}" for k in ks)
    parts = [f"""train AS MATERIALIZED (SELECT user_id, movie_id, CAST(rating >= 25 AS INT) AS y FROM ratings WHERE {_HELD_SQL} >= 0.2),
test AS (SELECT user_id, movie_id FROM ratings WHERE {_HELD_SQL} < 0.2),
names AS MATERIALIZED (SELECT DISTINCT movie_id, unnest(list_concat(['item:' || movie_id], list_transform(features, lambda f: 'feature:' || f))) AS token FROM features),
trained AS MATERIALIZED (SELECT * FROM names SEMI JOIN train USING (movie_id)),
u0 AS MATERIALIZED (SELECT user_id, CAST(0 AS DOUBLE) AS w, {start("'user:' || user_id")}, CAST(0 AS DOUBLE) AS aw, {zeros} FROM (SELECT DISTINCT user_id FROM train)),
t0 AS MATERIALIZED (SELECT token, CAST(0 AS DOUBLE) AS w, {start('token')}, CAST(0 AS DOUBLE) AS aw, {zeros} FROM (SELECT DISTINCT token FROM trained)),
b0 AS (SELECT CAST(0 AS DOUBLE) AS b, CAST(0 AS DOUBLE) AS a)"""]

    def item(r: int, rel: str) -> str:
        return f"SELECT movie_id, sum(w) AS iw, {half} AS own, {sums} FROM {rel} JOIN t{r} USING (token) GROUP BY movie_id"

    def moved(key: str, r: int, grads: str, after: str) -> str:
        g = {k: f"coalesce(g{k}{after.format(k=k)}, 0)" for k in ks}
        new = [f"m.w - {rate} * coalesce(gw, 0) / sqrt(aw + coalesce(gw, 0) ** 2 + 0.01) AS w",
               *[f"m.v{k} - {rate} * {g[k]} / sqrt(a{k} + {g[k]} ** 2 + 0.01) AS v{k}" for k in ks],
               "aw + coalesce(gw, 0) ** 2 AS aw", *[f"a{k} + {g[k]} ** 2 AS a{k}" for k in ks]]
        name = "u" if key == "user_id" else "t"
        return f"{name}{r + 1} AS MATERIALIZED (SELECT m.{key}, {', '.join(new)} FROM {name}{r} m LEFT JOIN ({grads}) g ON m.{key} = g.{key})"

    for r in range(rounds):
        parts += [f"i{r} AS MATERIALIZED ({item(r, 'trained')})",
                  f"""e{r} AS MATERIALIZED (SELECT user_id, movie_id, 1 / (1 + exp(-(b + u.w + iw + own + {dot}))) - y AS g, {v}, {s}
  FROM train JOIN i{r} USING (movie_id) JOIN u{r} u USING (user_id), b{r})""",
                  moved("user_id", r, "SELECT user_id, sum(g) AS gw, " + ", ".join(f"sum(g * s{k}) AS g{k}" for k in ks) + f" FROM e{r} GROUP BY user_id", ""),
                  moved("token", r, "SELECT token, sum(g) AS gw, " + ", ".join(f"sum(p{k}) AS g{k}" for k in ks) + " FROM trained JOIN (SELECT movie_id, g, "
                        + ", ".join(f"gu{k} + s{k} * g AS p{k}" for k in ks) + " FROM (SELECT movie_id, sum(g) AS g, "
                        + ", ".join(f"sum(g * v{k}) AS gu{k}" for k in ks) + f" FROM e{r} GROUP BY movie_id) JOIN i{r} USING (movie_id)) USING (movie_id) GROUP BY token",
                        " - m.v{k} * gw"),
                  f"b{r + 1} AS (SELECT b - {rate} * g / sqrt(a + g * g + 0.01) AS b, a + g * g AS a FROM b{r}, (SELECT sum(g) AS g FROM e{r}))"]
    parts.append(f"i{rounds} AS ({item(rounds, 'names')})")
    return ",\n".join(parts) + f"""
SELECT user_id, movie_id, round(1 / (1 + exp(-(b + coalesce(u.w, 0) + coalesce(iw, 0) + coalesce(own, 0) + coalesce({dot}, 0)))), 6) AS score
FROM test LEFT JOIN i{rounds} USING (movie_id) LEFT JOIN u{rounds} u USING (user_id), b{rounds}"""


_HELD_SQL = f"CAST('0x' || substr({_DRAW_SQL}, 1, 8) AS BIGINT) / 4294967296.0"


@query("logistic_fm", f"WITH {CATALOG_SQL}, {RATINGS_SQL}, {_FEATURES_SQL}, {_fm_sql(_FM_FACTORS, _FM_ROUNDS, _FM_RATE)}")
def logistic_fm(spark, folder):
    """Scores of the pairs held back; the model is trained on the others."""
    weighted = keep(interactions.interaction_weights(ratings(spark, folder), "condition_25"), "weighted")
    train, test = interactions.split_interactions(weighted, "random")
    features = keep(_features(spark, folder), "features")
    model = factors.fit_by_loss("logistic", train, features, factors=_FM_FACTORS, iterations=_FM_ROUNDS, rate=_FM_RATE)
    return factors.logistic_scores(model, test, features).withColumn("score", F.round("score", 6))


@query("logistic_fm_pairs", f"""WITH {RATINGS_SQL}
SELECT user_id, movie_id, true AS in_range FROM ratings
WHERE CAST('0x' || substr({_DRAW_SQL}, 1, 8) AS BIGINT) / 4294967296.0 < 0.2""")
def logistic_fm_pairs(spark, folder):
    """One score between 0 and 1 for every pair held back."""
    return logistic_fm(spark, folder).select("user_id", "movie_id", F.col("score").between(0, 1).alias("in_range"))


TASTES = 5


def _planted(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Interactions in which a user only likes the items of one taste, and items with their taste as a feature."""
    liked = ratings(spark, folder).filter((F.col("user_id") + F.col("movie_id")) % TASTES == 0).select(
        "user_id", "movie_id", F.lit(1.0).alias("weight"))
    items = table(spark, folder, "part").select(F.col("p_partkey").alias("movie_id"), F.array(
        F.concat(F.lit("taste "), (F.col("p_partkey") % TASTES).cast("string"))).alias("features"))
    return liked, items


def _best_taste(spark: SparkSession, folder: str, loss: str) -> DataFrame:
    """The taste whose items the model gives each user the highest mean score."""
    liked, items = _planted(spark, folder)
    user_vectors, item_vectors = factors.fit_by_loss(loss, liked, items, rank=8, epochs=4, passes=25, rate=0.5)
    of_taste = item_vectors.select("id", (F.col("id") % TASTES).alias("taste"))
    tastes = vectors.weighted_mean(of_taste, item_vectors, "taste", "id", 9, salt_from="id").withColumnRenamed("taste", "id")
    best = vectors.vector_topk(user_vectors, tastes, 1, "dot", query_id="user_id")
    return best.select("user_id", F.col("item_id").alias("taste"))


_TASTE_SQL = f"""WITH {RATINGS_SQL} SELECT DISTINCT user_id, ({TASTES} - user_id % {TASTES}) % {TASTES} AS taste
FROM ratings WHERE (user_id + movie_id) % {TASTES} = 0"""


@query("warp_planted_taste", _TASTE_SQL)
def warp_planted_taste(spark, folder):
    return _best_taste(spark, folder, "warp")


@query("bpr_planted_taste", _TASTE_SQL)
def bpr_planted_taste(spark, folder):
    return _best_taste(spark, folder, "bpr")


@query("hybrid_factor_ranks", f"""WITH {RATINGS_SQL}
SELECT user_id, 5 AS hits, 5 AS last_rank, true AS falling FROM (SELECT DISTINCT user_id FROM ratings WHERE rating >= 25)""")
def hybrid_factor_ranks(spark, folder):
    """What does not depend on the trainer: ranks 1 to 5 for every user with an interaction of
    positive weight (the model knows no other), scores that never rise."""
    by_rank = F.array_sort(F.collect_list(F.struct("rank", "score")))
    listed = hybrid_factor_topn(spark, folder).groupBy("user_id").agg(
        F.count("*").alias("hits"), F.max("rank").cast("bigint").alias("last_rank"), by_rank.alias("l"))
    rising = F.exists(F.sequence(F.lit(1), F.size("l") - 1), lambda i: F.get("l", i)["score"] > F.get("l", i - 1)["score"])
    return listed.select("user_id", "hits", "last_rank", (~rising).alias("falling"))
