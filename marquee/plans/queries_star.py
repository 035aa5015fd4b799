"""Star schema, views and list functions on the derived catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.functions import lists
from marquee.functions.spread import DIMENSION_ROWS
from marquee.operators import cleaning, star
from marquee.plans.registry import query
from marquee.sources.derived import CATALOG_SQL, catalog, table
from marquee.sources.scratch import buckets_for, keep, keep_bucketed

# Words that the stop-word and lemma queries use; both engines get the same list.
STOP_WORDS = ["the", "of", "and", "in", "la", "le", "des", "der", "die", "und"]


def star_input(spark: SparkSession, folder: str) -> DataFrame:
    """The derived catalog with the columns of a cleaned catalog."""
    df = catalog(spark, folder)
    return df.select(
        "id", "title", F.lit("Released").alias("status"), "release_date",
        (F.col("id") % 2 == 0).alias("adult"),
        F.concat(F.lit("l"), (F.col("id") % 5).cast("string")).alias("original_language"),
        F.concat(F.lit("About "), "title").alias("overview"),
        "vote_average", (F.col("runtime") / 2).alias("popularity"), "vote_count",
        F.floor("budget").alias("budget"), F.floor("revenue").alias("revenue"), "runtime",
        "genres", "keywords", "production_companies",
        F.when(F.col("id") % 9 != 0, F.split_part("keywords", F.lit(","), F.lit(1))).alias("spoken_languages"),
        "production_countries",
    )


STAR_INPUT_SQL = CATALOG_SQL + """,
cleaned AS (
  SELECT id, title, 'Released' AS status, release_date, id % 2 = 0 AS adult,
         'l' || CAST(id % 5 AS VARCHAR) AS original_language, 'About ' || title AS overview,
         vote_average, runtime / 2.0 AS popularity, vote_count,
         CAST(floor(budget) AS BIGINT) AS budget, CAST(floor(revenue) AS BIGINT) AS revenue, runtime,
         genres, keywords, production_companies,
         CASE WHEN id % 9 <> 0 THEN split_part(keywords, ',', 1) END AS spoken_languages,
         production_countries
  FROM catalog)
"""


def star_built(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The 12 tables as the transform job makes them, written: what has a movie_id is bucketed by it."""
    df = keep(star_input(spark, folder), "cleaned")
    buckets = buckets_for(df.count(), spark.sparkContext.defaultParallelism)
    tables = {"dim_movie": star.movie_dimension(df), "fact_movie": star.movie_fact(df)}
    tables = {name: keep_bucketed(t, name, "movie_id", buckets) for name, t in tables.items()}
    for spec in star.LIST_DIMENSIONS:
        dim = keep(star.dimension_from_list(df, spec.source, id_col=spec.id_col, value_col=spec.value_col), spec.dim)
        tables[spec.dim] = dim
        tables[spec.bridge] = keep_bucketed(star.bridge_for(df, dim, spec, DIMENSION_ROWS), spec.bridge, "movie_id", buckets)
    return tables


def _list_sql(column: str) -> str:
    return f"""SELECT id, trim(x) AS v FROM (
      SELECT id, unnest(string_split({column}, ',')) AS x FROM cleaned) WHERE trim(x) <> ''"""


def _dim_sql(column: str) -> str:
    return f"""SELECT row_number() OVER (ORDER BY substr(md5(v), 1, 3), v) AS dim_id, v
      FROM (SELECT DISTINCT v FROM ({_list_sql(column)}))"""


@query("dim_from_list", f"""WITH {STAR_INPUT_SQL}
SELECT dim_id AS company_id, v AS company_name FROM ({_dim_sql('production_companies')})""")
def dim_from_list(spark, folder):
    return star.dimension_from_list(
        star_input(spark, folder), "production_companies", id_col="company_id", value_col="company_name"
    )


@query("bridge_from_list", f"""WITH {STAR_INPUT_SQL}, dim AS ({_dim_sql('genres')}),
pairs AS (SELECT id AS movie_id, dim_id AS genre_id FROM ({_list_sql('genres')}) l JOIN dim USING (v))
SELECT row_number() OVER (ORDER BY substr(md5(movie_id || '|' || genre_id), 1, 3), movie_id, genre_id) AS bridge_id,
       movie_id, genre_id FROM pairs""")
def bridge_from_list(spark, folder):
    df = star_input(spark, folder)
    dim = star.dimension_from_list(df, "genres", id_col="genre_id", value_col="genre_name")
    return star.bridge_from_list(df, dim, "id", "genres", "genre_name", "genre_id")


@query("movie_dim", f"""WITH {STAR_INPUT_SQL}
SELECT id AS movie_id, title, status, CAST(release_date AS VARCHAR) AS release_date,
       CAST(adult AS BIGINT) AS adult, original_language, overview FROM cleaned""")
def movie_dim(spark, folder):
    df = star.movie_dimension(star_input(spark, folder))
    return df.withColumns({"release_date": F.col("release_date").cast("string"), "adult": F.col("adult").cast("bigint")})


@query("movie_fact", f"""WITH {STAR_INPUT_SQL}
SELECT id AS movie_id, round(vote_average, 6) AS vote_average, popularity, vote_count, budget, revenue,
       CAST(runtime AS BIGINT) AS runtime FROM cleaned""")
def movie_fact(spark, folder):
    return star.movie_fact(star_input(spark, folder)).withColumn("vote_average", F.round("vote_average", 6))


@query("star_row_counts", f"""WITH {STAR_INPUT_SQL}
SELECT 'dim_movie' AS table_name, count(*) AS n FROM cleaned UNION ALL
SELECT 'fact_movie', count(*) FROM cleaned UNION ALL
""" + " UNION ALL ".join(
    f"SELECT '{d.dim}', count(*) FROM ({_dim_sql(d.source)}) UNION ALL "
    f"SELECT '{d.bridge}', count(*) FROM ({_list_sql(d.source)})" for d in star.LIST_DIMENSIONS))
def star_row_counts(spark, folder):
    out = None
    for name, t in star_built(spark, folder).items():
        part = t.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = part if out is None else out.unionByName(part)
    return out


def _agg_sql(column: str, alias: str) -> str:
    return f"(SELECT id, string_agg(DISTINCT v, ', ' ORDER BY v) AS {alias} FROM ({_list_sql(column)}) GROUP BY id)"


@query("enriched_view18", f"""WITH {STAR_INPUT_SQL}
SELECT c.id AS movie_id, status, title, CAST(adult AS BIGINT) AS adult, overview, original_language,
       CAST(release_date AS VARCHAR) AS release_date, vote_count, round(vote_average, 6) AS vote_average,
       popularity, budget, revenue, CAST(runtime AS BIGINT) AS runtime,
       a1.genres, a2.keywords, a3.companies, a4.languages, a5.countries
FROM cleaned c
LEFT JOIN {_agg_sql('genres', 'genres')} a1 ON c.id = a1.id
LEFT JOIN {_agg_sql('keywords', 'keywords')} a2 ON c.id = a2.id
LEFT JOIN {_agg_sql('production_companies', 'companies')} a3 ON c.id = a3.id
LEFT JOIN {_agg_sql('spoken_languages', 'languages')} a4 ON c.id = a4.id
LEFT JOIN {_agg_sql('production_countries', 'countries')} a5 ON c.id = a5.id""")
def enriched_view18(spark, folder):
    df = star.enriched_view(star_built(spark, folder))
    return df.withColumns({
        "release_date": F.col("release_date").cast("string"), "adult": F.col("adult").cast("bigint"),
        "vote_average": F.round("vote_average", 6),
    })


@query("enriched_view4", f"""WITH {STAR_INPUT_SQL},
g AS (SELECT title, overview, string_agg(DISTINCT v, ', ' ORDER BY v) AS genres
      FROM cleaned JOIN ({_list_sql('genres')}) l ON cleaned.id = l.id GROUP BY 1, 2),
k AS (SELECT title, overview, string_agg(DISTINCT v, ', ' ORDER BY v) AS keywords
      FROM cleaned JOIN ({_list_sql('keywords')}) l ON cleaned.id = l.id GROUP BY 1, 2)
SELECT title, genres, keywords, overview FROM (SELECT DISTINCT title, overview FROM cleaned)
LEFT JOIN g USING (title, overview) LEFT JOIN k USING (title, overview)""")
def enriched_view4(spark, folder):
    return star.enriched_view_by_title(star_built(spark, folder))


# --- group statistics ---------------------------------------------------------------------

_STATS_SQL = """SELECT v AS {out}, count(*) AS movie_count, round(avg(vote_average), 6) AS avg_rating,
       CAST(sum(vote_count) AS BIGINT) AS total_votes, round(avg(popularity), 6) AS avg_popularity,
       round(avg(CAST(revenue AS DOUBLE)), 4) AS avg_revenue
FROM (SELECT trim(unnest(string_split(coalesce({col}, ''), ','))) AS v, * FROM cleaned) GROUP BY v"""


def _rounded_stats(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "avg_rating": F.round("avg_rating", 6), "avg_popularity": F.round("avg_popularity", 6),
        "avg_revenue": F.round("avg_revenue", 4),
    })


@query("group_stats_by_genre", f"""WITH {STAR_INPUT_SQL}
{_STATS_SQL.format(out='genre', col="CASE WHEN id % 7 <> 0 THEN genres END")} ORDER BY avg_rating DESC, genre""")
def group_stats_by_genre(spark, folder):
    df = star_input(spark, folder).withColumn("genres", F.when(F.col("id") % 7 != 0, F.col("genres")))
    return _rounded_stats(star.group_stats(df, "genres", "genre")).orderBy(F.desc("avg_rating"), "genre")


@query("group_stats_by_company", f"""WITH {STAR_INPUT_SQL}
{_STATS_SQL.format(out='company', col='production_companies')} ORDER BY total_votes DESC, company LIMIT 10""")
def group_stats_by_company(spark, folder):
    return _rounded_stats(
        star.top_group_stats(star_input(spark, folder), "production_companies", "company", 10)
    )


# --- list and text functions --------------------------------------------------------------


@query("parse_list", f"""WITH {STAR_INPUT_SQL}
SELECT id, list_aggregate(list_transform(string_split(coalesce(spoken_languages, '') || ' , ' || genres, ','),
       lambda x: trim(x)), 'string_agg', '|') AS parsed,
       CASE WHEN spoken_languages IS NULL THEN 0 ELSE len(string_split(spoken_languages, ',')) END AS n_languages
FROM cleaned""")
def parse_list(spark, folder):
    df = star_input(spark, folder)
    both = F.concat(F.coalesce("spoken_languages", F.lit("")), F.lit(" , "), "genres")
    return df.select(
        "id", F.array_join(lists.parse_list(both), "|").alias("parsed"),
        F.size(lists.parse_list("spoken_languages")).cast("bigint").alias("n_languages"),
    )


@query("parse_list_or_literal", f"""WITH {STAR_INPUT_SQL}
SELECT id, array_to_string(list_transform(string_split(genres, ','), lambda x: trim(x)), '|') AS values
FROM cleaned""")
def parse_list_or_literal(spark, folder):
    df = star_input(spark, folder)
    literal = F.concat(F.lit("['"), F.replace("genres", F.lit(", "), F.lit("', '")), F.lit("']"))
    mixed = df.withColumn("t", F.when(F.col("id") % 2 == 0, literal).otherwise(F.col("genres")))
    return mixed.select("id", F.array_join(lists.parse_list_or_literal("t"), "|").alias("values"))


@query("clean_list", f"""WITH {STAR_INPUT_SQL}
SELECT id, array_to_string(list_transform(string_split(keywords, ','), lambda x: lower(replace(x, ' ', ''))), ' ') AS words
FROM cleaned""")
def clean_list(spark, folder):
    df = star_input(spark, folder)
    return df.select("id", lists.join_list(lists.squash(lists.parse_list("keywords"))).alias("words"))


@query("compose_text", f"""WITH {STAR_INPUT_SQL}, t AS (
SELECT id, title || '. ' || coalesce(CASE WHEN id % 7 <> 0 THEN overview END, '') || ' Genres: ' ||
       coalesce(genres, '') AS text FROM cleaned)
SELECT id, text, split_part(text, '.', 1) AS title_back,
       list_extract(string_split(text, 'Genres: '), -1) AS genres_back FROM t""")
def compose_text(spark, folder):
    df = star_input(spark, folder).withColumn("overview", F.when(F.col("id") % 7 != 0, F.col("overview")))
    return df.select("id", lists.item_text("title", "overview", "genres").alias("text")).withColumns({
        "title_back": lists.title_of_text("text"), "genres_back": lists.genres_of_text("text"),
    })


@query("profile_text", f"""WITH {STAR_INPUT_SQL}
SELECT id, concat_ws(', ', title, spoken_languages, original_language) AS profile FROM cleaned""")
def profile_text(spark, folder):
    df = star_input(spark, folder).select(
        "id", F.col("title").alias("Last_genres1"), F.col("spoken_languages").alias("Last_genres2"),
        F.col("original_language").alias("Last_genres3"),
    )
    return df.select("id", lists.profile_text(df.columns).alias("profile"))


_STOPS_SQL = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"
_WORDS_SQL = r"list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')"


@query("remove_stopwords", f"""SELECT doc_id, array_to_string(list_filter({_WORDS_SQL},
   lambda w: NOT list_contains({_STOPS_SQL}, lower(w))), ' ') AS kept FROM documents""")
def remove_stopwords(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", lists.remove_words("text", STOP_WORDS).alias("kept"))


_LEMMAS_SQL = """lemmas AS (
  SELECT lower(n_name) AS word, 'nation' AS lemma FROM nation UNION ALL
  SELECT word, lemma FROM (SELECT DISTINCT p_type AS word, lower(p_type) AS lemma FROM part) UNION ALL
  SELECT DISTINCT split_part(p_name, ' ', 1), 'adj' FROM part UNION ALL
  SELECT 'the', 'DET' UNION ALL SELECT 'of', 'PREP' UNION ALL SELECT 'la', 'DET')"""


@query("lemmatize_by_dictionary", f"""WITH {_LEMMAS_SQL},
w AS (SELECT doc_id, unnest({_WORDS_SQL}) AS word, generate_subscripts({_WORDS_SQL}, 1) AS pos FROM documents)
SELECT d.doc_id, coalesce(t.text, '') AS text FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg(coalesce(lemma, word), ' ' ORDER BY pos) AS text
  FROM w LEFT JOIN lemmas USING (word) GROUP BY doc_id) t ON d.doc_id = t.doc_id""")
def lemmatize_by_dictionary(spark, folder):
    part = table(spark, folder, "part")
    lemmas = (
        table(spark, folder, "nation").select(F.lower("n_name").alias("word"), F.lit("nation").alias("lemma"))
        .unionByName(part.select(F.col("p_type").alias("word"), F.lower("p_type").alias("lemma")).distinct())
        .unionByName(part.select(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("word"), F.lit("adj").alias("lemma")).distinct())
        .unionByName(spark.createDataFrame([("the", "DET"), ("of", "PREP"), ("la", "DET")], "word string, lemma string"))
    )
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return cleaning.lemmatize(docs, "doc_id", "text", lemmas)
