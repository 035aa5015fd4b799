"""Cleaning steps on a raw-shaped catalog with planted defects, and the whole cleaning job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from marquee.functions import lists
from marquee.operators import checks, cleaning
from marquee.plans import jobs
from marquee.plans.queries_star import STAR_INPUT_SQL, star_built, star_input
from marquee.plans.registry import query
from marquee.sources.derived import table
from marquee.sources.scratch import keep

WHITELIST = ["red", "blue", "small", "large", "bolt", "gear", "ring", "widget"]

# column -> (Spark expression, SQL expression): the raw text of each column, defects included
_RAW = {
    "id": ("cast(id as string)", "CAST(id AS VARCHAR)"),
    "title": ("if(id % 5 = 0, '\"' || title || '\"', title)", "CASE WHEN id % 5 = 0 THEN '\"' || title || '\"' ELSE title END"),
    "vote_average": ("cast(round(vote_average, 2) as string)", "CAST(round(vote_average, 2) AS VARCHAR)"),
    "vote_count": ("if(id % 8 = 0, null, cast(vote_count as string))", "CASE WHEN id % 8 <> 0 THEN CAST(vote_count AS VARCHAR) END"),
    "status": ("if(id % 6 = 0, 'Planned', 'Released')", "CASE WHEN id % 6 = 0 THEN 'Planned' ELSE 'Released' END"),
    "release_date": (
        "case when id % 13 = 0 then null when id % 11 = 0 then 'not a date' when id % 19 = 0 then '1650-01-01' else cast(release_date as string) end",
        "CASE WHEN id % 13 = 0 THEN NULL WHEN id % 11 = 0 THEN 'not a date' WHEN id % 19 = 0 THEN '1650-01-01' ELSE CAST(release_date AS VARCHAR) END",
    ),
    "revenue": ("if(id % 9 = 0, 'abc', cast(revenue + 3000000000 as string))", "CASE WHEN id % 9 = 0 THEN 'abc' ELSE CAST(revenue + 3000000000 AS VARCHAR) END"),
    "runtime": ("if(id % 17 = 0, '-5', cast(runtime as string))", "CASE WHEN id % 17 = 0 THEN '-5' ELSE CAST(runtime AS VARCHAR) END"),
    "adult": ("if(id % 2 = 0, 'True', 'False')", "CASE WHEN id % 2 = 0 THEN 'True' ELSE 'False' END"),
    "backdrop_path": ("'/b' || id || '.jpg'", "'/b' || id || '.jpg'"),
    "budget": ("cast(budget as string)", "CAST(budget AS VARCHAR)"),
    "homepage": ("'https://x/' || id", "'https://x/' || id"),
    "imdb_id": ("'tt' || id", "'tt' || id"),
    "original_language": ("original_language", "original_language"),
    "original_title": ("title", "title"),
    "overview": ("if(id % 7 = 0, 'A \"' || title || '\" story', overview)", "CASE WHEN id % 7 = 0 THEN 'A \"' || title || '\" story' ELSE overview END"),
    "popularity": ("cast(popularity as string)", "CAST(popularity AS VARCHAR)"),
    "poster_path": ("case when id % 4 = 0 then null when id % 15 = 0 then '/p' || id || '.PNG' else '/p' || id || '.jpg' end",
                    "CASE WHEN id % 4 = 0 THEN NULL WHEN id % 15 = 0 THEN '/p' || id || '.PNG' ELSE '/p' || id || '.jpg' END"),
    "tagline": ("title", "title"),
    "genres": ("genres", "genres"),
    "production_companies": ("production_companies", "production_companies"),
    "production_countries": ("production_countries || if(id % 3 = 0, ', Atlantis', '')", "production_countries || CASE WHEN id % 3 = 0 THEN ', Atlantis' ELSE '' END"),
    "spoken_languages": ("spoken_languages", "spoken_languages"),
    "keywords": ("keywords", "keywords"),
}


def raw_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """All columns as text; every tenth title occurs a second time with another title."""
    df = star_input(spark, folder)
    raw = df.select(*[F.expr(s).alias(c) for c, (s, _) in _RAW.items()])
    again = raw.filter(F.col("id").try_cast("bigint") % 10 == 0).withColumn("title", F.concat(F.lit("zz "), "title"))
    return raw.unionByName(again)


RAW_SQL = STAR_INPUT_SQL + ",\nraw0 AS (SELECT " + ", ".join(f"{q} AS {c}" for c, (_, q) in _RAW.items()) + """ FROM cleaned),
raw AS (SELECT * FROM raw0 UNION ALL
        SELECT * REPLACE ('zz ' || title AS title) FROM raw0 WHERE CAST(id AS BIGINT) % 10 = 0)
"""
_REQUIRED_SQL = " AND ".join(f"{c} IS NOT NULL" for c in jobs.schemas.REQUIRED_COLUMNS)


def _countries(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").filter("n_regionkey < 3").select(F.lower("n_name").alias("country_name"))


_COUNTRIES_SQL = "countries AS (SELECT lower(n_name) AS country_name FROM nation WHERE n_regionkey < 3)"
_NORMAL_SQL = """(SELECT {key}, string_agg(country_name, ', ' ORDER BY country_name) AS production_countries
  FROM (SELECT {key}, lower(trim(unnest(string_split(production_countries, ',')))) AS v FROM {rel}) JOIN countries ON v = country_name
  GROUP BY {key})"""


@query("drop_null_rows", f"WITH {RAW_SQL} SELECT id, title, release_date FROM raw WHERE {_REQUIRED_SQL}")
def drop_null_rows(spark, folder):
    df = cleaning.drop_columns(raw_catalog(spark, folder), jobs.schemas.UNUSED_COLUMNS)
    return cleaning.drop_null_rows(df, jobs.schemas.REQUIRED_COLUMNS).select("id", "title", "release_date")


@query("typed_cast", f"""WITH {RAW_SQL}
SELECT id, title, TRY_CAST(vote_average AS DOUBLE) AS vote_average, TRY_CAST(vote_count AS BIGINT) AS vote_count,
       TRY_CAST(revenue AS BIGINT) AS revenue, TRY_CAST(runtime AS INT) AS runtime,
       CAST(TRY_CAST(adult AS BOOLEAN) AS BIGINT) AS adult,
       CAST(CAST(try_strptime(release_date, '%Y-%m-%d') AS DATE) AS VARCHAR) AS release_date FROM raw""")
def typed_cast(spark, folder):
    df = cleaning.cast_columns(
        raw_catalog(spark, folder), {**jobs.schemas.NUMERIC_TYPES, "adult": T.BooleanType()}
    )
    df = cleaning.parse_date(df, "release_date")
    return df.select("id", "title", "vote_average", "vote_count", "revenue", "runtime",
                     F.col("adult").cast("bigint").alias("adult"), F.col("release_date").cast("string").alias("release_date"))


@query("date_range", f"""WITH {RAW_SQL}
SELECT id, title, release_date FROM raw
WHERE CAST(try_strptime(release_date, '%Y-%m-%d') AS DATE) BETWEEN DATE '1700-01-01' AND DATE '1999-12-31'""")
def date_range(spark, folder):
    df = cleaning.parse_date(raw_catalog(spark, folder), "release_date")
    df = cleaning.date_between(df, "release_date", "1700-01-01", "1999-12-31")
    return df.select("id", "title", F.col("release_date").cast("string").alias("release_date"))


@query("fill_and_nonneg", f"""WITH {RAW_SQL}
SELECT id, title, coalesce(TRY_CAST(vote_count AS BIGINT), 0) AS vote_count,
       coalesce(TRY_CAST(revenue AS BIGINT), 0) AS revenue, TRY_CAST(runtime AS INT) AS runtime
FROM raw WHERE coalesce(TRY_CAST(runtime AS INT), 0) >= 0""")
def fill_and_nonneg(spark, folder):
    numeric = list(jobs.schemas.NUMERIC_TYPES)
    df = cleaning.cast_columns(raw_catalog(spark, folder), jobs.schemas.NUMERIC_TYPES)
    df = cleaning.keep_nonnegative(cleaning.fill_zero(df, numeric), numeric)
    return df.select("id", "title", "vote_count", "revenue", "runtime")


@query("strictly_positive", f"""WITH {RAW_SQL}
SELECT id, title FROM raw WHERE TRY_CAST(vote_count AS BIGINT) > 0 AND TRY_CAST(revenue AS BIGINT) > 0
  AND TRY_CAST(runtime AS INT) > 0""")
def strictly_positive(spark, folder):
    df = cleaning.cast_columns(raw_catalog(spark, folder), jobs.schemas.NUMERIC_TYPES)
    return cleaning.keep_nonnegative(df, ["vote_count", "revenue", "runtime"], strict=True).select("id", "title")


@query("status_filter", f"WITH {RAW_SQL} SELECT id, title, status FROM raw WHERE status = 'Released'")
def status_filter(spark, folder):
    return cleaning.keep_equal(raw_catalog(spark, folder), "status", "Released").select("id", "title", "status")


_WHITE_SQL = "len(list_filter(list_transform(string_split(genres, ','), lambda x: trim(x)), lambda g: NOT list_contains({w}, g))) = 0".format(
    w="[" + ", ".join(f"'{g}'" for g in WHITELIST) + "]")


@query("list_whitelist", f"WITH {STAR_INPUT_SQL} SELECT id, genres FROM cleaned WHERE {_WHITE_SQL}")
def list_whitelist(spark, folder):
    return cleaning.keep_whitelisted(star_input(spark, folder), "genres", WHITELIST).select("id", "genres")


@query("strip_quotes", """SELECT doc_id, replace(text, '"', '') AS text, source FROM documents""")
def strip_quotes(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return cleaning.strip_double_quotes(docs, ["text", "no_such_column"])


_NORM_QUERY = f"""WITH {RAW_SQL}, {_COUNTRIES_SQL}
SELECT CAST(id AS BIGINT) AS id, n.production_countries FROM {_NORMAL_SQL.format(key='id', rel='raw0')} n"""


@query("normalize_list_by_reference", _NORM_QUERY)
def normalize_list_by_reference(spark, folder):
    raw = star_input(spark, folder).select("id", F.expr(_RAW["production_countries"][0]).alias("production_countries"))
    return cleaning.normalize_by_reference(raw, "production_countries", _countries(spark, folder), "country_name")


@query("normalize_list_by_large_reference", _NORM_QUERY)
def normalize_list_by_large_reference(spark, folder):
    raw = star_input(spark, folder).select("id", F.expr(_RAW["production_countries"][0]).alias("production_countries"))
    return cleaning.normalize_by_large_reference(
        raw, "id", "production_countries", _countries(spark, folder), "country_name"
    )


@query("dedup_by_key", f"""WITH {RAW_SQL}
SELECT id, min(title) AS title FROM raw GROUP BY id""")
def dedup_by_key(spark, folder):
    return cleaning.dedup_by_key(raw_catalog(spark, folder), ["id"]).select("id", "title")


@query("clean_catalog", f"""WITH {RAW_SQL}, {_COUNTRIES_SQL},
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY title) AS rn FROM raw WHERE {_REQUIRED_SQL}) WHERE rn = 1),
typed AS (SELECT CAST(id AS BIGINT) AS id, replace(title, '"', '') AS title, coalesce(TRY_CAST(vote_average AS DOUBLE), 0) AS vote_average,
   coalesce(TRY_CAST(vote_count AS BIGINT), 0) AS vote_count, status, CAST(try_strptime(release_date, '%Y-%m-%d') AS DATE) AS d,
   coalesce(TRY_CAST(revenue AS BIGINT), 0) AS revenue, coalesce(TRY_CAST(runtime AS INT), 0) AS runtime,
   CAST(TRY_CAST(adult AS BOOLEAN) AS BIGINT) AS adult, coalesce(TRY_CAST(budget AS BIGINT), 0) AS budget, original_language,
   replace(overview, '"', '') AS overview, coalesce(TRY_CAST(popularity AS DOUBLE), 0) AS popularity, genres,
   production_companies, spoken_languages, replace(keywords, '"', '') AS keywords, production_countries FROM one)
SELECT t.* EXCLUDE (d, production_countries), CAST(d AS VARCHAR) AS release_date, n.production_countries
FROM typed t JOIN {_NORMAL_SQL.format(key='id', rel='typed')} n ON t.id = n.id
WHERE d BETWEEN DATE '1700-01-01' AND DATE '2025-06-02' AND runtime >= 0 AND status = 'Released' AND {_WHITE_SQL}""")
def clean_catalog(spark, folder):
    df = jobs.clean_catalog(raw_catalog(spark, folder), _countries(spark, folder), WHITELIST)
    return df.withColumns({"release_date": F.col("release_date").cast("string"), "adult": F.col("adult").cast("bigint")})


# --- predicates ---------------------------------------------------------------------------


@query("point_lookup", f"WITH {STAR_INPUT_SQL} SELECT id, title, budget FROM cleaned WHERE title = 'red bolt'")
def point_lookup(spark, folder):
    return cleaning.where_equal(star_input(spark, folder), title="red bolt").select("id", "title", "budget")


@query("substring_search", "SELECT doc_id, n_chars FROM documents WHERE lower(text) LIKE '%thth%'")
def substring_search(spark, folder):
    return cleaning.where_contains(table(spark, folder, "documents"), "text", "THth").select("doc_id", "n_chars")


@query("prefix_search", "SELECT page_id, url FROM pages WHERE url LIKE 'https://%'")
def prefix_search(spark, folder):
    return cleaning.where_prefix(table(spark, folder, "pages"), "url", "https://").select("page_id", "url")


@query("isin_filter", "SELECT doc_id, lang, source FROM documents WHERE lang IN ('fr', 'de')")
def isin_filter(spark, folder):
    return cleaning.where_in(table(spark, folder, "documents"), "lang", ["fr", "de"]).select("doc_id", "lang", "source")


@query("null_filter", f"WITH {STAR_INPUT_SQL} SELECT id, title FROM cleaned WHERE spoken_languages IS NULL")
def null_filter(spark, folder):
    return cleaning.where_null(star_input(spark, folder), "spoken_languages").select("id", "title")


@query("not_null_filter", f"WITH {STAR_INPUT_SQL} SELECT id, spoken_languages FROM cleaned WHERE spoken_languages IS NOT NULL")
def not_null_filter(spark, folder):
    return cleaning.where_null(star_input(spark, folder), "spoken_languages", False).select("id", "spoken_languages")


@query("length_filter", f"WITH {STAR_INPUT_SQL} SELECT id, title FROM cleaned WHERE length(title) = 8")
def length_filter(spark, folder):
    return cleaning.where_length(star_input(spark, folder), "title", 8).select("id", "title")


@query("extreme_length_rows", """SELECT doc_id, length(text) AS n FROM documents
WHERE length(text) IN ((SELECT min(length(text)) FROM documents), (SELECT max(length(text)) FROM documents))""")
def extreme_length_rows(spark, folder):
    df = cleaning.where_extreme_length(table(spark, folder, "documents"), "text")
    return df.select("doc_id", F.length("text").alias("n"))


@query("bad_dates", f"""WITH {RAW_SQL}
SELECT id, title, release_date FROM raw WHERE try_strptime(release_date, '%Y-%m-%d') IS NULL""")
def bad_dates(spark, folder):
    return raw_catalog(spark, folder).filter(lists.is_bad_date("release_date")).select("id", "title", "release_date")


# --- checks -------------------------------------------------------------------------------


def _planted(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with planted blanks, nulls, replacement characters and repeated ids."""
    docs = table(spark, folder, "documents")
    text = (
        F.when(F.col("doc_id") % 50 == 0, F.lit(" \t "))
        .when(F.col("doc_id") % 33 == 0, F.concat("text", F.lit(checks.REPLACEMENT_CHARACTER)))
        .when(F.col("doc_id") % 41 == 0, F.lit(None)).otherwise(F.col("text"))
    )
    movie_id = F.when(F.col("doc_id") % 3 == 0, F.lit(0)).otherwise(F.col("doc_id"))
    return docs.select(movie_id.alias("movie_id"), F.col("source").alias("title"), "lang", text.alias("overview"), "doc_id")


_PLANTED_SQL = """planted AS (SELECT CASE WHEN doc_id % 3 = 0 THEN 0 ELSE doc_id END AS movie_id, source AS title, lang,
  CASE WHEN doc_id % 50 = 0 THEN ' ' || chr(9) || ' ' WHEN doc_id % 33 = 0 THEN text || chr(65533) WHEN doc_id % 41 = 0 THEN NULL ELSE text END AS overview,
  doc_id FROM documents)"""


@query("check_nulls", f"""WITH {_PLANTED_SQL}
SELECT 'null' AS "check", 'overview' AS column_name, count(*) - count(overview) AS violations FROM planted UNION ALL
SELECT 'null', 'title', count(*) - count(title) FROM planted""")
def check_nulls(spark, folder):
    return checks.check_nulls(_planted(spark, folder), ["overview", "title"])


@query("check_blank", f"""WITH {_PLANTED_SQL}
SELECT 'blank' AS "check", 'overview' AS column_name, count(*) FILTER (regexp_replace(overview, '\\s', '', 'g') = '') AS violations FROM planted UNION ALL
SELECT 'blank', 'title', count(*) FILTER (regexp_replace(title, '\\s', '', 'g') = '') FROM planted""")
def check_blank(spark, folder):
    return checks.check_blank(_planted(spark, folder), ["overview", "title"])


@query("check_replacement_char", f"""WITH {_PLANTED_SQL}
SELECT 'replacement_char' AS "check", 'overview' AS column_name, count(*) FILTER (contains(overview, chr(65533))) AS violations FROM planted UNION ALL
SELECT 'replacement_char', 'title', count(*) FILTER (contains(title, chr(65533))) FROM planted UNION ALL
SELECT 'replacement_char', 'movie_id', 0""")
def check_replacement_char(spark, folder):
    return checks.check_replacement_char(_planted(spark, folder), ["overview", "title", "movie_id"])


@query("check_utf8", """SELECT 'utf8' AS "check", 'text' AS column_name, count(*) FILTER (doc_id % 25 = 0) AS violations FROM documents""")
def check_utf8(spark, folder):
    """Every 25th text gets a byte that is not UTF-8."""
    docs = table(spark, folder, "documents")
    broken = F.concat(F.col("text").cast("binary"), F.unhex(F.lit("FF"))).cast("string")
    return checks.check_valid_utf8(docs.withColumn("text", F.when(F.col("doc_id") % 25 == 0, broken).otherwise(F.col("text"))), ["text"])


@query("check_duplicates", f"""WITH {_PLANTED_SQL}
SELECT movie_id, doc_id, title FROM planted WHERE movie_id IN (SELECT movie_id FROM planted GROUP BY 1 HAVING count(*) > 1)""")
def check_duplicates(spark, folder):
    return checks.duplicate_key_rows(_planted(spark, folder), "movie_id", ["doc_id"]).select("movie_id", "doc_id", "title")


@query("duplicate_keys", f"""WITH {_PLANTED_SQL}
SELECT title, lang, count(*) AS rows FROM planted GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_keys(spark, folder):
    return checks.duplicate_keys(_planted(spark, folder), ["title", "lang"])


@query("check_schema", f"""WITH {_PLANTED_SQL}
SELECT 'columns' AS "check", 0 AS violations UNION ALL SELECT 'type', 0 UNION ALL
SELECT 'null', count(*) - count(overview) FROM planted UNION ALL
SELECT 'unique', (SELECT sum(n) FROM (SELECT count(*) AS n FROM planted GROUP BY movie_id HAVING count(*) > 1)) UNION ALL
SELECT 'blank', count(*) FILTER (regexp_replace(overview, '\\s', '', 'g') = '') FROM planted UNION ALL
SELECT 'replacement_char', count(*) FILTER (contains(overview, chr(65533))) FROM planted""")
def check_schema(spark, folder):
    """All export checks in order, summed per check, on a five-column export."""
    expected = ["movie_id", "title", "genres", "keywords", "overview"]
    df = _planted(spark, folder).select(
        "movie_id", "title", F.col("lang").alias("genres"), F.col("title").alias("keywords"), "overview"
    )
    out = None
    for report in checks.export_checks(df, expected):
        out = report if out is None else out.unionByName(report)
    return out.groupBy("check").agg(F.sum("violations").alias("violations"))


@query("check_foreign_keys", """SELECT 'foreign_key' AS "check", 'lineitem.l_partkey' AS column_name, count(*) AS violations
FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)""")
def check_foreign_keys(spark, folder):
    parents = table(spark, folder, "part").filter("p_size > 10")
    return checks.check_foreign_key(table(spark, folder, "lineitem"), "l_partkey", parents, "p_partkey", "lineitem.l_partkey")


@query("check_primary_key", f"""WITH {_PLANTED_SQL}
SELECT 'unique' AS "check", 'movie_id' AS column_name, sum(n) AS violations FROM (SELECT count(*) AS n FROM planted GROUP BY movie_id HAVING count(*) > 1)
UNION ALL SELECT 'key_null', 'movie_id', 0""")
def check_primary_key(spark, folder):
    return checks.check_primary_key(_planted(spark, folder), "movie_id")


def _key_counts_sql() -> str:
    """Expected findings on a star whose genre dimension lacks one value and whose fact repeats rows."""
    rows = [f"SELECT 'unique' AS \"check\", '{t}.{k}' AS column_name, {'(SELECT 2 * count(*) FROM cleaned WHERE id % 10 = 0)' if t == 'fact_movie' else 0} AS violations"
            f" UNION ALL SELECT 'key_null', '{t}.{k}', 0" for t, k in jobs.schemas.PRIMARY_KEYS.items()]
    rows += [f"SELECT 'foreign_key', '{c}.{ck}', " + (
        "(SELECT count(*) FROM (SELECT trim(unnest(string_split(genres, ','))) AS v FROM cleaned) WHERE v = 'red')" if p == "dim_genre"
        else "0") for c, ck, p, _ in jobs.schemas.FOREIGN_KEYS]
    return f"WITH {STAR_INPUT_SQL} " + " UNION ALL ".join(rows)


@query("check_star_keys", _key_counts_sql())
def check_star_keys(spark, folder):
    tables = {name: keep(t, name) for name, t in star_built(spark, folder).items()}
    tables["dim_genre"] = tables["dim_genre"].filter("genre_name <> 'red'")
    fact = tables["fact_movie"]
    tables["fact_movie"] = fact.unionByName(fact.filter("movie_id % 10 = 0"))
    return checks.check_star(tables)
