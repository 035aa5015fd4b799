"""Profiles and outliers on the derived catalog, documents, pages and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.operators import cleaning, outliers, profiling
from marquee.plans.queries_cleaning import RAW_SQL, raw_catalog
from marquee.plans.queries_star import STAR_INPUT_SQL, star_input
from marquee.plans.registry import query
from marquee.schemas import COLUMN_KINDS
from marquee.sources.derived import RATINGS_SQL, ratings, table

NUMBERS = ["vote_average", "vote_count", "revenue", "runtime", "budget", "popularity"]


def _rounded(df, *columns, places: int = 6):
    return df.withColumns({c: F.round(c, places) for c in columns})


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


@query("row_count", "SELECT count(*) AS rows FROM lineitem")
def row_count(spark, folder):
    return profiling.row_count(table(spark, folder, "lineitem"))


@query("null_counts", f"WITH {RAW_SQL} " + _union(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls, count({c}) AS non_nulls FROM raw"
    for c in ["id", "title", "vote_count", "release_date", "poster_path", "spoken_languages"]))
def null_counts(spark, folder):
    return profiling.null_counts(
        raw_catalog(spark, folder), ["id", "title", "vote_count", "release_date", "poster_path", "spoken_languages"])


@query("null_report", f"WITH {RAW_SQL} SELECT * FROM (" + _union(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls, round((count(*) - count({c})) * 100.0 / count(*), 6) AS percent, 'string' AS kind FROM raw"
    for c in ["vote_count", "release_date", "poster_path", "spoken_languages"]) + ") WHERE nulls > 0")
def null_report(spark, folder):
    return _rounded(profiling.null_report(raw_catalog(spark, folder)), "percent")


@query("completeness", f"""WITH {RAW_SQL} SELECT count(*) - count(poster_path) AS nulls,
  count(*) FILTER (poster_path LIKE '%.jpg') AS matching, count(*) AS rows,
  CAST(count(*) - count(poster_path) + count(*) FILTER (poster_path LIKE '%.jpg') = count(*) AS INT) AS complete FROM raw""")
def completeness(spark, folder):
    return profiling.completeness(raw_catalog(spark, folder), "poster_path", ".jpg")


_TITLES = "(SELECT title, genres, keywords FROM cleaned)"


@query("dup_report", f"""WITH {STAR_INPUT_SQL}, g AS (SELECT count(*) AS n FROM {_TITLES} GROUP BY title, genres, keywords)
SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n - 1) AS BIGINT) AS surplus, count(*) FILTER (n > 1) AS groups FROM g""")
def dup_report(spark, folder):
    return profiling.duplicate_report(star_input(spark, folder).select("title", "genres", "keywords"))


@query("dup_rows", f"""WITH {STAR_INPUT_SQL}
SELECT title, genres, keywords, count(*) AS copies FROM {_TITLES} GROUP BY title, genres, keywords HAVING count(*) > 1""")
def dup_rows(spark, folder):
    return profiling.duplicate_rows(star_input(spark, folder).select("title", "genres", "keywords"))


@query("drop_equal_rows", f"WITH {STAR_INPUT_SQL} SELECT DISTINCT title, genres, keywords FROM cleaned")
def drop_equal_rows(spark, folder):
    return cleaning.drop_equal_rows(star_input(spark, folder).select("title", "genres", "keywords"))


@query("length_stats", "SELECT min(length(text)) AS shortest, max(length(text)) AS longest FROM documents")
def length_stats(spark, folder):
    return profiling.length_range(table(spark, folder, "documents"), "text")


@query("date_span", "SELECT CAST(CAST(min(l_shipdate) AS DATE) AS VARCHAR) AS least, CAST(CAST(max(l_shipdate) AS DATE) AS VARCHAR) AS most FROM lineitem")
def date_span(spark, folder):
    line = table(spark, folder, "lineitem").withColumn("d", F.col("l_shipdate").cast("date"))
    return profiling.value_range(line, "d").select(F.col("least").cast("string"), F.col("most").cast("string"))


@query("length_histogram", "SELECT length(url) AS length, count(*) AS rows FROM pages GROUP BY 1")
def length_histogram(spark, folder):
    return profiling.length_histogram(table(spark, folder, "pages"), "url")


@query("value_counts", "SELECT event_type AS value, count(*) AS rows FROM events GROUP BY 1")
def value_counts(spark, folder):
    return profiling.value_counts(table(spark, folder, "events"), "event_type")


@query("value_counts_list", f"WITH {STAR_INPUT_SQL} SELECT trim(v) AS value, count(*) AS rows FROM (SELECT unnest(string_split(production_companies, ',')) AS v FROM cleaned) GROUP BY 1")
def value_counts_list(spark, folder):
    return profiling.list_value_counts(star_input(spark, folder), "production_companies")


@query("distinct_list_values", f"WITH {STAR_INPUT_SQL} SELECT DISTINCT trim(v) AS value FROM (SELECT unnest(string_split(keywords, ',')) AS v FROM cleaned)")
def distinct_list_values(spark, folder):
    return profiling.distinct_list_values(star_input(spark, folder), "keywords")


@query("nunique", f"WITH {STAR_INPUT_SQL} " + _union(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS uniques FROM cleaned" for c in ["title", "keywords", "spoken_languages", "runtime"]))
def nunique(spark, folder):
    return profiling.unique_counts(star_input(spark, folder), ["title", "keywords", "spoken_languages", "runtime"])


_DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount"]
_NAN_SQL = "(SELECT l_quantity, l_extendedprice, CASE WHEN l_linenumber = 7 THEN CAST('NaN' AS DOUBLE) WHEN l_linenumber = 6 THEN NULL ELSE l_discount END AS l_discount FROM lineitem)"


@query("describe", _union(
    f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
    min({c}) AS least, max({c}) AS most, round(quantile_cont({c}, 0.25), 6) AS q1, round(quantile_cont({c}, 0.5), 6) AS median,
    round(quantile_cont({c}, 0.75), 6) AS q3 FROM {_NAN_SQL} WHERE NOT isnan({c})""" for c in _DESCRIBED))
def describe(spark, folder):
    """The discount is NaN on some lines and null on others; neither is a value."""
    line = table(spark, folder, "lineitem").withColumn(
        "l_discount", F.when(F.col("l_linenumber") == 7, F.lit(float("nan"))).when(F.col("l_linenumber") != 6, F.col("l_discount")))
    return _rounded(profiling.describe(line, _DESCRIBED), "mean", "std", "q1", "median", "q3")


# every column of the catalog and its type
_PROFILED = {
    "id": "bigint", "title": "string", "status": "string", "release_date": "date", "adult": "boolean",
    "original_language": "string", "overview": "string", "vote_average": "double", "popularity": "double",
    "vote_count": "bigint", "budget": "bigint", "revenue": "bigint", "runtime": "int", "genres": "string",
    "keywords": "string", "production_companies": "string", "spoken_languages": "string", "production_countries": "string",
}
_NUMBER_KINDS = ("bigint", "int", "double")


@query("quality_profile", f"WITH {STAR_INPUT_SQL} " + _union(
    f"""SELECT '{c}' AS column_name, '{k}' AS kind, count(*) AS rows, count(*) - count({c}) AS nulls, count({c}) AS non_nulls,
    {f'round(avg({c}), 6)' if k in _NUMBER_KINDS else 'NULL'} AS mean, {f'CAST(min({c}) AS DOUBLE)' if k in _NUMBER_KINDS else 'NULL'} AS least,
    {f'CAST(max({c}) AS DOUBLE)' if k in _NUMBER_KINDS else 'NULL'} AS most, count(DISTINCT {c}) AS uniques, 0 AS surplus_rows FROM cleaned"""
    for c, k in _PROFILED.items()))
def quality_profile(spark, folder):
    return _rounded(profiling.quality_profile(star_input(spark, folder).select(*_PROFILED)), "mean")


@query("column_reports", f"WITH {STAR_INPUT_SQL} " + _union(
    f"SELECT '{c}' AS column_name, '{COLUMN_KINDS.get(c, 'other')}' AS kind, count(*) - count({c}) AS nulls, count({c}) AS non_nulls FROM cleaned"
    for c in _PROFILED))
def column_reports(spark, folder):
    return profiling.column_reports(star_input(spark, folder).select(*_PROFILED))


@query("correlation_matrix", f"""WITH {STAR_INPUT_SQL}, n AS (SELECT CASE WHEN id % 11 = 0 THEN CAST('NaN' AS DOUBLE) ELSE vote_average END AS vote_average,
  vote_count, CASE WHEN id % 7 <> 0 THEN revenue END AS revenue, runtime, budget, popularity FROM cleaned) """ + _union(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS correlation FROM n WHERE NOT isnan(CAST({a} AS DOUBLE)) AND NOT isnan(CAST({b} AS DOUBLE))"
    for a in NUMBERS for b in NUMBERS))
def correlation_matrix(spark, folder):
    df = star_input(spark, folder).withColumns({
        "revenue": F.when(F.col("id") % 7 != 0, F.col("revenue")),
        "vote_average": F.when(F.col("id") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("vote_average"))})
    return _rounded(profiling.correlation_matrix(df, NUMBERS), "correlation")


@query("histogram30", """WITH e AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
c AS (SELECT least(29, CAST(floor((o_totalprice - lo) / ((hi - lo) / 30)) AS INT)) AS bin, count(*) AS rows FROM orders, e GROUP BY 1)
SELECT b.bin, round(lo + b.bin * ((hi - lo) / 30), 6) AS starts, coalesce(c.rows, 0) AS rows
FROM (SELECT unnest(range(30)) AS bin) b CROSS JOIN e LEFT JOIN c ON b.bin = c.bin""")
def histogram30(spark, folder):
    return _rounded(profiling.histogram(table(spark, folder, "orders"), "o_totalprice", 30), "starts")


_BOXED = ["value", "user_id"]


@query("box_numbers", _union(
    f"""SELECT '{c}' AS column_name, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
      round(q1 - 1.5 * (q3 - q1), 6) AS lower, round(q3 + 1.5 * (q3 - q1), 6) AS upper,
      round(min({c}) FILTER ({c} >= q1 - 1.5 * (q3 - q1)), 6) AS low_whisker, round(max({c}) FILTER ({c} <= q3 + 1.5 * (q3 - q1)), 6) AS high_whisker,
      count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1)) AS below, count(*) FILTER ({c} > q3 + 1.5 * (q3 - q1)) AS above
    FROM events, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS q3 FROM events)
    GROUP BY q1, median, q3""" for c in _BOXED))
def box_numbers(spark, folder):
    return _rounded(profiling.box_numbers(table(spark, folder, "events"), _BOXED),
                    "q1", "median", "q3", "lower", "upper", "low_whisker", "high_whisker")


@query("word_count", "SELECT word, count(*) AS rows FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY 1")
def word_count(spark, folder):
    return profiling.word_count(table(spark, folder, "documents"), "text")


@query("url_schemes", r"SELECT regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*:/{0,2})', 1) AS scheme, count(*) AS rows FROM pages GROUP BY 1 HAVING scheme <> ''")
def url_schemes(spark, folder):
    return profiling.scheme_counts(table(spark, folder, "pages"), "url")


@query("file_extensions", r"SELECT regexp_extract(url, '\.([a-zA-Z0-9]+)$', 1) AS extension, count(*) AS rows FROM pages GROUP BY 1 HAVING extension <> ''")
def file_extensions(spark, folder):
    return profiling.extension_counts(table(spark, folder, "pages"), "url")


@query("sample_rows", "SELECT doc_id, lang FROM documents ORDER BY md5('42|' || doc_id), doc_id LIMIT 5")
def sample_rows(spark, folder):
    return profiling.sample_rows(table(spark, folder, "documents").select("doc_id", "lang"), "doc_id", 5)


@query("top_categories", f"WITH {STAR_INPUT_SQL} SELECT title AS value, count(*) AS rows FROM cleaned GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def top_categories(spark, folder):
    return profiling.top_categories(star_input(spark, folder), "title", 10)


@query("shortest_titles", f"WITH {STAR_INPUT_SQL} SELECT id, title, length(title) AS title_length FROM cleaned ORDER BY 3, 1 LIMIT 10")
def shortest_titles(spark, folder):
    df = star_input(spark, folder).select("id", "title", F.length("title").alias("title_length"))
    return df.orderBy("title_length", "id").limit(10)


@query("interactions_per_user", f"WITH {RATINGS_SQL} SELECT user_id, count(*) AS interactions FROM ratings GROUP BY 1")
def interactions_per_user(spark, folder):
    return profiling.rows_per_user(ratings(spark, folder))


# --- outliers -----------------------------------------------------------------------------

_FENCED = ["l_extendedprice", "l_quantity"]
_LIMITS_SQL = _union(
    f"""SELECT '{c}' AS column_name, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3,
    quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS iqr,
    quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lower,
    quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS upper FROM lineitem""" for c in _FENCED)


@query("iqr_limits", f"SELECT column_name, round(q1, 6) AS q1, round(q3, 6) AS q3, round(iqr, 6) AS iqr, round(lower, 6) AS lower, round(upper, 6) AS upper FROM ({_LIMITS_SQL})")
def iqr_limits(spark, folder):
    return _rounded(outliers.iqr_limits(table(spark, folder, "lineitem"), _FENCED), "q1", "q3", "iqr", "lower", "upper")


@query("iqr_filter", """WITH l AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT event_id, value FROM events, l WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""")
def iqr_filter(spark, folder):
    return outliers.iqr_filter(table(spark, folder, "events"), ["value"]).select("event_id", "value")


@query("zscore_filter", """WITH m AS (SELECT avg(value) AS mv, stddev_pop(value) AS sv, avg(user_id) AS mu, stddev_pop(user_id) AS su FROM events)
SELECT event_id, value FROM events, m WHERE abs(value - mv) / sv < 3 AND abs(user_id - mu) / su < 3""")
def zscore_filter(spark, folder):
    return outliers.zscore_filter(table(spark, folder, "events"), ["value", "user_id"]).select("event_id", "value")


def _forest_sql(trees: int = outliers.TREES, rows: int = outliers.TREE_ROWS, seed: int = 42) -> str:
    """The same trees in SQL: samples and cuts from md5, one group of CTEs a level."""
    depth = (rows - 1).bit_length()
    parts = [f"""vals AS MATERIALIZED (SELECT event_id AS k, CAST(value AS DOUBLE) AS v FROM events WHERE value IS NOT NULL),
pool AS MATERIALIZED (SELECT k, v FROM vals ORDER BY md5('{seed}|' || k), k LIMIT {trees * rows}),
dealt AS MATERIALIZED (SELECT tree, v FROM (SELECT tree, v, row_number() OVER (PARTITION BY tree ORDER BY md5('{seed}|' || tree || '|' || k), k) AS r
  FROM pool, (SELECT unnest(range({trees})) AS tree)) WHERE r <= {rows}),
size AS (SELECT least({rows}, (SELECT count(*) FROM pool)) AS n),
limits AS (SELECT CAST(ceil(log2(greatest(n, 2))) AS INT) AS most FROM size),
at0 AS (SELECT tree, 1 AS node, v FROM dealt)"""]
    path = "CASE WHEN n <= 1 THEN 0 WHEN n = 2 THEN 1 ELSE 2 * (ln(n - 1) + 0.5772156649015329) - 2 * (n - 1) / CAST(n AS DOUBLE) END"
    for d in range(depth + 1):
        before = "SELECT tree, node, CAST('-inf' AS DOUBLE) AS start FROM (SELECT DISTINCT tree, 1 AS node FROM at0)" if d == 0 else f"""
  SELECT tree, 2 * node AS node, start FROM cuts{d - 1} UNION ALL SELECT tree, 2 * node + 1, cut FROM cuts{d - 1}"""
        parts.append(f"""from{d} AS MATERIALIZED ({before}),
nodes{d} AS MATERIALIZED (SELECT tree, node, start, n, lo, hi, {d} >= (SELECT most FROM limits) OR n <= 1 OR lo = hi AS leaf
  FROM from{d} JOIN (SELECT tree, node, count(*) AS n, min(v) AS lo, max(v) AS hi FROM at{d} GROUP BY tree, node) USING (tree, node)),
cuts{d} AS MATERIALIZED (SELECT tree, node, start, lo + CAST(CAST('0x' || substr(md5('{seed}|' || tree || '|' || node), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 * (hi - lo) AS cut
  FROM nodes{d} WHERE NOT leaf),
at{d + 1} AS MATERIALIZED (SELECT tree, 2 * node + CAST(v > cut AS INT) AS node, v FROM at{d} JOIN cuts{d} USING (tree, node))""")
    leaves = " UNION ALL ".join(f"SELECT tree, start, {d} + {path} AS depth FROM nodes{d} WHERE leaf" for d in range(depth + 1))
    parts.append(f"""steps AS MATERIALIZED (SELECT start, depth - coalesce(lag(depth) OVER (PARTITION BY tree ORDER BY start), 0) AS more FROM ({leaves})),
paths AS MATERIALIZED (SELECT start, sum(more) OVER (ORDER BY start RANGE UNBOUNDED PRECEDING) AS total FROM (SELECT start, sum(more) AS more FROM steps GROUP BY start)),
scored AS MATERIALIZED (SELECT k, v, round(pow(2, -(total / {trees}) / greatest({path}, 1e-12)), 9) AS score FROM vals ASOF JOIN paths ON v > start, size)""")
    return ",\n".join(parts)


@query("isolation_forest_filter", f"""WITH {_forest_sql()}
SELECT k AS event_id, v AS value FROM scored WHERE score <= (SELECT quantile_cont(score, 0.95) FROM scored)""")
def isolation_forest_filter(spark, folder):
    df = table(spark, folder, "events").select("event_id", "value")
    return outliers.isolation_forest_filter(df, ["value"], "event_id")


@query("isolation_scores", f"WITH {_forest_sql()} SELECT k AS event_id, round(score, 6) AS score FROM scored")
def isolation_scores(spark, folder):
    df = table(spark, folder, "events").select("event_id", "value")
    return outliers.isolation_scores(df, "value", "event_id").select("event_id", F.round("score", 6).alias("score"))
