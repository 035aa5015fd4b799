"""Writers and readers: each query writes a whole table to the shared folder and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from marquee import schemas
from marquee.plans import jobs
from marquee.plans.queries_cleaning import WHITELIST, _countries, raw_catalog
from marquee.plans.queries_star import STAR_INPUT_SQL, _list_sql, star_input
from marquee.plans.registry import CHECKS, query
from marquee.session import scratch_path
from marquee.sources import io
from marquee.sources.derived import table, vectors

_DOCS_SQL = "SELECT doc_id, text, lang, source, n_chars FROM documents"
_DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@query("parquet_roundtrip", _DOCS_SQL)
def parquet_roundtrip(spark, folder):
    path = scratch_path(spark, "parquet")
    io.write_parquet(table(spark, folder, "documents"), path)
    return io.read_parquet(spark, path)


@query("csv_roundtrip", _DOCS_SQL)
def csv_roundtrip(spark, folder):
    """Texts with quotes, commas and line breaks survive."""
    path = scratch_path(spark, "csv")
    io.write_csv(table(spark, folder, "documents"), path)
    return io.read_csv(spark, path, _DOCS)


@query("export_shards", _DOCS_SQL)
def export_shards(spark, folder):
    path = scratch_path(spark, "shards")
    io.export_shards(table(spark, folder, "documents"), path, shards=4)
    return io.read_parquet(spark, path)


@query("merge_shards", _DOCS_SQL)
def merge_shards(spark, folder):
    path, merged = scratch_path(spark, "shards"), scratch_path(spark, "merged")
    io.export_shards(table(spark, folder, "documents"), path, shards=4)
    io.merge_shards(spark, f"{path}/*.parquet", merged)
    return io.read_parquet(spark, merged)


@query("merge_csv_shards", _DOCS_SQL)
def merge_csv_shards(spark, folder):
    path, merged = scratch_path(spark, "shards"), scratch_path(spark, "merged")
    io.export_shards(table(spark, folder, "documents"), path, "csv", shards=4)
    merge_pattern = f"{path}/*.csv"
    io.merge_shards(spark, merge_pattern, merged, "csv")
    return io.read_csv(spark, merged, _DOCS)


@query("slices", """SELECT o_orderkey, CASE WHEN p < 5 THEN 'head' ELSE 'tail' END AS part FROM (
  SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS p FROM orders) WHERE p >= 1""")
def slices(spark, folder):
    """Positions 1 to 4 and from 5 on, written apart and read together."""
    orders = table(spark, folder, "orders").select("o_orderkey")
    path = scratch_path(spark, "slices")
    io.write_parquet(io.positional_slice(orders, "o_orderkey", 1, 5), f"{path}/part=head")
    io.write_parquet(io.positional_slice(orders, "o_orderkey", 5), f"{path}/part=tail")
    return io.read_parquet(spark, path).select("o_orderkey", "part")


_COUNTS_SQL = " UNION ALL ".join(
    ["SELECT 'dim_movie' AS name, count(*) AS rows FROM cleaned", "SELECT 'fact_movie', count(*) FROM cleaned"] + [
        f"SELECT 'dim_{d.source}', count(DISTINCT v) FROM ({_list_sql(d.source)}) UNION ALL "
        f"SELECT 'bridge_{d.source}', count(*) FROM ({_list_sql(d.source)})" for d in schemas.LIST_DIMENSIONS])


def _star_folder(spark, folder) -> tuple[str, dict[str, int]]:
    """The derived catalog written as cleaned, and the transform job run on it: folder and counts."""
    clean_path, star_path = scratch_path(spark, "clean"), scratch_path(spark, "star")
    io.write_parquet(star_input(spark, folder), clean_path)
    return star_path, jobs.transform_job(spark, clean_path, star_path)


@query("observed_row_counts", f"WITH {STAR_INPUT_SQL} {_COUNTS_SQL}")
def observed_row_counts(spark, folder):
    """All 12 star tables written by the transform job; the counts come from the writes."""
    _, counts = _star_folder(spark, folder)
    return spark.createDataFrame(list(counts.items()), "name string, rows bigint")


def _own_database(spark) -> str:
    """A database whose tables lie in the shared folder."""
    path = scratch_path(spark, "database")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


_LOADED = {table: (place, source) for place, (source, table) in enumerate(schemas.LOAD_ORDER.items(), 1)}


@query("load_star_tables", f"WITH {STAR_INPUT_SQL}, counts AS ({_COUNTS_SQL}) " + " UNION ALL ".join(
    f"SELECT '{t}' AS name, {place} AS place, rows, {len(schemas.STAR_SCHEMAS[t])} AS columns FROM counts WHERE name = '{source}'"
    for t, (place, source) in _LOADED.items()))
def load_star_tables(spark, folder):
    """The load job: 12 folders into tables in their order, each checked, then scanned."""
    star_path, _ = _star_folder(spark, folder)
    name = _own_database(spark)
    checked = jobs.load_job(spark, star_path, name)
    out = None
    for place, (loaded, sample) in enumerate(checked.items(), 1):
        part = io.read_table(spark, f"{name}.{loaded}").agg(F.count("*").alias("rows")).select(
            F.lit(loaded).alias("name"), F.lit(place).alias("place"), "rows", F.lit(len(sample)).alias("columns"))
        out = part if out is None else out.unionByName(part)
    return out


@query("append_table", "SELECT o_orderkey, o_custkey FROM orders UNION ALL SELECT -1, c_custkey FROM customer")
def append_table(spark, folder):
    """Two appends to one table, then a table scan."""
    name = f"{_own_database(spark)}.grown"
    orders = table(spark, folder, "orders").select(*[F.col(c).cast("bigint").alias(c) for c in ("o_orderkey", "o_custkey")])
    more = table(spark, folder, "customer").select(
        F.lit(-1).cast("bigint").alias("o_orderkey"), F.col("c_custkey").cast("bigint").alias("o_custkey"))
    io.append_table(orders, name)
    io.append_table(more, name)
    return io.read_table(spark, name)


@query("inline_rows", """SELECT r_name AS name, CAST(w AS DOUBLE) AS weight, count(*) AS customers
FROM (VALUES ('ASIA', 0.5), ('EUROPE', 2.0)) t(k, w) JOIN region ON r_name = k JOIN nation ON n_regionkey = r_regionkey
JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2 UNION ALL
SELECT l, NULL, count(c_custkey) FROM (VALUES ('BUILDING'), ('no such segment')) s(l) LEFT JOIN customer ON c_mktsegment = l GROUP BY 1""")
def inline_rows(spark, folder):
    """Rows and lines given in the program, joined with the customers."""
    weights = io.inline_rows(spark, [("ASIA", 0.5), ("EUROPE", 2.0)], "name string, weight double")
    segments = io.inline_lines(spark, ["BUILDING", "no such segment"])
    customer = table(spark, folder, "customer")
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).join(F.broadcast(weights), F.col("r_name") == F.col("name"))
    by_region = customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("name", "weight").agg(F.count("*").alias("customers"))
    sizes = customer.groupBy("c_mktsegment").agg(F.count("*").alias("customers"))
    by_segment = segments.join(sizes, F.col("value") == F.col("c_mktsegment"), "left").select(
        F.col("value").alias("name"), F.lit(None).cast("double").alias("weight"), F.coalesce("customers", F.lit(0)).alias("customers"))
    return by_region.unionByName(by_segment)


@query("missing_inputs", """SELECT 'documents' AS name, count(*) AS rows, NULL AS message FROM documents UNION ALL
SELECT 'pages', count(*), NULL FROM pages UNION ALL SELECT 'no_such_table', 0, 'File not found: no_such_table'""")
def missing_inputs(spark, folder):
    """Inputs are looked up before they are read; a missing one is a message, not a failed read."""
    out = None
    for name in ("documents", "pages", "no_such_table"):
        try:
            read = io.read_parquet(spark, io.require_path(spark, f"{folder}/{name}.parquet"))
            part = read.agg(F.count("*").alias("rows")).withColumn("message", F.lit(None).cast("string"))
        except io.MissingInput as e:
            message = str(e).replace(f"{folder}/", "").removesuffix(".parquet")
            part = spark.range(1).select(F.lit(0).cast("bigint").alias("rows"), F.lit(message).alias("message"))
        part = part.select(F.lit(name).alias("name"), "rows", "message")
        out = part if out is None else out.unionByName(part)
    return out


@query("vector_table", """SELECT vec_id AS id, CAST(generate_subscripts(embedding, 1) AS BIGINT) AS pos,
CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings""")
def vector_table(spark, folder):
    """A vector table written, found and read again: every position of every vector."""
    path = scratch_path(spark, "vectors")
    io.write_vectors(vectors(spark, folder), path)
    return io.read_vectors(spark, path).select("id", F.posexplode("vector").alias("at", "v")).select(
        "id", (F.col("at") + 1).cast("bigint").alias("pos"), F.col("v").cast("double").alias("value"))


@query("etl_to_enriched_export", CHECKS["clean_catalog"])
def etl_to_enriched_export(spark, folder):
    """The whole run: raw CSV, cleaning job, star tables, enriched export with its checks.

    The export is brought back to the columns of the cleaned catalog to be compared with it.
    """
    raw_path, list_path = scratch_path(spark, "raw"), scratch_path(spark, "countries")
    clean_path, star_path, out = scratch_path(spark, "clean"), scratch_path(spark, "star"), scratch_path(spark, "export")
    io.write_csv(raw_catalog(spark, folder).select(*schemas.RAW_COLUMNS), raw_path)
    io.write_csv(_countries(spark, folder), list_path)
    raw = io.read_raw_catalog(spark, raw_path)
    countries = io.read_csv(spark, list_path, schemas.COUNTRY_LIST)
    io.write_parquet(jobs.clean_catalog(raw, countries, WHITELIST), clean_path)
    jobs.transform_job(spark, clean_path, star_path)
    jobs.export_job(spark, jobs.star_from_folder(spark, star_path), out)
    export = io.read_parquet(spark, out)
    cleaned = io.read_parquet(spark, clean_path)
    return export.select(
        F.col("movie_id").alias("id"), "status", "title", F.col("adult").cast("bigint").alias("adult"), "overview",
        "original_language", F.col("release_date").cast("string").alias("release_date"), "vote_count", "vote_average",
        "popularity", "budget", "revenue", F.col("runtime").cast("int").alias("runtime"),
        F.col("languages").alias("spoken_languages"), F.col("companies").alias("production_companies"),
        F.col("countries").alias("production_countries"),
    ).join(cleaned.select("id", "genres", "keywords"), "id")
