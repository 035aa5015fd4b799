"""Catalog, ratings and vectors derived from the supplied tables.

The DataFrame form is what the registered queries run on; the SQL form of the same recipe is the
head of every check query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    """One row per part, dressed as a movie.

    Lines are pre-aggregated to one row per part, for the sums and for the sets of suppliers and nations, so a
    part that holds most lines shrinks before it is shuffled. The sets need no distinct pairs ahead of them.
    """
    part = table(spark, folder, "part")
    line = table(spark, folder, "lineitem")
    supplier = table(spark, folder, "supplier")
    nation = table(spark, folder, "nation")
    sums = line.groupBy(F.col("l_partkey").alias("sum_part")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("revenue"),
        F.count("*").alias("vote_count"),
        (F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double") / F.count("*")).alias("vote_average"),
        F.min("l_shipdate").cast("date").alias("release_date"),
    )
    makers = (
        line.select("l_partkey", "l_suppkey")
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("l_partkey").alias("made_part"))
        .agg(
            F.array_join(F.sort_array(F.collect_set("s_name")), ", ").alias("production_companies"),
            F.array_join(F.sort_array(F.collect_set("n_name")), ", ").alias("production_countries"),
        )
    )
    return (
        part.join(sums, F.col("p_partkey") == F.col("sum_part"), "left")
        .join(makers, F.col("p_partkey") == F.col("made_part"), "left")
        .select(
            F.col("p_partkey").alias("id"),
            F.col("p_name").alias("title"),
            F.replace("p_name", F.lit(" "), F.lit(", ")).alias("genres"),
            F.concat("p_type", F.lit(", "), "p_brand").alias("keywords"),
            F.col("p_retailprice").alias("budget"),
            F.col("p_size").alias("runtime"),
            "revenue", "vote_count", "vote_average", "release_date",
            "production_companies", "production_countries",
        )
    )


CATALOG_SQL = """
sums AS (
  SELECT l_partkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
         count(*) AS vote_count,
         CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS vote_average,
         CAST(min(l_shipdate) AS DATE) AS release_date
  FROM lineitem GROUP BY l_partkey),
makers AS (
  SELECT l_partkey, string_agg(DISTINCT s_name, ', ' ORDER BY s_name) AS production_companies,
         string_agg(DISTINCT n_name, ', ' ORDER BY n_name) AS production_countries
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY l_partkey),
catalog AS (
  SELECT p_partkey AS id, p_name AS title, replace(p_name, ' ', ', ') AS genres,
         p_type || ', ' || p_brand AS keywords, p_retailprice AS budget, p_size AS runtime,
         revenue, vote_count, vote_average, release_date, production_companies, production_countries
  FROM part LEFT JOIN sums ON p_partkey = sums.l_partkey
       LEFT JOIN makers ON p_partkey = makers.l_partkey)
"""


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer and part with the largest quantity as the rating."""
    line = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return (
        line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("movie_id"))
        .agg(F.max("l_quantity").alias("rating"))
    )


RATINGS_SQL = """
ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS movie_id, max(l_quantity) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)
"""


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label"
    )
