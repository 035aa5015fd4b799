"""What the physical plans must look like."""

import os

import pytest
from pyspark.sql import functions as F

from compare import DATA
from marquee.functions.spread import BROADCAST_ROWS
from marquee.operators import cleaning, profiling, star, terms
from marquee.plans.registered import QUERIES

FOLDER = f"{DATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["isin_filter"](spark, FOLDER))
    assert "PushedFilters: [In(lang" in text
    assert "ReadSchema: struct<doc_id:bigint,lang:string,source:string>" in text


def test_value_counts_read_one_column_and_combine_first(spark):
    text = plan(QUERIES["value_counts"](spark, FOLDER))
    assert "ReadSchema: struct<event_type:string>" in text and "partial_count" in text


def test_reference_list_needs_no_shuffle_of_the_catalog(spark):
    df = spark.range(10).withColumn("c", F.lit("a, b"))
    ref = spark.createDataFrame([("a",)], "country_name string")
    text = plan(cleaning.normalize_by_reference(df, "c", ref, "country_name"))
    outside = text.split("Subquery")[0]
    assert "Exchange" not in outside and "Generate" not in outside


def test_profiles_take_one_pass(spark):
    df = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    text = plan(profiling.null_counts(df))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cartesian_product(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_large_dimension_is_not_broadcast_by_hand(spark):
    df = spark.createDataFrame([(1, "a, b")], "id bigint, l string")
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "d bigint, v string")
    small = star.bridge_from_list(df, dim, "id", "l", "v", "d", broadcast_rows=BROADCAST_ROWS)
    large = star.bridge_from_list(df, dim, "id", "l", "v", "d", broadcast_rows=1)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))


def test_term_statistics_are_salted(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert "_salt" in plan(terms.tfidf_vectors(docs, "doc_id", "text"))


def test_ranking_metrics_read_the_lines_once(spark):
    text = plan(QUERIES["auc_from_scores"](spark, FOLDER))
    assert "lineitem" not in text and text.count("Exchange") < 17
