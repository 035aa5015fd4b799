"""CSV files that are read split, with line breaks inside quotes."""

import random

import pytest
from pyspark.sql import types as T

from marquee.sources import io

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])


@pytest.fixture()
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "200")
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def texts(n, seed):
    rng = random.Random(seed)
    parts = ["plain", 'say ""hi""', "one, two", "line\nbreak", "\n\n\n", "tail\n", "", "ü", "x" * 300, "a\nb\nc\n" * 40, '"', "'", "back\\slash"]
    return [(i, rng.choice(parts) + rng.choice(parts), rng.choice([None, *parts[:6]])) for i in range(n)]


def plain(rows, spark, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.option("header", True).option("escape", '"').csv(path)
    return sorted(map(tuple, spark.read.option("header", True).option("escape", '"').option("multiLine", True).schema(SCHEMA).csv(path).collect()))


def test_records_over_many_splits_of_one_file(spark, tmp_path, small_splits):
    want = plain(texts(300, 1), spark, f"{tmp_path}/t")
    df = io.read_csv(spark, f"{tmp_path}/t", SCHEMA)
    assert sorted(map(tuple, df.collect())) == want
    lines = spark.read.option("lineSep", "\n").text(f"{tmp_path}/t")
    assert lines.rdd.getNumPartitions() > 20
    assert len(want) == 300


def test_several_files_and_no_schema(spark, tmp_path, small_splits):
    for i in range(3):
        plain(texts(40, i), spark, f"{tmp_path}/in/part{i}")
    got = io.read_csv(spark, f"{tmp_path}/in/*")
    want = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(f"{tmp_path}/in/*")
    assert got.columns == ["id", "a", "b"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_quotes_that_do_not_pair_up_are_left_to_the_reader(spark, tmp_path):
    (tmp_path / "odd.csv").write_text('id,a,b\n1,5" pipe,x\n2,plain,y\n')
    assert io.read_split_csv(spark, f"{tmp_path}/odd.csv", SCHEMA) is None
    assert [r["id"] for r in io.read_csv(spark, f"{tmp_path}/odd.csv", SCHEMA).collect()] == [1, 2]


@pytest.mark.parametrize("content", ["id,a,b\n", "id,a,b", 'id,a,b\r\n1,"x\r\ny",z\r\n\r\n2,,""\r\n'])
def test_headers_alone_and_windows_line_ends(spark, tmp_path, content):
    (tmp_path / "t.csv").write_bytes(content.encode())
    got = io.read_csv(spark, f"{tmp_path}/t.csv", SCHEMA).collect()
    want = spark.read.option("header", True).option("escape", '"').option("multiLine", True).schema(SCHEMA).csv(f"{tmp_path}/t.csv").collect()
    plain_rows = lambda rows: sorted((r["id"], (r["a"] or "").replace("\r\n", "\n")) for r in rows)
    assert plain_rows(got) == plain_rows(want)
