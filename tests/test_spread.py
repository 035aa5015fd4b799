"""Balanced ranks, ids, quantiles and look-ups, forced into their hot-key paths."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from marquee.sources.scratch import keep
from marquee.functions.spread import (
    dense_ids, exact_quantiles, fits_broadcast, ordered_ids, rank_within, salted_lookup, top_n,
)


def _hot(spark, n=3000):
    """Group 0 holds two thirds of all rows; group null exists; many equal sort values."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 < 2, 0).when(F.col("id") % 100 == 2, F.lit(None)).otherwise(F.col("id") % 7).cast("bigint").alias("g"),
        (F.pmod(F.xxhash64("id"), F.lit(500))).alias("v"), "id",
    )


@pytest.mark.parametrize("piece_rows", [100, 10**9])
@pytest.mark.parametrize("values", [500, 3, 1])
def test_rank_within_equals_a_plain_window(spark, piece_rows, values):
    from pyspark.sql import Window

    df = _hot(spark).withColumn("v", F.pmod("v", F.lit(values)))
    got = rank_within(df, ["g"], F.col("v"), [F.asc("id")], "r", "n", piece_rows=piece_rows)
    w = Window.partitionBy("g")
    want = df.withColumn("r", F.row_number().over(w.orderBy("v", "id"))).withColumn("n", F.count("*").over(w))
    key = lambda df: sorted((r["id"], r["r"], r["n"]) for r in df.collect())
    assert key(got) == key(want)


def test_rank_within_puts_nulls_last_in_hot_groups(spark):
    df = _hot(spark).withColumn("v", F.when(F.col("id") % 10 != 0, F.col("v")))
    got = rank_within(df, ["g"], F.col("v"), [F.asc("id")], "r", piece_rows=100).filter("g = 0")
    last_value = got.filter("v is not null").agg(F.max("r")).first()[0]
    assert got.filter("v is null").agg(F.min("r")).first()[0] == last_value + 1


def test_a_group_of_most_rows_is_ranked_in_even_pieces(spark, monkeypatch):
    """Nine tenths of the rows in one group, all of one value: no piece holds much more than its share."""
    from marquee.functions import spread

    seen = []
    monkeypatch.setattr(spread, "keep", lambda df, label: seen.append((label, keep(df, label))) or seen[-1][1])
    df = spark.range(40_000).select(F.when(F.col("id") % 10 > 0, 1).otherwise(F.col("id")).alias("g"), F.lit(7.0).alias("v"), "id")
    ranked = rank_within(df, ["g"], F.col("v"), [F.asc("id")], "r", "n", piece_rows=2_000)
    big = ranked.filter("g = 1 and n = 36000").agg(F.count("*"), F.count_distinct("r"), F.min("r"), F.max("r")).first()
    assert tuple(big) == (36_000, 36_000, 1, 36_000)
    pieces = [r["n"] for r in dict(seen)["pieces"].groupBy("_piece").agg(F.count("*").alias("n")).collect()]
    assert len(pieces) == 20 and max(pieces) < 2 * 2_000


def test_small_groups_of_a_large_table_are_written_once(spark, monkeypatch):
    """No group is larger than a piece: the rows are not cut, and not written a second time for it."""
    from marquee.functions import spread

    seen = []
    monkeypatch.setattr(spread, "keep", lambda df, label: seen.append(label) or keep(df, label))
    df = spark.range(3_000).select(F.when(F.col("id") > 50, F.col("id") % 40).alias("g"), F.lit(1.0).alias("v"), "id")
    ranked = rank_within(df, ["g"], F.col("v"), [F.asc("id")], "r", "n", piece_rows=100)
    assert ranked.filter("r = n").count() == 41 and ranked.count() == 3_000
    assert "pieces" not in seen


def test_scratch_of_a_job_goes_with_it(spark):
    import os

    from marquee.session import passing_scratch, scratch_path
    from marquee.sources.scratch import keep_bucketed

    lasting = keep(spark.range(5), "outside")
    seen = []
    with pytest.raises(RuntimeError), passing_scratch(spark):
        kept = keep(spark.range(10), "inside")
        seen = [f.replace("file:", "") for f in kept.inputFiles()]
        tables = {t.name for t in spark.catalog.listTables()}
        assert keep_bucketed(kept, "inside", "id", 2).count() == 10
        made = {t.name for t in spark.catalog.listTables()} - tables
        own = scratch_path(spark, "x", lasting=True).rsplit("/", 1)[0]
        assert all(os.path.exists(f) for f in seen) and len(made) == 1
        raise RuntimeError("the job fails")
    assert seen and not any(os.path.exists(f) for f in seen)
    assert not made & {t.name for t in spark.catalog.listTables()}
    assert lasting.count() == 5 and all(own in f for f in lasting.inputFiles())


def test_dense_ids_do_not_depend_on_partitions(spark):
    df = spark.range(1000).select(F.concat(F.lit("v"), "id").alias("v"))
    a = rows(dense_ids(df.repartition(3), ["v"], "k"), "v", "k")
    b = rows(dense_ids(df.repartition(17), ["v"], "k"), "v", "k")
    assert a == b
    assert sorted(k for _, k in a) == list(range(1, 1001))


def test_dense_ids_with_weights_leave_room(spark):
    df = spark.createDataFrame([("a", 3), ("b", 1), ("c", 2)], "v string, n int")
    got = {r["v"]: r["k"] for r in dense_ids(df, ["v"], "k", weight="n").collect()}
    taken = sorted(k + i for v, k in got.items() for i in range({"a": 3, "b": 1, "c": 2}[v]))
    assert taken == [1, 2, 3, 4, 5, 6]


def test_ordered_ids_follow_the_key(spark):
    df = spark.range(2000).select((F.col("id") * F.col("id") * 7).alias("k"))
    got = [r["at"] for r in ordered_ids(df, "k", "at").orderBy("k").collect()]
    assert got == list(range(2000))


@pytest.mark.parametrize("accuracy", [2_000, 50])
@pytest.mark.parametrize("n", [1, 2, 5, 10, 997])
def test_exact_quantiles_equal_numpy(spark, n, accuracy):
    rng = np.random.default_rng(n)
    values = np.concatenate([rng.normal(size=n), np.zeros(n)])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, ["v"], [0.0, 0.25, 0.5, 0.95, 1.0], accuracy).collect()}
    for p, v in got.items():
        assert v == pytest.approx(np.quantile(values, p), abs=1e-12)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_salted_lookup_never_broadcasts_the_repeated_side(spark, tmp_path, how):
    spark.range(1000).withColumnRenamed("id", "k").write.parquet(f"{tmp_path}/right")  # a few kB, repeated 16 times
    joined = salted_lookup(spark.range(100).withColumn("k", F.col("id") % 7), spark.read.parquet(f"{tmp_path}/right"), ["k"], ["id"], how)
    assert joined.count() == 100
    assert "BroadcastExchange" not in joined._jdf.queryExecution().executedPlan().toString()


def test_salted_lookup_keeps_every_row(spark):
    left = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    right = spark.createDataFrame([(0, "a"), (1, "b")], "k bigint, name string")
    assert salted_lookup(left, right, ["k"], ["id"]).count() == 667
    assert salted_lookup(left, right, ["k"], ["id"], how="left").count() == 1000


def test_top_n_cuts_before_the_shuffle(spark):
    plan = top_n(_hot(spark), ["g"], [F.asc("v"), F.asc("id")], 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_quantiles_skip_nan(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)] + [(float("nan"),), (None,)], "v double")
    got = exact_quantiles(df, ["v"], [0.25]).first()
    assert got["value"] == 2.25


def test_a_broadcast_is_bounded_in_rows_and_bytes(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("v"))
    assert fits_broadcast(df) and fits_broadcast(df.limit(0))
    assert not fits_broadcast(df, max_rows=99)
    assert not fits_broadcast(df, max_bytes=100_000)
