"""Ranks, ids, quantiles and lookups that stay balanced when one key holds most of the rows.

The rules used throughout:

* top-k per group is `row_number() <= k`, which Spark cuts to k rows per task before the shuffle;
* where whole groups must be ranked, rows are range-partitioned by group and order into pieces of
  bounded rows, each piece is ranked on its own and the rows of earlier pieces are added;
* a lookup on a key that may be hot is salted;
* nothing here depends on how the rows happen to be partitioned, so a recomputed task gives the
  same result.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.sources.scratch import keep

PIECE_ROWS = 1_000_000    # rows that are put in order by one task
KEY_BUCKETS = 256         # pieces of a table that is numbered by a key
ID_BUCKETS = 4096         # pieces of a table-wide numbering (three hexadecimal digits)
LOOKUP_SALTS = 16
QUANTILE_CELLS = 4096
PART_BYTES = 8 << 20      # bytes of input files for a part of a table whose texts are taken apart
BROADCAST_ROWS = 200_000
DIMENSION_ROWS = 1_000_000  # the same for a list dimension, a name and a number a row
BROADCAST_BYTES = 64 << 20


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Prove in one bounded pass that a side is small, in rows and in bytes (of its rows as JSON)."""
    sizes = df.select(F.octet_length(F.to_json(F.struct("*"))).cast("bigint").alias("_bytes")).limit(max_rows + 1)
    found = sizes.agg(F.count("*").alias("rows"), F.sum("_bytes").alias("bytes")).first()
    return found["rows"] <= max_rows and (found["bytes"] or 0) <= max_bytes


def checked_lookup(
    left: DataFrame, right: DataFrame, on: list[str], salt_from: list[str], how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """salted_lookup, or a broadcast if a count shows that `right` (a written table) is small."""
    if fits_broadcast(right, max_rows):
        return left.join(F.broadcast(right), on, how)
    return salted_lookup(left, right, on, salt_from, how)


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files a table is read from."""
    spark = df.sparkSession
    conf, path = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path
    found = [path(f) for f in df.inputFiles()]
    return sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in found)


def parts_for(df: DataFrame, part_bytes: int = PART_BYTES) -> int:
    """Parts of a table that follow the bytes of its input files, at least one a core; a power of two."""
    wanted = max(df.sparkSession.sparkContext.defaultParallelism, -(-input_bytes(df) // part_bytes), 1)
    return 1 << (wanted - 1).bit_length()


def one_row(df: DataFrame) -> Column:
    """The only row of an aggregate as a struct column (a scalar subquery, computed once)."""
    return df.select(F.struct("*")).scalar()


def top_n(df: DataFrame, group: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """First n rows of each group under a total order, with their 1-based rank."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def salted_lookup(
    left: DataFrame, right: DataFrame, on: list[str], salt_from: list[str], how: str = "inner",
    salts: int = LOOKUP_SALTS,
) -> DataFrame:
    """Join to a table that is unique on `on` when `left` may have hot keys.

    Each key of `left` is spread over `salts` tasks; `right` is repeated once per salt. The repeated side is
    shuffled: the planner's size of it, and so its choice of a broadcast, does not see the repetition.
    """
    spread = left.withColumn("_salt", F.pmod(F.xxhash64(*salt_from), F.lit(salts)).cast("int"))
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(repeated.hint("merge"), [*on, "_salt"], how).drop("_salt")


def _order_bucket(value: Column, bounds: Column, buckets: int = KEY_BUCKETS) -> Column:
    """Number of bounds below the value: an order-preserving, balanced bucket number.

    A binary search over the buckets - 1 bounds as one fold, so that the expression stays small
    wherever the optimizer copies it. Without bounds the bucket is 0; null values come last.
    """
    steps = []
    while buckets >> (len(steps) + 1):
        steps.append(F.lit(buckets >> (len(steps) + 1)))
    found = F.aggregate(
        F.array(*steps), F.lit(0),
        lambda at, step: F.when(value > F.get(bounds, at + step - 1), at + step).otherwise(at),
    )
    return F.when(bounds.isNull(), 0).when(value.isNull(), buckets).otherwise(found)


def _sketch_bounds(value: str, buckets: int = KEY_BUCKETS) -> Column:
    points = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    return F.percentile_approx(value, points, 2_000)


def rank_within(
    df: DataFrame, group: list[str], sort_value: Column, ties: list[Column], rank: str = "rank",
    size: str | None = None, piece_rows: int | None = None,
) -> DataFrame:
    """Exact 1-based rank of every row in its group, by `sort_value` (numeric) and then `ties`.

    Groups of up to PIECE_ROWS rows (counted) are put in order whole, after one shuffle by group. The rows of larger groups are
    range-partitioned by group, value and ties into pieces of about PIECE_ROWS rows: a rank is the row's place among
    its group's rows of the piece, and the group's rows in earlier pieces. Neighbouring pieces share one group at most,
    so the table of sums has fewer than two rows a piece and is broadcast. The sums are running ones, so a group over many
    pieces costs no more than its pieces.
    """
    piece_rows = piece_rows or PIECE_ROWS
    kept = keep(df.withColumn("_v", sort_value.cast("double")), "to-rank")
    names = [F.col(g).asc_nulls_first() for g in group]
    order = [F.col("_v").asc_nulls_last(), *ties]
    out = [*df.columns, rank, *([size] if size else [])]

    def placed_in(rows: DataFrame, keys: list[str]) -> DataFrame:
        inside = Window.partitionBy(*keys)
        found = rows.withColumn(rank, F.row_number().over(inside.orderBy(*order)))
        return found.withColumn(size, F.count("*").over(inside)) if size else found

    pieces = -(-kept.count() // piece_rows)
    if pieces <= 1:
        return placed_in(kept, group).select(*out)
    other = {g: f"_of_{g}" for g in group}
    same = reduce(and_, [F.col(g).eqNullSafe(F.col(o)) for g, o in other.items()])
    sizes = kept.groupBy(*[F.col(g).alias(o) for g, o in other.items()]).agg(F.count("*").alias("_n"))
    large = keep(sizes.filter(F.col("_n") > piece_rows), "large-groups")  # fewer rows than pieces
    if large.isEmpty():
        return placed_in(kept, group).select(*out)
    large = F.broadcast(large.drop("_n"))
    small = placed_in(kept.join(large, same, "left_anti"), group).select(*out)
    dealt = keep(kept.join(large, same, "left_semi").repartitionByRange(pieces, *names, *order).withColumn(
        "_piece", F.spark_partition_id()), "pieces")
    ranked = placed_in(dealt, [*group, "_piece"])
    counts = dealt.groupBy(*group, "_piece").agg(F.count("*").alias("_n"))
    whole = Window.partitionBy(*group)
    ahead = whole.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    spans = keep(counts.withColumns({"_k": F.count("*").over(whole), "_all": F.sum("_n").over(whole), "_skip": F.sum("_n").over(ahead)})
                 .filter("_k > 1"), "spans")
    sums = spans.select(*[F.col(g).alias(o) for g, o in other.items()], "_all", F.col("_piece").alias("_at"), "_skip")
    placed = ranked.join(F.broadcast(sums), same & (F.col("_piece") == F.col("_at")), "left")
    placed = placed.withColumn(rank, (F.col(rank) + F.coalesce("_skip", F.lit(0))))
    if size:
        placed = placed.withColumn(size, F.coalesce("_all", F.col(size)))
    return small.unionByName(placed.select(*out))


def hash_bucket(*keys: str | Column) -> Column:
    """Three hexadecimal digits of the md5 of the key: 4096 even buckets, same in any SQL engine."""
    return F.substring(F.md5(F.concat_ws("|", *keys)), 1, 3)


def _number_buckets(
    df: DataFrame, order: list[Column], id_col: str, start: int, weight: str | None, write: bool = False
) -> DataFrame:
    """Number the rows by (_bucket, order); with `weight` a row takes that many numbers.

    `write` puts the rows in order once and writes them with their places, so that `df` is read once, not twice.
    """
    units = F.col(weight) if weight else F.lit(1)
    w = Window.partitionBy("_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    numbered = df.withColumn("_last", F.sum(units).over(w))
    if write:
        df = numbered = keep(numbered, "numbered")
    ahead = Window.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    # at most ID_BUCKETS rows: the one ordered window over the whole frame is bounded
    offsets = (
        df.groupBy(F.col("_bucket").alias("_at")).agg(F.sum(units).alias("_rows"))
        .withColumn("_skip", F.coalesce(F.sum("_rows").over(ahead), F.lit(0)))
        .select("_at", "_skip")
    )
    joined = numbered.join(F.broadcast(offsets), F.col("_bucket") == F.col("_at"), "left")
    first = F.col("_skip") + F.col("_last") - units + start
    return joined.withColumn(id_col, first.cast("bigint")).drop("_bucket", "_at", "_skip", "_last")


def dense_ids(
    df: DataFrame, keys: list[str], id_col: str, start: int = 1, bucket_on: list[str] | None = None,
    weight: str | None = None, write: bool = False,
) -> DataFrame:
    """Gap-free ids ordered by hash bucket and then by key, for rows unique on `keys` or without other columns.

    One shuffle on the bucket; the same rows get the same ids under any partitioning, so a
    dimension and the bridge made from it agree even when one of them is recomputed. `write` is for rows that are
    many or costly to make: they are made and put in order once.
    """
    bucketed = df.withColumn("_bucket", hash_bucket(*(bucket_on or keys)))
    return _number_buckets(bucketed, [F.col(k) for k in keys], id_col, start, weight, write)


def ordered_ids(df: DataFrame, key: str, id_col: str, start: int = 0) -> DataFrame:
    """Gap-free ids in the order of a unique numeric key, cut at sketched quantiles of the key."""
    bounds = df.agg(_sketch_bounds(key)).scalar()
    bucketed = df.withColumn("_bounds", bounds).withColumn(
        "_bucket", _order_bucket(F.col(key).cast("double"), F.col("_bounds"))
    ).drop("_bounds")
    return _number_buckets(bucketed, [F.col(key)], id_col, start, None)


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float], accuracy: int = 2_000) -> DataFrame:
    """Exact quantiles with linear interpolation: rows (column_name, prob, value).

    Spark's exact `percentile` keeps every distinct value in one task. Here a small sketch brackets
    each quantile; rows outside the bracket are only counted; the bracket is cut into QUANTILE_CELLS
    equal cells, and only the cell that holds the wanted position is put in order. A bracket that
    misses raises an error; it never gives a wrong number. Null and NaN are no values.
    """
    long = df.select(
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v"))
            for c in columns
        ])).alias("s")
    ).select("s.column_name", "s.v").filter(F.col("v").isNotNull() & ~F.isnan("v"))
    return exact_quantiles_of(long, probs, accuracy)


def exact_quantiles_of(long: DataFrame, probs: list[float], accuracy: int = 2_000) -> DataFrame:
    """As exact_quantiles, of rows (column_name, v) without null and NaN; they are read twice."""
    margin = 10 / accuracy
    lows = F.array(*[F.lit(max(0.0, p - margin)) for p in probs])
    highs = F.array(*[F.lit(min(1.0, p + margin)) for p in probs])
    place = F.col("prob") * (F.col("n") - 1)
    brackets = (
        long.groupBy("column_name")
        .agg(
            F.count("*").alias("n"),
            F.percentile_approx("v", lows, accuracy).alias("lows"),
            F.percentile_approx("v", highs, accuracy).alias("highs"),
        )
        .select("column_name", "n", F.explode(F.arrays_zip(
            F.array(*[F.lit(float(p)) for p in probs]).alias("prob"), "lows", "highs")).alias("b"))
        .select("column_name", "n", F.col("b.prob").alias("prob"), F.col("b.lows").alias("low"),
                F.col("b.highs").alias("high"))
    )  # len(columns) * len(probs) rows
    width = F.col("high") - F.col("low")
    cell = F.least(F.lit(QUANTILE_CELLS - 1), F.floor((F.col("v") - F.col("low")) / width * QUANTILE_CELLS))
    keys = ["column_name", "prob", "n", "zone", "cell"]
    zones = (
        long.join(F.broadcast(brackets), "column_name")
        .withColumn("zone", F.when(F.col("v") < F.col("low"), 0).when(F.col("v") > F.col("high"), 2).otherwise(1))
        .withColumn("cell", F.when((F.col("zone") == 1) & (width > 0), cell.cast("int")).otherwise(0))
        .groupBy(*keys, F.when(F.col("zone") == 1, F.col("v")).alias("at"))
        .agg(F.count("*").alias("rows"), F.min("v").alias("least"), F.max("v").alias("most"))
    )
    # at most QUANTILE_CELLS + 2 rows per quantile, of which one or two hold the position
    in_order = Window.partitionBy("column_name", "prob").orderBy("zone", "cell")
    cells = (
        zones.groupBy(*keys).agg(F.sum("rows").alias("cell_rows"))
        .withColumn("cell_upto", F.sum("cell_rows").over(in_order))
        .withColumn("before", F.col("cell_upto") - F.col("cell_rows"))
        .filter((F.col("before") < F.ceil(place) + 1) & (F.floor(place) + 1 <= F.col("cell_upto")))
        .select(*keys, "before")
    )
    w = Window.partitionBy(*keys).orderBy("at")
    wanted = zones.join(F.broadcast(cells), keys).withColumn("upto", F.col("before") + F.sum("rows").over(w))
    cum = wanted.withColumn("past", F.col("upto") - F.col("rows"))

    def value_at(position: Column) -> Column:
        here = (F.col("past") < position) & (position <= F.col("upto"))
        value = (
            F.when(F.col("zone") == 1, F.col("at"))
            .when((F.col("zone") == 0) & (position == F.col("upto")), F.col("most"))
            .when((F.col("zone") == 2) & (position == F.col("past") + 1), F.col("least"))
            .otherwise(F.raise_error(F.lit("quantile bracket missed; raise accuracy")).cast("double"))
        )
        return F.max(F.when(here, value))

    return (
        cum.groupBy("column_name", "prob", "n")
        .agg(value_at(F.floor(place) + 1).alias("a"), value_at(F.ceil(place) + 1).alias("b"))
        .select("column_name", "prob",
                (F.col("a") + (F.col("b") - F.col("a")) * (place - F.floor(place))).alias("value"))
    )
