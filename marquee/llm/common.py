"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

WORD_BREAK = "[\\x20\\x09-\\x0D]+"
NUMBER_BUCKETS = 64
ROWS_A_BUCKET = 1_000_000


def text_of(column: str | Column = "text") -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce((F.col(column) if isinstance(column, str) else column).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Runs of characters other than ASCII white space; an empty array for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), "")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def constant_array(values: Iterable[float]) -> Column:
    """Numbers as one array that the optimizer folds to a literal."""
    return F.split(F.lit(",".join(str(float(v)) for v in values)), ",").cast("array<double>")


def uniform(*keys: Column) -> Column:
    """A number in [0, 1) that the keys alone decide."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 11) / F.lit(float(1 << 53))


def buckets_for(rows: int) -> int:
    """Buckets that hold about ROWS_A_BUCKET rows each, NUMBER_BUCKETS at least."""
    return max(NUMBER_BUCKETS, -(-rows // ROWS_A_BUCKET))


def numbered(
    df: DataFrame, group: list[str], spread: list[str], order: list[Column], name: str, largest: int
) -> DataFrame:
    """Number the rows of every group 0, 1, 2, ... without gaps.

    A group is cut by the hash of `spread` into pieces, each ranked by itself, and the sizes of the
    earlier pieces are added. `largest` bounds the rows of a group; the number of pieces follows it, so
    pieces do not grow with the data. The offsets, a row a piece, are joined, not broadcast by hand.
    Group values must not be null.
    """
    keyed = df.withColumn("_piece", F.pmod(F.xxhash64(*spread), F.lit(buckets_for(largest))).cast("int"))
    ahead = Window.partitionBy(*group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy(*group, "_piece").agg(F.count("*").alias("_n"))
        .withColumn("_skip", F.coalesce(F.sum("_n").over(ahead), F.lit(0)))
        .drop("_n")
    )
    inside = F.row_number().over(Window.partitionBy(*group, "_piece").orderBy(*order)) - 1
    return (
        keyed.withColumn("_inside", inside)
        .join(offsets, [*group, "_piece"])
        .withColumn(name, (F.col("_inside") + F.col("_skip")).cast("bigint"))
        .drop("_piece", "_inside", "_skip")
    )


@contextmanager
def tidy_shuffles(spark: SparkSession):
    """Inside, Spark deletes the shuffle files of each query when it ends: what is read again is written."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)
