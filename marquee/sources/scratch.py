"""Intermediate tables on the shared folder."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, functions as F

from marquee.session import enter_table, scratch_path

T = TypeVar("T")


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write a result that several later steps read, and read it back.

    Every executor can reach the folder, so nothing is lost with an executor, and the steps after
    it start from a file instead of recomputing the lineage.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


BUCKET_ROWS = 500_000


def buckets_for(rows: int, cores: int) -> int:
    """Buckets of about BUCKET_ROWS rows, a power of two so that layouts of unlike sizes still fit each other."""
    wanted = max(-(-rows // BUCKET_ROWS), min(cores, -(-rows // 5_000)), 1)
    return 1 << (wanted - 1).bit_length()


def keep_bucketed(df: DataFrame, label: str, key: str, buckets: int) -> DataFrame:
    """Write a table dealt into buckets by `key`, and read it back: joins and groups on the key need no shuffle.

    Each bucket is one file of one task. The table is entered in the session's catalog under a name of its own.
    """
    return keep_dealt(df.repartition(buckets, key), label, key, buckets)


def keep_dealt(df: DataFrame, label: str, key: str, buckets: int) -> DataFrame:
    """As keep_bucketed, for rows that are already dealt by `repartition(buckets, key)` and moved no more."""
    path = scratch_path(df.sparkSession, label)
    name = "kept_" + path.rsplit("-", 1)[1]
    df.write.bucketBy(buckets, key).sortBy(key).option("path", path).option("compression", "zstd").saveAsTable(name)
    enter_table(name)
    return df.sparkSession.table(name)


def state_of(*sources: DataFrame) -> str:
    """A digest of the files behind tables: paths, sizes and times of change."""
    parts = []
    for df in sources:
        files = df.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
        row = files.agg(F.count("*"), F.sum(F.xxhash64("*").cast("decimal(38,0)"))).first()
        parts.append(f"{row[0]}:{row[1]}")
    return "|".join(parts)


_built: dict[tuple[str, str, str], object] = {}


def built_once(label: str, sources: list[DataFrame], build: Callable[[str], T]) -> T:
    """`build(path)` for the present state of the source files, or what an earlier call of this application built."""
    spark = sources[0].sparkSession
    key = (spark.sparkContext.applicationId, label, state_of(*sources))
    if key not in _built:
        _built[key] = build(scratch_path(spark, label, lasting=True))
    return _built[key]
