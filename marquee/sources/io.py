"""Readers and writers: CSV, Parquet, tables, shard merging, positional slices."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Observation, SparkSession, Window, functions as F, types as T

from marquee.functions.spread import input_bytes, ordered_ids
from marquee.schemas import LOAD_ORDER, RAW_CATALOG
from marquee.sources.scratch import keep

# Task functions travel by value, so executors need numpy and pyarrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MERGED_BYTES = 1 << 28  # bytes of a merged file, which one task reads and writes
SHARD_BYTES = 1 << 27   # bytes of input files for a shard of an export
CSV_OPTIONS = {"escape": '"'}


class MissingInput(FileNotFoundError):
    """An input path does not exist or holds no files of the expected kind."""


def path_exists(spark: SparkSession, path: str) -> bool:
    """Looks the path or glob up in whatever file system it names."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop)
    return found is not None and len(found) > 0


def require_path(spark: SparkSession, path: str) -> str:
    if not path_exists(spark, path):
        raise MissingInput(f"File not found: {path}")
    return path


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = True
) -> DataFrame:
    """CSV file, folder or glob with a header; quoted line breaks and doubled quotes are read correctly.

    Files are split: read_split_csv finds the line breaks that lie inside quotes. Files in which quotes do not
    pair up are left to Spark's own reader, a task a file. multi_line=False is for files known to hold no quoted
    line breaks.
    """
    reader = spark.read.options(**CSV_OPTIONS).option("header", True)
    columns = schema if schema is not None else reader.csv(path).schema  # reads a line
    if not multi_line:
        return reader.schema(columns).csv(path)
    split = read_split_csv(spark, path, columns)
    return split if split is not None else reader.option("multiLine", True).schema(columns).csv(path)


def _quoted_lines(lines: DataFrame) -> DataFrame:
    """Lines (file, block, line) in their order, with what the quotes of their range say of each.

    `nth` counts the lines of a range, `before` is the parity of the quotes ahead of the line in the range, `odd`
    that of the line, `record0` and `record1` number the records that begin where `before` is 0 or 1.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, nth, parity, records = None, 0, 0, np.zeros(2, dtype=np.int64)
        for batch in batches:
            files, blocks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            odd = pc.count_substring(batch.column(2), '"').to_numpy(zero_copy_only=False).astype(np.int64) & 1
            edges = [0, *[i for i in range(1, len(files)) if (files[i], blocks[i]) != (files[i - 1], blocks[i - 1])], len(files)]
            out: list[list[np.ndarray]] = [[], [], [], []]
            for a, b in zip(edges[:-1], edges[1:]):
                if a == b:
                    continue
                if (files[a], blocks[a]) != now:
                    now, nth, parity, records = (files[a], blocks[a]), 0, 0, np.zeros(2, dtype=np.int64)
                upto = parity + np.cumsum(odd[a:b])
                before = (upto - odd[a:b]) & 1
                begun = np.stack([np.cumsum(before == 0), np.cumsum(before == 1)]) + records[:, None]
                for column, values in zip(out, (nth + np.arange(b - a), before, begun[0], begun[1])):
                    column.append(values)
                nth, parity, records = nth + b - a, int(upto[-1] & 1), begun[:, -1]
            joined = [np.concatenate(c) if c else np.zeros(0, dtype=np.int64) for c in out]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(c, pa.int64()) for c in (joined[0], odd, *joined[1:])], batch.column(2)],
                names=["file", "block", "nth", "odd", "before", "record0", "record1", "line"])

    return lines.mapInArrow(run, "file string, block bigint, nth bigint, odd bigint, before bigint, record0 bigint, record1 bigint, line string")


def read_split_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """Records of CSV files with a header, from lines that are read split; None if a file's quotes do not pair up.

    A line break lies inside quotes if an odd number of quotes stand before it in the file. Quotes are counted
    line by line and added up by byte range of the file (a row for each split); a window over those sums tells
    every range whether it starts inside quotes and in which range that record began. Only lines of records
    that hold a line break are brought together; all others are parsed where they are read.
    """
    text = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))
    local = _quoted_lines(text)
    ranges = keep(local.groupBy("file", "block").agg(
        F.pmod(F.sum("odd"), F.lit(2)).alias("odds"), F.max("record0").alias("records0"), F.max("record1").alias("records1")), "csv-ranges")
    if not ranges.groupBy("file").agg(F.sum("odds").alias("odds")).filter(F.pmod("odds", F.lit(2)) == 1).isEmpty():
        return None
    ahead = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    entered = ranges.withColumn("entry", F.pmod(F.coalesce(F.sum("odds").over(ahead), F.lit(0)), F.lit(2)))
    entered = entered.withColumn("records", F.when(F.col("entry") == 0, F.col("records0")).otherwise(F.col("records1")))
    last = F.last(F.when(F.col("records") > 0, F.struct(F.col("block"), F.col("records").alias("record"))), True)
    entered = entered.select("file", "block", "entry", last.over(ahead).alias("came_from"))

    record = F.when(F.col("entry") == 0, F.col("record0")).otherwise(F.col("record1"))
    numbered = local.join(entered, ["file", "block"]).withColumns({
        "record": record, "single": (F.col("before") == F.col("entry")) & (F.col("odd") == 0)})
    key = F.when(F.col("record") > 0, F.struct(F.col("block"), F.col("record"))).otherwise(F.col("came_from"))
    keyed = numbered.select("file", key.alias("key"), "block", "nth", "line", "single").filter(
        ~((F.col("key.block") == 0) & (F.col("key.record") == 1)))  # the header of its file
    glued = keyed.filter(~F.col("single")).groupBy("file", "key").agg(F.sort_array(F.collect_list(F.struct("block", "nth", "line"))).alias("all"))
    records = keyed.filter("single").select("line").unionByName(glued.select(F.array_join(F.col("all.line"), "\n").alias("line")))
    line = F.regexp_replace("line", "\r$", "")
    return records.filter(F.trim(line) != "").select(F.from_csv(line, _ddl(schema), CSV_OPTIONS).alias("r")).select("r.*")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def read_raw_catalog(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return read_csv(spark, require_path(spark, path), RAW_CATALOG, multi_line)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str | None = None, fmt: str | None = None, **options: str) -> DataFrame:
    """A catalog table, or any connector named by `fmt` with its options."""
    if fmt is None:
        return spark.table(name)
    return spark.read.format(fmt).options(**options).load()


def inline_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def inline_lines(spark: SparkSession, lines: list[str]) -> DataFrame:
    return spark.createDataFrame([(line,) for line in lines], "value string")


def write_parquet(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> None:
    """`single_file` ends in one task and is meant for small hand-over files only."""
    (df.coalesce(1) if single_file else df).write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> None:
    (df.coalesce(1) if single_file else df).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_vectors(df: DataFrame, path: str) -> None:
    """A vector table: one row per id, the vector as an array of floats next to it."""
    df.select("id", F.col("vector").cast("array<float>").alias("vector")).write.mode("overwrite").parquet(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(require_path(spark, path)).select("id", "vector")


def write_tables(tables: Iterable[tuple[str, str, DataFrame]], folder: str) -> dict[str, int]:
    """Write each (kind, name, table) to {folder}/{kind}_{name}; row counts come from the write itself."""
    counts: dict[str, int] = {}
    for kind, name, table in tables:
        seen = Observation(f"{kind}_{name}")
        watched = table.observe(seen, F.count(F.lit(1)).alias("rows"))
        watched.write.mode("overwrite").parquet(f"{folder}/{kind}_{name}")
        counts[f"{kind}_{name}"] = seen.get["rows"]
    return counts


def append_table(df: DataFrame, name: str) -> None:
    df.write.mode("append").saveAsTable(name)


def load_folder(spark: SparkSession, folder: str, table: str) -> None:
    """Replace a table by the part files of a folder; an empty or absent folder is an error."""
    if not path_exists(spark, f"{folder}/*.parquet"):
        raise MissingInput(f"No Parquet files found in {folder}")
    spark.read.parquet(folder).write.mode("overwrite").saveAsTable(table)


def load_star(spark: SparkSession, folder: str, database: str = "default") -> Iterator[str]:
    """Load the 12 star folders: dimensions, bridges, fact."""
    for source, table in LOAD_ORDER.items():
        load_folder(spark, f"{folder}/{source}", f"{database}.{table}")
        yield table


def export_shards(df: DataFrame, path: str, fmt: str = "parquet", shards: int | None = None) -> None:
    """Sharded export, overwriting. Without `shards` the number follows the size of the data.

    `shards` holds for inputs of up to SHARD_BYTES a shard; a larger one gives more shards, because a task writes each.
    """
    out = df.repartition(max(shards, -(-input_bytes(df) // SHARD_BYTES))) if shards else df
    (write_csv if fmt == "csv" else write_parquet)(out, path)


def bytes_below(spark: SparkSession, pattern: str) -> int:
    """Bytes of all files under a path or glob, from the file system's own counts."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    system = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return sum(system.getContentSummary(s.getPath()).getLength() for s in system.globStatus(hadoop) or [])


def merge_shards(
    spark: SparkSession, pattern: str, target: str, fmt: str = "parquet", file_bytes: int | None = MERGED_BYTES
) -> None:
    """Merge shards into files of about `file_bytes` each.

    Rows are dealt evenly: a coalesce joins splits, and of a shard with one row group all rows come from one split.
    None asks for one single file whatever the size; one task then writes all of it.
    """
    if not path_exists(spark, pattern):
        raise MissingInput(f"No shards match {pattern}")
    shards = read_csv(spark, pattern) if fmt == "csv" else spark.read.parquet(pattern)
    files = 1 if file_bytes is None else max(1, -(-bytes_below(spark, pattern) // file_bytes))
    (write_csv if fmt == "csv" else write_parquet)(shards.repartition(files), target)


def positional_slice(df: DataFrame, order_key: str, first: int, last: int | None = None) -> DataFrame:
    """Rows at 0-based positions first <= p < last in the order of a unique numeric key."""
    placed = ordered_ids(df, order_key, "_at")
    keep = F.col("_at") >= first
    if last is not None:
        keep = keep & (F.col("_at") < last)
    return placed.filter(keep).drop("_at")
