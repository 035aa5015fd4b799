"""Profiles: nulls, duplicates, lengths, value counts, distributions, correlations."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from marquee.functions import lists
from marquee.functions.spread import exact_quantiles, exact_quantiles_of, one_row
from marquee.schemas import COLUMN_KINDS
from marquee.sources.scratch import keep


def _by_column(row: DataFrame, fields: dict[str, dict[str, Column]], label: str = "column_name") -> DataFrame:
    """Turn one aggregate row into one row per column: fields[column][output name]."""
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias(label), *[e.alias(n) for n, e in out.items()])
        for c, out in fields.items()
    ])).alias("r")).select("r.*")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def column_types(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def row_count(df: DataFrame, out: str = "rows") -> DataFrame:
    return df.agg(F.count("*").alias(out))


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, nulls, non_nulls) for every column in one pass."""
    columns = columns or df.columns
    row = df.agg(
        F.count("*").alias("_rows"), *[F.count(F.col(c)).alias(f"_v{i}") for i, c in enumerate(columns)]
    )
    return _by_column(row, {
        c: {"nulls": F.col("_rows") - F.col(f"_v{i}"), "non_nulls": F.col(f"_v{i}")}
        for i, c in enumerate(columns)
    })


def null_report(df: DataFrame) -> DataFrame:
    """Columns that have nulls: count, percent and type, most nulls first."""
    kinds = dict(column_types(df))
    report = null_counts(df).filter(F.col("nulls") > 0)
    kind = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])[F.col("column_name")]
    return report.select(
        "column_name", "nulls",
        (F.col("nulls") * 100 / (F.col("nulls") + F.col("non_nulls"))).alias("percent"),
        kind.alias("kind"),
    ).orderBy(F.desc("nulls"), "column_name")


def completeness(df: DataFrame, column: str, suffix: str) -> DataFrame:
    """Nulls plus values with the expected suffix should account for all rows."""
    return df.agg(
        F.count_if(F.col(column).isNull()).alias("nulls"),
        F.count_if(F.col(column).endswith(suffix)).alias("matching"),
        F.count("*").alias("rows"),
    ).withColumn("complete", ((F.col("nulls") + F.col("matching")) == F.col("rows")).cast("int"))


def _copies(df: DataFrame) -> DataFrame:
    return df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))


def duplicate_report(df: DataFrame) -> DataFrame:
    """Rows, surplus rows (equal to an earlier one), and groups of equal rows."""
    return _copies(df).agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("surplus"),
        F.count_if(F.col("_copies") > 1).alias("groups"),
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Each repeated row once, with the number of its copies."""
    return _copies(df).filter(F.col("_copies") > 1).withColumnRenamed("_copies", "copies")


def length_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(F.length(column)).alias("shortest"), F.max(F.length(column)).alias("longest"))


def value_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("least"), F.max(column).alias("most"))


def length_histogram(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.length(column).alias("length")).agg(F.count("*").alias("rows")).orderBy("length")


def value_counts(df: DataFrame, column: str, out: str = "value") -> DataFrame:
    return (
        df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias(out))
        .agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), out)
    )


def list_value_counts(df: DataFrame, column: str, out: str = "value") -> DataFrame:
    return value_counts(df.select(F.explode(lists.split_list(column)).alias(out)), out, out)


def distinct_list_values(df: DataFrame, column: str, out: str = "value") -> DataFrame:
    return df.select(F.explode(lists.split_list(column)).alias(out)).distinct()


def unique_counts(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """(column_name, uniques), nulls excluded. The exact form counts the groups of one shuffle."""
    if approximate:
        row = df.agg(*[F.approx_count_distinct(c).alias(f"_u{i}") for i, c in enumerate(columns)])
        return _by_column(row, {c: {"uniques": F.col(f"_u{i}")} for i, c in enumerate(columns)})
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns
    ])).alias("s")).select("s.*")
    return pairs.filter(F.col("v").isNotNull()).distinct().groupBy("column_name").agg(
        F.count("*").alias("uniques")
    )


def word_count(df: DataFrame, column: str = "value") -> DataFrame:
    return df.select(F.explode(F.split(column, " ")).alias("word")).groupBy("word").agg(F.count("*").alias("rows"))


def extension_counts(df: DataFrame, column: str) -> DataFrame:
    return value_counts(df.select(lists.file_extension(column).alias("extension")), "extension", "extension")


def scheme_counts(df: DataFrame, column: str) -> DataFrame:
    return value_counts(df.select(lists.url_scheme(column).alias("scheme")), "scheme", "scheme")


def bad_dates(df: DataFrame, column: str, pattern: str = "yyyy-MM-dd") -> DataFrame:
    return df.filter(lists.is_bad_date(column, pattern))


def _wide_quantiles(df: DataFrame, columns: list[str], names: dict[float, str]) -> DataFrame:
    long = exact_quantiles(df, columns, list(names))
    return long.groupBy("column_name").agg(*[
        F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in names.items()
    ])


QUARTILES = {0.25: "q1", 0.5: "median", 0.75: "q3"}


def _numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, v) of all values of the columns; null and NaN are no values."""
    value = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in columns])
    return df.select(F.explode(value).alias("s")).select("s.*").filter(F.col("v").isNotNull() & ~F.isnan("v"))


def _listed(df: DataFrame, names: list[str], key: str) -> DataFrame:
    return df.sparkSession.createDataFrame([(n,) for n in names], f"{key} string")


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, sample deviation, min, quartiles and max, one row per column.

    The columns are read once and written as (column, value); moments are combined in each task, so the
    groups of the aggregate are the columns. Null and NaN are no values.
    """
    long = keep(_numbers(df, columns), "numbers")
    base = long.groupBy("column_name").agg(
        F.count("*").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.min("v").alias("least"), F.max("v").alias("most"))
    found = exact_quantiles_of(long, list(QUARTILES)).groupBy("column_name").agg(*[
        F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in QUARTILES.items()])
    # all sides have one row per column of the table
    wide = _listed(df, columns, "column_name").join(F.broadcast(base), "column_name", "left").join(F.broadcast(found), "column_name", "left")
    return wide.withColumn("n", F.coalesce("n", F.lit(0)))


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns over the rows where both are present; NaN is not.

    One scan and one aggregate whose groups are the pairs; co-moments are combined in each task.
    """
    numbers = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    pairs = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), numbers[columns[i]].alias("x"), numbers[columns[j]].alias("y"))
             for i, j in combinations(range(len(columns)), 2)]
    alone = [F.struct(F.lit(i).alias("i"), F.lit(i).alias("j"), numbers[c].alias("x"), numbers[c].alias("y")) for i, c in enumerate(columns)]
    long = df.select(F.explode(F.array(*pairs, *alone)).alias("p")).select("p.*").filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    found = long.groupBy("i", "j").agg(F.corr("x", "y").alias("correlation"))
    # one row for each pair of columns
    names = [(a, b, min(i, j), max(i, j)) for i, a in enumerate(columns) for j, b in enumerate(columns)]
    cells = df.sparkSession.createDataFrame(names, "a string, b string, i int, j int")
    return cells.join(F.broadcast(found), ["i", "j"], "left").select("a", "b", "correlation")


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Rows per equal-width bin; the last bin includes the maximum. Empty bins are listed."""
    value = F.col(column).cast("double")
    present = df.filter(value.isNotNull()).select(value.alias("v"))
    ends = one_row(present.agg(F.min("v").alias("lo"), F.max("v").alias("hi")))
    width = (F.col("e.hi") - F.col("e.lo")) / bins
    place = F.when(width == 0, 0).otherwise(F.least(F.lit(bins - 1), F.floor((F.col("v") - F.col("e.lo")) / width)))
    counted = (
        present.withColumn("e", ends).groupBy(place.cast("int").alias("bin")).agg(F.count("*").alias("rows"))
    )
    frame = (
        present.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).select(F.struct("*").alias("e"))
        .withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
        .select("bin", (F.col("e.lo") + F.col("bin") * width).alias("starts"))
    )
    return frame.join(F.broadcast(counted), "bin", "left").select(
        "bin", "starts", F.coalesce("rows", F.lit(0)).alias("rows")
    )


def box_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Quartiles, whisker limits and the numbers of points beyond them, per column."""
    fences = _wide_quantiles(df, columns, QUARTILES)
    spread = F.col("q3") - F.col("q1")
    limits = fences.withColumns({"lower": F.col("q1") - 1.5 * spread, "upper": F.col("q3") + 1.5 * spread})
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in columns
    ])).alias("s")).select("s.*").filter(F.col("v").isNotNull() & ~F.isnan("v"))
    inside = (F.col("v") >= F.col("lower")) & (F.col("v") <= F.col("upper"))
    names = ["column_name", "q1", "median", "q3", "lower", "upper"]
    return long.join(F.broadcast(limits), "column_name").groupBy(*names).agg(
        F.min(F.when(inside, F.col("v"))).alias("low_whisker"),
        F.max(F.when(inside, F.col("v"))).alias("high_whisker"),
        F.count_if(F.col("v") < F.col("lower")).alias("below"),
        F.count_if(F.col("v") > F.col("upper")).alias("above"),
    )


def top_categories(df: DataFrame, column: str, n: int) -> DataFrame:
    return value_counts(df, column).limit(n)


def rows_per_user(df: DataFrame, user: str = "user_id") -> DataFrame:
    return df.groupBy(user).agg(F.count("*").alias("interactions"))


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows in the order of a seeded hash of the key: random, yet the same on every run."""
    return (
        df.withColumn("_h", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"))))
        .orderBy("_h", key).limit(n).drop("_h")
    )


def column_reports(df: DataFrame, kinds: dict[str, str] = COLUMN_KINDS) -> DataFrame:
    """(column_name, kind, nulls, non_nulls): what each column is for a profile; unlisted ones are other."""
    listed = {c: kinds.get(c, "other") for c in df.columns}
    kind = F.create_map(*[F.lit(x) for pair in listed.items() for x in pair])[F.col("column_name")]
    return null_counts(df).withColumn("kind", kind)


def quality_profile(df: DataFrame) -> DataFrame:
    """One row per column: rows, type, nulls, uniques, and for numbers mean, min and max.

    The number of surplus equal rows of the table stands on every row.
    """
    kinds = dict(column_types(df))
    numbers = set(numeric_columns(df))
    moments = {"mean": F.avg, "least": F.min, "most": F.max}

    def summary(c: str) -> list[Column]:
        number = F.col(c).cast("double") if c in numbers else F.lit(None).cast("double")
        return [fn(number).alias(n) for n, fn in moments.items()]

    row = df.agg(F.count("*").alias("_rows"), *[
        F.struct(F.count(c).alias("present"), *summary(c)).alias(f"_p{i}") for i, c in enumerate(df.columns)
    ])
    profile = _by_column(row, {
        c: {
            "kind": F.lit(kinds[c]), "rows": F.col("_rows"),
            "nulls": F.col("_rows") - F.col(f"_p{i}.present"), "non_nulls": F.col(f"_p{i}.present"),
            **{n: F.col(f"_p{i}.{n}") for n in moments},
        } for i, c in enumerate(df.columns)
    })
    surplus = duplicate_report(df).select("surplus").scalar()
    return profile.join(F.broadcast(unique_counts(df, df.columns)), "column_name", "left").withColumns(
        {"uniques": F.coalesce("uniques", F.lit(0)), "surplus_rows": surplus}
    )
