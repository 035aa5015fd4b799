"""Checks. Each gives rows (check, column_name, violations); run_checks raises on the hard ones.

All row checks of a table share one pass; only uniqueness and foreign keys need a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from marquee.functions.spread import salted_lookup
from marquee.schemas import (
    ENRICHED_COLUMNS, EXPORT_TEXT_COLUMNS, FOREIGN_KEYS, PRIMARY_KEYS,
)

REPLACEMENT_CHARACTER = "�"
SOFT_CHECKS = {"null"}
_REPORT = "check string, column_name string, violations bigint"


class CheckFailed(ValueError):
    """A hard check has violations."""


Rules = list[tuple[str, str, Column]]


def report(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows that break each rule (check, column_name, condition): one aggregate over the table for all of them."""
    row = df.agg(*[F.coalesce(F.sum(cond.cast("bigint")), F.lit(0)).alias(f"_{i}") for i, (_, _, cond) in enumerate(rules)])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(check).alias("check"), F.lit(c).alias("column_name"), F.col(f"_{i}").alias("violations"))
        for i, (check, c, _) in enumerate(rules)
    ])))


def check_columns(df: DataFrame, expected: list[str] = ENRICHED_COLUMNS) -> DataFrame:
    """Names and order. Reads the plan's schema only."""
    wrong = int(df.columns != list(expected))
    return df.sparkSession.createDataFrame([("columns", ",".join(df.columns), wrong)], _REPORT)


def check_types(df: DataFrame, key: str = "movie_id", text: list[str] = EXPORT_TEXT_COLUMNS) -> DataFrame:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    rows = [("type", key, int(not isinstance(kinds.get(key), T.IntegralType)))]
    rows += [("type", c, int(not isinstance(kinds.get(c), T.StringType))) for c in text]
    return df.sparkSession.createDataFrame(rows, _REPORT)


def null_rules(columns: list[str]) -> Rules:
    return [("null", c, F.col(c).isNull()) for c in columns]


def blank_rules(columns: list[str]) -> Rules:
    """Empty or white-space-only text; null is not blank."""
    return [("blank", c, F.trim(F.regexp_replace(c, r"\s", " ")) == "") for c in columns]


def replacement_char_rules(columns: list[str]) -> Rules:
    return [("replacement_char", c, F.coalesce(F.col(c).cast("string").contains(REPLACEMENT_CHARACTER), F.lit(False)))
            for c in columns]


def check_nulls(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return report(df, null_rules(columns or df.columns))


def check_blank(df: DataFrame, columns: list[str]) -> DataFrame:
    return report(df, blank_rules(columns))


def check_replacement_char(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return report(df, replacement_char_rules(columns or df.columns))


def check_valid_utf8(df: DataFrame, columns: list[str]) -> DataFrame:
    return report(df, [("utf8", c, ~F.is_valid_utf8(F.col(c))) for c in columns])


def duplicate_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keys that occur more than once with their number of rows."""
    return df.groupBy(*columns).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def duplicate_key_rows(df: DataFrame, key: str, salt_from: list[str]) -> DataFrame:
    """Every row whose key is not unique. A null key is one more key."""
    repeated = duplicate_keys(df, [key]).select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_k"),
                                                F.col(key).isNull().alias("_z"))
    tagged = df.withColumn("_k", F.coalesce(F.col(key).cast("string"), F.lit(""))).withColumn("_z", F.col(key).isNull())
    return salted_lookup(tagged, repeated, ["_k", "_z"], salt_from, how="left_semi").select(*df.columns)


def check_unique(df: DataFrame, key: str) -> DataFrame:
    """Rows that belong to a repeated key."""
    return duplicate_keys(df, [key]).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("violations")).select(
        F.lit("unique").alias("check"), F.lit(key).alias("column_name"), "violations"
    )


def check_primary_key(df: DataFrame, key: str, label: str | None = None) -> DataFrame:
    """Rows that belong to a repeated key, and rows without one, from one count per key."""
    rows = F.col("_rows")
    row = df.groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("_rows")).agg(
        F.sum(F.when(rows > 1, rows)).alias("unique"), F.sum(F.when(F.col("_k").isNull(), rows)).alias("key_null"))
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("check"), F.lit(label or key).alias("column_name"), F.coalesce(F.col(c), F.lit(0)).alias("violations"))
        for c in ("unique", "key_null")
    ])))


def check_foreign_key(child: DataFrame, column: str, parent: DataFrame, parent_column: str, label: str | None = None) -> DataFrame:
    """Child rows whose key has no parent; null keys are not checked.

    Child rows are counted per key first, so a key with a third of all rows is one row in the join.
    """
    counts = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_k")).agg(F.count("*").alias("_n"))
    parents = parent.select(F.col(parent_column).alias("_k"))
    return (
        counts.join(parents, "_k", "left_anti")
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("violations"))
        .select(F.lit("foreign_key").alias("check"), F.lit(label or column).alias("column_name"), "violations")
    )


def check_star(tables: dict[str, DataFrame]) -> DataFrame:
    """Declared primary and foreign keys of the 12 star tables."""
    parts = [
        check_primary_key(tables[t], k, f"{t}.{k}")
        for t, k in PRIMARY_KEYS.items()
    ]
    parts += [
        check_foreign_key(tables[c], ck, tables[p], pk, f"{c}.{ck}") for c, ck, p, pk in FOREIGN_KEYS
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def check_table(spark: SparkSession, name: str) -> dict[str, str]:
    """A warehouse table exists, has rows, and gives one sample row: column -> 'value (type)'."""
    if not spark.catalog.tableExists(name):
        raise CheckFailed(f"table {name} does not exist")
    sample = spark.table(name).limit(1).collect()
    if not sample:
        raise CheckFailed(f"table {name} has no rows")
    return {c: f"{v} ({type(v).__name__})" for c, v in sample[0].asDict().items()}


def export_checks(df: DataFrame, expected: list[str] = ENRICHED_COLUMNS, key: str = "movie_id") -> list[DataFrame]:
    """The checks of an export file in their order; later ones may rely on earlier ones.

    Names and types read the schema only, all row checks share one pass, uniqueness is another.
    """
    texts = [c for c in EXPORT_TEXT_COLUMNS if c in expected]
    described = [c for c in ("title", "overview") if c in df.columns]
    return [
        check_columns(df, expected), check_types(df, key, texts), check_unique(df, key),
        report(df, null_rules(df.columns) + blank_rules(described) + replacement_char_rules(df.columns)),
    ]


def run_checks(reports: list[DataFrame], strict: bool = False) -> list[tuple[str, str, int]]:
    """Run reports in order and raise at the first hard violation; return the soft findings.

    `strict` makes nulls a hard failure. Every report is a handful of rows.
    """
    soft = []
    for report in reports:
        bad = [tuple(r) for r in report.filter(F.col("violations") > 0).collect()]
        hard = [b for b in bad if strict or b[0] not in SOFT_CHECKS]
        if hard:
            raise CheckFailed("; ".join(f"{c} on {col}: {n}" for c, col, n in hard))
        soft += bad
    return soft
