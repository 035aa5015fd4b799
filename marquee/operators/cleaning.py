"""Row filters, typed casts and multi-value cleaning of the raw catalog."""

from __future__ import annotations

import logging
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from marquee.functions import lists
from marquee.functions.spread import fits_broadcast, one_row, salted_lookup, top_n

log = logging.getLogger(__name__)

SHORT_LIST = 2_000  # reference values compared in place


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.drop(*names)


def drop_null_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.drop(subset=columns)


def dedup_by_key(df: DataFrame, key: list[str], order: list[Column] | None = None) -> DataFrame:
    """One row per key, the first under a total order (all other columns by default).

    Each task keeps one row per key before the shuffle, so copies of one key never pile up.
    """
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in key]
    return top_n(df, key, [*(order or []), *rest] or [F.lit(1)], 1, "_first").drop("_first")


def drop_equal_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def cast_columns(df: DataFrame, kinds: dict[str, T.DataType]) -> DataFrame:
    """Cast; a value that does not fit becomes null instead of failing the run."""
    return df.withColumns({c: F.col(c).try_cast(kind) for c, kind in kinds.items()})


def parse_date(df: DataFrame, column: str, pattern: str = "yyyy-MM-dd") -> DataFrame:
    parsed = F.try_to_timestamp(F.col(column).cast("string"), F.lit(pattern)).cast("date")
    return df.withColumn(column, parsed)


def date_between(df: DataFrame, column: str, first: str | None, last: str | None) -> DataFrame:
    """Inclusive range; null dates are dropped."""
    tests = [F.col(column).isNotNull()]
    if first:
        tests.append(F.col(column) >= F.lit(first).cast("date"))
    if last:
        tests.append(F.col(column) <= F.lit(last).cast("date"))
    return df.filter(reduce(and_, tests))


def fill_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.fillna(0, subset=columns)


def keep_nonnegative(df: DataFrame, columns: list[str], strict: bool = False) -> DataFrame:
    tests = [(F.col(c) > 0) if strict else (F.col(c) >= 0) for c in columns]
    return df.filter(reduce(and_, tests))


def keep_equal(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def keep_whitelisted(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Keep a row only if every element of its list is allowed."""
    return df.filter(lists.all_listed(column, allowed))


def strip_double_quotes(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    for name in columns or []:
        if name not in df.columns:
            log.warning("column %s is not in the table, skipped", name)
            continue
        df = df.withColumn(name, lists.strip_quotes(name))
    return df


def normalize_list(
    df: DataFrame, key: str, column: str, reference: DataFrame, reference_column: str
) -> DataFrame:
    """Rewrite a multi-value column to the lower-case values found in a reference list.

    Unknown values go, repeated ones stay, the values come out sorted, and a row without any known
    value or without a key disappears. The list is counted first: a short one (country names) is
    compared in place, a long one is joined; both give the same rows.
    """
    df = df.filter(F.col(key).isNotNull())
    if fits_broadcast(reference, SHORT_LIST):
        return _normalize_in_place(df, column, reference, reference_column)
    return normalize_by_large_reference(df, key, column, reference, reference_column)


def normalize_by_reference(
    df: DataFrame, column: str, reference: DataFrame, reference_column: str
) -> DataFrame:
    """normalize_list for a list known to be short: one aggregate row that is compared inside each array, so
    no row is exploded and nothing is shuffled. A list that proves long is refused."""
    if not fits_broadcast(reference, SHORT_LIST):
        raise ValueError(f"more than {SHORT_LIST} reference values: use normalize_by_large_reference")
    return _normalize_in_place(df, column, reference, reference_column)


def _normalize_in_place(df: DataFrame, column: str, reference: DataFrame, reference_column: str) -> DataFrame:
    known = reference.agg(F.collect_set(F.lower(F.trim(reference_column)))).scalar()
    values = F.transform(lists.split_list(column, keep_empty=True), lambda x: F.lower(x))
    return (
        df.withColumn("_known", known)
        .withColumn("_kept", F.sort_array(lists.keep_listed(values, F.col("_known"))))
        .filter(F.size("_kept") > 0)
        .withColumn(column, F.array_join("_kept", ", "))
        .drop("_known", "_kept")
    )


def normalize_by_large_reference(
    df: DataFrame, key: str, column: str, reference: DataFrame, reference_column: str
) -> DataFrame:
    """normalize_list through an exploded join, for a list of any length.

    Rows without a key go; rows that share a key keep their own lists. Repeats of a value inside a
    row are counted before the join, and the join is salted by the key, so a value found in most rows
    is spread over many tasks.
    """
    own = F.col(column).alias("_own")
    values = (
        df.select(key, own).distinct().select(key, "_own", F.explode(lists.split_list("_own", keep_empty=True)).alias("_v"))
        .groupBy(key, "_own", F.lower("_v").alias("_v")).agg(F.count("*").alias("_times"))
    )
    known = reference.select(F.lower(F.trim(reference_column)).alias("_v")).distinct()
    kept = (
        salted_lookup(values, known, ["_v"], [key])
        .groupBy(key, "_own")
        .agg(F.sort_array(F.collect_list(F.struct("_v", "_times"))).alias("_list"))
        .select(key, "_own", F.array_join(F.flatten(F.transform(
            "_list", lambda s: F.array_repeat(s["_v"], s["_times"].cast("int")))), ", ").alias("_text"))
    )
    position = {c: F.col("_text").alias(c) if c == column else F.col(c) for c in df.columns}
    return df.withColumn("_own", F.col(column)).join(kept, [key, "_own"]).select(*position.values())


# --- predicates and look-ups used on any table ---------------------------------------------


def where_equal(df: DataFrame, **values) -> DataFrame:
    return df.filter(reduce(and_, [F.col(c) == F.lit(v) for c, v in values.items()]))


def where_contains(df: DataFrame, column: str, text: str) -> DataFrame:
    """Case-insensitive substring; null does not match."""
    return df.filter(F.lower(F.col(column)).contains(text.lower()))


def where_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return df.filter(F.col(column).startswith(prefix))


def where_in(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.filter(F.col(column).isin(values))


def where_null(df: DataFrame, column: str, is_null: bool = True) -> DataFrame:
    return df.filter(F.col(column).isNull() if is_null else F.col(column).isNotNull())


def where_length(df: DataFrame, column: str, length: int) -> DataFrame:
    return df.filter(F.length(column) == length)


def where_extreme_length(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text is as short or as long as any in the column."""
    ends = one_row(df.agg(F.min(F.length(column)).alias("lo"), F.max(F.length(column)).alias("hi")))
    return (
        df.withColumn("_ends", ends)
        .filter(F.length(column).isin(F.col("_ends.lo"), F.col("_ends.hi")))
        .drop("_ends")
    )


def lemmatize(df: DataFrame, key: str, column: str, dictionary: DataFrame) -> DataFrame:
    """Replace every word found in a (word, lemma) dictionary, keeping word order.

    A dictionary that a count shows to be small is broadcast, so words meet their lemmas in place and are shuffled
    once, packed by row. Otherwise they are looked up once per distinct word of a row, salted by the row key.
    """
    words = df.select(key, F.posexplode(F.filter(F.split(column, r"\s+"), lambda w: w != "")).alias("_at", "_w"))
    lemmas = dictionary.select(F.col("word").alias("_w"), F.col("lemma").alias("_lemma"))
    lemma = F.coalesce("_lemma", "_w")
    if fits_broadcast(lemmas):
        found = words.join(F.broadcast(lemmas), "_w", "left")
        placed = F.collect_list(F.struct(F.col("_at").alias("p"), lemma.alias("t")))
    else:
        # distinct (row, word) pairs carry the list of positions of the word
        spots = words.groupBy(key, "_w").agg(F.collect_list("_at").alias("_spots"))
        found = salted_lookup(spots, lemmas, ["_w"], [key], how="left")
        placed = F.flatten(F.transform(F.collect_list(F.struct("_spots", lemma.alias("_out"))), lambda s: F.transform(
            s["_spots"], lambda p: F.struct(p.alias("p"), s["_out"].alias("t")))))
    joined = found.groupBy(key).agg(placed.alias("_l")).select(
        key, F.array_join(F.transform(F.sort_array("_l"), lambda s: s["t"]), " ").alias("_text"))
    out = [F.coalesce("_text", F.lit("")).alias(c) if c == column else F.col(c) for c in df.columns]
    return df.join(joined, key, "left").select(*out)
