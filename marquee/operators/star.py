"""Star schema: dimensions, bridges, movie dimension and fact, and the enriched views."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from marquee.functions import lists
from marquee.functions.spread import DIMENSION_ROWS, checked_lookup, dense_ids, fits_broadcast, salted_lookup
from marquee.schemas import (
    DIM_MOVIE_COLUMNS, ENRICHED_COLUMNS, FACT_MOVIE_COLUMNS, LIST_DIMENSIONS, STAR_SCHEMAS,
    ListDimension,
)

# Rows of one key from which its pairs are counted before they move, and numbers handed out per pair in one step.
_REPEAT_STEP = 10_000


def dimension_from_list(
    df: DataFrame, column: str, delimiter: str = ",", id_col: str = "id", value_col: str = "value",
    strict_reference: bool = False,
) -> DataFrame:
    """Distinct values of a delimited column with a gap-free id.

    `strict_reference` keeps the empty value that a stray delimiter yields.
    """
    values = _list_elements(df, column, delimiter, value_col, keep_empty=strict_reference).distinct()
    return dense_ids(values, [value_col], id_col).select(id_col, value_col)


def _list_elements(
    df: DataFrame, column: str, delimiter: str, value_col: str, *others: Column, keep_empty: bool = False
) -> DataFrame:
    """A row per element of lists.split_list, which is trimmed after the explode: there it is compiled."""
    parts = df.select(*others, F.explode(F.split(column, re.escape(delimiter))).alias(value_col))
    trimmed = parts.withColumn(value_col, F.trim(value_col))
    return trimmed if keep_empty else trimmed.filter(F.col(value_col) != "")


def bridge_from_list(
    df: DataFrame, dimension: DataFrame, key: str, column: str, value_col: str, id_col: str,
    delimiter: str = ", ", bridge_id: str = "bridge_id", movie_col: str = "movie_id",
    strict_reference: bool = False, broadcast_rows: int = 0,
) -> DataFrame:
    """(bridge_id, movie_id, dimension id) for every value of every row.

    A value repeated inside a list gives repeated rows. `strict_reference` splits on the literal
    delimiter, so that un-spaced lists lose their rows. The dimension is broadcast when a count
    shows that it has at most `broadcast_rows` rows; otherwise the look-up is salted by the row
    key, because one value may be carried by a third of all rows.

    Pairs move once, to be numbered. Where a key has so many rows that its pairs would pile up in one
    task (a null key, say), equal pairs are counted first and numbered together.
    """
    movie = F.col(key).alias(movie_col)
    pairs = df.select(movie, F.explode(lists.split_spaced(column, delimiter)).alias(value_col)) if strict_reference else (
        _list_elements(df, column, delimiter.strip() or delimiter, value_col, movie)
    )
    crowded = not df.groupBy(key).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > _REPEAT_STEP).isEmpty()
    if crowded:
        pairs = pairs.groupBy(movie_col, value_col).agg(F.count("*").alias("_times"))
    dims = dimension.select(value_col, id_col)
    found = checked_lookup(pairs, dims, [value_col], [movie_col], max_rows=broadcast_rows) if broadcast_rows else (
        salted_lookup(pairs, dims, [value_col], [movie_col])
    )
    if not crowded:
        return dense_ids(found.select(movie_col, id_col), [movie_col, id_col], bridge_id, write=True).select(bridge_id, movie_col, id_col)
    numbered = dense_ids(found.select(movie_col, id_col, "_times"), [movie_col, id_col], "_first", weight="_times", write=True)
    last_step = F.floor((F.col("_times") - 1) / _REPEAT_STEP)
    return (
        numbered.withColumn("_step", F.explode(F.sequence(F.lit(0).cast("bigint"), last_step)))
        .withColumn("_from", F.col("_first") + F.col("_step") * _REPEAT_STEP)
        .withColumn("_to", F.least(F.col("_first") + F.col("_times") - 1, F.col("_from") + _REPEAT_STEP - 1))
        .select(F.explode(F.sequence("_from", "_to")).alias(bridge_id), movie_col, id_col)
    )


def _typed(df: DataFrame, name: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in STAR_SCHEMAS[name].fields])


def movie_dimension(df: DataFrame) -> DataFrame:
    return _typed(df.select(F.col("id").alias("movie_id"), *DIM_MOVIE_COLUMNS), "dim_movie")


def movie_fact(df: DataFrame) -> DataFrame:
    return _typed(df.select(F.col("id").alias("movie_id"), *FACT_MOVIE_COLUMNS), "fact_movie")


def tables_without_bridges(df: DataFrame) -> Iterator[tuple[str, str, DataFrame]]:
    """Lazily yield (kind, name, table): movie dimension, fact, 5 dimensions."""
    yield "dim", "movie", movie_dimension(df)
    yield "fact", "movie", movie_fact(df)
    for spec in LIST_DIMENSIONS:
        yield "dim", spec.source, dimension_from_list(df, spec.source, id_col=spec.id_col, value_col=spec.value_col)


def star_tables(df: DataFrame) -> Iterator[tuple[str, str, DataFrame]]:
    """Lazily yield (kind, name, table): movie dimension, fact, 5 dimensions, 5 bridges.

    To yield a bridge is to join and order its pairs: who writes the dimensions first makes bridges from those.
    """
    dims: dict[str, DataFrame] = {}
    for kind, name, table in tables_without_bridges(df):
        dims[name] = table
        yield kind, name, table
    for spec in LIST_DIMENSIONS:
        yield "bridge", spec.source, bridge_for(df, dims[spec.source], spec)


def bridge_for(
    df: DataFrame, dimension: DataFrame, spec: ListDimension, broadcast_rows: int = 0
) -> DataFrame:
    return bridge_from_list(
        df, dimension, "id", spec.source, spec.value_col, spec.id_col, broadcast_rows=broadcast_rows
    )


def values_per_movie(
    bridge: DataFrame, dimension: DataFrame, id_col: str, value_col: str, out: str
) -> DataFrame:
    """Sorted distinct values of each movie as one string, one row per movie.

    Pairs named in place go straight into the sets; those that must be shuffled to their names are made distinct first.
    """
    pairs, names = bridge.select("movie_id", id_col), dimension.select(id_col, value_col)
    if fits_broadcast(names, DIMENSION_ROWS):
        named = pairs.join(F.broadcast(names), id_col)
    else:
        named = salted_lookup(pairs.distinct(), names, [id_col], ["movie_id"])
    return named.groupBy("movie_id").agg(
        F.array_join(F.sort_array(F.collect_set(value_col)), ", ").alias(out)
    )


def enriched_view(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per movie, 18 columns, from the 12 written star tables keyed by table name.

    Every bridge is folded to one row per movie before it is joined, so list sizes never multiply
    and all joins share the one key movie_id. From tables bucketed by movie_id nothing is shuffled for
    them, nor for the folds whose dimension is small.
    """
    movies = tables["dim_movie"].join(tables["fact_movie"], "movie_id", "left")
    folded = [
        values_per_movie(tables[d.bridge], tables[d.dim], d.id_col, d.value_col, d.export_col)
        for d in LIST_DIMENSIONS
    ]
    wide = reduce(lambda left, right: left.join(right, "movie_id", "left"), folded, movies)
    return wide.select(*ENRICHED_COLUMNS)


def enriched_view_by_title(tables: dict[str, DataFrame]) -> DataFrame:
    """title, genres, keywords, overview; movies with equal title and overview are merged."""
    movies = tables["dim_movie"].select("movie_id", "title", "overview")
    groups = movies.select("title", "overview").distinct()
    out = groups
    for d in LIST_DIMENSIONS[:2]:
        ids = tables[d.bridge].select("movie_id", d.id_col).distinct()
        # distinct (title, overview, value id) first: copies of one movie collapse before the look-up
        merged = movies.join(ids, "movie_id").select("title", "overview", d.id_col).distinct()
        named = checked_lookup(
            merged, tables[d.dim].select(d.id_col, d.value_col), [d.id_col], ["title", "overview"]
        )
        listed = named.groupBy("title", "overview").agg(
            F.array_join(F.sort_array(F.collect_set(d.value_col)), ", ").alias(d.export_col)
        )
        right = listed.select(
            F.col("title").alias("_t"), F.col("overview").alias("_o"), d.export_col
        )
        out = out.join(
            right, F.col("title").eqNullSafe(F.col("_t")) & F.col("overview").eqNullSafe(F.col("_o")), "left"
        ).drop("_t", "_o")
    return out.select("title", "genres", "keywords", "overview")


def list_values(df: DataFrame, column: str, value: str = "value") -> DataFrame:
    """One row per element of a delimited column."""
    return df.select(F.explode(lists.split_list(column)).alias(value))


def group_stats(df: DataFrame, column: str, out: str) -> DataFrame:
    """Movies, mean rating, votes, mean popularity and mean revenue for each list value.

    A null list counts as the value ''. Means and sums are combined in each task before the
    shuffle, so a value carried by most rows costs one row per task.
    """
    values = lists.split_list(F.coalesce(F.col(column), F.lit("")), keep_empty=True)
    measures = [c for c in ("vote_average", "vote_count", "popularity", "revenue") if c in df.columns]
    aggs: dict[str, Column] = {
        "vote_average": F.avg("vote_average").alias("avg_rating"),
        "vote_count": F.sum("vote_count").alias("total_votes"),
        "popularity": F.avg("popularity").alias("avg_popularity"),
        "revenue": F.avg("revenue").alias("avg_revenue"),
    }
    return (
        df.select(F.explode(values).alias(out), *measures)
        .groupBy(out)
        .agg(F.count("*").alias("movie_count"), *[aggs[m] for m in measures])
    )


def top_group_stats(df: DataFrame, column: str, out: str, n: int, by: str = "total_votes") -> DataFrame:
    return group_stats(df, column, out).orderBy(F.desc(by), F.asc(out)).limit(n)
