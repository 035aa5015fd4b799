"""Outlier filters: IQR fences, z-score, isolation forest."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from marquee.functions.spread import exact_quantiles, one_row

# Task functions travel by value, so executors need numpy and pandas but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TREES = 100
TREE_ROWS = 256


def iqr_limits(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, q1, q3, iqr, lower, upper)."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.75]).groupBy("column_name").agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("q3"),
    )
    iqr = F.col("q3") - F.col("q1")
    return quartiles.withColumns({
        "iqr": iqr, "lower": F.col("q1") - 1.5 * iqr, "upper": F.col("q3") + 1.5 * iqr,
    })


def iqr_filter(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows inside the fences of every column; a null is outside."""
    limits = iqr_limits(df, columns).agg(*[
        F.max(F.when(F.col("column_name") == c, F.struct("lower", "upper"))).alias(f"_l{i}")
        for i, c in enumerate(columns)
    ])
    tests = [
        F.col(c).cast("double").between(F.col(f"_lim._l{i}.lower"), F.col(f"_lim._l{i}.upper"))
        for i, c in enumerate(columns)
    ]
    return df.withColumn("_lim", one_row(limits)).filter(reduce(and_, tests)).drop("_lim")


def zscore_filter(df: DataFrame, columns: list[str], limit: float = 3.0) -> DataFrame:
    """Rows with |x - mean| < limit * population deviation in every column; a null fails."""
    moments = one_row(df.agg(*[
        F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(f"_m{i}")
        for i, c in enumerate(columns)
    ]))
    tests = [
        (F.abs(F.col(c) - F.col(f"_mom._m{i}.mean")) / F.nullif(F.col(f"_mom._m{i}.std"), F.lit(0.0))) < limit
        for i, c in enumerate(columns)
    ]
    return df.withColumn("_mom", moments).filter(reduce(and_, tests)).drop("_mom")


# --- isolation forest on one column ---------------------------------------------------------


def _mean_path(n: np.ndarray | float):
    """Expected depth of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3.0)
    deep = 2.0 * (np.log(big - 1.0) + np.euler_gamma) - 2.0 * (big - 1.0) / big
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, deep))


def _draw(*parts: object) -> str:
    return hashlib.md5("|".join(str(p) for p in parts).encode()).hexdigest()


def _grow(values: np.ndarray, seed: int, tree: int, limit: int) -> list[tuple[float, float]]:
    """One random tree over one column as steps: above `start` the path length is `depth`.

    Nodes are numbered like a heap; seed, tree and node decide where a node is cut, so any engine that has
    md5 can grow the same tree.
    """
    steps: list[tuple[float, float]] = []
    todo = [(np.sort(values), 1, 0, -np.inf)]
    while todo:
        part, node, depth, start = todo.pop()
        if depth >= limit or len(part) <= 1 or part[0] == part[-1]:
            steps.append((start, depth + float(_mean_path(len(part)))))
            continue
        cut = part[0] + int(_draw(seed, tree, node)[:8], 16) / 4294967296.0 * (part[-1] - part[0])
        at = int(np.searchsorted(part, cut, side="right"))
        todo.append((part[:at], 2 * node, depth + 1, start))
        todo.append((part[at:], 2 * node + 1, depth + 1, cut))
    return sorted(steps)


def _forest_steps(df: DataFrame, column: str, key: str, seed: int, trees: int, tree_rows: int) -> DataFrame:
    """Trees as rows (tree, start, depth, size), grown in parallel from one pool of sampled values.

    The pool holds trees * tree_rows values at most, however large the table: those with the
    smallest md5 of seed and key. Each tree takes the rows of the pool with the smallest md5 of seed, tree and key.
    """
    name = F.col(key).cast("string")
    pool = (
        df.filter(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double")))
        .select(F.col(column).cast("double").alias("v"), F.md5(F.concat_ws("|", F.lit(str(seed)), name)).alias("h"), F.col(key).alias("k"), name.alias("name"))
        .orderBy("h", "k").limit(trees * tree_rows)
        .agg(F.sort_array(F.collect_list(F.struct("k", "name", "v"))).alias("pool"))
    )

    def grow(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for tree, pool in zip(part["id"], part["pool"]):
                if not len(pool):
                    continue
                tree = int(tree)
                drawn = sorted((_draw(seed, tree, r["name"]), i) for i, r in enumerate(pool))[:tree_rows]  # the pool is in order of keys
                values = np.array([pool[i]["v"] for _, i in drawn], dtype=float)
                steps = _grow(values, seed, tree, int(np.ceil(np.log2(max(len(values), 2)))))
                yield pd.DataFrame({"tree": tree, "start": [s for s, _ in steps], "depth": [d for _, d in steps], "size": len(values)})

    rows = df.sparkSession.range(trees).withColumn("pool", pool.scalar())
    return rows.mapInPandas(grow, "tree int, start double, depth double, size int")


def isolation_scores(
    df: DataFrame, column: str, key: str, seed: int = 42, trees: int = TREES, tree_rows: int = TREE_ROWS,
    out: str = "score",
) -> DataFrame:
    """Anomaly score 2^(-mean path / expected path) of every row; null where the value is null.

    The forest is bounded by its parameters (about trees * tree_rows steps), not by the table, so
    it travels to the tasks inside the scoring function.
    """
    forest = _forest_steps(df, column, key, seed, trees, tree_rows).toPandas()
    grown = [g.sort_values("start") for _, g in forest.groupby("tree")]
    size = max((int(g["size"].iloc[0]) for g in grown), default=1)
    # sum of the trees' step functions: one sorted list of starts with the mean path from there on
    starts = np.unique(np.concatenate([g["start"].to_numpy() for g in grown])) if grown else np.array([-np.inf])
    total = np.zeros(len(starts))
    for g in grown:
        at = np.searchsorted(g["start"].to_numpy(), starts, side="right") - 1  # a step holds above its start, so up to the next start
        total += g["depth"].to_numpy()[at]
    paths = total / max(len(grown), 1)
    scores = np.round(np.power(2.0, -paths / max(float(_mean_path(size)), 1e-12)), 9)

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            at = np.clip(np.searchsorted(starts, part.to_numpy(dtype=float), side="left") - 1, 0, None)
            yield pd.Series(np.where(part.isna(), np.nan, scores[at]))

    return df.withColumn(out, F.nanvl(score(F.col(column).cast("double")), F.lit(None).cast("double")))


def isolation_forest_filter(
    df: DataFrame, columns: list[str], key: str, contamination: float = 0.05, seed: int = 42
) -> DataFrame:
    """Rows that no column's forest counts among its `contamination` most isolated values."""
    out = df
    for i, c in enumerate(columns):
        out = isolation_scores(out, c, key, seed, out=f"_s{i}")
    names = [f"_s{i}" for i in range(len(columns))]
    cuts = exact_quantiles(out.select(*names), names, [1 - contamination]).agg(*[
        F.max(F.when(F.col("column_name") == n, F.col("value"))).alias(n) for n in names
    ])
    kept = out.withColumn("_cut", one_row(cuts))
    return kept.filter(reduce(and_, [F.col(n) <= F.col(f"_cut.{n}") for n in names])).drop("_cut", *names)
