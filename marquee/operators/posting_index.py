"""A stored index for similarity requests: built once from a catalog, then asked often.

Three tables lie in the index folder, each dealt into buckets by the hash of what it is asked for and sorted
by it inside the files: postings by term, vectors by item, titles by title. A request names its buckets and
values as literals, so Spark lists only those buckets (partition pruning) and reads only the row groups whose
statistics hold a wanted value (pushed filters). A bucket with many rows, or long lists in them, has several files, so
a frequent term is written and read by several tasks, and a task's share does not follow the catalog.

Requests of more than MOST_TERMS distinct terms read the postings through a join on bucket and term instead.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marquee.functions.spread import salted_lookup, top_n
from marquee.operators import terms
from marquee.sources.scratch import keep

BUCKET_ROWS = 500_000   # rows a bucket is meant to hold
MOST_BUCKETS = 4_096
FILE_ROWS = 1_000_000   # rows of a bucket, and elements of the lists in them, that one file holds
MOST_TERMS = 5_000      # terms a request names as literals
MOST_SEEDS = 1_000      # seeds a request names as literals
LEAST_IDS = 1_000       # smallest ids kept for filling short lists


def _bucket(value: Column, buckets: int) -> Column:
    """As rows dealt by the hash of the value lie: parts that are a multiple of the buckets hold rows of one bucket each."""
    return F.pmod(F.hash(F.xxhash64(value)), F.lit(buckets)).cast("int")


def _write_dealt(rows: DataFrame, key: str, path: str, many: int) -> int:
    """As _write, for about `many` rows that `_h`, the hash of the key, has dealt already: they move no more. A part is a file or more."""
    wanted = min(MOST_BUCKETS, max(1, -(-many // BUCKET_ROWS)))
    buckets = 1 << (wanted.bit_length() - 1)  # parts are a power of two
    placed = rows.drop("_h").withColumn("bucket", _bucket(F.col(key), buckets)).sortWithinPartitions("bucket", key)
    placed.write.option("compression", "zstd").partitionBy("bucket").parquet(path)
    return buckets


def _write(rows: DataFrame, key: str, path: str) -> int:
    """Write rows under bucket folders, sorted by `key` in each file; the number of buckets."""
    buckets = min(MOST_BUCKETS, max(1, -(-rows.count() // BUCKET_ROWS)))
    placed = rows.withColumn("bucket", _bucket(F.col(key), buckets))
    listed = [F.greatest(F.size(c), F.lit(0)) for c, kind in rows.dtypes if kind.startswith("array")]
    width = reduce(add, listed, F.lit(1)).cast("bigint")
    files = keep(placed.groupBy(F.col("bucket").alias("_b")).agg(F.ceil(F.sum(width) / FILE_ROWS).cast("int").alias("_files")), "files")  # a row a bucket
    parts = max(1, files.agg(F.sum("_files")).first()[0] or 0)
    # what can be told from a row again is not moved with it
    dealt = rows.join(F.broadcast(files), _bucket(F.col(key), buckets) == F.col("_b")).drop("_b").repartition(
        parts, _bucket(F.col(key), buckets), F.pmod(F.xxhash64("id", F.lit(1)), F.col("_files")))
    sorted_rows = dealt.drop("_files").withColumn("bucket", _bucket(F.col(key), buckets)).sortWithinPartitions("bucket", key)
    sorted_rows.write.option("compression", "zstd").partitionBy("bucket").parquet(path)
    return buckets


@dataclass(frozen=True)
class PostingIndex:
    """Paths and layout of a stored index; `features` lists (name, weight, as_sets)."""

    spark: SparkSession
    path: str
    features: list[tuple[str, float, bool]]
    buckets: dict[str, int]

    def _read(self, name: str, key: str, values: list) -> DataFrame:
        """Rows of a table whose key is one of the values, by bucket and by pushed filter."""
        rows = self.spark.read.parquet(f"{self.path}/{name}")
        if not values:
            return rows.filter(F.lit(False))
        kind = dict(rows.dtypes)[key]
        asked = self.spark.createDataFrame([(v,) for v in values], f"v {kind}").select(_bucket(F.col("v"), self.buckets[name])).distinct()
        numbers = sorted(r[0] for r in asked.collect())  # at most one for each value
        return rows.filter(F.col("bucket").isin(numbers) & F.col(key).isin(values))

    def seeds_by_title(self, titles: list) -> tuple[DataFrame, DataFrame]:
        """As terms.seeds_by_title, from the titles' buckets."""
        return terms.seeds_by_title(self._read("titles", "title", [t for t in dict.fromkeys(titles) if isinstance(t, str)]), titles)

    def seeds_by_id(self, ids: list) -> tuple[DataFrame, DataFrame]:
        """As terms.seeds_by_id, from the items' buckets."""
        good = []
        for i in ids:
            try:
                good.append(int(i))
            except (TypeError, ValueError):
                continue
        return terms.seeds_by_id(self._read("items", "id", list(dict.fromkeys(good))), ids)

    def postings_of(self, name: str, seed_terms: DataFrame) -> DataFrame:
        """(id, term, size, w, seed_id, seed_size, seed_w) for all items that share a term with a seed."""
        found = seed_terms.select("term").distinct().limit(MOST_TERMS + 1).collect()
        if len(found) <= MOST_TERMS:
            rows = self._read(f"postings-{name}", "term", [r["term"] for r in found]).drop("bucket")
            return rows.join(F.broadcast(seed_terms), "term") if terms.fits_broadcast(seed_terms) else salted_lookup(rows, seed_terms, ["term"], ["id"])
        rows = self.spark.read.parquet(f"{self.path}/postings-{name}")
        placed = seed_terms.withColumn("bucket", _bucket(F.col("term"), self.buckets[f"postings-{name}"]))
        return rows.join(placed, ["bucket", "term"]).drop("bucket")

    def similar(self, seeds: DataFrame, n: int = 10, nearest: int | None = None) -> DataFrame:
        """As terms.similar_to_seeds with the stored features: (seed_id, rank, item_id, score)."""
        asked = [r["seed_id"] for r in seeds.select("seed_id").distinct().limit(MOST_SEEDS + 1).collect()]
        parts = None
        for name, weight, as_sets in self.features:
            if len(asked) <= MOST_SEEDS:
                wanted = self._read(f"vectors-{name}", "id", asked)
            else:
                wanted = self.spark.read.parquet(f"{self.path}/vectors-{name}").join(seeds.select(F.col("seed_id").alias("id")).distinct(), "id", "left_semi")
            seed_terms = terms.postings(wanted).select(F.col("id").alias("seed_id"), F.col("size").alias("seed_size"), "term", F.col("w").alias("seed_w"))
            pairs = terms.pair_scores(self.postings_of(name, seed_terms), as_sets)
            part = terms.nearest_only(pairs, nearest if not as_sets else None).select("seed_id", "item_id", (F.col("score") * weight).alias("score"))
            parts = part if parts is None else parts.unionByName(part)
        if 2 * n + 2 <= LEAST_IDS:
            least = self.spark.read.parquet(f"{self.path}/least").orderBy("id").limit(2 * n + 2)
        else:
            least = self.spark.read.parquet(f"{self.path}/items").select("id").orderBy("id").limit(2 * n + 2)
        return terms.blend(parts, seeds, least, n)


def build_index(catalog: DataFrame, path: str, **weights: float) -> PostingIndex:
    """Write the index of a catalog (id, title, genres, overview, keywords) to `path`."""
    names = ("genres", "overview", "keywords")
    features, buckets = [], {}
    short = keep(catalog.drop("overview"), "catalog")  # texts are read where their words are counted, and not stored
    many = short.count()
    for name, (vectors, weight, as_sets) in zip(names, terms.dealt_features(short, catalog, **weights)):
        features.append((name, weight, as_sets))
        stored = f"{path}/vectors-{name}"
        if "_h" in vectors.columns:
            buckets[f"vectors-{name}"] = _write_dealt(vectors, "id", stored, many)
        else:
            buckets[f"vectors-{name}"] = _write(vectors, "id", stored)
        written = catalog.sparkSession.read.parquet(stored).drop("bucket")
        buckets[f"postings-{name}"] = _write(terms.postings(written), "term", f"{path}/postings-{name}")
    listed = short.select("id", "title")
    buckets["titles"] = _write(listed, "title", f"{path}/titles")
    buckets["items"] = _write(listed, "id", f"{path}/items")
    listed.select("id").orderBy("id").limit(LEAST_IDS).coalesce(1).write.parquet(f"{path}/least")
    return PostingIndex(catalog.sparkSession, path, features, buckets)
