"""Document fingerprints: the bottom-k sketch of five-word shingles, in DataFrame functions only.

Method: every shingle is hashed to 64 bits; the k smallest distinct hashes are the sketch. The sketch of
a union is the k smallest of both sketches, so parts merge in any order; the share of the merged sketch
that lies in both estimates resemblance; the k-th value estimates the number of distinct shingles, and
both together containment. Texts with fewer distinct shingles than k have exact values.

Defined cases: null text is empty; an empty text has the empty sketch; a text of one to four words is one
shingle; two empty sketches are alike (1.0), an empty and a full one are not (0.0); equal texts have equal
fingerprints; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.llm.common import bind, constant_array, text_of, words

K = 64
SHINGLE = 5
DOCS_A_BUCKET = 1024
MOST_BUCKETS = 1 << 16
HASHES = float(1 << 64)


def sketch(text: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    """The k smallest distinct shingle hashes, in ascending order."""
    def of(hashes: Column) -> Column:
        n = F.size(hashes)
        windows = F.transform(F.sequence(F.lit(1), n - (shingle - 1)), lambda i: F.xxhash64(F.slice(hashes, i, shingle)))
        short = F.when(n > 0, F.array(F.xxhash64(hashes))).otherwise(F.array().cast("array<bigint>"))
        return F.when(n >= shingle, windows).otherwise(short)

    hashed = F.transform(words(text), lambda w: F.xxhash64(w))
    return F.slice(F.sort_array(F.array_distinct(bind(hashed, of))), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two sets of shingles."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles among all shingles of both."""
    def share(both: Column) -> Column:
        return F.when(F.size(both) == 0, 1.0).otherwise(
            F.size(F.array_intersect(F.array_intersect(both, a), b)) / F.size(both))

    return bind(merge(a, b, k), share)


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    at = (F.element_at(a, -1).cast("double") + F.lit(HASHES / 2)) / F.lit(HASHES)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / at)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of `a` that `b` has too."""
    common = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), common / distinct_shingles(a, k)))


def as_text(a: Column) -> Column:
    """The sketch as hexadecimal digits, 16 a hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def fingerprint(docs: DataFrame, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id and sketch. Map-side only."""
    return docs.select("doc_id", sketch(text_of("text"), k, shingle).alias("sketch"))


def _bucket_of(value: Column, bounds: Column, buckets: int) -> Column:
    """How many bounds lie below the value, by halving; null comes after all."""
    halves = F.array(*[F.lit(buckets >> s) for s in range(1, buckets.bit_length())])
    found = F.aggregate(halves, F.lit(0), lambda at, step: F.when(value > F.get(bounds, at + step - 1), at + step).otherwise(at))
    return F.when(value.isNull(), buckets).otherwise(found)


def with_next(docs: DataFrame, carried: list[str]) -> DataFrame:
    """Each document beside the next one by doc_id (nulls last; the first follows the last).

    The ids are cut at sketched quantiles into buckets of about DOCS_A_BUCKET documents, whatever their
    number; each bucket also gets the documents that open the next one, so the text is shuffled once.
    Columns `carried` come back as they are and, of the next document, with the prefix next_.
    Repeated ids follow each other in an order given by their texts.
    """
    ids = docs.select("doc_id")
    rows = ids.count()
    buckets = 1
    while buckets < MOST_BUCKETS and buckets * DOCS_A_BUCKET < rows:
        buckets *= 2
    bucket: Column = F.lit(0)
    if buckets > 1:
        points = constant_array(i / buckets for i in range(1, buckets))
        bounds = ids.agg(F.percentile_approx(F.col("doc_id").cast("double"), points, 10 * buckets)).first()[0]
        if bounds:  # at most MOST_BUCKETS numbers; None if every id is null
            bucket = _bucket_of(F.col("doc_id").cast("double"), constant_array(bounds), buckets)
    # at most MOST_BUCKETS + 1 rows
    everything = Window.orderBy("bucket")
    opens = (
        ids.withColumn("bucket", bucket.cast("int")).groupBy("bucket").agg(F.min("doc_id").alias("opening"))
        .withColumn("into", F.coalesce(F.lag("bucket").over(everything), F.max("bucket").over(Window.partitionBy())))
        .select("opening", "into")
    )
    own = docs.select("doc_id", *carried, bucket.cast("int").alias("bucket"), F.lit(0).alias("guest"))
    guests = docs.join(F.broadcast(opens), F.col("doc_id").eqNullSafe(F.col("opening"))).select(
        "doc_id", *carried, F.col("into").alias("bucket"), F.lit(1).alias("guest"))
    line = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").asc_nulls_last(), F.xxhash64("text"))
    following = {f"next_{c}": F.lead(c).over(line) for c in carried}
    return own.unionByName(guests).withColumns(following).filter(F.col("guest") == 0).drop("guest", "bucket")


def compare_with_edits(docs: DataFrame, k: int = K) -> DataFrame:
    """Each document's sketch against that of its text with the second half taken from the next document."""
    body = docs.select("doc_id", text_of("text").alias("text")).withColumn("sketch", sketch(F.col("text"), k))
    paired = with_next(body, ["text", "sketch"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    return (
        paired.select("doc_id", n.cast("bigint").alias("n_chars"), edited.alias("edited"), "sketch", "next_sketch")
        .withColumn("edited_sketch", sketch(F.col("edited"), k))
        .select("doc_id", "n_chars", "edited", "sketch", "edited_sketch", "next_sketch",
                resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
                resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"))
    )
