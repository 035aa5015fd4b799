"""Corpus pipeline: five stages from raw documents to packed training sequences.

Every stage but the last returns the columns of documents. Null texts and ids are carried through as each
operator defines; rows are told apart by doc_id, or by their text where doc_id is null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from marquee.llm import mixing, packing, quality_classifier, secrets, simhash
from marquee.llm.common import text_of
from marquee.sources.scratch import keep

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

ORACLE_SQL = None  # models, 64-bit hashes and a tokenizer: the stages are tested against brute force instead


def _unused(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name = f"_{name}"
    return name


def _row_key() -> Column:
    """doc_id, or above all usual ids a number made of the text."""
    made = F.xxhash64(text_of("text")).bitwiseAND((1 << 62) - 1) + F.lit(1 << 62)
    return F.coalesce(F.col("doc_id").cast("bigint"), made)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents it rejects go."""
    model = quality_classifier.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = _unused(docs, "score")
    return quality_classifier.with_score(docs, model, score).filter(F.col(score) >= 0.5).drop(score)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates (three-word shingles, three bits): of each group one row stays, by doc_id and whole row."""
    row, whole = (_unused(docs, name) for name in ("row_key", "whole"))
    keyed = docs.withColumns({row: _row_key(), whole: F.xxhash64(*[F.col(c) for c in docs.columns])})
    rows = keyed.select(F.col(row).alias("doc_id"), F.col(whole).alias("whole"), "text")
    grouped = simhash.near_duplicates(rows, carried=("whole",))
    first = grouped.groupBy("root").agg(F.min(F.struct("doc_id", "whole")).alias("_f")).select(
        F.col("_f.doc_id").alias(row), F.col("_f.whole").alias(whole))
    return keyed.join(keep(first, "survivors"), [row, whole], "left_semi").dropDuplicates([row, whole]).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scan: spans are replaced by marks, and n_chars follows."""
    clean = secrets.mask_secrets(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.coalesce(F.length("text").cast(dict(docs.dtypes)["n_chars"]), F.col("n_chars")))
    return clean.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: every document stands in the result as often as the mix takes it (0 to 2 times)."""
    row, nth, copies = _unused(docs, "row_key"), _unused(docs, "nth"), _unused(docs, "copies")
    keyed = docs.withColumn(row, _row_key())
    plan = mixing.mix(keyed.select(F.col(row).alias("doc_id"), "text", "source"))
    # rows that repeat an id, the same source and size, share their decisions out in any order
    same = Window.partitionBy(row).orderBy("source", "size")
    decided = plan.select(F.col("doc_id").alias(row), "source", "size", F.col("copies").alias(copies)).withColumn(
        nth, F.row_number().over(same)).filter(F.col(copies) > 0).select(row, nth, copies)
    size = _unused(docs, "size")
    sized = keyed.withColumn(size, mixing.size_of())
    numbered = sized.withColumn(nth, F.row_number().over(Window.partitionBy(row).orderBy(F.col("source").cast("string"), size)))
    taken = numbered.join(decided, [row, nth])
    return taken.withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing into sequences of 2048 tokens: one row per piece."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_good),
    ("simhash_near_dedup", drop_near_copies),
    ("secret_scan", mask_secrets),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
