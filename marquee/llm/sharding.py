"""Sharding by jump consistent hashing, in DataFrame functions only.

Method: a key owns a pseudo-random sequence of jumps 0 = b0 < b1 < b2 < ... that does not depend on the
number of shards; with n shards the key lives at the last jump below n. Appending shard n therefore
moves exactly the keys whose sequence holds the value n, about 1 / (n + 1) of them, and only into n. The
published form draws the sequence from a 64-bit linear generator; here draw i is xxhash64(key, i),
because Spark's integer product does not wrap under ANSI rules. The law of the jumps is the same.

Defined cases: a null key is a key like any other (all null keys share a shard); null text has size 0
and the checksum of the empty text; repeated rows share a shard and take one slot each; an empty table
gives an empty table; columns other than doc_id and text are neither read nor returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marquee.llm.common import bind, numbered, text_of

SHARDS = 40
ROW_BYTES = 16
FEW_JUMPS = 12  # all but a few keys in a million need no more; the rest go on to the full bound


def _jump(state: Column, key: Column, step: Column, shards: int) -> Column:
    draw = F.shiftrightunsigned(F.xxhash64(key, step), 33) + 1
    landing = F.floor((state["next"] + 1) * (F.lit(float(1 << 31)) / draw)).cast("bigint")
    moved = F.struct(state["next"].alias("at"), landing.alias("next"))
    return F.when(state["next"] < shards, moved).otherwise(state)


def jump_hash(key: Column, shards: int) -> Column:
    """struct(at, next): the shard among `shards`, and the jump after it (at least `shards`)."""
    start = F.struct(F.lit(-1).cast("bigint").alias("at"), F.lit(0).cast("bigint").alias("next"))

    def run(state: Column, first: int, last: int) -> Column:
        return F.aggregate(F.sequence(F.lit(first), F.lit(last)), state, lambda s, i: _jump(s, key, i, shards))

    # a jump moves by one at least, so shards + 1 draws always suffice
    return bind(run(start, 0, FEW_JUMPS), lambda s: F.when(s["next"] >= shards, s).otherwise(
        run(s, FEW_JUMPS + 1, FEW_JUMPS + shards + 1)))


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: size, text checksum, shard, slot in the shard, shard with one more shard."""
    body = text_of("text")
    placed = docs.select(
        "doc_id",
        (F.octet_length(body) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(body).cast("bigint").alias("text_crc32"),
        jump_hash(F.xxhash64("doc_id"), shards).alias("jump"),
    ).select(
        "doc_id", "size", "text_crc32", F.col("jump.at").cast("int").alias("shard"),
        F.when(F.col("jump.next") == shards, shards).otherwise(F.col("jump.at")).cast("int").alias("grown_shard"),
    )
    order = [F.col("doc_id").asc_nulls_last(), F.col("text_crc32")]
    # any one shard may be hot, so the count of all rows (read from file footers) bounds it
    return numbered(placed, ["shard"], ["doc_id", "text_crc32"], order, "slot", docs.count())


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write the documents themselves, one folder per shard, without a sort of whole shards."""
    at = jump_hash(F.xxhash64("doc_id"), shards)["at"].cast("int")
    docs.withColumn("shard", at).write.partitionBy("shard").parquet(path)
