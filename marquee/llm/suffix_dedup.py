"""Removal of repeated passages: a depth-limited radix sort of suffixes, most significant digit first.

Every byte covered by a WINDOW-byte string that starts anywhere else too is removed. Suffixes need to be told
apart only through WINDOW bytes, and equal groups at that depth are the repeated windows. The digits are
large and hashed, and the passes go from the cheapest to the dearest:

1. Digit one is a string of DIGIT bytes inside the window: the one of least hash (leftmost on ties), so equal
   windows choose equal digits at equal offsets, and neighbouring windows share one. One row per choice, an
   anchor, stands for all windows that chose it: about one row per 40 bytes. Digits that occur once are
   counted (8 bytes a row) and dropped with all their windows.
2. The next digit is everything that the anchor's windows cover. Anchors equal in it are equal throughout,
   so all their windows are repeated: exact copies and the inside of long passages end here.
3. What is left lies at the edges of passages. One anchor for each distinct cover is opened into its single
   windows, and the hash of all WINDOW bytes, within the group of digit one, is the last digit.

Windows of one anchor start at most WINDOW - DIGIT bytes apart and are longer than that, so the bytes
removed for an anchor are those from its first repeated window to the end of its last one.

Groups are counted by partial sums and looked up by equi-joins the adaptive planner may split; no group is
collected. Texts are shuffled twice: to open anchors and to cut. Rows meet in (hash, hash) keys of 128 bits.

Defined cases: null text is empty and stays empty; texts shorter than WINDOW bytes are left alone; repeated
rows are copies of each other and lose what repeats; a null doc_id is a document like any other; rows
that repeat a doc_id with unlike texts are told apart by a hash of the text; an empty table gives an empty
table; other columns are not read.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from marquee.llm.common import text_of, tidy_shuffles
from marquee.sources.scratch import keep

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 200
DIGIT = 120
SEGMENT = 1 << 19            # bytes hashed at a time; longer texts are cut with an overlap
PLACE = 21                   # bits for a position in a segment
MULTIPLIER = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


def _scramble(n: int) -> int:
    n = (n + 0x9E3779B97F4A7C15) & MASK
    n = ((n ^ (n >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    n = ((n ^ (n >> 27)) * 0x94D049BB133111EB) & MASK
    return n ^ (n >> 31)


class Hasher:
    """Hashes of any substring of a segment from prefix sums: sum of value(byte) * M^position, mod 2^64."""

    def __init__(self, longest: int):
        self.values = np.array([_scramble(b) for b in range(256)], dtype=np.uint64)
        self.up = self._powers(MULTIPLIER, longest + 1)
        self.down = self._powers(pow(MULTIPLIER, -1, 1 << 64), longest + 1)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.values[data] * self.up[: len(data)], out=sums[1:])
        return sums

    def span(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (sums[end] - sums[start]) * self.down[start]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        return h


def anchors_of(hasher: Hasher, data: np.ndarray, unit_ends: np.ndarray, window: int, digit: int):
    """(digit hash, cover hash, first window, windows) of the anchors in units laid end to end in `data`."""
    none = np.zeros(0, dtype=np.int64)
    if len(data) < window:
        return none, none, none, none
    sums = hasher.prefix(data)
    at = np.arange(len(data) - digit + 1)
    low = np.uint64((1 << PLACE) - 1)
    key = (hasher.span(sums, at, at + digit) & ~low) | at.astype(np.uint64)
    # least key of each run of `width`: blockwise running minima from both sides
    width = window - digit + 1
    n = len(key)
    blocks = np.concatenate([key, np.full(-n % width, MASK, dtype=np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    chosen = (np.minimum(back[: n - width + 1], ahead[width - 1:n]) & low).astype(np.int64)
    starts = np.arange(len(chosen))
    begins = np.concatenate([[0], unit_ends[:-1]])
    end_of = np.repeat(unit_ends, unit_ends - begins)[: len(chosen)]
    inside = starts + window <= end_of
    new = inside.copy()
    new[1:] &= (chosen[1:] != chosen[:-1]) | ~inside[:-1]
    stop = inside.copy()
    stop[:-1] &= (chosen[1:] != chosen[:-1]) | ~inside[1:]
    first, last = np.flatnonzero(new), np.flatnonzero(stop)
    if not len(first):
        return none, none, none, none
    place = chosen[first]
    cover = hasher.span(sums, first, last + window)
    cover ^= (place - first).astype(np.uint64) * np.uint64(0x94D049BB133111EB) + (last - first).astype(np.uint64) * np.uint64(MULTIPLIER)
    return hasher.span(sums, place, place + digit).view(np.int64), cover.view(np.int64), first, last - first + 1


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Data and offsets of a string column without nulls."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)), at


def anchors(docs: DataFrame, window: int = WINDOW, digit: int = DIGIT) -> DataFrame:
    """Anchors of all windows: digit, cover (hashes), rid, first (byte of the first window), windows."""
    def run(batches):
        hasher = Hasher(SEGMENT + window)
        for batch in batches:
            data, at = _bytes_of(batch.column(1))
            rid = batch.column(0)
            units: list[tuple[int, int, int]] = []  # row, start in the text, length
            room = SEGMENT
            for row, length in enumerate(np.diff(at).tolist()):
                for start in range(0, length, SEGMENT - window):
                    size = min(length - start, SEGMENT - 1)
                    if size < window:
                        continue
                    if size > room:
                        yield rows(hasher, data, at, rid, units)
                        units, room = [], SEGMENT
                    units.append((row, start, size))
                    room -= size
            if units:
                yield rows(hasher, data, at, rid, units)

    def rows(hasher, data, at, rid, units):
        row = np.array([u[0] for u in units])
        start = np.array([u[1] for u in units])
        size = np.array([u[2] for u in units])
        joined = np.concatenate([data[at[r] + s: at[r] + s + n] for r, s, n in units])
        ends = np.cumsum(size)
        d, c, first, n = anchors_of(hasher, joined, ends, window, digit)
        unit = np.searchsorted(ends, first, "right")
        return pa.RecordBatch.from_arrays([
            pa.array(d), pa.array(c), rid.take(pa.array(row[unit])),
            pa.array(first - (ends - size)[unit] + start[unit]), pa.array(n.astype(np.int32))],
            names=["digit", "cover", "rid", "first", "windows"])

    return docs.select("rid", "text").mapInArrow(run, "digit bigint, cover bigint, rid bigint, first bigint, windows int")


def _opened(docs: DataFrame, edge: DataFrame, window: int) -> DataFrame:
    """The single windows of edge anchors: digit, whole (hash), rid, first, at."""
    listed = edge.groupBy("rid").agg(F.collect_list(F.struct("digit", "first", "windows")).alias("edges"))
    texts = docs.join(listed, "rid").select("rid", F.col("text").cast("binary").alias("text"), "edges")

    def run(batches):
        hasher = Hasher(2 * window)
        for batch in batches:
            for rid, text, edges in zip(batch["rid"], batch["text"], batch["edges"]):
                data = np.frombuffer(text, dtype=np.uint8)
                out = []
                for e in edges:
                    first, n = e["first"], e["windows"]
                    sums = hasher.prefix(data[first: first + n - 1 + window])
                    at = np.arange(n)
                    out.append(pd.DataFrame({"digit": e["digit"], "whole": hasher.span(sums, at, at + window).view(np.int64),
                                             "rid": rid, "first": first, "at": first + at}))
                yield pd.concat(out)

    return texts.mapInPandas(run, "digit bigint, whole bigint, rid bigint, first bigint, at bigint")


def repeated_spans(docs: DataFrame, window: int = WINDOW, digit: int = DIGIT) -> DataFrame:
    """(rid, start, end): spans of bytes whose union per document is what repeats."""
    twice = keep(anchors(docs, window, digit).groupBy("digit").agg(F.count("*").alias("n")).filter("n > 1").select("digit"), "digits")
    known = keep(anchors(docs, window, digit).join(twice, "digit", "left_semi"), "anchors")
    groups = keep(known.groupBy("digit", "cover").agg(
        F.count("*").alias("n"), F.min(F.struct("rid", "first", "windows")).alias("one")), "covers")
    copied = groups.filter("n > 1").select("digit", "cover")
    whole = known.join(copied, ["digit", "cover"], "left_semi").select(
        "rid", F.col("first").alias("start"), (F.col("first") + F.col("windows") - 1 + window).alias("end"))
    # edges: digits with several covers, one of which occurs once
    mixed = groups.groupBy("digit").agg(F.count("*").alias("covers"), F.min("n").alias("least")).filter(
        "covers > 1 and least = 1").select("digit")
    edge = groups.join(mixed, "digit", "left_semi").select("digit", "n", "one.*")
    opened = keep(_opened(docs, edge.select("rid", "digit", "first", "windows"), window), "windows")
    equal = opened.groupBy("digit", "whole").agg(F.count("*").alias("n")).filter("n > 1").select("digit", "whole")
    parts = opened.join(equal, ["digit", "whole"], "left_semi").groupBy("rid", "first").agg(
        F.min("at").alias("start"), (F.max("at") + window).alias("end")).select("rid", "start", "end")
    return whole.unionByName(parts)


def cut(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Cut the union of the spans out of each text: doc_id, n_bytes, n_removed, n_spans, kept (bytes)."""
    listed = spans.groupBy("rid").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    both = docs.join(listed, "rid", "left").select("doc_id", F.col("text").cast("binary").alias("text"), "spans")
    id_type = dict(docs.dtypes)["doc_id"]

    def run(batches):
        for batch in batches:
            removed, runs, kept, lengths = [], [], [], []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                merged: list[list[int]] = []
                for a, b in sorted((s["start"], s["end"]) for s in spans or ()):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                parts, at = [], 0
                for a, b in merged:
                    parts.append(text[at:a])
                    at = b
                parts.append(text[at:])
                lengths.append(len(text))
                removed.append(sum(b - a for a, b in merged))
                runs.append(len(merged))
                kept.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(lengths, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
                pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return both.mapInArrow(run, f"doc_id {id_type}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, rid and text: rid is the id, or a hash of id and text where the id is null or has unlike texts."""
    body = text_of("text")
    number = F.col("doc_id").cast("bigint")
    unlike = keep(docs.filter(number.isNotNull()).groupBy(number.alias("id")).agg(
        F.min(F.xxhash64(body)).alias("least"), F.max(F.xxhash64(body)).alias("most")).filter("least <> most").select("id"), "unlike")
    made: Column = F.xxhash64(number, body)
    if unlike.isEmpty():
        return docs.select("doc_id", F.coalesce(number, made).alias("rid"), body.alias("text"))
    read = docs.select("doc_id", number.alias("_id"), body.alias("text")).join(unlike.withColumn("_two", F.lit(True)), F.col("_id") == F.col("id"), "left")
    own: Column = F.when(F.col("_two").isNull(), F.col("_id"))
    return read.select("doc_id", F.coalesce(own, F.xxhash64("_id", "text")).alias("rid"), "text")


def remove_repeats(docs: DataFrame, window: int = WINDOW, digit: int = DIGIT) -> DataFrame:
    with tidy_shuffles(docs.sparkSession):
        read = _keyed(docs)
        spans = keep(repeated_spans(read, window, digit), "spans")
    return cut(read, spans)
