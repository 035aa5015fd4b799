"""SimHash near-duplicates: exact search of all fingerprints within a few bits, compared bit-sliced.

Method: a 64-bit fingerprint is the bitwise majority over the hashes of the text's three-word shingles.
Equal fingerprints are one row from there on. Two fingerprints within RADIUS = 3 bits agree on at least two
of five bands of 12 or 13 bits, so each goes to the ten blocks named by two of its bands, and every close
pair meets in a block (no pair is lost, none is guessed). Inside a block the fingerprints stand as
64 bit planes; for many probes at once each plane is XORed with the probe's bit and added to the distances
by carry-save counters of two bits and a sticky overflow; probes for which every distance has overflowed
are abandoned. A block hands on one link per fingerprint to its least companion, never all pairs.

A block of more than BLOCK rows is cut by hash into parts, and each pair of parts is compared by itself, so
no task holds a block that grows with the data; blocks are counted before, by partial sums.

Defined cases: null, empty and word-less texts have fingerprint zero and are linked like any other; a text
of one or two words is one shingle; repeated rows and repeated ids are rows of their own; null ids never
name a component unless it has no other; an empty table gives an empty table; columns other than doc_id
and text are not read.
"""

from __future__ import annotations

import sys
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from marquee.llm.components import components
from marquee.sources.scratch import keep

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 3
SEED = 42
RADIUS = 3
BANDS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))  # first bit and width
BLOCK = 2048
PACK = 256  # small neighbouring blocks are compared together, up to so many rows


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bitwise majority of the shingle hashes; a bit is 1 if set in over half of them."""
    import xxhash

    found = (text or "").encode().lower().split()  # bytes: A-Z only, ASCII white space only
    if not found:
        return 0
    line = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found])
    width = min(shingle, len(found))
    starts = np.concatenate([[0], ends[: len(found) - width]])
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts.tolist(), (ends[width - 1:] - 1).tolist())], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at:at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the carried columns and fp, the fingerprint as a signed 64-bit number."""
    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))

    return docs.select("doc_id", *carried, of(F.col("text").cast("string")).alias("fp"))


def close_pairs(left: np.ndarray, right: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Indexes (i, j) with at most `radius` (3 or less) differing bits between left[i] and right[j]."""
    words = -(-len(right) // 64)
    padded = np.zeros(words * 64, dtype=np.uint64)
    padded[: len(right)] = right
    real = np.zeros(words * 64, dtype=np.uint8)
    real[: len(right)] = 1
    real_words = np.packbits(real, bitorder="little").view("<u8")
    bits = np.unpackbits(padded.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.packbits(bits.T.copy(), axis=1, bitorder="little").view("<u8")  # 64 rows of `words` words
    everything = np.uint64(0xFFFFFFFFFFFFFFFF)
    found_i, found_j = [], []
    for at in range(0, len(left), 512):
        probe = left[at:at + 512]
        alive = np.arange(len(probe))
        low = np.zeros((len(probe), words), dtype=np.uint64)
        high, over = low.copy(), low.copy()
        over[:] = ~real_words
        for bit in range(64):
            flip = np.where((probe[alive] >> np.uint64(bit)) & np.uint64(1), everything, np.uint64(0))
            differs = planes[bit][None, :] ^ flip[:, None]
            carry = low & differs
            low ^= differs
            over |= high & carry
            high ^= carry
            if radius < 3:  # sums above the radius that two bits can still hold
                over |= (high & low) if radius == 2 else high if radius == 1 else (high | low)
            if bit % 8 == 7 and bit < 63:
                go_on = ~(over == everything).all(axis=1)
                if not go_on.any():
                    alive = alive[:0]
                    break
                if not go_on.all():
                    alive, low, high, over = alive[go_on], low[go_on], high[go_on], over[go_on]
        if len(alive):
            near = np.unpackbits((~over).astype("<u8").view(np.uint8), axis=1, bitorder="little")
            i, j = np.nonzero(near)
            found_i.append(alive[i] + at)
            found_j.append(j)
    if not found_i:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(found_i), np.concatenate(found_j)


def star_links(values: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, least member) that join what the pairs join: at most one per member."""
    root = np.arange(len(values))
    while True:  # least label over the pairs, then jump
        new = root.copy()
        np.minimum.at(new, i, root[j])
        np.minimum.at(new, j, root[i])
        new = new[new]
        if (new == root).all():
            break
        root = new
    member = np.flatnonzero(root != np.arange(len(values)))
    return values[member], values[root[member]]


def links(fps: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that have the components of all close pairs."""
    def band(first: int, width: int):
        return F.shiftrightunsigned("fp", first).bitwiseAND((1 << width) - 1)

    tables = [F.struct(F.lit(t).alias("t"), (band(*x) * (1 << 13) + band(*y)).alias("k"))
              for t, (x, y) in enumerate(combinations(BANDS, 2))]
    keyed = fps.select("fp", F.explode(F.array(*tables)).alias("at")).select("fp", "at.t", "at.k")
    large = keyed.groupBy("t", "k").agg(F.count("*").alias("n")).filter(F.col("n") > block).select(
        "t", "k", F.ceil(F.col("n") / block).cast("int").alias("parts"))
    placed = keyed.join(large, ["t", "k"], "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn(
        "part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    # a part meets itself and every other part of its block: cells (i, j) with i <= j
    cells = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(
        F.least(F.col("part"), o).alias("i"), F.greatest(F.col("part"), o).alias("j")))
    met = placed.select("t", "k", "part", "fp", F.explode(cells).alias("cell")).select(
        "t", "k", F.col("cell.i").alias("i"), F.col("cell.j").alias("j"), "part", "fp")
    dealt = met.repartition("t", "k", "i", "j").sortWithinPartitions("t", "k", "i", "j", "part")

    def solve(fp: np.ndarray, first: np.ndarray | None) -> pd.DataFrame:
        if first is None:
            a, b = close_pairs(fp, fp, radius)
            a, b = a[a < b], b[a < b]
        else:  # two parts of a large block
            x, y = np.flatnonzero(first), np.flatnonzero(~first)
            a, b = close_pairs(fp[x], fp[y], radius)
            a, b = x[a], y[b]
        one, other = star_links(fp.view(np.int64), a, b)
        return pd.DataFrame({"a": one, "b": other})

    def packs(rows: pd.DataFrame):
        """Whole groups: cross groups by themselves, neighbouring others together; single rows meet nobody."""
        key, fp = rows[["t", "k", "i", "j"]].to_numpy(), rows["fp"].to_numpy().view(np.uint64)
        new = np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)])
        group = np.cumsum(new) - 1
        many = np.bincount(group)[group] > 1
        key, fp, group, first = key[many], fp[many], group[many], (rows["part"] == rows["i"]).to_numpy()[many]
        starts = np.concatenate([np.flatnonzero(np.diff(group, prepend=-1)), [len(group)]])
        cross = key[starts[:-1], 2] != key[starts[:-1], 3]
        after_cross = np.append(np.flatnonzero(cross), len(cross))
        at = 0
        while at < len(cross):
            if cross[at]:
                end = at + 1
                yield solve(fp[starts[at]:starts[end]], first[starts[at]:starts[end]])
            else:
                end = max(at + 1, int(np.searchsorted(starts, starts[at] + PACK, "right")) - 1)
                end = min(end, int(after_cross[np.searchsorted(after_cross, at)]))
                yield solve(fp[starts[at]:starts[end]], None)
            at = end

    def run(batches):
        rest = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if not len(rows):
                continue
            key = rows[["t", "k", "i", "j"]].to_numpy()
            cut = np.flatnonzero((key[1:] != key[:-1]).any(axis=1))
            last = int(cut[-1]) + 1 if len(cut) else 0  # the last group may go on in the next batch
            yield from packs(rows.iloc[:last]) if last else ()
            rest = rows.iloc[last:]
        if rest is not None and len(rest):
            yield from packs(rest)

    return dealt.mapInPandas(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, block: int = BLOCK, carried: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, fp, component_id (the smallest doc_id that links lead to) and root.

    `root` names the component by a fingerprint, so it also tells components apart that have an id in common.
    Columns named in `carried` are handed on.
    """
    marked = keep(fingerprints(docs, carried=carried), "fingerprints")
    classes = keep(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    tied = components(links(classes.select("fp"), radius, block).distinct())
    named = classes.join(tied, classes["fp"] == tied["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    final = keep(named.join(least, "root").select(F.col("fp").alias("of"), "component_id", "root"), "named")
    return marked.join(final, marked["fp"] == final["of"]).select("doc_id", *carried, "fp", "component_id", "root")
