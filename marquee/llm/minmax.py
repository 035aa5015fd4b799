"""MinHash near-duplicates by min-max hashing, every link confirmed on full sets.

Method: a document's set is its distinct two-word shingles, each a 64-bit hash. A permutation of the hash
space gives two signature values, the least and the greatest member of the set: both agree between two
sets with probability equal to their Jaccard similarity, so half the permutations make a signature that is
as long and unbiased, and of lower variance, since least and greatest can't be the same member. BANDS bands
hold ROWS values each, from ROWS / 2 permutations. At a similarity of 0.8 a pair shares a bucket with
probability 1 - (1 - 0.8 ** 6) ** 48 = 0.9999995 (0.99999 for sets of four and five, where the two ends
hang together most); README has the measured recall.

Equal sets are one node from there on. Every pair of nodes that shares a bucket is decided exactly, but not
one by one:

1. Every node is compared with the least of the nodes that lead its buckets. What links is one component.
2. In buckets that hold several components a node outside the largest one is compared with every node of
   another component: as pairs where there are up to FEW such nodes, or 4 * FEW nodes in all.
3. Other buckets are dealt by size and cut by hash into parts of bounded rows and bytes: the nodes outside the
   largest component, and all nodes. A part of the ones and a part of the others make a cell: shingles that
   several of its sets have are columns of a 0/1 matrix, intersections are one matrix product, and a cell hands
   on one link a node.

Pairs inside one component need no comparison, so a group of many copies costs one comparison a member. Before
sets travel, every comparison is made on bitmaps a sixteenth of their size: a bit that one set has and the other
hasn't is a member the other lacks, so the bitmaps bound the intersection from above and drop no link.

Defined cases: without words or text the set is empty and linked with nothing, and component_id is the
row's own id; one word is one shingle; repeated rows and ids are rows of their own; null ids never name a
component unless it has no other, then component_id is null (and kept is true); an empty table gives an
empty table; very long texts are hashed in parts of fixed size; columns other than doc_id and text are not
read.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from marquee.llm.common import tidy_shuffles
from marquee.llm.components import components
from marquee.llm.simhash import star_links
from marquee.sources.scratch import keep

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules["marquee.llm.simhash"])

SetsOf = Callable[[DataFrame], DataFrame]
PERCENT = 80
BANDS, ROWS = 48, 6
FEW = 4
CELL_ROWS = 512
CELL_BYTES = 8 << 20
SEED = 42
MOST_WORDS = 200_000  # word hashes a task remembers
COLUMNS = 4096        # shingles of a cell multiplied at a time
ODD = np.uint64(0x9E3779B97F4A7C15)
OTHER = np.uint64(0xBF58476D1CE4E5B9)


class WordHashes(dict):
    """Hash of each word, computed once while it is remembered."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= MOST_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word, SEED)
        return value


def shingle_set(text: str | None, known: WordHashes) -> np.ndarray:
    """Ascending distinct hashes of the two-word shingles; of the only word if there is one."""
    found = (text or "").encode().lower().split()  # bytes: A-Z only, ASCII white space only
    hashes = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    if len(hashes) < 2:
        return hashes
    pairs = hashes[:-1] * ODD
    pairs ^= pairs >> np.uint64(31)
    pairs += hashes[1:]
    pairs *= OTHER
    pairs ^= pairs >> np.uint64(29)
    return np.unique(pairs)


def band_keys(members: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> list[int]:
    """A signed number for each band of least and greatest members; none for an empty set."""
    import xxhash

    if not len(members):
        return []
    turns = bands * rows // 2
    flips, factors = np.random.default_rng(SEED).integers(0, 1 << 63, (2, turns), dtype=np.uint64)
    factors = factors * np.uint64(2) + np.uint64(1)
    least = np.full(turns, np.iinfo(np.uint64).max)
    most = np.zeros(turns, dtype=np.uint64)
    for at in range(0, len(members), 1024):
        part = members[at:at + 1024, None] ^ flips
        part *= factors
        np.minimum(least, part.min(axis=0), out=least)
        np.maximum(most, part.max(axis=0), out=most)
    ends = np.stack([least, most], axis=1).reshape(bands, rows)
    return np.array([xxhash.xxh64_intdigest(e.tobytes(), k) for k, e in enumerate(ends)], np.uint64).view(np.int64).tolist()


def alike(size_a, size_b, both, percent: int = PERCENT):
    """100 * intersection >= percent * union, in whole numbers."""
    return (100 + percent) * both >= percent * (size_a + size_b)


def bitmap(members: np.ndarray) -> np.ndarray:
    """Bits at the members' lowest digits, four a member at least; the length is a power of two."""
    width = max(64, 1 << (4 * len(members) - 1).bit_length())
    bits = np.zeros(width, dtype=np.uint8)
    bits[(members & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little")


def folded(bits: np.ndarray, length: int) -> np.ndarray:
    """A bitmap of fewer bytes: bits whose places agree in it fall together."""
    return bits if len(bits) == length else np.bitwise_or.reduce(bits.reshape(-1, length), axis=0)


def most_shared(size_a: int, a: np.ndarray, size_b: int, b: np.ndarray) -> int:
    """Upper bound of an intersection from two bitmaps."""
    length = min(len(a), len(b))
    a, b = folded(a, length), folded(b, length)
    only_a, only_b = (int(np.bitwise_count(x & ~y).sum()) for x, y in ((a, b), (b, a)))
    return min(size_a - only_a, size_b - only_b)


def _text_key() -> Column:
    """Names a text in 128 bits."""
    return F.unhex(F.md5(F.col("text").cast("string").cast("binary")))


def _digest(members: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(members.astype("<u8").tobytes())


def signatures(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, rid (a number of the row), text_key, digest of the set, n, keys, bits."""
    @F.pandas_udf("digest binary, n bigint, keys array<bigint>, bits binary")
    def of(texts: pd.Series) -> pd.DataFrame:
        known, out = WordHashes(), []
        for text in texts:
            some = shingle_set(text, known)
            out.append((_digest(some), len(some), band_keys(some), bitmap(some).tobytes() if len(some) else b""))
        return pd.DataFrame(out, columns=["digest", "n", "keys", "bits"])

    signed = docs.select("doc_id", F.monotonically_increasing_id().alias("rid"), _text_key().alias("text_key"), of(F.col("text").cast("string")).alias("_s"))
    return signed.select("doc_id", "rid", "text_key", "_s.*")


def full_sets(docs: DataFrame, signed: DataFrame, wanted: DataFrame) -> DataFrame:
    """(rid, members) of the wanted rows, members as sorted hashes: made again from their texts, and from no others."""
    @F.pandas_udf("digest binary, members binary")
    def of(texts: pd.Series) -> pd.DataFrame:
        known = WordHashes()
        sets = [shingle_set(text, known) for text in texts]
        return pd.DataFrame({"digest": [_digest(s) for s in sets], "members": [s.astype("<u8").tobytes() for s in sets]})

    names = signed.join(wanted.select("rid").distinct(), "rid", "left_semi").select("rid", "text_key", "digest")
    texts = docs.select(_text_key().alias("text_key"), F.col("text").cast("string").alias("text")).join(
        names.select("text_key").distinct(), "text_key", "left_semi").dropDuplicates(["text_key"])
    found = texts.select("text_key", of("text").alias("_s")).select("text_key", "_s.*")
    return keep(names.join(found, ["text_key", "digest"]).select("rid", "members"), "members")


def _fit(n: str, m: str, percent: int):
    """The sizes of two sets allow the similarity."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _with_both(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    """Pairs (a, b) with a column of `sets` (rid, ...) of both sides."""
    one, two = (sets.select(F.col("rid").alias(side), F.col(column).alias(f"s{side}")) for side in ("a", "b"))
    return pairs.join(one, "a").join(two, "b")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("rid")).distinct()


def confirmed(pairs: DataFrame, signed: DataFrame, sets_of: SetsOf, percent: int = PERCENT) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are alike."""
    @F.pandas_udf("boolean")
    def possible(left: pd.DataFrame, right: pd.DataFrame) -> pd.Series:
        return pd.Series([bool(alike(m, n, most_shared(m, np.frombuffer(x, np.uint8), n, np.frombuffer(y, np.uint8)), percent))
                          for m, x, n, y in zip(left["n"], left["bits"], right["n"], right["bits"])], dtype=bool)

    @F.pandas_udf("boolean")
    def linked(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(left, right):
            one, two = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
            if len(one) > len(two):
                one, two = two, one
            at = np.searchsorted(two, one)
            at[at == len(two)] = 0
            out.append(bool(alike(len(one), len(two), int((two[at] == one).sum()), percent)))
        return pd.Series(out, dtype=bool)

    pairs = keep(pairs, "pairs")
    marks = keep(signed.join(_ends(pairs), "rid", "left_semi").select("rid", F.struct("n", "bits").alias("mark")), "marks")
    close = keep(_with_both(pairs, marks, "mark").filter(possible("sa", "sb")).select("a", "b"), "close")
    return _with_both(close, sets_of(_ends(close)), "members").filter(linked("sa", "sb")).select("a", "b")


def cell_links(rid: np.ndarray, root: np.ndarray, sets: list[np.ndarray], first: np.ndarray | None,
               percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, least member) of a cell: its alike pairs of unlike roots, `first` against the others or all."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    row = np.repeat(np.arange(len(sets)), size)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    group = np.cumsum(np.concatenate([[True], flat[1:] != flat[:-1]])) - 1
    shared = np.bincount(group)[group] > 1
    group, row = group[shared], row[shared]
    _, column = np.unique(group, return_inverse=True)
    both = np.zeros((len(sets), len(sets)), dtype=np.float64)
    edges = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else -1) + 1 + COLUMNS, COLUMNS))
    for a, b in zip(edges[:-1], edges[1:]):  # products of 0/1 columns are whole numbers below 2^24
        part = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        part[row[a:b], column[a:b] % COLUMNS] = 1
        both += part @ part.T
    i, j = np.nonzero(alike(size[:, None], size[None, :], both, percent) & _asked(root, first))
    return star_links(rid, i, j)


def _asked(root: np.ndarray, first: np.ndarray | None) -> np.ndarray:
    """The pairs a cell has to decide."""
    unlike = root[:, None] != root[None, :]
    return unlike & (np.triu(np.ones_like(unlike), 1) if first is None else first[:, None] & ~first[None, :])


def cell_candidates(root: np.ndarray, size: np.ndarray, bits: list[np.ndarray], first: np.ndarray | None, percent: int = PERCENT) -> np.ndarray:
    """Which rows of a cell have a partner that their bitmaps do not rule out."""
    length = min(len(b) for b in bits)
    rows = np.stack([folded(b, length) for b in bits])
    both = np.zeros((len(bits), len(bits)), dtype=np.float64)
    for at in range(0, length, COLUMNS // 8):
        part = np.unpackbits(rows[:, at:at + COLUMNS // 8], axis=1).astype(np.float32)
        both += part @ part.T
    missed = np.diag(both)[:, None] - both  # bits of the row that the column lacks
    most = np.minimum(size[:, None] - missed, size[None, :] - missed.T)
    near = alike(size[:, None], size[None, :], most, percent) & _asked(root, first)
    return near.any(axis=1) | near.any(axis=0)


def _by_cells(rows: DataFrame, sets: DataFrame, bytes_each: float, solve, schema: str) -> DataFrame:
    """Cells of (bucket, rid, n, root) with the set of `sets` (rid, set), each given to `solve`.

    Rows outside the largest component of a bucket (side 1) meet all its rows (side 0): parts of the ones with
    parts of the others. While the former fit one part, a row travels once for its bucket.
    """
    def parts(count: str, members: str) -> Column:
        return F.greatest(F.lit(1), F.ceil(F.col(count) / CELL_ROWS), F.ceil(F.col(members) * bytes_each / CELL_BYTES)).cast("int")

    roots = rows.groupBy("bucket", "root").agg(F.count("*").alias("k"), F.sum("n").alias("m"))
    sizes = roots.groupBy("bucket").agg(F.max_by("root", "k").alias("main"), F.sum("k").alias("c"), F.sum("m").alias("cm"),
                                        (F.sum("k") - F.max("k")).alias("o"), (F.sum("m") - F.max_by("m", "k")).alias("om")).select(
        "bucket", "main", parts("c", "cm").alias("all"), parts("o", "om").alias("few"))
    placed = rows.join(sizes, "bucket")
    every = placed.select("bucket", F.explode(F.sequence(F.lit(0), F.col("few") - 1)).alias("i"),
                          F.pmod(F.xxhash64("rid"), F.col("all")).cast("int").alias("j"), F.lit(0).alias("side"), "rid", "n", "root")
    apart = placed.filter(F.col("root") != F.col("main")).select(
        "bucket", F.pmod(F.xxhash64("rid", F.lit(1)), F.col("few")).cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("all") - 1)).alias("j"), F.lit(1).alias("side"), "rid", "n", "root")
    return every.unionByName(apart).join(sets, "rid").groupBy("bucket", "i", "j").applyInPandas(solve, schema)


def _gathered(crowded: DataFrame) -> DataFrame:
    """Crowded buckets that share rows as one, where all its pairs are fewer than those of its buckets one by one.

    The nodes of one template meet in many bands; so they meet once.
    """
    crowded = keep(crowded, "crowded")
    stars = crowded.groupBy("bucket").agg(F.min("rid").alias("b"))
    tied = keep(components(crowded.join(stars, "bucket").select(F.col("rid").alias("a"), "b")), "gathered")
    # a bucket's rows are all of one group: that of its least row
    groups = stars.join(tied.select(F.col("node").alias("b"), F.col("root").alias("group")), "b", "left").select(
        "bucket", F.coalesce("group", "b").alias("group"))
    named = crowded.join(groups, "bucket")
    apart = named.groupBy("group", "bucket").agg(F.count("*").alias("c")).groupBy("group").agg(F.sum(F.col("c") * F.col("c")).alias("apart"))
    rows = named.select("group", "rid").distinct().groupBy("group").agg(F.count("*").alias("g"))
    as_one = apart.join(rows, "group").filter(F.col("g") * F.col("g") <= F.col("apart")).select("group", F.lit(True).alias("as_one"))
    key = F.when(F.col("as_one"), F.xxhash64("group", F.lit(0))).otherwise(F.xxhash64("bucket"))
    return named.join(as_one, "group", "left").select(key.alias("bucket"), "rid", "n", "root").distinct()


def _cells(crowded: DataFrame, signed: DataFrame, sets_of: SetsOf, percent: int) -> DataFrame:
    """Links of buckets (bucket, rid, n, root) with many components, compared part by part.

    Sets of sizes that can be alike share a class of sizes: a set stands in its own and in the one below. Bitmaps
    are compared first, and only the sets of rows that have a possible partner are brought together.
    """
    step = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(100 / percent) + 1e-9)) + 1e-9)
    classed = _gathered(crowded).withColumn("bucket", F.explode(F.array(*[F.xxhash64("bucket", step - k) for k in (0, 1)])))
    several = classed.groupBy("bucket").agg(F.min("root").alias("_a"), F.max("root").alias("_b")).filter("_a <> _b").select("bucket")
    rows = keep(classed.join(several, "bucket", "left_semi").select("bucket", "rid", "n", "root"), "classed")

    def narrow(cell: pd.DataFrame) -> pd.DataFrame:
        found = cell_candidates(cell["root"].to_numpy(), cell["n"].to_numpy(), [np.frombuffer(b, np.uint8) for b in cell["set"]], (cell["side"] == 1).to_numpy(), percent)
        return cell.loc[found, ["bucket", "rid", "n", "root"]]

    def solve(cell: pd.DataFrame) -> pd.DataFrame:
        a, b = cell_links(cell["rid"].to_numpy(), cell["root"].to_numpy(), [np.frombuffer(m, "<u8") for m in cell["set"]], (cell["side"] == 1).to_numpy(), percent)
        return pd.DataFrame({"a": a, "b": b})

    marks = keep(signed.join(rows.select("rid").distinct(), "rid", "left_semi").select("rid", F.col("bits").alias("set")), "marks")
    close = keep(_by_cells(rows, marks, 0.75, narrow, "bucket bigint, rid bigint, n bigint, root bigint").distinct(), "possible")
    return _by_cells(close, sets_of(close).withColumnRenamed("members", "set"), 8.0, solve, "a bigint, b bigint")


def links(signed: DataFrame, sets_of: SetsOf, percent: int = PERCENT, few: int = FEW) -> DataFrame:
    """Links (a, b) between nodes that have the components of all alike pairs sharing a bucket.

    `signed` has one row per node: rid, n, keys, bits; `sets_of` gives (rid, members) of the rids asked for.
    """
    placed = signed.select(F.col("rid"), "n", F.explode("keys").alias("bucket"))
    sizes = placed.groupBy("bucket").agg(F.count("*").alias("c"), F.min("rid").alias("leader"), F.min_by("n", "rid").alias("m")).filter("c > 1")
    met = keep(placed.join(sizes, "bucket"), "buckets")
    first = met.filter((F.col("rid") != F.col("leader")) & _fit("n", "m", percent)).groupBy(F.col("rid").alias("b")).agg(F.min("leader").alias("a"))
    tied = keep(components(confirmed(first.select("a", "b"), signed, sets_of, percent)), "tied")

    rooted = met.select("bucket", "rid", "n").join(
        tied.select(F.col("node").alias("rid"), "root"), "rid", "left").withColumn("root", F.coalesce("root", "rid"))
    counts = rooted.groupBy("bucket", "root").agg(F.count("*").alias("k"))
    mixed = counts.groupBy("bucket").agg(
        F.count("*").alias("roots"), F.max_by("root", "k").alias("main"), F.when((F.sum("k") - F.max("k") <= few) | (F.sum("k") <= 4 * few), True).otherwise(False).alias("small")).filter("roots > 1")
    left = keep(rooted.join(mixed.select("bucket", "main", "small"), "bucket"), "mixed")
    # of a bucket at most `few` are listed, or as many of 4 * `few` in all
    listed = left.filter(F.col("small") & (F.col("root") != F.col("main"))).groupBy("bucket").agg(
        F.collect_list(F.struct(F.col("rid").alias("other"), F.col("n").alias("m"), F.col("root").alias("at"))).alias("others"))
    second = left.join(listed, "bucket").select("rid", "n", "root", F.inline("others")).filter(
        (F.col("root") != F.col("at")) & _fit("n", "m", percent)).select(
        F.least("rid", "other").alias("a"), F.greatest("rid", "other").alias("b")).distinct()
    more = confirmed(second, signed, sets_of, percent)
    rest = _cells(left.filter(~F.col("small")).select("bucket", "rid", "n", "root"), signed, sets_of, percent)
    return tied.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more).unionByName(rest)


def near_duplicates(docs: DataFrame, percent: int = PERCENT, few: int = FEW) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    with tidy_shuffles(docs.sparkSession):
        signed = keep(signatures(docs), "signatures")
        nodes = keep(signed.filter("n > 0").groupBy("digest").agg(F.min("doc_id").alias("least"), F.min("rid").alias("node")), "nodes")
        reps = signed.join(nodes.select(F.col("node").alias("rid")), "rid", "left_semi").drop("doc_id")
        tied = keep(components(links(reps, lambda wanted: full_sets(docs, signed, wanted), percent, few)), "components")
        named = nodes.join(tied, "node", "left").select("digest", "least", F.coalesce("root", "node").alias("root"))
        least = named.groupBy("root").agg(F.min("least").alias("component_id"))
        final = keep(named.join(least, "root").select("digest", "component_id"), "named")
    found = signed.select("doc_id", F.col("n").alias("n_shingles"), "digest").join(final, "digest", "left").withColumn(
        "component_id", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")))
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
