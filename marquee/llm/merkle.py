"""Merkle manifest of a dataset by time-forward processing: digests up, then proof suffixes down.

Every row is a leaf. The leaves of a source, by ascending doc_id, are hashed in runs of FAN consecutive
digests until one is left, the source's subroot; subroots by source are hashed in the same way to the root.

Method: a node is labelled (tree, level, place), and labels ascend from children to parents. Processing the
nodes in label order, each one sends its digest forward in time to its parent's label through a priority
queue; when the parent's turn comes its children's digests lie at the head of the queue. The queue is
external: labels are dealt into blocks of FAN ** DEPTH leaves, a block's part of the queue is a heap of
bounded size in one task, and what leaves a block (one digest a block) is a table that the next round sorts
by label and reads as its leaves. A million leaves take two rounds, 10^12 take four. The reversed sweep
runs the blocks from the last round to the first with labels descending: a node sends each child the
siblings it needs to get to the root, and what enters a block of leaves is one proof suffix.

Places are numbered by a range-partitioned sort whose pieces are counted, so one source may hold all rows:
no task holds more than a piece of the sort or a block. Every round is a written table.

Defined cases: null source is a source of its own, before all others; null ids come before all others and
are never tampered with; rows of one id are ordered by their leaf; equal rows are leaves of their own;
null and empty texts have unlike leaves; an empty table gives an empty table; columns other than the five
hashed ones are not read; a text is hashed whole in one task.
"""

from __future__ import annotations

import sys
from hashlib import sha256
from heapq import heappop, heappush

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.sources.scratch import keep

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FAN = 16
DEPTH = 3  # levels of a block: FAN ** DEPTH leaves
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ONE_TREE = "all"


def digest_of(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """sha256 of the five fields, each as byte count, colon and value, or a hyphen for null."""
    return F.sha2(F.concat(*[_field(c) for c in (doc_id, source, lang, n_chars, text)]).cast("binary"), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, tree (names the source, sorts like it), leaf, tampered (a leaf, where the row is tampered with), rid."""
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    text = F.col("text").cast("string")
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    return docs.select(
        "doc_id", F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("-")).alias("tree"),
        leaf_of(*fields, text).alias("leaf"),
        F.when(tampered, leaf_of(*fields, F.translate(text, UPPER, LOWER))).alias("tampered"),
        F.monotonically_increasing_id().alias("rid"))


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows with `place`, gapless from 0 in each tree by the order, and `size`, the rows of the tree.

    One range sort; pieces are counted and ranked by themselves, so a tree is spread over many pieces.
    """
    dealt = keep(rows.repartitionByRange("tree", *order).withColumn("piece", F.spark_partition_id()), "pieces")
    counts = dealt.groupBy("tree", "piece").agg(F.count("*").alias("n"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select("tree", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"), F.sum("n").over(tree).alias("size"))
    inside = F.row_number().over(Window.partitionBy("tree", "piece").orderBy(*order)) - 1
    return dealt.withColumn("inside", inside).join(ahead, ["tree", "piece"]).withColumn(
        "place", (F.col("inside") + F.col("skip")).cast("bigint")).drop("piece", "inside", "skip")


def levels_of(size: int) -> int:
    """Levels above `size` leaves."""
    levels = 0
    while size > 1:
        size, levels = -(-size // FAN), levels + 1
    return levels


def sweep_up(places: list[int], digests: list[str], levels: int) -> list[dict[int, str]]:
    """Digests of a block by level and place: labels leave the queue in order and go to their parents."""
    queue: list[tuple[int, int, str]] = []
    for place, digest in zip(places, digests):
        heappush(queue, (0, place, digest))
    done: list[dict[int, str]] = [{} for _ in range(levels + 1)]
    while queue:
        level, place, digest = heappop(queue)
        done[level][place] = digest
        last = not queue or queue[0][0] != level or queue[0][1] // FAN != place // FAN
        if last and level < levels:
            first = place - place % FAN
            heappush(queue, (level + 1, place // FAN, digest_of(*(done[level][p] for p in range(first, place + 1)))))
    return done


def sweep_down(done: list[dict[int, str]], suffix: list[tuple[str, str]]) -> dict[int, list[tuple[str, str]]]:
    """For every leaf of a block its siblings (left, right), level by level up to the root.

    `suffix` is what the block's own root needs; labels are taken in descending order, parents first.
    """
    proofs = {place: suffix for place in done[-1]}
    for level in range(len(done) - 2, -1, -1):
        below = {}
        runs: dict[int, list[int]] = {}
        for place in sorted(done[level]):
            runs.setdefault(place // FAN, []).append(place)
        for parent in sorted(runs, reverse=True):
            some = [done[level][p] for p in runs[parent]]
            for at, place in enumerate(runs[parent]):
                below[place] = [("".join(some[:at]), "".join(some[at + 1:])), *proofs[parent]]
        proofs = below
    return proofs


def folded(leaf: str, proof: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings lead to."""
    for left, right in proof:
        leaf = digest_of(left, leaf, right)
    return leaf


def _block(places: DataFrame, depth: int) -> DataFrame:
    return places.withColumn("block", F.floor(F.col("place") / FAN ** depth).cast("bigint"))


def _levels(size: int, depth: int) -> int:
    return min(depth, levels_of(size))


def _up(nodes: DataFrame, depth: int) -> DataFrame:
    """One round: (tree, place, size, digest) of the blocks' roots; `nodes` has the same columns."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        size = int(rows["size"].iloc[0])
        levels = _levels(size, depth)
        top = sweep_up(rows["place"].tolist(), rows["digest"].tolist(), levels)[-1]
        (digest,) = top.values()
        return pd.DataFrame({"tree": rows["tree"].iloc[:1], "place": rows["block"].iloc[:1],
                             "size": [-(-size // FAN ** depth)], "digest": [digest]})

    return _block(nodes, depth).groupBy("tree", "block").applyInPandas(run, "tree string, place bigint, size bigint, digest string")


PROOF = "array<struct<left:string,right:string>>"


def _down(nodes: DataFrame, suffixes: DataFrame, depth: int, out: list[str], types: list[str], rows_of) -> DataFrame:
    """Hand the suffixes (tree, place of the block, proof) down to the nodes of each block."""
    def run(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place").reset_index(drop=True)
        done = sweep_up(rows["place"].tolist(), rows["digest"].tolist(), _levels(int(rows["size"].iloc[0]), depth))
        suffix = [(s["left"], s["right"]) for s in above["proof"].iloc[0]]
        proofs = sweep_down(done, suffix)
        return rows_of(rows, [proofs[p] for p in rows["place"].tolist()])[out]

    blocks = suffixes.select("tree", F.col("place").alias("block"), "proof")
    return _block(nodes, depth).groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInPandas(
        run, ", ".join(f"{c} {t}" for c, t in zip(out, types)))


def _with_proof(rows: pd.DataFrame, proofs: list) -> pd.DataFrame:
    return rows.assign(proof=[[{"left": a, "right": b} for a, b in p] for p in proofs])


def rounds_up(nodes: DataFrame, depth: int) -> list[DataFrame]:
    """Rounds until each tree has one node; the first entry is `nodes` (tree, place, size, digest) itself."""
    rounds = [nodes]
    most = nodes.agg(F.max("size")).first()[0] or 0
    while most > 1:
        rounds.append(keep(_up(rounds[-1], depth), "nodes"))
        most = -(-most // FAN ** depth)
    return rounds


def proofs_down(rounds: list[DataFrame], top: DataFrame, depth: int) -> DataFrame:
    """(tree, place, proof) of the blocks of the first round; `top` has (tree, proof) of each tree's last node."""
    now = top.select("tree", F.lit(0).cast("bigint").alias("place"), "proof")
    for nodes in rounds[-2:0:-1]:
        now = keep(_down(nodes, now, depth, ["tree", "place", "proof"], ["string", "bigint", PROOF], _with_proof), "suffixes")
    return now


def manifest(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    id_type = dict(docs.dtypes)["doc_id"]
    rows = keep(placed(keep(leaves(docs), "leaves"), ["doc_id", "leaf", "rid"]), "placed")
    rounds = rounds_up(rows.select("tree", "place", "size", F.col("leaf").alias("digest")), depth)

    # the tree over the subroots, by source
    subroots = rounds[-1].select(F.lit(ONE_TREE).alias("tree"), F.col("tree").alias("source"), "digest")
    sources = keep(placed(subroots, ["source"]), "sources")
    tops = rounds_up(sources.select("tree", "place", "size", "digest"), depth)
    nothing = F.slice(F.array(F.struct(F.lit("").alias("left"), F.lit("").alias("right"))), 1, 0)

    def by_source(some: pd.DataFrame, proofs: list) -> pd.DataFrame:
        return _with_proof(some, proofs).assign(tree=some["source"])

    above = proofs_down(tops, tops[-1].select("tree", nothing.alias("proof")), depth)
    above = keep(_down(sources, above, depth, ["tree", "proof"], ["string", PROOF], by_source), "suffixes")

    def finish(some: pd.DataFrame, proofs: list) -> pd.DataFrame:
        changed = some["tampered"].where(some["tampered"].notna(), some["digest"])
        return some.assign(proof_sha256=[digest_of(*(a + b for a, b in p)) for p in proofs],
                           folded_root=[folded(leaf, p) for leaf, p in zip(changed, proofs)])

    # ids go through pandas as text, which has nulls and all digits
    full = rows.select(F.col("doc_id").cast("string").alias("doc_id"), "tree", "place", "size", F.col("leaf").alias("digest"), "tampered")
    found = _down(full, proofs_down(rounds, above, depth), depth, ["doc_id", "tree", "digest", "proof_sha256", "folded_root"],
                  ["string"] * 5, finish)
    roots = sources.join(tops[-1].select("tree", F.col("digest").alias("root")), "tree").select(
        F.col("source").alias("tree"), F.col("digest").alias("subroot"), "root")
    return found.join(roots, "tree").select(
        F.col("doc_id").cast(id_type).alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))
