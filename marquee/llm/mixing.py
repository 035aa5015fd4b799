"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

Method: every document of a source has the same expected number of copies, target / source size. The
whole part is taken as it is; the fraction p is rounded by the pivotal method, in words: two documents
with fractional masses p1 * size1 and p2 * size2 are paired, and a random amount of mass moves from one
to the other until one of them is empty or full, with odds that leave both expectations as they were.
The mass of the source never changes, so its words come out at the target but for the last document.

Pairing is a reduction tree. Documents are dealt by hash into blocks of about BLOCK; each block is folded,
large documents first so that a small one is left over, and leaves one undecided document; those are dealt into blocks again, and so on up to one document per
source, which a hash rounds. A level is one shuffle of narrow rows and is written before the next, so a
lost executor repeats a level at most. All randomness is a hash of ids, so reruns agree.

Defined cases: null text has size 0; a document of size 0 is never taken; a null source is a source, the
last one; repeated rows (one source, id and size, or no id) are counted first and then decided each by itself
under a number of its own, so they spread over blocks like any others; an empty table gives an empty table; columns other
than doc_id, text and source are neither read nor returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.llm.common import text_of, uniform, words
from marquee.sources.scratch import keep

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
BLOCK = 64
RUN = 100_000    # equal rows made by one task at a time


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """One row per source: source_size, docs, target.

    Targets are weight * level cut at `most` times the source; the level is raised until the cut excess
    is shared out. Only single numbers come to the driver. The window over all sources holds one row per
    source, already added up.
    """
    by_rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    sources = keep(
        sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
        .withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(by_rank, F.lit(len(weights)))))
        .withColumn("most", F.col("source_size") * float(most)),
        "sources",
    )
    wanted = float(sources.agg(F.sum("source_size")).first()[0] or 0) * share
    level, full = 0.0, -1
    while True:
        over = F.col("weight") * level > F.col("most") if full >= 0 else F.lit(False)
        row = sources.agg(F.sum(F.when(over, F.col("most"))).alias("cut"), F.sum(F.when(~over, F.col("weight"))).alias("open"),
                          F.count(F.when(over, 1)).alias("full")).first()
        if row["full"] == full or not row["open"]:
            break
        full, level = row["full"], (wanted - (row["cut"] or 0.0)) / row["open"]
    return sources.select("source", "source_size", "docs", F.least(F.col("most"), F.col("weight") * level).alias("target"))


def size_of() -> Column:
    """Number of words of the text."""
    return F.size(words(text_of("text"))).cast("bigint")


def one_by_one(sized: DataFrame, run: int = RUN) -> DataFrame:
    """The rows of (source, doc_id, size) with a number `nth`, 0, 1, ... among equal ones.

    Equal rows are interchangeable, so they are counted and made again from the count, in runs of `run` rows
    that are dealt over the tasks: a row that stands for a third of the table neither meets itself in one task
    nor comes out of one.
    """
    names = ["source", "doc_id", "size"]
    counted = keep(sized.groupBy(*names).agg(F.count("*").alias("n")), "counted")
    few = counted.filter(F.col("n") <= run).withColumn("first", F.lit(0).cast("bigint"))
    many = counted.filter(F.col("n") > run).withColumn(
        "first", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(run).cast("bigint")))).repartition(*names, "first")
    last = F.least(F.col("first") + (run - 1), F.col("n") - 1)
    return few.unionByName(many).select(*names, F.explode(F.sequence("first", last)).alias("nth"))


def _entry(doc_id: Column, nth: Column, size: Column, mass: Column) -> Column:
    return F.struct(doc_id.alias("doc_id"), size.alias("size"), mass.cast("double").alias("mass"), nth.alias("nth"))


def _decided(one: Column, extra: Column) -> Column:
    return F.struct(one["doc_id"].alias("doc_id"), one["size"].alias("size"), extra.cast("int").alias("extra"))


def _pair(state: Column, new: Column, salt: int) -> Column:
    """One step of the fold: the undecided document meets the next one; one of the two gets decided."""
    old = state["open"]
    into_old = F.least(old["size"] - old["mass"], new["mass"])   # what may move to the old one
    into_new = F.least(old["mass"], new["size"] - new["mass"])   # what may move to the new one
    towards_old = uniform(
        F.lit(salt), old["doc_id"], old["nth"], new["doc_id"], new["nth"], old["size"], new["size"]) * (into_old + into_new) < into_new
    old_fills = old["size"] - old["mass"] <= new["mass"]
    old_empties = old["mass"] <= new["size"] - new["mass"]

    def after(done: Column, extra: int, stays: Column, mass: Column) -> Column:
        return F.struct(F.concat(state["out"], F.array(_decided(done, F.lit(extra)))).alias("out"),
                        _entry(stays["doc_id"], stays["nth"], stays["size"], mass).alias("open"))

    whole = (old["mass"] <= 0) | (old["mass"] >= old["size"])
    return (
        F.when(old["size"].isNull(), F.struct(state["out"].alias("out"), _entry(new["doc_id"], new["nth"], new["size"], new["mass"]).alias("open")))
        .when(whole, F.struct(
            F.concat(state["out"], F.array(_decided(old, F.when(old["mass"] > 0, 1).otherwise(0)))).alias("out"),
            _entry(new["doc_id"], new["nth"], new["size"], new["mass"]).alias("open")))
        .when(towards_old & old_fills, after(old, 1, new, new["mass"] - into_old))
        .when(towards_old, after(new, 0, old, old["mass"] + into_old))
        .when(old_empties, after(old, 0, new, new["mass"] + into_new))
        .otherwise(after(new, 1, old, old["mass"] - into_new))
    )


def _level(items: DataFrame, id_type: str, salt: int, block: int) -> DataFrame:
    """Fold blocks of (source, doc_id, nth, size, mass, blocks): decided documents and one left over a block."""
    dealt = items.withColumn("blocks", F.ceil(F.col("blocks") / block)).withColumn(
        "block", F.pmod(F.xxhash64(F.lit(salt), "doc_id", "nth", "size"), F.col("blocks")))
    entry = _entry(F.col("doc_id"), F.col("nth"), F.col("size"), F.col("mass"))
    start = F.struct(F.array().cast(f"array<struct<doc_id:{id_type},size:bigint,extra:int>>").alias("out"),
                     F.lit(None).cast(f"struct<doc_id:{id_type},size:bigint,mass:double,nth:bigint>").alias("open"))
    return (
        dealt.groupBy("source", "block", "blocks")
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("size")).alias("turn"), entry.alias("one")))).alias("all"))
        .select("source", "blocks", F.aggregate("all", start, lambda s, x: _pair(s, x["one"], salt)).alias("end"))
        .select("source", "blocks", F.col("end.out").alias("out"), F.col("end.open").alias("open"))
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    id_type = dict(docs.dtypes)["doc_id"]
    sized = keep(docs.select("doc_id", F.col("source").cast("string").alias("source"), size_of().alias("size")), "sized")
    goals = keep(targets(sized, weights, share), "targets")
    goal = goals.select(F.col("source").alias("of"), "source_size", "target", "docs")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = one_by_one(sized).join(goal, F.col("source").eqNullSafe(F.col("of")), "left").drop("of").withColumn("expected", expected).withColumn(
        "whole", F.floor("expected").cast("int"))
    fraction = F.col("expected") - F.col("whole")
    split = (F.col("size") > 0) & (fraction > 0)
    open_rows = rows.filter(split).select("source", "doc_id", "nth", "size", (fraction * F.col("size")).alias("mass"), F.col("docs").alias("blocks"))
    settled = rows.filter(~split).select("source", "doc_id", "size", F.lit(0).alias("extra"))

    left, parts, salt = open_rows, [settled], 0
    most = goals.agg(F.max("docs")).first()[0] or 1
    while True:
        level = keep(_level(left, id_type, salt, block), "mix-level")
        parts.append(level.select("source", F.inline("out")))
        left = level.select("source", F.col("open.doc_id").alias("doc_id"), F.col("open.nth").alias("nth"), F.col("open.size").alias("size"),
                            F.col("open.mass").alias("mass"), "blocks")
        most, salt = -(-most // block), salt + 1
        if most <= 1:
            break
    last = uniform(F.lit("last"), F.col("doc_id"), F.col("nth"), F.col("size")) * F.col("size") < F.col("mass")
    parts.append(left.select("source", "doc_id", "size", last.cast("int").alias("extra")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    copies = F.when(F.col("size") > 0, F.col("whole") + F.col("extra")).otherwise(0)
    plan = goal.withColumn("whole", F.floor(expected).cast("int"))
    return out.join(plan, F.col("source").eqNullSafe(F.col("of")), "left").select(
        "doc_id", "source", "size", "source_size", "target", copies.cast("int").alias("copies"),
        (copies * F.col("size")).cast("bigint").alias("taken"))
