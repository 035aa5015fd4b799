"""Term vectors and exact similarity search over them.

A vector is a row (id, terms) with terms an array of (term, w) sorted by term. Its postings are the
exploded form (id, term, w).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.functions import lists
from marquee.functions.spread import BROADCAST_BYTES, BROADCAST_ROWS, fits_broadcast, parts_for, salted_lookup, top_n
from marquee.sources.scratch import keep, keep_dealt

HEAD_TERMS = 4 * BROADCAST_ROWS  # frequent terms that may be broadcast with their counts
LONGEST_BROADCAST = 64           # bytes of such a term
MAX_SEEDS = 10_000
SIGNATURE_TERMS = 8
TERM_CHUNK = 1_000  # queries, and items, of one term that meet in one task
LEVELS = 16  # steps in which postings are told apart by what they can reach
_MARGIN = 1e-9  # room for floating-point noise in every pruning test
GENRE_WEIGHT, OVERVIEW_WEIGHT, KEYWORD_WEIGHT = 0.2, 0.5, 0.3
NEAREST = 50


def english_stop_words() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english")


def term_counts(df: DataFrame, key: str, column: str, stop_words: list[str] | None = None) -> DataFrame:
    """(id, term, n) of the word tokens of a text, stop words left out."""
    return _dealt_counts(df, key, column, stop_words, parts_for(df)).drop("_h")


def _dealt_counts(df: DataFrame, key: str, column: str, stop_words: list[str] | None, parts: int) -> DataFrame:
    """(_h, id, term, n), dealt by the hash of the id: whole texts are shuffled, and their words counted where they arrive."""
    stops = english_stop_words() if stop_words is None else stop_words
    # the hash is never null, so that texts without an id can be joined by it
    texts = df.select(F.xxhash64(key).alias("_h"), F.col(key).alias("id"), F.col(column).alias("_text")).repartition(parts, "_h")
    # explode_outer: the plain form makes Spark add a size test that tokenizes every text twice
    words = texts.select("_h", "id", F.explode_outer(lists.tokens("_text")).alias("term"))
    kept = words.filter(F.col("term").isNotNull() & ~F.col("term").isin(stops))
    return kept.groupBy("_h", "id", "term").agg(F.count("*").alias("n"))


def _unit(weighted: DataFrame, group: list[str]) -> DataFrame:
    """(id, term, w) -> vectors of length one. Terms are sorted first, so equal texts give equal bits."""
    rows = weighted.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("term", "w"))).alias("terms"))
    # the norm is a lambda variable, so it is computed once per vector and not once per element
    norm = F.sqrt(F.aggregate("terms", F.lit(0.0), lambda a, t: a + t["w"] * t["w"]))
    scaled = F.transform(F.array(norm), lambda n: F.transform(
        "terms", lambda t: F.struct(t["term"].alias("term"), (t["w"] / n).alias("w"))))
    return rows.select(*group, scaled[0].alias("terms"))


def _with_frequency(counted: DataFrame, freq: DataFrame, parts: int, most_broadcast: int = HEAD_TERMS) -> DataFrame:
    """(_h, id, term, n, df) of counted texts (_h, id, terms), a table in buckets by _h.

    Terms in more than the `most_broadcast`th part of all postings are fewer than `most_broadcast`, and are broadcast: their
    postings, most of all, stay where they lie. The others are rare, so no task gets many of one term: only
    their postings are shuffled by term, and what is found goes back to the texts. Without such terms nothing moves.
    """
    sums = freq.agg(F.count("*").alias("terms"), F.sum("df").alias("postings"), F.sum(F.octet_length("term")).alias("bytes")).first()
    flat = counted.select("_h", "id", F.inline("terms"))
    if sums["terms"] <= most_broadcast and (sums["bytes"] or 0) <= BROADCAST_BYTES:
        return flat.join(F.broadcast(freq), "term")
    frequent = (F.col("df") > sums["postings"] / most_broadcast) & (F.octet_length("term") <= LONGEST_BROADCAST)
    heads = F.broadcast(freq.filter(frequent))
    rare = flat.select("id", "term").join(heads, "term", "left_anti").join(freq.filter(~frequent), "term")
    returned = rare.repartition(parts, F.xxhash64("id")).select(F.xxhash64("id").alias("_h"), "id", "term", "df").groupBy("_h").agg(
        F.collect_list(F.struct("id", "term", "df")).alias("_rare"))
    # every entry carries its id, so ids of one hash may share a row; max() takes what is told twice once
    own = F.transform("terms", lambda t: F.struct(
        F.col("id").alias("id"), t["term"].alias("term"), t["n"].alias("n"), F.lit(None).cast("bigint").alias("_df")))
    told = F.transform("_rare", lambda t: F.struct(
        t["id"].alias("id"), t["term"].alias("term"), F.lit(None).cast("bigint").alias("n"), t["df"].alias("_df")))
    both = counted.join(returned, "_h", "left").select("_h", F.inline(F.when(F.col("_rare").isNull(), own).otherwise(F.concat(own, told))))
    return both.join(heads, "term", "left").groupBy("_h", "id", "term").agg(F.max("n").alias("n"), F.max(F.coalesce("_df", "df")).alias("df"))


def tfidf_vectors(df: DataFrame, key: str, column: str, stop_words: list[str] | None = None) -> DataFrame:
    """Unit vectors with weight n * (ln((1 + texts) / (1 + df)) + 1)."""
    return dealt_tfidf_vectors(df, key, column, stop_words).drop("_h")


def dealt_tfidf_vectors(df: DataFrame, key: str, column: str, stop_words: list[str] | None = None) -> DataFrame:
    """As tfidf_vectors, with the hash of the id that the rows are dealt by: (_h, id, terms).

    Words are counted once and written; the counts move no more, apart from those of rare terms.
    """
    parts = parts_for(df)
    listed = _dealt_counts(df, key, column, stop_words, parts).groupBy("_h", "id").agg(F.collect_list(F.struct("term", "n")).alias("terms"))
    counted = keep_dealt(listed, "term-counts", "_h", parts)
    freq = keep(counted.select(F.explode("terms.term").alias("term")).groupBy("term").agg(F.count("*").alias("df")), "document-frequency")
    texts = df.agg(F.count("*").cast("double")).scalar()
    idf = F.log((1 + texts) / (1 + F.col("df"))) + 1
    return _unit(_with_frequency(counted, freq, parts).select("_h", "id", "term", (F.col("n") * idf).alias("w")), ["_h", "id"])


def count_vectors(df: DataFrame, key: str, column: str, stop_words: list[str] | None = None) -> DataFrame:
    """Unit vectors of plain term counts."""
    return dealt_count_vectors(df, key, column, stop_words).drop("_h")


def dealt_count_vectors(df: DataFrame, key: str, column: str, stop_words: list[str] | None = None) -> DataFrame:
    """As count_vectors, with the hash of the id that the rows are dealt by: (_h, id, terms)."""
    counts = _dealt_counts(df, key, column, stop_words, parts_for(df))
    return _unit(counts.select("_h", "id", "term", F.col("n").cast("double").alias("w")), ["_h", "id"])


def set_vectors(df: DataFrame, key: str, array: str) -> DataFrame:
    """Distinct elements of an array column, each with weight one."""
    values = F.sort_array(F.array_distinct(F.filter(F.coalesce(F.col(array), F.array().cast("array<string>")), lambda x: x != "")))
    return df.select(F.col(key).alias("id"), values.alias("_v")).filter(F.size("_v") > 0).select(
        "id", F.transform("_v", lambda x: F.struct(x.alias("term"), F.lit(1.0).alias("w"))).alias("terms")
    )


def postings(vectors: DataFrame) -> DataFrame:
    return vectors.select("id", F.size("terms").alias("size"), F.explode("terms").alias("_t")).select(
        "id", "size", F.col("_t.term").alias("term"), F.col("_t.w").alias("w")
    )


def jaccard(a: Column, b: Column) -> Column:
    """Size of the intersection over size of the union; 0 when both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


# --- similarity to given seeds --------------------------------------------------------------


def _seed_pairs(vectors: DataFrame, seeds: DataFrame, as_sets: bool) -> DataFrame:
    """(seed, item, score) for every item that shares a term with a seed, the seed itself included.

    While the seeds' postings are few (counted first) they are broadcast, so the table is read where
    it lies and each task sends on one partial sum per seed and item. Beyond that both sides are
    shuffled by term and salt.
    """
    wanted = vectors.join(
        F.broadcast(seeds) if fits_broadcast(seeds, MAX_SEEDS) else seeds, F.col("id") == F.col("seed_id"), "left_semi"
    )
    left = postings(vectors)
    right = postings(wanted).select(
        F.col("id").alias("seed_id"), F.col("size").alias("seed_size"), "term", F.col("w").alias("seed_w")
    )
    if fits_broadcast(right):
        joined = left.join(F.broadcast(right), "term")
    else:
        joined = salted_lookup(left, right, ["term"], ["id"])
    return pair_scores(joined, as_sets)


def pair_scores(met: DataFrame, as_sets: bool) -> DataFrame:
    """(seed_id, item_id, score) from rows (id, size, w, seed_id, seed_size, seed_w), one a shared term."""
    dot = F.sum(F.col("w") * F.col("seed_w"))
    if as_sets:
        sums = met.groupBy("seed_id", F.col("id").alias("item_id"), "seed_size", "size").agg(dot.alias("_c"))
        score = F.col("_c") / (F.col("seed_size") + F.col("size") - F.col("_c"))
        return sums.select("seed_id", "item_id", score.alias("score"))
    return met.groupBy("seed_id", F.col("id").alias("item_id")).agg(dot.alias("score"))


def nearest_only(pairs: DataFrame, nearest: int | None) -> DataFrame:
    """The `nearest` best pairs of each seed, or all."""
    if not nearest:
        return pairs
    return top_n(pairs, ["seed_id"], [F.round("score", 9).desc(), F.col("item_id").asc()], nearest, "_near").drop("_near")


def blend(parts: DataFrame, seeds: DataFrame, least: DataFrame, n: int) -> DataFrame:
    """Top-n of summed scores (seed_id, item_id, score); items that score nowhere follow in the order of `least` (id)."""
    low_ids = least.agg(F.collect_list("id")).scalar()
    fill = seeds.withColumn("_ids", low_ids).select("seed_id", F.explode("_ids").alias("item_id"), F.lit(0.0).alias("score"))
    blended = (
        parts.unionByName(fill).filter(F.col("item_id") != F.col("seed_id"))
        .groupBy("seed_id", "item_id").agg(F.round(F.sum("score"), 6).alias("score"))
    )
    return top_n(blended, ["seed_id"], [F.desc("score"), F.asc("item_id")], n)


def similar_to_seeds(
    features: list[tuple[DataFrame, float, bool]], catalog: DataFrame, seeds: DataFrame, n: int = 10,
    nearest: int | None = None,
) -> DataFrame:
    """Top-n items of each seed under a weighted blend: (seed_id, rank, item_id, score).

    `features` lists (vectors, weight, as_sets). With `nearest`, a vector feature counts only for
    the `nearest` closest items of the seed, itself among them, and is 0 elsewhere. Items that
    share nothing with a seed follow with score 0 in id order, as in a full scan: the 2n + 2
    smallest ids of the catalog are enough to fill any list that has fewer than n others.
    """
    parts = None
    for vectors, weight, as_sets in features:
        pairs = nearest_only(_seed_pairs(vectors, seeds, as_sets), nearest if not as_sets else None)
        part = pairs.select("seed_id", "item_id", (F.col("score") * weight).alias("score"))
        parts = part if parts is None else parts.unionByName(part)
    return blend(parts, seeds, catalog.select("id").orderBy("id").limit(2 * n + 2), n)


def dealt_features(
    catalog: DataFrame, texts: DataFrame, genre_weight: float = GENRE_WEIGHT, overview_weight: float = OVERVIEW_WEIGHT,
    keyword_weight: float = KEYWORD_WEIGHT,
) -> list[tuple[DataFrame, float, bool]]:
    """Genre sets, overview TF-IDF and keyword counts of a catalog (id, genres, keywords) and its texts (id, overview), not yet written.

    The last two come with `_h`, the hash of the id that they are dealt by.
    """
    squashed = catalog.select(
        "id", lists.squash(lists.parse_list_or_literal("genres")).alias("_g"),
        lists.join_list(lists.squash(lists.parse_list_or_literal("keywords"))).alias("_k"),
    )
    return [
        (set_vectors(squashed, "id", "_g"), genre_weight, True),
        (dealt_tfidf_vectors(texts.select("id", "overview"), "id", "overview"), overview_weight, False),
        (dealt_count_vectors(squashed, "id", "_k"), keyword_weight, False),
    ]


def blended_features(catalog: DataFrame, **weights: float) -> list[tuple[DataFrame, float, bool]]:
    """Genre sets, overview TF-IDF and keyword counts of a catalog (id, genres, overview, keywords)."""
    labels = ("genre-sets", "overview-vectors", "keyword-vectors")
    return [(keep(vectors.drop("_h"), label), weight, as_sets)
            for label, (vectors, weight, as_sets) in zip(labels, dealt_features(catalog, catalog, **weights))]


def seeds_by_title(catalog: DataFrame, titles: list) -> tuple[DataFrame, DataFrame]:
    """Seeds (seed_id, title, matches) and problems (title, message).

    A title that occurs more than once stands for its smallest id; `matches` tells how often.
    """
    spark = catalog.sparkSession
    wrong = [(str(t), "Error: title must be a string.") for t in titles if not isinstance(t, str)]
    asked = spark.createDataFrame([(t,) for t in dict.fromkeys(titles) if isinstance(t, str)], "title string")
    found = (
        catalog.join(F.broadcast(asked), "title", "left_semi")
        .groupBy("title").agg(F.min("id").alias("seed_id"), F.count("*").alias("matches"))
    )
    missing = asked.join(found, "title", "left_anti").withColumn("message", F.lit("Error: title not found."))
    problems = missing.unionByName(spark.createDataFrame(wrong, "title string, message string"))
    return found.select("seed_id", "title", "matches"), problems


def seeds_by_id(catalog: DataFrame, ids: list) -> tuple[DataFrame, DataFrame]:
    """Seeds (seed_id, title) and problems (asked, message) for ids that may be text."""
    spark = catalog.sparkSession
    good: list[tuple[str, int]] = []
    wrong: list[tuple[str, str]] = []
    for asked in ids:
        try:
            good.append((str(asked), int(asked)))
        except (TypeError, ValueError):
            wrong.append((str(asked), "Error: id must be an integer."))
    wanted = spark.createDataFrame(good, "asked string, seed_id bigint")
    found = catalog.join(F.broadcast(wanted), F.col("id") == F.col("seed_id"), "inner").select("seed_id", "title").distinct()
    missing = wanted.join(found, "seed_id", "left_anti").select("asked", F.lit("Error: id not found.").alias("message"))
    return found, missing.unionByName(spark.createDataFrame(wrong, "asked string, message string"))


# --- nearest items of every item ------------------------------------------------------------


@dataclass(frozen=True)
class Measure:
    """A similarity that grows with the weight two vectors share, and the bounds used to prune it.

    Terms have one order for all vectors, from the most frequent to the rarest. `run` is the sum of squared
    weights of a vector from its most frequent term up to a term, that one included: what two vectors can
    still share if that term is the rarest they have in common.
    """

    score: Callable[[Column, Column, Column], Column]               # shared, query size, item size
    upper: Callable[[Column, Column, Column, Column], Column]       # shared, left out, query size, item size
    reach: Callable[[Column, Column], Column]                       # run, size: best score with this term as rarest
    need: Callable[[Column, Column, Column], Column]                # bound, run, size: least reach of the other vector
    rest: Callable[[Column, Column, Column, Column], Column]        # runs of both without this term: left to share


COSINE = Measure(
    score=lambda s, q, i: s,
    upper=lambda s, d, q, i: s + d,
    reach=lambda run, n: F.sqrt(run),
    need=lambda bound, run, n: bound / F.sqrt(run),
    rest=lambda q_run, qw, run, w: F.sqrt(F.greatest(q_run - qw * qw, F.lit(0.0)) * F.greatest(run - w * w, F.lit(0.0))),
)
JACCARD = Measure(
    score=lambda s, q, i: s / (q + i - s),
    upper=lambda s, d, q, i: F.least(s + d, q, i) / (q + i - F.least(s + d, q, i)),
    reach=lambda run, n: run / n,
    need=lambda bound, run, n: bound,
    rest=lambda q_run, qw, run, w: F.least(q_run, run) - 1,
)


def _shared_by_term(query: DataFrame, item: DataFrame, k: int, measure: Measure) -> DataFrame:
    """(q, id, score) lower bounds from the k + 1 heaviest postings of each of the query's terms."""
    champions = top_n(item, ["term"], [F.desc("w"), F.asc("size"), F.asc("id")], k + 1, "_c").drop("_c")
    probes = query.filter(F.col("df") > k)
    return (
        salted_lookup(probes, champions, ["term"], ["q"]).filter(F.col("id") != F.col("q"))
        .groupBy("q", "q_size", "id", "size").agg(F.sum(F.col("qw") * F.col("w")).alias("s"))
        .select("q", "id", measure.score(F.col("s"), F.col("q_size"), F.col("size")).alias("score"))
    )


def _shared_by_signature(vectors: DataFrame, query: DataFrame, k: int, measure: Measure) -> DataFrame:
    """(q, id, score) lower bounds from vectors that agree on all but one of their main terms.

    A vector has one signature for each of its SIGNATURE_TERMS heaviest terms: the others of them,
    in alphabetical order. The k + 1 shortest vectors stand for a signature.
    """
    main = top_n(query, ["q"], [F.desc("qw"), F.asc("df"), F.asc("term")], SIGNATURE_TERMS, "_r")
    heads = main.groupBy("q", "q_size").agg(F.sort_array(F.collect_list(F.struct("term", "qw"))).alias("_head"))
    signed = (
        heads.withColumn("_out", F.explode(F.sequence(F.lit(0), F.size("_head") - 1)))
        .withColumn("_rest", F.filter("_head", lambda t, i: i != F.col("_out")))
        .filter(F.size("_rest") > 0)
        .select("q", "q_size", F.sha2(F.to_json(F.col("_rest")["term"]), 256).alias("sig"), F.col("_rest")["qw"].alias("qws"))
    )
    stand_ins = top_n(
        signed.select(F.col("q").alias("id"), F.col("q_size").alias("size"), "sig", F.col("qws").alias("ws")),
        ["sig"], [F.asc("size"), F.asc("id")], k + 1, "_c",
    ).drop("_c")
    dot = F.aggregate(F.zip_with("qws", "ws", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    return (
        salted_lookup(signed, stand_ins, ["sig"], ["q"]).filter(F.col("id") != F.col("q"))
        .select("q", "id", measure.score(dot, F.col("q_size"), F.col("size")).alias("score"))
    )


def _prefix_plan(vectors: DataFrame, k: int, measure: Measure) -> DataFrame:
    """Every posting in both its roles: (q, q_size, bound, term, qw, df, run, level, lo, dropped).

    `bound` is what an item must score to enter the list of q. As part of an item the posting has a `level`,
    its reach in steps of 1 / LEVELS rounded up; as part of a query it only has to meet levels from `lo` on.
    """
    all_postings = keep(postings(vectors), "postings")
    freq = all_postings.groupBy("term").agg(F.count("*").alias("df"))
    counted = keep(salted_lookup(all_postings, freq, ["term"], ["id"]), "counted-postings")
    query = counted.select(F.col("id").alias("q"), F.col("size").alias("q_size"), "term", F.col("w").alias("qw"), "df")
    item = all_postings.select("id", "size", "term", "w")

    partial = _shared_by_term(query, item, k, measure).unionByName(_shared_by_signature(vectors, query, k, measure))
    bound = (
        top_n(partial.groupBy("q", "id").agg(F.max("score").alias("score")), ["q"], [F.desc("score"), F.asc("id")], k, "_r")
        .filter(F.col("_r") == k).select("q", (F.col("score") - _MARGIN).alias("bound"))
    )
    rare_last = Window.partitionBy("q").orderBy(F.desc("df"), F.asc("term")).rowsBetween(Window.unboundedPreceding, 0)
    runs = query.join(bound, "q", "left").withColumn("bound", F.coalesce("bound", F.lit(0.0))).withColumn(
        "run", F.sum(F.col("qw") * F.col("qw")).over(rare_last))
    reach, need = measure.reach(F.col("run"), F.col("q_size")), measure.need(F.col("bound"), F.col("run"), F.col("q_size"))
    steps = F.least(F.greatest(F.ceil((need - _MARGIN) * LEVELS), F.lit(1)), F.lit(LEVELS + 1))
    return runs.withColumns({
        "level": F.least(F.greatest(F.ceil((reach + _MARGIN) * LEVELS), F.lit(1)), F.lit(LEVELS)).cast("int"),
        "dropped": reach < F.col("bound"),
    }).withColumn("lo", F.when(F.col("dropped"), LEVELS + 1).otherwise(steps).cast("int"))


def _meetings(plan: DataFrame) -> DataFrame:
    """A row for each query posting and each item posting of the same term that it has to meet.

    Both sides of a term are cut by its frequency into chunks, and each chunk of queries meets each of items;
    a term of up to TERM_CHUNK items is repeated for its levels only.
    """
    chunks = F.ceil(F.col("df") / TERM_CHUNK).cast("int")
    every = F.sequence(F.lit(0), chunks - 1)
    asked = plan.filter(F.col("lo") <= LEVELS).select(
        "q", "q_size", "bound", "term", "qw", F.col("run").alias("q_run"), "df", F.explode(F.sequence("lo", F.lit(LEVELS))).alias("level")
    ).withColumn("_sq", F.pmod(F.xxhash64("q"), chunks).cast("int")).withColumn("_si", F.explode(every)).drop("df")
    items = plan.select(F.col("q").alias("id"), F.col("q_size").alias("size"), "term", F.col("qw").alias("w"), "run", "level", "df").withColumn(
        "_si", F.pmod(F.xxhash64("id"), chunks).cast("int")).withColumn("_sq", F.explode(every)).drop("df")
    return asked.join(items, ["term", "level", "_sq", "_si"]).filter(F.col("id") != F.col("q"))


def _nearest_distinct(vectors: DataFrame, k: int, measure: Measure) -> DataFrame:
    """Top-k others of every vector, exact: (id, other, score), scores above 0 only.

    1. Each query gets a lower bound for its k-th best score from the champions of its terms and of
       its signatures: k + 1 rows for each, whatever the frequency.
    2. The rarest term two vectors have in common limits what they can score by what both have from that
       term on. So a vector is looked up, and found, under its rarer terms only: a posting of a query
       meets only those postings of items whose reach, together with its own, can come up to the bound.
    3. Met postings are added up. A pair whose sum and the least rest after a met term stay below the
       bound is discarded; the survivors are completed with the terms that were not met.
    """
    plan = keep(_prefix_plan(vectors, k, measure), "query-plan")
    rest_here = measure.rest(F.col("q_run"), F.col("qw"), F.col("run"), F.col("w"))
    shared = (
        _meetings(plan).groupBy("q", "id", "q_size", "size", "bound")
        .agg(F.sum(F.col("qw") * F.col("w")).alias("s"), F.min(rest_here).alias("left_out"))
        .filter(measure.upper(F.col("s"), F.col("left_out") + _MARGIN, F.col("q_size"), F.col("size")) >= F.col("bound"))
    )
    survivors = keep(shared.select("q", "id", "q_size", "size", "s"), "survivors")
    unmet = plan.filter(F.col("lo") > 1).select("q", "term", "qw", "lo")
    rest = (
        survivors.select("q", "id").join(unmet, "q")
        .join(plan.select(F.col("q").alias("id"), "term", F.col("qw").alias("w"), "level"), ["id", "term"])
        .filter(F.col("level") < F.col("lo"))
        .groupBy("q", "id").agg(F.sum(F.col("qw") * F.col("w")).alias("more"))
    )
    scored = survivors.join(rest, ["q", "id"], "left").select(
        "q", "id", measure.score(F.col("s") + F.coalesce("more", F.lit(0.0)), F.col("q_size"), F.col("size")).alias("score")
    )
    best = scored.withColumn("score", F.round("score", 9))
    return top_n(best, ["q"], [F.desc("score"), F.asc("id")], k, "_r").select(
        F.col("q").alias("id"), F.col("id").alias("other"), "score"
    )


def nearest_items(vectors: DataFrame, k: int, measure: Measure = COSINE) -> DataFrame:
    """The k most similar other items of every item: (id, rank, other, score), ties by id.

    Equal vectors are searched once. A group of copies is represented by its smallest id and can
    enter a list with its k + 1 smallest ids at most, because ties go to the smaller id; so even
    when a third of all items are copies of one item, only k + 1 of them travel.
    """
    signed = keep(vectors.withColumn("sig", F.sha2(F.to_json("terms"), 256)), "signed-vectors")
    first = top_n(signed, ["sig"], [F.asc("id")], k + 1, "_m")
    members = keep(first.select("sig", "id", "_m"), "copies")
    unique = first.filter(F.col("_m") == 1).select("id", "terms")
    near = _nearest_distinct(unique, k, measure)

    head = members.filter(F.col("_m") == 1).select(F.col("id").alias("rep"), "sig")
    pairs = (
        near.join(head, F.col("other") == F.col("rep")).select("id", "sig", "score")
        .unionByName(head.select(F.col("rep").alias("id"), "sig", F.lit(1.0).alias("score")))
    )
    listed = pairs.join(members.select("sig", F.col("id").alias("other")), "sig").select("id", "other", "score")
    best = top_n(listed, ["id"], [F.desc("score"), F.asc("other")], k + 1, "_r")
    lists_of = best.groupBy("id").agg(F.collect_list(F.struct("_r", "other", "score")).alias("_near")).join(
        head.select(F.col("rep").alias("id"), "sig"), "id").select("sig", "_near")
    everyone = salted_lookup(signed.select("id", "sig"), lists_of, ["sig"], ["id"])
    own = F.filter(F.sort_array("_near"), lambda s: s["other"] != F.col("id"))
    return everyone.select("id", F.posexplode(F.slice(own, 1, k)).alias("_p", "_s")).select(
        "id", (F.col("_p") + 1).alias("rank"), F.col("_s.other").alias("other"), F.col("_s.score").alias("score")
    )


def filled_lists(near: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """Lists of nearest items (id, rank, other, score) filled to k with score 0 in the order of ids.

    Items that share nothing with the rest, or have no terms at all, get a list too. A list holds k items
    at most and leaves out itself, so the 2k + 1 smallest ids are all that can be needed.
    """
    least = [r["id"] for r in items.select("id").orderBy("id").limit(2 * k + 1).collect()]
    lists_of = near.groupBy("id").agg(F.collect_list(F.struct("rank", "other", "score")).alias("_near"))
    found = items.select("id").join(lists_of, "id", "left").withColumn(
        "_near", F.coalesce("_near", F.array().cast("array<struct<rank:int,other:bigint,score:double>>")))
    other = F.array(*[F.lit(i).cast("bigint") for i in least])
    free = F.filter(other, lambda o: (o != F.col("id")) & ~F.array_contains(F.col("_near.other"), o))
    more = F.transform(F.slice(free, 1, F.greatest(k - F.size("_near"), F.lit(0))), lambda o, i: F.struct(
        (F.size("_near") + i + 1).alias("rank"), o.alias("other"), F.lit(0.0).alias("score")))
    return found.select("id", F.inline(F.concat("_near", more)))


def pinned_union(pinned: DataFrame, rest: DataFrame, key: str, order: str, n: int | None = None) -> DataFrame:
    """Pinned rows and all other rows, or the first n in `order`; a key that is in both is taken once."""
    first = rest if n is None else rest.orderBy(order).limit(n)
    both = pinned.withColumn("_from", F.lit(0)).unionByName(first.withColumn("_from", F.lit(1)))
    return top_n(both, [key], [F.asc("_from"), F.asc(order)], 1, "_r").drop("_r", "_from")
