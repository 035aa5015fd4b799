"""Quality rules: text statistics with fixed limits, and a likelihood ratio of hashed n-grams, in
DataFrame functions only.

Method: words and word pairs are hashed to CELLS cells. Two multinomials over the cells are counted, one
over every document (raw) and one over trusted documents (target). Raw counts are brought to the size of
the target sample and both sides get SMOOTHING more, so a cell too rare to tell weighs nothing. A
document's score is the mean of log(target / raw) over its n-grams, so it does not depend on its length;
a document is kept if the score reaches THRESHOLD. Nothing is drawn at random: the same text always gets
the same verdict against the same corpus.

The raw counts cover all documents, the target counts all documents labelled good.

The base rule comes first: fewer than LEAST_WORDS words, or more than MOST_REPEATED percent of words in
8-word windows that occur more than once in the text, fails.

Defined cases: null text has no words and fails the base rule; without trusted documents every score is
0 and the base rule decides; repeated rows get equal verdicts; an empty table gives an empty table;
columns other than doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marquee.functions.spread import BROADCAST_ROWS, checked_lookup
from marquee.llm.common import WORD_BREAK, bind, constant_array, text_of, words
from marquee.sources.scratch import keep

CELLS = 1 << 16         # the first half holds words, the second word pairs
SMOOTHING = 5.0
THRESHOLD = -0.15
LEAST_WORDS = 20
MOST_REPEATED = 30      # percent
WINDOW = 8
SYMBOLS = "[^#*$%&|<>]++"
WORD_START = "[^\\x20\\x09-\\x0D]"  # found at once, where a line has a word


def repeated_words(hashes: Column, window: int = WINDOW) -> Column:
    """Words covered by windows that occur twice or more in the text, given the hashes of its words.

    Window hashes are sorted; most texts have no equal neighbours and stop there. Otherwise (hash,
    position) pairs are sorted and the union of the repeated windows is measured: n log n, never n^2.
    """
    def of(found: Column) -> Column:
        ordered = F.sort_array(found)
        any_equal = bind(ordered, lambda s: F.exists(
            F.zip_with(s, F.slice(s, 2, F.greatest(F.size(s) - 1, F.lit(0))), lambda a, b: a == b), lambda e: F.coalesce(e, F.lit(False))))
        paired = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))

        def covered(p: Column) -> Column:
            twice = F.filter(p, lambda x, i: F.coalesce(F.get(p, i - 1)["h"] == x["h"], F.lit(False))
                             | F.coalesce(F.get(p, i + 1)["h"] == x["h"], F.lit(False)))
            starts = F.sort_array(F.transform(twice, lambda x: x["at"]))
            return bind(starts, lambda s: F.aggregate(
                F.transform(s, lambda at, i: F.least(F.lit(window), F.coalesce(F.get(s, i + 1) - at, F.lit(window)))),
                F.lit(0), lambda a, b: a + b))

        return F.when(any_equal, bind(paired, covered)).otherwise(0)

    def windows(all_hashes: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(all_hashes) - (window - 1))
        found = F.transform(starts, lambda i: F.xxhash64(F.slice(all_hashes, i, window)))
        return F.when(F.size(all_hashes) > window, bind(found, of)).otherwise(0)

    return bind(hashes, windows)


def ngram_cells(hashes: Column, cells: int = CELLS) -> Column:
    """Cells of all words and of all pairs of neighbouring words, given the hashes of the words."""
    half = cells // 2

    def of(all_hashes: Column) -> Column:
        single = F.transform(all_hashes, lambda h: F.pmod(h, F.lit(half)).cast("int"))
        rest = F.slice(all_hashes, 2, F.greatest(F.size(all_hashes) - 1, F.lit(0)))
        pairs = F.transform(rest, lambda h, i: (F.pmod(F.xxhash64(F.get(all_hashes, i), h), F.lit(half)) + half).cast("int"))
        return F.concat(single, pairs)

    return bind(hashes, of)


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def base_stats(docs: DataFrame) -> DataFrame:
    """doc_id, word hashes, the counted statistics and base_failed."""
    body = docs.select("doc_id", text_of("text").alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD_START))
    counted = body.select(
        "doc_id",
        word_hashes(F.col("text")).alias("hashes"),
        F.length(F.regexp_replace("text", WORD_BREAK, "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace("text", SYMBOLS, "")).cast("bigint").alias("n_symbols"),
        bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
    ).withColumns({
        "n_words": F.size("hashes").cast("bigint"),
        "n_repeat_words": repeated_words(F.col("hashes")).cast("bigint"),
    })
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of all documents labelled good."""
    return labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()


def log_ratios(
    docs: DataFrame, trusted: DataFrame, cells: int = CELLS, smoothing: float = SMOOTHING, most_broadcast: int = BROADCAST_ROWS,
) -> list[float]:
    """The log ratio of target to raw probability of every cell.

    The distinct ids of `trusted` are broadcast if a count shows that they are at most `most_broadcast`; beyond
    that texts and ids meet in a salted shuffle. Counts are added up in each task first, so a task ships at most
    `cells` rows; `cells` numbers, whatever the corpus, come to the driver.
    """
    good = keep(trusted.withColumn("good", F.lit(1)), "trusted")
    marked = checked_lookup(docs.select("doc_id", text_of("text").alias("text")), good, ["doc_id"], ["text"], "left", most_broadcast)
    grams = marked.select("good", F.explode(ngram_cells(word_hashes(F.col("text")), cells)).alias("cell"))
    counts = keep(grams.groupBy("cell").agg(F.count("*").alias("raw"), F.count("good").alias("target")), "cells")
    sums = counts.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).first()
    if not sums["target"]:
        return [0.0] * cells

    share = sums["target"] / sums["raw"]
    ratio = F.round(F.log((F.col("target") + smoothing) / (F.col("raw") * share + smoothing)), 4)
    table = [0.0] * cells
    for cell, value in counts.select("cell", ratio).collect():
        table[cell] = value
    return table


def judge(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, cells: int = CELLS) -> DataFrame:
    """One row per document: statistics, base_failed, score and kept."""
    table = constant_array(log_ratios(docs, trusted, cells))

    def mean(grams: Column) -> Column:
        total = F.aggregate(grams, F.lit(0.0), lambda a, c: a + F.get(table, c))
        return F.when(F.size(grams) > 0, total / F.size(grams)).otherwise(0.0)

    scored = base_stats(docs).withColumn("score", bind(ngram_cells(F.col("hashes"), cells), mean))
    kept = ~F.col("base_failed") & (F.col("score") >= threshold)
    return scored.drop("hashes").withColumn("kept", kept)
