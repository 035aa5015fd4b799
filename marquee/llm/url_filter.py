"""URL filter: domain rules, and a logistic regression on hashed character n-grams of host and path.

Method: the n-grams of 3 to 5 characters of the host and of the path, each with end marks and kept apart
by a tag, are hashed to FEATURES cells; a logistic regression fitted on a small labelled table of URLs
(`LABELLED`, a parameter) weighs them. Scoring is one projection over the pages: no shuffle, no Python.

Defined cases: a null url, or one without "://", has an empty host and path, no rule, and is judged by
the model on empty strings; repeated rows are judged alike; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marquee.llm.common import bind, constant_array

FEATURES = 1 << 12
NGRAMS = (3, 4, 5)
BLOCK_AT = 0.5

# Verdict, host, path prefix.
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]

# The labelled URL table: invented hosts under reserved names; 1 = unwanted.
UNWANTED_HOSTS = [
    "cheap-pills", "best-pills-online", "discount-pharmacy", "buy-viagra-now", "online-casino", "casino-bonus",
    "free-slots", "poker-jackpot", "lucky-jackpot", "spam-farm", "link-farm", "seo-links", "click-bait", "click-farm",
    "adult-cams", "xxx-videos", "hot-singles", "payday-loans", "fast-loan", "easy-money", "get-rich-quick",
    "replica-watches", "fake-bags", "warez-download", "cracked-keygen", "free-torrent", "miracle-diet",
    "weight-loss-pills", "crypto-doubler", "win-free-prize", "sports-bets", "bets-and-odds", "ads-server", "ad-tracker",
]
WANTED_HOSTS = [
    "library", "university", "museum", "observatory", "gazette", "weather", "recipes", "gardening", "history",
    "mathematics", "physics", "chemistry", "poetry", "therapist", "athens", "theatre", "cathedral", "northern-river",
    "station", "foundation", "translation", "education", "parliament", "statistics", "hospital", "railway",
    "orchestra", "archive", "journal", "wiki", "whitby", "anderson", "thorner", "reading",
]
HOST_FRAMES = ["https://www.{}.example.com/en/12", "http://{}.example.org/fr/345.html", "https://blog.{}.example.net/es/7?page=2",
               "http://m.{}.example.com/de/68/"]
LABELLED = [(frame.format(host), label) for label, hosts in ((1, UNWANTED_HOSTS), (0, WANTED_HOSTS))
            for host in hosts for frame in HOST_FRAMES]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and without "://"."""
    known = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(known, PARTS, 1), UPPER, LOWER)
    return host, F.regexp_extract(known, PARTS, 2)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    def fits(rule_host: str, prefix: str) -> Column:
        return ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(prefix)

    longest_first = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    found = [F.when(fits(h, p), F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for v, h, p in longest_first]
    return F.coalesce(*found)


def _grams(tag: str, part: Column) -> Column:
    marked = F.concat(F.lit("^"), part, F.lit("$"))

    def of_length(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(marked) - (n - 1))
        cells = F.transform(starts, lambda i: F.pmod(F.xxhash64(F.lit(tag), F.substring(marked, i, F.lit(n))), F.lit(FEATURES)).cast("int"))
        return F.when(F.length(marked) >= n, cells).otherwise(F.array().cast("array<int>"))

    return F.concat(*[of_length(n) for n in NGRAMS])


def cells_of(host: Column, path: Column) -> Column:
    """Hashed n-grams, repeats included."""
    return F.concat(_grams("host", host), _grams("path", path))


def train(spark: SparkSession, labelled: list[tuple[str, int]] = LABELLED, reg: float = 0.0005) -> tuple[list[float], float]:
    """Weights and intercept. The table is small by contract; rows x FEATURES numbers are fitted."""
    lines = F.split(F.lit("\n".join(f"{label} {url}" for url, label in labelled)), "\n")
    table = spark.range(1).select(F.explode(lines).alias("line")).select(
        F.substring("line", 3, 10_000).alias("url"), F.substring("line", 1, 1).cast("double").alias("label"))
    host, path = host_and_path(F.col("url"))
    counts = (
        table.select("url", "label", cells_of(host, path).alias("cells"))
        .select("url", "label", F.sqrt(F.size("cells")).alias("root"), F.explode("cells").alias("cell"))
        .groupBy("url", "label", "root", "cell").agg(F.count("*").alias("n"))
        .groupBy("url", "label").agg(F.map_from_entries(F.collect_list(F.struct("cell", F.col("n") / F.col("root")))).alias("at"))
    )
    dense = bind(F.col("at"), lambda at: F.transform(
        F.sequence(F.lit(0), F.lit(FEATURES - 1)), lambda i: F.coalesce(F.try_element_at(at, i), F.lit(0.0))))
    rows = counts.select("label", array_to_vector(dense).alias("features")).coalesce(1)  # a few hundred rows
    model = LogisticRegression(regParam=reg, maxIter=40, standardization=False).fit(rows)
    return [float(w) for w in model.coefficients], float(model.intercept)


def judge(pages: DataFrame, weights: list[float], intercept: float, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """One row per page: host, path, rule, verdict, and the model's probability that it is unwanted."""
    host, path = host_and_path(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    table = constant_array(weights)
    total = F.aggregate("cells", F.lit(0.0), lambda a, c: a + F.get(table, c))
    margin = F.lit(intercept) + total / F.sqrt(F.greatest(F.size("cells"), F.lit(1)))
    scored = parts.select("*", rule_of(F.col("host"), F.col("path"), rules).alias("found"),
                          cells_of(F.col("host"), F.col("path")).alias("cells")).withColumn(
        "score", F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)))
    by_model = F.when(F.col("score") >= BLOCK_AT, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", F.col("found.rule").alias("rule"),
                         F.coalesce(F.col("found.verdict"), by_model).alias("verdict"), "score")


def filter_urls(pages: DataFrame, labelled: list[tuple[str, int]] = LABELLED, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    weights, intercept = train(pages.sparkSession, labelled)
    return judge(pages, weights, intercept, rules)
