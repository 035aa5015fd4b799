"""User-item interactions: codes, weights, splits, item features, seen items, ranking metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marquee.functions.spread import ordered_ids, rank_within, salted_lookup, top_n
from marquee.sources.scratch import keep

SEED = 42


def int_codes(df: DataFrame, column: str, order_key: str, out: str | None = None) -> DataFrame:
    """Replace values by 0-based codes in the order in which `order_key` first meets them; null is -1.

    The values are reduced to one row each before they are numbered and looked up again.
    """
    first = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_value")).agg(F.min(order_key).alias("_first"))
    codes = ordered_ids(first, "_first", "_code").select("_value", "_code")
    keyed = salted_lookup(df.withColumn("_value", F.col(column)), codes, ["_value"], [order_key], how="left")
    code = F.coalesce("_code", F.lit(-1).cast("bigint"))
    return keyed.withColumn(out or column, code).drop("_value", "_code")


def position_in_group(df: DataFrame, group: str, key: str, out: str = "position", size: str = "group_size") -> DataFrame:
    """0-based position of each row in its group by a numeric key, and the size of the group."""
    ranked = rank_within(df, [group], F.col(key), [F.asc(key)], out, size)
    return ranked.withColumn(out, F.col(out) - 1)


def relevant(df: DataFrame, threshold: float, rating: str = "rating", out: str = "relevant") -> DataFrame:
    return df.withColumn(out, (F.col(rating) >= threshold).cast("int"))


def interaction_weights(df: DataFrame, strategy: str = "default", rating: str = "rating", out: str = "weight") -> DataFrame:
    """`default`: 1; `ratings`: the rating; `condition_<t>`: 1 from t on, else 0."""
    if strategy == "default":
        weight = F.lit(1.0)
    elif strategy == "ratings":
        weight = F.col(rating).cast("double")
    elif strategy.startswith("condition_"):
        weight = F.when(F.col(rating) >= float(strategy.removeprefix("condition_")), 1.0).otherwise(0.0)
    else:
        raise ValueError(f"unknown weighting strategy: {strategy}")
    return df.withColumn(out, weight)


def _draw(seed: int, keys: list[str]) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def _fraction(digest: Column) -> Column:
    """First eight hexadecimal digits as a number in [0, 1)."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def user_split(
    df: DataFrame, user: str = "user_id", keys: tuple[str, ...] = ("user_id", "movie_id"),
    test_size: float = 0.2, seed: int = SEED, out: str = "is_test",
) -> DataFrame:
    """Flag max(1, floor(n * test_size)) random rows of each user with two or more rows as test.

    `keys` identify a row. The draw is a seeded hash of the keys, so a lost task draws the same rows.
    """
    drawn = df.withColumn("_draw", _draw(seed, list(keys)))
    ranked = rank_within(drawn, [user], _fraction(F.col("_draw")), [F.asc("_draw"), *[F.asc(k) for k in keys]], "_rank", "_size")
    wanted = F.greatest(F.lit(1), F.floor(F.col("_size") * F.lit(test_size)))
    return ranked.withColumn(out, ((F.col("_size") >= 2) & (F.col("_rank") <= wanted)).cast("int")).drop("_draw", "_rank", "_size")


def random_split(
    df: DataFrame, keys: tuple[str, ...] = ("user_id", "movie_id"), test_size: float = 0.2, seed: int = SEED,
    out: str = "is_test",
) -> DataFrame:
    """Flag each row as test with probability `test_size`; no shuffle."""
    return df.withColumn(out, (_fraction(_draw(seed, list(keys))) < test_size).cast("int"))


def split_interactions(df: DataFrame, method: str = "user", **options) -> tuple[DataFrame, DataFrame]:
    """(train, test) by `user` or `random`; one flag, so interactions and weights stay aligned."""
    splits = {"user": user_split, "random": random_split}
    if method not in splits:
        raise ValueError(f"unknown split method: {method}")
    flagged = splits[method](df, **options)
    return flagged.filter("is_test = 0").drop("is_test"), flagged.filter("is_test = 1").drop("is_test")


def without(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys do not occur in `other`."""
    return df.join(other.select(*keys), keys, "left_anti")


def seen_items(interactions: DataFrame, users: DataFrame, catalog: DataFrame) -> DataFrame:
    """Titles of everything the given users have interacted with; unknown users give no rows."""
    wanted = interactions.join(users.select("user_id").distinct(), "user_id", "left_semi").select("user_id", "movie_id").distinct()
    info = catalog.select(F.col("id").alias("movie_id"), "title")
    return salted_lookup(wanted, info, ["movie_id"], ["user_id"], how="left").withColumn(
        "title", F.coalesce("title", F.lit("Unknown"))
    )


def unknown_users(users: DataFrame, interactions: DataFrame) -> DataFrame:
    """(user_id, message) for asked users without interactions, who can get no list."""
    asked = users.select("user_id").distinct()
    return without(asked, interactions, ["user_id"]).withColumn("message", F.lit("Error: user not found."))


def known_positives(interactions: DataFrame, users: DataFrame, catalog: DataFrame, n: int = 10, rating: str = "rating") -> DataFrame:
    """The n best rated items of the given users, with titles, to be shown next to a recommendation."""
    wanted = interactions.join(users.select("user_id").distinct(), "user_id", "left_semi").select("user_id", "movie_id", rating)
    best = top_n(wanted, ["user_id"], [F.desc(rating), F.asc("movie_id")], n)
    info = catalog.select(F.col("id").alias("movie_id"), "title")
    return salted_lookup(best, info, ["movie_id"], ["user_id"], how="left").withColumn("title", F.coalesce("title", F.lit("Unknown")))


# --- item features ------------------------------------------------------------------------


def feature_list(columns: list[str]) -> Column:
    """Lower-case, trimmed, non-empty features of several delimited columns, in column order.

    Nulls give no feature; repeats are kept.
    """
    parts = F.transform(F.split(F.concat_ws(",", *columns), ","), lambda x: F.trim(F.lower(x)))
    return F.filter(parts, lambda x: x != "")


def item_features(df: DataFrame, columns: list[str], key: str = "id") -> DataFrame:
    return df.select(F.col(key).alias("movie_id"), feature_list(columns).alias("features"))


def feature_vocabulary(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(F.explode(feature_list(columns)).alias("feature")).distinct()


def simple_features(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct lower-case values of undelimited columns."""
    values = F.array(*[F.lower(F.trim(F.col(c).cast("string"))) for c in columns])
    return df.select(F.explode(values).alias("feature")).filter("feature <> ''").distinct()


def feature_matrix(features: DataFrame, identity: bool = True) -> DataFrame:
    """(movie_id, feature, weight): the item's own identity feature and its features, rows sum to 1.

    A feature that repeats in the list counts as often as it occurs.
    """
    own = F.concat(F.lit("item:"), F.col("movie_id").cast("string"))
    all_features = F.concat(F.array(own), "features") if identity else F.col("features")
    exploded = features.withColumn("_n", F.size(all_features)).select(
        "movie_id", "_n", F.explode(all_features).alias("feature")
    )
    return exploded.groupBy("movie_id", "feature", "_n").agg(F.count("*").alias("_c")).select(
        "movie_id", "feature", (F.col("_c") / F.col("_n")).alias("weight")
    )


# --- ranking metrics ------------------------------------------------------------------------


def ranks_from_scores(scores: DataFrame, positives: DataFrame, train: DataFrame | None = None) -> DataFrame:
    """0-based rank of each positive among its user's scored items, with the number ranked.

    Items of the user's training rows are left out first. Equal scores are ordered by item.
    """
    pool = without(scores, train, ["user_id", "movie_id"]) if train is not None else scores
    ranked = rank_within(pool, ["user_id"], -F.col("score"), [F.asc("movie_id")], "rank", "ranked")
    wanted = positives.select("user_id", "movie_id").distinct()
    return ranked.withColumn("rank", F.col("rank") - 1).join(wanted, ["user_id", "movie_id"], "left_semi").select(
        "user_id", "movie_id", "rank", "ranked"
    )


def precision_at_k(
    ranks: DataFrame, k: int, users: DataFrame | None = None, preserve_rows: bool = False
) -> DataFrame:
    """(user_id, precision) from 0-based ranks. `preserve_rows` keeps users without positives at 0."""
    per_user = ranks.groupBy("user_id").agg((F.count_if(F.col("rank") < k) / F.lit(k)).alias("precision"))
    if not preserve_rows or users is None:
        return per_user
    return users.select("user_id").distinct().join(per_user, "user_id", "left").fillna(0.0, ["precision"])


def user_metrics(ranks: DataFrame, ks: list[int]) -> DataFrame:
    """Precision@k, recall@k and AUC of every user with positives.

    AUC is the share of (positive, other) pairs in the right order, from the sum of ranks; a user
    whose ranked items are all positive gets 0.5.
    """
    n = F.count("*")
    other = F.max("ranked") - n
    right = n * F.max("ranked") - F.sum(F.col("rank") + 1) - n * (n - 1) / 2
    return ranks.groupBy("user_id").agg(
        *[(F.count_if(F.col("rank") < k) / F.lit(k)).alias(f"precision_{k}") for k in ks],
        *[(F.count_if(F.col("rank") < k) / n).alias(f"recall_{k}") for k in ks],
        F.when(other == 0, F.lit(0.5)).otherwise(right / (n * other)).alias("auc"),
    )


def mean_metrics(per_user: DataFrame) -> DataFrame:
    return per_user.agg(*[F.avg(c).alias(c) for c in per_user.columns if c != "user_id"])


def evaluate_scores(scores: DataFrame, train: DataFrame, test: DataFrame, ks: tuple[int, ...] = (3, 5, 10)) -> DataFrame:
    """Mean metrics of both splits; training items are left out when the test split is ranked."""
    scores, train, test = keep(scores, "scores"), keep(train, "train-split"), keep(test, "test-split")
    parts = [
        mean_metrics(user_metrics(ranks_from_scores(scores, train), list(ks))).withColumn("split", F.lit("train")),
        mean_metrics(user_metrics(ranks_from_scores(scores, test, train), list(ks))).withColumn("split", F.lit("test")),
    ]
    return parts[0].unionByName(parts[1])


def precision_recall_at_k(recommended: DataFrame, actual: DataFrame, k: int) -> DataFrame:
    """Mean precision@k and recall@k over the users of `actual`.

    `recommended` is (user_id, movie_id, rank from 1). A user without recommendations counts as 0.
    """
    listed = recommended.filter(F.col("rank") <= k).select("user_id", "movie_id").distinct()
    truth = actual.select("user_id", "movie_id")
    hits = listed.join(truth.distinct(), ["user_id", "movie_id"], "left_semi").groupBy("user_id").agg(F.count("*").alias("hits"))
    users = truth.groupBy("user_id").agg(F.count("*").alias("n"))
    per_user = users.join(hits, "user_id", "left").select(
        "user_id", (F.coalesce("hits", F.lit(0)) / F.lit(k)).alias("precision"),
        (F.coalesce("hits", F.lit(0)) / F.col("n")).alias("recall"),
    )
    return mean_metrics(per_user)
