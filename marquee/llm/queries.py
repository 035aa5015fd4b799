"""The registered query of each operator, over whole tables with production parameters.

CHECKS holds SQL where SQL can express a query's rows (repeated passages, near-duplicate sets, the Merkle manifest,
centroid clustering). It can't where they rest on 64-bit hashes, trained models or tokenizers; those queries are held
against brute-force versions in tests/llm.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.llm import (centroids, fingerprints, merkle, minmax, mixing, packing, quality_classifier, quality_rules, secrets,
                         sharding, simhash, suffix_dedup, url_filter)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def simhash_components(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def quality_rule_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    trusted = quality_rules.trusted_ids(_table(spark, folder, "labels"))
    return quality_rules.judge(_table(spark, folder, "documents"), trusted).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.score(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def secret_spans(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(_table(spark, folder, "documents"))

    def number(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", number("assign"), number("access"), number("hex"),
                        F.sha2(secrets.as_text(F.col("base")), 256).alias("base_sha256"),
                        secrets.as_text(F.col("spans")).alias("spans"))


def packed_sequences(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_table(spark, folder, "documents"))


def jump_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard(_table(spark, folder, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, folder, "pages"))


def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


def repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    found = fingerprints.compare_with_edits(_table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("sketch")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_sketch")).alias("edited_fingerprint"), "near_edited", "near_next",
        fingerprints.distinct_shingles(F.col("sketch")).alias("n_shingles"),
        fingerprints.containment(F.col("sketch"), F.col("edited_sketch")).alias("kept_share"))


def minmax_components(spark: SparkSession, folder: str) -> DataFrame:
    return minmax.near_duplicates(_table(spark, folder, "documents"))


def merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(_table(spark, folder, "documents"))


def centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    found = centroids.cluster_vectors(_table(spark, folder, "embeddings"))
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ",").cast("binary"), 256)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_components": simhash_components,
    "op2_quality_rules": quality_rule_verdicts,
    "op3_quality_classifier": quality_scores,
    "op4_secret_scan": secret_spans,
    "op5_best_fit_packing": packed_sequences,
    "op6_jump_sharding": jump_shards,
    "op7_url_filter": url_verdicts,
    "op8_source_mixing": source_mix,
    "op9_suffix_dedup": repeated_passages,
    "op10_fingerprints": document_fingerprints,
    "op11_minmax_components": minmax_components,
    "op12_merkle_manifest": merkle_manifest,
    "op13_centroid_clusters": centroid_clusters,
    "pipeline": pipeline,
}

# Every 200-byte string of every text, as hexadecimal digits; texts are cut into overlapping parts because
# taking a substring counts from the start.
REPEATS_SQL = """WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents),
parts AS (
  SELECT rid, len(hx) // 2 AS n, 500 * c AS base, substr(hx, 1000 * c + 1, 1400) AS part
  FROM (SELECT rid, hx, unnest(range(0, len(hx) // 1000 + 1)) AS c FROM docs)),
starts AS (
  SELECT rid, base + i AS s, md5(substr(part, 2 * i + 1, 400)) AS h
  FROM (SELECT rid, base, part, unnest(range(0, greatest(0, least(500, n - 199 - base)))) AS i FROM parts)),
twice AS (SELECT h FROM starts GROUP BY h HAVING count(*) > 1),
hits AS (SELECT rid, s, lag(s) OVER (PARTITION BY rid ORDER BY s) AS p FROM starts WHERE h IN (SELECT h FROM twice)),
runs AS (
  SELECT rid, min(s) AS a, max(s) + 200 AS b
  FROM (SELECT rid, s, sum(CASE WHEN p IS NULL OR s > p + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY s) AS run FROM hits)
  GROUP BY rid, run),
gaps AS (
  SELECT rid, lag(b, 1, 0) OVER w AS a, a AS b FROM runs WINDOW w AS (PARTITION BY rid ORDER BY a)
  UNION ALL SELECT rid, max(b), 9223372036854775807 FROM runs GROUP BY rid),
kept AS (
  SELECT rid, string_agg(substr(hx, 2 * a + 1, CASE WHEN b > len(hx) THEN len(hx) ELSE 2 * (b - a) END), '' ORDER BY a) AS k
  FROM gaps JOIN docs USING (rid) GROUP BY rid),
cut AS (SELECT rid, sum(b - a) AS removed, count(*) AS n FROM runs GROUP BY rid)
SELECT doc_id, CAST(len(hx) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k, hx))) AS kept_sha256
FROM docs LEFT JOIN cut USING (rid) LEFT JOIN kept USING (rid)"""

# All pairs of sets that share a shingle, counted; rows without an id take no part in names.
NEAR_SQL = """WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
words AS (
  SELECT rid, unnest(range(len(w))) AS pos, unnest(w) AS word
  FROM (SELECT rid, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM docs WHERE text IS NOT NULL)),
pairs AS (
  SELECT rid, word || coalesce(' ' || lead(word) OVER (PARTITION BY rid ORDER BY pos), '') AS s,
         lead(word) OVER (PARTITION BY rid ORDER BY pos) IS NULL AND pos > 0 AS past
  FROM words),
sets AS (SELECT DISTINCT rid, s FROM pairs WHERE NOT past),
marks AS (SELECT rid, count(*) AS n, md5(string_agg(s, chr(10) ORDER BY s)) AS h FROM sets GROUP BY rid),
reps AS (SELECT h, min(rid) AS rep, any_value(n) AS n FROM marks GROUP BY h),
codes AS (SELECT s, row_number() OVER () AS c FROM (SELECT s FROM sets WHERE rid IN (SELECT rep FROM reps) GROUP BY s HAVING count(*) > 1)),
coded AS (SELECT rid, c, n FROM sets JOIN codes USING (s) JOIN reps ON rid = rep),
links AS (
  SELECT x.rid AS a, y.rid AS b FROM coded x JOIN coded y ON x.c = y.c AND x.rid < y.rid AND 5 * x.n >= 4 * y.n AND 5 * y.n >= 4 * x.n
  GROUP BY x.rid, y.rid HAVING 180 * count(*) >= 80 * (any_value(x.n) + any_value(y.n))),
steps AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links UNION ALL SELECT rep, rep FROM reps),
reach AS (
  WITH RECURSIVE r(a, b) AS (SELECT a, b FROM steps UNION SELECT r.a, steps.b FROM r JOIN steps ON r.b = steps.a)
  SELECT a, min(b) AS root FROM r GROUP BY a),
named AS (SELECT rid, root FROM marks JOIN reps USING (h) JOIN reach ON a = rep),
least AS (SELECT root, min(doc_id) AS component_id FROM named JOIN docs USING (rid) GROUP BY root)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles,
       CASE WHEN n IS NULL THEN doc_id ELSE component_id END AS component_id,
       n IS NULL OR doc_id IS NOT DISTINCT FROM component_id AS kept
FROM docs LEFT JOIN marks USING (rid) LEFT JOIN named USING (rid) LEFT JOIN least USING (root)"""


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _tree_sql(name: str, levels: int) -> str:
    """Levels of trees: {name}0 has (tree, place, digest); {name}{levels} has one row a tree, up to 16 ** levels leaves."""
    parts = []
    for k in range(levels):
        parts.append(f"""{name}{k}s AS (
  SELECT tree, place, digest, count(*) OVER (PARTITION BY tree) AS n,
         coalesce(string_agg(digest, '') OVER (PARTITION BY tree, place // 16 ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(digest, '') OVER (PARTITION BY tree, place // 16 ORDER BY place ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}{k}),
{name}{k + 1} AS (
  SELECT tree, place // 16 AS place,
         CASE WHEN any_value(n) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY place)) END AS digest
  FROM {name}{k}s GROUP BY tree, place // 16)""")
    return ",\n".join(parts)


def _fold_sql(rows: str, name: str, levels: int) -> str:
    """Rows (rid, tree, place, f, proof, ...) led through the levels of their tree."""
    parts = []
    for k in range(levels):
        before = rows if k == 0 else f"{rows}_{name}{k - 1}"
        parts.append(f"""{rows}_{name}{k} AS (
  SELECT w.rid, w.tree, w.place // 16 AS place, CASE WHEN n = 1 THEN f ELSE sha256(l || f || r) END AS f,
         CASE WHEN n = 1 THEN proof ELSE proof || l || r END AS proof
  FROM {before} w JOIN {name}{k}s t ON w.tree IS NOT DISTINCT FROM t.tree AND w.place = t.place)""")
    return ",\n".join(parts)


_FIELDS = [_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars")]
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# crc32 of the decimal id, bit by bit
_CRC_SQL = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
  lambda c: CAST(ascii(c) AS BIGINT))), lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [CAST(0 AS BIGINT) FOR z IN range(8)]),
  lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, CAST(3988292384 AS BIGINT)) ELSE v // 2 END)))"""
# Up to 16 ** 5 rows a source and 16 ** 2 sources.
MERKLE_SQL = f"""WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, source AS tree, sha256({' || '.join([*_FIELDS, _field_sql('text')])}) AS leaf,
         CASE WHEN {_CRC_SQL} % 5 = 0 THEN sha256({' || '.join([*_FIELDS, _field_sql(_LOWERED)])}) END AS tampered
  FROM documents),
s0 AS (SELECT tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS place, leaf AS digest, rid FROM docs),
{_tree_sql('s', 5)},
t0 AS (SELECT 'all' AS tree, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS place, digest, tree AS source FROM s5),
{_tree_sql('t', 2)},
up AS (SELECT rid, s0.tree, place, coalesce(tampered, leaf) AS f, '' AS proof FROM s0 JOIN docs USING (rid)),
{_fold_sql('up', 's', 5)},
over AS (SELECT rid, 'all' AS tree, t0.place, f, proof FROM up_s4 JOIN t0 ON up_s4.tree IS NOT DISTINCT FROM t0.source),
{_fold_sql('over', 't', 2)}
SELECT doc_id, leaf, s5.digest AS subroot, t2.digest AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = t2.digest AS verified
FROM docs JOIN over_t1 USING (rid) JOIN s5 ON docs.tree IS NOT DISTINCT FROM s5.tree CROSS JOIN t2"""


def _cluster_sql(k: int = 40, rounds: int = 5, width: int = 64) -> str:
    parts = [f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS cid, v AS c
  FROM (SELECT v, sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h FROM v ORDER BY h, v LIMIT {k}))"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
  SELECT rid, arg_min(cid, d * 1000 + cid) AS cid, min(d) AS d
  FROM (SELECT rid, cid, list_sum(list_transform(list_zip(v, c), lambda p: CAST((p[1] - p[2]) * (p[1] - p[2]) AS HUGEINT))) AS d FROM v CROSS JOIN c{r})
  GROUP BY rid)""")
        if r < rounds:
            parts.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT cid, coalesce(m, c) AS c FROM c{r} LEFT JOIN (
    SELECT cid, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS m
    FROM (SELECT cid, pos, sum(x) AS s, count(*) AS n
          FROM (SELECT cid, unnest(v) AS x, unnest(range({width})) AS pos FROM v JOIN a{r} USING (rid)) GROUP BY cid, pos) GROUP BY cid) USING (cid))""")
    return f"""WITH {', '.join(parts)}
SELECT vec_id, CAST(cid AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY cid) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (rid) JOIN c{rounds} USING (cid)"""


CHECKS: dict[str, str] = {
    "op9_suffix_dedup": REPEATS_SQL,
    "op11_minmax_components": NEAR_SQL,
    "op12_merkle_manifest": MERKLE_SQL,
    "op13_centroid_clusters": _cluster_sql(),
}
