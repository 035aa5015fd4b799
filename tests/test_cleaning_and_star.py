"""Examples of the cleaning, star and check behaviour on small hand-written tables."""

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import rows
from marquee import schemas
from marquee.functions import lists, spread
from marquee.operators import checks, cleaning, star
from marquee.plans import jobs
from marquee.sources import io
from marquee.sources.derived import catalog


@pytest.fixture
def quoted(spark):
    return spark.createDataFrame([('"Inception"', 'A "mind" bending movie')], "title string, overview string")


@pytest.mark.parametrize("columns, want", [
    (["title"], ("Inception", 'A "mind" bending movie')),
    (["title", "overview"], ("Inception", "A mind bending movie")),
    (["absent"], ('"Inception"', 'A "mind" bending movie')),
    (None, ('"Inception"', 'A "mind" bending movie')),
])
def test_strip_quotes(quoted, columns, want):
    assert rows(cleaning.strip_double_quotes(quoted, columns)) == [want]


@pytest.mark.parametrize("text", ["Action, Comedy", "Action , Comedy , Action", "Action,Comedy,"])
def test_dimension(spark, text):
    df = spark.createDataFrame([(1, text)], "id bigint, genres string")
    assert {r["value"] for r in star.dimension_from_list(df, "genres").collect()} == {"Action", "Comedy"}


def test_dimension_strict_keeps_the_empty_value(spark):
    df = spark.createDataFrame([(1, "Action,Comedy,")], "id bigint, genres string")
    got = {r["value"] for r in star.dimension_from_list(df, "genres", strict_reference=True).collect()}
    assert got == {"Action", "Comedy", ""}


def test_bridge(spark):
    df = spark.createDataFrame([(1, "Action, Comedy")], "id bigint, genres string")
    dim = spark.createDataFrame([(10, "Action"), (20, "Comedy")], "genre_id bigint, genre string")
    for size in (0, 100):  # salted and broadcast look-up
        got = star.bridge_from_list(df, dim, "id", "genres", "genre", "genre_id", broadcast_rows=size)
        assert rows(got, "movie_id", "genre_id") == [(1, 10), (1, 20)]


def test_bridge_repeats_and_strict_splitter(spark):
    df = spark.createDataFrame([(1, "a, a, b"), (2, "a,b, c")], "id bigint, l string")
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "d bigint, v string")
    got = star.bridge_from_list(df, dim, "id", "l", "v", "d")
    assert rows(got, "movie_id", "d") == [(1, 1), (1, 1), (1, 2), (2, 1), (2, 2), (2, 3)]
    assert sorted(r["bridge_id"] for r in got.collect()) == [1, 2, 3, 4, 5, 6]
    strict = star.bridge_from_list(df, dim, "id", "l", "v", "d", strict_reference=True)
    assert rows(strict, "movie_id", "d") == [(1, 1), (1, 1), (1, 2), (2, 3)]


def test_bridge_numbers_masses_of_repeats(spark, monkeypatch):
    monkeypatch.setattr(star, "_REPEAT_STEP", 7)
    df = spark.createDataFrame([(1, ", ".join(["a"] * 50))], "id bigint, l string")
    dim = spark.createDataFrame([(1, "a")], "d bigint, v string")
    got = star.bridge_from_list(df, dim, "id", "l", "v", "d")
    assert sorted(r["bridge_id"] for r in got.collect()) == list(range(1, 51))


def test_bridge_of_crowded_keys_is_the_same(spark, monkeypatch):
    """Keys of many rows, a null one too: pairs that are counted first get the numbers of pairs that are not."""
    data = [(None if i % 3 == 0 else i % 4, "a, b , a,, c" if i % 2 else "b,c") for i in range(40)] + [(9, None), (9, "")]
    df = spark.createDataFrame(data, "id bigint, l string")
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "d bigint, v string")
    whole = rows(star.bridge_from_list(df, dim, "id", "l", "v", "d"), "bridge_id", "movie_id", "d")
    assert [r[0] for r in whole] == list(range(1, len(whole) + 1))
    assert len(whole) == sum(len([w for w in (l or "").split(",") if w.strip()]) for _, l in data)
    monkeypatch.setattr(star, "_REPEAT_STEP", 3)
    assert rows(star.bridge_from_list(df, dim, "id", "l", "v", "d"), "bridge_id", "movie_id", "d") == whole


def test_pairs_of_a_bridge_move_once(spark, monkeypatch):
    """They are put in order as they come, without a shuffle to count repeats, and written once."""
    kept = []
    monkeypatch.setattr(spread, "keep", lambda df, label: kept.append((label, df)) or df)
    df = spark.range(50).select("id", F.concat_ws(", ", F.lit("a"), F.col("id").cast("string")).alias("l"))
    dim = star.dimension_from_list(df, "l", id_col="d", value_col="v").localCheckpoint()
    star.bridge_from_list(df, dim, "id", "l", "v", "d", broadcast_rows=100)
    (label, pairs), = kept
    text = pairs._jdf.queryExecution().executedPlan().toString()
    assert label == "numbered" and text.count("Exchange hashpartitioning") == 1 and "HashAggregate" not in text


def test_catalog_moves_lines_by_part_only(spark):
    """Sets of suppliers are collected as the lines are read: no shuffle by pairs ahead of them."""
    df = catalog(spark, "/root/testdata/sf0.001")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert not [e for e in text.split("Exchange hashpartitioning(")[1:] if "l_suppkey" in e.split("REQUIREMENTS")[0].split(",")[1]]
    assert text.count("Exchange hashpartitioning(l_partkey") == 2


def test_values_named_in_place_are_not_made_distinct_first(spark):
    """Repeated pairs, a number without a name and two numbers of one name."""
    bridge = spark.createDataFrame([(1, 1), (1, 1), (1, 3), (1, 2), (2, 9), (None, 2), (None, 2)], "movie_id bigint, d bigint")
    dim = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b")], "d bigint, v string")
    got = star.values_per_movie(bridge, dim, "d", "v", "vs")
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "a, b"), (None, "a")]
    assert " HashAggregate" not in got._jdf.queryExecution().executedPlan().toString().replace("- HashAggregate", " HashAggregate")


def test_transform_job_makes_each_bridge_once(spark, tmp_path, monkeypatch):
    made, bridge_for = [], star.bridge_for
    monkeypatch.setattr(star, "bridge_for", lambda df, dim, spec, **how: made.append(spec.bridge) or bridge_for(df, dim, spec, **how))
    lists_of = {d.source: "a, b" for d in schemas.LIST_DIMENSIONS}
    movie = {c: "1" for c in star.DIM_MOVIE_COLUMNS + star.FACT_MOVIE_COLUMNS} | {"release_date": "2000-01-01", "adult": "true"} | lists_of
    spark.createDataFrame([movie]).withColumn("id", F.lit(1)).write.parquet(f"{tmp_path}/clean")
    counts = jobs.transform_job(spark, f"{tmp_path}/clean", f"{tmp_path}/star")
    assert len(counts) == 12 and all(counts[f"bridge_{d.source}"] == 2 for d in schemas.LIST_DIMENSIONS)
    assert sorted(made) == sorted(d.bridge for d in schemas.LIST_DIMENSIONS)


def test_whitelist_drops_the_whole_row(spark):
    df = spark.createDataFrame([(1, "Drama, War"), (2, "Drama, Nope"), (3, ""), (4, "War, War")], "id int, genres string")
    assert rows(cleaning.keep_whitelisted(df, "genres", ["Drama", "War"]), "id") == [(1,), (4,)]


def test_both_normalizers_agree(spark):
    df = spark.createDataFrame([(1, "USA, France , USA"), (2, "Atlantis"), (3, None)], "id int, c string")
    ref = spark.createDataFrame([("usa",), ("france",)], "country_name string")
    a = cleaning.normalize_by_reference(df, "c", ref, "country_name")
    b = cleaning.normalize_by_large_reference(df, "id", "c", ref, "country_name")
    assert rows(a) == rows(b) == [(1, "france, usa, usa")]
    assert rows(cleaning.normalize_list(df, "id", "c", ref, "country_name")) == rows(a)


def test_normalizers_agree_on_awkward_keys(spark):
    df = spark.createDataFrame([(None, "usa"), (7, "usa"), (7, "france, Usa"), (7, "usa"), (8, "nowhere")], "id bigint, c string")
    for extra in (0, cleaning.SHORT_LIST + 5):
        ref = spark.createDataFrame([("usa",), ("france",), *[(f"c{i}",) for i in range(extra)]], "country_name string")
        assert rows(cleaning.normalize_list(df, "id", "c", ref, "country_name")) == [(7, "france, usa"), (7, "usa"), (7, "usa")]


def test_dedup_is_deterministic_and_null_safe(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (None, "z"), (None, "y")], "id int, t string")
    got = {tuple(r) for r in cleaning.dedup_by_key(df.repartition(5), ["id"]).collect()}
    assert got == {(1, "a"), (None, "y")}


@pytest.mark.parametrize("text, want", [
    (None, []), ("a, b", ["a", "b"]), ("['a', 'b c']", ["a", "b c"]), ('["a"]', ["a"]), ("1917", ["1917"]), ("[broken", ["[broken"]),
])
def test_parse_list_or_literal(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(lists.parse_list_or_literal("t")).first()[0] == want


def test_squash(spark):
    df = spark.createDataFrame([(["Science Fiction", "War"],)], "a array<string>")
    assert df.select(lists.squash("a")).first()[0] == ["sciencefiction", "war"]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet="ab ,", max_size=12), min_size=1, max_size=8))
def test_split_list_never_gives_blank_elements(spark, texts):
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", lists.split_list("t").alias("l")).collect()
    for r in got:
        assert r["l"] == [p.strip(" ") for p in r["t"].split(",") if p.strip(" ")]


def test_lemmatize_keeps_word_order(spark):
    df = spark.createDataFrame([(1, "mice and men and mice"), (2, "")], "id int, t string")
    dictionary = spark.createDataFrame([("mice", "mouse"), ("men", "man")], "word string, lemma string")
    assert rows(cleaning.lemmatize(df, "id", "t", dictionary)) == [(1, "mouse and man and mouse"), (2, "")]


def test_lemmatize_shuffles_words_once_with_a_small_dictionary(spark, monkeypatch):
    df = spark.createDataFrame([(1, "b mice a mice"), (1, "men"), (2, None), (None, "mice")], "id int, t string")
    dictionary = spark.createDataFrame([("mice", "mouse"), ("men", "man"), ("men", "human")], "word string, lemma string")
    small = cleaning.lemmatize(df, "id", "t", dictionary)
    text = small._jdf.queryExecution().executedPlan().toString()
    assert "_salt" not in text and text.count("hashpartitioning(id") <= 2
    monkeypatch.setattr(cleaning, "fits_broadcast", lambda df: False)
    large = cleaning.lemmatize(df, "id", "t", dictionary)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(small) == key(large)


def test_a_long_reference_list_is_refused_in_place(spark):
    df = spark.createDataFrame([(1, "usa")], "id int, c string")
    long = spark.range(cleaning.SHORT_LIST + 1).select(F.col("id").cast("string").alias("country_name"))
    with pytest.raises(ValueError, match="normalize_by_large_reference"):
        cleaning.normalize_by_reference(df, "c", long, "country_name")


def test_row_checks_of_an_export_share_one_scan(spark, tmp_path):
    cols = schemas.SHORT_EXPORT_COLUMNS
    spark.createDataFrame([(1, "A", None, " ", "x�"), (1, "B", "g", "k", "")], "movie_id int, title string, genres string, keywords string, overview string"
                          ).write.parquet(str(tmp_path / "e"))
    reports = checks.export_checks(spark.read.parquet(str(tmp_path / "e")), cols)
    scans = [r._jdf.queryExecution().optimizedPlan().toString().count("parquet") for r in reports]
    assert sorted(scans) == [0, 0, 1, 1]
    found = {tuple(x) for r in reports for x in r.filter("violations > 0").collect()}
    assert found == {("unique", "movie_id", 2), ("null", "genres", 1), ("blank", "overview", 1), ("replacement_char", "overview", 1)}


def test_primary_key_counts_repeats_and_nulls(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,), (None,)], "k int")
    assert rows(checks.check_primary_key(df, "k", "t.k")) == [("key_null", "t.k", 3), ("unique", "t.k", 5)]
    assert rows(checks.check_primary_key(df.limit(0), "k")) == [("key_null", "k", 0), ("unique", "k", 0)]


def test_checks_pass_and_fail(spark):
    cols = schemas.SHORT_EXPORT_COLUMNS
    good = spark.createDataFrame([(1, "A", "g", "k", "o"), (2, "B", "g", "k", "p")], "movie_id int, title string, genres string, keywords string, overview string")
    assert checks.run_checks(checks.export_checks(good, cols)) == []
    null = good.withColumn("genres", F.when(F.col("movie_id") == 1, F.col("genres")))
    assert checks.run_checks(checks.export_checks(null, cols)) == [("null", "genres", 1)]
    with pytest.raises(checks.CheckFailed, match="null"):
        checks.run_checks(checks.export_checks(null, cols), strict=True)
    for broken, name in [
        (good.select(*reversed(cols)), "columns"),
        (good.withColumn("movie_id", F.col("movie_id").cast("string")), "type"),
        (good.withColumn("movie_id", F.lit(1)), "unique"),
        (good.withColumn("title", F.lit(" \n")), "blank"),
        (good.withColumn("overview", F.lit("x�")), "replacement_char"),
    ]:
        with pytest.raises(checks.CheckFailed, match=name):
            checks.run_checks(checks.export_checks(broken, cols))


def _raw(spark, tmp_path):
    header = schemas.RAW_COLUMNS
    base = dict.fromkeys(header, "x") | {
        "vote_average": "7.5", "vote_count": "10", "status": "Released", "release_date": "2000-01-02", "revenue": "2923706026",
        "runtime": "100", "adult": "False", "budget": "5", "popularity": "1.5", "genres": "Drama, War",
        "production_countries": "France, Atlantis", "production_companies": "Acme, Beta", "spoken_languages": "French",
    }
    movies = [
        base | {"id": "1", "title": 'The "Big"\nOne', "keywords": "k1, k2"},
        base | {"id": "2", "title": "Bad genre", "genres": "Drama, Nope"},
        base | {"id": "3", "title": "Future", "release_date": "2031-01-01"},
        base | {"id": "4", "title": "Planned", "status": "Planned"},
        base | {"id": "5", "title": "No country", "production_countries": "Atlantis"},
        base | {"id": "6", "title": "Negative", "runtime": "-1"},
        base | {"id": "7", "title": "Bad number", "revenue": "abc", "budget": ""},
        base | {"id": "7", "title": "Zz second copy"},
    ]
    df = spark.createDataFrame([tuple(m[c] for c in header) for m in movies], schemas.RAW_CATALOG)
    io.write_csv(df, f"{tmp_path}/raw")
    io.write_csv(spark.createDataFrame([("france",), ("japan",)], "country_name string"), f"{tmp_path}/iso")
    return f"{tmp_path}/raw", f"{tmp_path}/iso"


def test_whole_run_from_csv_to_tables(spark, tmp_path):
    raw, iso = _raw(spark, tmp_path)
    jobs.clean_job(spark, raw, iso, f"{tmp_path}/clean", single_file=True)
    clean = spark.read.parquet(f"{tmp_path}/clean")
    assert clean.columns[0] == "id" and clean.columns[-1] == "production_countries" and len(clean.columns) == 18
    got = {r["id"]: r for r in clean.collect()}
    assert set(got) == {1, 7}
    assert got[1]["title"] == "The Big\nOne" and got[1]["revenue"] == 2923706026 and got[1]["production_countries"] == "france"
    assert got[7]["title"] == "Bad number" and got[7]["revenue"] == 0 and got[7]["budget"] == 0

    counts = jobs.transform_job(spark, f"{tmp_path}/clean", f"{tmp_path}/star")
    assert len(counts) == 12 and counts["dim_movie"] == 2 and counts["bridge_production_companies"] == 4
    spark.sql("CREATE DATABASE IF NOT EXISTS film")
    samples = jobs.load_job(spark, f"{tmp_path}/star", "film")
    assert list(samples)[0] == "dim_movie" and list(samples)[-1] == "fact_movie"

    tables = jobs.star_from_database(spark, "film")
    assert checks.run_checks([checks.check_star(tables)]) == []
    assert jobs.export_job(spark, tables, f"{tmp_path}/export", f"{tmp_path}/merged") == []
    merged = spark.read.parquet(f"{tmp_path}/merged")
    assert merged.columns == schemas.ENRICHED_COLUMNS
    assert {r["movie_id"]: r["companies"] for r in merged.collect()} == {1: "Acme, Beta", 7: "Acme, Beta"}
    for name, schema in schemas.STAR_SCHEMAS.items():
        assert [(f.name, f.dataType) for f in tables[name].schema.fields] == [(f.name, f.dataType) for f in schema.fields]


def test_missing_inputs_raise(spark, tmp_path):
    with pytest.raises(io.MissingInput):
        io.require_path(spark, f"{tmp_path}/nothing")
    (tmp_path / "empty").mkdir()
    with pytest.raises(io.MissingInput, match="No Parquet files found"):
        io.load_folder(spark, f"{tmp_path}/empty", "t")
    with pytest.raises(io.MissingInput):
        io.merge_shards(spark, f"{tmp_path}/empty/*.parquet", f"{tmp_path}/out")
    with pytest.raises(checks.CheckFailed):
        checks.check_table(spark, "no_such_table")


def test_append_and_inline_rows(spark):
    df = io.inline_rows(spark, [(88, 0.0)], "movie_id bigint, vote_average double")
    io.append_table(df, "votes")
    io.append_table(df, "votes")
    assert io.read_table(spark, "votes").count() == 2
    assert io.inline_lines(spark, ["a b", "a"]).count() == 2


def test_merged_files_follow_the_size(spark, tmp_path):
    spark.range(20_000).repartition(8).write.parquet(f"{tmp_path}/shards")
    pattern = f"{tmp_path}/shards/*.parquet"
    for file_bytes, files in ((io.MERGED_BYTES, 1), (None, 1), (io.bytes_below(spark, pattern) // 3, 4)):
        io.merge_shards(spark, pattern, f"{tmp_path}/merged", file_bytes=file_bytes)
        merged = spark.read.parquet(f"{tmp_path}/merged")
        assert len(merged.inputFiles()) == files and merged.distinct().count() == 20_000


def test_shards_of_a_large_export_are_divided(spark, tmp_path, monkeypatch):
    spark.range(40_000).repartition(2).write.parquet(f"{tmp_path}/in")
    df = spark.read.parquet(f"{tmp_path}/in")
    for shard_bytes, shards in ((io.SHARD_BYTES, 4), (-(-io.bytes_below(spark, f"{tmp_path}/in/*.parquet") // 10), 10)):
        monkeypatch.setattr(io, "SHARD_BYTES", shard_bytes)
        io.export_shards(df, f"{tmp_path}/out", shards=4)
        out = spark.read.parquet(f"{tmp_path}/out")
        assert len(out.inputFiles()) == shards and out.distinct().count() == 40_000


def test_merged_files_are_even(spark, tmp_path):
    """Shards of one row group are read in several splits, of which one holds all rows."""
    spark.range(40_000).repartition(4).write.parquet(f"{tmp_path}/shards")
    pattern = f"{tmp_path}/shards/*.parquet"
    size = io.bytes_below(spark, pattern)
    settings = {"spark.sql.files.maxPartitionBytes": str(size // 8 + 500), "spark.sql.files.openCostInBytes": "1"}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        io.merge_shards(spark, pattern, f"{tmp_path}/merged", file_bytes=size // 2 + 1)
    finally:
        for key in settings:
            spark.conf.unset(key)
    merged = spark.read.parquet(f"{tmp_path}/merged")
    assert merged.distinct().count() == 40_000
    assert sorted(r[0] for r in merged.groupBy(F.input_file_name()).count().select("count").collect()) == [20_000, 20_000]
