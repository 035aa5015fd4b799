"""The batch jobs: clean, transform, load, export. Every failure is raised to the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee import schemas
from marquee.functions.spread import DIMENSION_ROWS
from marquee.operators import checks, cleaning, star
from marquee.session import passing_scratch
from marquee.sources import io


def clean_catalog(
    raw: DataFrame, country_list: DataFrame, genres: list[str] = schemas.GENRES,
    earliest: str = schemas.EARLIEST_RELEASE, latest: str = schemas.LATEST_RELEASE,
) -> DataFrame:
    """The 11 cleaning steps as one lazy plan with one shuffle (the deduplication).

    Ids are typed and required first, so '7' and '007' are one movie and a null or unreadable id is
    none. Deduplication stays ahead of the value filters, because the surviving row decides whether the
    movie is kept at all.
    """
    df = cleaning.drop_columns(raw, schemas.UNUSED_COLUMNS)
    df = cleaning.drop_null_rows(df, schemas.REQUIRED_COLUMNS)
    df = cleaning.cast_columns(df, {"id": schemas.T.LongType()})
    df = cleaning.drop_null_rows(df, ["id"])
    df = cleaning.dedup_by_key(df, ["id"])
    df = cleaning.cast_columns(df, {**schemas.NUMERIC_TYPES, "adult": schemas.T.BooleanType()})
    df = cleaning.parse_date(df, "release_date")
    df = cleaning.date_between(df, "release_date", earliest, latest)
    df = cleaning.fill_zero(df, list(schemas.NUMERIC_TYPES))
    df = cleaning.keep_nonnegative(df, list(schemas.NUMERIC_TYPES))
    df = cleaning.keep_equal(df, "status", "Released")
    df = cleaning.keep_whitelisted(df, "genres", genres)
    df = cleaning.strip_double_quotes(df, schemas.QUOTED_COLUMNS)
    df = cleaning.normalize_list(df, "id", "production_countries", country_list, "country_name")
    last = ["production_countries"]
    return df.select(*[c for c in df.columns if c not in last], *last)


def clean_job(spark: SparkSession, raw_path: str, country_path: str, out: str, single_file: bool = False) -> None:
    with passing_scratch(spark):
        raw = io.read_raw_catalog(spark, raw_path)
        countries = io.read_csv(spark, io.require_path(spark, country_path), schemas.COUNTRY_LIST)
        io.write_parquet(clean_catalog(raw, countries), out, single_file)


def transform_job(spark: SparkSession, clean_path: str, out: str) -> dict[str, int]:
    """Write the 12 star tables; returns rows per table.

    Dimensions are read back before the bridges use them: ids are fixed on disk, the write gives
    the size, and a small dimension is broadcast while a large one is joined with salt.
    """
    with passing_scratch(spark):
        cleaned = spark.read.parquet(io.require_path(spark, clean_path))
        counts = io.write_tables(star.tables_without_bridges(cleaned), out)
        for spec in schemas.LIST_DIMENSIONS:
            dim = spark.read.parquet(f"{out}/dim_{spec.source}")
            bridge = star.bridge_for(cleaned, dim, spec, broadcast_rows=DIMENSION_ROWS)
            counts |= io.write_tables([("bridge", spec.source, bridge)], out)
    return counts


def star_from_folder(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {table: spark.read.parquet(f"{folder}/{source}") for source, table in schemas.LOAD_ORDER.items()}


def star_from_database(spark: SparkSession, database: str = "default") -> dict[str, DataFrame]:
    return {table: spark.table(f"{database}.{table}") for table in schemas.LOAD_ORDER.values()}


def load_job(spark: SparkSession, folder: str, database: str = "default") -> dict[str, dict[str, str]]:
    """Load the star folders into tables and check that each exists and has rows."""
    return {
        table: checks.check_table(spark, f"{database}.{table}")
        for table in io.load_star(spark, folder, database)
    }


def export_job(
    spark: SparkSession, tables: dict[str, DataFrame], out: str, merged: str | None = None, strict: bool = False
) -> list[tuple[str, str, int]]:
    """Write the enriched view as shards, merge them if asked, and check what was written."""
    with passing_scratch(spark):
        io.export_shards(star.enriched_view(tables), out)
        if merged:
            io.merge_shards(spark, f"{out}/*.parquet", merged)
        written = spark.read.parquet(merged or out)
        return checks.run_checks(checks.export_checks(written), strict)
