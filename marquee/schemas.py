"""Declared schemas, keys and name maps of the catalog model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_S, _L, _I, _D, _B, _DATE = (
    T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType(), T.DateType()
)

# The 24 raw CSV columns in file order. Everything is read as text and cast with
# try_cast in the cleaning job, so that one bad cell never costs the row or the run.
RAW_COLUMNS = [
    "id", "title", "vote_average", "vote_count", "status", "release_date", "revenue", "runtime",
    "adult", "backdrop_path", "budget", "homepage", "imdb_id", "original_language",
    "original_title", "overview", "popularity", "poster_path", "tagline", "genres",
    "production_companies", "production_countries", "spoken_languages", "keywords",
]
RAW_CATALOG = _struct(*[(name, _S) for name in RAW_COLUMNS])
COUNTRY_LIST = _struct(("country_name", _S))

# Columns the cleaning job removes, requires, and casts.
UNUSED_COLUMNS = ["backdrop_path", "homepage", "imdb_id", "original_title", "poster_path", "tagline"]
REQUIRED_COLUMNS = [
    "title", "release_date", "adult", "original_language", "overview", "popularity", "genres",
    "production_companies", "production_countries", "spoken_languages", "keywords",
]
NUMERIC_TYPES = {
    "vote_average": _D, "vote_count": _L, "revenue": _L, "runtime": _I, "budget": _L,
    "popularity": _D,
}
QUOTED_COLUMNS = ["title", "overview", "keywords"]
EARLIEST_RELEASE = "1700-01-01"
LATEST_RELEASE = "2025-06-02"

# The genre whitelist.
GENRES = [
    "Crime", "Romance", "TV Movie", "Thriller", "Adventure", "Drama", "War", "Documentary", "Family",
    "Fantasy", "History", "Mystery", "Animation", "Music", "Science Fiction", "Horror", "Western", "Comedy", "Action",
]


@dataclass(frozen=True)
class ListDimension:
    """One multi-value column and the dimension and bridge that come from it."""

    source: str      # delimited column of the cleaned catalog
    dim: str         # dimension table
    bridge: str      # bridge table
    id_col: str
    value_col: str
    export_col: str  # column of the enriched row


LIST_DIMENSIONS = [
    ListDimension("genres", "dim_genre", "bridge_movie_genre", "genre_id", "genre_name", "genres"),
    ListDimension("keywords", "dim_keyword", "bridge_movie_keyword", "keyword_id", "keyword_name",
                  "keywords"),
    ListDimension("production_companies", "dim_production_company", "bridge_movie_company",
                  "company_id", "company_name", "companies"),
    ListDimension("spoken_languages", "dim_spoken_language", "bridge_movie_language",
                  "language_id", "language_name", "languages"),
    ListDimension("production_countries", "dim_production_country", "bridge_movie_country",
                  "country_id", "country_name", "countries"),
]

DIM_MOVIE_COLUMNS = ["title", "status", "release_date", "adult", "original_language", "overview"]
FACT_MOVIE_COLUMNS = ["vote_average", "popularity", "vote_count", "budget", "revenue", "runtime"]

STAR_SCHEMAS: dict[str, T.StructType] = {
    "dim_movie": _struct(("movie_id", _L), ("title", _S), ("status", _S), ("release_date", _DATE),
                         ("adult", _B), ("original_language", _S), ("overview", _S)),
    "fact_movie": _struct(("movie_id", _L), ("vote_average", _D), ("popularity", _D),
                          ("vote_count", _L), ("budget", _L), ("revenue", _L), ("runtime", _L)),
}
for _d in LIST_DIMENSIONS:
    STAR_SCHEMAS[_d.dim] = _struct((_d.id_col, _L), (_d.value_col, _S))
    STAR_SCHEMAS[_d.bridge] = _struct(("bridge_id", _L), ("movie_id", _L), (_d.id_col, _L))

PRIMARY_KEYS: dict[str, str] = {
    "dim_movie": "movie_id",
    **{d.dim: d.id_col for d in LIST_DIMENSIONS},
    **{d.bridge: "bridge_id" for d in LIST_DIMENSIONS},
    "fact_movie": "movie_id",
}
# child table, child column, parent table, parent column
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("fact_movie", "movie_id", "dim_movie", "movie_id"),
    *[(d.bridge, "movie_id", "dim_movie", "movie_id") for d in LIST_DIMENSIONS],
    *[(d.bridge, d.id_col, d.dim, d.id_col) for d in LIST_DIMENSIONS],
]

# Name of the folder the transform job writes (plural) -> warehouse table (singular), in load
# order: dimensions, then bridges, then the fact.
LOAD_ORDER: dict[str, str] = {
    "dim_movie": "dim_movie",
    "dim_keywords": "dim_keyword",
    "dim_production_companies": "dim_production_company",
    "dim_spoken_languages": "dim_spoken_language",
    "dim_production_countries": "dim_production_country",
    "dim_genres": "dim_genre",
    "bridge_keywords": "bridge_movie_keyword",
    "bridge_production_companies": "bridge_movie_company",
    "bridge_spoken_languages": "bridge_movie_language",
    "bridge_production_countries": "bridge_movie_country",
    "bridge_genres": "bridge_movie_genre",
    "fact_movie": "fact_movie",
}

ENRICHED_COLUMNS = [
    "movie_id", "status", "title", "adult", "overview", "original_language", "release_date",
    "vote_count", "vote_average", "popularity", "budget", "revenue", "runtime", "genres",
    "keywords", "companies", "languages", "countries",
]
SHORT_EXPORT_COLUMNS = ["movie_id", "title", "genres", "keywords", "overview"]
EXPORT_TEXT_COLUMNS = ["title", "genres", "keywords", "overview"]

# Which profile reports make sense for which column of the catalog.
COLUMN_KINDS: dict[str, str] = {
    **{c: "numeric" for c in
       ["vote_average", "vote_count", "revenue", "runtime", "budget", "popularity"]},
    **{c: "categorical" for c in
       ["status", "adult", "original_language", "genres", "production_companies",
        "production_countries", "spoken_languages", "keywords"]},
    **{c: "other" for c in
       ["id", "title", "release_date", "backdrop_path", "homepage", "imdb_id", "original_title",
        "overview", "poster_path", "tagline"]},
}
