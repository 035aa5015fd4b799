"""Columns that hold several values in one delimited string, and the texts built from them."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_list(c: str | Column, delimiter: str = ",", keep_empty: bool = False) -> Column:
    """Trimmed elements of a delimited string; null stays null, empty elements are dropped."""
    parts = F.transform(F.split(_col(c), re.escape(delimiter)), lambda x: F.trim(x))
    return parts if keep_empty else F.filter(parts, lambda x: x != "")


def split_spaced(c: str | Column, delimiter: str = ", ") -> Column:
    """The literal splitter bridges used to have: 'a,b, c' gives ['a,b', 'c']."""
    return F.transform(F.split(_col(c), re.escape(delimiter)), lambda x: F.trim(x))


def parse_list(c: str | Column) -> Column:
    """As split_list, but null gives an empty array and empty elements are kept."""
    return F.when(_col(c).isNull(), F.array().cast("array<string>")).otherwise(
        split_list(c, keep_empty=True)
    )


def parse_list_or_literal(c: str | Column) -> Column:
    """Text that is either a bracketed list literal or a comma-separated list.

    Both quote styles of a literal are read; text such as '1917' stays text. A bracketed text that
    is not a list of strings is read as a plain comma-separated list.
    """
    text = _col(c)
    as_literal = F.from_json(F.trim(text), "array<string>", {"allowSingleQuotes": "true"})
    plain = F.transform(F.split(text, ","), lambda x: F.trim(x))
    return (
        F.when(text.isNull(), F.array().cast("array<string>"))
        .when(text.rlike(r"^\s*\["), F.coalesce(as_literal, plain))
        .otherwise(plain)
    )


def squash(c: str | Column) -> Column:
    """Lower-case every element and delete the blanks inside it: 'Science Fiction' -> 'sciencefiction'."""
    return F.transform(_col(c), lambda x: F.lower(F.replace(x, F.lit(" "), F.lit(""))))


def join_list(c: str | Column, delimiter: str = " ") -> Column:
    return F.array_join(_col(c), delimiter)


def strip_quotes(c: str | Column) -> Column:
    return F.replace(_col(c), F.lit('"'), F.lit(""))


def keep_listed(c: str | Column, allowed: Column) -> Column:
    """Elements of the array column that occur in `allowed`, in place, duplicates kept."""
    return F.filter(_col(c), lambda x: F.array_contains(allowed, x))


def all_listed(c: str | Column, allowed: list[str]) -> Column:
    """True if every element of the delimited string is allowed; the empty string is not."""
    whitelist = F.array(*[F.lit(v) for v in allowed])
    return F.size(F.array_except(split_list(c, keep_empty=True), whitelist)) == 0


def remove_words(c: str | Column, stop_words: list[str]) -> Column:
    """Drop listed words, compared in lower case; the kept words keep their case."""
    stops = F.array(*[F.lit(w) for w in stop_words])
    words = F.filter(F.split(_col(c), r"\s+"), lambda w: w != "")
    return F.array_join(F.filter(words, lambda w: ~F.array_contains(stops, F.lower(w))), " ")


def tokens(c: str | Column) -> Column:
    """Lower-case word tokens of at least two letters, digits or underscores."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))


def item_text(title: str | Column, overview: str | Column, genres: str | Column) -> Column:
    return F.concat(
        _col(title), F.lit(". "), F.coalesce(_col(overview), F.lit("")),
        F.lit(" Genres: "), F.coalesce(_col(genres), F.lit("")),
    )


def title_of_text(c: str | Column) -> Column:
    return F.substring_index(_col(c), ".", 1)


def genres_of_text(c: str | Column) -> Column:
    return F.substring_index(_col(c), "Genres: ", -1)


def profile_text(columns: list[str], prefix: str = "Last_genres") -> Column:
    """User text: every column with the prefix, joined in column order, nulls skipped."""
    return F.concat_ws(", ", *[F.col(c) for c in columns if c.startswith(prefix)])


def file_extension(c: str | Column) -> Column:
    """Text after the last dot when it is all letters and digits, else null."""
    return F.nullif(F.regexp_extract(_col(c), r"\.([a-zA-Z0-9]+)$", 1), F.lit(""))


def url_scheme(c: str | Column) -> Column:
    """Scheme with its slashes, case kept, else null."""
    return F.nullif(
        F.regexp_extract(_col(c), r"^([a-zA-Z][a-zA-Z0-9+.-]*:/{0,2})", 1), F.lit("")
    )


def is_bad_date(c: str | Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.try_to_timestamp(_col(c).cast("string"), F.lit(pattern)).isNull()


def distance_score(d: str | Column) -> Column:
    return F.round(1 / (1 + _col(d)), 4)
