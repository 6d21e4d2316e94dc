"""Scalar text functions as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\r\n"


def bound(value: Column | str, f) -> Column:
    """f of a value that is computed once, however often f reads it and wherever the optimizer moves it to."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def trim_blanks(x: Column | str) -> Column:
    """Without spaces, tabs and line ends around it (trim() alone takes only spaces)."""
    return F.btrim(F.col(x) if isinstance(x, str) else x, F.lit(BLANKS))


def first_year(x: Column | str) -> Column:
    """First free-standing year 1900-2099 as an int; null if there is none."""
    found = F.regexp_extract(x, r"(?<![\p{L}\p{N}_])((?:19|20)[0-9]{2})(?![\p{L}\p{N}_])", 1)
    return F.when(found != "", found).try_cast("int")


def hangul_ratio(x: Column | str) -> Column:
    """Hangul syllables over the characters that are not white space; null for none."""
    solid = F.length(F.regexp_replace(x, r"\s", ""))
    return F.length(F.regexp_replace(x, "[^가-힣]", "")) / F.when(solid > 0, solid)


def has_hangul(x: Column | str) -> Column:
    return F.regexp_like(x, F.lit("[가-힣ㄱ-ㅎㅏ-ㅣ]"))


def has_latin(x: Column | str) -> Column:
    return F.regexp_like(x, F.lit("[a-zA-Z]"))


def has_digit(x: Column | str) -> Column:
    return F.regexp_like(x, F.lit("[0-9]"))


def clean_text(x: Column | str) -> Column:
    """Hangul, letters, digits and single spaces."""
    kept = F.regexp_replace(x, "[^가-힣a-zA-Z0-9 ]", " ")
    return F.btrim(F.regexp_replace(kept, " +", " "))


def year_span(x: Column | str) -> Column:
    """'a-b' for the least and greatest of at least two 4-digit numbers, else ''."""
    years = F.regexp_extract_all(x, F.lit(r"[0-9]{4}"), F.lit(0))
    return F.when(F.size(years) >= 2, F.concat(F.array_min(years), F.lit("-"), F.array_max(years))).otherwise(F.lit(""))


def strip_spaces(x: Column | str) -> Column:
    return F.regexp_replace(x, r"\s+", "")


def hash_id(*parts: Column) -> Column:
    """doc%08d of the md5 of the non-null parts, joined by |, in lower case and without white space; null if all are null."""
    joined = F.regexp_replace(F.lower(F.concat_ws("|", *parts)), r"(?U)\s+", "")
    number = F.pmod(F.conv(F.substring(F.md5(joined), 1, 8), 16, 10).cast("long"), F.lit(100_000_000))
    return F.when(F.coalesce(*parts).isNotNull(), F.concat(F.lit("doc"), F.lpad(number.cast("string"), 8, "0")))
