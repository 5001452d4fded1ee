"""Bibliographic fields as native expressions over the whole text of a book.

``regexp_substr`` is null where nothing matches, which keeps "no match" (null)
apart from "matched, but blank" (empty string), and it bounds the second regex,
which picks the captured group, to the matched line instead of the book.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuslens.functions import patterns as P


def strip(value: Column) -> Column:
    """Remove white space of every kind, not only blanks, from both ends."""
    return F.regexp_replace(value, rf"(?U)\A{P.SPACE}+|{P.SPACE}+\z", "")


def _captured(text: Column, pattern: str) -> Column:
    match = F.regexp_substr(text, F.lit(pattern))
    return strip(F.regexp_extract(match, pattern, 1))


def title(text: Column) -> Column:
    return _captured(text, P.TITLE)


def language(text: Column) -> Column:
    return _captured(text, P.LANGUAGE)


def encoding(text: Column) -> Column:
    return _captured(text, P.ENCODING)


def release_date(text: Column) -> Column:
    """The raw date string of the first release line, else of the first posting line."""
    return F.coalesce(_captured(text, P.RELEASE_DATE), _captured(text, P.POSTING_DATE))


def release_year(date: Column) -> Column:
    """The first four digits in a row of a date string."""
    return F.regexp_extract(date, P.FOUR_DIGITS, 1).try_cast("int")


def author(text: Column) -> Column:
    """The author line without parentheses, else a capitalised name after "by"."""
    named = strip(F.regexp_replace(_captured(text, P.AUTHOR), P.PARENTHESES, ""))
    byline = strip(F.regexp_extract(F.substring(text, 1, P.BYLINE_CHARS), P.BYLINE, 1))
    byline = strip(F.rtrim(byline, F.lit(",")))
    return F.coalesce(
        F.regexp_substr(named, F.lit(P.NAMED_AUTHOR)),
        F.regexp_substr(byline, F.lit(P.BYLINE_AUTHOR)),
    )


def author_year(text: Column) -> Column:
    """Year of the first release line *that has one*, else of such a posting line.

    Not the year of ``release_date``: that looks at the first date line only.
    """
    return F.coalesce(
        F.regexp_extract(text, P.RELEASE_YEAR, 1).try_cast("int"),
        F.regexp_extract(text, P.POSTING_YEAR, 1).try_cast("int"),
    )
