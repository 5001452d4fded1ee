"""Header fields by ladders of forms: the usual one first, then the forms that books have instead.

A ladder is tried from the top, each form only where those above it find nothing, and each
text is searched once for it. The first form of a field is that of ``headers``, so a field
that has it keeps its value.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuslens.functions import patterns as P
from corpuslens.functions.headers import strip

_REST = rf"{P.SPACE}*(.+)"
_DATE = rf"{P.SPACE}*(.+?)(?:{P.SPACE}*\[|$)"

LADDERS = {
    "title": (
        ("label", P.TITLE),
        ("heading", r"(?dmU)^[^\n]*Project Gutenberg E(?:Book|book|Text|text) of[ \t]+(.+?)(?:,[ \t]+by[ \t].*)?$"),
    ),
    "release_date": (
        ("release", P.RELEASE_DATE),
        ("posting", P.POSTING_DATE),
        ("first posted", rf"(?dmU)^First [Pp]osted:{_DATE}"),
        ("last updated", rf"(?dmU)^(?:Last|Most recently) [Uu]pdated:{_DATE}"),
    ),
    "language": (
        ("label", P.LANGUAGE),
        ("written in", r"(?idmU)^(?:Written|Original) in:[ \t]*(.+)$"),
    ),
    "encoding": (
        ("label", P.ENCODING),
        ("short label", rf"(?idmU)^Encoding:{_REST}"),
        ("charset", r"(?idU)\bcharset=[\"']?([\w.:-]+)"),
    ),
}


def _matched(text: Column, form: str, pattern: str) -> Column:
    """``struct<form, value>``, or null where the pattern finds nothing. The match stands in an array
    of one, so that it is looked for once."""
    match = F.filter(F.array(F.regexp_substr(text, F.lit(pattern))), lambda m: m.isNotNull())
    found = F.transform(
        match,
        lambda m: F.struct(F.lit(form).alias("form"), strip(F.regexp_extract(m, pattern, 1)).alias("value")),
    )
    return F.get(found, F.lit(0))


def laddered(text: Column, field: str) -> Column:
    """``struct<form, value>`` of the first form of ``field`` that matches; null if none does."""
    return F.coalesce(*[_matched(text, form, pattern) for form, pattern in LADDERS[field]])
