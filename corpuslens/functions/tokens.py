"""Boilerplate removal and the two tokenisers.

The tokenisers disagree on purpose: word count deletes foreign characters
(``well-known`` is one word, ``don't`` stays whole), similarity splits at them.
"""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.functions import patterns as P


def _ignoring_case(marker: str) -> str:
    return "(?i)" + re.escape(marker)


def _first_marker(text: Column, markers: tuple[str, ...]) -> Column:
    """Position of the first marker *of the list* that occurs; null if none does."""
    found = F.array(*[F.regexp_instr(text, F.lit(_ignoring_case(m))) for m in markers])
    return F.get(F.filter(found, lambda position: position > 0), F.lit(0))


def strip_boilerplate(books: DataFrame, text: str = "text") -> DataFrame:
    """Cut the header through the start-marker line and the footer from its marker.

    One cheap test spares unmarked texts the ten marker searches. Each step is a
    column of its own, so that no search is evaluated twice.
    """
    marked = F.col("_marked")
    return (
        books.withColumn("_marked", F.col(text).rlike(_ignoring_case(P.EVERY_MARKER_HOLDS)))
        .withColumn("_start", F.when(marked, _first_marker(F.col(text), P.START_MARKERS)))
        .withColumn("_eol", F.position(F.lit("\n"), F.col(text), F.col("_start")))
        .withColumn(
            "_body",
            F.when(F.col("_eol") > 0, F.substr(F.col(text), F.col("_eol") + 1)).otherwise(
                F.col(text)
            ),
        )
        .withColumn("_end", F.when(marked, _first_marker(F.col("_body"), P.END_MARKERS)))
        .withColumn(
            text,
            F.when(
                F.col("_end").isNotNull(),
                F.substr(F.col("_body"), F.lit(1), F.col("_end") - 1),
            ).otherwise(F.col("_body")),
        )
        .drop("_marked", "_start", "_eol", "_body", "_end")
    )


def long_words(text: Column) -> Column:
    """Lower-case letter runs longer than two."""
    return F.regexp_extract_all(F.lower(text), F.lit(P.CONTENT_WORD), F.lit(0))


def content_words(text: Column) -> Column:
    """Words for similarity: ``long_words`` without the stop words."""
    return F.filter(long_words(text), lambda word: ~word.isin(*P.STOP_WORDS))


def counted_words(text: Column) -> Column:
    """Words for word count, still with the apostrophes around them."""
    kept = F.lower(F.regexp_replace(text, P.NOT_IN_WORDS, ""))
    return F.split(kept, P.WORD_GAP)


def trim_apostrophes(word: Column) -> Column:
    return F.btrim(word, F.lit("'"))


def settled(rows: DataFrame) -> DataFrame:
    """``rows``, with every column computed before any filter that follows.

    Spark pushes a filter below the projection that computes its column and copies the
    expression into it, so that every text is searched twice. It does not push below the
    one-element array that is unpacked here.
    """
    columns = [F.col(f"`{c}`") for c in rows.columns]
    return rows.select(F.inline_outer(F.array(F.struct(*columns))))


def word_rows(rows: DataFrame, words: str) -> DataFrame:
    """One row per element of the array column ``words``, named ``word``.

    A plain ``explode`` makes Spark test the array's size first, and that test is
    pushed below to the scan where it tokenises every text once more; the outer form
    with the null check after it computes the array once.
    """
    others = [F.col(c) for c in rows.columns if c != words]
    return rows.select(*others, F.explode_outer(words).alias("word")).filter(
        F.col("word").isNotNull()
    )
