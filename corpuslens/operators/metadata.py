"""Bibliographic metadata and its summaries."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.functions import headers as H
from corpuslens.functions.header_forms import LADDERS, laddered
from corpuslens.functions.tokens import settled


def metadata(books: DataFrame, key: str = "file_name") -> DataFrame:
    """One row per book; a summary evaluates only the fields it uses."""
    text = F.col("text")
    return books.select(
        key,
        H.title(text).alias("title"),
        H.release_date(text).alias("release_date"),
        H.language(text).alias("language"),
        H.encoding(text).alias("encoding"),
    ).withColumn("release_year", H.release_year(F.col("release_date")))


def metadata_by_form(books: DataFrame, key: str = "file_name") -> DataFrame:
    """One row per book: each field and the form it was found in (``header_forms.LADDERS``), null
    where no form matches."""
    text = F.col("text")
    found = books.select(key, *[laddered(text, field).alias(f"_{field}") for field in LADDERS])
    return settled(found).select(
        key,
        *[
            column
            for field in LADDERS
            for column in (F.col(f"_{field}.value").alias(field), F.col(f"_{field}.form").alias(f"{field}_form"))
        ],
    )


def form_counts(by_form: DataFrame) -> DataFrame:
    """``(field, form, n)``: how many books have a field in each form; form is null for those without."""
    forms = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"{f}_form").alias("form")) for f in LADDERS])
    rows = settled(by_form.select(forms.alias("forms"))).select(F.explode("forms").alias("f"))
    return rows.groupBy("f.field", "f.form").agg(F.count("*").alias("n"))


def books_per_year(meta: DataFrame) -> DataFrame:
    return (
        settled(meta.select("release_year"))
        .filter(F.col("release_year").isNotNull())
        .groupBy("release_year")
        .agg(F.count("*").alias("num_books"))
    )


def language_counts(meta: DataFrame) -> DataFrame:
    return (
        settled(meta.select("language"))
        .filter(F.col("language").isNotNull())
        .groupBy("language")
        .agg(F.count("*").alias("num_books"))
    )


def top_languages(meta: DataFrame, k: int = 1) -> DataFrame:
    return language_counts(meta).orderBy(F.desc("num_books"), "language").limit(k)


def avg_title_length(meta: DataFrame) -> DataFrame:
    """Mean title length in characters; null where no book has a title."""
    return meta.agg(F.avg(F.length("title")).alias("avg_title_length"))


def metadata_coverage(meta: DataFrame) -> DataFrame:
    """Books in total and per field, with percentages, in one pass."""
    fields = {
        "title": "title",
        "date": "release_date",
        "language": "language",
        "encoding": "encoding",
    }
    counts = meta.agg(
        F.count("*").alias("total_books"),
        *[F.count(column).alias(f"with_{name}") for name, column in fields.items()],
    )
    return counts.select(
        "*",
        *[
            F.try_divide(F.lit(100.0) * F.col(f"with_{name}"), "total_books").alias(f"pct_{name}")
            for name in fields
        ],
    )


def metadata_quality(meta: DataFrame, key: str = "file_name") -> DataFrame:
    """Per book: which fields are missing, how many, and the release date where its text is
    a whole date.

    A date is a month by name or three letters, a day and a year (``May 2, 1999``), or a
    month and a year, which gives the first of the month; other texts give null.
    """
    month_day = F.regexp_extract("release_date", r"^([A-Z][a-z]+ \d{1,2}, ?\d{4})$", 1)
    month_only = F.regexp_extract("release_date", r"^([A-Z][a-z]+),? (\d{4})$", 1)
    year = F.regexp_extract("release_date", r"^([A-Z][a-z]+),? (\d{4})$", 2)
    whole = F.regexp_replace(month_day, ", ?", " ")
    first = F.concat(month_only, F.lit(" 1 "), year)
    day = F.coalesce(
        *[
            F.try_to_timestamp(text, F.lit(form)).cast("date")
            for text in (whole, first)
            for form in ("MMMM d yyyy", "MMM d yyyy")
        ]
    )
    fields = ("title", "release_date", "language", "encoding")
    missing = {name: F.col(name).isNull() for name in fields}
    return meta.select(
        key,
        *[flag.alias(f"no_{name}") for name, flag in missing.items()],
        sum(flag.cast("int") for flag in missing.values()).alias("n_missing"),
        day.alias("release_day"),
    )
