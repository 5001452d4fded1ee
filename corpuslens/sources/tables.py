"""Parquet tables as corpora."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.sources.files import clean_text

PARTITIONS = "spark.corpuslens.input.partitions"


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def spread(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal rows out evenly to that many partitions; without a number, leave them as stored.

    For tables stored in fewer row groups than there are cores. The number is the caller's,
    or the session's in ``PARTITIONS``; the data are not looked at. Large tables need none.
    """
    partitions = partitions or int(rows.sparkSession.conf.get(PARTITIONS, "0"))
    return rows.repartition(partitions) if partitions else rows


def documents(spark: SparkSession, directory: str) -> DataFrame:
    """``(doc_id, text)``: one row per document, other columns stay unread."""
    return spread(read_table(spark, directory, "documents").select("doc_id", "text"))


def documents_as_books(spark: SparkSession, directory: str) -> DataFrame:
    """The documents in the shape ``read_books`` gives: ``(file_name, text)``."""
    return documents(spark, directory).select(
        F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("file_name"),
        clean_text(F.col("text")).alias("text"),
    )


def books_with_headers(spark: SparkSession, directory: str) -> DataFrame:
    """``(doc_id, text)``: each document as the body of a book with header and footer.

    The documents have no bibliographic header, so one is composed from the order
    with the document's number, its customer and a part. Headers are joined from
    narrow columns; the texts take part in the last join only.
    """
    docs = read_table(spark, directory, "documents")
    orders = read_table(spark, directory, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = read_table(spark, directory, "customer").select("c_custkey")
    part = read_table(spark, directory, "part").select("p_partkey", "p_name")
    n_parts = part.agg(F.count("*")).scalar()

    doc = F.col("doc_id")

    def each(n):
        return doc % n == 0

    def line(*parts):
        return F.concat(*parts, F.lit("\n"))

    number = doc.cast("string")
    writer = F.concat(
        F.lit("Writer "), F.translate(F.col("c_custkey").cast("string"), "0123456789", "abcdefghij")
    )
    date = F.date_format("o_orderdate", "MMMM d, yyyy")
    names = {"en": "English", "fr": "French", "de": "German", "es": "Spanish"}
    language = F.lit(None).cast("string")
    for code, name in names.items():
        language = F.when(F.col("lang") == code, name).otherwise(language)

    header = F.concat(
        line(F.lit("The Project Gutenberg EBook of "), "p_name", F.lit(", by "), writer),
        F.lit("\n"),
        F.when(each(11), "").otherwise(line(F.lit("Title: "), "p_name", F.lit(" "), number)),
        F.when(each(19), "")
        .when(each(17), "Author: Various\n")
        .when(each(5), line(F.lit("Author: "), writer, F.lit(" (1812-1870)")))
        .otherwise(line(F.lit("Author: "), writer)),
        F.when(each(13), "")
        .when(each(7), line(F.lit("Posting Date: "), date))
        .otherwise(line(F.lit("Release Date: "), date, F.lit(" [EBook #"), number, F.lit("]"))),
        F.when(each(23), "").otherwise(line(F.lit("Language: "), language)),
        F.when(each(29), "").otherwise(
            line(F.lit("Character set encoding: "), F.when(each(2), "UTF-8").otherwise("ASCII"))
        ),
        F.lit("\n*** START OF THIS PROJECT GUTENBERG EBOOK ***\n"),
    )
    headers = (
        docs.select("doc_id", "lang", (doc % n_parts).alias("p_partkey"))
        .join(orders, F.col("o_orderkey") == doc)
        .join(customer, F.col("c_custkey") == F.col("o_custkey"))
        .join(part, "p_partkey")
        .select("doc_id", header.alias("header"))
    )
    footer = F.lit("\n*** END OF THIS PROJECT GUTENBERG EBOOK ***\n")
    return documents(spark, directory).join(headers, "doc_id").select(
        "doc_id", F.concat("header", "text", footer).alias("text")
    )
