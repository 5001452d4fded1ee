"""Text files in, word counts out."""

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.sources.shared import run_folder


def clean_text(text: Column) -> Column:
    """Unix line ends, undecodable bytes (read as U+FFFD) dropped."""
    unix = F.regexp_replace(text, "\r\n?", "\n")
    return F.translate(unix, "�", "")


def read_books(spark: SparkSession, directory: str) -> DataFrame:
    """``(file_name, text)``: one row per ``*.txt`` file directly in ``directory``.

    Executors read the files; unreadable ones are skipped, here and in no other read. Names
    starting with ``_`` or ``.`` are hidden from Spark's file index and are not read.
    """
    skipping = spark.read.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    books = skipping.text(directory, wholetext=True, pathGlobFilter="*.txt")
    return books.select(
        F.col("_metadata.file_name").alias("file_name"),
        clean_text(F.col("value")).alias("text"),
    )


def stream_books(spark: SparkSession, directory: str) -> DataFrame:
    """``read_books`` as a stream: each file once, in the batch after it has come."""
    books = spark.readStream.schema("value string")
    return books.text(directory, wholetext=True, pathGlobFilter="*.txt").select(
        F.col("_metadata.file_name").alias("file_name"), clean_text(F.col("value")).alias("text")
    )


def list_books(spark: SparkSession, directory: str) -> DataFrame:
    """``(file_name, path, bytes)`` of the files that ``read_books`` would read now. Their contents
    are not read."""
    files = spark.read.format("binaryFile").option("ignoreMissingFiles", True)
    return files.load(directory, pathGlobFilter="*.txt").select(
        F.col("_metadata.file_name").alias("file_name"), "path", F.col("length").alias("bytes")
    )


def read_report(
    spark: SparkSession, directory: str, most_errors: int = 100
) -> tuple[DataFrame, DataFrame]:
    """``(books, rejects)``: what ``read_books`` reads, and ``(file_name, bytes, reason, error)`` of
    the files that were listed and not read.

    The listing is written down first, so a file that goes afterwards is not forgotten: its reason
    is ``vanished``, of any other ``unreadable``. Every file is read once for its name; rejects are
    the listing's names without those, a join of two columns of names. ``error`` is what the
    reader says; it is asked for the first ``most_errors`` rejects by name, one read for each, and
    null for the rest.
    """
    folder = run_folder(spark, "listing")
    list_books(spark, directory).write.parquet(folder)
    books = read_books(spark, directory)
    return books, rejects(spark.read.parquet(folder), books, directory, most_errors)


def rejects(listed: DataFrame, books: DataFrame, directory: str, most_errors: int = 100) -> DataFrame:
    """Of ``listed`` (file_name, path, bytes) what is not among ``books``, with reason and error.
    Starts a job that reads the books and, for the errors, one for each of these files."""
    spark = listed.sparkSession
    # The length is asked for, so that every file is really read.
    read = books.select("file_name", F.length("text").alias("n")).filter("n IS NOT NULL")
    missing = listed.join(read.select("file_name"), "file_name", "left_anti").persist()
    still_there = list_books(spark, directory).select("file_name", F.lit(True).alias("there"))
    first = missing.orderBy("file_name").limit(most_errors).collect()
    said = [(row["file_name"], _read_error(spark, row["path"])) for row in first]
    errors = spark.createDataFrame(said, "file_name string, error string")
    reason = F.when(F.col("there"), "unreadable").otherwise("vanished")
    return (
        missing.join(still_there, "file_name", "left")
        .join(F.broadcast(errors), "file_name", "left")
        .select("file_name", "bytes", reason.alias("reason"), "error")
    )


def _read_error(spark: SparkSession, path: str) -> str | None:
    """The first line of what reading this one file says, null if it can be read after all."""
    try:
        text = spark.read.option("ignoreCorruptFiles", False).option("ignoreMissingFiles", False)
        literal = re.sub(r"([][{}*?\\])", r"\\\1", path)  # no part of the name is a pattern
        text.text(literal, wholetext=True).select(F.sum(F.length("value"))).collect()
    except Exception as error:  # whatever the reader raises is what is reported
        return _root_cause(error)
    return None


def _root_cause(error: Exception) -> str:
    causes = [line for line in str(error).splitlines() if line.startswith("Caused by: ")]
    lines = causes or [line for line in str(error).splitlines() if line.strip()] or [type(error).__name__]
    return lines[-1].removeprefix("Caused by: ") if causes else lines[0]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(value)``: one row per line of the text files under ``path``."""
    return spark.read.text(path)


def cap_input_splits(spark: SparkSession, max_bytes: int) -> None:
    """Read at most ``max_bytes`` per task; results never depend on it."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(max_bytes))
    spark.conf.set("spark.sql.files.openCostInBytes", str(min(max_bytes, 4 << 20)))


def write_word_counts(counts: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``word<TAB>count`` lines, sorted by word within each part file."""
    (
        counts.sortWithinPartitions("word")
        .select(F.concat_ws("\t", "word", F.col("n").cast("string")).alias("value"))
        .write.mode(mode)
        .text(path)
    )
