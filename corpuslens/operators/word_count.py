"""Word count over lines or whole texts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.functions.tokens import counted_words, trim_apostrophes, word_rows


def word_count(lines: DataFrame, text: str = "value") -> DataFrame:
    """``(word, n)``. Spark adds up within each task before it shuffles."""
    words = word_rows(lines.select(counted_words(F.col(text)).alias("words")), "words")
    return (
        words.select(trim_apostrophes(F.col("word")).alias("word"))
        .filter(F.col("word") != "")
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )
