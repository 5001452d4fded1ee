"""Stop words from a table of any size."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.functions.patterns import STOP_WORDS
from corpuslens.operators.lookup import join_lookup

MOST_BYTES = 8 << 20  # of a list that is broadcast, with 64 bytes for each word besides its letters


def usual_stop_words(spark: SparkSession) -> DataFrame:
    """``(word)``: the fixed list."""
    return spark.createDataFrame([(word,) for word in sorted(set(STOP_WORDS))], "word string")


def without_stop_words(rows: DataFrame, stop_words: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """``rows`` (word and others) without those whose word is in ``stop_words`` (word).

    The list is counted. A small one is broadcast, and no row is shuffled. Of a large one, only
    what the corpus has counts: the corpus's words are added up within tasks, the list's are taken
    out of them, and the rows meet the words that stay by ``join_lookup``, which broadcasts
    the common ones. So no frequent word is shuffled either way. Nulls in the list are ignored.
    """
    listed = stop_words.select("word").filter(F.col("word").isNotNull()).distinct()
    size = listed.agg(F.coalesce(F.sum(F.octet_length("word") + 64), F.lit(0))).first()[0]
    if size <= most_bytes:
        return rows.join(F.broadcast(listed), "word", "left_anti")
    counts = rows.groupBy("word").agg(F.count("*").alias("_n"))
    staying = counts.join(listed, "word", "left_anti")
    return join_lookup(rows, staying, on="word", frequency="_n", key_bytes=F.octet_length("word")).drop("_n")
