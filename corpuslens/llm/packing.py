"""Packing of token sequences by minimum bin slack.

1. Texts are encoded where they are read and cut into pieces of at most the capacity. Their
   lengths are counted: a histogram of at most ``capacity`` rows, whatever the corpus.
2. The plan is made from the histogram alone. For each bin, a subset-sum over a bitset finds
   the fullest combination of the lengths left, which is then removed, as often as it fits.
3. Each piece is ranked among those of its length: within salted groups, and by the sums of
   the groups before, so no length gathers in one task. Length and rank give its place.

Defined results: a null text is empty and is one piece with the end token. Only texts over
the capacity are cut, the last piece may be shorter. Pieces of one length stand in for each
other, so ties, repeated rows and null doc_ids need no rule. Other columns than those named
are ignored. An empty table gives no row.
"""

import numpy as np
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.llm import bpe, bpe_tasks, packing_tasks, text_tasks
from corpuslens.llm.stored import stored

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 4096
END = 1

# Tasks get these functions with the query and need no copy of the package.
cloudpickle.register_pickle_by_value(text_tasks)
cloudpickle.register_pickle_by_value(bpe_tasks)
cloudpickle.register_pickle_by_value(packing_tasks)


def pieces(docs: DataFrame, vocabulary: Broadcast, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """``(doc_id, text_hash, piece, start, length, ids)`` of ``docs`` (doc_id, text).

    ``ids`` are unsigned 32-bit numbers, little-endian.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"
    )
    return texts.mapInArrow(
        lambda batches: packing_tasks.pieces(batches, vocabulary.value, capacity, end),
        "doc_id long, text_hash long, piece int, start long, length long, ids binary",
    )


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``rows`` with ``sequence_id`` and ``offset``.

    ``rows`` has ``doc_id, text_hash, piece, length`` (1 to ``capacity``) and any others. It
    is read twice, so it should be a written table.
    """
    spark = rows.sparkSession
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64("doc_id", "text_hash", "piece"), F.lit(salts)).cast("int")
    salted = rows.withColumn("_salt", salt)
    groups = stored(salted.groupBy("length", "_salt").agg(F.count("*").alias("n")))
    histogram = groups.groupBy("length").agg(F.sum("n").alias("n")).collect()
    plan = packing_tasks.plan({row["length"]: row["n"] for row in histogram}, capacity)
    table = np.array(sorted(plan), np.int64).reshape(-1, 6).T
    sent = spark.sparkContext.broadcast(table)

    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = groups.select(
        "length", "_salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy("length", "_salt").orderBy("doc_id", "text_hash", "piece")
    ranked = (
        salted.withColumn("_within", F.row_number().over(within))
        .join(starts, ["length", "_salt"])
        .select(*rows.columns, (F.col("_before") + F.col("_within") - 1).alias("rank"))
    )
    schema = rows.limit(0).withColumns(
        {"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}
    ).schema
    return ranked.mapInArrow(lambda batches: packing_tasks.placed(batches, sent.value), schema)


def pack_documents(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` of whole documents."""
    vocabulary = bpe.read_vocabulary(docs.sparkSession.sparkContext, vocabulary_path)
    rows = pieces(docs, vocabulary).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(stored(rows)).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def query(spark, directory: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{directory}/documents.parquet")
    return pack_documents(docs, public_tokenizers.path(VOCABULARY))
