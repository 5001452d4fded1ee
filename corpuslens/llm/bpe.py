"""Byte-pair encoding and decoding with a public vocabulary.

Each word's symbols form a doubly linked list and a priority queue holds its pairs by merge
rank; entries that a merge has outdated are skipped. Decoding puts the vocabulary's strings
together. The vocabulary, a file of fixed size, is read by the driver and broadcast; texts
are encoded where they are read, without a shuffle. Of the runs that white space cuts a
batch into, each different one is encoded once; the ids of its places are copied from there.

Defined results: a null text is empty and has no ids. Special tokens are recognised in
texts, as the file says. A row's ids depend on its text alone, so ties, repeated rows and null doc_ids
need no rule; other columns are ignored; an empty table gives no row. A text of any length is
encoded whole, in time n log n even without white space.
"""

from pathlib import Path

from pyspark import Broadcast, SparkContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm import bpe_tasks, text_tasks

VOCABULARY = "byte_bpe_50k.json"

# Tasks get these functions with the query and need no copy of the package.
cloudpickle.register_pickle_by_value(text_tasks)
cloudpickle.register_pickle_by_value(bpe_tasks)


def read_vocabulary(context: SparkContext, path: str) -> Broadcast:
    return context.broadcast(bpe_tasks.Vocabulary(Path(path).read_text(encoding="utf-8")))


def encode(docs: DataFrame, vocabulary: Broadcast) -> DataFrame:
    """``(doc_id, ids)`` of ``docs`` (doc_id, text)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        lambda batches: bpe_tasks.encoded(batches, vocabulary.value), "doc_id long, ids array<int>"
    )


def decode(encoded: DataFrame, vocabulary: Broadcast) -> DataFrame:
    """``(doc_id, ids, decoded)`` of ``encoded`` (doc_id, ids)."""
    return encoded.mapInArrow(
        lambda batches: bpe_tasks.decoded(batches, vocabulary.value),
        "doc_id long, ids array<int>, decoded string",
    )


def query(spark, directory: str) -> DataFrame:
    import public_tokenizers

    vocabulary = read_vocabulary(spark.sparkContext, public_tokenizers.path(VOCABULARY))
    docs = spark.read.parquet(f"{directory}/documents.parquet")
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decode(encode(docs, vocabulary), vocabulary).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
