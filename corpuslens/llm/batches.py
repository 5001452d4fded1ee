"""Documents dealt into batches of bounded size."""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.stored import on_file

LEAST_BUCKET = 256  # keys that a batch should have for each of as many buckets as batches
BYTES_PER_KEY = 6


def batch_count(docs: DataFrame, batch_bytes: int) -> int:
    """How many batches hold about ``batch_bytes`` of text each.

    Where batches exchange keys in as many buckets, rows go from each batch to each bucket;
    beyond ``(bytes / 1536) ** 0.5`` batches they grow instead, so that a row stays worth it.
    At 100 TB that is 250,000 batches of 400 MB.
    """
    volume = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    most = math.isqrt(volume // (BYTES_PER_KEY * LEAST_BUCKET)) or 1
    return max(1, min(most, -(-volume // batch_bytes)))


def in_batches(docs: DataFrame, n_batches: int, *others: str) -> DataFrame:
    """``(batch, doc_id, text_hash, text, *others)``: batches by a hash of the row's place, its
    file and number there, so that neither a null doc_id nor a row that is repeated a million
    times makes a large one. Rows that are in no file are written to some first."""
    docs = on_file(docs)
    place = docs.metadataColumn("_metadata")
    return docs.select(
        F.pmod(F.xxhash64(place["file_path"], place["row_index"]), F.lit(n_batches)).cast("int").alias("batch"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        "text",
        *others,
    )
