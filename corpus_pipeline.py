"""A training corpus from ``documents``: language, copies, near copies, secrets, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept. All
but the last return the columns of ``documents``:

* ``language_id`` drops texts in no known language (null, without a letter, or of n-grams that no language has);
* ``exact_dedup`` keeps, of equal texts, the row with the largest doc_id;
* ``ngram_join`` keeps one document of each component of near copies;
* ``secret_scan`` keeps every document and masks the secrets in its text;
* ``packing`` returns the pieces of the documents and their places in sequences.

Nulls, empty and very long texts, repeated rows, empty tables and further columns are
treated as the operators' docstrings say.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpuslens.llm import credentials, language_id, ngram_join, packing, stream_dedup
from corpuslens.llm.stored import stored


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.in_known_language(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return stream_dedup.without_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each_group(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return credentials.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path(packing.VOCABULARY))


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("ngram_join", near_stage),
    ("secret_scan", secrets_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None  # near copies, linked secrets and packing are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn, each one's result written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
