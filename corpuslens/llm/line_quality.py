"""Quality rules by labelling lines as content or boilerplate.

The lines of a text are a sequence; a linear-chain conditional random field scores their
features (shares of symbols, capitals, digits, stops and repeated words, lengths, repetition)
and the change from label to label, and Viterbi decoding finds the most likely labels. A
text is kept if enough of its characters are in content lines. Base rules come first: texts
of fewer than 50 words, or with more than half of the words in repeated three-word windows,
fail.

The field is fitted on a bounded sample of labelled rows: of each quality ``sample`` labels,
chosen by a hash, of which those count whose documents have at most ``sample_chars`` code
points. The chosen numbers, 2,000 of them, are broadcast, so the texts are not shuffled. Lines
carry their document's label. Everything else covers all texts, whole, where they are read.

Defined results: a null text has no words and fails. Lines without a word have no label.
Without labels of both qualities the weights are zero; ties go to content, so only the base
rules decide. Texts are judged one by one, so ties, repeated rows and null doc_ids need no rule;
labels of null or unknown documents, and null labels, are ignored. ``judge`` keeps the columns
of its input, replacing one named ``quality``. An empty table gives no row.
"""

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm import line_tasks, text_tasks

SAMPLE = 1000
SAMPLE_CHARS = 20_000
CONTENT_SHARE = 0.5

# Tasks get these functions with the query and need no copy of the package.
cloudpickle.register_pickle_by_value(text_tasks)
cloudpickle.register_pickle_by_value(line_tasks)

JUDGED = (
    "struct<n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long,"
    "content_chars:long,base_failed:boolean,kept:boolean>"
)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS):
    """The field's ``(weights, transitions)`` from ``docs`` (doc_id, text) and ``labels``
    (doc_id, quality: 1 good, 0 not)."""
    by_quality = [
        labels.filter(F.col("quality") == quality)
        .select("doc_id", "quality")
        .distinct()
        .orderBy(F.xxhash64("doc_id"))
        .limit(sample)
        for quality in (1, 0)
    ]
    texts = docs.filter(F.length("text") <= sample_chars).select("doc_id", "text")
    chosen = (
        texts.join(F.broadcast(by_quality[0].union(by_quality[1])), "doc_id")
        .orderBy(F.xxhash64("doc_id"), "text")
        .limit(2 * sample)
        .toArrow()
    )
    sequences = line_tasks.line_features(chosen["text"])
    good = np.array(chosen["quality"].to_pylist(), int) == 1
    return line_tasks.fit(sequences, np.where(good, line_tasks.CONTENT, line_tasks.BOILERPLATE).tolist())


def judge(docs: DataFrame, model, content_share: float = CONTENT_SHARE) -> DataFrame:
    """``docs`` with ``quality``, a struct of statistics and verdict."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(JUDGED)
    def judged(texts: pa.Array) -> pa.Array:
        return line_tasks.judged(texts, sent.value, content_share)

    return docs.withColumn("quality", judged(F.col("text")))


def query(spark, directory: str) -> DataFrame:
    docs = spark.read.parquet(f"{directory}/documents.parquet")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    labels = spark.read.parquet(f"{directory}/labels.parquet")
    return judge(docs, train(docs, labels)).select("doc_id", "quality.*")
