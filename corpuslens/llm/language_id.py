"""Language identification by language-bitmask n-gram filters.

A language contains a byte 4-gram (letters in lower case, all else spaces) of its training
texts if its rate there, a share of all the language's n-grams, is at least one in ``share`` of the greatest
rate in any language; below that it is a stray word of another language. No n-gram is
dropped for being rare. All lists share one bit-sliced Bloom filter: each place holds a bitmask of languages,
and the masks at an n-gram's two places, joined by AND, are the languages that list it. Per
text and language, the set bits are counted, corrected by the language's rate of false
positives, and the largest share of n-grams decides; of equal shares, the first language
by name.

Training counts n-grams over all labelled training texts; tasks add up before the shuffle,
by language and n-gram, so a frequent language is no hot key. Lists grow with the corpus and stay in
tables. The filter has 32 places for each n-gram of the longest list, from 2**20 to 2**22, so the driver
gets at most 2**22 masks and the tasks 32 MB for up to 64 languages; in a fuller filter
false positives are more, and corrected.

Defined results: a null text, a text without a letter, and any text when no language was
learned is ``und`` with score 0. Rows without language, and held-out ones, teach nothing; a
null doc_id counts as not held out. Texts are judged one by one, so ties, repeated rows and
null doc_ids need no rule. All columns of the input are kept; those named ``lang_pred`` and
``score`` are replaced. An empty table gives no row.
"""

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.llm import language_tasks, text_tasks
from corpuslens.llm.stored import stored

SHARE = 16
LEAST_BITS, MOST_BITS = 20, 22
PLACES = 32  # of the filter for each n-gram of the longest list

# Tasks get these functions with the query and need no copy of the package.
cloudpickle.register_pickle_by_value(text_tasks)
cloudpickle.register_pickle_by_value(language_tasks)


def filter_bits(longest: int) -> int:
    """The filter for lists of up to ``longest`` n-grams has 2 to the power of this many places."""
    return min(MOST_BITS, max(LEAST_BITS, (PLACES * longest - 1).bit_length()))


def train(texts: DataFrame, share: int = SHARE, bits: int | None = None):
    """The filter of the labelled ``texts`` (text, lang)."""
    counts = (
        texts.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
        .select("lang", "text")
        .mapInArrow(language_tasks.count_grams, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    total = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    rates = counts.join(total, "lang").select("lang", "gram", (F.col("n") / F.col("total")).alias("rate"))
    greatest = F.max("rate").over(Window.partitionBy("gram"))
    listed = rates.withColumn("greatest", greatest).filter(F.col("rate") * share >= F.col("greatest"))
    listed = stored(listed.select("lang", "gram"))
    sizes = {row["lang"]: row["n"] for row in listed.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    bits = filter_bits(max(sizes.values(), default=0)) if bits is None else bits

    def placed(batches):
        return language_tasks.placed(batches, langs, bits)

    masks = listed.mapInArrow(placed, "word int, place int, mask long").groupBy("word", "place").agg(F.bit_or("mask").alias("mask"))
    table = masks.toArrow()
    return language_tasks.build(langs, table["word"].to_numpy(), table["place"].to_numpy(), table["mask"].to_numpy(), bits)


def predict(docs: DataFrame, training: DataFrame, share: int = SHARE, bits: int | None = None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, learned from ``training`` (text, lang)."""
    model = docs.sparkSession.sparkContext.broadcast(train(training, share, bits))

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def judged(texts: pa.Array) -> pa.Array:
        return language_tasks.predicted(texts, model.value)

    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.select(*kept, judged(F.col("text")).alias("_judged")).select(
        *kept, "_judged.lang_pred", "_judged.score"
    )


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: by a hash of its number."""
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % 4
    return F.coalesce(remainder == 2, F.lit(False))


def in_known_language(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, without the documents in no known language: those that are ``und``, and
    those of which no language contains more n-grams than by false positives (score 0)."""
    training = docs.filter(~held_out(F.col("doc_id"))).select("text", "lang")
    rows = predict(docs.select(F.struct("*").alias("document"), "text"), training)
    return rows.filter((F.col("lang_pred") != "und") & (F.col("score") > 0)).select("document.*")


def query(spark, directory: str) -> DataFrame:
    docs = spark.read.parquet(f"{directory}/documents.parquet")
    out = held_out(F.col("doc_id"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), out.alias("held_out"), "text")
    return predict(rows, docs.filter(~out).select("text", "lang")).drop("text")
