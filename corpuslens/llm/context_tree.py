"""Scores of texts under a context-tree weighting model of bytes.

A byte is eight binary decisions. Each decision has a tree of contexts, the bytes before it;
every context has a Krichevsky-Trofimov estimate, and the model mixes the estimates of all
depths with the weights that the training texts give them. A text's score is the log10
probability of its bytes (A-Z lower-cased) and of its end; ``-score * log2(10) / bytes`` is
the code length per byte.

The tree has every context of the training texts, so it grows with the corpus and stays in
tables. The texts are dealt into batches; a batch sends each of its grams (``depth`` bytes and
the one after them) once, with its number among the training texts, in a packed row per
bucket. Buckets are by a hash of the context, so no frequent one fills a bucket. The summed
grams are regrouped by stem, the three bytes before the predicted one: below a stem are at
most 65,536 contexts, which a task weighs from the longest up, some stems at a time. The sums
of what stems tell the contexts of two bytes go to the driver, which weighs these (65,793
contexts with the shorter ones, 16.8 million decisions at most, however large the corpus) and
sends them back; then each part finds the probabilities of its grams, and the buckets
answer the batches' requests. ``mass_bits`` is for comparisons: given, only contexts that
hold at least one in ``2 ** mass_bits`` of all bytes are kept, and what lies outside the kept
children of a context is one more child.

The base score is that of add-one smoothed words. Exact counts of all words come back to the
batches of documents that hold them; a batch sends each word once.

Defined results: a null text is empty and has one token, its end. Texts are scored one by
one, so repeated rows, ties and null doc_ids need no rule; a null doc_id counts as not held
out. Without training texts every context is empty, and each decision costs one bit. Other
columns are ignored. An empty table gives no row.
"""

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.llm import context_tree_tasks, text_tasks
from corpuslens.llm.batches import batch_count, in_batches
from corpuslens.llm.stored import stored

DEPTH = 5
BATCH_BYTES = 18 << 20

# Tasks get these functions with the query and need no copy of the package.
cloudpickle.register_pickle_by_value(text_tasks)
cloudpickle.register_pickle_by_value(context_tree_tasks)


def score(docs: DataFrame, depth: int = DEPTH, mass_bits: int | None = None) -> DataFrame:
    """Train on the documents that are not ``held_out`` and score all of ``docs``
    (doc_id, text, held_out)."""
    narrow = docs.select("doc_id", "text", "held_out")
    n_batches = batch_count(narrow, BATCH_BYTES)
    dealt = in_batches(narrow, n_batches, "held_out")
    asked = stored(
        dealt.select("batch", "text", "held_out")
        .groupBy("batch")
        .applyInArrow(
            lambda documents: context_tree_tasks.requests(documents, depth, n_batches),
            "batch int, word string, n long, bucket int, keys binary, counts binary",
        )
    )
    of_words = asked.filter("word IS NOT NULL").select("batch", "word", "n")
    words = of_words.groupBy("word").agg(F.sum("n").alias("c")).filter("c > 0")
    ends = narrow.agg(F.count_if(~F.col("held_out"))).first()[0]
    sums = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    train_tokens, distinct = sums[0] + ends, sums[1] + (ends > 0)
    counts = of_words.select("batch", "word").join(words, "word").select("batch", "word", "c")
    chances = _chances(asked.filter("word IS NULL"), n_batches, depth, mass_bits)
    answers = counts.unionByName(chances, allowMissingColumns=True)
    scores = (
        dealt.groupBy("batch")
        .cogroup(answers.groupBy("batch"))
        .applyInArrow(
            lambda documents, found: context_tree_tasks.scored(documents, found, depth),
            "doc_id long, text_hash long, held_out boolean, n_words long, n_known_words long,"
            " log_counts double, score double",
        )
    )
    n_tokens = F.col("n_words") + 1
    smoothed = F.log10(F.lit(float(train_tokens + distinct + 1)))
    return scores.select(
        "doc_id",
        "held_out",
        n_tokens.alias("n_tokens"),
        (F.col("n_known_words") + int(ends > 0)).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("log_counts") + F.log10(F.lit(ends + 1.0)) - n_tokens * smoothed).alias("base_score"),
        "score",
        "text_hash",
    )


def _chances(asked: DataFrame, n_buckets: int, depth: int, mass_bits: int | None) -> DataFrame:
    """``(batch, keys, log_p)``: the log10 probabilities of the grams that batches asked for."""
    grams = stored(
        asked.select("bucket", "keys", "counts")
        .groupBy("bucket")
        .applyInArrow(
            lambda rows: context_tree_tasks.whole_grams(rows, depth, n_buckets), "part int, key long, n long"
        )
    )
    least = 1
    if mass_bits is not None:
        total = grams.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        least = max(1, -(-total // (1 << mass_bits)))
    told = (
        grams.groupBy("part")
        .applyInArrow(
            lambda rows: context_tree_tasks.told_up(rows, depth, least), "kind int, key long, value double"
        )
        .groupBy("kind", "key")
        .agg(F.sum("value").alias("value"))
    )
    top = context_tree_tasks.top(told.toArrow(), depth, least)
    model = asked.sparkSession.sparkContext.broadcast(top)
    weighed = grams.groupBy("part").applyInArrow(
        lambda rows: context_tree_tasks.told_down(rows, model.value, depth, least, n_buckets),
        "bucket int, key long, log_p float",
    )
    return (
        asked.select("bucket", "batch", "keys")
        .groupBy("bucket")
        .cogroup(weighed.groupBy("bucket"))
        .applyInArrow(context_tree_tasks.answers, "batch int, keys binary, log_p binary")
    )


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: by a hash of its number."""
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % 7
    return F.coalesce(remainder == 2, F.lit(False))


def query(spark, directory: str) -> DataFrame:
    docs = spark.read.parquet(f"{directory}/documents.parquet")
    docs = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return score(docs).drop("text_hash")
