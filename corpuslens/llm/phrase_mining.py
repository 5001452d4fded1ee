"""Phrases whose words occur together more often than their parts suggest.

Counts are kept as sorted streams, and what a phrase must know of its parts comes from
passes over them in lockstep:

1. Texts are dealt into batches. A batch sends hashes of its phrases of one to three words with
   their numbers, packed, to buckets of hashes, and is told which occur ``least`` times in
   the corpus; a part of a frequent phrase is frequent too. A hash only chooses: the batch
   writes those phrases out in words, in sorted and compressed pieces for buckets of phrases,
   which add them up exactly. So the many rare phrases are never rows.
2. The counts are laid out twice, sorted by their words forwards (prefix order) and
   backwards (suffix order), in ranges of equal size. In prefix order a phrase stands after
   its first word and its first two words and before its extensions to the right; in suffix
   order, likewise to the left. One pass over each stream, with three numbers in memory,
   gives left counts, right counts and the most frequent extension; nothing is looked up in
   a hash table. Ranges cut through the phrases of a frequent word. What one must know of
   the range before is one or two counts for each range, which are broadcast.
3. The two streams are merge-joined by phrase, scored, and ranked per language: within
   salted groups first, since a language may hold most phrases.

Scores are exact: products are decimals of 38 digits, enough for counts below 10**15.

Defined results: a null text is empty, a null lang is ``und`` (and one with the lang of that
name). A-Z is lower-cased; pieces end at ``[.,;:!?\\x0A-\\x0D]``, words are ``[^\\x20\\x09]+``. Equal
scores go by count, then by phrase in UTF-8 order, so ties are settled. Each row counts, also
a repeated one; other columns are ignored. An empty table gives no row.
"""

import math

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.llm import phrase_tasks, text_tasks
from corpuslens.llm.batches import batch_count, in_batches
from corpuslens.llm.stored import stored

BATCH_BYTES = 12 << 20
LEAST = 10
MOST = 2000
SALTS = 32
WORDS = ("w1", "w2", "w3")
ORDER = ("lang", "k1", "k2", "k3")

# Tasks get these functions with the query and need no copy of the package.
cloudpickle.register_pickle_by_value(text_tasks)
cloudpickle.register_pickle_by_value(phrase_tasks)


def frequent(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``(lang, w1, w2, w3, n)``: the phrases of one to three words that ``docs`` (text, lang) has
    at least ``least`` times in a language, and of each language a row without words for
    the number of all its words."""
    narrow = docs.select(F.lit(None).cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    n_batches = batch_count(narrow, BATCH_BYTES)
    # Six bits more than the batches have bytes: hardly any rare phrase shares a hash.
    bits = min(63, math.ceil(math.log2(n_batches * BATCH_BYTES)) + 6)
    dealt = in_batches(narrow, n_batches, "lang").select("batch", "text", "lang")
    asked = dealt.groupBy("batch").applyInArrow(
        lambda texts: phrase_tasks.requests(texts, bits, n_batches),
        "batch int, bucket int, keys binary, counts binary",
    )
    answers = asked.groupBy("bucket").applyInArrow(
        lambda keys: phrase_tasks.replies(keys, least), "batch int, keys binary"
    )
    counts = (
        dealt.groupBy("batch")
        .cogroup(answers.groupBy("batch"))
        .applyInArrow(
            lambda texts, keys: phrase_tasks.counted(texts, keys, bits, n_batches), "bucket int, rows binary"
        )
    )
    return counts.groupBy("bucket").applyInArrow(
        lambda rows: phrase_tasks.summed(rows, least), "lang string, w1 string, w2 string, w3 string, n long"
    )


def _stream(phrases: DataFrame) -> DataFrame:
    """``phrases`` (lang, k1, k2, k3, n) with ``near_1, near_2, longest``, from one pass in order."""
    merged = stored(
        phrases.repartitionByRange(*ORDER)
        .sortWithinPartitions(*ORDER)
        .mapInArrow(
            phrase_tasks.lockstep,
            "lang string, k1 string, k2 string, k3 string, n long, near_1 long, near_2 long, longest long",
        )
    )
    rows = merged.filter("n IS NOT NULL")
    # At the head of each range: at most one word, one phrase of two, and one extension.
    one = ["lang", "k1"]
    two = ["lang", "k1", "k2"]
    open_1 = rows.filter("near_1 IS NULL AND k2 IS NOT NULL").select(one).distinct()
    open_2 = rows.filter("near_2 IS NULL AND k3 IS NOT NULL").select(two).distinct()
    known_1 = rows.filter("k2 IS NULL").join(F.broadcast(open_1), one).select(*one, F.col("n").alias("before_1"))
    known_2 = (
        rows.filter("k2 IS NOT NULL AND k3 IS NULL")
        .join(F.broadcast(open_2), two)
        .select(*two, F.col("n").alias("before_2"))
    )
    later = merged.filter("n IS NULL").groupBy(two).agg(F.max("longest").alias("later"))
    return (
        rows.join(F.broadcast(known_1), one, "left")
        .join(F.broadcast(known_2), two, "left")
        .join(F.broadcast(later), two, "left")
        .select(
            *ORDER,
            "n",
            F.coalesce("near_1", "before_1").alias("near_1"),
            F.coalesce("near_2", "before_2").alias("near_2"),
            F.when(F.col("k3").isNull(), F.greatest("longest", F.coalesce("later", F.lit(0)))).alias("longest"),
        )
    )


def _turned(k: Column, one: Column, two: Column, three: Column) -> list[Column]:
    """The words of a phrase of ``k`` words in the opposite order."""
    return [
        F.when(k == 3, three).when(k == 2, two).otherwise(one),
        F.when(k == 3, two).when(k == 2, one),
        F.when(k == 3, one),
    ]


def _length(second: str, third: str) -> Column:
    return 1 + F.col(second).isNotNull().cast("int") + F.col(third).isNotNull().cast("int")


def with_parts(phrases: DataFrame) -> DataFrame:
    """``(lang, w1, w2, w3, n, left_1, left_2, right_1, right_2, longest)`` of the phrases of two
    and three words in ``phrases`` (lang, w1, w2, w3, n): the numbers of their first one and two
    words, of their last one and two, and of their most frequent extension by one word."""
    backwards = _turned(_length("w2", "w3"), *map(F.col, WORDS))
    names = ("k1", "k2", "k3")
    forward = _stream(phrases.select("lang", *[F.col(w).alias(k) for w, k in zip(WORDS, names)], "n"))
    backward = _stream(phrases.select("lang", *[c.alias(k) for c, k in zip(backwards, names)], "n"))
    left = forward.filter("k2 IS NOT NULL").select(
        "lang",
        *[F.col(k).alias(w) for k, w in zip(names, WORDS)],
        "n",
        F.col("near_1").alias("left_1"),
        F.col("near_2").alias("left_2"),
        F.col("longest").alias("to_right"),
    )
    right = backward.filter("k2 IS NOT NULL").select(
        "lang",
        *[c.alias(w) for c, w in zip(_turned(_length("k2", "k3"), *map(F.col, names)), WORDS)],
        F.col("near_1").alias("right_1"),
        F.col("near_2").alias("right_2"),
        F.col("longest").alias("to_left"),
    )
    third = lambda rows: rows.withColumn("third", F.coalesce("w3", F.lit("")))  # noqa: E731  no word is empty
    return (
        third(left)
        .join(third(right).drop("w3").hint("merge"), ["lang", "w1", "w2", "third"])
        .withColumn("longest", F.greatest("to_right", "to_left"))
        .drop("third", "to_right", "to_left")
    )


def _score(n: Column, left: Column, right: Column) -> Column:
    """``floor(1000000 * n * n / (left * right))``, exactly."""
    exact = lambda x: x.cast("decimal(15,0)")
    square = F.lit(1_000_000).cast("decimal(7,0)") * (exact(n) * exact(n))
    return F.call_function("div", square, exact(left) * exact(right))


def scored(parts: DataFrame) -> DataFrame:
    """``(lang, phrase, a, l, r, score)`` of the phrases in ``parts`` that are not mostly within one
    longer phrase. A phrase of three words takes the lower-scoring of its two cuts."""
    n = F.col("n")
    first = _score(n, F.col("left_1"), F.coalesce("right_2", "right_1"))
    second = F.when(F.col("w3").isNotNull(), _score(n, F.col("left_2"), F.col("right_1")))
    rows = parts.filter(F.coalesce(100 * F.col("longest") < 50 * n, F.lit(True))).select(
        "lang",
        F.concat_ws(" ", *WORDS).alias("phrase"),
        n.alias("a"),
        "left_1",
        "left_2",
        "right_1",
        "right_2",
        first.alias("first"),
        second.alias("second"),
    )
    later = F.coalesce(F.col("second") < F.col("first"), F.lit(False))
    return rows.select(
        "lang",
        "phrase",
        "a",
        F.when(later, F.col("left_2")).otherwise(F.col("left_1")).alias("l"),
        F.when(later, F.col("right_1")).otherwise(F.coalesce("right_2", "right_1")).alias("r"),
        F.when(later, F.col("second")).otherwise(F.col("first")).alias("score"),
    )


def mine(docs: DataFrame, least: int = LEAST, most: int = MOST) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``most`` best phrases of each language."""
    counts = stored(frequent(docs, least))
    found = scored(with_parts(counts.filter("w1 IS NOT NULL")))
    order = (F.desc("score"), F.desc("a"), F.col("phrase"))
    salted = found.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    in_salt = Window.partitionBy("lang", "salt").orderBy(*order)
    in_language = Window.partitionBy("lang").orderBy(*order)
    words = counts.filter("w1 IS NULL").select("lang", F.col("n").alias("words"))
    return (
        salted.withColumn("rank", F.row_number().over(in_salt))
        .filter(F.col("rank") <= most)
        .withColumn("rank", F.row_number().over(in_language))
        .filter(F.col("rank") <= most)
        .join(words, "lang")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("words").alias("n"), "score")
    )


def query(spark, directory: str) -> DataFrame:
    return mine(spark.read.parquet(f"{directory}/documents.parquet"))


ORACLE_SQL = r"""
WITH texts AS (
    SELECT row_number() OVER () AS t, coalesce(lang, 'und') AS lang, string_split_regex(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]') AS pieces
    FROM documents
), pieces AS (
    SELECT t, lang, generate_subscripts(pieces, 1) AS p, unnest(pieces) AS piece FROM texts
), lists AS (
    SELECT t, lang, p, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces
), words AS (
    SELECT t, lang, p, generate_subscripts(w, 1) AS i, unnest(w) AS w1 FROM lists
), spans AS (
    SELECT lang, w1, lead(w1, 1) OVER near AS w2, lead(w1, 2) OVER near AS w3
    FROM words WINDOW near AS (PARTITION BY t, p ORDER BY i)
), totals AS (
    SELECT lang, count(*) AS n FROM words GROUP BY lang
), ones AS (
    SELECT lang, w1, count(*) AS f FROM spans GROUP BY ALL HAVING count(*) >= 10
), twos AS (
    SELECT lang, w1, w2, count(*) AS f FROM spans WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), threes AS (
    SELECT lang, w1, w2, w3, count(*) AS f FROM spans WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), longer AS (
    SELECT lang, w1, w2, max(f) AS f FROM (
        SELECT lang, w1, w2, f FROM threes UNION ALL SELECT lang, w2, w3, f FROM threes) GROUP BY ALL
), cuts AS (
    SELECT c.lang, c.w1 || ' ' || c.w2 AS phrase, 1 AS cut, c.f AS a, x.f AS l, y.f AS r
    FROM twos c JOIN ones x ON x.lang = c.lang AND x.w1 = c.w1 JOIN ones y ON y.lang = c.lang AND y.w1 = c.w2
    LEFT JOIN longer ON longer.lang = c.lang AND longer.w1 = c.w1 AND longer.w2 = c.w2
    WHERE coalesce(100 * longer.f < 50 * c.f, true)
    UNION ALL
    SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, 1, c.f, x.f, y.f
    FROM threes c JOIN ones x ON x.lang = c.lang AND x.w1 = c.w1
    JOIN twos y ON y.lang = c.lang AND y.w1 = c.w2 AND y.w2 = c.w3
    UNION ALL
    SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, 2, c.f, x.f, y.f
    FROM threes c JOIN twos x ON x.lang = c.lang AND x.w1 = c.w1 AND x.w2 = c.w2
    JOIN ones y ON y.lang = c.lang AND y.w1 = c.w3
), lowest AS (
    SELECT lang, phrase, a, l, r, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cuts
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest JOIN totals USING (lang)
QUALIFY rank <= 2000
"""
