"""Tokens, term counts, TF, IDF and TF-IDF, in long form: one row per document and word.

A document is one row, so its terms are counted within the row, without a shuffle.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.functions.tokens import content_words, long_words, settled, strip_boilerplate, word_rows
from corpuslens.operators.kept import Kept
from corpuslens.operators.lookup import join_lookup
from corpuslens.operators.stop_words import without_stop_words

UNITS = 2.0**52


def _words(books: DataFrame, key: str, words: Callable[[Column], Column] = content_words) -> DataFrame:
    return strip_boilerplate(books.select(key, "text")).select(key, words(F.col("text")).alias("words"))


def tokens(books: DataFrame, key: str = "file_name", stop_words: DataFrame | None = None) -> DataFrame:
    """``(key, word)``: one row per token. ``stop_words`` (word), of any size, replaces the list."""
    if stop_words is None:
        return word_rows(_words(books, key), "words")
    rows = word_rows(_words(books, key, long_words), "words")
    return without_stop_words(rows, stop_words).select(key, "word")


def token_count(books: DataFrame, key: str = "file_name") -> DataFrame:
    """Tokens of the corpus, counted without making a row of each."""
    return _words(books, key).agg(
        F.coalesce(F.sum(F.size("words")), F.lit(0)).cast("bigint").alias("tokens")
    )


def tokens_per_document(books: DataFrame, key: str = "file_name") -> DataFrame:
    """``(key, tokens)`` of the documents that have tokens."""
    sizes = _words(books, key).select(key, F.size("words").cast("bigint").alias("tokens"))
    return settled(sizes).filter(F.col("tokens") > 0)


def _runs(words: Column) -> Column:
    """``(word, word_count)`` for each run of equal words in a sorted array."""
    n = F.size(words)
    places = F.sequence(F.lit(0), n - 1)
    starts = F.filter(places, lambda i: (i == 0) | (F.get(words, i) != F.get(words, i - 1)))
    ends = F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(n))
    runs = F.zip_with(
        starts,
        ends,
        lambda start, end: F.struct(
            F.get(words, start).alias("word"), (end - start).cast("bigint").alias("word_count")
        ),
    )
    return F.when(n > 0, runs)


def term_counts(books: DataFrame, key: str = "file_name") -> DataFrame:
    """``(key, word, word_count, total_words)``; keys are unique in ``books``."""
    words = settled(
        _words(books, key).select(key, F.sort_array(F.coalesce("words", F.array())).alias("words"))
    )
    total = F.size("words").cast("bigint").alias("total_words")
    return (
        words.select(key, total, F.explode_outer(_runs(F.col("words"))).alias("run"))
        .filter(F.col("run").isNotNull())
        .select(key, "run.word", "run.word_count", "total_words")
    )


def term_frequency(counts: DataFrame) -> DataFrame:
    """The term counts with ``tf``, a word's share of the tokens of its document."""
    return counts.withColumn("tf", F.col("word_count") / F.col("total_words"))


def document_frequency(counts: DataFrame, key: str = "file_name") -> DataFrame:
    """``(word, doc_freq)``."""
    return counts.groupBy("word").agg(F.count(key).alias("doc_freq"))


def inverse_document_frequency(
    books: DataFrame, counts: DataFrame, key: str = "file_name"
) -> DataFrame:
    """``(word, doc_freq, idf)`` with idf = ln(N / doc_freq).

    N counts every book, also those without text or without a single token.
    """
    n_books = books.agg(F.count("*")).scalar()
    return document_frequency(counts, key).withColumn(
        "idf", F.log(n_books / F.col("doc_freq"))
    )


class Terms(Kept):
    """Term counts and vocabulary of a corpus, for any number of reports.

    ``counts`` is ``(key, word, word_count, total_words)``; ``vocabulary`` is ``(word,
    doc_freq, idf, word_id)``. ``release`` when the reports are done. Starts no job.
    """

    def __init__(self, books: DataFrame, key: str) -> None:
        super().__init__()
        self.books, self.key = books, key
        self.vectors = None  # kept by the first report that needs them
        self.counts = self.keep(term_counts(books, key))
        # Sorted, so that a part that is computed again gives each word the same number.
        self.vocabulary = self.keep(
            inverse_document_frequency(books, self.counts, key)
            .sortWithinPartitions("word")
            .withColumn("word_id", F.monotonically_increasing_id())
        )


def term_tables(books: DataFrame | Terms, key: str = "file_name") -> Terms:
    """The handle that the reports below accept in place of ``books``."""
    return books if isinstance(books, Terms) else Terms(books, key)


def weighted(terms: Terms, vocabulary: DataFrame | None = None) -> DataFrame:
    """``(key, tf, tfidf)`` and the columns of the vocabulary."""
    vocabulary = terms.vocabulary if vocabulary is None else vocabulary
    return join_lookup(
        term_frequency(terms.counts).select(terms.key, "word", "tf"),
        vocabulary,
        on="word",
        frequency="doc_freq",
        key_bytes=F.octet_length("word"),
    ).select(terms.key, "tf", (F.col("tf") * F.col("idf")).alias("tfidf"), *vocabulary.columns)


def tfidf(books: DataFrame | Terms, key: str = "file_name") -> DataFrame:
    """``(key, word, tf, idf, tfidf)``."""
    terms = term_tables(books, key)
    return weighted(terms).select(terms.key, "word", "tf", "idf", "tfidf")


def exact_sum(products: Column) -> Column:
    """The sum of products of two TF-IDF weights, which depends neither on the order of the rows nor
    on how they are partitioned: each is rounded to a multiple of 2**-52 and these are added up as
    integers.

    None overflows, whatever the corpus: the TF of a document add up to 1, so such a sum over a
    document's words is at most the greatest idf squared, ln(2**63) ** 2 = 1907, and 1907 * 2**52
    is below 2**63.
    """
    return F.sum(F.rint(products * UNITS).cast("bigint")) / UNITS


def exact_sum_of(rows: Column, product: Callable[[Column], Column]) -> Column:
    """``exact_sum`` of the products of the rows in an array."""
    zero = F.lit(0).cast("bigint")
    return F.aggregate(rows, zero, lambda total, x: total + F.rint(product(x) * UNITS).cast("bigint")) / UNITS


def document_norms(weights: DataFrame, key: str = "file_name") -> DataFrame:
    """``(key, norm)``: Euclidean length of each document's TF-IDF vector."""
    return weights.groupBy(key).agg(
        F.sqrt(exact_sum(F.col("tfidf") * F.col("tfidf"))).alias("norm")
    )


def top_by(rows: DataFrame, value: str, k: int, *ties: str, digits: int = 6) -> DataFrame:
    """The k rows of greatest ``value``, compared at ``digits`` decimals.

    Sums of doubles depend on their order, so nearly equal values are taken as
    ties and the columns ``ties`` decide.
    """
    return (
        rows.withColumn(value, F.round(value, digits)).orderBy(F.desc(value), *ties).limit(k)
    )


def idf_extremes(vocabulary: DataFrame, k: int = 10, digits: int = 6) -> DataFrame:
    """The k rarest and the k most widespread words."""
    words = vocabulary.select("word", "doc_freq", F.round("idf", digits).alias("idf"))
    highest = words.orderBy(F.desc("idf"), "word").limit(k).withColumn("extreme", F.lit("highest"))
    lowest = words.orderBy("idf", "word").limit(k).withColumn("extreme", F.lit("lowest"))
    return highest.unionByName(lowest)
