"""Every query by name: ``(spark, directory of the tables) -> DataFrame``.

All run over whole tables. A limit stands only where the report is a top-k. Doubles
are rounded to six decimals, since the order of a distributed sum is not fixed.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.functions import tokens as text_functions
from corpuslens.operators import influence as I
from corpuslens.operators import metadata as M
from corpuslens.operators import similarity as S
from corpuslens.operators import term_weights as T
from corpuslens.operators.adjacency import edges_of, influence_adjacency, numbered
from corpuslens.operators.near_search import approximate_similar, measured_recall
from corpuslens.operators.network_feed import feed, known_edges
from corpuslens.operators.posting_index import build_index, search
from corpuslens.operators.stop_words import usual_stop_words
from corpuslens.operators.word_count import word_count
from corpuslens.sources import files, tables
from corpuslens.sources.shared import run_folder

KEY = "doc_id"
TARGET = 10
WINDOW = 5

Query = Callable[[SparkSession, str], DataFrame]


def rounded(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({c: F.round(c, 6) for c in columns})


def _documents(query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, directory: query(tables.documents(spark, directory))


def _books(query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, directory: query(tables.books_with_headers(spark, directory))


def _metadata(query: Callable[[DataFrame], DataFrame]) -> Query:
    return _books(lambda books: query(M.metadata(books, KEY)))


def _dated(query: Callable[[DataFrame], DataFrame]) -> Query:
    return _books(lambda books: query(I.author_years(books, KEY)))


def _counts(docs: DataFrame) -> DataFrame:
    return T.term_counts(docs, KEY)


def _term_frequency(docs: DataFrame) -> DataFrame:
    return T.term_frequency(_counts(docs))


def _vocabulary(docs: DataFrame) -> DataFrame:
    return T.inverse_document_frequency(docs, _counts(docs), KEY)


def _terms(query: Callable[[T.Terms], DataFrame]) -> Query:
    return _documents(lambda docs: query(T.term_tables(docs, KEY)))


def _word_count_through_files(spark: SparkSession, directory: str) -> DataFrame:
    """Texts to line files, word count over the lines, counts to files, read back."""
    folder = run_folder(spark, "word-counts")
    lines = tables.documents(spark, directory).select("text")
    lines.write.text(f"{folder}/lines")
    counts = word_count(files.read_lines(spark, f"{folder}/lines"))
    files.write_word_counts(counts, f"{folder}/counts")
    return files.read_lines(spark, f"{folder}/counts")


def _book_folder(spark: SparkSession, directory: str) -> DataFrame:
    """Texts to a folder of books, up to 500 in each, read back with the report of rejects."""
    folder = run_folder(spark, "books")
    texts = tables.documents(spark, directory).select("text")
    texts.write.option("maxRecordsPerFile", 500).text(folder)
    books, rejects = files.read_report(spark, folder)
    rejected = rejects.agg(F.count("*").alias("rejected"))
    totals = books.agg(
        F.sum(F.length("text")).alias("characters"),
        (F.count("*") == files.list_books(spark, folder).count()).alias("all_read"),
    )
    return totals.withColumn("rejected", rejected.scalar())


def _edges_of_the_last_tenth(dated: DataFrame) -> DataFrame:
    """What the books whose number ends in 9 add to the network of all others."""
    added = F.col(KEY) % 10 == 9
    return I.edges_added(dated.filter(~added), dated.filter(added), WINDOW)


def _indexed_similar(spark: SparkSession, directory: str) -> DataFrame:
    """``top_similar`` through an index that is written first."""
    docs = tables.documents(spark, directory)
    index = build_index(T.term_tables(docs, KEY), run_folder(spark, "index"))
    return search(index, docs, TARGET, k=5)


def _every_fiftieth(doc: Column) -> Column:
    return doc % 50 == 0


def _approximate_recall(terms: T.Terms) -> DataFrame:
    """Whether the approximate search finds nine in ten of the rows that an exact one has."""
    recall = measured_recall(terms, _every_fiftieth)
    return recall.select("near", (F.col("found") * 10 >= F.col("near") * 9).alias("recall_reached"))


def _fed_network(spark: SparkSession, directory: str) -> DataFrame:
    """The network after books came in three lots, each taken in by a stream of its own run."""
    folder = run_folder(spark, "network")
    books = tables.books_with_headers(spark, directory)
    for lot in range(3):
        books.filter(F.col(KEY) % 3 == lot).write.mode("append").parquet(f"{folder}/books")
        landed = spark.readStream.schema(books.schema).parquet(f"{folder}/books")
        feed(I.author_years(landed, KEY), f"{folder}/state", WINDOW).awaitTermination()
    return known_edges(spark, f"{folder}/state").select("author_a", "author_b")


def _through_adjacency(dated: DataFrame) -> DataFrame:
    """The edges, taken from the bitmaps of all adjacency lists."""
    tables_ = I.author_tables(dated)
    numbers = numbered(tables_.authors)
    return edges_of(influence_adjacency(tables_, numbers, WINDOW), numbers)


def queries() -> dict[str, Query]:
    return {
        # sources and sinks
        "documents_as_books": tables.documents_as_books,
        "wordcount_sink": _word_count_through_files,
        "book_folder": _book_folder,
        # word count
        "word_count": _documents(lambda d: word_count(d, "text")),
        # metadata
        "meta_extract": _metadata(lambda m: m),
        "books_per_year": _metadata(lambda m: M.books_per_year(m).orderBy("release_year")),
        "language_counts": _metadata(
            lambda m: M.language_counts(m).orderBy(F.desc("num_books"), "language")
        ),
        "top_language": _metadata(M.top_languages),
        "avg_title_length": _metadata(lambda m: rounded(M.avg_title_length(m), "avg_title_length")),
        "metadata_coverage": _metadata(
            lambda m: rounded(
                M.metadata_coverage(m), "pct_title", "pct_date", "pct_language", "pct_encoding"
            )
        ),
        "metadata_by_form": _books(lambda b: M.metadata_by_form(b, KEY)),
        "metadata_forms": _books(lambda b: M.form_counts(M.metadata_by_form(b, KEY))),
        "metadata_quality": _metadata(lambda m: M.metadata_quality(m, KEY)),
        # tokens
        "strip_boilerplate": _books(text_functions.strip_boilerplate),
        "tokenize": _documents(lambda d: T.tokens(d, KEY)),
        "tokenize_by_table": _documents(
            lambda d: T.tokens(d, KEY, usual_stop_words(d.sparkSession))
        ),
        "tokenize_books": _books(lambda b: T.tokens(b, KEY)),
        "token_count": _documents(lambda d: T.token_count(d, KEY)),
        "tokens_per_doc": _documents(lambda d: T.tokens_per_document(d, KEY)),
        "first_tokens_per_doc": _documents(
            lambda d: T.tokens_per_document(d, KEY).orderBy(KEY).limit(10)
        ),
        # TF-IDF
        "term_counts": _documents(lambda d: _counts(d).select(KEY, "word", "word_count")),
        "term_frequency": _documents(lambda d: rounded(_term_frequency(d), "tf")),
        "top_tf": _documents(lambda d: T.top_by(_term_frequency(d), "tf", 10, KEY, "word")),
        "doc_frequency": _documents(lambda d: T.document_frequency(_counts(d), KEY)),
        "idf": _documents(lambda d: rounded(_vocabulary(d), "idf")),
        "idf_extremes": _documents(lambda d: T.idf_extremes(_vocabulary(d), 10)),
        "tfidf": _terms(lambda t: rounded(T.tfidf(t), "tf", "idf", "tfidf")),
        "top_tfidf": _terms(
            lambda t: rounded(T.top_by(T.tfidf(t), "tfidf", 20, KEY, "word"), "tf", "idf")
        ),
        "doc_norms": _terms(lambda t: rounded(T.document_norms(T.tfidf(t), KEY), "norm")),
        # similarity
        "cosine_pairs": _terms(lambda t: rounded(S.cosine_pairs(t), "cosine_similarity")),
        "similarity_pair_count": _terms(S.pair_count),
        "top_pairs": _terms(lambda t: S.top_pairs(t, k=20)),
        "pairs_above": _terms(lambda t: S.pairs_above(t, 0.6)),
        "top_similar": _terms(lambda t: S.top_similar(t, TARGET, k=5)),
        "indexed_similar": _indexed_similar,
        "approximate_similar": _terms(lambda t: approximate_similar(t, _every_fiftieth)),
        "approximate_recall": _terms(_approximate_recall),
        # influence network
        "author_extract": _books(lambda b: I.authors_and_years(b, KEY)),
        "author_years": _dated(lambda a: a),
        "first_author_years": _dated(lambda a: a.orderBy("release_year", KEY).limit(20)),
        "influence_edges": _dated(lambda a: I.influence_edges(a, WINDOW)),
        "out_degree": _dated(lambda a: I.out_degree(a, WINDOW)),
        "in_degree": _dated(lambda a: I.in_degree(a, WINDOW)),
        "degree_combined": _dated(lambda a: I.degrees(a, WINDOW)),
        "top_out_degree": _dated(
            lambda a: I.top_degrees(I.out_degree(a, WINDOW), "out_degree", 5)
        ),
        "top_in_degree": _dated(lambda a: I.top_degrees(I.in_degree(a, WINDOW), "in_degree", 5)),
        "top_total_degree": _dated(
            lambda a: I.top_degrees(I.degrees(a, WINDOW), "total_degree", 20)
        ),
        "network_stats": _dated(
            lambda a: rounded(
                I.network_statistics(a, WINDOW), "density", "avg_in_degree", "avg_out_degree"
            )
        ),
        "window_sensitivity": _dated(
            lambda a: rounded(
                I.window_sensitivity(a, [1, 2, 5, 10]),
                "density",
                "avg_in_degree",
                "avg_out_degree",
            )
        ),
        "edges_added": _dated(_edges_of_the_last_tenth),
        "fed_network": _fed_network,
        "adjacency_edges": _dated(_through_adjacency),
    }
