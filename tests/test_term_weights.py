import math
import random

import pytest
from pyspark.sql import functions as F

import brute_force
from corpuslens.operators import similarity as S
from corpuslens.operators import term_weights as T

TEXTS = ("cat dog cat", "cat bird", "the", "dog dog dog fish", None)
BAGS = {
    "b0": ["cat", "dog", "cat"],
    "b1": ["cat", "bird"],
    "b2": [],
    "b3": ["dog", "dog", "dog", "fish"],
    "b4": [],
}


def test_term_counts_and_frequency(books):
    rows = T.term_frequency(T.term_counts(books(*TEXTS))).collect()
    assert {(r["file_name"], r["word"]): (r["word_count"], r["total_words"]) for r in rows} == {
        ("b0", "cat"): (2, 3),
        ("b0", "dog"): (1, 3),
        ("b1", "cat"): (1, 2),
        ("b1", "bird"): (1, 2),
        ("b3", "dog"): (3, 4),
        ("b3", "fish"): (1, 4),
    }
    for doc in ("b0", "b1", "b3"):
        assert sum(r["tf"] for r in rows if r["file_name"] == doc) == pytest.approx(1)


def test_idf_counts_documents_without_words(books):
    rows = books("cat dog", "cat", "the")
    idf = {
        r["word"]: (r["doc_freq"], r["idf"])
        for r in T.inverse_document_frequency(rows, T.term_counts(rows)).collect()
    }
    assert idf == {
        "cat": (2, pytest.approx(math.log(3 / 2))),
        "dog": (1, pytest.approx(math.log(3))),
    }


def found_weights(rows):
    return {(r["file_name"], r["word"]): r["tfidf"] for r in rows.collect()}


def expected_weights():
    vectors = brute_force.weights(BAGS)
    return {(doc, word): w for doc, vector in vectors.items() for word, w in vector.items()}


def test_tfidf(books):
    assert found_weights(T.tfidf(books(*TEXTS))) == pytest.approx(expected_weights())


def test_tfidf_where_some_words_are_broadcast_and_some_shuffled(books, small):
    assert found_weights(T.tfidf(books(*TEXTS))) == pytest.approx(expected_weights())


def test_norms(books):
    norms = dict(map(tuple, T.document_norms(T.tfidf(books(*TEXTS))).collect()))
    assert norms == pytest.approx(
        {
            doc: math.sqrt(sum(w * w for w in vector.values()))
            for doc, vector in brute_force.weights(BAGS).items()
        }
    )


def test_top_by_breaks_ties_by_key(spark):
    rows = spark.createDataFrame([("b", 0.5), ("a", 0.5 + 1e-9), ("c", 0.7)], "word string, x double")
    assert [r["word"] for r in T.top_by(rows, "x", 2, "word").collect()] == ["c", "a"]


def test_idf_extremes(books):
    rows = books("cat dog", "cat emu", "cat dog")
    extremes = T.idf_extremes(T.inverse_document_frequency(rows, T.term_counts(rows)), 1).collect()
    assert {(r["extreme"], r["word"]) for r in extremes} == {("highest", "emu"), ("lowest", "cat")}


def test_no_documents(books):
    assert T.tfidf(books("cat").filter(F.lit(False))).count() == 0


def test_sums_do_not_depend_on_the_partitions(spark):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 7))) for _ in range(400)]
    texts = [(f"{i}.txt", " ".join(rng.choice(words[: 5 + 4 * i]) for _ in range(rng.randrange(3, 300)))) for i in range(90)]
    found = set()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in (1, 7, 64):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            rng.shuffle(texts)
            books = spark.createDataFrame(texts, "file_name string, text string").repartition(partitions)
            with T.term_tables(books) as terms:
                norms = T.document_norms(T.tfidf(terms)).collect()
                near = S.top_similar(terms, "10.txt", 50, digits=None).collect()
            found.add((frozenset(map(tuple, norms)), tuple(map(tuple, near))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(found) == 1


def test_exact_sums_are_near_the_sums(spark):
    rng = random.Random(7)
    values = [rng.random() ** 8 for _ in range(5000)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    assert frame.agg(T.exact_sum(F.col("v"))).first()[0] == pytest.approx(math.fsum(values), abs=1e-12)
