"""Boilerplate and the two tokenisers."""

import pytest
from pyspark.sql import functions as F

from corpuslens.functions.patterns import STOP_WORDS
from corpuslens.functions.tokens import strip_boilerplate
from corpuslens.operators.term_weights import token_count, tokens, tokens_per_document
from corpuslens.operators.word_count import word_count

START = "*** START OF THIS PROJECT GUTENBERG EBOOK A ***\n"
END = "*** END OF THIS PROJECT GUTENBERG EBOOK A ***\n"


@pytest.mark.parametrize(
    "text, body",
    [
        (f"head\n{START}body\n{END}foot", "body\n"),
        (f"head\n{START.lower()}body\n{END.lower()}foot", "body\n"),
        ("no marker", "no marker"),
        ("", ""),
        (None, None),
        (START.strip(), START.strip()),  # no line end after the marker
        (f"straße İ\n{START}body", "body"),  # letters that grow in upper case
        # the order of the list decides, not that of the text
        ("a\n***START OF THE PROJECT GUTENBERG\nb\n" + START + "c", "c"),
        ("End of Project Gutenberg a *** END OF THE PROJECT GUTENBERG b",
         "End of Project Gutenberg a "),
        (f"{END}head\n{START}body", "body"),  # an end marker before the start is cut off
        (f"body\n{END}foot", "body\n"),
    ],
)
def test_strip_boilerplate(books, text, body):
    assert strip_boilerplate(books(text)).first()["text"] == body


def words_of(rows):
    return sorted(r["word"] for r in rows.collect())


def test_similarity_tokens(books):
    assert words_of(tokens(books("well-known don't"))) == ["known", "well"]
    assert words_of(tokens(books("The CAT, a cat: ox cafés 4x4abc"))) == [
        "abc", "caf", "cat", "cat"
    ]
    assert words_of(tokens(books(" ".join(STOP_WORDS), "", None))) == []


def test_stop_words():
    assert len(set(STOP_WORDS)) == 134
    assert len([w for w in set(STOP_WORDS) if len(w) > 2]) == 108


def test_token_counts(books):
    rows = books("cat dog cat", "the", "dog", None)
    assert token_count(rows).first()[0] == 4
    assert sorted(map(tuple, tokens_per_document(rows).collect())) == [("b0", 3), ("b2", 1)]
    assert token_count(books("the")).first()[0] == 0


def counts_of(rows, text="value"):
    return {r["word"]: r["n"] for r in word_count(rows, text).collect()}


def test_word_count_tokens(books):
    assert counts_of(books("well-known 'tis don't"), "text") == {
        "wellknown": 1, "tis": 1, "don't": 1
    }
    assert counts_of(books("We're up\twe're UP\n\n''a'' ' 12 a1 café", None, ""), "text") == {
        "we're": 2, "up": 2, "a": 2, "caf": 1
    }


def test_word_count_keeps_vertical_tab_within_a_word(books):
    # it is white space to the first rule, but not a gap to the second
    assert counts_of(books("a\x0bb c"), "text") == {"a\x0bb": 1, "c": 1}


def test_word_count_does_not_depend_on_partitions(spark):
    lines = spark.range(500).select(
        F.concat_ws(" ", F.lit("all"), (F.col("id") % 7).cast("string"), F.hex("id")).alias("value")
    )
    assert counts_of(lines.repartition(1)) == counts_of(lines.repartition(13))


@pytest.mark.parametrize(
    "word",
    ["the", "and", "ours", "themselves", "would", "ought", "dare", "against", "further", "once",
     "nor", "too", "very", "just", "don", "now", "having", "because", "until", "herself"],
)
def test_a_stop_word_is_no_token(books, word):
    assert words_of(tokens(books(f"{word} {word.upper()} whale"))) == ["whale"]


@pytest.mark.parametrize(
    "word", ["one", "upon", "said", "like", "also", "never", "always", "many", "much", "whose", "get"]
)
def test_other_common_words_are_tokens(books, word):
    assert words_of(tokens(books(f"{word} the"))) == [word]


@pytest.mark.parametrize(
    "marker",
    [
        "*** START OF THIS PROJECT GUTENBERG",
        "*** START OF THE PROJECT GUTENBERG",
        "***START OF THIS PROJECT GUTENBERG",
        "***START OF THE PROJECT GUTENBERG",
    ],
)
def test_each_start_marker(books, marker):
    assert strip_boilerplate(books(f"head\n{marker} EBOOK\nbody")).first()["text"] == "body"


@pytest.mark.parametrize(
    "marker",
    [
        "*** END OF THIS PROJECT GUTENBERG",
        "*** END OF THE PROJECT GUTENBERG",
        "***END OF THIS PROJECT GUTENBERG",
        "***END OF THE PROJECT GUTENBERG",
        "End of the Project Gutenberg",
        "End of Project Gutenberg",
    ],
)
def test_each_end_marker(books, marker):
    assert strip_boilerplate(books(f"body\n{marker} EBOOK\nfoot")).first()["text"] == "body\n"
