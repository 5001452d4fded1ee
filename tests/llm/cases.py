"""Tables with every odd case, and small helpers."""

import random
import re

WORD = re.compile("[^\x20\x09-\x0d]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return WORD.findall(text or "")


def prose(seed, n_words, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n_words))


LONG = prose(7, 30_000)
ODD_TEXTS = [
    None,
    "",
    "  \n\t ",
    "one",
    "A few words",
    "A few words",
    "a FEW words",
    "\n\nline\nline\n\nline",
    "Ünïcödé ☃ 中文 😀 é",
    "1234 5678 !!!",
    LONG,
    LONG + " more",
]


def odd_documents(spark):
    """Nulls in every column, empty and very long texts, repeated rows, ties, and further
    columns whose names clash with those the operators use."""
    rows = [(i, t, "en" if i % 2 else None, "src", None, i, "x") for i, t in enumerate(ODD_TEXTS)]
    rows += [
        (None, "A few words", None, None, None, None, None),
        (None, None, "de", None, 3, None, None),
        (4, "A few words", "en", "src", None, 4, "x"),
        (4, "another text with the same number", "en", "src", 9, 4, "y"),
    ]
    names = "doc_id long, text string, lang string, source string, n_chars long, batch int, mark string"
    clashing = ", file string, `row` string, document string, digest string, score string, length int"
    filled = [(*r, "f", "r", None, "d", "s", 7) for r in rows]
    return spark.createDataFrame(filled, names + clashing)


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
