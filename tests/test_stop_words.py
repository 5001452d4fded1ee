import random

import pytest

from corpuslens.functions.patterns import STOP_WORDS
from corpuslens.operators import stop_words as S
from corpuslens.operators import term_weights as T


@pytest.fixture
def corpus(books):
    rng = random.Random(2)
    words = ["the", "and", "cat", "dog", "bird", "fish", "hadn"] + [f"w{chr(97 + i)}x" for i in range(20)]
    return books(*[" ".join(rng.choice(words[: 3 + i % 24]) for _ in range(60)) for i in range(40)], None, "", "the the")


def rows(frame):
    return sorted(map(tuple, frame.collect()))


@pytest.mark.parametrize("most_bytes", [0, S.MOST_BYTES])
def test_a_list_of_any_size_gives_the_same(spark, corpus, small, monkeypatch, most_bytes):
    monkeypatch.setattr(S.without_stop_words, "__defaults__", (most_bytes,))
    usual = S.usual_stop_words(spark)
    assert usual.count() == len(set(STOP_WORDS))
    assert rows(T.tokens(corpus, stop_words=usual)) == rows(T.tokens(corpus))
    own = [("cat",), (None,), ("dog",), ("dog",), ("unseen",)]
    listed = spark.createDataFrame(own, "word string")
    every = rows(T.tokens(corpus, stop_words=listed.limit(0)))
    assert ("b0", "the") in every
    assert rows(T.tokens(corpus, stop_words=listed)) == [r for r in every if r[1] not in ("cat", "dog")]


def test_no_list_stands_in_the_plan_and_size_decides(spark, corpus, monkeypatch):
    plans = []
    for most_bytes in (0, S.MOST_BYTES):
        monkeypatch.setattr(S.without_stop_words, "__defaults__", (most_bytes,))
        plans.append(T.tokens(corpus, stop_words=S.usual_stop_words(spark))._jdf.queryExecution().toString())
    assert not any("INSET" in p or " IN (" in p for p in plans)
    assert plans[1].count("Exchange hashpartitioning") < plans[0].count("Exchange hashpartitioning")
    assert "BroadcastHashJoin" in plans[1] and "LeftAnti" in plans[1]
