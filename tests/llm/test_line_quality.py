import itertools
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from corpuslens.llm import line_quality as Q
from corpuslens.llm import line_tasks as tasks
from tests.llm.cases import documents, no_documents, odd_documents, prose, words


def base(text):
    text = text or ""
    w = words(text)
    triples = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if triples[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    return (
        len(w),
        sum(map(len, w)),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
        len(w) < 50 or 100 * len(covered) > 50 * len(w),
    )


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
BLANK = (np.zeros((tasks.N_FEATURES, 2)), np.zeros((2, 2)))


def test_base_rules(spark):
    rng = random.Random(2)
    texts = [
        "".join(rng.choice(["a", "b", "é ", " ", "\n", "c#", "x x x ", "line\n", "\t", "😀"]) for _ in range(rng.randrange(80)))
        for _ in range(400)
    ]
    docs = odd_documents(spark).select("doc_id", "text").union(documents(spark, [(100 + i, t) for i, t in enumerate(texts)]))
    rows = Q.judge(docs, BLANK).collect()
    for r in rows:
        assert tuple(r.quality[n] for n in NAMES) == base(r.text), r.text
        assert r.quality.kept == (not r.quality.base_failed)
    assert Q.judge(no_documents(spark), BLANK).count() == 0


def test_slices_change_nothing(monkeypatch):
    texts = pa.array([prose(i, i % 90, 30).replace("w1", "\n") for i in range(200)] + [None, ""])
    rng = np.random.default_rng(1)
    model = (rng.normal(size=(tasks.N_FEATURES, 2)), rng.normal(size=(2, 2)))
    whole = tasks.judged(texts, model, 0.5)
    monkeypatch.setattr(tasks, "SLICE_BYTES", 300)
    assert tasks.judged(texts, model, 0.5).equals(whole)


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(0)
    lengths = [1, 4, 0, 3, 6]
    documents_ = np.repeat(np.arange(5), lengths)
    features = rng.integers(0, tasks.N_FEATURES, (sum(lengths), 3))
    weights, transitions = rng.normal(size=(tasks.N_FEATURES, 2)), rng.normal(size=(2, 2))
    label = tasks.viterbi(features, documents_, 5, weights, transitions)
    for d in range(5):
        own = weights[features[documents_ == d]].sum(1)

        def value(path, own=own):
            return sum(own[i, y] for i, y in enumerate(path)) + sum(transitions[a, b] for a, b in itertools.pairwise(path))

        found = label[documents_ == d]
        best = max(map(value, itertools.product((0, 1), repeat=len(own))))
        assert value(found) == pytest.approx(best)


def test_fit_climbs_the_likelihood():
    """The labels' likelihood by enumeration is larger than at nearby weights."""
    rng = np.random.default_rng(4)
    sequences = [rng.integers(0, 6, (n, 2)) for n in (1, 2, 3, 4, 2, 3)]
    labels = [0, 1, 0, 1, 0, 1]

    def value(weights, transitions):
        n = np.bincount(np.repeat(labels, [len(s) for s in sequences]))
        total = 0.0
        for s, y in zip(sequences, labels, strict=True):
            own = weights[s].sum(1)

            def path(p, own=own):
                return sum(own[i, x] for i, x in enumerate(p)) + sum(transitions[a, b] for a, b in itertools.pairwise(p))

            every = [path(p) for p in itertools.product((0, 1), repeat=len(s))]
            total += (path([y] * len(s)) - np.logaddexp.reduce(every)) * n.sum() / (2 * n[y])
        return total / n.sum() - 0.005 * ((weights**2).sum() + (transitions**2).sum())

    fitted = tasks.fit(sequences, labels, passes=3000, penalty=0.01, rate=0.02)
    best = value(*fitted)
    for _ in range(50):
        moved = [x + rng.normal(scale=0.05, size=x.shape) for x in fitted]
        moved[0][6:] = fitted[0][6:]
        assert value(*moved) <= best + 1e-4


def test_verdicts_follow_the_labels(spark):
    directory = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{directory}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{directory}/labels.parquet").withColumnRenamed("quality", "good")
    model = Q.train(docs.filter("doc_id % 2 = 0"), labels.withColumnRenamed("good", "quality"))
    rows = Q.judge(docs.filter("doc_id % 2 = 1"), model).join(labels, "doc_id").collect()
    passed = [(r.good, r.quality.kept) for r in rows if not r.quality.base_failed]
    assert sum(good == kept for good, kept in passed) >= 0.97 * len(passed)


def test_without_labels_of_both_qualities(spark):
    docs = documents(spark, [(1, prose(1, 80)), (2, prose(2, 80))])
    labels = spark.createDataFrame([(1, 1), (None, 0), (9, 0), (2, None)], "doc_id long, quality int")
    weights, transitions = Q.train(docs, labels)
    assert not weights.any() and not transitions.any()
