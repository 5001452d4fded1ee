import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from corpuslens.llm import batches, phrase_tasks
from corpuslens.llm import phrase_mining as P
from tests.llm.cases import lowered, no_documents, odd_documents


def brute(rows, least, most=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(text)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    longer = defaultdict(int)
    for (lang, *w), a in candidates.items():
        if len(w) == 3:
            for part in (w[:2], w[1:]):
                longer[(lang, *part)] = max(longer[(lang, *part)], a)
    found = defaultdict(list)
    for (lang, *w), a in candidates.items():
        if len(w) == 2 and 100 * longer[(lang, *w)] >= 50 * a and longer[(lang, *w)]:
            continue
        cuts = [(10**6 * a * a // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        found[lang].append((-score, -a, " ".join(w).encode(), f[(lang, *w[:k])], f[(lang, *w[k:])]))
    rows = []
    for lang, of_lang in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(of_lang)[:most], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(rows)


def mined(frame):
    return sorted(map(tuple, frame.collect()))


def texts(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string")


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["a", "A", "b", "c", "x!", "ü", "\x01", "a\x00", "b-c", "名", "😀"]
    gaps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n"]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(120)))
        rows.append((rng.choice(["en", "de", "und", None]), text))
    return rows


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(P, "BATCH_BYTES", 1 << 9)
    monkeypatch.setattr(batches, "LEAST_BUCKET", 1)
    monkeypatch.setattr(phrase_tasks, "SLICE_BYTES", 1 << 8)


@pytest.mark.parametrize("least, most", [(10, 2000), (3, 5)])
def test_brute_force(spark, small, least, most):
    rows = corpus(least, 90)
    expected = brute(rows, least, most)
    assert len(expected) > 4 * most * (most < 100) / 2
    assert mined(P.mine(texts(spark, rows), least, most)) == expected


def test_a_word_with_a_third_of_all_phrases(spark, small):
    rng = random.Random(5)
    rows = [("en", " ".join(f"the w{rng.randrange(300)}" for _ in range(40))) for _ in range(120)]
    rows += [("en", "one two three " * 30)] * 40
    assert mined(P.mine(texts(spark, rows), 5)) == brute(rows, 5)


def test_odd_cases(spark):
    docs = odd_documents(spark)
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert mined(P.mine(docs)) == brute(rows, 10)
    assert mined(P.mine(docs, 2)) == brute(rows, 2)
    assert P.mine(no_documents(spark)).count() == 0


def test_products_beyond_64_bits(spark):
    n, left, right = 9 * 10**12, 9 * 10**13, 8 * 10**13
    row = [("en", "a", "b", None, n, left, None, right, None, 0)]
    names = "lang string, w1 string, w2 string, w3 string, n long, left_1 long, left_2 long, right_1 long, right_2 long, longest long"
    assert P.scored(spark.createDataFrame(row, names)).first()["score"] == 10**6 * n * n // (left * right)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_lockstep_over_batches_and_ranges(size):
    """Cut anywhere, a stream gives the counts of the parts, but for those that went by before."""
    rng = random.Random(size)
    f = Counter()
    for _ in range(3000):
        w = [rng.choice("abcd") for _ in range(3)]
        for k in (1, 2, 3):
            f[tuple(w[:k])] += 1
    rows = sorted(f.items(), key=lambda r: r[0])
    columns = [[w[i] if i < len(w) else None for w, _ in rows] for i in range(3)]
    table = pa.table({"lang": ["en"] * len(rows), "k1": columns[0], "k2": columns[1], "k3": columns[2], "n": [n for _, n in rows]})
    for first in (0, 5, 17):
        stream = table.slice(first).to_batches(max_chunksize=size)
        out = pa.Table.from_batches(list(phrase_tasks.lockstep(iter(stream)))).to_pylist()
        whole = [r for r in out if r["n"] is not None]
        assert len(whole) == len(rows) - first
        seen = {w for w, _ in rows[first:]}
        for r in whole:
            w = tuple(x for x in (r["k1"], r["k2"], r["k3"]) if x)
            assert r["n"] == f[w]
            for k in (1, 2):
                assert r[f"near_{k}"] == (f[w[:k]] if k < len(w) and w[:k] in seen else None)
            if len(w) == 2:
                assert r["longest"] == max([n for x, n in rows if len(x) == 3 and x[:2] == w], default=0)
        cut = rows[first][0]
        assert len(out) - len(whole) == (len(cut) == 3)


def test_buckets_are_ranges_of_keys():
    table = pa.table({"batch": pa.array([3, 3], pa.int32()), "text": ["a b c. a b", None], "lang": ["en", None]})
    found = phrase_tasks.requests(table, 40, 5)
    for bucket, keys in zip(found["bucket"].to_pylist(), found["keys"].to_pylist(), strict=True):
        keys = phrase_tasks._unpacked(keys)
        assert ((keys * np.uint64(5)) >> np.uint64(40) == bucket).all()
    n = sum(phrase_tasks.T.from_planes(c, np.uint32).sum() for c in found["counts"].to_pylist())
    assert n == 5 + 3 + 1
