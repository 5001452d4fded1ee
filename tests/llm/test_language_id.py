import zlib

import numpy as np
import pyarrow as pa
import pytest

from corpuslens.llm import language_id as L
from corpuslens.llm import language_tasks as tasks
from tests.llm.cases import no_documents, odd_documents


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = L.query(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 200
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def brute_grams(text):
    data = bytearray(b"  ")
    for b in text.encode():
        lower = b + 32 if 65 <= b <= 90 else b
        data.append(lower if 97 <= lower <= 122 or b >= 128 else 0x20)
    data += b"  "
    found = [bytes(data[i : i + 4]) for i in range(len(data) - 3)]
    return [g for g in found if g[2:] != b"  " and g[:3] != b"   "]


def test_grams():
    texts = ["", "a", "Ab c", "  ", "é1x", "one\ntwo  three"]
    data = "".join(texts).encode()
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    found, bounds = tasks.grams(np.frombuffer(data, np.uint8), offsets)
    for i, text in enumerate(texts):
        assert [int(g).to_bytes(4, "big") for g in found[bounds[i] : bounds[i + 1]]] == brute_grams(text)


def test_a_mask_has_every_language_that_lists_a_gram():
    rng = np.random.default_rng(0)
    langs = [f"l{i:02}" for i in range(70)]  # two words of 64 bits
    lang = rng.integers(0, 70, 20_000)
    gram = rng.integers(0, 2**32, 20_000)
    _, slices, wrong = tasks.build(langs, *tasks.masks(lang, gram, 16), 16)
    one, two = tasks.places(gram, 16)
    mask = slices[lang >> 6, one] & slices[lang >> 6, two]
    assert (mask >> (lang & 63).astype(np.uint64) & np.uint64(1)).all()
    other = rng.integers(0, 2**32, 200_000)
    one, two = tasks.places(other, 16)
    for i in (0, 69):
        hits = (slices[i >> 6, one] & slices[i >> 6, two]) >> np.uint64(i & 63) & np.uint64(1)
        assert hits.mean() == pytest.approx(wrong[i], abs=2e-4)


def test_odd_cases(spark):
    docs = odd_documents(spark)
    training = spark.createDataFrame([("the words of this", "en"), ("die Worte", "de"), (None, "fr"), ("x", None)], "text string, lang string")
    found = L.predict(docs, training)
    assert sorted(found.columns) == sorted([*docs.columns, "lang_pred"])
    for r in found.collect():
        letter = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letter)
        assert r.lang_pred in ("und", "en", "de")
    assert L.predict(no_documents(spark), training).count() == 0
    assert {r.lang_pred for r in L.predict(docs, training.limit(0)).collect()} == {"und"}


def test_documents_in_no_known_language_go(spark):
    docs = odd_documents(spark)
    kept = L.in_known_language(docs)
    assert kept.columns == docs.columns
    learned = [r for r in docs.collect() if r.lang is not None and r.text is not None]
    learned = [r for r in learned if r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    known = {g for r in learned for g in brute_grams(r.text)}
    want = [r.text for r in docs.collect() if any(c.isalpha() for c in r.text or "") and known & set(brute_grams(r.text))]
    assert sorted(r.text for r in kept.collect()) == sorted(want)
    assert "another text with the same number" in want


def test_a_script_that_was_not_learned_goes(spark):
    rows = [(i, "the words of this text are plain", "en") for i in range(8)]
    rows += [(8, "\u4e2d\u6587\u6587\u672c\u6ca1\u6709\u5b66\u8fc7", None), (9, "words of a text", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in L.in_known_language(docs).collect()) == [*range(8), 9]


def test_lists_grow_with_the_texts_and_the_filter_is_bounded():
    assert [L.filter_bits(n) for n in (0, 1, 2**15, 2**15 + 1, 2**16 + 1, 10**9)] == [20, 20, 20, 21, 22, 22]


def test_partial_counts_stay_bounded(monkeypatch):
    def counted():
        total = {}
        for batch in tasks.count_grams(iter([texts, texts])):
            for row in batch.to_pylist():
                key = row["lang"], row["gram"]
                total[key] = total.get(key, 0) + row["n"]
        return total

    texts = pa.record_batch({"lang": ["a", "b"] * 50, "text": [f"word{i} und{i * 3}" for i in range(100)]})
    whole = counted()
    monkeypatch.setattr(tasks, "MOST_KEYS", 100)
    monkeypatch.setattr(tasks, "SLICE_BYTES", 200)
    assert counted() == whole


def brute_places(gram, bits):
    """The two places of a gram: 64-bit finaliser of MurmurHash3, in plain integers."""
    h = (int.from_bytes(gram, "big") + 0x9E3779B97F4A7C15) % 2**64
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h = (h ^ h >> 33) * factor % 2**64
    h ^= h >> 33
    return h % 2**bits, (h >> 32) % 2**bits


def brute_predictions(texts, training, share, bits):
    counts = {}
    for text, lang in training:
        if text is not None and lang is not None:
            for g in brute_grams(text):
                own = counts.setdefault(lang, {})
                own[g] = own.get(g, 0) + 1
    rates = {lang: {g: n / sum(own.values()) for g, n in own.items()} for lang, own in counts.items()}
    filters = {}
    for lang, own in rates.items():
        listed = [g for g, rate in own.items() if rate * share >= max(r.get(g, 0) for r in rates.values())]
        places = {p for g in listed for p in brute_places(g, bits)}
        if places:  # a language that lists nothing is not learned
            filters[lang] = places, (len(places) / 2**bits) ** 2
    out = []
    for text in texts:
        if not filters or not any(c.isalpha() for c in text or ""):
            out.append(("und", 0.0))
            continue
        grams = brute_grams(text)
        shares = {}
        for lang, (places, wrong) in filters.items():
            hits = sum(all(p in places for p in brute_places(g, bits)) for g in grams)
            shares[lang] = (hits / len(grams) - wrong) / max(1e-9, 1 - wrong)
        best = min(shares, key=lambda lang: (-shares[lang], lang))
        out.append((best, min(1.0, max(0.0, shares[best]))))
    return out


@pytest.mark.parametrize("share, bits", [(16, 20), (2, 10), (1, 7)])
def test_predictions_against_brute_force(spark, share, bits):
    """Also with filters so small that false positives are many and must be corrected."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text", "lang").limit(60).collect()
    training = [(r.text, r.lang) for r in rows[:40]] + [(None, "fr"), ("x", None), ("", "de")]
    texts = [r.text for r in rows[40:]] + [" ".join((r.text or "").split()[:2]) for r in rows[:20]] + [None, "", "12 !", "é", "a"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = L.predict(docs, spark.createDataFrame(training, "text string, lang string"), share, bits)
    expected = brute_predictions(texts, training, share, bits)
    for r in found.collect():
        name, score = expected[r.doc_id]
        assert r.lang_pred == name
        assert r.score == pytest.approx(score, abs=1e-9)
