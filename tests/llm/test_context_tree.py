import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuslens.llm import context_tree as C
from corpuslens.llm import context_tree_tasks as tasks
from tests.llm.cases import lowered, no_documents, odd_documents, words

DEPTH = 3


def log_kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)


class Brute:
    """The model by recursion over one binary decision and one context at a time."""

    def __init__(self, texts, mass_bits):
        self.after = Counter()
        for text in texts:
            frame = b"\xff" * DEPTH + text + b"\xff"
            for i in range(DEPTH, len(frame)):
                for d in range(DEPTH + 1):
                    self.after[frame[i - d : i], frame[i]] += 1
        held = Counter()
        for (context, _), n in self.after.items():
            held[context] += n
        self.kept = {c for c, n in held.items() if n << mass_bits >= held[b""]} | {b""}

    def counts(self, context, prefix):
        """Zeros and ones after the bits ``prefix``, in this context."""
        found = [0, 0]
        for byte in range(256):
            bits = f"{byte:08b}"
            if bits.startswith(prefix):
                found[int(bits[len(prefix)])] += self.after[context, byte]
        return found

    def rest(self, context, prefix):
        a, b = self.counts(context, prefix)
        for child in self.children(context):
            x, y = self.counts(child, prefix)
            a, b = a - x, b - y
        return a, b

    def children(self, context):
        return [bytes([x]) + context for x in range(256) if bytes([x]) + context in self.kept and len(context) < DEPTH]

    def weighted(self, context, prefix):
        own = log_kt(*self.counts(context, prefix))
        children = self.children(context)
        if not children:
            return own
        split = sum(self.weighted(c, prefix) for c in children) + log_kt(*self.rest(context, prefix))
        return float(np.logaddexp(own, split)) - math.log(2)

    def chance_of_one(self, context, past, prefix):
        a, b = self.counts(context, prefix)
        own = (b + 0.5) / (a + b + 1)
        if not self.children(context):
            return own
        share = math.exp(log_kt(a, b) - math.log(2) - self.weighted(context, prefix))
        child = past[len(past) - len(context) - 1 :]
        if child in self.kept:
            return share * own + (1 - share) * self.chance_of_one(child, past, prefix)
        x, y = self.rest(context, prefix)
        return share * own + (1 - share) * (y + 0.5) / (x + y + 1)

    def score(self, text):
        frame, total = b"\xff" * DEPTH + text + b"\xff", 0.0
        for i in range(DEPTH, len(frame)):
            bits = f"{frame[i]:08b}"
            for k in range(8):
                one = self.chance_of_one(b"", frame[i - DEPTH : i], bits[:k])
                total += math.log10(one if bits[k] == "1" else 1 - one)
        return total


@pytest.mark.parametrize("mass_bits", [4, 20])
def test_scores_against_recursion(spark, mass_bits):
    texts = ["abab abac", "the cat", "THE hat", "", "é"]
    rows = [(i, t, i == 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")
    brute = Brute([lowered(t).encode() for i, t, out in rows if not out], mass_bits)
    for r in C.score(docs, DEPTH, mass_bits).collect():
        assert r.score == pytest.approx(brute.score(lowered(texts[r.doc_id]).encode()), rel=1e-5)


def test_probabilities_add_up():
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 50, (3, 256)).astype(float)
    levels = [
        (np.zeros(1, np.int64), counts.sum(0, keepdims=True) + 5),
        (np.array([5, 9, 200]), counts),
        (np.array([5 + 256 * 7]), counts[:1] // 2),
    ]
    child, log_p = tasks.weigh(levels)
    assert child.shape == log_p.shape == (5, 256)
    assert child[0, 9] == 2 and child[1, 7] == 4
    assert np.allclose((10.0**log_p).sum(1), 1, atol=1e-4)


def test_base_score_and_odd_cases(spark):
    docs = odd_documents(spark).withColumn("held_out", C.held_out(F.col("doc_id")))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    count = Counter()
    for (_, t), o in zip(rows, out, strict=True):
        if not o:
            count.update([*words(lowered(t)), "\n"])
    total = sum(count.values())

    def base(text):
        tokens = [*words(lowered(text)), "\n"]
        known = sum(w in count for w in tokens)
        score = sum(math.log10((count[w] + 1) / (total + len(count) + 1)) for w in tokens)
        return len(tokens), known, round(score, 5)

    want = sorted(((i, o, *base(t)) for (i, t), o in zip(rows, out, strict=True)), key=str)
    found = C.score(docs).collect()
    assert {r.train_tokens for r in found} == {total}
    assert want == sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 5)) for r in found), key=str)


def test_without_documents_or_training(spark):
    empty = no_documents(spark).withColumn("held_out", F.lit(False))
    assert C.score(empty).count() == 0
    docs = spark.createDataFrame([(1, "ab", True)], "doc_id long, text string, held_out boolean")
    r = C.score(docs).first()
    assert r.score == pytest.approx(-24 * math.log10(2))
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (2, 0, 0, 0)


def test_partial_counts_stay_bounded(spark, monkeypatch):
    import pyarrow as pa

    batches = [pa.record_batch({"text": pa.array([f"text {i} {i * 7}" for i in range(2000)])})] * 2
    whole = Counter()
    for batch in tasks.count_grams(iter(batches), 3):
        for key, n in zip(batch["key"].to_pylist(), batch["n"].to_pylist(), strict=True):
            whole[key] += n
    monkeypatch.setattr(tasks, "MOST_KEYS", 500)
    monkeypatch.setattr(tasks, "SLICE_BYTES", 2000)
    parts = Counter()
    for batch in tasks.count_grams(iter(batches), 3):
        for key, n in zip(batch["key"].to_pylist(), batch["n"].to_pylist(), strict=True):
            parts[key] += n
    assert parts == whole


def test_every_context_of_a_large_corpus_counts(spark):
    """One context among more than 32,768 bytes still tells what follows it."""
    rows = [(i, "xy" * 1000, False) for i in range(40)] + [(40, "qwertz", False), (41, "qwertz", True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean").repartition(3)
    brute = Brute([t.encode() for _, t, out in rows if not out], 60)
    found = {r.doc_id: r.score for r in C.score(docs, DEPTH).collect()}
    assert len(found) == 42
    assert found[41] == found[40] == pytest.approx(brute.score(b"qwertz"), rel=1e-5)


@pytest.mark.parametrize("depth", [1, 2, 4, 5])
def test_parts_against_one_place(monkeypatch, depth):
    import pyarrow as pa

    monkeypatch.setattr(tasks, "PART_GRAMS", 50)
    rng = np.random.default_rng(depth)
    texts = ["".join(rng.choice(list("abc é"), 200)) for _ in range(5)]
    key, n = zip(*[(k, c) for b in tasks.count_grams([pa.record_batch({"text": texts})], depth) for k, c in zip(b["key"].to_pylist(), b["n"].to_pylist(), strict=True)])
    key, n = np.array(key), np.array(n)
    levels = []
    for d in range(depth + 1):
        context = key >> 8 & (1 << 8 * d) - 1
        known, place = np.unique(context, return_inverse=True)
        counts = np.zeros((len(known), 256))
        np.add.at(counts, (place, key & 255), n)
        levels.append((known, counts))
    child, log_p = tasks.weigh(levels)
    new = np.array([int.from_bytes(b"zzzzza"[-depth - 1 :], "big"), int.from_bytes(b"zzzcab"[-depth - 1 :], "big")])
    new = np.setdiff1d(new, key)
    asked = np.concatenate([key, new])
    table = pa.table({"key": tasks.turned(asked, depth), "n": np.concatenate([n, np.zeros(len(new), np.int64)])})
    told = tasks.told_up(table, depth, 1).group_by(["kind", "key"]).aggregate([("value", "sum")])
    told = told.rename_columns(["kind", "key", "value"])
    model = tasks.top(told, depth, 1)
    found = tasks.told_down(table, model, depth, 1, 7)
    assert sorted(found["key"].to_pylist()) == sorted(asked.tolist())
    for k, p in zip(found["key"].to_pylist(), found["log_p"].to_pylist(), strict=True):
        node = 0
        for i in range(1, depth + 1):
            below = child[node, k >> 8 * i & 255]
            if not below:
                break
            node = below
        assert p == pytest.approx(log_p[node, k & 255], rel=1e-4)
