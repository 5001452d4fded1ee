import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from corpuslens.llm import bpe_tasks, packing
from corpuslens.llm import packing_tasks as tasks
from tests.llm.cases import no_documents, odd_documents
from tests.llm.test_bpe import strange_texts

PATH = public_tokenizers.path(packing.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, encoding="utf-8") as source:
        return bpe_tasks.Vocabulary(source.read())


def put_together(batches):
    ids = defaultdict(list)
    for batch in batches:
        for row in batch.to_pylist():
            assert row["start"] == len(ids[row["i"]])
            found = np.frombuffer(row["ids"], "<u4").tolist()
            assert len(found) == row["length"]
            ids[row["i"]] += found
    return ids


@pytest.mark.parametrize("kept", [1 << 19, 3])
def test_ids_are_the_librarys(library, vocabulary, monkeypatch, kept):
    monkeypatch.setattr(tasks, "MOST_KEPT", kept)
    monkeypatch.setattr(tasks, "SLICE_BYTES", 20_000)
    texts = strange_texts(3000) + [None, "Σ ΑΣ σΣ", "Ǻ é"]
    batch = pa.record_batch({"i": list(range(len(texts))), "text": pa.array(texts)})
    found = put_together(tasks.pieces([batch], vocabulary, 50, 1))
    wanted = library.encode_batch([t or "" for t in texts], add_special_tokens=False)
    for i, want in enumerate(wanted):
        assert found[i] == [*want.ids, 1], texts[i]


def test_fullest_combination_against_enumeration():
    rng = random.Random(2)
    for _ in range(300):
        available = sorted(((rng.randrange(1, 20), rng.randrange(1, 4)) for _ in range(4)), reverse=True)
        available = [(x, c) for x, c in dict(available).items()]
        room = rng.randrange(0, 60)
        chosen = tasks.fullest(room, available)
        assert all(k <= dict(available)[x] for x, k in chosen.items())
        sums = [
            sum(k * x for k, (x, _) in zip(times, available, strict=True))
            for times in itertools.product(*(range(c + 1) for _, c in available))
        ]
        assert sum(k * x for x, k in chosen.items()) == max(s for s in sums if s <= room)


def checked(histogram, capacity):
    bins = defaultdict(list)
    seen = defaultdict(list)
    for length, first, last, per_bin, start, offset in tasks.plan(histogram, capacity):
        seen[length] += range(first, last)
        for rank in range(first, last):
            turn = rank - first
            bins[start + turn // per_bin].append((offset + turn % per_bin * length, length))
    assert {x: sorted(r) for x, r in seen.items()} == {x: list(range(c)) for x, c in histogram.items()}
    for content in bins.values():
        end = 0
        for offset, length in sorted(content):
            assert offset == end
            end += length
        assert end <= capacity
    assert sorted(bins) == list(range(len(bins)))
    return len(bins)


def test_plan_is_whole_and_tight():
    rng = random.Random(3)
    for _ in range(40):
        histogram = Counter(min(64, int(rng.paretovariate(1.1) * 4)) for _ in range(400))
        least = -(-sum(x * c for x, c in histogram.items()) // 64)
        assert least <= checked(histogram, 64) <= least * 1.03 + 1
    assert checked({}, 64) == 0
    assert checked({64: 3, 33: 5, 1: 1}, 64) == 8


def test_work_does_not_grow_with_the_counts():
    histogram = {x: 3 + x % 5 for x in range(1, 300)}
    few = tasks.plan(histogram, 512)
    many = tasks.plan({x: c * 10**6 for x, c in histogram.items()}, 512)
    assert len(many) < 3 * len(few)


def test_odd_cases(spark, library, tmp_path):
    docs = odd_documents(spark)
    rows = packing.pack_documents(docs, PATH).collect()
    want = []
    for r in docs.collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 1]
        for k, start in enumerate(range(0, len(ids), packing.CAPACITY)):
            part = ids[start : start + packing.CAPACITY]
            want.append((r.doc_id, k, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted(map(str, want)) == sorted(str(tuple(r)[:5]) for r in rows)
    placed = defaultdict(list)
    for r in rows:
        placed[r.sequence_id].append((r.offset, r.length))
    for content in placed.values():
        ends = list(itertools.accumulate(x for _, x in sorted(content)))
        assert [o for o, _ in sorted(content)] == [0, *ends[:-1]]
        assert ends[-1] <= packing.CAPACITY
    assert len(placed) == -(-sum(r.length for r in rows) // packing.CAPACITY)
    assert packing.pack_documents(no_documents(spark), PATH).count() == 0


def test_pieces_of_one_length(spark):
    rows = spark.range(5000).selectExpr("id % 7 AS doc_id", "0L AS text_hash", "0 AS piece", "10L AS length", "id AS rank_")
    found = packing.pack(rows, 64).collect()
    assert len({(r.sequence_id, r.offset) for r in found}) == 5000
    assert len({r.sequence_id for r in found}) == -(-5000 // 6)
    assert sorted(r.rank_ for r in found) == list(range(5000))
