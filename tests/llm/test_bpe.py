import random

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpuslens.llm import bpe
from corpuslens.llm import bpe_tasks as tasks
from tests.llm.cases import no_documents, odd_documents

PATH = public_tokenizers.path(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, encoding="utf-8") as source:
        return tasks.Vocabulary(source.read())


def strange_texts(n):
    rng = random.Random(1)
    alphabet = "abcXYZ  '\n\t.,!?0123456789éèßΣσς　  \xa0\x85\x1c\x1f​中文字🙂🙂́²½Ⅷ़्_-İ"
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(n)]
    special = ["<|endoftext|>", "<|startoftext|>", "<|endof", "|>", "it's WE'VE", " \n \n", "x" * 3000, "ab" * 1500]
    return texts + special + ["".join(rng.choices([*special[:6], "a", " "], k=6)) for _ in range(200)]


def test_ids_are_the_librarys(library, vocabulary):
    encoder = tasks.Encoder(vocabulary)
    texts = strange_texts(5000)
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert list(encoder.ids(text)) == want.ids, text


def test_the_queue_merges_by_rank_then_place():
    """Against looking for the first pair of lowest rank, over and over."""
    rng = random.Random(5)
    pairs = [(a, b) for a in range(6) for b in range(6)]
    rng.shuffle(pairs)
    merges, result = {}, []
    for rank, (a, b) in enumerate(pairs[:20]):
        merges[a << 20 | b] = rank
        result.append(rank % 7)
    for _ in range(2000):
        symbols = [rng.randrange(6) for _ in range(rng.randrange(1, 15))]
        want = list(symbols)
        # ``result`` may make symbols that merge again at a lower rank, unlike a real vocabulary.
        while True:
            found = [(merges[a << 20 | b], i) for i, (a, b) in enumerate(zip(want, want[1:], strict=False)) if a << 20 | b in merges]
            if not found:
                break
            rank, i = min(found)
            want[i : i + 2] = [result[rank]]
        assert tasks.merged(list(symbols), merges, result) == want


def test_decoding_gives_the_librarys_text(spark, library):
    vocabulary = bpe.read_vocabulary(spark.sparkContext, PATH)
    docs = odd_documents(spark)
    rows = bpe.decode(bpe.encode(docs, vocabulary), vocabulary).collect()
    texts = [r.text or "" for r in docs.collect()]
    assert sorted(r.decoded for r in rows) == sorted(texts)
    by_text = {r.decoded: r.ids for r in rows}
    for text in texts:
        assert by_text[text] == library.encode(text, add_special_tokens=False).ids
    cut = spark.createDataFrame([(1, [162]), (2, [447, 50256, 224]), (3, [])], "doc_id long, ids array<int>")
    for r in bpe.decode(cut, vocabulary).collect():
        assert r.decoded == library.decode(r.ids, skip_special_tokens=False)
    assert bpe.encode(no_documents(spark), vocabulary).count() == 0


def test_texts_of_a_batch_are_cut_without_moving_a_border(library, vocabulary, monkeypatch):
    """White space of all kinds behind and before letters, signs and special tokens."""
    marks = ["a", "é", "中", "🙂", "%", "'s", "<|endoftext|>", " ", "\n", "\xa0", "\x85", "\u1680", "\u2003", "\u2028", "\u205f", "\u3000", "Ġ"]
    texts = [None, "", *(a + b + c + "x" for a in marks for b in marks for c in marks), " ", ""]
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    want = library.encode_batch([t or "" for t in texts], add_special_tokens=False)
    for most_bytes in (tasks.SLICE_BYTES, 1000):
        monkeypatch.setattr(tasks, "SLICE_BYTES", most_bytes)
        found = pa.Table.from_batches(tasks.encoded([batch], vocabulary))
        assert found["ids"].to_pylist() == [w.ids for w in want]
        assert found["doc_id"].to_pylist() == list(range(len(texts)))


def test_each_different_run_of_a_batch_is_split_once(vocabulary, monkeypatch):
    split = []
    parts = tasks.Encoder.parts
    monkeypatch.setattr(tasks.Encoder, "parts", lambda self, cut: split.append(cut) or parts(self, cut))
    texts = pa.array(["one two, 3 two,"] * 1000 + ["two, one"])
    batch = pa.record_batch({"doc_id": pa.array(range(1001), pa.int64()), "text": texts})
    list(tasks.encoded([batch], vocabulary))
    assert sorted(split) == [" 3", " one", " two,", "one", "two,"]


def test_memory_of_words_is_bounded(vocabulary, monkeypatch):
    texts = strange_texts(300)
    whole = [list(tasks.Encoder(vocabulary).ids(t)) for t in texts]
    monkeypatch.setattr(tasks, "MOST_KEPT", 5)
    encoder = tasks.Encoder(vocabulary)
    assert [list(encoder.ids(t)) for t in texts] == whole
    assert len(encoder.words) <= 5 and len(encoder.cuts) <= 5


def test_query(spark, library):
    import hashlib

    directory = "/root/testdata/sf0.001"
    found = {r.doc_id: r for r in bpe.query(spark, directory).collect()}
    for r in spark.read.parquet(f"{directory}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        decoded = hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        assert tuple(found[r.doc_id]) == (r.doc_id, len(ids), digest, decoded)
