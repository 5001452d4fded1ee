"""Byte-pair encoding inside tasks. Nothing here knows Spark."""

import json
import re
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex

from corpuslens.llm import text_tasks as T

# White space by Unicode, and the pattern that splits a text before byte-level
# encoding. The texts of a batch are first cut where white space begins, which never moves a
# border of the pattern, so each different cut is split and encoded once.
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPLIT = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
WIDE_SPACES = {  # beyond ASCII, by their bytes in UTF-8
    n: [int.from_bytes(c.encode()) for c in map(chr, range(0x80, 0x3001)) if regex.match(f"[{SPACE}]", c) and len(c.encode()) == n]
    for n in (2, 3)
}
SLICE_BYTES = 2 << 20
MOST_KEPT = 1 << 19  # words, and as many cuts, whose ids a task remembers at a time,
MOST_BYTES = 16 << 20  # characters of all cuts,
LONGEST_KEPT = 64  # and of a word


def byte_characters():
    """The character that stands for each byte in a byte-level vocabulary: the printable ones
    of Latin-1 for themselves, the rest by U+0100 and up, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(0x100 + i) for i, b in enumerate(others)}


class Vocabulary:
    """Symbols, merges and special tokens of a tokenizer's JSON."""

    def __init__(self, source: str):
        content = json.loads(source)
        model = content["model"]
        vocab = model["vocab"]
        character = byte_characters()
        suffix = model.get("end_of_word_suffix") or ""
        self.symbol = [vocab[character[b]] for b in range(256)]
        self.last_symbol = [vocab[character[b] + suffix] for b in range(256)]
        self.merges, self.result = {}, []
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.merges[vocab[left] << 20 | vocab[right]] = rank
            self.result.append(vocab[left + right])
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        byte = {c: b for b, c in character.items()}
        self.bytes = {
            i: bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
            for token, i in vocab.items()
        } | {i: token.encode() for token, i in self.special.items()}


def merged(symbols, merges, result, ranks=None, queue=None):
    """Apply the merges to a list of symbols: ``merges`` gives a pair's rank, ``result`` the
    symbol that a rank makes.

    The symbols are a doubly linked list; a priority queue holds the rank and place of each
    pair that merges. An entry whose pair is no longer there is stale and skipped. ``ranks``, of the
    pair at each place or -1, and the ``queue`` may be given. One symbol more, no part of any
    pair, stands behind the last and, since lists wrap, before the first.
    """
    n = len(symbols)
    rank_of = merges.get
    if ranks is None:
        ranks = [rank_of(a << 20 | b, -1) for a, b in zip(symbols, symbols[1:], strict=False)] + [-1]
        queue = [rank * n + i for i, rank in enumerate(ranks) if rank >= 0]
    if not queue:
        return symbols
    heapify(queue)
    symbols.append(-1)
    ranks.append(-1)
    after, before = list(range(1, n + 1)), list(range(-1, n))
    while queue:
        rank, i = divmod(heappop(queue), n)
        if ranks[i] != rank:
            continue
        symbols[i] = left = result[rank]
        j = after[i]
        symbols[j] = ranks[j] = -1
        after[i] = j = after[j]
        before[j] = i
        ranks[i] = rank = rank_of(left << 20 | symbols[j], -1)
        if rank >= 0:
            heappush(queue, rank * n + i)
        i = before[i]
        ranks[i] = rank = rank_of(symbols[i] << 20 | left, -1)
        if rank >= 0:
            heappush(queue, rank * n + i)
    return [s for s in symbols if s >= 0]


def cut_starts(data, offsets):
    """Where cuts begin: at each text, and at white space of ASCII after a character that is none.
    No match of the pattern, and nothing that it looks at, crosses such a place."""
    gap = T.GAP[data]
    start = np.zeros(len(data) + 1, bool)
    start[1:-1] = gap[1:] & ~gap[:-1]
    after_wide = np.flatnonzero(start[1:-1] & (data[:-1] >= 0x80)) + 1
    for width, spaces in WIDE_SPACES.items():
        long = after_wide[after_wide >= width]
        last = sum(data[long - i].astype(np.int64) << 8 * (i - 1) for i in range(1, width + 1))
        start[long[np.isin(last, spaces)]] = False
    start[offsets] = True
    return np.flatnonzero(start[:-1])


class Encoder:
    """Ids of whole texts, with a bounded memory of cuts and words met before."""

    def __init__(self, vocabulary):
        self.vocabulary = vocabulary
        self.words = {}
        contents = sorted(vocabulary.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, contents)) + ")") if contents else None
        self.one_cut = any(T.GAP[np.frombuffer(c.encode(), np.uint8)].any() for c in contents)
        self.symbol = np.array(vocabulary.symbol)
        rank_of = vocabulary.merges.get
        self.first_ranks = np.array([rank_of(a << 20 | b, -1) for a in vocabulary.symbol for b in vocabulary.symbol])
        self.forget()

    def forget(self):
        self.cuts, self.kept, self.ids_of_cuts = {}, 0, T.Ragged()

    def parts(self, cut):
        """The words and special tokens of a cut."""
        if self.special is not None and self.special.search(cut):
            special = self.vocabulary.special
            pieces = self.special.split(cut)
            return [w for p in pieces for w in ((p,) if p in special else SPLIT.findall(p))]
        return (cut,) if cut.removeprefix(" ").isalpha() else SPLIT.findall(cut)

    def ids_of_words(self, words, new_cuts):
        """The ids of each of the different ``words``, those met before, also as cuts, from memory.
        Words that are ``new_cuts`` will be remembered as such."""
        special, known, cuts = self.vocabulary.special, self.words, self.cuts
        found = {w: known.get(w) for w in words}
        found |= {w: [special[w]] for w in special.keys() & found.keys()}
        new = [w for w, ids in found.items() if ids is None]
        as_cuts = [w for w in new if w in cuts]
        if as_cuts:
            values, bounds = self.ids_of_cuts.rows(np.fromiter(map(cuts.__getitem__, as_cuts), np.int64, len(as_cuts)))
            values, bounds = values.tolist(), bounds.tolist()
            found |= {w: values[a:b] for w, a, b in zip(as_cuts, bounds[:-1], bounds[1:], strict=True)}
            new = [w for w in new if w not in cuts]
        if not new:
            return found
        if len(known) + len(new) > MOST_KEPT:
            known.clear()
        plain = [w.encode() for w in new]
        lengths = np.array([len(w) for w in plain])
        ends = np.cumsum(lengths)
        data = np.frombuffer(b"".join(plain), np.uint8)
        symbols = self.symbol[data].tolist()
        ranks = np.full(len(data), -1)
        ranks[:-1] = self.first_ranks[data[:-1].astype(np.int64) << 8 | data[1:]]
        ranks[ends - 1] = -1
        merging = ranks >= 0
        place = np.arange(len(data)) - np.repeat(ends - lengths, lengths)
        queue = (ranks * np.repeat(lengths, lengths) + place)[merging].tolist()
        ranks = ranks.tolist()
        queued = np.append(0, np.cumsum(merging)[ends - 1]).tolist()
        low, merges, result = 0, self.vocabulary.merges, self.vocabulary.result
        for i, (word, high) in enumerate(zip(new, ends.tolist(), strict=True)):
            ids = merged(symbols[low:high], merges, result, ranks[low:high], queue[queued[i] : queued[i + 1]])
            found[word] = ids
            if len(word) <= LONGEST_KEPT and len(known) < MOST_KEPT and word not in new_cuts:
                known[word] = ids
            low = high
        return found

    def slice(self, data, offsets):
        """``(ids, bounds)`` of the texts in ``data``."""
        starts = np.unique(offsets[:-1][np.diff(offsets) > 0]) if self.one_cut else cut_starts(data, offsets)
        cuts = pa.LargeStringArray.from_buffers(
            len(starts), pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data)
        ).dictionary_encode()
        known, different = self.cuts, cuts.dictionary.to_pylist()
        new = [c for c in different if c not in known]
        if new:
            parts = [self.parts(c) for c in new]
            ids = self.ids_of_words(chain.from_iterable(parts), set(new))
            values, bounds = [], [0]
            for words in parts:
                for word in words:
                    values += ids[word]
                bounds.append(len(values))
            self.ids_of_cuts.add(np.array(values, np.int32), np.array(bounds, np.int64))
            known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
            self.kept += sum(map(len, new))
        row = np.fromiter(map(known.__getitem__, different), np.int64, len(different))
        values, bounds = self.ids_of_cuts.rows(row[cuts.indices.to_numpy()])
        if len(known) > MOST_KEPT or self.kept > MOST_BYTES:
            self.forget()
        return values, bounds[np.searchsorted(starts, offsets)]

    def ids(self, text):
        return self.slice(*T.flat(pa.array([text], pa.string())))[0].tolist()


def encoded(batches, vocabulary):
    """Each batch, in slices, with ``ids`` in place of ``text``; null is the empty text."""
    encoder = Encoder(vocabulary)
    for batch in batches:
        data, offsets = T.flat(batch.column("text"))
        at = batch.schema.get_field_index("text")
        names = [("ids" if i == at else n) for i, n in enumerate(batch.schema.names)]
        for first, last in T.slices(offsets, SLICE_BYTES):
            low, high = offsets[first], offsets[last]
            values, bounds = encoder.slice(np.ascontiguousarray(data[low:high]), offsets[first : last + 1] - low)
            ids = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int32()))
            rows = batch.slice(first, last - first)
            yield pa.RecordBatch.from_arrays([ids if i == at else c for i, c in enumerate(rows.columns)], names)
    # The worker lives on after the task; what it no longer uses goes back to the machine.
    encoder.forget()
    pa.default_memory_pool().release_unused()


def decoded(batches, vocabulary):
    """Each batch with ``decoded`` added: the vocabulary's strings of its ids, put together."""
    piece = vocabulary.bytes.__getitem__
    for batch in batches:
        ids = batch.column("ids")
        bounds, values = ids.offsets.to_pylist(), ids.values
        texts = [
            b"".join(map(piece, values[a:b].to_numpy().tolist())).decode("utf-8", "replace")
            for a, b in zip(bounds[:-1], bounds[1:], strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"]
        )
