"""Line features, a linear-chain conditional random field, and word statistics of texts.

Nothing here knows Spark.
"""

import numpy as np
import pyarrow as pa

from corpuslens.llm import text_tasks as T

SLICE_BYTES = 2 << 20
CONTENT, BOILERPLATE = 0, 1


def _table(characters):
    table = np.zeros(256, bool)
    table[list(characters.encode())] = True
    return table


SYMBOL = _table("#*$%&|<>")
UPPER, LOWER_CASE, DIGIT = (_table(c) for c in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"))
STOP, EXCLAIM, LINK = _table(".,;?"), _table("!"), _table("/@_=")
LEAD = (np.arange(256) & 0xC0) != 0x80  # bytes that begin a code point

# Bounds of the bins that shares fall into; a line has one feature per bin it is in.
SHARES = np.array([0.002, 0.01, 0.03, 0.06, 0.12, 0.25, 0.5, 0.8])
LENGTHS = np.array([2, 4, 8, 16, 32, 64, 128])
WORD_LENGTHS = np.array([2, 3, 4, 5, 6, 7, 9, 12])
N_SHARES = 8
N_FEATURES = N_SHARES * (len(SHARES) + 1) + len(LENGTHS) + 1 + len(WORD_LENGTHS) + 1 + 3


class Lines:
    """Lines, words and counts of a slice of texts."""

    def __init__(self, data, offsets):
        n = len(offsets) - 1
        self.n = n
        breaks = np.flatnonzero(data == 0x0A)
        starts = np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], breaks + 1]))
        starts = starts[starts < len(data)]
        line_of = np.searchsorted(starts, np.arange(len(data)), "right") - 1 if len(data) else np.zeros(0, np.int64)
        word_start, word_end, self.word_document = T.words(data, offsets)
        self.index, dictionary = T.distinct(data, word_start, word_end)
        self.n_kinds = len(dictionary)
        self.n_words = np.bincount(self.word_document, minlength=n)
        solid = LEAD[data] & ~T.GAP[data]
        document_of = np.searchsorted(offsets, np.arange(len(data)), "right") - 1
        self.word_chars = np.bincount(document_of, weights=solid, minlength=n).astype(np.int64)
        self.n_symbols = np.bincount(document_of, weights=SYMBOL[data], minlength=n).astype(np.int64)

        # Only lines with a word count.
        word_line = line_of[word_start]
        kept, self.word_line = np.unique(word_line, return_inverse=True)
        self.document = document_of[starts[kept]] if len(kept) else np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(data))[kept]
        begins = starts[kept]
        ends = np.minimum(ends, offsets[1:][self.document]) if len(kept) else ends
        last = ends - 1
        ends = ends - ((ends > begins) & (data[last] == 0x0A)) if len(kept) else ends
        self.repeated = self._repeated(data, begins, ends)
        self.n_dup_lines = np.bincount(self.document, weights=self.repeated, minlength=n).astype(np.int64)
        number = np.full(len(starts), -1)
        number[kept] = np.arange(len(kept))
        of_byte = number[line_of] if len(data) else line_of
        self.chars = self._sum(of_byte, solid, len(kept))
        counts = [self._sum(of_byte, table[data], len(kept)) for table in (SYMBOL, UPPER, DIGIT, STOP, EXCLAIM, LINK)]
        words = np.bincount(self.word_line, minlength=len(kept))
        pair = self.word_line * max(1, self.n_kinds) + self.index
        first = np.unique(pair) // max(1, self.n_kinds)
        different = np.bincount(first, minlength=len(kept))
        again = words - different
        follows = np.zeros(len(pair))
        follows[1:] = pair[1:] == pair[:-1]
        in_row = np.bincount(self.word_line, weights=follows, minlength=len(kept))
        self.features = self._features(
            words, [*(c / np.maximum(1, self.chars) for c in counts), again / np.maximum(1, words), in_row / np.maximum(1, words)]
        )

    @staticmethod
    def _sum(group, weight, n):
        there = (group >= 0) & (weight > 0)
        return np.bincount(group[there], minlength=n)

    def _repeated(self, data, begins, ends):
        """Whether each line equals an earlier one of its text."""
        if not len(begins):
            return np.zeros(0, bool)
        inside = np.zeros(len(data) + 1, np.int8)
        np.add.at(inside, begins, 1)
        np.add.at(inside, ends, -1)
        kept = data[np.cumsum(inside[:-1], dtype=np.int8) > 0]
        bounds = np.concatenate([[0], np.cumsum(ends - begins)])
        lines = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(begins), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(kept))]
        ).dictionary_encode()
        key = self.document * len(lines.dictionary) + lines.indices.to_numpy()
        _, first = np.unique(key, return_index=True)
        repeated = np.ones(len(begins), bool)
        repeated[first] = False
        return repeated

    def _features(self, words, shares):
        """Numbers of the features that each line has, one column for each kind of feature."""
        columns, base = [], 0
        for share in shares:
            columns.append(base + np.searchsorted(SHARES, share, "right"))
            base += len(SHARES) + 1
        columns.append(base + np.searchsorted(LENGTHS, words, "right"))
        base += len(LENGTHS) + 1
        columns.append(base + np.searchsorted(WORD_LENGTHS, self.chars / np.maximum(1, words), "right"))
        base += len(WORD_LENGTHS) + 1
        columns.append(np.where(self.repeated, base, base + 1))
        columns.append(np.full(len(words), base + 2))
        return np.stack(columns, 1) if len(words) else np.zeros((0, len(columns)), np.int64)

    def repeated_words(self):
        """Per text, the words in three-word windows that occur twice or more in it."""
        n = max(0, len(self.index) - 2)
        a, b, c = (self.index[i : i + n].astype(np.int64) for i in range(3))
        whole = self.word_document[:n] == self.word_document[2:] if n else np.zeros(0, bool)
        _, pair = np.unique(a * max(1, self.n_kinds) + b, return_inverse=True)
        _, triple = np.unique(pair * max(1, self.n_kinds) + c, return_inverse=True)
        _, place, count = np.unique(triple * max(1, self.n) + self.word_document[:n], return_inverse=True, return_counts=True)
        # Windows over a border hold other texts' words and must not count as occurrences.
        valid = np.bincount(place, weights=whole, minlength=len(count))
        again = np.flatnonzero(whole & (valid[place] > 1))
        covered = np.zeros(len(self.index), bool)
        for i in range(3):
            covered[again + i] = True
        return np.bincount(self.word_document, weights=covered, minlength=self.n).astype(np.int64)


def line_features(texts):
    """For training: the features of each text's lines."""
    data, offsets = T.flat(texts)
    lines = Lines(data, offsets)
    if lines.n == 0:
        return []
    return np.split(lines.features, np.searchsorted(lines.document, np.arange(1, lines.n)))


def _by_position(documents, n):
    """Lines put side by side: for each position, the texts that have one there."""
    first = np.searchsorted(documents, np.arange(n + 1))
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    for t in range(int(length.max(initial=0))):
        there = order[: np.searchsorted(-length[order], -t, "left")]
        yield there, first[there] + t


def viterbi(features, documents, n, weights, transitions):
    """The most likely label of each line; of equal paths, the one with more content."""
    own = weights[features].sum(1)
    best = np.zeros((n, 2))
    back = np.zeros((len(features), 2), np.int8)
    positions = list(_by_position(documents, n))
    for t, (there, line) in enumerate(positions):
        if t == 0:
            best[there] = own[line]
            continue
        paths = best[there][:, :, None] + transitions[None]
        back[line] = paths.argmax(1)
        best[there] = paths.max(1) + own[line]
    label = np.zeros(len(features), np.int64)
    state = np.zeros(n, np.int64)
    ended = np.zeros(n, bool)
    for there, line in reversed(positions):
        fresh = there[~ended[there]]
        state[fresh] = best[fresh].argmax(1)
        ended[fresh] = True
        label[line] = state[there]
        state[there] = back[line, state[there]]
    return label


def fit(sequences, labels, passes=150, penalty=1e-3, rate=0.1):
    """``(weights, transitions)`` that maximise the likelihood of the labels of the lines.

    ``sequences`` has an array of features per text, ``labels`` one label per text, which all
    its lines carry. Gradients by the forward-backward recursions, steps by Adam.
    """
    weights, transitions = np.zeros((N_FEATURES, 2)), np.zeros((2, 2))
    sequences, labels = zip(*[(s, y) for s, y in zip(sequences, labels, strict=True) if len(s)], strict=True) if any(map(len, sequences)) else ((), ())
    if len(set(labels)) < 2:
        return weights, transitions
    features = np.concatenate(sequences)
    lengths = np.array([len(s) for s in sequences])
    documents = np.repeat(np.arange(len(lengths)), lengths)
    truth = np.asarray(labels)[documents]
    share = np.array([np.sum(truth == y) for y in (0, 1)])
    weight = (len(truth) / (2 * share))[truth]  # both labels count alike
    positions = list(_by_position(documents, len(lengths)))
    gold = np.zeros((len(features), 2))
    gold[np.arange(len(features)), truth] = 1
    moments = [(np.zeros_like(x), np.zeros_like(x)) for x in (weights, transitions)]
    for step in range(1, passes + 1):
        own = weights[features].sum(1)
        forward, after = np.zeros_like(own), np.zeros_like(own)
        previous = np.full(len(lengths), -1)
        edges = np.zeros((2, 2))
        for t, (there, line) in enumerate(positions):
            if t == 0:
                forward[line] = own[line]
            else:
                paths = forward[previous[there]][:, :, None] + transitions[None]
                forward[line] = own[line] + np.logaddexp(paths[:, 0], paths[:, 1])
            previous[there] = line
        total = np.zeros(len(lengths))
        total[:] = np.logaddexp(*forward[previous].T)
        for t in range(len(positions) - 1, 0, -1):
            there, line = positions[t]
            before = line - 1
            ahead = (own[line] + after[line])[:, None, :] + transitions[None]
            after[before] = np.logaddexp(ahead[:, :, 0], ahead[:, :, 1])
            chance = np.exp(forward[before][:, :, None] + ahead - total[there][:, None, None])
            edges += (chance * weight[line][:, None, None]).sum(0)
        chance = np.exp(forward + after - total[documents][:, None])
        slope = np.zeros_like(weights)
        difference = (gold - chance) * weight[:, None]
        for column in features.T:
            np.add.at(slope, column, difference)
        inner = np.flatnonzero(documents[1:] == documents[:-1]) + 1
        seen = np.zeros((2, 2))
        np.add.at(seen, (truth[inner - 1], truth[inner]), weight[inner])
        slopes = (slope / len(truth) - penalty * weights, (seen - edges) / len(truth) - penalty * transitions)
        for x, s, (m, v) in zip((weights, transitions), slopes, moments, strict=True):
            m += 0.1 * (s - m)
            v += 0.001 * (s * s - v)
            x += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return weights, transitions


def judged(texts, model, share):
    """A struct per text: its word statistics, the characters of content, and the verdict."""
    weights, transitions = model
    data, offsets = T.flat(texts)
    parts = []
    for first, last in T.slices(offsets, SLICE_BYTES):
        lines = Lines(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        label = viterbi(lines.features, lines.document, lines.n, weights, transitions)
        content = np.bincount(lines.document, weights=lines.chars * (label == CONTENT), minlength=lines.n).astype(np.int64)
        repeated = lines.repeated_words()
        failed = (lines.n_words < 50) | (100 * repeated > 50 * lines.n_words)
        kept = ~failed & (content >= share * lines.word_chars)
        parts.append(
            (lines.n_words, lines.word_chars, lines.n_symbols, lines.n_dup_lines, repeated, content, failed, kept)
        )
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content_chars", "base_failed", "kept")
    columns = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, int)] * 6 + [np.zeros(0, bool)] * 2
    kinds = [pa.int64()] * 6 + [pa.bool_()] * 2
    return pa.StructArray.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], list(names)
    )
