"""Word-level byte-pair encoding of many words at once, and the packing plan.

Nothing here knows Spark.
"""

import unicodedata
from itertools import islice

import numpy as np
import pyarrow as pa
import regex

from corpuslens.llm import bpe_tasks as B
from corpuslens.llm import text_tasks as T

# Fixed value: the pattern whose matches are the words; anything else is dropped.
SPLIT = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{B.SPACE}\p{{L}}\p{{N}}]+")
SLICE_BYTES = 4 << 20
MOST_KEPT = 1 << 19  # runs whose ids a task remembers at a time,
MOST_BYTES = 16 << 20  # and their characters
LONG_WORD = 64  # bytes; such words are merged one by one


class WordEncoder:
    """Ids of runs without white space, remembered for a task in bounded memory."""

    def __init__(self, vocabulary):
        self.vocabulary = vocabulary
        pairs = np.array(list(vocabulary.merges), np.uint64)
        ranks = np.array(list(vocabulary.merges.values()), np.int64)
        order = np.argsort(pairs)
        self.pairs, self.ranks = pairs[order], ranks[order]
        self.result = np.array(vocabulary.result, np.int32)
        self.symbol = np.array(vocabulary.symbol, np.int32)
        self.last_symbol = np.array(vocabulary.last_symbol, np.int32)
        self.cut_special = regex.compile("|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True))) or r"(?!)")
        self.forget()

    def forget(self):
        self.runs, self.words, self.kept = {}, {}, 0
        self.ids_of_runs, self.ids_of_words = T.Ragged(), T.Ragged()

    def rows(self, runs):
        """For each run (text without white space) the number of its row in ``ids_of_runs``."""
        if len(self.runs) > MOST_KEPT or self.kept > MOST_BYTES:
            self.forget()
        known = self.runs
        new = [r for r in runs if r not in known]
        if new:
            self.kept += sum(map(len, new))
            parts, bounds, words = self._words(new)
            self._encode(words)
            values, at = self.ids_of_words.rows(parts)
            self.ids_of_runs.add(values, at[bounds])
            known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
        return np.fromiter(map(known.__getitem__, runs), np.int64, len(runs))

    def _words(self, runs):
        """The words of each run, as numbers, and the bytes of words not met before."""
        known, parts, bounds = self.words, [], [0]
        before = len(known)
        for run in runs:
            if run.isascii() and run.isalpha():
                parts.append(known.setdefault(run.lower(), len(known)))
            else:
                for word in self._split(run):
                    parts.append(known.setdefault(word, len(known)))
            bounds.append(len(parts))
        return np.array(parts, np.int64), np.array(bounds, np.int64), list(islice(known, before, None))

    def _split(self, run):
        """The words of a run, special tokens as tuples. Letters are lower-cased one by one,
        so a sigma at a word's end is as any other."""
        if self.cut_special.search(run):
            words, at = [], 0
            for special in self.cut_special.finditer(run):
                words += self._split(run[at : special.start()])
                words.append((special[0],))
                at = special.end()
            return words + self._split(run[at:])
        if not run.isascii():
            run = unicodedata.normalize("NFC", run).replace("\u03a3", "\u03c3")
        return SPLIT.findall(run.lower())

    def _encode(self, words):
        """Append the ids of ``words`` to ``ids_of_words``; a special token is in a tuple."""
        plain = [b"" if isinstance(w, tuple) else w.encode() for w in words]
        whole = {}
        for i, (word, data) in enumerate(zip(words, plain, strict=True)):
            if isinstance(word, tuple):
                whole[i] = [self.vocabulary.special[word[0]]]
            elif len(data) > LONG_WORD:
                symbols = [*map(self.vocabulary.symbol.__getitem__, data)]
                symbols[-1] = self.vocabulary.last_symbol[data[-1]]
                whole[i] = B.merged(symbols, self.vocabulary.merges, self.vocabulary.result)
        if whole:
            plain = [b"" if i in whole else data for i, data in enumerate(plain)]
        word, symbol = self._merged(plain)
        if whole:
            word = np.concatenate([word, *(np.full(len(x), i) for i, x in whole.items())])
            symbol = np.concatenate([symbol, *(np.array(x, np.int32) for x in whole.values())])
            order = np.argsort(word, kind="stable")
            word, symbol = word[order], symbol[order]
        self.ids_of_words.add(symbol, np.searchsorted(word, np.arange(len(words) + 1)))

    def _merged(self, words):
        """``(word, symbol)`` of all words after their merges, by word. In each pass every
        word that still has a pair to merge merges the first one of lowest rank."""
        lengths = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        word = np.repeat(np.arange(len(words)), lengths)
        symbol = self.symbol[data]
        ends = np.cumsum(lengths)[lengths > 0] - 1
        symbol[ends] = self.last_symbol[data[ends]]
        none = len(self.result)
        done = []
        while len(word):
            pair = symbol[:-1].astype(np.uint64) << np.uint64(20) | symbol[1:].astype(np.uint64)
            place = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            rank = np.full(len(word), none)
            rank[:-1] = np.where((self.pairs[place] == pair) & (word[:-1] == word[1:]), self.ranks[place], none)
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            least = np.minimum.reduceat(rank, first)
            count = np.diff(np.append(first, len(word)))
            finished = np.repeat(least == none, count)
            done.append((word[finished], symbol[finished]))
            chosen = np.flatnonzero((rank == np.repeat(least, count)) & ~finished)
            chosen = chosen[np.concatenate([[True], word[chosen[1:]] != word[chosen[:-1]]])] if len(chosen) else chosen
            symbol[chosen] = self.result[rank[chosen]]
            kept = ~finished
            kept[chosen + 1] = False
            word, symbol = word[kept], symbol[kept]
        word = np.concatenate([np.zeros(0, np.int64), *(w for w, _ in done)])
        symbol = np.concatenate([np.zeros(0, np.int32), *(s for _, s in done)])
        order = np.argsort(word, kind="stable")
        return word[order], symbol[order]


def pieces(batches, vocabulary, capacity, end):
    """A row per piece of each text: ``piece, start, length, ids`` after the other columns.

    White space drops out, so a text's ids are those of its runs without white space, one
    after the other, then ``end``.
    """
    encoder = WordEncoder(vocabulary)
    for batch in batches:
        data, offsets = T.flat(batch.column("text"))
        others = [n for n in batch.schema.names if n != "text"]
        for first, last in T.slices(offsets, SLICE_BYTES):
            bounds = offsets[first : last + 1] - offsets[first]
            part = data[offsets[first] : offsets[last]]
            starts, ends, document = T.words(part, bounds)
            index, dictionary = T.distinct(part, starts, ends)
            row = encoder.rows(dictionary.to_pylist())[index]
            values, at = encoder.ids_of_runs.rows(row)
            at = at[np.searchsorted(document, np.arange(last - first + 1))]
            values = np.insert(values, at[1:], end).astype("<u4")
            at = at + np.arange(len(at))
            n_pieces = -(-np.diff(at) // capacity)
            of = np.repeat(np.arange(last - first), n_pieces)
            piece = np.arange(len(of)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
            start = piece * capacity
            length = np.minimum(np.diff(at)[of] - start, capacity)
            low = (at[:-1][of] + start) * 4
            ids = values.tobytes()
            texts = batch.slice(first, last - first).take(pa.array(of))
            yield pa.RecordBatch.from_arrays(
                [
                    *[texts.column(n) for n in others],
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array([ids[a:b] for a, b in zip(low.tolist(), (low + 4 * length).tolist(), strict=True)], pa.binary()),
                ],
                [*others, "piece", "start", "length", "ids"],
            )
    # The worker lives on after the task; what it no longer uses goes back to the machine.
    encoder.forget()
    pa.default_memory_pool().release_unused()


# --- the plan -----------------------------------------------------------------


def fullest(room, available):
    """The fullest combination of lengths that fits in ``room``: ``{length: times}``.

    A subset-sum over ``available`` (length and count, longest first): bit s of ``reach`` says
    that some combination has the sum s. It ends when the room can be filled.
    """
    mask = (2 << room) - 1
    reach, steps = 1, []
    for length, count in available:
        if reach >> room & 1:
            break
        if length > room:
            continue
        steps.append((length, reach))
        for _ in range(min(count, room // length)):
            more = reach | (reach << length & mask)
            if more == reach:
                break
            reach = more
    total, chosen = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        times = 0
        while not before >> total & 1:
            total -= length
            times += 1
        if times:
            chosen[length] = times
    return chosen


def plan(histogram, capacity):
    """Bins for ``histogram`` (count by length) by minimum bin slack.

    Each bin takes the longest length left and the fullest combination for the rest of the
    room; the combination is used again as long as there is enough of each of its lengths.
    So the number of combinations, not of bins, sets the work. Rows ``(length, first rank,
    last rank, per bin, first bin, offset)``: of the pieces of this length, those with these
    ranks go, ``per bin`` together, to bins in sequence.
    """
    left = {length: count for length, count in histogram.items() if count > 0}
    used = dict.fromkeys(left, 0)
    rows, n_bins = [], 0
    longest_first = sorted(left, reverse=True)
    while left:
        longest_first = [x for x in longest_first if x in left]
        top = longest_first[0]
        available = [(x, left[x] - (x == top)) for x in longest_first]
        chosen = fullest(capacity - top, available)
        chosen[top] = chosen.get(top, 0) + 1
        times = min(left[x] // k for x, k in chosen.items())
        offset = 0
        for length, k in sorted(chosen.items(), reverse=True):
            first = used[length]
            rows.append((length, first, first + k * times, k, n_bins, offset))
            used[length] += k * times
            left[length] -= k * times
            if not left[length]:
                del left[length]
            offset += k * length
        n_bins += times
    return rows


def placed(batches, table):
    """``sequence_id`` and ``offset`` for rows with ``length`` and ``rank``."""
    length, first, _, per_bin, bin_, offset = table
    keys = length << 44 | first
    for batch in batches:
        own, rank = (batch.column(n).to_numpy() for n in ("length", "rank"))
        row = np.searchsorted(keys, own << 44 | rank, "right") - 1
        turn = rank - first[row]
        kept = [n for n in batch.schema.names if n != "rank"]
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(n) for n in kept],
                pa.array(bin_[row] + turn // per_bin[row], pa.int64()),
                pa.array(offset[row] + turn % per_bin[row] * own, pa.int64()),
            ],
            [*kept, "sequence_id", "offset"],
        )
