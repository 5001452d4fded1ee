"""Byte contexts inside tasks, and the weighting of a context tree. Nothing here knows Spark."""

import numpy as np
import pyarrow as pa
import pyarrow.compute

from corpuslens.llm import text_tasks as T

MARK = 0xFF  # stands before and after each text; UTF-8 has no such byte
SLICE_BYTES = 1 << 20
MOST_KEYS = 2 << 20


def framed(data, offsets, depth):
    """The texts with ``depth`` marks before and one after each, and where the bytes to
    predict are: those of the text and the mark that ends it."""
    lengths = np.diff(offsets)
    n = len(lengths)
    frame = np.full(len(data) + n * (depth + 1), MARK, np.uint8)
    document = np.repeat(np.arange(n), lengths)
    frame[np.arange(len(data)) + (document + 1) * depth + document] = data
    predicted = np.ones(len(frame), bool)
    heads = offsets[:-1] + np.arange(n) * (depth + 1)
    for i in range(depth):
        predicted[heads + i] = False
    return frame, np.flatnonzero(predicted)


def _merged(keys, counts):
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def count_grams(batches, depth):
    """Rows ``(key, n)``: a byte in the lowest eight bits, above it the bytes before it, the
    nearest lowest. Each task adds up before it sends; its memory is bounded."""
    held = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]

    def flushed():
        keys, counts = _merged(*(np.concatenate(x) for x in zip(*held, strict=True)))
        held[:] = [(keys, counts)]

    def sent():
        keys, counts = held[0]
        for a in range(0, len(keys), 1 << 17):
            yield pa.record_batch({"key": keys[a : a + (1 << 17)], "n": counts[a : a + (1 << 17)]})

    for batch in batches:
        data, offsets = T.flat(batch.column("text"))
        for first, last in T.slices(offsets, SLICE_BYTES):
            part = T.LOWER[data[offsets[first] : offsets[last]]]
            key = _keys(part, offsets[first : last + 1] - offsets[first], depth)
            keys, counts = np.unique(key, return_counts=True)
            held.append((keys, counts))
            if sum(len(k) for k, _ in held) > MOST_KEYS:
                flushed()
                if len(held[0][0]) > MOST_KEYS // 2:
                    yield from sent()
                    held[:] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    if sum(len(k) for k, _ in held):
        flushed()
        yield from sent()


def requests(table, depth, n_buckets):
    """For a batch: its distinct words and its distinct grams (as in ``count_grams``), each with
    its number among the training texts. Words are rows; grams are packed, a row per bucket."""
    words = word_counts(table)
    training = np.array(table["held_out"].to_pylist(), bool)
    keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for out in (False, True):
        some = table.select(["text"]).filter(pa.array(training == out)).to_batches()
        for part in count_grams(some, depth):
            keys.append(part["key"].to_numpy())
            counts.append(part["n"].to_numpy() * (not out))
    keys, counts = _merged(np.concatenate(keys), np.concatenate(counts))
    bucket = bucket_of(keys, n_buckets)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    packed = [(b, order[x:y]) for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if y > x]
    batch = table["batch"][0].as_py()
    grams = pa.table(
        {
            "batch": pa.array([batch] * len(packed), pa.int32()),
            "word": pa.nulls(len(packed), pa.string()),
            "n": pa.nulls(len(packed), pa.int64()),
            "bucket": pa.array([b for b, _ in packed], pa.int32()),
            "keys": pa.array([_packed_keys(keys[i]) for _, i in packed], pa.binary()),
            "counts": pa.array([T.planes(counts[i].astype(np.uint32)) for _, i in packed], pa.binary()),
        }
    )
    nothing = [pa.nulls(words.num_rows, t) for t in (pa.int32(), pa.binary(), pa.binary())]
    for name, column in zip(("bucket", "keys", "counts"), nothing, strict=True):
        words = words.append_column(name, column)
    return pa.concat_tables([words, grams])


def bucket_of(keys, n_buckets):
    """By the whole context, so that no frequent ending fills a bucket."""
    return (T.mixed((keys >> 8).astype(np.uint64)) % np.uint64(n_buckets)).astype(np.int32)


def _packed_keys(keys):
    return T.planes(np.diff(keys, prepend=0))


def _unpacked_keys(data):
    return np.cumsum(T.from_planes(data, np.int64))


def word_counts(table):
    """For a batch: its distinct words, each with its number among the training texts."""
    data, offsets = T.flat(table["text"])
    training = ~np.array(table["held_out"].to_pylist(), bool)
    words, numbers = [], []
    for first, last in T.slices(offsets, SLICE_BYTES):
        part = T.LOWER[data[offsets[first] : offsets[last]]]
        starts, ends, document = T.words(part, offsets[first : last + 1] - offsets[first])
        index, dictionary = T.distinct(part, starts, ends)
        words.append(dictionary)
        numbers.append(np.bincount(index, weights=training[first:last][document], minlength=len(dictionary)))
    every = pa.concat_arrays(words).dictionary_encode()
    n = np.bincount(
        every.indices.to_numpy(), weights=np.concatenate(numbers), minlength=len(every.dictionary)
    ).astype(np.int64)
    return pa.table(
        {
            "batch": pa.array([table["batch"][0].as_py()] * len(n), pa.int32()),
            "word": every.dictionary.cast(pa.string()),
            "n": n,
        }
    )


def scored(documents, answers, depth):
    """Per document: numbers of tokens and of known ones, the sum of log10(c + 1) over its
    tokens but the end, and the log10 probability that the model gives its bytes.

    ``answers`` has the counts of the batch's words and the log10 probabilities of its grams."""
    of_words = answers.filter(pa.compute.is_valid(answers["word"]))
    known = pa.concat_arrays([c.cast(pa.large_string()) for c in of_words["word"].chunks]) if of_words.num_rows else pa.array([], pa.large_string())
    count = of_words["c"].to_numpy() if of_words.num_rows else np.zeros(0, np.int64)
    keys, log_p = _answered(answers.filter(pa.compute.is_valid(answers["keys"])))
    data, offsets = T.flat(documents["text"])
    tokens, held, base, score = [], [], [], []
    for first, last in T.slices(offsets, SLICE_BYTES):
        part = T.LOWER[data[offsets[first] : offsets[last]]]
        bounds = offsets[first : last + 1] - offsets[first]
        starts, ends, document = T.words(part, bounds)
        index, dictionary = T.distinct(part, starts, ends)
        place = pa.compute.index_in(dictionary, value_set=known)
        place = place.fill_null(len(count)).to_numpy(zero_copy_only=False)
        c = np.append(count, 0)[place][index]
        n = last - first
        tokens.append(np.bincount(document, minlength=n))
        held.append(np.bincount(document, weights=c > 0, minlength=n).astype(np.int64))
        base.append(np.bincount(document, weights=np.log10(c + 1.0), minlength=n))
        score.append(_score(part, bounds, keys, log_p, depth))
    return pa.table(
        {
            "doc_id": documents["doc_id"].combine_chunks(),
            "text_hash": documents["text_hash"].combine_chunks(),
            "held_out": documents["held_out"].combine_chunks(),
            "n_words": np.concatenate(tokens).astype(np.int64),
            "n_known_words": np.concatenate(held),
            "log_counts": np.concatenate(base),
            "score": np.concatenate(score),
        }
    )


def _answered(rows):
    """Grams in order and their log10 probabilities."""
    keys = np.concatenate([_unpacked_keys(x.as_py()) for x in rows["keys"]])
    log_p = np.concatenate([T.from_planes(x.as_py(), np.float32) for x in rows["log_p"]])
    order = np.argsort(keys)
    return keys[order], log_p[order]


def _keys(data, offsets, depth):
    """The gram at each place to predict."""
    frame, at = framed(data, offsets, depth)
    key = np.zeros(len(at), np.int64)
    for i in range(depth, -1, -1):
        key = (key << 8) | frame[at - i]
    return key


def _score(data, offsets, keys, log_p, depth):
    grams, place = np.unique(_keys(data, offsets, depth), return_inverse=True)
    each = log_p[np.searchsorted(keys, grams)].astype(np.float64)[place]
    return np.add.reduceat(each, offsets[:-1] + np.arange(len(offsets) - 1))


# --- the tree in parts --------------------------------------------------------
#
# Every context of the training texts is in the tree. Contexts that end with the same STEM
# bytes are a part, at most 65,536 contexts of five bytes, which one task weighs; the
# contexts above the stems, at most 65,793, are weighed in one place. Only what some text
# holds is written down: a decision that training never met after a context has no weight
# (its estimate is 1 there and in all longer contexts), and its chance is a half.

STEM = 3


def stem_depth(depth):
    return min(STEM, depth)


def turned(keys, depth):
    """Grams with the bytes of the context in the order of the tree, the nearest highest."""
    out = np.zeros_like(keys)
    for i in range(1, depth + 1):
        out = (out << 8) | (keys >> (8 * i) & 255)
    return (out << 8) | (keys & 255)


def unturned(keys, depth):
    out = np.zeros_like(keys)
    for i in range(1, depth + 1):
        out |= (keys >> (8 * (depth - i + 1)) & 255) << (8 * i)
    return out | (keys & 255)


def whole_grams(table, depth, n_parts):
    """For a bucket of requests: its distinct grams with their numbers, and the part of each."""
    keys = np.concatenate([_unpacked_keys(x.as_py()) for x in table["keys"]])
    counts = np.concatenate([T.from_planes(x.as_py(), np.uint32) for x in table["counts"]])
    keys, counts = _merged(keys, counts.astype(np.int64))
    keys = turned(keys, depth)
    stems = keys >> (8 * (depth - stem_depth(depth) + 1))
    part = (T.mixed(stems.astype(np.uint64)) % np.uint64(n_parts)).astype(np.int32)
    return pa.table({"part": part, "key": keys, "n": counts})


class _Level:
    """The contexts of one length. A pair is a context and a byte after it (``node << 8 | byte``,
    sorted); a decision is a context and the bits so far (``node << 8 | 1, bits``)."""

    def __init__(self, pairs, n, least):
        self.pairs, self.n = pairs, n
        first = np.flatnonzero(np.diff(pairs >> 8, prepend=-1))
        self.node = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(pairs))))
        # Of each node, whether it is in the tree.
        self.kept = np.add.reduceat(n, first) >= least if len(first) else np.zeros(0, bool)
        byte = pairs & 255
        self.decision = np.zeros((len(pairs), 8), np.int32)
        self.bit = np.zeros((len(pairs), 8), bool)
        codes, self.starts, size = [], [], 0
        for k in range(8):
            code = (pairs >> 8 << 8) | (1 << k) | (byte >> (8 - k))
            starts = np.flatnonzero(np.diff(code, prepend=-1))
            self.decision[:, k] = size + np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(pairs))))
            self.bit[:, k] = byte >> (7 - k) & 1
            codes.append(code[starts])
            self.starts.append(starts)
            size += len(starts)
        self.code = np.concatenate(codes)
        self.first = np.concatenate(self.starts)  # a pair of each decision
        self.column = np.repeat(np.arange(8), [len(x) for x in self.starts])
        self.kept_decision = self.kept[self.node[self.first]]

    def counted(self, n):
        """Zeros and ones at each decision, of numbers by pair."""
        if not len(n):
            return np.zeros(0), np.zeros(0)
        every = np.concatenate([np.add.reduceat(n, x) for x in self.starts])
        ones = np.concatenate([np.add.reduceat(n * self.bit[:, k], x) for k, x in enumerate(self.starts)])
        return (every - ones).astype(np.float64), ones.astype(np.float64)

    def weigh(self, product, below, inner):
        """From the weights of the kept contexts one byte longer: their sum by decision, their
        numbers by pair, and which nodes have any."""
        zeros, ones = self.counted(self.n)
        left = self.counted(self.n - below)
        own = _log_kt(zeros, ones)
        mixed = np.logaddexp(own, product + _log_kt(*left)) - np.log(2)
        inner = inner[self.node[self.first]]
        self.weighted = np.where(inner, mixed, own)
        self.share = np.where(inner, np.exp(own - np.log(2) - mixed), 1.0)
        self.own = _chance(zeros, ones)
        self.rest = _chance(*left)

    def descend(self, sure, open_, one):
        """From these at the decisions of the contexts one byte shorter."""
        self.sure = sure + open_ * self.share * self.own
        self.open = open_ * (1 - self.share)
        self.one = np.where(self.kept_decision, self.sure + self.open * self.rest, one)

    def log_p(self):
        one = self.one[self.decision]
        return np.log10(np.where(self.bit, one, 1 - one)).sum(1)


def _levels(pairs, n, lowest, highest, least):
    """Levels by depth; a level knows the place of its pairs and decisions in the next higher."""
    levels = {}
    for d in range(lowest, highest - 1, -1):
        levels[d] = _Level(pairs, n, least)
        if d > highest:
            above = (pairs >> 16 << 8) | (pairs & 255)
            pairs, levels[d].up = np.unique(above, return_inverse=True)
            n = np.bincount(levels[d].up, n, minlength=len(pairs)).astype(np.int64)
    for d in range(lowest, highest, -1):
        own = levels[d]
        own.up_decision = levels[d - 1].decision[own.up[own.first], own.column]
    return levels


def _weigh_up(levels, product=None, below=None, inner=None):
    """Weights from the lowest of ``levels`` up; ``product`` and so on as for ``_Level.weigh``."""
    lowest = max(levels)
    for d in sorted(levels, reverse=True):
        own = levels[d]
        if d < lowest:
            down = levels[d + 1]
            kept, which = down.kept_decision, down.kept[down.node]
            product = np.bincount(down.up_decision[kept], down.weighted[kept], minlength=len(own.code))
            below = np.bincount(down.up[which], down.n[which], minlength=len(own.pairs)).astype(np.int64)
            inner = np.bincount(own.node[down.up[which]], minlength=len(own.kept)) > 0
        elif product is None:
            product = np.zeros(len(own.code))
            below = np.zeros(len(own.pairs), np.int64)
            inner = np.zeros(len(own.kept), bool)
        own.weigh(product, below, inner)


PART_GRAMS = 1 << 18
COUNT, KEPT, WEIGHT = 0, 1, 2


def _by_stem(table, depth):
    """The grams of a part, sorted, in runs of whole stems of about ``PART_GRAMS``."""
    keys, n = table["key"].to_numpy(), table["n"].to_numpy()
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    ends = np.append(np.flatnonzero(np.diff(keys >> (8 * (depth - stem_depth(depth) + 1)))) + 1, len(keys))
    first = 0
    while first < len(keys):
        last = ends[min(np.searchsorted(ends, first + PART_GRAMS), len(ends) - 1)]
        yield keys[first:last], n[first:last]
        first = last


def told_up(table, depth, least):
    """Rows ``(kind, key, value)`` that a part's stems tell the contexts one byte shorter: their
    numbers by pair, those of kept stems, and the weights of kept stems by decision."""
    rows = []
    for keys, n in _by_stem(table, depth):
        levels = _levels(keys, n, depth, stem_depth(depth), least)
        _weigh_up(levels)
        stems = levels[stem_depth(depth)]
        shorter = lambda x: (x >> 16 << 8) | (x & 255)
        which, kept = stems.kept[stems.node], stems.kept_decision
        for kind, key, value in (
            (COUNT, stems.pairs, stems.n),
            (KEPT, stems.pairs[which], stems.n[which]),
            (WEIGHT, stems.code[kept], stems.weighted[kept]),
        ):
            key, place = np.unique(shorter(key), return_inverse=True)
            rows.append((np.full(len(key), kind, np.int32), key, np.bincount(place, value, minlength=len(key))))
    kind, key, value = (np.concatenate(x) for x in zip(*rows, strict=True))
    return pa.table({"kind": kind, "key": key, "value": value.astype(np.float64)})


def top(table, depth, least):
    """``(codes, sure, open, one)`` by decision of the contexts one byte shorter than stems, from
    the sums of what all parts told; sorted by code."""
    kind, key, value = (table[c].to_numpy() for c in ("kind", "key", "value"))
    pairs, n = _sorted(key[kind == COUNT], value[kind == COUNT])
    levels = _levels(pairs, n.astype(np.int64), stem_depth(depth) - 1, 0, least)
    levels[0].kept[:] = True
    levels[0].kept_decision[:] = True
    lowest = levels[max(levels)]
    below = np.zeros(len(pairs), np.int64)
    below[np.searchsorted(pairs, key[kind == KEPT])] = value[kind == KEPT]
    product = np.zeros(len(lowest.code))
    by_code = np.argsort(lowest.code)
    found = np.searchsorted(lowest.code, key[kind == WEIGHT], sorter=by_code)
    product[by_code[found]] = value[kind == WEIGHT]
    inner = np.bincount(lowest.node, below, minlength=len(lowest.kept)) > 0
    _weigh_up(levels, product, below, inner)
    _descend(levels, 0.0, 1.0, 0.5)
    return lowest.code[by_code], lowest.sure[by_code], lowest.open[by_code], lowest.one[by_code]


def _sorted(keys, values):
    order = np.argsort(keys)
    return keys[order], values[order]


def _descend(levels, sure, open_, one):
    for d in sorted(levels):
        own = levels[d]
        if d > min(levels):
            above = levels[d - 1]
            sure, open_, one = (x[own.up_decision] for x in (above.sure, above.open, above.one))
        own.descend(sure, open_, one)


def told_down(table, model, depth, least, n_buckets):
    """Rows ``(bucket, key, log_p)``: of each gram of a part, the log10 probability of its byte."""
    codes, *of_codes = model
    out = []
    for keys, n in _by_stem(table, depth):
        levels = _levels(keys, n, depth, stem_depth(depth), least)
        _weigh_up(levels)
        stems = levels[stem_depth(depth)].code
        above = np.searchsorted(codes, (stems >> 16 << 8) | (stems & 255))
        _descend(levels, *(x[above] for x in of_codes))
        out.append((unturned(keys, depth), levels[depth].log_p().astype(np.float32)))
    keys, log_p = (np.concatenate(x) for x in zip(*out, strict=True))
    return pa.table({"bucket": bucket_of(keys, n_buckets), "key": keys, "log_p": log_p})


def answers(asked, weighed):
    """For a bucket: to each batch the log10 probabilities of the grams it asked for."""
    keys, log_p = _sorted(weighed["key"].to_numpy(), weighed["log_p"].to_numpy())
    packed = []
    for request in asked["keys"]:
        packed.append(T.planes(log_p[np.searchsorted(keys, _unpacked_keys(request.as_py()))]))
    return pa.table(
        {
            "batch": asked["batch"].combine_chunks(),
            "keys": asked["keys"].combine_chunks(),
            "log_p": pa.array(packed, pa.binary()),
        }
    )


# --- the tree's weights -------------------------------------------------------


def _log_gamma(x):
    """Of x > 0, by eight steps up and Stirling's series."""
    product = x.copy()
    for i in range(1, 8):
        product *= x + i
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(product)


def _binary(counts):
    """Numbers of zeros and ones at each of the 255 binary decisions of a byte, the decision
    with number b being followed by 2b or 2b + 1."""
    heap = np.zeros((len(counts), 512))
    heap[:, 256:] = counts
    for width in (128, 64, 32, 16, 8, 4, 2, 1):
        heap[:, width : 2 * width] = heap[:, 2 * width : 4 * width : 2] + heap[:, 2 * width + 1 : 4 * width : 2]
    return heap[:, 2:512:2], heap[:, 3:512:2]


def _log_kt(zeros, ones):
    """The Krichevsky-Trofimov estimate of a sequence with so many zeros and ones."""
    return (
        _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - np.log(np.pi)
    )


def _chance(zeros, ones):
    """The estimate's probability of a one next."""
    return (ones + 0.5) / (zeros + ones + 1.0)


def weigh(levels):
    """The mixture over all depths as tables ``child[node, byte]`` and ``log_p[node, byte]``, for
    a tree small enough for one place; the parts above are held against it.

    ``levels[d]`` is ``(contexts, counts)``: the kept contexts of d bytes, sorted, and for
    each the counts of the 256 bytes that follow. Per binary decision, a context's weighted
    probability is the mean of its own estimate and of the product over its children, the
    contexts one byte longer. Children that are not kept count as one child together. Row
    ``node`` of ``log_p`` holds log10 probabilities after the longest kept context ``node``.
    """
    depth = len(levels) - 1
    start = np.cumsum([0] + [len(c) for c, _ in levels])
    child = np.zeros((start[-1], 256), np.int32)
    parent = [np.zeros(0, np.int64)] * (depth + 1)
    for d in range(1, depth + 1):
        contexts = levels[d][0]
        nearest = (1 << (8 * (d - 1))) - 1
        parent[d] = np.searchsorted(levels[d - 1][0], contexts & nearest)
        child[start[d - 1] + parent[d], contexts >> (8 * (d - 1))] = start[d] + np.arange(len(contexts))
    weighted = [None] * (depth + 1)
    own_share = [None] * (depth + 1)
    rest = [None] * (depth + 1)
    for d in range(depth, -1, -1):
        counts = levels[d][1]
        own = _log_kt(*_binary(counts))
        left, product = counts.copy(), np.zeros_like(own)
        inner = np.zeros(len(counts), bool)
        if d < depth and len(levels[d + 1][0]):
            np.subtract.at(left, parent[d + 1], levels[d + 1][1])
            np.add.at(product, parent[d + 1], weighted[d + 1])
            inner[parent[d + 1]] = True
        product += _log_kt(*_binary(left))
        mixed = np.logaddexp(own, product) - np.log(2)
        weighted[d] = np.where(inner[:, None], mixed, own)
        own_share[d] = np.where(inner[:, None], np.exp(own - np.log(2) - mixed), 1.0)
        rest[d] = left
    log_p = np.empty((start[-1], 256), np.float32)
    sure, open_ = np.zeros((1, 255)), np.ones((1, 255))
    for d in range(depth + 1):
        if d:
            sure, open_ = sure[parent[d]], open_[parent[d]]
        own = _chance(*_binary(levels[d][1]))
        sure = sure + open_ * own_share[d] * own
        open_ = open_ * (1 - own_share[d])
        one = sure + open_ * _chance(*_binary(rest[d]))
        bits = np.zeros((len(one), 512))
        for b in range(1, 256):
            bits[:, 2 * b] = bits[:, b] + np.log10(1 - one[:, b - 1])
            bits[:, 2 * b + 1] = bits[:, b] + np.log10(one[:, b - 1])
        log_p[start[d] : start[d + 1]] = bits[:, 256:]
    return child, log_p
