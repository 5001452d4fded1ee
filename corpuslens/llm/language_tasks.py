"""Byte n-grams and bit-sliced Bloom filters inside tasks. Nothing here knows Spark."""

import numpy as np
import pyarrow as pa

from corpuslens.llm import text_tasks as T

GRAM = 4
SLICE_BYTES = 1 << 20
MOST_KEYS = 1 << 20
# What an ASCII byte counts as: letters in lower case, all else a space. Others stay.
MAPPED = np.where((T.LOWER >= 97) & (T.LOWER <= 122) | (np.arange(256) >= 128), T.LOWER, 0x20).astype(np.uint8)
BLANK = 0x20202020


def grams(data, offsets):
    """``(grams, bounds)``: all n-grams of each text between two spaces on either side, none
    of them blank or within a run of spaces."""
    n = len(offsets) - 1
    frame = np.full(len(data) + 4 * n, 0x20, np.uint8)
    document = np.repeat(np.arange(n), np.diff(offsets))
    frame[np.arange(len(data)) + 4 * document + 2] = MAPPED[data]
    size = max(0, len(frame) - GRAM + 1)
    gram = np.zeros(size, np.uint32)
    for i in range(GRAM):
        gram = gram << np.uint32(8) | frame[i : i + size]
    starts = offsets[:-1] + 4 * np.arange(n)
    inside = np.ones(size, bool)
    for i in range(1, GRAM):
        behind = starts[1:] - i
        inside[behind[behind < size]] = False
    inside &= (gram & np.uint32(0xFFFF)) != 0x2020
    inside &= (gram >> np.uint32(8)) != (BLANK >> 8)
    kept = np.flatnonzero(inside)
    bounds = np.searchsorted(kept, np.append(starts, size))
    return gram[kept], bounds


def count_grams(batches):
    """Rows ``(lang, gram, n)``, added up within the task in bounded memory."""
    langs, held = {}, []

    def merged():
        keys = np.concatenate([k for k, _ in held])
        keys, place = np.unique(keys, return_inverse=True)
        held[:] = [(keys, np.bincount(place, weights=np.concatenate([n for _, n in held])).astype(np.int64))]

    def sent():
        names = np.array(list(langs), object)
        keys, n = held[0]
        for a in range(0, len(keys), 1 << 17):
            part = keys[a : a + (1 << 17)]
            yield pa.record_batch(
                {
                    "lang": pa.array(names[part >> 32], pa.string()),
                    "gram": part & 0xFFFFFFFF,
                    "n": n[a : a + (1 << 17)],
                }
            )

    for batch in batches:
        own = np.array([langs.setdefault(x, len(langs)) for x in batch.column("lang").to_pylist()], np.int64)
        data, offsets = T.flat(batch.column("text"))
        for first, last in T.slices(offsets, SLICE_BYTES):
            gram, bounds = grams(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
            keys = np.repeat(own[first:last], np.diff(bounds)) << 32 | gram.astype(np.int64)
            held.append(np.unique(keys, return_counts=True))
            if sum(len(k) for k, _ in held) > MOST_KEYS:
                merged()
                if len(held[0][0]) > MOST_KEYS // 2:
                    yield from sent()
                    held.clear()
    if held:
        merged()
        yield from sent()


def places(gram, bits):
    """The two places of each n-gram in a filter of ``2 ** bits`` bits."""
    h = T.mixed(gram.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    mask = np.uint64((1 << bits) - 1)
    return (h & mask).astype(np.int64), (h >> np.uint64(32) & mask).astype(np.int64)


def masks(lang, gram, bits):
    """``(word, place, mask)``: the bit that each n-gram sets for its language, at both places. ``lang``
    has numbers of languages; masks have as many 64-bit words as these need."""
    where = np.concatenate(places(gram, bits))
    lang = np.tile(lang, 2)
    return lang >> 6, where, np.uint64(1) << (lang & 63).astype(np.uint64)


def placed(batches, langs, bits):
    """Rows of ``masks`` for rows (lang, gram)."""
    number = {name: i for i, name in enumerate(langs)}
    for batch in batches:
        lang = np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)
        word, where, mask = masks(lang, batch.column("gram").to_numpy(), bits)
        yield pa.record_batch(
            {"word": word.astype(np.int32), "place": where.astype(np.int32), "mask": mask.view(np.int64)}
        )


def build(langs, word, where, mask, bits):
    """``(langs, slices, false positive rates)``: at each place a bitmask of languages."""
    slices = np.zeros((max(1, -(-len(langs) // 64)), 1 << bits), np.uint64)
    np.bitwise_or.at(slices, (word, where), mask.view(np.uint64))
    fill = [np.count_nonzero(slices[i >> 6] >> np.uint64(i & 63) & np.uint64(1)) / (1 << bits) for i in range(len(langs))]
    return list(langs), slices, np.array(fill) ** 2


def _has_letter(text):
    return text is not None and any(map(str.isalpha, text))


def predicted(texts, model):
    """A struct ``(lang_pred, score)`` per text."""
    langs, slices, wrong = model
    bits = slices.shape[1].bit_length() - 1
    names, scores = [], []
    data, offsets = T.flat(texts)
    for first, last in T.slices(offsets, SLICE_BYTES):
        part = data[offsets[first] : offsets[last]]
        gram, bounds = grams(part, offsets[first : last + 1] - offsets[first])
        one, two = places(gram, bits)
        masks = [row.take(one) & row.take(two) for row in slices]
        total = np.diff(bounds)
        share = np.zeros((len(total), len(langs)))
        for i in range(len(langs)):
            bit = (masks[i >> 6] >> np.uint64(i & 63) & np.uint64(1)).astype(np.int64)
            sums = np.concatenate([[0], np.cumsum(bit)])
            count = sums[bounds[1:]] - sums[bounds[:-1]]
            share[:, i] = (count / np.maximum(total, 1) - wrong[i]) / max(1e-9, 1 - wrong[i])
        best = share.argmax(1) if langs else np.zeros(len(total), int)
        for i in range(last - first):
            if langs and _has_letter(texts[first + i].as_py()):
                names.append(langs[best[i]])
                scores.append(float(min(1.0, max(0.0, share[i, best[i]]))))
            else:
                names.append("und")
                scores.append(0.0)
    return pa.StructArray.from_arrays(
        [pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"]
    )
