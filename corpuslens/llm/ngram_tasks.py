"""Shingle sets, word orders and pair checks inside tasks. Nothing here knows Spark."""

import numpy as np
import pyarrow as pa
import xxhash

from corpuslens.llm import text_tasks as T

KEY_BITS = 40  # of a shingle's hash, for counting; orders need no exact counts
FOLD = np.uint64(0x9E3779B97F4A7C15)
SLICE_BYTES = 2 << 20


def shingle_sets(texts, size):
    """``(hashes, bounds)``: the sorted distinct shingle hashes of each text.

    A shingle's hash folds those of its words. A text of fewer words has one shingle of all
    its words, without words it has none.
    """
    data, offsets = T.flat(texts)
    found = []
    for first, last in T.slices(offsets, SLICE_BYTES):
        found += _sets(T.LOWER[data[offsets[first] : offsets[last]]], offsets[first : last + 1] - offsets[first], size)
    bounds = np.zeros(len(found) + 1, np.int64)
    np.cumsum([len(x) for x in found], out=bounds[1:])
    return np.concatenate([np.zeros(0, np.uint64), *found]), bounds


def _sets(data, offsets, size):
    starts, ends, document = T.words(data, offsets)
    index, dictionary = T.distinct(data, starts, ends)
    word = T.hashed(dictionary)[index]
    n = max(0, len(word) - size + 1)
    folded = np.zeros(n, np.uint64)
    for i in range(size):
        folded = folded * FOLD + word[i : i + n]
    folded = T.mixed(folded)
    sets = []
    at = np.searchsorted(document, np.arange(len(offsets)))
    for low, high in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if high - low >= size:
            sets.append(np.unique(folded[low : high - size + 1]))
        elif high > low:
            whole = np.uint64(high - low)
            for w in word[low:high]:
                whole = np.uint64((int(whole) * int(FOLD) + int(w)) & (2**64 - 1))
            sets.append(T.mixed(np.array([whole])))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def fingerprints(hashes, bounds):
    """128 bits for each set; null for the empty set."""
    return [
        xxhash.xxh3_128_digest(hashes[a:b].tobytes()) if b > a else None
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
    ]


def _first_of_each(marks):
    seen = {}
    for i, mark in enumerate(marks):
        if mark is not None:
            seen.setdefault(mark, i)
    return seen


def _batch_keys(hashes, bounds, rows):
    """Distinct short keys of the given rows, with the number of rows that hold each."""
    parts = [hashes[bounds[i] : bounds[i + 1]] >> np.uint64(64 - KEY_BITS) for i in rows]
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *parts]), return_counts=True)


def requests(table, size, n_buckets):
    """Two kinds of rows for a batch of documents: each document with its set's fingerprint
    and size; and, per bucket of keys, the batch's keys with their counts."""
    batch = table["batch"][0].as_py()
    hashes, bounds = shingle_sets(table["text"], size)
    marks = fingerprints(hashes, bounds)
    keys, counts = _batch_keys(hashes, bounds, _first_of_each(marks).values())
    edges = np.searchsorted(keys, _bucket_edges(n_buckets))
    buckets, held, numbers = [], [], []
    for b in range(n_buckets):
        low, high = edges[b], edges[b + 1]
        if high > low:
            buckets.append(b)
            steps = np.diff(keys[low:high], prepend=np.uint64(0))
            held.append(T.planes(steps))
            numbers.append(T.planes(counts[low:high].astype(np.uint32)))
    n_docs, n = table.num_rows, table.num_rows + len(buckets)
    nothing = [None] * len(buckets)
    return pa.table(
        {
            "batch": pa.array([batch] * n, pa.int32()),
            "doc_id": pa.concat_arrays([*table["doc_id"].chunks, pa.nulls(len(buckets), pa.int64())]),
            "text_hash": pa.concat_arrays([*table["text_hash"].chunks, pa.nulls(len(buckets), pa.int64())]),
            "mark": pa.array(marks + nothing, pa.binary()),
            "n_shingles": pa.array(np.diff(bounds).tolist() + nothing, pa.int64()),
            "bucket": pa.array([None] * n_docs + buckets, pa.int32()),
            "keys": pa.array([None] * n_docs + held, pa.binary()),
            "counts": pa.array([None] * n_docs + numbers, pa.binary()),
        }
    )


def _bucket_edges(n_buckets):
    span = 1 << KEY_BITS
    return np.array([span * b // n_buckets for b in range(n_buckets)] + [span], np.uint64)


def replies(table):
    """For one bucket of keys: to each batch, the counts over all batches, in its order."""
    held = [np.cumsum(T.from_planes(k, np.uint64), dtype=np.uint64) for k in table["keys"].to_pylist()]
    numbers = [T.from_planes(c, np.uint32).astype(np.int64) for c in table["counts"].to_pylist()]
    keys, place = np.unique(np.concatenate(held), return_inverse=True)
    total = np.bincount(place, weights=np.concatenate(numbers), minlength=len(keys))
    total = np.minimum(total, 2**32 - 1).astype(np.uint32)[place]
    cuts = np.cumsum([len(h) for h in held])[:-1]
    return pa.table(
        {
            "batch": table["batch"].cast(pa.int32()),
            "bucket": table["bucket"].cast(pa.int32()),
            "counts": pa.array([T.planes(x) for x in np.split(total, cuts)], pa.binary()),
            "mark": pa.nulls(table.num_rows, pa.binary()),
        }
    )


def orders(hashes, count):
    """Sort keys of the shingles under three global orders: by exact count, by magnitude of
    the count, by every second magnitude; each breaks ties by a hash of its own."""
    magnitude = np.log2(count).astype(np.int64)
    for rank, factor in ((count, 1), (magnitude, 0x9E3779B97F4A7C15), (magnitude >> 1, 0xC2B2AE3D27D4EB4F)):
        yield np.lexsort((hashes * np.uint64(factor), rank))


def prefix_length(n, percent):
    """Of two sets with that similarity, each has a common shingle among its first so many."""
    return n - (percent * n + 99) // 100 + 1


def records(documents, answers, size, percent):
    """For the sets of a batch that may have a partner: size, shingles that other sets also
    hold, and their prefixes under each order. The others share no prefix with any set."""
    if documents.num_rows == 0:
        return _no_records()
    kept = [(b, c) for b, c in zip(answers["bucket"].to_pylist(), answers["counts"].to_pylist(), strict=True) if b is not None]
    chosen = {m for m in answers["mark"].to_pylist() if m is not None}
    hashes, bounds = shingle_sets(documents["text"], size)
    first = _first_of_each(fingerprints(hashes, bounds))
    keys, _ = _batch_keys(hashes, bounds, first.values())
    counts = np.concatenate([np.zeros(0, np.uint32), *(T.from_planes(c, np.uint32) for _, c in sorted(kept))])
    rows = []
    for mark, i in first.items():
        if mark not in chosen:
            continue
        own = hashes[bounds[i] : bounds[i + 1]]
        count = counts[np.searchsorted(keys, own >> np.uint64(64 - KEY_BITS))].astype(np.int64)
        length = prefix_length(len(own), percent)
        if np.count_nonzero(count == 1) >= length:
            continue  # under every order the prefix is of shingles that no other set has
        prefixes = [own[o[:length]] for o in orders(own, count)]
        single = [count[o[:length]] == 1 for o in orders(own, count)]
        prefixes = [p[~s].view(np.int64) for p, s in zip(prefixes, single, strict=True)]
        if all(len(p) for p in prefixes):
            rows.append((mark, len(own), own[count > 1].view(np.int64), *prefixes))
    if not rows:
        return _no_records()
    columns = list(zip(*rows, strict=True))
    lists = pa.list_(pa.int64())
    return pa.table(
        {
            "mark": pa.array(columns[0], pa.binary()),
            "n": pa.array(columns[1], pa.int64()),
            "shared": pa.array(columns[2], lists),
            "prefix_1": pa.array(columns[3], lists),
            "prefix_2": pa.array(columns[4], lists),
            "prefix_3": pa.array(columns[5], lists),
        }
    )


def _no_records():
    lists = pa.list_(pa.int64())
    return pa.schema(
        [("mark", pa.binary()), ("n", pa.int64()), ("shared", lists), ("prefix_1", lists), ("prefix_2", lists), ("prefix_3", lists)]
    ).empty_table()


def _common(lists, most_cells=1 << 21):
    """How many numbers each two of the lists have in common, as a matrix."""
    sizes = np.array([len(x) for x in lists])
    values = np.concatenate([np.zeros(0, np.int64), *(np.asarray(x, np.int64) for x in lists)])
    row = np.repeat(np.arange(len(lists)), sizes)
    keys, place, held = np.unique(values, return_inverse=True, return_counts=True)
    number = np.full(len(keys), -1, np.int64)
    twice = held > 1
    number[twice] = np.arange(np.count_nonzero(twice))
    column = number[place]
    row, column = row[column >= 0], column[column >= 0]
    by = np.argsort(column, kind="stable")
    row, column = row[by], column[by]
    total = np.zeros((len(lists), len(lists)), np.float32)
    width = max(1, most_cells // max(1, len(lists)))
    for low in range(0, np.count_nonzero(twice), width):
        a, b = np.searchsorted(column, (low, low + width))
        part = np.zeros((len(lists), width), np.float32)
        part[row[a:b], column[a:b] - low] = 1
        total += part @ part.T
    return total


def linked_in_cell(table, percent):
    """One row for each set of a cell that has a link in it: a representative of the linked
    sets and the number of its links.

    The cell compares its two blocks, or one block with itself. Only pairs that share a
    prefix shingle under every order are verified.
    """
    left = np.array(table["block"].to_pylist()) == table["low"][0].as_py()
    alone = table["low"][0].as_py() == table["high"][0].as_py()
    allowed = ~np.eye(len(left), dtype=bool)
    if not alone:
        allowed &= left[:, None] != left[None, :]
    for name in ("prefix_1", "prefix_2", "prefix_3"):
        if not allowed.any():
            break
        allowed &= _common(_lists(table[name])) > 0
    marks = table["mark"].to_pylist()
    if allowed.any():
        n = np.array(table["n"].to_pylist())
        both = _common(_lists(table["shared"])).astype(np.int32)
        allowed &= 100 * both >= percent * (n[:, None] + n[None, :] - both)
    root = np.arange(len(marks))
    while True:
        least = np.where(allowed, root[None, :], len(marks)).min(1, initial=len(marks))
        least = np.minimum(root, least)
        least = least[least]
        if (least == root).all():
            break
        root = least
    degree = allowed.sum(1)
    rows = np.flatnonzero(degree)
    return pa.table(
        {
            "mark": pa.array([marks[i] for i in rows], pa.binary()),
            "partner": pa.array([marks[root[i]] for i in rows], pa.binary()),
            "links": pa.array(degree[rows], pa.int64()),
        }
    )


def _lists(column):
    values = pa.concat_arrays(column.chunks)
    bounds = values.offsets.to_numpy()
    return np.split(values.values.to_numpy(), bounds[1:-1]) if len(values) else []
