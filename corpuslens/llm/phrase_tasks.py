"""Phrases of a batch of texts, and the lockstep pass over a sorted stream of counts.

Nothing here knows Spark.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from corpuslens.llm import text_tasks as T

SLICE_BYTES = 2 << 20
LONGEST = 3
FOLD = np.uint64(0x9E3779B97F4A7C15)
NO_LANGUAGE = "und"
# The bytes at which pieces end, and those between words.
ENDS_PIECE = np.zeros(256, bool)
ENDS_PIECE[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
BETWEEN_WORDS = ENDS_PIECE.copy()
BETWEEN_WORDS[[0x20, 0x09]] = True


class _Slice:
    """The words of some texts as numbers of distinct words, and where phrases of two and of
    three words start: at words whose next ones are in the same piece."""

    def __init__(self, data, offsets):
        starts, ends, self.document = T.words(data, offsets, BETWEEN_WORDS)
        self.index, self.dictionary = T.distinct(data, starts, ends)
        self.index = self.index.astype(np.int64)
        piece = np.cumsum(ENDS_PIECE[data], dtype=np.int32)[starts]
        n = len(starts)
        near = np.zeros(n, bool)
        near[:-1] = (piece[1:] == piece[:-1]) & (self.document[1:] == self.document[:-1])
        self.starts = [np.arange(n), np.flatnonzero(near), np.flatnonzero(near[:-1] & near[1:])]

    def keys(self, language, bits):
        """For each length, a hash of ``bits`` bits for each phrase and its language."""
        word = T.mixed(T.hashed(self.dictionary)[self.index] ^ language[self.document])
        found, folded = [], np.zeros(len(word), np.uint64)
        for length, starts in enumerate(self.starts):
            folded = folded[: len(word) - length] * FOLD + word[length:]
            found.append(T.mixed(folded[starts]) >> np.uint64(64 - bits))
        return found


def _slices(table):
    """``(slice, languages of its documents)``."""
    data, offsets = T.flat(table["text"])
    languages = np.array(table["lang"].fill_null(NO_LANGUAGE).to_pylist(), object)
    for first, last in T.slices(offsets, SLICE_BYTES):
        part = T.LOWER[data[offsets[first] : offsets[last]]]
        yield _Slice(part, offsets[first : last + 1] - offsets[first]), languages[first:last]


def _hashes(languages):
    hash_of = {name: xxhash.xxh3_64_intdigest(name) for name in set(languages)}
    return np.array([hash_of[name] for name in languages], np.uint64)


def _merged(keys, counts):
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else []
    return (keys[first], np.add.reduceat(counts, first)) if len(keys) else (keys, counts)


def _packed(keys):
    return T.planes(np.diff(keys, prepend=np.uint64(0)))


def _unpacked(data):
    return np.cumsum(T.from_planes(data, np.uint64), dtype=np.uint64)


def requests(table, bits, n_buckets):
    """For a batch: its distinct phrase keys with their numbers, a packed row per bucket. Buckets
    are ranges of keys."""
    keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for part, languages in _slices(table):
        found, n = np.unique(np.concatenate(part.keys(_hashes(languages), bits)), return_counts=True)
        keys.append(found)
        counts.append(n)
    keys, counts = _merged(np.concatenate(keys), np.concatenate(counts))
    limits = [(b << bits) // n_buckets for b in range(1, n_buckets)]
    cuts = [0, *np.searchsorted(keys, np.array(limits, np.uint64)).tolist(), len(keys)]
    rows = [(b, x, y) for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if y > x]
    return pa.table(
        {
            "batch": pa.array([table["batch"][0].as_py()] * len(rows), pa.int32()),
            "bucket": pa.array([b for b, _, _ in rows], pa.int32()),
            "keys": pa.array([_packed(keys[x:y]) for _, x, y in rows], pa.binary()),
            "counts": pa.array([T.planes(counts[x:y].astype(np.uint32)) for _, x, y in rows], pa.binary()),
        }
    )


def replies(table, least):
    """For a bucket: to each batch those of its keys that the corpus has ``least`` times."""
    asked = [_unpacked(x.as_py()) for x in table["keys"]]
    counts = [T.from_planes(x.as_py(), np.uint32).astype(np.int64) for x in table["counts"]]
    keys, n = _merged(np.concatenate(asked), np.concatenate(counts))
    often = keys[n >= least]
    return pa.table(
        {
            "batch": table["batch"].combine_chunks(),
            "keys": pa.array([_packed(np.intersect1d(x, often, assume_unique=True)) for x in asked], pa.binary()),
        }
    )


def _grouped(*columns):
    """``(an index of each distinct row, the group of every row)``."""
    group = np.zeros(len(columns[0]), np.int64)
    for column in columns:
        _, first, group = np.unique(group << 32 | column, return_index=True, return_inverse=True)
    return first, group


def counted(documents, answers, bits, n_buckets):
    """For a batch: rows ``(lang, w1, w2, w3, n)`` of its phrases whose keys were answered, their
    words written out, and of each language a row without words for all its words; sorted,
    compressed, a piece for each bucket."""
    often = np.concatenate([np.zeros(0, np.uint64), *(_unpacked(x.as_py()) for x in answers["keys"])])
    often.sort()
    words, names, held, totals = {}, {}, [], {}
    for part, languages in _slices(documents):
        number = np.array([words.setdefault(w, len(words)) for w in part.dictionary.to_pylist()], np.int64)
        name = np.array([names.setdefault(x, len(names)) for x in languages], np.int64)
        for x, n in enumerate(np.bincount(name[part.document], minlength=len(names)).tolist()):
            totals[x] = totals.get(x, 0) + n
        rows = []
        for length, (key, starts) in enumerate(zip(part.keys(_hashes(languages), bits), part.starts, strict=True)):
            place = np.searchsorted(often, key)
            starts = starts[np.append(often, 0)[place] == key] if len(often) else starts[:0]
            # 0 stands for no word
            row = [number[part.index[starts + i]] + 1 if i <= length else np.zeros(len(starts), np.int64) for i in range(LONGEST)]
            rows.append([name[part.document[starts]], *row])
        columns = [np.concatenate(x) for x in zip(*rows, strict=True)]
        first, group = _grouped(*columns)
        held.append([*(c[first] for c in columns), np.bincount(group, minlength=len(first))])
    whole = [[x, 0, 0, 0, n] for x, n in totals.items() if n]
    held.append(np.array(whole, np.int64).reshape(-1, 5).T)
    columns = [np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*held, strict=True)]
    first, group = _grouped(*columns[:-1])
    numbers = np.bincount(group, columns[-1], len(first)).astype(np.int64)
    columns = [c[first] for c in columns[:-1]]
    used = np.unique(np.concatenate(columns[1:]))
    spelled = [None, *words]
    spelled = pa.array([spelled[i] for i in used.tolist()], pa.string())
    of_word = np.append(T.hashed(spelled.drop_null()), np.uint64(0))
    places = [np.searchsorted(used, c) for c in columns[1:]]
    has_none = len(used) > 0 and used[0] == 0
    bucket = _hashes(list(names))[columns[0]] if names else np.zeros(0, np.uint64)
    for at in places:
        bucket = T.mixed(bucket * FOLD + of_word[at - has_none])
    bucket = (bucket % np.uint64(n_buckets)).astype(np.int64)
    order = np.lexsort((*places[::-1], columns[0], bucket))
    table = pa.record_batch(
        {
            "lang": pa.array(list(names), pa.string()).take(pa.array(columns[0][order])),
            **{f"w{i + 1}": spelled.take(pa.array(at[order])) for i, at in enumerate(places)},
            "n": numbers[order],
        }
    )
    cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1)).tolist()
    pieces = [(b, table.slice(x, y - x)) for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if y > x]
    return pa.table(
        {
            "bucket": pa.array([b for b, _ in pieces], pa.int32()),
            "rows": pa.array([_written(rows) for _, rows in pieces], pa.binary()),
        }
    )


def _written(rows):
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(rows)
    return sink.getvalue().to_pybytes()


def summed(table, least):
    """For a bucket: its rows added up, those of phrases of less than ``least`` left out."""
    rows = pa.concat_tables([pa.ipc.open_stream(x.as_buffer()).read_all() for x in table["rows"]])
    keys = ["lang", "w1", "w2", "w3"]
    sums = rows.group_by(keys, use_threads=False).aggregate([("n", "sum")]).rename_columns([*keys, "n"])
    return sums.filter(pc.or_(pc.is_null(sums["w1"]), pc.greater_equal(sums["n"], least)))


# --- the lockstep pass ---------------------------------------------------------


def lockstep(batches):
    """Rows ``(lang, k1, k2, k3, n, near_1, near_2, longest)`` of a sorted stream of phrases, in
    which the parts of a phrase, its first one and first two words, stand before it.

    ``near_1`` and ``near_2`` are the numbers of these parts, which are the last rows of their
    length that went by; ``longest`` is the greatest number of a phrase of three words after
    one of two. At the head of the stream a part may have gone by in the stream before: its
    number is null then, and what it has to learn is a row without ``n``.
    """
    last, held = {1: None, 2: None}, None
    for batch in batches:
        if not batch.num_rows:
            continue
        n = batch["n"].to_numpy()
        length = 1 + sum(batch[c].is_valid().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("k2", "k3"))
        near = {}
        for part in (1, 2):
            place = np.maximum.accumulate(np.where(length == part, np.arange(len(n)), -1))
            known = np.where(place >= 0, n[place], -1 if last[part] is None else last[part])
            near[part] = pa.array(known, mask=(known < 0) | (length <= part))
            last[part] = None if known[-1] < 0 else int(known[-1])
        starts = np.flatnonzero(length < 3)  # rows that a run of three words may follow
        head = starts[0] if len(starts) else len(n)
        if head:
            most = int(n[:head].max())
            if held is None:
                held = batch.slice(0, 1).select(["lang", "k1", "k2"]), None, None, most
            else:
                held = *held[:3], max(held[3], most)
        longest = np.zeros(len(n), np.int64)
        kept = np.ones(len(n), bool)
        if len(starts):
            if held is not None:
                yield _held(*held)
            longest[starts] = np.maximum.reduceat(np.where(length == 3, n, 0), starts)
            at, held = int(starts[-1]), None
            if length[at] == 2:
                kept[at] = False
                held = batch.slice(at, 1).select(["lang", "k1", "k2"]), int(n[at]), near[1][at].as_py(), int(longest[at])
        rows = pa.RecordBatch.from_arrays(
            [*[batch[c] for c in ("lang", "k1", "k2", "k3")], pa.array(n), near[1], near[2], pa.array(longest)], ROW
        )
        yield rows.filter(pa.array(kept))
    if held is not None:
        yield _held(*held)


ROW = ["lang", "k1", "k2", "k3", "n", "near_1", "near_2", "longest"]


def _held(words, n, near, most):
    number = [pa.array([x], pa.int64()) for x in (n, near, None, most)]
    return pa.RecordBatch.from_arrays([*words.columns, pa.nulls(1, pa.string()), *number], ROW)
