"""p-stable hashing of vectors, its probes, and the search within a group. Nothing here knows Spark."""

import heapq
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

FARTHEST = 2.0**62  # slots farther out count as this one


def matrix(column):
    """A column of vectors of one length as rows of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def perturbations(n_slots, n_probes):
    """Sets of neighbouring slots to visit, likeliest first.

    Of a query's ``2 * n_slots`` neighbouring slots, number j is the one with the j-th nearest
    border. A set's score is the expected sum of squared distances to its borders; sets grow
    from the best ones in a heap. A set never moves one slot both ways.
    """
    m = 2 * n_slots
    j = np.arange(1, m + 1)
    far = m + 1 - j
    scale = 4 * (n_slots + 1) * (n_slots + 2)
    score = np.where(j <= n_slots, j * (j + 1) / scale, 1 - far / (n_slots + 1) + far * (far + 1) / scale)
    found, heap = [()], [(score[0], (0,))]
    while heap and len(found) <= n_probes:
        s, chosen = heapq.heappop(heap)
        if len({min(i, m - 1 - i) for i in chosen}) == len(chosen):
            found.append(chosen)
        after = chosen[-1] + 1
        if after < m:
            heapq.heappush(heap, (s - score[after - 1] + score[after], (*chosen[:-1], after)))
            heapq.heappush(heap, (s + score[after], (*chosen, after)))
    return found


@cache
def _padded(n_slots, n_probes):
    """The perturbations as a table; ``2 * n_slots`` stands for no slot."""
    sets = perturbations(n_slots, n_probes)
    table = np.full((len(sets), max(1, *map(len, sets))), 2 * n_slots)
    for row, chosen in zip(table, sets, strict=True):
        row[: len(chosen)] = chosen
    return table


@cache
def _drawn(seed, dimension, tables, slots):
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(tables, dimension, slots))
    shifts = rng.random((tables, slots))
    steps = rng.integers(0, 2**63, (tables, slots), np.uint64) * np.uint64(2) + np.uint64(1)
    return directions, shifts, steps


@dataclass(frozen=True)
class Hashes:
    """``tables`` hash tables; a vector's cell is given by ``slots`` projections on Gaussian, that
    is 2-stable, directions, cut into slots of ``width``. A cell's number adds a step for each
    slot, so a neighbouring cell's number is a sum as well."""

    dimension: int
    tables: int
    slots: int
    width: float
    probes: int
    seed: int = 7

    def _places(self, vectors, table):
        directions, shifts, steps = _drawn(self.seed, self.dimension, self.tables, self.slots)
        with np.errstate(over="ignore", invalid="ignore"):
            place = np.nan_to_num(vectors @ directions[table] / self.width + shifts[table])
        place = np.clip(place, -FARTHEST, FARTHEST)
        slot = np.floor(place)
        number = (slot.astype(np.int64).astype(np.uint64) * steps[table]).sum(1, dtype=np.uint64)
        return place - slot, number, steps[table]

    def cells(self, vectors, table):
        return self._places(vectors, table)[1]

    def probed(self, vectors, table):
        """The cells to visit for each vector, its own first."""
        inside, number, step = self._places(vectors, table)
        border = np.concatenate([inside, 1 - inside], 1)  # to the slot below, and above
        move = np.concatenate([np.uint64(0) - step, step])
        by_distance = np.append(
            move[np.argsort(border, 1, kind="stable")], np.zeros((len(vectors), 1), np.uint64), 1
        )
        moved = by_distance[:, _padded(self.slots, self.probes)].sum(2, dtype=np.uint64)
        return number[:, None] + moved


def ranges(low, high):
    """All numbers of the ranges, one range after the other."""
    size = high - low
    return np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())


def recall(sample, queries, nearest, hashes):
    """The share of ``nearest`` (row numbers for each query) among the candidates."""
    met = np.zeros((len(queries), len(sample)), bool)
    for table in range(hashes.tables):
        cell = hashes.cells(sample, table)
        order = np.argsort(cell, kind="stable")
        cell = cell[order]
        for row, probes in zip(met, hashes.probed(queries, table), strict=True):
            row[order[ranges(np.searchsorted(cell, probes), np.searchsorted(cell, probes, "right"))]] = True
    return np.take_along_axis(met, nearest, 1).mean()


def fit(sample, n_vectors, k, target, tables, probes, n_queries=100):
    """Hashes for ``n_vectors`` vectors of which ``sample`` are some: as many slots as keep
    cells at a few hundred vectors, and the least width at which the sample's own queries find
    ``target`` of their k nearest."""
    slots = max(4, round(np.log2(max(n_vectors, 2))) - 6)
    dimension = sample.shape[1]
    queries = sample[:n_queries]
    distance = np.stack([np.sqrt(((sample - q) ** 2).sum(1)) for q in queries])
    distance[np.arange(len(queries)), np.arange(len(queries))] = np.inf
    nearest = np.argsort(distance, 1, kind="stable")[:, : min(k, len(sample) - 1)]
    spread = sample @ np.random.default_rng(0).normal(size=dimension)
    spread = np.median(np.abs(spread - np.median(spread)))
    unit = spread if np.isfinite(spread) and spread > 0 else 1.0
    low, high = -8.0, 6.0  # powers of two: from a slot for each vector to one for nearly all
    if nearest.size:
        while high - low > 0.1:
            middle = (low + high) / 2
            hashes = Hashes(dimension, tables, slots, float(unit * 2**middle), probes)
            low, high = (low, middle) if recall(sample, queries, nearest, hashes) >= target else (middle, high)
    return Hashes(dimension, tables, slots, float(unit * 2**high), probes)


# --- rows ------------------------------------------------------------------------


def indexed(batches, hashes, n_groups, vectors=True):
    """Each point once per table: ``group, cell`` and the point's own columns."""
    for batch in batches:
        own = [n for n in batch.schema.names if vectors or n not in ("ids", "vector")]
        points = matrix(batch["vector"])
        for table in range(hashes.tables):
            cell = hashes.cells(points, table)
            group = table * n_groups + (cell % np.uint64(n_groups)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(group), pa.array(cell.view(np.int64)), *[batch[n] for n in own]], ["group", "cell", *own]
            )


def asking(batches, hashes, n_groups):
    """Each query once per group that it visits: ``group, cells`` (packed) and its own columns."""
    for batch in batches:
        queries = matrix(batch["vector"])
        for table in range(hashes.tables):
            cells = hashes.probed(queries, table)
            group = (cells % np.uint64(n_groups)).astype(np.int64)
            order = np.argsort(group, 1, kind="stable")
            cells, group = np.take_along_axis(cells, order, 1), np.take_along_axis(group, order, 1)
            for i in range(batch.num_rows):
                cuts = [0, *(np.flatnonzero(np.diff(group[i])) + 1).tolist(), group.shape[1]]
                packed = [cells[i, a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                groups = table * n_groups + group[i, cuts[:-1]]
                row = batch.slice(i, 1).take(pa.array([0] * len(packed)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(groups), pa.array(packed, pa.binary()), *row.columns], ["group", "cells", *batch.schema.names]
                )


def searched(points, queries, k):
    """For a group: ``(query, vec_id, score)``, the k nearest of each query among the points in
    the cells that it visits. Every distance is worked out on the vectors."""
    out = []
    if points.num_rows and queries.num_rows:
        cell = points["cell"].to_numpy().view(np.uint64)
        order = np.argsort(cell, kind="stable")
        cell = cell[order]
        vectors = matrix(points["vector"])[order]
        ids = points["ids"].combine_chunks().take(pa.array(order))
        names, asked = queries["query"].to_pylist(), matrix(queries["vector"])
        for name, vector, packed in zip(names, asked, queries["cells"], strict=True):
            probes = np.frombuffer(packed.as_buffer(), np.uint64)
            rows = ranges(np.searchsorted(cell, probes), np.searchsorted(cell, probes, "right"))
            if len(rows):
                with np.errstate(over="ignore"):
                    score = np.sqrt(((vectors[rows] - vector) ** 2).sum(1))
                if len(rows) > k:
                    near = score <= np.partition(score, k - 1)[k - 1]
                    rows, score = rows[near], score[near]
                lists = ids.take(pa.array(rows))
                score = np.repeat(score, pc.list_value_length(lists).to_numpy())
                vec_id = pc.list_flatten(lists).to_numpy()
                best = np.lexsort((vec_id, score))[:k]
                out.append((np.full(len(best), name), vec_id[best], score[best]))
    none = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    return pa.table(dict(zip(("query", "vec_id", "score"), map(np.concatenate, zip(*(out or none), strict=True)), strict=True)))
