"""Eigenvectors of a symmetric matrix by contour integration, interval by interval, and the sums
that whitening needs. Nothing here knows Spark."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

NODES = 16  # of the quadrature, on the upper half of the circle; the lower half mirrors it
ROUNDS = 8


def matrix(column):
    """A column of lists of one length as rows of 64-bit integers."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = pc.list_flatten(column).to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


# --- inertia -----------------------------------------------------------------------


def count_above(a, shift):
    """How many eigenvalues of ``a`` are greater than ``shift``, by Sylvester's law: as many as the
    block-diagonal factor of ``a - shift`` has positive ones.

    Elimination with pivots of one or two rows, chosen as in the factorisation of Bunch and
    Kaufman, so that no pivot is small against what it divides.
    """
    rest = a - shift * np.eye(len(a))
    bound = (1 + np.sqrt(17)) / 8
    positive = 0
    while len(rest):
        down = np.abs(rest[1:, 0])
        if not down.size or not down.max():
            positive += rest[0, 0] > 0
            rest = rest[1:, 1:]
            continue
        r = int(down.argmax()) + 1
        across = np.abs(rest[r])
        across[r] = 0
        if abs(rest[0, 0]) >= bound * down[r - 1] or abs(rest[0, 0]) * across.max() >= bound * down[r - 1] ** 2:
            pivot = [0]
        elif abs(rest[r, r]) >= bound * across.max():
            pivot = [r]
        else:
            pivot = [0, r]
        others = np.delete(np.arange(len(rest)), pivot)
        block, side = rest[np.ix_(pivot, pivot)], rest[np.ix_(others, pivot)]
        if len(pivot) == 1:
            positive += block[0, 0] > 0
        else:
            determinant = block[0, 0] * block[1, 1] - block[0, 1] * block[1, 0]
            positive += 1 if determinant < 0 else 2 * (block[0, 0] + block[1, 1] > 0)
        rest = rest[np.ix_(others, others)] - side @ np.linalg.solve(block, side.T)
        rest = (rest + rest.T) / 2
    return int(positive)


def intervals(a, n_largest, most):
    """Intervals ``(low, high, count)`` that hold the ``n_largest`` eigenvalues of ``a``, which are
    positive, from the greatest down, each with ``most`` of them at most unless they lie too
    close to be parted. Limits are found by halving and counting.

    An interval's low end is a quarter of its high end at least: on the scale of the circle, small
    eigenvalues outside would all lie on its border.
    """
    reach = np.abs(a).sum(1).max()
    tiny = reach * 1e-13

    def limit(wanted, low, high):
        """A shift with ``wanted`` eigenvalues above it, or where none is, with fewer, just above
        those that it cannot part."""
        while high - low > tiny:
            middle = (low + high) / 2
            above = count_above(a, middle)
            if above == wanted:
                return middle
            low, high = (middle, high) if above > wanted else (low, middle)
        return high

    n_largest = min(n_largest, len(a))
    found, above, high = [], 0, 2 * reach
    while above < n_largest:
        wanted = min(above + most, n_largest)
        low = max(limit(wanted, 0.0, high), high / 4)
        count = count_above(a, low)
        if count == above and low > high / 4:  # more than wanted at one place
            low = max(low - 4 * tiny, high / 4)
            count = count_above(a, low)
        if count > above:
            found.append((float(low), float(high), count - above))
        high, above = low, count
    return found


# --- the contour -------------------------------------------------------------------


def within(a, low, high, count, seed=0):
    """``(eigenvalues, eigenvectors)`` of ``a`` between ``low`` and ``high``, of which there are
    ``count``; eigenvectors are columns, the greatest eigenvalue first.

    A block of vectors is filtered by the rational function that the quadrature of the resolvent
    along a circle through both limits gives: near one on eigenvalues inside, near zero
    outside. Rayleigh and Ritz take the eigenvectors out of what is left. Rounds end when the
    residuals are at rounding level. Where eigenvalues crowd at the border, so that they do not
    get there, the block takes in more of them.
    """
    n = len(a)
    level = np.abs(a).sum(1).max() * 1e-14
    rng = np.random.default_rng(seed)
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(0.5j * np.pi * (nodes + 1))
    centre, radius = (low + high) / 2, (high - low) / 2
    size = count + max(4, count // 2)
    best = np.inf, None, None
    while True:
        size = min(n, size)
        block = np.linalg.qr(rng.normal(size=(n, size)))[0]
        for _ in range(ROUNDS):
            filtered = np.zeros_like(block)
            for weight, z in zip(weights, turn, strict=True):
                solved = np.linalg.solve((centre + radius * z) * np.eye(n) - a, block.astype(complex))
                filtered += weight / 2 * radius * (z * solved).real
            basis, strength, _ = np.linalg.svd(filtered, full_matrices=False)
            basis = basis[:, strength > strength[0] * 1e-14] if size < n else basis
            values, turned = np.linalg.eigh(basis.T @ a @ basis)
            vectors = basis @ turned
            inside = (values > low) & (values < high)
            if inside.sum() == count:
                residual = np.linalg.norm(a @ vectors - vectors * values, axis=0)[inside].max()
                before = best[0]
                if residual < before:
                    best = residual, values[inside][::-1], vectors[:, inside][:, ::-1]
                if best[0] <= level or (best[0] <= 100 * level and residual > before / 2):
                    return best[1], best[2]
            block = vectors
        if size == n:
            break
        size *= 2
    if best[0] <= 1e4 * level:
        return best[1], best[2]
    raise ArithmeticError(f"the contour found other than the {count} eigenvalues between {low} and {high}")


def components(batches, a):
    """For each interval a row per eigenvector: ``value, vector``."""
    for batch in batches:
        for low, high, count in zip(*(batch[c].to_pylist() for c in ("low", "high", "count")), strict=True):
            values, vectors = within(a, low, high, count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values), pa.array(list(vectors.T), pa.list_(pa.float64()))], ["value", "vector"]
            )


# --- sums over rows ----------------------------------------------------------------


def _cells(total):
    i, j = np.indices(total.shape)
    return pa.RecordBatch.from_arrays(
        [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], ["i", "j", "total"]
    )


def second_moments(batches, of_batch):
    """A task's sum of the outer products of the rows of ``of_batch(batch)``, entry by entry."""
    total = None
    for batch in batches:
        if batch.num_rows:
            rows = of_batch(batch)
            total = rows.T @ rows if total is None else total + rows.T @ rows
    if total is not None:
        yield _cells(total)


def centred(x, n, sums):
    """``x - sums / n`` in doubles: the whole part of the mean is taken off in integers."""
    whole = sums // n
    return (x - whole).astype(np.float64) - (sums - whole * n) / n


def deviation(x, n, sums):
    """``sum((n * x - sums) ** 2)`` of each row, exactly; null where it passes 64 bits."""
    # |x - whole| < most, so |n * x - sums| < n * (most + 1)
    whole = sums // n
    y, rest = x - whole, sums - whole * n
    most = int(np.abs(y).max(initial=0)) + 1
    if x.shape[1] * (n * most) ** 2 < 2**63:
        return pa.array(((n * y - rest) ** 2).sum(1))
    exact = ((n * y.astype(object) - rest.astype(object)) ** 2).sum(1)
    return pa.array([int(v) if v < 2**63 else None for v in exact], pa.int64())


def whitened(x, n, sums, values, vectors):
    return centred(x, n, sums) @ vectors / np.sqrt(values)


def rows_out(batches, n, sums, values, vectors):
    """Rows ``(vec_id, component, deviation, whitened)``."""
    for batch in batches:
        x = matrix(batch["x"])
        white = whitened(x, n, sums, values, vectors)
        m = white.shape[1]
        row = pa.array(np.repeat(np.arange(len(x)), m))
        yield pa.RecordBatch.from_arrays(
            [
                batch["vec_id"].take(row),
                pa.array(np.tile(np.arange(1, m + 1), len(x)), pa.int32()),
                deviation(x, n, sums).take(row),
                pa.array(white.ravel()),
            ],
            ["vec_id", "component", "deviation", "whitened"],
        )
