"""Whitening of embeddings: principal components of equal variance, by contour integration.

1. Vectors become integers. Their number, their sums and their covariance come from passes
   over all rows, added up within tasks; a task sends one number for each entry of the
   covariance, which is the only thing that the driver gets (``MOST_DIMENSIONS`` bounds it).
2. The greatest eigenvalues are shut in intervals by inertia counts: how many eigenvalues lie
   above a shift follows from the signs of a factorisation. The counts say how many each
   interval holds.
3. For each interval, a task of its own, the resolvent ``(z - V)^-1`` is integrated by quadrature
   along a circle in the complex plane through the interval's ends: solves with shifted
   covariances turn a block of vectors into a projection on the eigenvectors inside. Rayleigh
   and Ritz extract these; a round repeats until residuals are at rounding level. An interval that
   gives another number than its count is an error, so none is missed.
4. Each row is projected where it is read. The covariance of the projections is worked out from
   the rows themselves, and its distance from the identity is returned.

Defined results: rows whose vector is null, empty, or has a null or non-finite entry take no
part, nor do those of another length than most rows have (of equally frequent ones, the
longest). Rows are independent, so repeated rows, equal or null vec_ids and ties need no rule.
Components of no variance (an eigenvalue at or below rounding level of the greatest) have no
whitened value and are left out; so where all rows are equal, and in an empty table, there is
no row. ``deviation`` is null where it passes 64 bits. Other columns are ignored.
"""

import math

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm import spectrum_tasks
from corpuslens.llm.stored import stored

COMPONENTS = 32
IN_INTERVAL = 8  # eigenvalues, at most, that one circle takes
MOST_DIMENSIONS = 4096  # a covariance of 134 MB
SCALE, SHIFT = 64, 1_000_000  # fixed values: c becomes floor(64 * c) + 1000000

# Tasks get these functions with the query and need no copy of the package.
cloudpickle.register_pickle_by_value(spectrum_tasks)


def integers(rows: DataFrame) -> DataFrame:
    """``(vec_id, x)`` of the rows that take part."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall("vector", lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
    whole = rows.select("vec_id", vector.alias("vector")).filter(finite & (F.size("vector") > 0))
    lengths = whole.groupBy(F.size("vector").alias("size")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("size")).first()
    x = F.transform("vector", lambda c: F.floor(c * SCALE).cast("long") + SHIFT)
    return whole.filter(F.size("vector") == (most["size"] if most else 0)).select("vec_id", x.alias("x"))


def _moments(rows: DataFrame, of_batch, size: int) -> np.ndarray:
    """The summed outer products of all rows."""
    cells = (
        rows.mapInArrow(lambda b: spectrum_tasks.second_moments(b, of_batch), "i int, j int, total double")
        .groupBy("i", "j")
        .agg(F.sum("total").alias("total"))
        .toArrow()
    )
    found = np.zeros((size, size))
    found[cells["i"].to_numpy(), cells["j"].to_numpy()] = cells["total"].to_numpy()
    return (found + found.T) / 2


def components(covariance: np.ndarray, spark, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` greatest eigenvalues with more than rounding errors, and their eigenvectors as
    columns. The intervals are shared out over the cluster."""
    floor = np.abs(covariance).sum(1).max() * len(covariance) * np.finfo(float).eps
    above = spectrum_tasks.count_above(covariance, floor)
    shut_in = spectrum_tasks.intervals(covariance, min(most, above), IN_INTERVAL)
    if not shut_in:
        return np.zeros(0), np.zeros((len(covariance), 0))
    sent = spark.sparkContext.broadcast(covariance)
    work = spark.createDataFrame(shut_in, "low double, high double, count long").repartition(len(shut_in), "low")
    found = work.mapInArrow(
        lambda b: spectrum_tasks.components(b, sent.value), "value double, vector array<double>"
    ).toArrow()
    values = found["value"].to_numpy()
    vectors = np.array(found["vector"].to_pylist())
    sent.destroy()
    order = np.argsort(-values, kind="stable")[:most]
    return values[order], vectors[order].T


def whiten(rows: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` for ``rows``
    (vec_id, embedding)."""
    spark = rows.sparkSession
    x = stored(integers(rows))
    size = x.agg(F.max(F.size("x"))).first()[0] or 0
    if size > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {size} entries; {MOST_DIMENSIONS} at most")
    totals = x.select(F.posexplode("x").alias("i", "x")).groupBy("i")
    totals = totals.agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("sum"), F.count("*").alias("n")).toArrow()
    n = totals["n"][0].as_py() if size else 0
    by_place = dict(zip(totals["i"].to_pylist(), map(int, totals["sum"].to_pylist()), strict=True))
    sums = np.array([by_place[i] for i in range(size)], np.int64)

    def centred(batch):
        return spectrum_tasks.centred(spectrum_tasks.matrix(batch["x"]), n, sums)

    covariance = _moments(x, centred, size) / max(n, 1)
    values, vectors = components(covariance, spark, most) if size else (np.zeros(0), np.zeros((0, 0)))
    trace = float(np.trace(covariance)) if size else 0.0
    model = n, sums, values, vectors

    def white(batch):
        return spectrum_tasks.whitened(spectrum_tasks.matrix(batch["x"]), *model)

    error = 0.0
    if len(values):
        error = float(np.abs(_moments(x, white, len(values)) / n - np.eye(len(values))).max())
    explained = F.element_at(F.array(*[F.lit(float(v / trace)) for v in values] or [F.lit(0.0)]), F.col("component"))
    kind = dict(x.dtypes)["vec_id"]
    out = x.mapInArrow(
        lambda b: spectrum_tasks.rows_out(b, *model),
        f"vec_id {kind}, component int, deviation long, whitened double",
    )
    return out.select(
        "vec_id",
        "component",
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained.alias("explained"),
        F.lit(error if math.isfinite(error) else None).cast("double").alias("identity_error"),
    )


def query(spark, directory: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{directory}/embeddings.parquet").select("vec_id", "embedding"))
