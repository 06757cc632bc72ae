"""Whitening of embeddings: eigenvectors in single precision, refined by matrix products.

The covariance of all distinct vectors is summed up in Spark on whole numbers, centred before they
are multiplied, so it is exact. Its eigenvectors are computed in single precision and corrected by
Ogita-Aishima steps, which are products of matrices in extended precision: every step about doubles
the digits that are right. Eigenvectors whose eigenvalues are too close for a step to tell apart are
turned by an eigenproblem of their own, with what they share taken off.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.operators.scratch import written

SCALE, SHIFT = 64, 1_000_000
# Whole numbers beyond this, which only absurd components have, are set to it.
LIMIT = float(1 << 62)
STEPS = 40
# Eigenvalues up to this share of the largest, times the dimensions, are taken for zero.
NOTHING = 1e-16


def whole_numbers(vector: Column) -> Column:
    """floor(64 c) + 1000000 for every component; NULL unless all components are finite numbers."""
    values = vector.cast("array<double>")
    finite = F.forall(
        values, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
    )
    clipped = F.transform(
        values,
        lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(LIMIT)), F.lit(-LIMIT))) + F.lit(SHIFT),
    )
    return F.when(finite & (F.size(values) > 0), clipped)


def _matrix(frame: pa.RecordBatch) -> np.ndarray:
    lists = frame.column("x")
    return lists.flatten().to_numpy().reshape(len(lists), -1) if len(lists) else np.empty((0, 0), np.int64)


def _sums(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact sums per dimension of a task, as upper and lower halves, and its number of rows."""
    n, high, low = 0, 0, 0
    for x in map(_matrix, frames):
        if len(x):
            n, high, low = n + len(x), high + (x >> 32).sum(0), low + (x & 0xFFFFFFFF).sum(0)
    if n:
        columns = [pa.array(np.arange(len(high), dtype=np.int32)), pa.array(high), pa.array(low),
                   pa.array(np.full(len(high), n, np.int64))]
        yield pa.RecordBatch.from_arrays(columns, ["dim", "high", "low", "n"])


def products(rows: DataFrame, prepared: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Sum of outer products of the ``width`` numbers that ``prepared`` makes of every vector ``x``.

    A task adds up its rows and gives one row per dimension; one group per dimension adds the tasks'
    rows. The driver gets ``width`` rows.
    """

    def partial(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for x in map(_matrix, frames):
            if len(x):
                y = prepared(x)
                total += y.T @ y
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))],
            ["dim", "values"],
        )

    def added(table: pa.Table) -> pa.Table:
        values = table["values"].combine_chunks().flatten().to_numpy().reshape(-1, width)
        return pa.table({"dim": table["dim"][:1], "values": pa.array([values.sum(0)], pa.list_(pa.float64()))})

    schema = "dim int, values array<double>"
    found = rows.mapInArrow(partial, schema).groupBy("dim").applyInArrow(added, schema)
    out = np.zeros((width, width))
    for row in found.toArrow().to_pylist():
        out[row["dim"]] = row["values"]
    return out


def _joined(close: np.ndarray) -> list[np.ndarray]:
    """Groups of more than one place that are linked, directly or over others."""
    n = len(close)
    label = np.arange(n)
    while True:
        least = np.where(close | np.eye(n, dtype=bool), label[None, :], n).min(axis=1)
        if (least == label).all():
            break
        label = least
    return [g for k in np.unique(label) if len(g := np.flatnonzero(label == k)) > 1]


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix.

    ``matrix`` is in extended precision. The start is in single precision; see the module. What is
    left is rounding in extended precision: about 1e-19 times the norm over the gap to the next
    eigenvalue in a vector.
    """
    a = matrix.astype(np.longdouble)
    n, one = len(a), np.eye(len(a), dtype=np.longdouble)
    scale = np.abs(a).max()
    if not scale:
        return np.zeros(n, dtype=np.longdouble), one
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    size, tiny = np.sqrt((a * a).sum()), np.finfo(np.longdouble).eps * n
    for _ in range(STEPS):
        r, s = one - x.T @ x, x.T @ (a @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values)
        spread = 2 * (np.sqrt((off * off).sum()) + size * np.sqrt((r * r).sum()))
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > spread
        step = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + x @ step
        unsettled = False
        for some in _joined(~apart):
            part = x[:, some]
            centre = values[some].mean()
            own = part.T @ (a @ part) - centre * (part.T @ part)
            width = np.abs(own).max()
            turned = np.abs(own - np.diag(np.diag(own))).max()
            # Below the precision of the products they are one eigenvalue: any basis will do.
            if width > 8 * tiny * size and turned > tiny * width:
                x[:, some] = part @ np.linalg.eigh((own / width).astype(np.float64))[1]
                unsettled = True
        # What rounding in the products alone makes of a step, which no further step can mend.
        rounding = 4 * tiny * size / np.where(apart, np.abs(gap), size)
        if not unsettled and (np.abs(step) <= np.finfo(np.float64).eps / 64 + rounding).all():
            break
    for _ in range(2):
        x = x + x @ (one - x.T @ x) / 2
    values = np.diag(x.T @ (a @ x)) / (x * x).sum(0)
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt((x * x).sum(0))[order]
    signs = np.sign(x[np.abs(x).argmax(axis=0), np.arange(n)])
    return values[order] * scale, x * np.where(signs == 0, 1, signs)


@dataclass(frozen=True)
class Whitening:
    """What is learnt from the distinct vectors: see :func:`learn`."""

    n: int
    sums: list[int]
    centre: np.ndarray
    components: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def rest(self) -> np.ndarray:
        """Exact n (mean - centre), per dimension."""
        return np.array([s - self.n * int(c) for s, c in zip(self.sums, self.centre)], dtype=object)

    def whitened(self) -> Callable[[np.ndarray], np.ndarray]:
        centre, rest = self.centre, (self.rest / self.n).astype(np.float64)
        turn = self.components / np.sqrt(self.values)
        return lambda x: ((x - centre).astype(np.float64) - rest) @ turn


def _usable(vectors: DataFrame, vector_col: str) -> tuple[DataFrame, int]:
    """Rows with whole numbers ``x`` of the commonest length (of several, the longest)."""
    rows = vectors.withColumn("x", whole_numbers(F.col(vector_col))).where("x IS NOT NULL")
    sizes = rows.groupBy(F.size("x").alias("size")).count()
    first = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    width = first["size"] if first else 0
    return rows.where(F.size("x") == width), width


def distinct_vectors(vectors: DataFrame, vector_col: str = "embedding") -> tuple[DataFrame, int]:
    rows, width = _usable(vectors.select(vector_col), vector_col)
    return written(rows.select("x").distinct(), "fit"), width


def learn(fit: DataFrame, width: int, components: int = 16) -> Whitening | None:
    """Mean, covariance and leading components of distinct vectors ``x``; None if there are none.

    Components without variance are left out.
    """
    halves = fit.mapInArrow(_sums, "dim int, high long, low long, n long")
    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    rows = sorted(halves.groupBy("dim").agg(*exact, F.sum("n").alias("n")).collect())
    if not rows:
        return None
    n, sums = rows[0].n, [(int(r.high) << 32) + int(r.low) for r in rows]
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)
    gram = products(fit, lambda x: (x - centre).astype(np.float64), width)
    rest = np.array([s - n * int(c) for s, c in zip(sums, centre)], dtype=object)
    whole = np.vectorize(int, otypes=[object])
    exact_cov = n * whole(gram) - rest[:, None] * rest[None, :]
    high = exact_cov.astype(np.float64)
    low = (exact_cov - whole(high)).astype(np.float64)
    cov = (high.astype(np.longdouble) + low.astype(np.longdouble)) / np.longdouble(n) / np.longdouble(n)
    values, vectors = eigen(cov)
    some = int((values > NOTHING * width * values[0]).sum()) if values[0] > 0 else 0
    some = min(some, components)
    return Whitening(
        n, sums, centre, vectors[:, :some].astype(np.float64), values[:some].astype(np.float64),
        float(np.trace(cov)),
    )


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened vectors' covariance less the identity."""
    k, whitened = len(model.values), model.whitened()
    sums = products(fit, lambda x: np.column_stack((whitened(x), np.ones(len(x)))), k + 1)
    mean = sums[k, :k] / model.n
    return float(np.abs(sums[:k, :k] / model.n - np.outer(mean, mean) - np.eye(k)).max(initial=0))


def _applied(model: Whitening):
    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whitened, rest = model.whitened(), model.rest
        for frame in frames:
            x = _matrix(frame)
            if not len(x):
                continue
            y = x - model.centre
            # Whole numbers of 64 bits where the sum is sure to fit, of any size elsewhere.
            reach = model.n * int(np.abs(y).max()) + int(np.abs(rest).max())
            if reach * reach * x.shape[1] < 1 << 63:
                parts = model.n * y - rest.astype(np.int64)
                deviation = pa.array((parts * parts).sum(1))
            else:
                exact = ((model.n * y.astype(object) - rest) ** 2).sum(1)
                deviation = pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())
            values = pa.array(list(whitened(x)), pa.list_(pa.float64()))
            columns = [frame.column("vec_id"), deviation, values]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "deviation", "values"])

    return batches


def whiten(
    vectors: DataFrame, components: int = 16, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Per usable row and component: vec_id, component, n, deviation, whitened, explained,
    identity_error.

    Rows whose vector is NULL, empty or holds a NULL or non-finite number are dropped, and so are
    vectors of another length than the commonest. Every distinct vector counts once in the fit; rows
    repeated with one vector are all returned, a NULL id among them. ``deviation`` is the exact sum
    of (n x - S)^2, NULL beyond 63 bits. Components without variance are left out: one distinct
    vector, or an empty table, gives no rows. Of equal eigenvalues any basis may be returned, the same
    for all rows. Other columns are not looked at.
    """
    given = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    fit, width = distinct_vectors(given, "vector")
    model = learn(fit, width, components) if width else None
    if model is None or not len(model.values):
        return given.sparkSession.createDataFrame(
            [], "vec_id long, component int, n long, deviation long, whitened double, explained double, "
            "identity_error double")  # fmt: skip
    error = identity_error(fit, model)
    rows = given.withColumn("x", whole_numbers(F.col("vector"))).where(F.size("x") == width)
    found = rows.select("vec_id", "x").mapInArrow(
        _applied(model), "vec_id long, deviation long, values array<double>"
    )
    explained = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    listed = found.select("vec_id", "deviation", F.posexplode("values").alias("place", "whitened"))
    return listed.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
