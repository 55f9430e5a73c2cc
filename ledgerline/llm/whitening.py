"""Whitening of integer vectors by principal components, found by QDWH spectral divide and conquer.

1. Every entry c of a vector becomes ``x = floor(scale * c)``. The fit list holds each distinct
   x vector once: a grouping whose partial aggregation sends a repeated vector once from each task.
2. One pass over the list gives its size and the exact sums of each dimension, a second one the
   products of centred entries. A task adds up its own rows and sends one small matrix.
3. The covariance, which has the size of the dimension squared whatever the number of rows, is taken apart on
   the driver: the polar factor U of the covariance less a shift, by dynamically weighted Halley
   steps, gives the spectral projector (U + I) / 2 on the components above the shift. An
   orthogonal basis of its range and one of the rest split the matrix in two smaller ones, and so on
   until single components are left.
4. Mean and components go to every task, which centres, projects and scales its rows in place.

Defined results: a row takes no part if its vector is null or empty, holds a null or non-finite entry or
one whose x needs more than 62 bits, or has another length than most rows have (of several such
lengths the longest). Rows with a null id and repeated rows are whitened as any other; repeated vectors count
once in the fit. A component without variance (up to rounding) has 0 as its whitened values and its share.
There are no more components than dimensions. A deviation beyond 63 bits is null. An empty table,
or one without a whole vector, gives an empty result. Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.frames import small_batches, stored

EPS = np.finfo(float).eps
#: Beyond this magnitude integer sums are kept as Python integers.
SMALL = 1 << 40
#: Where a split's shift may lie, in standard deviations of the eigenvalues from their mean.
PLACES = (0.0, 0.05, -0.05, 0.2, -0.2, 0.5, -0.5)


# ---- the spectral part


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by QDWH; symmetric too."""
    one = np.eye(len(a))
    x = a / np.linalg.norm(a)
    try:
        least = 1 / np.abs(np.linalg.inv(x)).sum(axis=0).max()
    except np.linalg.LinAlgError:
        least = EPS
    least = min(max(least, EPS), 1.0)
    for _ in range(40):
        square = least * least
        root = np.cbrt(4 * (1 - square) / (square * square))
        p = np.sqrt(1 + root)
        w = p + np.sqrt(max(8 - 4 * root + 8 * (2 - square) / (square * p), 0.0)) / 2
        b = (w - 1) ** 2 / 4
        c = w + b - 1
        if c > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, one]))
            new = (b / c) * x + ((w - b / c) / np.sqrt(c)) * (q[: len(a)] @ q[len(a) :].T)
        else:
            new = (b / c) * x + (w - b / c) * np.linalg.solve(one + c * (x @ x), x)
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x = new
        least = min(least * (w + b * square) / (1 + c * square), 1.0)
        if moved <= 8 * EPS * np.sqrt(len(a)) * len(a):
            break
        if 1 - least < EPS and moved < 1e-7:
            break
    return x


def _split(a: np.ndarray) -> tuple[np.ndarray, int] | None:
    """An orthogonal basis whose first columns span the components above some shift, and how many they are."""
    n = len(a)
    mean = np.trace(a) / n
    spread = np.linalg.norm(a - mean * np.eye(n)) / np.sqrt(n)
    start = np.random.default_rng(n).standard_normal((n, n))
    for shift in [float(np.median(np.diag(a))), *[mean + t * spread for t in PLACES]]:
        moved = a - shift * np.eye(n)
        if not np.linalg.norm(moved):
            continue
        u = polar(moved)
        above = (u + np.eye(n)) / 2
        k = round(float(np.trace(above)))
        if not 0 < k < n or np.linalg.norm(u @ u - np.eye(n)) > 1e-9:
            continue  # nothing on one side, or a component that lies at the shift
        basis = start
        for _ in range(2):
            basis = np.hstack([above @ basis[:, :k], basis[:, k:] - above @ basis[:, k:]])
            basis, _ = np.linalg.qr(basis)
        if np.linalg.norm(basis[:, k:].T @ a @ basis[:, :k]) <= 1e-10 * max(np.linalg.norm(a), EPS):
            return basis, k
    return None


def components(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues from the largest, unit eigenvectors as columns) of a symmetric matrix."""
    n = len(covariance)
    a = (covariance + covariance.T) / 2
    size = np.linalg.norm(a)
    values: list[float] = []
    vectors: list[np.ndarray] = []
    todo = [(a, np.eye(n))]
    while todo:
        block, basis = todo.pop()
        k = len(block)
        flat = np.linalg.norm(block - np.trace(block) / k * np.eye(k)) <= 4 * EPS * n * size
        found = None if flat else _split(block)
        if found is None:
            # One component, or several that rounding can't tell apart.
            values += np.diag(block).tolist()
            vectors += list(basis.T)
            continue
        turn, above = found
        for part in (turn[:, :above], turn[:, above:]):
            inner = part.T @ block @ part
            todo.append(((inner + inner.T) / 2, basis @ part))
    order = np.argsort(-np.array(values), kind="stable")
    columns, _ = np.linalg.qr(np.array(vectors)[order].T)
    return np.array(values)[order], columns


# ---- the distributed part


def _whole(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, x) of the rows whose vector is whole."""

    def scaled(c: Column) -> Column:
        return F.floor(F.lit(float(scale)) * c).cast("long")

    entry = F.col("embedding").cast("array<double>")
    fits = F.forall(entry, lambda c: c.isNotNull() & (F.abs(c * float(scale)) < float(1 << 62)))  # false for NaN and infinity
    rows = vectors.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.coalesce(fits & ~F.exists(entry, F.isnan), F.lit(False)))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(entry, scaled).alias("x"))


def _matrix(x: pd.Series) -> np.ndarray:
    return np.stack(x.to_numpy()).astype(np.int64, copy=False)


def _sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for each dimension, (i, sum), and the number of rows as that of dimension -1."""
    n, total = 0, 0
    for batch in batches:
        if len(batch):
            x = _matrix(batch["x"])
            n += len(x)
            total = total + (x if np.abs(x).max() < SMALL else x.astype(object)).sum(axis=0).astype(object)
    if n:
        yield pd.DataFrame({"i": range(-1, len(total)), "value": [str(n), *map(str, total)]})


def _products(mean: np.ndarray, turn: np.ndarray | None = None):
    """Rows (i, j, sum of products) of the task's centred rows, or of their projections on ``turn``.

    With ``turn``, (i, -1) are the projections' own sums.
    """

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, own = None, None
        for batch in batches:
            if len(batch):
                centred = _matrix(batch["x"]) - mean
                if turn is not None:
                    centred = centred @ turn
                total = centred.T @ centred if total is None else total + centred.T @ centred
                own = centred.sum(axis=0) if own is None else own + centred.sum(axis=0)
        if total is not None:
            i, j = np.triu_indices(len(total))
            out = pd.DataFrame({"i": i, "j": j, "value": total[i, j]})
            yield out if turn is None else pd.concat([out, pd.DataFrame({"i": range(len(own)), "j": -1, "value": own})])

    return over


def _symmetric(rows: list, size: int) -> np.ndarray:
    out = np.zeros((size, size))
    for r in rows:
        if r["j"] >= 0:
            out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["value"]
    return out


@dataclass(frozen=True)
class Whitening:
    """What was fitted: ``n`` distinct vectors, their sums, and all components by falling variance."""

    scale: int
    n: int
    sums: list[int]
    variances: np.ndarray
    vectors: np.ndarray
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def explained(self) -> list[float]:
        total = float(self.variances.sum())
        return [float(e) / total if total > 0 and e > 0 else 0.0 for e in self.variances]

    def matrix(self, k: int) -> np.ndarray:
        """Projection and scaling to the first ``k`` components."""
        return _scaled(self.variances, self.vectors, k)

    def apply(self, vectors: DataFrame, k: int) -> DataFrame:
        """(vec_id, deviation, whitened array of ``k``) for every whole row; deviation is the exact sum of (n*x - S)^2."""
        n, sums, mean, turn = self.n, np.array(self.sums, dtype=object), self.mean, self.matrix(k)
        high = max(map(abs, self.sums), default=0)

        def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if not len(batch):
                    continue
                x = _matrix(batch["x"])
                fits = len(sums) * (n * int(np.abs(x).max()) + high) ** 2 < 1 << 63
                if fits:
                    away = n * x - sums.astype(np.int64)
                    deviation = (away * away).sum(axis=1).tolist()
                else:
                    away = n * x.astype(object) - sums
                    deviation = [v if v < 1 << 63 else None for v in (away * away).sum(axis=1)]
                yield pd.DataFrame(
                    {
                        "vec_id": batch["vec_id"].astype("Int64"),
                        "deviation": pd.array(deviation, dtype="Int64"),
                        "whitened": list((x - mean) @ turn),
                    }
                )

        rows = _whole(vectors, self.scale).where(F.size("x") == len(self.sums))
        return rows.mapInPandas(over, "vec_id long, deviation long, whitened array<double>")


def _scaled(variances: np.ndarray, vectors: np.ndarray, k: int) -> np.ndarray:
    least = 4 * EPS * len(variances) * max(float(variances[0]), 0.0)
    own = variances[:k]
    return vectors[:, :k] * np.where(own > least, 1 / np.sqrt(np.where(own > least, own, 1.0)), 0.0)


def fit(vectors: DataFrame, k: int, scale: int = 256) -> Whitening | None:
    """The whitening of a table (vec_id, embedding), checked on its first ``k`` components; None without a whole vector."""
    small_batches(vectors.sparkSession)
    rows = _whole(vectors, scale).select("x")
    usual = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if usual is None:
        return None
    d = usual["d"]
    distinct = stored(rows.where(F.size("x") == d).distinct(), "whitening-fit")
    summed = distinct.mapInPandas(_sums, "i int, value string").groupBy("i")
    total = {r["i"]: int(r["value"]) for r in summed.agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()}
    n, sums = total[-1], [total[i] for i in range(d)]
    mean = np.array([s / n for s in sums])

    def covariance(turn: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        parts = distinct.mapInPandas(_products(mean, turn), "i int, j int, value double")
        found = parts.groupBy("i", "j").agg(F.sum("value").alias("value")).collect()
        own = np.zeros(d if turn is None else turn.shape[1])
        for r in found:
            if r["j"] == -1:
                own[r["i"]] = r["value"] / n
        return _symmetric(found, len(own)) / n, own

    variances, basis = components(covariance(None)[0])
    k = min(k, d)
    # The projections were centred before multiplying; what rounding left of their mean is taken off.
    second, off = covariance(_scaled(variances, basis, k))
    error = float(np.abs(second - np.outer(off, off) - np.eye(k)).max())
    return Whitening(scale, n, sums, variances, basis, error)


def whitened_components(vectors: DataFrame, k: int = 4, scale: int = 256) -> DataFrame:
    """A row for each whole row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    fitted = fit(vectors, k, scale)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], schema)
    k = min(k, len(fitted.sums))
    shares = F.array(*[F.lit(e) for e in fitted.explained()[:k]])
    rows = fitted.apply(vectors, k).select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return rows.select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(fitted.n).cast("long").alias("n"), "deviation", "whitened",
        shares[F.col("place")].alias("explained"), F.lit(fitted.identity_error).alias("identity_error"),
    )
