"""Embedding whitening by shifted CholeskyQR.

Rows centred on their exact mean are orthogonalised by Gram passes: Spark
sums the d x d Gram matrix of the rows, its Cholesky factor R is found on the
driver, and the next pass divides every row by R in a triangular solve before
it multiplies.  A matrix too ill-conditioned for its factor to be trusted is
shifted by a multiple of the unit matrix first; the pass after it sees a far
better one.  After a few passes the rows are orthonormal to rounding, and the
product of all factors is the R of a QR decomposition of the centred rows,
found without squaring their condition.  Its singular value decomposition
gives the whitening components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundflow.llm.matrices import by_length, grams

COMPONENTS = 32
#: An entry c becomes floor(SCALE c) + OFFSET.
SCALE, OFFSET = 64.0, 1_000_000
#: Entries beyond this have no exact long form and count as non-finite.
LARGEST = 2.0 ** 40
MAX_PASSES = 6
#: Columns of a triangular solve that are divided one by one before the next block is updated.
SOLVE_BLOCK = 64
#: Rows that are added up one after another: it enters the shift.
CHUNK = 10_000
_UNIT = 2.0 ** -53


def quantised(vectors: np.ndarray) -> np.ndarray:
    """Entries as long ``floor(64 c) + 1000000``, exact."""
    return np.floor(vectors.astype(np.float64) * SCALE).astype(np.int64) + OFFSET


def divide(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """``rows`` R^-1 for an upper triangular R, by substitution."""
    out = rows.copy()
    d = len(r)
    for start in range(0, d, SOLVE_BLOCK):
        stop = min(start + SOLVE_BLOCK, d)
        out[:, start:stop] -= out[:, :start] @ r[:start, start:stop]
        for j in range(start, stop):
            out[:, j] = (out[:, j] - out[:, start:j] @ r[start:j, j]) / r[j, j]
    return out


@dataclass
class Whitening:
    """Fit over vectors of one length: ``n`` of them, exact per-dimension
    ``sums``, the factors found so far, then ``components`` (unit columns by
    falling eigenvalue) with ``eigenvalues``, and ``identity_error``."""

    n: int
    sums: list[int]
    factors: list[np.ndarray] = field(default_factory=list)
    components: np.ndarray | None = None
    eigenvalues: np.ndarray | None = None
    explained: np.ndarray | None = None
    identity_error: float | None = None

    def centred(self, vectors: np.ndarray) -> np.ndarray:
        return quantised(vectors) - np.array([s / self.n for s in self.sums])

    def orthogonal(self, vectors: np.ndarray) -> np.ndarray:
        rows = self.centred(vectors)
        for r in self.factors:
            rows = divide(rows, r)
        return rows

    def whiten(self, vectors: np.ndarray) -> np.ndarray:
        """Unrounded projections over the root of their eigenvalue; NaN for a
        component without variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.eigenvalues > 0, self.centred(vectors) @ self.components / np.sqrt(self.eigenvalues),
                            np.nan)

    def deviations(self, vectors: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n x - S)^2, exact; None beyond a long."""
        x = quantised(vectors)
        largest = max(map(abs, self.sums), default=0) + self.n * int(np.abs(x).max(initial=0))
        if largest < 2 ** 62:
            off = self.n * x - np.array(self.sums, np.int64)
            if int(np.abs(off).max(initial=0)) ** 2 * max(x.shape[1], 1) < 2 ** 62:
                return (off * off).sum(axis=1).tolist()
        exact = [sum((self.n * c - s) ** 2 for c, s in zip(row, self.sums)) for row in x.tolist()]
        return [v if v < 2 ** 63 else None for v in exact]

    def add_factor(self, gram: np.ndarray) -> bool:
        """Take the Gram matrix of the rows divided so far.  True when they
        are orthonormal to rounding, else one more factor has been found."""
        d = len(gram)
        if np.abs(gram - np.eye(d)).max(initial=0.0) <= 100 * d * _UNIT:
            return True
        low, high = np.linalg.eigvalsh(gram)[[0, -1]] if d else (0.0, 0.0)
        if not high > 0:  # no variance in any dimension
            return True
        shift = 11.0 * d * (CHUNK + d + 1) * _UNIT * high
        self.factors.append(np.linalg.cholesky(gram + (0.0 if low > shift else shift) * np.eye(d)).T)
        return False

    def finish(self, gram: np.ndarray, most: int) -> None:
        """Components from the last Gram matrix and all factors.  Directions
        without variance never become orthonormal, so the matrix' root takes
        the last factor's place: the decomposition is exact for any rank."""
        value, vector = np.linalg.eigh(gram)
        r = (vector * np.sqrt(np.maximum(value, 0.0))) @ vector.T
        for f in reversed(self.factors):
            r = r @ f
        _, sigma, vt = np.linalg.svd(r)
        sigma[sigma <= len(gram) * 1e-13 * sigma.max(initial=0.0)] = 0.0
        e = sigma ** 2 / self.n
        self.components, self.eigenvalues = vt[:most].T, e[:most]
        self.explained = e[:most] / e.sum() if e.sum() > 0 else np.zeros(len(e[:most]))


def sums_of(rows: DataFrame) -> dict[int, Whitening]:
    """Number and exact per-dimension sums of the quantised vectors of each length."""
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, list] = {}
        for pdf in batches:
            for d, _, v in by_length(pdf["vec"]):
                # A batch sums exactly in longs; their sum is kept in Python integers.
                have = total.setdefault(d, [0] * (d + 1))
                total[d] = [a + int(b) for a, b in zip(have, [len(v), *quantised(v).sum(axis=0)])]
        for d, t in total.items():
            yield pd.DataFrame({"d": d, "i": np.arange(d + 1), "s": [str(x) for x in t]})

    parts = rows.mapInPandas(partial, "d int, i int, s string")
    got = (parts.groupBy("d", "i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
           .groupBy("d").agg(F.array_sort(F.collect_list(F.struct("i", "s"))).alias("s")).collect())  # d numbers a length
    return {r["d"]: Whitening(int(r["s"][0]["s"]), [int(x["s"]) for x in r["s"][1:]]) for r in got}


def fit(rows: DataFrame, components: int = COMPONENTS, max_passes: int = MAX_PASSES) -> dict[int, Whitening]:
    """A :class:`Whitening` for each vector length of ``rows (vec)``: one pass
    for the sums, one for each factor (mostly two), one to see that the rows
    are orthonormal and one for the error.  What is left of a matrix still
    not orthonormal after ``max_passes`` goes into the decomposition as it is."""
    models = sums_of(rows)
    open_ = {d: m for d, m in models.items() if d}
    for last in [False] * max_passes + [True]:
        if not open_:
            break
        found = grams(rows, {d: m.orthogonal for d, m in open_.items()})
        for d, g in found.items():
            if last or open_[d].add_factor(g):
                open_.pop(d).finish(g, min(components, d))
    done = {d: m for d, m in models.items() if m.components is not None}
    # The exact mean was taken off before projecting; the projections' own mean, left by rounding, is taken off here.
    seen = grams(rows, {d: (lambda v, m=m: np.hstack([np.ones((len(v), 1)), m.whiten(v)])) for d, m in done.items()})
    for d, g in seen.items():
        mean = g[0, 1:] / done[d].n
        off = g[1:, 1:] / done[d].n - np.outer(mean, mean) - np.eye(len(mean))
        varied = done[d].eigenvalues > 0
        done[d].identity_error = float(np.abs(off[np.ix_(varied, varied)]).max(initial=0.0))
    return done


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, vec`` of rows whose vector has entries, all finite and within :data:`LARGEST`."""
    fine = F.forall(F.col(vec_col), lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < LARGEST), F.lit(False)))
    return (vectors.filter(F.coalesce(fine & (F.size(vec_col) > 0), F.lit(False)))
            .select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec")))


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """One row per usable row and component: ``vec_id, component, n,
    deviation, whitened, explained, identity_error``.

    Rows whose vector is NULL or empty or has a NULL, non-finite or huge
    (2^40) entry are dropped.  The fit is over all others; vectors of
    different lengths have fits of their own.  Components are numbered from 1
    by falling eigenvalue, at most ``components`` and the length of them; a
    component without variance has ``whitened`` NULL and counts in no error.
    ``deviation`` is NULL where it exceeds a long.  NULL ids and repeated rows
    are rows like any other, other columns are ignored, an empty table gives
    no rows.  The driver holds d x d numbers of a length, executors the
    d x ``components`` of the result.
    """
    rows = usable(vectors, id_col, vec_col)
    models = fit(rows.select("vec"), components)
    for m in models.values():
        m.factors = []  # the components are enough from here on

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for d, at, v in by_length(pdf["vec"]):
                m = models[d]
                yield pd.DataFrame({"row": pdf["row"].to_numpy()[at], "n": m.n,
                                    "deviation": pd.array(m.deviations(v), "Int64"),
                                    "whitened": list(m.whiten(v)), "explained": [m.explained] * len(at),
                                    "identity_error": m.identity_error})

    # pandas has no NULL in a long column: the id travels as text.
    out = rows.select(F.col("vec_id").cast("string").alias("row"), "vec").mapInPandas(
        apply, "row string, n long, deviation long, whitened array<double>, explained array<double>, identity_error double")
    return (out.select("row", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("i", "x"))
            .select(F.col("row").cast("long").alias("vec_id"), (F.col("i") + 1).alias("component"), "n", "deviation",
                    F.nanvl("x.whitened", F.lit(None).cast("double")).alias("whitened"),
                    F.col("x.explained").alias("explained"), "identity_error"))
