"""Embedding near-duplicates by PCA-ordered tiled comparison.

Unit vectors are rotated into the eigenbasis of their second moments, so that
leading dimensions carry most of every product.  Two vectors at cosine t or
more differ by at most sqrt(2 - 2t) in any direction: vectors are put into
cells of that width over the first dimensions, three or more as the rows grow,
and only blocks of the same or adjacent cells, whose bounding boxes are near
enough, are paired.

A pair of blocks is compared in tiles.  A tile accumulates the products of the
leading dimensions first; what the others can add is at most the product of
the two suffix norms (which the same matrix product adds as one more
dimension), and pairs that cannot reach the threshold are given up, the whole
tile when none is left.  The rest are decided by the cosine of the
vectors as given, in double precision.

Equal vectors are compared once and counted as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundflow.llm.graph import components
from fundflow.llm.matrices import by_length, grams
from fundflow.operators.stage import stage

COSINE = 0.95
BLOCK = 4096
TILE = 1024
#: Dimensions of the cells: one more than the least for each ``ROWS_PER_DIM``-fold of a block's rows.
CELL_DIMS, MAX_CELL_DIMS = 3, 6
ROWS_PER_DIM = 16
BOX_DIMS = 16
#: Bound of the cells, which are broadcast with their number of blocks.
MAX_CELLS = 100_000
#: Leading dimensions after which the pairs of a tile are looked at again.
STEPS = (16, 32)
_EPS = 1e-9


def unit(x: np.ndarray) -> np.ndarray:
    """Rows to length 1, in double precision, without overflow."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def moments(vectors: DataFrame, dims: list[int]) -> dict[int, np.ndarray]:
    """For each length d of ``dims``, the sum of x x' over all its unit
    vectors, d x d, summed by Spark; d rows come to the driver."""
    found = grams(vectors.select("vec"), {d: unit for d in dims})
    return {d: found.get(d, np.zeros((d, d))) for d in dims}


def leading(rotated: np.ndarray) -> list[np.ndarray]:
    """For each of :data:`STEPS`, the leading dimensions and the norm of the
    rest as one more: the product of two such rows bounds their cosine."""
    return [np.hstack([rotated[:, :s], np.sqrt((rotated[:, s:] ** 2).sum(axis=1, keepdims=True))])
            for s in STEPS if s < rotated.shape[1]]


def tile_links(a: np.ndarray, b: np.ndarray, lead_a: list[np.ndarray], lead_b: list[np.ndarray],
               cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of unit rows of ``a`` and ``b`` that reach ``cosine``, by
    the rows' :func:`leading` parts, shortest first."""
    for la, lb in zip(lead_a, lead_b):
        x, y = np.nonzero(la @ lb.T >= cosine - _EPS)
        if not len(x):
            return x, y
        if len(x) * 50 < len(a) * len(b):
            break
    else:
        return np.nonzero(a @ b.T >= cosine)
    # Few are left: longer leads for them alone, then the vectors themselves.
    for la, lb in zip(lead_a, lead_b):
        going = np.einsum("ij,ij->i", la[x], lb[y]) >= cosine - _EPS
        x, y = x[going], y[going]
    going = np.einsum("ij,ij->i", a[x], b[y]) >= cosine
    return x[going], y[going]


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n nodes over links i-j."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        np.minimum.at(new, low, new)
        new = new[new]
        if np.array_equal(new, low):
            return low
        low = new


def embedding_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                         cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept``.

    ``n_links`` counts the other rows at cosine ``cosine`` or more (0 < cosine
    < 1), ``component_id`` is the smallest id reachable over such links.
    Vectors that are NULL, empty or zero or that hold NULL or non-finite
    components link with nothing, nor do rows with a NULL id, whose component
    is NULL.  Vectors link only with vectors of their own length; each length
    has its own basis, and all are compared in one go.
    Rows that repeat an id with another vector are one item and share
    component and links; rows that repeat id and vector count each.  Other
    columns are ignored.  An empty table gives no rows.

    The work is the block pairs that cells and boxes leave.  Vectors that
    spread wider than a cell over the leading dimensions, as clustered ones
    do, are compared with their neighbourhood only.  Vectors that do not, such
    as directions drawn evenly from many dimensions, fall into a few adjacent
    cells whose boxes overlap: then every block meets every other, the work is
    the square of the rows in tiles of matrix products, most of them given up
    after the leading dimensions.  So it is within a cell of many near vectors,
    whose links are counted one by one.  The pairs are spread over tasks of
    bounded size either way, and none is left out.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"))
    four = rows.schema["vec"].dataType.elementType == T.FloatType()
    fine = (F.col("vec").isNotNull() & F.col("vec_id").isNotNull() & F.exists("vec", lambda x: x != 0)
            & F.forall("vec", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))))
    rows = rows.withColumn("fine", F.coalesce(fine, F.lit(False)))
    keys = [F.when(F.col("fine"), F.xxhash64(F.lit(s), "vec")).alias(k) for s, k in ((1, "hi"), (2, "lo"))]
    classes = stage(rows.filter("fine").select("vec_id", "vec", *keys).groupBy("hi", "lo")
                    .agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("vec").alias("vec")),
                    "embed-classes")
    # One number a length; a class that is alone in its length has nothing to be compared with.
    lengths = classes.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()
    if not lengths:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    dims = sorted(r["d"] for r in lengths if r["n"] > 1)
    compared = classes.filter(F.size("vec").isin(dims))
    # Eigenvectors by falling eigenvalue; a driver-side step on a d x d matrix.
    found = {d: np.linalg.eigh(m)[1][:, ::-1].copy() for d, m in moments(compared, dims).items()}
    shared = classes.sparkSession.sparkContext.broadcast(found)  # d x d numbers a length, once an executor
    width = float(np.sqrt(2.0 - 2.0 * cosine) + _EPS)
    # Coordinates lie in [-1, 1], so there are at most (2 / width + 2)^q cells a length.
    most = max(MAX_CELLS / max(len(dims), 1), 1.0)
    many = max(sum(r["n"] for r in lengths) / block, 1.0)
    q = min(CELL_DIMS + int(np.log(many) / np.log(ROWS_PER_DIM)), MAX_CELL_DIMS)
    q = max(1, min(q, max(dims, default=1), int(np.log(most) / np.log(2.0 / width + 2.0))))
    dtype = "<f4" if four else "<f8"

    @F.pandas_udf("array<int>")
    def cell_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bases = shared.value
        for vs in batches:
            cell = np.zeros((len(vs), q + 1), np.int32)  # the length, then the place (0 beyond the length)
            for d, at, x in by_length(vs):
                cell[at, 0] = d
                cell[at, 1:min(q, d) + 1] = np.floor(unit(x) @ bases[d][:, :q] / width)
            yield pd.Series(list(cell), dtype=object)

    placed = compared.select("id", "copies", "vec", cell_of("vec").alias("cell"))
    sizes = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block).alias("k"))
    placed = placed.join(F.broadcast(sizes), "cell").withColumn("b", F.pmod(F.xxhash64("id"), F.col("k")))

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(pdf["vec"].to_numpy()).astype(dtype)
        lead = unit(x) @ shared.value[x.shape[1]][:, :BOX_DIMS]
        return pd.DataFrame({"cell": [pdf["cell"].iloc[0]], "b": [pdf["b"].iloc[0]],
                             "low": [lead.min(axis=0)], "high": [lead.max(axis=0)],
                             "ids": [pdf["id"].to_numpy(np.int64).tobytes()],
                             "copies": [pdf["copies"].to_numpy(np.int64).tobytes()], "vecs": [x.tobytes()]})

    blocks = stage(placed.select("cell", "b", "id", "copies", "vec").groupBy("cell", "b").applyInPandas(
        packed, "cell array<int>, b long, low array<double>, high array<double>, ids binary, copies binary, vecs binary"),
        "embed-blocks")

    # Block pairs: each cell with itself and with one of every two opposite neighbours, of the same length.
    near = F.array(*[F.array(*[F.lit(x) for x in (0, *d)]) for d in product((-1, 0, 1), repeat=q) if d >= (0,) * q])
    left = (blocks.select(F.col("cell").alias("cell_a"), F.col("b").alias("b_a"), F.col("low").alias("low_a"),
                          F.col("high").alias("high_a"))
            .withColumn("cell_b", F.explode(F.transform(near, lambda d: F.zip_with("cell_a", d, lambda x, y: x + y)))))
    right = blocks.select(F.col("cell").alias("cell_b"), F.col("b").alias("b_b"), "low", "high")
    gap = F.zip_with(F.zip_with("low", "high_a", lambda x, y: F.greatest(x - y, F.lit(0.0))),
                     F.zip_with("low_a", "high", lambda x, y: F.greatest(x - y, F.lit(0.0))),
                     lambda x, y: x * x + y * y)
    apart = F.aggregate(gap, F.lit(0.0), lambda acc, x: acc + x)
    pairs = (left.join(right, "cell_b")
             .filter(((F.col("cell_a") != F.col("cell_b")) | (F.col("b_a") <= F.col("b_b")))
                     & (apart <= width * width)).select("cell_a", "b_a", "cell_b", "b_b"))
    side = lambda s: blocks.select(F.col("cell").alias(f"cell_{s}"), F.col("b").alias(f"b_{s}"),
                                   *[F.col(c).alias(f"{c}_{s}") for c in ("ids", "copies", "vecs")])

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                same = r.b_a == r.b_b and list(r.cell_a) == list(r.cell_b)
                ia, ib = np.frombuffer(r.ids_a, np.int64), np.frombuffer(r.ids_b, np.int64)
                dim = r.cell_a[0]
                basis = shared.value[dim]
                ca, cb = np.frombuffer(r.copies_a, np.int64), np.frombuffer(r.copies_b, np.int64)
                a = unit(np.frombuffer(r.vecs_a, dtype).reshape(len(ia), dim))
                b = unit(np.frombuffer(r.vecs_b, dtype).reshape(len(ib), dim))
                la, lb = leading(a @ basis), leading(b @ basis)
                na, nb = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
                root = np.arange(len(a) + len(b))
                for i in range(0, len(a), TILE):
                    for j in range(i if same else 0, len(b), TILE):
                        s, t = slice(i, i + TILE), slice(j, j + TILE)
                        x, y = tile_links(a[s], b[t], [z[s] for z in la], [z[t] for z in lb], cosine)
                        x, y = x + i, y + j
                        if same and i == j:  # each pair once
                            x, y = x[x < y], y[x < y]
                        if len(x):
                            na += np.bincount(x, cb[y], len(a)).astype(np.int64)
                            nb += np.bincount(y, ca[x], len(b)).astype(np.int64)
                            # Links of this tile joined to the sets found so far.
                            root = forest(len(root), root[x], root[y + (0 if same else len(a))])[root]
                if same:
                    na += nb
                    ids, n, sets = ia, na, root[:len(a)]
                else:
                    ids, n, sets = np.concatenate([ia, ib]), np.concatenate([na, nb]), root
                at = np.nonzero(n)[0]
                yield pd.DataFrame({"u": ids[sets[at]], "v": ids[at], "n": n[at]})

    # Rows (u, v, n): v has n links here and is connected with u.
    found = (pairs.join(side("a"), ["cell_a", "b_a"]).join(side("b"), ["cell_b", "b_b"])
             .mapInPandas(compare, "u long, v long, n long"))
    found = stage(found, "embed-links")
    counts = found.groupBy("v").agg(F.sum("n").alias("n"))
    root = components(found.select("u", "v"), "embed-cc")
    # A class whose id stands for several vectors counts the links of all.
    own = classes.groupBy("id").agg(F.sum("copies").alias("all"))
    known = (classes.select("hi", "lo", "id").join(own, "id")
             .join(counts.withColumnRenamed("v", "id"), "id", "left")
             .join(root.select(F.col("node").alias("id"), "root"), "id", "left")
             .filter("n IS NOT NULL OR all > 1")
             .select("hi", "lo", (F.coalesce("n", F.lit(0)) + F.col("all") - 1).alias("n_links"),
                     F.coalesce("root", "id").alias("component_id")))
    known = stage(known, "embed-known")
    return (rows.select("vec_id", *keys).join(known, ["hi", "lo"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
