"""Vectors by their length, and sums of outer products over all of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_length(vectors: pd.Series) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, places in the batch and matrix of the vectors of each length."""
    vectors = vectors.to_numpy()
    sizes = np.fromiter(map(len, vectors), np.int64, len(vectors))
    for d in np.unique(sizes).tolist():
        at = np.nonzero(sizes == d)[0]
        yield d, at, np.stack(vectors[at])


def grams(rows: DataFrame, of: Mapping[int, Callable[[np.ndarray], np.ndarray]]) -> dict[int, np.ndarray]:
    """Sum of y y' over ``rows (vec)`` for each length in ``of``, y being
    ``of[length](vectors)``, NaN counted as 0; a length without rows is absent.
    A task sums its rows, Spark the tasks' upper triangles; the driver
    receives one row of numbers a dimension."""
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for pdf in batches:
            for d, _, v in by_length(pdf["vec"]):
                if d in of:
                    y = np.nan_to_num(of[d](v))
                    total[d] = total.get(d, 0.0) + y.T @ y
        for d, t in total.items():
            yield pd.DataFrame({"d": d, "i": np.arange(len(t)), "row": [t[i, i:] for i in range(len(t))]})

    parts = rows.mapInPandas(partial, "d int, i int, row array<double>")
    got = (parts.select("d", "i", F.posexplode("row").alias("j", "v")).groupBy("d", "i", "j").agg(F.sum("v").alias("v"))
           .groupBy("d", "i").agg(F.array_sort(F.collect_list(F.struct("j", "v"))).alias("row")).collect())
    size: dict[int, int] = {}
    for r in got:
        size[r["d"]] = max(size.get(r["d"], 0), r["i"] + 1)
    out = {d: np.zeros((k, k)) for d, k in size.items()}
    for r in got:
        out[r["d"]][r["i"], r["i"]:] = [x["v"] for x in r["row"]]
    return {d: np.triu(g) + np.triu(g, 1).T for d, g in out.items()}
