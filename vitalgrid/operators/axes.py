"""Principal axes of a matrix of vectors: a rotation after which few coordinates bound a distance from below."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F


def second_moments(matrix: DataFrame, x: str = "x") -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, sums and sums of products of all dimensions; partitions add up their own before anything is shuffled."""
    def partial(batches):
        import pandas as pd

        n, s, p = 0, None, None
        for pdf in batches:
            if len(pdf):
                rows = np.stack(pdf[x].to_list()).astype(float)
                own = (rows.sum(0), rows.T @ rows)
                n, s, p = n + len(rows), own[0] if s is None else s + own[0], own[1] if p is None else p + own[1]
        if n:
            flat = np.concatenate([[n], s, p.ravel()])
            yield pd.DataFrame({"pos": np.arange(len(flat)), "v": flat})

    cells = matrix.select(x).mapInPandas(partial, "pos long, v double").groupBy("pos").agg(F.sum("v").alias("v")).orderBy("pos").collect()
    if not cells:
        return 0, np.zeros(0), np.zeros((0, 0))
    flat = np.array([c.v for c in cells])
    dims = int((np.sqrt(4 * len(flat) - 3) - 1) / 2)
    return int(flat[0]), flat[1 : dims + 1], flat[dims + 1 :].reshape(dims, dims)


def principal_axes(matrix: DataFrame, x: str = "x", most: int = 8) -> np.ndarray:
    """Orthonormal directions, widest spread first; what the driver holds is one number for each two dimensions."""
    n, sums, products = second_moments(matrix, x)
    if not n:
        return np.zeros((0, 0))
    _, vectors = np.linalg.eigh(products / n - np.outer(sums, sums) / n**2)
    return vectors.T[::-1][:most]


def along(x: Column, axes: np.ndarray) -> Column:
    """Coordinates of a vector on the axes."""
    def on(axis) -> Column:
        weights = F.array(*[F.lit(float(v)) for v in axis])
        return F.aggregate(F.zip_with(x, weights, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)

    return F.array(*[on(a) for a in axes])
