"""Vector expressions on ``array<double>`` columns (H15 distances, literals)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa

from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("euclidean", "manhattan", "minkowski")


def _sql_double(x: float) -> str:
    x = float(x)
    if x != x:
        return "CAST('NaN' AS DOUBLE)"
    if x in (float("inf"), float("-inf")):
        return f"CAST('{'-' if x < 0 else ''}Infinity' AS DOUBLE)"
    return f"{x!r}D"  # shortest repr: parses back to the same double


def lit_vec_sql(v: Sequence[float]) -> str:
    return "array(" + ", ".join(_sql_double(x) for x in v) + ")"


def lit_vec(v: Sequence[float]) -> Column:
    """A literal array<double>, built as one SQL expression (one JVM call,
    instead of one call per element)."""
    return F.expr(lit_vec_sql(v)) if len(v) else F.array().cast("array<double>")


def lit_mat(rows: Sequence[Sequence[float]]) -> Column:
    """A literal array<array<double>> (k centres), as one SQL expression."""
    return F.expr("array(" + ", ".join(lit_vec_sql(r) for r in rows) + ")")


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, v: acc + v)


def distance(x: Column, c: Column, metric: str = "euclidean", p: float = 3.0) -> Column:
    """Euclidean, manhattan or minkowski(p) distance between two arrays."""
    m = metric.lower()
    if m == "euclidean":
        return F.sqrt(_sum(F.zip_with(x, c, lambda a, b: (a - b) * (a - b))))
    if m == "manhattan":
        return _sum(F.zip_with(x, c, lambda a, b: F.abs(a - b)))
    if m == "minkowski":
        pp = float(p)
        return F.pow(_sum(F.zip_with(x, c, lambda a, b: F.pow(F.abs(a - b), F.lit(pp)))), F.lit(1.0 / pp))
    raise ValueError(f"metric must be one of {METRICS}")


def block(points: pa.Array, d: int) -> np.ndarray:
    """An Arrow array of d-long lists as an n x d matrix, without a copy per row."""
    return points.flatten().to_numpy(zero_copy_only=False).reshape(len(points), d)


def block_distances(x: np.ndarray, centres: np.ndarray, metric: str = "euclidean", p: float = 3.0) -> np.ndarray:
    """H15 over blocks: n x k distances, or a power of them that orders them alike."""
    m, power = metric.lower(), {"euclidean": 2.0, "manhattan": 1.0, "minkowski": float(p)}
    if m not in power:
        raise ValueError(f"metric must be one of {METRICS}")
    out = np.empty((len(x), len(centres)))
    for j, c in enumerate(centres):
        gap = np.abs(x - c)
        out[:, j] = (gap if m == "manhattan" else gap * gap if m == "euclidean" else gap ** power[m]).sum(axis=1)
    return out


def sq_distance(x: Column, c: Column) -> Column:
    return _sum(F.zip_with(x, c, lambda a, b: (a - b) * (a - b)))


def dot(x: Column, c: Column) -> Column:
    return _sum(F.zip_with(x, c, lambda a, b: a * b))
