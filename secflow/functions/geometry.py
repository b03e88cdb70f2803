"""Distances between blocks of vectors, used inside tasks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.ml.linalg import VectorUDT

METRICS = ("euclidean", "manhattan", "cosine")
_CELLS = 4_000_000
_FEW_DIGITS = 1e-4


def as_matrix(values: pd.Series) -> np.ndarray:
    return np.stack(values.to_numpy()).astype(np.float64) if len(values) else np.zeros((0, 0))


def unit_rows(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; zero rows stay zero."""
    length = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, length, out=np.zeros_like(m), where=length > 0)


def pair_distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Distances of aligned rows, taken from their differences in slices of bounded size."""
    out = np.empty(len(a))
    rows = max(1, _CELLS // max(1, a.shape[1]))
    for i in range(0, len(a), rows):
        x, y = a[i:i + rows], b[i:i + rows]
        if metric == "cosine":
            out[i:i + rows] = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * np.einsum("ij,ij->i", unit_rows(x), unit_rows(y))))
        else:
            gap = x - y
            out[i:i + rows] = np.sqrt((gap * gap).sum(1)) if metric == "euclidean" else np.abs(gap).sum(1)
    return out


def _product_distances(a: np.ndarray, b: np.ndarray, limits) -> np.ndarray:
    """Euclidean distances from matrix products; pairs whose difference keeps few digits of the product, and
    those next to a limit, are taken again from their differences."""
    aa, bb = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
    out = np.empty((len(a), len(b)))
    turned, most = np.ascontiguousarray(-2.0 * b.T), bb.max()
    rows = max(1, _CELLS // (16 * len(b)))  # a slice stays in the processor's cache
    for i in range(0, len(a), rows):
        part = np.matmul(a[i:i + rows], turned, out=out[i:i + rows])
        part += bb
        part += aa[i:i + rows, None]
        scale = aa[i:i + rows, None] + most
        again = part <= _FEW_DIGITS * scale
        for limit in limits:
            again |= (part >= limit * limit - 1e-11 * scale) & (part <= limit * limit + 1e-11 * scale)
        np.maximum(part, 0.0, out=part)
        np.sqrt(part, out=part)
        if again.any():
            x, y = np.divmod(np.flatnonzero(again), len(b))
            for k in range(0, len(x), _CELLS // 16):
                u, v = x[k:k + _CELLS // 16], y[k:k + _CELLS // 16]
                part[u, v] = pair_distances(a[i + u], b[v], "euclidean")
    return out


def block_distances(a: np.ndarray, b: np.ndarray, metric: str, limits=()) -> np.ndarray:
    """All distances of two blocks, in slices of bounded size; ``limits`` are distances that the caller compares with.

    Cosine is measured as the chord between unit vectors, which obeys the triangle inequality;
    ``reported`` turns it back.
    """
    if metric == "cosine":
        return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (unit_rows(a) @ unit_rows(b).T)))
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric}")
    if metric == "euclidean" and a.size and b.size and a.shape[1] >= 8 and np.isfinite(a).all() and np.isfinite(b).all():
        return _product_distances(a, b, limits)
    out = np.empty((len(a), len(b)))
    rows = max(1, _CELLS // max(1, b.size))
    for i in range(0, len(a), rows):
        gap = a[i:i + rows, None, :] - b[None, :, :]
        out[i:i + rows] = np.sqrt((gap * gap).sum(2)) if metric == "euclidean" else np.abs(gap).sum(2)
    return out


def reported(d, metric: str):
    """The metric's own value from an internal distance."""
    return d * d / 2 if metric == "cosine" else d


def internal(d: float, metric: str) -> float:
    return float(np.sqrt(2 * d)) if metric == "cosine" else float(d)


def array_features(df: DataFrame, column: str) -> Column:
    """The feature column as ``array<double>`` whatever its stored form."""
    if isinstance(df.schema[column].dataType, VectorUDT):
        return vector_to_array(column)
    return F.col(column).cast("array<double>")
