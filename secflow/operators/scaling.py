"""Scalers fitted by one aggregate and applied as one projection of literals."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow.functions.columns import continuous_types, long_form
from secflow.operators.ranking import exact_quantiles
from secflow.sources.schemas import NON_FEATURES

METHODS = ("standard", "minmax", "robust", "none")


@dataclass(frozen=True)
class Scaler:
    """Fitted centre and scale per column."""

    method: str
    params: dict[str, tuple[float, float]]

    def transform(self, df: DataFrame) -> DataFrame:
        scaled = {c: ((F.col(c) - F.lit(m)) / F.lit(s)).alias(c) for c, (m, s) in self.params.items() if c in df.columns}
        return df.select(*[scaled.get(c, F.col(c)) for c in df.columns])


def _sketches(columns: list[str]) -> list:
    return [F.approx_count_distinct(c, 0.05).alias(c) for c in columns]


def _few_of_sketch(df: DataFrame, columns: list[str], most: int, sketch) -> set[str]:
    doubtful = [c for c in columns if sketch[c] <= 4 * most + 10]
    if not doubtful:
        return set()
    exact = df.agg(*[F.count_distinct(c).alias(c) for c in doubtful]).head()
    return {c for c in doubtful if exact[c] <= most}


def few_valued(df: DataFrame, columns: list[str], most: int) -> set[str]:
    """Columns with at most ``most`` distinct values.

    A sketch over all columns finds the clearly richer ones; only the doubtful rest is counted
    exactly, and there the partial aggregate leaves few values per task.
    """
    return _few_of_sketch(df, columns, most, df.agg(*_sketches(columns)).head()) if columns else set()


def columns_to_scale(df: DataFrame, exclude: list[str] | None = None, few: int = 2, detect: bool = True) -> list[str]:
    """Continuous feature columns: 64-bit numbers that are no target, flag, key or few-valued code."""
    skip = set(NON_FEATURES) | set(exclude or [])
    names = [c for c in continuous_types(df) if c not in skip and not c.endswith("_flag")]
    if detect and exclude is None:
        codes = few_valued(df, names, few)
        names = [c for c in names if c not in codes]
    return names


def fit_scaler(df: DataFrame, columns: list[str], method: str = "standard") -> Scaler:
    """Population mean and deviation, range, or median and quartile range; a zero scale becomes 1."""
    if method not in METHODS:
        raise ValueError(f"unknown method {method}")
    if method == "none" or not columns:
        return Scaler(method, {})
    if method == "robust":
        quartiles = exact_quantiles(long_form(df, columns), "value", {"q1": 0.25, "q2": 0.5, "q3": 0.75}, ["column"])
        found = {r["column"]: (r["q2"], r["q3"] - r["q1"]) for r in quartiles.collect()}  # one row per column
    else:
        found = _moments(df.agg(*_moment_columns(columns, method)).head(), columns)
    return _scaler(method, found)


def _moment_columns(columns: list[str], method: str) -> list:
    centre, scale = (F.avg, F.stddev_pop) if method == "standard" else (F.min, lambda c: F.max(c) - F.min(c))
    return [f(c).alias(f"{c}:{i}") for c in columns for i, f in enumerate((centre, scale))]


def _moments(row, columns: list[str]) -> dict:
    return {c: (row[f"{c}:0"], row[f"{c}:1"]) for c in columns}


def _scaler(method: str, found: dict) -> Scaler:
    return Scaler(method, {c: (float(m or 0.0), float(s or 0.0) or 1.0) for c, (m, s) in found.items()})


def scale_numeric(
    df: DataFrame, train: DataFrame | None = None, exclude: list[str] | None = None, few: int = 2, method: str = "standard"
) -> DataFrame:
    """Scale the continuous columns of ``df`` with parameters fitted on ``train`` (or on itself)."""
    base = df if train is None else train
    names = columns_to_scale(base, exclude, detect=False)
    if exclude is None and method in ("standard", "minmax") and names:  # one pass for the distinct values and the moments
        row = base.agg(*_sketches(names), *_moment_columns(names, method)).head()
        codes = _few_of_sketch(base, names, few, row)
        return _scaler(method, _moments(row, [c for c in names if c not in codes])).transform(df)
    return fit_scaler(base, columns_to_scale(base, exclude, few), method).transform(df)


def fit_sparse_scaler(df: DataFrame, column: str, output: str, method: str = "standard"):
    """Vector scaler that keeps zeros: divides by the population deviation without centring.

    Robust scaling has no sparse form and falls back to this; min-max divides by the largest
    absolute value.
    """
    stats = df.select(
        Summarizer.variance(F.col(column)).alias("v"), Summarizer.count(F.col(column)).alias("n"),
        Summarizer.max(F.col(column)).alias("hi"), Summarizer.min(F.col(column)).alias("lo"),
    ).head()
    if method in ("standard", "robust"):
        n = stats["n"]
        widths = [(v * (n - 1) / n) ** 0.5 for v in stats["v"]]
    elif method == "minmax":
        widths = [max(abs(a), abs(b)) for a, b in zip(stats["lo"], stats["hi"])]
    elif method == "none":
        widths = [1.0] * len(stats["v"])
    else:
        raise ValueError(f"unknown method {method}")
    return ElementwiseProduct(scalingVec=Vectors.dense([1 / w if w > 0 else 1.0 for w in widths]), inputCol=column, outputCol=output)
