"""Column expressions shared by the row-wise stages; all stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPSILON = 1e-6
_FRACTIONAL = (T.DoubleType, T.FloatType)


def as_flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for null)."""
    return F.when(condition, 1).otherwise(0)


def finite_or_zero(c: Column) -> Column:
    """Replace null, NaN and both infinities with zero."""
    infinite = F.abs(c) == F.lit(float("inf"))
    return F.when(c.isNull() | F.isnan(c) | infinite, F.lit(0.0)).otherwise(c)


def guarded_ratio(a: Column, b: Column) -> Column:
    """a / (b + epsilon); null instead of an error when the denominator is exactly zero."""
    return F.try_divide(a, b + F.lit(EPSILON))


def signed_log(c: Column) -> Column:
    return F.signum(c) * F.log1p(F.abs(c))


def ratio_or_zero(a: Column, b: Column) -> Column:
    """a / b with zero for an empty denominator."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def numeric_columns(df: DataFrame, exclude: list[str] | tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def continuous_types(df: DataFrame, exclude: list[str] | tuple[str, ...] = ()) -> list[str]:
    """64-bit numeric columns: the only ones that scaling ever touches; 32-bit codes and flags stay."""
    wide = (T.DoubleType, T.LongType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, wide) and f.name not in exclude]


def text_columns(df: DataFrame, exclude: list[str] | tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def columns_like(df: DataFrame, prefix: str = "", suffix: str = "") -> list[str]:
    return [c for c in df.columns if c.startswith(prefix) and c.endswith(suffix)]


def is_fractional(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, _FRACTIONAL)


def long_form(df: DataFrame, columns: list[str], keys: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """(keys..., column, value) with every value as double."""
    doubles = [F.col(c).cast("double").alias(c) for c in columns]
    return df.select(*keys, *doubles).unpivot(list(keys), columns, "column", "value")


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column; engines add in different orders."""
    return df.select(*[F.round(c, digits).alias(c) if is_fractional(df, c) else F.col(c) for c in df.columns])
