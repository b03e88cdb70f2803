"""Category codes and one-hot columns with encoders that are fitted once and reused."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from secflow.session import broadcast_if_small


def fit_codes(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, category, code): codes follow the sorted order of the categories, from 0.

    The window runs over distinct categories, never over rows.
    """
    pairs = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    distinct = (
        pairs.unpivot([], columns, "column", "category").filter(F.col("category").isNotNull()).distinct()
    )
    by_name = Window.partitionBy("column").orderBy("category")
    return distinct.withColumn("code", (F.row_number().over(by_name) - 1).cast("int"))


def apply_codes(df: DataFrame, codes: DataFrame, columns: list[str], unknown: int = -1) -> DataFrame:
    """Replace each column with its code; unseen and null categories get ``unknown``.

    The dictionary is counted first and broadcast only when short.
    """
    order = df.columns
    out = df
    codes = broadcast_if_small(codes)
    for c in columns:
        lookup = codes.filter(F.col("column") == c).select(
            F.col("category").alias("_category"), F.col("code").alias("_code")
        )
        out = (
            out.join(lookup, F.col(c).cast("string") == F.col("_category"), "left")
            .withColumn(c, F.coalesce("_code", F.lit(unknown)).cast("int"))
            .drop("_category", "_code")
        )
    return out.select(*order)


def categories_of(codes: DataFrame, column: str, most: int = 1000) -> list[str]:
    """Sorted categories of one column; one-hot width must stay a schema-sized number."""
    rows = codes.filter(F.col("column") == column).orderBy("code").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{column} has more than {most} categories; use codes instead of one-hot columns")
    return [r["category"] for r in rows]


def one_hot_columns(df: DataFrame, codes: DataFrame, columns: list[str]) -> DataFrame:
    """One 0/1 column ``<column>_<category>`` per known category; an unknown one sets none of them."""
    codes = broadcast_if_small(codes)
    expanded = [
        F.when(F.col(c).cast("string") == v, 1).otherwise(0).alias(f"{c}_{v}")
        for c in columns
        for v in categories_of(codes, c)
    ]
    keep = [F.col(c) for c in df.columns if c not in columns]
    return df.select(*keep, *expanded)


def encoder_stages(columns: list[str], encoding: str) -> tuple[list, list[str]]:
    """MLlib stages and their output columns for ``onehot``, ``label`` or ``category`` encoding.

    The indexer keeps unknown values in an extra last slot, which the one-hot stage drops, so an
    unknown value becomes the zero vector. Tree learners read the index as a nominal feature.
    """
    if not columns:
        return [], []
    indexed = [f"{c}_index" for c in columns]
    indexer = StringIndexer(
        inputCols=columns, outputCols=indexed, stringOrderType="alphabetAsc", handleInvalid="keep"
    )
    if encoding in ("label", "category"):
        return [indexer], indexed
    if encoding != "onehot":
        raise ValueError(f"unknown encoding {encoding}")
    hot = [f"{c}_hot" for c in columns]
    return [indexer, OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True)], hot


def fit_encoder(df: DataFrame, columns: list[str], encoding: str = "onehot"):
    """A reusable fitted encoder and the columns it adds."""
    stages, outputs = encoder_stages(columns, encoding)
    return Pipeline(stages=stages).fit(df), outputs
