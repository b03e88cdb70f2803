"""Profiles of tables and columns."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from secflow.functions.columns import is_fractional, long_form, numeric_columns, ratio_or_zero, text_columns
from secflow.operators.ranking import exact_quantiles, quantiles_of_totals, running_totals


def table_shape(df: DataFrame) -> DataFrame:
    """Rows, columns and columns per type."""
    kinds: dict[str, int] = {}
    for _, kind in df.dtypes:
        kinds[kind] = kinds.get(kind, 0) + 1
    return df.agg(
        F.count("*").alias("rows"),
        F.lit(len(df.columns)).cast("bigint").alias("columns"),
        *[F.lit(n).cast("bigint").alias(f"columns_{kind}") for kind, n in sorted(kinds.items())],
    )


def is_missing(df: DataFrame, name: str) -> Column:
    return (F.col(name).isNull() | F.isnan(name)) if is_fractional(df, name) else F.col(name).isNull()


def null_counts(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """(column, null_count) from one scan; columns without nulls are left out unless asked for."""
    counted = df.agg(*[F.count_if(is_missing(df, c)).alias(c) for c in df.columns])
    out = counted.unpivot([], df.columns, "column", "null_count")
    return out.filter("null_count > 0") if only_missing else out


def frequencies(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """(column, count, pct), most frequent first, ties by value; the share is of all rows."""
    counts = df.groupBy(column).count()
    total = df.agg(F.count("*").alias("n")).scalar()
    shares = counts.withColumn("pct", F.lit(100.0) * F.col("count") / total)
    return shares.orderBy(F.desc("count"), column).limit(top) if top else shares


def minority_classes(df: DataFrame, column: str, below_pct: float = 5.0) -> DataFrame:
    return frequencies(df, column).filter(F.col("pct") < below_pct)


def three_way_counts(df: DataFrame, by: str = "split") -> DataFrame:
    """Rows per split that are normal, suspicious and evil, with percentages."""
    sus, evil = F.col("sus") == 1, F.col("evil") == 1
    counted = df.groupBy(by).agg(
        F.count("*").alias("total"),
        F.count_if(~sus & ~evil).alias("normal"),
        F.count_if(sus).alias("suspicious"),
        F.count_if(evil).alias("malicious"),
    )
    return counted.select(
        "*", *[(100.0 * F.col(c) / F.col("total")).alias(f"{c}_pct") for c in ("normal", "suspicious", "malicious")]
    )


def column_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per numeric column: count, moments, exact quartiles, nulls."""
    names = columns or numeric_columns(df)
    long = long_form(df, names)
    moments = long.groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.var_samp("value").alias("variance"),
        F.count_if(F.col("value").isNull()).alias("null_count"),
        (100.0 * F.count_if(F.col("value").isNull()) / F.count("*")).alias("null_pct"),
    )
    quartiles = exact_quantiles(long, "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, ["column"])
    return moments.join(quartiles, "column", "left")


def data_quality(df: DataFrame, name: str) -> DataFrame:
    """Rows, columns, duplicate rows, empty cells and value bytes of one dataset.

    Whole-row copies collapse in the partial aggregate; text counts its bytes, other cells 8.
    """
    texts = text_columns(df)
    width = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(8 * (len(df.columns) - len(texts))))
    missing = sum((F.when(is_missing(df, c), 1).otherwise(0) for c in df.columns), F.lit(0))
    distinct_rows = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    return distinct_rows.agg(
        F.sum("_copies").alias("rows"),
        F.sum(F.col("_copies") - 1).alias("duplicates"),
        F.sum(missing * F.col("_copies")).alias("null_cells"),
        (F.sum(width * F.col("_copies")) / F.lit(1024.0 * 1024.0)).alias("memory_mb"),
    ).select(F.lit(name).alias("dataset"), "rows", F.lit(len(df.columns)).cast("bigint").alias("columns"),
             "duplicates", "null_cells", "memory_mb")


def distinct_counts(df: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """(column, distinct). The exact way groups (column, value) pairs; the quick way sketches."""
    if exact:
        texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        pairs = texts.unpivot([], columns, "column", "value").filter(F.col("value").isNotNull()).distinct()
        return pairs.groupBy("column").agg(F.count("*").alias("distinct"))
    sketched = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
    return sketched.unpivot([], columns, "column", "distinct")


def variances(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, variance) with the sample variance, from one aggregate."""
    names = columns or numeric_columns(df)
    return df.agg(*[F.var_samp(c).alias(c) for c in names]).unpivot([], names, "column", "variance")


def top_by_variance(df: DataFrame, k: int, columns: list[str] | None = None) -> DataFrame:
    return variances(df, columns).orderBy(F.desc("variance"), "column").limit(k)


def target_correlations(df: DataFrame, target: str, columns: list[str]) -> DataFrame:
    """(column, correlation) with the target, all columns in one aggregate."""
    found = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in columns])
    return found.unpivot([], columns, "column", "correlation")


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """(left, right, correlation) for all ordered column pairs; only the d x d matrix reaches the driver."""
    vectors = VectorAssembler(inputCols=columns, outputCol="_v").transform(df).select("_v")
    matrix = Correlation.corr(vectors, "_v").head()[0].toArray()
    rows = [(a, b, float(matrix[i, j])) for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return df.sparkSession.createDataFrame(rows, "left string, right string, correlation double")


def histogram(df: DataFrame, column: str, bins: int, by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """(by..., bin, low, high, count, density); equal bins over the whole range, last bin closed.

    A constant column gets a range of width one around its value.
    """
    by = list(by)
    low, high = F.min(column), F.max(column)
    margin = F.when(low == high, 0.5).otherwise(0.0)
    edges = df.agg((low - margin).alias("lo"), (high + margin).alias("hi"))
    lo, hi = edges.select("lo").scalar(), edges.select("hi").scalar()
    width = (F.col("_hi") - F.col("_lo")) / bins
    placed = df.withColumn("_lo", lo).withColumn("_hi", hi).withColumn(
        "bin", F.least(F.floor(F.try_divide(F.col(column) - F.col("_lo"), width)), F.lit(bins - 1)).cast("int")
    ).filter(F.col("bin").isNotNull())
    counts = placed.groupBy(*by, "bin", "_lo", "_hi").agg(F.count("*").alias("count"))
    if by:
        counts = counts.join(counts.groupBy(*by).agg(F.sum("count").alias("_n")), by)
    else:
        counts = counts.withColumn("_n", df.agg(F.count(column).alias("n")).scalar())
    return counts.select(
        *by, "bin",
        (F.col("_lo") + F.col("bin") * width).alias("low"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("high"),
        "count",
        (F.col("count") / (F.col("_n") * width)).alias("density"),
    )


def box_summary(df: DataFrame, column: str, by: list[str]) -> DataFrame:
    """Five numbers per group plus whiskers at 1.5 interquartile ranges and the count outside."""
    totals = running_totals(df, column, {"n": F.count("*")}, by)
    box = quantiles_of_totals(
        totals, column, {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}, by
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    box = box.withColumns({"low_whisker": F.col("q1") - reach, "high_whisker": F.col("q3") + reach})
    outside = (F.col(column) < F.col("low_whisker")) | (F.col(column) > F.col("high_whisker"))
    counted = totals.join(box.select(*by, "low_whisker", "high_whisker"), by).groupBy(*by).agg(
        F.sum(F.when(outside, F.col("n")).otherwise(0)).alias("outside")
    )
    return box.join(counted, by)


def mean_and_median(df: DataFrame, columns: list[str]) -> DataFrame:
    long = long_form(df, columns)
    means = long.groupBy("column").agg(F.avg("value").alias("mean"))
    return means.join(exact_quantiles(long, "value", {"median": 0.5}, ["column"]), "column")


def zscore_outliers(df: DataFrame, columns: list[str], label: str, cutoff: float = 3.0, within_class: bool = False) -> DataFrame:
    """Rows beyond ``cutoff`` population deviations, per column and class.

    The moments are one small table: per column, or per column and class.
    """
    long = long_form(df, columns, [label])
    keys = ["column", label] if within_class else ["column"]
    moments = long.groupBy(*keys).agg(F.avg("value").alias("_m"), F.stddev_pop("value").alias("_s"))
    z = F.abs(F.try_divide(F.col("value") - F.col("_m"), F.col("_s")))
    return long.join(F.broadcast(moments), keys).groupBy("column", label).agg(
        F.count("*").alias("rows"),
        F.count_if(z > cutoff).alias("outliers"),
        (100.0 * F.count_if(z > cutoff) / F.count("*")).alias("outlier_pct"),
    )


def schema_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """What a preparation step did: columns dropped and added, rows removed."""
    old, new = set(before.columns), set(after.columns)
    rows_before = before.agg(F.count("*").alias("n")).scalar()
    return after.agg(F.count("*").alias("rows_after")).select(
        F.lit(len(old)).cast("bigint").alias("columns_before"),
        F.lit(len(new)).cast("bigint").alias("columns_after"),
        F.lit(",".join(sorted(old - new))).alias("dropped_columns"),
        F.lit(",".join(sorted(new - old))).alias("new_columns"),
        rows_before.alias("rows_before"),
        "rows_after",
        (rows_before - F.col("rows_after")).alias("rows_removed"),
    )


def scale_check(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, mean, std_pop): after standard scaling these are 0 and 1."""
    return long_form(df, columns).groupBy("column").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std")
    )


def score_summary(df: DataFrame, score: str, by: list[str]) -> DataFrame:
    """Range, mean, median and upper percentiles of a score per group."""
    base = df.groupBy(*by).agg(
        F.count("*").alias("rows"), F.min(score).alias("min"), F.max(score).alias("max"), F.avg(score).alias("mean")
    )
    return base.join(exact_quantiles(df, score, {"median": 0.5, "p90": 0.9, "p100": 1.0}, by), by)


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    counts = df.groupBy(label).agg(F.count("*").alias("count"))
    total = df.agg(F.count("*").alias("n")).scalar()
    return counts.withColumn("pct", 100.0 * ratio_or_zero(F.col("count"), total))
