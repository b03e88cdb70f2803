"""Global ranks, running totals and exact quantiles without pulling rows into one task.

A plain ordered window without partitions sends every row to one task, and the built-in exact
percentile keeps every distinct value of a group in one buffer. Here rows are first collapsed
to distinct values (so a value held by a third of all rows is one row after the partial
aggregate), the values are cut into range buckets, bucket totals give each bucket its starting
offset, and an ordered window runs inside each bucket only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from secflow.functions.columns import is_fractional
from secflow.session import broadcast_if_small, shuffle_buckets

_ACCURACY = 2000
_SMALL_GROUP = 50_000  # a bracket must span several rows beyond the error of the sketch


def cuts_below(cuts: Column, value: Column, most: int) -> Column:
    """How many of the ascending ``cuts`` (at most ``most``) lie below the value, found by halving."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(most.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(cuts, at + step - 1) < value, at + step).otherwise(at))


def running_totals(
    df: DataFrame,
    value: str,
    sums: dict[str, Column],
    by: list[str] | tuple[str, ...] = (),
    descending: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """One row per (by..., value) with, for each entry of ``sums``, three columns:

    ``<name>`` the total of the value's rows, ``<name>_upto`` the running total up to and
    including the value (from the largest down when ``descending``), ``<name>_all`` the total
    of the whole group.
    """
    by = list(by)
    rows = df.filter(F.col(value).isNotNull())
    cells = rows.groupBy(*by, value).agg(*[e.alias(n) for n, e in sums.items()])
    count = buckets or shuffle_buckets(df.sparkSession)
    cuts = F.percentile_approx(value, [i / count for i in range(1, count)], F.lit(_ACCURACY)).alias("_cuts")
    if by:
        cut_cells = cells.join(cells.groupBy(*by).agg(cuts), by)
    else:
        cut_cells = cells.withColumn("_cuts", cells.agg(cuts).scalar())
    placed = cut_cells.withColumn("_bucket", cuts_below(F.col("_cuts"), F.col(value), count - 1)).drop("_cuts")

    totals = placed.groupBy(*by, "_bucket").agg(*[F.sum(n).alias(f"_{n}") for n in sums])
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    bucket_order = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    before = group.orderBy(bucket_order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by,
        "_bucket",
        *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}_before") for n in sums],
        *[F.sum(f"_{n}").over(group).alias(f"{n}_all") for n in sums],
    )
    keys = [*by, "_bucket"]
    value_order = F.col(value).desc() if descending else F.col(value).asc()
    inside = Window.partitionBy(*keys).orderBy(value_order).rowsBetween(Window.unboundedPreceding, 0)
    return placed.join(offsets, keys).select(
        *by,
        value,
        *sums,
        *[(F.sum(n).over(inside) + F.col(f"_{n}_before")).alias(f"{n}_upto") for n in sums],
        *[f"{n}_all" for n in sums],
    )


def quantile_array(totals: DataFrame, value: str, probs: list[float], by=(), count: str = "n") -> DataFrame:
    """(by..., quantiles): exact linear-interpolated quantiles from ascending running counts.

    Each wanted rank is held by exactly one distinct value, so only those few rows survive the
    explode; array functions keep the generated code small for any number of probabilities.
    """
    upto, total = F.col(f"{count}_upto"), F.col(f"{count}_all")
    levels = F.array(*[F.lit(float(p)) for p in probs])

    def ranks(i, p):
        spot = p * (total - 1)
        return F.array(
            F.struct((2 * i).alias("slot"), F.floor(spot).alias("rank")),
            F.struct((2 * i + 1).alias("slot"), F.ceil(spot).alias("rank")),
        )

    wanted = F.flatten(F.transform(levels, lambda p, i: ranks(i, p)))
    held = F.filter(wanted, lambda w: (w["rank"] >= upto - F.col(count)) & (w["rank"] < upto))
    found = (
        totals.select(*by, value, total.alias("_total"), F.explode(held).alias("_w"))
        .groupBy(*by)
        .agg(
            F.array_sort(F.collect_list(F.struct("_w.slot", F.col(value).alias("v")))).alias("_at"),
            F.max("_total").alias("_total"),
        )
    )

    def between(p, i):
        spot = p * (F.col("_total") - 1)
        low, high = F.col("_at")[2 * i]["v"], F.col("_at")[2 * i + 1]["v"]
        return low + (high - low) * (spot - F.floor(spot))

    return found.select(*by, F.transform(levels, between).alias("quantiles"))


def quantiles_of_totals(totals: DataFrame, value: str, probs: dict[str, float], by=(), count: str = "n") -> DataFrame:
    """As ``quantile_array`` with one named column per probability."""
    found = quantile_array(totals, value, list(probs.values()), by, count)
    return found.select(*by, *[F.col("quantiles")[i].alias(name) for i, name in enumerate(probs)])


def _collapsed(df: DataFrame, value: str, probs: list[float], by: list[str]) -> DataFrame:
    """Rows (by..., value) whose values away from the wanted ranks are replaced by the nearest bracket end below.

    A sketch gives a bracket around each rank, wider than its error on both sides, and the replacement keeps the
    order, so the values at the wanted ranks stay. Small groups and those with NaN are left as they are.
    """
    rows = df.filter(F.col(value).isNotNull()).select(*by, value)
    margin = 2 / _ACCURACY
    ends = sorted({min(1.0, max(0.0, p + m)) for p in probs for m in (-margin, margin)})
    spots = [[ends.index(min(1.0, max(0.0, p + m))) for m in (-margin, margin)] for p in probs]
    fractional = is_fractional(rows, value)
    few = F.count("*") <= _SMALL_GROUP
    whole = (few | (F.count_if(F.isnan(value)) > 0)) if fractional else few
    cuts = F.percentile_approx(value, ends, F.lit(_ACCURACY))
    found = rows.groupBy(*by).agg(cuts.alias("_ends"), whole.alias("_as_is"))
    brackets = broadcast_if_small(found)
    v, at = F.col(value), F.col("_ends")
    inside = F.lit(False)
    for low, high in spots:
        low_end = F.lit(True) if ends[low] == 0.0 else v >= at[low]
        inside = inside | (low_end & (F.lit(True) if ends[high] == 1.0 else v <= at[high]))
    below = at[0]
    for i in range(1, len(ends)):
        below = F.when(v >= at[i], at[i]).otherwise(below)
    placed = rows.join(brackets, by) if by else rows.crossJoin(brackets)
    return placed.select(*by, F.when(F.col("_as_is") | inside, v).otherwise(below).alias(value))


def exact_quantiles(
    df: DataFrame, value: str, probs: dict[str, float], by: list[str] | tuple[str, ...] = ()
) -> DataFrame:
    """Exact quantiles (linear interpolation) of a numeric column, per group; name -> probability."""
    totals = running_totals(_collapsed(df, value, list(probs.values()), list(by)), value, {"n": F.count("*")}, by)
    return quantiles_of_totals(totals, value, probs, by)


def average_ranks(df: DataFrame, value: str, by=(), sums: dict[str, Column] | None = None) -> DataFrame:
    """Distinct values with their tie-averaged rank (column ``rank``, from 1)."""
    totals = running_totals(df, value, {"n": F.count("*"), **(sums or {})}, by)
    return totals.withColumn("rank", F.col("n_upto") - (F.col("n") - 1) / 2)


def spread_hash(key: str) -> Column:
    """Multiplicative hash of an integer key into [0, 2**32); plain arithmetic in any SQL engine."""
    return F.pmod(F.pmod(F.col(key), F.lit(2**31)) * F.lit(2654435761), F.lit(2**32))


_HASH_BUCKETS = 1024


def key_hash(key: str, seed: int = 0) -> Column:
    """The place of a key in hash order, in [0, 2**32)."""
    return spread_hash(key) if seed == 0 else F.pmod(F.xxhash64(F.lit(seed), key), F.lit(2**32))


def hash_bucket(hash_: Column) -> Column:
    return F.floor(hash_ / (2**32 // _HASH_BUCKETS))


def hash_ranks(df: DataFrame, key: str, by: list[str] | tuple[str, ...] = (), seed: int = 0) -> DataFrame:
    """Append ``rank`` (from 1) and ``group_rows``: each row's place in hash order within its group.

    The hash is cut into equal buckets; a window runs only inside one (group, bucket), so a class
    that holds most rows is still spread over many tasks.
    """
    by = list(by)
    hashed = df.withColumn("_hash", key_hash(key, seed))
    hashed = hashed.withColumn("_bucket", hash_bucket(F.col("_hash")))
    sizes = hashed.groupBy(*by, "_bucket").agg(F.count("*").alias("_rows"))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *by, "_bucket",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(group).alias("group_rows"),
    )
    inside = Window.partitionBy(*by, "_bucket").orderBy("_hash", key)
    return (
        hashed.join(offsets, [*by, "_bucket"])
        .withColumn("rank", F.row_number().over(inside) + F.col("_before"))
        .drop("_hash", "_bucket", "_before")
    )
