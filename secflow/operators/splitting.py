"""Exact seeded splits and samples in hash order of the row key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from secflow.operators.ranking import hash_bucket, hash_ranks, key_hash
from secflow.session import broadcast_if_small

#: Most (class, hash bucket) counts that are brought to the driver.
MOST_CLASS_BUCKETS = 100_000


def class_quotas(df: DataFrame, label: str, size: int | float) -> DataFrame:
    """(label, quota): proportional shares of a fixed size or fraction, largest remainders first."""
    return _quotas(df.groupBy(label).agg(F.count("*").alias("_n")), label, size)


def _quotas(counts: DataFrame, label: str, size: int | float) -> DataFrame:
    every = Window.partitionBy(F.lit(0))  # one row per class
    total = F.sum("_n").over(every)
    wanted = F.round(total * size) if isinstance(size, float) else F.least(F.lit(size), total)
    share = wanted * F.col("_n") / total
    parts = counts.withColumns({"_share": share, "_wanted": wanted})
    parts = parts.withColumns({"_floor": F.floor("_share"), "_rest": F.round(F.col("_share") - F.floor("_share"), 9)})
    left = F.col("_wanted") - F.sum("_floor").over(every)
    order = F.row_number().over(every.orderBy(F.desc("_rest"), label))
    return parts.select(label, (F.col("_floor") + F.when(order <= left, 1).otherwise(0)).cast("bigint").alias("quota"))


def stratified_split(
    df: DataFrame, label: str, size: int | float, key: str = "row_id", seed: int = 0, names: tuple[str, str] = ("first", "second")
) -> DataFrame:
    """Append ``split``: exactly the class quotas in the first part, the rest in the second."""
    ranked = hash_ranks(df, key, [label], seed)
    joined = ranked.join(broadcast_if_small(class_quotas(df, label, size)), label)
    tag = F.when(F.col("rank") <= F.col("quota"), names[0]).otherwise(names[1])
    return joined.withColumn("split", tag).drop("rank", "group_rows", "quota").select(*df.columns, "split")


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def split_in_place(
    df: DataFrame, label: str, size: int | float, key: str = "row_id", seed: int = 0, names: tuple[str, str] = ("first", "second")
) -> DataFrame:
    """The rows of ``stratified_split`` without moving them: each class is cut at the hash and key of its last row in the first part.

    Two scans find the cuts: rows per class and bucket of the hash, then the keys of the one bucket in which a quota ends. Only
    rows that share the key at a cut are numbered, where the quota ends among them.
    """
    hash_ = key_hash(key, seed)
    sizes = df.groupBy(F.col(label).alias("label"), hash_bucket(hash_).alias("bucket")).agg(F.count("*").alias("n"))
    found = sizes.limit(MOST_CLASS_BUCKETS + 1).collect()  # classes x buckets
    if len(found) > MOST_CLASS_BUCKETS:
        return stratified_split(df, label, size, key, seed, names)
    counts = df.sparkSession.createDataFrame(found, sizes.schema).groupBy("label").agg(F.sum("n").alias("_n"))
    quotas = {r["label"]: r["quota"] for r in _quotas(counts, "label", size).collect() if r["label"] is not None}
    whole, ends = [], {}
    for value, quota in quotas.items():
        upto = sum(r["n"] for r in found if r["label"] == value and r["bucket"] is None)  # rows without a key come first, and are left out
        for bucket, n in sorted((r["bucket"], r["n"]) for r in found if r["label"] == value and r["bucket"] is not None):
            if upto < quota <= upto + n:
                ends[value] = (bucket, quota - upto)
            upto += n
        if quota >= upto:
            whole.append(value)
            ends.pop(value, None)
    of = {value: F.col(label) == F.lit(value) for value in quotas}
    edge = df.filter(_any([of[v] & (hash_bucket(hash_) == bucket) for v, (bucket, _) in ends.items()]))
    keys = edge.groupBy(F.col(label).alias("label"), hash_.alias("hash"), F.col(key).alias("key")).agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("label").orderBy("hash", "key").rowsBetween(Window.unboundedPreceding, 0))
    wanted = F.lit(0)
    for v, (_, n) in ends.items():
        wanted = F.when(F.col("label") == F.lit(v), n).otherwise(wanted)
    last = keys.withColumns({"upto": upto, "wanted": wanted}).filter("upto >= wanted AND upto - n < wanted")
    cuts = {r["label"]: r for r in last.collect()} if ends else {}  # a row per class
    here = F.col(key)

    def at(r) -> Column:
        return (hash_ == r["hash"]) & here.eqNullSafe(F.lit(r["key"]))

    def below(r) -> Column:
        return (hash_ < r["hash"]) | ((hash_ == r["hash"]) & (here.isNull() | F.coalesce(here <= F.lit(r["key"]), F.lit(False))))

    shared = {v: r for v, r in cuts.items() if r["upto"] > r["wanted"]}
    first = _any([of[v] for v in whole] + [of[v] & (below(r) & ~at(r) if v in shared else below(r)) for v, r in cuts.items()])
    rows = df.filter(F.col(label).isNotNull() & hash_.isNotNull())
    tag = lambda inside: F.when(inside, names[0]).otherwise(names[1])
    tied = _any([of[v] & at(r) for v, r in shared.items()])
    out = (rows.filter(~tied) if shared else rows).withColumn("split", tag(first))
    if shared:
        left = F.lit(0)
        for v, r in shared.items():
            left = F.when(of[v], r["wanted"] - (r["upto"] - r["n"])).otherwise(left)
        numbered = rows.filter(tied).withColumn("_at", F.row_number().over(Window.partitionBy(label).orderBy(key)))
        out = out.unionByName(numbered.withColumn("split", tag(F.col("_at") <= left)).drop("_at"))
    return out.select(*df.columns, "split")


def sample_rows(df: DataFrame, n: int, key: str = "row_id", seed: int = 0) -> DataFrame:
    """Exactly ``n`` rows (or all), without replacement: the first ones in hash order."""
    return hash_ranks(df, key, [], seed).filter(F.col("rank") <= n).select(*df.columns)


def stratified_sample(df: DataFrame, label: str, n: int, key: str = "row_id", seed: int = 0) -> DataFrame:
    return stratified_split(df, label, n, key, seed).filter("split = 'first'").drop("split")


def tag_and_union(parts: dict[str, DataFrame]) -> DataFrame:
    """One table from several, each row tagged with its ``split``."""
    tagged = [df.withColumn("split", F.lit(name)) for name, df in parts.items()]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df)
    return out


def split_back(df: DataFrame, names: list[str]) -> dict[str, DataFrame]:
    return {n: df.filter(F.col("split") == n).drop("split") for n in names}
