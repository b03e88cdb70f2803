"""Exact nearest-neighbour and radius joins over vectors.

No step pairs all rows. A bounded set of pivots (reference rows picked by hash) splits the
reference side into cells, each with the range of distances to its pivot. By the triangle
inequality a row only visits cells that can hold a neighbour within its bound: the radius, or
the distance to its k-th nearest pivot. The cells are strung into parts of bounded size, a row is sent
to the parts with open cells, and a task compares two parts block by block, holding one matrix of
distances at a time. It emits only what the caller aggregates (k rows, a count, a nearest one), put
together for the whole task, never the pairs. Identical vectors are
merged first, so copies cost one row. Only ``pairs_within`` lists pairs; it unfolds the copies
after the blocks are compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from secflow.functions.geometry import array_features, as_matrix, block_distances, internal, pair_distances, reported

BLOCK_ROWS = 2048
MOST_PIVOTS = 128
MOST_PARTS = 16
PART_ROWS = 32_768
_HELD_ROWS = 1 << 20
_SLACK = 1e-7


@dataclass(frozen=True)
class Cells:
    """Pivots with the row count and distance range of the cell around each."""

    pivots: np.ndarray
    count: np.ndarray
    low: np.ndarray
    high: np.ndarray
    metric: str
    block_rows: int


def _fields(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)


def _placed(right: DataFrame, pivots: np.ndarray, metric: str) -> DataFrame:
    def place(batches):
        for pdf in batches:
            if len(pdf):
                d = block_distances(as_matrix(pdf["features"]), pivots, metric)
                cell = d.argmin(1)
                yield pdf.assign(cell=cell, reach=d[np.arange(len(pdf)), cell])

    return right.mapInPandas(place, f"{_fields(right)}, cell long, reach double")


def _chained(pivots: np.ndarray, metric: str) -> np.ndarray:
    """The pivots in an order where neighbours stand together."""
    d = block_distances(pivots, pivots, metric)
    order, left = [0], np.ones(len(pivots), bool)
    left[0] = False
    while left.any():
        order.append(int(np.where(left, np.nan_to_num(d[order[-1]], nan=np.inf), np.inf).argmin()) if left.sum() > 1 else int(left.argmax()))
        if not left[order[-1]]:  # nothing but infinite distances left
            order[-1] = int(left.argmax())
        left[order[-1]] = False
    return pivots[order]


def build_cells(right: DataFrame, metric: str, block_rows: int = BLOCK_ROWS, least: int = 8) -> tuple[Cells | None, DataFrame]:
    """Choose pivots from ``right`` (id, features) and place every row in the cell of its nearest one."""
    total = right.count()
    if total == 0:
        return None, right
    wanted = int(min(MOST_PIVOTS, max(least, total // 256)))
    picked = right.select("features").orderBy(F.xxhash64("features"), "id").limit(wanted).collect()
    pivots = _chained(np.array([r["features"] for r in picked], dtype=np.float64), metric)
    placed = _placed(right, pivots, metric)
    count, low, high = np.zeros(len(pivots), np.int64), np.zeros(len(pivots)), np.full(len(pivots), -np.inf)
    for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.min("reach").alias("lo"), F.max("reach").alias("hi")).collect():
        count[r["cell"]], low[r["cell"]], high[r["cell"]] = r["n"], r["lo"], r["hi"]
    return Cells(pivots, count, low, high, metric, block_rows), placed


def side_parts(rows: int, block_rows: int) -> int:
    """Number of parts of one side. Every part of one side meets the parts of the other in tasks of their own, so a
    row is sent once per part of the other side: few parts, unless a part outgrows a task."""
    return int(max(1, min(MOST_PARTS, -(-rows // block_rows)), -(-rows // PART_ROWS)))


class _Parts:
    """Parts of about equal size along the chain of cells; a crowded cell lies in several."""

    def __init__(self, count: np.ndarray, block_rows: int):
        self.count = count
        self.start = np.cumsum(count) - count
        total = int(count.sum())
        self.number = side_parts(total, block_rows)
        self.size = max(1, -(-total // self.number))

    def of(self, cell: int) -> range:
        first, rows = int(self.start[cell]), int(self.count[cell])
        return range(first // self.size, (first + rows - 1) // self.size + 1) if rows else range(0)

    def column(self) -> Column:
        start, rows = F.array(*[F.lit(int(v)) for v in self.start]), F.array(*[F.lit(max(1, int(v))) for v in self.count])
        at = F.get(start, F.col("cell")) + F.pmod(F.xxhash64("id"), F.get(rows, F.col("cell")))
        return F.floor(at / self.size).cast("int")


def _open_cells(x: np.ndarray, cells: Cells, radius: float | None, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of each row and the cells it has to look into."""
    d = block_distances(x, cells.pivots, cells.metric)
    if radius is not None:
        bound = np.full((len(x), 1), radius)
    elif k <= d.shape[1]:
        bound = np.partition(d, k - 1, axis=1)[:, k - 1:k]
    else:
        bound = np.full((len(x), 1), np.inf)
    bound = bound * (1 + _SLACK) + _SLACK
    return d.argmin(1), (cells.count > 0) & (d - cells.high <= bound) & (cells.low - d <= bound)


def _visits(left: DataFrame, cells: Cells, parts: _Parts, radius: float | None, k: int) -> DataFrame:
    """Append ``cell``, that of the nearest pivot, and ``open``, the parts of the other side each row has to look into."""
    holds = np.zeros((len(cells.pivots), parts.number), np.float32)
    for c in range(len(holds)):
        holds[c, list(parts.of(c))] = 1

    def visit(batches):
        for pdf in batches:
            if len(pdf):
                cell, open_ = _open_cells(as_matrix(pdf["features"]), cells, radius, k)
                met = open_.astype(np.float32) @ holds > 0
                yield pdf.assign(cell=cell, open=[np.nonzero(row)[0] for row in met])

    return left.mapInPandas(visit, f"{_fields(left)}, cell long, open array<int>")


def _typed(pdf: pd.DataFrame, types: dict[str, str]) -> pd.DataFrame:
    """The columns of one side with their own types, which the other side's nulls widened."""
    whole = {"bigint": np.int64, "int": np.int32, "boolean": bool}
    out = pdf[list(types)].reset_index(drop=True)
    return out.astype({c: whole[t] for c, t in types.items() if t in whole and out[c].dtype != whole[t]}) if len(out) else out


def grouped_blocks(left: DataFrame, right: DataFrame, keys: list[str], work: Callable, schema: str, merge: Callable | None = None) -> DataFrame:
    """Run ``work(left_rows, right_rows)``, which yields frames, on the two sides of every key.

    Frames go out as they come; with ``merge`` (frame -> smaller frame of the same meaning) they are put together first.
    """
    types = [dict(df.dtypes) for df in (left, right)]
    both = left.withColumn("_right", F.lit(False)).unionByName(right.withColumn("_right", F.lit(True)), allowMissingColumns=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sides = [[], []]
        for pdf in batches:
            of_right = pdf["_right"].to_numpy(dtype=bool)
            for own, kind, held in zip((~of_right, of_right), types, sides):
                if own.any():
                    held.append(_typed(pdf[own], kind))
        if not all(sides):
            return
        l, r = (pd.concat(held, ignore_index=True) for held in sides)
        del sides
        held, rows = [], 0
        for frame in work(l, r):
            if not len(frame):
                continue
            if merge is None:
                yield frame
                continue
            held.append(frame)
            rows += len(frame)
            if rows > _HELD_ROWS:
                held = [merge(pd.concat(held, ignore_index=True))]
                rows = len(held[0])
                if rows > _HELD_ROWS // 2:
                    yield held.pop()
                    rows = 0
        if held:
            yield merge(pd.concat(held, ignore_index=True))

    return both.groupBy(*keys).applyInPandas(run, schema)


def slices(rows: int, size: int) -> list[slice]:
    return [slice(i, min(i + size, rows)) for i in range(0, rows, size)]


def block_join(
    left: DataFrame, cells: Cells, placed: DataFrame, compare: Callable, schema: str, radius: float | None = None, k: int = 1,
    merge: Callable | None = None, limits=(),
) -> DataFrame:
    """Run ``compare(left_block, right_block, distances, exact)`` on every pair of blocks that can matter.

    ``exact(i, j)`` are the distances of single pairs, from their differences. The distances hold on which side of
    ``limits`` they are.
    """
    spark = left.sparkSession
    if cells is None:  # no reference rows at all
        return spark.createDataFrame([], schema)
    theirs = _Parts(cells.count, cells.block_rows)
    visits = _visits(left, cells, theirs, radius, k)
    load, meets = np.zeros(len(cells.pivots), np.int64), {}
    marked = visits.select("cell", F.explode(F.array_prepend("open", F.lit(-1))).alias("part"))
    for r in marked.groupBy("cell", "part").agg(F.count("*").alias("n")).collect():  # pivots x parts at most
        if r["part"] < 0:
            load[r["cell"]] = r["n"]
        else:
            meets.setdefault(r["cell"], []).append(r["part"])
    mine = _Parts(load, cells.block_rows)
    pairs = sorted({(lp, rp) for cell, parts in meets.items() for lp in mine.of(cell) for rp in parts})
    if not pairs:
        return spark.createDataFrame([], schema)
    a = visits.withColumn("lp", mine.column()).withColumn("rp", F.explode("open")).drop("cell", "open")
    b = placed.withColumn("rp", theirs.column()).drop("reach").join(F.broadcast(spark.createDataFrame(pairs, "lp int, rp int")), "rp")
    metric, size = cells.metric, cells.block_rows

    def work(l: pd.DataFrame, r: pd.DataFrame):
        r = r.sort_values("cell", kind="stable", ignore_index=True)
        y, of_cell = as_matrix(r["features"]), r["cell"].to_numpy()
        r = r.drop(columns=["features", "cell"])
        rights = [(s, np.unique(of_cell[s])) for s in slices(len(r), size)]
        for at in slices(len(l), size):
            block = l.iloc[at]
            x = as_matrix(block["features"])
            block = block.drop(columns=["features"])
            open_ = _open_cells(x, cells, radius, k)[1]
            for s, inside in rights:
                rows = np.nonzero(open_[:, inside].any(1))[0]
                if len(rows):
                    p, q = x[rows], y[s]
                    yield compare(block.iloc[rows], r.iloc[s], block_distances(p, q, metric, limits),
                                  lambda i, j: pair_distances(p[i], q[j], metric))

    return grouped_blocks(a, b, ["lp", "rp"], work, schema, merge)


def summed(*by: str) -> Callable:
    """Merge of frames whose other columns are sums."""
    return lambda pdf: pdf.groupby(list(by), as_index=False, sort=False).sum()


def _vectors(df: DataFrame, key: str, features: str) -> DataFrame:
    return df.select(F.col(key).cast("long").alias("id"), array_features(df, features).alias("features"))


def distinct_vectors(points: DataFrame) -> DataFrame:
    """(id, features, weight): one row per distinct vector with its lowest id and its copies."""
    return points.groupBy("features").agg(F.min("id").alias("id"), F.count("*").alias("weight")).select("id", "features", "weight")


def nearest(
    left: DataFrame, right: DataFrame, k: int = 1, metric: str = "euclidean", key: str = "row_id",
    features: str = "features", exclude_self: bool = False, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(key, neighbor, distance, rank): the exact k nearest reference rows of each left row, ties by id."""
    need = k + int(exclude_self)
    copies = Window.partitionBy("features").orderBy("id")
    reference = _vectors(right, key, features).withColumn("_c", F.row_number().over(copies)).filter(F.col("_c") <= need).drop("_c")
    rows = _vectors(left, key, features)
    queries = distinct_vectors(rows).drop("weight")
    cells, placed = build_cells(reference, metric, block_rows, least=max(8, need + 1))
    schema = "id long, neighbor long, distance double"
    if cells is None:
        return left.sparkSession.createDataFrame([], f"{key} long, neighbor long, distance double, rank int")

    def closest(l, r, d, exact):
        d = np.where(np.isnan(d), np.inf, d)
        take = min(need, d.shape[1])
        cut = np.partition(d, take - 1, axis=1)[:, take - 1:take]
        i, j = np.divmod(np.flatnonzero(d <= cut * (1 + _SLACK) + _SLACK), len(r))
        return first(pd.DataFrame({"id": l["id"].to_numpy()[i], "neighbor": r["id"].to_numpy()[j], "distance": reported(exact(i, j), metric)}))

    def first(pdf):
        """The ``need`` nearest of every id."""
        order = np.lexsort((pdf["neighbor"], pdf["distance"], pdf["id"]))
        ids = pdf["id"].to_numpy()[order]
        start = np.r_[True, ids[1:] != ids[:-1]]
        rank = np.arange(len(ids)) - np.maximum.accumulate(np.where(start, np.arange(len(ids)), 0))
        return pdf.iloc[order[rank < need]]

    found = block_join(queries, cells, placed, closest, schema, k=need, merge=first)
    best = Window.partitionBy("id").orderBy("distance", "neighbor")
    top = found.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= need)
    lists = top.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("distance", "neighbor"))).alias("near"))
    owner = queries.select(F.col("id").alias("_owner"), "features")
    whole = rows.join(owner, "features").join(lists.withColumnRenamed("id", "_owner"), "_owner")
    if exclude_self:
        whole = whole.withColumn("near", F.filter("near", lambda n: n["neighbor"] != F.col("id")))
    return whole.select(F.col("id").alias(key), F.posexplode(F.slice("near", 1, k)).alias("_p", "_n")).select(
        key, "_n.neighbor", "_n.distance", (F.col("_p") + 1).cast("int").alias("rank")
    )


def pairs_within(
    df: DataFrame, radius: float, metric: str = "euclidean", key: str = "row_id", features: str = "features", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(left, right, distance) of rows at most ``radius`` apart, ``left < right``, copies of one vector included."""
    rows = _vectors(df, key, features)
    distinct = distinct_vectors(rows)
    points = distinct.drop("weight")
    cells, placed = build_cells(points, metric, block_rows)
    limit = internal(radius, metric)

    def close(l, r, d, exact):
        a, b = l["id"].to_numpy(), r["id"].to_numpy()
        if metric == "cosine":  # a vector to itself, free of rounding (zero vectors stay at 1)
            d = np.where((a[:, None] == b) & (d < 1), 0.0, d)
            i, j = np.nonzero((d <= limit) & (a[:, None] <= b))
            return pd.DataFrame({"left": a[i], "right": b[j], "distance": reported(d[i, j], metric)})
        i, j = np.divmod(np.flatnonzero(d <= limit), len(b))
        kept = a[i] <= b[j]
        i, j = i[kept], j[kept]
        return pd.DataFrame({"left": a[i], "right": b[j], "distance": exact(i, j)})

    near = block_join(points, cells, placed, close, "left long, right long, distance double", radius=limit, limits=(limit,))
    if distinct.filter("weight > 1").isEmpty():
        return near.filter("left < right")
    return _unfolded(near, rows, distinct, block_rows)


def _unfolded(near: DataFrame, rows: DataFrame, distinct: DataFrame, block_rows: int) -> DataFrame:
    """Pairs of rows from pairs of lowest copies: the copies of a vector lie in lists of about ``block_rows`` ids,
    and every two lists of a pair meet in a row of their own."""
    parts = F.ceil(F.col("weight") / block_rows).cast("int")
    owners = distinct.select(F.col("id").alias("owner"), "features", parts.alias("parts"))
    lists = (rows.join(owners, "features").withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int"))
             .groupBy("owner", "part").agg(F.collect_list("id").alias("ids")))

    def side(name: str) -> DataFrame:
        return owners.select(F.col("owner").alias(name), F.sequence(F.lit(0), F.col("parts") - 1).alias(f"{name}_parts"))

    def ids(name: str) -> DataFrame:
        return lists.select(F.col("owner").alias(name), F.col("part").alias(f"{name}_part"), F.col("ids").alias(f"{name}_ids"))

    met = near.join(side("left"), "left").join(side("right"), "right")
    met = met.withColumn("left_part", F.explode("left_parts")).withColumn("right_part", F.explode("right_parts"))
    met = met.join(ids("left"), ["left", "left_part"]).join(ids("right"), ["right", "right_part"])
    pairs = met.select((F.col("left") == F.col("right")).alias("same"), "distance", "right_ids", F.explode("left_ids").alias("a")).select(
        "same", "distance", "a", F.explode("right_ids").alias("b"))
    return pairs.filter("a < b OR NOT same").select(F.least("a", "b").alias("left"), F.greatest("a", "b").alias("right"), "distance")
