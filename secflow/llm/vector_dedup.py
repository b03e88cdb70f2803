"""Near-duplicate vectors by sorted projection passes.

Equal vectors become one class. Each pass hashes the classes by the signs of random projections and orders
them by the concatenated signs; vectors of a small angle share long prefixes and so come to lie near each other.
Neighbours in that order are compared, window by window, and the verified pairs of all passes are united into
components. The window bounds what a pass compares, not what is reported: links are counted exactly inside each
component afterwards. What is less than half the threshold's angle from the mean of its component links with all
others that are, without a comparison; the rest is compared in bounded blocks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from secflow.llm import common
from secflow.llm.graph import components

COSINE = 0.95
#: Places ahead that a vector is compared with in a pass, and vectors of a block.
WINDOW, BLOCK = 512, 2048
#: Chance that a lone pair exactly at the threshold meets in some window; sets the number of passes.
TARGET = 0.98
#: Signs in the key of a pass.
SIGNS = 48
#: A table of one row per large component is broadcast up to this many rows, and joined by shuffle beyond.
MOST_BROADCAST = 10_000

_TILE = 512
_LOWEST = -(1 << 63)


def passes_for(vectors: int, cosine: float = COSINE, window: int = WINDOW, target: float = TARGET) -> int:
    """Passes after which two vectors of that cosine met with chance ``target``.

    A window reaches about as far as the rows that share log2(vectors / window) signs, and each sign
    agrees with chance 1 - angle / pi.
    """
    together = (1 - math.acos(cosine) / math.pi) ** max(0.0, math.log2(max(1, vectors) / window))
    return 1 if together >= target else math.ceil(math.log(1 - target) / math.log(1 - together))


def _units(blobs: list[bytes], code: str) -> np.ndarray:
    """Rows of length one, in doubles, from equally long rows of bytes."""
    rows = np.frombuffer(b"".join(blobs), code).reshape(len(blobs), -1).astype(np.float64)
    rows /= np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def _near(a: np.ndarray, b: np.ndarray, cosine: float) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, marks) of tiles of ``a`` against ``b``: single precision decides what lies clear of the limit, doubles the rest."""
    margin = 1e-6 + 2.4e-7 * a.shape[1]
    single = b.astype(np.float32).T
    for start in range(0, len(a), _TILE):
        found = a[start:start + _TILE].astype(np.float32) @ single
        near = found >= cosine
        i, j = np.nonzero(np.abs(found - np.float32(cosine)) <= margin)
        for k in range(0, len(i), 1 << 16):
            x, y = i[k:k + (1 << 16)], j[k:k + (1 << 16)]
            near[x, y] = np.einsum("ij,ij->i", a[start + x], b[y]) >= cosine
        yield start, near


def _by_width(table: pa.Table) -> Iterator[pa.Table]:
    """Rows of each vector length apart; vectors of different lengths never link."""
    widths = pc.binary_length(table["vec"]).to_numpy()
    for w in np.unique(widths):
        yield table.take(pa.array(np.flatnonzero(widths == w)))


def spanning_links(near: np.ndarray) -> list[tuple[int, int]]:
    """Stars that join what is connected in a symmetric table of marks."""
    near[np.arange(len(near)), np.arange(len(near))] = False
    left, links = near.any(1), []
    while left.any():
        hub = int(np.argmax(left))
        left[hub], front = False, np.array([hub])
        while len(front):
            front = np.flatnonzero(near[front].any(0) & left)
            left[front] = False
            links += [(hub, int(i)) for i in front]
    return links


def _entries(docs: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, str]:
    """One row per distinct vector of a batch, with the ids that have it; vectors that link with nothing have no digest."""
    single = dict(docs.dtypes)[vec_col] == "array<float>"
    code = "<f4" if single else "<f8"

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = batch["vec_id"].to_pylist(), batch["vec"]
            lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
            flat = np.ascontiguousarray(vectors.flatten().to_numpy(zero_copy_only=False), code)
            ends = np.cumsum(lengths)
            odd = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            set_ = np.concatenate([[0], np.cumsum(flat != 0)])
            usable = (odd[ends] == odd[ends - lengths]) & (set_[ends] > set_[ends - lengths])
            held: dict[bytes | None, list] = {}
            first: dict[bytes | None, bytes | None] = {None: None}
            for own, start, end, good in zip(ids, ends - lengths, ends, usable):
                blob = flat[start:end].tobytes() if good else None
                digest = hashlib.blake2b(blob, digest_size=16).digest() if good else None
                held.setdefault(digest, []).append(own)
                first.setdefault(digest, blob)
            yield pa.RecordBatch.from_pydict({
                "digest": pa.array(list(held), pa.binary()), "ids": pa.array(list(held.values()), pa.list_(pa.int64())),
                "vec": pa.array([first[d] for d in held], pa.binary())})

    vec = F.col(vec_col) if single else F.col(vec_col).cast("array<double>")
    rows = docs.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec"))
    return rows.mapInArrow(gather, "digest binary, ids array<long>, vec binary"), code


def _node(least: Column, digest: Column) -> Column:
    """A class as bytes that sort by its least id (null last), then its digest."""
    shown = F.lpad(F.hex(F.coalesce(least, F.lit(0)).bitwiseXOR(F.lit(_LOWEST))), 16, "0")
    return F.concat(F.unhex(F.concat(F.when(least.isNull(), "01").otherwise("00"), shown)), digest)


def _least_id(node: Column) -> Column:
    number = F.conv(F.hex(F.substring(node, 2, 8)), 16, -10).cast("long").bitwiseXOR(F.lit(_LOWEST))
    return F.when(F.hex(F.substring(node, 1, 1)) == "00", number)


def link_vectors(classes: DataFrame, code: str, cosine: float = COSINE, window: int = WINDOW, block: int = BLOCK,
                 target: float = TARGET, seed: int = 11) -> DataFrame:
    """(a, b): links that join all classes (node, vec) which the passes found connected; never all pairs of a window."""
    passes = passes_for(classes.count(), cosine, window, target)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            for part in _by_width(pa.Table.from_batches([batch])):
                units = _units(part["vec"].to_pylist(), code)
                d = units.shape[1]
                if d not in planes:
                    planes[d] = np.random.default_rng((seed, d)).standard_normal((d, passes * SIGNS))
                signs = (units @ planes[d] > 0).reshape(len(units) * passes, SIGNS)
                key = signs @ (1 << np.arange(SIGNS - 1, -1, -1, dtype=np.int64))
                yield pa.RecordBatch.from_pydict({
                    "pass": np.tile(np.arange(passes, dtype=np.int32), len(units)), "width": np.full(len(key), d, np.int32), "key": key,
                    "node": part["node"].combine_chunks().take(pa.array(np.repeat(np.arange(len(units)), passes)))})

    def link_block(table: pa.Table) -> pa.Table:
        a, b = [], []
        for part in _by_width(table):
            node, units = part["node"].to_pylist(), _units(part["vec"].to_pylist(), code)
            for i, j in spanning_links(np.concatenate([near for _, near in _near(units, units, cosine)])):
                a.append(node[i])
                b.append(node[j])
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    hashed = classes.select("node", "vec").mapInArrow(keys, "pass int, width int, key long, node binary")
    placed = common.ranked(hashed, ["pass", "width", "key", "node"], "vector-order")
    own = F.floor(F.col("place") / block).cast("long")
    ahead = F.when((F.col("place") % block < window) & (own > 0), F.array(own, own - 1)).otherwise(F.array(own))
    seated = placed.select("node", F.explode(ahead).alias("block")).join(classes.select("node", "vec"), "node")
    return common.stored(seated.groupBy("block").applyInArrow(link_block, "a binary, b binary"), "vector-links")


def count_links(member: DataFrame, code: str, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """(node, links): vectors of other classes that each class (component, node, n, vec) links with, inside its component."""

    def inside(table: pa.Table) -> pa.Table:
        table = table.sort_by("component")
        names = table["component"].to_pylist()
        cuts = [0, *[i for i in range(1, len(names)) if names[i] != names[i - 1]], len(names)]
        vec, n, links = table["vec"].to_pylist(), table["n"].to_numpy(), np.zeros(len(names), np.int64)
        for start, end in zip(cuts, cuts[1:]):
            units = _units(vec[start:end], code)
            for at, near in _near(units, units, cosine):
                near[np.arange(len(near)), np.arange(at, at + len(near))] = False
                links[start + at:start + at + len(near)] = near @ n[start:end]
        return pa.table({"node": table["node"], "links": links})

    sizes = member.groupBy("component").agg(F.count("*").alias("m"))
    large = common.stored(sizes.where(F.col("m") > block), "large-components")
    total, n_large = member.count(), large.count()

    def looked_up(table: DataFrame) -> DataFrame:
        return F.broadcast(table) if n_large <= MOST_BROADCAST else table

    small = member if n_large == 0 else member.join(looked_up(large.select("component")), "component", "left_anti")
    dealt = small.withColumn("bucket", F.pmod(F.xxhash64("component"), F.lit(max(1, math.ceil(total / block)))))
    links = dealt.groupBy("bucket").applyInArrow(inside, "node binary, links long")
    return links if n_large == 0 else links.unionByName(_large_links(member.join(looked_up(large), "component"), looked_up, code, cosine, block))


def _large_links(member: DataFrame, looked_up: Callable[[DataFrame], DataFrame], code: str, cosine: float, block: int) -> DataFrame:
    """Links in components above the block size: the core links with itself, the rim is compared in blocks."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[bytes, list[bytes]] = {}
            for name, vec in zip(batch["component"].to_pylist(), batch["vec"].to_pylist()):
                rows.setdefault(name, []).append(vec)
            total = {name: _units(own, code).sum(0) for name, own in rows.items()}
            yield pa.RecordBatch.from_pydict({"component": pa.array(list(total), pa.binary()),
                                              "mean": pa.array([t.tobytes() for t in total.values()], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        mean = sum(np.frombuffer(b) for b in table["mean"].to_pylist())
        length = math.sqrt(float(mean @ mean))
        return pa.table({"component": table["component"][:1], "mean": pa.array([(mean / length if length > 0 else mean).tobytes()], pa.binary())})

    half = math.cos(math.acos(cosine) / 2) + 1e-9

    def rims(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _by_width(pa.Table.from_batches([batch])):
                to_mean = np.einsum("ij,ij->i", _units(part["vec"].to_pylist(), code), np.frombuffer(b"".join(part["mean"].to_pylist())).reshape(part.num_rows, -1))
                part = part.drop_columns("mean").append_column("rim", pa.array(to_mean < half))
                yield from part.combine_chunks().to_batches()

    def compare(table: pa.Table) -> pa.Table:
        asks = table["asks"].to_numpy()
        asked, held = table.filter(pa.array(asks)), table.filter(pa.array(~asks))
        n_asked, n_held, rim = asked["n"].to_numpy(), held["n"].to_numpy(), held["rim"].to_numpy()
        if not asked.num_rows or not held.num_rows:
            return pa.table({"node": asked["node"], "links": np.zeros(asked.num_rows, np.int64)})
        out, back = np.zeros(asked.num_rows, np.int64), np.zeros(held.num_rows, np.int64)
        place = {v: i for i, v in enumerate(held["node"].to_pylist())}
        same = np.array([place.get(v, -1) for v in asked["node"].to_pylist()])
        for at, near in _near(_units(asked["vec"].to_pylist(), code), _units(held["vec"].to_pylist(), code), cosine):
            own = same[at:at + len(near)]
            near[np.flatnonzero(own >= 0), own[own >= 0]] = False
            out[at:at + len(near)] = near @ n_held
            back += n_asked[at:at + len(near)] @ near
        back[rim] = 0
        return pa.table({"node": pa.concat_arrays([asked["node"].combine_chunks(), held["node"].combine_chunks()]), "links": np.concatenate([out, back])})

    means = member.select("component", "vec").mapInArrow(sums, "component binary, mean binary").groupBy("component").applyInArrow(add, "component binary, mean binary")
    with_mean = member.join(looked_up(common.stored(means, "component-means")), "component")
    held = common.stored(with_mean.mapInArrow(rims, "component binary, node binary, n long, vec binary, m long, rim boolean"), "large-members")
    shape = held.groupBy("component").agg(F.count_if("rim").alias("rim_rows"), F.sum(F.when(~F.col("rim"), F.col("n"))).alias("core_n"),
                                          F.ceil(F.max("m") / block).cast("int").alias("parts"))
    shape = looked_up(shape.withColumn("rims", F.ceil(F.col("rim_rows") / block).cast("int")).drop("rim_rows"))
    placed = held.join(shape, "component")
    core = placed.where(~F.col("rim")).select("node", (F.col("core_n") - F.col("n")).alias("links"))
    seat, rim_seat = F.pmod(F.xxhash64("node"), "parts").cast("int"), F.pmod(F.xxhash64("node", F.lit(1)), "rims").cast("int")
    asked = placed.where("rim").select("component", rim_seat.alias("rim_part"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                                       F.lit(True).alias("asks"), "node", "n", "vec", "rim")
    rows = placed.where("rims > 0").select("component", F.explode(F.sequence(F.lit(0), F.col("rims") - 1)).alias("rim_part"), seat.alias("part"),
                                           F.lit(False).alias("asks"), "node", "n", "vec", "rim")
    compared = asked.unionByName(rows).groupBy("component", "rim_part", "part").applyInArrow(compare, "node binary, links long")
    return core.unionByName(compared)


def dedup_vectors(docs: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = COSINE, window: int = WINDOW,
                  block: int = BLOCK, target: float = TARGET) -> DataFrame:
    """Links, component and verdict of every row: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Two rows link when the cosine of their vectors, in doubles, is at least ``cosine``. ``n_links`` counts the
    other rows linked directly, ``component_id`` is the least id reachable by links, and a row is kept when that is
    its own id. No link below the limit is ever reported; a pair at the limit is found with chance ``target`` on its
    own, more often the closer it is or the more others connect it.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, nor do vectors of
    different lengths. A null id stays null and never is a component's least id unless all are null; it is kept when
    its component has no other. Repeated rows are rows of their own and link with each other. Other columns are
    ignored whatever their names, and an empty table gives an empty result.
    """
    if not 0 < cosine <= 1 or window > block:
        raise ValueError("cosine must lie in (0, 1], and a window inside a block")
    raw, code = _entries(docs, id_col, vec_col)
    entries = common.stored(raw, "vector-entries")
    classes = (entries.where("digest IS NOT NULL").groupBy("digest")
               .agg(F.min(F.array_min("ids")).alias("least"), F.sum(F.size("ids")).alias("n"), F.first("vec").alias("vec")))
    classes = common.stored(classes.select("digest", _node(F.col("least"), F.col("digest")).alias("node"), "n", "vec"), "vector-classes")
    joined = common.stored(components(link_vectors(classes, code, cosine, window, block, target)), "vector-components")
    member = common.stored(joined.join(classes.drop("digest"), "node").select("component", "node", "n", "vec"), "vector-members")
    links = count_links(member, code, cosine, block).groupBy("node").agg(F.sum("links").alias("links"))
    of_class = (classes.drop("vec").join(joined, "node", "left").join(links, "node", "left")
                .select("digest", _least_id(F.coalesce("component", "node")).alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    rows = entries.drop("vec").join(of_class, "digest", "left").select("digest", F.explode("ids").alias("vec_id"), "component_id", "n_links")
    component = F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return rows.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
                       component.eqNullSafe(F.col("vec_id")).alias("kept"))
