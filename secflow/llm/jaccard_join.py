"""Similarity join of shingle sets through a token-group matrix.

Documents with equal sets become one class. A class takes part only where enough of its shingles
occur in other classes. Similar classes are gathered into groups of bounded size, in several ways; their
members are linked among themselves. Each class then belongs to the largest of its groups, whose matrix
row is the union of its members' shingles. A class queries the groups that hold one of its rarest
shingles: what both sides have from that shingle on bounds the overlap before any set is fetched, the
overlap with the group's union bounds the overlap with any member, and only groups that reach the
threshold are opened. Components need one link between two classes already known to be connected; link
counts need all of them, so for those every class asks every group that passes the bounds, its own as well.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow.llm import common
from secflow.llm.graph import components
from secflow.llm.hashing import BLANK_SPLIT, LOWER_AZ, U64, SpanHash, bucket_runs, bucketed, hash_words, mix

WORDS = 4
PERCENT = 85
#: Ways to gather similar classes, by the least shingle under that many hash functions.
FAMILIES = 4
#: Most members of a group, and most queries that open a group in one task.
GROUP = 512
QUERIES = 512


class _Sets:
    """Shingle sets of a chunk of documents: sorted hashes ``tokens[first[i]:first[i + 1]]``, and a digest of each."""

    def __init__(self, table: pa.Table, words: int):
        hasher = SpanHash(51)
        found = hash_words(common.utf8(table["text"]), BLANK_SPLIT, [hasher], LOWER_AZ)
        counts, owner = found.counts, found.text_of()
        at = np.arange(len(owner))
        place = at - found.first[owner]
        at = at[(place + words <= counts[owner]) | (place == 0)]
        width = np.minimum(counts[owner[at]], words)
        tokens, owner = found.windows(at, width, [hasher])[0], owner[at]
        order = np.lexsort((tokens, owner))
        tokens, owner = tokens[order], owner[order]
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
        self.tokens = tokens[new]
        self.sizes = np.bincount(owner[new], minlength=table.num_rows)
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])
        self.digests = [hashlib.blake2b(self.own(i).tobytes(), digest_size=16).digest() if n else None
                        for i, n in enumerate(self.sizes)]

    def own(self, i: int) -> np.ndarray:
        return self.tokens[self.first[i]:self.first[i + 1]]

    def homes(self, digests: set[bytes]) -> list[int]:
        """The first document of each class that this chunk stands for."""
        left, out = set(digests), []
        for i, d in enumerate(self.digests):
            if d in left:
                left.remove(d)
                out.append(i)
        return out


def _level(counts: np.ndarray) -> np.ndarray:
    """0 for a token of one class, else 1 more than the whole part of the binary logarithm of its classes."""
    return np.where(counts < 2, 0, np.floor(np.log2(np.maximum(counts, 1))) + 1).astype(np.uint8)


def _token_levels(table: pa.Table) -> pa.Table:
    """Levels of each chunk's sorted tokens of a bucket, from the classes of all chunks."""
    parts = [np.frombuffer(k, np.uint32) for k in table["keys"].to_pylist()]
    counts = np.concatenate([np.frombuffer(k, np.uint32) for k in table["counts"].to_pylist()])
    _, number = np.unique(np.concatenate(parts), return_inverse=True)
    levels = _level(np.bincount(number, weights=counts))[number]
    cut = np.split(levels, np.cumsum([len(p) for p in parts])[:-1])
    return pa.table({"chunk": table["chunk"], "bucket": table["bucket"], "payload": pa.array([c.tobytes() for c in cut], pa.binary())})


class _Matrix:
    """Members of one group: their sets as places in the union."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        self.union, self.places = np.unique(np.concatenate(sets), return_inverse=True)
        self.first = np.cumsum(self.sizes) - self.sizes

    def overlap_bound(self, query: np.ndarray) -> np.ndarray:
        """Marks of the union's tokens that the query has; their number bounds every overlap."""
        slot = np.minimum(np.searchsorted(self.union, query), len(self.union) - 1)
        marks = np.zeros(len(self.union), np.int64)
        marks[slot[self.union[slot] == query]] = 1
        return marks

    def links(self, marks: np.ndarray, size: int, percent: int) -> np.ndarray:
        """Members that reach the threshold with a query of these marks."""
        both = np.add.reduceat(marks[self.places], self.first)
        return np.flatnonzero(100 * both >= percent * (self.sizes + size - both))


def _sets(table: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(s, U64) for s in table["tokens"].to_pylist()]


_EDGES = "a binary, b binary"


def _edge_table(edges: list[tuple[bytes, bytes]]) -> pa.Table:
    return pa.table({k: pa.array([e[i] for e in edges], pa.binary()) for i, k in enumerate("ab")})


def join_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT,
                 group: int = GROUP, queries: int = QUERIES, chunk_bytes: int = common.CHUNK_BYTES, links: bool = False) -> DataFrame:
    """Set size and component of every row, where sets link at ``100 * overlap >= percent * union``.

    A set holds the distinct shingles of ``words`` consecutive words (A-Z lower-cased, words being runs
    of anything but space and the controls 9 to 13); a shorter text is one shingle. Returns ``doc_id``,
    ``text_hash`` (xxhash64), ``digest`` (of the set), ``component`` (a member's digest), ``n_shingles``
    and ``component_id``, the least id reachable by links, one row per input row; other columns are
    ignored, whatever their names. With ``links`` there is ``n_links`` too: the other rows that a row links
    with, those of equal set included. It compares each pair of classes that passes the bounds, once from
    each side, and emits a count per class and group asked, never pairs.

    Null and blank texts have an empty set, link with nothing and stand alone under their own id. Equal
    sets always link, whatever their ids. Null ids take part, but give a component its id only when it
    has no other. Repeated rows give repeated equal rows. An empty table gives an empty result.

    The result is exact but for collisions of 64-bit shingle hashes. Candidates come from the rarest
    shingles of each set (those past the overlap that the threshold asks for), so no partner is lost.
    Classes already known to be connected are not compared again, so a large group of near copies costs
    about one comparison per member. Groups hold at most ``group`` members and are opened by at most
    ``queries`` classes per task.
    """
    if words < 1 or not 0 < percent <= 100 or group < 2 or queries < 1:
        raise ValueError("words, percent, group or queries out of range")
    total = common.text_bytes(docs, text_col)
    bits, chunks = common.bucket_bits(total, chunk_bytes), common.chunk_count(total, chunk_bytes)
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))
    by_chunk = rows.withColumn("chunk", common.chunk_of(chunks, "doc_id", "text")).repartition(spread, "chunk").groupBy("chunk")

    def digests(table: pa.Table) -> pa.Table:
        s = _Sets(table, words)
        return pa.table({"chunk": table["chunk"], "doc_id": table["doc_id"], "text_hash": table["text_hash"], "n_shingles": s.sizes.astype(np.int64),
                         "digest": pa.array(s.digests, pa.binary())})

    def need(sizes: np.ndarray) -> np.ndarray:
        return (percent * sizes + 99) // 100

    def chunk_tokens(s: _Sets, homes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct token keys of the classes at home, the key number of each token, and classes by key."""
        own = [s.own(i) for i in homes]
        return np.unique(bucketed(np.concatenate(own) if own else s.tokens[:0], bits), return_inverse=True, return_counts=True)

    def send_tokens(table: pa.Table, homes: pa.Table) -> pa.Table:
        if not homes.num_rows:
            return pa.table({"bucket": pa.array([], pa.int32()), "chunk": pa.array([], pa.int32()),
                             "keys": pa.array([], pa.binary()), "counts": pa.array([], pa.binary())})
        s = _Sets(table, words)
        keys, _, counts = chunk_tokens(s, s.homes(set(homes["payload"].to_pylist())))
        low = (keys & U64(0xFFFFFFFF)).astype(np.uint32)
        runs = bucket_runs(keys)
        return pa.table({
            "bucket": pa.array([r[0] for r in runs], pa.int32()),
            "chunk": pa.array([homes["chunk"][0].as_py()] * len(runs), pa.int32()),
            "keys": pa.array([low[a:b].tobytes() for _, a, b in runs], pa.binary()),
            "counts": pa.array([counts[a:b].astype(np.uint32).tobytes() for _, a, b in runs], pa.binary()),
        })

    active_schema = "digest binary, n int, tokens binary, prefix array<long>, rest array<int>, families array<long>"

    def active(table: pa.Table, replies: pa.Table) -> pa.Table:
        out: dict[str, list] = {name: [] for name in ("digest", "n", "tokens", "prefix", "rest", "families")}
        bucket_of, payload = replies["bucket"].to_pylist(), replies["payload"].to_pylist()
        home = {p for b, p in zip(bucket_of, payload) if b is None}
        if home:
            s = _Sets(table, words)
            homes = s.homes(home)
            keys, number, _ = chunk_tokens(s, homes)
            sent = {b: p for b, p in zip(bucket_of, payload) if b is not None}
            levels = np.concatenate([np.frombuffer(sent[b], np.uint8) for b, _, _ in bucket_runs(keys)])[number]
            end = np.cumsum([s.sizes[i] for i in homes])
            for i, stop in zip(homes, end):
                own, level = s.own(i), levels[stop - s.sizes[i]:stop]
                least = int(need(s.sizes[i]))
                if np.count_nonzero(level) < least:
                    continue
                order = np.lexsort((own, level))[:len(own) - least + 1]
                out["digest"].append(s.digests[i])
                out["n"].append(len(own))
                out["tokens"].append(own.tobytes())
                shared = np.flatnonzero(level[order])
                out["prefix"].append(own[order[shared]].view(np.int64))
                out["rest"].append((len(own) - shared).astype(np.int32))
                out["families"].append([int(mix(own ^ U64(seed)).min().view(np.int64)) for seed in range(FAMILIES)])
        types = (pa.binary(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()))
        return pa.table({name: pa.array(v, t) for (name, v), t in zip(out.items(), types)})

    def link_members(table: pa.Table) -> pa.Table:
        """Stars from the first found to the other members of each component of a group."""
        digest, edges = table["digest"].to_pylist(), []
        matrix, sets = _Matrix(_sets(table)), _sets(table)
        new = np.ones(len(sets), bool)
        while new.any():
            hub = int(np.argmax(new))
            new[hub] = False
            todo = [hub]
            while todo and new.any():
                near = matrix.links(matrix.overlap_bound(sets[todo[-1]]), len(sets[todo.pop()]), percent)
                near = near[new[near]]
                new[near] = False
                todo += near.tolist()
                edges += [(digest[hub], digest[i]) for i in near]
        return _edge_table(edges)

    def count_links(table: pa.Table) -> pa.Table:
        """Rows of the group that link with each query, those of its own class aside."""
        is_query = table["query"].to_numpy().astype(bool)
        members, asked = table.filter(pa.array(~is_query)), table.filter(pa.array(is_query))
        matrix, copies = _Matrix(_sets(members)), members["copies"].to_numpy()
        place = {d: i for i, d in enumerate(members["digest"].to_pylist())}
        counts = []
        for q, tokens in zip(asked["digest"].to_pylist(), _sets(asked)):
            marks, n = matrix.overlap_bound(tokens), 0
            if 100 * int(marks.sum()) >= percent * len(tokens):
                near = matrix.links(marks, len(tokens), percent)
                n = int(copies[near[near != place.get(q, -1)]].sum())
            counts.append(n)
        return pa.table({"digest": asked["digest"], "n_links": pa.array(counts, pa.int64())})

    def open_group(table: pa.Table) -> pa.Table:
        """Links from each query to members of other components, one per component."""
        is_query = table["query"].to_numpy().astype(bool)
        members, asked = table.filter(pa.array(~is_query)), table.filter(pa.array(is_query))
        edges: list[tuple[bytes, bytes]] = []
        matrix = _Matrix(_sets(members))
        digest, part = members["digest"].to_pylist(), members["component"].to_pylist()
        for q, own, tokens in zip(asked["digest"].to_pylist(), asked["component"].to_pylist(), _sets(asked)):
            marks = matrix.overlap_bound(tokens)
            if 100 * int(marks.sum()) >= percent * len(tokens):
                found = {part[i]: digest[i] for i in matrix.links(marks, len(tokens), percent) if part[i] != own}
                edges += [(q, other) for other in found.values()]
        return _edge_table(edges)

    judged = by_chunk.applyInArrow(digests, "chunk int, doc_id long, text_hash long, n_shingles long, digest binary")
    judged = common.stored(judged, "shingle-sets")
    classes = judged.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("least_id"), F.min("chunk").alias("chunk"), F.count("*").alias("copies"))
    homes = classes.select("chunk", F.lit(None).cast("int").alias("bucket"), F.col("digest").alias("payload"))
    levels = (by_chunk.cogroup(homes.groupBy("chunk")).applyInArrow(send_tokens, "bucket int, chunk int, keys binary, counts binary")
              .groupBy("bucket").applyInArrow(_token_levels, "chunk int, bucket int, payload binary"))
    sets = common.stored(by_chunk.cogroup(homes.unionByName(levels).groupBy("chunk")).applyInArrow(active, active_schema), "live-sets")

    filed = sets.select("digest", F.posexplode("families").alias("way", "family"))
    families = (filed.groupBy("way", "family").agg(F.count("*").alias("members"), F.min("digest").alias("pivot"))
                .withColumn("parts", F.ceil(F.col("members") / (group - 1)).cast("int")))
    dealt = common.stored(filed.join(families, ["way", "family"])
                          .withColumn("part", F.pmod(F.xxhash64("digest"), "parts").cast("int")), "set-groups")
    pivots = (dealt.where("parts > 1 AND digest = pivot")
              .withColumn("to", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).where("to <> part")
              .select("way", "family", F.col("to").alias("part"), "digest"))
    seats = dealt.where("members > 1").select("way", "family", "part", "digest").unionByName(pivots)
    inside = (seats.join(sets.select("digest", "tokens"), "digest")
              .groupBy("way", "family", "part").applyInArrow(link_members, _EDGES))
    inside = common.stored(inside, "group-links")
    first = common.stored(components(inside), "group-components")

    home = (dealt.groupBy("digest").agg(F.max(F.struct("members", "way", "family", "part")).alias("home"))
            .select("digest", F.xxhash64("home.way", "home.family").alias("family"), "home.part"))
    member = (sets.join(home, "digest")
              .join(first, F.col("digest") == first.node, "left").withColumn("component", F.coalesce("component", "digest"))
              .select("digest", "n", "family", "part", "component", "tokens", F.arrays_zip("prefix", "rest").alias("prefix")))
    member = common.stored(member, "group-members")
    # A set has ``rest`` tokens from a shared one on, so with another of m tokens, whose first common one it is,
    # it can link only where (100 + percent) * rest >= percent * (n + m), that is slack >= percent * m.
    postings = (member.select("digest", "n", "family", "part", "component", F.explode("prefix").alias("at"))
                .select("digest", "n", "family", "part", "component", F.col("at.prefix").alias("token"),
                        ((100 + percent) * F.col("at.rest").cast("long") - percent * F.col("n")).alias("slack")))
    every_posting = postings
    open_tokens = postings.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("token")
    postings = common.stored(postings.join(open_tokens, "token"), "open-postings")
    rows_of = postings.groupBy("token", "family", "part").agg(F.min("component").alias("to"), F.min("n").alias("least"), F.max("n").alias("most"), F.max("slack").alias("room"))
    other = rows_of.withColumnsRenamed({"family": "to_family", "part": "to_part"})
    asks = (postings.join(other, "token").where("component > to AND NOT (family = to_family AND part = to_part)")
            .where(f"100 * most >= {percent} * n AND {percent} * least <= 100 * n AND slack >= {percent} * least AND room >= {percent} * n")
            .select("digest", F.col("to_family").alias("family"), F.col("to_part").alias("part")).distinct())
    asks = common.stored(asks, "group-queries")
    salts = asks.groupBy("family", "part").agg(F.ceil(F.count("*") / queries).cast("int").alias("salts"))
    asked = (asks.join(salts, ["family", "part"]).join(member.select("digest", "component", "tokens"), "digest")
             .select("family", "part", F.pmod(F.xxhash64("digest"), "salts").cast("int").alias("salt"), F.lit(True).alias("query"),
                     "digest", "component", "tokens"))
    held = (member.join(salts, ["family", "part"]).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
            .select("family", "part", "salt", F.lit(False).alias("query"), "digest", "component", "tokens"))
    across = asked.unionByName(held).groupBy("family", "part", "salt").applyInArrow(open_group, _EDGES)

    last = components(inside.unionByName(across))
    found = classes.join(last, classes.digest == last.node, "left").withColumn("component", F.coalesce("component", "digest"))
    least = found.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_class = found.join(least, "component").select("digest", "component", "component_id", "copies")
    columns = ["doc_id", "text_hash", "digest", "component", "n_shingles",
               F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")]
    if not links:
        return judged.join(of_class, "digest", "left").select(*columns)

    every_posting = common.stored(every_posting.drop("component"), "all-postings")
    rows_of = every_posting.groupBy("token", "family", "part").agg(
        F.count("*").alias("sets"), F.min("n").alias("least"), F.max("n").alias("most"), F.max("slack").alias("room"))
    other = rows_of.withColumnsRenamed({"family": "to_family", "part": "to_part"})
    asks = (every_posting.join(other, "token").where("NOT (family = to_family AND part = to_part AND sets = 1)")
            .where(f"100 * most >= {percent} * n AND {percent} * least <= 100 * n AND slack >= {percent} * least AND room >= {percent} * n")
            .select("digest", F.col("to_family").alias("family"), F.col("to_part").alias("part")).distinct())
    asks = common.stored(asks, "link-queries")
    salts = asks.groupBy("family", "part").agg(F.ceil(F.count("*") / queries).cast("int").alias("salts"))
    asked = (asks.join(salts, ["family", "part"]).join(member.select("digest", "tokens"), "digest")
             .select("family", "part", F.pmod(F.xxhash64("digest"), "salts").cast("int").alias("salt"), F.lit(True).alias("query"),
                     "digest", "tokens", F.lit(0).cast("long").alias("copies")))
    held = (member.join(salts, ["family", "part"]).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
            .join(classes.select("digest", "copies"), "digest")
            .select("family", "part", "salt", F.lit(False).alias("query"), "digest", "tokens", "copies"))
    counted = asked.unionByName(held).groupBy("family", "part", "salt").applyInArrow(count_links, "digest binary, n_links long")
    counted = counted.groupBy("digest").agg(F.sum("n_links").alias("n_links"))
    n_links = F.when(F.col("digest").isNull(), 0).otherwise(F.col("copies") - 1 + F.coalesce("n_links", F.lit(0))).alias("n_links")
    return judged.join(of_class.join(counted, "digest", "left"), "digest", "left").select(*columns, n_links)


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings: int) -> DataFrame:
    """One row of each component, all columns unchanged: that of least id (null last), then least text hash.

    Rows with an empty set are all kept, but of rows equal in id and text one stays.
    """
    joined = join_similar(docs, id_col, text_col, **settings)
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    best = joined.where("component IS NOT NULL").groupBy("component").agg(F.min(rank).alias("best")).select("best.doc_id", "best.text_hash")
    best = best.unionByName(joined.where("component IS NULL").select("doc_id", "text_hash")).distinct()
    key = ["own_null", "own_id", "own_hash"]
    own = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).isNull().alias("own_null"),
                      F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("own_id"), F.xxhash64(text_col).alias("own_hash"))
    best = best.select(F.col("doc_id").isNull().alias("own_null"), F.coalesce("doc_id", F.lit(0)).alias("own_id"), F.col("text_hash").alias("own_hash"))
    return own.join(best, key, "left_semi").dropDuplicates(key).select("row.*")
