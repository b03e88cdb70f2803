"""Removal of word passages that start in an earlier document: difference-cover anchors.

A passage of ``window`` words is judged only where a shorter anchor at a cover position repeats:
positions are taken modulo ``period``, and the cover holds two residues for every difference. So
any two places of an equal passage have a common offset below ``period`` at which both are cover
positions, and the anchor of ``window - period + 1`` words there lies inside the passage. Anchors
that occur in one document only are dropped; the others are extended to all windows around them,
and those windows are compared whole.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow.llm import common
from secflow.llm.hashing import BLANK_SPLIT, U64, SpanHash, Words, bucket_runs, bucketed, hash_words

WINDOW = 13
PERIOD = 7
#: Differences of these residues give every residue modulo 7.
COVER = (0, 1, 3)

_NULL_ID = np.iinfo(np.int64).min


def is_cover(cover: tuple[int, ...], period: int) -> bool:
    return {(a - b) % period for a in cover for b in cover} == set(range(period))


def _hashers() -> list[SpanHash]:
    return [SpanHash(11), SpanHash(12)]


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    return column.fill_null(int(_NULL_ID)).to_numpy().astype(np.int64)


class _Passages:
    """Anchors and windows of one chunk of documents."""

    def __init__(self, table: pa.Table, window: int, period: int, cover: tuple[int, ...], bits: int):
        self.window, self.period, self.width, self.bits = window, period, window - period + 1, bits
        self.hashers = _hashers()
        self.texts = common.utf8(table["text"])
        self.ids = _ids(table["doc_id"])
        self.words: Words = hash_words(self.texts, BLANK_SPLIT, self.hashers)
        counts, first = self.words.counts, self.words.first[:-1]
        self.owner = self.words.text_of()
        place = np.arange(len(self.owner)) - first[self.owner]
        left = counts[self.owner] - place
        at_cover = np.isin(np.arange(period), cover)[place % period]
        self.anchors = np.flatnonzero(at_cover & (left >= self.width) & (counts[self.owner] >= window))
        self.fits = left >= window

    def anchor_keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct anchor keys of the chunk, and the key number of each anchor."""
        hashes = self.words.windows(self.anchors, self.width, self.hashers[:1])[0]
        return np.unique(bucketed(hashes, self.bits), return_inverse=True)

    def candidates(self, elsewhere: dict[int, bytes]) -> np.ndarray:
        """Starts of windows that hold an anchor which another document has too."""
        keys, number = self.anchor_keys()
        shared = np.zeros(len(keys), bool)
        for bucket, a, b in bucket_runs(keys):
            shared[a:b] = np.unpackbits(np.frombuffer(elsewhere[bucket], np.uint8), count=b - a)
        ids = self.ids[self.owner[self.anchors]]
        low, high = np.full(len(keys), np.iinfo(np.int64).max), np.full(len(keys), _NULL_ID)
        np.minimum.at(low, number, ids)
        np.maximum.at(high, number, ids)
        shared |= low < high
        hit = self.anchors[shared[number]]
        marks = np.zeros(len(self.owner) + 1, np.int32)
        from_ = np.maximum(hit - (self.period - 1), self.words.first[self.owner[hit]])
        np.add.at(marks, from_, 1)
        np.add.at(marks, hit + 1, -1)
        return np.flatnonzero((np.cumsum(marks[:-1]) > 0) & self.fits)

    def window_keys(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct windows at ``at``: bucket order, two hashes, least id; and the number of each window."""
        one, two = self.words.windows(at, self.window, self.hashers)
        two = (two & U64(0xFFFFFFFF)).astype(np.uint32)
        order = np.lexsort((two, one))
        one, two = one[order], two[order]
        new = np.ones(len(one), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        number = np.empty(len(one), np.int64)
        number[order] = np.cumsum(new) - 1
        least = np.full(int(new.sum()), np.iinfo(np.int64).max)
        np.minimum.at(least, number, self.ids[self.owner[at]])
        return one[new], two[new], least, number, (one[new] >> U64(64 - self.bits)).astype(np.int64)


def _runs(buckets: np.ndarray) -> list[tuple[int, int, int]]:
    if not len(buckets):
        return []
    cuts = np.flatnonzero(np.diff(buckets)) + 1
    return [(int(buckets[a]), int(a), int(b)) for a, b in zip([0, *cuts], [*cuts, len(buckets)])]


def _flags(table: pa.Table) -> dict[int, bytes]:
    return dict(zip(table["bucket"].to_pylist(), table["flags"].to_pylist()))


def _packed(chunks: list[int], bucket: int, flags: np.ndarray, sizes: list[int]) -> pa.Table:
    parts = np.split(flags, np.cumsum(sizes)[:-1])
    return pa.table({
        "chunk": pa.array(chunks, pa.int32()),
        "bucket": pa.array([bucket] * len(chunks), pa.int32()),
        "flags": pa.array([np.packbits(p).tobytes() for p in parts], pa.binary()),
    })


def _anchors_elsewhere(table: pa.Table) -> pa.Table:
    """For each chunk's sorted anchors of a bucket: does another chunk have it as well?"""
    parts = [np.frombuffer(k, np.uint32) for k in table["keys"].to_pylist()]
    keys = np.concatenate(parts)
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    flags = np.zeros(len(keys), bool)
    flags[order[1:]] |= same
    flags[order[:-1]] |= same
    return _packed(table["chunk"].to_pylist(), table["bucket"][0].as_py(), flags, [len(p) for p in parts])


def _windows_earlier(table: pa.Table) -> pa.Table:
    """For each chunk's windows of a bucket: does a document of another chunk have it under a smaller id?"""
    ones = [np.frombuffer(k, U64) for k in table["one"].to_pylist()]
    one = np.concatenate(ones)
    two = np.concatenate([np.frombuffer(k, np.uint32) for k in table["two"].to_pylist()])
    least = np.concatenate([np.frombuffer(k, np.int64) for k in table["least"].to_pylist()])
    order = np.lexsort((least, two, one))
    a, b = one[order], two[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    head = least[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    flags = np.zeros(len(one), bool)
    flags[order] = head < least[order]
    return _packed(table["chunk"].to_pylist(), table["bucket"][0].as_py(), flags, [len(p) for p in ones])


def remove_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                             period: int = PERIOD, cover: tuple[int, ...] = COVER,
                             chunk_bytes: int = common.CHUNK_BYTES) -> DataFrame:
    """Drop every word that lies in a window also starting in a document with a smaller id.

    Returns one row per input row: ``doc_id``, ``text`` (kept words joined by one space), ``n_words``
    and ``n_removed``. Other input columns are ignored, whatever their names. Words are runs of
    anything but space, tab, line feed, vertical tab, form feed and carriage return. Windows are
    judged on the input, never on what is left.

    Null and blank texts have no words and give an empty text. A null id sorts before all others.
    Rows with equal ids never remove each other's words; a repeated row gets its own equal row. Very
    long texts are cut between words while hashing, so memory follows the chunk or the longest text.
    An empty table gives an empty result. Anchors are sent to their buckets as 32 bits beside the
    bucket number, once per chunk; a collision only adds windows to compare. Windows are compared by
    96 hash bits. A passage of very many documents is one entry per chunk.
    """
    if not is_cover(cover, period) or not 0 < period <= window:
        raise ValueError("the cover must give every difference modulo the period, and the period fit the window")
    total = common.text_bytes(docs, text_col)
    bits = common.bucket_bits(total, chunk_bytes)
    chunks = common.chunk_count(total, chunk_bytes)
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("chunk", common.chunk_of(chunks, "doc_id", "text")).repartition(spread, "chunk")

    def passages(table: pa.Table) -> _Passages:
        return _Passages(table, window, period, cover, bits)

    def send_anchors(table: pa.Table) -> pa.Table:
        keys, _ = passages(table).anchor_keys()
        low = (keys & U64(0xFFFFFFFF)).astype(np.uint32)
        runs = bucket_runs(keys)
        return pa.table({
            "bucket": pa.array([r[0] for r in runs], pa.int32()),
            "chunk": pa.array([table["chunk"][0].as_py()] * len(runs), pa.int32()),
            "keys": pa.array([low[a:b].tobytes() for _, a, b in runs], pa.binary()),
        })

    def send_windows(table: pa.Table, replies: pa.Table) -> pa.Table:
        p = passages(table)
        one, two, least, _, buckets = p.window_keys(p.candidates(_flags(replies)))
        runs = _runs(buckets)
        return pa.table({
            "bucket": pa.array([r[0] for r in runs], pa.int32()),
            "chunk": pa.array([table["chunk"][0].as_py()] * len(runs), pa.int32()),
            **{name: pa.array([x[a:b].tobytes() for _, a, b in runs], pa.binary())
               for name, x in (("one", one), ("two", two), ("least", least))},
        })

    def cut(table: pa.Table, replies: pa.Table) -> pa.Table:
        p = passages(table)
        kinds = replies["kind"].to_numpy()
        at = p.candidates(_flags(replies.filter(pa.array(kinds == 0))))
        _, _, least, number, buckets = p.window_keys(at)
        earlier = _flags(replies.filter(pa.array(kinds == 1)))
        flags = np.zeros(len(least), bool)
        for bucket, a, b in _runs(buckets):
            flags[a:b] = np.unpackbits(np.frombuffer(earlier[bucket], np.uint8), count=b - a)
        hit = at[flags[number] | (p.ids[p.owner[at]] > least[number])]
        marks = np.zeros(len(p.owner) + 1, np.int32)
        np.add.at(marks, hit, 1)
        np.add.at(marks, hit + window, -1)
        kept = np.cumsum(marks[:-1]) <= 0
        first = p.words.first
        gone = p.words.counts - np.add.reduceat(np.append(kept, False).astype(np.int64), first[:-1]) * (p.words.counts > 0)
        texts = [b" ".join(compress(t.split(), kept[first[i]:first[i + 1]].tolist()) if gone[i] else t.split())
                 for i, t in enumerate(p.texts)]
        return pa.table({"doc_id": table["doc_id"], "text": pa.array(texts, pa.binary()).cast(pa.string()),
                         "n_words": p.words.counts, "n_removed": gone})

    flags = "chunk int, bucket int, flags binary"
    by_chunk = rows.groupBy("chunk")
    anchors = (by_chunk.applyInArrow(send_anchors, "bucket int, chunk int, keys binary")
               .groupBy("bucket").applyInArrow(_anchors_elsewhere, flags))
    windows = (by_chunk.cogroup(anchors.groupBy("chunk"))
               .applyInArrow(send_windows, "bucket int, chunk int, one binary, two binary, least binary")
               .groupBy("bucket").applyInArrow(_windows_earlier, flags))
    replies = anchors.withColumn("kind", F.lit(0)).unionByName(windows.withColumn("kind", F.lit(1)))
    return by_chunk.cogroup(replies.groupBy("chunk")).applyInArrow(
        cut, "doc_id long, text string, n_words long, n_removed long")
