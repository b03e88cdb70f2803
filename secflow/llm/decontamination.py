"""Benchmark decontamination over a distributed positional inverted index.

The corpus is cut into segments. A segment stores, for the words that the test items use, the sorted
positions of each word (its postings), beside the ids and lengths of its documents. A query window is
looked up from its rarest word: every posting of that word proposes a start, and the offset-adjusted
postings of the other words, rarer ones first, confirm it. With ``slop`` a word may stand that many
places off, which turns phrase matches into proximity matches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow.llm import common
from secflow.llm.hashing import ALNUM, LOWER_AZ, SpanHash, Words, hash_words

WINDOW = 10
#: Text bytes of the test items that are held in memory at once; more items go in further blocks.
BLOCK_BYTES = 8 << 20

_SEED = 31
INDEX_SCHEMA = ("doc_ids array<long>, text_hashes array<long>, n_words array<int>, terms array<long>, "
                "counts array<int>, positions binary")
FOUND_SCHEMA = "doc_id long, text_hash long, n_words long, hits array<int>, items array<string>"


@dataclass(frozen=True)
class Windows:
    """Distinct word windows of test items: terms by window and offset, lengths, and items by window."""

    terms: np.ndarray
    lengths: np.ndarray
    items: list[list[str]]

    def vocabulary(self) -> np.ndarray:
        inside = np.arange(self.terms.shape[1]) < self.lengths[:, None]
        return np.unique(self.terms[inside])


def _word_hashes(texts: list[bytes]) -> Words:
    return hash_words(texts, ALNUM, [SpanHash(_SEED)], LOWER_AZ)


def item_windows(items: list[tuple[str, str | None]], window: int = WINDOW) -> Windows:
    """Windows of ``window`` words of each item; an item of fewer words, but not none, is one window."""
    words = _word_hashes([(text or "").encode() for _, text in items])
    hashes = words.hashes[0].view(np.int64)
    owners: dict[tuple[int, ...], set[str]] = {}
    for i, (item, _) in enumerate(items):
        own = hashes[words.first[i]:words.first[i + 1]].tolist()
        for at in range(max(1, len(own) - window + 1) if own else 0):
            owners.setdefault(tuple(own[at:at + window]), set()).add(item)
    terms = np.zeros((len(owners), window), np.int64)
    for row, w in enumerate(owners):
        terms[row, :len(w)] = w
    return Windows(terms, np.array([len(w) for w in owners], np.int64), [sorted(x) for x in owners.values()])


def positional_index(docs: DataFrame, vocabulary: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per corpus segment: its documents, and the postings of the vocabulary's words, by word."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches, "text"):
            words = _word_hashes(common.utf8(part["text"]))
            hashes = words.hashes[0].view(np.int64)
            slot = np.searchsorted(vocabulary, hashes)
            at = np.flatnonzero(vocabulary[np.minimum(slot, len(vocabulary) - 1)] == hashes) if len(vocabulary) else slot[:0]
            order = np.argsort(slot[at], kind="stable")
            present, counts = np.unique(slot[at], return_counts=True)
            yield pa.RecordBatch.from_pydict({
                "doc_ids": pa.array([part["doc_id"].to_pylist()], pa.list_(pa.int64())),
                "text_hashes": pa.array([part["text_hash"].to_pylist()], pa.list_(pa.int64())),
                "n_words": pa.array([words.counts], pa.list_(pa.int32())),
                "terms": pa.array([vocabulary[present]], pa.list_(pa.int64())),
                "counts": pa.array([counts], pa.list_(pa.int32())),
                "positions": pa.array([at[order].astype(np.uint32).tobytes()], pa.binary()),
            })

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("text_hash"))
    return common.stored(rows.mapInArrow(build, INDEX_SCHEMA), "positional-index")


def term_counts(index: DataFrame) -> dict[int, int]:
    """Postings of each word over all segments; at most one entry per word of the test items."""
    pairs = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("p"))
    return {r.term: r.n for r in pairs.groupBy(F.col("p.terms").alias("term")).agg(F.sum("p.counts").alias("n")).collect()}


def _ranges(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All integers of the ranges, and the range number of each."""
    number = np.repeat(np.arange(len(counts)), counts)
    return np.arange(len(number)) - np.repeat(np.cumsum(counts) - counts, counts) + starts[number], number


def match_segment(terms: np.ndarray, counts: np.ndarray, positions: np.ndarray, first: np.ndarray, windows: Windows,
                  rarest: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, first position, last position) of every match in one segment, never across documents.

    ``rarest`` lists the offsets of each window from its rarest word on. Without ``slop`` the words follow each other.
    With it, every word lies at most ``slop`` places from its own behind some common start, whichever word is the
    rarest; a match then runs from the first to the last such occurrence. One occurrence may stand for equal words.
    """
    offsets = np.concatenate([[0], np.cumsum(counts)])
    slot = np.searchsorted(terms, windows.terms)
    slot = np.where(terms[np.minimum(slot, len(terms) - 1)] == windows.terms, slot, -1) if len(terms) else np.full(windows.terms.shape, -1)
    inside = np.arange(windows.terms.shape[1]) < windows.lengths[:, None]
    whole = np.flatnonzero(~((slot < 0) & inside).any(axis=1))
    lead = slot[whole, rarest[whole, 0]]
    place, number = _ranges(offsets[lead], offsets[lead + 1] - offsets[lead])
    window = whole[number]
    anchor = positions[place].astype(np.int64)
    keys = (np.repeat(np.arange(len(terms)), counts) << 32) | positions.astype(np.int64)
    if slop:
        return _near_matches(keys, first, slot, windows.lengths, window, anchor, rarest, slop)
    start = anchor - rarest[window, 0]
    low, high = anchor.copy(), anchor.copy()
    for r in range(1, windows.terms.shape[1]):
        more = windows.lengths[window] > r
        at = rarest[window, np.minimum(r, windows.lengths[window] - 1)]
        wanted = np.maximum(start + at, 0)
        base = slot[window, at] << 32
        found = np.searchsorted(keys, base | wanted)
        hit = keys[np.minimum(found, len(keys) - 1)] - base if len(keys) else np.zeros(len(at), np.int64)
        good = ~more | (hit == start + at)
        hit = np.where(more, hit, anchor)
        window, start, anchor = window[good], start[good], anchor[good]
        low, high = np.minimum(low, hit)[good], np.maximum(high, hit)[good]
    same = np.searchsorted(first, low, side="right") == np.searchsorted(first, high, side="right")
    return window[same], low[same], high[same]


def _near_matches(keys: np.ndarray, first: np.ndarray, slot: np.ndarray, lengths: np.ndarray, window: np.ndarray, anchor: np.ndarray,
                  rarest: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matches with moved words: starts around each occurrence of the rarest word, kept while every word is near its place."""
    document = np.searchsorted(first, anchor, side="right") - 1
    starts = (anchor - rarest[window, 0])[:, None] + np.arange(-slop, slop + 1)
    tried = np.stack([np.repeat(window, 2 * slop + 1), np.repeat(document, 2 * slop + 1), starts.ravel()], 1)
    window, document, start = (np.unique(tried, axis=0) if len(tried) else tried).T
    low, high = np.full(len(start), np.iinfo(np.int64).max), np.full(len(start), -1)
    for r in range(slot.shape[1]):
        more = lengths[window] > r
        at = rarest[window, np.minimum(r, lengths[window] - 1)]
        base = slot[window, at] << 32
        left = np.searchsorted(keys, base | np.maximum(start + at - slop, first[document]))
        right = np.searchsorted(keys, base | np.maximum(np.minimum(start + at + slop, first[document + 1] - 1), 0), side="right")
        good = right > left
        low = np.where(more & good, np.minimum(low, keys[np.minimum(left, len(keys) - 1)] - base), low)
        high = np.where(more & good, np.maximum(high, keys[np.maximum(right - 1, 0)] - base), high)
        good |= ~more
        window, document, start, low, high = window[good], document[good], start[good], low[good], high[good]
    return window, low, high


def _search(index: DataFrame, windows: Windows, slop: int) -> DataFrame:
    counts = term_counts(index)
    rarity = np.vectorize(lambda t: counts.get(t, 0), otypes=[np.int64])(windows.terms) if windows.items else np.zeros(windows.terms.shape, np.int64)
    rarity[np.arange(windows.terms.shape[1]) >= windows.lengths[:, None]] = np.iinfo(np.int64).max
    rarest = np.argsort(rarity, axis=1, kind="stable")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment in (batch.slice(i, 1) for batch in batches for i in range(batch.num_rows)):
            n_words = segment["n_words"].flatten().to_numpy()
            first = np.concatenate([[0], np.cumsum(n_words)])
            positions = np.frombuffer(segment["positions"][0].as_py(), np.uint32)
            window, low, high = match_segment(segment["terms"].flatten().to_numpy(), segment["counts"].flatten().to_numpy(),
                                              positions, first, windows, rarest, slop)
            owner = np.searchsorted(first, low, side="right") - 1
            hits: list[set[int]] = [set() for _ in n_words]
            items: list[set[str]] = [set() for _ in n_words]
            for w, d, a, b in zip(window.tolist(), owner.tolist(), low.tolist(), high.tolist()):
                hits[d].update(range(a - int(first[d]), b + 1 - int(first[d])))
                items[d].update(windows.items[w])
            yield pa.RecordBatch.from_pydict({
                "doc_id": segment["doc_ids"].flatten(), "text_hash": segment["text_hashes"].flatten(),
                "n_words": pa.array(n_words, pa.int64()),
                "hits": pa.array([sorted(x) for x in hits], pa.list_(pa.int32())),
                "items": pa.array([sorted(x) for x in items], pa.list_(pa.string())),
            })

    return index.mapInArrow(search, FOUND_SCHEMA)


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, slop: int = 0,
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Which words of which documents lie in test-item windows, and in whose.

    Returns one row per input document: ``doc_id``, ``text_hash`` (xxhash64), ``n_words``, ``hits`` (word numbers from 0, sorted)
    and ``items`` (item ids as strings, sorted). Words are runs of ASCII letters and digits and of
    anything outside ASCII, A-Z lower-cased. Null and empty texts have no words and no hits; items
    without words have no window. Null item ids are left out; repeated items count once. Null
    document ids stay null, repeated rows give repeated equal rows, other columns are ignored whatever
    their names, and empty tables on either side give no hits.

    With ``slop`` a window also matches where each of its words lies at most that many places from its own behind
    some start, inside one document; all words from the first to the last such occurrence are hit.

    Items are held in memory in blocks of about ``block_bytes`` of text, the index of a block is built
    for its words only, and results of several blocks are merged by document.
    """
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text")).where("item IS NOT NULL")
    blocks = common.chunk_count(common.text_bytes(items, "text"), block_bytes)
    items = items.withColumn("block", common.chunk_of(blocks, "item", "text"))
    found = []
    for block in range(blocks):
        windows = item_windows([(r.item, r.text) for r in items.where(F.col("block") == block).collect()], window)
        found.append(_search(positional_index(docs, windows.vocabulary(), id_col, text_col), windows, slop))
    if blocks == 1:
        return found[0]
    rows = found[0]
    for other in found[1:]:
        rows = rows.unionByName(other)
    merged = rows.groupBy("doc_id", "text_hash").agg(
        F.first("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        (F.count("*") / blocks).cast("int").alias("times"))
    return merged.withColumn("nth", F.explode(F.sequence(F.lit(1), "times"))).select("doc_id", "text_hash", "n_words", "hits", "items")
