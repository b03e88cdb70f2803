"""Importance resampling towards a target: word n-grams of both sides in hashed buckets, then a weighted draw.

A batch of texts is joined by separator sentinels and cut into words by one regular expression. The sentinels'
places are the document offsets; n-grams whose ends lie in different documents are masked out before they are
counted. An n-gram's checksum is put together from those of its words.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow.llm import common

BUCKETS, LONGEST = 10_000, 3
PERCENT, LEAST_WORDS, SEED = 5, 20, 42

_SENTINEL = b"\0"
_TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+|\0")
_WORDS_KEPT, _LENGTHS_KEPT = 200_000, 1024


def _crc_columns() -> np.ndarray:
    """What one zero byte makes of each bit of a checksum."""
    c = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> np.uint32(1)) ^ np.uint32(0xEDB88320), c >> np.uint32(1))
    return c


def _lookup(columns: np.ndarray) -> np.ndarray:
    """The 4 x 256 table of a linear map given by its 32 columns."""
    out = np.zeros((4, 256), np.uint32)
    for k in range(4):
        for j in range(8):
            out[k, 1 << j:2 << j] = out[k, :1 << j] ^ columns[8 * k + j]
    return out


def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """Tables (4, 256), or one for each value (n, 4, 256) given as (all tables, numbers)."""
    out = np.zeros_like(crc)
    for k in range(4):
        out ^= tables[k][(crc >> np.uint32(8 * k)) & np.uint32(255)]
    return out


class Shifts:
    """Tables that move a checksum past a number of bytes."""

    def __init__(self) -> None:
        self.powers = [_crc_columns()]  # columns for 1, 2, 4, ... bytes
        self.known: dict[int, np.ndarray] = {}

    def table(self, size: int) -> np.ndarray:
        if size not in self.known:
            columns, k, left = np.uint32(1) << np.arange(32, dtype=np.uint32), 0, size
            while left:
                if len(self.powers) <= k:
                    self.powers.append(_apply(_lookup(self.powers[-1]), self.powers[-1]))
                if left & 1:
                    columns = _apply(_lookup(self.powers[k]), columns)
                left, k = left >> 1, k + 1
            if len(self.known) >= _LENGTHS_KEPT:
                self.known.clear()
            self.known[size] = _lookup(columns)
        return self.known[size]

    def joined(self, first: np.ndarray, second: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Checksums of two strings put together, from their own and the second one's bytes."""
        lengths, which = np.unique(sizes, return_inverse=True)
        tables = np.stack([self.table(int(n)) for n in lengths]) if len(lengths) else np.zeros((1, 4, 256), np.uint32)
        out = second.copy()
        for k in range(4):
            out ^= tables[which, k, (first >> np.uint32(8 * k)) & np.uint32(255)]
        return out


class Grams:
    """Buckets of the word n-grams of many texts; what is known of a word is kept between batches."""

    def __init__(self, buckets: int = BUCKETS, longest: int = LONGEST):
        self.buckets, self.longest, self.shifts = buckets, longest, Shifts()
        self._forget()

    def _forget(self) -> None:
        self.index = {_SENTINEL: 0}
        self.crc, self.spaced, self.sizes = array("I", [0]), array("I", [0]), array("q", [0])

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(words of each text, text of each n-gram, bucket of each n-gram)."""
        # A text's own sentinels become blanks; both part words.
        tokens = _TOKEN.findall(_SENTINEL.join([t.replace(_SENTINEL, b" ").lower() for t in texts]))
        new = [w for w in set(tokens) if w not in self.index]
        if len(self.index) + len(new) > _WORDS_KEPT:
            self._forget()
            new = [w for w in set(tokens) if w not in self.index]
        for w in new:
            self.index[w] = len(self.crc)
            self.crc.append(zlib.crc32(w))
            self.spaced.append(zlib.crc32(b" " + w))
            self.sizes.append(len(w) + 1)
        ids = np.fromiter(map(self.index.__getitem__, tokens), np.int64, len(tokens))
        at = np.flatnonzero(ids)
        text_of = np.searchsorted(np.flatnonzero(ids == 0), at)
        ids = ids[at]
        crc, spaced, sizes = (np.array(x, t) for x, t in ((self.crc, np.uint32), (self.spaced, np.uint32), (self.sizes, np.int64)))
        gram, first = crc[ids], np.arange(len(ids))
        owners, buckets = [text_of], [gram % np.uint32(self.buckets)]
        for n in range(1, self.longest):
            whole = first + n < len(ids)
            gram, first = gram[whole], first[whole]
            whole = text_of[first] == text_of[first + n]
            gram, first = gram[whole], first[whole]
            last = ids[first + n]
            gram = self.shifts.joined(gram, spaced[last], sizes[last])
            owners.append(text_of[first])
            buckets.append(gram % np.uint32(self.buckets))
        return np.bincount(text_of, minlength=len(texts)), np.concatenate(owners), np.concatenate(buckets)


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """N-grams per bucket over a whole table; one row of ``buckets`` sums leaves each task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, total = Grams(buckets, longest), np.zeros(buckets, np.int64)
        for part in common.slices(batches, "text"):
            total += np.bincount(grams.of(common.utf8(part["text"]))[2], minlength=buckets)
        yield pa.RecordBatch.from_pydict({"counts": pa.array([total], pa.list_(pa.int64()))})

    found = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "counts array<long>")
    rows = found.select(F.posexplode("counts").alias("bucket", "n")).groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r.bucket] = r.n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's share in the target over that in the source, one added to every count."""
    s, t, n = source.astype(np.float64), target.astype(np.float64), len(source)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def importance_weights(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
                       buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row of ``docs``; the weight sums its n-grams' gains."""
    gains = bucket_gains(bucket_counts(docs, text_col, buckets, longest), bucket_counts(target, target_col, buckets, longest))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(buckets, longest)
        for part in common.slices(batches, "text"):
            words, owner, bucket = grams.of(common.utf8(part["text"]))
            weight = np.bincount(owner, gains[bucket], minlength=part.num_rows)
            yield pa.RecordBatch.from_pydict({"doc_id": part["doc_id"], "n_words": words, "n_features": np.bincount(owner, minlength=part.num_rows),
                                              "weight": weight.astype(np.int64)})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", percent: int = PERCENT,
             least_words: int = LEAST_WORDS, seed: int = SEED, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """Every row's ``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``; drawn rows have a rank.

    Of the N rows with at least ``least_words`` words the floor(percent * N / 100) of highest score are drawn, ties to
    the smaller id (null first). The score adds Gumbel noise from a hash of the seed and the id to the weight, so it is a draw
    without replacement in proportion to the exponential of the weight, and comes out the same in every run.

    Null and empty texts have no features and weight 0. A null id is hashed as an empty one. Repeated rows are weighed
    and drawn each for itself. Other columns are ignored whatever their names; an empty table gives an empty result,
    and with an empty target every bucket counts as seen alike often. Texts are read whole, a few megabytes or one
    longer text at a time.
    """
    weighed = importance_weights(docs, target, id_col, text_col, target_col, buckets, longest)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    scored = weighed.withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log(share))))
    scored = common.stored(scored, "importance-weights")
    long_enough = scored.where(F.col("n_words") >= least_words).withColumn("less", -F.col("score"))
    drawn = long_enough.count() * percent // 100
    placed = common.ranked(long_enough, ["less", "doc_id"], "importance-order")
    rank = F.when(F.col("place") < drawn, F.col("place") + 1).alias("rank")
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    return placed.select(*columns, rank).unionByName(
        scored.where(F.col("n_words") < least_words).select(*columns, F.lit(None).cast("long").alias("rank")))
