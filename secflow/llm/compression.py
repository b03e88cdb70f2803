"""Quality rule by compression: zstandard ratios of whole documents and of fixed chunks.

Ordinary prose of one length compresses to a narrow band of ratios. Text below its band repeats
itself, text above it carries next to no structure. Short texts compress worse, so every band has
its own limits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow.llm import common
from secflow.llm.hashing import BLANK_SPLIT, U64, SpanHash, hash_words, mix

#: (bytes from, lowest ratio, highest ratio): fixed values. The highest lie about 0.03 above the most that texts and pieces of
#: the sample tables reach that pass the base rules (0.756 from 256 bytes on, 0.603 from 1024, 0.513 from 4096, 0.44 from 16384).
#: Base64 in the shortest words reaches more in every band (0.818, 0.698, 0.673), hexadecimal words from 4096 bytes on (0.531).
#: Long texts have a wider whole limit, as their pieces of 4096 bytes are judged too. Below 256 bytes prose and noise meet, so
#: there is no limit.
BANDS = ((0, 0.00, 9.00), (256, 0.22, 0.80), (320, 0.22, 0.785), (384, 0.22, 0.755), (448, 0.22, 0.75), (512, 0.22, 0.725),
         (640, 0.22, 0.705), (768, 0.22, 0.67), (896, 0.22, 0.655), (1024, 0.15, 0.635), (1536, 0.15, 0.59), (2048, 0.15, 0.58),
         (4096, 0.12, 0.525), (16384, 0.08, 0.60), (65536, 0.05, 0.60))
CHUNK = 4096
#: A document fails when more than this share of its chunks leaves the band.
MOST_BAD_CHUNKS = 0.5
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

_SYMBOLS = b"#*$%&|<>"
_NOT_WORD_STARTS = bytes(range(0x80, 0xC0)) + b" \t\n\x0b\x0c\r"

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, ratio double, n_chunks long, n_bad_chunks long")


def in_band(size: int, ratio: float, bands: tuple[tuple[int, float, float], ...]) -> bool:
    _, low, high = [b for b in bands if size >= b[0]][-1]
    return low <= ratio <= high


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    seen: set[bytes] = set()
    lines = [x for x in text.split(b"\n") if x.strip()]
    seen.update(lines)
    return len(lines) - len(seen)


def repeated_words(texts: list[bytes], hashers: list[SpanHash]) -> tuple[np.ndarray, np.ndarray]:
    """Words per text, and words inside three-word windows that occur twice or more in the text."""
    words = hash_words(texts, BLANK_SPLIT, hashers)
    owner = words.text_of()
    at = np.flatnonzero(np.arange(len(owner)) + 3 <= words.first[1:][owner])
    keys = mix(words.windows(at, 3, hashers)[0] + owner[at].astype(U64) * U64(0xD6E8FEB86659FD93))
    _, number, times = np.unique(keys, return_inverse=True, return_counts=True)
    hit = at[times[number] > 1]
    covered = np.zeros(len(owner), bool)
    for k in range(3):
        covered[hit + k] = True
    return words.counts, np.bincount(owner[covered], minlength=len(texts))


def compression_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        bands: tuple[tuple[int, float, float], ...] = BANDS, chunk: int = CHUNK,
                        most_bad_chunks: float = MOST_BAD_CHUNKS, level: int = 3) -> DataFrame:
    """Word and repetition counts, compression ratios and the verdict ``kept`` for every row.

    A row fails the base rules with fewer than 50 words or with over half of its words in repeated
    three-word windows. Of the rest it is kept when its whole ratio lies in the band of its length
    and at most ``most_bad_chunks`` of its ``chunk``-byte pieces leave the band of theirs.

    Null and empty texts have no words and ratio 0, so they fail the base rules. Null ids stay null,
    repeated rows give repeated equal rows, other columns are ignored whatever their names, and an
    empty table gives an empty result. Texts are read whole; a row needs its own text in memory.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashers = [SpanHash(1)]
        zstd = zstandard.ZstdCompressor(level=level)
        for part in common.slices(batches, "text"):
            texts = common.utf8(part["text"])
            n_words, n_repeat = repeated_words(texts, hashers)
            failed = (n_words < LEAST_WORDS) | (100 * n_repeat > MOST_REPEATED_PERCENT * n_words)
            ratios, pieces, bad = [], [], []
            for t in texts:
                ratios.append(len(zstd.compress(t)) / len(t) if t else 0.0)
                cuts = [t[i:i + chunk] for i in range(0, len(t), chunk)]
                pieces.append(len(cuts))
                bad.append(sum(not in_band(len(c), len(zstd.compress(c)) / len(c), bands) for c in cuts))
            kept = [not f and in_band(len(t), r, bands) and b <= most_bad_chunks * n
                    for f, t, r, b, n in zip(failed, texts, ratios, bad, pieces)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": part["doc_id"], "n_words": n_words,
                "word_chars": pa.array([len(t.translate(None, _NOT_WORD_STARTS)) for t in texts], pa.int64()),
                "n_symbols": pa.array([len(t) - len(t.translate(None, _SYMBOLS)) for t in texts], pa.int64()),
                "n_dup_lines": pa.array([duplicate_lines(t) for t in texts], pa.int64()),
                "n_repeat_words": n_repeat.astype(np.int64), "base_failed": failed, "kept": pa.array(kept, pa.bool_()),
                "ratio": pa.array(ratios, pa.float64()), "n_chunks": pa.array(pieces, pa.int64()),
                "n_bad_chunks": pa.array(bad, pa.int64()),
            })

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(judge, SCHEMA)
