"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A three-letter window binds its letters: each vector is
rotated by the letter's place, and the three are multiplied. A text bundles (adds) the vectors of its
windows, a language bundles its documents, and a text gets the language of greatest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from secflow.llm import common
from secflow.llm.letters import letter_codes

DIMENSIONS = 512
#: Window vectors that a task keeps; beyond that it forgets them and builds those it needs anew.
MOST_KEPT = 60_000
UNKNOWN = "und"


class Profiles:
    """Bundled window vectors of texts; vectors of windows are kept between calls."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.table = np.zeros((0, dimensions), np.int8)

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            self.letters[code] = np.random.default_rng((7, code)).integers(0, 2, self.dimensions, dtype=np.int8) * np.int8(2) - np.int8(1)
        return self.letters[code]

    def window(self, key: int) -> np.ndarray:
        a, b, c = key >> 42, (key >> 21) & 0x1FFFFF, key & 0x1FFFFF
        return np.roll(self.letter(a), 2) * np.roll(self.letter(b), 1) * self.letter(c)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Table rows of window keys."""
        keys = keys.tolist()
        new = [k for k in keys if k not in self.rows]
        if len(self.rows) + len(new) > MOST_KEPT:
            self.rows, new = {}, keys
            self.table = np.zeros((0, self.dimensions), np.int8)
        if new:
            at = len(self.rows)
            self.rows.update((k, at + i) for i, k in enumerate(new))
            self.table = np.concatenate([self.table[:at], np.stack([self.window(k) for k in new])])
        return np.fromiter((self.rows[k] for k in keys), np.int64, len(keys))

    def bundle(self, texts: list[str | None]) -> np.ndarray:
        """One bundled vector per text; a text without letters gets the zero vector."""
        codes, owner = letter_codes(texts)
        codes = codes.astype(np.int64)
        inside = (codes[1:-1] != 0) & (owner[:-2] == owner[2:]) if len(codes) > 2 else np.zeros(0, bool)
        at = np.flatnonzero(inside)
        keys, number = np.unique((codes[at] << 42) | (codes[at + 1] << 21) | codes[at + 2], return_inverse=True)
        pair, times = np.unique(owner[at + 1].astype(np.int64) * max(1, len(keys)) + number, return_counts=True)
        doc = pair // max(1, len(keys))
        place = self.places(keys)[pair % max(1, len(keys))] if len(keys) else pair
        out = np.zeros((len(texts), self.dimensions), np.float32)
        cuts = np.searchsorted(doc, np.arange(len(texts) + 1))
        for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            if b > a:
                out[i] = times[a:b].astype(np.float32) @ self.table[place[a:b]].astype(np.float32)
        return out


def fit_languages(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """The profile of each language: the sum of the bundles of all its documents.

    Every row with a language counts, so nothing is sampled; each task adds up its own rows first, and
    one vector per task and language is shuffled. Null languages and null texts add nothing. No row
    with a language gives no profile.
    """

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles, sums = Profiles(dimensions), {}
        for part in common.slices(batches, "text", 1 << 20):
            langs = part["lang"].to_pylist()
            bundles = profiles.bundle(part["text"].to_pylist())
            for lang in set(langs):
                mine = bundles[[x == lang for x in langs]].sum(0, dtype=np.float64)
                sums[lang] = sums.get(lang, 0) + mine
        if sums:
            n = len(sums)
            yield pa.RecordBatch.from_pydict({"lang": np.repeat(np.array(list(sums), object), dimensions),
                                              "d": np.tile(np.arange(dimensions, dtype=np.int32), n), "v": np.concatenate(list(sums.values()))})

    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    sums = rows.mapInArrow(add_up, "lang string, d int, v double").groupBy("lang", "d").agg(F.sum("v").alias("v"))
    found: dict[str, np.ndarray] = {}
    for r in sums.collect():
        found.setdefault(r.lang, np.zeros(dimensions))[r.d] = r.v
    return dict(sorted(found.items()))


def identify(docs: DataFrame, languages: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``lang_pred`` and ``score`` (its cosine, 0 at least) of every row, from the text alone.

    Null texts, texts without a letter, and all texts when no language is known, get ``und`` and score
    0. Of languages with equal cosines the first by name wins. Null ids stay null, repeated rows give
    repeated equal rows, other columns are ignored whatever their names, and an empty table gives an
    empty result. Texts are read whole.
    """
    names = list(languages)
    dimensions = len(next(iter(languages.values()), np.zeros(DIMENSIONS)))
    targets = np.stack([v / max(np.linalg.norm(v), 1e-12) for v in languages.values()], 1) if names else np.zeros((dimensions, 0))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = Profiles(dimensions)
        for part in common.slices(batches, "text", 1 << 20):
            texts = part["text"].to_pylist()
            bundles = profiles.bundle(texts)
            size = np.linalg.norm(bundles, axis=1)
            cosine = bundles @ targets / np.maximum(size, 1e-12)[:, None]
            lettered = np.array([any(c.isalpha() for c in t or "") for t in texts], bool) & bool(names)
            best = cosine.argmax(1) if names else np.zeros(len(texts), np.int64)
            score = np.where(lettered, np.clip(cosine.max(1, initial=0), 0, 1), 0)
            yield pa.RecordBatch.from_pydict({
                "doc_id": part["doc_id"],
                "lang_pred": pa.array([names[b] if ok else UNKNOWN for b, ok in zip(best, lettered)], pa.string()),
                "score": pa.array(score.astype(np.float64)),
            })

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(predict, "doc_id long, lang_pred string, score double")


def id_remainder(column: str, of: int) -> Column:
    """crc32 of an id as text, modulo ``of``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % of
