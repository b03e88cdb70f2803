"""Spelling variants: words one edit apart, found through a reduced alphabet.

Letters are hashed to a few symbols. Two words that differ by one inserted, deleted or replaced letter have
reduced words that are equal or differ by one such edit, so the full one-edit neighbourhood of every reduced
word, looked up among the reduced words of the vocabulary, holds all its partners. The original strings decide.
With few symbols the neighbourhood stays small whatever the alphabet.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow.llm import common
from secflow.llm.hashing import U64, mix

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: One run of so many loses a letter; least code points and occurrences of a word.
TYPO_EVERY, LEAST_LENGTH, LEAST_TIMES = 97, 5, 3
#: Symbols of the reduced alphabet.
SYMBOLS = 8
#: Words that a task counts before it passes them on, and neighbours that it makes at a time.
_COUNTED, _MADE = 200_000, 1 << 20


def typed_runs(doc_id: int | None, text: bytes) -> Counter[str]:
    """Lower-cased runs of a text with their times, some of them with a letter deleted by the fixed rule."""
    out: Counter[str] = Counter()
    start = None if doc_id is None else zlib.crc32(f"{doc_id}:".encode())
    for run, times in Counter(RUN.findall(text.lower().decode())).items():
        if start is not None:
            h = zlib.crc32(run.encode(), start)
            if h % TYPO_EVERY == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1:]
        out[run] += times
    return out


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
               least_times: int = LEAST_TIMES) -> DataFrame:
    """(word, n, word_id) of all words of enough code points and occurrences; each task counts before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def passed() -> pa.RecordBatch:
            kept = {w: n for w, n in total.items() if len(w) >= least_length}
            return pa.RecordBatch.from_pydict({"word": pa.array(list(kept), pa.string()), "n": pa.array(list(kept.values()), pa.int64())})

        for part in common.slices(batches, "text"):
            for doc, text in zip(part["doc_id"].to_pylist(), common.utf8(part["text"])):
                for word, times in typed_runs(doc, text).items():
                    total[word] += times
                if len(total) > _COUNTED:
                    yield passed()
                    total.clear()
        yield passed()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    counted = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return common.stored(counted.where(F.col("n") >= least_times).withColumn("word_id", F.monotonically_increasing_id()), "vocabulary")


def _codes(place: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """A random number for a symbol at a place; a reduced word is the exclusive or of its own."""
    return mix(place.astype(U64) * U64(0x9E3779B97F4A7C15) + symbol.astype(U64) * U64(0xC2B2AE3D27D4EB4F) + U64(77))


def _short(keys: np.ndarray) -> np.ndarray:
    """32 bits of each key: words that share them by chance cost a comparison, no more."""
    return (keys >> U64(32)).astype(np.uint32).view(np.int32)


def reduced(words: list[str], symbols: int) -> np.ndarray:
    """Symbols of equally long words, one row each."""
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), -1)
    return (mix(points.astype(U64) + U64(1)) % U64(symbols)).astype(np.int64)


def own_keys(word: np.ndarray) -> np.ndarray:
    n, length = word.shape
    return np.bitwise_xor.reduce(_codes(np.arange(length)[None, :], word), axis=1) ^ mix(U64(length) + np.zeros(n, U64))


def neighbour_keys(word: np.ndarray, symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, key) of every reduced word at most one edit away, in pieces; within a row a key may come again."""
    n, length = word.shape
    at = np.arange(length)[None, :]

    def after(shift: int) -> np.ndarray:
        """What the symbols from each place on give when they are moved by ``shift`` places."""
        codes = np.zeros((n, length + 1), U64)
        codes[:, :length] = np.bitwise_xor.accumulate(_codes(at + shift, word)[:, ::-1], axis=1)[:, ::-1]
        return codes

    before = np.zeros((n, length + 1), U64)
    before[:, 1:] = np.bitwise_xor.accumulate(_codes(at, word), axis=1)
    same, closer, wider = after(0), after(-1), after(1)
    size = [mix(U64(k) + np.zeros(1, U64)) for k in (length - 1, length, length + 1)]
    rows = np.arange(n)
    yield rows, before[:, length] ^ size[1]
    yield np.repeat(rows, length), (before[:, :-1] ^ closer[:, 1:] ^ size[0]).ravel()
    step = max(1, _MADE // (n * symbols))
    for start in range(0, length + 1, step):
        places = np.arange(start, min(length + 1, start + step))
        new = _codes(places[:, None], np.arange(symbols)[None, :])
        added = before[:, places, None] ^ new[None] ^ wider[:, places, None] ^ size[2]
        yield np.repeat(rows, len(places) * symbols), added.ravel()
        places = places[places < length]
        changed = before[:, places, None] ^ new[None, :len(places)] ^ same[:, places + 1, None] ^ size[1]
        yield np.repeat(rows, len(places) * symbols), changed.ravel()


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(word, n, other, other_n): every ordered pair of words of a vocabulary (word, n, word_id) that one edit parts.

    Neighbourhoods carry numbers, so that a very long word is not repeated for each of its neighbours. Each holds all
    reduced words at one edit, but only those of no larger key are looked up: every pair meets from one of its sides.
    """

    def groups(batch: pa.RecordBatch) -> Iterator[tuple[list[str], pa.Array]]:
        """Equally long words, few enough at a time for their neighbourhoods."""
        texts = batch["word"].to_pylist()
        by: dict[int, list[int]] = {}
        for i, w in enumerate(texts):
            by.setdefault(len(w), []).append(i)
        for length, rows in by.items():
            step = max(1, _MADE // (2 * (length + 1) * symbols))
            for start in range(0, len(rows), step):
                part = rows[start:start + step]
                yield [texts[i] for i in part], batch["word_id"].take(pa.array(part))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, ids in groups(batch):
                yield pa.RecordBatch.from_pydict({"key": _short(own_keys(reduced(part, symbols))), "other_id": ids})

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, ids in groups(batch):
                symbols_of = reduced(part, symbols)
                own = _short(own_keys(symbols_of))
                row, key = (np.concatenate(x) for x in zip(*neighbour_keys(symbols_of, symbols)))
                key = _short(key)
                asking = key <= own[row]
                row, key = row[asking], key[asking]
                order = np.lexsort((key, row))
                row, key = row[order], key[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
                row, key = row[new], key[new]
                yield pa.RecordBatch.from_pydict({"key": key, "same": key == own[row], "word_id": ids.take(pa.array(row))})

    asked = words.select("word", "word_id").mapInArrow(spread, "key int, same boolean, word_id long")
    held = words.select("word", "word_id").mapInArrow(keyed, "key int, other_id long")
    # The word of larger key asks; words of one key ask each other, and the one of smaller number is heard.
    met = asked.join(held, "key").where("NOT same OR word_id < other_id").select("word_id", "other_id")
    other = words.select(F.col("word_id").alias("other_id"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    pairs = met.join(words, "word_id").join(other, "other_id").where(F.levenshtein("word", "other", 1) == 1)
    both = F.array(F.struct("word", "n", "other", "other_n"), F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    return pairs.select(F.explode(both).alias("pair")).select("pair.*")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the forms of ``forms`` (word, form) lead; each round doubles the steps taken."""
    now = common.stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("at"), F.col("root").alias("further"))
        moved = now.join(ahead, now.root == ahead["at"], "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        moved = common.stored(moved, "spelling-roots")
        now = moved.drop("moved")
        if moved.where("moved").limit(1).count() == 0:
            return now


def group_spellings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", symbols: int = SYMBOLS) -> DataFrame:
    """Every word of the table with its more frequent spelling: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    Words are lower-cased runs of Latin letters with at least five code points and three occurrences. A word's form
    is its most frequent word at one edit (ties: the least), if that occurs at least twice as often; its root is
    where the forms lead, itself without one.

    Null and empty texts have no words. Rows with a null id count like others, with no letter deleted; repeated rows
    count each. Other columns are ignored whatever their names, and an empty table gives an empty result. Texts are
    read whole, a few megabytes or one longer text at a time.
    """
    words = vocabulary(docs, id_col, text_col)
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    near = near_words(words, symbols).groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    good = -F.col("best.less") >= 2 * F.col("n")
    near = near.select("word", "n_near", F.when(good, F.col("best.form")).alias("form"), F.when(good, -F.col("best.less")).alias("form_n"))
    near = common.stored(near, "near-words")
    found = roots(near.where("form IS NOT NULL"))
    return words.drop("word_id").join(near, "word", "left").join(found, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
