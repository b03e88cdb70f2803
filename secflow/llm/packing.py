"""Best-fit packing of tokenised documents, certified by lower bounds.

Pieces are packed partition by partition with best-fit decreasing. Dual-feasible functions give a
lower bound on the bins that a partition needs; where the bound is met the packing is optimal. The
partitions with a gap exchange their pieces and are packed again.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from secflow.llm import common

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
LENGTH = 2048
END_ID = 0
#: Pieces that one task packs, and rounds of exchange at most.
PARTITION_PIECES, ROUNDS = 20_000, 3

#: Fixed value: the pre-tokenisation for which words can be encoded one by one.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Visible ASCII and precomposed Latin letters: already normalised, and lower-cased letter by letter.
_PLAIN = re.compile(r"[!-~À-įı-ɏ]+")
_MARKS = (b".", b",")
_WORDS_KEPT = 800_000


class _Known(dict):
    """Ids by word; an unknown word is encoded when it is asked for."""

    def __init__(self, encode: Callable[[bytes], bytes]):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: bytes) -> bytes:
        ids = self[word] = self.encode(word)
        return ids


class WordEncoder:
    """Token ids of whole texts, each distinct word encoded once.

    The pieces of words are kept beside the words: a piece that stands alone has the same ids.

    White space parts words in this kind of vocabulary, so a text's ids are those of its words. Plain
    words go straight to the BPE model; any other word passes through the whole tokenizer.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = [p.get("pattern", {}).get("Regex") for p in spec["pre_tokenizer"].get("pretokenizers", [])]
        kinds = [n["type"] for n in spec["normalizer"].get("normalizers", [])]
        self.by_word = split[:1] == [_SPLIT] and kinds == ["NFC", "Replace", "Lowercase"] and self.tokenizer.get_vocab_size() < 1 << 16
        self.tokenize = self.tokenizer.model.tokenize
        self.split = regex.compile(_SPLIT)
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        other = [b for b in range(256) if b not in printable]
        self.shown = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(other)}
        self.words = _Known(self._word)

    def _stem(self, stem: bytes) -> bytes:
        """Ids of a lower-cased run that the pre-tokenisation leaves whole."""
        ids = self.words.get(stem)
        if ids is None:
            shown = stem.decode("latin-1")
            if not stem.isalpha():  # ASCII letters stand for themselves
                shown = shown.translate(self.shown)
            ids = self.words[stem] = array("H", [t.id for t in self.tokenize(shown)]).tobytes()
        return ids

    def _word(self, word: bytes) -> bytes:
        if word.isalpha():  # ASCII letters only
            return self._stem(word.lower())
        if word[-1:] in _MARKS and word[:-1].isalpha():
            return self._stem(word[:-1].lower()) + self._stem(word[-1:])
        text = word.decode()
        if "<|" in text or not _PLAIN.fullmatch(text):
            return array("H", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        text = text.lower()
        if text.isalpha():
            return self._stem(text.encode())
        return b"".join([self._stem(x.encode()) for x in self.split.findall(text)])

    def ids(self, text: bytes) -> np.ndarray:
        if not self.by_word:
            return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, np.uint32)
        if len(self.words) > _WORDS_KEPT:
            self.words.clear()
        return np.frombuffer(b"".join(map(self.words.__getitem__, text.split())), np.uint16).astype(np.uint32)


@lru_cache(maxsize=1)
def encoder_of(path: str) -> WordEncoder:
    """The encoder of a worker process, kept with its words from one task to the next."""
    return WordEncoder(path)


def tokenised_pieces(docs: DataFrame, path: str = TOKENIZER, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = True) -> DataFrame:
    """The pieces of every document, stored in the shared folder, numbered by ``piece_no``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        for part in common.slices(batches, "text"):
            rows: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            for doc, text in zip(part["doc_id"].to_pylist(), common.utf8(part["text"])):
                ids = np.append(encoder.ids(text), np.uint32(END_ID)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), length)):
                    own = ids[start:start + length]
                    for k, v in zip(rows, (doc, piece, start, len(own), zlib.crc32(own.tobytes()), own.tobytes() if with_ids else None)):
                        rows[k].append(v)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_pydict({k: pa.array(v, t) for (k, v), t in zip(rows.items(), types)})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")
    return common.stored(pieces.withColumn("piece_no", F.monotonically_increasing_id()), "token-pieces")


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece: longest first, each into the fullest bin that still takes it."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    free = 0  # bit r is set when a bin with r free places exists
    opened = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = free >> size
        if fitting:
            room = (fitting & -fitting).bit_length() - 1 + size
            b = open_bins[room].pop()
            if not open_bins[room]:
                free ^= 1 << room
        else:
            room, b = capacity, opened
            opened += 1
        bins[i], offsets[i] = b, capacity - room
        if room > size:
            open_bins[room - size].append(b)
            free |= 1 << (room - size)
    return bins, offsets


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs, by two families of dual-feasible functions."""
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    sizes = np.arange(capacity + 1)
    weight = counts * sizes
    many, mass = np.cumsum(counts), np.cumsum(weight)
    cut = np.arange(0, capacity // 2 + 1)
    # 1 above capacity - cut, 0 below cut, the size itself between
    above = many[-1] - many[capacity - cut]
    between = mass[capacity - cut] - np.where(cut > 0, mass[np.maximum(cut - 1, 0)], 0)
    best = int(np.max(-(-(above * capacity + between) // capacity)))
    for k in range(1, 41):  # rounded down to k-ths, sizes that are whole (k + 1)-ths kept
        scaled = (k + 1) * sizes
        value = np.where(scaled % capacity == 0, sizes * k, scaled // capacity * capacity)
        best = max(best, int(-(-int((counts * value).sum()) // (k * capacity))))
    return best


def _packed(pieces: DataFrame, capacity: int) -> DataFrame:
    """Pack each ``part`` of (piece_no, length, part), with the part's bins and lower bound on every row."""

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("piece_no", "ascending")])
        lengths = table["length"].to_numpy()
        bins, offsets = best_fit(lengths, capacity)
        n = table.num_rows
        return pa.table({"piece_no": table["piece_no"], "length": table["length"], "part": table["part"], "bin": bins, "offset": offsets,
                         "bins": np.full(n, bins.max() + 1), "bound": np.full(n, lower_bound(lengths, capacity))})

    packed = pieces.groupBy("part").applyInArrow(pack, "piece_no long, length long, part long, bin long, offset long, bins long, bound long")
    return common.stored(packed, "packed-pieces")


def packing_plan(pieces: DataFrame, length: int = LENGTH, partition_pieces: int = PARTITION_PIECES, rounds: int = ROUNDS) -> DataFrame:
    """``piece_no``, ``sequence_id`` and ``offset`` of every piece of at most ``length`` tokens.

    Whole pieces fill a sequence alone. The others are dealt into partitions by hash; after each round
    the partitions whose bins exceed their lower bound exchange all pieces, and the new packing is taken
    if it needs fewer bins. Only a count and a sum of bins reach the driver.
    """
    full = pieces.where(F.col("length") == length).select("piece_no", (-F.col("piece_no") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.where(F.col("length") < length).select("piece_no", "length")

    def dealt(some: DataFrame, parts: int, turn: int) -> DataFrame:
        return some.select("piece_no", "length", F.pmod(F.xxhash64("piece_no", F.lit(turn)), F.lit(parts)).alias("part"))

    def gaps(packed: DataFrame) -> tuple[int, int, DataFrame]:
        loose = packed.where("bins > bound")
        r = loose.groupBy("part").agg(F.first("bins").alias("bins")).agg(F.count("*").alias("n"), F.coalesce(F.sum("bins"), F.lit(0)).alias("s")).first()
        return r.n, r.s, loose

    parts = max(1, -(-rest.count() // partition_pieces))
    packed, done = _packed(dealt(rest, parts, 0), length), full
    turn = 0
    while True:
        n, bins, loose = gaps(packed)
        done = done.unionByName(_sequences(packed.where("bins <= bound"), turn))
        if n < 2 or turn >= rounds:
            break
        again = _packed(dealt(loose, n, turn + 1), length)
        if again.groupBy("part").agg(F.first("bins").alias("bins")).agg(F.sum("bins")).first()[0] >= bins:
            break
        packed, turn = again, turn + 1
    return done.unionByName(_sequences(loose, turn))


def _sequences(packed: DataFrame, turn: int) -> DataFrame:
    number = F.lit(turn << 58) + F.shiftleft("part", 24) + F.col("bin")
    return packed.select("piece_no", number.alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, path: str = TOKENIZER, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
                   with_ids: bool = True) -> DataFrame:
    """Pieces of all documents and their places in training sequences of at most ``length`` tokens.

    A document is its token ids and ``END_ID``; longer ones are cut into pieces of ``length``. Returns
    ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``ids`` (little-endian 32-bit ids; null
    without ``with_ids``), ``sequence_id`` and ``offset``, where the pieces of a sequence leave no gap.

    Null and empty texts are one piece of one id. Null ids stay null. Repeated rows are packed each for
    itself, and other columns are ignored whatever their names. An empty table gives an empty result.
    """
    pieces = tokenised_pieces(docs, path, length, id_col, text_col, with_ids)
    plan = packing_plan(pieces.select("piece_no", "length"), length)
    return pieces.join(plan, "piece_no").drop("piece_no")
