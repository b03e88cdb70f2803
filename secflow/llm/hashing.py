"""Words of many texts at once: boundaries and hashes with NumPy on UTF-8 bytes.

Hashes are polynomials modulo 2**64 over random byte codes, finished with a mixing step. Span
hashes come from prefix sums, so the cost per word or window does not depend on its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

BLOCK = 1 << 20
U64 = np.uint64


def byte_table(pattern_bytes: set[int]) -> np.ndarray:
    table = np.zeros(256, bool)
    table[sorted(pattern_bytes)] = True
    return table


#: Words of anything but space, tab, line feed, vertical tab, form feed and carriage return.
BLANK_SPLIT = byte_table(set(range(256)) - {0x20, *range(0x09, 0x0E)})
#: Words of digits, Latin letters and everything outside ASCII.
ALNUM = byte_table({*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)})
#: Byte map that lower-cases A-Z and nothing else.
LOWER_AZ = np.arange(256, dtype=np.uint8)
LOWER_AZ[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class SpanHash:
    """Hashes of spans of a code sequence from prefix sums of codes times powers of an odd base."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.base = int(rng.integers(1 << 62)) * 2 + 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.codes = rng.integers(1 << 63, size=256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
        self.up = self.down = np.ones(1, U64)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            for name, base in (("up", self.base), ("down", self.inverse)):
                powers = np.full(n, base, U64)
                powers[0] = 1
                setattr(self, name, np.cumprod(powers))

    def spans(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self._grow(len(codes) + 1)
        sums = np.zeros(len(codes) + 1, U64)
        np.cumsum(codes * self.up[: len(codes)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(U64) * U64(0x9E3779B97F4A7C15))


@dataclass
class Words:
    """Word hashes of a run of texts, in order. ``first[i]:first[i + 1]`` are the words of text ``i``."""

    first: np.ndarray
    hashes: list[np.ndarray]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def windows(self, at: np.ndarray, width: int | np.ndarray, hashers: list[SpanHash]) -> list[np.ndarray]:
        """Hashes of the ``width`` words that start at each word number of ``at``."""
        return [h.spans(w, at, at + width) for h, w in zip(hashers, self.hashes)]


def _pieces(texts: list[bytes], table: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Texts, the long ones cut between words into pieces of about ``BLOCK`` bytes."""
    for i, text in enumerate(texts):
        start = 0
        while len(text) - start > BLOCK:
            end = start + BLOCK
            gaps = np.flatnonzero(~table[np.frombuffer(text, np.uint8, BLOCK, start)])
            if len(gaps):
                end = start + int(gaps[-1]) + 1
            else:  # one word fills the block: go on to its end
                while end < len(text) and table[text[end]]:
                    end += 1
            yield i, text[start:end]
            start = end
        yield i, text[start:]


def hash_words(texts: list[bytes], table: np.ndarray, hashers: list[SpanHash], fold: np.ndarray | None = None) -> Words:
    """Words of each text by byte class ``table``, hashed once per hasher."""
    out: list[list[np.ndarray]] = [[] for _ in hashers]
    counts = np.zeros(len(texts), np.int64)
    block: list[tuple[int, bytes]] = []
    size = 0

    def flush() -> None:
        nonlocal block, size
        data = np.frombuffer(b" ".join(p for _, p in block), np.uint8)
        inside = table[data]
        edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
        starts, ends = edges[::2], edges[1::2]
        begins = np.cumsum([0] + [len(p) + 1 for _, p in block[:-1]])
        owner = np.searchsorted(begins, starts, side="right") - 1
        np.add.at(counts, [i for i, _ in block], np.bincount(owner, minlength=len(block)))
        data = data if fold is None else fold[data]
        for to, h in zip(out, hashers):
            to.append(h.spans(h.codes[data], starts, ends))
        block, size = [], 0

    for i, piece in _pieces(texts, table):
        block.append((i, piece))
        size += len(piece) + 1
        if size >= BLOCK:
            flush()
    if block:
        flush()
    first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    return Words(first, [np.concatenate(x) if x else np.zeros(0, U64) for x in out])


def bucketed(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bucket number (the top bits) and 32 more bits of each hash in one sortable integer."""
    return ((hashes >> U64(64 - bits)) << U64(32)) | (hashes & U64(0xFFFFFFFF))


def bucket_runs(keys: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of sorted ``bucketed`` keys."""
    if not len(keys):
        return []
    buckets = (keys >> U64(32)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(buckets)) + 1
    return [(int(buckets[a]), int(a), int(b)) for a, b in zip([0, *cuts], [*cuts, len(keys)])]
