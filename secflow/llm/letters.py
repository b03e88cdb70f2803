"""Lower-case letters of many texts as one code array, for character n-grams with NumPy."""

from __future__ import annotations

from functools import cache

import numpy as np


@cache
def _letter_table() -> np.ndarray:
    """Each code point that is a letter stands for itself, every other one for 0."""
    table = np.zeros(0x110000, np.uint32)
    alpha = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isalpha()]
    table[alpha] = alpha
    return table


def letter_codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, text number): letters lower-cased, each other run as one 0, a 0 before and after every text."""
    lowered = [f"\n{(t or '').lower()}\n" for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = _letter_table()[points]
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in lowered])
    kept = codes != 0
    kept[1:] |= (codes[:-1] != 0) | (owner[1:] != owner[:-1])
    kept[:1] = True
    return codes[kept], owner[kept]


#: Characters that stand for a letter inside a word: fixed values.
MASKS = "@$*#!+|%&"


@cache
def _word_table() -> np.ndarray:
    """Letters and digits stand for themselves, masks too, every other code point for 0."""
    table = _letter_table().copy()
    for c in "0123456789" + MASKS:
        table[ord(c)] = ord(c)
    return table


def word_codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """As ``letter_codes``, with digits, and with masks that have a letter or digit on both sides in their run."""
    lowered = [f"\n{(t or '').lower()}\n" for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = _word_table()[points]
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in lowered])
    mask = np.isin(codes, [ord(c) for c in MASKS])
    if mask.any():
        at, gap, solid = np.arange(len(codes), dtype=np.int32), codes == 0, (codes != 0) & ~mask
        before = np.maximum.accumulate(np.where(solid, at, -1)) > np.maximum.accumulate(np.where(gap, at, -1))
        most = len(codes)
        after = (np.minimum.accumulate(np.where(solid, at, most)[::-1])[::-1] < np.minimum.accumulate(np.where(gap, at, most)[::-1])[::-1])
        codes = np.where(mask & ~(before & after), np.uint32(0), codes)
    kept = codes != 0
    kept[1:] |= (codes[:-1] != 0) | (owner[1:] != owner[:-1])
    kept[:1] = True
    return codes[kept], owner[kept]
