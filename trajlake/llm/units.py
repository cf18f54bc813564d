"""Texts as sequences of units: words, and single characters of Chinese and Japanese.

A unit is kept as a stable 64-bit hash, so sequences are numpy arrays wherever they are compared.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np
import xxhash

# Ranges whose characters are units of their own (kana, ideographs and their marks).
IDEOGRAPHS = "々〆぀-ヿㇰ-ㇿ㐀-䶿一-鿿豈-﫿\U00020000-\U0003ffff"
#: Distinct units a worker remembers before it starts anew.
MEMO = 400_000

# The same without signs that aren't letters (middle dot, combining marks).
IDEOGRAPH_LETTERS = "々〆ぁ-ゖゝ-ゟァ-ヺー-ヿㇰ-ㇿ㐀-䶿一-鿿豈-﫿\U00020000-\U0003ffff"
_LETTERS = re.compile(f"[{IDEOGRAPH_LETTERS}]|[^\\W\\d_{IDEOGRAPHS}]+")
_IDEOGRAPH_RUNS = re.compile(f"[{IDEOGRAPHS}]+")
_WORDS = re.compile(f"[{IDEOGRAPHS}]|[^\\W_{IDEOGRAPHS}]+")
# a path begins at a drive or where its first name begins, so no word is tried again from its middle
_FOLDERS = re.compile(r"(?:[A-Za-z]:|(?<![A-Za-z0-9_.~\-]))[A-Za-z0-9_.~\-]*[/\\](?:[A-Za-z0-9_.~\-]+[/\\])*(?=[A-Za-z0-9_.~\-])")


class Hashes:
    """Hash of each unit, remembered within a worker; multi-sign units get an even, single ideographs an odd hash."""

    def __init__(self):
        self.memo: dict[str, int] = {}

    def of(self, units: list[str]) -> np.ndarray:
        memo = self.memo
        try:
            return np.array([memo[u] for u in units], np.int64)
        except KeyError:
            pass
        if len(memo) > MEMO:
            memo.clear()
        one = re.compile(f"[{IDEOGRAPHS}]").fullmatch
        for u in set(units):
            if u not in memo:
                h = xxhash.xxh3_64_intdigest(u) >> 1
                memo[u] = (h | 1) if len(u) == 1 and one(u) else (h & ~1)
        return np.array([memo[u] for u in units], np.int64)


@lru_cache(maxsize=1)
def hashes() -> Hashes:
    return Hashes()


def letter_units(text: str) -> tuple[np.ndarray, bool]:
    """Words without digits, punctuation, case and width, an ideograph being a word of its own; and False.

    Of a text at least half of whose letters are ideographs: all letters one by one; and True.
    """
    words = _LETTERS.findall(text.lower() if text.isascii() else unicodedata.normalize("NFKC", text).lower())
    joined = "".join(words)
    if not joined.isascii() and 2 * sum(map(len, _IDEOGRAPH_RUNS.findall(joined))) >= len(joined):
        return np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64), True
    return hashes().of(words), False


def word_units(text: str) -> np.ndarray:
    """Words and numbers without punctuation, case, width and the folders in front of file names; ideographs one by one."""
    plain = text.lower() if text.isascii() else unicodedata.normalize("NFKC", text).lower()
    if "/" in plain or "\\" in plain:
        plain = _FOLDERS.sub("", plain)
    return hashes().of(_WORDS.findall(plain))


#: Fixed odd multiplier of the rolling hashes.
BASE = np.uint64(0x9E3779B97F4A7C15)


def grams(units: np.ndarray, n: int) -> np.ndarray:
    """Rolling hashes of all runs of n units: a polynomial in BASE modulo 2^64, mixed at the end."""
    if len(units) < n:
        return np.empty(0, np.uint64)
    u = units.astype(np.uint64)
    m = len(u) - n + 1
    h = u[:m].copy()
    with np.errstate(over="ignore"):
        for i in range(1, n):
            h *= BASE
            h += u[i : i + m]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return h


def _windows(sequences: list[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sequences laid end to end: the sequence of each unit; start and rolling hash of each window within one sequence."""
    owner = np.repeat(np.arange(len(sequences)), [len(s) for s in sequences])
    h = grams(np.concatenate([np.empty(0, np.int64), *sequences]), n)
    start = np.flatnonzero(owner[: len(h)] == owner[n - 1 :]) if len(h) else np.empty(0, np.int64)
    return owner, start, h[start]


#: Sequences handled at once have numbers of so many bits, which leave the others of 64 to a hash.
OWNER_BITS = 11


def repeated_windows(sequences: list[np.ndarray], n: int) -> np.ndarray:
    """For each sequence, how many of its windows of n units equal an earlier one; never too few (equal hashes count as equal)."""
    owner, start, h = _windows(sequences, n)
    at = owner[start]
    keys = np.sort((at.astype(np.uint64) << np.uint64(64 - OWNER_BITS)) | (h >> np.uint64(OWNER_BITS)))
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    distinct = np.bincount((keys[new] >> np.uint64(64 - OWNER_BITS)).astype(np.int64), minlength=len(sequences))
    return np.bincount(at, minlength=len(sequences)) - distinct


def repeated_units(sequences: list[np.ndarray], n: int) -> np.ndarray:
    """For each sequence, how many of its units lie in windows of n units that equal an earlier one."""
    owner, start, h = _windows(sequences, n)
    with np.errstate(over="ignore"):
        keys = h ^ (owner[start].astype(np.uint64) * BASE)
    again = np.ones(len(keys), bool)
    again[np.unique(keys, return_index=True)[1]] = False
    edges = np.zeros(len(owner) + n, np.int32)
    np.add.at(edges, start[again], 1)
    np.add.at(edges, start[again] + n, -1)
    return np.bincount(owner[np.cumsum(edges[: len(owner)]) > 0], minlength=len(sequences))
