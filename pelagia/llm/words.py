"""Words of a batch of texts as integer codes, and hashed character n-grams of the distinct words; all in numpy."""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pandas as pd

WORD = re.compile(r"[^\W\d_]+")


def coded(texts: Sequence[str | None], pattern: re.Pattern = WORD) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Codes of all words in order, the offset of each text (one more than texts), and the distinct words, lower-cased.

    Distinct spellings keep distinct codes; a null text has no words.
    """
    flat: list[str] = []
    ends = [0]
    for t in texts:
        if t:
            flat += pattern.findall(t)
        ends.append(len(flat))
    if not flat:
        return np.zeros(0, np.int64), np.array(ends), []
    codes, kinds = pd.factorize(np.array(flat, object))
    return codes, np.array(ends), [w.lower() for w in kinds]


def ngrams(words: Sequence[str], orders: Sequence[int], buckets: int, whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, index of the word) of every character n-gram of the words between boundary marks, and of each whole word."""
    points = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(ends, sizes) - np.arange(len(points))
    with np.errstate(over="ignore"):
        def bucket(h: np.ndarray, salt: int) -> np.ndarray:
            h = (h + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
            return ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)).astype(np.int64) % buckets

        keys, owners, h = [], [], np.zeros(len(points), np.uint64)
        for n in range(1, max(orders, default=0) + 1):
            h = h[:len(h) - 1] if n > 1 else h
            h = h * np.uint64(1_000_003) + points[n - 1:] + np.uint64(1)
            if n in orders:
                fits = left[:len(h)] >= n
                keys.append(bucket(h[fits], n))
                owners.append(owner[:len(h)][fits])
        if whole and len(words):
            steps = np.arange(len(points)) - np.repeat(ends - sizes, sizes)
            mixed = (points + np.uint64(7)) * np.power(np.uint64(0x100000001B3), steps.astype(np.uint64))
            keys.append(bucket(np.add.reduceat(mixed, ends - sizes), 99))
            owners.append(np.arange(len(words)))
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(owners)
