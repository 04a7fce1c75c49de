"""Periodic runs of words, found online by catchers over completed power-of-two blocks.

Words are appended one by one. When a block of 2^k words is complete (blocks begin at every multiple of 2^(k-1)), a catcher is set
up for it and lives for the next 2^k words; so about three catchers of each size are alive, whatever the length of the text. A catcher
looks for a copy of its block that ends at the appended word, at a distance p with 2^(k-1) < p <= 2^k. A copy means that a square of
period p ends here; from then on period p is open, and every appended word is compared with the one p before it. Squares of one period
that follow one another merge into a run, which is reported when the comparison fails or the text ends.

Every run of at least four periods is caught: with smallest period q, 2^(k-1) < q <= 2^k, it has 3q - 2^k + 1 >= 2^(k-1) places for a
block of 2^k words whose copy at distance q is in the run too, so one of them is a place where a block begins. A period that is open with
a divisor of p that covers the last p words is no new period; at the end, runs whose root is a power are left out.

Defined results: words are runs of other characters than blank and U+0009 to U+000D, case matters; null and empty texts have no words
and no runs; the longest exponent wins, ties go to the smallest start, then the smallest period; repeated rows are judged one by one; a
null doc_id leaves the words as they are; an empty table gives an empty result; extra columns are not read. Memory is that of the words
of one text.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches

#: A run has at least this many words and this many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = ("doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
          "collapsed_sha256 string")


def primitive(words: Sequence[int], start: int, period: int) -> bool:
    """Whether the ``period`` words from ``start`` are no repetition of fewer words; the run goes on for another period at least."""
    rest, f = period, 2
    while rest > 1:
        if rest % f == 0:
            q = period // f
            if words[start:start + period - q] == words[start + q:start + period]:
                return False
            while rest % f == 0:
                rest //= f
        f = f + 1 if f * f <= rest else max(rest, f + 1)
    return True


def catch_runs(words: Iterable[int]) -> Iterator[tuple[int, int, int]]:
    """(start, length, smallest period) of every run, in the order in which runs end."""
    seen: list[int] = []
    opened: dict[int, int] = {}  # period -> first word that equals the one a period before
    ending: dict[int, list[tuple[int, int]]] = {}  # last word of a block -> (end, size) of its live catchers
    i, n = -1, 0

    def run(first: int, end: int, p: int) -> tuple[int, int, int] | None:
        n = end - first + p
        if n >= LEAST_PERIODS * p and n >= LEAST_WORDS and primitive(seen, first - p, p):
            return first - p, n, p
        return None

    def catch(p: int, size: int) -> None:
        if p in opened or any(p % q == 0 and n - first + q >= p for q, first in opened.items()) or seen[n - p - size:n - p] != seen[n - size:n]:
            return
        j = i - size
        while j >= p and seen[j] == seen[j - p]:
            j -= 1
        opened[p] = j + 1

    for i, w in enumerate(words):
        seen.append(w)
        n = i + 1
        if opened:
            for p in [p for p in opened if seen[i - p] != w]:
                if found := run(opened.pop(p), i, p):
                    yield found
        # blocks of one and two words begin everywhere, so their catchers are the last words themselves
        if i and seen[i - 1] == w:
            catch(1, 1)
        elif i > 2 and seen[i - 2] == w and seen[i - 1] == seen[i - 3]:
            catch(2, 2)
        for end, size in ending.get(w, ()):
            p = n - end
            if size < 2 * p <= 2 * size and seen[end - 4:end] == seen[n - 4:n]:
                catch(p, size)
        size, step = 4, 2
        while n % step == 0 and size <= n:
            gone = n - size - step
            if gone >= size:
                last = seen[gone - 1]
                left = ending[last]
                if len(left) == 1:
                    del ending[last]
                else:
                    left.remove((gone, size))
            if w in ending:
                ending[w].append((n, size))
            else:
                ending[w] = [(n, size)]
            size, step = 2 * size, size
    for p, first in opened.items():
        if found := run(first, i + 1, p):
            yield found


def planted(doc_id: int | None, words: list[str]) -> list[str]:
    """The words with a repetition set in where the id's checksum asks for one."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def describe(words: list[str]) -> tuple:
    """n_words, n_runs, start, length, period and exponent_milli of the run of greatest exponent, and the two digests."""
    codes: dict[str, int] = {}
    runs = sorted(catch_runs([codes.setdefault(w, len(codes)) for w in words]), key=lambda r: (r[0], r[2]))
    kept, best = words, None
    if runs:
        drop = bytearray(len(words))
        for run in runs:
            start, length, period = run
            drop[start + period:start + length] = b"\x01" * (length - period)
            if best is None or length * best[2] > best[1] * period:
                best = run
        kept = [w for w, x in zip(words, drop) if not x]
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(words), len(runs), *top, hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(" ".join(kept).encode("utf-8", "surrogatepass")).hexdigest())


def periodic_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """One row per document: number of runs, the run of greatest exponent, digests of all runs and of the text without repetitions.

    With ``plant``, words are first replaced as ``planted`` says.
    """
    arrow_batches(docs.sparkSession)
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc_id, text in zip(b.doc_id, b.text):
                own = None if pd.isna(doc_id) else int(doc_id)
                words = _WORD.findall(text) if isinstance(text, str) else []
                rows.append((own, *describe(planted(own, words) if plant else words)))
            yield pd.DataFrame(rows, columns=names).astype({c: "Int64" for c in names[:7]})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(work, SCHEMA)
