"""Packing: Karmarkar-Karp multiway differencing.

Documents become token ids plus an end id. Whole sequences are cut off a long document; the rest is cut into pieces, and a group of
pieces, large enough for ``windows`` sequences, is partitioned: every piece starts as a partial partition that holds it alone, and
the two partial partitions with the largest imbalance are merged, the fullest windows of one with the emptiest of the other,
until one is left. Its windows are near-equal. If any is over the capacity, the group is partitioned again into one window more.

Groups are filled from the rows of a task as they come, so nothing is shuffled, no key can be hot, and memory is bounded by a group
and a batch. Sequence ids are the partition's number and a counter, so a lost task writes the same ids again.

Defined results: a null text is empty and has only the end id; repeated rows are packed one by one; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches
from .tokens import Encoder

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def difference(sizes: np.ndarray, count: int) -> np.ndarray:
    """The window (0 to count - 1) of every piece, by differencing of partial partitions with the largest spread first."""
    if count == 1 or not len(sizes):
        return np.zeros(len(sizes), np.int64)
    n = len(sizes)
    left, right = np.zeros(n + 1 + n * 2, np.int64), np.zeros(n + 1 + n * 2, np.int64)  # bag ids: 0 empty, 1..n pieces, then unions
    fresh = n + 1
    heap = []
    for k in range(n):
        sums, bags = np.zeros(count, np.int64), np.zeros(count, np.int64)
        sums[-1], bags[-1] = sizes[k], k + 1
        heap.append((-int(sizes[k]), k, sums, bags))
    heapq.heapify(heap)
    turn = n
    while len(heap) > 1:
        _, _, a, x = heapq.heappop(heap)
        _, _, b, y = heap[0]
        sums, y = a + b[::-1], y[::-1]
        bags = np.maximum(x, y)
        both = np.flatnonzero((x > 0) & (y > 0))
        if len(both):
            made = np.arange(fresh, fresh + len(both))
            left[made], right[made] = x[both], y[both]
            bags[both] = made
            fresh += len(both)
        order = np.argsort(sums, kind="stable")
        sums, bags = sums[order], bags[order]
        heapq.heapreplace(heap, (int(sums[0] - sums[-1]), turn, sums, bags))
        turn += 1
    window = np.full(fresh, -1, np.int64)
    for k, bag in enumerate(heap[0][3]):
        if bag:
            window[bag] = k
    for bag in range(fresh - 1, n, -1):
        window[left[bag]] = window[right[bag]] = window[bag]
    return window[1:n + 1]


def windows_for(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Windows of the pieces and their count: the least that can hold all, raised whenever one exceeds the capacity."""
    count = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = difference(sizes, count)
        if np.bincount(window, sizes, count).max(initial=0) <= capacity:
            return window, count
        count += 1


class Packer:
    """Takes documents in order and gives the rows of whole groups."""

    def __init__(self, capacity: int, windows: int, piece: int, slack: int, first_id: int):
        self.capacity, self.piece = capacity, piece
        self.target = windows * (capacity - slack)
        self.next_id = first_id
        self.done: list[tuple] = []
        self.rest: list[tuple] = []
        self.held = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        n, a = len(ids), 0
        while n - a >= self.capacity:
            self.done.append((doc_id, a, ids[a:a + self.capacity], n, self.next_id, 0))
            self.next_id += 1
            a += self.capacity
        while a < n:
            late = self.held >= self.target * 3 // 4  # small pieces at the end of a group level its windows
            b = min(n, a + self.target - self.held, a + (min(self.piece, max(16, (n - a + 1) // 2)) if late else self.piece))
            self.rest.append((doc_id, a, ids[a:b], n))
            self.held += b - a
            a = b
            if self.held == self.target:
                self.close()

    def close(self) -> None:
        """Partition the held pieces; sequences keep the order in which their pieces came."""
        if not self.rest:
            return
        window, count = windows_for(np.fromiter((len(r[2]) for r in self.rest), np.int64, len(self.rest)), self.capacity)
        filled = [0] * count
        for r, w in zip(self.rest, window.tolist()):
            self.done.append((*r, self.next_id + w, filled[w]))
            filled[w] += len(r[2])
        self.next_id += count
        self.rest, self.held = [], 0

    def rows(self) -> pd.DataFrame:
        done, self.done = self.done, []
        columns = list(zip(*done)) if done else [()] * 6
        return pd.DataFrame({"doc_id": pd.array(columns[0], "Int64"), "start": np.array(columns[1], np.int64), "length": np.array([len(x) for x in columns[2]], np.int64),
                             "ids": [x.tobytes() for x in columns[2]], "doc_tokens": np.array(columns[3], np.int64),
                             "sequence_id": np.array(columns[4], np.int64), "offset": np.array(columns[5], np.int64)})


def pack(docs: DataFrame, ranks: str, pattern: str, capacity: int = 2048, end_id: int = 1, windows: int = 48, piece: int = 512,
         slack: int = 8) -> DataFrame:
    """Pieces of all documents with their ids (little-endian unsigned 32-bit) and their places in sequences of at most ``capacity``."""
    arrow_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(ranks, pattern)
        packer = Packer(capacity, windows, piece, slack, TaskContext.get().partitionId() << 32)
        for b in batches:
            flat, ends = encoder.encode(list(b.text))
            begin = 0
            for doc_id, end in zip(b.doc_id, ends.tolist()):
                packer.add(None if pd.isna(doc_id) else int(doc_id), np.append(flat[begin:end], np.array(end_id, "<u4")))
                begin = end
            yield packer.rows()
        packer.close()
        yield packer.rows()

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return text.mapInPandas(run, PIECES)
