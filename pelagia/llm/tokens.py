"""Token ids of whole texts with a public byte-level BPE vocabulary.

A blank followed by a character that is not white space always begins a new pre-token of this vocabulary, so a text can be cut
there and the ids of the parts joined. Parts repeat much more often than texts: a worker keeps the ids of those it has met in one
numpy pool, and encodes all new ones of a batch in one call. The ids equal those of the ``tokenizers`` file of the same
vocabulary (tested).
"""

from __future__ import annotations

import base64
from collections.abc import Sequence

import numpy as np
import pandas as pd


class Encoder:
    """``encode`` gives the ids of many texts as one flat array and the end of each text in it; no special token is added or read."""

    def __init__(self, ranks: str, pattern: str, keep: int = 1_000_000):
        import tiktoken
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.bytes_of = [b""] * (max(table.values()) + 1)
        for k, v in table.items():
            self.bytes_of[v] = k
        self.size = np.fromiter(map(len, self.bytes_of), np.int64, len(self.bytes_of))
        self.keep = keep
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.pool, self.used = np.zeros(1 << 20, "<u4"), 0
        self.start, self.length = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

    def learn(self, parts: list[str]) -> None:
        """Ids of blank + part, for parts that follow a blank; length -1 where that blank is not the start of a pre-token."""
        good = [p for p in parts if p and not p[0].isspace()]
        ids = np.array(self.bpe.encode_ordinary(" " + " ".join(good)) if good else [], "<u4")
        ends = np.cumsum(np.fromiter((len(p.encode()) + 1 for p in good), np.int64, len(good)))
        cut = np.searchsorted(np.cumsum(self.size[ids]), ends) + 1
        bad = [p for p in parts if not p or p[0].isspace()]
        a, b = len(self.known), len(self.known) + len(parts)
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while b > len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length))
        self.pool[self.used:self.used + len(ids)] = ids
        self.start[a:a + len(good)] = self.used + np.concatenate([[0], cut])[:-1]
        self.length[a:a + len(good)] = np.diff(cut, prepend=0)
        self.length[a + len(good):b] = -1
        self.known.update(zip(good + bad, range(a, b)))
        self.used += len(ids)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.bpe.encode_ordinary(text), "<u4")

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        flat: list[str] = []
        heads, ends = [], []
        for t in texts:
            p = t.split(" ")
            heads.append(p[0])
            flat += p[1:]
            ends.append(len(flat))
        codes, kinds = pd.factorize(np.array(flat, object)) if flat else (np.zeros(0, np.int64), [])
        if len(self.known) + len(kinds) > self.keep:
            self.forget()
        self.learn([w for w in kinds if w not in self.known])
        at = np.fromiter(map(self.known.__getitem__, kinds), np.int64, len(kinds))[codes]
        start, length = self.start[at], self.length[at]
        begins = np.concatenate([np.zeros(1, np.int64), np.array(ends, np.int64)])[:-1]
        bad = np.add.reduceat(np.append(length < 0, False).astype(np.int64), begins) if ends else begins
        out, first = [], 0
        sums = np.concatenate([[0], np.cumsum(np.maximum(length, 0))])
        taken = np.repeat(start - sums[:-1], np.maximum(length, 0)) + np.arange(sums[-1])
        body = self.pool[taken]
        for t, head, end, b in zip(texts, heads, ends, bad):
            out.append(self.whole(t) if end > first and b else np.concatenate([self.whole(head), body[sums[first]:sums[end]]]))
            first = end
        sizes = np.fromiter(map(len, out), np.int64, len(out))
        return (np.concatenate(out) if out else np.zeros(0, "<u4")), np.cumsum(sizes)
