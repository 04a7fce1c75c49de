"""Quality rules: gradient-boosted trees over document statistics.

``document_stats`` measures every whole text, ``fit_trees`` boosts shallow trees with monotonic constraints on a bounded
sample of labelled rows, and ``score_trees`` scores a table with the trees flattened into numpy node arrays.

Defined results: a null text has no words (all statistics 0); an empty table gives an empty result; repeated rows are measured
one by one; without labels of both kinds the model keeps every document. Columns other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_batches, written

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_lines", "n_word_lines", "n_distinct", "n_digits", "n_upper", "n_punct", "n_letters", "n_short", "n_long", "n_chars"]
STATS_TYPE = T.StructType([T.StructField("doc_id", T.LongType())] + [T.StructField(c, T.LongType()) for c in COUNTS + EXTRA])

#: Statistics the trees see, as ratios, and the direction quality may move when each rises (0: free).
FEATURES = {"log_words": 0, "mean_word": 0, "symbols_per_word": -1, "dup_line_share": -1, "repeat_share": -1, "distinct_share": 0,
            "digit_share": 0, "upper_share": 0, "punct_share": 0, "letter_share": 0, "short_share": 0, "long_share": 0, "words_per_line": 0}

_WHITE = np.array([0x20, 9, 10, 11, 12, 13])
_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_PUNCT = np.frombuffer(b".,;:!?'\"()-", np.uint8)


def repeated_positions(ids: np.ndarray) -> int:
    """Positions covered by a three-item window that occurs twice or more; every occurrence counts, the first included."""
    n = len(ids) - 2
    if n < 2:
        return 0
    _, pairs = np.unique(ids[:-1].astype(np.int64) * (int(ids.max()) + 1) + ids[1:], return_inverse=True)
    _, inverse, counts = np.unique(pairs[:n].astype(np.int64) * (int(ids.max()) + 1) + ids[2:], return_inverse=True, return_counts=True)
    hit = counts[inverse] > 1
    cover = np.zeros(n + 2, bool)
    for k in range(3):
        cover[k:k + n] |= hit
    return int(cover.sum())


def text_stats(text: str | None) -> tuple[int, ...]:
    """The statistics of one text, in the order of COUNTS and EXTRA. Words are runs free of ASCII white space."""
    if not text:
        return (0,) * len(COUNTS + EXTRA)
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    points = len(text)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    letters = int(byte[65:91].sum() + byte[97:123].sum() + byte[0xC0:].sum())
    return (len(words), points - int(byte[_WHITE].sum()), int(byte[_SYMBOLS].sum()), len(lines) - len(set(lines)), repeated_positions(ids),
            raw.count(b"\n") + 1, len(lines), len(seen), int(byte[48:58].sum()), int(byte[65:91].sum()), int(byte[_PUNCT].sum()), letters,
            int((sizes <= 2).sum()), int((sizes >= 20).sum()), points)


def document_stats(docs: DataFrame) -> DataFrame:
    """Statistics of every document, one row each: doc_id, COUNTS and EXTRA."""
    arrow_batches(docs.sparkSession)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = np.array([text_stats(t) for t in b.text], np.int64).reshape(-1, len(COUNTS + EXTRA))
            out = pd.DataFrame(rows, columns=COUNTS + EXTRA)
            out.insert(0, "doc_id", b.doc_id.astype("Int64").array)
            yield out

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(measure, STATS_TYPE)


def feature_matrix(s: pd.DataFrame) -> np.ndarray:
    words, chars = np.maximum(s.n_words.to_numpy(float), 1), np.maximum(s.n_chars.to_numpy(float), 1)
    columns = [np.log1p(s.n_words.to_numpy(float)), s.word_chars / words, s.n_symbols / words, s.n_dup_lines / np.maximum(s.n_word_lines, 1),
               s.n_repeat_words / words, s.n_distinct / words, s.n_digits / chars, s.n_upper / words, s.n_punct / words, s.n_letters / chars,
               s.n_short / words, s.n_long / words, words / np.maximum(s.n_lines, 1)]
    return np.column_stack([np.asarray(c, float) for c in columns])


class Trees:
    """Boosted trees as node arrays of shape (trees, nodes): feature, threshold, left child (right is the next), value.

    A leaf points to itself, so a fixed number of vectorised steps sends every row to its leaf.
    """

    def __init__(self, base: float, depth: int, nodes: list[list[tuple[int, float, int, float]]]):
        self.base, self.depth = base, depth
        width = max([1, *map(len, nodes)])
        padded = [t + [(0, np.inf, k, 0.0) for k in range(len(t), width)] for t in nodes]
        take = lambda k, kind: np.array([[n[k] for n in t] for t in padded], kind).reshape(len(nodes), width)
        self.feature, self.threshold, self.left, self.value = take(0, np.int64), take(1, float), take(2, np.int64), take(3, float)

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, t, left, v in zip(self.feature, self.threshold, self.left, self.value):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = left[at] + (x[rows, f[at]] > t[at])
            total += v[at]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def fit_trees(x: np.ndarray, y: np.ndarray, monotone: list[int], rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 48,
              least: int = 10, ridge: float = 1.0) -> Trees:
    """Logistic boosting on histograms.

    A constrained feature is split only where the two leaf values keep its direction; the midpoint then bounds all leaves below,
    so no later split of either side can turn the order round.
    """
    if not len(y) or y.min() == y.max():
        return Trees(8.0, 0, [])
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    code = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)])
    prior = y.mean()
    base = float(np.log(prior / (1 - prior)))
    margin, nodes = np.full(len(y), base), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        tree: list[tuple[int, float, int, float]] = [(0, np.inf, 0, 0.0)]
        work = [(0, np.arange(len(y)), -np.inf, np.inf, 0)]
        while work:
            node, rows, low, high, level = work.pop()
            total_g, total_h = g[rows].sum(), h[rows].sum()
            own = float(np.clip(total_g / (total_h + ridge), low, high))
            best = (1e-6, None)
            if level < depth and len(rows) >= 2 * least:
                for f, e in enumerate(edges):
                    if not len(e):
                        continue
                    c = code[rows, f]
                    sums = [np.bincount(c, w, len(e) + 1).cumsum()[:-1] for w in (g[rows], h[rows], np.ones(len(rows)))]
                    a, b = (np.clip(s / (t + ridge), low, high) for s, t in ((sums[0], sums[1]), (total_g - sums[0], total_h - sums[1])))
                    gain = sum(s * v - 0.5 * (t + ridge) * v * v for s, t, v in ((sums[0], sums[1], a), (total_g - sums[0], total_h - sums[1], b)))
                    gain = gain - (total_g * own - 0.5 * (total_h + ridge) * own * own)
                    good = (sums[2] >= least) & (len(rows) - sums[2] >= least) & ((monotone[f] == 0) | (monotone[f] * (b - a) >= 0))
                    if good.any():
                        k = int(np.argmax(np.where(good, gain, -np.inf)))
                        if gain[k] > best[0]:
                            best = (gain[k], f, k, float(a[k]), float(b[k]))
            if best[1] is None:
                tree[node] = (0, np.inf, node, own * rate)
                margin[rows] += own * rate
                continue
            _, f, k, a, b = best
            left = len(tree)
            tree[node] = (f, float(edges[f][k]), left, 0.0)
            tree += [(0, np.inf, left, 0.0), (0, np.inf, left + 1, 0.0)]
            middle = (a + b) / 2
            side = code[rows, f] <= k
            bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[monotone[f]]
            work += [(left, rows[side], *bounds[0], level + 1), (left + 1, rows[~side], *bounds[1], level + 1)]
        nodes.append(tree)
    return Trees(base, depth, nodes)


def fit_quality(stats: DataFrame, sample: DataFrame) -> Trees:
    """Trees for the labelled ``sample`` (doc_id, label), whose size the caller has bounded; only its numbers reach the driver."""
    rows = stats.join(sample, "doc_id").toPandas().sort_values("doc_id", kind="stable")
    return fit_trees(feature_matrix(rows), rows.label.to_numpy(float), list(FEATURES.values()))


def score_trees(stats: DataFrame, trees: Trees) -> DataFrame:
    """``stats`` with the column quality: the trees' probability of a good document."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(quality=trees.probability(feature_matrix(b)))

    return stats.mapInPandas(score, T.StructType([*STATS_TYPE.fields, T.StructField("quality", T.DoubleType())]))


def judge_quality(docs: DataFrame, sample: DataFrame, least: float = 0.5) -> DataFrame:
    """Statistics, quality and the verdict of every document. Texts are read once: the trees are fitted on the written statistics."""
    stats = written(document_stats(docs), "quality-stats")
    scored = score_trees(stats, fit_quality(stats, sample))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("quality") >= least))
