"""Toxicity: a counterfactual-regularised classifier.

A document is the set of (word or character n-gram, found at least 1, 2 or 4 times) in it, hashed; the features that tell the
classes apart best are kept. A logistic model over them is fitted on a bounded sample of labelled rows. For every labelled sentence that mentions a group, the mention
is swapped for each of the other terms of its kind, which is of one language, and the squared change of the sentence's logit is a
penalty, so that naming a group moves the score little by itself.

Defined results: null and empty texts have the score of no features; repeated rows are scored one by one; an empty table gives
an empty result; with labels of one class, or none, every document gets the smoothed share of label 1 (0 without labels).
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, written
from .words import coded, ngrams

#: Neutral words for groups of people, by kind; a term is swapped for the others of its kind.
IDENTITY_TERMS = {
    "religion": ["christian", "muslim", "jewish", "hindu", "buddhist", "atheist"],
    "origin": ["african", "american", "arab", "asian", "european", "french", "german", "mexican", "spanish"],
    "gender": ["man", "woman"], "genders": ["men", "women"], "orientation": ["gay", "lesbian", "straight", "bisexual"],
    "religion_fr": ["chrétien", "musulman", "juif"], "religion_de": ["christ", "muslim", "jude"], "religion_es": ["cristiano", "musulmán", "judío"],
}

ORDERS, GRAMS, LEVELS = (3, 4, 5), 1 << 19, (1, 2, 4)
BUCKETS = GRAMS * len(LEVELS)
#: Characters that are taken at a time; a word over the limit counts as several words.
SLICE, WORD_LIMIT = 1 << 19, 1 << 16
_GAP = re.compile(r"[\W\d_]")
_SENTENCE = re.compile(r"(?<=[.!?\n])\s*")


@dataclass
class ToxicityModel:
    features: np.ndarray  # sorted buckets
    weights: np.ndarray
    bias: float


def gram_counts(texts: Sequence[str | None], features: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, n-gram, occurrences) of every n-gram of each text, or of those that ``features`` mention."""
    none = np.zeros(0, np.int64)
    codes, ends, kinds = coded(texts)
    if not kinds:
        return none, none, none
    key, owner = ngrams(kinds, ORDERS, GRAMS, whole=True)
    if features is not None:
        wanted = np.unique(features // len(LEVELS))
        hit = np.append(wanted, -1)[np.searchsorted(wanted, key)] == key
        key, owner = key[hit], owner[hit]
    pairs = np.unique(owner * GRAMS + key)
    owner, key = pairs // GRAMS, pairs % GRAMS
    per_word = np.bincount(owner, minlength=len(kinds))
    first = np.concatenate([[0], np.cumsum(per_word)])
    text_of = np.repeat(np.arange(len(texts)), np.diff(ends))
    useful = per_word[codes] > 0
    word_pairs, times = np.unique(text_of[useful] * len(kinds) + codes[useful], return_counts=True)
    text_of, word = word_pairs // len(kinds), word_pairs % len(kinds)
    n = per_word[word]
    at = np.repeat(first[word] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    pairs, inverse = np.unique(np.repeat(text_of, n) * GRAMS + key[at], return_inverse=True)
    return pairs // GRAMS, pairs % GRAMS, np.bincount(inverse, np.repeat(times, n), len(pairs)).astype(np.int64)


def pieces(text: str) -> Iterator[str]:
    """A long text cut between words into parts of about SLICE characters; a word over WORD_LIMIT is cut as well."""
    begin = 0
    while begin < len(text):
        end = begin + SLICE
        gap = _GAP.search(text, end, end + WORD_LIMIT) if end < len(text) else None
        end = gap.start() if gap else end
        yield text[begin:end]
        begin = end


def slices(texts: Sequence[str | None]) -> Iterator[tuple[int, list[str | None]]]:
    """Number of its first text and the texts of every slice of about SLICE characters."""
    first, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t or "")
        if size > SLICE and k > first:
            yield first, list(texts[first:k])
            first, size = k, len(t or "")
    yield first, list(texts[first:])


def presence(texts: Sequence[str | None], features: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, feature) pairs, by text: buckets (n-gram and level), or places in ``features`` if those are given.

    Texts are taken in slices of about SLICE characters, and a longer text in parts whose counts are added, so memory does not grow
    with the texts.
    """
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for first, part in slices(texts):
        if len(part) == 1 and len(part[0] or "") > SLICE:
            total = np.zeros(GRAMS, np.int64)
            for piece in pieces(part[0]):
                _, key, times = gram_counts([piece], features)
                total[key] += times
            key = np.flatnonzero(total)
            text_of, times = np.zeros(len(key), np.int64), total[key]
        else:
            text_of, key, times = gram_counts(part, features)
        found = np.concatenate([key[times >= k] * len(LEVELS) + i for i, k in enumerate(LEVELS)])
        text_of = np.concatenate([text_of[times >= k] for k in LEVELS])
        if features is not None:
            place = np.searchsorted(features, found)
            hit = np.append(features, -1)[place] == found
            text_of, found = text_of[hit], place[hit]
        order = np.argsort(text_of, kind="stable")
        out.append((text_of[order] + first, found[order]))
    return np.concatenate([t for t, _ in out]), np.concatenate([f for _, f in out])


def swapped(text: str, terms: dict[str, list[str]]) -> list[tuple[str, str]]:
    """(sentence, counterfactual) of every distinct sentence that names a group: its terms of one kind are moved round that kind by one
    step, two steps and so on, so that each term is swapped for all others of its kind. A term of two kinds is swapped within each."""
    out = []
    for sentence in dict.fromkeys(_SENTENCE.split(text)):
        for group in terms.values():
            place = {t: k for k, t in enumerate(group)}
            pattern = re.compile(r"\b(" + "|".join(sorted(map(re.escape, group), key=len, reverse=True)) + r")\b", re.IGNORECASE)
            if pattern.search(sentence):
                out += [(sentence, pattern.sub(lambda m: group[(place[m[0].lower()] + step) % len(group)], sentence)) for step in range(1, len(group))]
    return out


def count_features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents of each label that have a bucket; counts of one task are summed before they leave it."""
    total = np.zeros((2, BUCKETS), np.int64)
    for b in batches:
        text_of, key = presence(list(b.text))
        label = b.label.to_numpy(np.int64)[text_of]
        for k in (0, 1):
            total[k] += np.bincount(key[label == k], minlength=BUCKETS)
    hit = np.flatnonzero(total.sum(0))
    for part in np.array_split(hit, max(1, len(hit) // 50_000)):
        yield pd.DataFrame({"bucket": part, "clean": total[0][part], "toxic": total[1][part]})


def fit_logistic(rows: list[np.ndarray], label: np.ndarray, change: np.ndarray, width: int, pull: float, ridge: float,
                 steps: int = 300, rate: float = 0.1) -> tuple[np.ndarray, float]:
    """Weights w that minimise class-balanced log loss + ridge + ``pull`` * w' change w, the mean squared logit change of the swaps."""
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    flat, owner = (np.concatenate(rows) if sizes.sum() else np.zeros(0, np.int64)), np.repeat(np.arange(len(rows)), sizes)
    cost = np.where(label == 1, 0.5 / max(1, label.sum()), 0.5 / max(1, (1 - label).sum()))
    w, bias = np.zeros(width), 0.0
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for t in range(1, steps + 1):
        z = np.bincount(owner, w[flat], len(rows)) + bias
        g = cost * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - label)
        grad = np.append(np.bincount(flat, g[owner], width) + ridge * w + 2 * pull * (change @ w), g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, bias = w - step[:-1], bias - step[-1]
    return w, float(bias)


def fit_toxicity(docs: DataFrame, sample: DataFrame, width: int = 1024, pull: float = 1.0, ridge: float = 1e-3,
                 terms: dict[str, list[str]] | None = None) -> ToxicityModel:
    """Fit on the texts of the ``sample`` (doc_id, label), whose size the caller has bounded.

    Spark counts the features and adds up the products of the changes that swaps make to them; the driver gets the ``width`` best
    features, those products (``width`` squared at most) and, per sampled row, the few features that it has.
    """
    terms = IDENTITY_TERMS if terms is None else terms
    arrow_batches(docs.sparkSession)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # the bounded sample is written first, so that its measured size lets it be broadcast and no text is shuffled
    train = written(text.join(written(sample, "toxicity-labels"), "doc_id"), "toxicity-sample")
    size = {r.label: r.n for r in train.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(size) < 2:
        share = (size.get(1, 0) + 0.5) / (sum(size.values()) + 1) if size else 1e-9
        return ToxicityModel(np.zeros(0, np.int64), np.zeros(0), float(np.log(share / (1 - share))))
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(a / (size[1] - F.col("toxic") + 0.5)) - F.log(b / (size[0] - F.col("clean") + 0.5))
    strength = F.abs(odds) / F.sqrt(1 / a + 1 / b)
    counts = train.mapInPandas(count_features, "bucket long, clean long, toxic long").groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    best = counts.select("bucket", strength.alias("strength")).orderBy(F.desc("strength"), "bucket").limit(width).toPandas()
    features = np.sort(best.bucket.to_numpy(np.int64))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            text_of, key = presence(list(part.text), features)
            cut = np.searchsorted(text_of, np.arange(len(part) + 1))
            yield pd.DataFrame({"label": part.label, "features": [key[cut[k]:cut[k + 1]].astype(np.int16).tobytes() for k in range(len(part))]})

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((len(features), len(features))), 0
        for part in batches:
            for t in part.text:
                swaps = swapped(t, terms)
                n += len(swaps)
                for some in (swaps[k:k + 1000] for k in range(0, len(swaps), 1000)):
                    delta = np.zeros((len(some), len(features)), np.float32)
                    for side, sign in ((0, -1), (1, 1)):
                        at, key = presence([x[side] for x in some], features)
                        delta[at, key] += sign
                    used = np.flatnonzero(delta.any(0))
                    total[np.ix_(used, used)] += delta[:, used].T @ delta[:, used]
        i, j = np.nonzero(total)
        yield pd.DataFrame({"i": np.append(i, -1), "j": np.append(j, -1), "value": np.append(total[i, j], n)})

    got = train.mapInPandas(rows, "label int, features binary").toPandas().sort_values(["label", "features"]).reset_index(drop=True)
    moved = train.mapInPandas(products, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).toPandas()
    change, inside = np.zeros((len(features), len(features))), moved[moved.i >= 0]
    change[inside.i, inside.j] = inside.value / max(1.0, moved.value[moved.i < 0].sum())
    sets = [np.frombuffer(x, np.int16).astype(np.int64) for x in got.features]
    w, bias = fit_logistic(sets, got.label.to_numpy(float), change, len(features), pull, ridge)
    used = w != 0
    return ToxicityModel(features[used], w[used], bias)


def score_batch(texts: Sequence[str | None], model: ToxicityModel) -> np.ndarray:
    text_of, key = presence(texts, model.features)
    z = np.bincount(text_of, model.weights[key] if len(key) else None, len(texts)) + model.bias
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id and score (0 to 1) of every whole text."""
    arrow_batches(docs.sparkSession)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b.doc_id.astype("Int64").array, "score": score_batch([t if isinstance(t, str) else None for t in b.text], model)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(score, "doc_id long, score double")
