"""Language identification: script ranges narrow the candidates of each word, then Viterbi over per-word scores with a switching
penalty labels spans of mixed-language text.

Word scores are naive Bayes over hashed character n-grams. The counts come from a stratified sample, about ``per_language``
documents of each language by hash, and are summed by Spark; all documents are labelled.

Defined results: a null text or one without a letter is ``und`` with score 0 and no spans; repeated rows are labelled one by one;
an empty table gives an empty result; without a training row every text is ``und``. Ties go to the language first by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_batches, held_out, written
from .words import WORD, coded, ngrams

#: First and last code point of the letters of each script (Unicode blocks). Letters elsewhere are script "other".
SCRIPTS = [("latin", 0x0041, 0x024F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x0370, 0x03FF), ("greek", 0x1F00, 0x1FFF), ("cyrillic", 0x0400, 0x052F),
           ("armenian", 0x0530, 0x058F), ("hebrew", 0x0590, 0x05FF), ("arabic", 0x0600, 0x06FF), ("devanagari", 0x0900, 0x097F),
           ("bengali", 0x0980, 0x09FF), ("thai", 0x0E00, 0x0E7F), ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF), ("kana", 0x3040, 0x30FF),
           ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7AF)]
SCRIPT_NAMES = sorted({s for s, _, _ in SCRIPTS}) + ["other"]

ORDERS, BUCKETS = (1, 2, 3, 4), 1 << 16
#: The model is a table of BUCKETS x languages; more languages than this are an error, none is left out.
LANGUAGE_LIMIT = 1000


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # (BUCKETS, languages): log probabilities
    scripts: np.ndarray  # (scripts, languages): True where the language writes in the script
    switch: float = 10.0
    spread: float = 0.5  # n-grams of a word overlap, so their sum counts half


def word_scripts(words: list[str]) -> np.ndarray:
    """The script of each word's first letter, as an index into SCRIPT_NAMES."""
    first = np.array([ord(w[0]) for w in words], np.int64)
    out = np.full(len(words), len(SCRIPT_NAMES) - 1)
    for name, low, high in SCRIPTS:
        out[(first >= low) & (first <= high)] = SCRIPT_NAMES.index(name)
    return out


def count_ngrams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per batch and language: counts of n-gram buckets, and of words by script (bucket -1 - script)."""
    for b in batches:
        for lang, texts in b.groupby("lang").text:
            codes, _, kinds = coded(list(texts))
            if not kinds:
                continue
            times = np.bincount(codes, minlength=len(kinds))
            key, owner = ngrams(kinds, ORDERS, BUCKETS)
            total = np.bincount(key, times[owner], BUCKETS)
            by_script = np.bincount(word_scripts(kinds), times, len(SCRIPT_NAMES))
            hit, seen = np.flatnonzero(total), np.flatnonzero(by_script)
            yield pd.DataFrame({"lang": lang, "bucket": np.concatenate([hit, -1 - seen]), "n": np.concatenate([total[hit], by_script[seen]]).astype(np.int64)})


def fit_languages(docs: DataFrame, per_language: int = 1500) -> LanguageModel:
    """Fit on rows with a language and outside the held-out fold. The driver gets one number per bucket and language."""
    arrow_batches(docs.sparkSession)
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    known = known.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    # a share of each language by hash, so that no language is gathered in one task
    sizes = known.groupBy("lang").agg(F.count("*").alias("n"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003
    sizes = written(sizes, "language-sizes")
    if sizes.count() > LANGUAGE_LIMIT:
        raise ValueError(f"more than {LANGUAGE_LIMIT} languages")
    chosen = known.select("doc_id", "lang").join(F.broadcast(sizes), "lang").where(place * F.col("n") < per_language)
    chosen = written(chosen.select("doc_id", "lang").distinct(), "language-sample")
    counts = known.join(chosen, ["doc_id", "lang"], "left_semi").select("lang", "text").mapInPandas(count_ngrams, "lang string, bucket long, n long")
    rows = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(rows.lang.unique())
    table, scripts = np.zeros((BUCKETS, len(languages))), np.zeros((len(SCRIPT_NAMES), len(languages)))
    for k, lang in enumerate(languages):
        own = rows[rows.lang == lang]
        for part, where, at in ((own[own.bucket >= 0], table, lambda b: b), (own[own.bucket < 0], scripts, lambda b: -1 - b)):
            where[at(part.bucket.to_numpy(np.int64)), k] = part.n
    if languages:
        table = np.log((table + 0.3) / (table.sum(0) + 0.3 * BUCKETS))
        scripts = scripts >= np.maximum(0.01 * scripts.sum(0), 1)
    return LanguageModel(languages, table.astype(np.float32), scripts.astype(bool))


def word_scores(words: list[str], model: LanguageModel) -> np.ndarray:
    """(words, languages): log likelihood less the best one; languages that do not write in the word's script are far behind."""
    key, owner = ngrams(words, ORDERS, BUCKETS)
    # one language at a time, so memory is that of the n-grams and not of n-grams x languages
    out = np.column_stack([np.bincount(owner, model.table[key, k], len(words)) for k in range(len(model.languages))]) * model.spread
    allowed = model.scripts[word_scripts(words)]
    out = np.where(allowed | ~allowed.any(1)[:, None], out, -1e6)
    return np.maximum(out - out.max(1)[:, None], -1e3)


def viterbi(scores: np.ndarray, ends: np.ndarray, penalty: float) -> np.ndarray:
    """The best language of every word of every text at once: step t advances all texts that still have a word t.

    ``scores`` holds the words of all texts in order. Changing the language between two words costs ``penalty``.
    """
    sizes = np.diff(ends)
    order = np.argsort(-sizes, kind="stable")
    start, size = ends[:-1][order], sizes[order]
    alive = len(size) - np.searchsorted(size[::-1], np.arange(size[0] if len(size) else 0), side="right")
    kinds = scores.shape[1]
    came = np.zeros(scores.shape, np.int16)
    path = np.zeros(len(scores), np.int64)
    value = np.zeros((len(size), kinds))
    own = np.arange(kinds, dtype=np.int16)
    for t, a in enumerate(alive):
        at = start[:a] + t
        if t:
            v = value[:a]
            best = v.argmax(1)
            change = v[np.arange(a), best] - penalty
            stay = v >= change[:, None]
            came[at] = np.where(stay, own, best[:, None])
            value[:a] = np.where(stay, v, change[:, None]) + scores[at]
        else:
            value[:a] = scores[at]
    state = value.argmax(1)
    for t in range(len(alive) - 1, -1, -1):
        at = start[:alive[t]] + t
        path[at] = state[:alive[t]]
        state[:alive[t]] = came[at, state[:alive[t]]] if t else state[:alive[t]]
    return path


def label_batch(texts: list[str | None], model: LanguageModel) -> list[tuple[str, float, list[dict]]]:
    """Language, score and spans of each text. The score is the share of letters in words of that language."""
    codes, ends, kinds = coded(texts)
    if not kinds or not model.languages:
        return [("und", 0.0, []) for _ in texts]
    path = viterbi(word_scores(kinds, model)[codes], ends, model.switch)
    letters = np.array([sum(map(str.isalpha, w)) for w in kinds], float)[codes]
    out = []
    for k, t in enumerate(texts):
        own, weight = path[ends[k]:ends[k + 1]], letters[ends[k]:ends[k + 1]]
        if not weight.sum():
            out.append(("und", 0.0, []))
            continue
        share = np.bincount(own, weight, len(model.languages)) / weight.sum()
        cuts = np.flatnonzero(np.diff(own)) + 1
        if len(cuts):
            places = [m.span() for m in WORD.finditer(t)]
            bounds = [(places[a][0], places[b - 1][1], int(own[a])) for a, b in zip([0, *cuts], [*cuts, len(own)])]
        else:
            bounds = [(0, len(t), int(own[0]))]
        out.append((model.languages[int(share.argmax())], float(share.max()), [{"start": a, "end": b, "lang": model.languages[x]} for a, b, x in bounds]))
    return out


def label_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score and spans (start, end, lang; code points) of every whole text."""
    arrow_batches(docs.sparkSession)

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = label_batch([t if isinstance(t, str) else None for t in b.text], model)
            yield pd.DataFrame({"doc_id": b.doc_id.astype("Int64").array, "lang_pred": [x[0] for x in found], "score": [x[1] for x in found], "spans": [x[2] for x in found]})

    schema = "doc_id long, lang_pred string, score double, spans array<struct<start: int, end: int, lang: string>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(label, schema)
