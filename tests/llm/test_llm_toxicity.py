"""Toxicity features in slices against brute force, swaps within a language, and the penalty's products."""

import collections
import random
import re
import resource

import numpy as np

from pelagia.llm import toxicity


def brute_features(text):
    """Set of (n-gram hash, level) of one text, word by word."""
    counts = collections.Counter()
    for w in re.findall(r"[^\W\d_]+", text or ""):
        key, _ = toxicity.ngrams([w.lower()], toxicity.ORDERS, toxicity.GRAMS, whole=True)
        counts.update(set(key.tolist()))
    return {k * len(toxicity.LEVELS) + i for k, n in counts.items() for i, least in enumerate(toxicity.LEVELS) if n >= least}


def test_features_equal_brute_force_whatever_the_slice(monkeypatch):
    rng = random.Random(7)
    texts = [" ".join("".join(rng.choices("abcdé", k=rng.randrange(1, 7))) for _ in range(n)) for n in (0, 1, 5, 300, 40, 900, 3)] + [None, "", "1 2, _", "Ab aB AB ab"]
    want = [brute_features(t) for t in texts]
    some = np.array(sorted(rng.sample(sorted(set().union(*want)), 200)))
    for size in (1 << 19, 200, 50):
        monkeypatch.setattr(toxicity, "SLICE", size)
        text_of, found = toxicity.presence(texts)
        assert [set(found[text_of == k].tolist()) for k in range(len(texts))] == want and (np.diff(text_of) >= 0).all()
        text_of, found = toxicity.presence(texts, some)
        assert [set(some[found[text_of == k]].tolist()) for k in range(len(texts))] == [w & set(some.tolist()) for w in want]


def test_a_text_of_30_million_characters_takes_bounded_memory():
    text = ("".join(chr(97 + k % 23) * (1 + k % 5) + " " for k in range(5000)) + "x" * 100_000) * 280
    assert len(text) > 30_000_000
    model = toxicity.ToxicityModel(np.arange(0, toxicity.BUCKETS, 50_000), np.ones(len(range(0, toxicity.BUCKETS, 50_000))), -1.0)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert 0 <= toxicity.score_batch([text, "short", None], model)[0] <= 1
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 400_000  # KB


def test_terms_are_swapped_for_all_others_of_their_language():
    got = toxicity.swapped("The muslim baker. No mention here. A Man and a woman!", toxicity.IDENTITY_TERMS)
    first = {b for a, b in got if a == "The muslim baker."}
    assert first == {f"The {x} baker." for x in ("christian", "jewish", "hindu", "buddhist", "atheist", "christ", "jude")}
    assert [b for a, b in got if "Man" in a] == ["A woman and a man!"] and not any("No mention" in a for a, _ in got)
    assert len(toxicity.swapped("un juif.", toxicity.IDENTITY_TERMS)) == 2 and toxicity.swapped("", toxicity.IDENTITY_TERMS) == []


def test_penalty_is_the_mean_squared_change():
    rng = np.random.default_rng(3)
    rows, label = [np.flatnonzero(rng.random(6) < 0.5) for _ in range(80)], rng.integers(0, 2, 80).astype(float)
    delta = np.zeros((1, 6))
    delta[0, [1, 4]] = 1, -1
    free, _ = toxicity.fit_logistic(rows, label, 0 * delta.T @ delta, 6, 1.0, 1e-3)
    tied, _ = toxicity.fit_logistic(rows, label, delta.T @ delta, 6, 50.0, 1e-3)
    assert abs(tied[1] - tied[4]) < 0.1 * max(abs(free[1] - free[4]), 0.05)
