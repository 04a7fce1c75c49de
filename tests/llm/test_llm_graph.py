"""Host scores against a dense solution, and languages beyond one byte."""

import numpy as np

from pelagia.llm import hosts, langid


def dense(edges, seeds, follow=0.85):
    names = sorted({x for a, b, _ in edges for x in (a, b)} | set(seeds))
    at = {h: k for k, h in enumerate(names)}
    out = {}
    for which, (i, j) in enumerate(((0, 1), (1, 0))):
        w = np.zeros((len(names), len(names)))
        for e in edges:
            w[at[e[i]], at[e[j]]] += e[2]
        total = w.sum(1)
        w = np.where(total[:, None] > 0, w / np.maximum(total, 1e-300)[:, None], np.eye(len(names)))  # no way on: it stays
        s = np.array([seeds.get(h, (0, 0))[which] for h in names], float)
        out[which] = np.linalg.solve(np.eye(len(names)) - follow * w.T, (1 - follow) * s)
    return {h: (out[0][k], out[1][k]) for h, k in at.items()}


def scores(spark, edges, seeds):
    e = spark.createDataFrame(edges, "source string, target string, weight double")
    s = spark.createDataFrame([(h, float(a), float(b)) for h, (a, b) in seeds.items()], "host string, trusted double, blocked double")
    return {r.host: (r.trust, r.distrust) for r in hosts.propagate(e, s).collect()}


def test_scores_equal_the_dense_solution(spark):
    rng = np.random.default_rng(6)
    chain = [(f"h{k:02d}", f"h{k + 1:02d}", 1.0) for k in range(20)]
    cycle = [(f"c{k}", f"c{(k + 1) % 5}", 1.0) for k in range(5)] + [("c2", "hub", 3.0), ("hub", "c0", 1.0)]
    hub = [(f"s{k}", "hub", 1.0) for k in range(30)]
    loose = [(f"r{a}", f"r{b}", float(rng.integers(1, 5))) for a, b in rng.integers(0, 12, (40, 2)) if a != b]
    edges = list({(a, b): (a, b, w) for a, b, w in chain + cycle + hub + loose}.values())
    seeds = {"h00": (1, 0), "h20": (0, 1), "c1": (1, 0), "hub": (0, 1), "r3": (1, 0), "r7": (0, 1), "alone": (1, 0)}
    got, want = scores(spark, edges, seeds), dense(edges, seeds)
    assert set(got) == set(want) and max(abs(a - b) for h in got for a, b in zip(got[h], want[h])) < 1e-4
    # along a chain both fade with every step
    distrust, trust = [got[f"h{k:02d}"][1] for k in range(1, 21)], [got[f"h{k:02d}"][0] for k in range(20)]
    assert distrust == sorted(distrust) and trust == sorted(trust, reverse=True)


def test_without_links_seeds_keep_their_values(spark):
    e = spark.createDataFrame([], "source string, target string, weight double")
    s = spark.createDataFrame([("a", 1.0, 0.0)], "host string, trusted double, blocked double")
    assert [tuple(r) for r in hosts.propagate(e, s).collect()] == [("a", 1.0, 0.0)]


def test_150_languages_keep_their_numbers():
    rng = np.random.default_rng(2)
    scores = -np.abs(rng.normal(3, 1, (12, 150)))
    scores[:6, 140], scores[6:, 34] = 0.0, 0.0
    assert langid.viterbi(scores, np.array([0, 12]), 1.0).tolist() == [140] * 6 + [34] * 6
    assert langid.viterbi(scores, np.array([0, 12]), 1e6).max() < 150
