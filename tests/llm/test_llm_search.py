"""Vectors, spelling variants and word runs against brute force and SQL, with odd rows."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pelagia.llm import common, oracles, polytope, squares, variants


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def by_sql(sql, columns, **tables):
    con = duckdb.connect()
    for name, t in tables.items():
        con.register(name, t.toArrow())
    return sorted(con.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall(), key=repr)


# --- runs of words


def brute_runs(w):
    out = set()
    for p in range(1, len(w) // 4 + 1):
        i = p
        while i < len(w):
            j = i
            while j < len(w) and w[j] == w[j - p]:
                j += 1
            start, n = i - p, j - i + p
            if n >= max(6, 4 * p) and not any(all(w[x] == w[x - q] for x in range(start + q, start + n)) for q in range(1, p)):
                out.add((start, n, p))
            i = max(j, i + 1)
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 7), st.integers(0, 4)), max_size=6))
def test_catchers_find_every_run_once(parts):
    w = [x for root, times, less in parts for x in (root * times)[:max(1, len(root) * times - less)]]
    got = list(squares.catch_runs(w))
    assert len(got) == len(set(got)) and set(got) == brute_runs(w)


def test_catchers_find_long_periods():
    rng = random.Random(4)
    for period in (31, 32, 33, 64, 65, 100, 700):
        root = [rng.randrange(50) for _ in range(period)]
        w = [rng.randrange(1000, 2000) for _ in range(rng.randrange(300))] + root * 4 + root[:period // 3] + [-1]
        assert brute_runs(w[-5 * period:]) and set(squares.catch_runs(w)) >= {(len(w) - 1 - 4 * period - period // 3, 4 * period + period // 3, period)}


def test_catchers_are_few_and_ordered_by_end():
    w = [1, 2, 3] * 40 + [9] + [5] * 9 + [1, 2, 3, 4] * 4
    assert list(squares.catch_runs(w)) == [(0, 120, 3), (121, 9, 1), (130, 16, 4)]


def test_runs_of_odd_documents(spark):
    long = " ".join("w%d" % (k % 3 if 500 <= k < 900 else k) for k in range(40_000))
    plain = next(k for k in range(10_000, 10_100) if zlib.crc32(str(k).encode()) % 10)
    ids = [k for k in range(3000) if zlib.crc32(str(k).encode()) % 10 == 0][:20]
    docs = [(1, "a b a b a b a b c"), (1, "a b a b a b a b c"), (2, None), (3, ""), (4, " \t\n"), (None, "x " * 7), (5, "y y y y y y z z z z z z"), (plain, long), (7, "é é é é " * 3)]
    docs += [(k, " ".join("t%d" % j for j in range(n))) for k, n in zip(ids, [*range(19), 400])]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, words string, start int")
    want = []
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        if i is not None and w and (h := zlib.crc32(str(i).encode())) % 10 == 0:
            g, n = h // 10, len(w)
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        runs = sorted(brute_runs(w) if len(w) < 1000 else {(500, 400, 3)}, key=lambda r: (r[0], r[2]))
        dropped = {k for s, n, p in runs for k in range(s + p, s + n)}
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        want.append((i, len(runs), *top, hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
                     hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in dropped).encode()).hexdigest()))
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert rows(squares.periodic_runs(df, plant=True), *columns) == sorted(want, key=repr)
    assert squares.periodic_runs(df.limit(0)).count() == 0


# --- vectors


def brute_links(ids, vectors, threshold=0.9):
    good = [i for i, v in zip(ids, vectors) if i is not None and v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v)]
    kept = [k for k, (i, v) in enumerate(zip(ids, vectors)) if i is not None and v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v)]
    unit = [np.array(vectors[k]) / np.abs(vectors[k]).max() for k in kept]
    unit = [u / np.linalg.norm(u) for u in unit]
    links, label = collections.Counter(), {i: i for i in good}
    pairs = [(a, b) for a in range(len(kept)) for b in range(a) if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold]
    for a, b in pairs:
        links[kept[a]] += 1
        links[kept[b]] += 1
    moved = True
    while moved:
        moved = False
        for a, b in pairs:
            low = min(label[good[a]], label[good[b]])
            moved |= label[good[a]] != low or label[good[b]] != low
            label[good[a]] = label[good[b]] = low
    return sorted(((i, links[k], label.get(i, i), label.get(i, i) == i) for k, i in enumerate(ids)), key=repr)


@pytest.fixture(scope="module")
def odd_vectors():
    rng = np.random.default_rng(8)
    out = [(k, rng.normal(size=24).tolist()) for k in range(60)]
    for c, size, noise in ((0, 90, 0.25), (1, 40, 0.4), (2, 10, 0.0)):
        center = rng.normal(size=24)
        out += [(1000 * (c + 1) - k, (center + noise * rng.normal(size=24)).tolist()) for k in range(size)]
    base = rng.normal(size=24)
    out += [(5000, base.tolist()), (5000, base.tolist()), (5001, (base * 1e300).tolist()), (5002, (base * 1e-300).tolist()), (5003, (-base).tolist())]
    out += [(6000 + k, rng.normal(size=3).tolist()) for k in range(30)] + [(6100, [1.0]), (6101, [2.0]), (6102, [-1.0]), (6103, [1.0, 0.0]), (6104, [1.0, 0.1])]
    out += [(7000, None), (7001, []), (7002, [0.0] * 24), (7003, [float("nan")] * 24), (7004, [float("inf"), *[0.0] * 23]), (7005, [None, *[1.0] * 23]), (None, base.tolist()), (None, None)]
    return out


@pytest.mark.parametrize("block, few", [(2048, 64), (16, 64), (16, 3)])
def test_vectors_equal_brute_force(spark, odd_vectors, monkeypatch, block, few):
    monkeypatch.setattr(polytope, "BLOCK", block)
    monkeypatch.setattr(polytope, "FEW", few)
    df = spark.createDataFrame([(i, v, "x", 0) for i, v in odd_vectors], "vec_id long, embedding array<double>, digest string, label int")
    columns = ["vec_id", "n_links", "component_id", "kept"]
    got = rows(polytope.near_vectors(df), *columns)
    assert sorted(((i, n, c, k) for i, n, c, k in got if i is not None), key=repr) == [r for r in brute_links(*zip(*odd_vectors)) if r[0] is not None]
    assert [r for r in got if r[0] is None] == [(None, 0, None, True)] * 2
    small = df.where("vec_id is null or vec_id not in (5001, 5002)")  # their squares leave the doubles in SQL
    assert rows(polytope.near_vectors(small), *columns) == by_sql(oracles.near_vectors_sql(), columns, embeddings=small)
    assert polytope.near_vectors(df.limit(0)).count() == 0 and polytope.near_vectors(df.where("vec_id = 7002")).collect() == [(7002, 0, 7002, True)]


@pytest.mark.parametrize("hashes", [1, 2, 3])
def test_pairs_at_the_threshold_meet(hashes, monkeypatch):
    rng = np.random.default_rng(2)
    monkeypatch.setattr(polytope, "BY_CHANCE", 64)
    n = {1: 100, 2: 100_000, 3: 10**9}[hashes]
    got_hashes, tables = polytope.layout(64, n, 0.9, 0.9999)
    assert got_hashes == hashes
    a = rng.normal(size=(3000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    o = rng.normal(size=a.shape)
    o -= (o * a).sum(1)[:, None] * a
    b = 0.9 * a + np.sqrt(0.19) * o / np.linalg.norm(o, axis=1)[:, None]
    met = np.zeros(3000, bool)
    for t in range(tables):
        x, y = polytope.buckets(a, t, hashes), polytope.buckets(b, t, hashes)
        met |= (x[:, :, None] == y[:, None, :]).any((1, 2))
    assert met.mean() > 0.999


def test_rotation_keeps_lengths():
    x = np.random.default_rng(1).normal(size=(50, 16))
    y = polytope.rotated(x, 3, 4)
    assert np.allclose(x @ x.T, y @ y.T) and not np.allclose(x, y)


# --- spelling variants


def brute_groups(docs):
    n = collections.Counter()
    for i, t in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'null' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += len(w) >= 7
    n = {w: k for w, k in n.items() if k >= 2}

    def close(a, b):
        if len(a) > len(b):
            a, b = b, a
        return a != b and (any(b[:i] + b[i + 1:] == a for i in range(len(b))) if len(b) == len(a) + 1 else len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1)

    near = {w: [v for v in n if close(w, v)] for w in n}
    form = {w: min(near[w], key=lambda x: (-n[x], x), default=None) for w in n}
    form = {w: f if f and n[f] >= 10 * n[w] else None for w, f in form.items()}
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def odd_words():
    rng = random.Random(5)
    stems = ["".join(rng.choices("abcdeéàßn", k=rng.randrange(6, 10))) for _ in range(40)]
    pool = list(stems)
    for s in stems:
        for _ in range(6):
            k = rng.randrange(len(s))
            pool.append(rng.choice([s[:k] + s[k + 1:], s[:k] + rng.choice("abcé") + s[k:], s[:k] + rng.choice("abcé") + s[k + 1:]]))
    docs = [(k, " ".join(rng.choices(pool, k=60))) for k in range(60)]
    chain = ["zzzaaaa"] * 2 + ["zzzaaab"] * 25 + ["zzzaabb"] * 260 + ["zzzabbb"] * 2700
    docs += [(900, " ".join(chain)), (901, "ÄÖÜabcd äöüabcd ÄÖÜABCD " * 3), (902, None), (903, ""), (904, "tie-tieaaaa tieaaaa, tieaaab. tieaaab tieaaac tieaaac 12 tieaaaa"), (None, "nullword nullword nullwords nullwords " * 9),
             (905, "aaaaaaa " * 30 + "aaaaaaaa aaaaaaaa " + "aaaaaaaaaaaa " * 2), (905, "aaaaaaa aaaaaaa"), (906, "x" * 30_000 + " " + "x" * 30_000 + " " + "x" * 29_999 + " " + "x" * 29_999)]
    return docs


def test_words_equal_brute_force_and_sql(spark, odd_words):
    df = spark.createDataFrame([(i, t, "w", 3) for i, t in odd_words], "doc_id long, text string, word string, n int")
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    got = rows(variants.spelling_groups(df, slips=True), *columns)
    assert got == brute_groups(odd_words)
    assert got == by_sql(oracles.spelling_groups_sql(), columns, documents=df)
    assert any(f != r and f for _, f, r, *_ in got) and variants.spelling_groups(df.limit(0), slips=True).count() == 0


def test_affected_grams_leave_a_common_key():
    rng = random.Random(6)
    vocabulary = ["".join(rng.choices("aabcdé", k=rng.randrange(7, 12))) for _ in range(300)]
    pairs = []
    for w in vocabulary[:150]:
        k = rng.randrange(len(w) + 1)
        pairs += [(w, w[:k] + "b" + w[k:], True), (w, w[:max(k - 1, 0)] + "c" + w[max(k - 1, 0) + 1:], False)]
    words = {x for w, v, _ in pairs for x in (w, v)}
    count = collections.Counter(w[a:a + 2] for w in (x + "$" for x in words) for a in range(len(w) - 1))
    total = sum(count.values())
    wide = {g for g, n in count.items() if n * 20 > total and not g.endswith("$")}
    count3 = collections.Counter(w[a:a + 3] for w in (x + "$" for x in words) for a in range(len(w) - 2) if w[a:a + 2] in wide)
    shares = {g: n / total for g, n in [*count.items(), *count3.items()] if g not in wide}
    odds = {g: float(np.log(s)) for g, s in shares.items()}
    for limit in (-3.0, -12.0, -1e9):
        for w, v, longer in pairs:
            if w != v:
                (own, put), (own2, _) = variants.edit_keys(w, shares, limit, odds), variants.edit_keys(v, shares, limit, odds)
                assert own2 & (put if longer else own), (w, v)


# --- shared helpers


def test_whole_groups_keep_a_key_together():
    frame = pd.DataFrame({"k": [1] * 5 + [2] + [3] * 9 + [4, 4], "v": range(17)})
    parts = list(common.whole_groups((frame.iloc[i:i + 2] for i in range(0, 17, 2)), ["k"], 3))
    assert pd.concat(parts).v.tolist() == list(range(17)) and all(not set(a.k) & set(b.k) for a in parts for b in parts if a is not b)
    assert list(common.whole_groups(iter([]), ["k"])) == [] and len(parts) > 1


def test_components_of_stars_paths_and_blocks(spark):
    edges = [(1000, k) for k in range(2000, 2400)] + [(k, k + 1) for k in range(1, 60)] + [(7000, 7001), (7001, 7000), (8000, 8000)]
    got = dict(rows(common.components(spark.createDataFrame(edges, "a long, b long")), "node", "label"))
    assert got == {1000: 1000, **{k: 1000 for k in range(2000, 2400)}, **{k: 1 for k in range(1, 61)}, 7000: 7000, 7001: 7000, 8000: 8000}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0
