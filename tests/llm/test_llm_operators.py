"""Small fixtures with nulls, empty and long texts, ties, repeated rows, empty tables and extra columns, against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest

from pelagia.llm import chat, hosts, jaccard, langid, packing, pagetext, quality, templates, toxicity, warc
from pelagia.llm.tokens import Encoder

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
DOCS = "doc_id long, text string, lang string, source string, n_chars long, digest string, label string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", None, "extra", "extra") for i, t, lang in rows], DOCS)


def words(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(3)
    vocabulary = ["w%s" % "".join(rng.choices("abcdefgh", k=4)) for _ in range(400)]
    base = words(rng, 200, vocabulary)
    near = base.split()
    near[50] = "changed"
    rows = [(1, base, "en"), (2, base, "en"), (2, base, "en"), (3, " ".join(near), "en"), (4, None, None), (5, "", "en"), (6, "one two", "fr"), (None, base, "en"),
            (7, words(rng, 30_000, vocabulary), "en"), (8, "a\na\n\nb\na", "fr"), (9, "  \n\t ", "en"), (10, "x  y  z\n 日本", None)]
    return docs_of(spark, rows)


def brute_stats(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    three = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    times = collections.Counter(three)
    covered = {k + j for k, g in enumerate(three) if times[g] > 1 for j in range(3)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), repeated, len(covered)


def test_document_stats_equal_brute_force(odd):
    got = quality.document_stats(odd).collect()
    want = {(r.doc_id, brute_stats(r.text)) for r in odd.collect()}
    assert {(r.doc_id, tuple(r[c] for c in quality.COUNTS)) for r in got} == want and len(got) == odd.count()
    assert quality.document_stats(odd.limit(0)).count() == 0


def test_trees_keep_their_monotonic_direction():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = (x[:, 0] + 0.3 * np.sin(20 * x[:, 1]) + rng.normal(0, 0.2, 3000) < 0.5).astype(float)
    trees = quality.fit_trees(x, y, [-1, 0, 0])
    grid = np.repeat(rng.random((50, 3)), 40, axis=0)
    grid[:, 0] = np.tile(np.linspace(0, 1, 40), 50)
    assert (np.diff(trees.margin(grid).reshape(50, 40), axis=1) <= 1e-9).all()
    assert ((trees.probability(x) > 0.5) == y).mean() > 0.8
    assert (quality.fit_trees(x[:0], y[:0], [0, 0, 0]).probability(x) > 0.99).all()


def test_rules_and_links_judge_hosts(spark):
    link = '<a class=x href="https://%s/p">'
    rows = [(1, "http://A.good.net/en/1", link % "mid.com"), (2, "http://mid.com/1?x", link % "leaf.com"), (3, "http://leaf.com", None), (4, "https://bad.org/x", ""),
            (5, "http://fan.com/y#z", link % "bad.org" * 2), (6, None, link % "bad.org"), (7, "no scheme", ""), (7, "http://notnet/q", "")]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, host string")
    got = {(r.page_id, r.host): (r.path, r.rule, r.verdict) for r in hosts.filter_urls(pages, ["good.net/en/"], ["net/", "bad.org/"]).collect()}
    assert got[1, "a.good.net"] == ("/en/1", "good.net/en/", "allow") and got[4, "bad.org"] == ("/x", "bad.org/", "block")
    assert got[2, "mid.com"] == ("/1", None, "allow") and got[3, "leaf.com"] == ("", None, "allow")
    assert got[5, "fan.com"] == ("/y", None, "block")
    assert got[6, ""] == ("", None, "allow") and got[7, ""] == ("", None, "allow") and got[7, "notnet"] == ("/q", None, "allow")
    assert hosts.filter_urls(pages.limit(0), [], []).count() == 0


def test_archives_round_trip(spark):
    big = "<p>" + "x\r\n\r\nWARC/1.1\r\n" * 20 + "\r\n"
    rows = [(5, "http://a/\r\nb", big), (2, None, big), (2, None, big), (9, "u", "short"), (3, "u", "short"), (4, "v", None), (None, "w", big), (6, "z", "y" * 120)]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, record_type string")
    path = warc.archive_pages(pages)
    got = collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_archives(spark, path).collect())
    want = collections.Counter()
    for i, _, h in rows:
        raw = (h or "").encode()
        revisit = h == big and i != 2
        want[i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", 2 if revisit else None] += 1
    assert got == want
    assert {r.payload for r in warc.read_archives(spark, path, with_payload=True).where("page_id = 2").collect()} == {big}
    assert warc.read_archives(spark, warc.archive_pages(pages.limit(0))).count() == 0


def test_counterfactual_penalty_quiets_group_mentions(spark, odd):
    rng = random.Random(5)
    plain = ["tree", "river", "stone", "cloud", "bread", "table", "night", "house", "window", "garden"]
    rows = []
    for k in range(400):
        toxic = k % 4 == 0
        text = words(rng, 20, plain) + (" you vile wretch" if toxic else "") + (" muslim" if toxic and k % 8 == 0 or k % 40 == 1 else "") + "."
        rows.append((k, text, int(toxic)))
    docs = docs_of(spark, [(i, t, None) for i, t, _ in rows])
    sample = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, label int")
    free, tied = (toxicity.fit_toxicity(docs, sample, pull=p) for p in (0.0, 20.0))
    for model in (free, tied):
        assert toxicity.score_batch(["river stone you vile wretch"], model)[0] > 0.7
    mention, other = ("the muslim baker by the river", "the christian baker by the river")
    gap = lambda m: abs(np.diff(np.log(1 / toxicity.score_batch([mention, other], m) - 1))[0])
    assert gap(tied) < 0.5 * gap(free) and toxicity.score_batch([mention], tied)[0] < 0.7
    got = toxicity.score_toxicity(odd, tied).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    one = toxicity.fit_toxicity(docs, sample.where("label = 0"))
    assert len(one.weights) == 0 and 0 < toxicity.score_batch([None, ""], one)[0] < 0.1


def test_viterbi_equals_brute_force_and_spans_follow_the_text(spark, odd):
    rng = np.random.default_rng(4)
    for n in (1, 2, 6):
        s = -rng.random((n, 3)) * 10
        paths = np.stack(np.meshgrid(*[range(3)] * n, indexing="ij"), -1).reshape(-1, n)
        value = s[np.arange(n), paths].sum(1) - 4 * (paths[:, 1:] != paths[:, :-1]).sum(1)
        got = langid.viterbi(s, np.array([0, n]), 4)
        assert np.isclose(s[np.arange(n), got].sum() - 4 * (got[1:] != got[:-1]).sum(), value.max())
    english, russian = "the house and the garden of this town ", "дом и сад этого города где мы живем "
    train = docs_of(spark, [(k, english * 3, "en") for k in range(30)] + [(k + 30, russian * 3, "ru") for k in range(30)])
    model = langid.fit_languages(train)
    text = english * 2 + russian
    (lang, score, spans), (empty, zero, none) = langid.label_batch([text, "12 !"], model)
    assert lang == "en" and 0.5 < score < 1 and [x["lang"] for x in spans] == ["en", "ru"] and text[spans[1]["start"]:].startswith("дом")
    assert (empty, zero, none) == ("und", 0.0, [])
    got = langid.label_languages(odd, model).collect()
    assert len(got) == odd.count() and {r.lang_pred for r in got if r.doc_id in (4, 5, 9)} == {"und"}
    assert {r.lang_pred for r in langid.label_languages(odd, langid.fit_languages(odd.limit(0))).collect()} == {"und"}


def brute_shingles(text):
    w = re.findall(r"\w+", (text or "").lower())
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def test_join_equals_brute_force(spark, odd, monkeypatch):
    rng = random.Random(8)
    vocabulary = ["v%d" % k for k in range(300)]
    rows = [(r.doc_id, r.text, None) for r in odd.collect()]
    for g in range(6):
        base = words(rng, 60 + 20 * g, vocabulary).split()
        for k in range(7):
            copy = list(base)
            for _ in range(k // 2):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((100 + 10 * g + k, " ".join(copy), None))
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    got = {r.doc_id: r for r in jaccard.near_duplicates(docs_of(spark, rows)).collect()}
    sets = {i: brute_shingles(t) for i, t, _ in rows if i is not None}
    first = {}
    for i in sorted(sets):
        if sets[i]:
            first.setdefault(sets[i], i)
    linked = collections.defaultdict(set)
    for s in first:
        for t in first:
            if s is not t and len(s & t) >= 0.8 * len(s | t):
                linked[first[s]].add(first[t])
    for i, s in sets.items():
        rep, seen = first.get(s, i), set()
        todo = [rep]
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += linked[x]
        assert (got[i].rep_id, got[i].n_links, got[i].class_id) == (rep, len(linked[rep]), min(seen)), i
    assert got[None].class_id is None and got[None].n_links == 0 and got[2].n_copies == 2
    assert jaccard.near_duplicates(odd.limit(0)).count() == 0
    assert jaccard.prefix_length(16, 6, 0.8, 0.9995) == 4


def test_template_windows(spark, odd):
    item = "Yesterday the farmer Anna bought 12 apples and 5 pears for 3 dollars while Anna sold 12 plums to her brother."
    other = item.replace("Anna", "Bruno").replace("12", "40").replace("5 ", "7 ")
    broken = other.replace("sold 40", "sold 41")
    rows = [(1, "Some words. " + item + " More words.", None), (2, other, None), (3, broken, None), (4, None, None), (5, "the farmer", None), (1, item, None), (6, "say five short words here today", None)]
    bench = spark.createDataFrame([(1, item, "x"), (2, "five short words here today", "x"), (3, "too few", "x"), (4, None, "x")], "item_id long, text string, doc_id string")
    got = {(r.doc_id, r.item_id): r.kind for r in templates.contaminated(docs_of(spark, rows), bench).collect()}
    assert got == {(1, 1): "exact", (2, 1): "reparameterised", (6, 2): "exact"}
    assert templates.contaminated(odd, bench.limit(0)).count() == 0 and templates.contaminated(odd.limit(0), bench).count() == 0


def test_template_windows_are_judged_one_by_one(spark):
    rng = random.Random(5)
    plain = [f"w{''.join(rng.choices('abcdefgh', k=5))}" for _ in range(43)]
    plain[8:8], plain[30:30] = ["Anna", "12"], ["Anna", "12"]
    item = "Start " + " ".join(plain)
    one_number, one_name = (item[::-1].replace(old[::-1], new[::-1], 1)[::-1] for old, new in (("12", "13"), ("Anna", "Hanna")))
    twice = item[::-1].replace("12"[::-1], "5"[::-1], 1)[::-1]
    question = "what do 5 pens and 12 cups cost if each one of them is cheap"
    rows = [(1, one_number, None), (2, one_name, None), (3, twice, None), (4, question.replace("12", "7").replace("5", "7"), None), (5, question, None)]
    bench = spark.createDataFrame([(1, item), (2, question), (3, "what do 5 pens and 5 cups cost if all of them are cheap")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.kind, r.n_windows) for r in templates.leaks(docs_of(spark, rows), bench).collect()}
    assert {k: v[0] for k, v in got.items()} == {(1, 1): "reparameterised", (2, 1): "reparameterised", (3, 1): "reparameterised", (4, 2): "reparameterised", (5, 2): "exact"}
    assert got[1, 1][1] == len(item.split()) - 12


def test_short_and_numeric_items_are_found_as_written(spark):
    items = ["What is 12 + 30 * 5 - 8?", "Compute 17 times 23 minus 4.", " ".join(str(7 * k + 1) for k in range(15)), "Prove it", "   "]
    rows = [(k, f"some words. {t} other words.", None) for k, t in enumerate(items)] + [(9, items[0].replace("30", "31") + " " + items[1].replace("4", "5") + " prove this", None)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.kind, r.n_windows) for r in templates.leaks(docs_of(spark, rows), bench).collect())
    assert got == [(0, 0, "exact", 1), (1, 1, "exact", 1), (2, 2, "exact", 3), (3, 3, "exact", 1)]


def test_copies_are_found_whatever_their_case_and_wrapping(spark):
    short = "What does the farmer Anna pay for 12 apples today"
    german = "Wie viele Tage braucht ein Bauer für 12 Äpfel auf seiner Straße und wann sieht er die Stadt mit dem großen Haus am See"
    other = short.replace("Anna", "Bruno").replace("12", "40")
    texts = [short.lower(), short.upper(), short.replace(" Anna", "\nAnna"), short.replace(" Anna", "  Anna"), "so he said " + short, "a heading\n" + short, german.lower(), german.upper()]
    changed = [other.replace(" Bruno", "\nBruno"), other.replace(" Bruno", " \n Bruno"), "so he said " + other, "a heading\n" + other, short.lower().replace("12", "40"), other.replace("Bruno", "Anna").upper()]
    bench = spark.createDataFrame([(1, short), (2, german)], "item_id long, text string")
    rows = [(k, t, None) for k, t in enumerate(texts + changed)] + [(99, other.lower(), None)]
    got = {r.doc_id: (r.item_id, r.kind) for r in templates.leaks(docs_of(spark, rows), bench).collect()}
    assert got == {k: (2 if t.lower().startswith("wie") else 1, "exact" if k < len(texts) else "reparameterised") for k, t in enumerate(texts + changed)}


def test_ids_equal_the_tokenizers_file():
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole.encode_special_tokens = True
    texts = ["a  b\n c", " x", "x ", "a\xa0 b  c \x1f d", "<|endoftext|> hi", "", "don't  \n\n  foo\t bar", "a \n", "\n", "x\n\n y", "é́ 日本 語  ", "plain words, again and again."]
    encoder = Encoder(*VOCABULARY)
    flat, ends = encoder.encode(texts)
    for t, part in zip(texts, np.split(flat, ends[:-1])):
        assert part.tolist() == whole.encode(t, add_special_tokens=False).ids


def test_packing_places_every_id_once(spark, odd):
    rows = packing.pack(odd, *VOCABULARY, capacity=256, windows=8, piece=64, slack=2).collect()
    encoder = Encoder(*VOCABULARY)
    flat, ends = encoder.encode([r.text or "" for r in odd.collect()])
    whole = collections.Counter((r.doc_id, (*x.tolist(), 1)) for r, x in zip(odd.collect(), np.split(flat, ends[:-1])))
    pieces = collections.defaultdict(set)
    for r in rows:
        pieces[r.sequence_id].add((r.offset, r.length))
        assert len(r.ids) == 4 * r.length
    for x in pieces.values():
        assert sorted(x)[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(sorted(x), sorted(x)[1:])) and sum(n for _, n in x) <= 256
    total = sum(len(k[1]) * v for k, v in whole.items())
    assert sum(r.length for r in rows) == total and len(pieces) * 256 - total < 0.05 * total + 256
    seven = sorted((r for r in rows if r.doc_id == 7), key=lambda r: r.start)
    assert b"".join(r.ids for r in seven) == np.array(next(k[1] for k in whole if k[0] == 7), "<u4").tobytes()
    assert packing.pack(odd.limit(0), *VOCABULARY).count() == 0


def test_differencing_levels_windows():
    sizes = np.array([9, 8, 7, 6, 5, 4, 3, 2, 1, 3])
    window = packing.difference(sizes, 4)
    assert np.ptp(np.bincount(window, sizes, 4)) <= 1
    window, count = packing.windows_for(np.array([6, 6, 6]), 10)
    assert count == 3 and len(set(window.tolist())) == 3


def test_chat_round_trip(spark):
    said = "\\### Assistant: </turn> ok"
    rows = [(1, 1, "assistant", said), (1, 0, "user", "hi \\ ### "), (1, 2, "assistant", ""), (2, 0, None, None), (3, 0, "us: er", "x\ny"), (3, 0, "us: er", "x\ny"), (None, 0, "assistant", "z")]
    turns = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, ids string")
    got = {r.conv_id: r for r in chat.read_back(chat.assemble(chat.format_turns(turns, *VOCABULARY)), *VOCABULARY).collect()}
    digest = lambda parts: hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in parts).encode()).hexdigest()
    assert got[1].turns_sha256 == digest([("user", "hi \\ ### "), ("assistant", said), ("assistant", "")]) and got[1].n_turns == 3
    assert got[1].loss_sha256 == hashlib.sha256(said.encode()).hexdigest() and got[1].loss_chars == len(said)
    assert got[2].turns_sha256 == digest([("", "")]) and got[3].n_turns == 2 and got[3].turns_sha256 == digest([("us: er", "x\ny")] * 2)
    assert got[None].loss_chars == 1
    assert chat.unescape(chat.escape(said)) == said
    assert chat.read_back(chat.assemble(chat.format_turns(turns.limit(0), *VOCABULARY)), *VOCABULARY).count() == 0


def test_page_text(spark):
    page = ("<html><head><title>No</title><script>var a='</p>';</script></head><body><nav><ul><li><a href=x>menu words here</a></li></ul></nav><div class='ad'>buy</div>"
            "<article><h1>Title &amp; more</h1><p>One <b>two\n three</b><br>four<p>five<aside>side note</aside><ul><li>six</li></ul><form>name</form>"
            "<p>seven</p><section class=comments>troll</section></article><footer>&copy; foot words that are many and long enough to tempt</footer></body></html>")
    rows = [(1, "u", page), (2, None, None), (3, "v", ""), (4, "w", "<p>no article <!-- open"), (1, "u", page)]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, text string")
    weights = pagetext.fit_weights(pages)
    got = [(r.page_id, r.text) for r in pagetext.extract(pages, weights).collect()]
    text = "Title & more\nOne two three four\nfive\nsix\nseven"
    assert collections.Counter(got) == collections.Counter({(1, text): 2, (2, ""): 1, (3, ""): 1, (4, "no article"): 1})
    assert pagetext.extract(pages.limit(0), {}).count() == 0 and pagetext.fit_weights(pages.limit(0)) == {}
