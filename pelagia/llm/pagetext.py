"""HTML extraction by a maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive and tags negative; a linear scan finds the contiguous region with the
largest sum. The weights are log ratios of how often a token occurs inside and outside the article of labelled pages (a bounded
sample of pages that mark it themselves, by an ``article`` element), clipped so that no tag scores above a small negative number.
Words take the weight of the part of the page they stand in (nearest sectioning element with its class); words in menus,
adverts, forms and the like count against a region (inside an article they count nothing) and are left out of it.

Defined results: a null or empty page, and one without words, has the empty text; unclosed comments, scripts and tags reach to the
end of the page; repeated rows are read one by one; of regions with equal sums the first is taken; extra columns are not read.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches

#: Elements of the HTML standard by what they do.
BLOCKS = set("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
             "header hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
PARTS = set("article aside body button details dialog div fieldset footer form head header main menu nav ol search section select table ul".split())
NOISE_ELEMENTS = set("aside button dialog fieldset footer form head menu nav search select".split())
#: Words in a class or id that name a part which is not the article.
NOISE_NAMES = set("ad ads advert advertisement adverts advertising aside banner breadcrumb breadcrumbs byline comment comments consent cookie cookies copyright "
                  "disclaimer disqus footer form gdpr login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager "
                  "pagination popup promo promotion recommended related replies respond search share sharing sidebar signup skip social sponsor sponsored "
                  "subscribe tags toolbar tracking widget".split())
NOISE_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|iframe|svg|canvas|object|textarea|title)\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
                    r"|<(/?)([a-zA-Z][\w:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.DOTALL | re.IGNORECASE)
_NAME = re.compile(r"""\b(class|id|role|hidden)\b\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.IGNORECASE)
_SPLIT = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")

CLIP, LEAST_TAG = 8.0, -0.02
DEFAULT_WORD, DEFAULT_TAG, NOISE_WORD = 1.0, -0.5, -1.0


class Part:
    """An open sectioning element: its label (name and class), whether it or one around it is noise, and if it is in an article."""

    __slots__ = ("tag", "label", "noise", "article")

    def __init__(self, tag: str, attributes: str, around: Part | None):
        named = {k.lower(): (v or "").strip("\"'") for k, v in _NAME.findall(attributes)} if attributes.strip() else {}
        names = {x.lower() for k in ("class", "id") for x in _SPLIT.split(named.get(k, "")) if x}
        self.tag = tag
        self.label = ".".join([tag, *sorted(names)][:4])
        self.article = tag in ("article", "main") or bool(around and around.article)
        own = tag in NOISE_ELEMENTS or tag == "header" and not self.article or bool(names & NOISE_NAMES) or named.get("role", "").lower() in NOISE_ROLES
        own = own and tag not in ("article", "main", "body") or "hidden" in named
        self.noise = own or bool(around and around.noise)


def tokens(page: str) -> Iterator[tuple[str, str, Part | None]]:
    """("text", text, part) and ("tag", label, part) in page order; scripts, styles and comments are left out."""
    stack: list[Part] = []
    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            yield "text", page[at:m.start()], stack[-1] if stack else None
        at = m.end()
        tag = m[3] and m[3].lower()
        if not tag:
            continue
        if m[2]:
            label = tag
            if tag in PARTS:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k].tag == tag:
                        label = stack[k].label
                        del stack[k:]
                        break
            yield "tag", label, stack[-1] if stack else None
        else:
            label = tag
            if tag == "body":
                stack.clear()  # a head that was not closed ends here
            if tag in PARTS and tag not in VOID and not m[4].rstrip().endswith("/"):
                stack.append(Part(tag, m[4], stack[-1] if stack else None))
                label = stack[-1].label
            yield "tag", label, stack[-1] if stack else None
    if at < len(page):
        yield "text", page[at:], stack[-1] if stack else None


def word_kind(part: Part | None) -> str:
    return "word:" + (part.label if part else "")


def count_tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of pages that mark their article: each kind of token, inside (the first article element) and outside."""
    for b in batches:
        inside, outside = Counter(), Counter()
        for page in b.html:
            if not re.search(r"<article\b", page, re.IGNORECASE):
                continue
            for kind, x, part in tokens(page):
                counter = inside if part and part.article and not part.noise else outside
                if kind == "text":
                    counter[word_kind(part)] += len(x.split())
                elif x.split(".")[0] in ("article", "main"):
                    outside["tag:" + x] += 1  # the edge itself
                else:
                    counter["tag:" + x] += 1
        keys = sorted(inside | outside)
        yield pd.DataFrame({"kind": keys, "inside": [inside[k] for k in keys], "outside": [outside[k] for k in keys]})


def fit_weights(pages: DataFrame, sample: int = 500, kinds: int = 5000) -> dict[str, float]:
    """Weights of tokens from at most ``sample`` pages, chosen by hash; the driver gets at most ``kinds`` counts."""
    arrow_batches(pages.sparkSession)
    chosen = pages.where(F.lower("html").contains("<article")).select(F.col("html").cast("string").alias("html"), F.xxhash64("page_id", "html").alias("order"))
    # only hashes are sorted; the pages at or below the last of them are read in place
    last = chosen.select("order").orderBy("order").limit(sample).agg(F.max("order")).first()[0]
    counts = chosen.where(F.col("order") <= F.lit(last)).select("html").mapInPandas(count_tokens, "kind string, inside long, outside long")
    rows = counts.groupBy("kind").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    rows = rows.orderBy(F.desc(F.col("inside") + F.col("outside")), "kind").limit(kinds).toPandas()
    if not len(rows):
        return {}
    a, b = rows.inside.sum() + 1, rows.outside.sum() + 1
    weights = {}
    for kind, x, y in zip(rows.kind, rows.inside, rows.outside):
        w = max(-CLIP, min(CLIP, math.log((x + 0.5) / a) - math.log((y + 0.5) / b)))
        weights[kind] = min(w, LEAST_TAG) if kind.startswith("tag:") else (max(0.1, w) if x > y else min(-0.1, w))
    return weights


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """The blocks of the region with the largest sum, without words of noise parts, joined by newlines."""
    if not page:
        return ""
    items: list[tuple[str | None, bool]] = []  # text to keep, or None; whether a block ends here
    best, best_from, best_to, total, begin = 0.0, 0, 0, 0.0, 0
    for kind, x, part in tokens(page):
        noise, article = bool(part and part.noise), bool(part and part.article)
        if kind == "text":
            n, w = len(x.split()), weights.get(word_kind(part), DEFAULT_WORD)
            if noise:  # left out anyway: inside an article it does not end the region
                w = 0.0 if article else NOISE_WORD * min(n, 10)
            else:
                w = n * (max(w, DEFAULT_WORD) if article else w)
            items.append((None if noise else x, False))
        else:
            w = weights.get("tag:" + x, DEFAULT_TAG)
            if article and x.split(".")[0] not in ("article", "main"):
                w = 0.0 if noise else max(w, DEFAULT_TAG)
            items.append((" " if x == "br" else None, x.split(".")[0] in BLOCKS))
        total += w
        if total <= 0:
            total, begin = 0.0, len(items)
        elif total > best:
            best, best_from, best_to = total, begin, len(items)
    blocks, now = [], []
    for x, ends in [*items[best_from:best_to], (None, True)]:
        if x is not None:
            now.append(x)
        if ends and now:
            blocks.append(" ".join(html.unescape("".join(now)).split()))
            now = []
    return "\n".join(x for x in blocks if x)


def extract(pages: DataFrame, weights: dict[str, float]) -> DataFrame:
    """page_id, url and text of every page."""
    arrow_batches(pages.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"page_id": b.page_id.astype("Int64").array, "url": b.url, "text": [main_text(x if isinstance(x, str) else None, weights) for x in b.html]})

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), *[F.col(c).cast("string").alias(c) for c in ("url", "html")])
    return rows.mapInPandas(run, "page_id long, url string, text string")
