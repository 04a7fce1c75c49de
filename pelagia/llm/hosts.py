"""URL filters by link-graph propagation.

Rules judge the urls they fit. For all others the host decides: trust spreads from hosts whose pages the rules allow along the
links, distrust spreads from hosts whose pages they block against the links (who links to a blocked host is suspect). Both are
personalised PageRank over host edges, kept per host (a seed starts at 1) so that the threshold does not depend on the size of the
graph. A host is blocked if its distrust is at least ``threshold`` and larger than its trust.

Defined results: a null url, or one without ``://``, has the empty host and path and fits no rule; the empty host has no
links; repeated rows count and are judged one by one; without links only seeds have scores; an empty table gives an empty
result. Of rules that fit, the longest (host and path) wins, then the longer host, then block. Only page_id, url and html are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Most rules that may be given: they are one expression of the scan.
RULE_LIMIT = 500

AUTHORITY, PATH = r"(?s)://([^/?#]*)", r"(?s)://[^/?#]*([^?#]*)"
LINK = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    text = F.coalesce(url.cast("string"), F.lit(""))
    return F.translate(F.regexp_extract(text, AUTHORITY, 1), UPPER, LOWER), F.regexp_extract(text, PATH, 1)


def ordered_rules(allow: Sequence[str], block: Sequence[str]) -> list[tuple[str, str, str, str]]:
    """(host, path, rule, verdict), the first that fits wins. A rule is a host and a path, like ``example.net/en/``."""
    rules = [(*r.partition("/")[::2], r, v) for group, v in ((block, "block"), (allow, "allow")) for r in group]
    if len(rules) > RULE_LIMIT:
        raise ValueError(f"{len(rules)} rules; {RULE_LIMIT} may be given")
    return sorted(((h, "/" + p if "/" in r else "", r, v) for h, p, r, v in rules), key=lambda x: (-len(x[0] + x[1]), -len(x[0]), x[3] != "block"))


def judged(pages: DataFrame, rules: list[tuple[str, str, str, str]]) -> DataFrame:
    """page_id, host, path, and the rule that fits with its verdict (else null)."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, r, v in reversed(rules):
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        rule, verdict = F.when(fits, r).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("rule_verdict"))


def host_edges(pages: DataFrame) -> DataFrame:
    """source, target, weight: how many links go from one host to another; links within a host are left out."""
    host, _ = host_and_path(F.col("url"))
    links = pages.select(host.alias("source"), F.explode(F.regexp_extract_all(F.col("html").cast("string"), F.lit(LINK), F.lit(1))).alias("target"))
    links = links.select("source", F.translate("target", UPPER, LOWER).alias("target")).where("source <> '' and source <> target")
    return links.groupBy("source", "target").agg(F.count("*").cast("double").alias("weight"))


def seeds(verdicts: DataFrame) -> DataFrame:
    """host, trusted, blocked (0 or 1): most pages allowed, or some allowed and none blocked; most pages blocked."""
    allowed, blocked = (F.sum(F.coalesce((F.col("rule_verdict") == v).cast("long"), F.lit(0))) for v in ("allow", "block"))
    counts = verdicts.where("host <> ''").groupBy("host").agg(F.count("*").alias("n"), allowed.alias("a"), blocked.alias("b"))
    return counts.select("host", ((2 * F.col("a") > F.col("n")) | (F.col("a") > 0) & (F.col("b") == 0)).cast("double").alias("trusted"),
                         (2 * F.col("b") > F.col("n")).cast("double").alias("blocked"))


def propagate(edges: DataFrame, start: DataFrame, follow: float = 0.85, tolerance: float = 1e-5, every: int = 4, most: int = 400) -> DataFrame:
    """host, trust, distrust, carried on until no score changes by ``tolerance`` or more in a step; then each is within 6 times that of its
    limit. Hosts that no edge touches keep their seed values. It is an error if ``most`` steps do not suffice.

    Trust moves along edges in shares of the source's links, distrust against them in shares of the target's; both move in one
    join, as an edge is stored once for each direction. What a host without a way out holds stays with it.
    """
    one = edges.select(F.col("source").alias("host"), F.col("target").alias("to"), "weight", F.lit(True).alias("forward"))
    two = edges.select(F.col("target").alias("host"), F.col("source").alias("to"), "weight", F.lit(False).alias("forward"))
    both = one.unionByName(two)
    total = both.groupBy("host", "forward").agg(F.sum("weight").alias("total"))
    moves = written(both.join(total, ["host", "forward"]).select("host", "to", "forward", (F.col("weight") / F.col("total")).alias("share")), "host-moves")
    ways = total.groupBy("host").agg(F.max("forward").alias("out"), F.max(~F.col("forward")).alias("back"))
    known = start.select("host").union(moves.select("host")).distinct()
    base = known.join(start, "host", "left").join(ways, "host", "left")
    base = written(base.select("host", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("trusted", "blocked")],
                               *[F.coalesce(c, F.lit(False)).alias(c) for c in ("out", "back")]), "host-seeds")
    score = base.select("host", F.col("trusted").alias("trust"), F.col("blocked").alias("distrust"))
    if moves.isEmpty():
        return score
    # what comes back to a seed must not start as a wave of its whole mass
    score = base.select("host", ((1 - follow) * F.col("trusted")).alias("trust"), ((1 - follow) * F.col("blocked")).alias("distrust"))
    for k in range(1, most + 1):
        got = moves.join(score, "host").groupBy(F.col("to").alias("host")).agg(
            F.sum(F.when(F.col("forward"), F.col("share") * F.col("trust")).otherwise(0.0)).alias("t"),
            F.sum(F.when(~F.col("forward"), F.col("share") * F.col("distrust")).otherwise(0.0)).alias("d"))
        old = base.join(score, "host").join(got, "host", "left")

        def step(seed: str, old_score: str, came: str, way: str) -> Column:
            return (1 - follow) * F.col(seed) + follow * (F.coalesce(came, F.lit(0.0)) + F.when(F.col(way), 0.0).otherwise(F.col(old_score)))

        score = old.select("host", step("trusted", "trust", "t", "out").alias("trust"), step("blocked", "distrust", "d", "back").alias("distrust"),
                           F.col("trust").alias("was"), F.col("distrust").alias("was_distrust"))
        if k % every == 0:
            stored = written(score, "host-scores")
            moved = stored.agg(F.max(F.greatest(F.abs(F.col("trust") - F.col("was")), F.abs(F.col("distrust") - F.col("was_distrust"))))).first()[0]
            score = stored.select("host", "trust", "distrust")
            if moved < tolerance:
                return score
        score = score.select("host", "trust", "distrust")
    raise RuntimeError(f"host scores did not settle in {most} steps")


def filter_urls(pages: DataFrame, allow: Sequence[str], block: Sequence[str], threshold: float = 0.05) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust of every page."""
    rules = ordered_rules(allow, block)
    verdicts = judged(pages, rules)
    score = propagate(host_edges(pages), seeds(verdicts))
    method = F.when((F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust")), "block").otherwise("allow")
    rows = verdicts.join(score, "host", "left")
    return rows.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", method).alias("verdict"), "trust", "distrust")
