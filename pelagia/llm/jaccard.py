"""N-gram Jaccard join: MinHash banding with exact verification; each tree gives one key of a prefix whose length is fixed by constants.

A text is its set of five-word shingles. Texts with equal sets are one class, represented by the smallest id. Each class has a
label of ``depth`` MinHash values in each of ``trees`` sorted prefix tries. The prefix that two labels must share starts at the full
depth and is shortened until the expected recall at the threshold reaches ``recall``; labels that share it are in one bucket.

In a bucket, members whose signatures agree enough are connected to a leader, one row each, not pair by pair. A bucket over ``block``
members is dealt into shares, whose leaders meet in pairs of blocks. What is connected over all buckets is a group, and every pair of a group is verified exactly. Groups over ``block`` members are dealt out as pairs of
blocks, so no task holds more than two blocks, and a task gives a count and one connection for each member, never its pairs.

Defined results: words are runs of letters, digits and ``_``, lower-cased; a text with fewer than five words is one shingle of them all;
null and empty texts have no shingles, no links and a class of their own; repeated rows with one doc_id count once; a null doc_id is
left out of groups and is a class of its own; ties have no effect; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, components, written
from .words import coded

WIDTH, THRESHOLD = 5, 0.8
TREES, DEPTH, RECALL = 16, 5, 0.9995
#: Signatures agree by chance on a share that differs from the similarity by 0.05 (one sigma of 80 values) or less: a pair at the
#: threshold is below CLOSE with a chance under 1e-7; SAME marks members that need not lead.
CLOSE, SAME, BLOCK = 0.5, 0.93, 512
_WORD = re.compile(r"\w+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def prefix_length(trees: int, depth: int, threshold: float, recall: float) -> int:
    """The longest prefix whose forest finds a pair at the threshold with the wanted chance."""
    k = depth
    while k > 1 and 1 - (1 - threshold ** k) ** trees < recall:
        k -= 1
    return k


def shingles(texts: Sequence[str | None], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of all texts, flat, and the end of each text."""
    codes, ends, kinds = coded(texts, _WORD)
    sizes = np.diff(ends)
    counts = np.where(sizes >= width, sizes - width + 1, (sizes > 0).astype(np.int64))
    if not kinds:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    word = pd.util.hash_array(np.array(kinds, object), categorize=False)[codes]
    # words after the end of a short text count as 0
    word = np.append(word, np.zeros(width, np.uint64))
    owner = np.repeat(np.arange(len(texts)), counts)
    at = np.repeat(ends[:-1] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    total = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            part = np.where(at + k < ends[1:][owner], word[at + k], np.uint64(0))
            total = (total ^ (total >> np.uint64(31))) * _MIX + part
        total ^= total >> np.uint64(29)
    order = np.lexsort((total, owner))
    total, owner = total[order], owner[order]
    first = np.append(True, (total[1:] != total[:-1]) | (owner[1:] != owner[:-1]))[:len(total)]
    return total[first], np.cumsum(np.bincount(owner[first], minlength=len(texts)))


def signatures(flat: np.ndarray, ends: np.ndarray, count: int) -> np.ndarray:
    """(texts, count) MinHash values; texts without shingles have zeros."""
    rng = np.random.default_rng(20)
    factor, shift = (rng.integers(1, 2**63, count, dtype=np.uint64) | np.uint64(1)), rng.integers(0, 2**63, count, dtype=np.uint64)
    out = np.zeros((len(ends), count), np.uint32)
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    full = np.flatnonzero(ends > begins)
    if len(full):
        with np.errstate(over="ignore"):
            for k in range(count):
                out[full, k] = np.minimum.reduceat(((flat * factor[k] + shift[k]) >> np.uint64(32)).astype(np.uint32), begins[full])
    return out


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, digest of the shingle set (null without shingles), signature, and one prefix key for each tree."""
    arrow_batches(docs.sparkSession)
    k = prefix_length(TREES, DEPTH, THRESHOLD, RECALL)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib
        for b in batches:
            flat, ends = shingles(list(b.text))
            sig = signatures(flat, ends, TREES * DEPTH)
            keys = np.zeros((len(sig), TREES), np.uint64)
            with np.errstate(over="ignore"):
                for t in range(TREES):
                    keys[:, t] = t + 1
                    for d in range(k):
                        keys[:, t] = (keys[:, t] ^ (keys[:, t] >> np.uint64(31))) * _MIX + sig[:, t * DEPTH + d]
            begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            digests = [hashlib.blake2b(flat[x:y].tobytes(), digest_size=16).digest() if y > x else None for x, y in zip(begins, ends)]
            yield pd.DataFrame({"doc_id": b.doc_id.astype("Int64").array, "digest": digests, "signature": [x.tobytes() for x in sig], "prefixes": list(keys.astype(np.int64))})

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return text.mapInPandas(run, "doc_id long, digest binary, signature binary, prefixes array<long>")


class Sets:
    """Disjoint sets of places, for one bucket or block at a time."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)


def runs(batches: Iterator[pd.DataFrame], key: list[str]) -> Iterator[pd.DataFrame]:
    """The rows of one key after another, of batches that are sorted by it."""
    held: list[pd.DataFrame] = []
    for b in batches:
        if not len(b):
            continue
        values = b[key].to_numpy()
        cut = np.flatnonzero((values[1:] != values[:-1]).any(1)) + 1
        for part in np.split(np.arange(len(b)), cut):
            piece = b.iloc[part]
            if held and (held[-1][key].to_numpy()[-1] != values[part[0]]).any():
                yield pd.concat(held)
                held = []
            held.append(piece)
    if held:
        yield pd.concat(held)


def connect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per share of a bucket: leaders and those close to them, as one connection (a, b) for each member that is close to an earlier one.

    If the bucket has several shares, each leader is also given with its bucket (a = b), to be compared with those of other shares.
    """
    columns = ["prefix", "a", "b"]
    out: list[tuple[int, int, int]] = []
    for bucket in runs(batches, ["prefix", "share"]):
        ids, prefix = bucket.rep.to_numpy(), int(bucket.prefix.iloc[0])
        sig = np.frombuffer(b"".join(bucket.signature), np.uint32).reshape(len(ids), -1)
        sets, leaders = Sets(len(ids)), np.zeros(len(ids), np.int64)
        n = 0
        for i in range(len(ids)):
            alike = (sig[leaders[:n]] == sig[i]).mean(1) if n else np.zeros(0)
            for j in leaders[:n][alike >= CLOSE].tolist():
                sets.join(i, j)
            if not (alike >= SAME).any():
                leaders[n] = i
                n += 1
        out += [(prefix, int(ids[i]), int(ids[sets.root(i)])) for i in range(len(ids)) if sets.root(i) != i]
        if bucket.shares.iloc[0] > 1:
            out += [(prefix, int(ids[i]), int(ids[i])) for i in leaders[:n]]
        if len(out) > 20_000:
            yield pd.DataFrame(out, columns=columns)
            out = []
    yield pd.DataFrame(out, columns=columns, dtype=np.int64)


def connect_leaders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per pair of blocks of a bucket's leaders: one connection (a, b) for each leader that is close to one of the other block.

    Two members that agree on a share x have leaders that agree on x - 2 * (1 - SAME) or more, within a share of a bucket it is
    x - (1 - SAME) against CLOSE; the bound here is lower by the difference, so a split bucket finds what a whole one does.
    """
    for part in runs(batches, ["prefix", "i", "j"]):
        ids, side = part.rep.to_numpy(), part.side.to_numpy()
        sig = np.frombuffer(b"".join(part.signature), np.uint32).reshape(len(ids), -1)
        left, right = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if part.i.iloc[0] != part.j.iloc[0] else (np.arange(len(ids)),) * 2
        sets = Sets(len(ids))
        for x in left.tolist():
            for y in right[(sig[right] == sig[x]).mean(1) >= CLOSE - (1 - SAME)].tolist():
                sets.join(x, y)
        yield pd.DataFrame([(int(ids[x]), int(ids[sets.root(x)])) for x in range(len(ids)) if sets.root(x) != x], columns=["a", "b"], dtype=np.int64)


def in_blocks(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows (key, rep, blocks, columns) dealt into pairs of blocks of their key: key, rep, columns, i, j and the row's side of the pair."""
    own, other = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    parts = rows.select(key, "rep", *columns, own.alias("own"), other.alias("x"))
    parts = parts.select(key, "rep", *columns, F.least("own", "x").alias("i"), F.greatest("own", "x").alias("j"), (F.col("own") > F.col("x")).cast("int").alias("side"))
    return parts.repartition(key, "i", "j").sortWithinPartitions(key, "i", "j", "rep")


def bucket_edges(signed: DataFrame, signature: DataFrame) -> DataFrame:
    """Connections (a, b) of members (prefix, n of its bucket, rep, signature).

    A bucket of more than ``block`` members is dealt into shares of about that size; only the leaders of the shares meet again, in
    pairs of blocks, so no task holds a whole bucket.
    """
    shares = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = signed.select("prefix", "rep", "signature", shares.alias("shares"), F.pmod(F.xxhash64(F.lit(7), "rep"), shares).cast("int").alias("share"))
    first = dealt.repartition("prefix", "share").sortWithinPartitions("prefix", "share", "rep").mapInPandas(connect, "prefix long, a long, b long")
    first = written(first, "bucket-connections")
    leaders = first.where("a = b").select("prefix", F.col("a").alias("rep"))
    counts = leaders.groupBy("prefix").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    met = leaders.join(counts, "prefix").join(signature, "rep")
    second = in_blocks(met, "prefix", ["signature"]).mapInPandas(connect_leaders, "a long, b long")
    return first.where("a <> b").select("a", "b").union(second).distinct()


def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per pair of blocks: every member's number of texts at the threshold or above, and one connection within what is linked."""
    for part in runs(batches, ["grp", "i", "j"]):
        ids, side = part.rep.to_numpy(), part.side.to_numpy()
        flat, ends = shingles(list(part.text))
        _, flat = np.unique(flat, return_inverse=True)
        begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        sizes = ends - begins
        cross = bool(part.i.iloc[0] != part.j.iloc[0])
        order = np.argsort(side, kind="stable")
        ids, begins, sizes = ids[order], begins[order], sizes[order]
        flat = np.concatenate([flat[x:x + n] for x, n in zip(begins, sizes)])
        begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        split = int((side == 0).sum()) if cross else 0
        links, sets, mark = np.zeros(len(ids), np.int64), Sets(len(ids)), np.zeros(int(flat.max(initial=0)) + 1, np.int32)
        for a in range(split if cross else len(ids)):
            start = split if cross else a + 1
            if start >= len(ids):
                break
            own = flat[begins[a]:begins[a] + sizes[a]]
            mark[own] = 1
            shared = np.add.reduceat(mark[flat[begins[start]:]], begins[start:] - begins[start])
            mark[own] = 0
            hit = start + np.flatnonzero(shared >= THRESHOLD * (sizes[a] + sizes[start:] - shared) - 1e-9)
            links[a] += len(hit)
            links[hit] += 1
            for b in hit.tolist():
                sets.join(a, b)
        yield pd.DataFrame({"rep": ids, "links": links, "to": [int(ids[sets.root(k)]) for k in range(len(ids))]})


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, rep_id (smallest id with the same shingle set), n_copies (documents with it), n_links (other texts at the threshold or
    above) and class_id (smallest id connected by links) of every document."""
    sketches = written(sketch(docs), "sketches")
    known = sketches.where(F.col("doc_id").isNotNull() & F.col("digest").isNotNull())
    classes = written(known.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.countDistinct("doc_id").alias("n_copies")), "shingle-classes")
    buckets = sketches.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").select(F.col("doc_id").alias("rep"), F.explode("prefixes").alias("prefix")).distinct()
    shared = buckets.groupBy("prefix").agg(F.count("*").alias("n")).where("n > 1")
    members = written(buckets.join(shared, "prefix"), "bucket-members")
    signature = sketches.select(F.col("doc_id").alias("rep"), "signature").dropDuplicates(["rep"])
    edges = bucket_edges(members.join(signature, "rep"), signature)
    groups = components(edges)
    sizes = groups.groupBy("label").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = groups.join(written(sizes, "group-sizes"), "label").select(F.col("label").alias("grp"), F.col("node").alias("rep"), "blocks")
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("string").alias("text"))
    held = dealt.join(texts, "rep").dropDuplicates(["rep"])
    found = in_blocks(held, "grp", ["text"]).mapInPandas(verify, "rep long, links long, to long")
    found = written(found, "verified")
    counts = found.groupBy("rep").agg(F.sum("links").alias("n_links"))
    linked = components(found.where("rep <> to").select(F.col("rep").alias("a"), F.col("to").alias("b")))
    result = classes.join(counts, "rep", "left").join(linked.select(F.col("node").alias("rep"), "label"), "rep", "left")
    result = written(result.select("digest", "rep", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("label", "rep").alias("class_id")), "near-classes")
    rows = sketches.select("doc_id", "digest").join(result, "digest", "left")
    own = F.col("doc_id")
    return rows.select("doc_id", F.coalesce(F.when(own.isNotNull(), F.col("rep")), own).alias("rep_id"), F.coalesce(F.when(own.isNotNull(), F.col("n_copies")), F.lit(1)).alias("n_copies"),
                       F.coalesce(F.when(own.isNotNull(), F.col("n_links")), F.lit(0)).alias("n_links"), F.coalesce(F.when(own.isNotNull(), F.col("class_id")), own).alias("class_id"))
