"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations, with multiprobe buckets and verified pairs.

A vector is scaled to length 1 and filled with zeros up to a power of two, D. A rotation is three rounds of random signs and a fast
Hadamard transform; its hash is the largest coordinate with its sign, one of 2 D. A bucket of a table is named by ``hashes`` such values.
Each vector goes to its own bucket and to the ``PROBES`` - 1 next best ones, in which coordinates that are almost as large take the place
of the largest. The number of hashes follows from the number of vectors, so that vectors that are alike by chance only are few in a bucket;
the number of tables follows from the share of pairs at the threshold that meet in one table, which is measured on random pairs, so that
a pair at the threshold meets in some table with a chance of ``RECALL``.

In a bucket, 128 signs of random projections tell which vectors have a possible partner; only those get their coordinates looked up. Their
pairs are verified by cosine in double precision, and a pair that shares several buckets counts in that of the smallest name. Equal
vectors are one member with a number of copies. A bucket over ``BLOCK`` members is dealt out as pairs of blocks. A task gives a count and
one connection for each member, never its pairs.

Defined results: null, empty and zero vectors, and those with null or non-finite components, link with nothing, nor do rows without vec_id;
vectors of different sizes don't link; every row counts as a vector, so rows that repeat an id and a vector are linked to one another, and
an id with several vectors is judged row by row; ties have no effect; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, components, group_of, in_pairs_of_blocks, whole_groups, written

THRESHOLD, RECALL, PROBES = 0.9, 0.9999, 4
#: Vectors that a bucket may hold by chance, on average; bits of the signs compared there; members of a block.
BY_CHANCE, BITS, BLOCK = 64, 128, 2048
#: Rows of a bucket that are compared place by place, together with those of other small buckets.
FEW = 64


def rotated(x: np.ndarray, *seed: int) -> np.ndarray:
    """Rows of ``x`` (a power of two long) after three rounds of random signs and a fast Hadamard transform."""
    n, d = x.shape
    rng = np.random.default_rng([5, d, *seed])
    for _ in range(3):
        x = x * rng.choice([-1.0, 1.0], d)
        h = 1
        while h < d:
            pairs = x.reshape(n, d // (2 * h), 2, h)
            x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(n, d)
            h *= 2
        x = x / math.sqrt(d)
    return x


def buckets(x: np.ndarray, table: int, hashes: int) -> np.ndarray:
    """(rows, probes) numbers of the own bucket and of the next best ones in one table, below (2 D) ^ hashes."""
    n, d = x.shape
    take = min(PROBES, d)
    codes, gaps = [], []
    for k in range(hashes):
        y = rotated(x, table, k)
        size = np.abs(y)
        at = np.argpartition(-size, take - 1, axis=1)[:, :take]
        at = np.take_along_axis(at, np.argsort(-np.take_along_axis(size, at, 1), axis=1, kind="stable"), 1)
        codes.append(2 * at + (np.take_along_axis(y, at, 1) < 0))
        top = np.take_along_axis(size, at, 1)
        gaps.append((top[:, :1] - top) ** 2)
    # a choice that takes the a-th coordinate in one hash and the b-th in another is among the best only if a * b is small
    choices = [c for c in itertools.product(range(take), repeat=hashes) if math.prod(i + 1 for i in c) <= PROBES]
    cost = np.stack([sum(g[:, i] for g, i in zip(gaps, c)) for c in choices], 1)
    best = np.argsort(cost, axis=1, kind="stable")[:, :PROBES]
    number = np.stack([sum(c[:, i].astype(np.int64) * (2 * d) ** k for k, (c, i) in enumerate(zip(codes, choice))) for choice in choices], 1)
    return np.take_along_axis(number, best, 1)


@cache
def meeting_share(d: int, hashes: int, threshold: float, pairs: int = 4000) -> float:
    """Least share (three deviations below the measured one) of random pairs with that cosine that share a bucket of one table."""
    rng = np.random.default_rng([9, d])
    a = rng.normal(size=(pairs, d))
    a /= np.linalg.norm(a, axis=1)[:, None]
    o = rng.normal(size=(pairs, d))
    o -= (o * a).sum(1)[:, None] * a
    o /= np.maximum(np.linalg.norm(o, axis=1), 1e-300)[:, None]
    x, y = (buckets(v, 1, hashes) for v in (a, threshold * a + math.sqrt(1 - threshold * threshold) * o))
    share = float((x[:, :, None] == y[:, None, :]).any((1, 2)).mean())
    return max(0.01, share - 3 * math.sqrt(share * (1 - share) / pairs))


def layout(d: int, n: int, threshold: float, recall: float) -> tuple[int, int]:
    """Hashes of a bucket and tables for ``n`` vectors of ``d`` coordinates."""
    hashes = 1
    while hashes < 3 and n / (2 * d) ** hashes > BY_CHANCE:
        hashes += 1
    share = meeting_share(d, hashes, threshold) if d > 1 else 1.0
    return hashes, max(1, math.ceil(math.log(1 - recall) / math.log(1 - min(share, 0.9999))))


def unit(vector) -> np.ndarray | None:
    """The vector with length 1, filled up to a power of two; None if it has no direction."""
    if vector is None:
        return None
    v = np.asarray(vector, dtype=np.float64)
    top = np.abs(v).max(initial=0.0)
    if not top or not np.isfinite(v).all():
        return None
    v = v / 2.0 ** min(1000, math.frexp(top)[1])  # exact, so that squares neither overflow nor vanish
    out = np.zeros(1 << (len(v) - 1).bit_length())
    out[:len(v)] = v / np.linalg.norm(v)
    return out


def digest(vector) -> bytes:
    return hashlib.blake2b((np.asarray(vector, np.float64) + 0.0).tobytes(), digest_size=16).digest()


def sketch(rows: DataFrame, layouts: dict[int, tuple[int, int]]) -> DataFrame:
    """vec_id, digest (null if it links with nothing), signs, and the names of its buckets, ascending by table."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            n = len(b)
            units = [unit(v) if good else None for v, good in zip(b.embedding, b.vec_id.notna())]
            digests: list[bytes | None] = [None if u is None else digest(v) for u, v in zip(units, b.embedding)]
            signs: list[bytes | None] = [None] * n
            names: list[np.ndarray | None] = [None] * n
            # vectors of another size never share a bucket: the size is part of its name
            for size in {len(v) for u, v in zip(units, b.embedding) if u is not None}:
                at = [i for i in range(n) if units[i] is not None and len(b.embedding[i]) == size]
                x = np.stack([units[i] for i in at])
                d = x.shape[1]
                hashes, tables = layouts[d]
                got = np.stack([buckets(x, t, hashes) + (size * tables + t) * (2 * d) ** hashes for t in range(tables)], 1)
                plane = np.random.default_rng([3, d]).normal(size=(d, BITS))
                packed = np.packbits(x @ plane > 0, axis=1)
                for k, i in enumerate(at):
                    signs[i], names[i] = packed[k].tobytes(), got[k].ravel()
            yield pd.DataFrame({"vec_id": b.vec_id.astype("Int64"), "digest": digests, "signs": signs, "names": names})

    return rows.mapInPandas(work, "vec_id long, digest binary, signs binary, names array<long>")


def possible(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Members (name, digest) of a bucket's share with a possible partner in it; all members of a bucket of several shares."""
    turned = math.acos(THRESHOLD) / math.pi
    most = int(BITS * (turned + 5 * math.sqrt(turned * (1 - turned) / BITS))) + 1
    for part in whole_groups(batches, ["name", "share"]):
        group = group_of(part, ["name", "share"])
        signs = np.frombuffer(b"".join(part.signs), np.uint64).reshape(len(part), -1)
        hit = part.shares.to_numpy() > 1
        step = 1
        while len(same := np.flatnonzero(group[step:] == group[:-step])):
            near = same[np.bitwise_count(signs[same] ^ signs[same + step]).sum(1) <= most]
            hit[near] = hit[near + step] = True
            step += 1
        yield part.loc[hit, ["name", "digest"]]


def linked(x: np.ndarray, group: np.ndarray, apart: np.ndarray, side: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a, b) of rows of one group with the cosine or more; where ``apart``, of different sides only.

    Groups of up to FEW rows are compared all at once, each row with the one 1, 2, ... places on; larger ones by matrix products.
    """
    size = np.bincount(group)[group]
    out = [(np.zeros(0, np.int64),) * 2]
    step = 1
    while len(a := np.flatnonzero((group[step:] == group[:-step]) & (size[step:] <= FEW))):
        a = a[~apart[a] | (side[a] != side[a + step])]
        a = a[np.einsum("ij,ij->i", x[a], x[a + step]) >= threshold]
        out.append((a, a + step))
        step += 1
    for g in np.unique(group[size > FEW]):
        rows = np.flatnonzero(group == g)
        left, right = (rows[side[rows] == 0], rows[side[rows] == 1]) if apart[rows[0]] else (rows, rows)
        for some in np.array_split(left, max(1, len(left) // 256)):
            a, b = np.nonzero(x[some] @ x[right].T >= threshold)
            a, b = some[a], right[b]
            out.append((a, b) if apart[rows[0]] else (a[a < b], b[a < b]))
    return tuple(np.concatenate(c) for c in zip(*out))


def first_meeting(names: np.ndarray, a: np.ndarray, b: np.ndarray, name: np.ndarray) -> np.ndarray:
    """Whether the pairs share no bucket with a smaller name than the one they were found in."""
    first, least = np.ones(len(a), bool), names.min(2)
    for t in range(names.shape[1]):
        open_ = np.flatnonzero(first & (least[a, t] < name))
        for part in np.array_split(open_, max(1, len(open_) // 50_000)):
            p, q = names[a[part], t], names[b[part], t]
            first[part] = ~((p[:, :, None] == q[:, None, :]) & (p[:, :, None] < name[part, None, None])).any((1, 2))
    return first


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links (other vectors with that cosine or more), component_id (smallest id connected by links) and kept of every row."""
    spark = vectors.sparkSession
    arrow_batches(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    power = F.when(F.size("embedding") > 1, F.length(F.bin(F.size("embedding") - 1))).otherwise(0)
    seen = rows.where(F.size("embedding") > 0).agg(F.count("*").alias("n"), F.collect_set(power).alias("powers")).first()
    layouts = {1 << p: layout(1 << p, seen.n, threshold, recall) for p in seen.powers}
    sketches = written(sketch(rows, layouts), "vector-sketches")
    classes = sketches.where(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("signs").alias("signs"), F.first("names").alias("names"))
    classes = written(classes, "vector-classes")

    named = classes.select("digest", "signs", F.explode("names").alias("name"))
    shared = named.groupBy("name").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("shares"), F.count("*").alias("n")).where("n > 1")
    dealt = named.join(shared, "name").select("name", "digest", "signs", "shares", F.pmod(F.xxhash64(F.lit(7), "digest"), F.col("shares")).cast("int").alias("share"))
    members = dealt.repartition("name", "share").sortWithinPartitions("name", "share").mapInPandas(possible, "name long, digest binary")
    members = written(members, "vector-members")

    def coordinates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            units = [unit(v) for v in b.embedding]
            good = [i for i, u in enumerate(units) if u is not None]
            yield pd.DataFrame({"digest": [digest(b.embedding[i]) for i in good], "vector": [units[i].tobytes() for i in good]})

    wanted = written(members.select("digest").distinct().join(classes.select("digest", "rep", "copies", "names"), "digest"), "vector-wanted")
    ids = wanted.select(F.col("rep").alias("vec_id")).distinct()
    found = rows.join(ids, "vec_id", "left_semi").mapInPandas(coordinates, "digest binary, vector binary").dropDuplicates(["digest"])
    held = members.join(written(wanted.join(found, "digest"), "vector-coordinates"), "digest")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in whole_groups(batches, ["name", "i", "j"], 4 * BLOCK):
            for length in part.vector.map(len).unique():  # a group has vectors of one size
                g = part[part.vector.map(len) == length]
                copies, rep, name = g.copies.to_numpy(np.int64), g.rep.to_numpy(np.int64), g["name"].to_numpy(np.int64)
                x = np.frombuffer(b"".join(g.vector), np.float64).reshape(len(g), -1)
                names = np.stack(g.names.to_list()).reshape(len(g), layouts[x.shape[1]][1], -1)
                a, b = linked(x, group_of(g, ["name", "i", "j"]), (g.i != g.j).to_numpy(), g.side.to_numpy(), threshold)
                first = first_meeting(names, a, b, name[a])
                links = np.bincount(a[first], copies[b[first]], len(g)) + np.bincount(b[first], copies[a[first]], len(g))
                label = rep.copy()
                while True:
                    low = label.copy()
                    np.minimum.at(low, a, label[b])
                    np.minimum.at(low, b, label[a])
                    if (low == label).all():
                        break
                    label = low
                hit = np.union1d(a, b)
                yield pd.DataFrame({"digest": g.digest.to_numpy()[hit], "links": links[hit].astype(np.int64), "rep": rep[hit], "to": label[hit]})

    met = in_pairs_of_blocks(held, "name", "digest", BLOCK).mapInPandas(verify, "digest binary, links long, rep long, to long")
    met = written(met, "vector-links")
    counts = met.groupBy("digest").agg(F.sum("links").alias("links"))
    groups = components(met.where("rep <> to").select(F.col("rep").alias("a"), F.col("to").alias("b")).distinct())
    result = classes.select("digest", "rep", "copies").join(counts, "digest", "left").join(groups.select(F.col("node").alias("rep"), "label"), "rep", "left")
    result = written(result.select("digest", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("label", "rep").alias("component_id")), "vector-results")
    out = sketches.select("vec_id", "digest").join(result, "digest", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
                      F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"))
