"""Spelling variants by a variable-length gram index: words that differ by one inserted, deleted or replaced character.

The gram dictionary is pruned by frequency: two characters are a gram of their own unless more than one word position in ``RARE`` has
them; then they are extended by the next character, up to ``LONGEST``. A word (with an end mark) has one gram at each place, the
shortest that the dictionary does not extend, so which gram that is depends on the gram's own characters only.

An edit at a place affects exactly the grams that cover it. All others, in order, are in the other word too: the lists of all of
them hold both words. Merging those lists is done by hash: for every place the rarest unaffected grams, as many as it takes to
expect less than ``ALIKE`` words by chance, make up one key together with the length. A replaced or deleted character gives keys of the
word's own length, an inserted one keys of the length after it; words that share a key are candidates, and the edit distance
verifies them. Most places leave the same rarest grams, so a word has few keys (7 and 7 on the given tables).

Words are counted, and candidates joined and verified by Spark expressions; the keys are computed in Python on distinct words. The
dictionary reaches the driver: it holds at most 91^2 pairs, and at most RARE pairs are extended, whatever the size of the corpus.

Defined results: null and empty texts have no words; rows that repeat an id are counted one by one; a null doc_id is the text ``null`` in the
checksum; ties for a form go to the smallest word in code-point order; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, written

#: Least code points and occurrences of a word; a form is at least this many times as frequent as the word.
LEAST_POINTS, LEAST_COUNT, RATIO = 7, 2, 10
SHORTEST, LONGEST, RARE, ALIKE = 2, 3, 500, 1e-4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
END = "$"


def with_slips(word: Column, doc_id: Column) -> Column:
    """The word, without the character that its checksum with the document's id names if 31 divides that checksum."""
    h = F.crc32(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), word).cast("binary"))
    at = (h % F.length(word)).cast("int")
    return F.when(h % 31 == 0, F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))).otherwise(word)


def count_words(docs: DataFrame, slips: bool = False) -> DataFrame:
    """word and n of all words of enough length and occurrences; with ``slips``, after ``with_slips``."""
    runs = F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"[A-Za-zÀ-ÿ]{{{LEAST_POINTS},}}"), F.lit(0))
    words = docs.select(F.col("doc_id"), F.explode(runs).alias("run")).select("doc_id", F.translate("run", UPPER, LOWER).alias("word"))
    if slips:
        words = words.select(with_slips(F.col("word"), F.col("doc_id")).alias("word")).where(F.length("word") >= LEAST_POINTS)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


def gram_dictionary(words: DataFrame) -> dict[str, float]:
    """Share of the words' places of every gram; those that are extended have no entry of their own."""
    places = words.select(F.concat("word", F.lit(END)).alias("w"))
    places = places.select("w", F.explode(F.sequence(F.lit(1), F.length("w") - (SHORTEST - 1))).alias("at"))
    shares: dict[str, float] = {}
    total, extended = 0, None
    for size in range(SHORTEST, LONGEST + 1):
        gram = F.substring("w", F.col("at"), F.lit(size))
        rows = places if extended is None else places.where(F.substring("w", F.col("at"), F.lit(size - 1)).isin(extended))
        found = {r.gram: r.n for r in rows.groupBy(gram.alias("gram")).agg(F.count("*").alias("n")).collect()}
        total = total or sum(found.values())
        extended = [g for g, n in found.items() if size < LONGEST and n * RARE > total and not g.endswith(END)]
        shares |= {g: n / total for g, n in found.items()}
        for g in extended:
            del shares[g]
        if not extended:
            break
    return shares


def decompose(word: str, shares: dict[str, float]) -> list[tuple[int, str]]:
    """(place, gram) of every place of the word with its end mark."""
    w = word + END
    out = []
    for at in range(len(w) - SHORTEST + 1):
        size = SHORTEST
        while w[at:at + size] not in shares:
            size += 1
        out.append((at, w[at:at + size]))
    return out


def edit_keys(word: str, shares: dict[str, float], limit: float, odds: dict[str, float]) -> tuple[set[str], set[str]]:
    """Keys for an edit of the word's own characters, and for a character put in; ``odds`` are the shares' logarithms."""
    grams = decompose(word, shares)
    ranked = sorted((odds[g], g, at, at + len(g)) for at, g in grams)

    def key(first: int, last: int) -> str:
        # a gram is affected if it covers what lies between these two places
        chance, taken = 0.0, []
        for x, g, start, end in ranked:
            if end <= first or start >= last:
                taken.append((start, g))
                chance += x
                if chance <= limit:
                    break
        taken.sort()
        return f"{len(word) + (first == last)} " + " ".join([g for _, g in taken])

    own = {key(i, i + 1) for i in range(len(word))}
    put = {key(i, i) for i in range(len(word) + 1)}
    return own, put


def near_words(words: DataFrame) -> DataFrame:
    """word, n, near, near_n of all pairs of words at an edit distance of one, each in both orders."""
    arrow_batches(words.sparkSession)
    size = words.count()
    shares = gram_dictionary(words)
    odds = {g: math.log(s) for g, s in shares.items()}
    limit = math.log(ALIKE / max(1, size))

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash
        for b in batches:
            rows = []
            for word, n in zip(b.word, b.n):
                own, put = edit_keys(word, shares, limit, odds)
                rows += [(xxhash.xxh64_intdigest(k) - (1 << 63), word, n, False) for k in own]
                rows += [(xxhash.xxh64_intdigest(k) - (1 << 63), word, n, True) for k in put]
            yield pd.DataFrame(rows, columns=["key", "word", "n", "put"])

    keyed = written(words.mapInPandas(keys, "key long, word string, n long, put boolean"), "gram-keys")
    own = keyed.where(~F.col("put")).select("key", "word", "n")
    other = keyed.select("key", F.col("word").alias("near"), F.col("n").alias("near_n"), "put")
    close = F.when(F.col("word") != F.col("near"), F.levenshtein("word", "near", 1) == 1).otherwise(False)
    pairs = own.join(other, (own.key == other.key) & close).select("word", "n", "near", "near_n", "put")
    both = F.when(F.col("put"), F.array(F.struct("word", "n", "near", "near_n"), F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))))
    rows = pairs.select(F.inline(both.otherwise(F.array(F.struct("word", "n", "near", "near_n")))))
    return rows.distinct()


def roots(forms: DataFrame, most: int) -> DataFrame:
    """word and root of the rows (word, form): the end of the chain of forms, of at most ``most`` steps."""
    known = written(forms, "forms")
    reach = 1
    while reach < most:
        ahead = known.select(F.col("word").alias("form"), F.col("form").alias("next"))
        known = written(known.join(ahead, "form", "left").select("word", F.coalesce("next", "form").alias("form")), "roots")
        reach *= 2
    return known.withColumnRenamed("form", "root")


def spelling_groups(docs: DataFrame, slips: bool = False) -> DataFrame:
    """word, n, n_near (words at distance one), form (the most frequent of them if it is much more frequent), form_n and root of every word."""
    words = written(count_words(docs, slips), "word-counts")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("near")))
    near = near_words(words).groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    far = -F.col("best.n") >= RATIO * F.col("n")
    near = written(near.select("word", "n_near", F.when(far, F.col("best.near")).alias("form"), F.when(far, -F.col("best.n")).alias("form_n")), "near-words")
    # each form is RATIO times as frequent as the word before it, so counts bound the chain
    top = near.agg(F.max("form_n")).first()[0] or 1
    ends = roots(near.where(F.col("form").isNotNull()).select("word", "form"), max(1, math.ceil(math.log(top, RATIO))))
    rows = words.join(near, "word", "left").join(ends, "word", "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n")
