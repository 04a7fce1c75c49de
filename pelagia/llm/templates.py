r"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Numbers, names (capitalised words inside a sentence) and units after a number become typed placeholders. Windows of ``size``
placeholders and lower-case words of every document are joined by hash to those of the benchmark items; an item shorter than that is
one window of its own length. Windows are also joined as written, with names as written and with line breaks and several blanks read
as one blank, so case and wrapping of a copy do not matter; one with fewer than ``least`` plain words is joined in this form only.
A matched window counts if each value of the item stands for one value in the document. Counted windows with the same shift between
document and item form a passage; one whose values are all the item's own is ``exact``, else the question has been ``reparameterised``.

The document side is never shuffled unless the benchmark is too large to broadcast: only hashes leave a text, and only matches go on.

Defined results: null and empty texts match nothing; repeated rows of a document give what one gives; a null doc_id or item_id is a
value of its own; empty tables give an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Units that may follow a number, in lower case.
UNITS = ("mm cm dm m km inch inches feet foot ft yard yards mile miles mg g kg gram grams kilogram kilograms pound pounds lb lbs ounce ounces oz ton tons "
         "ml cl l liter liters litre litres gallon gallons second seconds sec minute minutes min hour hours day days week weeks month months year years "
         "dollar dollars euro euros cent cents percent meter meters metre metres kilometer kilometers kilometre kilometres degree degrees mph kmh").split()

NAME_MARK, NUMBER_MARK, UNIT_MARK, PLAIN = "\x01", "\x02", "\x03", "\x04"
NAME = r"\p{Lu}(?<=[\p{L}\p{N},;] \p{Lu})\p{Ll}+(?![\p{L}\p{N}])"
SEPARATOR = r"(?<=[0-9])[.,](?=[0-9])"
NUMBER = r"(?<![\p{L}\p{N}_])[0-9][0-9_]*(?:st|nd|rd|th)?(?![\p{L}\p{N}_])"
UNIT = r"(?<=\x02[0-9_]{1,40} ?)(?:" + "|".join(sorted(UNITS, key=len, reverse=True)) + r")(?![\p{L}\p{N}])"
BETWEEN = r"[^\p{L}\p{N}_\x01-\x03]+"

# The same for folded white space: a name or unit that only counts as one when a line break or several blanks are read as one.
WIDE_NAME_MARK, WIDE_UNIT_MARK, WIDE_BLANK, WIDE_PLAIN = "\x04", "\x05", "\x06", "\x06"
WIDE = r"[\s\p{Z}]{2,}|[\s\p{Z}&&[^ ]]"
WIDE_NAME = r"\p{Lu}(?<=[\p{L}\p{N},;]\x06 \p{Lu})\p{Ll}+(?![\p{L}\p{N}])"
WIDE_UNIT = UNIT.replace(" ?)", "\x06 )", 1)
WIDE_BETWEEN = BETWEEN.replace("\\x03", "\\x05")


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once for a row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def template_words(text: Column) -> Column:
    """Lower-case words; a word that is a slot has its mark before it."""
    clean = F.translate(F.coalesce(text.cast("string"), F.lit("")), "\x01\x02\x03_", "    ")

    def marked(named: Column) -> Column:
        joined = F.regexp_replace(F.lower(named), SEPARATOR, "_")
        counted = F.regexp_replace(joined, NUMBER, NUMBER_MARK + "$0")
        return F.when(F.rlike(named, F.lit("[0-9]")), F.regexp_replace(counted, UNIT, UNIT_MARK + "$0")).otherwise(F.lower(named))

    named = F.regexp_replace(clean, NAME, NAME_MARK + "$0")
    return F.array_remove(F.split(let(named, marked), BETWEEN), "")


def word_hashes(words: Column) -> Column:
    """The hash of every word; a slot counts as its mark."""
    return F.transform(words, lambda w: F.xxhash64(F.when(w < PLAIN, F.substring(w, 1, 1)).otherwise(w)))


def slot_words(words: Column) -> Column:
    """The marked words, null elsewhere; null if there are none."""
    return F.when(F.exists(words, lambda w: w < PLAIN), F.transform(words, lambda w: F.when(w < PLAIN, w)))


def window(hashes: Column, slots: Column, at: Column, size: int) -> tuple[Column, Column]:
    """Hash and slots of the window of ``size`` words from place ``at`` (0 first). Elements are taken one by one: a slice would copy
    the whole array for every window."""
    marked = F.when(slots.isNotNull(), F.array_compact(F.array(*[slots[at + k] for k in range(size)])))
    return F.xxhash64(*[hashes[at + k] for k in range(size)]).alias("hash"), marked.alias("slots")


def windows_of(words: Column, sizes: list[int]) -> Column:
    """array<struct<hash, slots, at>> of all windows of a document."""
    def sized(x: Column, size: int) -> Column:
        n = F.size(x.hashes)
        places = F.when(n >= size, F.sequence(F.lit(0), n - size)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.struct(*window(x.hashes, x.slots, i, size), i.alias("at")))

    def of(x: Column) -> Column:
        return F.concat(*[sized(x, size) for size in sizes])

    return let(words, lambda w: let(F.struct(word_hashes(w).alias("hashes"), slot_words(w).alias("slots")), of))


def item_windows(benchmark: DataFrame, size: int, least: int) -> DataFrame:
    """item_id, size, hash, item_slots, item_at of the windows of every item."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), template_words(F.col("text")).alias("words"))
    items = items.withColumn("size", F.least(F.lit(size), F.size("words"))).where(F.col("size") >= least)
    rows = None
    for n in range(least, size + 1):
        found = items.where(F.col("size") == n).select("item_id", "size", F.explode(windows_of(F.col("words"), [n])).alias("w"))
        rows = found if rows is None else rows.unionByName(found)
    rows = rows.select("item_id", "size", "w.hash", F.col("w.slots").alias("item_slots"), F.col("w.at").alias("item_at"))
    return rows.where(F.col("size") - F.coalesce(F.size("item_slots"), F.lit(0)) >= least).distinct()


def window_hits(docs: DataFrame, items: DataFrame, size: int, windows: Callable[[Column, list[int]], Column]) -> DataFrame:
    """doc_id, item_id, at, shift and slots of both sides of every window that a document shares with an item; whether the forms are
    own ones, if the windows say so."""
    items = written(items, "item-windows")
    sizes = sorted(r.size_ for r in items.select(F.col("size").alias("size_")).distinct().collect())  # at most ``size`` numbers
    found = F.explode(windows(F.col("text"), sizes or [size]))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), found.alias("w")).select("doc_id", "w.*")
    hits = rows.join(items, "hash").where(F.coalesce(F.size("slots"), F.lit(0)) == F.coalesce(F.size("item_slots"), F.lit(0)))
    own = [(F.col("own") & F.col("item_own")).alias("own")] if "item_own" in items.columns else []
    return hits.select("doc_id", "item_id", "at", (F.col("at") - F.col("item_at")).alias("shift"), "slots", "item_slots", *own).distinct()


def slot_pairs() -> Column:
    """Distinct (item's value, document's value) of a window; null without slots."""
    return F.when(F.size("slots") > 0, F.array_distinct(F.zip_with("item_slots", "slots", lambda a, b: F.struct(a.alias("a"), b.alias("b")))))


def contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 13, least: int = 5) -> DataFrame:
    """doc_id, item_id, n_windows (matched window places) and kind of every document that holds a passage whose slots are one-to-one
    throughout: what the SQL counterpart says. ``leaks`` also finds passages that keep to this in parts only."""
    hits = window_hits(docs, item_windows(benchmark, size, least), size, lambda text, sizes: windows_of(template_words(text), sizes))
    # sets of one passage are bounded by the length of the item
    passages = hits.groupBy("doc_id", "item_id", "shift").agg(F.count("*").alias("n"), F.array_distinct(F.flatten(F.collect_set(slot_pairs()))).alias("pairs"))
    n = F.size("pairs")
    one_to_one = (F.size(F.array_distinct("pairs.a")) == n) & (F.size(F.array_distinct("pairs.b")) == n)
    exact = ~F.exists("pairs", lambda p: p.a != p.b)
    sound = passages.where(one_to_one).select("doc_id", "item_id", "n", exact.alias("exact"))
    return sound.groupBy("doc_id", "item_id").agg(F.sum("n").alias("n_windows"), F.when(F.max("exact"), "exact").otherwise("reparameterised").alias("kind"))


def folded_words(text: Column) -> Column:
    """Lower-case words as in ``template_words``; names and units after other white space than one blank have marks of their own."""
    clean = F.translate(F.coalesce(text.cast("string"), F.lit("")), "\x01\x02\x03\x04\x05\x06_", "       ")
    clean = F.replace(F.replace(clean, F.lit("ß"), F.lit("ss")), F.lit("ẞ"), F.lit("SS"))

    def marked(named: Column) -> Column:
        joined = F.regexp_replace(F.lower(named), SEPARATOR, "_")
        counted = F.regexp_replace(F.regexp_replace(F.regexp_replace(joined, NUMBER, NUMBER_MARK + "$0"), UNIT, UNIT_MARK + "$0"), WIDE_UNIT, WIDE_UNIT_MARK + "$0")
        return F.when(F.rlike(named, F.lit("[0-9]")), counted).otherwise(F.lower(named))

    folded = F.regexp_replace(clean, WIDE, WIDE_BLANK + " ")
    named = F.regexp_replace(F.regexp_replace(folded, NAME, NAME_MARK + "$0"), WIDE_NAME, WIDE_NAME_MARK + "$0")
    return F.array_remove(F.split(let(named, marked), WIDE_BETWEEN), "")


def word_forms(words: Column) -> Column:
    """What the windows of a text are made of, null but ``typed`` if it has no slot: hashes of the words as written, as templates, as
    templates with folded white space, and as such with names as written; and the slots of the last three."""
    def bare(w: Column) -> Column:
        return F.substring(w, 2, 1 << 30)

    def kind(w: Column) -> Column:
        return F.translate(F.substring(w, 1, 1), WIDE_NAME_MARK + WIDE_UNIT_MARK, NAME_MARK + UNIT_MARK)

    def of(w: Column) -> Column:
        any_mark = w < WIDE_PLAIN
        typed = F.when(w < PLAIN, F.substring(w, 1, 1)).when(any_mark, bare(w)).otherwise(w)
        folded = F.when(any_mark, kind(w)).otherwise(w)
        numbered = F.when(any_mark & (kind(w) != NAME_MARK), kind(w)).when(any_mark, bare(w)).otherwise(w)
        slot = F.when(any_mark, F.concat(kind(w), bare(w)))
        return F.struct(
            F.xxhash64(F.when(any_mark, bare(w)).otherwise(w)).alias("literal"), F.xxhash64(typed).alias("typed"), F.xxhash64(folded).alias("folded"), F.xxhash64(numbered).alias("numbered"),
            F.when(w < PLAIN, w).alias("slots"), slot.alias("folded_slots"), F.when(kind(w) != NAME_MARK, slot).alias("numbered_slots"))

    names = ["literal", "folded", "numbered", "slots", "folded_slots", "numbered_slots"]
    plain = F.struct(F.transform(words, lambda w: F.xxhash64(w)).alias("typed"), *[F.lit(None).cast("array<string>" if "slots" in k else "array<long>").alias(k) for k in names])
    full = let(F.transform(words, of), lambda x: F.struct(x["typed"].alias("typed"), *[x[k].alias(k) for k in names]))
    return F.when(F.exists(words, lambda w: w < WIDE_PLAIN), full).otherwise(plain)


def window_forms(x: Column, at: Column, size: int, least: int) -> Column:
    """array<struct<hash, slots, at, own>>: the window as written and, with ``least`` plain words, as templates: the ``own`` one, with
    white space folded, so with names as written, and so with its first word as written, which opens a sentence in the item. A window
    without slots has one form."""
    def take(name: str) -> list[Column]:
        return [x[name][at + k] for k in range(size)]

    def form(hashes: list[Column], slots: Column, own: bool) -> Column:
        return F.struct(F.xxhash64(*hashes).alias("hash"), slots.alias("slots"), at.alias("at"), F.lit(own).alias("own"))

    def typed(name: str, slots: str, own: bool, when: Column, first: int = 0) -> Column:
        def of(found: Column) -> Column:
            return F.when(when & (size - F.size(found) >= least), form(take("literal")[:first] + take(name)[first:], F.when(F.size(found) > 0, found), own))

        return let(F.array_compact(F.array(*take(slots)[first:])), of)

    none = F.lit(None).cast("array<string>")
    literal = form(take("literal"), none, False)
    if size < least:
        marked = F.array(literal)
    else:
        wide = F.exists(F.array(*[~a.eqNullSafe(b) for a, b in zip(take("slots"), take("folded_slots"))]), lambda d: d)
        named = F.exists(F.array(*[a.eqNullSafe(b) for a, b in zip(take("numbered_slots"), take("folded_slots"))]), lambda same: ~same)
        first = x["folded_slots"][at].isNotNull() & x["numbered_slots"][at].isNull()
        marked = F.array_compact(F.array(literal, typed("typed", "slots", True, F.lit(True)), typed("folded", "folded_slots", False, wide),
                                         typed("numbered", "numbered_slots", False, named), typed("folded", "folded_slots", False, first, 1)))
    return F.when(F.coalesce(*take("folded_slots")).isNull(), F.array(form(take("typed"), none, size >= least))).otherwise(marked)


def all_forms(words: Column, sizes: list[int], least: int) -> Column:
    """array<struct<hash, slots, at, own>> of all forms of all windows of a text."""
    def sized(x: Column, size: int) -> Column:
        n = F.size(x.typed)
        places = F.when(n >= size, F.sequence(F.lit(0), n - size)).otherwise(F.array().cast("array<int>"))
        return F.flatten(F.transform(places, lambda i: window_forms(x, i, size, least)))

    def of(x: Column) -> Column:
        return F.concat(*[sized(x, size) for size in sizes])

    return let(words, lambda w: let(word_forms(w), of))


def item_forms(benchmark: DataFrame, size: int, least: int) -> DataFrame:
    """item_id, size, hash, item_slots, item_at, item_own of all forms of the windows of every item with a word."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), folded_words(F.col("text")).alias("words"))
    items = items.withColumn("size", F.least(F.lit(size), F.size("words")))
    rows = None
    for n in range(1, size + 1):
        found = items.where(F.col("size") == n).select("item_id", "size", F.explode(all_forms(F.col("words"), [n], least)).alias("w"))
        rows = found if rows is None else rows.unionByName(found)
    return rows.select("item_id", "size", "w.hash", F.col("w.slots").alias("item_slots"), F.col("w.at").alias("item_at"), F.col("w.own").alias("item_own")).distinct()


def leaks(docs: DataFrame, benchmark: DataFrame, size: int = 13, least: int = 5) -> DataFrame:
    """doc_id, item_id, n_windows and kind of every document that shares a window with an item, as written or as a template in which
    each value of the item stands for one value in the document. Windows are judged one by one; ``exact`` needs a passage of own values
    only. n_windows is the number of places that match as templates; if there is none, of those that match in another form."""
    hits = window_hits(docs, item_forms(benchmark, size, least), size, lambda text, sizes: all_forms(folded_words(text), sizes, least))
    pairs = F.coalesce(slot_pairs(), F.array().cast("array<struct<a:string,b:string>>"))
    sound = hits.select("doc_id", "item_id", "at", "shift", "own", pairs.alias("pairs")).where(F.size(F.array_distinct("pairs.a")) == F.size("pairs"))
    exact = ~F.exists("pairs", lambda p: p.a != p.b)
    places = sound.groupBy("doc_id", "item_id", "shift", "at").agg(F.max(exact).alias("exact"), F.max(F.col("own").cast("long")).alias("own"))
    passages = places.groupBy("doc_id", "item_id", "shift").agg(F.count("*").alias("n"), F.sum("own").alias("n_own"), F.min("exact").alias("exact"))
    n = F.coalesce(F.nullif(F.sum("n_own"), F.lit(0)), F.sum("n"))
    return passages.groupBy("doc_id", "item_id").agg(n.alias("n_windows"), F.when(F.max("exact"), "exact").otherwise("reparameterised").alias("kind"))
