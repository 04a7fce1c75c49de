"""Report text: catch counts, trip types, place hints, keys and flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import ColumnLike, as_col

# Spoken names and the subject id they count for.
SPECIES_ALIASES = {
    "california halibut": "california_halibut", "halibut": "california_halibut",
    "calico bass": "calico_bass", "calico": "calico_bass", "kelp bass": "calico_bass",
    "sand bass": "sand_bass", "sandbass": "sand_bass", "barred sand bass": "sand_bass",
    "spotted bay bass": "spotted_bay_bass", "bass (spotted bay)": "spotted_bay_bass",
    "corbina": "corbina", "california corbina": "corbina",
    "barred surfperch": "barred_surfperch", "surfperch": "barred_surfperch",
    "rockfish": "rockfish", "red snapper": "rockfish", "vermilion": "rockfish",
    "vermilion rockfish": "rockfish", "rockcod": "rockfish", "rock cod": "rockfish",
    "sheephead": "sheephead", "california sheephead": "sheephead",
    "barracuda": "barracuda", "california barracuda": "barracuda",
    "bonito": "bonito", "boneheads": "bonito", "pacific bonito": "bonito",
    "yellowtail": "yellowtail", "yellows": "yellowtail", "firecracker yellowtail": "yellowtail",
    "white seabass": "white_seabass", "wsb": "white_seabass",
    "bluefin tuna": "bluefin_tuna", "bluefin": "bluefin_tuna",
    "yellowfin tuna": "yellowfin_tuna", "yellowfin": "yellowfin_tuna",
    "dorado": "dorado", "mahi": "dorado", "mahi mahi": "dorado", "mahi-mahi": "dorado",
    "whitefish": "ocean_whitefish", "ocean whitefish": "ocean_whitefish",
}
# Alias targets that are kept apart from the modelled subjects.
UNMODELLED = {"ocean_whitefish"}

# Trip length in days by trip type.
TRIP_DAYS = {"half_day": 0.5, "three_quarter_day": 0.75, "full_day": 1.0, "twilight": 0.4,
             "overnight": 1.0, "1.5_day": 1.5, "2_day": 2.0, "2.5_day": 2.5, "3_day": 3.0,
             "3.5_day": 3.5, "4_day": 4.0, "5_day": 5.0, "7_day": 7.0}

# Landing names as written in reports and their short form.
LANDINGS = {"Fisherman's Landing": "Fishermans", "H&M Landing": "H&M",
            "Point Loma Sportfishing": "Point Loma", "Seaforth Sportfishing": "Seaforth",
            "Sea Forth Sportfishing": "Seaforth", "Islandia Sportfishing": "Islandia",
            "Fisherman's Landing Fish Counts": "Fishermans"}

MONTHS = ("January|February|March|April|May|June|July|August|September|October|November|December")


def literal_map(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def trip_days(trip_type: ColumnLike) -> Column:
    return F.coalesce(F.try_element_at(literal_map(TRIP_DAYS), as_col(trip_type)), F.lit(1.0))


def _bind(value: Column, fn) -> Column:
    """Evaluate ``value`` once and hand it to ``fn`` (a lambda variable is not recomputed per use)."""
    return F.transform(F.array(value), fn)[0]


def count_items(text: ColumnLike, aliases: dict[str, str] | None = None) -> Column:
    """Entries like "12 Calico Bass Released" as structs (n, released, hit), hit being a struct (key, mapped).

    Lambda bodies are interpreted: there are few passes, each value is used once, and a lookup is tried on names it can hold only.
    """
    aliases = aliases or SPECIES_ALIASES
    released = r"(?i)\breleased?\b"
    hit = lambda key, mapped: F.struct(key.alias("key"), F.lit(mapped).alias("mapped"))
    table = F.create_map(*[x for name, sid in aliases.items() for x in (F.lit(name), hit(F.lit(sid), sid not in UNMODELLED))])
    parts = F.filter(F.split(F.coalesce(as_col(text), F.lit("")), r",(?![^()]*\))"), lambda p: p.rlike(r"^\s*\d+\s+\S"))
    counted = F.transform(parts, lambda p: F.struct(
        F.regexp_extract(p, r"^\s*(\d+)", 1).try_cast("bigint").alias("n"),
        F.regexp_replace(F.regexp_replace(p, r"^\s*\d+\s+|\([^)]*\)", ""), r"(?i)\bup to .*$", "").alias("name")))
    named = F.transform(counted, lambda i: F.struct(
        i["n"].alias("n"), i["name"].rlike(released).alias("released"),
        F.lower(F.trim(one_space(F.regexp_replace(i["name"], released, "")), F.lit(" .-"))).alias("name")))
    slug = lambda name: F.regexp_replace(F.regexp_replace(name, r"[^a-z0-9]+", "_"), r"^_+|_+$", "")
    return F.transform(F.filter(named, lambda i: i["name"] != ""), lambda i: F.struct(
        i["n"].alias("n"), i["released"].alias("released"), F.coalesce(
            F.when(i["name"].isin(*aliases), F.try_element_at(table, i["name"])),
            F.when(i["name"].endswith("s"), F.try_element_at(table, F.regexp_replace(i["name"], "s+$", ""))),
            F.when(i["name"].endswith("rockfish"), hit(F.lit("rockfish"), True)), hit(slug(i["name"]), False)).alias("hit")))


def one_space(text: Column) -> Column:
    """Every run of white space as one space; a single space is no match, so most texts stay as they are."""
    return F.regexp_replace(text, r"\s{2,}|[^\S ]", " ")


def count_map(items: ColumnLike, mapped: bool, released: bool) -> Column:
    """Map key -> sum of n over the items of one bucket."""
    def sums(chosen: Column) -> Column:
        return _bind(F.sort_array(F.array_distinct(F.transform(chosen, lambda i: i["hit"]["key"]))), lambda keys: F.map_from_arrays(
            keys, F.transform(keys, lambda k: F.aggregate(chosen, F.lit(0).cast("bigint"), lambda acc, i: F.try_add(acc, F.when(i["hit"]["key"] == k, i["n"]).otherwise(F.lit(0).cast("bigint")))))))

    yes = lambda flag, wanted: flag if wanted else ~flag
    return _bind(F.filter(as_col(items), lambda i: yes(i["hit"]["mapped"], mapped) & yes(i["released"], released)), sums)


#: The buckets of a list of counts: name, mapped, released.
BUCKETS = (("kept", True, False), ("released", True, True), ("unmapped", False, False), ("unmapped_released", False, True))


def parse_counts(text: ColumnLike, aliases: dict[str, str] | None = None) -> Column:
    """Struct of maps kept / released / unmapped / unmapped_released from a comma list of counts.

    Commas inside parentheses do not separate. The whole list is handled inside its own row, so
    no shuffle is needed to add up repeated names. A number or sum beyond 64 bits is null.
    """
    return _bind(count_items(text, aliases), lambda items: F.struct(*[count_map(items, m, r).alias(name) for name, m, r in BUCKETS]))


def trip_type_page(raw: ColumnLike, corrected: bool = False) -> Column:
    """Trip vocabulary of the page parser. Rule order matters: "1 1/2 day" contains "1/2 day" and is
    read as a half day; ``corrected`` tests the longer phrases first."""
    s = F.lower(as_col(raw))
    days = F.regexp_extract(s, r"(\d+)\s*day", 1)
    half = (s.contains("1/2 day") | s.contains("half day") | s.contains("twilight"), "half_day")
    fractions = [(s.contains(f"{n}.5 day") | s.contains(f"{n} 1/2 day"), f"{n}.5_day") for n in (3, 2, 1)]
    three_quarter = (s.contains("3/4 day"), "three_quarter_day")
    rules = [*fractions, half, three_quarter] if corrected else [half, three_quarter, *fractions]
    out = F.when(s.isNull(), F.lit(None).cast("string"))
    for cond, name in rules:
        out = out.when(cond, F.lit(name))
    return (out.when((days != "") & (days.cast("int") >= 2), F.concat(days.cast("int").cast("string"), F.lit("_day")))
               .when(s.contains("overnight"), "overnight").when(s.contains("full day"), "full_day")
               .when(s.contains("extended") | s.contains("day"), "multi_day").otherwise("unknown"))


def trip_type(raw: ColumnLike) -> Column:
    """Trip vocabulary of the outcome path."""
    s = F.lower(as_col(raw))
    days = F.regexp_extract(s, r"(\d+(?:\.5)?)\s*day", 1)
    return (F.when(s.isNull(), F.lit(None).cast("string")).when(s.contains("twilight"), "twilight")
             .when(s.contains("1/2 day") | s.contains("half day"), "half_day")
             .when(s.contains("3/4 day"), "three_quarter_day").when(s.contains("full day"), "full_day")
             .when(s.contains("overnight"), "overnight")
             .when(days != "", F.concat(days, F.lit("_day"))).otherwise("unknown"))


def zone_hint(raw: ColumnLike, trip: ColumnLike) -> Column:
    s, t = F.lower(as_col(raw)), as_col(trip)
    long_trip = t.isin("overnight", "1.5_day", "2_day", "2.5_day", "3_day", "3.5_day", "4_day", "5_day", "multi_day")
    return (F.when(s.contains("coronado"), "coronados").when(s.contains("offshore") | long_trip, "offshore")
             .when(s.contains("bay"), "bay")
             .when(s.contains("local") | t.isin("half_day", "three_quarter_day", "full_day"), "point loma kelp")
             .otherwise("unknown"))


def zone_hint_naive(raw: ColumnLike, corrected: bool = False) -> Column:
    """Hint of the daily-report path: any "<number> day" reads as offshore, also "1/2 day"."""
    s = F.lower(as_col(raw))
    number = r"(?<!/)\b\d+(\.5)?\s*day" if corrected else r"\d+(\.5)?\s*day"
    return (F.when(s.rlike("offshore|overnight|" + number), "offshore")
             .when(s.contains("coronado"), "coronados").otherwise("point loma kelp"))


def classify_trip(raw: ColumnLike, trip: ColumnLike) -> Column:
    """Struct(region, flag): the outcome region a trip can be attributed to, or why it cannot."""
    s, t = F.lower(F.coalesce(as_col(raw), F.lit(""))), F.coalesce(as_col(trip), F.lit(""))
    days = F.try_element_at(literal_map(TRIP_DAYS), t)

    def to(region=None, flag=None):
        return F.struct(F.lit(region).cast("string").alias("region"), F.lit(flag).cast("string").alias("flag"))

    return (F.when(s.contains("coronado"), to("coronados"))
             .when(days >= 3.0, to(flag="out_of_domain_long_range"))
             .when(t.isin("2_day", "2.5_day"), to("extended_offshore"))
             .when(t == "1.5_day", to("offshore_banks"))
             .when(t == "overnight", to("offshore_banks", "overnight_destination_uncertain"))
             .when(s.contains("offshore"), to("offshore_banks"))
             .when(t.isin("half_day", "three_quarter_day", "twilight") | s.contains("local"), to("kelp_nearshore"))
             .when(t == "full_day", to(flag="ambiguous_full_day"))
             .otherwise(to(flag="unknown_trip_type")))


def page_date(text: ColumnLike) -> Column:
    """First "Month d, yyyy" in a text as a date."""
    return F.to_date(F.try_to_timestamp(F.nullif(F.regexp_extract(as_col(text), rf"((?:{MONTHS}) \d{{1,2}}, \d{{4}})", 1),
                                                 F.lit("")), F.lit("MMMM d, yyyy")))


def content_id(*cols: ColumnLike) -> Column:
    """First 16 hex digits of the SHA-256 over the joined texts."""
    parts = [F.coalesce(as_col(c).cast("string"), F.lit("")) for c in cols]
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 16)


def key_text(*cols: ColumnLike) -> Column:
    return F.concat_ws("|", *[as_col(c).cast("string") for c in cols])


def flags(*conditions: tuple[Column, ColumnLike]) -> Column:
    """Ordered distinct flags joined by ";", or null when none applies."""
    arr = F.array(*[F.when(cond, F.lit(name) if isinstance(name, str) else name) for cond, name in conditions])
    return F.nullif(F.array_join(F.array_distinct(F.array_compact(arr)), ";"), F.lit(""))


def has_flag(flags_col: ColumnLike, name: str) -> Column:
    return F.coalesce(F.array_contains(F.split(as_col(flags_col), ";"), name), F.lit(False))
