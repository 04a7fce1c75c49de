"""Classes, buckets, tiers, seasons and their fixed tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import ColumnLike, as_col, round_to

# Score classes and their cuts (a score at a cut belongs to the upper class).
CLASSES = ["Poor", "Fair", "Good", "Very Good", "Excellent"]
CLASS_CUTS = [40.0, 60.0, 75.0, 90.0]
GOOD_INDEX = 2

# Lead buckets with their probability spread.
LEAD_BUCKETS = [("0-3", 0, 3), ("4-7", 4, 7), ("8-14", 8, 14), ("15-30", 15, 30)]
P_SPREAD = {"0-3": 8.0, "4-7": 10.0, "8-14": 14.0, "15-30": 20.0}

# Confidence tiers by lead day.
CONFIDENCE_TIERS = [
    (1, 0, 6, "high", "High confidence"),
    (2, 7, 14, "moderate", "Moderate confidence"),
    (3, 15, 30, "outlook", "Outlook / trend only"),
]

# Driver terms of the score, in storage order.
TERMS = ["sst", "season", "tide", "moon", "pressure", "swell", "front", "chl"]

# Sample-size rules (pairs, target dates, issuances).
PRELIMINARY_FLOOR = (30, 10, 3)
REPORTABLE_FLOOR = (100, 30, 10)


def score_class_index(score: ColumnLike) -> Column:
    s = as_col(score)
    return F.when(s.isNotNull(), sum((s >= c).cast("int") for c in CLASS_CUTS))


def score_class(score: ColumnLike) -> Column:
    names = F.array(*[F.lit(c) for c in CLASSES])
    return F.get(names, score_class_index(score))


def lead_bucket(lead: ColumnLike) -> Column:
    lead = as_col(lead)
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, lo, hi in LEAD_BUCKETS:
        out = out.when(lead.between(lo, hi), F.lit(name))
    return out


def horizon_group(lead: ColumnLike) -> Column:
    return F.when(as_col(lead) <= 7, "short_0_7").otherwise("outlook_8_30")


def tier_for_lead(lead: ColumnLike) -> Column:
    """Struct(tier, key, label)."""
    lead = as_col(lead)
    rows = [F.struct(F.lit(t).alias("tier"), F.lit(k).alias("key"), F.lit(l).alias("label"))
            for t, _, _, k, l in CONFIDENCE_TIERS]
    return F.when(lead <= 6, rows[0]).when(lead <= 14, rows[1]).otherwise(rows[2])


def p_good(score: ColumnLike, lead: ColumnLike) -> Column:
    """Probability of "Good or better": logistic around 60, wider with lead."""
    lead = as_col(lead)
    spread = F.when(F.lit(False), F.lit(None).cast("double"))
    for name, lo, hi in LEAD_BUCKETS:
        spread = spread.when(lead.between(lo, hi), F.lit(P_SPREAD[name]))
    return round_to(1.0 / (1.0 + F.exp(-(as_col(score) - CLASS_CUTS[1]) / spread)), 4)


def sample_flag(pairs: ColumnLike, dates: ColumnLike, issuances: ColumnLike) -> Column:
    counts = [as_col(pairs), as_col(dates), as_col(issuances)]

    def below(floor):
        a, b, c = (x < f for x, f in zip(counts, floor))
        return a | b | c

    return (F.when(below(PRELIMINARY_FLOOR), "insufficient")
             .when(below(REPORTABLE_FLOOR), "preliminary")
             .otherwise("reportable"))


def meteorological_season(month: ColumnLike) -> Column:
    m = as_col(month)
    return (F.when(m.isin(12, 1, 2), "DJF").when(m.isin(3, 4, 5), "MAM")
             .when(m.isin(6, 7, 8), "JJA").when(m.isin(9, 10, 11), "SON"))


def season_start(day: ColumnLike, first_month: int = 3) -> Column:
    """Start of the running season: the latest 1 March not after the day."""
    d = as_col(day)
    year = F.year(d) - (F.month(d) < first_month).cast("int")
    return F.make_date(year, F.lit(first_month), F.lit(1))


def index_regime(v: ColumnLike) -> Column:
    v = as_col(v)
    return (F.when(v.isNull(), F.lit(None).cast("string"))
             .when(v >= 1.5, "Strong El Nino").when(v >= 0.5, "El Nino")
             .when(v <= -1.5, "Strong La Nina").when(v <= -0.5, "La Nina")
             .otherwise("Neutral"))


def simple_regime(v: ColumnLike) -> Column:
    v = as_col(v)
    return (F.when(v.isNull(), F.lit(None).cast("string"))
             .when(v >= 0.5, "El Nino").when(v <= -0.5, "La Nina").otherwise("Neutral"))


def trend_label(delta: ColumnLike) -> Column:
    d = as_col(delta)
    return (F.when(d.isNull(), "unknown").when(d >= 8, "well above typical").when(d >= 3, "above typical")
             .when(d > -3, "near typical").when(d > -8, "below typical").otherwise("well below typical"))
