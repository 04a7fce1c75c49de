"""Calendar, lead, time-zone and astronomical column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import ColumnLike, as_col, clamp

LOCAL_ZONE = "America/Los_Angeles"


def local_date(ts: ColumnLike, zone: str = LOCAL_ZONE) -> Column:
    """Calendar day of a UTC instant in a zone (session time zone is UTC)."""
    return F.to_date(F.from_utc_timestamp(as_col(ts), zone))


def day_end_utc(day: ColumnLike, zone: str = LOCAL_ZONE) -> Column:
    """UTC instant at which a local calendar day ends."""
    return F.to_utc_timestamp(F.date_add(as_col(day), 1).cast("timestamp"), zone)


def cyclic_doy(doy: ColumnLike, offset: ColumnLike) -> Column:
    """Day of year shifted on the 366-day circle."""
    return (F.pmod(as_col(doy) + as_col(offset) - 1, F.lit(366)) + 1).cast("int")


def doy_to_month(doy: ColumnLike) -> Column:
    """Month of a day-of-year in a non-leap calendar; day 366 wraps to January."""
    return F.month(F.date_add(F.lit("2025-01-01").cast("date"), as_col(doy).cast("int") - 1))


def parse_instant(text: ColumnLike) -> Column:
    """ISO instant to timestamp; bare dates and non-dates give null."""
    s = F.trim(as_col(text))
    usable = (F.length(s) > 10) & s.rlike(r"^\d{4}")
    return F.when(usable, F.try_to_timestamp(s))


def fishing_days(report_date: ColumnLike, trip_days: ColumnLike) -> Column:
    """Days covered by a trip that ended on the report date: one up to 1.5 days, else floor."""
    d, n = as_col(report_date), as_col(trip_days)
    count = F.when(n <= 1.5, F.lit(1)).otherwise(F.floor(n).cast("int"))
    return F.sequence(F.date_sub(d, count - 1), d)


def date_spine(start: ColumnLike, end: ColumnLike) -> Column:
    return F.sequence(as_col(start).cast("date"), as_col(end).cast("date"))


def refresh_due(last_success: ColumnLike, cadence: ColumnLike, today: ColumnLike, force: ColumnLike = None) -> Column:
    """Whether a source is due: daily after 1 day, weekly after 7, monthly after 28, or never fetched."""
    wait = F.when(as_col(cadence) == "weekly", 7).when(as_col(cadence) == "monthly", 28).otherwise(1)
    due = F.coalesce(F.datediff(as_col(today), as_col(last_success)) >= wait, F.lit(True))
    return due if force is None else (as_col(force) | due)


def freshness(age: ColumnLike, fresh: float, delayed: float) -> Column:
    """fresh / delayed / stale by age against two limits (3 h and 12 h, or 1 and 3 days)."""
    a = as_col(age)
    return (F.when(a.isNull(), F.lit(None).cast("string")).when(a <= fresh, "fresh")
             .when(a <= delayed, "delayed").otherwise("stale"))


# Lunar phase names with the upper age (days) each one reaches.
MOON_PHASES = [(1.5, "New"), (6.0, "Waxing Crescent"), (9.0, "First Quarter"), (13.5, "Waxing Gibbous"),
               (16.5, "Full"), (21.0, "Waning Gibbous"), (24.0, "Last Quarter"), (28.1, "Waning Crescent"),
               (30.0, "New")]
# Low-precision lunar series, (amplitude, multiples of D, M, M') in degrees.
LUNAR_ARGUMENTS = {"D": (297.8501921, 445267.1114034, -0.0018819), "M": (357.5291092, 35999.0502909, 0.0),
                   "Mp": (134.9633964, 477198.8675055, 0.0)}
LUNAR_SERIES = [(-6.289, 0, 0, 1), (2.100, 0, 1, 0), (-1.274, 2, 0, -1), (-0.658, 2, 0, 0),
                (-0.214, 0, 0, 2), (-0.110, 1, 0, 0)]
SYNODIC_MONTH = 29.530588
NEW_MOON_EPOCH_JD = 2451550.1
J2000_JD = 2451545.0
UNIX_EPOCH_JD = 2440587.5


def _wrap360(c: Column) -> Column:
    return F.pmod(c, F.lit(360.0))


def moon(day: ColumnLike) -> Column:
    """Struct(illumination, phase_angle, phase, age_days) at 12:00 UTC of a day."""
    jd = F.datediff(as_col(day), F.lit("1970-01-01").cast("date")) + 0.5 + UNIX_EPOCH_JD
    t = (jd - J2000_JD) / 36525.0
    arg = {k: _wrap360(F.lit(c0) + c1 * t + c2 * t * t) for k, (c0, c1, c2) in LUNAR_ARGUMENTS.items()}
    angle = 180.0 - arg["D"]
    for amp, d, m, mp in LUNAR_SERIES:
        angle = angle + amp * F.sin(F.radians(d * arg["D"] + m * arg["M"] + mp * arg["Mp"]))
    angle = _wrap360(angle)
    age = F.pmod((jd - NEW_MOON_EPOCH_JD) / SYNODIC_MONTH, F.lit(1.0)) * SYNODIC_MONTH
    phase = F.when(F.lit(False), F.lit(None).cast("string"))
    for limit, name in MOON_PHASES:
        phase = phase.when(age <= limit, F.lit(name))
    return F.struct(((1.0 + F.cos(F.radians(angle))) / 2.0).alias("illumination"),
                    angle.alias("phase_angle"), phase.alias("phase"), age.alias("age_days"))


# Fourier terms of the equation of time (minutes / 229.18) and solar declination (radians),
# as constant and (cos, sin) pairs for one, two and three times the day angle.
EQUATION_OF_TIME = (0.000075, [(0.001868, -0.032077), (-0.014615, -0.040849)])
DECLINATION = (0.006918, [(-0.399912, 0.070257), (-0.006758, 0.000907), (-0.002697, 0.00148)])
SUN_ZENITH_DEG = 90.833


def _fourier(angle: Column, terms) -> Column:
    const, pairs = terms
    out = F.lit(const)
    for k, (c, s) in enumerate(pairs, start=1):
        out = out + c * F.cos(k * angle) + s * F.sin(k * angle)
    return out


def sun(day: ColumnLike, lat: float = 32.72, lon: float = -117.22, utc_offset: int = -8) -> Column:
    """Struct(sunrise, sunset, daylight) in local clock hours; months 3..10 count as summer time."""
    d = as_col(day)
    angle = 2.0 * math.pi / 365.0 * (F.dayofyear(d) - 1 + 0.5)
    eq_minutes = 229.18 * _fourier(angle, EQUATION_OF_TIME)
    decl = _fourier(angle, DECLINATION)
    la = math.radians(lat)
    cos_h = (math.cos(math.radians(SUN_ZENITH_DEG)) / (math.cos(la) * F.cos(decl))) - math.tan(la) * F.tan(decl)
    ha = F.degrees(F.acos(clamp(cos_h, -1.0, 1.0)))
    shift = utc_offset + F.month(d).between(3, 10).cast("int")
    rise = (720.0 + 4.0 * (-lon - ha) - eq_minutes) / 60.0 + shift
    sset = (720.0 + 4.0 * (-lon + ha) - eq_minutes) / 60.0 + shift
    return F.struct(rise.alias("sunrise"), sset.alias("sunset"), (sset - rise).alias("daylight"))
