"""Null-safe numeric column expressions: limits, shapes, rounding, units and the normal CDF."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str | float | int


def as_col(x: ColumnLike) -> Column:
    """Column names and Columns pass through, numbers become literals."""
    if isinstance(x, Column):
        return x
    return F.col(x) if isinstance(x, str) else F.lit(x)


def nan_to_null(c: ColumnLike) -> Column:
    """NaN means "missing" in every source; null is the only marker past ingestion."""
    c = as_col(c)
    return F.when(~F.isnan(c), c)


def clamp(v: ColumnLike, lo: float = 0.02, hi: float = 1.0) -> Column:
    """Limit to [lo, hi]; null stays null (greatest/least alone would drop the null)."""
    v = as_col(v)
    return F.when(v.isNotNull(), F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), v)))


def limit(v: ColumnLike, lo: float = 0.02, hi: float = 1.0) -> Column:
    """``clamp`` for values already known to be present: one reference, so nested use stays small."""
    return F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), as_col(v)))


def trapezoid(x: ColumnLike, a: ColumnLike, b: ColumnLike, c: ColumnLike, d: ColumnLike) -> Column:
    """Suitability rising over a..b, full over b..c, falling over c..d, with a 0.02 floor."""
    x, a, b, c, d = map(as_col, (x, a, b, c, d))
    floor, rise = 0.02, 0.98
    return (F.when(x.isNull(), F.lit(None).cast("double"))
             .when((x <= a) | (x >= d), F.lit(floor))
             .when(x < b, floor + rise * (x - a) / (b - a))
             .when(x <= c, F.lit(1.0))
             .otherwise(floor + rise * (d - x) / (d - c)))


def gaussian(distance: ColumnLike, sigma: float) -> Column:
    d = as_col(distance)
    return F.exp(-(d * d) / (2.0 * sigma * sigma))


def round_to(v: ColumnLike, digits: int) -> Column:
    """Half-even decimal rounding on the scaled binary value."""
    scale = float(10 ** digits)
    return F.rint(as_col(v) * scale) / scale


def safe_ratio(num: ColumnLike, den: ColumnLike) -> Column:
    """num / den, null for a null or zero denominator."""
    num, den = as_col(num), as_col(den)
    return F.when(den != 0, num / den)


def soft_ceiling(v: ColumnLike, knee: float = 0.90, span: float = 0.10) -> Column:
    """Monotone compression above the knee, so high scores keep their order below 1."""
    v = as_col(v)
    return F.when(v <= knee, v).otherwise(knee + span * (1.0 - F.exp(-(v - knee) / span)))


def inverse_soft_ceiling(v: ColumnLike, knee: float = 0.90, span: float = 0.10) -> Column:
    v = as_col(v)
    x = F.least((v - knee) / span, F.lit(0.999999))
    return F.when(v <= knee, v).otherwise(knee - span * F.log(1.0 - x))


def piecewise_linear(x: ColumnLike, knots: list[tuple[float, float]]) -> Column:
    """Linear interpolation through ascending knots, constant outside them."""
    x = as_col(x)
    out = F.when(x.isNull(), F.lit(None).cast("double")).when(x <= knots[0][0], F.lit(float(knots[0][1])))
    for (x0, y0), (x1, y1) in zip(knots, knots[1:]):
        out = out.when(x <= x1, y0 + (y1 - y0) * (x - x0) / (x1 - x0))
    return out.otherwise(F.lit(float(knots[-1][1])))


# Coefficients of the Abramowitz-Stegun 7.1.26 approximation of erf.
ERF_P = 0.3275911
ERF_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def erf(z: ColumnLike) -> Column:
    """Error function (absolute error below 1.5e-7), kept in generated code."""
    z = as_col(z)
    a = F.abs(z)
    t = 1.0 / (1.0 + ERF_P * a)
    poly = F.lit(0.0)
    for k in reversed(ERF_A):
        poly = (poly + k) * t
    y = 1.0 - poly * F.exp(-a * a)
    return F.when(z < 0, -y).otherwise(y)


def anomaly_percentile(anomaly: ColumnLike, sd: ColumnLike) -> Column:
    """Percentile of an anomaly under a normal law, limited to 0.1..99.9; null without spread."""
    anomaly, sd = as_col(anomaly), as_col(sd)
    pct = 50.0 * (1.0 + erf(anomaly / (sd * math.sqrt(2.0))))
    return F.when((sd != 0) & anomaly.isNotNull(), clamp(pct, 0.1, 99.9))


# Unit factors.
FEET_PER_METRE = 3.28084
KNOTS_PER_MPS = 1.94384
KNOTS_PER_KMH = 0.539957


def celsius_to_fahrenheit(c: ColumnLike) -> Column:
    return as_col(c) * 9.0 / 5.0 + 32.0


def metres_to_feet(c: ColumnLike) -> Column:
    return as_col(c) * FEET_PER_METRE


def mps_to_knots(c: ColumnLike) -> Column:
    return as_col(c) * KNOTS_PER_MPS


def kmh_to_knots(c: ColumnLike) -> Column:
    return as_col(c) * KNOTS_PER_KMH


def cell_size_nm(lat_step: ColumnLike, lon_step: ColumnLike, mean_lat: ColumnLike) -> tuple[Column, Column]:
    """Height and width of a lat/lon grid cell in nautical miles."""
    return (as_col(lat_step) * 60.0,
            as_col(lon_step) * 60.0 * F.cos(F.radians(as_col(mean_lat))))
