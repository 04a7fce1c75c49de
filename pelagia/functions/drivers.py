"""Driver suitabilities, the access gate and the score, as column expressions.

A driver term is a value in 0..1 (null = no data). The score is the weighted geometric mean of
the terms that exist, with the weights of the missing ones dropped and the rest renormalised,
times an anomaly multiplier and an access gate.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .classes import TERMS
from .numeric import (ColumnLike, as_col, clamp, gaussian, inverse_soft_ceiling, limit, round_to, soft_ceiling,
                      trapezoid)

# Neutral terms used when only the climatology of a place and day is known.
CLIMATOLOGY_TERMS = {"tide": 0.72, "moon": 0.72, "pressure": 0.85, "front": 0.6, "chl": 0.7}
# Chlorophyll response corners.
CHL_OPEN_WATER = (0.02, 0.15, 1.2, 6.0)
CHL_INSHORE = (0.05, 0.3, 3.0, 15.0)
OPEN_WATER_GROUPS = ("tuna", "pelagic")
TERM_FLOOR = 0.02
SCORE_LIMITS = (0.01, 1.35)
DEFAULT_ACCESS = 0.7
LN_HALF = math.log(0.5)


def tide_strength(tide_range: ColumnLike, rate: ColumnLike) -> Column:
    """Strength of the day's exchange from its range and fastest rate; null if either is missing."""
    rng, rate = as_col(tide_range), as_col(rate)
    by_range = limit(0.25 + 0.75 * F.least(F.lit(1.0), (rng - 2.0) / 4.5))
    by_rate = limit(0.25 + 0.75 * F.least(F.lit(1.0), (rate - 0.5) / 1.3))
    return F.when(rng.isNotNull() & rate.isNotNull(), 0.45 * by_range + 0.55 * by_rate)


def light_timing(best_hour: ColumnLike, sunrise: ColumnLike, sunset: ColumnLike) -> Column:
    """How close the best water is to dawn or dusk, 0.5 when unknown."""
    hour, rise, sset = map(as_col, (best_hour, sunrise, sunset))
    gap = F.least(F.abs(hour - rise), F.abs(hour - sset), F.abs(hour + 24 - rise), F.abs(hour - 24 - sset))
    known = hour.isNotNull() & rise.isNotNull() & sset.isNotNull()
    return F.when(known, limit(F.exp(-F.pow(gap, F.lit(2.0)) / 12.5))).otherwise(0.5)


def high_water_push(first_high: ColumnLike) -> Column:
    """How close the first high water is to 07:00 or 19:00, 0.5 when unknown."""
    h = as_col(first_high)
    gap = F.least(F.abs(h - 7), F.abs(h - 19))
    return F.when(h.isNotNull(), limit(F.exp(-F.pow(gap, F.lit(2.0)) / 24.5))).otherwise(0.5)


def tide_by_preference(pref: ColumnLike, strength: ColumnLike, timing: ColumnLike, push: ColumnLike) -> Column:
    pref, base, timing, push = map(as_col, (pref, strength, timing, push))
    mixed = (F.when(pref == "any", 0.6 + 0.4 * base)
              .when(pref == "strong_moving", 0.55 * base + 0.45 * (0.4 + 0.6 * timing))
              .when(pref == "high_pushing", 0.45 * base + 0.55 * (0.35 + 0.65 * push))
              .when(pref == "grey_light_moving", 0.4 * base + 0.6 * (0.3 + 0.7 * timing))
              .when(pref == "moderate", 1.0 - 0.9 * F.abs(base - 0.6))
              .otherwise(0.5 * base + 0.5 * (0.45 + 0.55 * timing)))
    return F.when(base.isNotNull(), limit(mixed))


def tide_term(pref: ColumnLike, tide_range: ColumnLike, rate: ColumnLike, best_hour: ColumnLike,
              sunrise: ColumnLike, sunset: ColumnLike, first_high: ColumnLike) -> Column:
    """Tide suitability by preference; strength of exchange combined with its timing."""
    return tide_by_preference(pref, tide_strength(tide_range, rate), light_timing(best_hour, sunrise, sunset),
                              high_water_push(first_high))


def moon_term(pref: ColumnLike, illumination: ColumnLike, age: ColumnLike) -> Column:
    pref, illum, age = map(as_col, (pref, illumination, age))
    extreme = 2.0 * F.abs(illum - 0.5)
    from_new = F.least(F.abs(age - 2.5), F.abs(age - 32.03))
    by_pref = (F.when(pref == "any", 0.85 + 0.125 * (1.0 - extreme))
                .when(pref == "spring_tide", limit(0.45 + 0.55 * extreme))
                .when((pref == "post_new_moon") & age.isNull(), 0.6)
                .when(pref == "post_new_moon", limit(0.35 + 0.65 * F.exp(-F.pow(from_new, F.lit(2.0)) / 18.0)))
                .when(pref == "dark_or_full_night", limit(0.5 + 0.5 * extreme))
                .otherwise(0.7))
    return F.when(illum.isNotNull(), by_pref)


def swell_term(wave: ColumnLike, tolerance: ColumnLike) -> Column:
    w, tol = as_col(wave), as_col(tolerance)
    calm, rough = tol * 0.35, tol * 1.9
    return (F.when(w.isNull(), F.lit(None).cast("double")).when(w <= calm, 1.0).when(w >= rough, 0.05)
             .otherwise(limit(1.0 - 0.95 * (w - calm) / (tol * 1.55))))


def pressure_term(trend: ColumnLike) -> Column:
    t = as_col(trend)
    return (F.when(t.isNull(), F.lit(None).cast("double")).when(t <= -4, 0.55).when(t <= -1, 1.0)
             .when(t <= 1, 0.85).when(t <= 4, 0.6).otherwise(0.4))


def front_term(gradient: ColumnLike, spread: ColumnLike) -> Column:
    v = F.coalesce(as_col(gradient), as_col(spread) / 12.0)
    return F.when(v.isNotNull(), limit(0.25 + 0.75 * F.least(F.lit(1.0), v / 0.6)))


def chl_term(group: ColumnLike, chl: ColumnLike) -> Column:
    c = as_col(chl)
    return F.when(as_col(group).isin(*OPEN_WATER_GROUPS), trapezoid(c, *CHL_OPEN_WATER)).otherwise(
        trapezoid(c, *CHL_INSHORE))


def access_limits(distance: ColumnLike) -> dict[str, Column]:
    """Wind and sea limits and the run factor of a place by its distance."""
    dist = as_col(distance)
    far = dist > 15
    return {"wind_max": F.when(dist < 5, 26.0).otherwise(22.0), "sea_ok": F.when(far, 3.5).otherwise(4.5),
            "sea_max": F.when(far, 9.0).otherwise(11.0), "run": F.when(dist < 12, 1.0).when(dist < 40, 0.9).otherwise(0.8)}


def access_within(wind: ColumnLike, wave: ColumnLike, period: ColumnLike, limits: dict[str, Column]) -> Column:
    w, sea, per = map(as_col, (wind, wave, period))
    wind_gate = trapezoid(w, -5.0, 0.0, 12.0, limits["wind_max"])
    sea_gate = trapezoid(sea, -1.0, 0.0, limits["sea_ok"], limits["sea_max"])
    chop = F.when((per < 8) & (sea > 3), 0.75).otherwise(1.0)
    gate = limit((wind_gate * 0.5 + sea_gate * 0.5) * chop * limits["run"], 0.05, 1.0)
    return F.when(w.isNull() | sea.isNull(), DEFAULT_ACCESS).otherwise(gate)


def access(wind: ColumnLike, wave: ColumnLike, period: ColumnLike, distance: ColumnLike) -> Column:
    """Share of a day that is workable (0.05..1) by wind, sea, chop and run length."""
    return access_within(wind, wave, period, access_limits(distance))


def access_note(wind: ColumnLike, wave: ColumnLike, distance: ColumnLike) -> Column:
    w, sea, dist = map(as_col, (wind, wave, distance))
    text = F.concat_ws(", ",
                       F.when(w > 18, F.format_string("%.0f kt wind", round_to(w, 0))),
                       F.when(sea > 5, F.format_string("%.1f ft seas", round_to(sea, 1))),
                       F.when(dist > 40, F.lit("long-range run")))
    return (F.when(w.isNull() | sea.isNull(), "insufficient wind/wave data")
             .when(text == "", "workable").otherwise(text))


def anomaly_multiplier(pref: ColumnLike, anomaly: ColumnLike) -> Column:
    return clamp(1.0 + as_col(pref) * (as_col(anomaly) / 2.5) * 0.45, 0.35, 1.35)


def reference_temperature(temp_ref: ColumnLike, depth: ColumnLike, sst: ColumnLike) -> Column:
    """Surface temperature, or the near-bottom one by an exponential depth offset."""
    depth = F.coalesce(as_col(depth), F.lit(100.0))
    offset = F.when(as_col(temp_ref) == "bottom", 14.0 * (1.0 - F.exp(-depth / 160.0))).otherwise(0.0)
    return as_col(sst) - offset


def weighted_mean_log(terms: dict[str, Column], weights: dict[str, Column]) -> tuple[Column, Column]:
    """(sum of w*ln term, sum of w) over the terms that exist and weigh something."""
    log_sum, weight_sum = F.lit(0.0), F.lit(0.0)
    for k, v in terms.items():
        w = F.when(v.isNotNull() & (weights[k] > 0), weights[k]).otherwise(0.0)
        weight_sum = weight_sum + w
        log_sum = log_sum + w * F.log(F.greatest(F.coalesce(v, F.lit(1.0)), F.lit(TERM_FLOOR)))
    return log_sum, weight_sum


def core_from(log_sum: Column, weight_sum: Column, multiplier: Column) -> Column:
    """Core suitability; null when no driver is left."""
    return F.when(weight_sum > 0, limit(F.exp(log_sum / weight_sum) * F.coalesce(multiplier, F.lit(1.0)),
                                        *SCORE_LIMITS))


def gated(core: Column, access_share: Column) -> Column:
    """Score in points before rounding."""
    return 100.0 * soft_ceiling(clamp(core * (0.35 + 0.65 * access_share), *SCORE_LIMITS))


def rescore(terms: dict[str, Column], weights: dict[str, Column], multiplier: ColumnLike,
            access_pct: ColumnLike) -> Column:
    """Score again from stored terms, e.g. under other weights."""
    log_sum, weight_sum = weighted_mean_log(terms, weights)
    share = F.coalesce(as_col(access_pct) / 100.0, F.lit(DEFAULT_ACCESS))
    return round_to(gated(core_from(log_sum, weight_sum, as_col(multiplier)), share), 1)


def regime_baseline(clim_score: ColumnLike, anomaly: ColumnLike, pref: ColumnLike) -> Column:
    """Climatological score shifted by the regime's mean anomaly through the preference."""
    factor = anomaly_multiplier(pref, anomaly)
    raw = inverse_soft_ceiling(as_col(clim_score) / 100.0) * factor
    return F.when(factor.isNotNull(), round_to(100.0 * soft_ceiling(clamp(raw, *SCORE_LIMITS)), 1))


def weight_columns(df: DataFrame) -> DataFrame:
    """One column ``_w_<driver>`` for each entry of the ``weights`` map (0 where absent), unless the rows have them.

    Taken on the few subject rows, they spare the map on every zone-day.
    """
    if f"_w_{TERMS[0]}" in df.columns:
        return df
    return df.withColumns({f"_w_{k}": F.coalesce(F.try_element_at("weights", F.lit(k)), F.lit(0.0)) for k in TERMS})


def with_score(df: DataFrame, prefix: str = "", climatology: bool = False, sst: str = "sst_f",
               anomaly: str = "sst_anom_f", score_only: bool = False) -> DataFrame:
    """Append score columns to rows that carry conditions and subject parameters.

    Conditions: month, sst (+ norm), anomaly, wave_ft/wind_kt (+ wave_norm/wind_norm), wave_period_s,
    tide and moon fields, sunrise/sunset, pressure trend, front and chlorophyll.
    Subject: sst_window array(4), season_index array(12), weights map, tide_pref, moon_pref, group,
    temp_ref, anomaly_pref, swell_tolerance_ft. Place: distance_nm, depth_mid_ft.
    In climatology mode the norms replace the observations and the short-lived drivers are neutral.
    Intermediate values are staged as columns, so that every generated expression stays short.
    """
    c, p = F.col, prefix
    before = list(df.columns)
    temp, wave, wind = (("sst_norm", "wave_norm", "wind_norm") if climatology else (sst, "wave_ft", "wind_kt"))
    win = c("sst_window")
    staged = df.withColumns({
        "_temp": reference_temperature("temp_ref", "depth_mid_ft", temp), **{f"_c{i}": win[i] for i in range(4)},
        **({} if climatology else {
            "_strength": tide_strength("tide_range_ft", "max_exchange_rate_ft_h"),
            "_timing": light_timing("best_water_hour", "sunrise_hour", "sunset_hour"),
            "_push": high_water_push("first_high_hour")})})
    terms = {
        "sst": trapezoid("_temp", "_c0", "_c1", "_c2", "_c3"), "season": F.get(c("season_index"), c("month") - 1),
        "swell": swell_term(wave, "swell_tolerance_ft"),
        **({k: F.lit(v) for k, v in CLIMATOLOGY_TERMS.items()} if climatology else {
            "tide": tide_by_preference("tide_pref", "_strength", "_timing", "_push"),
            "moon": moon_term("moon_pref", "moon_illum", "moon_age_days"), "pressure": pressure_term("pressure_trend_24h"),
            "front": front_term("front_f_per_nm", "sst_spread_f"), "chl": chl_term("group", "chl_mg_m3")})}
    # one column per driver; the sums over them are folded into two columns, so that few columns pass from step to step
    staged = weight_columns(staged).withColumns({f"_t_{k}": terms[k] for k in TERMS})
    used = {k: c(f"_t_{k}").isNotNull() & (c(f"_w_{k}") > 0) for k in TERMS}
    total = lambda part: reduce(lambda acc, k: acc + F.when(used[k], part(k)).otherwise(0.0), TERMS, F.lit(0.0))
    ln = {k: F.log(F.greatest(c(f"_t_{k}"), F.lit(TERM_FLOOR))) for k in TERMS}
    staged = staged.withColumns({"_weight": total(lambda k: c(f"_w_{k}")), "_log": total(lambda k: c(f"_w_{k}") * ln[k])})
    staged = staged.withColumns({
        **{f"_{k}": v for k, v in access_limits("distance_nm").items()},
        "_multiplier": F.lit(1.0) if climatology else anomaly_multiplier("anomaly_pref", anomaly)})
    staged = staged.withColumns({
        "_access": access_within(wind, wave, "wave_period_s", {k: c(f"_{k}") for k in ("wind_max", "sea_ok", "sea_max", "run")}),
        "_core": core_from(c("_log"), c("_weight"), c("_multiplier"))})
    staged = staged.withColumn("_gated", limit(c("_core") * (0.35 + 0.65 * c("_access")), *SCORE_LIMITS))
    out = {f"{p}score": F.when(c("_core").isNotNull(), round_to(100.0 * soft_ceiling("_gated"), 1))}
    if not score_only:
        share = lambda k: round_to(c(f"_w_{k}") / c("_weight") * (ln[k] - LN_HALF), 4)
        shares = F.array_compact(F.array(*[F.when(used[k], F.struct(F.lit(k).alias("k"), share(k).alias("v"))) for k in TERMS]))
        out |= {
            f"{p}core_score": round_to(100.0 * soft_ceiling("_core"), 1), f"{p}fishability": round_to(100.0 * c("_access"), 1),
            f"{p}access_note": access_note(wind, wave, "distance_nm"), f"{p}contrib": F.map_from_entries(shares),
            f"{p}missing_drivers": F.concat_ws(",", *[F.when(c(f"_t_{k}").isNull() & (c(f"_w_{k}") > 0), k) for k in TERMS]),
            f"{p}anomaly_term": round_to("_multiplier", 3),
            **{f"{p}term_{k}": round_to(f"_t_{k}", 3) for k in TERMS}}
    return staged.select(*before, *[v.alias(k) for k, v in out.items()])
