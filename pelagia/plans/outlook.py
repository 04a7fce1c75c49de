"""30-day outlook: blended projections, score bands and the monotone uncertainty ratchet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classes import tier_for_lead, trend_label
from ..functions.dates import date_spine, moon, sun
from ..functions.drivers import weight_columns, with_score
from ..functions.numeric import ColumnLike, as_col, clamp, round_to
from ..operators.ordered import ratchet

# Governing product intervals, priority, blend weight and signal scale.
PRODUCTS = [("cpc_814_temp", 7, 14, 1, 0.55, 1.6), ("cpc_wk34_temp", 15, 28, 1, 0.32, 1.1),
            ("cpc_month_temp", 0, 30, 2, 0.20, 0.8), ("cpc_season_temp", 0, 30, 3, 0.15, 0.6)]
# Score points added on each side of the band by tier.
TIER_WIDENING = {2: 3.0, 3: 7.0}
SCORE_BOUNDS = (1.0, 99.9)


def persistence_weight(lead: ColumnLike) -> Column:
    return round_to(F.exp(-(as_col(lead) - 6) / 8.0), 4)


def analog_weight(lead: ColumnLike) -> Column:
    return round_to(1.0 - F.exp(-(as_col(lead) - 6) / 8.0), 4)


def model_weight(lead: ColumnLike) -> Column:
    """Share of the deterministic model in wind and waves; none from lead 15 on."""
    lead = as_col(lead)
    return F.when(lead <= 14, F.exp(-(lead - 6) / 7.0)).otherwise(0.0)


def band_multiplier(lead: ColumnLike) -> Column:
    return 0.55 + 0.038 * F.greatest(F.lit(0), as_col(lead) - 6)


def tercile_confidence(prob: ColumnLike) -> Column:
    return F.greatest(F.lit(0.0), (as_col(prob) - 33.3) / 66.7)


def tercile_signal(cat: ColumnLike, prob: ColumnLike, scale: ColumnLike) -> Column:
    """Signed degF signal of a category probability; zero for normal or equal chances."""
    c = F.lower(F.trim(as_col(cat)))
    sign = F.when(c == "above", 1.0).when(c == "below", -1.0).otherwise(0.0)
    return sign * tercile_confidence(prob) * as_col(scale)


def blend(parts: list[tuple[Column, Column]]) -> Column:
    """Weighted mean of the parts that exist, weights renormalised; null when none does."""
    num, den = F.lit(0.0), F.lit(0.0)
    for w, v in parts:
        num = num + F.when(v.isNotNull(), w * v).otherwise(0.0)
        den = den + F.when(v.isNotNull(), w).otherwise(0.0)
    return F.when(den > 0, num / den)


def toward_norm(weight: Column, model: Column, norm: Column) -> Column:
    """Model value relaxed toward its norm; the model alone where no norm exists."""
    return F.when(norm.isNull(), model).otherwise(weight * model + (1.0 - weight) * norm)


def product_table(samples: DataFrame) -> DataFrame:
    """Sampled products (product, cat, prob) with their interval, weight and signal."""
    spec = F.create_map(*[x for p, a, b, prio, w, s in PRODUCTS for x in (
        F.lit(p), F.struct(F.lit(a).alias("lead_from"), F.lit(b).alias("lead_to"), F.lit(prio).alias("prio"),
                           F.lit(w).alias("weight"), F.lit(s).alias("scale")))])
    rows = samples.withColumn("_s", F.try_element_at(spec, F.col("product"))).where(F.col("_s").isNotNull())
    return rows.select(*samples.columns, "_s.*").withColumns({
        "signal_f": round_to(tercile_signal("cat", "prob", "scale"), 3),
        "confidence": round_to(F.when(F.lower("cat").isin("above", "below"), tercile_confidence("prob")).otherwise(0.0), 3)})


def horizon(zones: DataFrame, today: ColumnLike, first_lead: int = 7, last_lead: int = 30) -> DataFrame:
    """Zone x date spine of the extended horizon."""
    t = as_col(today)
    spine = zones.withColumn("date", F.explode(date_spine(F.date_add(t, first_lead), F.date_add(t, last_lead))))
    tier = tier_for_lead("lead_days")
    return spine.withColumn("lead_days", F.datediff("date", t)).withColumns({
        "doy": F.dayofyear("date"), "month": F.month("date"), "confidence_tier": tier["tier"],
        "confidence_key": tier["key"], "confidence_label": tier["label"]})


def build_outlook(spine: DataFrame, norms: DataFrame, latest: DataFrame, expected: DataFrame, products: DataFrame,
                  model: DataFrame, tide: DataFrame) -> DataFrame:
    """Projected conditions per zone and date.

    spine: horizon(); norms: zone_id, doy, sst_norm_f, sst_sd_f, wave_norm, wind_norm;
    latest: zone_id, anom_now; expected: zone_id, month, anom_f, sd_f, basis;
    products: one row per lead_days; model: zone_id, date, wave_model_ft, wind_model_kt,
    wave_model_period_s, pressure_trend_model_24h; tide: tide_station, date and tide features.
    """
    c = F.col
    df = (spine.join(norms, ["zone_id", "doy"]).join(latest, "zone_id", "left")
               .join(expected.withColumnRenamed("basis", "enso_analog_basis"), ["zone_id", "month"], "left")
               .join(products, "lead_days", "left").join(model, ["zone_id", "date"], "left")
               .join(tide, ["tide_station", "date"], "left"))
    df = df.withColumns({"w_persistence": persistence_weight("lead_days"), "w_enso_analog": analog_weight("lead_days"),
                         "_bw": model_weight("lead_days"), "_m": moon("date"), "_s": sun("date")})
    near = c("confidence_tier") == 2
    wc = F.when(F.coalesce(c("signal_f"), F.lit(0.0)) != 0, c("weight")).otherwise(0.0)
    df = df.withColumns({
        "_core": blend([(c("w_persistence"), c("anom_now")), (c("w_enso_analog"), c("anom_f"))]),
        "_wc": wc, "_nudge": wc * F.coalesce(c("signal_f"), F.lit(0.0)),
        "_sd": F.coalesce("sst_sd_f", "sd_f"),
        "_wave": F.when(near & c("wave_model_ft").isNotNull(), toward_norm(c("_bw"), c("wave_model_ft"), c("wave_norm"))),
        "_wind": F.when(near & c("wind_model_kt").isNotNull(), toward_norm(c("_bw"), c("wind_model_kt"), c("wind_norm")))})
    df = df.withColumns({"_anom": c("_core") + c("_nudge"), "_half": c("_sd") * band_multiplier("lead_days")})
    df = df.withColumn("_sst", c("sst_norm_f") + c("_anom"))
    blended = F.format_string("model blended toward climatology (model weight %.2f)", "_bw")

    def basis(value: str, what: str) -> Column:
        return (F.when(c(value).isNotNull(), blended)
                 .when(near, f"climatology only - deterministic {what} model does not reach this lead")
                 .otherwise(f"climatology only - no skilful deterministic {what} at this lead"))

    both, any_ = c("_wave").isNotNull() & c("_wind").isNotNull(), c("_wave").isNotNull() | c("_wind").isNotNull()
    has_band = c("_sst").isNotNull() & c("_half").isNotNull()
    return df.withColumns({
        "sst_proj_f": round_to("_sst", 2), "sst_anom_proj_f": round_to("_anom", 2), "sst_anom_core_f": round_to("_core", 2),
        "sst_proj_lo_f": F.when(has_band, round_to(c("_sst") - c("_half"), 2)),
        "sst_proj_hi_f": F.when(has_band, round_to(c("_sst") + c("_half"), 2)),
        "sst_basis": F.when(c("_wc") > 0, "persistence + ENSO analog + CPC outlook").otherwise("persistence + ENSO analog"),
        "w_cpc_outlook": round_to("_wc", 4), "cpc_nudge_f": round_to("_nudge", 3),
        "model_blend_weight": round_to("_bw", 3),
        "wave_proj_ft": round_to("_wave", 2), "wind_proj_kt": round_to("_wind", 2),
        "wave_basis": basis("_wave", "swell"), "wind_basis": basis("_wind", "wind"),
        "sea_state_published": any_,
        "sea_state_basis": F.when(both, "model-blended").when(any_, "partially model-blended").otherwise("climatology only"),
        "xx_sst_used": c("_sst"), "xx_sst_lo": c("_sst") - F.coalesce("_half", F.lit(0.0)),
        "xx_sst_hi": c("_sst") + F.coalesce("_half", F.lit(0.0)),
        "xx_wave_used": F.coalesce("_wave", "wave_norm"), "xx_wind_used": F.coalesce("_wind", "wind_norm"),
        "xx_period_used": F.when(c("_wave").isNotNull(), c("wave_model_period_s")),
        "moon_illum": round_to(c("_m.illumination"), 3), "moon_phase": c("_m.phase"),
        "moon_age_days": round_to(c("_m.age_days"), 2), "sunrise_hour": round_to(c("_s.sunrise"), 2),
        "sunset_hour": round_to(c("_s.sunset"), 2), "daylight_hours": round_to(c("_s.daylight"), 2),
    }).drop("_bw", "_m", "_s", "_core", "_wc", "_nudge", "_sd", "_wave", "_wind", "_anom", "_half", "_sst")


def score_outlook(outlook: DataFrame, subjects: DataFrame, zones: DataFrame, curve: DataFrame) -> DataFrame:
    """Scores of the outlook with a sensitivity band that never narrows with lead."""
    c = F.col
    null = F.lit(None).cast("double")
    pairs = weight_columns(subjects).withColumn("zone_id", F.explode("zones")).drop("zones")
    place = zones.select("zone_id", "distance_nm", "depth_mid_ft")
    base = outlook.drop("distance_nm", "depth_mid_ft").join(pairs.join(place, "zone_id"), "zone_id")
    base = base.withColumns({
        "sst_norm": c("sst_norm_f"), "wave_ft": c("xx_wave_used"), "wind_kt": c("xx_wind_used"),
        "wave_period_s": c("xx_period_used"), "pressure_trend_24h": null, "front_f_per_nm": null,
        "sst_spread_f": null, "chl_mg_m3": null,
        "_step": F.coalesce(c("sst_proj_hi_f") - c("sst_proj_f"), F.lit(0.0))})
    base = base.withColumns({"_anom_lo": c("sst_anom_proj_f") - c("_step"), "_anom_hi": c("sst_anom_proj_f") + c("_step")})
    rows = with_score(base, prefix="mid_", sst="xx_sst_used", anomaly="sst_anom_proj_f").where("mid_score is not null")
    rows = with_score(rows, prefix="lo_", sst="xx_sst_lo", anomaly="_anom_lo", score_only=True)
    rows = with_score(rows, prefix="hi_", sst="xx_sst_hi", anomaly="_anom_hi", score_only=True)
    rows = with_score(rows, prefix="norm_", climatology=True)
    rows = rows.join(curve.select("zone_id", "species_id", "doy", c("climatological_score").alias("_curve")),
                     ["zone_id", "species_id", "doy"], "left")
    widen = F.when(c("confidence_tier") == 2, TIER_WIDENING[2]).otherwise(TIER_WIDENING[3])
    lo, hi = F.least("lo_score", "mid_score", "hi_score") - widen, F.greatest("lo_score", "mid_score", "hi_score") + widen
    clim = F.coalesce("_curve", "norm_score")
    delta = round_to(c("mid_score") - clim, 1)
    published = c("sea_state_published")
    out = rows.select(
        "date", "zone_id", "species_id", "lead_days", "confidence_tier", "confidence_key", "confidence_label",
        c("mid_score").alias("score_outlook"), round_to(F.greatest(F.lit(SCORE_BOUNDS[0]), lo), 1).alias("score_lo"),
        round_to(F.least(F.lit(SCORE_BOUNDS[1]), hi), 1).alias("score_hi"), c("norm_score").alias("seasonal_norm_score"),
        clim.alias("climatological_score"), delta.alias("vs_seasonal_norm"), trend_label(delta).alias("trend"),
        F.when(published, c("mid_fishability")).alias("fishability_outlook"),
        c("norm_fishability").alias("fishability_climatological"),
        F.when(published, c("mid_access_note")).otherwise("climatological sea state").alias("access_note"),
        *[c(f"mid_term_{t}").alias(f"term_{t}") for t in ("sst", "season", "tide", "moon", "swell")],
        c("mid_anomaly_term").alias("anomaly_term"), c("mid_missing_drivers").alias("missing_drivers"),
        F.when(published, "model-blended conditions + exact tide/moon").otherwise(
            "climatology + ENSO analog + exact tide/moon").alias("basis"))
    return ratchet_band(out)


def ratchet_band(scores: DataFrame) -> DataFrame:
    """Half-widths may not shrink as lead grows; the published band is clipped to the scale and flagged."""
    c, keys = F.col, ["zone_id", "species_id"]
    df = scores.withColumns({"_lo": F.abs(c("score_outlook") - c("score_lo")), "_hi": F.abs(c("score_hi") - c("score_outlook"))})
    df = ratchet(df, keys, "lead_days", "_lo", "_rlo")
    df = ratchet(df, keys, "lead_days", "_hi", "_rhi")
    lo, hi = SCORE_BOUNDS
    df = df.withColumns({
        "score_band_raw_pts": round_to(c("_lo") + c("_hi"), 1),
        "score_halfband_lo_pts": round_to("_rlo", 1), "score_halfband_hi_pts": round_to("_rhi", 1),
        "score_lo": round_to(F.greatest(F.lit(lo), c("score_outlook") - c("_rlo")), 1),
        "score_hi": round_to(F.least(F.lit(hi), c("score_outlook") + c("_rhi")), 1),
        "score_band_hits_ceiling": c("score_outlook") + c("_rhi") > hi,
        "score_band_hits_floor": c("score_outlook") - c("_rlo") < lo})
    return df.withColumns({
        "score_band_pts": round_to(c("score_hi") - c("score_lo"), 1),
        "score_band_is_ratcheted": (c("score_halfband_lo_pts") > c("_lo") + 0.05) | (c("score_halfband_hi_pts") > c("_hi") + 0.05),
    }).drop("_lo", "_hi", "_rlo", "_rhi")


def stitched_series(near: DataFrame, extended: DataFrame, norms: DataFrame, keys: list[str]) -> DataFrame:
    """Near-term and extended scores on one date axis with the norm where neither exists."""
    a = near.select(*keys, "date", F.col("score"), F.lit(1).alias("tier"))
    b = extended.select(*keys, "date", F.col("score_outlook").alias("score"), F.col("confidence_tier").alias("tier"))
    one = a.unionByName(b.join(a.select(*keys, "date"), [*keys, "date"], "left_anti"))
    out = norms.join(one, [*keys, "date"], "full_outer")
    return out.withColumns({"value": F.coalesce("score", "norm_score"), "is_norm": F.col("score").isNull()})
