"""Conditions, scores, curves and the dashboard queries on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import drivers as dr
from ..functions.classes import TERMS
from ..operators import climatology as cl
from ..plans import conditions as cond
from ..plans import dashboard as db
from . import inputs as i
from .registry import query
from .sqlparts import doy_climatology_sql, even_sql, mean_log_sql, part, soft_sql, clamp_sql, trapezoid_sql

COND_SPEC = ("zone_id s, date t, doy i, month i, sst_f d4, sst_source s, sst_norm d4, sst_sd d4, sst_years l, sst_anom_f d4, sst_pctile d3, "
             "sst_trend_7d d4, pressure_hpa d4, pressure_trend_24h d4, wave_ft d4, wave_norm d4, wave_anom_ft d4, wind_kt d4, wind_norm d4, wind_anom_kt d4, "
             "tide_range_ft d4, front_f_per_nm d4, chl_mg_m3 d4, cuti d4, moon_illum d5, moon_phase s, sunrise_hour d4, shore_sst_f d4, is_forecast b, enso_simple s, oni_latest d2")


@query("build_conditions", COND_SPEC, """
  SELECT *, (SELECT simple_regime FROM p_current) AS enso_simple, (SELECT oni FROM p_current) AS oni_latest FROM p_conditions""")
def conditions(spark, sf):
    return i.conditions(spark, sf)


@query("f12_observed_over_model", "zone_id s, date t, sst_f d4, sst_source s", """
  SELECT d.zone_id, d.date, coalesce(s.sst_f, d.sst_f_model) AS sst_f, CASE WHEN s.sst_f IS NOT NULL THEN 'MUR 1km satellite' ELSE 'Open-Meteo marine model' END AS sst_source
  FROM p_zone_daily d LEFT JOIN p_satellite s USING (zone_id, date)""")
def observed(spark, sf):
    sat = i.satellite(spark, sf).withColumnRenamed("sst_f", "sst_f_sat")
    return cond.observed_over_model(i.zone_daily(spark, sf).join(sat, ["zone_id", "date"], "left"))


SCORE_SPEC = ("date t, zone_id s, species_id s, group s, score d1, seasonal_norm_score d1, vs_norm d1, core_score d1, fishability d1, access_note s, is_forecast b, "
              "sst_f d4, wave_ft d4, wind_kt d4, " + ", ".join(f"term_{k} d3" for k in TERMS) + ", anomaly_term d3, missing_drivers s")


def scores(spark, sf):
    return i.scores(spark, sf)


@query("build_scores", SCORE_SPEC, 'SELECT *, grp AS "group" FROM p_scores WHERE score IS NOT NULL')
def build_scores(spark, sf):
    return scores(spark, sf)


@query("climatological_curve", "zone_id s, species_id s, doy i, month i, climatological_score d1, sst_norm_f d4, wave_norm_ft d4, wind_norm_kt d4, climatology_source s",
       "SELECT * FROM p_curve WHERE climatological_score IS NOT NULL")
def curve(spark, sf):
    return i.curve(spark, sf)


@query("w12_annual_percentile", "date t, zone_id s, species_id s, score d1, annual_percentile d1", """
  SELECT s.date, s.zone_id, s.species_id, s.score, round(100.0::DOUBLE * count_if(c.climatological_score < s.score) / nullif(count(c.climatological_score), 0), 1) AS annual_percentile
  FROM p_scores s LEFT JOIN p_curve c USING (zone_id, species_id) WHERE s.score IS NOT NULL GROUP BY 1, 2, 3, 4""")
def annual_percentile(spark, sf):
    return cl.curve_percentile(scores(spark, sf), i.curve(spark, sf), ["zone_id", "species_id"], "score", "climatological_score", "annual_percentile")


def term_rows(spark, sf):
    return cond.eligible_pairs(i.conditions(spark, sf), i.subjects(spark, sf), i.zones(spark, sf))


@query("m02_m08_driver_terms", "date t, zone_id s, species_id s, " + ", ".join(f"t_{k} d6" for k in TERMS) + ", t_anom d6, acc d6", "SELECT * FROM p_terms")
def terms(spark, sf):
    c = F.col
    w = c("sst_window")
    return term_rows(spark, sf).select(
        "date", "zone_id", "species_id",
        dr.trapezoid(dr.reference_temperature("temp_ref", "depth_mid_ft", "sst_f"), w[0], w[1], w[2], w[3]).alias("t_sst"),
        F.get("season_index", c("month") - 1).alias("t_season"),
        dr.tide_term("tide_pref", "tide_range_ft", "max_exchange_rate_ft_h", "best_water_hour", "sunrise_hour", "sunset_hour", "first_high_hour").alias("t_tide"),
        dr.moon_term("moon_pref", "moon_illum", "moon_age_days").alias("t_moon"), dr.pressure_term("pressure_trend_24h").alias("t_pressure"),
        dr.swell_term("wave_ft", "swell_tolerance_ft").alias("t_swell"), dr.front_term("front_f_per_nm", "sst_spread_f").alias("t_front"),
        dr.chl_term("group", "chl_mg_m3").alias("t_chl"), dr.anomaly_multiplier("anomaly_pref", "sst_anom_f").alias("t_anom"),
        dr.access("wind_kt", "wave_ft", "wave_period_s", "distance_nm").alias("acc"))


_terms = {k: f"term_{k}" for k in TERMS}
_n2, _d2 = mean_log_sql(_terms)


@query("m10_rescore_from_terms", "date t, zone_id s, species_id s, rescored d1", f"""
  SELECT date, zone_id, species_id, round(100 * {soft_sql('g')}, 1) AS rescored FROM (
    SELECT *, {clamp_sql(clamp_sql(f'exp({_n2} / {_d2}) * coalesce(anomaly_term, 1.0::DOUBLE)', 0.01, 1.35) + ' * (0.35 + 0.65 * coalesce(fishability / 100.0, 0.7::DOUBLE))', 0.01, 1.35)} AS g FROM p_scores WHERE score IS NOT NULL)""")
def rescored(spark, sf):
    s = scores(spark, sf).join(i.subjects(spark, sf).select("species_id", "weights"), "species_id")
    return s.withColumn("rescored", dr.rescore({k: F.col(f"term_{k}") for k in TERMS}, {k: F.col("weights")[k] for k in TERMS}, "anomaly_term", "fishability"))


part("p_best_day", "SELECT max(date) AS day FROM p_scores")


@query("o01_top_combinations", "date t, zone_id s, species_id s, score d1", """
  SELECT date, zone_id, species_id, score FROM p_scores WHERE date = DATE '2001-06-15' AND score IS NOT NULL ORDER BY score DESC, zone_id, species_id LIMIT 10""")
def top10(spark, sf):
    return db.top_combinations(scores(spark, sf), F.lit("2001-06-15").cast("date"))


@query("o02_best_per_species", "species_id s, date t, zone_id s, score d1, vs_norm d1", """
  SELECT species_id, date, zone_id, score, vs_norm FROM p_scores WHERE score IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY species_id ORDER BY score DESC, date, zone_id) = 1""")
def best_species(spark, sf):
    return db.best_per_species(scores(spark, sf))


@query("o07_forward_window_ranked", "species_id s, date t, zone_id s, score d1", """
  SELECT species_id, date, zone_id, score FROM p_scores WHERE score IS NOT NULL AND date > DATE '2001-06-30' AND date <= DATE '2001-07-07'""")
def forward(spark, sf):
    s = scores(spark, sf).where((F.col("date") > F.lit(i.AS_OF_DAY).cast("date")) & (F.col("date") <= F.date_add(F.lit(i.AS_OF_DAY).cast("date"), 7)))
    return s.orderBy(F.desc("score"), "zone_id", "species_id")


@query("o08_nearest_curve_point", "zone_id s, species_id s, doy i, climatological_score d1", """
  SELECT zone_id, species_id, doy, climatological_score FROM p_curve WHERE climatological_score IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY zone_id, species_id ORDER BY abs(doy - 200), doy) = 1""")
def nearest(spark, sf):
    return db.nearest_curve_point(i.curve(spark, sf), ["zone_id", "species_id"], 200)


@query("f09_decimated_curve", "zone_id s, species_id s, doy i, climatological_score d1", "SELECT * FROM p_curve WHERE doy % 3 = 1 AND climatological_score IS NOT NULL")
def decimated(spark, sf):
    return db.decimate_curve(i.curve(spark, sf))


_zones = [f"NATION_{k}" for k in range(25)]


@query("dash_opportunity_matrix", "species_id s, " + ", ".join(f"{z} d1" for z in _zones), f"""
  SELECT species_id, {", ".join(f"max(score) FILTER (zone_id = '{z}') AS {z}" for z in _zones)}
  FROM p_scores WHERE date = DATE '2001-06-15' AND score IS NOT NULL GROUP BY 1""")
def matrix(spark, sf):
    return db.opportunity_matrix(scores(spark, sf), F.lit("2001-06-15").cast("date"), _zones)


part("p_contrib", """SELECT date, zone_id, species_id, unnest([""" + ", ".join(
    f"{{'driver': '{k}', 'v': CASE WHEN t_{k} IS NOT NULL AND w_{k} > 0 THEN round(w_{k} / wsum * (ln(greatest(t_{k}, 0.02)) - ln(0.5)), 4) END}}" for k in TERMS) + """]) AS e
  FROM p_scores WHERE score IS NOT NULL""")


@query("dash_driver_ranking", "date t, zone_id s, species_id s, driver s, contribution d4, rank i", """
  SELECT date, zone_id, species_id, e.driver AS driver, e.v AS contribution, row_number() OVER (PARTITION BY date, zone_id, species_id ORDER BY abs(e.v) DESC, e.driver) AS rank
  FROM p_contrib WHERE e.v IS NOT NULL""")
def driver_ranking(spark, sf):
    return db.driver_ranking(scores(spark, sf))


@query("a30_mean_norm_by_date", "date t, mean_norm d4, n l", """
  SELECT date, avg(seasonal_norm_score) AS mean_norm, count(seasonal_norm_score) AS n FROM p_scores WHERE score IS NOT NULL GROUP BY 1""")
def mean_norm(spark, sf):
    return db.mean_norm_by_date(scores(spark, sf))


@query("dash_access_by_zone", "zone_id s, date t, fishability d1", "SELECT zone_id, date, max(fishability) AS fishability FROM p_scores WHERE score IS NOT NULL GROUP BY 1, 2")
def access(spark, sf):
    return db.access_by_zone(scores(spark, sf))


@query("dash_zones_vs_normal", "zone_id s, date t, score d1, norm d1, above b", """
  SELECT zone_id, date, max(score) AS score, max(seasonal_norm_score) AS norm, max(score) > max(seasonal_norm_score) AS above FROM p_scores WHERE score IS NOT NULL GROUP BY 1, 2""")
def vs_normal(spark, sf):
    d = scores(spark, sf).groupBy("zone_id", "date").agg(F.max("score").alias("score"), F.max("seasonal_norm_score").alias("norm"))
    return d.withColumn("above", F.col("score") > F.col("norm"))


@query("dash_suitability_by_zone", "date t, zone_id s, species_id s, suitability d5", f"""
  SELECT date, zone_id, species_id, {trapezoid_sql('sst_f', 'ta', 'tb', 'tc', 'td')} AS suitability FROM p_conditions JOIN p_subjects USING (zone_id)""")
def suitability(spark, sf):
    return db.suitability_by_zone(i.conditions(spark, sf), i.subjects(spark, sf))


@query("dash_missing_driver_share", "driver s, missing_share d6", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{k}' AS driver, avg(CASE WHEN term_{k} IS NULL THEN 1.0 ELSE 0.0 END) AS missing_share FROM p_scores WHERE score IS NOT NULL" for k in TERMS) + ")")
def missing_share(spark, sf):
    return db.missing_term_share(scores(spark, sf))


@query("d10_classes_and_trend", "date t, zone_id s, species_id s, score_class s, class_index i, trend s", """
  SELECT date, zone_id, species_id, CASE WHEN score >= 90 THEN 'Excellent' WHEN score >= 75 THEN 'Very Good' WHEN score >= 60 THEN 'Good' WHEN score >= 40 THEN 'Fair' ELSE 'Poor' END AS score_class,
    CASE WHEN score >= 90 THEN 4 WHEN score >= 75 THEN 3 WHEN score >= 60 THEN 2 WHEN score >= 40 THEN 1 ELSE 0 END AS class_index,
    CASE WHEN vs_norm IS NULL THEN 'unknown' WHEN vs_norm >= 8 THEN 'well above typical' WHEN vs_norm >= 3 THEN 'above typical' WHEN vs_norm > -3 THEN 'near typical' WHEN vs_norm > -8 THEN 'below typical' ELSE 'well below typical' END AS trend
  FROM p_scores WHERE score IS NOT NULL""")
def classes(spark, sf):
    from ..functions.classes import score_class, score_class_index, trend_label
    return scores(spark, sf).select("date", "zone_id", "species_id", score_class("score").alias("score_class"),
                                    score_class_index("score").alias("class_index"), trend_label("vs_norm").alias("trend"))


@query("j05_eligible_pairs", "date t, zone_id s, species_id s", "SELECT date, zone_id, species_id FROM p_conditions JOIN p_subjects USING (zone_id)")
def eligible(spark, sf):
    return term_rows(spark, sf)


part("p_regime_baseline", f"""SELECT s.*, c.climatological_score AS clim, k.mean_anom_f AS an FROM p_scores s
  LEFT JOIN p_curve c ON c.zone_id = s.zone_id AND c.species_id = s.species_id AND c.doy = s.doy
  LEFT JOIN (SELECT zone_id, i.month, simple_regime, avg(sst_anom_f) AS mean_anom_f FROM p_sat_anom a JOIN p_index_labelled i ON i.year = year(a.date) AND i.month = month(a.date)
    WHERE sst_anom_f IS NOT NULL GROUP BY 1, 2, 3) k ON k.zone_id = s.zone_id AND k.month = s.month AND k.simple_regime = (SELECT simple_regime FROM p_current) WHERE s.score IS NOT NULL""")
_inv = "(CASE WHEN clim / 100.0 <= 0.9 THEN clim / 100.0 ELSE 0.9 - 0.1 * ln(1.0 - least((clim / 100.0 - 0.9) / 0.1, 0.999999)) END)"
_fac = clamp_sql("1.0 + anomaly_pref * (an / 2.5) * 0.45", 0.35, 1.35)


@query("m16_regime_baseline", "date t, zone_id s, species_id s, baseline_clim_score d1, baseline_enso_score d1, baseline_enso_anom_f d3", f"""
  SELECT date, zone_id, species_id, clim AS baseline_clim_score, CASE WHEN clim IS NOT NULL AND an IS NOT NULL THEN {even_sql('100 * ' + soft_sql('r'), 1)} END AS baseline_enso_score,
    CASE WHEN clim IS NOT NULL THEN round(an, 3) END AS baseline_enso_anom_f FROM (SELECT *, {clamp_sql(f'{_inv} * {_fac}', 0.01, 1.35)} AS r FROM p_regime_baseline)""")
def regime_baseline(spark, sf):
    from ..operators.features import regime_composite
    from ..plans.ledger import with_baselines
    comp = regime_composite(i.satellite_anomaly(spark, sf), i.labelled_index(spark, sf), "zone_id", "sst_anom_f")
    regime = cond.current_index(i.climate_index(spark, sf)).select("simple_regime").scalar()
    rows = scores(spark, sf).select(F.col("date").alias("target_date"), "zone_id", "species_id").withColumn("simple_regime", regime)
    return with_baselines(rows, i.curve(spark, sf), comp, i.subjects(spark, sf)).withColumnRenamed("target_date", "date")
