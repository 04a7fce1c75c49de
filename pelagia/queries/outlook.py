"""30-day outlook from the conditions of the line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as ft
from ..operators import joins
from ..operators.dedup import latest_per_key
from ..plans import conditions as cond
from ..plans import outlook as ol
from ..session import staged
from . import inputs as i
from .registry import query
from .sqlparts import access_sql, clamp_sql, even_sql, mean_log_sql, part, ref_temp_sql, soft_sql, swell_sql, trapezoid_sql, MOON_SQL, TIDE_SQL

TODAY = i.AS_OF_DAY
PRODUCT_KEYS = {0: "cpc_814_temp", 1: "cpc_wk34_temp", 2: "cpc_month_temp", 3: "cpc_season_temp"}


# sampled products: regions modulo 4, category and probability from their mean discount
part("p_samples", """SELECT CASE n_regionkey % 4 WHEN 0 THEN 'cpc_814_temp' WHEN 1 THEN 'cpc_wk34_temp' WHEN 2 THEN 'cpc_month_temp' ELSE 'cpc_season_temp' END AS product,
  CASE WHEN n_regionkey % 4 % 2 = 0 THEN 'Above' ELSE 'Below' END AS cat, 33.3::DOUBLE + 4 * (sum(disc) / sum(n)) AS prob FROM p_zone_raw JOIN nation ON n_name = zone_id GROUP BY 1, 2""")
part("p_products", """SELECT product, cat, prob, v.*, round(CASE cat WHEN 'Above' THEN 1.0 WHEN 'Below' THEN -1.0 ELSE 0.0 END * greatest(0.0, (prob - 33.3) / 66.7) * scale, 3) AS signal_f FROM p_samples
  JOIN (VALUES ('cpc_814_temp', 7, 14, 1, 0.55::DOUBLE, 1.6::DOUBLE), ('cpc_wk34_temp', 15, 28, 1, 0.32, 1.1), ('cpc_month_temp', 0, 30, 2, 0.20, 0.8), ('cpc_season_temp', 0, 30, 3, 0.15, 0.6)) v(pname, lead_from, lead_to, prio, weight, scale) ON v.pname = product""")
part("p_by_lead", """SELECT CAST(l AS INT) AS lead_days, p.* FROM (SELECT unnest(range(0, 31)) AS l) JOIN p_products p ON l BETWEEN lead_from AND lead_to QUALIFY row_number() OVER (PARTITION BY l ORDER BY prio, product) = 1""")


def samples(spark, sf):
    z = i.zone_raw(spark, sf).join(i.zones(spark, sf).select("zone_id", (F.col("region_no") % 4).alias("region_no")), "zone_id")
    g = z.groupBy("region_no").agg((F.sum("disc") / F.sum("n")).alias("m"))
    names = F.create_map(*[F.lit(x) for kv in PRODUCT_KEYS.items() for x in kv])
    return g.select(F.element_at(names, F.col("region_no").cast("int")).alias("product"), F.when(F.col("region_no") % 2 == 0, "Above").otherwise("Below").alias("cat"), (33.3 + 4 * F.col("m")).alias("prob"))


def products(spark, sf):
    return joins.product_by_lead(ol.product_table(samples(spark, sf))).select("lead_days", "product", "cat", "prob", "prio", "weight", "signal_f")


@query("j10_product_by_lead", "lead_days i, product s, cat s, prob d4, weight d2, signal_f d3", "SELECT * FROM p_by_lead")
def by_lead(spark, sf):
    return products(spark, sf)


# preference chains: each zone may use its own region's station, then the next region's
part("p_field_clim", """SELECT primary_buoy AS station, doy, CASE WHEN r_regionkey IN (0, 2, 4) THEN wave_norm END AS wave_norm, wave_p90, CASE WHEN r_regionkey IN (1, 2) THEN wind_norm END AS wind_norm, wind_p90
  FROM p_buoy_clim JOIN region ON r_name = primary_buoy""")
part("p_chain", """SELECT z.zone_id, 0 AS prio, r_name AS station FROM p_zones z JOIN region ON r_regionkey = z.region_no
  UNION ALL SELECT z.zone_id, 1, r_name FROM p_zones z JOIN region ON r_regionkey = (z.region_no + 1) % 5""")
part("p_pick_wave", "SELECT zone_id, station FROM p_chain WHERE station IN (SELECT station FROM p_field_clim WHERE wave_norm IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY zone_id ORDER BY prio) = 1")
part("p_pick_wind", """SELECT zone_id, station, prio = 9 AS regional FROM (SELECT * FROM p_chain UNION ALL SELECT zone_id, 9, (SELECT r_name FROM region WHERE r_regionkey = 2) FROM p_zones)
  WHERE station IN (SELECT station FROM p_field_clim WHERE wind_norm IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY zone_id ORDER BY prio) = 1""")
part("p_chain_norms", """SELECT z.zone_id, d.doy, w.station AS wave_station, a.wave_norm, v.station AS wind_station, b.wind_norm, v.regional AS wind_regional FROM p_zones z, (SELECT DISTINCT doy FROM p_field_clim) d
  LEFT JOIN p_pick_wave w ON w.zone_id = z.zone_id LEFT JOIN p_field_clim a ON a.station = w.station AND a.doy = d.doy
  LEFT JOIN p_pick_wind v ON v.zone_id = z.zone_id LEFT JOIN p_field_clim b ON b.station = v.station AND b.doy = d.doy""")


def chain_norms(spark, sf):
    reg = i.table(spark, sf, "region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("station"))
    c = i.buoy_clim(spark, sf).withColumnRenamed("primary_buoy", "station").join(reg, "station")
    c = c.select("station", "doy", F.when(F.col("k").isin(0, 2, 4), F.col("wave_norm")).alias("wave_norm"), "wave_p90",
                 F.when(F.col("k").isin(1, 2), F.col("wind_norm")).alias("wind_norm"), "wind_p90")
    z = i.zones(spark, sf).select("zone_id", "region_no").join(reg.select(F.col("k").alias("region_no"), F.col("station").alias("own")), "region_no")
    z = z.withColumn("nxt", (F.col("region_no") + 1) % 5).join(reg.select(F.col("k").alias("nxt"), F.col("station").alias("alt")), "nxt")
    last = reg.where("k = 2").first()["station"]
    return joins.fallback_chain(z.select("zone_id", F.array("own", "alt").alias("chain")), c, "zone_id", "chain", "station", "doy",
                                {"wave_norm": ["wave_norm", "wave_p90"], "wind_norm": ["wind_norm", "wind_p90"]}, {"wind_norm": last})


@query("j08_fallback_chain", "zone_id s, doy i, wave_station s, wave_norm d5, wind_station s, wind_norm d5, wind_regional b", "SELECT * FROM p_chain_norms")
def fallback(spark, sf):
    return chain_norms(spark, sf).withColumnsRenamed({"wave_norm_station": "wave_station", "wind_norm_station": "wind_station", "wind_norm_is_regional": "wind_regional"})


part("p_comp", """SELECT zone_id, i.month, simple_regime, avg(sst_anom_f) AS mean_anom_f, stddev_samp(sst_anom_f) AS sd_anom_f, count(*) AS n_days FROM p_sat_anom a
  JOIN p_index_labelled i ON i.year = year(a.date) AND i.month = month(a.date) WHERE sst_anom_f IS NOT NULL GROUP BY 1, 2, 3""")
part("p_sens", """SELECT zone_id, i.month, regr_slope(sst_anom_f, oni) AS slope, corr(oni, sst_anom_f) AS r, count(*) AS n_days FROM p_sat_anom a JOIN p_index_labelled i ON i.year = year(a.date) AND i.month = month(a.date)
  WHERE sst_anom_f IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 20 AND stddev_samp(oni) > 0.15""")
part("p_expected", """SELECT z.zone_id, CAST(m AS INT) AS month, coalesce(c.mean_anom_f, s.slope * (SELECT oni FROM p_current)) AS anom_f, c.sd_anom_f AS sd_f,
  CASE WHEN c.mean_anom_f IS NOT NULL THEN printf('enso_zone_composite (%s, month %d, n=%d days)', c.simple_regime, m, c.n_days)
    WHEN s.slope IS NOT NULL THEN printf('enso_sensitivity slope x ONI %+.2f (r=%.2f, n=%d)', (SELECT oni FROM p_current), s.r, s.n_days) ELSE 'unavailable' END AS basis, coalesce(c.n_days, s.n_days, 0) AS n_days
  FROM p_zones z, (SELECT unnest(range(1, 13)) AS m) LEFT JOIN p_comp c ON c.zone_id = z.zone_id AND c.month = m AND c.simple_regime = (SELECT simple_regime FROM p_current) LEFT JOIN p_sens s ON s.zone_id = z.zone_id AND s.month = m""")


def expected(spark, sf):
    a, idx = i.satellite_anomaly(spark, sf), i.labelled_index(spark, sf)
    keys = i.zones(spark, sf).select("zone_id", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
    return joins.expected_anomaly(keys, ft.regime_composite(a, idx, "zone_id", "sst_anom_f"), ft.sensitivity(a, idx, "zone_id", "sst_anom_f", min_n=20), "zone_id",
                                  cond.current_index(i.climate_index(spark, sf)))


@query("j09_expected_anomaly", "zone_id s, month i, anom_f d5, sd_f d5, basis s, n_days l", "SELECT * FROM p_expected")
def expected_anomaly(spark, sf):
    return expected(spark, sf)


part("p_latest", f"SELECT zone_id, sst_anom_f AS anom_now FROM p_conditions WHERE date <= DATE '{TODAY}' QUALIFY row_number() OVER (PARTITION BY zone_id ORDER BY date DESC) = 1")
part("p_model", f"""SELECT zone_id, date, wave_ft AS wave_model_ft, CASE WHEN tax_ok THEN wind_kt END AS wind_model_kt, wave_period_s AS wave_model_period_s, pressure_trend_24h AS pressure_trend_model_24h
  FROM (SELECT *, wind_kt > 6 AS tax_ok FROM p_conditions) WHERE date > DATE '{TODAY}'""")
part("p_spine", f"""SELECT z.*, CAST(DATE '{TODAY}' + CAST(l AS INT) AS DATE) AS date, CAST(l AS INT) AS lead_days, CAST(dayofyear(DATE '{TODAY}' + CAST(l AS INT)) AS INT) AS doy, CAST(month(DATE '{TODAY}' + CAST(l AS INT)) AS INT) AS month,
  CASE WHEN l <= 14 THEN 2 ELSE 3 END AS tier FROM p_zones z, (SELECT unnest(range(7, 31)) AS l)""")
part("p_out0", f"""SELECT s.*, n.sst_norm, n.sst_sd, n.wave_norm, n.wind_norm, anom_now, e.anom_f, e.sd_f, p.product, coalesce(p.signal_f, 0) AS sig, p.weight, m.wave_model_ft, m.wind_model_kt, m.wave_model_period_s, m.pressure_trend_model_24h,
  t.tide_range_ft, t.max_exchange_rate_ft_h, t.best_water_hour, t.first_high_hour, {even_sql('c.moon_illum', 3)} AS moon_illum, {even_sql('c.moon_age_days', 2)} AS moon_age_days, {even_sql('c.sunrise_hour', 2)} AS sunrise_hour, {even_sql('c.sunset_hour', 2)} AS sunset_hour,
  round(exp(-(s.lead_days - 6) / 8.0), 4) AS wp, round(1 - exp(-(s.lead_days - 6) / 8.0), 4) AS we, CASE WHEN tier = 2 THEN exp(-(s.lead_days - 6) / 7.0) ELSE 0 END AS bw
  FROM p_spine s JOIN p_norms n ON n.zone_id = s.zone_id AND n.doy = s.doy LEFT JOIN p_latest pl ON pl.zone_id = s.zone_id LEFT JOIN p_expected e ON e.zone_id = s.zone_id AND e.month = s.month LEFT JOIN p_by_lead p ON p.lead_days = s.lead_days
  LEFT JOIN p_model m ON m.zone_id = s.zone_id AND m.date = s.date LEFT JOIN p_tide_daily t ON t.tide_station = s.tide_station AND t.date = s.date LEFT JOIN p_calendar c ON c.date = s.date""")
part("p_out1", """SELECT *, CASE WHEN anom_now IS NULL AND anom_f IS NULL THEN NULL ELSE (coalesce(wp * anom_now, 0) + coalesce(we * anom_f, 0)) / (CASE WHEN anom_now IS NULL THEN 0 ELSE wp END + CASE WHEN anom_f IS NULL THEN 0 ELSE we END) END AS core_anom,
  CASE WHEN sig <> 0 THEN weight ELSE 0 END AS wc, coalesce(sst_sd, sd_f) * (0.55 + 0.038 * greatest(0, lead_days - 6)) AS half,
  CASE WHEN tier = 2 AND wave_model_ft IS NOT NULL THEN CASE WHEN wave_norm IS NULL THEN wave_model_ft ELSE bw * wave_model_ft + (1 - bw) * wave_norm END END AS wave_p,
  CASE WHEN tier = 2 AND wind_model_kt IS NOT NULL THEN CASE WHEN wind_norm IS NULL THEN wind_model_kt ELSE bw * wind_model_kt + (1 - bw) * wind_norm END END AS wind_p FROM p_out0""")
part("p_outlook", """SELECT *, core_anom + wc * sig AS anom, sst_norm + core_anom + wc * sig AS sst, wave_p IS NOT NULL OR wind_p IS NOT NULL AS published FROM p_out1""")


def outlook(spark, sf):
    def build():
        z = i.zones(spark, sf)
        c = i.conditions(spark, sf)
        today = F.lit(TODAY).cast("date")
        n = i.norms(spark, sf).select("zone_id", "doy", F.col("sst_norm").alias("sst_norm_f"), F.col("sst_sd").alias("sst_sd_f"), "wave_norm", "wind_norm")
        latest = latest_per_key(c.select("zone_id", "date", "sst_anom_f"), ["zone_id"], "date", not_after=today).select("zone_id", F.col("sst_anom_f").alias("anom_now"))
        model = c.where(F.col("date") > today).select("zone_id", "date", F.col("wave_ft").alias("wave_model_ft"), F.when(F.col("wind_kt") > 6, F.col("wind_kt")).alias("wind_model_kt"),
                                                     F.col("wave_period_s").alias("wave_model_period_s"), F.col("pressure_trend_24h").alias("pressure_trend_model_24h"))
        spine = ol.horizon(z.select("zone_id", "tide_station"), today)
        return ol.build_outlook(spine, n, latest, expected(spark, sf), products(spark, sf), model, i.tide_daily(spark, sf))
    return staged(spark, sf, "outlook", build)


@query("build_outlook", "zone_id s, date t, lead_days i, confidence_tier i, sst_proj_f d2, sst_anom_proj_f d2, sst_anom_core_f d2, sst_proj_lo_f d2, sst_proj_hi_f d2, w_persistence d4, w_enso_analog d4, w_cpc_outlook d4, cpc_nudge_f d3, "
       "model_blend_weight d3, wave_proj_ft d2, wind_proj_kt d2, sea_state_published b, sea_state_basis s, sst_basis s, product s", f"""
  SELECT zone_id, date, lead_days, tier AS confidence_tier, {even_sql('sst', 2)} AS sst_proj_f, {even_sql('anom', 2)} AS sst_anom_proj_f, {even_sql('core_anom', 2)} AS sst_anom_core_f, CASE WHEN half IS NOT NULL THEN {even_sql('sst - half', 2)} END AS sst_proj_lo_f,
    CASE WHEN half IS NOT NULL THEN {even_sql('sst + half', 2)} END AS sst_proj_hi_f, wp AS w_persistence, we AS w_enso_analog, wc AS w_cpc_outlook, {even_sql('wc * sig', 3)} AS cpc_nudge_f, {even_sql('bw', 3)} AS model_blend_weight, {even_sql('wave_p', 2)} AS wave_proj_ft,
    {even_sql('wind_p', 2)} AS wind_proj_kt, published AS sea_state_published, CASE WHEN wave_p IS NOT NULL AND wind_p IS NOT NULL THEN 'model-blended' WHEN published THEN 'partially model-blended' ELSE 'climatology only' END AS sea_state_basis,
    CASE WHEN wc > 0 THEN 'persistence + ENSO analog + CPC outlook' ELSE 'persistence + ENSO analog' END AS sst_basis, product FROM p_outlook""")
def build_outlook(spark, sf):
    return outlook(spark, sf)


_T = {"sst": "{s}", "season": "t_season", "tide": "t_tide", "moon": "t_moon", "swell": "t_swell"}


def _variant(name: str, sst: str, anom: str) -> str:
    """Gate argument of one scored variant."""
    terms = {"sst": trapezoid_sql(ref_temp_sql(sst), "ta", "tb", "tc", "td"), "season": "t_season", "tide": "t_tide", "moon": "t_moon", "swell": "t_swell"}
    num, den = mean_log_sql(terms)
    mult = f"coalesce({clamp_sql(f'1.0 + anomaly_pref * (({anom}) / 2.5) * 0.45', 0.35, 1.35)}, 1.0::DOUBLE)"
    core = clamp_sql(f"exp({num} / {den}) * {mult}", 0.01, 1.35)
    return clamp_sql(f"{core} * (0.35 + 0.65 * acc)", 0.01, 1.35) + f" AS g_{name}"


part("p_os0", f"""SELECT o.* EXCLUDE (zone_no), s.*  EXCLUDE (zone_id), coalesce(wave_p, o.wave_norm) AS wave_u, coalesce(wind_p, o.wind_norm) AS wind_u, CASE WHEN wave_p IS NOT NULL THEN wave_model_period_s END AS per_u,
  {even_sql('anom', 2)} AS anom2, coalesce({even_sql('sst + half', 2)} - {even_sql('sst', 2)}, 0) AS step FROM p_outlook o JOIN p_subjects s USING (zone_id)""")
part("p_os1", f"""SELECT *, season_index[month] AS t_season, {TIDE_SQL} AS t_tide, {MOON_SQL} AS t_moon, {swell_sql('wave_u')} AS t_swell, {access_sql('wind_u', 'wave_u', 'per_u')} AS acc FROM p_os0""")
part("p_os2", f"""SELECT *, {_variant('mid', 'sst', 'anom2')}, {_variant('lo', '(sst - coalesce(half, 0))', 'anom2 - step')}, {_variant('hi', '(sst + coalesce(half, 0))', 'anom2 + step')} FROM p_os1""")
part("p_os3", f"""SELECT o.zone_id, o.species_id, o.date, o.lead_days, o.tier, o.published, round(100 * {soft_sql('g_mid')}, 1) AS mid, round(100 * {soft_sql('g_lo')}, 1) AS lo, round(100 * {soft_sql('g_hi')}, 1) AS hi, c.climatological_score AS clim
  FROM p_os2 o LEFT JOIN p_curve c ON c.zone_id = o.zone_id AND c.species_id = o.species_id AND c.doy = o.doy""")
part("p_os4", """SELECT *, abs(mid - greatest(1.0, least(lo, mid, hi) - CASE WHEN tier = 2 THEN 3 ELSE 7 END)) AS wl, abs(least(99.9, greatest(lo, mid, hi) + CASE WHEN tier = 2 THEN 3 ELSE 7 END) - mid) AS wh FROM p_os3 WHERE mid IS NOT NULL""")
part("p_os5", """SELECT *, max(wl) OVER w AS rl, max(wh) OVER w AS rh FROM p_os4 WINDOW w AS (PARTITION BY zone_id, species_id ORDER BY lead_days)""")


def outlook_scores(spark, sf):
    return staged(spark, sf, "outlook_scores", lambda: ol.score_outlook(outlook(spark, sf), i.subjects(spark, sf), i.zones(spark, sf), i.curve(spark, sf)))


@query("w05_outlook_scores_ratchet", "zone_id s, species_id s, date t, lead_days i, score_outlook d1, score_lo d1, score_hi d1, climatological_score d1, vs_seasonal_norm d1, score_halfband_lo_pts d1, score_halfband_hi_pts d1, "
       "score_band_hits_ceiling b, score_band_hits_floor b, basis s", """
  SELECT zone_id, species_id, date, lead_days, mid AS score_outlook, round(greatest(1.0, mid - rl), 1) AS score_lo, round(least(99.9, mid + rh), 1) AS score_hi, clim AS climatological_score, round(mid - clim, 1) AS vs_seasonal_norm,
    round(rl, 1) AS score_halfband_lo_pts, round(rh, 1) AS score_halfband_hi_pts, mid + rh > 99.9 AS score_band_hits_ceiling, mid - rl < 1.0 AS score_band_hits_floor,
    CASE WHEN published THEN 'model-blended conditions + exact tide/moon' ELSE 'climatology + ENSO analog + exact tide/moon' END AS basis FROM p_os5""")
def outlook_ratchet(spark, sf):
    return outlook_scores(spark, sf)


@query("u05_stitched_series", "zone_id s, species_id s, date t, tier i, value d1, is_norm b", f"""
  SELECT coalesce(n.zone_id, o.zone_id) AS zone_id, coalesce(n.species_id, o.species_id) AS species_id, coalesce(n.date, o.date) AS date, o.tier, coalesce(o.score, n.norm) AS value, o.score IS NULL AS is_norm FROM (
    SELECT zone_id, species_id, CAST(DATE '{TODAY}' + CAST(l AS INT) AS DATE) AS date, climatological_score AS norm FROM p_curve, (SELECT unnest(range(0, 31)) AS l) WHERE doy = dayofyear(DATE '{TODAY}' + CAST(l AS INT)) AND climatological_score IS NOT NULL) n
  FULL JOIN (SELECT zone_id, species_id, date, score, 1 AS tier FROM p_scores WHERE score IS NOT NULL AND date BETWEEN DATE '{TODAY}' AND DATE '{TODAY}' + 6
    UNION ALL SELECT zone_id, species_id, date, mid, tier FROM p_os4) o ON o.zone_id = n.zone_id AND o.species_id = n.species_id AND o.date = n.date""")
def stitched(spark, sf):
    t = F.lit(TODAY).cast("date")
    near = i.scores(spark, sf).where(F.col("date").between(t, F.date_add(t, 6)))
    days = F.explode(F.transform(F.sequence(F.lit(0), F.lit(30)), lambda k: F.date_add(t, k)))
    span = i.subjects(spark, sf).select("species_id", F.explode("zones").alias("zone_id")).withColumn("date", days).withColumn("doy", F.dayofyear("date"))
    norm = i.curve(spark, sf).join(span, ["zone_id", "species_id", "doy"]).select("zone_id", "species_id", "date", F.col("climatological_score").alias("norm_score"))
    return ol.stitched_series(near, outlook_scores(spark, sf), norm, ["zone_id", "species_id"])


@query("m14_category_signal", "product s, signal_f d3, confidence d3", """
  SELECT product, signal_f, round(greatest(0.0, (prob - 33.3) / 66.7), 3) AS confidence FROM p_products""")
def signal(spark, sf):
    return ol.product_table(samples(spark, sf))
