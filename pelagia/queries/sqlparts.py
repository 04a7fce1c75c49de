"""The derivations of ``inputs`` as named SQL parts, joined into a WITH list on demand."""

from __future__ import annotations

import re

from .inputs import AS_OF_DAY, SUBJECT_ROWS, TERM_NAMES, season_curve

PARTS: dict[str, str] = {}


def part(name: str, body: str) -> None:
    PARTS[name] = body


def with_parts(body: str) -> str:
    """Prefix a query with every part it needs, dependencies first."""
    order: list[str] = []

    def visit(text: str, trail: tuple[str, ...] = ()):
        for word in dict.fromkeys(re.findall(r"\b[a-z_0-9]+\b", text)):
            if word in PARTS and word not in order and word not in trail:
                visit(PARTS[word], (*trail, word))
                order.append(word)

    visit(body)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({PARTS[n]})" for n in order) + "\n" + body


_flags = ", ".join(f"""count(*) FILTER (l_returnflag = '{f}') AS {f.lower()}n,
  sum(CASE WHEN l_returnflag = '{f}' THEN CAST(l_quantity AS BIGINT) END) AS {f.lower()}q,
  sum(CASE WHEN l_returnflag = '{f}' THEN CAST(round(l_discount * 100) AS BIGINT) END) AS {f.lower()}disc""" for f in "RAN")
_sums = ", ".join(f"sum({m}) AS {m}" for m in ["n", "q", "disc", "tax", "cents"] + [f"{f}{m}" for f in "ran" for m in ("n", "q", "disc")])

part("p_supplier_days", f"""SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date, count(*) AS n, sum(CAST(l_quantity AS BIGINT)) AS q,
  sum(CAST(round(l_discount * 100) AS BIGINT)) AS disc, sum(CAST(round(l_tax * 100) AS BIGINT)) AS tax,
  sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS cents, {_flags} FROM lineitem GROUP BY 1, 2""")
part("p_zone_raw", f"""SELECT n_name AS zone_id, r_name AS region, date, {_sums} FROM p_supplier_days
  JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2, 3""")
part("p_region_raw", f"SELECT region, date, {_sums} FROM p_zone_raw GROUP BY 1, 2")
part("p_zone_daily", """SELECT zone_id, date, 45.0::DOUBLE + 0.7937::DOUBLE * (q / n) AS sst_f_model, 1.1::DOUBLE * (disc / n) AS wave_ft,
  5.0::DOUBLE + CASE WHEN rn > 0 THEN rq / rn END / 5.0::DOUBLE AS wave_period_s, 3.0::DOUBLE * (tax / n) AS wind_kt,
  1000.0::DOUBLE + cents / n / 400000.0::DOUBLE AS pressure_hpa FROM p_zone_raw""")
part("p_satellite", "SELECT zone_id, date, 45.0::DOUBLE + 0.7937::DOUBLE * (rq / rn) AS sst_f FROM p_zone_raw WHERE rn > 0")
part("p_shore_daily", "SELECT region AS tide_station, date, 45.0::DOUBLE + 0.7937::DOUBLE * (aq / an) AS shore_sst_f, an AS n_obs FROM p_region_raw WHERE an >= 1")
part("p_tide_daily", """SELECT region AS tide_station, date, 2.0::DOUBLE + 0.6::DOUBLE * (tax / n) AS tide_range_ft,
  disc / n / 5.0::DOUBLE AS max_exchange_rate_ft_h, 0.48::DOUBLE * (q / n) AS best_water_hour,
  CASE WHEN an > 0 THEN CAST(q % 24 AS DOUBLE) END AS first_high_hour FROM p_region_raw""")
part("p_buoy_daily", "SELECT region AS station, date, 1.1::DOUBLE * (disc / n) AS wave_ft, 3.0::DOUBLE * (tax / n) AS wind_kt FROM p_region_raw")
part("p_fronts", """SELECT zone_id, date, ndisc / nn / 15.0::DOUBLE AS front_f_per_nm, 0.5::DOUBLE * (nq / nn) AS sst_spread_f
  FROM p_zone_raw WHERE nn > 0""")
part("p_chl", "SELECT zone_id, date, 0.6::DOUBLE * (adisc / an) AS chl_mg_m3 FROM p_zone_raw WHERE an > 0")
part("p_upwelling", "SELECT date, sum(tax) / sum(n) AS cuti FROM p_region_raw GROUP BY 1")
part("p_month", """SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
  sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS c, count(*) AS n FROM orders GROUP BY 1, 2""")
part("p_index", """SELECT 'S' || lpad(CAST(month AS VARCHAR), 2, '0') AS season, year, month,
  round(30.0::DOUBLE * (c / n / (SELECT sum(c) / sum(n) FROM p_month) - 1.0::DOUBLE), 2) AS oni FROM p_month""")
part("p_index_labelled", """SELECT *, CASE WHEN oni >= 1.5 THEN 'Strong El Nino' WHEN oni >= 0.5 THEN 'El Nino' WHEN oni <= -1.5 THEN 'Strong La Nina'
  WHEN oni <= -0.5 THEN 'La Nina' ELSE 'Neutral' END AS regime,
  CASE WHEN oni >= 0.5 THEN 'El Nino' WHEN oni <= -0.5 THEN 'La Nina' ELSE 'Neutral' END AS simple_regime FROM p_index""")
part("p_current", """SELECT season, year, month, oni, regime, simple_regime,
  (SELECT avg(oni) FROM (SELECT oni FROM p_index ORDER BY year DESC, month DESC LIMIT 12)) AS trailing_12mo_mean_oni
  FROM p_index_labelled ORDER BY year DESC, month DESC LIMIT 1""")
part("p_zones", """SELECT n_name AS zone_id, n_nationkey AS zone_no, n_regionkey AS region_no, n_regionkey = 0 AS inshore, r_name AS tide_station,
  r_name AS primary_buoy, 2.0::DOUBLE * n_nationkey AS distance_nm, 20.0::DOUBLE + 10.0::DOUBLE * n_nationkey AS depth_mid_ft
  FROM nation JOIN region ON r_regionkey = n_regionkey""")


def _subject_values() -> str:
    rows = []
    for i, (t, g, ref, win, a, tide, moon, tol, w, ph) in enumerate(SUBJECT_ROWS):
        season = "[" + ", ".join(f"{x}::DOUBLE" for x in season_curve(ph)) + "]"
        nums = ", ".join(f"{x}::DOUBLE" for x in (*win, a, tol, *w))
        rows.append(f"('{t}', '{g}', '{ref}', '{tide}', '{moon}', {i}, {nums}, {season})")
    cols = "species_id, grp, temp_ref, tide_pref, moon_pref, subject_no, ta, tb, tc, td, anomaly_pref, swell_tolerance_ft, " + \
        ", ".join(f"w_{k}" for k in TERM_NAMES) + ", season_index"
    return f"SELECT * FROM (VALUES {', '.join(rows)}) AS v({cols})"


part("p_subject_params", _subject_values())
part("p_subjects", """SELECT p.*, z.zone_id FROM p_subject_params p JOIN (SELECT DISTINCT p_type FROM part) t ON t.p_type = p.species_id
  JOIN p_zones z ON (z.zone_no + p.subject_no) % 6 <> 0""")


def doy_climatology_sql(source: str, entity: str, value: str, label: str) -> str:
    return f"""SELECT s.{entity}, s.doy, s.{label}_norm, s.{label}_sd, s.{label}_p10, s.{label}_p50, s.{label}_p90, s.{label}_n, y.{label}_years FROM (
    SELECT {entity}, CAST((((dayofyear(date) + k - 1) % 366) + 366) % 366 + 1 AS INT) AS doy, avg({value}) AS {label}_norm,
      stddev_samp({value}) AS {label}_sd, quantile_cont({value}, 0.1) AS {label}_p10, quantile_cont({value}, 0.5) AS {label}_p50,
      quantile_cont({value}, 0.9) AS {label}_p90, count({value}) AS {label}_n
    FROM {source}, (SELECT unnest(range(-7, 8)) AS k) WHERE {value} IS NOT NULL GROUP BY 1, 2 HAVING count({value}) >= 5) s
  JOIN (SELECT {entity}, count(DISTINCT year(date)) AS {label}_years FROM {source} WHERE {value} IS NOT NULL GROUP BY 1) y USING ({entity})"""


part("p_sst_clim", doy_climatology_sql("p_satellite", "zone_id", "sst_f", "sst"))
part("p_shore_clim", doy_climatology_sql("p_shore_daily", "tide_station", "shore_sst_f", "shoresst"))
part("p_wave_clim", doy_climatology_sql("p_buoy_daily", "station", "wave_ft", "wave"))
part("p_wind_clim", doy_climatology_sql("p_buoy_daily", "station", "wind_kt", "wind"))
part("p_buoy_clim", """SELECT coalesce(a.station, b.station) AS primary_buoy, coalesce(a.doy, b.doy) AS doy, wave_norm, wave_p90, wind_norm, wind_p90
  FROM p_wave_clim a FULL JOIN p_wind_clim b ON a.station = b.station AND a.doy = b.doy""")


def percentile_sql(anom: str, sd: str) -> str:
    """Normal-law percentile of an anomaly (same erf approximation as the column expression)."""
    z = f"(abs({anom}) / ({sd} * sqrt(2.0::DOUBLE)))"
    t = f"(1.0::DOUBLE / (1.0 + 0.3275911 * {z}))"
    poly = f"(((((1.061405429 * {t} - 1.453152027) * {t} + 1.421413741) * {t} - 0.284496736) * {t} + 0.254829592) * {t})"
    erf = f"(CASE WHEN {anom} < 0 THEN -1.0 ELSE 1.0 END) * (1.0 - {poly} * exp(-({z} * {z})))"
    return f"CASE WHEN {sd} <> 0 AND {anom} IS NOT NULL THEN greatest(0.1::DOUBLE, least(99.9::DOUBLE, 50.0 * (1.0 + {erf}))) END"


part("p_sat_anom", f"""SELECT *, {percentile_sql('sst_anom_f', 'sst_sd')} AS sst_pctile FROM (
  SELECT s.zone_id, s.date, s.sst_f, CAST(dayofyear(s.date) AS INT) AS doy, c.sst_norm, c.sst_sd, s.sst_f - c.sst_norm AS sst_anom_f
  FROM p_satellite s LEFT JOIN p_sst_clim c ON c.zone_id = s.zone_id AND c.doy = dayofyear(s.date))""")

# lunar and solar fields per date
part("p_moon_raw", """SELECT date, jd, (jd - 2451545.0::DOUBLE) / 36525.0 AS tt FROM (
  SELECT date, (date - DATE '1970-01-01') + 0.5::DOUBLE + 2440587.5::DOUBLE AS jd FROM (SELECT DISTINCT date FROM p_dates))""")
part("p_dates", """SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem UNION SELECT DISTINCT CAST(o_orderdate AS DATE) FROM orders
  UNION SELECT CAST(DATE '2001-06-30' + CAST(unnest(range(7, 31)) AS INT) AS DATE)""")
part("p_moon_args", """SELECT date, jd, (((297.8501921::DOUBLE + 445267.1114034::DOUBLE * tt - 0.0018819::DOUBLE * tt * tt) % 360) + 360) % 360 AS d,
  (((357.5291092::DOUBLE + 35999.0502909::DOUBLE * tt) % 360) + 360) % 360 AS m,
  (((134.9633964::DOUBLE + 477198.8675055::DOUBLE * tt) % 360) + 360) % 360 AS p FROM p_moon_raw""")
part("p_moon", """SELECT date, (1 + cos(radians(angle))) / 2 AS moon_illum, age AS moon_age_days,
  CASE WHEN age <= 1.5 THEN 'New' WHEN age <= 6 THEN 'Waxing Crescent' WHEN age <= 9 THEN 'First Quarter' WHEN age <= 13.5 THEN 'Waxing Gibbous'
    WHEN age <= 16.5 THEN 'Full' WHEN age <= 21 THEN 'Waning Gibbous' WHEN age <= 24 THEN 'Last Quarter' WHEN age <= 28.1 THEN 'Waning Crescent' ELSE 'New' END AS moon_phase
  FROM (SELECT date, (((180 - d - 6.289 * sin(radians(p)) + 2.100 * sin(radians(m)) - 1.274 * sin(radians(2 * d - p)) - 0.658 * sin(radians(2 * d))
      - 0.214 * sin(radians(2 * p)) - 0.110 * sin(radians(d))) % 360) + 360) % 360 AS angle,
    ((((jd - 2451550.1::DOUBLE) / 29.530588::DOUBLE) % 1) + 1) % 1 * 29.530588::DOUBLE AS age FROM p_moon_args)""")
part("p_sun_raw", """SELECT date, 229.18 * (0.000075 + 0.001868 * cos(g) - 0.032077 * sin(g) - 0.014615 * cos(2 * g) - 0.040849 * sin(2 * g)) AS eqt,
  0.006918 - 0.399912 * cos(g) + 0.070257 * sin(g) - 0.006758 * cos(2 * g) + 0.000907 * sin(2 * g) - 0.002697 * cos(3 * g) + 0.00148 * sin(3 * g) AS decl
  FROM (SELECT DISTINCT date, 2.0 * pi() / 365.0 * (dayofyear(date) - 0.5::DOUBLE) AS g FROM p_dates)""")
part("p_sun", """SELECT date, (720 + 4 * (117.22::DOUBLE - ha) - eqt) / 60 - 8 + dst AS sunrise_hour, (720 + 4 * (117.22::DOUBLE + ha) - eqt) / 60 - 8 + dst AS sunset_hour,
  8 * ha / 60 AS daylight_hours FROM (SELECT date, eqt, degrees(acos(greatest(-1.0, least(1.0, cos(radians(90.833::DOUBLE)) / (cos(radians(32.72::DOUBLE)) * cos(decl)) - tan(radians(32.72::DOUBLE)) * tan(decl))))) AS ha,
    CASE WHEN month(date) BETWEEN 3 AND 10 THEN 1 ELSE 0 END AS dst FROM p_sun_raw)""")
part("p_calendar", "SELECT m.date, moon_illum, moon_phase, moon_age_days, sunrise_hour, sunset_hour, daylight_hours FROM p_moon m JOIN p_sun s USING (date)")

part("p_cond_joined", """SELECT d.*, z.inshore, z.tide_station, z.primary_buoy, z.distance_nm, z.depth_mid_ft, CAST(dayofyear(d.date) AS INT) AS doy,
  CAST(month(d.date) AS INT) AS month, s.sst_f AS sst_f_sat, c.sst_norm AS c_norm, c.sst_sd AS c_sd, c.sst_years AS c_years,
  t.tide_range_ft, t.max_exchange_rate_ft_h, t.best_water_hour, t.first_high_hour, sh.shore_sst_f, sc.shoresst_norm, sc.shoresst_sd, sc.shoresst_years,
  b.wave_norm, b.wind_norm, f.front_f_per_nm, f.sst_spread_f, ch.chl_mg_m3, u.cuti, cal.moon_illum, cal.moon_age_days, cal.moon_phase, cal.sunrise_hour, cal.sunset_hour,
  z.inshore AND sh.shore_sst_f IS NOT NULL AS use_shore
  FROM p_zone_daily d JOIN p_zones z USING (zone_id) LEFT JOIN p_satellite s ON s.zone_id = d.zone_id AND s.date = d.date
  LEFT JOIN p_sst_clim c ON c.zone_id = d.zone_id AND c.doy = dayofyear(d.date) LEFT JOIN p_tide_daily t ON t.tide_station = z.tide_station AND t.date = d.date
  LEFT JOIN p_shore_daily sh ON sh.tide_station = z.tide_station AND sh.date = d.date
  LEFT JOIN p_shore_clim sc ON sc.tide_station = z.tide_station AND sc.doy = dayofyear(d.date)
  LEFT JOIN p_buoy_clim b ON b.primary_buoy = z.primary_buoy AND b.doy = dayofyear(d.date)
  LEFT JOIN p_fronts f ON f.zone_id = d.zone_id AND f.date = d.date LEFT JOIN p_chl ch ON ch.zone_id = d.zone_id AND ch.date = d.date
  LEFT JOIN p_upwelling u ON u.date = d.date LEFT JOIN p_calendar cal ON cal.date = d.date""")
part("p_cond_sst", """SELECT *, CASE WHEN use_shore THEN shore_sst_f ELSE coalesce(sst_f_sat, sst_f_model) END AS sst_f,
  CASE WHEN use_shore THEN 'NOAA CO-OPS shore thermistor' WHEN sst_f_sat IS NOT NULL THEN 'MUR 1km satellite' ELSE 'Open-Meteo marine model' END AS sst_source,
  CASE WHEN use_shore THEN shoresst_norm ELSE c_norm END AS sst_norm, CASE WHEN use_shore THEN shoresst_sd ELSE c_sd END AS sst_sd,
  CASE WHEN use_shore THEN shoresst_years ELSE c_years END AS sst_years FROM p_cond_joined""")
part("p_conditions", f"""SELECT *, {percentile_sql('sst_anom_f', 'sst_sd')} AS sst_pctile FROM (SELECT *, sst_f - sst_norm AS sst_anom_f,
  sst_f - lag(sst_f, 7) OVER (PARTITION BY zone_id ORDER BY date) AS sst_trend_7d,
  pressure_hpa - lag(pressure_hpa) OVER (PARTITION BY zone_id ORDER BY date) AS pressure_trend_24h,
  wave_ft - wave_norm AS wave_anom_ft, wind_kt - wind_norm AS wind_anom_kt, date > DATE '{AS_OF_DAY}' AS is_forecast FROM p_cond_sst)""")


def even_sql(x: str, digits: int) -> str:
    """Half-even rounding on the scaled value, like the library's ``round_to``."""
    s = f"(({x}) * {float(10 ** digits)}::DOUBLE)"
    return f"((CASE WHEN abs({s} - trunc({s})) = 0.5 THEN 2 * round({s} / 2) ELSE round({s}) END) / {float(10 ** digits)}::DOUBLE)"


def clamp_sql(x: str, lo: float = 0.02, hi: float = 1.0) -> str:
    return f"(CASE WHEN ({x}) IS NULL THEN NULL ELSE greatest({lo}::DOUBLE, least({hi}::DOUBLE, {x})) END)"


def trapezoid_sql(x: str, a: str, b: str, c: str, d: str) -> str:
    return f"""(CASE WHEN ({x}) IS NULL THEN NULL WHEN {x} <= {a} OR {x} >= {d} THEN 0.02 WHEN {x} < {b} THEN 0.02 + 0.98 * ({x} - {a}) / ({b} - {a})
      WHEN {x} <= {c} THEN 1.0 ELSE 0.02 + 0.98 * ({d} - {x}) / ({d} - {c}) END)"""


def access_sql(wind: str, wave: str, period: str) -> str:
    wg = clamp_sql(trapezoid_sql(wind, "(-5.0::DOUBLE)", "0.0", "12.0", "(CASE WHEN distance_nm < 5 THEN 26.0::DOUBLE ELSE 22.0 END)"))
    sg = clamp_sql(trapezoid_sql(wave, "(-1.0::DOUBLE)", "0.0", "(CASE WHEN distance_nm > 15 THEN 3.5::DOUBLE ELSE 4.5 END)",
                                 "(CASE WHEN distance_nm > 15 THEN 9.0::DOUBLE ELSE 11.0 END)"))
    body = clamp_sql(f"""({wg} * 0.5 + {sg} * 0.5) * (CASE WHEN {period} < 8 AND {wave} > 3 THEN 0.75 ELSE 1.0 END)
      * (CASE WHEN distance_nm < 12 THEN 1.0 WHEN distance_nm < 40 THEN 0.9 ELSE 0.8 END)""", 0.05, 1.0)
    return f"(CASE WHEN {wind} IS NULL OR {wave} IS NULL THEN 0.7::DOUBLE ELSE {body} END)"


def swell_sql(wave: str) -> str:
    return f"""(CASE WHEN {wave} IS NULL THEN NULL WHEN {wave} <= swell_tolerance_ft * 0.35 THEN 1.0 WHEN {wave} >= swell_tolerance_ft * 1.9 THEN 0.05
      ELSE {clamp_sql(f'1.0 - 0.95 * ({wave} - swell_tolerance_ft * 0.35) / (swell_tolerance_ft * 1.55)')} END)"""


def soft_sql(v: str) -> str:
    return f"(CASE WHEN {v} <= 0.9 THEN {v} ELSE 0.9 + 0.1 * (1.0 - exp(-({v} - 0.9) / 0.1)) END)"


def mean_log_sql(terms: dict[str, str]) -> tuple[str, str]:
    num = " + ".join(f"CASE WHEN {v} IS NOT NULL AND w_{k} > 0 THEN w_{k} * ln(greatest({v}, 0.02)) ELSE 0 END" for k, v in terms.items())
    den = " + ".join(f"CASE WHEN {v} IS NOT NULL AND w_{k} > 0 THEN w_{k} ELSE 0 END" for k, v in terms.items())
    return f"({num})", f"({den})"


def ref_temp_sql(t: str) -> str:
    return f"({t} - CASE WHEN temp_ref = 'bottom' THEN 14.0 * (1.0 - exp(-depth_mid_ft / 160.0)) ELSE 0.0::DOUBLE END)"


_base = "(0.45 * {r} + 0.55 * {x})".format(r=clamp_sql("0.25 + 0.75 * least(1.0::DOUBLE, (tide_range_ft - 2.0) / 4.5)"),
                                         x=clamp_sql("0.25 + 0.75 * least(1.0::DOUBLE, (max_exchange_rate_ft_h - 0.5) / 1.3)"))
_light = """least(abs(best_water_hour - sunrise_hour), abs(best_water_hour - sunset_hour), abs(best_water_hour + 24 - sunrise_hour), abs(best_water_hour - 24 - sunset_hour))"""
_timing = f"(CASE WHEN best_water_hour IS NULL THEN 0.5 ELSE {clamp_sql(f'exp(-(({_light}) * ({_light})) / 12.5)')} END)"
_push_d = "least(abs(first_high_hour - 7), abs(first_high_hour - 19))"
_push = f"(CASE WHEN first_high_hour IS NULL THEN 0.5 ELSE {clamp_sql(f'exp(-({_push_d} * {_push_d}) / 24.5)')} END)"
TIDE_SQL = f"""(CASE WHEN tide_range_ft IS NULL OR max_exchange_rate_ft_h IS NULL THEN NULL ELSE {clamp_sql(f'''CASE tide_pref WHEN 'any' THEN 0.6 + 0.4 * {_base}
  WHEN 'strong_moving' THEN 0.55 * {_base} + 0.45 * (0.4 + 0.6 * {_timing}) WHEN 'high_pushing' THEN 0.45 * {_base} + 0.55 * (0.35 + 0.65 * {_push})
  WHEN 'grey_light_moving' THEN 0.4 * {_base} + 0.6 * (0.3 + 0.7 * {_timing}) WHEN 'moderate' THEN 1.0 - abs({_base} - 0.6) * 0.9
  ELSE 0.5 * {_base} + 0.5 * (0.45 + 0.55 * {_timing}) END''')} END)"""
_nm = "least(abs(moon_age_days - 2.5), abs(moon_age_days - 32.03))"
MOON_SQL = f"""(CASE WHEN moon_illum IS NULL THEN NULL WHEN moon_pref = 'any' THEN 0.75 + 0.25 * (1 - abs(moon_illum - 0.5) * 2) * 0.5 + 0.1
  WHEN moon_pref = 'spring_tide' THEN {clamp_sql('0.45 + 0.55 * abs(moon_illum - 0.5) * 2')}
  WHEN moon_pref = 'post_new_moon' THEN coalesce({clamp_sql(f'0.35 + 0.65 * exp(-({_nm} * {_nm}) / 18.0)')}, 0.6)
  WHEN moon_pref = 'dark_or_full_night' THEN {clamp_sql('0.5 + 0.5 * abs(moon_illum - 0.5) * 2')} ELSE 0.7 END)"""
PRESSURE_SQL = """(CASE WHEN pressure_trend_24h IS NULL THEN NULL WHEN pressure_trend_24h <= -4 THEN 0.55 WHEN pressure_trend_24h <= -1 THEN 1.0
  WHEN pressure_trend_24h <= 1 THEN 0.85 WHEN pressure_trend_24h <= 4 THEN 0.6 ELSE 0.4 END)"""
FRONT_SQL = """(CASE WHEN coalesce(front_f_per_nm, sst_spread_f / 12.0) IS NULL THEN NULL ELSE """ + clamp_sql(
    "0.25 + 0.75 * least(1.0::DOUBLE, coalesce(front_f_per_nm, sst_spread_f / 12.0) / 0.6)") + " END)"
CHL_SQL = f"""(CASE WHEN grp IN ('tuna', 'pelagic') THEN {clamp_sql(trapezoid_sql('chl_mg_m3', '0.02', '0.15', '1.2', '6.0'))}
  ELSE {clamp_sql(trapezoid_sql('chl_mg_m3', '0.05', '0.3', '3.0', '15.0'))} END)"""
ANOM_SQL = clamp_sql("1.0 + anomaly_pref * (sst_anom_f / 2.5) * 0.45", 0.35, 1.35)

part("p_terms", f"""SELECT *, {trapezoid_sql(ref_temp_sql('sst_f'), 'ta', 'tb', 'tc', 'td')} AS t_sst, season_index[month] AS t_season, {TIDE_SQL} AS t_tide,
  {MOON_SQL} AS t_moon, {PRESSURE_SQL} AS t_pressure, {swell_sql('wave_ft')} AS t_swell, {FRONT_SQL} AS t_front, {CHL_SQL} AS t_chl, {ANOM_SQL} AS t_anom,
  {access_sql('wind_kt', 'wave_ft', 'wave_period_s')} AS acc, {trapezoid_sql(ref_temp_sql('sst_norm'), 'ta', 'tb', 'tc', 'td')} AS n_sst,
  {swell_sql('wave_norm')} AS n_swell, {access_sql('wind_norm', 'wave_norm', 'wave_period_s')} AS n_acc
  FROM p_conditions c JOIN p_subjects s USING (zone_id)""")
_num, _den = mean_log_sql({k: f"t_{k}" for k in TERM_NAMES})
CLIM_TERMS = {"sst": "n_sst", "season": "t_season", "tide": "0.72::DOUBLE", "moon": "0.72::DOUBLE", "pressure": "0.85::DOUBLE", "swell": "n_swell", "front": "0.6::DOUBLE", "chl": "0.7::DOUBLE"}
_cnum, _cden = mean_log_sql(CLIM_TERMS)
part("p_core", f"""SELECT *, {_den} AS wsum, {clamp_sql(f'exp({_num} / {_den}) * coalesce(t_anom, 1.0::DOUBLE)', 0.01, 1.35)} AS core,
  {clamp_sql(f'exp({_cnum} / {_cden})', 0.01, 1.35)} AS n_core FROM p_terms""")
part("p_gate", f"""SELECT *, {clamp_sql('core * (0.35 + 0.65 * acc)', 0.01, 1.35)} AS g, {clamp_sql('n_core * (0.35 + 0.65 * n_acc)', 0.01, 1.35)} AS n_g FROM p_core""")
part("p_scores", f"""SELECT date, zone_id, species_id, grp, round(100 * {soft_sql('g')}, 1) AS score, round(100 * {soft_sql('n_g')}, 1) AS seasonal_norm_score,
  round(round(100 * {soft_sql('g')}, 1) - round(100 * {soft_sql('n_g')}, 1), 1) AS vs_norm, round(100 * {soft_sql('core')}, 1) AS core_score,
  {even_sql('100 * acc', 1)} AS fishability, is_forecast, sst_f, sst_anom_f, wave_ft, wind_kt, tide_range_ft, moon_illum, front_f_per_nm, doy, month,
  {', '.join(even_sql(f't_{k}', 3) + f' AS term_{k}' for k in TERM_NAMES)}, {even_sql('t_anom', 3)} AS anomaly_term, wsum,
  {', '.join(f't_{k}, w_{k}' for k in TERM_NAMES)}, anomaly_pref,
  concat_ws(',', {', '.join(f"CASE WHEN t_{k} IS NULL AND w_{k} > 0 THEN '{k}' END" for k in TERM_NAMES)}) AS missing_drivers,
  CASE WHEN wind_kt IS NULL OR wave_ft IS NULL THEN 'insufficient wind/wave data' ELSE coalesce(nullif(concat_ws(', ',
    CASE WHEN wind_kt > 18 THEN printf('%.0f kt wind', {even_sql('wind_kt', 0)}) END, CASE WHEN wave_ft > 5 THEN printf('%.1f ft seas', {even_sql('wave_ft', 1)}) END,
    CASE WHEN distance_nm > 40 THEN 'long-range run' END), ''), 'workable') END AS access_note FROM p_gate""")

part("p_norms", """SELECT z.*, n.doy, n.sst_norm, n.sst_sd, n.src AS climatology_source, b.wave_norm, b.wind_norm FROM p_zones z JOIN (
    SELECT zone_id, doy, shoresst_norm AS sst_norm, shoresst_sd AS sst_sd, 'CO-OPS shore climatology' AS src FROM p_zones JOIN p_shore_clim USING (tide_station) WHERE inshore
    UNION ALL SELECT zone_id, doy, sst_norm, sst_sd, 'MUR satellite climatology' FROM p_zones JOIN p_sst_clim USING (zone_id) WHERE NOT inshore) n USING (zone_id)
  LEFT JOIN p_buoy_clim b ON b.primary_buoy = z.primary_buoy AND b.doy = n.doy""")
part("p_curve_terms", f"""SELECT *, {trapezoid_sql(ref_temp_sql('sst_norm'), 'ta', 'tb', 'tc', 'td')} AS n_sst, season_index[month] AS t_season, {swell_sql('wave_norm')} AS n_swell,
  {access_sql('wind_norm', 'wave_norm', 'wave_period_s')} AS n_acc FROM (SELECT n.*, CAST(month(DATE '2025-01-01' + CAST(doy - 1 AS INT)) AS INT) AS month, CAST(NULL AS DOUBLE) AS wave_period_s FROM p_norms n)
  JOIN p_subjects s USING (zone_id)""")
part("p_curve", f"""SELECT zone_id, species_id, doy, month, round(100 * {soft_sql('g')}, 1) AS climatological_score, sst_norm AS sst_norm_f, wave_norm AS wave_norm_ft, wind_norm AS wind_norm_kt, climatology_source
  FROM (SELECT *, {clamp_sql('n_core * (0.35 + 0.65 * n_acc)', 0.01, 1.35)} AS g FROM (SELECT *, {clamp_sql(f'exp({_cnum} / {_cden})', 0.01, 1.35)} AS n_core FROM p_curve_terms))""")
