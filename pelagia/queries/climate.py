"""Resampling, climatology, anomaly, regime and tide-feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import date_spine, local_date
from ..operators import climatology as cl
from ..operators import features as ft
from ..operators import ordered as od
from ..plans import conditions as cond
from ..sources.readers import upwelling_daily
from . import inputs as i
from .registry import query
from .sqlparts import doy_climatology_sql, part


@query("a01_hourly_resample", "event_type s, ts_hour z, value d6", """
  SELECT g.event_type, g.ts_hour, h.value FROM (
    SELECT event_type, unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)), INTERVAL 1 HOUR)) AS ts_hour FROM events GROUP BY 1) g
  LEFT JOIN (SELECT event_type, date_trunc('hour', ts) AS ts_hour, avg(value) AS value FROM events GROUP BY 1, 2) h
    ON h.event_type = g.event_type AND h.ts_hour = g.ts_hour""")
def hourly(spark, sf):
    return ft.hourly_means(i.events(spark, sf), "event_type", "ts", ["value"])


@query("a02_local_day_features", "event_type s, date t, value_mean d6, value_max d6, value_min d6", """
  SELECT event_type, CAST(timezone('America/Los_Angeles', timezone('UTC', ts_hour)) AS DATE) AS date, avg(v) AS value_mean, max(v) AS value_max, min(v) AS value_min
  FROM (SELECT event_type, date_trunc('hour', ts) AS ts_hour, avg(value) AS v FROM events GROUP BY 1, 2) GROUP BY 1, 2""")
def local_day(spark, sf):
    hourly_rows = ft.hourly_means(i.events(spark, sf), "event_type", "ts", ["value"], fill_gaps=False)
    return ft.daily_from_hourly(hourly_rows, "event_type", {"value_mean": ("value", "mean"), "value_max": ("value", "max"),
                                                            "value_min": ("value", "min")}, "America/Los_Angeles")


@query("a03_daily_stats_min_obs", "event_type s, date t, value d6, value_min d6, value_max d6, n_obs l", """
  SELECT event_type, CAST(ts AS DATE) AS date, avg(value) AS value, min(value) AS value_min, max(value) AS value_max, count(value) AS n_obs
  FROM events WHERE event_type IS NOT NULL GROUP BY 1, 2 HAVING count(value) >= 12""")
def daily_stats(spark, sf):
    return cl.daily_stats(i.events(spark, sf), ["event_type"], F.to_date("ts"), F.col("value"), "value", min_n=12)


part("p_flag_day", "SELECT l_returnflag, CAST(l_shipdate AS DATE) AS date, avg(l_quantity) AS qty FROM lineitem GROUP BY 1, 2")
part("p_flag_clim", doy_climatology_sql("p_flag_day", "l_returnflag", "qty", "qty"))


def flag_daily(spark, sf):
    return cl.daily_stats(i.table(spark, sf, "lineitem"), ["l_returnflag"], F.to_date("l_shipdate"), F.col("l_quantity"), "qty")


@query("a04_doy_climatology", "l_returnflag s, doy i, qty_norm d6, qty_sd d6, qty_p10 d6, qty_p50 d6, qty_p90 d6, qty_n l, qty_years l",
       "SELECT * FROM p_flag_clim")
def doy_clim(spark, sf):
    return cl.doy_climatology(flag_daily(spark, sf), "l_returnflag", "qty", "qty")


@query("a04_zone_sst_climatology", "zone_id s, doy i, sst_norm d6, sst_sd d6, sst_p10 d6, sst_p50 d6, sst_p90 d6, sst_n l, sst_years l",
       "SELECT * FROM p_sst_clim")
def zone_clim(spark, sf):
    return i.sst_clim(spark, sf)


@query("a05_within_doy_percentile", "l_returnflag s, date t, qty d6, pctile d6", """
  SELECT l_returnflag, date, qty, (rank() OVER (PARTITION BY l_returnflag, dayofyear(date) ORDER BY qty) - 1) * 100.0::DOUBLE
    / count(qty) OVER (PARTITION BY l_returnflag, dayofyear(date)) AS pctile FROM p_flag_day""")
def doy_percentile(spark, sf):
    return cl.within_doy_percentile(flag_daily(spark, sf), "l_returnflag", "qty", "pctile")


@query("m11_anomaly_percentile", "zone_id s, date t, sst_f d4, sst_norm d4, sst_anom_f d4, sst_pctile d3",
       "SELECT * FROM p_sat_anom")
def anomaly(spark, sf):
    return i.satellite_anomaly(spark, sf)


@query("w01_daily_pressure_change", "zone_id s, date t, pressure_hpa d4, change_1 d4", """
  SELECT zone_id, date, pressure_hpa, pressure_hpa - lag(pressure_hpa) OVER (PARTITION BY zone_id ORDER BY date) AS change_1 FROM p_zone_daily""")
def pressure_change(spark, sf):
    return od.lag_change(i.zone_daily(spark, sf), "zone_id", "date", "pressure_hpa", 1, "change_1")


@query("w02_seven_row_and_seven_day_change", "zone_id s, date t, rows_7 d4, days_7 d4", """
  SELECT a.zone_id, a.date, a.rows_7, a.sst_f - b.sst_f AS days_7 FROM (
    SELECT zone_id, date, sst_f, sst_f - lag(sst_f, 7) OVER (PARTITION BY zone_id ORDER BY date) AS rows_7 FROM p_satellite) a
  LEFT JOIN p_satellite b ON b.zone_id = a.zone_id AND b.date = a.date - 7""")
def seven_change(spark, sf):
    d = od.lag_change(i.satellite(spark, sf), "zone_id", "date", "sst_f", 7, "rows_7")
    return od.date_change(d, "zone_id", "date", "sst_f", 7, "days_7")


@query("a08_regime_composite", "zone_id s, month i, simple_regime s, mean_anom_f d6, sd_anom_f d6, n_days l", """
  SELECT zone_id, i.month, simple_regime, avg(sst_anom_f) AS mean_anom_f, stddev_samp(sst_anom_f) AS sd_anom_f, count(*) AS n_days
  FROM p_sat_anom a JOIN p_index_labelled i ON i.year = year(a.date) AND i.month = month(a.date) WHERE sst_anom_f IS NOT NULL GROUP BY 1, 2, 3""")
def composite(spark, sf):
    return ft.regime_composite(i.satellite_anomaly(spark, sf), i.labelled_index(spark, sf), "zone_id", "sst_anom_f")


@query("a09_index_sensitivity", "zone_id s, month i, anom_f_per_oni d6, r d6, n_days l", """
  SELECT zone_id, i.month, regr_slope(sst_anom_f, oni) AS anom_f_per_oni, corr(oni, sst_anom_f) AS r, count(*) AS n_days
  FROM p_sat_anom a JOIN p_index_labelled i ON i.year = year(a.date) AND i.month = month(a.date) WHERE sst_anom_f IS NOT NULL
  GROUP BY 1, 2 HAVING count(*) > 60 AND stddev_samp(oni) > 0.15""")
def sensitivity(spark, sf):
    return ft.sensitivity(i.satellite_anomaly(spark, sf), i.labelled_index(spark, sf), "zone_id", "sst_anom_f")


@query("j03_anomaly_with_monthly_index", "zone_id s, date t, sst_anom_f d4, oni d2, simple_regime s", """
  SELECT zone_id, a.date, sst_anom_f, oni, simple_regime FROM p_sat_anom a LEFT JOIN p_index_labelled i ON i.year = year(a.date) AND i.month = month(a.date)""")
def anomaly_index(spark, sf):
    a = i.satellite_anomaly(spark, sf).withColumns({"year": F.year("date"), "month": F.month("date")})
    return a.join(i.labelled_index(spark, sf).select("year", "month", "oni", "simple_regime"), ["year", "month"], "left")


MONTHS = [1, 2, 3, 4, 5, 6]
part("p_analogs", """SELECT *, abs(window_oni - (SELECT oni FROM p_current)) AS delta FROM (
  SELECT year, avg(oni) AS window_oni, count(oni) AS n_seasons FROM p_index WHERE month IN (1, 2, 3, 4, 5, 6) GROUP BY 1)
  WHERE year < (SELECT year FROM p_current) AND sign(window_oni) = sign((SELECT oni FROM p_current)) AND abs(window_oni - (SELECT oni FROM p_current)) <= 30.0""")
part("p_analog_obs", """SELECT zone_id, CAST(year(date) AS INT) AS year, avg(sst_anom_f) AS observed_anom_f, count(*) AS n_days FROM p_sat_anom
  WHERE sst_anom_f IS NOT NULL AND dayofyear(date) BETWEEN 160 AND 200 AND year(date) IN (SELECT year FROM p_analogs) GROUP BY 1, 2""")


def analogs(spark, sf):
    idx = i.climate_index(spark, sf)
    return ft.analog_years(idx, MONTHS, cond.current_index(idx), tolerance=30.0, min_year=None)


def analog_obs(spark, sf):
    return ft.analog_zone_anomaly(i.satellite_anomaly(spark, sf), analogs(spark, sf), list(range(160, 201)), "zone_id", "sst_anom_f")


@query("a12_analog_years", "year i, window_oni d4, n_seasons l, delta d4", "SELECT * FROM p_analogs")
def analog_years(spark, sf):
    return analogs(spark, sf)


@query("a13_analog_zone_anomaly", "zone_id s, year i, observed_anom_f d6, n_days l", "SELECT * FROM p_analog_obs")
def analog_zone(spark, sf):
    return analog_obs(spark, sf)


@query("j22_analog_summary", "year i, window_oni d4, zones_with_obs l, observed_anom_f d6", """
  SELECT a.year, window_oni, o.zones_with_obs, o.observed_anom_f FROM p_analogs a
  LEFT JOIN (SELECT year, count(DISTINCT zone_id) AS zones_with_obs, avg(observed_anom_f) AS observed_anom_f FROM p_analog_obs GROUP BY 1) o USING (year)""")
def analog_summary(spark, sf):
    return ft.analog_summary(analogs(spark, sf), analog_obs(spark, sf), "zone_id")


@query("a24_station_difference", "date t, offshore_minus_nearshore d6", """
  SELECT date, max(CASE WHEN station = (SELECT r_name FROM region WHERE r_regionkey = 3) THEN wave_ft END)
    - max(CASE WHEN station = (SELECT r_name FROM region WHERE r_regionkey = 1) THEN wave_ft END) AS offshore_minus_nearshore
  FROM p_buoy_daily WHERE station IN (SELECT r_name FROM region WHERE r_regionkey IN (1, 3)) GROUP BY date""")
def difference(spark, sf):
    names = {r.r_regionkey: r.r_name for r in i.table(spark, sf, "region").where("r_regionkey in (1, 3)").collect()}
    return ft.station_difference(i.buoy_daily(spark, sf), "station", "wave_ft", names[3], names[1], "offshore_minus_nearshore")


@query("a28_trailing_index_mean", "year i, month i, oni d2, mean_12 d6", """
  SELECT year, month, oni, avg(oni) OVER (ORDER BY year, month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS mean_12 FROM p_index""")
def trailing(spark, sf):
    # a monthly index has one row per month, so one ordered partition stays small
    one = i.climate_index(spark, sf).withColumn("_all", F.lit(1))
    return od.trailing_mean(one, ["_all"], ["year", "month"], "oni", 12, "mean_12")


@query("j23_current_index_state", "season s, year i, month i, oni d2, regime s, simple_regime s, trailing_12mo_mean_oni d6", "SELECT * FROM p_current")
def current_state(spark, sf):
    return cond.current_index(i.climate_index(spark, sf))


@query("a32_two_latitude_daily_mean", "date t, cuti d6", """
  SELECT CAST(l_shipdate AS DATE) AS date, avg(l_tax) AS cuti FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size IN (10, 20) GROUP BY 1""")
def two_latitudes(spark, sf):
    li = i.table(spark, sf, "lineitem").select("l_partkey", F.to_date("l_shipdate").alias("date"), F.col("l_tax").alias("CUTI"))
    pt = i.table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_size").cast("double").alias("latitude"))
    return upwelling_daily(li.join(pt, "l_partkey"), [10.0, 20.0])


part("p_extrema", "SELECT user_id, ts, value AS v, CASE WHEN event_id % 2 = 0 THEN 'H' ELSE 'L' END AS type FROM events QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id) = 1")
part("p_steps", """SELECT *, CAST(ts AS DATE) AS date, abs((v - lag(v) OVER w) / nullif(dt_h, 0)) AS rate FROM (
  SELECT *, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts)) / 3.6e9 AS dt_h FROM p_extrema) WINDOW w AS (PARTITION BY user_id ORDER BY ts)""")
part("p_tide_agg", """SELECT user_id, date, max(v) AS hi, min(v) AS lo, count(*) AS n, max(rate) AS r, max(ts) AS last_ts,
  min(CASE WHEN type = 'H' THEN hour(ts) END) AS fh FROM p_steps GROUP BY 1, 2""")


def mid_hour_sql(ts: str, dt: str) -> str:
    m = f"make_timestamp(CAST(trunc(epoch_us({ts}) - coalesce({dt}, 0) / 2.0 * 3.6e9) AS BIGINT))"
    return f"hour({m}) + minute({m}) / 60.0::DOUBLE"


def extrema(spark, sf):
    e = i.events(spark, sf)
    return e.select("user_id", "ts", F.col("value").alias("v"), F.when(F.col("event_id") % 2 == 0, "H").otherwise("L").alias("type"))


@query("w03_exchange_steps", "user_id l, ts z, dt_h d6, rate d4", "SELECT user_id, ts, dt_h, rate FROM p_steps")
def steps(spark, sf):
    return ft.exchange_steps(extrema(spark, sf), "user_id", "ts", "v", 6 * 3600)


@query("a06_tide_features", "user_id l, date t, tide_high_ft d4, tide_low_ft d4, tide_range_ft d4, tide_exchanges l, max_exchange_rate_ft_h d4, best_water_hour d6, first_high_hour i", f"""
  SELECT a.user_id, a.date, hi AS tide_high_ft, lo AS tide_low_ft, hi - lo AS tide_range_ft, n AS tide_exchanges, r AS max_exchange_rate_ft_h,
    {mid_hour_sql('s.ts', 's.dt_h')} AS best_water_hour, fh AS first_high_hour
  FROM p_tide_agg a JOIN p_steps s ON s.user_id = a.user_id AND s.date = a.date WHERE n >= 2
  QUALIFY row_number() OVER (PARTITION BY a.user_id, a.date ORDER BY s.rate DESC NULLS LAST, CASE WHEN s.rate IS NULL THEN -epoch_us(s.ts) ELSE epoch_us(s.ts) END) = 1""")
def tides(spark, sf):
    return ft.tide_features(extrema(spark, sf), "user_id", width_seconds=6 * 3600)


part("p_near", """SELECT *, lag(v) OVER w AS pv, lag(ts) OVER w AS pts, lag(rate) OVER w AS prate, lag(dt_h) OVER w AS pdt, lag(type) OVER w AS ptype,
  lead(v) OVER w AS nv, lead(ts) OVER w AS nts, lead(rate) OVER w AS nrate, lead(dt_h) OVER w AS ndt, lead(type) OVER w AS ntype
  FROM p_steps WINDOW w AS (PARTITION BY user_id ORDER BY ts)""")
part("p_pair", """SELECT *, use_prev, CASE WHEN use_prev THEN pv ELSE nv END AS ov FROM (SELECT *, pts IS NOT NULL AND (nts IS NULL OR abs(pv - v) <= abs(nv - v)) AS use_prev FROM p_near)
  WHERE (user_id, date) IN (SELECT (user_id, date) FROM p_tide_agg WHERE n = 1) AND (pts IS NOT NULL OR nts IS NOT NULL)""")
part("p_pair2", """SELECT user_id, date, greatest(v, ov) AS hi, least(v, ov) AS lo,
  CASE WHEN use_prev THEN pts ELSE ts END AS ts1, CASE WHEN use_prev THEN prate ELSE rate END AS r1, CASE WHEN use_prev THEN pdt ELSE dt_h END AS d1, CASE WHEN use_prev THEN ptype ELSE type END AS k1,
  CASE WHEN use_prev THEN ts ELSE nts END AS ts2, CASE WHEN use_prev THEN rate ELSE nrate END AS r2, CASE WHEN use_prev THEN dt_h ELSE ndt END AS d2, CASE WHEN use_prev THEN type ELSE ntype END AS k2 FROM p_pair""")


@query("a07_tide_features_widened", "user_id l, date t, tide_high_ft d4, tide_low_ft d4, tide_range_ft d4, tide_exchanges l, tide_window_widened b, max_exchange_rate_ft_h d4, best_water_hour d6, first_high_hour i", f"""
  SELECT * FROM (SELECT a.user_id, a.date, hi AS tide_high_ft, lo AS tide_low_ft, hi - lo AS tide_range_ft, n AS tide_exchanges, false AS tide_window_widened, r AS max_exchange_rate_ft_h,
    {mid_hour_sql('s.ts', 's.dt_h')} AS best_water_hour, fh AS first_high_hour
  FROM p_tide_agg a JOIN p_steps s ON s.user_id = a.user_id AND s.date = a.date WHERE n >= 2
  QUALIFY row_number() OVER (PARTITION BY a.user_id, a.date ORDER BY s.rate DESC NULLS LAST, CASE WHEN s.rate IS NULL THEN -epoch_us(s.ts) ELSE epoch_us(s.ts) END) = 1)
  UNION ALL SELECT user_id, date, hi, lo, hi - lo, 1, true, CASE WHEN r1 IS NULL THEN r2 WHEN r2 IS NULL THEN r1 ELSE greatest(r1, r2) END,
    CASE WHEN r1 IS NOT NULL AND (r2 IS NULL OR r1 >= r2) THEN {mid_hour_sql('ts1', 'd1')} ELSE {mid_hour_sql('ts2', 'd2')} END,
    least(CASE WHEN k1 = 'H' THEN hour(ts1) END, CASE WHEN k2 = 'H' THEN hour(ts2) END) FROM p_pair2""")
def tides_widened(spark, sf):
    return ft.tide_features(extrema(spark, sf), "user_id", width_seconds=6 * 3600, widen=True)


@query("d01_local_day_keys", "event_id l, local_day t, doy i, month i, year i", """
  SELECT event_id, d AS local_day, dayofyear(d) AS doy, month(d) AS month, year(d) AS year FROM (
    SELECT event_id, CAST(timezone('America/Los_Angeles', timezone('UTC', ts)) AS DATE) AS d FROM events)""")
def local_days(spark, sf):
    e = i.events(spark, sf).select("event_id", local_date("ts").alias("local_day"))
    return e.withColumns({"doy": F.dayofyear("local_day"), "month": F.month("local_day"), "year": F.year("local_day")})


@query("d05_date_spine_gaps", "zone_id s, date t, observed b", """
  SELECT g.zone_id, g.date, s.date IS NOT NULL AS observed FROM (
    SELECT zone_id, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM p_satellite GROUP BY 1) g
  LEFT JOIN p_satellite s ON s.zone_id = g.zone_id AND s.date = g.date""")
def spine(spark, sf):
    sat = i.satellite(spark, sf)
    span = sat.groupBy("zone_id").agg(F.min("date").alias("a"), F.max("date").alias("b"))
    grid = span.select("zone_id", F.explode(date_spine("a", "b")).alias("date"))
    return grid.join(sat.select("zone_id", "date", F.lit(True).alias("_o")), ["zone_id", "date"], "left").withColumn(
        "observed", F.coalesce("_o", F.lit(False)))


@query("m20_m21_calendar", "date t, moon_illum d6, moon_phase s, moon_age_days d6, sunrise_hour d6, sunset_hour d6, daylight_hours d6", """
  SELECT c.* FROM p_calendar c WHERE date IN (SELECT CAST(o_orderdate AS DATE) FROM orders)""")
def calendar(spark, sf):
    return cond.calendar(i.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date")))
