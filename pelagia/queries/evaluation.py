"""Forecast ledger rows matched to labels: verification, calibration, bootstrap, gate and changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.classes import TERMS, horizon_group, lead_bucket, p_good, tier_for_lead
from ..functions.dates import day_end_utc
from ..functions.numeric import round_to
from ..operators import stats
from ..plans import changes as ch
from ..plans import dashboard as db
from ..plans import verify as ver
from ..session import staged
from . import effort as ef
from . import inputs as i
from .registry import query
from .sqlparts import clamp_sql, even_sql, mean_log_sql, part, soft_sql

AS_OF = "2001-07-31"
LEADS = [0, 2, 5, 7, 9, 14, 21]
MODELS = ["v1", "baseline_climatology", "baseline_enso", "v1.1-cal"]
# weights of the stored terms, and a challenger that lifts two of them
OVERRIDE = {"*": {"sst": 0.5, "tide": 0.3}, "LARGE": {"swell": 0.6}}

_lead = "CASE l_linenumber " + " ".join(f"WHEN {k + 1} THEN {v}" for k, v in enumerate(LEADS)) + " END"

# Ledger rows: line items by nation (zone), part type (subject), ship day (target) and line number (lead).
_CELL = """date_sub(target_date, lead_days) AS issue_date, zone_id, species_id, target_date, lead_days, n, q, disc, tax"""
_ROW = """zone_id, region_no, species_id, target_date, lead_days, issue_date, 1.973D * (q / n) AS bite_score, 9.931D * (disc / n) AS baseline_clim_score, 11.937D * (tax / n) AS baseline_enso_score,
  concat_ws(';', CASE WHEN lead_days = 0 AND tax % 2 = 1 THEN 'lead0_issued_after_local_noon' END, CASE WHEN lead_days >= 15 THEN 'no_daily_sea_state' END) AS flags_text,
  CASE WHEN month(issue_date) % 2 = 0 THEN 'El Nino' ELSE 'Neutral' END AS enso_regime, q / n / 50.0D AS term_sst, disc / n / 10.0D AS term_season, tax / n / 8.0D AS term_tide,
  CASE WHEN tax % 3 <> 0 THEN 0.7D END AS term_moon, 0.85D AS term_pressure, CASE WHEN disc % 2 = 1 THEN disc / n / 10.0D END AS term_swell, CAST(NULL AS DOUBLE) AS term_front, 0.4D AS term_chl,
  0.8D + 0.01D * (q / n) AS anomaly_term, 50.0D + 5.0D * (tax / n) AS fishability"""


def _duck(text: str) -> str:
    import re
    return re.sub(r"(\d+\.\d+)D\b", r"\1::DOUBLE", text)


part("p_cells", f"""SELECT n_name AS zone_id, n_regionkey AS region_no, p_type AS species_id, CAST(l_shipdate AS DATE) AS target_date, CAST({_lead} AS INT) AS lead_days, count(*) AS n,
  sum(CAST(l_quantity AS BIGINT)) AS q, sum(CAST(round(l_discount * 100) AS BIGINT)) AS disc, sum(CAST(round(l_tax * 100) AS BIGINT)) AS tax
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY 1, 2, 3, 4, 5""")
part("p_ledger", f"""SELECT *, 'I' || issue_date AS issuance_id, CAST(issue_date AS TIMESTAMP) + INTERVAL 15 HOUR AS issue_utc, nullif(flags_text, '') AS dq_flags,
  CASE WHEN lead_days <= 3 THEN '0-3' WHEN lead_days <= 7 THEN '4-7' WHEN lead_days <= 14 THEN '8-14' ELSE '15-30' END AS lead_bucket, CASE WHEN lead_days <= 7 THEN 'short_0_7' ELSE 'outlook_8_30' END AS horizon_group
  FROM (SELECT {_duck(_ROW)} FROM (SELECT *, target_date - lead_days AS issue_date FROM p_cells))""")
part("p_zone_region", """SELECT n_name AS zone_id, r.region_id, r.labelled FROM nation JOIN (VALUES (0, 'kelp_nearshore', true), (1, 'coronados', true), (2, 'offshore_banks', true),
  (2, 'extended_offshore', true), (3, 'extended_offshore', true), (4, 'bays', false)) r(k, region_id, labelled) ON r.k = n_regionkey""")


def zone_region(spark, sf):
    links = spark.createDataFrame([(0, "kelp_nearshore", True), (1, "coronados", True), (2, "offshore_banks", True), (2, "extended_offshore", True),
                                   (3, "extended_offshore", True), (4, "bays", False)], "region_no int, region_id string, labelled boolean")
    return i.zones(spark, sf).select("zone_id", "region_no").join(links, "region_no").select("zone_id", "region_id", "labelled")


def _ledger(spark, sf):
    li = i.table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", F.to_date("l_shipdate").alias("target_date"), F.expr(_lead).cast("int").alias("lead_days"),
                                               F.col("l_quantity").cast("bigint").alias("q"), i.hundredths("l_discount").alias("disc"), i.hundredths("l_tax").alias("tax"))
    pt = i.table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("species_id"))
    sup = i.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    nat = i.table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("zone_id"), F.col("n_regionkey").alias("region_no"))
    cells = li.join(pt, "l_partkey").join(sup, "l_suppkey").join(nat, "s_nationkey").groupBy("zone_id", "region_no", "species_id", "target_date", "lead_days").agg(
        F.count(F.lit(1)).alias("n"), F.sum("q").alias("q"), F.sum("disc").alias("disc"), F.sum("tax").alias("tax"))
    rows = cells.withColumn("issue_date", F.date_sub("target_date", F.col("lead_days"))).selectExpr(*_split_columns(_ROW))
    tier = tier_for_lead("lead_days")
    return rows.withColumns({
        "issuance_id": F.concat(F.lit("I"), F.col("issue_date").cast("string")), "issue_utc": F.col("issue_date").cast("timestamp") + F.expr("interval 15 hours"),
        "dq_flags": F.nullif("flags_text", F.lit("")), "lead_bucket": lead_bucket("lead_days"), "horizon_tier": tier["tier"]})


def _split_columns(text: str) -> list[str]:
    """Top-level comma split of a select list."""
    out, depth, cur = [], 0, ""
    for c in text:
        depth += (c == "(") - (c == ")")
        if c == "," and depth == 0:
            out.append(cur.strip())
            cur = ""
        else:
            cur += c
    return [*out, cur.strip()]


def ledger(spark, sf):
    return staged(spark, sf, "ledger", lambda: _ledger(spark, sf))


def pairs(spark, sf):
    def build():
        p = ver.build_pairs(ledger(spark, sf), ef.labels(spark, sf), zone_region(spark, sf))
        return ver.walk_forward_calibration(p, "score__v1.1-cal")
    return staged(spark, sf, "pairs", build)


part("p_region_fc", """SELECT issuance_id, target_date, z.region_id, species_id, avg(bite_score) AS bite_score, avg(baseline_clim_score) AS baseline_clim_score, avg(baseline_enso_score) AS baseline_enso_score,
  any_value(lead_days) AS lead_days, any_value(lead_bucket) AS lead_bucket, any_value(horizon_group) AS horizon_group, any_value(issue_utc) AS issue_utc, any_value(enso_regime) AS enso_regime,
  count(DISTINCT l.zone_id) AS n_zones, coalesce(max(dq_flags), '') AS dq_flags FROM p_ledger l JOIN p_zone_region z USING (zone_id) WHERE labelled AND NOT coalesce(contains(dq_flags, 'lead0_issued'), false) GROUP BY 1, 2, 3, 4""")
part("p_pairs", """SELECT f.*, observed_score, observed_class, observed_good_or_better AS y_good, label_status, available AS available_at_utc,
  CASE observed_class WHEN 'Poor' THEN 0 WHEN 'Fair' THEN 1 WHEN 'Good' THEN 2 WHEN 'Very Good' THEN 3 ELSE 4 END AS obs_idx, strftime(target_date, '%m') AS month,
  CASE WHEN month(target_date) IN (12, 1, 2) THEN 'DJF' WHEN month(target_date) <= 5 THEN 'MAM' WHEN month(target_date) <= 8 THEN 'JJA' ELSE 'SON' END AS season, 'all' AS overall
  FROM p_region_fc f JOIN p_labels l ON l.fishing_date = f.target_date AND l.region_id = f.region_id AND l.species_id = f.species_id WHERE observed_class IS NOT NULL
  AND issue_utc < timezone('UTC', timezone('America/Los_Angeles', CAST(target_date + 1 AS TIMESTAMP)))""")


@query("a16_region_forecasts", "issuance_id s, target_date t, region_id s, species_id s, bite_score d4, baseline_clim_score d4, baseline_enso_score d4, lead_days i, enso_regime s, n_zones l, dq_flags s", "SELECT * FROM p_region_fc")
def region_fc(spark, sf):
    from ..functions.text import has_flag
    led = ledger(spark, sf).where(~has_flag("dq_flags", "lead0_issued_after_local_noon"))
    return ver.region_forecasts(led, zone_region(spark, sf))


@query("j12_forecast_label_pairs", "issuance_id s, target_date t, region_id s, species_id s, lead_days i, bite_score d4, observed_score d1, obs_idx i, y_good i, horizon_group s, season s, label_status s", "SELECT * FROM p_pairs")
def build_pairs(spark, sf):
    return ver.build_pairs(ledger(spark, sf), ef.labels(spark, sf), zone_region(spark, sf))


part("p_events", """SELECT horizon_group, greatest(issue_utc, available_at_utc) AS t, count(*) AS n, sum(bite_score - 50) AS sx, sum(observed_score - 50) AS sy,
  sum((bite_score - 50) * (observed_score - 50)) AS sxy, sum((bite_score - 50) * (bite_score - 50)) AS sxx FROM p_pairs GROUP BY 1, 2""")
part("p_fit", """SELECT a.horizon_group, a.issue_utc, sum(n) AS n, sum(sx) AS sx, sum(sy) AS sy, (sum(sxy) - sum(sx) * sum(sy) / sum(n)) / nullif(sum(sxx) - sum(sx) * sum(sx) / sum(n), 0) AS b
  FROM (SELECT DISTINCT horizon_group, issue_utc FROM p_pairs) a JOIN p_events e ON e.horizon_group = a.horizon_group AND e.t < a.issue_utc GROUP BY 1, 2""")
part("p_cal", """SELECT p.*, CASE WHEN f.n >= 60 AND f.b IS NOT NULL THEN greatest(0.0, least(99.9, 50 + f.sy / f.n + f.b * (p.bite_score - 50 - f.sx / f.n))) ELSE p.bite_score END AS cal_score
  FROM p_pairs p LEFT JOIN p_fit f ON f.horizon_group = p.horizon_group AND f.issue_utc = p.issue_utc""")


@query("j14_walk_forward_calibration", "issuance_id s, target_date t, region_id s, species_id s, bite_score d4, cal_score d4", "SELECT * FROM p_cal")
def walk_forward(spark, sf):
    p = ver.build_pairs(ledger(spark, sf), ef.labels(spark, sf), zone_region(spark, sf))
    return ver.walk_forward_calibration(p, "cal_score")


_k = "CASE lead_bucket WHEN '0-3' THEN 8.0 WHEN '4-7' THEN 10.0 WHEN '8-14' THEN 14.0 ELSE 20.0 END"


def _pg(s: str) -> str:
    return f"round(1.0 / (1.0 + exp(-({s} - 60.0) / ({_k}))), 4)"


part("p_long", f"""SELECT *, (score >= 40)::INT + (score >= 60)::INT + (score >= 75)::INT + (score >= 90)::INT AS fidx, {_pg('score')} AS pr FROM (
  SELECT p.* EXCLUDE (bite_score, baseline_clim_score, baseline_enso_score, cal_score), m.model_id, CASE m.model_id WHEN 'v1' THEN bite_score WHEN 'baseline_climatology' THEN baseline_clim_score
    WHEN 'baseline_enso' THEN baseline_enso_score ELSE cal_score END AS score FROM p_cal p, (VALUES ('v1'), ('baseline_climatology'), ('baseline_enso'), ('v1.1-cal')) m(model_id)) WHERE score IS NOT NULL""")
_good, _tp = "count(*) FILTER (fidx >= 2)", "count(*) FILTER (fidx >= 2 AND y_good = 1)"
METRICS = f"""count(*) AS n_pairs, count(DISTINCT target_date) AS n_target_dates, count(DISTINCT issuance_id) AS n_issuances, {even_sql('avg((fidx = obs_idx)::INT)', 4)} AS exact_hit,
  {even_sql('avg((abs(fidx - obs_idx) <= 1)::INT)', 4)} AS within_one, {even_sql('avg(abs(score - observed_score))', 2)} AS mae, {even_sql('avg((pr - y_good) * (pr - y_good))', 4)} AS brier, sum(y_good) AS n_obs_good,
  {_good} AS n_fcst_good, {even_sql('avg(y_good)', 4)} AS obs_good_rate, CASE WHEN {_good} >= 10 THEN {even_sql(f'{_tp} / {_good}', 4)} END AS precision_good,
  CASE WHEN sum(y_good) >= 10 THEN {even_sql(f'{_tp} / sum(y_good)', 4)} END AS recall_good, {even_sql('avg(score)', 1)} AS mean_forecast_score, {even_sql('avg(observed_score)', 1)} AS mean_observed_score"""
METRIC_SPEC = ("n_pairs l, n_target_dates l, n_issuances l, exact_hit d3, within_one d3, mae d1, brier d3, n_obs_good l, n_fcst_good l, obs_good_rate d3, precision_good d3, recall_good d3, "
               "mean_forecast_score d0, mean_observed_score d0")
part("p_windowed", f"""SELECT l.*, w.window_name FROM p_long l JOIN (VALUES ('rolling_30d', DATE '{AS_OF}' - 29), ('rolling_90d', DATE '{AS_OF}' - 89), ('season_to_date', DATE '2001-03-01'), ('all', DATE '1900-01-01')) w(window_name, start)
  ON l.target_date >= w.start""")
_dims = ver.DIMENSIONS
part("p_eval", f"""SELECT window_name, CASE {' '.join(f"WHEN grouping({d}) = 0 THEN '{d}'" for d in _dims)} END AS dimension, coalesce({', '.join(f'CASE WHEN grouping({d}) = 0 THEN {d} END' for d in _dims)}) AS stratum, model_id, {METRICS}
  FROM p_windowed GROUP BY GROUPING SETS ({', '.join(f'(window_name, model_id, {d})' for d in _dims)})""")
part("p_eval_skill", f"""SELECT e.*, {even_sql('1 - e.brier / nullif(r.brier, 0)', 4)} AS brier_skill, {even_sql('1 - e.mae / nullif(r.mae, 0)', 4)} AS mae_skill,
  CASE WHEN e.n_pairs < 30 OR e.n_target_dates < 10 OR e.n_issuances < 3 THEN 'insufficient' WHEN e.n_pairs < 100 OR e.n_target_dates < 30 OR e.n_issuances < 10 THEN 'preliminary' ELSE 'reportable' END AS sample_flag
  FROM p_eval e LEFT JOIN p_eval r ON r.window_name = e.window_name AND r.dimension = e.dimension AND r.stratum = e.stratum AND r.model_id = 'baseline_climatology'""")


def evaluation(spark, sf):
    return staged(spark, sf, "evaluation", lambda: ver.evaluate(pairs(spark, sf), MODELS, F.lit(AS_OF).cast("date")))


@query("a19_evaluation_report", "window_name s, dimension s, stratum s, model_id s, sample_flag s, " + METRIC_SPEC + ", brier_skill d4, mae_skill d4", "SELECT * FROM p_eval_skill")
def evaluate(spark, sf):
    e = ver.evaluate(pairs(spark, sf), MODELS, F.lit(AS_OF).cast("date"))
    return e.withColumnsRenamed({"window": "window_name", "brier_skill_vs_clim": "brier_skill", "mae_skill_vs_clim": "mae_skill"})


@query("a17_verification_metrics", "model_id s, horizon_group s, " + METRIC_SPEC, f"SELECT model_id, horizon_group, {METRICS} FROM p_long GROUP BY 1, 2")
def metrics(spark, sf):
    return stats.metrics(stats.long_by_model(pairs(spark, sf), MODELS), ["model_id", "horizon_group"])


@query("a20_reliability", "horizon_group s, bin s, n l, mean_p d3, obs_rate d3", f"""
  SELECT horizon_group, (b * 20) || '-' || (b * 20 + 20) || '%' AS bin, count(*) AS n, avg(pr) AS mean_p, avg(y_good) AS obs_rate FROM (SELECT *, CAST(least(floor(pr * 5), 4) AS INT) AS b FROM p_long WHERE model_id = 'v1') GROUP BY 1, b""")
def reliability(spark, sf):
    return stats.reliability(pairs(spark, sf), "score__v1")


part("p_boot_day", f"""SELECT horizon_group, target_date, sum(a * a) AS ms, sum(r * r) AS rs, count(*) AS n, row_number() OVER (PARTITION BY horizon_group ORDER BY target_date) - 1 AS i, count(*) OVER (PARTITION BY horizon_group) AS d
  FROM (SELECT horizon_group, target_date, {_pg('bite_score')} - y_good AS a, {_pg('baseline_clim_score')} - y_good AS r FROM p_pairs) GROUP BY 1, 2""")
part("p_boot_draw", """SELECT horizon_group, rep, CAST('0x' || substr(md5('7|' || rep || '|' || k), 1, 8) AS BIGINT) % d AS i FROM (
  SELECT horizon_group, d, rep, unnest(range(0, d)) AS k FROM (SELECT horizon_group, d, unnest(range(0, 400)) AS rep FROM p_boot_day WHERE i = 0 AND d >= 5))""")
part("p_boot", """SELECT horizon_group, rep, 1 - round(sum(ms) / sum(n), 4) / nullif(round(sum(rs) / sum(n), 4), 0) AS v FROM p_boot_draw JOIN p_boot_day USING (horizon_group, i) GROUP BY 1, 2""")


@query("a21_block_bootstrap", "horizon_group s, p05 d4, p50 d4, p95 d4, p_positive d3, reps i", f"""
  SELECT horizon_group, quantile_cont(v, 0.05) AS p05, quantile_cont(v, 0.5) AS p50, quantile_cont(v, 0.95) AS p95, {even_sql('avg((v > 0)::INT)', 3)} AS p_positive, 400 AS reps FROM p_boot WHERE v IS NOT NULL GROUP BY 1""")
def bootstrap(spark, sf):
    return stats.block_bootstrap(pairs(spark, sf), "v1", "baseline_climatology", ["horizon_group"])


def gate(spark, sf):
    return ver.assess_challenger(pairs(spark, sf), "v1.1-cal", priority_species=["ECONOMY", "SMALL", "LARGE"], priority_regions=["kelp_nearshore", "offshore_banks"])


part("p_gate_rows", "SELECT *, 'all' AS dimension, 'all' AS stratum FROM p_long UNION ALL SELECT *, 'species_id', species_id FROM p_long UNION ALL SELECT *, 'region_id', region_id FROM p_long UNION ALL SELECT *, 'lead_bucket', lead_bucket FROM p_long")
part("p_gate_m", f"SELECT dimension, stratum, model_id, {METRICS} FROM p_gate_rows WHERE model_id IN ('v1', 'v1.1-cal') GROUP BY 1, 2, 3")


@query("a22_challenger_gate", "check_name s, passed b", """
  WITH j AS (SELECT c.dimension, c.stratum, c.n_pairs, c.n_target_dates, c.n_issuances, c.brier AS cb, v.brier AS vb, c.mae AS cm, v.mae AS vm, c.exact_hit AS ch, v.exact_hit AS vh FROM p_gate_m c
    JOIN p_gate_m v USING (dimension, stratum) WHERE c.model_id = 'v1.1-cal' AND v.model_id = 'v1')
  SELECT 'minimum sample' AS check_name, n_pairs >= 300 AND n_target_dates >= 45 AND n_issuances >= 30 AS passed FROM j WHERE dimension = 'all'
  UNION ALL SELECT 'aggregate Brier improvement', 1 - cb / vb >= 0.02 FROM j WHERE dimension = 'all' UNION ALL SELECT 'aggregate MAE not worse', cm <= vm + 0.5 FROM j WHERE dimension = 'all'
  UNION ALL SELECT 'priority ' || stratum || ' not degraded', cb / vb - 1 <= 0.05 FROM j WHERE n_pairs >= 30 AND ((dimension = 'species_id' AND stratum IN ('ECONOMY', 'SMALL', 'LARGE')) OR (dimension = 'region_id' AND stratum IN ('kelp_nearshore', 'offshore_banks')))
  UNION ALL SELECT 'short-range lead ' || stratum || ' not degraded', cb / vb - 1 <= 0.02 AND ch >= vh - 0.02 FROM j WHERE n_pairs >= 30 AND dimension = 'lead_bucket' AND stratum IN ('0-3', '4-7')""")
def challenger_gate(spark, sf):
    return gate(spark, sf).where("check_name <> 'bootstrap confidence'")


part("p_gate_day", """SELECT target_date, sum((pr - y_good) ** 2) FILTER (model_id = 'v1.1-cal') AS ms, count(*) FILTER (model_id = 'v1.1-cal') AS mn, sum((pr - y_good) ** 2) FILTER (model_id = 'v1') AS rs,
  count(*) FILTER (model_id = 'v1') AS rn, row_number() OVER (ORDER BY target_date) - 1 AS i, count(*) OVER () AS d FROM p_long WHERE model_id IN ('v1', 'v1.1-cal') GROUP BY 1""")
part("p_gate_boot", f"""SELECT {even_sql('avg((v > 0)::INT)', 3)} AS p_positive FROM (SELECT rep, 1 - round(sum(ms) / sum(mn), 4) / nullif(round(sum(rs) / sum(rn), 4), 0) AS v FROM (
  SELECT rep, CAST('0x' || substr(md5('7|' || rep || '|' || k), 1, 8) AS BIGINT) % d AS i FROM (SELECT d, rep, unnest(range(0, d)) AS k FROM (SELECT d, unnest(range(0, 400)) AS rep FROM p_gate_day WHERE i = 0 AND d >= 5)))
  JOIN p_gate_day USING (i) GROUP BY 1) WHERE v IS NOT NULL""")


@query("a22_challenger_gate_all", "check_name s, passed b", """
  WITH j AS (SELECT c.dimension, c.stratum, c.n_pairs, c.n_target_dates, c.n_issuances, c.brier AS cb, v.brier AS vb, c.mae AS cm, v.mae AS vm, c.exact_hit AS ch, v.exact_hit AS vh FROM p_gate_m c
    JOIN p_gate_m v USING (dimension, stratum) WHERE c.model_id = 'v1.1-cal' AND v.model_id = 'v1')
  SELECT 'minimum sample' AS check_name, n_pairs >= 300 AND n_target_dates >= 45 AND n_issuances >= 30 AS passed FROM j WHERE dimension = 'all'
  UNION ALL SELECT 'aggregate Brier improvement', 1 - cb / vb >= 0.02 FROM j WHERE dimension = 'all' UNION ALL SELECT 'aggregate MAE not worse', cm <= vm + 0.5 FROM j WHERE dimension = 'all'
  UNION ALL SELECT 'priority ' || stratum || ' not degraded', cb / vb - 1 <= 0.05 FROM j WHERE n_pairs >= 30 AND ((dimension = 'species_id' AND stratum IN ('ECONOMY', 'SMALL', 'LARGE')) OR (dimension = 'region_id' AND stratum IN ('kelp_nearshore', 'offshore_banks')))
  UNION ALL SELECT 'short-range lead ' || stratum || ' not degraded', cb / vb - 1 <= 0.02 AND ch >= vh - 0.02 FROM j WHERE n_pairs >= 30 AND dimension = 'lead_bucket' AND stratum IN ('0-3', '4-7')
  UNION ALL SELECT 'bootstrap confidence', coalesce(n_pairs >= 300 AND n_target_dates >= 45 AND n_issuances >= 30 AND (SELECT p_positive FROM p_gate_boot) >= MIN_POSITIVE, false) FROM j WHERE dimension = 'all'""".replace("MIN_POSITIVE", str(ver.CRITERIA["min_bootstrap_p_positive"])))
def challenger_gate_all(spark, sf):
    """All checks of the gate, the bootstrap too."""
    return gate(spark, sf)


@query("dash_failed_checks", "model_id s, recommendation s, failed s, n_passed l")
def failed(spark, sf):
    return db.failed_checks(gate(spark, sf))


@query("w08_timeline", "target_date t, region_id s, species_id s, lead_days i, observed_score d1, bite_score d1, baseline_clim_score d1", f"""
  SELECT target_date, region_id, species_id, lead_days, observed_score, bite_score, baseline_clim_score FROM (SELECT target_date, region_id, species_id, lead_days, observed_score, {even_sql('bite_score', 1)} AS bite_score, {even_sql('baseline_clim_score', 1)} AS baseline_clim_score
    FROM p_pairs WHERE target_date > DATE '{AS_OF}' - 60 QUALIFY row_number() OVER (PARTITION BY target_date, region_id, species_id ORDER BY lead_days, issuance_id) = 1)""")
def timeline(spark, sf):
    return ver.timeline(pairs(spark, sf), F.lit(AS_OF).cast("date"))


@query("m17_p_good_and_leads", "issuance_id s, zone_id s, species_id s, target_date t, lead_days i, lead_bucket s, horizon_group s, tier i, p_good d4", f"""
  SELECT issuance_id, zone_id, species_id, target_date, lead_days, lead_bucket, horizon_group, CASE WHEN lead_days <= 6 THEN 1 WHEN lead_days <= 14 THEN 2 ELSE 3 END AS tier, {_pg('bite_score')} AS p_good FROM p_ledger""")
def p_good_rows(spark, sf):
    return ledger(spark, sf).withColumns({"horizon_group": horizon_group("lead_days"), "tier": tier_for_lead("lead_days")["tier"], "p_good": p_good("bite_score", "lead_days")})


def _w(k: str) -> str:
    large = OVERRIDE["LARGE"].get(k)
    rest = OVERRIDE["*"].get(k)
    a = f"{large}::DOUBLE" if large is not None else f"w.w_{k}"
    b = f"{rest}::DOUBLE" if rest is not None else f"w.w_{k}"
    return f"CASE WHEN species_id = 'LARGE' THEN {a} ELSE {b} END AS w_{k}"


_num, _den = mean_log_sql({k: f"term_{k}" for k in TERMS})
_core = clamp_sql(f"exp({_num} / {_den}) * anomaly_term", 0.01, 1.35)


@query("a17_weight_challenger", "issuance_id s, zone_id s, species_id s, target_date t, score d1", f"""
  SELECT issuance_id, zone_id, species_id, target_date, round(100 * {soft_sql('g')}, 1) AS score FROM (SELECT *, {clamp_sql('core * (0.35 + 0.65 * fishability / 100.0)', 0.01, 1.35)} AS g FROM (
    SELECT *, {_core} AS core FROM (SELECT l.*, {', '.join(_w(k) for k in TERMS)} FROM p_ledger l JOIN p_subject_params w USING (species_id))))""")
def weight_challenger(spark, sf):
    led = ver.with_weight_challenger(ledger(spark, sf), i.subjects(spark, sf).select("species_id", "weights"), "w", OVERRIDE)
    return led.withColumn("score", F.col("score__w"))


@query("f07_as_of_filter", "event_id l, before_end b", """
  SELECT event_id, ts < timezone('UTC', timezone('America/Los_Angeles', CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP))) - INTERVAL 12 HOUR AS before_end FROM events""")
def as_of(spark, sf):
    e = i.events(spark, sf)
    return e.select("event_id", (F.col("ts") < day_end_utc(F.to_date("ts")) - F.expr("interval 12 hours")).alias("before_end"))


part("p_now", "SELECT * FROM p_ledger WHERE lead_days = 2")
part("p_was", "SELECT * FROM p_ledger WHERE lead_days = 7")


def _parts_sql(side: str) -> dict[str, str]:
    den = " + ".join(f"CASE WHEN {side}.term_{k} IS NOT NULL AND w_{k} > 0 THEN w_{k} ELSE 0 END" for k in TERMS)
    out = {k: f"CASE WHEN {side}.term_{k} IS NOT NULL AND w_{k} > 0 THEN w_{k} / ({den}) * ln(greatest({side}.term_{k}, 0.02)) END" for k in TERMS}
    out["anomaly"] = f"ln({side}.anomaly_term)"
    out["access"] = f"ln(0.35 + 0.65 * {side}.fishability / 100.0)"
    return out


_a, _b = _parts_sql("n"), _parts_sql("o")
_delta_sql = f"""SELECT n.target_date, n.zone_id, n.species_id, n.issuance_id AS current_issuance, o.issuance_id AS prior_issuance, n.bite_score - o.bite_score AS d,
  {', '.join(f'coalesce({_a[k]}, 0) - coalesce({_b[k]}, 0) AS d_{k}' for k in _a)}, n.term_swell IS NOT NULL AND o.term_swell IS NULL AND w_swell > 0 AS swell_added, o.bite_score AS was_score, n.bite_score AS now_score
  FROM p_now n JOIN p_was o USING (target_date, zone_id, species_id) JOIN p_subject_params w ON w.species_id = n.species_id"""
part("p_delta", _delta_sql)
_tot = "(" + " + ".join(f"d_{k}" for k in _a) + ")"


part("p_ranked", "SELECT *, row_number() OVER (PARTITION BY target_date, zone_id, species_id ORDER BY issue_utc DESC, issuance_id DESC) AS newest FROM p_ledger")
part("p_newest", "SELECT * FROM p_ranked WHERE newest = 1")
part("p_before", "SELECT * FROM p_ranked WHERE newest = 2")
part("p_newest_delta", _delta_sql.replace("p_now n", "p_newest n").replace("p_was o", "p_before o"))


def changed_rows(spark, sf):
    return ledger(spark, sf).withColumns({
        "wave_ft": F.col("term_swell") * 10, "wind_kt": F.lit(None).cast("double"), "sst_f": F.col("term_sst") * 50, "sst_anom_f": F.lit(None).cast("double"),
        "tide_range_ft": F.lit(None).cast("double"), "sst_source": F.lit("model"), "model_version": F.lit("v1"), "bite_class": F.lit(None).cast("string")})


def changes(spark, sf):
    led = changed_rows(spark, sf)
    w = i.subjects(spark, sf).select("species_id", "weights")
    return ch.forecast_changes(led.where("lead_days = 2"), led.where("lead_days = 7"), w)


@query("j15_forecast_changes", "target_date t, zone_id s, species_id s, current_issuance s, prior_issuance s, delta d1, pts_sst d1, pts_tide d1, pts_access d1, swell_added b", f"""
  SELECT *, {even_sql('d', 1)} AS delta, {', '.join(f'CASE WHEN abs({_tot}) > 1e-9 AND abs(d * d_{k} / {_tot}) >= 0.1 THEN {even_sql(f"d * d_{k} / {_tot}", 1)} END AS pts_{k}' for k in ('sst', 'tide', 'access'))} FROM p_delta""")
def forecast_changes(spark, sf):
    return _with_points(changes(spark, sf))


def _with_points(c):
    return c.withColumns({f"pts_{k}": F.try_element_at("driver_points", F.lit(k)) for k in ("sst", "tide", "access")}).withColumn(
        "swell_added", F.coalesce(F.col("notes").rlike("driver now available:[^;]*swell"), F.lit(False)))


@query("f10_material_changes", "target_date t, zone_id s, species_id s, delta d1, top_drivers s, input_changes s, notes s")
def material(spark, sf):
    return ch.material_changes(changes(spark, sf))


def newest_changes(spark, sf):
    return ch.forecast_changes(*ch.newest_two(changed_rows(spark, sf)), i.subjects(spark, sf).select("species_id", "weights"))


@query("j15_newest_changes", "target_date t, zone_id s, species_id s, current_issuance s, prior_issuance s, delta d1, pts_sst d1, pts_tide d1, pts_access d1, swell_added b", f"""
  SELECT *, {even_sql('d', 1)} AS delta, {', '.join(f'CASE WHEN abs({_tot}) > 1e-9 AND abs(d * d_{k} / {_tot}) >= 0.1 THEN {even_sql(f"d * d_{k} / {_tot}", 1)} END AS pts_{k}' for k in ('sst', 'tide', 'access'))} FROM p_newest_delta""")
def newest_forecast_changes(spark, sf):
    """Every target's newest issuance against the one before it, whatever their leads."""
    return _with_points(newest_changes(spark, sf))


@query("f10_newest_material_changes", "target_date t, zone_id s, species_id s, delta d1, top_drivers s, input_changes s, notes s")
def newest_material(spark, sf):
    return ch.material_changes(newest_changes(spark, sf))


@query("dash_champion_vs_baseline", "window_name s, dimension s, stratum s, left_value d3, right_value d3", """
  SELECT window_name, dimension, stratum, max(brier) FILTER (model_id = 'v1') AS left_value, max(brier) FILTER (model_id = 'baseline_climatology') AS right_value FROM p_eval GROUP BY 1, 2, 3""")
def strata(spark, sf):
    return db.side_by_side(evaluation(spark, sf), "v1", "baseline_climatology").withColumnRenamed("window", "window_name")


@query("dash_model_by_lead", "model_id s, lead_bucket s, n_pairs l, exact_hit d3, mae d1, brier d3", """
  SELECT model_id, stratum AS lead_bucket, n_pairs, exact_hit, mae, brier FROM p_eval WHERE window_name = 'all' AND dimension = 'lead_bucket'""")
def by_lead(spark, sf):
    return db.model_by_lead(evaluation(spark, sf))


@query("j20_registry_performance", "model_id s, status s, horizon_group s, n_pairs l, mae d1, brier d3", """
  SELECT m.model_id, m.status, e.stratum AS horizon_group, e.n_pairs, e.mae, e.brier FROM (VALUES ('v1', 'production'), ('baseline_climatology', 'reference'), ('v1.1-cal', 'shadow'), ('v9', 'candidate')) m(model_id, status)
  LEFT JOIN (SELECT * FROM p_eval WHERE window_name = 'all' AND dimension = 'horizon_group') e USING (model_id)""")
def registry(spark, sf):
    models = spark.createDataFrame([("v1", "production"), ("baseline_climatology", "reference"), ("v1.1-cal", "shadow"), ("v9", "candidate")], "model_id string, status string")
    return ver.registry_performance(models, evaluation(spark, sf))
