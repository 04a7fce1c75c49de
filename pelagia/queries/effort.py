"""Trips, catch per effort, outcome labels and their validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dedup, stats
from ..plans import dashboard as db
from ..plans import labels as lab
from ..session import staged
from . import inputs as i
from .registry import query
from .sqlparts import even_sql, part

WINDOW = ("1995-03-01", "1996-06-30")
REGION_OF = {"kelp_nearshore": [0, 1], "coronados": [0, 2], "offshore_banks": [2, 3], "extended_offshore": [3, 1]}

# trips: one order is one boat trip; its lines are the catch by part type
_trip_type = ("CASE o_orderpriority WHEN '1-URGENT' THEN 'half_day' WHEN '2-HIGH' THEN 'full_day' WHEN '3-MEDIUM' THEN '1.5_day' "
              "WHEN '4-NOT SPECIFIED' THEN '2.5_day' ELSE CASE WHEN o_orderstatus = 'P' THEN '3_day' ELSE 'overnight' END END")
_trip_raw = ("CASE o_orderpriority WHEN '1-URGENT' THEN '1/2 Day AM' WHEN '2-HIGH' THEN CASE WHEN o_orderstatus = 'F' THEN 'Full Day' ELSE 'Full Day Coronado Islands' END "
             "WHEN '3-MEDIUM' THEN '1.5 Day' WHEN '4-NOT SPECIFIED' THEN '2.5 Day' ELSE CASE WHEN o_orderstatus = 'P' THEN '3 Day' ELSE 'Overnight' END END")
_trip_days = "CASE WHEN trip_type = 'half_day' THEN 0.5 WHEN trip_type = '1.5_day' THEN 1.5 WHEN trip_type = '2.5_day' THEN 2.5 WHEN trip_type = '3_day' THEN 3.0 ELSE 1.0 END"

part("p_trips", f"""SELECT *, CAST({_trip_days} AS DOUBLE) AS trip_days FROM (SELECT o_orderkey AS raw_id, CAST(o_orderdate AS DATE) AS report_date, o_custkey,
  {_trip_type} AS trip_type, {_trip_raw} AS trip_type_raw, 5 + CAST(floor(o_totalprice / 10000) AS INT) AS anglers, o_orderstatus FROM orders)""")
part("p_catch", """SELECT l_orderkey AS raw_id, p_type AS species_id, sum(CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS kept,
  sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS released FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2""")
part("p_fetch", """SELECT report_date, CAST(report_date AS TIMESTAMP) + INTERVAL 20 HOUR AS fetched_at_utc, 'daily_refresh' AS ingest_method, true AS ok FROM (SELECT DISTINCT report_date FROM p_trips)
  UNION ALL SELECT report_date, CAST(report_date AS TIMESTAMP) + INTERVAL 70 HOUR, CASE WHEN day(report_date) % 5 = 0 THEN 'backfill' ELSE 'daily_refresh' END, day(report_date) % 7 <> 0 FROM (SELECT DISTINCT report_date FROM p_trips)""")
part("p_listing", """SELECT report_date, CAST(report_date AS TIMESTAMP) + INTERVAL 20 HOUR AS fetched_at_utc, raw_id FROM p_trips WHERE o_orderstatus <> 'P'
  UNION ALL SELECT report_date, CAST(report_date AS TIMESTAMP) + INTERVAL 70 HOUR, raw_id FROM p_trips""")


def trips(spark, sf):
    o = i.table(spark, sf, "orders")
    t = o.select(F.col("o_orderkey").alias("raw_id"), F.to_date("o_orderdate").alias("report_date"), "o_custkey", F.expr(_trip_type).alias("trip_type"),
                 F.expr(_trip_raw).alias("trip_type_raw"), (5 + F.floor(F.col("o_totalprice") / 10000)).cast("int").alias("anglers"), "o_orderstatus")
    return t.withColumn("trip_days", F.expr(_trip_days).cast("double"))


def catch(spark, sf, parts=None):
    """Catch per trip and subject; rows are dealt by trip once, which also serves what is gathered for each trip after.

    ``parts`` fixes the number of tasks, for callers whose work on a row is long against its size.
    """
    li = i.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", F.col("l_quantity").cast("bigint").alias("q"))
    pt = i.table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("species_id"))
    back = F.col("l_returnflag") == "R"
    lines = li.join(pt, "l_partkey").select(F.col("l_orderkey").alias("raw_id"), "species_id", "l_returnflag", "q").repartition(*([parts] if parts else []), "raw_id")
    return lines.groupBy("raw_id", "species_id").agg(
        F.sum(F.when(~back, F.col("q")).otherwise(0)).alias("kept"), F.sum(F.when(back, F.col("q")).otherwise(0)).alias("released"))


def trips_with_maps(spark, sf):
    """Trips with their catch as maps; an order has a handful of lines, so the maps are short."""
    m = catch(spark, sf).groupBy("raw_id").agg(F.map_from_entries(F.collect_list(F.struct("species_id", "kept"))).alias("kept"),
                                               F.map_from_entries(F.collect_list(F.struct("species_id", "released"))).alias("released"))
    empty = F.create_map().cast("map<string,bigint>")
    return trips(spark, sf).join(m, "raw_id", "left").withColumns({"kept": F.coalesce("kept", empty), "released": F.coalesce("released", empty)})


def fetch_log(spark, sf):
    d = trips(spark, sf).select("report_date").distinct()
    at = lambda h: F.col("report_date").cast("timestamp") + F.expr(f"interval {h} hours")
    one = d.select("report_date", at(20).alias("fetched_at_utc"), F.lit("daily_refresh").alias("ingest_method"), F.lit(True).alias("ok"))
    dom = F.dayofmonth("report_date")
    two = d.select("report_date", at(70).alias("fetched_at_utc"), F.when(dom % 5 == 0, "backfill").otherwise("daily_refresh").alias("ingest_method"), (dom % 7 != 0).alias("ok"))
    return one.unionByName(two)


def listing(spark, sf):
    t = trips(spark, sf)
    at = lambda h: (F.col("report_date").cast("timestamp") + F.expr(f"interval {h} hours")).alias("fetched_at_utc")
    return t.where("o_orderstatus <> 'P'").select("report_date", at(20), "raw_id").unionByName(t.select("report_date", at(70), "raw_id"))


part("p_species_region", "SELECT r.region_id, s.species_id FROM (VALUES " + ", ".join(f"('{r}', {n})" for r, ns in REGION_OF.items() for n in ns) +
     ") r(region_id, k) JOIN p_subject_params s ON s.subject_no % 4 <> r.k GROUP BY 1, 2")


def species_region(spark, sf):
    links = spark.createDataFrame([(r, n) for r, ns in REGION_OF.items() for n in ns], "region_id string, k int")
    s = i.subjects(spark, sf).select("species_id", F.explode(F.filter(F.sequence(F.lit(0), F.lit(3)), lambda k: F.col("subject_no") % 4 != k)).alias("k"))
    return links.join(s, "k").select("region_id", "species_id").distinct()


@query("w04_current_trips", "raw_id l, report_date t, page_fetched_at_utc z, page_method s, anglers i", """
  SELECT t.raw_id, t.report_date, n.fetched_at_utc AS page_fetched_at_utc, n.ingest_method AS page_method, t.anglers FROM (
    SELECT report_date, fetched_at_utc, ingest_method FROM p_fetch WHERE ok QUALIFY row_number() OVER (PARTITION BY report_date ORDER BY fetched_at_utc DESC) = 1) n
  JOIN p_listing l ON l.report_date = n.report_date AND l.fetched_at_utc = n.fetched_at_utc JOIN p_trips t ON t.raw_id = l.raw_id""")
def current(spark, sf):
    return lab.current_trips(trips(spark, sf), fetch_log(spark, sf), listing(spark, sf))


@query("a10_catch_per_effort", "date t, species_id s, kept l, released l, anglers l, angler_days d4, trips l, cpue d6, cpue_per_angler_day d6", """
  SELECT report_date AS date, species_id, sum(kept) AS kept, sum(released) AS released, sum(anglers) AS anglers, sum(anglers * trip_days) AS angler_days, count(*) AS trips,
    sum(kept) / sum(anglers) AS cpue, sum(kept) / sum(anglers * trip_days) AS cpue_per_angler_day FROM p_trips JOIN p_catch USING (raw_id) WHERE kept > 0 GROUP BY 1, 2""")
def cpue(spark, sf):
    rows = trips(spark, sf).join(catch(spark, sf).where("kept > 0"), "raw_id").withColumnRenamed("report_date", "date")
    return stats.catch_per_effort(rows, ["date", "species_id"])


part("p_cpue", """SELECT report_date AS date, species_id, sum(kept) AS kept, sum(anglers) AS anglers, sum(kept) / sum(anglers) AS cpue, sum(kept) / sum(anglers * trip_days) AS cpd
  FROM p_trips JOIN p_catch USING (raw_id) WHERE kept > 0 GROUP BY 1, 2""")
part("p_valid", """SELECT c.*, s.score FROM p_cpue c JOIN (SELECT species_id, date, max(score) AS score FROM p_scores WHERE score IS NOT NULL AND NOT is_forecast GROUP BY 1, 2) s USING (species_id, date)""")


def _avg_rank(v):
    return f"(rank() OVER (PARTITION BY species_id ORDER BY {v}) + (count(*) OVER (PARTITION BY species_id, {v}) - 1) / 2.0::DOUBLE)"


@query("a11_model_validation", "species_id s, n_days l, spearman_rho d3, pearson_r d3, spearman_rho_raw_cpue d3, mean_cpue_per_angler_day d3, mean_score d1, total_fish l, total_anglers l", f"""
  SELECT species_id, count(*) AS n_days, round(corr(rs, rd), 3) AS spearman_rho, round(corr(score, cpd), 3) AS pearson_r, round(corr(rs, rr), 3) AS spearman_rho_raw_cpue,
    round(avg(cpd), 3) AS mean_cpue_per_angler_day, round(avg(score), 1) AS mean_score, sum(kept) AS total_fish, sum(anglers) AS total_anglers
  FROM (SELECT *, {_avg_rank('score')} AS rs, {_avg_rank('cpd')} AS rd, {_avg_rank('cpue')} AS rr FROM p_valid) GROUP BY 1 HAVING count(*) >= 5 AND stddev_samp(score) <> 0 AND stddev_samp(cpd) <> 0""")
def validation(spark, sf):
    rows = trips(spark, sf).join(catch(spark, sf).where("kept > 0"), "raw_id").withColumnRenamed("report_date", "date")
    return stats.model_validation(i.scores(spark, sf), stats.catch_per_effort(rows, ["date", "species_id"]))


@query("w07_average_rank", "species_id s, date t, rank_score d2", f"SELECT species_id, date, {_avg_rank('score')} AS rank_score FROM p_valid")
def avg_rank(spark, sf):
    rows = trips(spark, sf).join(catch(spark, sf).where("kept > 0"), "raw_id").withColumnRenamed("report_date", "date")
    best = i.scores(spark, sf).where("not is_forecast").groupBy("species_id", "date").agg(F.max("score").alias("score"))
    j = stats.catch_per_effort(rows, ["date", "species_id"]).join(best, ["species_id", "date"])
    return j.withColumn("rank_score", stats.average_rank("score", ["species_id"]))


part("p_current_trips", """SELECT t.*, n.fetched_at_utc, n.ingest_method FROM (
    SELECT report_date, fetched_at_utc, ingest_method FROM p_fetch WHERE ok QUALIFY row_number() OVER (PARTITION BY report_date ORDER BY fetched_at_utc DESC) = 1) n
  JOIN p_listing l ON l.report_date = n.report_date AND l.fetched_at_utc = n.fetched_at_utc JOIN p_trips t ON t.raw_id = l.raw_id""")
part("p_trip_region", """SELECT *, CASE WHEN trip_days <= 1.5 THEN 1 ELSE CAST(floor(trip_days) AS INT) END AS nd FROM (SELECT *, CASE WHEN contains(lower(trip_type_raw), 'coronado') THEN 'coronados' WHEN trip_type = '3_day' THEN NULL
    WHEN trip_type = '2.5_day' THEN 'extended_offshore' WHEN trip_type IN ('1.5_day', 'overnight') THEN 'offshore_banks' WHEN trip_type = 'half_day' THEN 'kelp_nearshore' END AS region_id,
  CASE WHEN trip_type = 'overnight' THEN 'overnight_destination_uncertain' END AS flag FROM p_current_trips) WHERE region_id IS NOT NULL""")
part("p_tsd", """SELECT t.report_date - CAST(k AS INT) AS fishing_date, t.region_id, s.species_id, t.raw_id, t.anglers / nd AS anglers, t.anglers * t.trip_days / nd AS angler_days,
  coalesce(c.kept, 0) / nd AS kept, coalesce(c.released, 0) / nd AS released, t.report_date, CAST(k AS INT) AS lag, t.fetched_at_utc, t.ingest_method, nd > 1 AS multi, t.flag
  FROM (SELECT *, unnest(range(0, nd)) AS k FROM p_trip_region) t JOIN p_species_region s USING (region_id) LEFT JOIN p_catch c ON c.raw_id = t.raw_id AND c.species_id = s.species_id""")
part("p_daily", """SELECT *, fish_kept + fish_released AS fish_total, (fish_kept + fish_released) / nullif(angler_days, 0) AS catch_index, n_trips >= 2 AND angler_days >= 30 AS effort_sufficient FROM (
  SELECT fishing_date, region_id, species_id, count(DISTINCT raw_id) AS n_trips, sum(anglers) AS anglers, sum(angler_days) AS angler_days, sum(kept) AS fish_kept, sum(released) AS fish_released,
    max(lag) AS lag, max(fetched_at_utc) AS available, count(*) AS n_raw, string_agg(DISTINCT CAST(report_date AS VARCHAR), ';' ORDER BY CAST(report_date AS VARCHAR)) AS report_dates,
    bool_or(ingest_method = 'backfill') AS backfilled, bool_or(multi) AS multi, max(flag) AS flag FROM p_tsd GROUP BY 1, 2, 3)""")
part("p_ref", f"""SELECT k.species_id, k.region_id, {even_sql("CASE WHEN n_own >= 5 AND own > 0 THEN own WHEN sp > 0 THEN sp ELSE 0.5 END", 4)} AS reference_index,
  CASE WHEN n_own >= 5 AND own > 0 THEN n_own WHEN sp > 0 THEN n_sp ELSE 0 END AS n_days,
  CASE WHEN n_own >= 5 AND own > 0 THEN 'species-region median' WHEN sp > 0 THEN 'species median (region fallback)' ELSE 'default (no reference data)' END AS basis
  FROM (SELECT DISTINCT species_id, region_id FROM p_daily) k
  LEFT JOIN (SELECT species_id, region_id, median(catch_index) AS own, count(catch_index) AS n_own FROM p_daily WHERE effort_sufficient AND fishing_date BETWEEN DATE '{WINDOW[0]}' AND DATE '{WINDOW[1]}' GROUP BY 1, 2) USING (species_id, region_id)
  LEFT JOIN (SELECT species_id, median(catch_index) AS sp, count(catch_index) AS n_sp FROM p_daily WHERE effort_sufficient AND fishing_date BETWEEN DATE '{WINDOW[0]}' AND DATE '{WINDOW[1]}' GROUP BY 1) USING (species_id)""")
part("p_settled", "SELECT DISTINCT report_date FROM p_fetch WHERE ok AND CAST(timezone('America/Los_Angeles', timezone('UTC', fetched_at_utc)) AS DATE) > report_date")
part("p_open", """SELECT DISTINCT fishing_date, region_id, species_id FROM p_tsd WHERE report_date NOT IN (SELECT report_date FROM p_settled)""")
_score = even_sql("CASE WHEN ratio <= 0 THEN 0.0 WHEN ratio <= 0.25 THEN 40 * ratio / 0.25 WHEN ratio <= 0.6 THEN 40 + 20 * (ratio - 0.25) / 0.35 WHEN ratio <= 1.2 THEN 60 + 15 * (ratio - 0.6) / 0.6 "
                  "WHEN ratio <= 2 THEN 75 + 15 * (ratio - 1.2) / 0.8 WHEN ratio <= 4 THEN 90 + 10 * (ratio - 2) / 2 ELSE 100.0 END::DOUBLE", 1)
part("p_labels_base", f"""SELECT d.*, coalesce(r.reference_index, 0.5) AS reference_index, coalesce(r.basis, 'default (no reference data)') AS basis, o.fishing_date IS NOT NULL AS is_open,
  CASE WHEN effort_sufficient AND r.basis = 'species-region median' THEN catch_index / nullif(r.reference_index, 0) END AS ratio
  FROM p_daily d LEFT JOIN p_ref r USING (species_id, region_id) LEFT JOIN p_open o ON o.fishing_date = d.fishing_date AND o.region_id = d.region_id AND o.species_id = d.species_id
  WHERE d.fishing_date <= DATE '2001-08-03'""")
part("p_labels", f"""SELECT 'L1|' || fishing_date || '|' || region_id || '|' || species_id AS label_id, *, CASE WHEN observed_score >= 90 THEN 'Excellent' WHEN observed_score >= 75 THEN 'Very Good'
    WHEN observed_score >= 60 THEN 'Good' WHEN observed_score >= 40 THEN 'Fair' WHEN observed_score IS NOT NULL THEN 'Poor' END AS observed_class, CAST(observed_score >= 60 AS INT) AS observed_good_or_better,
  CASE WHEN NOT effort_sufficient THEN 'insufficient_effort' WHEN basis <> 'species-region median' THEN 'no_reference' WHEN DATE '2001-08-03' - fishing_date >= 3 AND NOT is_open THEN 'final' ELSE 'provisional' END AS label_status,
  CAST(timezone('America/Los_Angeles', timezone('UTC', available)) AS DATE) - fishing_date AS publication_lag_days,
  nullif(concat_ws(';', flag, CASE WHEN backfilled THEN 'backfilled' END, CASE WHEN multi THEN 'multi_day_split' END, CASE WHEN contains(basis, 'fallback') THEN 'reference_species_fallback' END,
    CASE WHEN basis LIKE 'default%' THEN 'reference_default' END, CASE WHEN effort_sufficient AND angler_days < 100 THEN 'low_effort' END,
    CASE WHEN fishing_date BETWEEN DATE '{WINDOW[0]}' AND DATE '{WINDOW[1]}' THEN 'in_reference_window' END,
    CASE WHEN effort_sufficient AND basis = 'species-region median' AND fish_total = 0 THEN 'effort_adjusted_zero' END), '') AS dq_flags
  FROM (SELECT *, CASE WHEN ratio IS NOT NULL THEN {_score} END AS observed_score FROM p_labels_base)""")


def daily(spark, sf):
    def build():
        cur = lab.current_trips(trips_with_maps(spark, sf), fetch_log(spark, sf), listing(spark, sf))
        return lab.daily_catch(lab.trip_species_days(cur, species_region(spark, sf)))
    return staged(spark, sf, "daily_catch", build)


def reference(spark, sf):
    return lab.build_reference(daily(spark, sf), *WINDOW)


def labels(spark, sf):
    return staged(spark, sf, "labels", lambda: lab.build_labels(
        daily(spark, sf), reference(spark, sf), fetch_log(spark, sf), F.lit("2001-08-03").cast("date"), *WINDOW, source="orders"))


@query("a14_daily_catch", "fishing_date t, region_id s, species_id s, n_trips l, anglers d3, angler_days d3, fish_kept d3, fish_released d3, fish_total d3, catch_index d6, effort_sufficient b, lag i, available z, n_raw l, report_dates s, multi b",
       "SELECT * FROM p_daily")
def daily_catch(spark, sf):
    return daily(spark, sf)


@query("a15_label_reference", "species_id s, region_id s, reference_index d4, n_days i, basis s", "SELECT * FROM p_ref")
def ref(spark, sf):
    return reference(spark, sf)


@query("build_labels", "label_id s, fishing_date t, region_id s, species_id s, n_trips i, angler_days d1, fish_total d1, catch_index d4, reference_index d4, index_ratio d3, observed_score d1, "
       "observed_class s, observed_good_or_better i, effort_sufficient b, label_status s, reporting_lag_days i, available_at_utc z, publication_lag_days i, n_raw_records i, dq_flags s", f"""
  SELECT label_id, fishing_date, region_id, species_id, n_trips, {even_sql('angler_days', 1)} AS angler_days, {even_sql('fish_total', 1)} AS fish_total, {even_sql('catch_index', 4)} AS catch_index, reference_index,
    {even_sql('ratio', 3)} AS index_ratio, observed_score, observed_class, observed_good_or_better, effort_sufficient, label_status, lag AS reporting_lag_days, available AS available_at_utc,
    publication_lag_days, n_raw AS n_raw_records, dq_flags FROM p_labels""")
def build_labels(spark, sf):
    return labels(spark, sf)


@query("a23_label_coverage", "region_id s, species_id s, final l, provisional l, insufficient_effort l, no_reference l", """
  SELECT region_id, species_id, count(*) FILTER (label_status = 'final') AS final, count(*) FILTER (label_status = 'provisional') AS provisional,
    count(*) FILTER (label_status = 'insufficient_effort') AS insufficient_effort, count(*) FILTER (label_status = 'no_reference') AS no_reference FROM p_labels GROUP BY 1, 2""")
def coverage(spark, sf):
    return lab.label_coverage(labels(spark, sf))


@query("a29_label_summary", "rows l, labelled l, final l, provisional l, insufficient_effort l, no_reference l, effort_adjusted_zero l, first_fishing_date t, last_fishing_date t, "
       "median_publication_lag_days d2, median_publication_lag_days_live d2, median_reporting_lag_days d2", """
  SELECT count(*) AS rows, count(observed_class) AS labelled, count(*) FILTER (label_status = 'final') AS final, count(*) FILTER (label_status = 'provisional') AS provisional,
    count(*) FILTER (label_status = 'insufficient_effort') AS insufficient_effort, count(*) FILTER (label_status = 'no_reference') AS no_reference,
    count(*) FILTER (contains(dq_flags, 'effort_adjusted_zero')) AS effort_adjusted_zero, min(fishing_date) FILTER (observed_class IS NOT NULL) AS first_fishing_date,
    max(fishing_date) FILTER (observed_class IS NOT NULL) AS last_fishing_date, median(publication_lag_days) FILTER (observed_class IS NOT NULL) AS median_publication_lag_days,
    median(publication_lag_days) FILTER (observed_class IS NOT NULL AND NOT coalesce(contains(dq_flags, 'backfilled'), false)) AS median_publication_lag_days_live,
    median(lag) FILTER (observed_class IS NOT NULL) AS median_reporting_lag_days FROM p_labels""")
def summary(spark, sf):
    return lab.label_summary(labels(spark, sf))


@query("o04_top_species", "species_id s, total l", "SELECT species_id, sum(kept) AS total FROM p_catch GROUP BY 1 ORDER BY total DESC, species_id LIMIT 6")
def top_species(spark, sf):
    return db.top_species(catch(spark, sf))


@query("a34_trip_type_summary", "report_date t, trip_type s, n l", "SELECT report_date, trip_type, count(*) AS n FROM p_trips GROUP BY 1, 2")
def by_type(spark, sf):
    return db.count_by(trips(spark, sf), "report_date", "trip_type")


@query("a35_ingest_counters", "pages l, pages_ok l, n_failed l", "SELECT count(*) AS pages, count(*) FILTER (ok) AS pages_ok, count(*) FILTER (NOT ok) AS n_failed FROM p_fetch")
def counters(spark, sf):
    from ..sources.sinks import ingest_counters
    return ingest_counters(fetch_log(spark, sf), 0, 0).withColumn("n_failed", F.size("failed_dates"))


@query("a36_positive_agreement", "n_positive l, n_species l, best_rho d3", f"""
  SELECT count(*) FILTER (r > 0) AS n_positive, count(*) AS n_species, max(r) AS best_rho FROM (
    SELECT species_id, round(corr(rs, rd), 3) AS r FROM (SELECT *, {_avg_rank('score')} AS rs, {_avg_rank('cpd')} AS rd FROM p_valid) GROUP BY 1 HAVING count(*) >= 5)""")
def agreement(spark, sf):
    return db.positive_agreement(validation(spark, sf))


@query("d04_fishing_days", "raw_id l, fishing_date t, share d6", """
  SELECT raw_id, report_date - CAST(k AS INT) AS fishing_date, 1.0 / nd AS share FROM (
    SELECT *, unnest(range(0, nd)) AS k FROM (SELECT *, CASE WHEN trip_days <= 1.5 THEN 1 ELSE CAST(floor(trip_days) AS INT) END AS nd FROM p_trips))""")
def fishing_days(spark, sf):
    from ..functions.dates import fishing_days as days
    t = trips(spark, sf).withColumn("_d", days("report_date", "trip_days"))
    return t.select("raw_id", F.explode("_d").alias("fishing_date"), (1.0 / F.size("_d")).alias("share"))


@query("j16_replace_by_date", "report_date t, raw_id l, load s", """
  SELECT report_date, raw_id, 'old' AS load FROM p_trips WHERE report_date NOT IN (SELECT report_date FROM p_trips WHERE trip_type = '3_day')
  UNION ALL SELECT report_date, raw_id, 'new' FROM p_trips WHERE trip_type = '3_day'""")
def replace_by_date(spark, sf):
    t = trips(spark, sf).select("report_date", "raw_id", "trip_type")
    new = t.where("trip_type = '3_day'").select("report_date", "raw_id", F.lit("new").alias("load"))
    return dedup.replace_by_date(t.select("report_date", "raw_id", F.lit("old").alias("load")), new, "report_date")
