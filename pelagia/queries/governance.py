"""Quality gates, ledger storage, sinks and streaming forms on the driver tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import features as ft
from ..plans import conditions as cond
from ..plans import dashboard as db
from ..plans import ledger as led
from ..plans import quality as ql
from ..session import fresh_path, staged
from ..sources import sinks
from ..streaming import jobs
from . import effort as ef
from . import evaluation as ev
from . import inputs as i
from . import outlook as ou
from .outlook import outlook
from .registry import query
from .sqlparts import clamp_sql, even_sql, part, soft_sql


@query("q01_table_checks", "table_name s, n_rows l, duplicate_keys l, null_keys l, ok b", """
  SELECT 'lineitem' AS table_name, sum(n) AS n_rows, count(*) FILTER (n > 1) AS duplicate_keys, 0 AS null_keys, sum(n) >= 1000 AND count(*) FILTER (n > 1) = 0 AS ok FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)
  UNION ALL SELECT 'orders', sum(n), count(*) FILTER (n > 1), 0, sum(n) >= 1000 AND count(*) FILTER (n > 1) = 0 FROM (SELECT o_orderkey, count(*) AS n FROM orders GROUP BY 1)""")
def table_checks(spark, sf):
    return ql.table_check(i.table(spark, sf, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"], 1000).unionByName(
        ql.table_check(i.table(spark, sf, "orders"), "orders", ["o_orderkey"], 1000))


@query("q02_history_check", "table_name s, n_old l, n_new l, min_old t, max_old t, min_new t, max_new t, shrunk b, starts_later b, ends_earlier b", """
  SELECT 'orders' AS table_name, a.n AS n_old, b.n AS n_new, a.lo AS min_old, a.hi AS max_old, b.lo AS min_new, b.hi AS max_new, b.n < a.n * 0.995 AS shrunk, b.lo > a.lo AS starts_later, b.hi < a.hi AS ends_earlier
  FROM (SELECT count(*) AS n, min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders) a, (SELECT count(*) AS n, min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders WHERE o_orderstatus <> 'P') b""")
def history(spark, sf):
    o = i.table(spark, sf, "orders").withColumn("date", F.to_date("o_orderdate"))
    return ql.history_check(o, o.where("o_orderstatus <> 'P'"), "orders", "date", 0.995)


@query("q03_range_check", "column_name s, n_out l", """
  SELECT 'score' AS column_name, count(*) FILTER (score < -0.01 OR score > 100.01) AS n_out FROM p_scores UNION ALL SELECT 'wind_kt', count(*) FILTER (wind_kt < -0.01 OR wind_kt > 100.01) FROM p_scores WHERE score IS NOT NULL
  UNION ALL SELECT 'vs_norm', count(*) FILTER (vs_norm < -0.01 OR vs_norm > 100.01) FROM p_scores WHERE score IS NOT NULL""")
def ranges(spark, sf):
    return ql.range_check(i.scores(spark, sf), ["score", "wind_kt", "vs_norm"])


@query("q04_coverage", "rule s, ok b", f"""
  WITH c AS (SELECT count(DISTINCT zone_id) AS z, min(date) AS a, max(date) AS b, (SELECT max(date) FROM p_outlook) AS e FROM p_conditions)
  SELECT 'zone_count' AS rule, z = (SELECT count(*) FROM nation) AS ok FROM c UNION ALL SELECT 'near_term_end', b >= DATE '{i.AS_OF_DAY}' + 6 FROM c
  UNION ALL SELECT 'hindcast_start', a <= DATE '{i.AS_OF_DAY}' - 13 FROM c UNION ALL SELECT 'outlook_end', e >= DATE '{i.AS_OF_DAY}' + 30 FROM c""")
def coverage(spark, sf):
    return ql.coverage_check(i.conditions(spark, sf), outlook(spark, sf), F.lit(i.AS_OF_DAY).cast("date"), 25)


@query("q05_lead_rules", "rule s, n_bad l", """
  WITH o AS (SELECT lead_days + CASE WHEN n_nationkey % 2 = 0 THEN -2 ELSE 3 END AS l, tier, wave_p, wind_p, published FROM p_outlook JOIN nation ON n_name = zone_id)
  SELECT 'overlaps_near_term' AS rule, count(*) FILTER (l < 7) AS n_bad FROM o UNION ALL SELECT 'tier_2_expected', count(*) FILTER (l BETWEEN 7 AND 14 AND tier <> 2) FROM o
  UNION ALL SELECT 'tier_3_expected', count(*) FILTER (l >= 15 AND tier <> 3) FROM o UNION ALL SELECT 'far_wave_published', count(*) FILTER (l >= 15 AND wave_p IS NOT NULL) FROM o
  UNION ALL SELECT 'far_wind_published', count(*) FILTER (l >= 15 AND wind_p IS NOT NULL) FROM o UNION ALL SELECT 'far_sea_state_flag', count(*) FILTER (l >= 15 AND published) FROM o""")
def lead_rules(spark, sf):
    # leads are moved, so that each rule is broken somewhere
    zones = i.zones(spark, sf).select("zone_id", F.when(F.col("zone_no") % 2 == 0, -2).otherwise(3).alias("moved"))
    return ql.lead_rules(outlook(spark, sf).join(zones, "zone_id").withColumn("lead_days", F.col("lead_days") + F.col("moved")))


@query("q07_labels_without_evidence", "label_status s, n l", """
  SELECT label_status, count(*) AS n FROM p_labels WHERE label_status IN ('insufficient_effort', 'no_reference') AND (observed_class IS NOT NULL OR day(fishing_date) % 2 = 1) GROUP BY 1""")
def evidence(spark, sf):
    # the label step gives no such class, so every odd day gets one
    given = F.coalesce("observed_class", F.when(F.dayofmonth("fishing_date") % 2 == 1, "Fair"))
    return db.count_by(ql.labels_without_evidence(ef.labels(spark, sf).withColumn("observed_class", given)), "label_status")


@query("q06_failed_critical_sources", "source_identifier s, freshness s, used_cached_data b", """
  SELECT 'u' || user_id AS source_identifier, 'failed' AS freshness, false AS used_cached_data FROM events GROUP BY user_id
  HAVING arg_max(event_type, (ts, event_id)) = 'error' AND user_id % 3 = 0 AND NOT coalesce(bool_or(event_type <> 'error' AND value > 300), false)""")
def failed_critical(spark, sf):
    """Critical sources whose last attempt failed and that have no usable earlier copy."""
    last = F.max_by("event_type", F.struct("ts", "event_id"))
    usable = F.coalesce(F.bool_or((F.col("event_type") != "error") & (F.col("value") > 300)), F.lit(False))
    status = i.events(spark, sf).groupBy("user_id").agg(F.when(last == "error", "failed").otherwise("fresh").alias("freshness"), usable.alias("used_cached_data"))
    status = status.select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("source_identifier"), "freshness", "used_cached_data", (F.col("user_id") % 3 == 0).alias("deployment_critical"))
    return ql.failed_critical_sources(status)


@query("q11_registry_violations", "violation s, subject s", """
  SELECT 'decision_changed' AS violation, CAST(c_custkey AS VARCHAR) AS subject FROM customer WHERE c_custkey % 50 = 0 OR c_custkey % 77 = 0
  UNION ALL SELECT 'model_removed', n_name FROM nation WHERE n_nationkey % 7 = 3
  UNION ALL SELECT 'production_without_approval', n_name FROM nation WHERE n_nationkey IN (2, 4)
  UNION ALL SELECT 'production_model_not_unique', (SELECT n_name FROM nation WHERE n_nationkey = 1) UNION ALL SELECT 'production_differs_from_engine', (SELECT n_name FROM nation WHERE n_nationkey = 1)
  UNION ALL SELECT 'auto_retrain_enabled', (SELECT n_name FROM nation WHERE n_nationkey = 1)""")
def registry(spark, sf):
    """A registry with every fault: three production models of which two are not approved, removed models, dropped and rewritten decisions."""
    k = F.col("n_nationkey")
    old = i.table(spark, sf, "nation").select(F.col("n_name").alias("model_id"), F.when(k.isin(1, 2, 4), "production").otherwise("shadow").alias("status"), F.when(k != 4, k == 1).alias("approved"), k.alias("k"))
    decisions = i.table(spark, sf, "customer").select(F.col("c_custkey").alias("seq"), "c_name", F.col("c_mktsegment").alias("decision"))
    now = decisions.where("seq % 77 <> 0").withColumn("decision", F.when(F.col("seq") % 50 == 0, F.lit("rewritten")).otherwise(F.col("decision")))
    production = old.where("k = 1").first()["model_id"]
    return ql.registry_violations(old.where("k % 7 <> 3").drop("k"), now, production, "another", True, old.drop("k"), decisions)


@query("q09_lookahead", "issuance_id s, src_ts z", """
  SELECT issuance_id, max(src) AS src_ts FROM (SELECT issuance_id, issue_utc, issue_utc + to_minutes(CAST(lead_days AS BIGINT)) AS src FROM p_ledger) WHERE src > issue_utc + INTERVAL 5 MINUTE GROUP BY 1""")
def lookahead(spark, sf):
    rows = ev.ledger(spark, sf).withColumn("src_fetched", F.date_format(F.col("issue_utc") + F.expr("make_dt_interval(0, 0, lead_days)"), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return led.lookahead(rows, ["src_fetched"])


@query("q08_forbidden_far_values", "issuance_id s, n l", "SELECT issuance_id, count(*) AS n FROM p_ledger WHERE lead_days >= 15 AND term_swell IS NOT NULL GROUP BY 1")
def far_values(spark, sf):
    return led.forbidden_far_values(ev.ledger(spark, sf).withColumn("wave_ft", F.col("term_swell")), ["wave_ft"])


@query("q12_copies_agree", "table_name s, n_left l, n_right l, same_content b", """
  WITH shifted AS (SELECT * REPLACE (CASE WHEN o_orderkey = 1 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice) FROM orders), again AS (SELECT * FROM supplier ORDER BY s_name DESC)
  SELECT 'supplier' AS table_name, (SELECT count(*) FROM supplier) AS n_left, (SELECT count(*) FROM again) AS n_right, NOT EXISTS (SELECT * FROM supplier EXCEPT ALL SELECT * FROM again) AS same_content
  UNION ALL SELECT 'orders', (SELECT count(*) FROM orders), (SELECT count(*) FROM shifted), NOT EXISTS (SELECT * FROM orders EXCEPT ALL SELECT * FROM shifted)""")
def copies(spark, sf):
    s, o = i.table(spark, sf, "supplier"), i.table(spark, sf, "orders")
    shifted = o.withColumn("o_totalprice", F.when(F.col("o_orderkey") == 1, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return ql.copies_agree(s, s.repartition(7), "supplier").unionByName(ql.copies_agree(o, shifted, "orders"))


@query("q13_status_upsert", "source_identifier s, last_attempted_fetch_utc z, last_successful_fetch_utc z, newest_valid_source_timestamp z, freshness s", """
  SELECT 'u' || coalesce(p.user_id, a.user_id) AS source_identifier, coalesce(a.att, p.att) AS last_attempted_fetch_utc, coalesce(CASE WHEN a.ok THEN a.att END, p.suc) AS last_successful_fetch_utc,
    coalesce(a.newest, p.newest) AS newest_valid_source_timestamp, CASE WHEN a.user_id IS NULL THEN 'fresh' WHEN a.ok THEN 'fresh' ELSE 'failed' END AS freshness
  FROM (SELECT user_id, max(ts) AS att, max(ts) AS suc, max(ts) FILTER (event_type <> 'error') AS newest FROM events WHERE ts < TIMESTAMP '2024-01-28' GROUP BY 1) p
  FULL JOIN (SELECT user_id, max(ts) AS att, bool_and(event_type <> 'error') AS ok, max(ts) FILTER (event_type <> 'error') AS newest FROM events WHERE ts >= TIMESTAMP '2024-01-28' GROUP BY 1) a ON a.user_id = p.user_id""")
def status_upsert(spark, sf):
    e = i.events(spark, sf).withColumn("source_identifier", F.concat(F.lit("u"), F.col("user_id").cast("string")))
    good = F.col("event_type") != "error"
    prev = e.where(F.col("ts") < F.lit("2024-01-28").cast("timestamp")).groupBy("source_identifier").agg(
        F.max("ts").alias("last_attempted_fetch_utc"), F.max("ts").alias("last_successful_fetch_utc"), F.max(F.when(good, F.col("ts"))).alias("newest_valid_source_timestamp"),
        F.lit("fresh").alias("freshness"), F.lit(False).alias("used_cached_data"), F.lit(None).cast("string").alias("error"))
    att = e.where(F.col("ts") >= F.lit("2024-01-28").cast("timestamp")).groupBy("source_identifier").agg(
        F.max("ts").alias("attempted_utc"), F.bool_and(good).alias("success"), F.max(F.when(good, F.col("ts"))).alias("newest"))
    att = att.withColumns({"freshness": F.when(F.col("success"), "fresh").otherwise("failed"), "cached": ~F.col("success"), "error": F.lit(None).cast("string")})
    return ql.upsert_status(prev, att)


@query("q14_payload_sanity", "event_type s, newest_valid z, n_future l, covered_from t, covered_to t, n_valid l, usable b", """
  SELECT event_type, max(ts) FILTER (value < 200 AND ts <= TIMESTAMP '2024-01-25 02:00:00') AS newest_valid, count(*) FILTER (ts > TIMESTAMP '2024-01-25 02:00:00') AS n_future, CAST(min(ts) FILTER (value < 200) AS DATE) AS covered_from,
    CAST(max(ts) FILTER (value < 200) AS DATE) AS covered_to, count(*) FILTER (value < 200) AS n_valid, bool_or(value < 200) AS usable FROM events GROUP BY 1""")
def sanity(spark, sf):
    return ql.payload_sanity(i.events(spark, sf), "event_type", "ts", F.when(F.col("value") < 200, F.col("value")), F.lit("2024-01-25 00:00:00").cast("timestamp"))


@query("a27_freshness_counts", "freshness s, n l", """
  SELECT CASE WHEN h <= 3 THEN 'fresh' WHEN h <= 12 THEN 'delayed' ELSE 'stale' END AS freshness, count(*) AS n FROM (SELECT user_id, (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts))) / 3.6e9 AS h FROM events GROUP BY 1) GROUP BY 1""")
def freshness_counts(spark, sf):
    from ..functions.dates import freshness
    last = i.events(spark, sf).groupBy("user_id").agg(F.max("ts").alias("ts"))
    hours = (F.unix_micros(F.lit("2024-01-31").cast("timestamp")) - F.unix_micros("ts")) / 3.6e9
    return db.count_by(last.withColumn("freshness", freshness(hours, 3, 12)), "freshness")


@query("d07_refresh_due", "user_id l, due_daily b, due_weekly b, due_monthly b", """
  SELECT user_id, DATE '2024-01-30' - CAST(max(ts) AS DATE) >= 1 AS due_daily, DATE '2024-01-30' - CAST(max(ts) AS DATE) >= 7 AS due_weekly, DATE '2024-01-30' - CAST(max(ts) AS DATE) >= 28 AS due_monthly FROM events GROUP BY 1""")
def refresh_due(spark, sf):
    from ..functions.dates import refresh_due as due
    last = i.events(spark, sf).groupBy("user_id").agg(F.to_date(F.max("ts")).alias("d"))
    return last.select("user_id", *[due("d", F.lit(k), F.lit("2024-01-30").cast("date")).alias(f"due_{k}") for k in ("daily", "weekly", "monthly")])


@query("k06_data_dictionary", "table_name s, field s, definition s", """
  SELECT table_name, column_name AS field, CASE WHEN column_name = 'o_orderkey' THEN 'Order key' ELSE 'No definition recorded.' END AS definition FROM (DESCRIBE orders), (SELECT 'orders' AS table_name)
  UNION ALL SELECT 'nation', column_name, 'No definition recorded.' FROM (DESCRIBE nation)""")
def dictionary(spark, sf):
    d = spark.createDataFrame([("o_orderkey", "Order key")], "field string, definition string")
    return ql.data_dictionary({"orders": i.table(spark, sf, "orders"), "nation": i.table(spark, sf, "nation")}, d)


@query("k07_year_span", "table_name s, n_rows l, span s", """
  SELECT 'orders' AS table_name, count(*) AS n_rows, min(year(o_orderdate)) || '–' || max(year(o_orderdate)) AS span FROM orders UNION ALL SELECT 'lineitem', count(*), min(year(l_shipdate)) || '–' || max(year(l_shipdate)) FROM lineitem""")
def spans(spark, sf):
    return ql.year_span(i.table(spark, sf, "orders"), "orders", "o_orderdate").unionByName(ql.year_span(i.table(spark, sf, "lineitem"), "lineitem", "l_shipdate"))


@query("k02_append_versions", "raw_id l, report_date t, n l", "SELECT raw_id, report_date, 1 AS n FROM p_trips")
def append_versions(spark, sf):
    path = fresh_path(spark, "trip_store")
    t = ef.trips(spark, sf).select("raw_id", "report_date", "anglers")
    sinks.append_versions(spark, t.where("anglers >= 20"), path, "raw_id", "report_date")
    sinks.append_versions(spark, t, path, "raw_id", "report_date")  # overlapping load adds only the unseen rows
    return spark.read.parquet(path).groupBy("raw_id", "report_date").agg(F.count(F.lit(1)).alias("n"))


part("p_versions", """SELECT report_date, raw_id, 0 AS version FROM p_trips UNION ALL SELECT report_date, raw_id, 1 FROM p_trips WHERE raw_id % 5 = 0""")


def _pages(trips, hours: int, changed: bool = False):
    """Fetch envelopes: one page per report date with its trips; ``changed`` gives every fifth trip another count."""
    more = F.when(F.lit(changed) & (F.col("raw_id") % 5 == 0), 1).otherwise(0)
    trip = F.struct(F.lit("Seaforth").alias("landing"), F.concat(F.lit("Boat "), "raw_id").alias("boat"), F.col("trip_type_raw"), (F.col("anglers") + more).alias("anglers"),
                    F.lit("{}").alias("kept_json"), F.lit(None).cast("string").alias("released_json"))
    return trips.groupBy("report_date").agg(F.collect_list(trip).alias("trips")).withColumns({
        "fetched_at_utc": F.col("report_date").cast("timestamp") + F.expr(f"interval {hours} hours"), "ingest_method": F.lit("daily_refresh"), "ok": F.dayofmonth("report_date") % 7 != 0,
        "error": F.lit(None).cast("string")})


@query("k02_append_loads", "report_date t, n_versions l, n_fetches l, n_ok l, n_listed l", """
  SELECT report_date, n_versions, CASE WHEN day(report_date) <= 20 THEN 3 ELSE 2 END AS n_fetches, CASE WHEN day(report_date) % 7 = 0 THEN 0 WHEN day(report_date) <= 20 THEN 3 ELSE 2 END AS n_ok,
    n_trips * CASE WHEN day(report_date) <= 20 THEN 3 ELSE 2 END AS n_listed
  FROM (SELECT report_date, count(*) AS n_versions, count(*) FILTER (version = 0) AS n_trips FROM p_versions GROUP BY 1)""")
def append_loads(spark, sf):
    """Loads that overlap, are repeated, and list changed trips: every version once, every fetch once."""
    path = fresh_path(spark, "trip_loads")
    t = ef.trips(spark, sf).select("raw_id", "report_date", "anglers", "trip_type_raw")
    early, whole, later = _pages(t.where(F.dayofmonth("report_date") <= 20), 20), _pages(t, 44), _pages(t, 70, changed=True)
    for load in (early, early, whole.unionByName(early), later, whole):
        sinks.append_load(spark, load, path)
    versions = sinks.read_trips(spark, path).groupBy("report_date").agg(F.count(F.lit(1)).alias("n_versions"))
    log = spark.read.parquet(f"{path}/fetches").groupBy("report_date").agg(F.count(F.lit(1)).alias("n_fetches"), F.count_if("ok").alias("n_ok"), F.sum("n_trips").alias("n_listed"))
    return versions.join(log, "report_date")


@query("k05_ordered_write", "n_rows l, n_files_out_of_order l, n_rows_out_of_order l", "SELECT count(*) AS n_rows, 0 AS n_files_out_of_order, 0 AS n_rows_out_of_order FROM p_ledger")
def ordered_write(spark, sf):
    """The ledger written in its contractual order over many files, and read back in the order of the files' names."""
    path, order = fresh_path(spark, "ordered"), ["issuance_id", "target_date", "zone_id", "species_id"]
    rows = ev.ledger(spark, sf)
    sinks.write_ordered(rows, [*order, "lead_days", "bite_score"], path, order, files=16)
    back = sinks.read_in_order(spark, path).withColumn("k", F.struct(*order))
    before = F.lag("k").over(Window.partitionBy("file_no").orderBy("row_no"))
    checked = back.withColumn("late", before > F.col("k"))
    files = checked.groupBy("file_no").agg(F.min("k").alias("a"), F.max("k").alias("b"), F.count(F.lit(1)).alias("n"), F.count_if("late").alias("late"))
    late = files.withColumn("w", F.lag("b").over(Window.orderBy("file_no")) > F.col("a"))  # one row per file
    return late.agg(F.sum("n").alias("n_rows"), F.count_if("w").alias("n_files_out_of_order"), F.sum("late").alias("n_rows_out_of_order"))


@query("k03_ledger_append_verify", "issuance_id s, seq l, n_rows l, lead_min i, lead_max i", """
  SELECT issuance_id, row_number() OVER (ORDER BY count(*) DESC, issuance_id) - 1 AS seq, count(*) AS n_rows, min(lead_days) AS lead_min, max(lead_days) AS lead_max
  FROM p_ledger GROUP BY 1 ORDER BY count(*) DESC, issuance_id LIMIT 2""")
def ledger_append(spark, sf):
    """Record the two largest issuances, once each although each is offered twice."""
    path = fresh_path(spark, "ledger_store")
    rows = ev.ledger(spark, sf).withColumns({"issue_local_date": F.col("issue_date"), "origin": F.lit("live_daily_refresh"), "source_ref": F.col("issuance_id"), "model_version": F.lit("v1"), "record_id": F.concat_ws("|", "issuance_id", "target_date", "zone_id", "species_id")})
    for top in rows.groupBy("issuance_id").count().orderBy(F.desc("count"), "issuance_id").limit(2).collect():
        one = rows.where(F.col("issuance_id") == top["issuance_id"])
        led.append_issuance(spark, path, one)
        led.append_issuance(spark, path, one)
    return spark.read.parquet(f"{path}/index")


@query("k03_ledger_append_all", "issuance_id s, seq l, n_rows l, lead_min i, lead_max i", """
  SELECT issuance_id, row_number() OVER (ORDER BY min(issue_utc), issuance_id) - 1 AS seq, count(*) AS n_rows, min(lead_days) AS lead_min, max(lead_days) AS lead_max
  FROM p_ledger GROUP BY issuance_id""")
def ledger_append_all(spark, sf):
    """Record every issuance of the ledger, once each although all are offered twice."""
    path = fresh_path(spark, "ledger_store")
    rows = ev.ledger(spark, sf).withColumns({"issue_local_date": F.col("issue_date"), "origin": F.lit("live_daily_refresh"), "source_ref": F.col("issuance_id"), "model_version": F.lit("v1"), "record_id": F.concat_ws("|", "issuance_id", "target_date", "zone_id", "species_id")})
    led.append_issuances(spark, path, rows)
    led.append_issuances(spark, path, rows)
    return spark.read.parquet(f"{path}/index")


# a source status in six families, from the events of each user
part("p_status", """SELECT CASE user_id % 6 WHEN 0 THEN 'mur_sst' WHEN 1 THEN 'ndbc:' || user_id WHEN 2 THEN 'coops:' || user_id || ':water_temperature' WHEN 3 THEN 'coops:' || user_id || ':predictions'
    WHEN 4 THEN 'openmeteo:' || user_id ELSE 'cpc_oni' END AS source_identifier, max(ts) FILTER (value < 200) AS newest, max(ts) AS fetched,
  CASE count(*) % 4 WHEN 0 THEN 'failed' WHEN 1 THEN 'stale' ELSE 'fresh' END AS freshness FROM events GROUP BY 1""")
_TODAY = i.AS_OF_DAY
_iso = "strftime({}, '%Y-%m-%dT%H:%M:%SZ')"
part("p_source_fields", f"""SELECT max({_iso.format('newest')}) FILTER (source_identifier = 'mur_sst') AS mur, max(freshness) FILTER (source_identifier = 'mur_sst') AS mur_freshness,
  max(date_trunc('second', newest)) FILTER (starts_with(source_identifier, 'ndbc:')) AS ndbc, max({_iso.format('newest')}) FILTER (starts_with(source_identifier, 'coops:') AND ends_with(source_identifier, 'water_temperature')) AS wtemp,
  min({_iso.format('fetched')}) FILTER (starts_with(source_identifier, 'openmeteo:')) AS meteo, min({_iso.format('newest')}) FILTER (starts_with(source_identifier, 'openmeteo:')) AS meteo_to,
  max({_iso.format('fetched')}) FILTER (source_identifier = 'cpc_oni') AS oni_checked, min({_iso.format('fetched')}) FILTER (starts_with(source_identifier, 'coops:') AND ends_with(source_identifier, 'predictions')) AS tides,
  string_agg(source_identifier, ',' ORDER BY source_identifier) FILTER (freshness = 'failed') AS failed, count(*) FILTER (freshness = 'failed') AS n_failed FROM p_status""")
part("p_issue_ext", f"""SELECT o.zone_id, o.species_id, o.date, o.lead_days, o.doy, o.month, o.anomaly_pref, e.mid AS score, greatest(1.0, e.mid - e.rl) AS lo, least(99.9, e.mid + e.rh) AS hi, CAST(NULL AS DOUBLE) AS core_score, NULL AS term_pressure, {even_sql('t_tide', 3)} AS term_tide,
  CASE WHEN o.published THEN {even_sql('100 * acc', 1)} END AS fishability, CASE WHEN o.published THEN 'model-blended conditions + exact tide/moon' ELSE 'climatology + ENSO analog + exact tide/moon' END AS basis, 'projected (persistence + ENSO analog + CPC)' AS sst_source,
  {even_sql('o.sst', 2)} AS sst_f, CASE WHEN o.lead_days < 15 THEN {even_sql('o.wave_p', 2)} END AS wave_ft, CASE WHEN o.lead_days < 15 THEN {even_sql('o.wind_p', 2)} END AS wind_kt, CASE WHEN o.lead_days < 15 THEN o.pressure_trend_model_24h END AS pressure, CAST(NULL AS DOUBLE) AS front,
  concat_ws(',', CASE WHEN o.sst IS NULL AND w_sst > 0 THEN 'sst' END, CASE WHEN t_season IS NULL AND w_season > 0 THEN 'season' END, CASE WHEN t_tide IS NULL AND w_tide > 0 THEN 'tide' END, CASE WHEN t_moon IS NULL AND w_moon > 0 THEN 'moon' END,
    CASE WHEN w_pressure > 0 THEN 'pressure' END, CASE WHEN t_swell IS NULL AND w_swell > 0 THEN 'swell' END, CASE WHEN w_front > 0 THEN 'front' END, CASE WHEN w_chl > 0 THEN 'chl' END) AS missing,
  o.wave_p IS NOT NULL AND o.lead_days < 15 AS has_wave FROM p_os2 o JOIN p_os5 e ON e.zone_id = o.zone_id AND e.species_id = o.species_id AND e.date = o.date""")
part("p_issue_near", f"""SELECT s.zone_id, s.species_id, s.date, CAST(s.date - DATE '{_TODAY}' AS INT) AS lead_days, s.doy, s.month, s.anomaly_pref, s.score, NULL AS lo, NULL AS hi, s.core_score, s.term_pressure, s.term_tide, s.fishability,
  CASE WHEN s.date > DATE '{_TODAY}' THEN 'observed + deterministic forecast' ELSE 'observed/nowcast' END AS basis, c.sst_source, c.sst_f, c.wave_ft, c.wind_kt, c.pressure_trend_24h AS pressure, c.front_f_per_nm AS front, s.missing_drivers AS missing,
  c.wave_ft IS NOT NULL AS has_wave FROM p_scores s JOIN p_conditions c ON c.zone_id = s.zone_id AND c.date = s.date WHERE s.score IS NOT NULL AND s.date BETWEEN DATE '{_TODAY}' AND DATE '{_TODAY}' + 6""")
_inverse = "(CASE WHEN clim / 100.0 <= 0.9 THEN clim / 100.0 ELSE 0.9 - 0.1 * ln(1.0 - least((clim / 100.0 - 0.9) / 0.1, 0.999999)) END)"
_turned = clamp_sql(_inverse + " * " + clamp_sql("1.0 + anomaly_pref * (an / 2.5) * 0.45", 0.35, 1.35), 0.01, 1.35)


@query("b06_build_issuance", "record_id s, issuance_id s, issue_local s, target_date t, lead_days i, lead_bucket s, horizon_tier i, confidence_key s, region_id s, bite_score d1, bite_class s, p_good_or_better d4, score_lo d1, score_hi d1, baseline_clim_score d1, "
       "baseline_enso_score d1, baseline_enso_anom_f d3, enso_regime s, oni d2, core_score d1, fishability d1, term_tide d3, term_pressure d3, missing_drivers s, basis s, sst_f d2, sst_source s, wave_ft d2, wind_kt d2, pressure_trend_24h d3, "
       "front_f_per_nm d4, has_wave b, src_mur_newest s, src_mur_freshness s, src_ndbc_newest_utc z, src_coops_wtemp_newest s, src_openmeteo_fetched_utc s, src_openmeteo_valid_to s, src_cpc_814_issued s, src_oni_checked s, src_tides_fetched_utc s, "
       "src_failed s, dq_flags s", f"""
  SELECT concat_ws('|', '{_TODAY}T1330PT_v1', date, zone_id, species_id) AS record_id, '{_TODAY}T1330PT_v1' AS issuance_id, '{_TODAY}T13:30:00' AS issue_local, date AS target_date, lead_days,
    CASE WHEN lead_days <= 3 THEN '0-3' WHEN lead_days <= 7 THEN '4-7' WHEN lead_days <= 14 THEN '8-14' ELSE '15-30' END AS lead_bucket, CASE WHEN lead_days <= 6 THEN 1 WHEN lead_days <= 14 THEN 2 ELSE 3 END AS horizon_tier,
    CASE WHEN lead_days <= 6 THEN 'high' WHEN lead_days <= 14 THEN 'moderate' ELSE 'outlook' END AS confidence_key, region_id, score AS bite_score,
    CASE WHEN score >= 90 THEN 'Excellent' WHEN score >= 75 THEN 'Very Good' WHEN score >= 60 THEN 'Good' WHEN score >= 40 THEN 'Fair' ELSE 'Poor' END AS bite_class,
    {even_sql('1 / (1 + exp(-(score - 60) / CASE WHEN lead_days <= 3 THEN 8 WHEN lead_days <= 7 THEN 10 WHEN lead_days <= 14 THEN 14 ELSE 20 END))', 4)} AS p_good_or_better, lo AS score_lo, hi AS score_hi, clim AS baseline_clim_score,
    CASE WHEN clim IS NOT NULL AND an IS NOT NULL THEN {even_sql('100 * ' + soft_sql('r'), 1)} END AS baseline_enso_score, CASE WHEN clim IS NOT NULL THEN an END AS baseline_enso_anom_f, simple_regime AS enso_regime, oni, core_score, fishability, term_tide, term_pressure,
    nullif(missing, '') AS missing_drivers, basis, sst_f, sst_source, wave_ft, wind_kt, pressure AS pressure_trend_24h, front AS front_f_per_nm, has_wave, mur AS src_mur_newest, mur_freshness AS src_mur_freshness, ndbc AS src_ndbc_newest_utc,
    wtemp AS src_coops_wtemp_newest, meteo AS src_openmeteo_fetched_utc, meteo_to AS src_openmeteo_valid_to, '2001-06-29' AS src_cpc_814_issued, oni_checked AS src_oni_checked, tides AS src_tides_fetched_utc, failed AS src_failed,
    nullif(concat_ws(';', CASE WHEN mur_freshness IN ('failed', 'stale', 'delayed') THEN 'mur_' || mur_freshness END, CASE WHEN n_failed > 0 THEN 'sources_failed=' || n_failed END, CASE WHEN missing <> '' THEN 'missing_drivers' END,
      CASE WHEN lead_days <= 6 AND contains(lower(sst_source), 'model') THEN 'sst_modelled_not_observed' END, CASE WHEN lead_days = 0 THEN 'lead0_issued_after_local_noon' END, CASE WHEN NOT labelled THEN 'no_outcome_source' END,
      CASE WHEN lead_days >= 15 THEN 'no_daily_sea_state;fishability_default' WHEN lead_days >= 7 THEN 'model_decayed_toward_climatology' END), '') AS dq_flags
  FROM (SELECT q.*, k.mean_anom_f AS an, c.climatological_score AS clim, {_turned.replace('clim', 'c.climatological_score').replace('(an ', '(k.mean_anom_f ')} AS r, z.region_id, z.labelled, w.simple_regime, w.oni, f.*
    FROM (SELECT * FROM p_issue_near UNION ALL BY NAME SELECT * FROM p_issue_ext) q CROSS JOIN p_current w CROSS JOIN p_source_fields f
    LEFT JOIN p_curve c ON c.zone_id = q.zone_id AND c.species_id = q.species_id AND c.doy = q.doy LEFT JOIN p_comp k ON k.zone_id = q.zone_id AND k.month = q.month AND k.simple_regime = w.simple_regime
    LEFT JOIN (SELECT * FROM p_zone_region QUALIFY row_number() OVER (PARTITION BY zone_id ORDER BY region_id) = 1) z ON z.zone_id = q.zone_id)""")
def build_issuance(spark, sf):
    """One whole issuance of today's scores and the outlook, with its provenance, recorded and read back."""
    path, c = fresh_path(spark, "issuance_store"), F.col
    family = c("user_id") % 6
    ident = (F.when(family == 0, "mur_sst").when(family == 1, F.concat(F.lit("ndbc:"), "user_id")).when(family == 2, F.concat(F.lit("coops:"), "user_id", F.lit(":water_temperature")))
             .when(family == 3, F.concat(F.lit("coops:"), "user_id", F.lit(":predictions"))).when(family == 4, F.concat(F.lit("openmeteo:"), "user_id")).otherwise("cpc_oni"))
    iso = lambda x: F.date_format(x, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    sources = i.events(spark, sf).groupBy(ident.alias("source_identifier")).agg(
        iso(F.max(F.when(c("value") < 200, c("ts")))).alias("newest_valid_source_timestamp"), iso(F.max("ts")).alias("last_successful_fetch_utc"),
        F.when(F.count("*") % 4 == 0, "failed").when(F.count("*") % 4 == 1, "stale").otherwise("fresh").alias("freshness"))
    documents = sources.select(F.to_json(F.struct(F.array(F.struct("*")).alias("sources"))).alias("status"))  # one document per source
    issued = spark.createDataFrame([("cpc_814_temp", "2001-06-29"), ("cpc_month_temp", "2001-06-21")], "product string, issued string")
    region = ev.zone_region(spark, sf).groupBy("zone_id").agg(F.min(F.struct("region_id", "labelled")).alias("r")).select("zone_id", "r.*")
    comp = ft.regime_composite(i.satellite_anomaly(spark, sf), i.labelled_index(spark, sf), "zone_id", "sst_anom_f")
    rows = led.build_issuance(
        i.scores(spark, sf), i.conditions(spark, sf), ou.outlook_scores(spark, sf), ou.outlook(spark, sf), i.curve(spark, sf), comp, cond.current_index(i.climate_index(spark, sf)),
        i.subjects(spark, sf), region, led.status_rows(documents, "status"), issued, issue_utc=F.lit(f"{_TODAY} 20:30:00").cast("timestamp"),
        data_cutoff_utc=F.lit(f"{_TODAY} 20:00:00").cast("timestamp"), today=F.lit(_TODAY).cast("date"), origin=led.LIVE_ORIGIN, source_ref="run:1", model_version="v1")
    led.append_issuances(spark, path, rows)
    return led.read_ledger(spark, path).withColumn("has_wave", F.col("inputs_json").rlike('"(wave_ft|wave_proj_ft)"'))


# one fault for every issuance, by its number modulo 12, in its first record
part("p_faults", """SELECT *, (dense_rank() OVER (ORDER BY issue_utc, issuance_id) - 1) AS seq, (dense_rank() OVER (ORDER BY issue_utc, issuance_id) - 1) % 12 AS fault,
    record_id = min(record_id) OVER (PARTITION BY issuance_id) AS victim, count(*) OVER (PARTITION BY issuance_id) AS n_rows,
    ('0x' || substr(sha256(record_id), 1, 8))::BIGINT % ceil(count(*) OVER (PARTITION BY issuance_id) / 16)::BIGINT AS leaf
  FROM (SELECT issuance_id, issue_utc, lead_days, concat_ws('|', issuance_id, target_date, zone_id, species_id) AS record_id FROM p_ledger)""")
_LOST = "fault = 7"


@query("q08_ledger_verification", "issuance_id s, error s, detail s", f"""
  WITH one AS (SELECT * FROM p_faults WHERE victim)
  SELECT issuance_id, 'rows_missing' AS error, NULL AS detail FROM one WHERE fault = 9
  UNION ALL SELECT issuance_id, 'row_count_mismatch', NULL FROM one WHERE fault IN (0, 3, 5) AND n_rows - (fault = 0)::INT > 0
  UNION ALL SELECT issuance_id, 'rows_missing', NULL FROM one WHERE fault = 0 AND n_rows = 1
  UNION ALL SELECT issuance_id, 'content_mismatch', NULL FROM one WHERE fault IN (0, 2, 3, 8) AND n_rows - (fault = 0)::INT > 0
  UNION ALL SELECT issuance_id, 'row_modified', record_id FROM one WHERE fault = 1
  UNION ALL SELECT issuance_id, 'leaf_mismatch', leaf::VARCHAR FROM one WHERE fault IN (0, 2, 3) AND n_rows - (fault = 0)::INT > 0
  UNION ALL SELECT issuance_id, 'duplicate_record', record_id FROM one WHERE fault = 3
  UNION ALL SELECT issuance_id, 'hash_chain_broken', NULL FROM one WHERE fault IN (4, 6, 8, 9) AND seq > 0
  UNION ALL SELECT issuance_id, 'far_sea_state', count(*)::VARCHAR FROM p_faults WHERE fault = 10 AND lead_days >= 15 GROUP BY 1
  UNION ALL SELECT issuance_id, 'look_ahead', 'src_fetched' FROM one WHERE fault = 11
  UNION ALL SELECT issuance_id, 'issuance_removed', NULL FROM one WHERE {_LOST}
  UNION ALL SELECT issuance_id, 'issuance_rewritten', NULL FROM one WHERE fault = 8""")
def ledger_verification(spark, sf):
    """A ledger of all issuances in which every one has a fault: lost, changed, repeated and forged rows, forged and lost index rows, late sources."""
    path = fresh_path(spark, "ledger_store")
    c = F.col
    rows = ev.ledger(spark, sf).withColumn("record_id", F.concat_ws("|", "issuance_id", "target_date", "zone_id", "species_id"))
    heads = rows.select("issuance_id", "issue_utc").distinct()
    numbers = heads.select("issuance_id", (F.row_number().over(Window.orderBy("issue_utc", "issuance_id")) - 1).alias("seq"))  # one row per issuance
    fault = numbers.select("issuance_id", (c("seq") % 12).alias("fault"))
    first = rows.groupBy("issuance_id").agg(F.min("record_id").alias("first_record"))
    faults = staged(spark, sf, "ledger_faults", lambda: fault.join(first, "issuance_id"))
    late = F.when(c("fault") == 11, c("issue_utc") + F.expr("interval 6 minutes")).otherwise(c("issue_utc"))
    given = rows.join(faults, "issuance_id").withColumns({
        "issue_local_date": c("issue_date"), "origin": F.lit("live_daily_refresh"), "source_ref": c("issuance_id"), "model_version": F.lit("v1"),
        "wave_ft": F.when(c("fault") == 10, F.lit(3.0)), "wind_kt": F.lit(None).cast("double"), "src_fetched": F.date_format(late, "yyyy-MM-dd'T'HH:mm:ss'Z'")})
    led.append_issuances(spark, path, given.drop("fault", "first_record"), leaf_rows=16)

    index = spark.read.parquet(f"{path}/index")
    stored = led.read_ledger(spark, path, hashes=True).join(faults, "issuance_id")
    victim = c("record_id") == c("first_record")
    kept = stored.where(~((c("fault") == 9) | (c("fault") == 0) & victim))
    kept = kept.withColumn("bite_score", F.when(c("fault").isin(1, 2) & victim, c("bite_score") + 1).otherwise(c("bite_score")))
    content = [x for x in kept.columns if x not in ("row_sha256", "leaf", "fault", "first_record")]
    kept = kept.withColumn("row_sha256", F.when((c("fault") == 2) & victim, led.row_digest(kept, content)).otherwise(c("row_sha256")))
    kept = kept.unionByName(kept.where((c("fault") == 3) & victim)).drop("fault", "first_record")
    forged = index.join(faults.select("issuance_id", "fault"), "issuance_id").where("fault <> 7").withColumns({
        "n_rows": c("n_rows") + F.when(c("fault") == 5, 1).otherwise(0),
        "content_sha256": F.when(c("fault") == 8, F.sha2("content_sha256", 256)).otherwise(c("content_sha256")),
        "prev_index_row_sha256": F.when(c("fault") == 4, F.lit("forged")).otherwise(c("prev_index_row_sha256"))}).drop("fault")
    return led.verify_ledger(kept, led.read_leaves(spark, path), forged, ["src_fetched"], index)


@query("k04_export_records", "l_returnflag s, record s", """
  SELECT l_returnflag, CAST(to_json({'l_returnflag': l_returnflag, 'n': count(*)}) AS VARCHAR) AS record FROM lineitem GROUP BY 1""")
def export(spark, sf):
    d = db.count_by(i.table(spark, sf, "lineitem"), "l_returnflag")
    return d.select("l_returnflag", F.to_json(F.struct("l_returnflag", "n")).alias("record"))


part("p_event_hours", "SELECT event_type, date_trunc('hour', ts) AS ts_hour, avg(value) AS mean_value, count(value) AS n_obs FROM events GROUP BY 1, 2")


@query("r02_streaming_hourly", "event_type s, ts_hour z, mean_value d5, n_obs l", "SELECT * FROM p_event_hours")
def streaming_hourly(spark, sf):
    """The hourly resample as a stream: update output, upserted per (type, hour), read after the run."""
    path = fresh_path(spark, "stream_hourly")
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    stream = jobs.stream_table(spark, f"{sf}/events.parquet*", schema).withColumn("ts", F.col("ts").cast("timestamp"))
    hourly = jobs.hourly(stream, "event_type", "ts", "value", "3 days").withColumn("day", F.to_date("ts_hour"))
    jobs.run_available(hourly, f"{path}/checkpoint", jobs.upsert_sink(spark, f"{path}/table", ["event_type", "ts_hour"], ["n_obs"], "day"), mode="update")
    return jobs.latest_version(spark, f"{path}/table")


@query("r05_streaming_append_unseen", "user_id l, day t", "SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events")
def streaming_append(spark, sf):
    path = fresh_path(spark, "stream_append")
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    stream = jobs.stream_table(spark, f"{sf}/events.parquet*", schema).select(F.concat_ws("|", "user_id", F.to_date("ts")).alias("key"), "user_id", F.to_date("ts").alias("day"))
    jobs.run_available(stream, f"{path}/checkpoint", jobs.append_unseen_sink(spark, f"{path}/table", "key"))
    return spark.read.parquet(f"{path}/table")
