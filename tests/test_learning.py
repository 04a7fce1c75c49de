import datetime as dt

import pytest
from pyspark.sql import functions as F

from pelagia.functions.classes import TERMS
from pelagia.plans import changes, labels, ledger, quality, verify
from pelagia.session import fresh_path

D = dt.date


@pytest.fixture(scope="module")
def label_rows(spark):
    """A reference window with calico catches, a day of effort without any, and a day without trips."""
    trips, fetches, listing, n = [], [], [], 0
    days = [(D(2026, 8, 15) + dt.timedelta(days=k), 30, {"calico_bass": 30}, dt.datetime(2026, 8, 28)) for k in range(13)]
    days.append((D(2026, 9, 10), 40, {"sand_bass": 5}, dt.datetime(2026, 9, 11, 12)))
    for day, anglers, kept, fetched in days:
        fetches.append((day, fetched, "test", True))
        for _ in range(3):
            trips.append((str(n), day, "half_day", "1/2 Day AM", 0.5, anglers, kept, {}))
            listing.append((day, fetched, str(n)))
            n += 1
    fetches.append((D(2026, 9, 11), dt.datetime(2026, 9, 12), "test", True))
    raw = spark.createDataFrame(trips, "raw_id string, report_date date, trip_type string, trip_type_raw string, trip_days double, anglers int, kept map<string,int>, released map<string,int>")
    log = spark.createDataFrame(fetches, "report_date date, fetched_at_utc timestamp, ingest_method string, ok boolean")
    pages = spark.createDataFrame(listing, "report_date date, fetched_at_utc timestamp, raw_id string")
    regions = spark.createDataFrame([("kelp_nearshore", s) for s in ("calico_bass", "sand_bass", "white_seabass")], "region_id string, species_id string")
    daily = labels.daily_catch(labels.trip_species_days(labels.current_trips(raw, log, pages), regions))
    ref = labels.build_reference(daily, "2026-08-15", "2026-08-27")
    out = labels.build_labels(daily, ref, log, F.lit("2026-09-20").cast("date"), "2026-08-15", "2026-08-27", "test")
    return {(r.fishing_date, r.species_id): r for r in out.collect()}


def test_effort_adjusted_zero_is_poor(label_rows):
    r = label_rows[(D(2026, 9, 10), "calico_bass")]
    assert r.observed_class == "Poor" and "effort_adjusted_zero" in r.dq_flags and r.angler_days == 60.0 and r.label_status == "final"


def test_no_reports_and_no_reference_give_no_label(label_rows):
    assert not [k for k in label_rows if k[0] == D(2026, 9, 11)]
    r = label_rows[(D(2026, 9, 10), "white_seabass")]
    assert r.observed_class is None and r.label_status == "no_reference" and "sparse_species" in r.dq_flags


def test_walk_forward_uses_only_prior_labels(spark):
    rows = []
    for n in range(120):
        d = D(2026, 6, 1) + dt.timedelta(days=n)
        t = dt.datetime(d.year, d.month, d.day, 13)
        rows.append((str(d), d, t, "short_0_7", 70.0 + n % 10, (30.0 + n % 10) if n < 100 else 95.0, dt.datetime(d.year, d.month, d.day) + dt.timedelta(days=1)))
    df = spark.createDataFrame(rows, "issuance_id string, target_date date, issue_utc timestamp, horizon_group string, bite_score double, observed_score double, available_at_utc timestamp")
    got = [r.cal for r in verify.walk_forward_calibration(df, "cal").orderBy("target_date").collect()]
    assert got[100] < 60 and got[10] == 70.0
    # availability exactly at the issue time is not "before" it
    late = df.withColumn("available_at_utc", F.col("issue_utc") + F.expr("interval 60 days"))
    assert [r.cal for r in verify.walk_forward_calibration(late, "cal", min_training=60).orderBy("target_date").collect()][:120] == [70.0 + n % 10 for n in range(120)]


def issuance(spark, iid, lead, score=60.0, tide=0.5, wave=1.0):
    row = {"issuance_id": iid, "record_id": f"{iid}|x", "issue_utc": dt.datetime(2026, 9, int(iid)), "issue_local_date": D(2026, 9, int(iid)), "origin": "live_daily_refresh", "source_ref": f"run:{iid}",
           "model_version": "v1", "target_date": D(2026, 9, 20), "zone_id": "z", "species_id": "s", "lead_days": lead, "horizon_tier": 1 if lead <= 6 else 2, "bite_score": score, "bite_class": "Good",
           "anomaly_term": 1.0, "fishability": 80.0, "sst_f": 66.0, "sst_anom_f": 1.0, "wave_ft": wave, "wind_kt": None, "tide_range_ft": 4.0, "sst_source": "sat", "src_a": "2026-09-01T00:00:00Z", "inputs_json": "{}"}
    row |= {f"term_{k}": 0.5 for k in TERMS} | {"term_tide": tide, "term_front": None}
    types = {"issue_utc": "timestamp", "issue_local_date": "date", "target_date": "date", "lead_days": "int", "horizon_tier": "int"}
    nums = {"bite_score", "anomaly_term", "fishability", "sst_f", "sst_anom_f", "wave_ft", "wind_kt", "tide_range_ft"} | {f"term_{k}" for k in TERMS}
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {types.get(k, 'double' if k in nums else 'string')}" for k in row))


def test_ledger_is_write_once_and_tamper_evident(spark):
    path = fresh_path(spark, "led")
    assert ledger.append_issuance(spark, path, issuance(spark, "10", 5)) is True
    assert ledger.append_issuance(spark, path, issuance(spark, "10", 5, score=10.0)) is False
    assert ledger.append_issuance(spark, path, issuance(spark, "12", 3)) is True
    index, rows, leaves = spark.read.parquet(f"{path}/index"), ledger.read_ledger(spark, path, hashes=True), ledger.read_leaves(spark, path)
    assert rows.count() == 2 and index.agg(F.max("seq")).first()[0] == 1 and "row_sha256" not in ledger.read_ledger(spark, path).columns
    found = lambda r, v, i: sorted(tuple(x) for x in ledger.verify_ledger(r, v, i, ["src_a"], index).collect())
    assert found(rows, leaves, index) == []
    edited = rows.withColumn("bite_score", F.when(F.col("issuance_id") == "10", F.col("bite_score") + 1).otherwise(F.col("bite_score")))
    assert found(edited, leaves, index) == [("10", "row_modified", "10|x")]
    # the forger writes the row's digest anew, then the leaf too
    rehashed = edited.withColumn("row_sha256", ledger.row_digest(edited.drop("row_sha256", "leaf")))
    assert found(rehashed, leaves, index) == [("10", "content_mismatch", None), ("10", "leaf_mismatch", "0")]
    assert found(rehashed, ledger.hash_leaves(rehashed), index) == [("10", "content_mismatch", None)]
    forged = index.withColumn("n_rows", F.when(F.col("seq") == 0, F.lit(7)).otherwise(F.col("n_rows")))
    assert found(rows, leaves, forged) == [("10", "row_count_mismatch", None), ("12", "hash_chain_broken", None)]
    assert found(rows, leaves, index.where("seq = 1")) == [("10", "issuance_removed", None), ("12", "hash_chain_broken", None)]


def test_digests_tell_rows_apart_and_ignore_the_time_zone(spark):
    df = spark.createDataFrame([("a|b", "c", None), ("a", "b|c", None), ("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    assert df.select(ledger.row_digest(df).alias("d")).distinct().count() == 4
    t = spark.sql("select timestamp'2026-01-01 00:00:00Z' as t")
    before = t.select(ledger.row_digest(t)).first()[0]
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert t.select(ledger.row_digest(t)).first()[0] == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_lookahead_and_far_sea_state(spark):
    late = issuance(spark, "10", 20).withColumn("src_a", F.lit("2026-09-10T01:00:00Z"))
    assert [r.issuance_id for r in ledger.lookahead(late, ["src_a"]).collect()] == ["10"]
    assert ledger.forbidden_far_values(late).first().n == 1
    j = late.select(ledger.inputs_json(["wave_proj_ft", "sst_f"]).alias("j")) if "wave_proj_ft" in late.columns else late.withColumn("wave_proj_ft", F.lit(3.0)).select(ledger.inputs_json(["wave_proj_ft", "sst_f"]).alias("j"))
    assert j.first().j == '{"sst_f":66.0}'


def test_changes_add_up_and_name_the_driver(spark):
    w = spark.createDataFrame([("s", {k: 0.1 for k in TERMS})], "species_id string, weights map<string,double>")
    out = changes.forecast_changes(issuance(spark, "12", 3, 70.0, tide=0.9, wave=None), issuance(spark, "10", 8, 60.0, tide=0.4), w).first()
    assert out.delta == 10.0 and out.top_drivers == "tide +10.0" and sum(out.driver_points.values()) == pytest.approx(10.0, abs=0.2)
    assert out.input_changes == "seas withdrawn" and "confidence tier 2→1" in out.notes


def test_registry_rules(spark):
    models = spark.createDataFrame([("v1", "production", True), ("v1.1-cal", "shadow", False)], "model_id string, status string, approved boolean")
    dec = spark.createDataFrame([(0, "register"), (1, "approve")], "seq int, action string")
    check = lambda m, d, prod="v1": {r.violation for r in quality.registry_violations(m, d, prod, "v1", False, models, dec).collect()}
    assert check(models, dec) == set()
    assert "production_differs_from_engine" in check(models, dec, "v1.1-cal")
    assert check(models.where("model_id = 'v1'"), dec) == {"model_removed"}
    assert check(models, dec.where("seq > 0")) == {"decision_changed"}


def test_failed_attempt_keeps_last_success(spark):
    t = dt.datetime(2026, 9, 1)
    prev = spark.createDataFrame([("a", t, t, t, "fresh", False, None)], "source_identifier string, last_attempted_fetch_utc timestamp, last_successful_fetch_utc timestamp, newest_valid_source_timestamp timestamp, freshness string, used_cached_data boolean, error string")
    att = spark.createDataFrame([("a", t + dt.timedelta(days=1), False, None, "failed", True, "timeout")], "source_identifier string, attempted_utc timestamp, success boolean, newest timestamp, freshness string, cached boolean, error string")
    r = quality.upsert_status(prev, att).first()
    assert r.last_successful_fetch_utc == t and r.last_attempted_fetch_utc == t + dt.timedelta(days=1) and r.newest_valid_source_timestamp == t and r.freshness == "failed"


def test_entry_and_sql_share_names(spark):
    import __spark_entry__ as e
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q) and e.FLAGSHIP in q and len(q) > 100


def test_an_issuance_is_built_whole(spark):
    """Both horizons, far-lead fields removed, provenance from the status document, hindcast days left out."""
    day = lambda k: D(2026, 9, 10) + dt.timedelta(days=k)
    terms = [f"term_{t}" for t in TERMS]
    near = spark.createDataFrame([(day(k), z, "s", "front" if k == 1 else "", 1.0, 70.0, 72.0, 80.0, *[0.5] * 8) for k in range(-2, 9) for z in ("sd_bay", "far")],
                                 "date date, zone_id string, species_id string, missing_drivers string, anomaly_term double, score double, core_score double, fishability double, " + ", ".join(f"{t} double" for t in terms))
    cond = spark.createDataFrame([(day(k), z, 66.0, "Open-Meteo marine model", 3.0, None, "x") for k in range(-2, 9) for z in ("sd_bay",)],
                                 "date date, zone_id string, sst_f double, sst_source string, wave_ft double, wind_kt double, unlisted string").withColumn("sst_anom_f", F.lit(1.0)).withColumn(
        "tide_range_ft", F.lit(4.0)).withColumn("moon_illum", F.lit(0.5)).withColumn("pressure_trend_24h", F.lit(-1.0))
    ext = spark.createDataFrame([(day(k), "sd_bay", "s", "", 1.0, 55.0, 50.0, 60.0, 75.0, "b", 0.4) for k in range(5, 33)],
                                "date date, zone_id string, species_id string, missing_drivers string, anomaly_term double, score_outlook double, score_lo double, score_hi double, fishability_outlook double, basis string, term_sst double")
    out = spark.createDataFrame([(day(k), "sd_bay", 65.0, 0.5, 4.0, 9.0, 4.0, 0.5, 2.0) for k in range(5, 33)],
                                "date date, zone_id string, sst_proj_f double, sst_anom_proj_f double, wave_proj_ft double, wind_proj_kt double, tide_range_ft double, moon_illum double, pressure_trend_model_24h double")
    curve = spark.createDataFrame([("sd_bay", "s", d, 50.0) for d in range(240, 300)], "zone_id string, species_id string, doy int, climatological_score double")
    comp = spark.createDataFrame([("sd_bay", 9, "El Nino", 1.25)], "zone_id string, month int, simple_regime string, mean_anom_f double")
    now = spark.createDataFrame([("El Nino", 1.1)], "simple_regime string, oni double")
    subjects = spark.createDataFrame([("s", 1.0)], "species_id string, anomaly_pref double")
    region = spark.createDataFrame([("sd_bay", "bays", False), ("far", "offshore", True)], "zone_id string, region_id string, labelled boolean")
    status = '{"sources": [{"source_identifier": "mur_sst:1", "freshness": "stale", "newest_valid_source_timestamp": "2026-09-08"}, {"source_identifier": "ndbc:1", "freshness": "failed", "newest_valid_source_timestamp": "2026-09-10T10:00:00Z"}]}'
    docs = spark.createDataFrame([(status,), ("not json",), (None,)], "status string")
    issued = spark.createDataFrame([("cpc_814_temp", "2026-09-09")], "product string, issued string")
    rows = ledger.build_issuance(near, cond, ext, out, curve, comp, now, subjects, region, ledger.status_rows(docs, "status"), issued, issue_utc=F.lit("2026-09-10 20:30:00").cast("timestamp"),
                                 data_cutoff_utc=F.lit("2026-09-10 20:00:00").cast("timestamp"), today=F.lit("2026-09-10").cast("date"), origin="backfill", source_ref="r", model_version="v1")
    got = {(r.zone_id, r.lead_days): r for r in rows.collect()}
    assert rows.columns == ledger.LEDGER_COLUMNS and sorted(got) == sorted([("sd_bay", k) for k in range(31)] + [("far", k) for k in range(7)])
    a, b, c, d = got["sd_bay", 0], got["sd_bay", 14], got["sd_bay", 15], got["far", 1]
    assert a.inputs_json == '{"moon_illum":0.5,"pressure_trend_24h":-1.0,"sst_anom_f":1.0,"sst_f":66.0,"sst_source":"Open-Meteo marine model","tide_range_ft":4.0,"wave_ft":3.0}'
    assert a.dq_flags == "mur_stale;sources_failed=1;backfill;sst_modelled_not_observed;lead0_issued_after_local_noon;shared_bay_thermistor;no_outcome_source"
    assert (b.wave_ft, b.wind_kt, b.pressure_trend_24h, b.term_sst, b.term_moon, b.core_score) == (4.0, 9.0, 2.0, 0.4, None, None) and "wave_proj_ft" in b.inputs_json
    assert (c.wave_ft, c.wind_kt, c.pressure_trend_24h) == (None, None, None) and "wave_proj_ft" not in c.inputs_json and c.dq_flags.endswith("no_daily_sea_state;fishability_default")
    assert (d.inputs_json, d.sst_f, d.baseline_clim_score, d.missing_drivers) == ("{}", None, None, "front") and "missing_drivers" in d.dq_flags
    assert (a.src_mur_newest, a.src_failed, a.src_cpc_814_issued, a.src_cpc_wk34_issued) == ("2026-09-08", "ndbc:1", "2026-09-09", None) and a.issue_local == "2026-09-10T13:30:00"
    assert (a.baseline_clim_score, a.baseline_enso_anom_f, a.enso_regime, a.oni, a.record_id) == (50.0, 1.25, "El Nino", 1.1, "2026-09-10T1330PT_v1|2026-09-10|sd_bay|s")
    assert ledger.forbidden_far_values(rows).isEmpty()


def test_reduced_evaluation_equals_the_plain_one(spark):
    """Sums and distinct counts from reduced rows against metrics of every window and dimension apart."""
    import random
    from pelagia.operators import stats
    rng = random.Random(3)
    day = lambda k: D(2026, 9, 30) - dt.timedelta(days=k)
    rows = [(day(k), f"i{rng.randrange(30)}", rng.choice(["short_0_7", "outlook_8_30"]), rng.randrange(31), rng.choice("st"), rng.choice(["r", None]), rng.uniform(0, 100), rng.choice([None, 50.0]), rng.uniform(0, 100))
            for k in (rng.randrange(200) for _ in range(400))]
    df = spark.createDataFrame(rows, "target_date date, issuance_id string, horizon_group string, lead_days int, species_id string, region_id string, score__v1 double, score__baseline_climatology double, observed_score double")
    df = df.withColumns({"overall": F.lit("all"), "y_good": (F.col("observed_score") >= 60).cast("int"), "obs_idx": F.floor(F.col("observed_score") / 25).cast("int")})
    as_of, dims = F.lit("2026-09-30").cast("date"), ["overall", "horizon_group", "species_id", "region_id"]
    models = ["v1", "baseline_climatology"]
    got = {(r.window, r.dimension, r.stratum, r.model_id): r.asDict() for r in verify.evaluate(df, models, as_of, dims).collect()}
    n = 0
    for window, days in (("rolling_30d", 30), ("rolling_90d", 90), ("all", 10**4)):
        part = stats.long_by_model(df.where(F.col("target_date") > F.date_sub(as_of, days)), models)
        for d in dims:
            for r in stats.metrics(part, [d, "model_id"], 10).where(F.col(d).isNotNull()).collect():
                mine = got[window, d, r[d], r.model_id]
                assert {k: v for k, v in r.asDict().items() if k not in (d, "model_id")} == {k: mine[k] for k in r.asDict() if k not in (d, "model_id")}
                n += 1
    assert n > 30
