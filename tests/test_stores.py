"""Restarts and retries of the stores: no history is lost and nothing is written twice."""

from datetime import datetime

from pyspark.sql import functions as F

from pelagia.functions.text import parse_counts
from pelagia.plans import ledger as led
from pelagia.streaming import jobs


def test_upsert_survives_a_new_checkpoint_and_copies_touched_partitions_only(spark, tmp_path):
    path = f"file://{tmp_path}/table"
    rows = lambda *x: spark.createDataFrame([(k[0], k, n) for k, n in x], "day string, k string, n long")
    files = lambda: {p: p.stat().st_mtime_ns for p in tmp_path.glob("table/data/*/*/*.parquet")}
    sink = jobs.upsert_sink(spark, path, ["day", "k"], ["n"], "day")
    sink(rows(("a1", 1), ("b1", 7)), 0)
    sink(rows(("b2", 1)), 1)
    a_files = {p: t for p, t in files().items() if "_part=p-a" in str(p)}
    sink(rows(("c1", 5), ("b1", 2)), 0)  # a new checkpoint counts from 0 again, and late data does not win
    sink(rows(("d1", 1)), 9)
    sink(rows(("d1", 1)), 9)  # the batch is tried again
    sink(rows(), 10)
    want = {("a1", 1), ("b1", 7), ("b2", 1), ("c1", 5), ("d1", 1)}
    assert {tuple(r) for r in jobs.latest_version(spark, path).select("k", "n").collect()} == want
    assert a_files and a_files.items() <= files().items()  # untouched since the first batch
    assert len({p.parent.parent for p in files()}) <= 4 and len(list(tmp_path.glob("table/manifest/v=*"))) == 2


def test_a_half_committed_version_is_never_read(spark, tmp_path):
    path = f"file://{tmp_path}/table"
    rows = lambda *x: spark.createDataFrame(x, "day string, k string, n long")
    sink = jobs.upsert_sink(spark, path, ["day", "k"], ["n"], "day")
    sink(rows(("x", "a", 1), ("y", "b", 1)), 0)
    # the driver is lost after it wrote some data files and before the manifest
    rows(("x", "a", 99)).selectExpr("k", "n", "day", "'p-x' AS _part").write.partitionBy("_part").parquet(f"{path}/data/_folder=1-lost")
    (tmp_path / "table/manifest/v=1/_temporary/0").mkdir(parents=True)
    assert {tuple(r) for r in jobs.latest_version(spark, path).select("k", "n").collect()} == {("a", 1), ("b", 1)}
    sink(rows(("x", "c", 3)), 1)
    assert {tuple(r) for r in jobs.latest_version(spark, path).select("k", "n").collect()} == {("a", 1), ("b", 1), ("c", 3)}
    assert not list(tmp_path.glob("table/data/_folder=1-lost"))


def test_sources_turn_stale_in_stream_order(spark, tmp_path):
    jobs.with_state_store(spark)
    t = lambda day, hour=0: datetime(2026, 1, day, hour)
    parts = [[("a", t(1), True, t(1)), ("b", t(1), False, None), ("b", t(1, 5), False, None), ("c", t(1), True, None)],
             [("a", t(2), False, None), ("b", t(2), True, t(1)), ("d", t(2), True, t(2))],
             [("a", t(6), True, t(5)), ("b", t(3), True, t(2)), ("b", t(3), True, t(3))]]
    schema = "source_identifier string, attempted_utc timestamp, success boolean, newest timestamp"
    got = {}
    for run, groups in (("many", parts), ("one", [[x for p in parts for x in p]])):
        src = f"file://{tmp_path}/{run}"
        for rows in groups:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{src}/in")
            changes = jobs.freshness_transitions(jobs.stream_table(spark, f"{src}/in", schema), 3 * 86_400, "1 hour")
            jobs.run_available(changes, f"{src}/ck", path=f"{src}/out")
        got[run] = sorted(tuple(r) for r in spark.read.parquet(f"{src}/out").select("source_identifier", "at", "freshness", "last_successful_fetch_utc").collect())
    want = [("a", t(1), "fresh", t(1)), ("a", t(4), "stale", t(1)), ("a", t(6), "fresh", t(6)), ("b", t(1), "failed", None), ("b", t(2), "fresh", t(2)),
            ("c", t(1), "fresh", t(1)), ("c", t(4), "stale", t(1)), ("d", t(2), "fresh", t(2)), ("d", t(5), "stale", t(2))]
    assert got["one"] == want and got["many"] == want


def test_freshness_keeps_the_last_success(spark, tmp_path):
    path = f"file://{tmp_path}/status"
    rows = lambda *x: spark.createDataFrame(x, "source_identifier string, attempted_utc string, success boolean, newest string")
    sink = jobs.freshness_sink(spark, path)
    sink(rows(("s", "2024-01-01", True, "2023-12-31")), 0)
    sink(rows(("s", "2024-01-02", False, None)), 0)
    got = jobs.latest_version(spark, path).first()
    assert tuple(got) == ("s", "2024-01-02", "2024-01-01", "2023-12-31")


def test_numbers_out_of_range_do_not_stop_the_parser(spark):
    text = "99999999999999999999 Yellowtail, 99999999999 Dorado, 3 Calico Bass"
    got = spark.range(1).select(parse_counts(F.lit(text)).alias("c")).first()["c"]["kept"]
    assert got["dorado"] == 99999999999 and got["calico_bass"] == 3 and got["yellowtail"] is None


def test_all_issuances_are_appended_as_if_one_by_one(spark, tmp_path):
    def rows(*days):
        data = [(f"I{d}", f"2001-01-0{d} 15:00:00", f"2001-01-0{d}", "s1" if d == 3 else f"s{d}", k, f"{d}-{k}") for d in days for k in range(d)]
        df = spark.createDataFrame(data, "issuance_id string, u string, l string, source_ref string, lead_days int, record_id string")
        return df.select("issuance_id", F.to_timestamp("u").alias("issue_utc"), F.to_date("l").alias("issue_local_date"), F.lit("live").alias("origin"), "source_ref",
                         F.lit("v1").alias("model_version"), "lead_days", "record_id", F.lit(None).cast("double").alias("wave_ft"), F.lit(None).cast("double").alias("wind_kt"))

    for days in ((2, 1, 3, 4), (4, 2), (5, 6)):  # the third has the source of the first
        led.append_issuances(spark, f"{tmp_path}/all", rows(*days))
        for d in sorted(days):
            led.append_issuance(spark, f"{tmp_path}/one", rows(d))
    index, single = (spark.read.parquet(f"{tmp_path}/{k}/index").drop("created_utc") for k in ("all", "one"))
    assert [(r.issuance_id, r.seq, r.n_rows) for r in index.orderBy("seq").collect()] == [("I1", 0, 1), ("I2", 1, 2), ("I4", 2, 4), ("I5", 3, 5), ("I6", 4, 6)]
    assert index.orderBy("seq").collect() == single.select(index.columns).orderBy("seq").collect()
    kept = led.read_ledger(spark, f"{tmp_path}/all")
    assert kept.count() == 18 and led.broken_chain(index).isEmpty()


def test_loads_commit_trips_and_fetch_log_together(spark, tmp_path):
    from pelagia.sources import sinks
    path = f"file://{tmp_path}/store"
    trip = "landing string, boat string, trip_type_raw string, anglers int, kept_json string, released_json string"
    t = lambda boat, n, landing="L": (landing, boat, "Full Day", n, '{"a":1}', None)
    day = lambda d, h, trips, ok=True: (datetime(2026, 1, d).date(), datetime(2026, 1, d, h), "m", ok, None, trips)
    fetches = lambda *x: spark.createDataFrame(x, f"report_date date, fetched_at_utc timestamp, ingest_method string, ok boolean, error string, trips array<struct<{trip.replace(' ', ':').replace(',:', ',')}>>")
    one = fetches(day(1, 5, [t("x", 3), t("x", 3), t("y", 4)]), day(2, 5, [], False))
    sinks.append_load(spark, one, path)
    sinks.append_load(spark, one, path)
    # fields that a plain join of texts would confuse
    sinks.append_load(spark, fetches(day(1, 9, [t("x", 3), t("b|c", 1, "a"), t("c", 1, "a|b")])), path)
    got = sinks.read_trips(spark, path)
    assert sorted((r.landing, r.boat, r.fetched_at_utc.hour) for r in got.collect()) == [("L", "x", 5), ("L", "y", 5), ("a", "b|c", 9), ("a|b", "c", 9)]
    assert sorted((r.report_date.day, r.n_trips, r.ok) for r in spark.read.parquet(f"{path}/fetches").collect()) == [(1, 3, True), (1, 3, True), (2, 0, False)]
    # the driver is lost between the trips and the log: nothing shows; another load and the repeated one both commit
    half = fetches(day(3, 5, [t("z", 1), t("w", 1)]))
    log = spark.read.parquet(f"{path}/fetches")
    kept = log.collect()
    sinks.append_load(spark, half, path)
    spark.createDataFrame(kept, log.schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/fetches")
    assert sinks.read_trips(spark, path).count() == 4
    sinks.append_load(spark, fetches(day(3, 7, [t("z", 1)])), path)
    sinks.append_load(spark, half, path)
    assert sorted(r.boat for r in sinks.read_trips(spark, path).collect()) == ["b|c", "c", "w", "x", "y", "z"]


def test_ordered_files_read_in_name_order(spark, tmp_path):
    from pelagia.sources import sinks
    df = spark.range(5000).selectExpr("pmod(xxhash64(id), 700) as a", "pmod(xxhash64(id, 1), 50) as b", "id as c")
    for fmt in ("parquet", "csv"):
        path = f"file://{tmp_path}/{fmt}"
        sinks.write_ordered(df, ["b", "a", "c"], path, ["a", "b"], files=7, fmt=fmt)
        rows = [(int(r.a), int(r.b), int(r.c)) for r in sinks.read_in_order(spark, path, fmt).orderBy("file_no", "row_no").collect()]
        assert rows == sorted((r.a, r.b, r.c) for r in df.collect()) and len(list((tmp_path / fmt).glob("part-*"))) == 7
    assert spark.read.parquet(f"file://{tmp_path}/parquet").columns == ["b", "a", "c"]


def test_dirty_numbers_leave_the_rest_of_a_row(spark):
    from pyspark.sql import Row

    from pelagia.sources import readers as rd
    lines = spark.createDataFrame([("DJF 1999 25.1 -1.2",), ("JFM 19x9 25.1 -1.2",), ("FMA 2000 n/a --",), ("bad",)], "line string")
    assert [(r.year, r.sst_c, r.oni) for r in rd.parse_index_lines(lines, "line").collect()] == [(1999, 25.1, -1.2), (None, 25.1, -1.2), (2000, None, None)]
    dim = spark.createDataFrame([Row(species_id="s", zones="a,b", season_index_monthly="0.5,x", weights_json='{"sst":0.5}', sst_min_f="50", sst_opt_lo_f="?", sst_opt_hi_f="70", sst_max_f=None)],
                                "species_id string, zones string, season_index_monthly string, weights_json string, sst_min_f string, sst_opt_lo_f string, sst_opt_hi_f string, sst_max_f string")
    r = rd.parse_dimension_csv(dim).first()
    assert (r.zones, r.season_index, r.sst_window) == (["a", "b"], [0.5, None], [50.0, None, 70.0, None])
