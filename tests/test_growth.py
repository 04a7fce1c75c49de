"""Steps whose cost must not grow faster than their input: what a task holds, how often state is called, what is shuffled."""

from datetime import date, datetime
from types import SimpleNamespace

from pyspark.sql import functions as F

from pelagia.operators import joins
from pelagia.plans import conditions, labels
from pelagia.plans import ledger as led
from pelagia.queries import inputs, textual
from pelagia.sources import readers, sinks
from pelagia.streaming.jobs import Freshness

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_listed_ids_are_rows_and_the_fetch_log_stays_short(spark, tmp_path):
    path = f"file://{tmp_path}/store"
    fields = "landing:string,boat:string,trip_type_raw:string,anglers:int,kept_json:string,released_json:string"
    t = lambda boat: ("L", boat, "Full Day", 3, "{}", None)
    rows = lambda hour, *boats: spark.createDataFrame([(date(2026, 1, 1), datetime(2026, 1, 1, hour), "m", True, None, [t(b) for b in boats])],
                                                      f"report_date date, fetched_at_utc timestamp, ingest_method string, ok boolean, error string, trips array<struct<{fields}>>")
    sinks.append_load(spark, rows(5, "x", "y", "x"), path)
    committed = spark.read.parquet(f"{path}/fetches")
    log = committed.collect()
    sinks.append_load(spark, rows(9, "x", "z"), path)
    # a load without its log is not listed; repeated, it is listed once
    spark.createDataFrame(log, committed.schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/fetches")
    assert sinks.read_listing(spark, path).count() == 2
    sinks.append_load(spark, rows(9, "x", "z"), path)
    got = sinks.read_listing(spark, path).join(sinks.read_trips(spark, path).select("raw_id", "boat"), "raw_id")
    assert sorted((r.fetched_at_utc.hour, r.boat) for r in got.collect()) == [(5, "x"), (5, "y"), (9, "x"), (9, "z")]
    assert sorted(spark.read.parquet(f"{path}/fetches").columns) == ["error", "fetched_at_utc", "ingest_method", "load_id", "n_trips", "ok", "report_date"]


def test_freshness_calls_its_state_once_for_all_rows_of_a_trigger():
    class State:
        value, calls = None, 0

        def exists(self):
            return self.value is not None

        def get(self):
            self.calls += 1
            return self.value

        def update(self, value):
            self.calls += 1
            self.value = value

    state, timers = State(), []
    handle = SimpleNamespace(getValueState=lambda *a: state, listTimers=lambda: iter(()), deleteTimer=timers.remove, registerTimer=timers.append)
    p = Freshness(1_000_000)
    p.init(handle)
    row = lambda at, ok, newest=None: SimpleNamespace(at=at, success=ok, newest=newest)
    rows = [row(10 + k % 500, True, k) for k in range(1000)] + [row(3_000_000, False), row(5, False)]
    got = [(r.at, r.freshness, r.success) for r in p.handleInputRows(("s",), iter(rows), None)]
    assert got == [(5, "failed", None), (10, "fresh", 10), (1_000_509, "stale", 509)]
    assert state.value == (509, 999, "stale") and state.calls <= 2


def test_labels_count_trips_without_a_shuffle_by_trip(spark):
    trips = spark.createDataFrame([(k, date(2026, 1, 5), "2.5 Day", "2.5_day", 2.5, 4) for k in range(3)], "raw_id int, report_date date, trip_type_raw string, trip_type string, trip_days double, anglers int")
    trips = trips.withColumns({"kept": F.create_map(F.lit("s"), F.col("raw_id").cast("bigint")), "released": F.create_map().cast("map<string,bigint>")})
    log = spark.createDataFrame([(date(2026, 1, 5), datetime(2026, 1, 6), "m", True)], "report_date date, fetched_at_utc timestamp, ingest_method string, ok boolean")
    pages = spark.createDataFrame([(date(2026, 1, 5), datetime(2026, 1, 6), k) for k in (0, 1, 1, 2)], "report_date date, fetched_at_utc timestamp, raw_id int")
    regions = spark.createDataFrame([("extended_offshore", "s")], "region_id string, species_id string")
    daily = labels.daily_catch(labels.trip_species_days(labels.current_trips(trips, log, pages), regions))
    # the second trip is listed twice: two rows, one trip
    assert sorted((r.fishing_date.day, r.n_trips, r.n_raw, r.fish_kept) for r in daily.collect()) == [(4, 3, 4, 2.0), (5, 3, 4, 2.0)]
    assert not [x for x in plan_of(daily).splitlines() if "hashpartitioning" in x and "trip_key" in x]


def test_zone_days_are_summed_where_lines_are_read(spark):
    assert not [x for x in plan_of(inputs._zone_raw(spark, SF)).splitlines() if "Exchange hashpartitioning" in x and "suppkey" in x]


def test_a_page_is_cut_once_and_its_cells_are_read_once(spark):
    page = ("<h1>Totals <b>March</b>\t&nbsp; 3,\n2026 April 1, 2026</h1><table><tr><td>Stray</td><td>5 Anglers Full Day</td><td>1 Dorado</td></tr></table>"
            "<!-- <h2>Islandia Sportfishing</h2> --><H2 class='x'><i>H&amp;M</i>  Landing\n</H2><table><tr><th>Boat</th><th>Trip</th><th>Counts</th></tr>"
            "<tr><td>Ace <b>&lt;2&gt;</b> H&amp;M Landing, San Diego</td><td>12 anglers 1/2 Day AM</td><td>3 Calico\t Bass RELEASED, 2 red snappers (up to 9, big), 4 Sculpin -, 1 Yellowtail. up to 9, 5 (x)</td><td>more</td></tr>"
            "<tr><td>Dock Total</td><td>12 Anglers</td><td>1 Dorado</td></tr><tr><td>Bee</td><td>7 Anglers</td></tr></table><h3>More</h3><tr><td>Cee</td><td>99999999999 Anglers Overnight</td><td></td></tr>")
    df = readers.parse_report_html(spark.createDataFrame([(page,), (None,), ("<h2>none</h2>",)], "html string"), "html", [])
    got = [(r.page_date, r.landing, r.boat, r.trip_type, r.anglers, r.kept, r.released) for r in df.collect()]
    assert got == [(date(2026, 3, 3), "H&M", "Ace <2>", "half_day", 12, {"rockfish": 2, "yellowtail": 1}, {"calico_bass": 3}),
                   (date(2026, 3, 3), "H&M", "Cee", "overnight", None, {}, {})]
    plan = plan_of(df).split("== Initial Plan ==")[-1]
    # before, each landing decoded the heading again and each filter the cells
    assert plan.count("<h[23]\\b[^>]*>") == 1 and plan.count("<t[dh]") == 1 and plan.count("script|style") == 1


def test_pages_are_parsed_in_all_shuffle_partitions(spark):
    # before, AQE joined the few bytes of the pages to one task
    for build in (textual.report_html, textual.daily_html):
        assert build(spark, SF).select(F.spark_partition_id()).distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_an_issuance_stores_its_list_of_failed_sources_once(spark, tmp_path):
    long = ",".join(f"coops:{k}:predictions" for k in range(3000))
    given = [(f"I{n}", f"I{n}|{k}", datetime(2026, 9, 1 + n), date(2026, 9, 1 + n), "live", f"run:{n}", "v1", k, 1.0, 2.0, (long, None, "ndbc:1")[n if k else 0]) for n in range(3) for k in range(5)]
    shape = ("issuance_id string, record_id string, issue_utc timestamp, issue_local_date date, origin string, source_ref string, model_version string, lead_days int, wave_ft double, "
             "wind_kt double, src_failed string")
    path = str(tmp_path / "led")
    led.append_issuances(spark, path, spark.createDataFrame(given, shape))
    # before, every stored row held the list
    assert spark.read.parquet(f"{path}/rows").agg(F.max(F.length("src_failed"))).first()[0] == 64
    assert sorted((r.issuance_id, r.text) for r in spark.read.parquet(f"{path}/texts").collect()) == [("I0", long), ("I1", long), ("I2", long), ("I2", "ndbc:1")]
    assert sorted(map(tuple, led.read_ledger(spark, path).select(*[c.split()[0] for c in shape.split(", ")]).collect())) == sorted(given)
    rows, leaves, index = led.read_ledger(spark, path, hashes=True), led.read_leaves(spark, path), spark.read.parquet(f"{path}/index")
    found = lambda r: sorted(tuple(x) for x in led.verify_ledger(r, leaves, index, ["src_failed"]).collect())
    assert rows.rdd.getNumPartitions() > 1 and spark.conf.get("spark.sql.shuffle.partitions") == "4"
    edited = F.when(F.col("record_id") == "I2|1", "ndbc:2").when(F.col("record_id") == "I0|1", None).otherwise(F.col("src_failed"))
    assert found(rows) == [] and found(rows.withColumn("src_failed", edited)) == [("I0", "row_modified", "I0|1"), ("I2", "row_modified", "I2|1")]


def test_zone_days_are_scored_where_they_lie(spark):
    # before, the zone-days were broadcast to the few subject rows, and one task scored them all
    days = inputs.conditions(spark, SF).repartition(4)
    rows = conditions.eligible_pairs(days, inputs.subjects(spark, SF), inputs.zones(spark, SF))
    assert rows.select(F.spark_partition_id()).distinct().count() == 4


def test_the_index_does_not_read_orders_each_time(spark):
    assert "o_orderdate" not in plan_of(inputs.labelled_index(spark, SF))


def test_cells_of_polygons_in_a_small_file_are_not_broadcast(spark, tmp_path):
    # before, the edges of all cells were broadcast, as Catalyst takes them to be as small as the polygons' file
    ring = lambda k, r: [(k % 7 + r, k % 5 + 0.1), (k % 7 + 0.1, k % 5 + r), (k % 7 - r, k % 5 + 0.1), (k % 7 + 0.1, k % 5 - r)]
    shapes = [(k, [ring(k, 0.9), ring(k, 0.4)]) for k in range(20)]
    spark.createDataFrame(shapes, "gid long, rings array<array<struct<x:double,y:double>>>").coalesce(1).write.parquet(f"file://{tmp_path}/polys")
    spark.range(3000).selectExpr("id AS pid", "(id % 83) / 11.0D AS x", "(id % 61) / 11.0D AS y").write.parquet(f"file://{tmp_path}/pts")
    polys, pts = spark.read.parquet(f"file://{tmp_path}/polys"), spark.read.parquet(f"file://{tmp_path}/pts")
    df = joins.points_in_polygons(pts, polys, "pid", "gid", 0.1)
    assert "Broadcast" not in plan_of(df)
    assert "Join" not in plan_of(joins.polygon_cells(polys, "gid", 0.1)[1])

    def inside(x, y, rings):
        return sum((b > y) != (d > y) and x < (c - a) * (y - b) / (d - b) + a for r in rings for (a, b), (c, d) in zip(r, r[1:] + r[:1], strict=True)) % 2

    assert sorted((r.pid, r.gid) for r in df.collect()) == [(k, g) for k in range(3000) for g, rings in shapes if inside(k % 83 / 11.0, k % 61 / 11.0, rings)]
