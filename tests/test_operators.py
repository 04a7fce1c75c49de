import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from pelagia.operators import climatology, dedup, features, joins, ordered, stats
from pelagia.plans import labels, outlook
from pelagia.queries import load
from pelagia.sources import readers, sinks
from pelagia.session import fresh_path
from pelagia.streaming import jobs

D = dt.date


def test_climatology_wraps_and_ignores_missing(spark):
    rows = [("a", D(y, 12, 31), 10.0 + y % 3) for y in (2019, 2020, 2021)] + [("a", D(y, 1, 2), 20.0) for y in (2020, 2021, 2022)]
    rows += [("b", D(2020, 5, 1), 1.0), ("c", D(2020, 5, 1), float("nan")), (None, D(2020, 5, 1), 3.0)]
    df = spark.createDataFrame(rows, "entity string, date date, value double").withColumn("value", F.when(~F.isnan("value"), F.col("value")))
    got = {(r.entity, r.doy): r for r in climatology.doy_climatology(df, "entity", "value", "x").collect()}
    assert {e for e, _ in got} == {"a"}
    vals = [v for e, d, v in rows if e == "a"]
    r = got[("a", 1)]
    assert r.x_n == 6 and r.x_years == 4 and r.x_norm == pytest.approx(statistics.mean(vals)) and r.x_sd == pytest.approx(statistics.stdev(vals))


def test_neighbours_and_totals_match_plain_windows(spark):
    rnd = random.Random(3)
    t0 = dt.datetime(2026, 1, 1)
    rows = [("hot" if rnd.random() < 0.5 else f"k{rnd.randrange(4)}", t0 + dt.timedelta(minutes=rnd.randrange(9000)), n, float(rnd.randrange(100))) for n in range(800)]
    df = spark.createDataFrame(rows, "key string, ts timestamp, id int, v double").withColumn("day", F.to_date("ts"))
    got = {r.id: r for r in ordered.with_neighbours(df, ["key"], ["ts", "id"], ["v"], "ts", 3600, following=True).collect()}
    cum = {r.id: r.cum_v for r in ordered.running_totals(df, ["key"], ["ts", "id"], ["v"], "day").collect()}
    for key in {r[0] for r in rows}:
        seq = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        total = 0.0
        for n, r in enumerate(seq):
            total += r[3]
            assert got[r[2]].prev_v == (seq[n - 1][3] if n else None) and got[r[2]].next_v == (seq[n + 1][3] if n + 1 < len(seq) else None)
            assert cum[r[2]] == pytest.approx(total)


def test_tide_day_with_one_extremum_borrows_the_closer_neighbour(spark):
    rows = [("s", dt.datetime(2026, 1, 1, 4), 1.0, "L"), ("s", dt.datetime(2026, 1, 1, 20), 5.0, "H"), ("s", dt.datetime(2026, 1, 2, 12), 2.0, "L"), ("s", dt.datetime(2026, 1, 3, 2), 4.5, "H"), ("s", dt.datetime(2026, 1, 3, 14), 1.0, "L")]
    df = spark.createDataFrame(rows, "tide_station string, ts timestamp, v double, type string")
    plain = {r.date for r in features.tide_features(df).collect()}
    wide = {r.date: r for r in features.tide_features(df, widen=True).collect()}
    assert D(2026, 1, 2) not in plain and len(plain) == 2
    r = wide[D(2026, 1, 2)]
    assert r.tide_window_widened and r.tide_range_ft == 2.5 and r.tide_exchanges == 1 and r.first_high_hour == 2
    assert wide[D(2026, 1, 1)].best_water_hour == 12.0 and wide[D(2026, 1, 1)].max_exchange_rate_ft_h == 0.25


def test_merge_policies_and_append_only(spark):
    old = spark.createDataFrame([("a", 1, 1.0), ("b", 1, 2.0)], "k string, d int, v double")
    new = spark.createDataFrame([("a", 1, 9.0), ("c", 1, 3.0)], "k string, d int, v double")
    first = {r.k: r.v for r in dedup.merge_keep(old, new, ["k", "d"], "old").collect()}
    last = {r.k: r.v for r in dedup.merge_keep(old, new, ["k", "d"], "new").collect()}
    assert first == {"a": 1.0, "b": 2.0, "c": 3.0} and last == {"a": 9.0, "b": 2.0, "c": 3.0}
    path = fresh_path(spark, "t")
    rows = spark.createDataFrame([("x", D(2026, 1, 5)), ("y", D(2026, 2, 5))], "raw_id string, report_date date")
    sinks.append_versions(spark, rows, path, "raw_id", "report_date")
    sinks.append_versions(spark, rows.unionByName(spark.createDataFrame([("z", D(2026, 2, 6))], rows.schema)), path, "raw_id", "report_date")
    assert sorted(r.raw_id for r in spark.read.parquet(path).collect()) == ["x", "y", "z"]


def test_polygon_with_hole(spark):
    square = lambda a, b: [(a, a), (b, a), (b, b), (a, b)]
    polys = spark.createDataFrame([(1, "Above", 40.0, [square(0.0, 10.0), square(4.0, 6.0)]), (2, "Below", 50.0, [square(8.0, 12.0)])], "pid int, cat string, prob double, rings array<array<struct<x:double,y:double>>>")
    pts = spark.createDataFrame([(1, 1.0, 1.0), (2, 5.0, 5.0), (3, 9.0, 9.0), (4, 20.0, 1.0)], "id int, x double, y double")
    got = {r.id: (r.cat, r.prob) for r in joins.sample_outlook(pts, polys, "id", "pid", 1.5).collect()}
    assert got == {1: ("Above", 40.0), 2: ("EC", 33.3), 3: ("Below", 50.0), 4: ("EC", 33.3)}


@pytest.mark.parametrize("cell", [0.07, 0.5, 30.0])
def test_polygon_cells_give_the_even_odd_rule(spark, cell):
    rng = random.Random(2)
    shapes = [(99, [[(-2.0, -2.0), (2.0, -2.0), (2.0, 2.0), (-2.0, 2.0)], [(-1.0, -1.0), (1.0, -1.0), (1.0, 1.0), (-1.0, 1.0)]])]
    for k in range(25):
        cx, cy, r, n = rng.uniform(-3, 3), rng.uniform(-3, 3), rng.choice([0.02, 0.3, 1.0, 2.0]), rng.randrange(3, 30)
        star = lambda s: [(cx + r * s * rng.uniform(0.5, 1) * math.cos(2 * math.pi * i / n), cy + r * s * rng.uniform(0.5, 1) * math.sin(2 * math.pi * i / n)) for i in range(n)]
        shapes.append((k, [star(1)] + ([star(0.4)] if k % 2 else [])))
    pts = [(k, rng.uniform(-4, 4), rng.uniform(-4, 4)) for k in range(1500)]

    def inside(x, y, rings):
        return sum((y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 for r in rings for (x1, y1), (x2, y2) in zip(r, r[1:] + r[:1])) % 2

    polys = spark.createDataFrame(shapes, "gid int, rings array<array<struct<x:double,y:double>>>")
    odd = [(-1, None, 1.0), (-2, float("nan"), 0.0), (-3, float("inf"), 0.0), *pts[:40]]
    got = [tuple(r) for r in joins.points_in_polygons(spark.createDataFrame(pts + odd, "pid long, x double, y double"), polys, "pid", "gid", cell).collect()]
    assert len(got) == len(set(got)) and set(got) == {(i, k) for i, x, y in pts for k, r in shapes if inside(x, y, r)}
    whole, edges = joins.polygon_cells(polys, "gid", cell)
    assert (whole.count() > 0) == (cell < 1) and edges.groupBy("gid", "_i", "_j").agg({"_n": "max", "*": "count"}).where("`max(_n)` <> `count(1)`").isEmpty()


def shuffled_rows(spark, action):
    """Rows that the stages of an action wrote to shuffles."""
    store, none = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway.new_array(spark._jvm.double, 0)
    def total():
        it, n = store.stageList(None, False, False, none, None).iterator(), {}
        while it.hasNext():
            s = it.next()
            n[s.stageId(), s.attemptId()] = s.shuffleWriteRecords()
        return n
    before = total()
    action()
    return sum(n for k, n in total().items() if k not in before)


def test_points_in_many_polygons_shuffle_no_pairs(spark):
    ring = lambda r: [[(-r, -r), (r, -r), (r, r), (-r, r)]]
    polys = spark.createDataFrame([(k, ring(1.0 + k / 1000)) for k in range(200)], "gid int, rings array<array<struct<x:double,y:double>>>")
    pts = spark.createDataFrame([(k, (k % 40) / 21 - 0.9, (k // 40) / 21 - 0.9) for k in range(1600)], "pid long, x double, y double")
    found = []
    rows = shuffled_rows(spark, lambda: found.append(joins.points_in_polygons(pts, polys, "pid", "gid", 2.0).count()))
    assert found == [sum(abs(x) < r and abs(y) < r for k in range(1600) for x, y in [((k % 40) / 21 - 0.9, (k // 40) / 21 - 0.9)] for r in [1.0 + k / 1000 for k in range(200)])]
    assert rows < found[0] / 10


def test_points_in_a_polygon_whose_edges_pass_through_cell_corners(spark):
    x, y, r = 2.9, 2.02, 0.76
    rings = [[(x + a * r * k, y + b * r * k) for a, b in ((1, 0), (0, 1), (-1, 0), (0, -1))] for k in (1.0, 0.5)]
    rng = random.Random(2)
    pts = [(n, 2.0 + 1.8 * rng.random(), 1.2 + 1.6 * rng.random()) for n in range(4000)]
    inside = lambda px, py: sum((b > py) != (d > py) and px < (c - a) * (py - b) / (d - b) + a for g in rings for (a, b), (c, d) in zip(g, g[1:] + g[:1])) % 2
    polys = spark.createDataFrame([(29, rings)], "gid int, rings array<array<struct<x:double,y:double>>>")
    got = joins.points_in_polygons(spark.createDataFrame(pts, "pid long, x double, y double"), polys, "pid", "gid", 0.1).collect()
    assert sorted(g.pid for g in got) == [n for n, px, py in pts if inside(px, py)]


@pytest.mark.parametrize("block_rows", [10**6, 300])
def test_running_totals_of_a_hot_key_and_day(spark, block_rows):
    rng = random.Random(9)
    rows = [("hot", 5, n // 3, n, rng.randrange(-5, 9)) for n in range(4000)] + [(k, d, 0, 10**6 + n, n % 4) for n, (k, d) in enumerate((k, d) for k in ("a", "hot", "z") for d in (1, 5, 9) for _ in range(40))]
    rng.shuffle(rows)
    rows.append(("a", 1, 0, 5 * 10**6, None))
    df = spark.createDataFrame(rows, "k string, day int, t int, id int, v int")
    got = {r.id: r.cum_v for r in ordered.running_totals(df, ["k"], ["day", "t", "id"], ["v"], "day", block_rows).collect()}
    want, total = {}, {}
    for k, _, _, n, v in sorted(rows, key=lambda r: r[:4]):
        total[k] = total.get(k, 0) + (v or 0)
        want[n] = total[k]
    assert got == want
    if block_rows == 300:
        blocks = ordered.range_blocks(df, ["k"], ["day", "t", "id"], 300)
        sizes = blocks.where("k = 'hot' and day = 5").groupBy("_block").count().collect()
        assert len(sizes) > 8 and max(r["count"] for r in sizes) < 1200


def test_nearest_node_is_exact_at_cell_edges_and_beyond_the_axis(spark):
    rng = random.Random(4)
    axes = {"a": [10.0 + 0.25 * k for k in range(9)], "b": sorted(rng.uniform(11, 15) for _ in range(12)), "c": [12.0], "d": [10.0, 11.0, 18.0]}
    targets = [(k, rng.uniform(5, 25)) for k in range(200)] + [(1000 + k, 10.0 + 0.125 * k) for k in range(40)] + [(2000, None), (2001, float("nan"))]
    grid = spark.createDataFrame([(d, v, n) for d, vs in axes.items() for n, v in enumerate(vs)] * 2 + [("a", None, 99)], "date string, v double, idx int")
    places = spark.createDataFrame(targets, "id int, t double")
    got = {(r.date, r.id): r.n for r in joins.nearest_node(grid, "date", "v", "idx", places, "id", "t", "n").collect()}
    want = {(d, i): min(range(len(vs)), key=lambda n: (abs(vs[n] - t), n)) for d, vs in axes.items() for i, t in targets if t is not None and t == t}
    assert got == want


def test_fallback_chain_and_products(spark):
    zones = spark.createDataFrame([("z1", ["a", "b"]), ("z2", ["c"])], "zone string, chain array<string>")
    clim = spark.createDataFrame([("a", 1, None, 5.0), ("b", 1, 2.0, 6.0), ("r", 1, 3.0, 7.0)], "station string, doy int, wind double, wave double")
    got = {r.zone: r for r in joins.fallback_chain(zones, clim, "zone", "chain", "station", "doy", {"wave": ["wave"], "wind": ["wind"]}, {"wind": "r"}).collect()}
    assert (got["z1"].wave_station, got["z1"].wave, got["z1"].wind_station, got["z1"].wind) == ("a", 5.0, "b", 2.0)
    assert got["z2"].wave is None and got["z2"].wind == 3.0 and got["z2"].wind_is_regional
    p = outlook.product_table(spark.createDataFrame([("cpc_814_temp", "Above", 40.0), ("cpc_month_temp", "Below", 50.0)], "product string, cat string, prob double"))
    by = {r.lead_days: r.product for r in joins.product_by_lead(p).collect()}
    assert by[7] == by[14] == "cpc_814_temp" and by[15] == by[30] == "cpc_month_temp"


def test_band_never_narrows(spark):
    rows = [("z", "s", lead, 50.0, 50.0 - w, 50.0 + w) for lead, w in ((7, 5.0), (8, 3.0), (9, 8.0), (10, 1.0))] + [("z", "t", 7, 97.0, 90.0, 99.0), ("z", "t", 8, 98.0, 97.0, 99.0)]
    df = spark.createDataFrame(rows, "zone_id string, species_id string, lead_days int, score_outlook double, score_lo double, score_hi double")
    out = outlook.ratchet_band(df).orderBy("species_id", "lead_days").collect()
    assert [r.score_halfband_lo_pts for r in out if r.species_id == "s"] == [5.0, 5.0, 8.0, 8.0]
    assert all(r.score_hi <= 99.9 for r in out) and [r.score_band_is_ratcheted for r in out if r.species_id == "s"] == [False, True, False, True]


def test_bootstrap_sign_and_floor(spark):
    rows = [(D(2026, 1, 1) + dt.timedelta(days=n), 1, n % 2, 95.0 if n % 2 else 5.0, 50.0, "g") for n in range(30)] + [(D(2026, 1, 1), 1, 1, 90.0, 50.0, "few")]
    df = spark.createDataFrame(rows, "target_date date, lead_days int, y_good int, m double, r double, g string").withColumnsRenamed({"m": "score__m", "r": "score__r"})
    out = {r.g: r for r in stats.block_bootstrap(df, "m", "r", ["g"], reps=50).collect()}
    assert set(out) == {"g"} and out["g"].p_positive == 1.0 and out["g"].p05 > 0


def test_station_text_layouts(spark):
    lines = ["#YY MM", "2026 08 01 00 10 270 5.0 7.0 1.2 10 6 200 1013.2 15.5 20.0 MM MM -0.4 MM", "2026 08 01 00 20 270 99.0 7.0 1.2 10 6 200 1013.2 15.5 20.0 MM MM MM", "2026 08 01", "2026 13 01 00 20 270 5 7.0 1.2 10 6 200 1013.2 15.5 20.0 MM MM MM"]
    df = spark.createDataFrame([(x,) for x in lines], "line string").withColumn("station", F.lit("s"))
    got = readers.parse_station_lines(df, "line", ["station"]).orderBy("ts").collect()
    assert [r.WSPD for r in got] == [5.0, None] and [r.WTMP for r in got] == [20.0, 20.0]


def test_stream_dedup_and_status(spark):
    t = dt.datetime(2026, 1, 1)
    src, ck, out = (fresh_path(spark, n) for n in ("src", "ck", "out"))
    schema = "station string, ts timestamp, v double"
    spark.createDataFrame([("a", t, 1.0), ("b", t, 2.0)], schema).coalesce(1).write.parquet(src)
    run = lambda: jobs.run_available(jobs.deduplicated(jobs.stream_table(spark, src, spark.read.parquet(src).schema), ["station", "ts"], "ts", "1 hour"), ck, path=out)
    run()
    spark.createDataFrame([("a", t, 1.0), ("a", t + dt.timedelta(minutes=10), 3.0)], schema).coalesce(1).write.mode("append").parquet(src)
    run()
    assert spark.read.parquet(out).count() == 3
    path = fresh_path(spark, "status")
    write = jobs.freshness_sink(spark, path)
    a = "source_identifier string, attempted_utc timestamp, success boolean, newest timestamp"
    write(spark.createDataFrame([("s", t, True, t)], a), 0)
    write(spark.createDataFrame([("s", t + dt.timedelta(days=1), False, None)], a), 1)
    r = jobs.latest_version(spark, path).first()
    assert r.last_successful_fetch_utc == t and r.last_attempted_fetch_utc == t + dt.timedelta(days=1)


def test_newest_issuance_of_every_target_and_the_one_before(spark):
    from pelagia.plans.changes import newest_two
    rows = spark.createDataFrame([(t, "z", "s", 20 - lead, f"I{20 - lead:02d}") for t, leads in (("a", (0, 5, 9)), ("b", (14, 21)), ("c", (2,))) for lead in leads],
                                 "target_date string, zone_id string, species_id string, issue_utc int, issuance_id string")
    now, was = ({r.target_date: r.issuance_id for r in x.collect()} for x in newest_two(rows))
    assert now == {"a": "I20", "b": "I06", "c": "I18"} and was == {"a": "I15", "b": "I-1"}


def test_gate_query_returns_every_check(spark):
    from pelagia.queries import load
    checks = [r.check_name for r in load()["a22_challenger_gate_all"].build(spark, "/root/testdata/sf0.001").collect()]
    assert checks.count("bootstrap confidence") == 1 and "minimum sample" in checks


def test_a_part_type_without_parameters_is_an_error(spark, tmp_path):
    from pelagia.queries import inputs
    for t in ("nation", "region"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    part.unionByName(part.limit(1).withColumn("p_type", F.lit("SEVENTH"))).write.parquet(f"{tmp_path}/part.parquet")
    assert inputs.subjects(spark, "/root/testdata/sf0.001").count() == part.select("p_type").distinct().count()
    with pytest.raises(ValueError, match="SEVENTH"):
        inputs.subjects(spark, str(tmp_path))


def test_analog_years_before_1950_count_as_in_the_sql(spark, tmp_path):
    rows = [(dt.datetime(y, m, 3), p) for y, p in ((1940, 200.0), (1990, 50.0), (2000, 200.0), (2001, 210.0)) for m in range(1, 7)]
    spark.createDataFrame(rows, "o_orderdate timestamp, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    assert sorted(r.year for r in load()["a12_analog_years"].build(spark, str(tmp_path)).collect()) == [1940, 2000]


def test_daily_catch_gathers_no_set_for_each_trip(spark):
    day, at = D(2026, 8, 1), dt.datetime(2026, 8, 2)
    rows = [("r", "s", k, 2.0, 4.0, 3.0, 1.0, day, 0, at, m, False, f) for k, m, f in (("t1", "live", None), ("t1", "backfill", "x"), ("t2", "live", None), (None, "live", None))]
    agg = spark.createDataFrame(rows, "region_id string, species_id string, trip_key string, anglers double, angler_days double, kept double, released double, report_date date, "
                                "lag int, fetched timestamp, method string, multi_day boolean, flag string").withColumn("fishing_date", F.col("report_date"))
    out = labels.daily_catch(agg)
    r = out.first()
    assert (r.n_trips, r.n_raw, r.anglers, r.fish_total, r.methods, r.flags, r.report_dates) == (2, 4, 8.0, 16.0, "backfill;live", "x", "2026-08-01")
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert not [line for line in plan.splitlines() if "ObjectHashAggregate" in line and "trip_key" in line]


def test_metrics_count_dates_and_issuances_without_expanding_rows(spark):
    rows = [(k, D(2026, 8, d), f"i{d % 2}" if d != 3 else None, 50.0 + d, 60.0, 2, 1, 3) for k in ("a", None) for d in (1, 1, 2, 3)]
    df = spark.createDataFrame(rows, "k string, target_date date, issuance_id string, score double, observed_score double, obs_idx int, y_good int, lead_days int")
    out = stats.metrics(df, ["k"])
    assert {(r.k, r.n_pairs, r.n_target_dates, r.n_issuances, r.mae, r.n_obs_good) for r in out.collect()} == {(k, 4, 3, 2, 8.25, 4) for k in ("a", None)}
    assert "Expand" not in out._jdf.queryExecution().sparkPlan().toString()
