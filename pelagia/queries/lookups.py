"""Dedup, set, preference and spatial lookup queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dedup, joins
from ..operators import ordered as od
from ..plans import dashboard as db
from ..plans import quality as ql
from . import inputs as i
from .registry import query
from .sqlparts import part


@query("w04_latest_per_entity", "user_id l, event_type s, ts z, value d4", """
  SELECT user_id, event_type, ts, value FROM events WHERE ts <= TIMESTAMP '2024-01-20 00:00:00' QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def latest(spark, sf):
    e = i.events(spark, sf).select("event_id", "user_id", "event_type", "ts", "value")
    return dedup.latest_per_key(e, ["user_id", "event_type"], "ts", ["event_id"], not_after=F.lit("2024-01-20 00:00:00").cast("timestamp"))


def _loads(spark, sf):
    d = i.events(spark, sf).groupBy("user_id", F.to_date("ts").alias("date")).agg(F.sum("value").alias("total"), F.count(F.lit(1)).alias("n"))
    old = d.where(F.dayofmonth("date") <= 20).select("user_id", "date", (F.col("total") * 2).alias("total"))
    return old, d.where(F.dayofmonth("date") >= 10).select("user_id", "date", "total")


part("p_load", "SELECT user_id, CAST(ts AS DATE) AS date, sum(value) AS total FROM events GROUP BY 1, 2")


@query("u02_union_keep_first", "user_id l, date t, total d4", "SELECT user_id, date, CASE WHEN day(date) <= 20 THEN total * 2 ELSE total END AS total FROM p_load")
def keep_first(spark, sf):
    return dedup.merge_keep(*_loads(spark, sf), ["user_id", "date"], "old")


@query("u03_union_keep_last", "user_id l, date t, total d4", "SELECT user_id, date, CASE WHEN day(date) >= 10 THEN total ELSE total * 2 END AS total FROM p_load")
def keep_last(spark, sf):
    return dedup.merge_keep(*_loads(spark, sf), ["user_id", "date"], "new")


@query("j17_unseen_keys", "o_orderkey l", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def unseen(spark, sf):
    stored = i.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return dedup.unseen(i.table(spark, sf, "orders").select("o_orderkey"), stored, "o_orderkey")


@query("j18_semi_join_listed", "o_orderkey l, o_totalprice d2", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def listed(spark, sf):
    r = i.table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return i.table(spark, sf, "orders").join(r, "o_orderkey", "left_semi")


@query("u07_key_difference", "c_custkey l", """
  SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'""")
def difference(spark, sf):
    c, o = i.table(spark, sf, "customer").select("c_custkey"), i.table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return dedup.lost_rows(c, o, ["c_custkey"])


@query("u08_distinct_dates", "date t, n l", "SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders GROUP BY 1")
def dates(spark, sf):
    return db.count_by(i.table(spark, sf, "orders").withColumn("date", F.to_date("o_orderdate")), "date")


@query("u10_first_request_per_page", "page_date t, request_date t, is_stale b", """
  SELECT page_date, min(request_date) AS request_date, min(request_date) <> page_date AS is_stale FROM (
    SELECT CAST(l_shipdate AS DATE) AS page_date, CAST(l_shipdate AS DATE) + CAST(l_linenumber - 1 AS INT) AS request_date FROM lineitem) GROUP BY 1""")
def first_request(spark, sf):
    p = i.table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("page_date"), F.date_add(F.to_date("l_shipdate"), F.col("l_linenumber") - 1).alias("request_date"))
    return dedup.first_request_per_page(p, "page_date", "request_date")


@query("j02_full_outer_fill", "zone_id s, date t, a d4, b d4", """
  SELECT coalesce(s.zone_id, c.zone_id) AS zone_id, coalesce(s.date, c.date) AS date, s.sst_f AS a, c.chl_mg_m3 AS b FROM p_satellite s FULL JOIN p_chl c ON s.zone_id = c.zone_id AND s.date = c.date""")
def outer(spark, sf):
    return joins.full_outer(i.satellite(spark, sf).withColumnRenamed("sst_f", "a"), i.chlorophyll(spark, sf).withColumnRenamed("chl_mg_m3", "b"), ["zone_id", "date"])


@query("j19_overlap_bridge", "species_id s, tide_station s", "SELECT DISTINCT s.species_id, z.tide_station FROM p_subjects s JOIN p_zones z USING (zone_id)")
def overlap(spark, sf):
    a = joins.bridge(i.subjects(spark, sf), "species_id", "zones", "zone_id")
    return joins.overlap_bridge(a, "species_id", i.zones(spark, sf).select("tide_station", "zone_id"), "tide_station", "zone_id")


@query("j21_table_comparison", "user_id l, status s", """
  SELECT coalesce(a.user_id, b.user_id) AS user_id, CASE WHEN b.user_id IS NULL THEN 'removed' WHEN a.user_id IS NULL THEN 'added' WHEN a.n <> b.n THEN 'changed' ELSE 'same' END AS status
  FROM (SELECT user_id, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1) a FULL JOIN (SELECT user_id, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY 1) b USING (user_id)""")
def comparison(spark, sf):
    e = i.events(spark, sf)
    a = db.count_by(e.where(F.col("ts") < F.lit("2024-01-15").cast("timestamp")), "user_id").withColumnRenamed("n", "na")
    b = db.count_by(e.where("event_type <> 'error'"), "user_id").withColumnRenamed("n", "nb")
    return joins.full_outer(a, b, ["user_id"]).withColumn("status", F.when(F.col("nb").isNull(), "removed").when(F.col("na").isNull(), "added").when(
        F.col("na") != F.col("nb"), "changed").otherwise("same"))


# spatial: the first two embedding coordinates are points; polygons are diamonds around each label's centre, with a hole
part("p_centres", "SELECT label AS polygon_id, avg(embedding[1]::DOUBLE) AS cx, avg(embedding[2]::DOUBLE) AS cy, stddev_samp(embedding[1]::DOUBLE) AS r FROM embeddings GROUP BY 1")
part("p_polys", """SELECT polygon_id, CASE WHEN polygon_id % 2 = 0 THEN 'Above' ELSE 'Below' END AS cat, 40.0::DOUBLE + polygon_id AS prob, cx, cy, r FROM p_centres""")
part("p_edges", "SELECT polygon_id, cx + a * r AS x1, cy + b * r AS y1, cx + c * r AS x2, cy + d * r AS y2 FROM p_polys, (VALUES " + ", ".join(
    f"({a}::DOUBLE, {b}::DOUBLE, {c}::DOUBLE, {d}::DOUBLE)" for s in (1.5, 0.5) for a, b, c, d in ((s, 0, 0, s), (0, s, -s, 0), (-s, 0, 0, -s), (0, -s, s, 0))) + ") v(a, b, c, d)")
part("p_pts", "SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings")
part("p_inside", """SELECT vec_id, polygon_id FROM p_pts JOIN p_edges ON (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 GROUP BY 1, 2 HAVING count(*) % 2 = 1""")


def polygons(spark, sf):
    e = i.table(spark, sf, "embeddings")
    x, y = F.col("embedding")[0].cast("double"), F.col("embedding")[1].cast("double")
    c = e.groupBy(F.col("label").alias("polygon_id")).agg(F.avg(x).alias("cx"), F.avg(y).alias("cy"), F.stddev_samp(x).alias("r"))
    ring = lambda s: F.array(*[F.struct((F.col("cx") + a * s * F.col("r")).alias("x"), (F.col("cy") + b * s * F.col("r")).alias("y")) for a, b in ((1, 0), (0, 1), (-1, 0), (0, -1))])
    return c.select("polygon_id", F.when(F.col("polygon_id") % 2 == 0, "Above").otherwise("Below").alias("cat"), (F.lit(40.0) + F.col("polygon_id")).alias("prob"),
                    F.array(ring(1.5), ring(0.5)).alias("rings"))


def points(spark, sf):
    return i.table(spark, sf, "embeddings").select("vec_id", F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))


@query("j11_point_in_polygon", "vec_id l, polygon_id i", "SELECT * FROM p_inside")
def in_polygon(spark, sf):
    return joins.points_in_polygons(points(spark, sf), polygons(spark, sf), "vec_id", "polygon_id", 0.05)


# many polygons: a diamond with a hole for each supplier, and a point for each order
part("p_parcels", "SELECT s_suppkey, (s_suppkey % 97) / 10.0::DOUBLE AS cx, (s_acctbal + 1000) / 1100 AS cy, 0.2::DOUBLE + s_nationkey / 25.0::DOUBLE AS r FROM supplier")
part("p_parcel_edges", "SELECT s_suppkey, cx + a * r AS x1, cy + b * r AS y1, cx + c * r AS x2, cy + d * r AS y2 FROM p_parcels, (VALUES " + ", ".join(
    f"({a}::DOUBLE, {b}::DOUBLE, {c}::DOUBLE, {d}::DOUBLE)" for s in (1.0, 0.5) for a, b, c, d in ((s, 0, 0, s), (0, s, -s, 0), (-s, 0, 0, -s), (0, -s, s, 0))) + ") v(a, b, c, d)")


def parcels(spark, sf):
    s = i.table(spark, sf, "supplier").select("s_suppkey", ((F.col("s_suppkey") % 97) / 10.0).alias("cx"), ((F.col("s_acctbal") + 1000) / 1100).alias("cy"),
                                              (F.lit(0.2) + F.col("s_nationkey") / 25.0).alias("r"))
    ring = lambda k: F.array(*[F.struct((F.col("cx") + a * k * F.col("r")).alias("x"), (F.col("cy") + b * k * F.col("r")).alias("y")) for a, b in ((1, 0), (0, 1), (-1, 0), (0, -1))])
    return s.select("s_suppkey", F.array(ring(1.0), ring(0.5)).alias("rings"))


@query("j11_orders_in_parcels", "o_orderkey l, s_suppkey l", """
  SELECT o_orderkey, s_suppkey FROM (SELECT o_orderkey, o_totalprice / 50000 AS x, (o_custkey % 1000) / 100.0::DOUBLE + o_totalprice / 1e6::DOUBLE AS y FROM orders) p
  JOIN p_parcel_edges ON (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 GROUP BY 1, 2 HAVING count(*) % 2 = 1""")
def orders_in_parcels(spark, sf):
    at = i.table(spark, sf, "orders").select("o_orderkey", (F.col("o_totalprice") / 50000).alias("x"), (F.col("o_custkey") % 1000 / 100.0 + F.col("o_totalprice") / 1e6).alias("y"))
    return joins.points_in_polygons(at, parcels(spark, sf), "o_orderkey", "s_suppkey", 0.1)


@query("s14_polygon_outlook_sample", "vec_id l, cat s, prob d1", """
  SELECT p.vec_id, coalesce(b.cat, 'EC') AS cat, coalesce(b.prob, 33.3) AS prob FROM p_pts p LEFT JOIN (
    SELECT vec_id, cat, prob FROM p_inside JOIN p_polys USING (polygon_id) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY prob DESC, cat DESC) = 1) b USING (vec_id)""")
def outlook_sample(spark, sf):
    return joins.sample_outlook(points(spark, sf), polygons(spark, sf), "vec_id", "polygon_id", 0.05)


# grid: nations (rows) x part sizes (columns) per order year, mean value in each cell
part("p_grid", """SELECT CAST(make_date(year(l_shipdate), 1, 1) AS DATE) AS date, n_nationkey AS lat_idx, p_size AS lon_idx, 30 + 0.05 * n_nationkey::DOUBLE AS latitude, -118 + 0.05 * p_size::DOUBLE AS longitude,
  sum(CAST(l_quantity AS BIGINT)) / count(*) AS sst_c FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3, 4, 5""")
part("p_sites", "SELECT n_name AS zone_id, 30.02 + 0.05 * n_nationkey::DOUBLE AS lat, -117.98 + 0.1 * n_nationkey::DOUBLE AS lon FROM nation")
part("p_grad", """SELECT *, CASE WHEN fr AND lr THEN NULL WHEN fr THEN nr - sst_c WHEN lr THEN sst_c - pr ELSE (nr - pr) / 2 END AS d_row, CASE WHEN fc AND lc THEN NULL WHEN fc THEN nc - sst_c WHEN lc THEN sst_c - pc ELSE (nc - pc) / 2 END AS d_col
  FROM (SELECT *, lag(sst_c) OVER r AS pr, lead(sst_c) OVER r AS nr, lag(1) OVER r IS NULL AS fr, lead(1) OVER r IS NULL AS lr, lag(sst_c) OVER c AS pc, lead(sst_c) OVER c AS nc, lag(1) OVER c IS NULL AS fc, lead(1) OVER c IS NULL AS lc
    FROM p_grid WINDOW r AS (PARTITION BY date, lon_idx ORDER BY lat_idx), c AS (PARTITION BY date, lat_idx ORDER BY lon_idx))""")


def grid(spark, sf):
    li = i.table(spark, sf, "lineitem").select("l_suppkey", "l_partkey", F.make_date(F.year("l_shipdate"), F.lit(1), F.lit(1)).alias("date"), F.col("l_quantity").cast("bigint").alias("q"))
    sup = i.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("lat_idx"))
    pt = i.table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_size").alias("lon_idx"))
    g = li.join(sup, "l_suppkey").join(pt, "l_partkey").groupBy("date", "lat_idx", "lon_idx").agg((F.sum("q") / F.count(F.lit(1))).alias("sst_c"))
    return g.withColumns({"latitude": 30 + 0.05 * F.col("lat_idx").cast("double"), "longitude": -118 + 0.05 * F.col("lon_idx").cast("double")})


def sites(spark, sf):
    k = F.col("n_nationkey").cast("double")
    return i.table(spark, sf, "nation").select(F.col("n_name").alias("zone_id"), (30.02 + 0.05 * k).alias("lat"), (-117.98 + 0.1 * k).alias("lon"))


@query("w09_grid_gradient", "date t, lat_idx i, lon_idx i, d_row d5, d_col d5", "SELECT * FROM p_grad")
def grid_gradient(spark, sf):
    return joins.gradient(grid(spark, sf), "sst_c")


@query("a26_box_median", "zone_id s, date t, median_value d5", """
  SELECT zone_id, date, median(sst_c) AS median_value FROM p_grid JOIN p_sites ON abs(latitude - lat) < 0.12 AND abs(longitude - lon) < 0.12 GROUP BY 1, 2""")
def median_in_box(spark, sf):
    return joins.box_median(grid(spark, sf), sites(spark, sf), "zone_id", "sst_c", "median_value")


@query("a25_front_strength", "zone_id s, date t, front_f_per_nm d5, front_mean_f_per_nm d5, sst_spread_f d4", """
  WITH axes AS (SELECT date, (max(latitude) - min(latitude)) / (count(DISTINCT latitude) - 1) * 60 AS h, (max(longitude) - min(longitude)) / (count(DISTINCT longitude) - 1) * 60 * cos(radians(avg(latitude))) AS w FROM p_grid GROUP BY 1),
  rowsat AS (SELECT DISTINCT date, zone_id, first_value(lat_idx) OVER (PARTITION BY date, zone_id ORDER BY abs(latitude - lat), lat_idx) AS iy FROM (SELECT DISTINCT date, lat_idx, latitude FROM p_grid), p_sites),
  colsat AS (SELECT DISTINCT date, zone_id, first_value(lon_idx) OVER (PARTITION BY date, zone_id ORDER BY abs(longitude - lon), lon_idx) AS ix FROM (SELECT DISTINCT date, lon_idx, longitude FROM p_grid), p_sites)
  SELECT zone_id, g.date, max(sqrt(power(d_row / h, 2) + power(d_col / w, 2)) * 1.8) AS front_f_per_nm, avg(sqrt(power(d_row / h, 2) + power(d_col / w, 2)) * 1.8) AS front_mean_f_per_nm, (max(sst_c) - min(sst_c)) * 1.8 AS sst_spread_f
  FROM rowsat JOIN colsat USING (date, zone_id) JOIN p_grad g ON g.date = rowsat.date AND g.lat_idx BETWEEN iy - 8 AND iy + 8 AND g.lon_idx BETWEEN ix - 8 AND ix + 8 JOIN axes ON axes.date = g.date
  GROUP BY 1, 2 HAVING max(sqrt(power(d_row / h, 2) + power(d_col / w, 2))) IS NOT NULL""")
def front_strength(spark, sf):
    return joins.front_strength(grid(spark, sf), sites(spark, sf), "zone_id")


@query("w13_neighbours_across_buckets", "user_id l, event_id l, prev_value d4, next_value d4", """
  SELECT user_id, event_id, lag(value) OVER w AS prev_value, lead(value) OVER w AS next_value FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def neighbours(spark, sf):
    return od.with_neighbours(i.events(spark, sf), ["user_id"], ["ts", "event_id"], ["value"], "ts", 6 * 3600, following=True)


@query("w14_running_totals", "event_type s, event_id l, cum_value d3", """
  SELECT event_type, event_id, sum(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS cum_value FROM events""")
def totals(spark, sf):
    e = i.events(spark, sf).select("event_type", "event_id", "ts", "value", F.to_date("ts").alias("day"))
    return od.running_totals(e, ["event_type"], ["ts", "event_id"], ["value"], "day")


@query("d09_snapshot_date", "snapshot_date t", "SELECT min(date) AS snapshot_date FROM (SELECT DISTINCT date FROM p_satellite ORDER BY date DESC LIMIT 7)")
def snapshot(spark, sf):
    return ql.snapshot_date(i.satellite(spark, sf))


@query("o06_custom_order", "part_size_band s, position i, n l", """
  SELECT p_type AS part_size_band, coalesce(nullif(list_position(['SMALL', 'MEDIUM', 'LARGE'], p_type), 0), 4) AS position, count(*) AS n FROM part GROUP BY 1""")
def custom_order(spark, sf):
    d = db.count_by(i.table(spark, sf, "part").withColumnRenamed("p_type", "part_size_band"), "part_size_band")
    return d.withColumn("position", db.custom_order(d, "part_size_band", ["SMALL", "MEDIUM", "LARGE"])).orderBy("position", "part_size_band")


@query("f11_text_search", "p_partkey l, p_name s", "SELECT p_partkey, p_name FROM part WHERE contains(lower(concat_ws(' ', p_partkey, p_name, p_brand)), 'blue')")
def search(spark, sf):
    return db.search_dictionary(i.table(spark, sf, "part").select("p_partkey", "p_name", "p_brand"), "Blue")
