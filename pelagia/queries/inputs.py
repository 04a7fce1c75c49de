"""Domain-shaped inputs derived from the driver tables.

Nations act as zones, regions as shore, tide and buoy stations, part types as subjects, line items as
observations, orders as trips. Sums are taken over integers (hundredths), so that results do not
depend on the order of addition. ``sqlparts`` holds the same derivations in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.conditions import build_conditions, build_scores, climatological_curve, index_table, current_index, zone_norms
from ..operators.climatology import doy_climatology
from ..session import staged

# Parameters of the six subjects (part types): temperature window, preferences, weights and season curve.
SUBJECT_ROWS = [
    # type, group, temp_ref, window, anomaly, tide, moon, swell tolerance, weights (sst..chl), season phase
    ("ECONOMY", "tuna", "surface", (50.0, 58.0, 70.0, 80.0), 0.6, "any", "post_new_moon", 6.0, (0.30, 0.20, 0.05, 0.10, 0.05, 0.10, 0.15, 0.05), 1),
    ("SMALL", "pelagic", "surface", (48.0, 56.0, 66.0, 76.0), 0.3, "strong_moving", "spring_tide", 5.0, (0.28, 0.20, 0.20, 0.05, 0.08, 0.10, 0.04, 0.05), 3),
    ("MEDIUM", "bass", "surface", (52.0, 60.0, 72.0, 82.0), 0.2, "high_pushing", "any", 4.0, (0.26, 0.22, 0.16, 0.06, 0.08, 0.14, 0.00, 0.08), 5),
    ("LARGE", "groundfish", "bottom", (38.0, 44.0, 58.0, 70.0), -0.3, "moderate", "dark_or_full_night", 8.0, (0.25, 0.15, 0.10, 0.05, 0.10, 0.25, 0.05, 0.05), 7),
    ("STANDARD", "surf", "surface", (50.0, 59.0, 69.0, 79.0), 0.0, "grey_light_moving", "none", 3.0, (0.24, 0.20, 0.22, 0.04, 0.06, 0.20, 0.00, 0.04), 9),
    ("PROMO", "flatfish", "surface", (46.0, 54.0, 68.0, 78.0), -0.5, "moving", "spring_tide", 5.0, (0.28, 0.20, 0.24, 0.05, 0.08, 0.10, 0.00, 0.05), 11),
]
TERM_NAMES = ("sst", "season", "tide", "moon", "pressure", "swell", "front", "chl")
AS_OF_DAY = "2001-06-30"


def season_curve(phase: int) -> list[float]:
    """Twelve monthly index values peaking at month ``phase``."""
    return [round(1.0 - 0.1 * min((m - phase) % 12, (phase - m) % 12), 2) for m in range(1, 13)]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def hundredths(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


MEASURES = ["n", "q", "disc", "tax", "cents"] + [f"{f}{m}" for f in "ran" for m in ("n", "q", "disc")]


def zone_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Zone-day sums, written once and shared by all queries of the application."""
    return staged(spark, sf, "zone_raw", lambda: _zone_raw(spark, sf))


def _zone_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Line items summed by nation and ship day where they are read: a supplier has few lines a day, so sums by supplier would save nothing."""
    c, qty, disc = F.col, F.col("q"), F.col("disc")
    by_flag = []
    for f in "RAN":
        here = c("l_returnflag") == f
        by_flag += [F.count_if(here).alias(f"{f.lower()}n"), F.sum(F.when(here, qty)).alias(f"{f.lower()}q"),
                    F.sum(F.when(here, disc)).alias(f"{f.lower()}disc")]
    li = table(spark, sf, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("date"), "l_returnflag", c("l_quantity").cast("bigint").alias("q"),
                                             hundredths("l_discount").alias("disc"), hundredths("l_tax").alias("tax"), hundredths("l_extendedprice").alias("cents"))
    sup = table(spark, sf, "supplier").select(c("s_suppkey").alias("l_suppkey"), "s_nationkey")
    days = li.join(sup, "l_suppkey").groupBy("s_nationkey", "date").agg(
        F.count(F.lit(1)).alias("n"), F.sum(qty).alias("q"), F.sum(disc).alias("disc"), F.sum("tax").alias("tax"), F.sum("cents").alias("cents"), *by_flag)
    nat, reg = table(spark, sf, "nation"), table(spark, sf, "region")
    place = nat.join(reg, nat.n_regionkey == reg.r_regionkey).select(c("n_nationkey").alias("s_nationkey"), c("n_name").alias("zone_id"), c("r_name").alias("region"))
    return days.join(place, "s_nationkey").groupBy("zone_id", "region", "date").agg(*[F.sum(m).alias(m) for m in MEASURES])


def region_raw(spark: SparkSession, sf: str) -> DataFrame:
    return zone_raw(spark, sf).groupBy("region", "date").agg(*[F.sum(m).alias(m) for m in MEASURES])


def _ratio(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b))


def zone_daily(spark, sf):
    return zone_raw(spark, sf).select(
        "zone_id", "date", (45.0 + 0.7937 * _ratio("q", "n")).alias("sst_f_model"), (1.1 * _ratio("disc", "n")).alias("wave_ft"),
        (5.0 + _ratio("rq", "rn") / 5.0).alias("wave_period_s"), (3.0 * _ratio("tax", "n")).alias("wind_kt"),
        (1000.0 + _ratio("cents", "n") / 400000.0).alias("pressure_hpa"))


def satellite(spark, sf):
    return zone_raw(spark, sf).where("rn > 0").select("zone_id", "date", (45.0 + 0.7937 * _ratio("rq", "rn")).alias("sst_f"))


def shore_daily(spark, sf):
    return region_raw(spark, sf).where("an >= 1").select(
        F.col("region").alias("tide_station"), "date", (45.0 + 0.7937 * _ratio("aq", "an")).alias("shore_sst_f"), F.col("an").alias("n_obs"))


def tide_daily(spark, sf):
    return region_raw(spark, sf).select(
        F.col("region").alias("tide_station"), "date", (2.0 + 0.6 * _ratio("tax", "n")).alias("tide_range_ft"),
        (_ratio("disc", "n") / 5.0).alias("max_exchange_rate_ft_h"), (0.48 * _ratio("q", "n")).alias("best_water_hour"),
        F.when(F.col("an") > 0, (F.col("q") % 24).cast("double")).alias("first_high_hour"))


def buoy_daily(spark, sf):
    return region_raw(spark, sf).select(F.col("region").alias("station"), "date", (1.1 * _ratio("disc", "n")).alias("wave_ft"),
                                        (3.0 * _ratio("tax", "n")).alias("wind_kt"))


def fronts(spark, sf):
    return zone_raw(spark, sf).where("nn > 0").select("zone_id", "date", (_ratio("ndisc", "nn") / 15.0).alias("front_f_per_nm"),
                                                     (0.5 * _ratio("nq", "nn")).alias("sst_spread_f"))


def chlorophyll(spark, sf):
    return zone_raw(spark, sf).where("an > 0").select("zone_id", "date", (0.6 * _ratio("adisc", "an")).alias("chl_mg_m3"))


def upwelling(spark, sf):
    return region_raw(spark, sf).groupBy("date").agg((F.sum("tax") / F.sum("n")).alias("cuti"))


def monthly_orders(spark, sf):
    """Sums of orders by month, written once: the index is asked for many times in a query, and each time for its months and their mean."""
    def build():
        o = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d"), hundredths("o_totalprice").alias("c"))
        return o.groupBy(F.year("d").alias("year"), F.month("d").alias("month")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n"))
    return staged(spark, sf, "monthly_orders", build)


def climate_index(spark, sf):
    """Monthly index from orders: relative departure of the month's mean value from the overall mean."""
    monthly = monthly_orders(spark, sf)
    total = monthly.agg((F.sum("c") / F.sum("n")).alias("m")).scalar()
    oni = F.round(30.0 * (F.col("c") / F.col("n") / total - 1.0), 2)
    return monthly.select(F.concat(F.lit("S"), F.lpad(F.col("month").cast("string"), 2, "0")).alias("season"), "year", "month", oni.alias("oni"))


def zones(spark, sf):
    nat, reg = table(spark, sf, "nation"), table(spark, sf, "region")
    k = F.col("n_nationkey")
    return nat.join(reg, nat.n_regionkey == reg.r_regionkey).select(
        F.col("n_name").alias("zone_id"), k.alias("zone_no"), F.col("n_regionkey").alias("region_no"), (F.col("n_regionkey") == 0).alias("inshore"),
        F.col("r_name").alias("tide_station"), F.col("r_name").alias("primary_buoy"), (2.0 * k).alias("distance_nm"),
        (20.0 + 10.0 * k).alias("depth_mid_ft"))


def subjects(spark, sf):
    return staged(spark, sf, "subjects", lambda: _subjects(spark, sf))


def _subjects(spark, sf):
    """Subjects modelled per zone: the literal parameters joined to the part types that occur."""
    rows = [(t, g, ref, list(win), a, tide, moon, tol, dict(zip(TERM_NAMES, w)), season_curve(ph), i)
            for i, (t, g, ref, win, a, tide, moon, tol, w, ph) in enumerate(SUBJECT_ROWS)]
    params = spark.createDataFrame(rows, """species_id string, group string, temp_ref string, sst_window array<double>,
        anomaly_pref double, tide_pref string, moon_pref string, swell_tolerance_ft double, weights map<string,double>,
        season_index array<double>, subject_no int""")
    seen = table(spark, sf, "part").select(F.col("p_type").alias("species_id")).distinct()
    unknown = [r.species_id for r in seen.where(F.col("species_id").isNotNull()).join(params, "species_id", "left_anti").orderBy("species_id").limit(5).collect()]
    if unknown:
        raise ValueError(f"part types without parameters: {unknown}")
    z = zones(spark, sf).select("zone_id", "zone_no")
    bridge = z.select("zone_id", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("subject_no"), "zone_no").where(
        (F.col("zone_no") + F.col("subject_no")) % 6 != 0)
    lists = bridge.groupBy("subject_no").agg(F.array_sort(F.collect_list("zone_id")).alias("zones"))
    return params.join(seen, "species_id").join(lists, "subject_no")


def sst_clim(spark, sf):
    return staged(spark, sf, "sst_clim", lambda: _sst_clim(spark, sf))


def _sst_clim(spark, sf):
    return doy_climatology(satellite(spark, sf), "zone_id", "sst_f", "sst")


def shore_clim(spark, sf):
    return staged(spark, sf, "shore_clim", lambda: _shore_clim(spark, sf))


def _shore_clim(spark, sf):
    return doy_climatology(shore_daily(spark, sf), "tide_station", "shore_sst_f", "shoresst")


def buoy_clim(spark, sf):
    return staged(spark, sf, "buoy_clim", lambda: _buoy_clim(spark, sf))


def _buoy_clim(spark, sf):
    d = buoy_daily(spark, sf)
    wave = doy_climatology(d, "station", "wave_ft", "wave").select("station", "doy", "wave_norm", "wave_p90")
    wind = doy_climatology(d, "station", "wind_kt", "wind").select("station", "doy", "wind_norm", "wind_p90")
    return wave.join(wind, ["station", "doy"], "full_outer").withColumnRenamed("station", "primary_buoy")


def conditions(spark, sf):
    return staged(spark, sf, "conditions", lambda: _conditions(spark, sf))


def _conditions(spark, sf):
    idx = current_index(climate_index(spark, sf))
    return build_conditions(zone_daily(spark, sf), zones(spark, sf), satellite(spark, sf), sst_clim(spark, sf), tide_daily(spark, sf),
                            shore_daily(spark, sf), shore_clim(spark, sf), buoy_clim(spark, sf), fronts(spark, sf),
                            chlorophyll(spark, sf), upwelling(spark, sf), idx, F.lit(AS_OF_DAY).cast("date"))


def norms(spark, sf):
    return zone_norms(zones(spark, sf), sst_clim(spark, sf), shore_clim(spark, sf), buoy_clim(spark, sf))


def curve(spark, sf):
    return staged(spark, sf, "curve", lambda: _curve(spark, sf))


def _curve(spark, sf):
    return climatological_curve(norms(spark, sf), subjects(spark, sf), zones(spark, sf))


def satellite_anomaly(spark, sf):
    from ..operators.climatology import with_anomaly
    return with_anomaly(satellite(spark, sf), sst_clim(spark, sf), "zone_id", "sst_f", "sst", "sst_anom_f", "sst_pctile")


def labelled_index(spark, sf):
    return index_table(climate_index(spark, sf))


def events(spark, sf):
    return table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def scores(spark, sf):
    """Scores of all zones, subjects and days, written once per application."""
    return staged(spark, sf, "scores", lambda: build_scores(conditions(spark, sf), subjects(spark, sf), zones(spark, sf)))
