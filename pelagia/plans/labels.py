"""Raw trip store and effort-adjusted outcome labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classes import GOOD_INDEX, score_class, score_class_index
from ..functions.dates import fishing_days, local_date
from ..functions.numeric import piecewise_linear, round_to, safe_ratio
from ..functions.text import classify_trip, flags, key_text
from ..operators.dedup import pick_row

LABEL_VERSION = "L1"
# Effort gate, reference rules and the catch-ratio scale.
MIN_TRIPS = 2
MIN_ANGLER_DAYS = 30.0
LOW_EFFORT = 100.0
REFERENCE_MIN_DAYS = 5
DEFAULT_REFERENCE = 0.5
FINAL_AFTER_DAYS = 3
RATIO_KNOTS = [(0.0, 0.0), (0.25, 40.0), (0.6, 60.0), (1.2, 75.0), (2.0, 90.0), (4.0, 100.0)]
SPARSE_SPECIES = ["white_seabass", "california_halibut"]
BASIS_OWN, BASIS_SPECIES, BASIS_DEFAULT = ("species-region median", "species median (region fallback)",
                                           "default (no reference data)")


def raw_id() -> Column:
    """Content version of a trip: the full SHA-256 of its fields as JSON, which no two different trips share."""
    fields = ["report_date", "landing", "boat", "trip_type_raw", "anglers", "kept_json", "released_json"]
    return F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)


def ratio_score(ratio: Column) -> Column:
    return round_to(piecewise_linear(ratio, RATIO_KNOTS), 1)


def current_trips(raw: DataFrame, fetch_log: DataFrame, page_trips: DataFrame) -> DataFrame:
    """Trips listed on the newest successful fetch of each report date, each listing of a trip numbered (``listing_no``, from 1).

    ``fetch_log`` has one row per page fetch; ``page_trips`` one row per trip listed on it
    (report_date, fetched_at_utc, raw_id), so a page of any length stays spread over rows.
    """
    ok = fetch_log.where(F.lower(F.col("ok").cast("string")) == "true")
    newest = pick_row(ok.select("report_date", "fetched_at_utc", "ingest_method"), ["report_date"], ["fetched_at_utc", "ingest_method"])
    listed = page_trips.join(newest, ["report_date", "fetched_at_utc"]).select(
        "raw_id", F.col("fetched_at_utc").alias("page_fetched_at_utc"), F.col("ingest_method").alias("page_method"))
    number = F.row_number().over(Window.partitionBy("raw_id").orderBy("page_method", "page_fetched_at_utc"))
    listed = listed.withColumn("listing_no", number)
    return raw.dropDuplicates(["raw_id"]).join(listed, "raw_id")


def page_listing(fetch_log: DataFrame) -> DataFrame:
    """Long form of a fetch log that stores the listed ids as one ";" text per fetch."""
    return fetch_log.select("report_date", "fetched_at_utc", F.explode(F.split("raw_ids", ";")).alias("raw_id")).where("raw_id <> ''")


def trip_species_days(trips: DataFrame, species_region: DataFrame) -> DataFrame:
    """Every trip x species eligible in the trip's region x day fished, zeros included.

    Effort and catch are split evenly over the days. ``trips`` carries maps kept and released. Numbered listings are passed on, so that
    the daily step can count trips without bringing the rows of each trip together again.
    """
    where = classify_trip("trip_type_raw", "trip_type")
    t = trips.withColumns({"_c": where, "_days": fishing_days("report_date", "trip_days")})
    t = t.withColumns({"region_id": F.col("_c.region"), "flag": F.col("_c.flag"), "share": 1.0 / F.size("_days")})
    t = t.where(F.col("region_id").isNotNull())
    rows = t.join(species_region, "region_id").withColumn("fishing_date", F.explode("_days"))
    amount = lambda m: F.coalesce(F.try_element_at(m, F.col("species_id")), F.lit(0)) * F.col("share")
    numbered = ["listing_no"] if "listing_no" in trips.columns else []
    return rows.select(
        "fishing_date", "region_id", "species_id", F.col("raw_id").alias("trip_key"), *numbered,
        (F.col("anglers") * F.col("share")).alias("anglers"),
        (F.col("anglers") * F.col("trip_days") * F.col("share")).alias("angler_days"),
        amount("kept").alias("kept"), amount("released").alias("released"), "report_date",
        F.datediff("report_date", "fishing_date").alias("lag"), F.col("page_fetched_at_utc").alias("fetched"),
        F.col("page_method").alias("method"), (F.size("_days") > 1).alias("multi_day"), "flag")


def daily_catch(agg: DataFrame) -> DataFrame:
    """Label grain: fishing date x region x species.

    Each trip counts in its first row. Where listings of a trip are numbered, that is known in the row, and rows are summed by report date,
    method and flag where they are read; else they are summed per trip first. So the sets of dates, methods and flags are gathered from
    their few combinations, not from one set for each trip.
    """
    keys, texts = ["fishing_date", "region_id", "species_id"], ["report_date", "method", "flag"]
    added = ["anglers", "angler_days", "kept", "released", "n_raw"]
    total = [*[F.sum(m).alias(m) for m in added], F.max("lag").alias("lag"), F.max("fetched").alias("fetched"), F.bool_or("multi_day").alias("multi_day")]
    by_trip = agg.withColumn("n_raw", F.lit(1))
    if "listing_no" in agg.columns:
        first = F.col("listing_no") == 1
    else:
        by_trip = by_trip.groupBy(*keys, "trip_key", *texts).agg(*total)
        first = F.row_number().over(Window.partitionBy(*keys, "trip_key").orderBy(*texts)) == 1
    few = by_trip.withColumn("n_trips", (first & F.col("trip_key").isNotNull()).cast("long")).groupBy(*keys, *texts).agg(*total, F.sum("n_trips").alias("n_trips"))
    text = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ";")
    d = few.groupBy(*keys).agg(
        F.sum("n_trips").alias("n_trips"), F.sum("anglers").alias("anglers"),
        F.sum("angler_days").alias("angler_days"), F.sum("kept").alias("fish_kept"), F.sum("released").alias("fish_released"),
        F.max("lag").alias("lag"), F.max("fetched").alias("available"), F.sum("n_raw").alias("n_raw"),
        text(F.col("report_date").cast("string")).alias("report_dates"), text("method").alias("methods"),
        F.bool_or("multi_day").alias("multi"), text("flag").alias("flags"))
    d = d.withColumn("fish_total", F.col("fish_kept") + F.col("fish_released"))
    return d.withColumns({"catch_index": safe_ratio("fish_total", "angler_days"),
                          "effort_sufficient": (F.col("n_trips") >= MIN_TRIPS) & (F.col("angler_days") >= MIN_ANGLER_DAYS)})


def _median_counted(df: DataFrame, keys: list[str], value: str, out: str, n: str) -> DataFrame:
    """Median over counted distinct values, so a hot key shuffles its distinct values only."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return counted.groupBy(*keys).agg(F.percentile(value, F.lit(0.5), F.col("_n")).alias(out), F.sum("_n").alias(n))


def build_reference(daily: DataFrame, window_start: str, window_end: str) -> DataFrame:
    """Reference catch rate per species and region: own median, else the species', else a default."""
    lo, hi = (F.lit(d).cast("date") for d in (window_start, window_end))
    win = daily.where(F.col("fishing_date").between(lo, hi) & F.col("effort_sufficient"))
    own = _median_counted(win, ["species_id", "region_id"], "catch_index", "_own", "_n_own")
    sp = _median_counted(win, ["species_id"], "catch_index", "_sp", "_n_sp")
    keys = daily.select("species_id", "region_id").distinct()
    j = keys.join(own, ["species_id", "region_id"], "left").join(sp, "species_id", "left")
    use_own = (F.col("_n_own") >= REFERENCE_MIN_DAYS) & (F.col("_own") > 0)
    pick = lambda a, b, c: F.when(use_own, a).when(F.col("_sp") > 0, b).otherwise(c)
    return j.select("species_id", "region_id",
                    round_to(pick(F.col("_own"), F.col("_sp"), F.lit(DEFAULT_REFERENCE)), 4).alias("reference_index"),
                    pick(F.col("_n_own"), F.col("_n_sp"), F.lit(0)).cast("int").alias("n_days"),
                    pick(F.lit(BASIS_OWN), F.lit(BASIS_SPECIES), F.lit(BASIS_DEFAULT)).alias("basis"),
                    lo.alias("window_start"), hi.alias("window_end"), F.lit(LABEL_VERSION).alias("label_version"))


def settled_dates(fetch_log: DataFrame, zone: str = "America/Los_Angeles") -> DataFrame:
    """Report dates that had a successful fetch on a later local day."""
    ok = fetch_log.where(F.lower(F.col("ok").cast("string")) == "true")
    return ok.where(local_date("fetched_at_utc", zone) > F.col("report_date")).select("report_date").distinct()


def build_labels(daily: DataFrame, reference: DataFrame, fetch_log: DataFrame, as_of: Column,
                 window_start: str, window_end: str, source: str, zone: str = "America/Los_Angeles") -> DataFrame:
    """Outcome labels with status, class, lags and data-quality flags."""
    c = F.col
    d = daily.where(c("fishing_date") <= as_of).join(
        reference.select("species_id", "region_id", c("reference_index").alias("_ref"), c("basis").alias("_basis")),
        ["species_id", "region_id"], "left")
    d = d.withColumns({"reference_index": F.coalesce("_ref", F.lit(DEFAULT_REFERENCE)),
                       "_basis": F.coalesce("_basis", F.lit(BASIS_DEFAULT))})
    # open report dates per label: an anti-join on the exploded dates, aggregated back to the key
    keys = ["fishing_date", "region_id", "species_id"]
    opened = (daily.select(*keys, F.explode(F.split("report_dates", ";")).alias("_d"))
                   .withColumn("report_date", F.col("_d").cast("date"))
                   .join(settled_dates(fetch_log, zone), "report_date", "left_anti")
                   .select(*keys).distinct().withColumn("_open", F.lit(True)))
    d = d.join(opened, keys, "left")
    scored = c("effort_sufficient") & (c("_basis") == BASIS_OWN)
    ratio = F.when(scored, safe_ratio("catch_index", "reference_index"))
    d = d.withColumn("_ratio", ratio).withColumn("observed_score", ratio_score(c("_ratio")))
    final = (F.datediff(as_of, "fishing_date") >= FINAL_AFTER_DAYS) & c("_open").isNull()
    status = (F.when(~c("effort_sufficient"), "insufficient_effort").when(~scored, "no_reference")
               .when(final, "final").otherwise("provisional"))
    in_window = c("fishing_date").between(F.lit(window_start).cast("date"), F.lit(window_end).cast("date"))
    own_flags = F.when(c("flags") != "", c("flags"))
    dq = F.concat_ws(";", own_flags, flags(
        (c("methods").contains("backfill"), "backfilled"), (c("multi"), "multi_day_split"),
        (c("_basis").contains("fallback"), "reference_species_fallback"), (c("_basis").startswith("default"), "reference_default"),
        (c("species_id").isin(SPARSE_SPECIES), "sparse_species"),
        (c("effort_sufficient") & (c("angler_days") < LOW_EFFORT), "low_effort"), (in_window, "in_reference_window"),
        (scored & (c("fish_total") == 0), "effort_adjusted_zero")))
    return d.select(
        key_text(F.lit(LABEL_VERSION), "fishing_date", "region_id", "species_id").alias("label_id"),
        F.lit(LABEL_VERSION).alias("label_version"), *keys, c("n_trips").cast("int").alias("n_trips"),
        *[round_to(x, 1).alias(x) for x in ("anglers", "angler_days", "fish_kept", "fish_released", "fish_total")],
        round_to("catch_index", 4).alias("catch_index"), "reference_index", round_to("_ratio", 3).alias("index_ratio"),
        "observed_score", score_class("observed_score").alias("observed_class"),
        (score_class_index("observed_score") >= GOOD_INDEX).cast("int").alias("observed_good_or_better"),
        "effort_sufficient", status.alias("label_status"), c("lag").alias("reporting_lag_days"),
        c("available").alias("available_at_utc"),
        F.datediff(local_date("available", zone), "fishing_date").alias("publication_lag_days"), "report_dates",
        F.lit(source).alias("source"), c("n_raw").cast("int").alias("n_raw_records"), F.nullif(dq, F.lit("")).alias("dq_flags"))


def label_summary(labels: DataFrame) -> DataFrame:
    """One row: counts by status, lag medians and the labelled period."""
    ok = labels.where(F.col("observed_class").isNotNull())
    base = labels.agg(F.count(F.lit(1)).alias("rows"), F.count("observed_class").alias("labelled"),
                      *[F.count_if(F.col("label_status") == s).alias(s) for s in (
                          "final", "provisional", "insufficient_effort", "no_reference")],
                      F.count_if(F.coalesce(F.col("dq_flags").contains("effort_adjusted_zero"), F.lit(False))).alias("effort_adjusted_zero"),
                      F.min(F.when(F.col("observed_class").isNotNull(), F.col("fishing_date"))).alias("first_fishing_date"),
                      F.max(F.when(F.col("observed_class").isNotNull(), F.col("fishing_date"))).alias("last_fishing_date"))

    def median(df: DataFrame, col: str):
        counted = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
        return counted.agg(F.percentile(col, F.lit(0.5), F.col("_n")).alias("m")).scalar()

    live = ok.where(~F.coalesce(F.col("dq_flags").contains("backfilled"), F.lit(False)))
    return base.withColumns({"median_publication_lag_days": median(ok, "publication_lag_days"),
                             "median_publication_lag_days_live": median(live, "publication_lag_days"),
                             "median_reporting_lag_days": median(ok, "reporting_lag_days")})


def label_coverage(labels: DataFrame) -> DataFrame:
    """Labels per region and species by status, zero-filled."""
    statuses = ["final", "provisional", "insufficient_effort", "no_reference"]
    return labels.groupBy("region_id", "species_id").pivot("label_status", statuses).agg(
        F.count(F.lit(1))).na.fill(0, statuses)
