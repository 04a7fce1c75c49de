"""Append-only forecast ledger: issuance rows, write-once storage and verification."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.classes import TERMS, lead_bucket, p_good, score_class, tier_for_lead
from ..functions.dates import LOCAL_ZONE, parse_instant
from ..functions.drivers import regime_baseline
from ..functions.numeric import round_to
from ..functions.text import flags, key_text
from ..session import cut_lineage

# Zones that share one thermistor, regions without an outcome source, far-lead exclusions.
SHARED_SENSOR_ZONES = ["sd_bay", "mission_bay"]
FAR_LEAD = 15
FAR_FORBIDDEN = ["wave_model_ft", "wind_model_kt", "wave_model_period_s", "wave_proj_ft", "wind_proj_kt"]
LIVE_ORIGIN = "live_daily_refresh"
SCHEMA_VERSION = 1

# Inputs kept with a near-term and with an extended row, and the columns of the ledger in order.
NEAR_INPUTS = [
    "sst_f", "sst_source", "sst_norm", "sst_anom_f", "sst_pctile", "sst_trend_7d", "shore_sst_f", "wave_ft", "swell_ft", "wave_period_s",
    "swell_period_s", "wave_dir_deg", "wind_kt", "gust_kt", "wind_dir_deg", "pressure_hpa", "pressure_trend_24h", "cloud_pct", "air_temp_f",
    "precip_mm", "tide_range_ft", "tide_exchanges", "max_exchange_rate_ft_h", "best_water_hour", "moon_illum", "moon_phase", "moon_age_days",
    "front_f_per_nm", "sst_spread_f", "wave_norm", "wind_norm", "is_forecast", "enso_regime", "oni_latest"]
EXTENDED_INPUTS = [
    "sst_norm_f", "sst_proj_f", "sst_anom_proj_f", "sst_proj_lo_f", "sst_proj_hi_f", "sst_basis", "w_persistence", "w_enso_analog",
    "w_cpc_outlook", "cpc_nudge_f", "sst_anom_core_f", "wave_proj_ft", "wind_proj_kt", "wave_norm_ft", "wind_norm_kt", "sea_state_published",
    "sea_state_basis", "model_blend_weight", "pressure_trend_model_24h", "cpc_product", "cpc_temp_cat", "cpc_temp_prob", "enso_regime", "oni",
    "enso_expected_anom_f", "analog_years", "tide_range_ft", "max_exchange_rate_ft_h", "best_water_hour", "moon_illum", "moon_phase"]
SOURCE_COLUMNS = [
    "src_mur_newest", "src_mur_freshness", "src_ndbc_newest_utc", "src_coops_wtemp_newest", "src_openmeteo_fetched_utc", "src_openmeteo_valid_to",
    "src_cpc_814_issued", "src_cpc_wk34_issued", "src_oni_checked", "src_tides_fetched_utc", "src_failed"]
LEDGER_COLUMNS = [
    "record_id", "issuance_id", "schema_version", "origin", "source_ref", "issue_utc", "issue_local", "issue_local_date", "data_cutoff_utc",
    "target_date", "lead_days", "lead_bucket", "horizon_tier", "confidence_key", "confidence_label", "zone_id", "region_id", "species_id",
    "model_version", "bite_score", "bite_class", "p_good_or_better", "score_lo", "score_hi", "baseline_clim_score", "baseline_enso_score",
    "baseline_enso_anom_f", "enso_regime", "oni", "core_score", "fishability", "anomaly_term", *[f"term_{t}" for t in TERMS],
    "missing_drivers", "basis", "sst_f", "sst_anom_f", "sst_source", "wave_ft", "wind_kt", "tide_range_ft", "moon_illum",
    "pressure_trend_24h", "front_f_per_nm", "inputs_json", *SOURCE_COLUMNS, "dq_flags"]
#: Columns whose text grows with the number of sources and is the same in many rows: stored once for each issuance and named in its rows by its SHA-256.
SHARED = ["src_failed"]
TEXTS_SCHEMA = "issuance_id string, name string, sha256 string, text string"
INDEX_HASHED = ["issuance_id", "issue_utc", "origin", "source_ref", "model_version", "n_rows", "content_sha256"]


def status_rows(documents: DataFrame, json: str) -> DataFrame:
    """Rows of the source status, one per source, from its JSON document (or several); one that cannot be read gives none."""
    source = "source_identifier string, freshness string, newest_valid_source_timestamp string, last_successful_fetch_utc string"
    return documents.select(F.inline(F.from_json(json, f"sources array<struct<{source.replace(' string', ': string')}>>")["sources"])).where("source_identifier is not null")


def source_fields(sources: DataFrame) -> DataFrame:
    """One row of provenance columns from the per-source status rows."""
    s, newest, got = F.col("source_identifier"), F.col("newest_valid_source_timestamp"), F.col("last_successful_fetch_utc")
    is_ = lambda prefix, suffix="": s.startswith(prefix) & s.endswith(suffix)
    failed = F.array_sort(F.collect_set(F.when(F.col("freshness") == "failed", s)))
    row = sources.agg(
        F.min_by(newest, F.when(is_("mur_sst"), s)).alias("src_mur_newest"),
        F.min_by("freshness", F.when(is_("mur_sst"), s)).alias("src_mur_freshness"),
        F.max(F.when(is_("ndbc:"), parse_instant(newest))).alias("src_ndbc_newest_utc"),
        F.max(F.when(is_("coops:", "water_temperature"), newest)).alias("src_coops_wtemp_newest"),
        F.min(F.when(is_("openmeteo:"), got)).alias("src_openmeteo_fetched_utc"),
        F.min(F.when(is_("openmeteo:"), newest)).alias("src_openmeteo_valid_to"),
        F.min_by(got, F.when(is_("cpc_oni"), s)).alias("src_oni_checked"),
        F.min(F.when(is_("coops:", "predictions"), got)).alias("src_tides_fetched_utc"),
        failed.alias("_failed"), F.count(F.lit(1)).alias("_n"))
    mur = F.col("src_mur_freshness")
    return row.withColumns({
        "src_failed": F.nullif(F.array_join("_failed", ","), F.lit("")),
        "src_flags": flags((F.col("_n") == 0, "no_source_timestamps"),
                           (mur.isin("failed", "stale", "delayed"), F.concat(F.lit("mur_"), mur)),
                           (F.size("_failed") > 0, F.concat(F.lit("sources_failed="), F.size("_failed").cast("string"))))}
    ).drop("_failed", "_n")


def inputs_json(columns: list[str], lead: str = "lead_days") -> Column:
    """JSON of the non-null inputs; sea-state model fields are removed from lead 15 on."""
    far = F.col(lead) >= FAR_LEAD
    kept = [F.when(~far, F.col(c)).alias(c) if c in FAR_FORBIDDEN else F.col(c) for c in sorted(columns)]
    return F.to_json(F.struct(*kept), {"ignoreNullFields": "true"})


def with_baselines(rows: DataFrame, curve: DataFrame, composite: DataFrame, subjects: DataFrame) -> DataFrame:
    """Climatology and regime baselines of each (zone, species, target date) row with simple_regime."""
    cv = curve.select("zone_id", "species_id", F.col("doy").alias("_doy"), F.col("climatological_score").alias("_clim"))
    cp = composite.select("zone_id", F.col("month").alias("_month"), "simple_regime", F.col("mean_anom_f").alias("_an"))
    keyed = rows.withColumns({"_doy": F.dayofyear("target_date"), "_month": F.month("target_date")})
    j = (keyed.join(cv, ["zone_id", "species_id", "_doy"], "left").join(cp, ["zone_id", "_month", "simple_regime"], "left")
              .join(subjects.select("species_id", F.col("anomaly_pref").alias("_pref")), "species_id", "left"))
    known = F.col("_clim").isNotNull()
    return j.withColumns({
        "baseline_clim_score": round_to("_clim", 1),
        "baseline_enso_score": F.when(known, regime_baseline("_clim", "_an", F.coalesce("_pref", F.lit(0.0)))),
        "baseline_enso_anom_f": F.when(known, round_to("_an", 3)),
    }).drop("_doy", "_month", "_clim", "_an", "_pref")


def issuance_rows(near: DataFrame, extended: DataFrame, today: Column) -> DataFrame:
    """Near-term scores (leads 0-6) and extended scores (7-30) in one shape; hindcast rows are excluded.

    ``near``/``extended`` are score rows already joined to their zone-day inputs.
    """
    lead = F.datediff("date", today)
    a = near.withColumn("lead_days", lead).where(F.col("lead_days").between(0, 6)).withColumns({
        "bite_score": F.col("score"), "score_lo": F.lit(None).cast("double"), "score_hi": F.lit(None).cast("double"),
        "basis": F.when(F.col("lead_days") > 0, "observed + deterministic forecast").otherwise("observed/nowcast")})
    b = extended.withColumn("lead_days", lead).where(F.col("lead_days").between(7, 30)).withColumns({
        "bite_score": F.col("score_outlook"), "fishability": F.col("fishability_outlook"),
        "core_score": F.lit(None).cast("double"), "sst_f": F.col("sst_proj_f"), "sst_anom_f": F.col("sst_anom_proj_f"),
        "wave_ft": F.col("wave_proj_ft"), "wind_kt": F.col("wind_proj_kt"),
        "pressure_trend_24h": F.col("pressure_trend_model_24h"),
        "sst_source": F.lit("projected (persistence + ENSO analog + CPC)")})
    for t in TERMS:
        if f"term_{t}" not in b.columns:
            b = b.withColumn(f"term_{t}", F.lit(None).cast("double"))
    common = ["date", "lead_days", "zone_id", "species_id", "bite_score", "score_lo", "score_hi", "core_score",
              "fishability", "anomaly_term", *[f"term_{t}" for t in TERMS], "missing_drivers", "basis", "sst_f",
              "sst_anom_f", "sst_source", "wave_ft", "wind_kt", "tide_range_ft", "moon_illum", "pressure_trend_24h",
              "front_f_per_nm", "inputs_json"]
    if "front_f_per_nm" not in a.columns:
        a = a.withColumn("front_f_per_nm", F.lit(None).cast("double"))
    b = b.withColumn("front_f_per_nm", F.lit(None).cast("double"))
    return a.select(*common).unionByName(b.select(*common)).withColumnRenamed("date", "target_date")


def finish_issuance(rows: DataFrame, zone_region: DataFrame, issue_utc: Column, today: Column, origin: str,
                    source_ref: str, model_version: str, src_flags: Column, zone: str = LOCAL_ZONE) -> DataFrame:
    """Add keys, classes, probabilities and flags; ``zone_region`` has (zone_id, region_id, labelled)."""
    c = F.col
    local = F.from_utc_timestamp(issue_utc, zone)
    iid = F.concat(F.date_format(today, "yyyy-MM-dd"), F.lit("T"), F.date_format(local, "HHmm"), F.lit(f"PT_{model_version}"))
    tier = tier_for_lead("lead_days")
    far = c("lead_days") >= FAR_LEAD
    df = rows.join(zone_region, "zone_id", "left").withColumns({
        "issuance_id": iid, "issue_utc": issue_utc, "issue_local_date": today, "origin": F.lit(origin),
        "source_ref": F.lit(source_ref), "model_version": F.lit(model_version)})
    own = flags((src_flags.isNotNull(), src_flags), (F.lit(origin != LIVE_ORIGIN), origin),
                (c("missing_drivers") != "", "missing_drivers"),
                ((c("lead_days") <= 6) & F.lower("sst_source").contains("model"), "sst_modelled_not_observed"),
                ((c("lead_days") == 0) & (F.hour(local) >= 12), "lead0_issued_after_local_noon"),
                (c("zone_id").isin(SHARED_SENSOR_ZONES), "shared_bay_thermistor"),
                (~c("labelled"), "no_outcome_source"), (far, "no_daily_sea_state"), (far, "fishability_default"),
                (c("lead_days").between(7, 14), "model_decayed_toward_climatology"))
    return df.withColumns({
        "record_id": key_text("issuance_id", F.date_format("target_date", "yyyy-MM-dd"), "zone_id", "species_id"),
        "lead_bucket": lead_bucket("lead_days"), "horizon_tier": tier["tier"], "confidence_key": tier["key"],
        "confidence_label": tier["label"], "bite_class": score_class("bite_score"),
        "p_good_or_better": p_good("bite_score", "lead_days"),
        "missing_drivers": F.nullif("missing_drivers", F.lit("")),
        **{k: F.when(~far, c(k)) for k in ("wave_ft", "wind_kt", "pressure_trend_24h")},
        "dq_flags": own}).drop("labelled")


def build_issuance(near: DataFrame, conditions: DataFrame, extended: DataFrame, outlook: DataFrame, curve: DataFrame, composite: DataFrame,
                   current: DataFrame, subjects: DataFrame, zone_region: DataFrame, status: DataFrame, issued: DataFrame, *, issue_utc: Column,
                   data_cutoff_utc: Column, today: Column, origin: str, source_ref: str, model_version: str, zone: str = LOCAL_ZONE) -> DataFrame:
    """All rows of one issuance, in the ledger's columns: near-term scores for leads 0 to 6 and extended ones for 7 to 30.

    ``near`` and ``extended`` are score rows, ``conditions`` and ``outlook`` the zone-days they came from, ``status`` the rows of the source
    status, ``issued`` (product, issued) the outlook products' dates, ``current`` one row with oni and simple_regime, ``zone_region`` one
    row per zone. Inputs are packed per zone-day of the horizon before they meet the scores. One-row states enter as scalar subqueries.
    The rows are built once, as an append reads them several times, and dealt to all tasks; the list of failed sources, long if they are
    many, is put to them last.
    """
    c, horizon = F.col, lambda df, a, b: df.where(c("date").between(F.date_add(today, a), F.date_add(today, b)))
    lead = F.datediff("date", today)

    def inputs(df: DataFrame, names: list[str], taken: list[str]) -> DataFrame:
        days = df.withColumn("lead_days", lead)
        return days.select("zone_id", "date", *[c(x) for x in taken if x in df.columns], inputs_json([x for x in names if x in df.columns]).alias("inputs_json"))

    scored = ["date", "zone_id", "species_id", "missing_drivers", "anomaly_term"]
    a = horizon(near, 0, 6).select(*scored, "score", "core_score", "fishability", *[f"term_{t}" for t in TERMS])
    a = a.join(inputs(horizon(conditions, 0, 6), NEAR_INPUTS, ["sst_f", "sst_anom_f", "sst_source", "wave_ft", "wind_kt", "tide_range_ft", "moon_illum",
                                                              "pressure_trend_24h", "front_f_per_nm"]), ["zone_id", "date"], "left")
    b = horizon(extended, 7, 30).select(*scored, "score_outlook", "score_lo", "score_hi", "fishability_outlook", "basis",
                                        *[x for x in (f"term_{t}" for t in TERMS) if x in extended.columns])
    b = b.join(inputs(horizon(outlook, 7, 30), EXTENDED_INPUTS, ["sst_proj_f", "sst_anom_proj_f", "wave_proj_ft", "wind_proj_kt", "tide_range_ft", "moon_illum",
                                                                "pressure_trend_model_24h"]), ["zone_id", "date"], "left")
    source = cut_lineage(source_fields(status))
    shared = [x for x in LEDGER_COLUMNS if x in SHARED]
    rows = issuance_rows(a, b, today).withColumns({
        "inputs_json": F.coalesce("inputs_json", F.lit("{}")), "missing_drivers": F.coalesce("missing_drivers", F.lit("")),
        "_now": current.select(F.struct(c("simple_regime"), c("oni"))).scalar(), "_src": source.drop(*shared).select(F.struct("*")).scalar(),
        "_issued": issued.agg(F.map_from_entries(F.collect_list(F.struct("product", "issued")))).scalar()})
    rows = with_baselines(rows.withColumn("simple_regime", c("_now.simple_regime")), curve, composite, subjects)
    rows = rows.withColumns({
        **{x: c(f"_src.{x}") for x in SOURCE_COLUMNS if "cpc" not in x and x not in shared}, "src_cpc_814_issued": F.try_element_at("_issued", F.lit("cpc_814_temp")),
        "src_cpc_wk34_issued": F.try_element_at("_issued", F.lit("cpc_wk34_temp")), "enso_regime": c("simple_regime"), "oni": c("_now.oni"),
        "schema_version": F.lit(SCHEMA_VERSION), "data_cutoff_utc": data_cutoff_utc,
        "issue_local": F.date_format(F.from_utc_timestamp(issue_utc, zone), "yyyy-MM-dd'T'HH:mm:ss")})
    done = finish_issuance(rows, zone_region, issue_utc, today, origin, source_ref, model_version, c("_src.src_flags"), zone)
    tasks = int(done.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    done = cut_lineage(done.select(*[x for x in LEDGER_COLUMNS if x not in shared]).repartition(tasks, "record_id"))
    return done.withColumns({x: source.select(x).scalar() for x in shared}).select(*LEDGER_COLUMNS)


def row_digest(df: DataFrame, columns: list[str] | None = None) -> Column:
    """SHA-256 of a row as JSON, columns in name order and nulls written out, so that no two different rows have one text.

    Timestamps go in as microseconds, so the session's time zone has no effect; shared texts go in by their own SHA-256.
    """
    kinds = dict(df.dtypes)
    plain = lambda c: F.unix_micros(F.col(c)) if kinds[c] == "timestamp" else F.sha2(c, 256) if c in SHARED else F.col(c)
    cols = sorted(columns or df.columns)
    return F.sha2(F.to_json(F.struct(*[plain(c).alias(c) for c in cols]), {"ignoreNullFields": "false"}), 256)


def content_checksum(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Order-free checksum of a table with repeated rows, as one aggregate: sums of both halves of 64 digest bits, and the row count."""
    d = row_digest(df, columns)
    part = lambda a: F.sum(F.conv(F.substring(d, a, 8), 16, 10).cast("decimal(38,0)")).cast("string")
    return F.concat_ws("-", part(1), part(9), F.count(F.lit(1)).cast("string"))


#: Rows that a leaf of an issuance's hash tree holds, on average.
LEAF_ROWS = 1000


def leaf_of(record_id: str, leaves: str | Column) -> Column:
    """Number of the leaf that a record belongs to."""
    return F.pmod(F.conv(F.substring(F.sha2(F.col(record_id), 256), 1, 8), 16, 10).cast("long"), F.col(leaves) if isinstance(leaves, str) else leaves).cast("int")


def hash_leaves(rows: DataFrame) -> DataFrame:
    """Lower level of the hash tree: per (issuance_id, leaf) the number of rows and the SHA-256 of its row digests in order."""
    return rows.groupBy("issuance_id", "leaf").agg(
        F.count(F.lit(1)).cast("long").alias("n"), F.sha2(F.concat_ws(",", F.array_sort(F.collect_list("row_sha256"))), 256).alias("leaf_sha256"))


def hash_roots(leaves: DataFrame) -> DataFrame:
    """Upper level of the hash tree: per issuance the SHA-256 of its leaves, with their numbers, in order."""
    named = F.concat_ws(":", F.lpad(F.col("leaf").cast("string"), 10, "0"), "leaf_sha256")
    return leaves.groupBy("issuance_id").agg(F.sha2(F.concat_ws(",", F.array_sort(F.collect_list(named))), 256).alias("content_sha256"))


def shared_texts(rows: DataFrame, names: list[str]) -> DataFrame:
    """The different texts of shared columns, one row for each issuance, column and text."""
    named = F.inline(F.array(*[F.struct(F.lit(x).alias("name"), F.col(x).alias("text")) for x in names]))
    return rows.select("issuance_id", named).where("text is not null").distinct().select("issuance_id", "name", F.sha2("text", 256).alias("sha256"), "text")


def _stored(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def append_issuance(spark: SparkSession, path: str, rows: DataFrame, created_utc: Column | None = None) -> bool:
    """Write one issuance if it is not recorded yet; False when nothing was new, an error for several new ones."""
    index = _stored(spark, f"{path}/index")
    new = rows.select("issuance_id", "source_ref").distinct()
    if index is not None:
        new = new.join(index.select("issuance_id"), "issuance_id", "left_anti").join(index.where("source_ref <> ''").select("source_ref"), "source_ref", "left_anti")
    n = new.select("issuance_id").distinct().limit(2).count()
    if n > 1:
        raise ValueError("append one issuance at a time")
    if n:
        append_issuances(spark, path, rows, created_utc)
    return n == 1


def append_issuances(spark: SparkSession, path: str, rows: DataFrame, created_utc: Column | None = None, leaf_rows: int = LEAF_ROWS) -> None:
    """Write all issuances not recorded yet, in one partitioned write; existing files are never rewritten.

    Rows go to ``path/rows`` with their digest and leaf, partitioned by month and issuance, their shared texts to ``path/texts``; the leaves
    of each issuance's hash tree to ``path/leaves``; then one index row per issuance, with the root of its tree, to ``path/index``. An append that stopped before its
    index rows is invisible and can be repeated. Numbers follow the issue time; each index row holds the digest of the row numbered
    before it. Only index rows, one per issuance, meet in one place.
    """
    index = _stored(spark, f"{path}/index")
    fresh = rows
    if index is not None:
        fresh = fresh.join(index.select("issuance_id"), "issuance_id", "left_anti")
        fresh = fresh.join(index.where("source_ref <> ''").select("source_ref"), "source_ref", "left_anti")
    heads = ["issuance_id", "issue_utc", "issue_local_date", "origin", "source_ref", "model_version"]
    entry = fresh.groupBy(*heads).agg(F.count(F.lit(1)).alias("n_rows"), F.min("lead_days").alias("lead_min"), F.max("lead_days").alias("lead_max"))
    if not entry.groupBy("issuance_id").count().where("count > 1").isEmpty():
        raise ValueError("an issuance has several heads")
    # of several new issuances with one source the first counts, as it would if they came one by one
    source = F.when(F.col("source_ref") != "", F.col("source_ref")).otherwise(F.concat(F.lit("\0"), "issuance_id"))
    first = entry.groupBy(source.alias("_source")).agg(F.min_by("issuance_id", F.struct("issue_utc", "issuance_id")).alias("issuance_id"))
    entry = entry.join(first.select("issuance_id"), "issuance_id", "left_semi").withColumn("n_leaves", F.ceil(F.col("n_rows") / leaf_rows).cast("int"))
    folders = {"issue_month": F.date_format("issue_local_date", "yyyy-MM"), "issuance_part": F.col("issuance_id")}
    hashed = fresh.withColumn("row_sha256", row_digest(fresh))
    shared = [x for x in SHARED if x in rows.columns]
    if shared:
        # long texts are read twice, to store and to hash them; from there on rows are short
        texts = shared_texts(fresh, shared).join(entry.select("issuance_id"), "issuance_id", "left_semi")
        texts.withColumn("issuance_part", F.col("issuance_id")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("issuance_part").parquet(f"{path}/texts")
        hashed = cut_lineage(hashed.withColumns({x: F.sha2(x, 256) for x in shared}))
    hashed = hashed.join(entry.select("issuance_id", "n_leaves"), "issuance_id")
    hashed = hashed.withColumn("leaf", leaf_of("record_id", "n_leaves")).drop("n_leaves").withColumns(folders)
    # a task writes a thousand leaves of an issuance at most
    dealt = hashed.repartition("issuance_id", F.floor(F.col("leaf") / 1000))
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(f"{path}/rows")
    leaves = hash_leaves(hashed)
    leaves.withColumn("issuance_part", F.col("issuance_id")).repartition("issuance_id").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("issuance_part").parquet(f"{path}/leaves")
    entry = entry.join(hash_roots(leaves), "issuance_id")
    order = Window.orderBy("issue_utc", "issuance_id")
    new = entry.withColumns({"seq": F.row_number().over(order).cast("long") - 1, "prev_index_row_sha256": F.coalesce(F.lag(row_digest(entry, INDEX_HASHED)).over(order), F.lit(""))})
    head = index.orderBy(F.desc("seq")).limit(1).select("seq", row_digest(index, INDEX_HASHED).alias("digest")).first() if index is not None else None
    if head:
        new = new.withColumns({"seq": F.col("seq") + head["seq"] + 1,
                               "prev_index_row_sha256": F.when(F.col("seq") == 0, head["digest"]).otherwise(F.col("prev_index_row_sha256"))})
    new.withColumn("created_utc", created_utc if created_utc is not None else F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{path}/index")


def read_ledger(spark: SparkSession, path: str, hashes: bool = False) -> DataFrame:
    """Rows of indexed issuances only (an interrupted append stays invisible); with ``hashes`` also row_sha256 and leaf."""
    rows = spark.read.parquet(f"{path}/rows").drop("issue_month", "issuance_part", *([] if hashes else ["row_sha256", "leaf"]))
    rows = rows.join(spark.read.parquet(f"{path}/index").select("issuance_id"), "issuance_id", "left_semi")
    texts, names = _stored(spark, f"{path}/texts", TEXTS_SCHEMA), rows.columns
    if texts is None:
        return rows
    # dealt to all tasks while they are short
    rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "record_id")
    for x in [x for x in SHARED if x in names]:
        text = texts.where(F.col("name") == x).select("issuance_id", F.col("sha256").alias(x), F.col("text").alias("_text"))
        rows = rows.join(text, ["issuance_id", x], "left").withColumn(x, F.coalesce("_text", x)).select(*names)
    return rows


def read_leaves(spark: SparkSession, path: str) -> DataFrame:
    """Stored leaves of the hash trees of indexed issuances."""
    return spark.read.parquet(f"{path}/leaves").drop("issuance_part").join(spark.read.parquet(f"{path}/index").select("issuance_id"), "issuance_id", "left_semi")


def broken_chain(index: DataFrame) -> DataFrame:
    """Index rows whose stored previous digest differs from the row before (matched on seq, no global sort)."""
    prev = index.select((F.col("seq") + 1).alias("seq"), row_digest(index, INDEX_HASHED).alias("_prev"))
    return index.join(prev, "seq", "left").where(
        F.coalesce("_prev", F.lit("")) != F.col("prev_index_row_sha256")).select("issuance_id", F.lit("hash_chain_broken").alias("error"))


def lookahead(rows: DataFrame, source_columns: list[str], tolerance_minutes: int = 5) -> DataFrame:
    """Issuances that carry a source timestamp later than their issue time."""
    stamped = rows.select("issuance_id", "issue_utc", F.inline(F.array(*[
        F.struct(F.lit(c).alias("source_column"), parse_instant(F.col(c).cast("string")).alias("src_ts")) for c in source_columns])))
    late = F.col("src_ts") > F.col("issue_utc").cast("timestamp") + F.expr(f"interval {tolerance_minutes} minutes")
    return stamped.where(late).groupBy("issuance_id", "source_column").agg(
        F.max("src_ts").alias("src_ts")).withColumn("error", F.lit("look_ahead"))


def forbidden_far_values(rows: DataFrame, columns: list[str] = ("wave_ft", "wind_kt")) -> DataFrame:
    """Rows per issuance that publish deterministic sea state at lead 15 or later."""
    far = rows.where(F.col("lead_days") >= FAR_LEAD)
    bad = F.lit(False)
    for c in columns:
        bad = bad | F.col(c).isNotNull()
    if "inputs_json" in rows.columns:
        bad = bad | F.coalesce(F.col("inputs_json").rlike("|".join(FAR_FORBIDDEN)), F.lit(False))
    return far.where(bad).groupBy("issuance_id").agg(F.count(F.lit(1)).alias("n"))


def verify_ledger(rows: DataFrame, leaves: DataFrame, index: DataFrame, source_columns: list[str], baseline: DataFrame | None = None) -> DataFrame:
    """All violations of a ledger as (issuance_id, error, detail).

    ``rows`` carry row_sha256 and leaf, ``leaves`` and ``index`` are as stored, ``baseline`` is an older index. A row that differs from its
    own digest is named; rows that were added, removed or rewritten together with their digest show in their leaf, and leaves that were
    rewritten as well show in the root. Also found: missing rows, wrong counts, duplicate records, a broken chain of the index,
    sources later than the issue, sea state at far leads, and issuances that the baseline had and the index lost or rewrote.
    """
    content = [c for c in rows.columns if c not in ("row_sha256", "leaf")]
    said = lambda df, error, detail=F.lit(None).cast("string"): df.select("issuance_id", F.lit(error).alias("error"), detail.cast("string").alias("detail"))
    changed = rows.where(row_digest(rows.select(content)) != F.col("row_sha256"))
    now = hash_leaves(rows)
    state = now.groupBy("issuance_id").agg(F.sum("n").alias("_n")).join(hash_roots(now).withColumnRenamed("content_sha256", "_root"), "issuance_id")
    indexed = index.select("issuance_id", "n_rows", "content_sha256").join(state, "issuance_id", "left")
    here = indexed.where("_n is not null").select("issuance_id")
    present = now.join(here, "issuance_id", "left_semi")
    stored = leaves.join(here, "issuance_id", "left_semi").select("issuance_id", "leaf", F.col("leaf_sha256").alias("_stored"))
    different = present.join(stored, ["issuance_id", "leaf"], "full_outer").where(~F.col("leaf_sha256").eqNullSafe(F.col("_stored")))
    out = said(indexed.where("_n is null"), "rows_missing")
    for part in (said(indexed.where("_n <> n_rows"), "row_count_mismatch"), said(indexed.where("_root <> content_sha256"), "content_mismatch"),
                 said(changed, "row_modified", F.col("record_id")), said(different, "leaf_mismatch", F.col("leaf")),
                 said(rows.groupBy("issuance_id", "record_id").count().where("count > 1"), "duplicate_record", F.col("record_id")),
                 broken_chain(index).withColumn("detail", F.lit(None).cast("string")),
                 said(lookahead(rows, source_columns), "look_ahead", F.col("source_column")), said(forbidden_far_values(rows), "far_sea_state", F.col("n"))):
        out = out.unionByName(part)
    if baseline is not None:
        old = baseline.select("issuance_id", F.col("content_sha256").alias("_old"))
        both = old.join(index.select("issuance_id", "content_sha256"), "issuance_id", "left")
        out = out.unionByName(said(both.where("content_sha256 is null"), "issuance_removed")).unionByName(said(both.where("content_sha256 <> _old"), "issuance_rewritten"))
    return out
