"""Data-quality and governance gates. Each returns violation rows or one summary row per table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ledger import content_checksum


def table_check(df: DataFrame, name: str, key: list[str], min_rows: int) -> DataFrame:
    """One row: row count against a floor, null keys and duplicated keys."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    null_key = F.lit(False)
    for k in key:
        null_key = null_key | F.col(k).isNull()
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.count_if(F.col("_n") > 1).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(null_key, F.col("_n"))), F.lit(0)).alias("null_keys")).select(
        F.lit(name).alias("table_name"), "n_rows", "duplicate_keys", "null_keys",
        ((F.col("n_rows") >= min_rows) & (F.col("duplicate_keys") == 0)).alias("ok"))


def history_check(old: DataFrame, new: DataFrame, name: str, date: str, ratio: float) -> DataFrame:
    """One row: the new table may not shrink, start later or end earlier than the old one."""
    side = lambda df, p: df.agg(F.count(F.lit(1)).alias(f"n_{p}"), F.min(date).alias(f"min_{p}"), F.max(date).alias(f"max_{p}"))
    now = side(new, "new").select(F.struct("*")).scalar()
    both = side(old, "old").withColumn("_now", now).select("*", "_now.*").drop("_now")
    c = F.col
    return both.select(F.lit(name).alias("table_name"), "n_old", "n_new", "min_old", "min_new", "max_old", "max_new",
                       (c("n_new") < c("n_old") * ratio).alias("shrunk"), (c("min_new") > c("min_old")).alias("starts_later"),
                       (c("max_new") < c("max_old")).alias("ends_earlier"))


def range_check(df: DataFrame, columns: list[str], lo: float = 0.0, hi: float = 100.0, tol: float = 0.01) -> DataFrame:
    """Out-of-range counts per column, in one pass."""
    row = df.agg(*[F.count_if((F.col(c) < lo - tol) | (F.col(c) > hi + tol)).alias(c) for c in columns])
    return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_out")) for c in columns])))


def coverage_check(conditions: DataFrame, outlook: DataFrame, today: Column, n_zones: int, ahead: int = 6, back: int = 13,
                   horizon: int = 30) -> DataFrame:
    """Coverage rules as rows (rule, ok)."""
    c = conditions.agg(F.countDistinct("zone_id").alias("z"), F.min("date").alias("a"), F.max("date").alias("b"))
    row = c.withColumn("e", outlook.agg(F.max("date")).scalar())
    rules = {"zone_count": F.col("z") == n_zones, "near_term_end": F.col("b") >= F.date_add(today, ahead),
             "hindcast_start": F.col("a") <= F.date_sub(today, back), "outlook_end": F.col("e") >= F.date_add(today, horizon)}
    return row.select(F.inline(F.array(*[F.struct(F.lit(k).alias("rule"), v.alias("ok")) for k, v in rules.items()])))


def lead_rules(outlook: DataFrame) -> DataFrame:
    """Counts of rows breaking the tier and publication rules by lead."""
    lead, tier = F.col("lead_days"), F.col("confidence_tier")
    far = lead >= 15
    rules = {"overlaps_near_term": lead < 7, "tier_2_expected": lead.between(7, 14) & (tier != 2),
             "tier_3_expected": far & (tier != 3), "far_wave_published": far & F.col("wave_proj_ft").isNotNull(),
             "far_wind_published": far & F.col("wind_proj_kt").isNotNull(),
             "far_sea_state_flag": far & F.col("sea_state_published")}
    row = outlook.agg(*[F.count_if(v).alias(k) for k, v in rules.items()])
    return row.select(F.inline(F.array(*[F.struct(F.lit(k).alias("rule"), F.col(k).alias("n_bad")) for k in rules])))


def failed_critical_sources(status: DataFrame) -> DataFrame:
    """Critical sources that failed without a usable earlier copy."""
    return status.where((F.col("freshness") == "failed") & F.col("deployment_critical") & ~F.col("used_cached_data"))


def labels_without_evidence(labels: DataFrame) -> DataFrame:
    """Labels that carry a class although their status says there is no evidence for one."""
    return labels.where(F.col("label_status").isin("insufficient_effort", "no_reference") & F.col("observed_class").isNotNull())


def registry_violations(models: DataFrame, decisions: DataFrame, production_model: str, engine_model: str, auto_retrain: bool,
                        old_models: DataFrame | None = None, old_decisions: DataFrame | None = None) -> DataFrame:
    """Registry rules as violation rows.

    models: model_id, status, approved; decisions: seq and the decision fields, append-only.
    """
    prod = models.where("status = 'production'")
    summary = prod.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("model_id") == production_model).alias("m"))
    bad = [summary.where((F.col("n") != 1) | (F.col("m") != 1)).select(F.lit("production_model_not_unique").alias("violation"), F.lit(production_model).alias("subject")),
           prod.where(~F.coalesce("approved", F.lit(False))).select(F.lit("production_without_approval").alias("violation"), F.col("model_id").alias("subject")),
           summary.where(F.lit(production_model != engine_model)).select(F.lit("production_differs_from_engine").alias("violation"), F.lit(production_model).alias("subject")),
           summary.where(F.lit(bool(auto_retrain))).select(F.lit("auto_retrain_enabled").alias("violation"), F.lit(production_model).alias("subject"))]
    if old_models is not None:
        bad.append(old_models.join(models, "model_id", "left_anti").select(F.lit("model_removed").alias("violation"), F.col("model_id").alias("subject")))
    if old_decisions is not None:
        rewritten = old_decisions.join(decisions, old_decisions.columns, "left_anti")
        bad.append(rewritten.select(F.lit("decision_changed").alias("violation"), F.col("seq").cast("string").alias("subject")))
    out = bad[0]
    for b in bad[1:]:
        out = out.unionByName(b)
    return out


def copies_agree(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
    """Two published copies of a table: equal row count and order-free content checksum."""
    cols = sorted(left.columns)
    a = left.agg(F.count(F.lit(1)).alias("n_left"), content_checksum(left, cols).alias("_a"))
    b = right.agg(F.struct(F.count(F.lit(1)).alias("n"), content_checksum(right, cols).alias("sum"))).scalar()
    both = a.withColumn("_b", b)
    return both.select(F.lit(name).alias("table_name"), "n_left", F.col("_b.n").alias("n_right"), (F.col("_a") == F.col("_b.sum")).alias("same_content"))


def upsert_status(previous: DataFrame, attempts: DataFrame) -> DataFrame:
    """Source status after a run: a failed attempt keeps the last success and newest timestamp.

    attempts: source_identifier, attempted_utc, success, newest, freshness, cached, error. Sources not
    attempted keep their row; ``not_due`` keeps the last attempt time.
    """
    c = F.col
    p = previous.select("source_identifier", c("last_attempted_fetch_utc").alias("_pa"), c("last_successful_fetch_utc").alias("_ps"),
                        c("newest_valid_source_timestamp").alias("_pn"), c("freshness").alias("_pf"),
                        c("used_cached_data").alias("_pc"), c("error").alias("_pe"))
    a = attempts.withColumn("_seen", F.lit(True))
    j = p.join(a, "source_identifier", "full_outer")
    seen = F.coalesce(c("_seen"), F.lit(False))
    return j.select(
        "source_identifier",
        F.when(seen & (c("freshness") != "not_due"), c("attempted_utc")).otherwise(c("_pa")).alias("last_attempted_fetch_utc"),
        F.when(seen & c("success"), c("attempted_utc")).otherwise(c("_ps")).alias("last_successful_fetch_utc"),
        F.coalesce(F.when(seen, c("newest")), c("_pn")).alias("newest_valid_source_timestamp"),
        F.when(seen, c("freshness")).otherwise(c("_pf")).alias("freshness"),
        F.when(seen, c("cached")).otherwise(c("_pc")).alias("used_cached_data"),
        F.when(seen, F.col("error")).otherwise(c("_pe")).alias("error"))


def payload_sanity(rows: DataFrame, source: str, ts: str, value: Column, now: Column, max_ahead: str = "2 hours") -> DataFrame:
    """Newest valid timestamp, coverage, future timestamps and usable values per source."""
    ok = value.isNotNull()
    future = F.col(ts) > now + F.expr(f"interval {max_ahead}")
    return rows.groupBy(source).agg(
        F.max(F.when(ok & ~future, F.col(ts))).alias("newest_valid"), F.count_if(future).alias("n_future"),
        F.to_date(F.min(F.when(ok, F.col(ts)))).alias("covered_from"), F.to_date(F.max(F.when(ok, F.col(ts)))).alias("covered_to"),
        F.count_if(ok).alias("n_valid"), F.bool_or(ok).alias("usable"))


def snapshot_date(conditions: DataFrame, from_last: int = 7, date: str = "date") -> DataFrame:
    """The ``from_last``-th newest distinct date (one row)."""
    return conditions.select(date).distinct().orderBy(F.desc(date)).limit(from_last).agg(
        F.when(F.count(F.lit(1)) == from_last, F.min(date)).alias("snapshot_date"))


def year_span(df: DataFrame, name: str, date: str) -> DataFrame:
    """Row count and covered years of a table."""
    y = F.year(date)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.concat_ws("–", F.min(y).cast("string"), F.max(y).cast("string")).alias("span")).select(
        F.lit(name).alias("table_name"), "n_rows", "span")


def data_dictionary(tables: dict[str, DataFrame], definitions: DataFrame) -> DataFrame:
    """Actual columns of each table with their definition, or a default text."""
    spark = definitions.sparkSession
    cols = [(t, f.name, f.dataType.simpleString()) for t, df in tables.items() for f in df.schema.fields]
    actual = spark.createDataFrame(cols, "table_name string, field string, data_type string")
    return actual.join(definitions.select("field", "definition"), "field", "left").select(
        "table_name", "field", "data_type", F.coalesce("definition", F.lit("No definition recorded.")).alias("definition"))
