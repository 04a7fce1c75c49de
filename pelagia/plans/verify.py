"""Forecast evaluation: pairs, walk-forward calibration, reports and the challenger gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classes import CLASSES, TERMS, horizon_group, meteorological_season, season_start
from ..functions.dates import day_end_utc
from ..functions.drivers import rescore
from ..functions.numeric import round_to, safe_ratio
from ..functions.text import has_flag
from ..operators.dedup import pick_row
from ..operators.ordered import running_totals
from ..operators.stats import (block_bootstrap, finish_metrics, long_by_model, metric_sums, merged_metrics, metric_columns,
                               metrics, with_skill)

BASE_MODELS = {"v1": "bite_score", "baseline_climatology": "baseline_clim_score", "baseline_enso": "baseline_enso_score"}
DIMENSIONS = ["overall", "horizon_group", "lead_bucket", "species_id", "region_id", "month", "season", "enso_regime",
              "label_status"]
# Challenger gate.
CRITERIA = {"min_pairs": 300, "min_target_dates": 45, "min_issuances": 30, "min_aggregate_brier_improvement": 0.02,
            "max_mae_degradation_pts": 0.5, "min_bootstrap_p_positive": 0.90, "min_stratum_pairs": 30,
            "max_priority_brier_degradation": 0.05, "max_short_range_brier_degradation": 0.02,
            "max_short_range_hit_drop": 0.02}
MIN_TRAINING_PAIRS = 60


def with_weight_challenger(ledger: DataFrame, weights: DataFrame, model_id: str, override: dict[str, dict[str, float]]) -> DataFrame:
    """Score stored terms under overridden weights; an override keyed "*" applies to all other species."""
    def over(k: str) -> Column:
        own = F.lit(None).cast("double")
        for sp, w in override.items():
            if sp != "*" and w:
                own = F.when(F.col("species_id") == sp, F.lit(w.get(k)).cast("double")).otherwise(own)
        named = [sp for sp, w in override.items() if sp != "*" and w]
        any_ = F.lit(override.get("*", {}).get(k)).cast("double")
        return F.when(F.col("species_id").isin(named), own).otherwise(any_) if named else any_

    j = ledger.join(weights.select("species_id", F.col("weights").alias("_w")), "species_id", "left")
    w = {k: F.coalesce(over(k), F.col("_w")[k], F.lit(0.0)) for k in TERMS}
    terms = {k: F.col(f"term_{k}") for k in TERMS}
    return j.withColumn(f"score__{model_id}", rescore(terms, w, "anomaly_term", "fishability")).drop("_w")


def region_forecasts(ledger: DataFrame, zone_region: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Mean zone forecast per labelled region (a zone may feed several) with the union of flags."""
    z = ledger.drop("region_id").join(zone_region.where("labelled").select("zone_id", "region_id"), "zone_id")
    split = F.filter(F.split(F.coalesce("dq_flags", F.lit("")), ";"), lambda f: f != "")
    means = ["bite_score", "baseline_clim_score", "baseline_enso_score", *(extra or [])]
    return z.groupBy("issuance_id", "target_date", "region_id", "species_id").agg(
        *[F.avg(m).alias(m) for m in means],
        *[F.any_value(k).alias(k) for k in ("lead_days", "lead_bucket", "issue_utc", "enso_regime")],
        F.countDistinct("zone_id").alias("n_zones"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set(split)))), ";").alias("dq_flags"))


def build_pairs(ledger: DataFrame, labels: DataFrame, zone_region: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Region forecasts matched to labels of the same day, under the strict as-of rule."""
    usable = ledger.where(~has_flag("dq_flags", "lead0_issued_after_local_noon"))
    rf = region_forecasts(usable, zone_region, extra)
    lab = labels.where(F.col("observed_class").isNotNull()).select(
        F.col("fishing_date").alias("target_date"), "region_id", "species_id", "observed_score", "observed_class",
        "observed_good_or_better", "label_status", "available_at_utc")
    p = rf.join(lab, ["target_date", "region_id", "species_id"])
    p = p.where(F.col("issue_utc").cast("timestamp") < day_end_utc("target_date"))
    return with_dimensions(p).withColumns({f"score__{m}": F.col(c) for m, c in BASE_MODELS.items()})


def with_dimensions(pairs: DataFrame) -> DataFrame:
    names = F.array(*[F.lit(c) for c in CLASSES])
    return pairs.withColumns({
        "obs_idx": (F.array_position(names, F.col("observed_class")) - 1).cast("int"),
        "y_good": F.col("observed_good_or_better").cast("int"), "horizon_group": horizon_group("lead_days"),
        "month": F.date_format("target_date", "MM"), "season": meteorological_season(F.month("target_date")),
        "overall": F.lit("all")})


def walk_forward_calibration(pairs: DataFrame, out: str, score: str = "bite_score", min_training: int = MIN_TRAINING_PAIRS) -> DataFrame:
    """Calibrate each issuance on the pairs that were complete before it was issued.

    A pair is usable for an issuance at t0 when both its issue time and its label's availability are
    before t0, i.e. greatest(issue, available) < t0. Sufficient statistics are summed per horizon group
    and that time, accumulated with day-bucketed running totals, and read by each distinct issue time
    as of the moment before; nothing is paired row by row. Scores are centred on the group means
    before squares are summed. Fewer than ``min_training`` pairs or no spread leave the score as is.
    """
    c = F.col
    t0 = c("issue_utc").cast("timestamp")
    base = pairs.withColumns({"_t0": t0, "_eff": F.greatest(t0, c("available_at_utc").cast("timestamp"))})
    means = base.groupBy("horizon_group").agg(F.avg(score).alias("_mx"), F.avg("observed_score").alias("_my"))
    known = base.where(c(score).isNotNull() & c("observed_score").isNotNull() & c("_eff").isNotNull())
    x, y = c(score) - c("_mx"), c("observed_score") - c("_my")
    events = known.join(means, "horizon_group").groupBy("horizon_group", c("_eff").alias("_t")).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"),
        F.sum(x * y).alias("sxy"), F.sum(x * x).alias("sxx"))
    stats = ["n", "sx", "sy", "sxy", "sxx"]
    asks = base.select("horizon_group", c("_t0").alias("_t")).distinct()
    # at equal times the question sorts first: availability at the issue time must not be used
    line = events.withColumn("_kind", F.lit(1)).unionByName(asks.withColumn("_kind", F.lit(0)), allowMissingColumns=True)
    line = line.withColumn("_day", F.to_date("_t"))
    summed = running_totals(line, ["horizon_group"], ["_t", "_kind"], stats, "_day").where("_kind = 0")
    sx, sy, sxy, sxx = (c(f"cum_{s}") for s in stats[1:])
    n = F.nullif(c("cum_n"), F.lit(0.0))
    var = sxx - sx * sx / n
    slope = F.try_divide(sxy - sx * sy / n, var)
    fit = summed.join(means, "horizon_group").select(
        "horizon_group", c("_t").alias("_t0"), n.alias("_n"), F.when((n >= min_training) & (var > 1e-9), slope).alias("_b"),
        (c("_my") + sy / n).alias("_ybar"), (c("_mx") + sx / n).alias("_xbar"))
    j = base.join(fit, ["horizon_group", "_t0"], "left")
    fitted = c("_ybar") + c("_b") * (c(score) - c("_xbar"))
    value = F.when(c("_b").isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(99.9), fitted))).otherwise(c(score))
    return j.withColumn(out, value).drop("_t0", "_eff", "_n", "_b", "_ybar", "_xbar")


def window_names(target: str | Column, as_of: Column) -> Column:
    """Array of the evaluation windows a target date belongs to."""
    d = F.col(target) if isinstance(target, str) else target
    return F.array_compact(F.array(
        F.when(d > F.date_sub(as_of, 30), "rolling_30d"), F.when(d > F.date_sub(as_of, 90), "rolling_90d"),
        F.when(d >= season_start(as_of), "season_to_date"), F.lit("all")))


def evaluate(pairs: DataFrame, models: list[str], as_of: Column, dimensions: list[str] | None = None) -> DataFrame:
    """Metrics and skill for every window x dimension x stratum x model.

    Rows are reduced before they are listed: once to sums and target dates per (set of windows, model, all dimensions), once to the
    distinct issuances of those. Only these reduced rows are listed under their windows (at most four) and dimensions. Each table has
    one distinct count, so no row is expanded for two of them.
    """
    dims = dimensions or DIMENSIONS
    names = {d: f"_d_{d}" for d in dims}
    rows = long_by_model(pairs, models).withColumns(metric_columns()).withColumns({names[d]: F.col(d).cast("string") for d in dims})
    rows = rows.withColumn("windows", window_names("target_date", as_of))
    base = ["windows", "model_id", *names.values()]
    keys = ["window", "dimension", "stratum", "model_id"]

    def listed(df: DataFrame) -> DataFrame:
        strata = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(n).alias("stratum")) for d, n in names.items()])
        rest = [c for c in df.columns if c not in ("windows", *names.values())]
        out = df.withColumn("window", F.explode("windows")).select("window", *rest, F.inline(strata))
        return out.where(F.col("stratum").isNotNull())

    daily = rows.groupBy(*base, "target_date").agg(*metric_sums())
    issued = rows.groupBy(*base, "issuance_id").agg(F.lit(1).alias("_one"))
    sums = listed(daily).groupBy(*keys).agg(*merged_metrics(), F.countDistinct("target_date").alias("n_target_dates"))
    issuances = listed(issued).groupBy(*keys).agg(F.countDistinct("issuance_id").alias("n_issuances"))
    table = finish_metrics(sums.join(issuances, keys), 10)
    return with_skill(table, keys[:3]).withColumn("as_of", as_of)


def timeline(pairs: DataFrame, as_of: Column, days: int = 60) -> DataFrame:
    """Shortest-lead forecast per target date, region and species over the last days."""
    recent = pairs.where(F.col("target_date") > F.date_sub(as_of, days))
    cols = ["target_date", "region_id", "species_id", "lead_days", "observed_score", "observed_class", "label_status",
            "bite_score", "baseline_clim_score", "baseline_enso_score", "issuance_id"]
    best = pick_row(recent.select(*cols), ["target_date", "region_id", "species_id"], ["lead_days", "issuance_id"], keep="min")
    return best.withColumns({k: round_to(k, 1) for k in ("bite_score", "baseline_clim_score", "baseline_enso_score")}).drop("issuance_id")


def assess_challenger(pairs: DataFrame, model: str, champion: str = "v1", priority_species: list[str] = (),
                      priority_regions: list[str] = (), criteria: dict | None = None, reps: int = 400) -> DataFrame:
    """Gate checks as rows (check_name, passed, detail) plus the overall recommendation on each row."""
    k = criteria or CRITERIA
    c = F.col
    both = long_by_model(pairs, [model, champion])
    dims = {"all": F.lit("all"), "species_id": c("species_id"), "region_id": c("region_id"), "lead_bucket": c("lead_bucket")}
    listed = both.select("*", F.inline(F.array(*[F.struct(F.lit(d).alias("dimension"), v.cast("string").alias("stratum"))
                                                 for d, v in dims.items()])))
    wanted = ((c("dimension") == "all") | ((c("dimension") == "species_id") & c("stratum").isin(list(priority_species)))
              | ((c("dimension") == "region_id") & c("stratum").isin(list(priority_regions)))
              | ((c("dimension") == "lead_bucket") & c("stratum").isin("0-3", "4-7")))
    m = metrics(listed.where(wanted), ["dimension", "stratum", "model_id"])
    key = ["dimension", "stratum"]
    ch = m.where(c("model_id") == model).select(*key, *[c(x).alias(f"c_{x}") for x in (
        "n_pairs", "n_target_dates", "n_issuances", "brier", "mae", "exact_hit")])
    cp = m.where(c("model_id") == champion).select(*key, *[c(x).alias(f"v_{x}") for x in ("brier", "mae", "exact_hit")])
    sizes = pairs.select("*", F.inline(F.array(*[F.struct(F.lit(d).alias("dimension"), v.cast("string").alias("stratum"))
                                                 for d, v in dims.items()]))).groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"))
    boot = block_bootstrap(pairs.withColumn("_g", F.lit("all")), model, champion, ["_g"], reps).select(
        c("_g").alias("stratum"), F.lit("all").alias("dimension"), "p_positive")
    j = ch.join(cp, key).join(sizes, key).join(boot, key, "left")
    enough = ((c("c_n_pairs") >= k["min_pairs"]) & (c("c_n_target_dates") >= k["min_target_dates"])
              & (c("c_n_issuances") >= k["min_issuances"]))
    gain = F.coalesce(1.0 - safe_ratio("c_brier", "v_brier"), F.lit(0.0))
    deg = F.coalesce(safe_ratio("c_brier", "v_brier") - 1.0, F.lit(0.0))
    agg = c("dimension") == "all"

    def check(name, passed, detail) -> Column:
        return F.struct(F.lit(name).alias("check_name") if isinstance(name, str) else name.alias("check_name"),
                        F.coalesce(passed, F.lit(False)).alias("passed"), detail.alias("detail"))

    overall = F.array(
        check("minimum sample", enough, F.format_string("%d pairs / %d target dates / %d issuances", "c_n_pairs", "c_n_target_dates", "c_n_issuances")),
        check("aggregate Brier improvement", gain >= k["min_aggregate_brier_improvement"], F.format_string("%+.1f%% vs champion", gain * 100)),
        check("aggregate MAE not worse", c("c_mae") <= c("v_mae") + k["max_mae_degradation_pts"], F.format_string("%.1f vs %.1f pts", "c_mae", "v_mae")),
        check("bootstrap confidence", enough & (c("p_positive") >= k["min_bootstrap_p_positive"]),
              F.concat(F.lit("P(improves Brier) = "), F.coalesce(F.when(enough, c("p_positive").cast("string")), F.lit("n/a")))))
    priority = F.array(check(F.concat(F.lit("priority "), c("stratum"), F.lit(" not degraded")),
                             deg <= k["max_priority_brier_degradation"],
                             F.format_string("Brier %.3f vs %.3f (%+.1f%%)", "c_brier", "v_brier", deg * 100)))
    short = F.array(check(F.concat(F.lit("short-range lead "), c("stratum"), F.lit(" not degraded")),
                          (deg <= k["max_short_range_brier_degradation"]) & (c("c_exact_hit") >= c("v_exact_hit") - k["max_short_range_hit_drop"]),
                          F.format_string("Brier %+.1f%%; exact hit %.0f%% vs %.0f%%", deg * 100, c("c_exact_hit") * 100, c("v_exact_hit") * 100)))
    sized = agg | (c("n_rows") >= k["min_stratum_pairs"])
    checks = j.where(sized).select(F.inline(F.when(agg, overall).when(c("dimension") == "lead_bucket", short).otherwise(priority)))
    verdict = checks.agg(F.bool_and("passed").alias("all_ok"),
                         F.bool_and(F.when(c("check_name") == "minimum sample", c("passed"))).alias("enough")).select(
        F.when(~F.coalesce("enough", F.lit(False)), "insufficient_data").when(c("all_ok"), "recommend_promotion_pending_human_approval")
         .otherwise("do_not_promote").alias("r")).scalar()
    return checks.withColumns({"model_id": F.lit(model), "recommendation": verdict})


def registry_performance(registry: DataFrame, evaluation: DataFrame) -> DataFrame:
    """Models with their all-time metrics per horizon group."""
    head = evaluation.where("`window` = 'all' and dimension = 'horizon_group'").select(
        "model_id", F.col("stratum").alias("horizon_group"), "n_pairs", "n_target_dates", "sample_flag", "exact_hit",
        "within_one", "mae", "brier", "brier_skill_vs_clim")
    return registry.join(head, "model_id", "left")
