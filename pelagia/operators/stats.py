"""Effort aggregates, rank correlation, verification metrics and bootstrap."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classes import GOOD_INDEX, p_good, sample_flag, score_class_index
from ..functions.numeric import round_to, safe_ratio


def catch_per_effort(trips: DataFrame, keys: list[str]) -> DataFrame:
    """Sums and catch rates per key from trip x subject rows (kept, released, anglers, trip_days)."""
    out = trips.groupBy(*keys).agg(
        F.sum("kept").alias("kept"), F.sum("released").alias("released"), F.sum("anglers").alias("anglers"),
        F.sum(F.col("anglers") * F.col("trip_days")).alias("angler_days"), F.count(F.lit(1)).alias("trips"))
    return out.withColumns({"cpue": safe_ratio("kept", "anglers"),
                            "cpue_per_angler_day": safe_ratio("kept", "angler_days")})


def average_rank(value: str, part: list[str]) -> Column:
    """Rank with ties sharing their mean rank; nulls must be removed first."""
    ordered = Window.partitionBy(*part).orderBy(value)
    ties = F.count(F.lit(1)).over(Window.partitionBy(*part, value))
    return F.rank().over(ordered) + (ties - 1) / 2.0


def rank_correlation(df: DataFrame, keys: list[str], x: str, y: str, out: str) -> DataFrame:
    """Spearman correlation per key. Rows must be reduced to one per key and day beforehand."""
    ranked = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).withColumns(
        {"_rx": average_rank(x, keys), "_ry": average_rank(y, keys)})
    return ranked.groupBy(*keys).agg(F.corr("_rx", "_ry").alias(out))


def model_validation(scores: DataFrame, catch_daily: DataFrame, species_names: DataFrame | None = None,
                     prior: DataFrame | None = None, min_days: int = 5) -> DataFrame:
    """Pearson and rank agreement of the daily best score with catch per effort, by species.

    Without any usable overlap the prior table is returned instead.
    """
    best = scores.where(~F.col("is_forecast")).groupBy("species_id", "date").agg(F.max("score").alias("score"))
    j = catch_daily.join(best, ["species_id", "date"]).where(
        F.col("score").isNotNull() & F.col("cpue_per_angler_day").isNotNull())
    k = ["species_id"]
    ranked = j.withColumns({"_rs": average_rank("score", k), "_rd": average_rank("cpue_per_angler_day", k),
                            "_rr": average_rank("cpue", k)})
    agg = ranked.groupBy("species_id").agg(
        F.count(F.lit(1)).alias("n_days"), F.corr("_rs", "_rd").alias("_sp"), F.corr("score", "cpue_per_angler_day").alias("_pe"),
        F.corr("_rs", "_rr").alias("_raw"), F.avg("cpue_per_angler_day").alias("_mc"), F.avg("score").alias("_ms"),
        F.sum("kept").cast("long").alias("total_fish"), F.sum("anglers").cast("long").alias("total_anglers"),
        F.stddev_samp("score").alias("_s1"), F.stddev_samp("cpue_per_angler_day").alias("_s2"))
    agg = agg.where((F.col("n_days") >= min_days) & (F.col("_s1") != 0) & (F.col("_s2") != 0))
    out = agg.select("species_id", "n_days", round_to("_sp", 3).alias("spearman_rho"), round_to("_pe", 3).alias("pearson_r"),
                     round_to("_raw", 3).alias("spearman_rho_raw_cpue"), round_to("_mc", 3).alias("mean_cpue_per_angler_day"),
                     round_to("_ms", 1).alias("mean_score"), "total_fish", "total_anglers")
    if species_names is not None:
        out = out.join(species_names.select("species_id", "species"), "species_id", "left")
    if prior is None:
        return out
    any_new = out.agg(F.count(F.lit(1)).alias("n")).scalar()
    return out.unionByName(prior.where(any_new == 0), allowMissingColumns=True)


def long_by_model(pairs: DataFrame, models: list[str], prefix: str = "score__") -> DataFrame:
    """One row per pair and model (model_id, score); pairs without that model's score are dropped."""
    keep = [c for c in pairs.columns if not c.startswith(prefix)]
    packed = F.array(*[F.struct(F.lit(m).alias("model_id"), F.col(f"`{prefix}{m}`").cast("double").alias("score"))
                       for m in models])
    return pairs.select(*keep, F.inline(packed)).where(F.col("score").isNotNull())


def metric_columns() -> dict[str, Column]:
    """Additive parts of the verification metrics for one (pair, model) row."""
    idx = score_class_index("score")
    p = p_good("score", "lead_days")
    y = F.col("y_good").cast("double")
    pred = idx >= GOOD_INDEX
    return {"_hit": (idx == F.col("obs_idx")).cast("double"),
            "_near": (F.abs(idx - F.col("obs_idx")) <= 1).cast("double"),
            "_ae": F.abs(F.col("score") - F.col("observed_score")),
            "_sq": (p - y) * (p - y), "_p": p, "_y": y, "_pred": pred.cast("double"),
            "_tp": (pred & (y == 1)).cast("double")}


def metrics(rows: DataFrame, keys: list[str], min_events: int = 10) -> DataFrame:
    """Verification metrics per key from (pair, model) rows.

    Rows are reduced to sums by target date and to the keys' issuances, on the map side, so that no row is expanded for two distinct counts.
    """
    names = {k: f"_k{n}" for n, k in enumerate(keys)}
    parts = rows.withColumns(metric_columns()).withColumns({n: F.col(k) for k, n in names.items()})
    daily = parts.groupBy(*names.values(), "target_date").agg(*metric_sums())
    sums = daily.groupBy(*names.values()).agg(*merged_metrics(), F.count("target_date").alias("n_target_dates"))
    issued = parts.select(*[F.col(n).alias(f"_i{n}") for n in names.values()], "issuance_id").distinct()
    issuances = issued.groupBy(*[f"_i{n}" for n in names.values()]).agg(F.count("issuance_id").alias("n_issuances"))
    same = reduce(and_, [F.col(n).eqNullSafe(F.col(f"_i{n}")) for n in names.values()])
    joined = sums.join(issuances, same).select(*[F.col(n).alias(k) for k, n in names.items()], *[c for c in sums.columns if c not in names.values()], "n_issuances")
    return finish_metrics(joined, min_events)


#: Parts that are averaged, and their columns.
AVERAGED = {"_hit": "_hit", "_near": "_near", "_ae": "_ae", "_sq": "_sq", "_fs": "score", "_os": "observed_score"}


def metric_sums() -> list[Column]:
    """Sums and counts that ``merged_metrics`` can add up again."""
    return [F.count(F.lit(1)).alias("n_pairs"), *[F.sum(c).alias(k) for k, c in AVERAGED.items()], *[F.count(c).alias(f"{k}_n") for k, c in AVERAGED.items()],
            *[F.sum(c).alias(c) for c in ("_pred", "_tp", "_y")]]


def merged_metrics() -> list[Column]:
    """The metrics but for distinct counts, from rows of ``metric_sums``."""
    return [F.sum("n_pairs").alias("n_pairs"), *[F.try_divide(F.sum(k), F.sum(f"{k}_n")).alias(k) for k in AVERAGED], *[F.sum(c).alias(c) for c in ("_pred", "_tp", "_y")]]


def finish_metrics(agg: DataFrame, min_events: int) -> DataFrame:
    part = ("_hit", "_near", "_ae", "_sq", "_pred", "_tp", "_y", "_fs", "_os")
    return agg.withColumns({
        "sample_flag": sample_flag("n_pairs", "n_target_dates", "n_issuances"),
        "exact_hit": round_to("_hit", 4), "within_one": round_to("_near", 4), "mae": round_to("_ae", 2),
        "brier": round_to("_sq", 4), "n_obs_good": F.col("_y").cast("long"), "n_fcst_good": F.col("_pred").cast("long"),
        "obs_good_rate": round_to(F.col("_y") / F.col("n_pairs"), 4),
        "precision_good": F.when(F.col("_pred") >= min_events, round_to(F.col("_tp") / F.col("_pred"), 4)),
        "recall_good": F.when(F.col("_y") >= min_events, round_to(F.col("_tp") / F.col("_y"), 4)),
        "mean_forecast_score": round_to("_fs", 1), "mean_observed_score": round_to("_os", 1)}).drop(*part)


def with_skill(table: DataFrame, keys: list[str], reference: str = "baseline_climatology") -> DataFrame:
    """Brier and MAE skill of each model against the reference model's row of the same key."""
    ref = table.where(F.col("model_id") == reference).select(
        *keys, F.col("brier").alias("_rb"), F.col("mae").alias("_rm"))
    null_safe = [F.col(f"t.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    cond = null_safe[0]
    for c in null_safe[1:]:
        cond = cond & c
    j = table.alias("t").join(ref.alias("r"), cond, "left").select("t.*", "r._rb", "r._rm")
    return j.withColumns({
        "brier_skill_vs_clim": round_to(1.0 - safe_ratio("brier", "_rb"), 4),
        "mae_skill_vs_clim": round_to(1.0 - safe_ratio("mae", "_rm"), 4)}).drop("_rb", "_rm")


def reliability(pairs: DataFrame, score: str, group: str = "horizon_group", bins: int = 5) -> DataFrame:
    """Mean probability and observed rate per group and equal-width probability bin."""
    p = p_good(score, "lead_days")
    width = 100 // bins
    rows = pairs.where(F.col(score).isNotNull()).withColumn("_p", p).withColumn(
        "_b", F.least(F.floor(F.col("_p") * bins).cast("int"), F.lit(bins - 1)))
    out = rows.groupBy(group, "_b").agg(F.count(F.lit(1)).alias("n"), F.avg("_p").alias("_mp"), F.avg("y_good").alias("_or"))
    return out.select(group, F.concat((F.col("_b") * width).cast("string"), F.lit("-"),
                                      (F.col("_b") * width + width).cast("string"), F.lit("%")).alias("bin"),
                      "n", round_to("_mp", 3).alias("mean_p"), round_to("_or", 3).alias("obs_rate"))


def hash_draw(n: Column, *parts: Column) -> Column:
    """A repeatable pseudo-random integer in 0..n-1 from the MD5 of the joined parts."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % n


def block_bootstrap(pairs: DataFrame, model: str, reference: str, group: list[str], reps: int = 400,
                    seed: int = 7, min_dates: int = 5) -> DataFrame:
    """Bootstrap of Brier skill per group, resampling whole target dates.

    Pairs are reduced to one row per group and date first (at most a calendar's worth); each replicate
    then draws as many dates as there are. Scores are rounded to 4 decimals before the ratio.
    """
    y = F.col("y_good").cast("double")

    def part(m: str) -> tuple[Column, Column]:
        s = F.col(f"`score__{m}`")
        d = p_good(s, "lead_days") - y
        return F.sum(F.when(s.isNotNull(), d * d)), F.sum(s.isNotNull().cast("long"))

    (ms, mn), (rs, rn) = part(model), part(reference)
    daily = pairs.groupBy(*group, "target_date").agg(ms.alias("_ms"), mn.alias("_mn"), rs.alias("_rs"), rn.alias("_rn"))
    per_group = Window.partitionBy(*group)
    daily = daily.withColumns({"_i": F.row_number().over(per_group.orderBy("target_date")) - 1,
                               "_d": F.count(F.lit(1)).over(per_group)}).where(F.col("_d") >= min_dates)
    # the date count per group rides on its first row; reps x dates draws are generated from there
    draws = (daily.where("_i = 0").select(*group, "_d", F.explode(F.sequence(F.lit(0), F.lit(reps - 1))).alias("rep"))
                  .repartition("rep")
                  .select(*group, "_d", "rep", F.explode(F.sequence(F.lit(0), (F.col("_d") - 1).cast("int"))).alias("_k"))
                  .select(*group, "rep", hash_draw(F.col("_d"), F.lit(seed), F.col("rep"), F.col("_k")).cast("int").alias("_i")))
    per_rep = draws.join(daily, [*group, "_i"]).groupBy(*group, "rep").agg(
        F.try_divide(F.sum("_ms"), F.sum("_mn")).alias("_m"), F.try_divide(F.sum("_rs"), F.sum("_rn")).alias("_r"))
    skill = per_rep.select(*group, (1.0 - safe_ratio(round_to("_m", 4), round_to("_r", 4))).alias("_v")).where("_v is not null")
    return skill.groupBy(*group).agg(
        round_to(F.percentile("_v", F.lit(0.05)), 4).alias("p05"), round_to(F.percentile("_v", F.lit(0.5)), 4).alias("p50"),
        round_to(F.percentile("_v", F.lit(0.95)), 4).alias("p95"),
        round_to(F.avg((F.col("_v") > 0).cast("double")), 3).alias("p_positive"), F.lit(reps).alias("reps"))
