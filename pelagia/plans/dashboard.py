"""Read-side queries of the dashboard: rankings, pivots and lookups over the built tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classes import TERMS
from ..functions.numeric import trapezoid
from ..operators.dedup import pick_row


def top_combinations(scores: DataFrame, day: Column, n: int = 10) -> DataFrame:
    """Best zone x species combinations of a date."""
    return scores.where(F.col("date") == day).orderBy(F.desc("score"), "zone_id", "species_id").limit(n)


def best_per_species(scores: DataFrame, after: Column | None = None, score: str = "score") -> DataFrame:
    """Best zone and day per species; the earliest date, then zone, on equal scores."""
    rows = scores if after is None else scores.where(F.col("date") > after)
    return pick_row(rows, ["species_id"], [-F.col(score), F.col("date"), F.col("zone_id")], keep="min")


def opportunity_matrix(scores: DataFrame, day: Column, zones: list[str]) -> DataFrame:
    """Species x zone pivot of a date's scores."""
    return scores.where(F.col("date") == day).groupBy("species_id").pivot("zone_id", zones).agg(F.max("score"))


def driver_ranking(scores: DataFrame) -> DataFrame:
    """Drivers of each score row by absolute contribution."""
    rows = scores.select("date", "zone_id", "species_id", F.explode("contrib").alias("driver", "contribution"))
    from pyspark.sql import Window
    w = Window.partitionBy("date", "zone_id", "species_id").orderBy(F.desc(F.abs("contribution")), "driver")
    return rows.withColumn("rank", F.row_number().over(w))


def mean_norm_by_date(scores: DataFrame, species: str | None = None) -> DataFrame:
    """Mean seasonal norm over zones per date (missing norms skipped)."""
    rows = scores if species is None else scores.where(F.col("species_id") == species)
    return rows.groupBy("date").agg(F.avg("seasonal_norm_score").alias("mean_norm"), F.count("seasonal_norm_score").alias("n"))


def access_by_zone(scores: DataFrame) -> DataFrame:
    """One access value per zone and date (it does not depend on the species)."""
    return scores.groupBy("zone_id", "date").agg(F.max("fishability").alias("fishability"))


def top_species(catch: DataFrame, n: int = 6) -> DataFrame:
    """Species with the largest total catch."""
    return catch.groupBy("species_id").agg(F.sum("kept").alias("total")).orderBy(F.desc("total"), "species_id").limit(n)


def decimate_curve(curve: DataFrame, step: int = 3) -> DataFrame:
    """Every ``step``-th day of year, starting at 1."""
    return curve.where(F.pmod("doy", F.lit(step)) == 1)


def nearest_curve_point(curve: DataFrame, keys: list[str], doy: Column | int) -> DataFrame:
    """The curve row closest to a day of year per key (the earlier one on a tie)."""
    return pick_row(curve, keys, [F.abs(F.col("doy") - doy), F.col("doy")], keep="min")


def custom_order(df: DataFrame, column: str, order: list[str]) -> Column:
    """Sort key by position in a list, unknown values last."""
    pos = F.array_position(F.array(*[F.lit(o) for o in order]), F.col(column))
    return F.when(pos > 0, pos).otherwise(len(order) + 1)


def search_dictionary(dictionary: DataFrame, text: str) -> DataFrame:
    """Case-insensitive substring search over all columns."""
    return dictionary.where(F.lower(F.concat_ws(" ", *dictionary.columns)).contains(text.lower()))


def suitability_by_zone(conditions: DataFrame, subjects: DataFrame) -> DataFrame:
    """Temperature suitability of each subject in each zone-day."""
    w = F.col("sst_window")
    rows = conditions.join(subjects.select("species_id", "sst_window", F.explode("zones").alias("zone_id")), "zone_id")
    return rows.select("date", "zone_id", "species_id", trapezoid("sst_f", w[0], w[1], w[2], w[3]).alias("suitability"))


def side_by_side(evaluation: DataFrame, left: str, right: str, metric: str = "brier") -> DataFrame:
    """One metric of two models per stratum."""
    return evaluation.groupBy("window", "dimension", "stratum").pivot("model_id", [left, right]).agg(F.first(metric)).select(
        "window", "dimension", "stratum", F.col(f"`{left}`").alias("left_value"), F.col(f"`{right}`").alias("right_value"),
        (F.col(f"`{left}`") - F.col(f"`{right}`")).alias("difference"))


def model_by_lead(evaluation: DataFrame) -> DataFrame:
    return evaluation.where("`window` = 'all' and dimension = 'lead_bucket'").select(
        "model_id", F.col("stratum").alias("lead_bucket"), "n_pairs", "exact_hit", "within_one", "mae", "brier")


def failed_checks(checks: DataFrame) -> DataFrame:
    """Failed gate checks per challenger as one text."""
    return checks.groupBy("model_id", "recommendation").agg(
        F.array_join(F.array_sort(F.collect_set(F.when(~F.col("passed"), F.col("check_name")))), "; ").alias("failed"),
        F.count_if("passed").alias("n_passed"))


def positive_agreement(validation: DataFrame) -> DataFrame:
    """Species with positive rank agreement, and the best value."""
    return validation.agg(F.count_if(F.col("spearman_rho") > 0).alias("n_positive"), F.count(F.lit(1)).alias("n_species"),
                          F.max("spearman_rho").alias("best_rho"))


def recent_decisions(decisions: DataFrame, n: int = 25) -> DataFrame:
    return decisions.orderBy(F.desc("seq")).limit(n)


def count_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def export_record(df: DataFrame, columns: list[str], digits: int = 2) -> DataFrame:
    """JSON record per row: chosen columns, rounded floats, nulls left out."""
    types = dict(df.dtypes)
    cols = [F.round(c, digits).alias(c) if types[c] in ("double", "float") else F.col(c) for c in columns]
    return df.select(F.to_json(F.struct(*cols)).alias("record"))


def missing_term_share(scores: DataFrame) -> DataFrame:
    """Share of rows without data per driver term."""
    row = scores.agg(*[F.avg(F.col(f"term_{t}").isNull().cast("double")).alias(t) for t in TERMS])
    return row.select(F.inline(F.array(*[F.struct(F.lit(t).alias("driver"), F.col(t).alias("missing_share")) for t in TERMS])))
