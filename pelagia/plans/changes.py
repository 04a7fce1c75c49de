"""Why a forecast changed between two issuances, in score points per driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classes import TERMS
from ..functions.drivers import DEFAULT_ACCESS, TERM_FLOOR
from ..functions.numeric import round_to

# Driver names in the change text, and inputs with their unit and reporting threshold.
DRIVER_LABELS = {"sst": "water temperature fit", "season": "seasonality", "tide": "tide", "moon": "moon",
                 "pressure": "pressure trend", "swell": "swell", "front": "SST front", "chl": "chlorophyll",
                 "anomaly": "ENSO/SST anomaly boost", "access": "fishability (wind/sea access)"}
INPUTS = [("sst_f", "SST", "°F", 0.3), ("sst_anom_f", "SST anomaly", "°F", 0.3), ("wave_ft", "seas", " ft", 0.5),
          ("wind_kt", "wind", " kt", 2.0), ("tide_range_ft", "tide range", " ft", 0.5)]


def log_parts(side: str) -> Column:
    """Map driver -> share of ln(score) for one side (struct column) with the weights map ``weights``."""
    row = F.col(side)
    present = {k: row[f"term_{k}"].isNotNull() & (F.coalesce(F.col("weights")[k], F.lit(0.0)) > 0) for k in TERMS}
    total = sum(F.when(present[k], F.col("weights")[k]).otherwise(0.0) for k in TERMS)
    part = {k: F.when(present[k], F.col("weights")[k] / total * F.log(F.greatest(row[f"term_{k}"], F.lit(TERM_FLOOR)))) for k in TERMS}
    mult = row["anomaly_term"]
    part["anomaly"] = F.when(total > 0, F.when(mult > 0, F.log(mult)).otherwise(0.0))
    share = F.coalesce(row["fishability"] / 100.0, F.lit(DEFAULT_ACCESS))
    part["access"] = F.when(total > 0, F.log(0.35 + 0.65 * share))
    keys, vals = F.array(*[F.lit(k) for k in sorted(part)]), F.array(*[part[k] for k in sorted(part)])
    return F.map_filter(F.map_from_arrays(keys, vals), lambda _, v: v.isNotNull())


def _listed(keys: Column, prefix: str) -> Column:
    names = F.create_map(*[F.lit(x) for kv in DRIVER_LABELS.items() for x in kv])
    words = F.transform(F.filter(F.array_sort(keys), lambda k: ~k.isin("anomaly", "access")), lambda k: F.element_at(names, k))
    return F.when(F.size(words) > 0, F.concat(F.lit(prefix), F.array_join(words, ", ")))


def forecast_changes(current: DataFrame, prior: DataFrame, weights: DataFrame) -> DataFrame:
    """Per target date, zone and species in both issuances: score change split over drivers.

    The change in each driver's log share is rescaled so that the parts add up to the score change.
    """
    key = ["target_date", "zone_id", "species_id"]
    pack = lambda df, n: df.select(*key, F.struct(*[c for c in df.columns if c not in key]).alias(n))
    j = pack(current, "now").join(pack(prior, "was"), key).join(weights.select("species_id", "weights"), "species_id", "left")
    j = j.withColumns({"_a": log_parts("now"), "_b": log_parts("was")})
    zero = F.lit(0.0)
    j = j.withColumns({
        "_d": F.map_zip_with("_a", "_b", lambda _, a, b: F.coalesce(a, zero) - F.coalesce(b, zero)),
        "_delta": F.coalesce(F.col("now.bite_score"), zero) - F.coalesce(F.col("was.bite_score"), zero),
        "_added": F.array_except(F.map_keys("_a"), F.map_keys("_b")), "_dropped": F.array_except(F.map_keys("_b"), F.map_keys("_a"))})
    j = j.withColumn("_total", F.aggregate(F.map_values("_d"), zero, lambda acc, v: acc + v))
    pts = F.transform_values("_d", lambda _, v: F.when(F.abs("_total") > 1e-9, F.col("_delta") * v / F.col("_total")).otherwise(0.0))
    j = j.withColumn("_pts", pts)
    names = F.create_map(*[F.lit(x) for kv in DRIVER_LABELS.items() for x in kv])
    ranked = F.array_sort(F.transform(F.filter(F.map_entries("_pts"), lambda e: F.abs(e["value"]) >= 1.0),
                                      lambda e: F.struct((-F.abs(e["value"])).alias("o"), e["key"].alias("k"), e["value"].alias("v"))))
    top = F.array_join(F.transform(F.slice(ranked, 1, 3), lambda e: F.format_string("%s %+.1f", F.element_at(names, e["k"]), e["v"])), "; ")
    top = F.when(top != "", top).when(F.abs("_delta") < 1, "no material driver change").otherwise("small changes across several drivers")

    def moved(col, label, unit, limit):
        x, y = F.col(f"now.{col}"), F.col(f"was.{col}")
        return (F.when(x.isNull() & y.isNotNull(), f"{label} withdrawn").when(x.isNotNull() & y.isNull(), f"{label} now forecast")
                 .when(F.abs(x - y) >= limit, F.format_string(f"{label} %.1f→%.1f{unit}", y, x)))

    inputs = [moved(*i) for i in INPUTS]
    s_now, s_was = F.col("now.sst_source"), F.col("was.sst_source")
    inputs.append(F.when(~s_now.eqNullSafe(s_was), F.concat_ws("", F.lit("SST source "), F.coalesce(s_was, F.lit("None")),
                                                              F.lit(" → "), F.coalesce(s_now, F.lit("None")))))
    t_now, t_was = F.col("now.horizon_tier"), F.col("was.horizon_tier")
    notes = [_listed(F.col("_added"), "driver now available: "), _listed(F.col("_dropped"), "driver dropped (no data at this lead): "),
             F.when(t_now != t_was, F.format_string("confidence tier %d→%d as the date came closer", t_was, t_now)),
             F.when(F.col("now.model_version") != F.col("was.model_version"),
                    F.concat_ws("", F.lit("model "), F.col("was.model_version"), F.lit("→"), F.col("now.model_version")))]
    null_if_empty = lambda parts: F.nullif(F.concat_ws("; ", *parts), F.lit(""))
    return j.select(
        F.col("now.issuance_id").alias("current_issuance"), F.col("was.issuance_id").alias("prior_issuance"), *key,
        F.col("now.lead_days").alias("lead_now"), F.col("was.lead_days").alias("lead_prior"),
        t_now.alias("tier_now"), t_was.alias("tier_prior"), F.col("was.bite_score").alias("score_prior"),
        F.col("now.bite_score").alias("score_now"), round_to("_delta", 1).alias("delta"),
        F.col("was.bite_class").alias("class_prior"), F.col("now.bite_class").alias("class_now"), top.alias("top_drivers"),
        F.transform_values(F.map_filter("_pts", lambda _, v: F.abs(v) >= 0.1), lambda _, v: round_to(v, 1)).alias("driver_points"),
        null_if_empty(inputs).alias("input_changes"), null_if_empty(notes).alias("notes"))


def material_changes(changes: DataFrame) -> DataFrame:
    """Changes worth showing: a point or more, another class or tier, or a note."""
    differs = lambda a, b: ~F.col(a).eqNullSafe(F.col(b))
    return changes.where((F.abs("delta") >= 1) | differs("class_now", "class_prior") | differs("tier_now", "tier_prior")
                         | F.col("notes").isNotNull())


def latest_two(index: DataFrame) -> DataFrame:
    """The newest issuance and the one before it, ranked 1 and 2 by sequence."""
    top = index.select("issuance_id", "seq").orderBy(F.desc("seq")).limit(2)
    newest = top.agg(F.max("seq").alias("m")).scalar()
    return top.withColumn("rank", (newest - F.col("seq") + 1).cast("int"))


def newest_two(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For every target date, zone and species the row of the newest issuance and that of the one before it."""
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy("target_date", "zone_id", "species_id").orderBy(F.desc("issue_utc"), F.desc("issuance_id"))))
    return tuple(ranked.where(F.col("_rank") == k).drop("_rank") for k in (1, 2))
