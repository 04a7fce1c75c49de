"""Daily reduction, day-of-year climatology, anomalies and empirical percentiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import cyclic_doy
from ..functions.numeric import anomaly_percentile


def daily_stats(df: DataFrame, keys: list[str], date: Column, value: Column, out: str, min_n: int = 0) -> DataFrame:
    """Mean, min, max and count per key and day, keeping days with enough observations.

    Null keys, null values and NaN are dropped. Partial aggregation bounds what is shuffled to one
    row per key, day and map task.
    """
    rows = df.select(*keys, date.alias("date"), value.cast("double").alias("_v"))
    rows = rows.where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    daily = rows.groupBy(*keys, "date").agg(
        F.avg("_v").alias(out), F.min("_v").alias(f"{out}_min"), F.max("_v").alias(f"{out}_max"),
        F.count("_v").alias("n_obs"))
    return daily.where(F.col("n_obs") >= min_n) if min_n else daily


def doy_climatology(daily: DataFrame, entity: str, value: str, label: str, window: int = 7, min_n: int = 5,
                    date: str = "date") -> DataFrame:
    """Norm, spread and percentiles per entity and day of year over a +/- ``window`` day pool.

    ``daily`` holds one value per (entity, date), so a pool has at most (2*window+1) values per
    year whatever the raw volume was. The pool wraps on a 366-day circle. Only (entity, day-of-year,
    value) is multiplied by the window; percentiles are exact with linear interpolation.
    """
    rows = (daily.where(F.col(value).isNotNull() & F.col(entity).isNotNull())
                 .select(entity, F.dayofyear(date).alias("_d"), F.year(date).alias("_y"), F.col(value).alias("_v")))
    years = rows.groupBy(entity).agg(F.countDistinct("_y").alias(f"{label}_years"))
    pooled = rows.select(entity, F.explode(F.transform(F.sequence(F.lit(-window), F.lit(window)),
                                                       lambda k: cyclic_doy("_d", k))).alias("doy"), "_v")
    stats = pooled.groupBy(entity, "doy").agg(
        F.avg("_v").alias(f"{label}_norm"), F.stddev_samp("_v").alias(f"{label}_sd"),
        F.percentile("_v", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9))).alias("_p"),
        F.count("_v").alias(f"{label}_n")).where(F.col(f"{label}_n") >= min_n)
    stats = stats.select(entity, "doy", f"{label}_norm", f"{label}_sd",
                         *[F.col("_p")[i].alias(f"{label}_{p}") for i, p in enumerate(("p10", "p50", "p90"))],
                         f"{label}_n")
    return stats.join(years, entity)


def with_anomaly(daily: DataFrame, clim: DataFrame, entity: str, value: str, label: str, anom: str, pctile: str,
                 date: str = "date") -> DataFrame:
    """Anomaly against the norm and its percentile under a normal law."""
    norms = clim.select(entity, "doy", f"{label}_norm", f"{label}_sd")
    out = daily.withColumn("doy", F.dayofyear(date)).join(norms, [entity, "doy"], "left")
    out = out.withColumn(anom, F.col(value) - F.col(f"{label}_norm"))
    return out.withColumn(pctile, anomaly_percentile(anom, f"{label}_sd"))


def within_doy_percentile(daily: DataFrame, entity: str, value: str, out: str, date: str = "date") -> DataFrame:
    """Share (in %) of an entity's values on the same day of year that lie strictly below.

    One value per entity and date: a partition holds one row per year.
    """
    keyed = daily.withColumn("doy", F.dayofyear(date))
    part = Window.partitionBy(entity, "doy")
    below = F.rank().over(part.orderBy(value)) - 1
    return keyed.withColumn(out, F.when(F.col(value).isNotNull(), below / F.count(value).over(part) * 100.0))


def curve_percentile(scores: DataFrame, curve: DataFrame, keys: list[str], score: str, curve_score: str,
                     out: str) -> DataFrame:
    """Share (in %) of the annual curve strictly below each score; null without a curve.

    Curve points are counted below the distinct scores of a key only, of which one-decimal scores have a thousand at most; the
    score rows themselves are joined to these shares and never sorted.
    """
    value = F.col(score).cast("double")
    points = curve.where(F.col(curve_score).isNotNull()).select(*keys, F.col(curve_score).cast("double").alias("_s"), F.lit(1).alias("_points"))
    asked = scores.where(value.isNotNull()).select(*keys, value.alias("_s")).distinct().withColumn("_points", F.lit(0))
    steps = asked.unionByName(points).groupBy(*keys, "_s").agg(F.sum("_points").alias("_points"))
    part = Window.partitionBy(*keys)
    below = F.coalesce(F.sum("_points").over(part.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("_points").over(part)
    shares = steps.select(*keys, "_s", F.when(total > 0, F.round(below / F.nullif(total, F.lit(0)) * 100.0, 1)).alias(out))
    return scores.withColumn("_s", value).join(shares, [*keys, "_s"], "left").drop("_s")
