"""The zone x day fact table and its scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classes import index_regime, simple_regime
from ..functions.dates import doy_to_month, local_date, moon, sun
from ..functions.drivers import weight_columns, with_score
from ..functions.numeric import anomaly_percentile, round_to
from ..operators.climatology import curve_percentile
from ..operators.ordered import lag_change

SATELLITE, MODEL, SHORE = "MUR 1km satellite", "Open-Meteo marine model", "NOAA CO-OPS shore thermistor"


def calendar(dates: DataFrame, date: str = "date") -> DataFrame:
    """One row per distinct date with moon and sun fields, computed once per date."""
    d = dates.select(date).distinct().withColumns({"_m": moon(date), "_s": sun(date)})
    return d.select(date, F.col("_m.illumination").alias("moon_illum"), F.col("_m.phase").alias("moon_phase"),
                    F.col("_m.age_days").alias("moon_age_days"), F.col("_s.sunrise").alias("sunrise_hour"),
                    F.col("_s.sunset").alias("sunset_hour"), F.col("_s.daylight").alias("daylight_hours"))


def index_table(index: DataFrame) -> DataFrame:
    """Monthly index with both regime labels."""
    return index.withColumns({"regime": index_regime("oni"), "simple_regime": simple_regime("oni")})


def current_index(index: DataFrame) -> DataFrame:
    """One row: the latest month with a value and the mean over the last twelve rows."""
    labelled = index_table(index)
    key = F.struct("year", "month")
    tail = labelled.orderBy(F.desc("year"), F.desc("month")).limit(12).agg(F.avg("oni").alias("m"))
    last = labelled.where(F.col("oni").isNotNull()).agg(F.max_by(F.struct("season", "year", "month", "oni", "regime", "simple_regime"), key).alias("_r"))
    return last.select("_r.*").withColumn("trailing_12mo_mean_oni", tail.scalar())


def observed_over_model(df: DataFrame) -> DataFrame:
    """Satellite temperature where present, else the model, with its source named."""
    return df.withColumns({
        "sst_f": F.coalesce("sst_f_sat", "sst_f_model"),
        "sst_source": F.when(F.col("sst_f_sat").isNotNull(), SATELLITE).otherwise(MODEL)})


def shore_authority(df: DataFrame, inshore: Column) -> DataFrame:
    """Inshore zones with a shore reading take temperature and norms from the shore station."""
    use = inshore & F.col("shore_sst_f").isNotNull()
    out = df.withColumns({"sst_f": F.when(use, F.col("shore_sst_f")).otherwise(F.col("sst_f")),
                          "sst_source": F.when(use, SHORE).otherwise(F.col("sst_source"))})
    for k in ("norm", "sd", "p10", "p50", "p90", "years"):
        if f"shoresst_{k}" in df.columns:
            out = out.withColumn(f"sst_{k}", F.when(use, F.col(f"shoresst_{k}")).otherwise(F.col(f"sst_{k}")))
    return out


def build_conditions(zone_daily: DataFrame, zones: DataFrame, satellite: DataFrame, sst_clim: DataFrame,
                     tide: DataFrame, shore_daily: DataFrame, shore_clim: DataFrame, buoy_clim: DataFrame,
                     fronts: DataFrame, chl: DataFrame, upwelling: DataFrame, current: DataFrame,
                     as_of: Column) -> DataFrame:
    """Left-join every daily source onto the zone timeline and derive anomalies and trends.

    All inputs are daily or day-of-year tables; ``zones`` carries zone_id, inshore, tide_station and
    primary_buoy. ``current`` is the one-row index state and enters as scalar subqueries.
    """
    z = zones.select("zone_id", "inshore", "tide_station", "primary_buoy")
    df = zone_daily.join(z, "zone_id").withColumns({"doy": F.dayofyear("date"), "month": F.month("date")})
    df = df.join(satellite.select("zone_id", "date", F.col("sst_f").alias("sst_f_sat")), ["zone_id", "date"], "left")
    df = observed_over_model(df).join(sst_clim, ["zone_id", "doy"], "left").join(tide, ["tide_station", "date"], "left")
    df = df.join(shore_daily.select("tide_station", "date", "shore_sst_f"), ["tide_station", "date"], "left")
    df = df.join(shore_clim.drop("shoresst_n"), ["tide_station", "doy"], "left")
    df = df.withColumn("shore_sst_anom_f", F.col("shore_sst_f") - F.col("shoresst_norm"))
    df = shore_authority(df, F.col("inshore")).withColumn("sst_anom_f", F.col("sst_f") - F.col("sst_norm"))
    df = df.withColumn("sst_pctile", anomaly_percentile("sst_anom_f", "sst_sd"))
    df = lag_change(df, "zone_id", "date", "sst_f", 7, "sst_trend_7d")
    df = lag_change(df, "zone_id", "date", "pressure_hpa", 1, "pressure_trend_24h")
    df = df.join(buoy_clim, ["primary_buoy", "doy"], "left").withColumns({
        "wave_anom_ft": F.col("wave_ft") - F.col("wave_norm"), "wind_anom_kt": F.col("wind_kt") - F.col("wind_norm")})
    df = df.join(fronts, ["zone_id", "date"], "left").join(chl, ["zone_id", "date"], "left")
    df = df.join(upwelling, "date", "left").join(calendar(zone_daily), "date", "left")
    return df.withColumns({
        "oni_latest": current.select("oni").scalar(), "enso_regime": current.select("regime").scalar(),
        "enso_simple": current.select("simple_regime").scalar(),
        "is_forecast": F.col("date") > as_of})


def today_local(now_utc: Column | None = None, hours: int = -7) -> Column:
    """Calendar day of the run at a fixed UTC offset."""
    now = now_utc if now_utc is not None else F.current_timestamp()
    return F.to_date(now + F.expr(f"make_interval(0, 0, 0, 0, {hours})"))


def eligible_pairs(conditions: DataFrame, subjects: DataFrame, zones: DataFrame) -> DataFrame:
    """Zone-day rows with every subject modelled in the zone, through the zone-subject bridge.

    The pairs are the parameters, a few rows; by the sizes that Catalyst guesses for their joins the zone-days would be broadcast to them,
    and one task would score all.
    """
    pairs = weight_columns(subjects).withColumn("zone_id", F.explode("zones")).drop("zones")
    place = zones.select("zone_id", "distance_nm", "depth_mid_ft")
    return conditions.join(F.broadcast(pairs.join(place, "zone_id")), "zone_id")


SCORE_OUTPUT = ["date", "zone_id", "species_id", "group", "score", "seasonal_norm_score", "vs_norm", "core_score",
                "fishability", "access_note", "is_forecast", "sst_f", "sst_anom_f", "wave_ft", "wind_kt",
                "tide_range_ft", "moon_illum", "front_f_per_nm", "term_sst", "term_season", "term_tide", "term_moon",
                "term_pressure", "term_swell", "term_front", "term_chl", "anomaly_term", "contrib", "missing_drivers",
                "enso_regime", "oni_latest"]


def build_scores(conditions: DataFrame, subjects: DataFrame, zones: DataFrame, curve: DataFrame | None = None) -> DataFrame:
    """Score and seasonal norm score of every zone, subject and day; optionally the annual percentile."""
    rows = eligible_pairs(conditions, subjects, zones)
    rows = with_score(rows).where(F.col("score").isNotNull())
    rows = with_score(rows, prefix="n_", climatology=True, score_only=True)
    rows = rows.withColumn("seasonal_norm_score", F.col("n_score")).withColumn(
        "vs_norm", round_to(F.col("score") - F.col("n_score"), 1))
    out = rows.select(*[c for c in SCORE_OUTPUT if c in rows.columns])
    if curve is None:
        return out
    return curve_percentile(out, curve, ["zone_id", "species_id"], "score", "climatological_score", "annual_percentile")


def climatological_curve(norms: DataFrame, subjects: DataFrame, zones: DataFrame) -> DataFrame:
    """Score of every zone, subject and day of year from climatological drivers only.

    ``norms``: zone_id, doy, sst_norm, wave_norm, wind_norm, climatology_source.
    """
    rows = eligible_pairs(norms.withColumns({"month": doy_to_month("doy"), "wave_period_s": F.lit(None).cast("double")}),
                          subjects, zones)
    scored = with_score(rows, climatology=True, score_only=True)
    return scored.where(F.col("score").isNotNull()).select(
        "zone_id", "species_id", "doy", "month", F.col("score").alias("climatological_score"),
        F.col("sst_norm").alias("sst_norm_f"), F.col("wave_norm").alias("wave_norm_ft"),
        F.col("wind_norm").alias("wind_norm_kt"), "climatology_source")


def zone_norms(zones: DataFrame, sst_clim: DataFrame, shore_clim: DataFrame, buoy_clim: DataFrame) -> DataFrame:
    """Day-of-year norms per zone: shore stations inshore, satellite elsewhere, waves and wind by buoy."""
    shore = zones.where("inshore").join(shore_clim, "tide_station").select(
        "zone_id", "primary_buoy", "doy", F.col("shoresst_norm").alias("sst_norm"), F.col("shoresst_sd").alias("sst_sd"),
        F.lit("CO-OPS shore climatology").alias("climatology_source"))
    sat = zones.where("not inshore").join(sst_clim, "zone_id").select(
        "zone_id", "primary_buoy", "doy", "sst_norm", "sst_sd", F.lit("MUR satellite climatology").alias("climatology_source"))
    return shore.unionByName(sat).join(buoy_clim.select("primary_buoy", "doy", "wave_norm", "wind_norm"),
                                       ["primary_buoy", "doy"], "left")
