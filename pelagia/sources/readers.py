"""Readers: station text, model JSON, gridded CSV, index text, report pages and stored tables.

Each ``parse_*`` works on a DataFrame column so that it can follow any reader; each ``read_*`` is the
matching ``spark.read`` call.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import nan_to_null
from ..functions.text import (BUCKETS, LANDINGS, MONTHS, count_items, count_map, literal_map, one_space, page_date, trip_days, trip_type, trip_type_page,
                              zone_hint)
from ..operators.joins import full_outer

# Station text layout, missing markers and upper limits.
STATION_COLUMNS = ["YY", "MM", "DD", "hh", "mm", "WDIR", "WSPD", "GST", "WVHT", "DPD", "APD", "MWD", "PRES", "ATMP",
                   "WTMP", "DEWP", "VIS", "PTDY", "TIDE"]
STATION_MISSING = ["MM", "999", "99.0", "999.0", "9999.0", "99.00", "9999", "99"]
STATION_LIMITS = {"WSPD": 90, "GST": 90, "WVHT": 90, "DPD": 90, "APD": 90, "PRES": 9000, "ATMP": 900, "WTMP": 900,
                  "DEWP": 900, "VIS": 90, "WDIR": 900, "MWD": 900}
STATION_MEASURES = ["WDIR", "WSPD", "GST", "WVHT", "DPD", "APD", "MWD", "PRES", "ATMP", "WTMP"]
# Overlapping three-month seasons and their centre month.
SEASON_MONTH = {s: i + 1 for i, s in enumerate(
    ["DJF", "JFM", "FMA", "MAM", "AMJ", "MJJ", "JJA", "JAS", "ASO", "SON", "OND", "NDJ"])}


def file_name(path: Column | None = None) -> Column:
    return F.regexp_extract(path if path is not None else F.input_file_name(), r"([^/]+)$", 1)


def sentinel_to_null(text: Column, limit: float | None = None) -> Column:
    """Numeric value of a token; missing markers, non-numbers and values at or over the limit are null."""
    v = F.when(~text.isin(STATION_MISSING), text.try_cast("double"))
    v = nan_to_null(v)
    return v if limit is None else F.when(v < limit, v)


def parse_station_lines(df: DataFrame, line: str, keep: list[str]) -> DataFrame:
    """Whitespace station records to typed rows with a UTC timestamp.

    Comment lines and lines under 15 tokens are dropped. An 18-token line is the historical layout
    without PTDY.
    """
    rows = df.where(~F.col(line).startswith("#")).withColumn("_t", F.split(F.trim(line), r"\s+"))
    rows = rows.withColumn("_n", F.size("_t")).where("_n >= 15")
    short = F.col("_n") == 18

    def token(name: str) -> Column:
        i = STATION_COLUMNS.index(name)
        j = i - 1 if i > STATION_COLUMNS.index("PTDY") else i
        return F.when(short, F.get("_t", F.lit(j))).otherwise(F.get("_t", F.lit(i)))

    when = [token(n).try_cast("int") for n in ("YY", "MM", "DD", "hh", "mm")]
    ts = F.try_make_timestamp(*when, F.lit(0))
    return rows.select(*keep, ts.alias("ts"), *[sentinel_to_null(token(m), STATION_LIMITS[m]).alias(m) for m in STATION_MEASURES]
                       ).where(F.col("ts").isNotNull())


def read_station_text(spark: SparkSession, path: str) -> DataFrame:
    """Station files (or folders of files) with station and source taken from names like ``ndbc_rt_46086.txt``; first source wins.

    Real-time files rank before historical ones for the same station and time.
    """
    lines = spark.read.text(path).withColumn("_f", F.input_file_name())
    lines = lines.withColumns({"station": F.regexp_extract("_f", r"ndbc_(?:rt|hist)_([^_./]+)", 1),
                               "src": F.when(F.col("_f").contains("_rt_"), "realtime").otherwise("historical")})
    rows = parse_station_lines(lines, "value", ["station", "src", "_f"])
    return first_per_reading(rows, [-F.col("src").eqNullSafe("realtime").cast("int"), F.col("_f")]).drop("_f")


def first_per_reading(rows: DataFrame, order: list) -> DataFrame:
    from ..operators.dedup import pick_row
    return pick_row(rows, ["station", "ts"], order, keep="min")


SERIES_SCHEMA = "struct<{key}: array<struct<t: string, v: string, type: string>>, data: array<struct<t: string, v: string, type: string>>>"


def parse_series_json(df: DataFrame, json: str, key: str, keep: list[str]) -> DataFrame:
    """Records {t, v, type} of a station document to rows; unreadable values are dropped."""
    doc = F.from_json(F.col(json), SERIES_SCHEMA.format(key=key) if key != "data" else
                      "struct<data: array<struct<t: string, v: string, type: string>>>")
    records = F.coalesce(doc[key], doc["data"])
    rows = df.select(*keep, F.inline(records))
    v = nan_to_null(F.col("v").try_cast("double"))
    return rows.select(*keep, F.try_to_timestamp(F.col("t")).alias("ts"), v.alias("v"), "type").where("v is not null and ts is not null")


def read_series_json(spark: SparkSession, path: str, key: str) -> DataFrame:
    docs = spark.read.text(path, wholetext=True).withColumn("station", F.split(file_name(), "_")[1])
    return parse_series_json(docs, "value", key, ["station"])


# Daily model variables.
MARINE_DAILY = ["wave_height_max", "swell_wave_height_max", "wave_period_max", "swell_wave_period_max",
                "wave_direction_dominant", "sea_surface_temperature_max", "sea_surface_temperature_min"]
WEATHER_DAILY = ["wind_speed_10m_max", "wind_gusts_10m_max", "wind_direction_10m_dominant", "pressure_msl_mean",
                 "cloud_cover_mean", "temperature_2m_max", "precipitation_sum"]


def daily_schema(variables: list[str]) -> str:
    return "struct<daily: struct<time: array<string>, " + ", ".join(f"{v}: array<double>" for v in variables) + ">>"


def parse_parallel_arrays(df: DataFrame, doc: Column, variables: list[str], keep: list[str]) -> DataFrame:
    """A document of parallel daily arrays to one row per day."""
    d = doc["daily"]
    zipped = F.arrays_zip(d["time"].alias("time"), *[d[v].alias(v) for v in variables])
    names = ["time", *variables]
    fixed = F.transform(zipped, lambda z: F.struct(*[z[n].alias(n) for n in names]))
    return df.select(*keep, F.inline(fixed)).withColumn("date", F.to_date("time")).drop("time")


def model_daily(marine: DataFrame, weather: DataFrame, zone: str = "zone_id") -> DataFrame:
    """Marine and weather days joined outer per zone, in output units."""
    d = full_outer(marine, weather, [zone, "date"])
    c = F.col
    return d.select(
        zone, "date", (c("wave_height_max") * 3.28084).alias("wave_ft"), (c("swell_wave_height_max") * 3.28084).alias("swell_ft"),
        c("wave_period_max").alias("wave_period_s"), c("swell_wave_period_max").alias("swell_period_s"),
        c("wave_direction_dominant").alias("wave_dir_deg"),
        ((c("sea_surface_temperature_max") + c("sea_surface_temperature_min")) / 2.0 * 9.0 / 5.0 + 32.0).alias("sst_f_model"),
        c("wind_speed_10m_max").alias("wind_kt"), c("wind_gusts_10m_max").alias("gust_kt"),
        c("wind_direction_10m_dominant").alias("wind_dir_deg"), c("pressure_msl_mean").alias("pressure_hpa"),
        c("cloud_cover_mean").alias("cloud_pct"), (c("temperature_2m_max") * 9.0 / 5.0 + 32.0).alias("air_temp_f"),
        c("precipitation_sum").alias("precip_mm"))


def read_model_daily(spark: SparkSession, marine_path: str, weather_path: str) -> DataFrame:
    """Per-zone documents whose zone id is the file name after ``om_marine_`` / ``om_wx_``."""
    def load(path, prefix, variables):
        docs = spark.read.text(path, wholetext=True).withColumn("zone_id", F.regexp_extract(file_name(), prefix + r"(.+)\.json", 1))
        return parse_parallel_arrays(docs, F.from_json("value", daily_schema(variables)), variables, ["zone_id"])
    return model_daily(load(marine_path, "om_marine_", MARINE_DAILY), load(weather_path, "om_wx_", WEATHER_DAILY))


def parse_model_16day(df: DataFrame, json: str) -> DataFrame:
    """Map zone -> {marine, weather} of parallel arrays to model columns per zone and date."""
    marine_vars = ["wave_height_max", "wave_period_max", "swell_wave_height_max"]
    weather_vars = ["wind_speed_10m_max", "wind_gusts_10m_max", "pressure_msl_mean", "cloud_cover_mean"]
    schema = f"map<string, struct<marine: {daily_schema(marine_vars)}, weather: {daily_schema(weather_vars)}>>"
    zones = df.select(F.explode(F.from_json(F.col(json), schema)).alias("zone_id", "_z"))
    mar = parse_parallel_arrays(zones, F.col("_z.marine"), marine_vars, ["zone_id"])
    wx = parse_parallel_arrays(zones, F.col("_z.weather"), weather_vars, ["zone_id"])
    c, r3 = F.col, lambda x: F.round(x, 3)
    d = full_outer(mar, wx, ["zone_id", "date"]).select(
        "zone_id", "date", r3(c("wave_height_max") * 3.28084).alias("wave_model_ft"), r3("wave_period_max").alias("wave_model_period_s"),
        r3(c("swell_wave_height_max") * 3.28084).alias("swell_model_ft"), r3(c("wind_speed_10m_max") * 0.539957).alias("wind_model_kt"),
        r3(c("wind_gusts_10m_max") * 0.539957).alias("gust_model_kt"), r3("pressure_msl_mean").alias("pressure_model_hpa"),
        r3("cloud_cover_mean").alias("cloud_model_pct"))
    from ..operators.ordered import lag_change
    return lag_change(d, "zone_id", "date", "pressure_model_hpa", 1, "pressure_trend_model_24h")


def parse_units_csv(df: DataFrame, time: str, values: list[str], keep: list[str]) -> DataFrame:
    """CSV rows read with a header whose second line holds units: the units row has no parsable time."""
    ts = F.try_to_timestamp(F.col(time))
    return df.where(ts.isNotNull()).select(*keep, F.to_date(ts).alias("date"),
                                           *[nan_to_null(F.col(v).try_cast("double")).alias(v) for v in values])


def read_units_csv(spark: SparkSession, path: str, time: str, values: list[str], keep: list[str] | None = None) -> DataFrame:
    return parse_units_csv(spark.read.option("header", True).csv(path), time, values, keep or [])


def parse_index_lines(df: DataFrame, line: str) -> DataFrame:
    """Lines "season year total anomaly" to monthly index rows; other lines are skipped, a number that cannot be read is null."""
    t = F.split(F.trim(line), r"\s+")
    month = F.try_element_at(literal_map(SEASON_MONTH), t[0])
    rows = df.where((F.size(t) == 4) & month.isNotNull())
    return rows.select(t[0].alias("season"), t[1].try_cast("int").alias("year"), month.alias("month"),
                       t[2].try_cast("double").alias("sst_c"), t[3].try_cast("double").alias("oni"))


def upwelling_daily(rows: DataFrame, latitudes: list[float] = (33.0, 32.5), value: str = "CUTI") -> DataFrame:
    """Daily mean of an index over chosen latitudes, matched with a tolerance."""
    near = F.lit(False)
    for lat in latitudes:
        near = near | (F.abs(F.col("latitude") - lat) <= 1e-8 + 1e-5 * abs(lat))
    return rows.where(near & F.col("date").isNotNull()).groupBy("date").agg(F.avg(value).alias("cuti"))


def parse_report_rows(pages: DataFrame, content: str, title: str, keep: list[str]) -> DataFrame:
    """Markdown report pages to trips: the section heading carries down onto its table rows.

    The page is cut into heading sections and lines inside its own row, so no window or shuffle is
    needed to know which heading a line belongs to.
    """
    sections = F.split(F.concat(F.lit("\n"), F.col(content)), r"\n(?=##\s)")
    sec = pages.withColumn("page_date", page_date(title)).select(*keep, "page_date", F.posexplode(sections).alias("_s", "_sec"))
    head = F.regexp_extract(F.trim(F.split("_sec", "\n", 2)[0]), r"^##\s+(.*?)\s+Fish Counts\s*$", 1)
    sec = sec.withColumn("_landing", head).where(F.col("_landing") != "")
    rows = sec.select(*keep, "page_date", "_landing", "_s", F.posexplode(F.split("_sec", "\n")).alias("_l", "_row"))
    rows = rows.where(F.col("_row").startswith("|") & ~F.col("_row").startswith("|--") & ~F.col("_row").contains("|Boat|Trip Details|"))
    cell = lambda i: F.trim(F.regexp_extract("_row", r"^\|(.+?)\|(.+?)\|(.+?)\|\s*$", i))
    rows = rows.select(*keep, "page_date", "_landing", "_s", "_l", cell(1).alias("_boat"), cell(2).alias("_trip"), cell(3).alias("_counts"))
    city = "San Diego, CA"
    short = F.try_element_at(literal_map(LANDINGS), F.col("_landing"))
    rows = rows.where(short.isNotNull() & F.col("_boat").endswith(city))
    rows = rows.withColumn("_boat", F.trim(F.regexp_replace("_boat", city + "$", "")))
    boat = F.trim(F.when(F.col("_boat").endswith(F.col("_landing")),
                         F.expr("left(_boat, length(_boat) - length(_landing))")).otherwise(F.col("_boat")))
    raw = F.trim(F.regexp_replace("_trip", r"(?i)\d+\s*Anglers?", ""))
    anglers = F.nullif(F.regexp_extract("_trip", r"(?i)(\d+)\s*Anglers?", 1), F.lit("")).try_cast("int")
    out = rows.select(*keep, "page_date", short.alias("landing"), boat.alias("boat"), raw.alias("trip_type_raw"), anglers.alias("anglers"),
                      count_items("_counts").alias("_items"), F.concat_ws(" | ", boat, F.col("_trip"), F.col("_counts")).alias("raw_text"))
    out = out.withColumn("trip_type", trip_type_page("trip_type_raw"))
    return out.withColumns({"zone_hint": zone_hint("trip_type_raw", "trip_type"), **{name: count_map("_items", m, r) for name, m, r in BUCKETS}}).drop("_items")


def _texts_of(htmls: Column) -> Column:
    """The plain texts of an array of HTML pieces: tags are spaces, entities are decoded, white space is one space."""
    def decoded(t: Column) -> Column:
        for entity, ch in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
            t = F.replace(t, F.lit(entity), F.lit(ch))
        return t

    bare = F.transform(htmls, lambda h: F.when(h.contains("<"), F.regexp_replace(h, TAG, " ")).otherwise(h))
    plain = F.transform(bare, lambda t: F.when(t.contains("&"), decoded(t)).otherwise(t))
    return F.transform(plain, lambda t: F.trim(one_space(t)))


TAG = r"(?s)<[^>]*>"


def _first_date(page: Column) -> Column:
    """First "Month d, yyyy" in the plain text of a page; only what is found has its entities and white space replaced."""
    gap = r"(?:\s|&nbsp;)++"
    found = F.regexp_extract(F.regexp_replace(page, TAG, " "), rf"(?:{MONTHS}){gap}\d{{1,2}},{gap}\d{{4}}", 0)
    return F.to_date(F.try_to_timestamp(F.nullif(F.regexp_replace(found, gap, " "), F.lit("")), F.lit("MMMM d, yyyy")))


def parse_report_html(pages: DataFrame, html: str, keep: list[str], all_trips: bool = True) -> DataFrame:
    """HTML report pages to trips. Headings h2/h3 naming a landing apply to the tables after them.

    With ``all_trips`` trips without tracked catch stay, because they are effort. A page is cleaned and cut once; what later
    steps use several times is a column of its own.
    """
    clean = F.regexp_replace(F.col(html), r"(?is)<(?:(script|style)\b.*?</\1>|!--.*?-->)", " ")
    cut = pages.select(*keep, clean.alias("_page")).select(*keep, _first_date(F.col("_page")).alias("page_date"), F.split("_page", r"(?i)(?=<h[23]\b)").alias("_sections"))
    titles = _texts_of(F.transform("_sections", lambda s: F.regexp_extract(s, r"(?is)^<h[23]\b[^>]*>(.*?)</h[23]>", 1)))
    heads = F.transform(titles, lambda t: F.coalesce(*[F.when(t.contains(long), F.lit(short)) for long, short in LANDINGS.items()]))
    # a heading that names no landing keeps the one before it
    carried = F.aggregate(heads, F.array().cast("array<string>"), lambda acc, h: F.concat(acc, F.array(F.coalesce(h, F.try_element_at(acc, F.lit(-1))))))
    sec = cut.select(*keep, "page_date", F.inline(F.arrays_zip(F.col("_sections").alias("sec"), carried.alias("landing")))).where("landing is not null")
    # the cells of a row are read before it becomes a row of its own, so that no filter reads them again
    cells = F.transform(F.regexp_extract_all("sec", F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), 1),
                        lambda tr: _texts_of(F.slice(F.regexp_extract_all(tr, F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>"), 1), 1, 3)))
    rows = sec.select(*keep, "page_date", "landing", F.explode(F.filter(cells, lambda c: F.size(c) == 3)).alias("_c"))
    boat, trip, counts = (F.col("_c")[i] for i in range(3))
    low = F.lower(boat)
    rows = rows.where(~(low.startswith("boat") | low.startswith("dock total")) & trip.rlike(r"(?i)\d+\s*Anglers?"))
    named = r"\s+(?:Fisherman's Landing|H&M Landing|Point Loma Sportfishing|Seaforth Sportfishing)\b.*$"
    raw = F.trim(F.regexp_replace(trip, r"(?i)\d+\s*Anglers?", ""))
    out = rows.select(*keep, "page_date", "landing", F.trim(F.regexp_replace(boat, named, "")).alias("boat"), raw.alias("trip_type_raw"),
                      F.regexp_extract(trip, r"(?i)(\d+)\s*Anglers?", 1).try_cast("int").alias("anglers"), count_items(counts).alias("_items"))
    out = out.withColumns({"trip_type": trip_type("trip_type_raw"), "kept": count_map("_items", True, False), "released": count_map("_items", True, True)})
    out = out.withColumn("trip_days", trip_days("trip_type")).drop("_items")
    return out if all_trips else out.where((F.size("kept") > 0) | (F.size("released") > 0))


def html_headings(pages: DataFrame, html: str, keep: list[str]) -> DataFrame:
    """Heading texts of a page in order, with entities decoded."""
    found = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<h[1-6]\b[^>]*>(.*?)</h[1-6]>"), 1)
    return pages.select(*keep, F.posexplode(_texts_of(found)).alias("position", "heading"))


def catch_rows(reports: DataFrame) -> DataFrame:
    """Report rows with catch and released maps to trip x species rows."""
    usable = reports.where(F.col("date").isNotNull() & (F.coalesce("anglers", F.lit(0)) > 0))
    rows = usable.withColumn("_d", trip_days("trip_type")).select("*", F.explode("catch").alias("species_id", "kept"))
    return rows.withColumn("released", F.coalesce(F.try_element_at("released", F.col("species_id")), F.lit(0))).withColumnRenamed(
        "_d", "trip_days").drop("catch")


def read_dimension_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def parse_dimension_csv(df: DataFrame) -> DataFrame:
    """Species dimension stored flat: comma lists and a JSON weights map back to typed columns."""
    return df.select("species_id", F.split("zones", ",").alias("zones"),
                     F.transform(F.split("season_index_monthly", ","), lambda x: x.try_cast("double")).alias("season_index"),
                     F.from_json("weights_json", "map<string,double>").alias("weights"),
                     F.array(*[F.col(c).try_cast("double") for c in ("sst_min_f", "sst_opt_lo_f", "sst_opt_hi_f", "sst_max_f")]).alias("sst_window"))


def newest_sample(samples: DataFrame, cached: DataFrame, key: str = "product") -> DataFrame:
    """Last-known-good: the newest readable sample per product, else the cached one."""
    from ..operators.dedup import pick_row
    both = samples.withColumn("_fresh", F.lit(1)).unionByName(cached.withColumn("_fresh", F.lit(0)), allowMissingColumns=True)
    return pick_row(both.where(F.col("cat").isNotNull()), [key], ["_fresh", "issued"]).drop("_fresh")
