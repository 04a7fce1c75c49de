"""Source-format and report-text queries: texts are built from the tables and parsed back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import LANDINGS, content_id, page_date, parse_counts, trip_type, trip_type_page, zone_hint, zone_hint_naive
from ..session import fresh_path
from ..sources import readers as rd
from . import effort as ef
from . import inputs as i
from .registry import query
from .sqlparts import part


def station_lines(spark, sf):
    """Station records with 18 or 19 tokens, missing markers and an over-limit value."""
    e = i.events(spark, sf)
    stamp = F.date_format("ts", "yyyy MM dd HH mm")
    v = F.format_string("%.2f", "value")
    wide = F.concat_ws(" ", stamp, F.lit("270"), F.format_string("%.1f", (F.col("event_id") % 120).cast("double")), F.lit("999.0"), v, F.lit("MM"), F.lit("5.5"), F.lit("200"), F.lit("1013.2"), F.lit("15.5"), v, F.lit("MM"), F.lit("MM"), F.lit("-0.4"), F.lit("MM"))
    short = F.concat_ws(" ", stamp, F.lit("270"), F.format_string("%.1f", (F.col("event_id") % 120).cast("double")), F.lit("999.0"), v, F.lit("MM"), F.lit("5.5"), F.lit("200"), F.lit("1013.2"), F.lit("15.5"), v, F.lit("MM"), F.lit("MM"), F.lit("MM"))
    line = F.when(F.col("event_id") % 50 == 0, F.concat(F.lit("# "), wide)).when(F.col("event_id") % 2 == 0, wide).otherwise(short)
    return e.select(F.col("event_type").alias("station"), "event_id", line.alias("line"))


@query("s03_station_text", "station s, event_id l, ts z, WSPD d2, GST d2, WVHT d2, PRES d2, WTMP d2", """
  SELECT event_type AS station, event_id, date_trunc('minute', ts) AS ts, CASE WHEN event_id % 120 < 90 AND event_id % 120 <> 99 THEN (event_id % 120)::DOUBLE END AS WSPD, CAST(NULL AS DOUBLE) AS GST,
    CASE WHEN round(value, 2) < 90 THEN round(value, 2) END AS WVHT, 1013.2 AS PRES, CASE WHEN round(value, 2) NOT IN (99.0, 999.0) THEN round(value, 2) END AS WTMP FROM events WHERE event_id % 50 <> 0""")
def station_text(spark, sf):
    return rd.parse_station_lines(station_lines(spark, sf), "line", ["station", "event_id"])


@query("s05_series_json", "station s, ts z, v d2, type s", """
  SELECT user_id AS station, date_trunc('minute', ts) AS ts, value AS v, CASE WHEN event_id % 2 = 0 THEN 'H' ELSE 'L' END AS type FROM events WHERE event_id % 10 <> 0""")
def series_json(spark, sf):
    e = i.events(spark, sf)
    rec = F.struct(F.date_format("ts", "yyyy-MM-dd HH:mm").alias("t"), F.when(F.col("event_id") % 10 != 0, F.col("value").cast("string")).otherwise("").alias("v"),
                   F.when(F.col("event_id") % 2 == 0, "H").otherwise("L").alias("type"))
    docs = e.select(F.col("user_id").alias("station"), F.to_json(F.struct(F.array(rec).alias("predictions"))).alias("doc"))
    return rd.parse_series_json(docs, "doc", "predictions", ["station"])


def model_docs(spark, sf, variables: dict[str, str], source, name: str):
    """One document of parallel daily arrays per zone and year (at most 366 days each)."""
    cols = [F.col(c).alias(v) for v, c in variables.items()]
    rows = source.select("zone_id", F.year("date").alias("year"), F.struct(F.col("date").cast("string").alias("time"), *cols).alias("r"))
    packed = rows.groupBy("zone_id", "year").agg(F.array_sort(F.collect_list("r")).alias("a"))
    daily = F.struct(F.col("a.time").alias("time"), *[F.col(f"a.{v}").alias(v) for v in variables])
    return packed.select("zone_id", F.to_json(F.struct(daily.alias("daily"))).alias(name))


@query("s01_model_json", "zone_id s, date t, wave_ft d4, wave_period_s d4, wind_kt d4, pressure_hpa d4, sst_f_model d4", """
  SELECT coalesce(d.zone_id, s.zone_id) AS zone_id, coalesce(d.date, s.date) AS date, d.wave_ft * 3.28084 AS wave_ft, d.wave_period_s, s.sst_f AS wind_kt, s.sst_f AS pressure_hpa, d.sst_f_model * 1.8 + 32 AS sst_f_model
  FROM p_zone_daily d FULL JOIN p_satellite s ON s.zone_id = d.zone_id AND s.date = d.date""")
def model_json(spark, sf):
    marine = {v: c for v, c in zip(rd.MARINE_DAILY, ["wave_ft", "wave_ft", "wave_period_s", "wave_period_s", "wind_kt", "sst_f_model", "sst_f_model"])}
    weather = {v: "sst_f" for v in rd.WEATHER_DAILY}
    m = model_docs(spark, sf, marine, i.zone_daily(spark, sf), "doc")
    w = model_docs(spark, sf, weather, i.satellite(spark, sf), "doc")
    parse = lambda d, v: rd.parse_parallel_arrays(d, F.from_json("doc", rd.daily_schema(v)), v, ["zone_id"])
    return rd.model_daily(parse(m, rd.MARINE_DAILY), parse(w, rd.WEATHER_DAILY))


@query("s06_units_csv", "zone_id s, date t, analysed_sst d4", "SELECT zone_id, date, CASE WHEN day(date) % 9 <> 0 THEN sst_f END AS analysed_sst FROM p_satellite")
def units_csv(spark, sf):
    s = i.satellite(spark, sf)
    val = F.when(F.dayofmonth("date") % 9 == 0, "NaN").otherwise(F.col("sst_f").cast("string"))
    rows = s.select("zone_id", F.concat(F.col("date").cast("string"), F.lit("T09:00:00Z")).alias("time"), val.alias("analysed_sst"))
    units = s.select("zone_id").distinct().select("zone_id", F.lit("UTC").alias("time"), F.lit("degree_C").alias("analysed_sst"))
    return rd.parse_units_csv(rows.unionByName(units), "time", ["analysed_sst"], ["zone_id"])


@query("s07_index_text", "season s, year i, month i, oni d2", """
  SELECT list_extract(['DJF','JFM','FMA','MAM','AMJ','MJJ','JJA','JAS','ASO','SON','OND','NDJ'], month) AS season, year, month, oni FROM p_index""")
def index_text(spark, sf):
    names = F.array(*[F.lit(s) for s in rd.SEASON_MONTH])
    idx = i.climate_index(spark, sf)
    lines = idx.select(F.format_string("  %s %d  26.50 %.2f", F.element_at(names, F.col("month")), "year", "oni").alias("line"))
    return rd.parse_index_lines(lines.unionByName(idx.limit(1).select(F.lit("SEAS YR TOTAL ANOM EXTRA").alias("line"))), "line")


@query("s08_catch_rows", "raw_id l, species_id s, kept l, released l, anglers l, trip_days d2", """
  SELECT raw_id, species_id, kept, released, anglers, trip_days FROM p_trips JOIN p_catch USING (raw_id)""")
def catch_rows(spark, sf):
    t = ef.trips_with_maps(spark, sf).withColumnsRenamed({"report_date": "date", "kept": "catch"}).drop("trip_days")
    return rd.catch_rows(t)


# report pages: one page per order, its lines written as counts
NAMES = {"ECONOMY": "Yellowtail", "SMALL": "Calico Bass", "MEDIUM": "Red Rockfish", "LARGE": "Bluefin Tuna (up to 90 pounds, gaffed)", "STANDARD": "Sculpin", "PROMO": "Dorado"}
KEYS = {"ECONOMY": "yellowtail", "SMALL": "calico_bass", "MEDIUM": "rockfish", "LARGE": "bluefin_tuna", "STANDARD": "sculpin", "PROMO": "dorado"}


def parsing_parts(spark):
    """Tasks for parsing: all shuffle partitions. Left to their bytes they become a few tasks of 64 MB, fewer than or hardly more than the cores."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def count_texts(spark, sf):
    names = F.create_map(*[F.lit(x) for kv in NAMES.items() for x in kv])
    c = ef.catch(spark, sf, parsing_parts(spark))
    kept = F.when(F.col("kept") > 0, F.concat(F.col("kept").cast("string"), F.lit(" "), F.element_at(names, F.col("species_id"))))
    rel = F.when(F.col("released") > 0, F.concat(F.col("released").cast("string"), F.lit(" "), F.element_at(names, F.col("species_id")), F.lit(" Released")))
    return c.groupBy("raw_id").agg(F.concat_ws(", ", F.sort_array(F.flatten(F.collect_list(F.array_compact(F.array(kept, rel)))))).alias("counts"))


_key_case = "CASE species_id " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in KEYS.items()) + " END"


@query("x01_parse_counts", "raw_id l, bucket s, species_key s, n l", f"""
  SELECT raw_id, CASE WHEN species_id = 'STANDARD' THEN 'unmapped' ELSE 'kept' END AS bucket, {_key_case} AS species_key, kept AS n FROM p_catch WHERE kept > 0
  UNION ALL SELECT raw_id, CASE WHEN species_id = 'STANDARD' THEN 'unmapped_released' ELSE 'released' END, {_key_case}, released FROM p_catch WHERE released > 0""")
def counts(spark, sf):
    p = count_texts(spark, sf).select("raw_id", parse_counts("counts").alias("p"))
    buckets = F.array(*[F.struct(F.lit(b).alias("bucket"), F.col(f"p.{b}").alias("m")) for b in ("kept", "released", "unmapped", "unmapped_released")])
    return p.select("raw_id", F.inline(buckets)).select("raw_id", "bucket", F.explode("m").alias("species_key", "n"))


def pages_md(spark, sf):
    t = ef.trips(spark, sf).join(count_texts(spark, sf), "raw_id")
    landing = F.when(F.col("raw_id") % 3 == 0, "Seaforth Sportfishing").when(F.col("raw_id") % 3 == 1, "H&M Landing").otherwise("Elsewhere Pier")
    body = F.format_string("intro text\n## %s Fish Counts\n|Boat|Trip Details|Counts|\n|--|--|--|\n|Boat %d %sSan Diego, CA|%d Anglers %s|%s|\n", landing, "raw_id", landing, "anglers", "trip_type_raw", "counts")
    title = F.concat(F.lit("Fish Counts by Boat - "), F.date_format("report_date", "MMMM d, yyyy"))
    return t.select("raw_id", title.alias("title"), body.alias("content"))


_type_page = """CASE WHEN trip_type_raw = '1/2 Day AM' THEN 'half_day' WHEN trip_type_raw = '1.5 Day' THEN '1.5_day' WHEN trip_type_raw = '2.5 Day' THEN '2.5_day' WHEN trip_type_raw = '3 Day' THEN '3_day'
  WHEN trip_type_raw = 'Overnight' THEN 'overnight' ELSE 'full_day' END"""
_hint = "CASE WHEN contains(trip_type_raw, 'Coronado') THEN 'coronados' WHEN trip_type_raw IN ('1.5 Day', '2.5 Day', '3 Day', 'Overnight') THEN 'offshore' ELSE 'point loma kelp' END"


@query("s09_report_pages", "raw_id l, page_date t, landing s, boat s, trip_type s, trip_type_raw s, anglers i, zone_hint s, n_kept l, n_released l, n_unmapped l", f"""
  SELECT t.raw_id, report_date AS page_date, CASE WHEN t.raw_id % 3 = 0 THEN 'Seaforth' ELSE 'H&M' END AS landing, 'Boat ' || t.raw_id AS boat, {_type_page} AS trip_type, trip_type_raw, anglers, {_hint} AS zone_hint,
    coalesce(sum(c.kept) FILTER (species_id <> 'STANDARD'), 0) AS n_kept, coalesce(sum(c.released) FILTER (species_id <> 'STANDARD'), 0) AS n_released, coalesce(sum(c.kept) FILTER (species_id = 'STANDARD'), 0) AS n_unmapped
  FROM p_trips t JOIN p_catch c USING (raw_id) WHERE t.raw_id % 3 < 2 GROUP BY ALL""")
def report_pages(spark, sf):
    r = rd.parse_report_rows(pages_md(spark, sf), "content", "title", ["raw_id"])
    total = lambda m: F.aggregate(F.map_values(m), F.lit(0).cast("bigint"), lambda a, v: a + v)
    return r.withColumns({"n_kept": total("kept"), "n_released": total("released"), "n_unmapped": total("unmapped")})


def daily_trips(spark, sf):
    """Trips of a report date with their count texts, by landing: those of a page's sections."""
    return ef.trips(spark, sf).join(count_texts(spark, sf), "raw_id").withColumn("k", F.col("raw_id") % 3)


def lines_of(k: int, line):
    """The lines of one section of a page, in the order of their trips."""
    return F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("k") == k, F.struct("raw_id", line.alias("line"))))), lambda x: x["line"]), "")


@query("s09_daily_pages", "page_date t, landing s, boat s, trip_type s, trip_type_raw s, anglers i, n_kept l, n_released l", f"""
  SELECT report_date AS page_date, CASE WHEN t.raw_id % 3 = 0 THEN 'Seaforth' ELSE 'H&M' END AS landing, 'Boat ' || t.raw_id AS boat, {_type_page} AS trip_type, trip_type_raw, CASE WHEN t.raw_id % 7 <> 0 THEN anglers END AS anglers,
    coalesce(sum(c.kept) FILTER (species_id <> 'STANDARD'), 0) AS n_kept, coalesce(sum(c.released) FILTER (species_id <> 'STANDARD'), 0) AS n_released
  FROM p_trips t JOIN p_catch c USING (raw_id) WHERE t.raw_id % 3 < 2 GROUP BY ALL""")
def daily_pages(spark, sf):
    """One page for each report date with three sections of several trips; the middle one is of a landing that is not listed, and every seventh count of anglers is no number that fits."""
    anglers = F.when(F.col("raw_id") % 7 == 0, F.lit("99999999999")).otherwise(F.col("anglers").cast("string"))
    line = lambda landing: F.format_string(f"|Boat %d {landing}San Diego, CA|%s Anglers %s|%s|\n", "raw_id", anglers, "trip_type_raw", "counts")
    table = "|Boat|Trip Details|Counts|\n|--|--|--|\n"
    content = F.concat(*[x for k, name in ((0, "Seaforth Sportfishing"), (2, "Elsewhere Pier"), (1, "H&M Landing"))
                         for x in (F.lit(f"intro of {name}\n## {name} Fish Counts\n{table}"), lines_of(k, line(name)), F.lit("|Dock Total|none|none|\n\n"))])
    pages = daily_trips(spark, sf).repartition(parsing_parts(spark), "report_date").groupBy("report_date").agg(content.alias("content"))
    pages = pages.withColumn("title", F.concat(F.lit("Fish Counts by Boat - "), F.date_format("report_date", "MMMM d, yyyy")))
    total = lambda m: F.aggregate(F.map_values(m), F.lit(0).cast("bigint"), lambda a, v: a + v)
    return rd.parse_report_rows(pages, "content", "title", []).withColumns({"n_kept": total("kept"), "n_released": total("released")})


@query("s09_daily_html", "page_date t, landing s, boat s, trip_type s, anglers i, n_kept l", """
  SELECT report_date AS page_date, CASE WHEN t.raw_id % 3 = 0 THEN 'Seaforth' ELSE 'H&M' END AS landing, 'Vessel ' || t.raw_id AS boat,
    CASE WHEN trip_type_raw LIKE 'Full Day%' THEN 'full_day' WHEN trip_type_raw = '1/2 Day AM' THEN 'half_day' WHEN trip_type_raw = 'Overnight' THEN 'overnight' ELSE replace(lower(trip_type_raw), ' ', '_') END AS trip_type,
    CASE WHEN t.raw_id % 7 <> 0 THEN anglers END AS anglers, coalesce(sum(c.kept) FILTER (species_id <> 'STANDARD'), 0) AS n_kept FROM p_trips t JOIN p_catch c USING (raw_id) GROUP BY ALL""")
def daily_html(spark, sf):
    """One page for each report date: a table before any landing is no trip, a heading without a landing keeps the one before it."""
    anglers = F.when(F.col("raw_id") % 7 == 0, F.lit("99999999999")).otherwise(F.col("anglers").cast("string"))
    row = F.format_string("<tr><td><b>Vessel %d</b> H&amp;M Landing</td><td>%s Anglers %s</td><td>%s</td></tr>", "raw_id", anglers, "trip_type_raw", "counts")
    table = lambda k: F.concat(F.lit("<table><tr><th>Boat</th><th>Trip</th><th>Counts</th></tr>"), lines_of(k, row), F.lit("</table>"))
    doc = F.concat(F.lit("<h1>Dock Totals - "), F.date_format("report_date", "MMMM d, yyyy"), F.lit("</h1><table><tr><td>Stray</td><td>5 Anglers Full Day</td><td>1 Dorado</td></tr></table>"),
                   F.lit("<h2>Seaforth Sportfishing Fish Counts</h2>"), table(0), F.lit("<h3>H&amp;M Landing</h3>"), table(1), F.lit("<h2>More boats</h2>"), table(2))
    r = rd.parse_report_html(daily_trips(spark, sf).repartition(parsing_parts(spark), "report_date").groupBy("report_date").agg(doc.alias("html")), "html", [])
    return r.withColumn("n_kept", F.aggregate(F.map_values("kept"), F.lit(0).cast("bigint"), lambda a, v: a + v))


part("p_station_minutes", """SELECT replace(event_type, '_', '-') AS station, date_trunc('minute', ts) AS ts, min(event_id) AS event_id, round(arg_min(value, event_id), 2) AS v FROM events GROUP BY 1, 2""")


@query("s04_station_files", "station s, ts z, src s, WTMP d2", """
  SELECT station, ts, CASE WHEN event_id % 3 = 0 THEN 'historical' ELSE 'realtime' END AS src, CASE WHEN x NOT IN (99.0, 999.0) THEN x END AS WTMP
  FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN round(v + 1, 2) ELSE v END AS x FROM p_station_minutes)""")
def station_files(spark, sf):
    """Real-time and historical files of every station, overlapping on a third of the readings, where the real-time one counts."""
    path, c = fresh_path(spark, "station_files"), F.col
    m = i.events(spark, sf).groupBy(F.translate("event_type", "_", "-").alias("station"), F.date_trunc("minute", "ts").alias("ts")).agg(
        F.min("event_id").alias("event_id"), F.round(F.min_by("value", "event_id"), 2).alias("v"))
    both = m.where("event_id % 3 <> 0").withColumn("kind", F.lit("rt")).unionByName(m.where("event_id % 3 <> 1").withColumns({"kind": F.lit("hist"), "v": c("v") + 1}))
    line = F.concat_ws(" ", F.date_format("ts", "yyyy MM dd HH mm"), F.lit("270 5.0 6.0 1.5 MM 5.5 200 1013.2 15.5"), F.format_string("%.2f", "v"), F.lit("MM MM MM"), F.when(c("kind") == "rt", "-0.4"))
    text = both.select(F.concat(F.lit("ndbc_"), "kind", F.lit("_"), "station").alias("name"), line.alias("value"))
    text.write.partitionBy("name").text(path)
    return rd.read_station_text(spark, f"{path}/*")


@query("s02_model_16day", "zone_id s, date t, wave_model_ft d3, wind_model_kt d3, pressure_model_hpa d3, pressure_trend_model_24h d3", """
  SELECT zone_id, date, round(wave_ft * 3.28084, 3) AS wave_model_ft, round(wind_kt * 0.539957, 3) AS wind_model_kt, floor(pressure_hpa * 100) / 100 AS pressure_model_hpa,
    floor(pressure_hpa * 100) / 100 - lag(floor(pressure_hpa * 100) / 100) OVER (PARTITION BY zone_id ORDER BY date) AS pressure_trend_model_24h FROM p_zone_daily""")
def model_16day(spark, sf):
    """One document for each year that maps every zone to its parallel arrays; the years are parsed together."""
    d = i.zone_daily(spark, sf)
    rows = d.groupBy("zone_id", F.year("date").alias("year")).agg(F.array_sort(F.collect_list(F.struct(F.col("date").cast("string").alias("time"), "wave_ft", "wind_kt", (F.floor(F.col("pressure_hpa") * 100) / 100).alias("pressure_hpa")))).alias("a"))
    null = F.transform("a", lambda x: F.lit(None).cast("double"))
    marine = F.struct(F.struct(F.col("a.time").alias("time"), F.col("a.wave_ft").alias("wave_height_max"), null.alias("wave_period_max"), null.alias("swell_wave_height_max")).alias("daily"))
    weather = F.struct(F.struct(F.col("a.time").alias("time"), F.col("a.wind_kt").alias("wind_speed_10m_max"), null.alias("wind_gusts_10m_max"), F.col("a.pressure_hpa").alias("pressure_msl_mean"), null.alias("cloud_cover_mean")).alias("daily"))
    docs = rows.groupBy("year").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("zone_id", F.struct(marine.alias("marine"), weather.alias("weather")))))).alias("doc"))
    return rd.parse_model_16day(docs, "doc")


@query("s09_report_html", "raw_id l, page_date t, landing s, boat s, trip_type s, anglers i, n_kept l", """
  SELECT t.raw_id, report_date AS page_date, CASE WHEN t.raw_id % 3 = 0 THEN 'Seaforth' ELSE 'H&M' END AS landing, 'Vessel ' || t.raw_id AS boat,
    CASE WHEN trip_type_raw LIKE 'Full Day%' THEN 'full_day' WHEN trip_type_raw = '1/2 Day AM' THEN 'half_day' WHEN trip_type_raw = 'Overnight' THEN 'overnight' ELSE replace(lower(trip_type_raw), ' ', '_') END AS trip_type, anglers,
    coalesce(sum(c.kept) FILTER (species_id <> 'STANDARD'), 0) AS n_kept FROM p_trips t JOIN p_catch c USING (raw_id) WHERE t.raw_id % 3 < 2 GROUP BY ALL""")
def report_html(spark, sf):
    t = ef.trips(spark, sf).join(count_texts(spark, sf), "raw_id")
    landing = F.when(F.col("raw_id") % 3 == 0, "Seaforth Sportfishing").when(F.col("raw_id") % 3 == 1, "H&amp;M Landing")
    head = F.coalesce(F.concat(F.lit("<h2>"), landing, F.lit(" Fish Counts</h2>")), F.lit("<h2>Other</h2>"))
    row = F.format_string("<table><tr><th>Boat</th><th>Trip</th><th>Counts</th></tr><tr><td><b>Vessel %d</b> H&amp;M Landing</td><td>%d Anglers %s</td><td>%s</td></tr></table>", "raw_id", "anglers", "trip_type_raw", "counts")
    doc = F.concat(F.lit("<html><script>var t='<h2>x</h2>';</script><h1>Dock Totals - "), F.date_format("report_date", "MMMM d, yyyy"), F.lit("</h1>"), head, row, F.lit("</html>"))
    r = rd.parse_report_html(t.select("raw_id", doc.alias("html")), "html", ["raw_id"])
    return r.withColumn("n_kept", F.aggregate(F.map_values("kept"), F.lit(0).cast("bigint"), lambda a, v: a + v))


@query("s09_page_headings", "page_id l, position i, heading s", r"""
  SELECT page_id, CAST(p - 1 AS INT) AS position, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(h[p], '<[^>]*>', ' ', 'gs'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\s+', ' ', 'g')) AS heading
  FROM (SELECT page_id, h, unnest(range(1, len(h) + 1)) AS p FROM (SELECT page_id, regexp_extract_all(html, '<h[1-6]\b[^>]*>(.*?)</h[1-6]>', 1, 'is') AS h FROM pages))""")
def headings(spark, sf):
    return rd.html_headings(i.table(spark, sf, "pages"), "html", ["page_id"])


@query("x02_x03_trip_text", "raw_id l, page_type s, outcome_type s, hint s, naive_hint s, region s", f"""
  SELECT raw_id, {_type_page} AS page_type, CASE WHEN trip_type_raw LIKE 'Full Day%' THEN 'full_day' WHEN trip_type_raw = '1/2 Day AM' THEN 'half_day' WHEN trip_type_raw = 'Overnight' THEN 'overnight' ELSE replace(lower(trip_type_raw), ' ', '_') END AS outcome_type,
    {_hint} AS hint, CASE WHEN trip_type_raw LIKE 'Full Day C%' THEN 'coronados' WHEN trip_type_raw = 'Full Day' THEN 'point loma kelp' ELSE 'offshore' END AS naive_hint,
    CASE WHEN contains(trip_type_raw, 'Coronado') THEN 'coronados' WHEN trip_type_raw = '2.5 Day' THEN 'extended_offshore' WHEN trip_type_raw IN ('1.5 Day', 'Overnight') THEN 'offshore_banks' WHEN trip_type_raw = '1/2 Day AM' THEN 'kelp_nearshore' END AS region FROM p_trips""")
def trip_text(spark, sf):
    from ..functions.text import classify_trip
    t = ef.trips(spark, sf)
    return t.select("raw_id", trip_type_page("trip_type_raw").alias("page_type"), trip_type("trip_type_raw").alias("outcome_type"), zone_hint("trip_type_raw", trip_type_page("trip_type_raw")).alias("hint"),
                    zone_hint_naive("trip_type_raw").alias("naive_hint"), classify_trip("trip_type_raw", trip_type("trip_type_raw"))["region"].alias("region"))


@query("x04_content_id", "raw_id l, content_id s", """
  SELECT raw_id, substr(sha256(report_date || '|' || trip_type || '|' || anglers || '|' || o_custkey), 1, 16) AS content_id FROM p_trips""")
def ids(spark, sf):
    return ef.trips(spark, sf).select("raw_id", content_id("report_date", "trip_type", "anglers", "o_custkey").alias("content_id"))


@query("x08_page_dates", "raw_id l, page_date t", "SELECT raw_id, report_date AS page_date FROM p_trips")
def page_dates(spark, sf):
    return ef.trips(spark, sf).select("raw_id", page_date(F.concat(F.lit("Counts - "), F.date_format("report_date", "MMMM d, yyyy"), F.lit(" (final)"))).alias("page_date"))


@query("d06_instants", "event_id l, parsed z", "SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN date_trunc('second', ts) END AS parsed FROM events")
def instants(spark, sf):
    from ..functions.dates import parse_instant
    e = i.events(spark, sf)
    text = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return e.select("event_id", parse_instant(text).alias("parsed"))


@query("d11_json_maps", "event_id l, k l, has_k b", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_extract(props, '$.k') IS NOT NULL AS has_k FROM events")
def json_maps(spark, sf):
    m = F.from_json("props", "map<string,bigint>")
    return i.events(spark, sf).select("event_id", F.try_element_at(m, F.lit("k")).alias("k"), F.coalesce(F.map_contains_key(m, "k"), F.lit(False)).alias("has_k"))
