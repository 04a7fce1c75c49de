"""Writers: overwrite tables, append unseen versions, keep a bounded run log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.dedup import unseen


def stored(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A table at ``path``, or an empty one shaped like ``like`` when nothing was written yet."""
    try:
        return spark.read.parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return like.limit(0)
        raise


def write_tables(tables: dict[str, DataFrame], root: str, fmt: str = "parquet") -> list[str]:
    """Overwrite each non-empty table below ``root``; returns the names written."""
    written = []
    for name, df in tables.items():
        if not df.isEmpty():
            w = df.write.mode("overwrite")
            (w.option("header", True) if fmt == "csv" else w).format(fmt).save(f"{root}/{name}")
            written.append(name)
    return written


def append_versions(spark: SparkSession, new: DataFrame, path: str, key: str, date: str) -> None:
    """Append rows whose key is not stored, partitioned by month of ``date``; stored rows stay as they are.

    Only the months of the load are read: a row's version lies in the month of its own date, so the key must determine the date.
    """
    load = new.withColumn("report_month", F.date_format(date, "yyyy-MM"))
    months = [r["report_month"] for r in load.select("report_month").distinct().collect()]  # months of one load
    known = stored(spark, path, load).where(F.col("report_month").cast("string").isin([m for m in months if m is not None]))
    unseen(load, known, key).dropDuplicates([key]).write.mode("append").partitionBy("report_month").parquet(path)


#: Fields of a trip whose content makes its version.
TRIP_FIELDS = ["landing", "boat", "trip_type_raw", "anglers", "kept_json", "released_json"]


def append_load(spark: SparkSession, fetches: DataFrame, path: str) -> None:
    """Record one load of fetched pages: its unseen trip versions, what each page lists and its fetch log, committed together.

    fetches: report_date, fetched_at_utc, ingest_method, ok, error, trips (array of structs with TRIP_FIELDS). A version's ``raw_id`` is the
    full SHA-256 of page date and fields as JSON, so different trips never share one. Trips and the listing (one row per trip on a page) are
    appended first, each with the load's name; the fetch log, one short row per page fetch, is the commit. A load that stopped half-way is
    invisible and can be repeated; fetches that are logged already add nothing.
    """
    fetched = ["report_date", "fetched_at_utc"]
    shape = fetches.select(*fetched, "ingest_method", "ok", "error").withColumns({"n_trips": F.lit(0).cast("int"), "load_id": F.lit("")})
    log = stored(spark, f"{path}/fetches", shape)
    fresh = fetches.join(log.select(*fetched), fetched, "left_anti").withColumn("n_trips", F.when(F.col("trips").isNull(), 0).otherwise(F.size("trips"))).dropDuplicates(fetched)
    named = F.sha2(F.to_json(F.array_sort(F.collect_list(F.struct(*[F.col(c).cast("string").alias(c) for c in fetched])))), 256)
    month = F.date_format("report_date", "yyyy-MM")
    load, months = fresh.agg(F.when(F.count(F.lit(1)) > 0, named), F.collect_set(month)).first()  # of the page fetches of one load
    if load is None:
        return
    trips = fresh.select(*fetched, "ingest_method", F.inline("trips")).withColumn("load_id", F.lit(load))
    trips = trips.withColumn("raw_id", content_key(trips, ["report_date", *TRIP_FIELDS]))
    first = trips.groupBy("raw_id").agg(F.min_by(F.struct(*[c for c in trips.columns if c != "raw_id"]), F.struct(*fetched, "ingest_method")).alias("t")).select("raw_id", "t.*")
    first = first.withColumn("report_month", month)
    # versions of other loads that were never committed don't count as stored; a repeated load meets its own
    seen = stored(spark, f"{path}/trips", first).where(F.col("report_month").cast("string").isin(months))
    seen = seen.where(F.col("load_id") == load).select("raw_id").unionByName(seen.join(log.select("load_id").distinct(), "load_id", "left_semi").select("raw_id"))
    unseen(first, seen, "raw_id").repartition("report_month", "report_date").write.mode("append").partitionBy("report_month").parquet(f"{path}/trips")
    trips.select(*fetched, "raw_id", "load_id").write.mode("append").parquet(f"{path}/listing")
    # one file, so the log has all fetches of a load or none; the listed ids are rows of their own, so its one task holds no page
    fresh.withColumn("load_id", F.lit(load)).select(*shape.columns).repartition(1).write.mode("append").parquet(f"{path}/fetches")


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """Ids listed on each page of committed loads, one row each (report_date, fetched_at_utc, raw_id)."""
    rows = spark.read.parquet(f"{path}/listing").join(spark.read.parquet(f"{path}/fetches").select("load_id").distinct(), "load_id", "left_semi")
    return rows.select("report_date", "fetched_at_utc", "raw_id").distinct()


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    """Trip versions of committed loads, each once, as first fetched."""
    rows = spark.read.parquet(f"{path}/trips").join(spark.read.parquet(f"{path}/fetches").select("load_id").distinct(), "load_id", "left_semi")
    rest = [c for c in rows.columns if c != "raw_id"]
    return rows.groupBy("raw_id").agg(F.min_by(F.struct(*rest), F.struct("fetched_at_utc", "load_id")).alias("t")).select("raw_id", "t.*")


def content_key(df: DataFrame, columns: list[str]) -> Column:
    """Full SHA-256 of the named fields as JSON with nulls written out; no two different rows have one text."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def ingest_counters(fetches: DataFrame, n_before: int, n_after: int) -> DataFrame:
    """Pages, good pages, failed dates and new trip versions of one ingest."""
    return fetches.agg(F.count(F.lit(1)).alias("pages"), F.count_if("ok").alias("pages_ok"),
                       F.array_sort(F.collect_set(F.when(~F.col("ok"), F.col("report_date").cast("string")))).alias("failed_dates"),
                       F.lit(n_after - n_before).alias("new_trip_versions"))


def write_ordered(df: DataFrame, columns: list[str], path: str, order: list[str] | None = None, files: int | None = None, fmt: str = "parquet") -> None:
    """Write with a contractual column order and, given ``order``, with contractual row order over all files.

    Rows are dealt into ranges of the order and sorted within them, so the files, read in the order of their names, are one sorted
    sequence; no task holds more than a range. Ties fall to the remaining columns, so a repeated run gives the same files.
    """
    out = df.select(*columns)
    if order:
        rank = [*order, *[c for c in columns if c not in order and dict(out.dtypes)[c] not in ("variant",) and not dict(out.dtypes)[c].startswith("map")]]
        out = (out.repartitionByRange(files, *rank) if files else out.repartitionByRange(*rank)).sortWithinPartitions(*rank)
    w = out.write.mode("overwrite")
    (w.option("header", True) if fmt == "csv" else w).format(fmt).save(path)


def read_in_order(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Rows of a table with ``file_no`` (place of the row's file by name) and ``row_no`` within the file, for checks of a stored order."""
    rows = (spark.read.option("header", True) if fmt == "csv" else spark.read).format(fmt).load(path)
    rows = rows.withColumns({"_file": F.input_file_name(), "_at": F.monotonically_increasing_id()})
    names = rows.select("_file").distinct().agg(F.array_sort(F.collect_list("_file"))).scalar()  # one name per file
    return rows.withColumn("file_no", F.array_position(names, F.col("_file"))).withColumn(
        "row_no", F.row_number().over(Window.partitionBy("_file").orderBy("_at"))).drop("_file", "_at")


def append_run(spark: SparkSession, run: DataFrame, path: str) -> None:
    run.write.mode("append").parquet(path)


def run_log(spark: SparkSession, path: str, order: str = "run_utc", keep: int = 2000) -> DataFrame:
    """The newest runs of the log (the stored log itself is never shortened)."""
    return spark.read.parquet(path).orderBy(F.desc(order)).limit(keep)
