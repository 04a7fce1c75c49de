"""Structured Streaming forms of the daily batch steps."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.dedup import pick_row, unseen
from ..sources.sinks import stored

# The state processor sent to Python workers carries its code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def stream_table(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def deduplicated(stream: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """Drop repeated readings within the watermark delay (overlapping re-reads)."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def hourly(stream: DataFrame, station: str, ts: str, value: str, delay: str) -> DataFrame:
    """Tumbling one-hour means per station; with append output an hour is emitted once it is closed."""
    w = F.window(ts, "1 hour")
    out = stream.withWatermark(ts, delay).groupBy(station, w).agg(F.avg(value).alias("mean_value"), F.count(value).alias("n_obs"))
    return out.select(station, F.col("window.start").alias("ts_hour"), "mean_value", "n_obs")


def upsert_sink(spark: SparkSession, path: str, keys: list[str], order: list[str], partition: str, keep: int = 2, merge=None):
    """foreachBatch writer that keeps the newest row per key (or what ``merge`` makes of the rows), copying only the partitions that a batch touches.

    ``partition`` is a column that the keys determine (the day of an hour, say), so all rows of a key lie in one partition. A batch
    reads the partitions that it touches, merges them and writes them to a folder of its own; then one small manifest file, which
    names the folder of every partition, makes the new version valid at once. What was written without a manifest is never read.
    A table has one writer at a time. Merging a batch twice changes nothing. Of the versions, the last ``keep`` stay for readers; files that none of them names go.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        manifest, _ = newest_manifest(spark, path)
        # a number whose manifest was never finished is not used again
        number = max((int(p.getName().removeprefix("v=")) for p in listed(spark, f"{path}/manifest/v=*")), default=-1)
        rows = batch.withColumn("_part", part_name(partition))
        touched = [r["_part"] for r in rows.select("_part").distinct().collect()]  # one per partition of a micro-batch
        if not touched:
            return
        folder = f"{number + 1}-{uuid.uuid4().hex}"
        if manifest is not None:
            old = read_parts(spark, path, manifest.where(F.col("_part").isin(touched)))
            rows = rows.unionByName(old.select(*rows.columns)) if old is not None else rows
        merged = merge(rows) if merge else pick_row(rows, keys, order)
        merged.repartition("_part", *keys).write.partitionBy("_part").parquet(f"{path}/data/_folder={folder}")
        entries = spark.createDataFrame([(p, folder) for p in touched], "_part string, _folder string")
        if manifest is not None:
            entries = entries.unionByName(manifest.where(~F.col("_part").isin(touched)))
        # one file, and an error if another writer has committed this number
        entries.coalesce(1).write.parquet(f"{path}/manifest/v={number + 1}")
        remove_unnamed(spark, path, number + 2 - keep)
    return write


def part_name(partition: str) -> Column:
    """Folder name of a partition's value; the prefix keeps it from being read as a date or number."""
    return F.concat(F.lit("p-"), F.coalesce(F.col(partition).cast("string"), F.lit("null")))


def newest_manifest(spark: SparkSession, path: str) -> tuple[DataFrame | None, int]:
    """Rows (_part, _folder) of the newest complete version and its number; None and -1 if there is none."""
    try:
        versions = spark.read.schema("_part string, _folder string, v long").parquet(f"{path}/manifest")
        newest = versions.agg(F.max("v").alias("v")).first()["v"]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None, -1
    return (versions.where(F.col("v") == newest).drop("v"), int(newest)) if newest is not None else (None, -1)


def read_parts(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame | None:
    """Rows of the partitions that the manifest names, with ``_part``; None if it names none."""
    named = [f"{path}/data/_folder={r['_folder']}/_part={r['_part']}" for r in manifest.collect()]  # one per partition, not per row
    return spark.read.option("basePath", f"{path}/data").parquet(*named).drop("_folder") if named else None


def listed(spark: SparkSession, pattern: str) -> list:
    """Hadoop paths that match a pattern, in whatever store the table lies."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return [s.getPath() for s in path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []]


def remove_unnamed(spark: SparkSession, path: str, oldest: int) -> None:
    """Delete manifests before the number ``oldest`` and the partition folders that no later manifest names."""
    kept = spark.read.schema("_part string, _folder string, v long").parquet(f"{path}/manifest").where(F.col("v") >= oldest)
    named = {(f"_folder={r['_folder']}", f"_part={r['_part']}") for r in kept.select("_folder", "_part").distinct().collect()}
    folders = {f for f, _ in named}
    gone = [p for p in listed(spark, f"{path}/manifest/v=*") if int(p.getName().removeprefix("v=")) < oldest]
    gone += [p for p in listed(spark, f"{path}/data/_folder=*") if p.getName() not in folders]
    gone += [p for p in listed(spark, f"{path}/data/_folder=*/_part=*") if p.getParent().getName() in folders and (p.getParent().getName(), p.getName()) not in named]
    for p in gone:
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def latest_version(spark: SparkSession, path: str) -> DataFrame:
    """Newest complete version of an upserted table."""
    manifest, _ = newest_manifest(spark, path)
    rows = read_parts(spark, path, manifest) if manifest is not None else None
    if rows is None:
        raise ValueError(f"no version of the table in {path}")
    return rows.drop("_part")


def append_unseen_sink(spark: SparkSession, path: str, key: str):
    """foreachBatch writer that appends rows with unknown keys only (content-hashed versions)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        unseen(batch, stored(spark, path, batch), key).write.mode("append").parquet(path)
    return write


def run_available(stream: DataFrame, checkpoint: str, sink=None, path: str | None = None, mode: str = "append") -> StreamingQuery:
    """Process everything available and stop; the checkpoint lets the next call continue."""
    w = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    q = w.foreachBatch(sink).start() if sink else w.format("parquet").start(path)
    q.awaitTermination()
    return q


def freshness_sink(spark: SparkSession, path: str):
    """Status per source from a stream of attempts: a failure keeps the last success. One partition per source.

    attempts: source_identifier, attempted_utc, success, newest.
    """
    fields = ["last_attempted_fetch_utc", "last_successful_fetch_utc", "newest_valid_source_timestamp"]
    write = upsert_sink(spark, path, ["source_identifier"], [], "source_identifier",
                        merge=lambda rows: rows.groupBy("source_identifier", "_part").agg(*[F.max(c).alias(c) for c in fields]))

    def attempts(batch: DataFrame, batch_id: int) -> None:
        write(batch.groupBy("source_identifier").agg(
            F.max("attempted_utc").alias(fields[0]), F.max(F.when(F.col("success"), F.col("attempted_utc"))).alias(fields[1]),
            F.max(F.when(F.col("success"), F.col("newest"))).alias(fields[2])), batch_id)
    return attempts


class Freshness(StatefulProcessor):
    """Per source: when it last succeeded, and whether it has been silent for too long since. Times are microseconds since 1970.

    A success makes a source fresh, a failure leaves the last success as it is, and ``limit`` after the last success a timer turns the
    source stale, whether or not rows come. State is one row per source; attempts of one trigger are taken in order of time.
    """

    OUTPUT = "source_identifier string, at long, freshness string, success long, newest long"

    def __init__(self, limit: int):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("freshness", "success long, newest long, freshness string")

    def known(self) -> tuple:
        return tuple(self.state.get()) if self.state.exists() else (None, None, None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # state is read once and written once for all rows of a trigger: each access is a call from Python to the JVM
        success, newest, freshness = before = self.known()
        attempts: dict[tuple, int | None] = {}  # the newest of equal attempts
        for r in rows:
            known = attempts.get((r.at, r.success))
            attempts[r.at, r.success] = r.newest if known is None or (r.newest is not None and r.newest > known) else known
        for (at, good), valid in sorted(attempts.items()):
            if freshness == "fresh" and at > success + self.limit:
                freshness = "stale"
                yield Row(source_identifier=key[0], at=success + self.limit, freshness=freshness, success=success, newest=newest)
            turned = freshness
            if good and (success is None or at >= success):
                turned, success, newest = "fresh", at, max([x for x in (newest, valid) if x is not None], default=None)
            elif success is None:
                turned = "failed"
            if turned != freshness:
                freshness = turned
                yield Row(source_identifier=key[0], at=at, freshness=freshness, success=success, newest=newest)
        if (success, newest, freshness) != before:
            self.state.update((success, newest, freshness))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if freshness == "fresh":
            self.handle.registerTimer((success + self.limit) // 1000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        success, newest, freshness = self.known()
        if freshness == "fresh":
            self.state.update((success, newest, "stale"))
            yield Row(source_identifier=key[0], at=success + self.limit, freshness="stale", success=success, newest=newest)

    def close(self) -> None:
        pass


def freshness_transitions(attempts: DataFrame, stale_after: int, delay: str) -> DataFrame:
    """Changes of freshness of every source, as a stream; a source that is silent for ``stale_after`` seconds turns stale when the watermark passes that time.

    attempts: source_identifier, attempted_utc, success, newest.
    """
    rows = attempts.withWatermark("attempted_utc", delay).select(
        "source_identifier", "attempted_utc", F.unix_micros("attempted_utc").alias("at"), F.coalesce("success", F.lit(False)).alias("success"), F.unix_micros("newest").alias("newest"))
    turns = rows.groupBy("source_identifier").transformWithState(
        statefulProcessor=Freshness(stale_after * 1_000_000), outputStructType=Freshness.OUTPUT, outputMode="append", timeMode="eventTime")
    return turns.select("source_identifier", F.timestamp_micros("at").alias("at"), "freshness", F.timestamp_micros("success").alias("last_successful_fetch_utc"),
                        F.timestamp_micros("newest").alias("newest_valid_source_timestamp"))


def with_state_store(spark: SparkSession) -> None:
    """Timers and typed state need the RocksDB state store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
