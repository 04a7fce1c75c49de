"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "pelagia", master: str | None = None, **conf) -> SparkSession:
    """A session with UTC time, AQE with skew-join handling and no machine-bound settings.

    Shuffle partition counts are left to the cluster and to AQE coalescing; callers override
    through ``conf`` (keys use ``__`` for dots, e.g. ``spark__sql__shuffle__partitions=8``).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true"))
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` as the cluster names it.

    Only on a single machine, and only where the setting is absent, is a fresh temporary folder
    chosen, once per session; a cluster without the setting is an error.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="pelagia-"))
    return sc.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused table path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives executor loss."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


_STAGED: dict[tuple[str, str, str], str] = {}


def staged(spark: SparkSession, scope: str, name: str, build) -> DataFrame:
    """A table written once per application to the shared folder and read back by every later step.

    Used for tables that several jobs build on; it cuts lineage with files any executor can reach.
    """
    key = (spark.sparkContext.applicationId, scope, name)
    if key not in _STAGED:
        path = fresh_path(spark, name)
        build().write.parquet(path)
        _STAGED[key] = path
    return spark.read.parquet(_STAGED[key])
