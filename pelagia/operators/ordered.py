"""Ordered operators that do not gather a whole key in one task.

A plain ``Window.partitionBy(key)`` puts every row of a key into one task; a key holding a third
of the data would stall the job. Here rows are windowed per (key, time bucket), and what crosses a
bucket edge (the neighbouring row, the running total so far) comes from one aggregated row per
bucket, joined back on the same (key, bucket) hash partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import fresh_path


def time_bucket(ts: str | Column, width_seconds: int) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_micros(c.cast("timestamp")) / F.lit(width_seconds * 1_000_000)).cast("long")


def with_neighbours(df: DataFrame, keys: list[str], order: list[str], values: list[str], ts: str,
                    width_seconds: int = 86_400, following: bool = False) -> DataFrame:
    """Append ``prev_<v>`` (and ``next_<v>``) of the adjacent row per key in ``order``.

    ``order`` must start with ``ts`` and be unique within a key for a defined result. Choose
    ``width_seconds`` so that one key's rows of one bucket fit a task.
    """
    b = "_bucket"
    rows = df.withColumn(b, time_bucket(ts, width_seconds))
    part = Window.partitionBy(*keys, b).orderBy(*order)
    payload = F.struct(*values)
    rows = rows.withColumn("_prev", F.lag(payload).over(part))
    if following:
        rows = rows.withColumn("_next", F.lead(payload).over(part))

    rank = F.struct(*order)
    ends = df.withColumn(b, time_bucket(ts, width_seconds)).groupBy(*keys, b).agg(
        F.max_by(payload, rank).alias("_last"), F.min_by(payload, rank).alias("_first"))
    across = Window.partitionBy(*keys).orderBy(b)
    ends = ends.select(*keys, b, F.lag("_last").over(across).alias("_edge_prev"),
                       F.lead("_first").over(across).alias("_edge_next"))
    out = rows.join(ends, [*keys, b], "left")
    picked = {f"prev_{v}": F.coalesce(F.col("_prev"), F.col("_edge_prev"))[v] for v in values}
    if following:
        picked |= {f"next_{v}": F.coalesce(F.col("_next"), F.col("_edge_next"))[v] for v in values}
    return out.withColumns(picked).drop(b, "_prev", "_next", "_edge_prev", "_edge_next")


#: Rows of one key and bucket that a task may window; beyond it the key's rows are dealt into blocks of about this size.
BLOCK_ROWS = 1_000_000


def range_blocks(df: DataFrame, keys: list[str], order: list[str], rows: int) -> DataFrame:
    """``df`` with ``_block``: number of a contiguous range of (keys, order) of about ``rows`` rows, however they fall on keys and times.

    Ranges come from Spark's own sample of the sort columns; the table is written once in them, so the numbers stay what they are.
    """
    n = max(1, -(-df.count() // rows))
    path = fresh_path(df.sparkSession, "range-blocks")
    df.repartitionByRange(n, *keys, *order).withColumn("_block", F.spark_partition_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def running_totals(df: DataFrame, keys: list[str], order: list[str], measures: list[str], bucket: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Append ``cum_<m>``: the sum of each measure over rows up to and including this one per key.

    ``bucket`` is a column that never decreases along ``order`` (a day, an hour). Rows are summed within a part of their key, and the
    total of the key's earlier parts is carried in as one row per (key, part). Parts are the buckets where the measured counts show
    that each fits a task; otherwise they are ranges of the order, so that one key's single bucket, a third of all rows even, spreads over many
    tasks. Only the carried rows, one for each key and part, meet per key.
    """
    sums = [F.sum(F.coalesce(m, F.lit(0))).alias(f"_t_{m}") for m in measures]
    part, rows = bucket, df
    totals = df.groupBy(*keys, part).agg(F.count(F.lit(1)).alias("_n"), *sums)
    widest = totals.agg(F.max("_n")).first()[0] or 0
    if widest > block_rows:
        part, rows = "_block", range_blocks(df, keys, order, block_rows)
        totals = rows.groupBy(*keys, part).agg(F.count(F.lit(1)).alias("_n"), *sums)
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*keys, part, *[F.coalesce(F.sum(f"_t_{m}").over(before), F.lit(0)).alias(f"_c_{m}") for m in measures])
    within = Window.partitionBy(*keys, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"cum_{m}": F.sum(F.coalesce(m, F.lit(0))).over(within) for m in measures})
    out = rows.join(carried, [*keys, part], "left").withColumns({f"cum_{m}": F.col(f"cum_{m}") + F.col(f"_c_{m}") for m in measures})
    return out.select(*df.columns, *[f"cum_{m}" for m in measures])


def lag_change(daily: DataFrame, entity: str | list[str], date: str, value: str, rows_back: int, out: str) -> DataFrame:
    """value minus the value ``rows_back`` rows earlier per entity.

    Input holds one row per (entity, date), so a window partition is bounded by the calendar.
    """
    keys = [entity] if isinstance(entity, str) else entity
    w = Window.partitionBy(*keys).orderBy(date)
    return daily.withColumn(out, F.col(value) - F.lag(value, rows_back).over(w))


def date_change(daily: DataFrame, entity: str | list[str], date: str, value: str, days: int, out: str) -> DataFrame:
    """value minus the value exactly ``days`` calendar days earlier (null where that day is absent)."""
    keys = [entity] if isinstance(entity, str) else entity
    w = Window.partitionBy(*keys).orderBy(F.unix_date(date)).rangeBetween(-days, -days)
    return daily.withColumn(out, F.col(value) - F.max(value).over(w))


def trailing_mean(series: DataFrame, keys: list[str], order: list[str], value: str, rows: int, out: str) -> DataFrame:
    """Mean of the last ``rows`` rows including this one, per key of a calendar-bounded series."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-(rows - 1), 0)
    return series.withColumn(out, F.avg(value).over(w))


def ratchet(df: DataFrame, keys: list[str], order: str, value: str | Column, out: str) -> DataFrame:
    """Running maximum along ``order`` per key (leads 0..30, so partitions stay tiny)."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.max(value).over(w))
