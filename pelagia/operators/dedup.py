"""Deduplication, latest-version and append operators.

"One row per key" is done with max_by / min_by aggregates: they combine on the map side, so a key
with very many versions never travels whole to one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pick_row(df: DataFrame, keys: list[str], order: list[Column | str], keep: str = "max") -> DataFrame:
    """The row with the greatest (or least) ``order`` tuple per key; give a total order for ties."""
    cols = [c for c in df.columns if c not in keys]
    rank = F.struct(*order)
    chooser = F.max_by if keep == "max" else F.min_by
    best = df.groupBy(*keys).agg(chooser(F.struct(*cols), rank).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


def merge_keep(old: DataFrame, new: DataFrame, keys: list[str], winner: str, tiebreak: list[str] | None = None) -> DataFrame:
    """Union of two loads with one row per key; ``winner`` is "old" (keep first) or "new" (keep last)."""
    both = old.withColumn("_load", F.lit(0)).unionByName(new.withColumn("_load", F.lit(1)), allowMissingColumns=True)
    order = [F.col("_load") if winner == "new" else -F.col("_load"), *(tiebreak or [])]
    return pick_row(both, keys, order).drop("_load")


def latest_per_key(df: DataFrame, keys: list[str], ts: str, tiebreak: list[str] | None = None,
                   not_after: Column | None = None) -> DataFrame:
    """Newest row per key, optionally as known at a point in time."""
    rows = df if not_after is None else df.where(F.col(ts) <= not_after)
    return pick_row(rows, keys, [ts, *(tiebreak or [])])


def replace_by_date(old: DataFrame, new: DataFrame, date: str) -> DataFrame:
    """A new load is authoritative for the dates it contains; other dates keep the old rows."""
    dates = new.select(F.to_date(date).alias("_d")).distinct()
    kept = old.join(dates, F.to_date(old[date]) == F.col("_d"), "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def unseen(new: DataFrame, existing: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows of ``new`` whose key is not stored yet, one per key."""
    keys = [key] if isinstance(key, str) else key
    return new.dropDuplicates(keys).join(existing.select(*keys), keys, "left_anti")


def lost_rows(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the earlier table that the newer one no longer has (empty = append-only held)."""
    return old.join(new.select(*keys), keys, "left_anti")


def first_request_per_page(pages: DataFrame, page_date: str, request_date: str) -> DataFrame:
    """Skip repeated and stale pages: the first request that served each page date is kept."""
    kept = pick_row(pages.where(F.col(page_date).isNotNull()), [page_date], [request_date], keep="min")
    return kept.withColumn("is_stale", F.col(page_date) != F.col(request_date))
