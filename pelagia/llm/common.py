"""Shared settings and small helpers of the training-data operators."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path

# Functions sent to Python workers carry their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__package__])

#: Rows and bytes that one Arrow batch may hold, so that very long texts do not pile up in a worker.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def arrow_batches(spark: SparkSession) -> None:
    """Bound the batches sent to Python workers by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: cuts lineage with files every executor can reach."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """True for the test fold: crc32 of the id as text leaves 1 modulo 3. A null id counts as the text ``null``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % 3 == 1


def label_sample(labels: DataFrame, column: str, limit: int, train_only: bool) -> DataFrame:
    """At most ``limit`` labelled ids with one label each (majority, ties to 1), chosen by hash so that the choice repeats."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
    if train_only:
        rows = rows.where(~held_out(F.col("doc_id")))
    one = rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg(F.col(column).cast("double")) >= 0.5).cast("int").alias("label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def whole_groups(batches: Iterator[pd.DataFrame], key: list[str], rows: int = 20_000) -> Iterator[pd.DataFrame]:
    """About ``rows`` rows at a time of batches sorted by ``key``, never a part of a key's rows; the caller has bounded those of one key."""
    held: list[pd.DataFrame] = []
    n = 0
    for b in batches:
        held.append(b)
        n += len(b)
        if n >= rows:
            together = pd.concat(held, ignore_index=True)
            values = together[key].to_numpy()
            other = np.flatnonzero((values != values[-1]).any(1))
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield together.iloc[:cut]
            held, n = [together.iloc[cut:]], n - cut
    if n:
        yield pd.concat(held, ignore_index=True)


def group_of(frame: pd.DataFrame, key: list[str]) -> np.ndarray:
    """Number of its group for every row of a frame sorted by ``key``."""
    values = frame[key].to_numpy()
    return np.concatenate([[0], np.cumsum((values[1:] != values[:-1]).any(1))]).astype(np.int64)


def in_pairs_of_blocks(rows: DataFrame, key: str, member: str, block: int) -> DataFrame:
    """``rows`` dealt out so that every two members of a key meet once: i, j (blocks of the key) and side are added, and rows are sorted by key, i, j.

    A key of at most ``block`` rows is one pair (0, 0); a larger one is cut into blocks by the members' hash, and each member goes to
    the pairs that its block is in, so that no task holds more than about two blocks.
    """
    counts = rows.groupBy(key).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = rows.join(counts, key).withColumn("own", F.pmod(F.xxhash64(F.lit(11), member), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(*rows.columns, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"))
    return dealt.repartition(key, "i", "j").sortWithinPartitions(key, "i", "j", member)


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """node, label (smallest node it is connected to) of all nodes of the edges (a, b).

    Each round moves labels to neighbours and then to the label of the label, and is written; the loop ends when none changes. A label
    or neighbour that very many nodes share is only ever joined between two plain tables, which Spark may split; rows are reduced to one
    per distinct label before those are looked up.
    """
    both = written(edges.union(edges.select("b", "a")).distinct().toDF("node", "to"), "component-edges")
    labels = written(both.groupBy("node").agg(F.min("to").alias("low")).select("node", F.least("node", "low").alias("label")), "component-labels")
    for _ in range(most):
        near = both.join(labels.select(F.col("node").alias("to"), "label"), "to").groupBy("node").agg(F.min("label").alias("low"))
        moved = labels.join(near, "node").select("node", F.least("label", "low").alias("label"), F.col("label").alias("old"))
        moved = written(moved, "component-moved")
        heads = moved.select("label").distinct().join(moved.select(F.col("node").alias("label"), F.col("label").alias("next")), "label").where("next < label")
        heads = written(heads, "component-heads")
        new = written(moved.join(heads, "label", "left").select("node", F.coalesce("next", "label").alias("label"), "old"), "component-labels")
        labels = new.select("node", "label")
        if new.where("label <> old").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {most} rounds")
