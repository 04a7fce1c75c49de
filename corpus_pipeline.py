"""From raw documents to packed training sequences: toxicity, language, near duplicates, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with their columns; the last returns packed pieces. A stage
works on all rows that its predecessor kept. Results of a stage are written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pelagia.llm import common, jaccard, langid, packing, templates, toxicity  # noqa: E402
from pelagia.llm.queries import LABEL_LIMIT, token_files  # noqa: E402

#: A document scored this high is rejected as toxic.
TOXIC = 0.7
#: Least share of a document's letters in words of its main language.
LANGUAGE_SHARE = 0.5


def keep_by_id(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` whose doc_id is in ``ids`` (left_semi) or is not (left_anti); a null id equals a null id."""
    chosen = ids.select("doc_id").distinct()
    return docs.join(chosen, docs.doc_id.cast("long").eqNullSafe(chosen.doc_id), how)


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents with a toxicity of 0.7 or more; texts without words, null ones too, stay."""
    sample = common.label_sample(common.table(spark, sf_dir, "labels"), "toxic", LABEL_LIMIT, train_only=True)
    scores = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, sample))
    return keep_by_id(docs, common.written(scores.where(F.col("score") >= TOXIC).select("doc_id"), "rejected"), "left_anti")


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter and those of which no language has half the letters."""
    found = langid.label_languages(docs, langid.fit_languages(docs))
    rejected = found.where((F.col("lang_pred") == "und") | (F.col("score") < LANGUAGE_SHARE)).select("doc_id")
    return keep_by_id(docs, common.written(rejected, "rejected"), "left_anti")


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near duplicates, once; a null id is no duplicate of any."""
    found = jaccard.near_duplicates(docs)
    rejected = common.written(found.where(F.col("doc_id") != F.col("class_id")).select("doc_id"), "rejected")
    kept = keep_by_id(docs, rejected, "left_anti")
    # rows that repeat an id: the first by text stays
    repeated = common.written(kept.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "repeated")
    if repeated.isEmpty():
        return kept
    again = keep_by_id(kept, repeated, "left_semi")
    first = again.groupBy("doc_id").agg(F.min(F.struct("text", *[c for c in kept.columns if c not in ("doc_id", "text")])).alias("row"))
    return keep_by_id(kept, repeated, "left_anti").unionByName(first.select("doc_id", "row.*").select(*kept.columns))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a passage of a benchmark item, re-parameterised ones too."""
    leaks = templates.leaks(docs, common.table(spark, sf_dir, "benchmark"))
    return keep_by_id(docs, common.written(leaks.select("doc_id").distinct(), "rejected"), "left_anti")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 ids."""
    pieces = packing.pack(docs, *token_files())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", clean_of_toxicity), ("language", in_a_language), ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark), ("packing", packed)]

#: SQL can't express the classifiers, MinHash and token ids; tests compare the stages with brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each result but the last is written to the shared folder and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = common.written(docs, f"stage-{name}")
    return docs
