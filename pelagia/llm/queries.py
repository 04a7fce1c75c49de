"""The numbered queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .common import table
from .oracles import host_graph_sql, near_vectors_sql, spelling_groups_sql, template_leaks_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Labelled rows a classifier may learn from.
LABEL_LIMIT = 20_000


def token_files() -> tuple[str, str]:
    """Ranks file and pre-token pattern of the byte-level vocabulary; another can be given to the operators."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import COUNTS, judge_quality
    sample = common.label_sample(table(spark, sf_dir, "labels"), "quality", LABEL_LIMIT, train_only=False)
    return judge_quality(table(spark, sf_dir, "documents"), sample).select("doc_id", *COUNTS, "base_failed", "kept", "quality")


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import fit_toxicity, score_toxicity
    docs = table(spark, sf_dir, "documents")
    sample = common.label_sample(table(spark, sf_dir, "labels"), "toxic", LABEL_LIMIT, train_only=True)
    scored = score_toxicity(docs, fit_toxicity(docs, sample))
    return scored.select("doc_id", common.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op9_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import fit_languages, label_languages
    docs = table(spark, sf_dir, "documents")
    found = label_languages(docs, fit_languages(docs))
    return found.select("doc_id", common.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack
    pieces = pack(table(spark, sf_dir, "documents"), *token_files())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op7_chat_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import assemble, format_turns, read_back
    vocabulary = token_files()
    said = "\\### Assistant: </turn> ok"
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return read_back(assemble(format_turns(turns, *vocabulary)), *vocabulary)


@query
def op8_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pagetext import extract, fit_weights
    pages = table(spark, sf_dir, "pages")
    return extract(pages, fit_weights(pages)).withColumn("n_chars", F.length("text").cast("long"))


#: Rules of the url filter: host and path.
URL_ALLOW, URL_BLOCK = ["example.net/en/", "org/fr/"], ["net/", "example.com/de/"]


@query
def op2_host_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .hosts import filter_urls
    return filter_urls(table(spark, sf_dir, "pages"), URL_ALLOW, URL_BLOCK).select("page_id", "host", "path", "rule", "verdict")


@query
def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import archive_pages, read_archives
    records = read_archives(spark, archive_pages(table(spark, sf_dir, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op10_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .templates import leaks
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op11_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .polytope import near_vectors
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op12_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .variants import spelling_groups
    return spelling_groups(table(spark, sf_dir, "documents"), slips=True)


@query
def op13_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .squares import periodic_runs
    return periodic_runs(table(spark, sf_dir, "documents"), plant=True)


SQL["op2_host_graph"] = host_graph_sql(URL_ALLOW, URL_BLOCK)
SQL["op10_template_leaks"] = template_leaks_sql()
SQL["op11_cross_polytope"] = near_vectors_sql()
SQL["op12_spelling_groups"] = spelling_groups_sql()
