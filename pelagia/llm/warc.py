"""WARC archives with revisit records.

Every page becomes a response record of a gzipped archive. The headers alone, read back, are shuffled by payload digest: among
records with equal payloads of at least ``least`` bytes the one with the smallest id stays, the others are joined to it. A second
set of archives, with fresh headers, holds the responses and, for the others, revisit records without payload.

Archives are written by Spark's text writer with the record end as separator and read by its reader with the version line as
separator, in any store that Spark reads. A payload may contain either: records are put together again by their Content-Length.

Defined results: a null html is an empty payload; a null url leaves the target header out, and line ends in a url are
percent-encoded there; a null page_id is id ``none`` and never the original of others; repeated rows with the smallest id of a
payload are all responses; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path
from .common import arrow_batches, written

VERSION, RECORD_END = "WARC/1.1\r\n", "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"
RECORDS_PER_FILE = 20_000
PARSED = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload string"


def record_text(kind: Column, page_id: Column, url: Column, digest: Column, length: Column, payload: Column, refers_to: Column, note: str) -> Column:
    """One record without its end. A revisit keeps the HTTP header block, whose Content-Length is that of the full payload."""
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    line = lambda key, c: F.coalesce(F.concat(F.lit(key + ": "), c, F.lit("\r\n")), F.lit(""))
    safe = F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    block = F.concat(F.lit(HTTP), length.cast("string"), F.lit(RECORD_END), F.when(kind == "response", payload).otherwise(""))
    refers = F.when(kind == "revisit", F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), name(refers_to), F.lit("\r\n"))).otherwise("")
    return F.concat(F.lit(VERSION), line("WARC-Type", kind), line("WARC-Record-ID", name(page_id)), F.lit(f"WARC-Date: {DATE}\r\n"), line("WARC-Target-URI", safe),
                    line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)), refers, F.lit(f"WARC-Warcinfo-ID: <urn:{note}>\r\n"),
                    F.lit("Content-Type: application/http; msgtype=response\r\n"), line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block)


def write_archives(records: DataFrame, path: str) -> str:
    """Write the string column ``record`` as gzipped archives below ``path``."""
    writer = records.write.option("lineSep", RECORD_END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE)
    writer.text(path)
    return path


def parse(record: bytes, with_payload: bool) -> tuple:
    head, _, block = record.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n") if ": " in x)
    number = lambda x: None if x is None or x.endswith(":none>") else int(x.rsplit(":", 1)[1][:-1])
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields["WARC-Type"]
    length = int(http.rsplit(b": ", 1)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not fit its header")
    return (number(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), kind, length, digest, number(fields.get("WARC-Refers-To")), payload.decode() if with_payload else None)


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """A row per record; payload digests are checked against the payloads."""
    arrow_batches(spark)
    columns = [x.split()[0] for x in PARSED.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = b""
        for b in batches:
            rows = []
            for value in b.value:
                held += value.encode()
                size = need(held)
                if size is None or len(held) < size:
                    if held:
                        held += VERSION.encode()  # the separator was part of a payload
                    continue
                rows.append(parse(held[:size], with_payload))
                held = b""
            out = pd.DataFrame(rows, columns=columns)
            yield out.assign(**{c: pd.array(out[c], "Int64") for c in ("page_id", "payload_bytes", "refers_to")})
        if held.strip():
            raise ValueError("an archive ends within a record")

    def need(record: bytes) -> int | None:
        """Bytes of the header, the blank line and the block; None while the header is not complete."""
        end = record.find(b"\r\n\r\n")
        if end < 0:
            return None
        return end + 4 + int(record[:end].rsplit(b"Content-Length: ", 1)[1].split(b"\r\n")[0])

    return spark.read.option("lineSep", VERSION).text(path).mapInPandas(run, PARSED)


def originals(headers: DataFrame, least: int) -> DataFrame:
    """payload_digest, refers_to (the smallest id) of payloads that several records share."""
    large = headers.where((F.col("payload_bytes") >= least) & F.col("page_id").isNotNull())
    groups = large.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
    return groups.where("n > 1").select("payload_digest", "refers_to")


def archive_pages(pages: DataFrame, path: str | None = None, least: int = 100) -> str:
    """Write the pages as archives, resolve revisits, and write the deduplicated archives; gives their folder."""
    spark = pages.sparkSession
    path = path or fresh_path(spark, "warc")
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"payload_digest": F.sha2(F.col("payload").cast("binary"), 256), "payload_bytes": F.octet_length("payload")})

    def record(kind: str, refers_to: Column, text: Column) -> Column:
        return record_text(F.lit(kind), F.col("page_id"), F.col("url"), F.col("payload_digest"), F.col("payload_bytes"), text, refers_to, path.rsplit("/", 1)[-1]).alias("record")

    raw = write_archives(rows.select(record("response", F.lit(None), F.col("payload"))), f"{path}/raw")
    headers = written(read_archives(spark, raw).drop("payload", "refers_to"), "warc-headers")
    first = written(originals(headers, least), "warc-originals")
    # both sides are written tables, so Spark can split a digest that very many records share
    shared = headers.where(F.col("payload_bytes") >= least).join(first, "payload_digest")
    revisits = written(shared.where(F.col("page_id").isNull() | (F.col("page_id") != F.col("refers_to"))), "warc-revisits")
    full, gone = read_archives(spark, raw, with_payload=True), revisits.select(F.col("page_id").alias("id"), F.col("payload_digest").alias("digest")).distinct()
    kept = full.join(gone, F.col("page_id").eqNullSafe(F.col("id")) & (F.col("payload_digest") == F.col("digest")), "left_anti")
    fresh = kept.select(record("response", F.lit(None), F.col("payload"))).unionByName(revisits.select(record("revisit", F.col("refers_to"), F.lit(""))))
    return write_archives(fresh, f"{path}/deduplicated")
