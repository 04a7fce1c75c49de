"""Registration of queries on the driver tables, each with one output spec for Spark and SQL.

A spec lists "name type": s string, i int, l bigint, b boolean, t date, z timestamp, dN double with
N decimals. Both sides are cast and rounded by the same spec, so names, types and rounding agree.
A small offset before rounding keeps exact ties (averages of few-decimal values) on one side.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPARK_TYPES = {"s": "string", "i": "int", "l": "bigint", "b": "boolean", "t": "date", "z": "timestamp"}
SQL_TYPES = {"s": "VARCHAR", "i": "INTEGER", "l": "BIGINT", "b": "BOOLEAN", "t": "DATE", "z": "TIMESTAMP"}


@dataclass
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    spec: list[tuple[str, str]]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def _offset(digits: int) -> float:
    return 0.37 * 10.0 ** -(digits + 2)


def _spark_columns(spec):
    out = []
    for name, kind in spec:
        c = F.col(f"`{name}`")
        if kind[0] == "d":
            d = int(kind[1:])
            c = F.round(c.cast("double") + _offset(d), d) + 0.0
        else:
            c = c.cast(SPARK_TYPES[kind])
        out.append(c.alias(name))
    return out


def _sql_columns(spec):
    out = []
    for name, kind in spec:
        if kind[0] == "d":
            d = int(kind[1:])
            out.append(f'round(CAST("{name}" AS DOUBLE) + {_offset(d)!r}, {d}) + 0.0::DOUBLE AS "{name}"')
        else:
            out.append(f'CAST("{name}" AS {SQL_TYPES[kind]}) AS "{name}"')
    return ", ".join(out)


def query(name: str, spec: str, sql: str | None = None):
    """Register a builder (spark, sf_dir) -> DataFrame with its output spec and, if any, its SQL."""
    parsed = [tuple(part.split()) for part in spec.split(",")]

    def wrap(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")

        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir).select(*_spark_columns(parsed))

        full = None
        if sql is not None:
            from .sqlparts import with_parts
            full = with_parts(f"SELECT {_sql_columns(parsed)} FROM ({sql}) AS result")
        REGISTRY[name] = Query(build, parsed, full)
        return fn

    return wrap
