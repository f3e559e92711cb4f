"""Registry of named queries, each with its SQL twin where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def rounded(df: DataFrame, digits: int = 4, **special: int) -> DataFrame:
    """Doubles rounded for comparison between engines, negative zero removed."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.dataType.simpleString() == "double":
            c = (F.round(c, special.get(f.name, digits)) + F.lit(0.0)).alias(f.name)
        elif f.dataType.simpleString() in ("int", "smallint", "tinyint"):
            c = c.cast("long").alias(f.name)
        out.append(c)
    return df.select(*out)


def r(expr: str, digits: int = 4, name: str | None = None) -> str:
    """SQL form of the same rounding."""
    return f"round({expr}, {digits}) + 0.0 AS {name or expr}"
