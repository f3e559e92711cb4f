"""Bounded samples of labelled rows, and linear models written as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo parts."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % parts


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, most: int, id_col: str = "doc_id") -> DataFrame:
    """Texts with their 0/1 label (columns text, y), of about ``most`` labelled ids that ``learn`` admits.

    All are taken where there are fewer; else a fixed share by a hash of the id. Ids or labels that are null take no
    part; of several labels of an id the largest counts. The sample of (id, label) pairs has a bound by its parameter,
    so it is broadcast and the texts are not shuffled.
    """
    y = (
        labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_y"))
        .filter("_id IS NOT NULL AND _y IN (0, 1)")
        .groupBy("_id")
        .agg(F.max("_y").alias("y"))
        .withColumn(id_col, F.col("_id"))
        .filter(learn)
        .select("_id", "y")
    )
    n = y.count()
    if n > most:
        y = y.filter(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < int(most / n * (1 << 20)))
    return docs.select(F.col(id_col).alias("_id"), "text").join(F.broadcast(y), "_id").select("text", "y")


def logistic(intercept: float, terms: Sequence[tuple[float, Column]]) -> Column:
    """1 / (1 + exp(-(intercept + sum of weight x term))); sums of at most 16 terms are nested to keep expressions flat."""
    parts = [F.lit(float(w)) * t for w, t in terms]
    while len(parts) > 1:
        parts = [sum(parts[i + 1 : i + 16], parts[i]) for i in range(0, len(parts), 16)]
    z = F.lit(float(intercept)) + (parts[0] if parts else F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
