"""Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


LINE_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def line_order() -> Column:
    """Total order of line items as one number, so that first and last rows are plain hash aggregates.

    Digits from the left: order, line, part, supplier, price in cents. A struct of the same columns would make every
    such aggregate sort its whole input.
    """
    digits = (("l_linenumber", 1), ("l_partkey", 9), ("l_suppkey", 8))
    out = F.col("l_orderkey").cast("decimal(38,0)")
    for name, n in digits:
        out = (out * F.lit(10**n).cast("decimal(10,0)") + F.col(name).cast("decimal(10,0)")).cast("decimal(38,0)")
    cents = F.round(F.col("l_extendedprice") * 100).cast("decimal(10,0)")
    return (out * F.lit(10**9).cast("decimal(10,0)") + cents).cast("decimal(38,0)")


def trades(spark: SparkSession, folder: str) -> DataFrame:
    """Line items seen as trades: one price and quantity on a series and a day, with a total order in ``seq``."""
    return table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("series_id"),
        F.col("l_shipdate").cast("date").alias("date"),
        line_order().alias("seq"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("quantity"),
    )


def brand_trades(spark: SparkSession, folder: str) -> DataFrame:
    """The same trades keyed by the brand of the part, for panels with more series."""
    part = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("series_id"))
    return (
        table(spark, folder, "lineitem")
        .join(part, "l_partkey")
        .select(
            "series_id",
            F.col("l_shipdate").cast("date").alias("date"),
            line_order().alias("seq"),
            F.col("l_extendedprice").alias("price"),
            F.col("l_quantity").alias("quantity"),
        )
    )


def ticks(spark: SparkSession, folder: str) -> DataFrame:
    """Events as irregular ticks: a series may hold any number of rows, so these go through block layouts."""
    return table(spark, folder, "events").select(
        F.col("event_type").alias("series_id"), "ts", "event_id", F.col("value").alias("price")
    )


def raw_bar_text(spark: SparkSession, folder: str) -> DataFrame:
    """Line items written out as the untidy text a bar file holds, one raw row per line item.

    Gives the cleaning operators every kind of cell they must survive: two date forms and an impossible
    date, thousands separators, unit suffixes, blanks, dashes and missing cells.
    """
    q = F.col("l_quantity").cast("int")
    qs = q.cast("string")
    money = lambda c: c.cast("decimal(18,2)").cast("string")
    price = F.col("l_extendedprice")
    day = F.col("l_shipdate").cast("date")
    return table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("series_id"),
        line_order().alias("_seq"),
        *LINE_KEYS,
        F.when((F.col("l_linenumber") == 7) & (F.dayofmonth(day) == 31), F.lit("2024-13-40"))
        .when(F.col("l_linestatus") == "F", F.date_format(day, "yyyy-MM-dd"))
        .otherwise(F.date_format(day, "MM/dd/yyyy"))
        .alias("Date"),
        F.when((F.col("l_linenumber") == 5) & (F.col("l_tax") == 0.08), F.format_number(price, 2))
        .otherwise(money(price))
        .alias("Price"),
        F.when(F.col("l_discount") == 0.0, F.lit(""))
        .when(F.col("l_discount") != 0.1, money(price - F.col("l_quantity")))
        .alias("Open"),
        money(price + F.col("l_quantity")).alias("High"),
        F.concat(F.lit(" "), money(price - 2 * F.col("l_quantity")), F.lit(" ")).alias("Low"),
        F.when(q < 10, F.concat(qs, F.lit("K")))
        .when(q < 20, F.concat(F.lit("1,0"), qs))
        .when(q < 30, F.concat(F.lit("0."), qs, F.lit("m")))
        .when(q == 30, F.lit("-"))
        .when(q == 31, F.lit(""))
        .when(q == 32, F.lit(None).cast("string"))
        .when(q == 33, F.lit("1.5KM"))
        .when(q >= 40, F.concat(F.lit(" 0."), qs, F.lit("B ")))
        .otherwise(qs)
        .alias("Vol."),
        F.when(F.col("l_tax") == 0.0, F.lit(""))
        .when(F.col("l_tax") == 0.05, F.lit("-1,2.5%"))
        .otherwise(F.concat(F.round(F.col("l_tax") * 100).cast("int").cast("string"), F.lit(".25%")))
        .alias("Change %"),
    )
