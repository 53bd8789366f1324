"""Retail sale lines and a holiday calendar derived from the order tables.

The order tables are clean, so anonymous, returned, repeated, oversized and
free lines are derived by key arithmetic. Holidays fall on one day of the
month per nation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COUNTRY_ALIASES = {"NATION_4": "Nation Four"}
CUT_OFF = "2001-01-01"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def retail_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sale lines with their product's text, buyer and date.

    A line carries only what comes out. It meets the parts first and the orders
    last, by the number that leaves as ``InvoiceNo``: all copies of a line then
    lie together, so that folding them needs no shuffle of its own.
    """
    qty, order = F.col("l_quantity"), F.col("l_orderkey")
    quantity = (
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), -qty)
        .when((qty == 50) & (F.col("l_linestatus") == "O"), F.lit(0.0))
        .when((F.col("l_linenumber") == 7) & (order % 4 == 0), qty * 20)
        .otherwise(qty)
    )
    price = F.when(order % 101 != 0, F.floor(F.col("l_extendedprice") / qty) / 4).otherwise(F.lit(0.0))
    lines = _table(spark, sf_dir, "lineitem").select(
        order.cast("string").alias("InvoiceNo"),
        "l_partkey",
        quantity.cast("bigint").alias("Quantity"),
        price.cast("decimal(12,2)").alias("UnitPrice"),
        ((F.col("l_linenumber") == 1) & (order % 10 == 0)).alias("copied"),
    )
    parts = _table(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_partkey") % 50 != 0, F.concat(F.lit("  "), F.upper("p_name"), F.lit(" "))).alias("Description")
    )
    buyers = _table(spark, sf_dir, "customer").join(
        _table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    orders = _table(spark, sf_dir, "orders").join(buyers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").cast("string").alias("order_no"),
        "o_orderdate",
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey")).alias("CustomerID"),
        F.col("n_name").alias("Country"),
    )
    named = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    # A tenth of the first lines appears again, dated one day later.
    copies = F.when(F.col("copied"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return named.join(orders, F.col("InvoiceNo") == F.col("order_no")).select(
        "InvoiceNo", F.col("l_partkey").cast("string").alias("StockCode"), "Description", "Quantity",
        "o_orderdate", F.explode(copies).alias("copy"), "UnitPrice", "CustomerID", "Country",
    ).select(
        "InvoiceNo", "StockCode", "Description", "Quantity",
        (F.col("o_orderdate") + F.make_dt_interval(F.col("copy"))).alias("InvoiceDate"),
        "UnitPrice", "CustomerID", "Country",
    )


def holidays_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar of (date, country, name): equi-joined on the day of the month, never crossed."""
    dates = _table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("date")).distinct()
    nations = _table(spark, sf_dir, "nation")
    main = dates.join(nations, F.day("date") == 1 + F.col("n_nationkey") % 28).select(
        "date",
        F.when(F.col("n_name") == "NATION_4", "Nation Four").otherwise(F.col("n_name")).alias("countryOrRegion"),
        F.when(F.col("n_nationkey") % 6 != 0, F.concat(F.lit("holiday of "), F.col("n_name"))).alias("holidayName"),
    )
    extra = dates.where(F.day("date") == 2).join(
        nations.where("n_nationkey = 1"), F.day("date") == F.col("n_nationkey") + 1
    ).select("date", F.col("n_name").alias("countryOrRegion"), F.lit("Zweiter Feiertag").alias("holidayName"))
    return main.unionByName(extra)
