"""Customer KPIs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import dbl, ratio
from ..functions.ranking import ValueCounts
from ..functions.staging import stage

WORD = 62  # months per bit word
CLIPPED = ("AvgOrderValue", "PurchaseFrequency", "Recency")


def total_orders(sales: DataFrame) -> DataFrame:
    return sales.where("CustomerID IS NOT NULL").groupBy("CustomerID").agg(F.count_distinct("InvoiceNo").alias("TotalOrders"))


def active_months(sales: DataFrame) -> DataFrame:
    return sales.where("CustomerID IS NOT NULL").groupBy("CustomerID").agg(F.count_distinct("YearMonth").alias("ActiveMonth"))


def recency(sales: DataFrame) -> DataFrame:
    """Whole days between each customer's last purchase and the last purchase of all."""
    reference = sales.agg(F.max("InvoiceDate").alias("d")).first()["d"]
    return sales.where("CustomerID IS NOT NULL").groupBy("CustomerID").agg(
        F.datediff(F.lit(reference), F.max("InvoiceDate")).alias("Recency")
    )


def avg_order_value(sales: DataFrame) -> DataFrame:
    """Mean over orders of the order total."""
    orders = sales.where("CustomerID IS NOT NULL AND InvoiceNo IS NOT NULL").groupBy("CustomerID", "InvoiceNo").agg(
        F.sum(F.col("Quantity") * F.col("UnitPrice")).alias("value")
    )
    return orders.groupBy("CustomerID").agg(ratio(F.sum("value"), F.count(F.lit(1))).alias("AvgOrderValue"))


def customer_kpis_raw(sales: DataFrame) -> DataFrame:
    """All KPIs before clipping, from one aggregation chain instead of four joined ones.

    Lines fold to orders, orders to customers. The months of an order travel as
    bits, one per calendar month of the data, so counting them needs neither a
    second pass nor a set per customer.
    """
    ends = sales.agg(F.min("InvoiceDate").alias("first"), F.max("InvoiceDate").alias("last")).first()
    first, last = ends["first"] or date(1970, 1, 1), ends["last"] or date(1970, 1, 1)
    start = first.year * 12 + first.month
    words = (last.year * 12 + last.month - start) // WORD + 1
    index = F.year("InvoiceDate") * 12 + F.month("InvoiceDate") - start

    def month_bit(word):
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), index - word * WORD)
        return F.when((index >= word * WORD) & (index < (word + 1) * WORD), bit).otherwise(F.lit(0).cast("long"))

    months = [f"_months{i}" for i in range(words)]
    orders = sales.where("CustomerID IS NOT NULL").groupBy("CustomerID", "InvoiceNo").agg(
        F.sum(F.col("Quantity") * F.col("UnitPrice")).alias("_value"),
        F.max("InvoiceDate").alias("_last"),
        *[F.bit_or(month_bit(i)).alias(m) for i, m in enumerate(months)],
    )
    known = F.col("InvoiceNo").isNotNull()
    kpis = orders.groupBy("CustomerID").agg(
        F.count("InvoiceNo").alias("TotalOrders"),
        reduce(add, [F.bit_count(F.bit_or(m)) for m in months]).cast("long").alias("ActiveMonth"),
        ratio(F.sum(F.when(known, F.col("_value"))), F.count("InvoiceNo")).alias("AvgOrderValue"),
        F.datediff(F.lit(ends["last"]), F.max("_last")).alias("Recency"),
    )
    return kpis.withColumn("PurchaseFrequency", ratio(F.col("TotalOrders"), F.col("ActiveMonth")))


def clip_bounds(df: DataFrame, columns: Sequence[str], low: float = 0.01, high: float = 0.99) -> dict[str, list[float]]:
    return ValueCounts.of(df, columns).quantiles({c: [low, high] for c in columns})


def clip(df: DataFrame, bounds: Mapping[str, Sequence[float]]) -> DataFrame:
    """Hold each column inside its bounds; NULL stays NULL, and a bound of None holds nothing."""
    def held(c, lo, hi):
        lo, hi = (F.lit(x).cast("double") for x in (lo, hi))
        return F.when(dbl(c) < lo, lo).when(dbl(c) > hi, hi).otherwise(dbl(c))

    return df.withColumns({c: held(c, *ends) for c, ends in bounds.items()})


def customer_kpis(sales: DataFrame) -> DataFrame:
    """KPIs with order value, frequency and recency held inside their 1st and 99th percentiles."""
    kpis = stage(customer_kpis_raw(sales), "customer_kpis_raw")  # read twice: bounds, then rows
    return clip(kpis, clip_bounds(kpis, CLIPPED))
