"""Sales trends, per-customer totals and top lists over clean sales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import dbl

# Weekday number (Monday = 0) -> name.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def total_by(sales: DataFrame, key: str, column: str) -> DataFrame:
    return sales.where(F.col(key).isNotNull()).groupBy(key).agg(dbl(F.sum(column)).alias(column))


def weekday_name(col: str):
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), F.col(col) + 1)


def weekday_revenue(sales: DataFrame) -> DataFrame:
    return sales.where("day_of_week IS NOT NULL").groupBy(weekday_name("day_of_week").alias("Days")).agg(dbl(F.sum("Revenue")).alias("Revenue"))


def customer_orders(sales: DataFrame) -> DataFrame:
    return sales.where("CustomerID IS NOT NULL").groupBy("CustomerID").agg(F.count_distinct("InvoiceNo").alias("Orders"))


def customer_revenue(sales: DataFrame) -> DataFrame:
    return total_by(sales, "CustomerID", "Revenue")


def customer_orders_revenue(sales: DataFrame) -> DataFrame:
    """Orders and revenue per customer; lines fold to invoices first, so a hot customer stays spread."""
    invoices = sales.where("CustomerID IS NOT NULL").groupBy("CustomerID", "InvoiceNo").agg(F.sum("Revenue").alias("value"))
    return invoices.groupBy("CustomerID").agg(
        F.count("InvoiceNo").alias("Orders"), dbl(F.sum("value")).alias("revenue")
    )


def top_products(sales: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The ``n`` best-selling descriptions; equal totals go by name."""
    totals = sales.where("Description IS NOT NULL").groupBy(F.col("Description").alias("Product")).agg(
        F.sum(column).alias("_total")
    )
    return totals.orderBy(F.desc("_total"), "Product").limit(n).select("Product", dbl("_total").alias(column))
