"""Questions the business notes pose without code: retention, purchase rhythm, concentration, product labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import dbl, ratio
from ..functions.ranking import ValueCounts, with_running_totals


def cohort_retention(sales: DataFrame) -> DataFrame:
    """Active customers per first-purchase month and months since."""
    active = sales.select(
        "CohortMonth", "CustomerID",
        F.months_between("YearMonth", "CohortMonth").cast("int").alias("months_since"),
    ).distinct()
    return active.groupBy("CohortMonth", "months_since").agg(F.count("CustomerID").alias("customers"))


def purchase_rhythm(sales: DataFrame) -> DataFrame:
    """Purchase days, mean days between them and revenue per customer.

    The gaps between consecutive days add up to last minus first, so no window
    over a customer's purchases is needed.
    """
    days = sales.where("CustomerID IS NOT NULL").groupBy("CustomerID", "InvoiceDate").agg(F.sum("Revenue").alias("value"))
    out = days.groupBy("CustomerID").agg(
        F.count("InvoiceDate").alias("purchase_days"),
        F.min("InvoiceDate").alias("_first"), F.max("InvoiceDate").alias("_last"),
        dbl(F.sum("value")).alias("lifetime_value"),
    )
    gap = ratio(F.datediff("_last", "_first"), F.col("purchase_days") - 1)
    return out.select("CustomerID", "purchase_days", gap.alias("mean_gap_days"), "lifetime_value")


def revenue_concentration(sales: DataFrame) -> DataFrame:
    """Products by falling revenue with their cumulative share of all revenue."""
    totals = sales.where("StockCode IS NOT NULL").groupBy("StockCode").agg(F.sum("Revenue").cast("decimal(28,7)").alias("revenue"))
    running = with_running_totals(totals, [F.desc("revenue"), F.col("StockCode")], {"cumulative": "revenue"})
    whole = running.agg(F.max("cumulative").alias("t")).first()["t"]
    return running.select(
        "StockCode", dbl("revenue").alias("revenue"), ratio(F.col("cumulative"), F.lit(whole)).alias("cumulative_share")
    )


def product_labels(kpis: DataFrame, top: float = 0.8) -> DataFrame:
    """Top sellers, high churn and high engagement: at or above the ``top`` quantile of the products.

    Demand is judged by quantity, churn by few active months, engagement by customer reach.
    """
    cut = ValueCounts.of(kpis, ["TotalQuantitySold", "ActiveMonthCount", "UniqueCustomersCount"]).quantiles({
        "TotalQuantitySold": [top], "ActiveMonthCount": [1 - top], "UniqueCustomersCount": [top],
    })
    cut = {c: [F.lit(found).cast("double") for found in ends] for c, ends in cut.items()}  # NULL where there are no products
    return kpis.select(
        "StockCode",
        F.when(F.col("TotalQuantitySold") >= cut["TotalQuantitySold"][0], "Top Seller").otherwise("Normal").alias("demand"),
        F.when(F.col("ActiveMonthCount") <= cut["ActiveMonthCount"][0], "High").otherwise("Low").alias("churn"),
        F.when(F.col("UniqueCustomersCount") >= cut["UniqueCustomersCount"][0], "High").otherwise("Low").alias("engagement"),
    )
