"""Product KPIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import dbl, mean_of, ratio, variance
from .monthly import monthly_measures


def _rollup_columns() -> list[Column]:
    q = F.col("MonthlyQuantity")
    return [
        dbl(F.sum(q)).alias("TotalQuantitySold"),
        dbl(F.sum("MonthlyRevenue")).alias("TotalRevenue"),
        mean_of("MonthlyQuantity").alias("AvgMonthlyQuantity"),
        mean_of("MonthlyRevenue").alias("AvgMonthlyRevenue"),
        F.count("YearMonth").alias("ActiveMonthCount"),  # one row per month already
        F.sqrt(variance(F.sum(q), F.sum(q * q), F.count(q))).alias("StdMonthlyQuantity"),
        dbl(F.max(q)).alias("PeakMonthSale"),
        dbl(F.sum("TotalHolidayQuantity")).alias("TotalHolidayQuantity"),
    ]


def _pricing_columns(lines: Column, price: Column, squares: Column) -> list[Column]:
    return [ratio(price, lines).alias("AvgUnitPrice"), variance(price, squares, lines).alias("PriceVariance")]


def product_rollup(monthly: DataFrame) -> DataFrame:
    """Second aggregation level: months to products."""
    return monthly.groupBy("StockCode").agg(*_rollup_columns())


def product_pricing(sales: DataFrame) -> DataFrame:
    p = F.col("UnitPrice")
    return sales.where("StockCode IS NOT NULL").groupBy("StockCode").agg(
        *_pricing_columns(F.count(p), F.sum(p), F.sum(p * p))
    )


def product_reach(sales: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct customers per product; ``approximate`` trades exactness for a one-pass sketch."""
    distinct = F.approx_count_distinct("CustomerID") if approximate else F.count_distinct("CustomerID")
    return sales.where("StockCode IS NOT NULL").groupBy("StockCode").agg(distinct.alias("UniqueCustomersCount"))


def product_kpis(sales: DataFrame) -> DataFrame:
    """Rollup, pricing and reach per product.

    Rollup and pricing both come from the monthly sums, so the lines are read
    once for them and once for the customers; the join is already partitioned
    by StockCode on both sides.
    """
    kpis = monthly_measures(sales).groupBy("StockCode").agg(
        *_rollup_columns(), *_pricing_columns(F.sum("PricedLines"), F.sum("PriceSum"), F.sum("PriceSquares"))
    )
    holiday = F.coalesce(ratio(F.col("TotalHolidayQuantity"), F.col("TotalQuantitySold")), F.lit(0.0))
    return kpis.withColumn("HolidayRatio", holiday).join(product_reach(sales), "StockCode", "left")
