"""Monthly product series and the features derived from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import dbl, ratio, total

FEATURES = (
    "MonthlyQuantity", "AvgUnitPrice", "HolidayCount", "MonthlyRevenue",
    "lag1_quantity", "lag2_quantity", "lag3_quantity", "rolling_mean_3", "GrowthRate", "Month",
    "LagRevenue1", "LagRevenue2", "LagRevenue3",
)


def monthly_measures(sales: DataFrame) -> DataFrame:
    """Sums per product and month, with the price moments that the product level needs."""
    price = F.col("UnitPrice")
    return (
        sales.where("StockCode IS NOT NULL AND YearMonth IS NOT NULL")
        .groupBy("StockCode", "YearMonth")
        .agg(
            total("Quantity").alias("MonthlyQuantity"),
            total("isholiday").alias("HolidayCount"),
            total("Revenue").alias("MonthlyRevenue"),
            total("HolidayQuantity").alias("TotalHolidayQuantity"),
            F.count(price).alias("PricedLines"),
            F.sum(price).alias("PriceSum"),
            F.sum(price * price).alias("PriceSquares"),
        )
    )


def monthly_product(sales: DataFrame) -> DataFrame:
    """Quantity, mean price, holiday lines, revenue and holiday quantity per product and month."""
    return monthly_measures(sales).select(
        "StockCode", "YearMonth", "MonthlyQuantity",
        ratio(F.col("PriceSum"), F.col("PricedLines")).alias("AvgUnitPrice"),
        "HolidayCount", "MonthlyRevenue", "TotalHolidayQuantity",
    )


def _series() -> Window:
    # One row per product and existing month: a group never exceeds the number of months.
    return Window.partitionBy("StockCode").orderBy("YearMonth")


def lags(column: str, prefix: str, suffix: str = "", count: int = 3) -> dict[str, Column]:
    """Values of the previous existing months; a missing month is skipped, not filled."""
    return {f"{prefix}{k}{suffix}": dbl(F.lag(column, k).over(_series())) for k in range(1, count + 1)}


def rolling_mean(column: str, window: int = 3) -> Column:
    """Mean of the previous ``window`` months, NULL until that many exist."""
    frame = _series().rowsBetween(-window, -1)
    return F.when(F.count(column).over(frame) == window, dbl(F.sum(column).over(frame)) / window)


def change_rate(column: str) -> Column:
    return ratio(F.col(column), F.lag(column, 1).over(_series())) - 1


def lag_features(monthly: DataFrame) -> DataFrame:
    return monthly.select(
        "StockCode", "YearMonth",
        *[c.alias(n) for n, c in lags("MonthlyQuantity", "lag", "_quantity").items()],
        *[c.alias(n) for n, c in lags("MonthlyRevenue", "LagRevenue").items()],
    )


def monthly_features(monthly: DataFrame) -> DataFrame:
    """Complete rows of the 13 features; all windows share one sort."""
    columns = {
        **lags("MonthlyQuantity", "lag", "_quantity"),
        "rolling_mean_3": rolling_mean("MonthlyQuantity"),
        "GrowthRate": change_rate("MonthlyQuantity"),
        "Month": F.month("YearMonth"),
        **lags("MonthlyRevenue", "LagRevenue"),
    }
    wide = monthly.withColumns(columns).withColumns(
        {"MonthlyQuantity": dbl("MonthlyQuantity"), "MonthlyRevenue": dbl("MonthlyRevenue")}
    )
    return wide.select("StockCode", "YearMonth", *FEATURES).dropna()


def latest_per_product(features: DataFrame) -> DataFrame:
    """The most recent row of every product; a product has one row a month.

    One ``max_by`` per number keeps fixed-width buffers, so this is a hash
    aggregate with a map side; the maximum of a struct would sort twice.
    """
    rest = [c for c in features.columns if c not in ("StockCode", "YearMonth")]
    latest = [F.max_by(c, "YearMonth").alias(c) for c in rest]
    return features.groupBy("StockCode").agg(F.max("YearMonth").alias("YearMonth"), *latest)
