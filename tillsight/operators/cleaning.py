"""Cleaning of raw sale lines into purchases with revenue and calendar columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import month_start, strip
from ..functions.ranking import ValueCounts
from ..functions.staging import stage

LINE_KEY = ("InvoiceNo", "StockCode", "Quantity", "UnitPrice")
REQUIRED = ("InvoiceNo", "StockCode", "Quantity", "UnitPrice", "InvoiceDate", "Revenue")
QUANTITY_TYPE = "decimal(12,3)"  # a fence over integers has at most three decimals


def drop_anonymous(sales: DataFrame) -> DataFrame:
    return sales.where(F.col("CustomerID").isNotNull())


def dedup_lines(sales: DataFrame, key: Sequence[str] = LINE_KEY) -> DataFrame:
    """Keep the earliest line per key; ties go by the remaining columns in order.

    A minimum combines on the map side, so any number of copies of one line
    costs one row per task; numbering the copies in a window would not.
    """
    order = ("InvoiceDate", "CustomerID", "Description", "Country")
    rest = [c for c in order if c in sales.columns and c not in key]
    rest += [c for c in sales.columns if c not in rest and c not in key]
    first = sales.groupBy(*key).agg(F.min(F.struct(*rest)).alias("first"))
    return first.select(*[F.col(c) if c in key else F.col(f"first.{c}").alias(c) for c in sales.columns])


def line_kind() -> Column:
    q = F.col("Quantity")
    return F.when(q > 0, "purchase").when(q == 0, "invalid").when(q < 0, "return")


def split_lines(sales: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Purchases, invalid lines and returns."""
    return sales.where("Quantity > 0"), sales.where("Quantity = 0"), sales.where("Quantity < 0")


def split_counts(sales: DataFrame) -> DataFrame:
    return sales.where(F.col("Quantity").isNotNull()).groupBy(line_kind().alias("kind")).agg(F.count(F.lit(1)).alias("lines"))


def standardize_text(sales: DataFrame, strip_special: bool = False) -> DataFrame:
    """Trim and lower the description.

    By default a missing description becomes the text ``nan``; with
    ``strip_special`` it stays NULL and everything but ``[a-z0-9 ]`` goes.
    """
    text = F.lower(strip("Description"))
    if strip_special:
        text = F.regexp_replace(text, "[^a-z0-9 ]", "")
    else:
        text = F.coalesce(text, F.lit("nan"))
    return sales.where(F.col("StockCode").isNotNull()).withColumn("Description", text)


@dataclass(frozen=True)
class Fence:
    """All None where no value was there to fit: nothing is then capped, and no price is inside."""

    q1: float | None
    q3: float | None
    lower: float | None
    upper: float | None


@dataclass(frozen=True)
class Fences:
    quantity: Fence
    price: Fence


def iqr_fence(q1: float | None, q3: float | None, factor: float = 1.5) -> Fence:
    if q1 is None or q3 is None:
        return Fence(None, None, None, None)
    return Fence(q1, q3, q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))


def fit_fences(purchases: DataFrame, factor: float = 1.5) -> Fences:
    """Exact IQR fences of Quantity and UnitPrice, both taken before either is applied.

    Only the two columns are read; the fitted fences are plain numbers, so
    applying them needs no join.
    """
    columns = ["Quantity", "UnitPrice"]
    q = ValueCounts.of(purchases, columns).quantiles({c: [0.25, 0.75] for c in columns})
    return Fences(iqr_fence(*q["Quantity"], factor), iqr_fence(*q["UnitPrice"], factor))


def cap_quantity(sales: DataFrame, fence: Fence) -> DataFrame:
    """Cap from above only; the cap may be fractional."""
    cap, quantity = F.lit(fence.upper).cast(QUANTITY_TYPE), F.col("Quantity")
    # compared before the cast: the outliers may not fit the type of the result
    return sales.withColumn("Quantity", F.when(quantity > cap, cap).otherwise(quantity.cast(QUANTITY_TYPE)))


def filter_price(sales: DataFrame, fence: Fence) -> DataFrame:
    """Keep prices strictly between zero and the upper fence."""
    return sales.where((F.col("UnitPrice") > 0) & (F.col("UnitPrice").cast("double") < F.lit(fence.upper).cast("double")))


def quantity_outliers(sales: DataFrame, fence: Fence) -> DataFrame:
    return sales.where(F.col("Quantity").cast("double") > F.lit(fence.upper).cast("double"))


def price_outliers(sales: DataFrame, fence: Fence) -> DataFrame:
    """Lines priced outside the fences, labelled by side."""
    p = F.col("UnitPrice").cast("double")
    lower, upper = (F.lit(x).cast("double") for x in (fence.lower, fence.upper))
    side = F.when(p >= upper, "above").when(p <= F.greatest(lower, F.lit(0.0)), "below")
    return sales.withColumn("side", side).where(F.col("side").isNotNull())


def calendar_parts(sales: DataFrame) -> DataFrame:
    """Year, month, weekday (Monday = 0) and ISO week of the invoice date."""
    d = F.col("InvoiceDate")
    return sales.withColumns({
        "Year": F.year(d), "Month": F.month(d), "day_of_week": F.weekday(d), "week": F.weekofyear(d),
    })


def add_revenue(sales: DataFrame) -> DataFrame:
    return sales.withColumn("Revenue", F.col("Quantity") * F.col("UnitPrice"))


def first_months(sales: DataFrame) -> DataFrame:
    """One row per customer with the month of the first purchase."""
    return (
        sales.where(F.col("CustomerID").isNotNull())
        .groupBy("CustomerID")
        .agg(month_start(F.min("InvoiceDate")).alias("CohortMonth"))
    )


def add_cohort(sales: DataFrame) -> DataFrame:
    """Attach the cohort month.

    The minimum is aggregated and joined back, not computed in a window: one
    customer may own a third of the lines. The customer table is written first,
    so that both join inputs are plain shuffles, the form in which Spark splits
    a skewed key; below the broadcast size it is broadcast anyway.
    """
    first = stage(first_months(sales), "first_months")
    return sales.join(first, "CustomerID", "left").select(*sales.columns, "CohortMonth")


def purchases_of(sales: DataFrame) -> DataFrame:
    """Known customers, no repeated lines, positive quantity, tidy text."""
    bought, _, _ = split_lines(dedup_lines(drop_anonymous(sales)))
    return standardize_text(bought)


def revenue_sign_check(sales: DataFrame) -> DataFrame:
    return sales.agg(
        F.count_if(F.col("Revenue") < 0).alias("negative_lines"),
        F.count_if(F.col("Revenue") == 0).alias("zero_lines"),
        F.count(F.lit(1)).alias("lines"),
    )
