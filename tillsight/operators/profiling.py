"""Profiles: counts, nulls, duplicates, moments, quartiles, histograms."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import dbl, mean_of
from ..functions.ranking import ValueCounts


def dataset_card(sales: DataFrame) -> DataFrame:
    """Distinct invoices, products and customers, first and last date, lines.

    Each distinct count is a narrow scan of its own, folded on the map side;
    several in one aggregate would copy every line once per column.
    """
    def distinct(column):
        return sales.select(column).distinct().agg(F.count(column)).scalar()

    totals = sales.agg(F.min("InvoiceDate").alias("first_date"), F.max("InvoiceDate").alias("last_date"),
                       F.count(F.lit(1)).alias("lines"))
    return totals.select(distinct("InvoiceNo").alias("invoices"), distinct("StockCode").alias("products"),
                         distinct("CustomerID").alias("customers"), "first_date", "last_date", "lines")


def null_profile(df: DataFrame) -> DataFrame:
    """NULL (or NaN) count of every column in one pass, one row per column."""
    def missing(field):
        c = F.col(f"`{field.name}`")
        test = c.isNull() | F.isnan(c) if field.dataType.typeName() in ("double", "float") else c.isNull()
        return F.count_if(test).alias(field.name)

    counts = df.agg(*[missing(f) for f in df.schema])
    pairs = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    return counts.selectExpr(f"stack({len(df.columns)}, {pairs}) AS (column, nulls)")


def duplicate_profile(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Repeated whole rows and repeated keys, counting every row after the first.

    Rows are grouped by all columns first, so copies fold on the map side, and
    the key level then works on distinct rows only.
    """
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    keys = rows.groupBy(*key).agg(F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_rows"))
    return keys.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("_n") - F.sum("_rows"), F.lit(0)).alias("repeated_rows"),
        F.coalesce(F.sum("_n") - F.count(F.lit(1)), F.lit(0)).alias("repeated_keys"),
    )


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max per column.

    The rows are read once, into value counts. The deviation is taken around
    the mean in a second pass over those, which loses no digits to cancellation.
    """
    counts = ValueCounts.of(df, columns)
    quartiles = counts.quantiles({c: [0.25, 0.5, 0.75] for c in counts.rows})
    mean, std = counts.moments()
    rows = [
        (c, counts.rows[c], mean[c], std[c], counts.low[c], *quartiles[c], counts.high[c]) if c in counts.rows
        else (c, 0, *[None] * 7)
        for c in columns
    ]
    return df.sparkSession.createDataFrame(
        rows, "column string, count long, mean double, std double, min double, q25 double, q50 double, q75 double, max double"
    )


def center(df: DataFrame, column: str) -> DataFrame:
    """Mean and median; a mean above the median marks a right-skewed column."""
    median = ValueCounts.of(df, [column]).quantiles({column: [0.5]})[column][0]
    mean = mean_of(column)
    return df.agg(mean.alias("mean"), F.lit(median).cast("double").alias("median"), (mean > F.lit(median).cast("double")).alias("right_skewed"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("lines"))


def auto_bins(n: int, low: float, high: float, q1: float, q3: float) -> int:
    """Number of equal bins by the 'auto' rule of numpy.

    The finer of the Sturges and the Freedman-Diaconis widths, where the latter
    is at least half the square-root width: never more than 2 sqrt(n) bins.
    """
    span = high - low
    if n == 0 or span == 0:
        return 1
    spread = max(2.0 * (q3 - q1) / n ** (1.0 / 3.0), span / math.sqrt(n) / 2)
    return math.ceil(span / min(spread, span / (math.log2(n) + 1.0)))


def histogram(df: DataFrame, column: str, bins: int | None = None) -> DataFrame:
    """Equal-width bins with the last one closed; empty bins are listed with zero."""
    counts = ValueCounts.of(df, [column])
    spark = df.sparkSession
    n = counts.rows.get(column, 0)
    if n == 0:
        return spark.range(0).selectExpr("id AS bin", "0D AS left_edge", "0D AS right_edge", "0L AS lines")
    low, high = counts.low[column], counts.high[column]
    if bins is None:
        q1, q3 = counts.quantiles({column: [0.25, 0.75]})[column]
        bins = auto_bins(n, low, high, q1, q3)
    if high == low:
        low, high = low - 0.5, high + 0.5
    step = (high - low) / bins

    def edge(i):
        return F.when(i == bins, F.lit(high)).otherwise(F.lit(low) + i * F.lit(step))

    v = F.col("value")
    guess = F.least(F.floor((v - low) / (high - low) * bins), F.lit(bins - 1))
    # Arithmetic may land one bin off; the edges decide.
    placed = guess - (v < edge(guess)).cast("int") + ((v >= edge(guess + 1)) & (guess < bins - 1)).cast("int")
    filled = counts.one(column).groupBy(placed.cast("bigint").alias("id")).agg(F.sum("rows").alias("lines"))
    i = F.col("id")
    return spark.range(bins).join(filled, "id", "left").select(
        i.alias("bin"), edge(i).alias("left_edge"), edge(i + 1).alias("right_edge"),
        F.coalesce("lines", F.lit(0)).alias("lines"),
    )


def box_plot(df: DataFrame, column: str, factor: float = 1.5) -> DataFrame:
    """Quartiles, whiskers at the extreme values inside the fences, and the number of fliers; NULLs where there are no values."""
    counts = ValueCounts.of(df, [column])
    q1, median, q3 = counts.quantiles({column: [0.25, 0.5, 0.75]})[column]
    if q1 is None:
        none = [F.lit(None).cast("double").alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")]
        return df.sparkSession.range(1).select(*none, F.lit(0).cast("long").alias("fliers"))
    low, high = q1 - factor * (q3 - q1), q3 + factor * (q3 - q1)
    v = F.col("value")
    whisker_low, whisker_high = F.least(F.min(F.when(v >= low, v)), F.lit(q1)), F.greatest(
        F.max(F.when(v <= high, v)), F.lit(q3)
    )
    box = counts.one(column).agg(
        whisker_low.alias("whisker_low"), whisker_high.alias("whisker_high"),
    )
    ends = box.first()  # one row
    fliers = F.coalesce(
        F.sum(F.when((v < ends["whisker_low"]) | (v > ends["whisker_high"]), F.col("rows"))), F.lit(0)
    )
    return counts.one(column).agg(
        F.lit(q1).alias("q1"), F.lit(median).alias("median"), F.lit(q3).alias("q3"),
        F.lit(ends["whisker_low"]).alias("whisker_low"), F.lit(ends["whisker_high"]).alias("whisker_high"),
        fliers.alias("fliers"),
    )


def grid_counts(df: DataFrame, x: str, y: str, x_step: float, y_step: float) -> DataFrame:
    """Scatter data as counts on a grid: bounded output however many points there are."""
    return df.groupBy(
        F.floor(dbl(x) / x_step).alias("x_bin"), F.floor(dbl(y) / y_step).alias("y_bin")
    ).agg(F.count(F.lit(1)).alias("points"))


def distinct_months(sales: DataFrame) -> DataFrame:
    return sales.select("Month_num", "YearMonth").distinct()


def table_shape(df: DataFrame) -> tuple[int, int]:
    return df.count(), len(df.columns)


def table_info(df: DataFrame) -> DataFrame:
    """Column, type and non-null count."""
    types = df.sparkSession.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema], "column string, type string")
    total = df.count()
    return types.join(null_profile(df), "column").select("column", "type", (F.lit(total) - F.col("nulls")).alias("non_null"))
