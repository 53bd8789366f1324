"""One customer, one product and one repeated line hold a third of all rows each."""

import datetime as dt
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillsight.operators import cleaning, customers, holidays, monthly, products

ROWS = 60_000


@pytest.fixture(scope="module")
def hot(spark):
    i = F.col("id")
    third = i % 3 == 0
    return spark.range(ROWS).select(
        F.when(third, "hot").otherwise((i % 5000).cast("string")).alias("InvoiceNo"),
        F.when(third, "hot").otherwise((i % 97).cast("string")).alias("StockCode"),
        F.lit("thing").alias("Description"),
        F.when(third, 3).otherwise(i % 7 + 1).cast("long").alias("Quantity"),
        F.expr("TIMESTAMP_NTZ'2011-01-01 00:00:00' + make_dt_interval(CAST(pmod(hash(id), 400) AS INT))").alias("InvoiceDate"),
        F.when(third, 2).otherwise(i % 11 + 1).cast("decimal(12,2)").alias("UnitPrice"),
        F.when(i % 3 != 1, i % 1000 + 10).otherwise(F.lit(1)).alias("CustomerID"),
        F.when(i % 3 == 1, "EIRE").otherwise("France").alias("Country"),
    )


def test_repeated_line_folds_to_the_first(hot):
    got = cleaning.dedup_lines(hot).toPandas()
    pdf = hot.toPandas().sort_values(["InvoiceDate", "CustomerID", "Description", "Country"])
    want = pdf.drop_duplicates(["InvoiceNo", "StockCode", "Quantity", "UnitPrice"])
    order = list(want.columns)
    pd.testing.assert_frame_equal(
        got[order].sort_values(order).reset_index(drop=True), want.sort_values(order).reset_index(drop=True), check_dtype=False)
    assert (got.InvoiceNo == "hot").sum() == 1


def test_skewed_joins_are_split_and_whole(spark, hot):
    """Without broadcasts a hot customer and a hot (date, country) still give every line, over several tasks."""
    lines = hot.withColumn("InvoiceDate", F.when(F.col("CustomerID") == 1, F.expr("TIMESTAMP_NTZ'2011-03-17 00:00:00'")).otherwise(F.col("InvoiceDate")))
    lines = lines.withColumn("Description", F.sha2(F.rand(1).cast("string"), 512))  # does not compress away
    calendar = holidays.holiday_calendar(spark.createDataFrame(
        [(dt.datetime(2011, 3, 17), "Ireland", "Patrick")], "date timestamp_ntz, countryOrRegion string, holidayName string"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        cohort = cleaning.add_cohort(lines.repartition(24))
        enriched = holidays.add_holidays(cohort, calendar).select("CohortMonth", "CustomerID", "Description", "isholiday")
        rows = enriched.collect()
        plan = enriched._jdf.queryExecution().executedPlan().toString()
        assert len(rows) == ROWS
        assert all((r.isholiday == 1) == (r.CustomerID == 1) for r in rows)
        assert plan.count("SortMergeJoin(skew=true)") == 2
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_kpis_of_hot_keys_equal_pandas(hot):
    sales = hot.selectExpr(
        "* EXCEPT (InvoiceDate)", "CAST(InvoiceDate AS DATE) AS InvoiceDate", "trunc(CAST(InvoiceDate AS DATE), 'month') AS YearMonth",
        "Quantity * UnitPrice AS Revenue", "0 AS isholiday", "0L AS HolidayQuantity")
    pdf = hot.toPandas()
    pdf["UnitPrice"] = pdf.UnitPrice.astype(float)
    pdf["Revenue"] = pdf.Quantity * pdf.UnitPrice
    pdf["YearMonth"] = pdf.InvoiceDate.dt.to_period("M")

    got = customers.customer_kpis_raw(sales).toPandas().set_index("CustomerID").sort_index()
    by = pdf.groupby("CustomerID")
    assert (got.TotalOrders == by.InvoiceNo.nunique()).all()
    assert (got.ActiveMonth == by.YearMonth.nunique()).all()
    assert (got.Recency == (pdf.InvoiceDate.max() - by.InvoiceDate.max()).dt.days).all()
    orders = pdf.groupby(["InvoiceNo", "CustomerID"]).Revenue.sum().reset_index().groupby("CustomerID").Revenue.mean()
    assert got.AvgOrderValue.to_numpy() == pytest.approx(orders.to_numpy())

    kpis = products.product_kpis(sales).toPandas().set_index("StockCode").sort_index()
    by = pdf.groupby("StockCode")
    assert (kpis.UniqueCustomersCount == by.CustomerID.nunique()).all()
    assert kpis.PriceVariance.to_numpy() == pytest.approx(by.UnitPrice.var().to_numpy())
    months = pdf.groupby(["StockCode", "YearMonth"]).Quantity.sum().reset_index().groupby("StockCode").Quantity
    assert kpis.StdMonthlyQuantity.to_numpy() == pytest.approx(months.std().to_numpy())
    assert monthly.monthly_product(sales).agg(F.sum("MonthlyQuantity")).first()[0] == Decimal(int(pdf.Quantity.sum()))


def test_months_beyond_one_bit_word(spark, sales_of):
    """A customer active in 150 different months."""
    rows = [(str(m), "A", "x", 1, f"{2000 + m // 12}-{m % 12 + 1:02d}-05 00:00:00", 1.0, 5, "EIRE") for m in range(150)]
    sales = sales_of(*rows, *rows[:40])
    row = customers.customer_kpis_raw(sales.selectExpr("* EXCEPT (InvoiceDate)", "CAST(InvoiceDate AS DATE) AS InvoiceDate")).first()
    assert (row.ActiveMonth, row.TotalOrders) == (150, 150)


def test_no_sales(sales_of):
    empty = sales_of().selectExpr("* EXCEPT (InvoiceDate)", "CAST(InvoiceDate AS DATE) AS InvoiceDate")
    assert customers.customer_kpis_raw(empty).count() == 0
