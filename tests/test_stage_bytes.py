"""What the stages between the order tables and the forecast move and write, on rows of their own."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from tillsight.operators import cleaning, forecast
from tillsight.plans.tables import Tables
from tillsight.sources import bridge


@pytest.fixture(scope="module")
def orders_dir(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("orders")
    written = {
        "nation": ([(4, "NATION_4"), (5, "NATION_5")], "n_nationkey long, n_name string"),
        "customer": ([(1, 4), (2, 5), (2, 5), (None, 4)], "c_custkey long, c_nationkey long"),
        "part": ([(10, "bolt"), (50, "nut"), (11, None), (None, "gap")], "p_partkey long, p_name string"),
        "orders": ([(10, 1, date(2000, 1, 5)), (12, 2, date(2000, 2, 5)), (14, 1, date(2000, 1, 6)), (None, 1, date(2000, 1, 7)), (202, 1, None)],
                   "o_orderkey long, o_custkey long, o_orderdate date"),
        "lineitem": ([
            (10, 10, 1, 2.0, 9.0, "N", "F"), (10, 10, 1, 2.0, 9.0, "N", "F"), (10, 50, 2, 50.0, 100.0, "N", "O"), (12, 11, 7, 3.0, 13.0, "N", "O"),
            (14, 10, 1, 1.0, 4.0, "N", "O"), (12, 10, 2, 4.0, 5.0, "R", "F"), (None, 10, 1, 1.0, 1.0, "N", "O"), (12, None, 1, 1.0, 1.0, "N", "O"),
            (202, 10, 3, 2.0, 5.0, "N", "O"), (99, 10, 1, 1.0, 1.0, "N", "O"),
        ], "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string"),
    }
    for name, (rows, schema) in written.items():
        spark.createDataFrame(rows, schema).withColumns(
            {"o_orderdate": F.col("o_orderdate").cast("timestamp_ntz")} if name == "orders" else {}).write.parquet(f"{root}/{name}.parquet")
    return str(root)


def test_raw_lines(spark, orders_dir):
    """Null keys and unknown orders meet nothing, repeated buyers repeat the line, every tenth first line comes twice."""
    rows = sorted((r.InvoiceNo, r.StockCode, r.Description or "", r.Quantity, float(r.UnitPrice), r.CustomerID or 0, r.Country)
                  for r in bridge.retail_raw(spark, orders_dir).collect())
    assert rows == sorted([
        *[("10", "10", "  BOLT ", 2, 1.0, 1, "NATION_4")] * 4, ("10", "50", "", 0, 0.5, 1, "NATION_4"),
        *[("12", "11", "", 60, 1.0, 2, "NATION_5")] * 2, *[("12", "10", "  BOLT ", -4, 0.25, 2, "NATION_5")] * 2,
        ("14", "10", "  BOLT ", 1, 1.0, 0, "NATION_4"), ("202", "10", "  BOLT ", 2, 0.0, 1, "NATION_4"),
    ])


def test_folding_needs_no_shuffle_behind_the_joins(spark, orders_dir):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = cleaning.purchases_of(bridge.retail_raw(spark, orders_dir))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    dealt = [re.sub(r"#\d+L?", "", keys) for keys in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)]
    assert sorted(dealt) == ["InvoiceNo", "c_custkey", "c_nationkey", "l_partkey", "n_nationkey", "o_custkey", "order_no", "p_partkey"]


def test_lines_are_the_clean_sales_without_their_text(spark, orders_dir):
    tables, both = Tables(spark, orders_dir), Tables(spark, orders_dir)
    assert tables.lines.count() and not {"raw", "clean"} & set(vars(tables))
    assert both.clean.columns == [*both.clean.columns[:2], "Description", *both.clean.columns[3:]]
    assert tables.lines.columns == [c for c in both.clean.columns if c != "Description"] == both.lines.columns
    assert sorted(map(str, tables.lines.collect())) == sorted(map(str, both.lines.collect()))


def test_targets_come_with_the_features(spark):
    """The dataset reads the features' own table: a target in the latest month, or behind a gap, is treated as before."""
    months = [date(2000, m, 1) for m in range(1, 6)]
    rows = [("a", months[k], float(k)) for k in range(5)] + [("b", months[0], 7.0), ("b", months[3], None), ("c", months[2], 1.0), ("c", months[4], 2.0), ("d", None, 3.0)]
    df = spark.createDataFrame(rows, "StockCode string, YearMonth date, MonthlyQuantity double")
    expected = forecast.add_target(df.where(F.col("YearMonth") < F.lit(months[4])))
    series = forecast.with_next_month(df)
    got = forecast.before_latest(series)
    assert got.columns == expected.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect())) == [("a", months[k], float(k), k + 1.0) for k in range(3)]
    assert series.drop(*forecast.NEXT).columns == df.columns
