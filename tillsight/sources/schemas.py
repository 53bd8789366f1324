"""Declared schemas; nothing is inferred at read time."""

from pyspark.sql import types as T

_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "date": T.DateType(),
          "quantity": T.DecimalType(12, 3), "price": T.DecimalType(14, 4), "revenue": T.DecimalType(27, 7)}


def _table(columns: str) -> T.StructType:
    """Columns as ``name type, ...``; reading DDL would need a session."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in map(str.split, columns.split(", "))])


RETAIL_RAW = T.StructType([
    T.StructField("InvoiceNo", T.StringType()),
    T.StructField("StockCode", T.StringType()),
    T.StructField("Description", T.StringType()),
    T.StructField("Quantity", T.LongType()),
    T.StructField("InvoiceDate", T.TimestampNTZType()),
    T.StructField("UnitPrice", T.DecimalType(14, 4)),
    T.StructField("CustomerID", T.LongType()),
    T.StructField("Country", T.StringType()),
])

HOLIDAYS_RAW = T.StructType([
    T.StructField("Unnamed: 0", T.LongType()),
    T.StructField("countryOrRegion", T.StringType()),
    T.StructField("holidayName", T.StringType()),
    T.StructField("normalizeHolidayName", T.StringType()),
    T.StructField("isPaidTimeOff", T.BooleanType()),
    T.StructField("countryRegionCode", T.StringType()),
    T.StructField("date", T.TimestampNTZType()),
])

# Hand-off tables, in the order of their columns in files.
CLEAN = _table(
    "InvoiceNo string, StockCode string, Description string, Quantity quantity, InvoiceDate date, UnitPrice price, "
    "CustomerID bigint, Country string, Revenue revenue, Year int, Month_num int, day_of_week int, week int, "
    "CohortMonth date, holidayname string, isholiday int, HolidayQuantity quantity, YearMonth date")

FEATURES = _table(
    "StockCode string, YearMonth date, MonthlyQuantity double, AvgUnitPrice double, HolidayCount bigint, MonthlyRevenue double, "
    "lag1_quantity double, lag2_quantity double, lag3_quantity double, rolling_mean_3 double, GrowthRate double, Month int, "
    "LagRevenue1 double, LagRevenue2 double, LagRevenue3 double")

PRODUCT_KPIS = _table(
    "StockCode string, TotalQuantitySold double, TotalRevenue double, AvgMonthlyQuantity double, AvgMonthlyRevenue double, "
    "ActiveMonthCount bigint, StdMonthlyQuantity double, PeakMonthSale double, TotalHolidayQuantity double, AvgUnitPrice double, "
    "PriceVariance double, HolidayRatio double, UniqueCustomersCount bigint")

CUSTOMER_KPIS = _table(
    "CustomerID bigint, TotalOrders bigint, ActiveMonth bigint, AvgOrderValue double, Recency double, PurchaseFrequency double")

SEGMENTS = T.StructType([
    *CUSTOMER_KPIS, *_table("clusters int, Churn int, segment string, Customer_Text string")])
