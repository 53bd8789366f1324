"""Edge rows of cleaning, holidays and the monthly series."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillsight.operators import cleaning, customers, holidays, monthly, products
from tillsight.plans.tables import clean_sales

LINE = ("1", "A", " Red MUG ", 2, "2011-01-03 10:00:00", 2.5, 7, "EIRE")


def line(**change):
    names = ("InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country")
    return tuple({**dict(zip(names, LINE)), **change}[n] for n in names)


def test_dedup_keeps_the_earliest(sales_of):
    out = cleaning.dedup_lines(sales_of(line(InvoiceDate="2011-01-05 00:00:00", CustomerID=9), line(), line(Quantity=3))).collect()
    assert sorted((r.Quantity, r.InvoiceDate.day, r.CustomerID) for r in out) == [(2, 3, 7), (3, 3, 7)]


def test_dedup_treats_null_keys_as_equal(sales_of):
    assert cleaning.dedup_lines(sales_of(line(UnitPrice=None), line(UnitPrice=None))).count() == 1


def test_split_adds_up(sales_of):
    sales = sales_of(line(), line(Quantity=0), line(Quantity=-4), line(Quantity=9))
    assert [p.count() for p in cleaning.split_lines(sales)] == [2, 1, 1]
    assert {r.kind: r.lines for r in cleaning.split_counts(sales).collect()} == {"purchase": 2, "invalid": 1, "return": 1}


def test_text(sales_of):
    sales = sales_of(line(Description="\t Red-MUG #2 \n"), line(Description=None), line(StockCode=None))
    assert sorted(r.Description for r in cleaning.standardize_text(sales).collect()) == ["nan", "red-mug #2"]
    assert {r.Description for r in cleaning.standardize_text(sales, strip_special=True).collect()} == {"redmug 2", None}


def test_fractional_cap_and_strict_price_fence(sales_of):
    sales = sales_of(*[line(InvoiceNo=str(i), Quantity=q, UnitPrice=p) for i, (q, p) in enumerate(
        [(1, 1), (2, 2), (4, 3), (100, 4)])])
    fences = cleaning.fit_fences(sales)
    # quartiles 1.75 and 28 of the quantities; 1.75 and 3.25 of the prices
    assert fences.quantity.upper == 28 + 1.5 * 26.25
    assert fences.price.upper == 5.5
    capped = cleaning.cap_quantity(sales, fences.quantity).agg(F.max("Quantity")).first()[0]
    assert capped == Decimal("67.375")
    on_fence = sales_of(line(UnitPrice=5.5), line(UnitPrice=5.49), line(UnitPrice=0))
    assert [float(r.UnitPrice) for r in cleaning.filter_price(on_fence, fences.price).collect()] == [5.49]


def test_nulls_pass_through_caps(spark, sales_of):
    assert cleaning.cap_quantity(sales_of(line(Quantity=None)), cleaning.iqr_fence(1, 2)).first().Quantity is None
    df = spark.sql("SELECT * FROM VALUES (CAST(NULL AS DOUBLE)), (0.5D), (9D) AS t(v)")
    assert [r.v for r in customers.clip(df, {"v": [1.0, 2.0]}).collect()] == [None, 1.0, 2.0]


def test_fences_are_those_of_the_folded_lines(t):
    assert cleaning.fit_fences(cleaning.purchases_of(t.raw)) == t.fences


def test_iso_week_and_monday_zero(sales_of):
    row = cleaning.calendar_parts(sales_of(line(InvoiceDate="2011-01-01 08:00:00"))).first()
    assert (row.Year, row.Month, row.day_of_week, row.week) == (2011, 1, 5, 52)


def holiday_rows(spark, *rows):
    return spark.createDataFrame(
        [(dt.datetime.fromisoformat(d), c, n) for d, c, n in rows],
        "date timestamp_ntz, countryOrRegion string, holidayName string")


def test_calendar_flags_and_unknown_name(spark):
    raw = holiday_rows(spark, ("2011-01-01", "Ireland", None), ("2011-01-02", "Ireland", " New "), ("2011-01-31", "Ireland", "x"))
    days = {r.date.day: r for r in holidays.holiday_calendar(raw).collect()}
    assert days[1].is_weekend and days[2].is_weekend and not days[31].is_weekend
    assert days[1].month_start and days[31].month_end and not days[2].month_end
    assert days[1].holidayname == "Unknown Holiday" and days[2].holidayname == "New"


def test_calendar_by_name_keeps_each_name(spark):
    raw = holiday_rows(spark, ("2011-01-01", " south africa", "new year"), ("2011-01-01", " south africa", None))
    rows = {r.holidayname: r for r in holidays.holiday_calendar_by_name(raw).collect()}
    assert rows["New Year"].isholiday == 1 and rows[None].isholiday == 0
    assert rows["New Year"].countryorregion == "South Africa"


def test_repeated_holiday_breaks_the_join_until_folded(spark, sales_of):
    raw = holiday_rows(spark, ("2011-01-03", "Ireland", "a"), ("2011-01-03", "Ireland", "b"))
    doubled = raw.select(F.to_date("date").alias("date"), F.col("countryOrRegion").alias("countryorregion"),
                         F.col("holidayName").alias("holidayname"), F.lit(1).alias("isholiday"))
    with pytest.raises(ValueError, match="not unique"):
        holidays.add_holidays(sales_of(line()), doubled)
    out = holidays.add_holidays(sales_of(line(), line(Country="France")), holidays.holiday_calendar(raw)).collect()
    assert sorted((r.Country, r.holidayname, r.isholiday, r.HolidayQuantity) for r in out) == [
        ("EIRE", "a", 1, 2), ("France", "Non-holiday", 0, 0)]


def test_country_aliases(spark):
    df = spark.createDataFrame([(" EIRE ",), ("RSA",), ("USA",), ("Czech Republic",), ("France",)], "Country string")
    out = [r[0] for r in df.select(holidays.alias_country("Country")).collect()]
    assert out == ["Ireland", "South Africa", "United States", "Czech", "France"]


def test_title_case_as_python(spark):
    words = ["new year's day", "ST. PATRICK'S", " côte d'ivoire ", "a-b 3rd x_y", ""]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    assert [r[0] for r in df.select(holidays.title_case("w")).collect()] == [w.strip().title() for w in words]


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2)], "` Unnamed: 0` int, `countryOrRegion` int")
    assert holidays.normalize_names(df).columns == ["unnamed: 0", "countryorregion"]
    assert holidays.normalize_names(df, underscore=True).columns == ["unnamed:_0", "countryorregion"]


def test_clean_sales_end_to_end(spark, sales_of):
    sales = sales_of(
        line(), line(InvoiceDate="2011-01-04 09:00:00"), line(InvoiceNo="2", InvoiceDate="2011-02-01 09:00:00"),
        line(InvoiceNo="3", CustomerID=None), line(InvoiceNo="4", Quantity=-1), line(InvoiceNo="5", UnitPrice=0))
    calendar = holidays.holiday_calendar(holiday_rows(spark, ("2011-01-03", "Ireland", "Day")))
    fences = cleaning.Fences(cleaning.iqr_fence(1, 100), cleaning.iqr_fence(1, 100))
    rows = {r.InvoiceNo: r for r in clean_sales(sales, calendar, fences).collect()}
    assert set(rows) == {"1", "2"}
    assert rows["1"].HolidayQuantity == 2 and rows["2"].HolidayQuantity == 0
    assert rows["2"].CohortMonth == dt.date(2011, 1, 1) and rows["2"].YearMonth == dt.date(2011, 2, 1)
    assert rows["1"].Revenue == Decimal("5.00000") and rows["1"].InvoiceDate == dt.date(2011, 1, 3)


def test_totals_survive_each_stage(t):
    for column in ("Quantity", "Revenue", "HolidayQuantity"):
        monthly_name = {"HolidayQuantity": "TotalHolidayQuantity"}.get(column, f"Monthly{column}")
        assert t.clean.agg(F.sum(column)).first()[0] == t.monthly.agg(F.sum(monthly_name)).first()[0]
    kept = cleaning.filter_price(cleaning.cap_quantity(t.purchases, t.fences.quantity), t.fences.price)
    assert kept.count() == t.clean.count()


def series(spark, *rows):
    return spark.createDataFrame(
        [(c, dt.date(2011, m, 1), Decimal(q), 2.0, 0, Decimal(q) * 2, Decimal(0)) for c, m, q in rows],
        "StockCode string, YearMonth date, MonthlyQuantity decimal(22,3), AvgUnitPrice double, HolidayCount long, "
        "MonthlyRevenue decimal(35,5), TotalHolidayQuantity decimal(22,3)")


def test_gap_month_is_skipped_and_short_series_vanish(spark):
    m = series(spark, ("A", 1, 1), ("A", 2, 2), ("A", 4, 4), ("A", 5, 5), ("B", 1, 1), ("B", 2, 1), ("B", 3, 1))
    rows = monthly.monthly_features(m).collect()
    assert [(r.StockCode, r.YearMonth.month) for r in rows] == [("A", 5)]
    assert (rows[0].lag1_quantity, rows[0].lag2_quantity, rows[0].lag3_quantity) == (4, 2, 1)
    assert rows[0].rolling_mean_3 == 7 / 3 and rows[0].GrowthRate == 0.25 and rows[0].LagRevenue1 == 8


def test_zero_predecessor_gives_null(spark):
    m = series(spark, ("A", 1, 0), ("A", 2, 5))
    assert [r[0] for r in m.select("YearMonth", monthly.change_rate("MonthlyQuantity").alias("g")).orderBy("YearMonth").select("g").collect()] == [None, None]


def test_single_line_product_has_no_spread(spark, sales_of):
    sales = sales_of(line()).selectExpr(
        "*", "DATE'2011-01-01' AS YearMonth", "Quantity * UnitPrice AS Revenue", "0 AS isholiday", "0L AS HolidayQuantity")
    row = products.product_kpis(sales).first()
    assert row.StdMonthlyQuantity is None and row.PriceVariance is None and row.HolidayRatio == 0


def test_variance_survives_decimal_overflow(spark):
    from tillsight.functions.columns import variance

    big = spark.sql("SELECT CAST(x AS DECIMAL(20,2)) AS x FROM VALUES (1e15), (3e15), (5e15) AS t(x)")
    got = big.agg(variance(F.sum("x"), F.sum(F.col("x") * F.col("x")), F.count("x"))).first()[0]
    assert got == pytest.approx(4e30)
    same = spark.sql("SELECT CAST(2.55 AS DECIMAL(12,2)) AS x FROM range(3)")
    assert same.agg(variance(F.sum("x"), F.sum(F.col("x") * F.col("x")), F.count("x"))).first()[0] == 0


def test_null_keys_are_no_group(spark, sales_of):
    sales = sales_of(line(StockCode=None), line()).selectExpr(
        "*", "DATE'2011-01-01' AS YearMonth", "Quantity * UnitPrice AS Revenue", "0 AS isholiday", "0L AS HolidayQuantity")
    assert monthly.monthly_product(sales).count() == 1
    assert products.product_reach(sales).count() == 1


def test_cap_takes_quantities_beyond_its_type(spark):
    from tillsight.operators.cleaning import Fence, cap_quantity

    df = spark.createDataFrame([(5_000_000_000,), (3,), (None,)], "Quantity long")
    assert [None if r[0] is None else float(r[0]) for r in cap_quantity(df, Fence(1.0, 2.0, 0.0, 27.0)).collect()] == [27.0, 3.0, None]


def test_unreadable_numbers_are_null(spark):
    from tillsight.sources.files import whole_number

    df = spark.createDataFrame([("1e30",), ("2.7",), ("17850.0",), ("x",), (None,), ("-4",)], "q string")
    assert [r[0] for r in df.select(whole_number("q")).collect()] == [None, None, 17850, None, None, -4]


def test_plans_fold_before_they_shuffle(spark, t):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    from tillsight.operators import monthly, profiling

    assert "Expand" not in plan(profiling.dataset_card(t.raw))
    latest = plan(monthly.latest_per_product(t.features))
    assert "SortAggregate" not in latest and latest.count("Exchange") == 1


def test_no_rows_have_no_quantiles(sales_of, t):
    """Fences, boxes, centres, bounds and labels of nothing are NULL or no rows."""
    from tillsight.operators import cleaning, customers, extensions, profiling

    none = sales_of()
    fences = cleaning.fit_fences(none)
    assert fences.quantity == fences.price == cleaning.Fence(None, None, None, None)
    assert cleaning.filter_price(cleaning.cap_quantity(none, fences.quantity), fences.price).count() == 0
    assert cleaning.price_outliers(none, fences.price).count() == cleaning.quantity_outliers(none, fences.quantity).count() == 0
    assert tuple(profiling.box_plot(none, "Quantity").first()) == (None, None, None, None, None, 0)
    assert tuple(profiling.center(none, "Quantity").first()) == (None, None, None)
    assert customers.customer_kpis(t.clean.limit(0)).count() == 0
    assert extensions.product_labels(t.product_kpis.limit(0)).count() == 0


def test_a_calendar_goes_by_its_header(spark, tmp_path):
    import datetime as dt

    import pytest

    from tillsight.sources import files

    (tmp_path / "a.csv").write_text(",date,countryOrRegion,holidayName,normalizeHolidayName,isPaidTimeOff,countryRegionCode\n"
                                    "7,2011-01-01 00:00:00,Norway,New Year,New Year,true,NO\n")
    (row,) = files.read_holidays(spark, str(tmp_path / "a.csv")).collect()
    assert (row["Unnamed: 0"], row.countryOrRegion, row.isPaidTimeOff, row.date) == (7, "Norway", True, dt.datetime(2011, 1, 1))
    (tmp_path / "b.csv").write_text("date,holidayName\n2011-01-01,x\n")
    with pytest.raises(ValueError, match="lacks .*countryOrRegion"):
        files.read_holidays(spark, str(tmp_path / "b.csv"))
