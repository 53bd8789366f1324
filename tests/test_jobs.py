"""The jobs from CSV files to segments, and the sinks."""

import csv
import datetime as dt

import pytest

from tillsight.__main__ import JOBS, main
from tillsight.plans import jobs
from tillsight.sources import files
from tillsight.sources.schemas import CLEAN, FEATURES, RETAIL_RAW


@pytest.fixture(scope="module")
def work(spark, t, tmp_path_factory):
    """Raw tables of the smallest data set as CSV files with dirty ids and dates."""
    root = tmp_path_factory.mktemp("jobs")
    with open(root / "sales.csv", "w", newline="") as f:
        out = csv.writer(f)
        out.writerow([c.name for c in RETAIL_RAW])
        for r in t.raw.collect():
            out.writerow([r.InvoiceNo, r.StockCode, r.Description, r.Quantity, r.InvoiceDate, r.UnitPrice,
                          "" if r.CustomerID is None else f"{r.CustomerID}.0", r.Country])
    with open(root / "holidays.csv", "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(["Unnamed: 0", "countryOrRegion", "holidayName", "normalizeHolidayName", "isPaidTimeOff",
                      "countryRegionCode", "date"])
        for i, r in enumerate(t.holidays_raw.collect()):
            # The default country names apply here, so the fixture's alias is undone.
            out.writerow([i, "NATION_4" if r.countryOrRegion == "Nation Four" else r.countryOrRegion, r.holidayName, "", "", "", r.date])
    return str(root)


def test_chain(spark, t, work):
    jobs.preprocess(spark, f"{work}/sales.csv", f"{work}/holidays.csv", f"{work}/clean", backup=f"{work}/backup")
    clean = spark.read.parquet(f"{work}/clean")
    columns = sorted(t.clean.columns)
    assert sorted(clean.columns) == columns
    assert clean.select(columns).exceptAll(t.clean.select(columns)).isEmpty()
    assert clean.count() == t.clean.count() == spark.read.parquet(f"{work}/backup").count()

    jobs.build_features(spark, f"{work}/clean", f"{work}/processed")
    for name, table in (("regression_features", t.features), ("product_classification_features", t.product_kpis),
                        ("customer_churn_features", t.customers)):
        written = spark.read.parquet(f"{work}/processed/{name}")
        assert written.exceptAll(table).isEmpty() and written.count() == table.count()

    features, model = f"{work}/processed/regression_features", f"{work}/model"
    trained = jobs.train(spark, features, model, "2001-01-01")
    assert trained.alpha == t.trained.alpha
    scores = {r.model: r for r in jobs.predict(spark, features, model, f"{work}/predictions", "2001-01-01").collect()}
    assert scores["ridge"].rows == scores["baseline"].rows == 73
    assert scores["ridge"].RMSE < scores["baseline"].RMSE
    jobs.explain_forecast(spark, features, model, f"{work}/shap", "2001-01-01")
    assert spark.read.parquet(f"{work}/shap/shap_feature_importance").count() == 13
    assert spark.read.parquet(f"{work}/shap/shap_representative_prediction").count() == 1
    code = t.features.first().StockCode
    assert jobs.forecast_product(spark, features, model, code).count() == 1

    jobs.segment(spark, f"{work}/processed/customer_churn_features", f"{work}/segments", f"{work}/kmeans")
    rows = spark.read.parquet(f"{work}/segments")
    assert rows.count() == 150 and rows.select("segment").distinct().count() == 3
    assert jobs.segment_requests(spark, f"{work}/segments").count() == 3


def test_unreadable_values_become_null(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
        '536365,85123A,"WHITE ""T"", LIGHT",6,12/1/2010 8:26,2.55,17850.0,United Kingdom\n'
        "C5,85123A,,x,soon,,,EIRE\n")
    good, bad = files.read_sales(spark, str(tmp_path / "s.csv"), timestamp_format="M/d/yyyy H:mm").collect()
    assert good.InvoiceDate == dt.datetime(2010, 12, 1, 8, 26) and good.CustomerID == 17850
    assert good.Description == 'WHITE "T", LIGHT' and float(good.UnitPrice) == 2.55
    assert bad.Quantity is None and bad.InvoiceDate is None and bad.CustomerID is None and bad.UnitPrice is None


def test_small_prices_are_kept_and_headers_checked(spark, tmp_path):
    head = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
    (tmp_path / "s.csv").write_text(head + "1,A,x,1,2011-01-01 08:00:00,0.001,5,EIRE\n")
    assert float(files.read_sales(spark, str(tmp_path / "s.csv")).first().UnitPrice) == 0.001
    (tmp_path / "t.csv").write_text(head.replace("StockCode,Description", "Description,StockCode") + "1,A,x,1,,1,5,EIRE\n")
    with pytest.raises(Exception, match="header"):
        files.read_sales(spark, str(tmp_path / "t.csv")).collect()


def test_chain_as_csv(spark, t, work):
    jobs.preprocess(spark, f"{work}/sales.csv", f"{work}/holidays.csv", f"{work}/c_clean", backup=f"{work}/c_backup", out_fmt="csv")
    for copy in ("c_clean", "c_backup"):
        rows = files.read_table(spark, f"{work}/{copy}", CLEAN, "csv").select(t.clean.columns)
        assert rows.count() == t.clean.count() and rows.exceptAll(t.clean).isEmpty()
    jobs.build_features(spark, f"{work}/c_clean", f"{work}/c_processed", fmt="csv")
    features = files.read_table(spark, f"{work}/c_processed/regression_features", FEATURES, "csv")
    assert features.exceptAll(t.features).isEmpty() and features.count() == t.features.count()


def test_prices_of_fewer_decimals_are_read(spark, t, tmp_path):
    t.raw.write.parquet(str(tmp_path / "raw"))
    rows = files.read_sales(spark, str(tmp_path / "raw"), "parquet")
    assert rows.schema["UnitPrice"].dataType == RETAIL_RAW["UnitPrice"].dataType
    assert rows.exceptAll(t.raw).isEmpty() and rows.count() == t.raw.count()


def test_quotes_survive_csv(spark, tmp_path):
    rows = spark.createDataFrame([("a \"b\", c", "x"), (None, "\\")], "x string, y string")
    files.write_table(rows, str(tmp_path / "q"), fmt="csv", backup_path=str(tmp_path / "r"))
    for name in ("q", "r"):
        again = files.read_table(spark, str(tmp_path / name), rows.schema, "csv")
        assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)


def test_csv_sink(spark, t, tmp_path):
    files.write_table(t.features, str(tmp_path / "f"), fmt="csv")
    again = files.read_table(spark, str(tmp_path / "f"), t.features.schema, "csv")
    assert again.exceptAll(t.features).isEmpty() and again.count() == t.features.count()
    with pytest.raises(ValueError, match="schema"):
        files.read_table(spark, str(tmp_path / "f"), fmt="csv")


def test_command_line(spark, work, capsys):
    assert set(JOBS) == {"preprocess", "build-features", "train", "predict", "explain-forecast", "forecast-product",
                         "segment", "segment-requests"}
    with pytest.raises(SystemExit):
        main(["preprocess"])
    main(["segment-requests", f"{work}/segments"])
    assert "business analyst" in capsys.readouterr().out
