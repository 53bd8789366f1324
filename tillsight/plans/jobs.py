"""End-to-end jobs that read and write tables; each stage can run alone.

Hand-off tables have declared schemas and may be Parquet or CSV (``fmt``).
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.staging import stage
from ..operators import customers, explain, forecast, insights, kmeans, monthly, products, segments
from ..operators.holidays import holiday_calendar
from ..sources.files import conform, read_holidays, read_sales, read_table, write_table
from ..sources.schemas import CLEAN, CUSTOMER_KPIS, FEATURES, PRODUCT_KPIS, SEGMENTS
from .tables import clean_sales

CUT_OFF = "2011-08-01"


def preprocess(spark: SparkSession, sales: str, holidays: str, out: str, fmt: str = "csv",
               timestamp_format: str | None = None, backup: str | None = None, out_fmt: str = "parquet") -> None:
    """Raw sales and holidays to clean sales, partitioned by month."""
    raw = read_sales(spark, sales, fmt, timestamp_format)
    calendar = stage(holiday_calendar(read_holidays(spark, holidays, fmt, timestamp_format)), "holidays")
    write_table(conform(clean_sales(raw, calendar), CLEAN), out, out_fmt, partition_by="YearMonth", backup_path=backup)


def build_features(spark: SparkSession, clean: str, out: str, fmt: str = "parquet") -> None:
    """Clean sales to monthly features, product KPIs and customer KPIs."""
    sales = read_table(spark, clean, CLEAN, fmt)
    write_table(conform(monthly.monthly_features(monthly.monthly_product(sales)), FEATURES), f"{out}/regression_features", fmt)
    write_table(conform(products.product_kpis(sales), PRODUCT_KPIS), f"{out}/product_classification_features", fmt)
    write_table(conform(customers.customer_kpis(sales), CUSTOMER_KPIS), f"{out}/customer_churn_features", fmt)


def _split(spark: SparkSession, features: str, cut_off: str, fmt: str) -> tuple[DataFrame, DataFrame]:
    # Staged: training and evaluation pass over these rows many times.
    dataset = stage(forecast.forecast_dataset(read_table(spark, features, FEATURES, fmt)), "forecast_dataset")
    train, test = forecast.time_split(dataset, cut_off)
    forecast.require_split(train, test)
    return train, test


def train(spark: SparkSession, features: str, model: str, cut_off: str = CUT_OFF, fmt: str = "parquet") -> forecast.Trained:
    """Choose alpha, fit, and save the model."""
    trained = forecast.train_ridge(_split(spark, features, cut_off, fmt)[0])
    trained.model.write().overwrite().save(model)
    return trained


def predict(spark: SparkSession, features: str, model: str, out: str, cut_off: str = CUT_OFF, fmt: str = "parquet") -> DataFrame:
    """Save the test predictions; return the metrics of the model and of the naive forecast."""
    _, test = _split(spark, features, cut_off, fmt)
    rows = forecast.predict(PipelineModel.load(model), test)
    write_table(rows, out, fmt)
    saved = read_table(spark, out, rows.schema, fmt)
    return (
        forecast.metrics(saved, "Predicted").select(F.lit("ridge").alias("model"), "*")
        .unionByName(forecast.metrics(saved, "MonthlyQuantity").select(F.lit("baseline").alias("model"), "*"))
    )


def explain_forecast(spark: SparkSession, features: str, model: str, out: str, cut_off: str = CUT_OFF,
                     fmt: str = "parquet") -> None:
    """Save feature importance, the attribution of every forecast, and one representative forecast."""
    train_rows, test = _split(spark, features, cut_off, fmt)
    fitted = PipelineModel.load(model)
    linear = explain.unfold(fitted, train_rows.count())
    means = explain.background_means(train_rows)
    values = explain.shap_values(test, linear, means)
    row = stage(explain.representative(forecast.predict(fitted, test), "Predicted"), "representative")
    write_table(explain.shap_importance(test, linear, means), f"{out}/shap_feature_importance", fmt)
    write_table(values, f"{out}/shap_values", fmt)
    write_table(row, f"{out}/shap_representative_prediction", fmt)
    write_table(explain.shap_local(values, row), f"{out}/shap_local", fmt)


def forecast_product(spark: SparkSession, features: str, model: str, stock_code: str, fmt: str = "parquet") -> DataFrame:
    """Next-month forecast from the latest row of one product."""
    rows = read_table(spark, features, FEATURES, fmt).where(F.col("StockCode") == stock_code)
    return forecast.predict(PipelineModel.load(model), monthly.latest_per_product(rows))


def segment(spark: SparkSession, kpis: str, out: str, model: str, k: int = 3, fmt: str = "parquet") -> None:
    """Customer KPIs to named segments with profile text; saves table and model."""
    labelled, fitted = segments.segment_customers(read_table(spark, kpis, CUSTOMER_KPIS, fmt), k)
    write_table(conform(labelled, SEGMENTS), out, fmt)
    kmeans.save(spark, fitted, model)


def segment_requests(spark: SparkSession, segmented: str, has_key: bool = True, fmt: str = "parquet") -> DataFrame:
    """Request text for the insight on each segment."""
    profile = insights.segment_profile(read_table(spark, segmented, SEGMENTS, fmt))
    return insights.insight_requests(insights.segment_text(profile), has_key)
