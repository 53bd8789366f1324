"""Registry: query name -> (spark, data folder) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import dbl
from ..operators import (
    cleaning,
    customers,
    explain,
    extensions,
    forecast,
    holidays,
    insights,
    monthly,
    products,
    profiling,
    segments,
    trends,
)
from ..operators.monthly import FEATURES
from ..sources import bridge
from .tables import FIXED_CENTROIDS, Query, Tables, tables

_REGISTRY: dict[str, Query] = {}


def query(fn):
    """Register ``fn(tables)`` under its own name; decimals leave as doubles."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = fn(tables(spark, sf_dir))
        return out.select(*[
            dbl(F.col(f"`{f.name}`")).alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f"`{f.name}`")
            for f in out.schema
        ])

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    _REGISTRY[fn.__name__] = run
    return fn


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round sums of doubles, whose last bits depend on the order of addition."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


# --- sources and cleaning ----------------------------------------------------------


@query
def retail_raw(t: Tables):
    return bridge.retail_raw(t.spark, t.sf_dir)


@query
def holidays_raw(t: Tables):
    return bridge.holidays_raw(t.spark, t.sf_dir)


@query
def drop_null_customer(t: Tables):
    return cleaning.drop_anonymous(t.raw)


@query
def dedup_lines(t: Tables):
    return cleaning.dedup_lines(cleaning.drop_anonymous(t.raw))


@query
def split_counts(t: Tables):
    return cleaning.split_counts(cleaning.dedup_lines(cleaning.drop_anonymous(t.raw)))


@query
def returns(t: Tables):
    return cleaning.split_lines(cleaning.dedup_lines(cleaning.drop_anonymous(t.raw)))[2]


@query
def invalid_lines(t: Tables):
    return cleaning.split_lines(cleaning.dedup_lines(cleaning.drop_anonymous(t.raw)))[1]


@query
def text_standardize(t: Tables):
    return cleaning.standardize_text(t.raw).select("InvoiceNo", "StockCode", "Description")


@query
def text_strip_special(t: Tables):
    return cleaning.standardize_text(t.raw, strip_special=True).select("InvoiceNo", "StockCode", "Description")


@query
def iqr_fences(t: Tables):
    rows = [
        (c, f.q1, f.q3, f.lower, f.upper)
        for c, f in (("Quantity", t.fences.quantity), ("UnitPrice", t.fences.price))
    ]
    return t.spark.createDataFrame(rows, "column string, q1 double, q3 double, lower double, upper double")


@query
def cap_quantity(t: Tables):
    return cleaning.cap_quantity(t.purchases, t.fences.quantity)


@query
def filter_price(t: Tables):
    return cleaning.filter_price(t.purchases, t.fences.price)


@query
def quantity_outliers(t: Tables):
    return cleaning.quantity_outliers(t.purchases, t.fences.quantity)


@query
def price_outliers(t: Tables):
    return cleaning.price_outliers(t.purchases, t.fences.price)


@query
def calendar_parts(t: Tables):
    return cleaning.calendar_parts(t.raw).select(
        "InvoiceNo", "StockCode", "InvoiceDate", "Year", "Month", "day_of_week", "week"
    )


@query
def holiday_calendar(t: Tables):
    return holidays.holiday_calendar(t.holidays_raw)


@query
def holiday_calendar_by_name(t: Tables):
    return holidays.holiday_calendar_by_name(t.holidays_raw)


@query
def country_alias(t: Tables):
    country = holidays.alias_country("Country", bridge.COUNTRY_ALIASES)
    return t.raw.groupBy("Country", country.alias("holiday_country")).agg(F.count(F.lit(1)).alias("lines"))


@query
def holiday_enrich(t: Tables):
    return holidays.add_holidays(t.raw, t.calendar, bridge.COUNTRY_ALIASES).select(
        "InvoiceNo", "StockCode", "Quantity", "InvoiceDate", "Country", "holidayname", "isholiday", "HolidayQuantity"
    )


@query
def key_uniqueness(t: Tables):
    return holidays.repeated_keys(
        t.holidays_raw.where("date IS NOT NULL AND countryOrRegion IS NOT NULL"),
        [F.to_date("date").alias("date"), "countryOrRegion"],
    )


@query
def revenue_sign_check(t: Tables):
    return cleaning.revenue_sign_check(cleaning.add_revenue(t.raw))


@query
def cohort_month(t: Tables):
    return cleaning.first_months(t.lines)


@query
def retail_clean(t: Tables):
    return t.clean


# --- products ----------------------------------------------------------------------


@query
def monthly_product(t: Tables):
    return t.monthly


@query
def product_rollup(t: Tables):
    return products.product_rollup(t.monthly)


@query
def product_pricing(t: Tables):
    return products.product_pricing(t.lines)


@query
def product_reach(t: Tables):
    return products.product_reach(t.lines)


@query
def product_kpis(t: Tables):
    return products.product_kpis(t.lines)


# --- customers ---------------------------------------------------------------------


@query
def total_orders(t: Tables):
    return customers.total_orders(t.lines)


@query
def recency(t: Tables):
    return customers.recency(t.lines)


@query
def avg_order_value(t: Tables):
    return customers.avg_order_value(t.lines)


@query
def active_months(t: Tables):
    return customers.active_months(t.lines)


@query
def customer_kpis_raw(t: Tables):
    return customers.customer_kpis_raw(t.lines)


@query
def customer_kpis(t: Tables):
    return customers.customer_kpis(t.lines)


# --- trends and top lists ----------------------------------------------------------


@query
def monthly_revenue(t: Tables):
    return trends.total_by(t.lines, "YearMonth", "Revenue")


@query
def monthly_quantity(t: Tables):
    return trends.total_by(t.lines, "YearMonth", "Quantity")


@query
def weekly_revenue(t: Tables):
    return trends.total_by(t.lines, "week", "Revenue")


@query
def weekday_revenue(t: Tables):
    return trends.weekday_revenue(t.lines)


@query
def orders_per_customer(t: Tables):
    return trends.customer_orders(t.lines)


@query
def revenue_per_customer(t: Tables):
    return trends.customer_revenue(t.lines)


@query
def customer_orders_revenue(t: Tables):
    return trends.customer_orders_revenue(t.lines)


@query
def top10_revenue(t: Tables):
    return trends.top_products(t.clean, "Revenue")


@query
def top10_quantity(t: Tables):
    return trends.top_products(t.clean, "Quantity")


# --- profiles ----------------------------------------------------------------------


@query
def dataset_card(t: Tables):
    return profiling.dataset_card(t.lines)


@query
def quantity_center(t: Tables):
    return profiling.center(t.lines, "Quantity")


@query
def holiday_quantity_counts(t: Tables):
    return profiling.value_counts(t.lines, "HolidayQuantity")


@query
def histogram_quantity(t: Tables):
    return profiling.histogram(t.lines, "Quantity")


@query
def histogram_unit_price(t: Tables):
    return profiling.histogram(t.lines, "UnitPrice")


@query
def histogram_revenue(t: Tables):
    return profiling.histogram(t.lines, "Revenue")


@query
def histogram_holiday_quantity(t: Tables):
    return profiling.histogram(t.lines, "HolidayQuantity")


@query
def histogram_orders_per_customer(t: Tables):
    return profiling.histogram(trends.customer_orders(t.lines), "Orders")


@query
def histogram_revenue_per_customer(t: Tables):
    return profiling.histogram(trends.customer_revenue(t.lines), "Revenue")


@query
def boxplot_quantity(t: Tables):
    return profiling.box_plot(t.lines, "Quantity")


@query
def boxplot_revenue(t: Tables):
    return profiling.box_plot(t.lines, "Revenue")


@query
def price_quantity_bins(t: Tables):
    return profiling.grid_counts(t.lines, "UnitPrice", "Quantity", 50.0, 5.0)


@query
def orders_revenue_bins(t: Tables):
    return profiling.grid_counts(trends.customer_orders_revenue(t.lines), "Orders", "revenue", 1.0, 10000.0)


@query
def null_profile(t: Tables):
    return profiling.null_profile(t.raw)


@query
def null_profile_clean(t: Tables):
    return profiling.null_profile(t.clean)


@query
def duplicate_profile(t: Tables):
    return profiling.duplicate_profile(t.raw, cleaning.LINE_KEY)


@query
def holiday_duplicate_profile(t: Tables):
    return profiling.duplicate_profile(t.holidays_raw, ["date", "countryOrRegion"])


@query
def describe_numeric(t: Tables):
    return rounded(profiling.describe_numeric(t.raw, ["Quantity", "UnitPrice", "CustomerID"]), "mean", "std")


@query
def describe_revenue(t: Tables):
    return rounded(profiling.describe_numeric(t.lines, ["Revenue"]), "mean", "std")


@query
def distinct_months(t: Tables):
    return profiling.distinct_months(t.lines)


# --- product features --------------------------------------------------------------


@query
def lag_features(t: Tables):
    return monthly.lag_features(t.monthly)


@query
def rolling_mean(t: Tables):
    return t.monthly.select("StockCode", "YearMonth", monthly.rolling_mean("MonthlyQuantity").alias("rolling_mean_3"))


@query
def growth_rate(t: Tables):
    return t.monthly.select("StockCode", "YearMonth", monthly.change_rate("MonthlyQuantity").alias("GrowthRate"))


@query
def price_change(t: Tables):
    return t.monthly.select("StockCode", "YearMonth", monthly.change_rate("AvgUnitPrice").alias("avg_unitprice"))


@query
def monthly_features(t: Tables):
    return monthly.monthly_features(t.monthly)


@query
def latest_per_product(t: Tables):
    return monthly.latest_per_product(t.features)


# --- forecast ----------------------------------------------------------------------


@query
def forecast_dataset(t: Tables):
    return forecast.forecast_dataset(t.features)


@query
def split_sizes(t: Tables):
    return forecast.split_sizes(t.dataset, bridge.CUT_OFF)


@query
def scaler_stats(t: Tables):
    return rounded(forecast.scaler_stats(t.train), "mean", "std", digits=5)


@query
def cv_folds(t: Tables):
    return forecast.cv_blocks(t.train).select("StockCode", "YearMonth", "block")


@query
def cv_scores(t: Tables):
    return rounded(t.trained.scores, "rmse", digits=5)


@query
def ridge_fit(t: Tables):
    fit, _ = t.explained
    rows = [(f, w, s, fit.intercept, t.trained.alpha) for f, w, s in zip(fit.features, fit.weights, fit.standardized)]
    out = t.spark.createDataFrame(
        rows, "Feature string, weight double, standardized double, intercept double, alpha double"
    )
    return rounded(out, "weight", "standardized", "intercept")


@query
def predictions(t: Tables):
    return rounded(forecast.predict(t.model, t.test), "Predicted", digits=5)


@query
def model_metrics(t: Tables):
    return rounded(forecast.metrics(forecast.predict(t.model, t.test), "Predicted"), "MAE", "RMSE", "R2", digits=5)


@query
def baseline_metrics(t: Tables):
    return forecast.metrics(t.test, "MonthlyQuantity")


@query
def one_hot(t: Tables):
    return forecast.aligned_dummies(t.train, t.test)


@query
def model_comparison(t: Tables):
    return t.comparison


@query
def best_model(t: Tables):
    return forecast.best_model(t.comparison)


@query
def next_month_forecast(t: Tables):
    rows = forecast.predict(t.model, monthly.latest_per_product(t.features))
    return rounded(rows.select("StockCode", "YearMonth", "Predicted"), "Predicted", digits=5)


@query
def revenue_forecast(t: Tables):
    train, test = forecast.time_split(forecast.forecast_dataset(t.features, "MonthlyRevenue"), bridge.CUT_OFF)
    trained = forecast.train_ridge(train)
    return rounded(forecast.metrics(forecast.predict(trained.model, test), "Predicted"), "MAE", "RMSE", "R2", digits=5)


# --- explanation -------------------------------------------------------------------


@query
def shap_background(t: Tables):
    return explain.background(t.train)


@query
def shap_values(t: Tables):
    return rounded(explain.shap_values(t.test, *t.explained), "BaseValue", "SHAP", digits=5)


@query
def shap_importance(t: Tables):
    out = explain.shap_importance(t.test, *t.explained)
    return rounded(out, "MeanAbsoluteSHAP", "StandardizedRidgeCoefficient", digits=5)


@query
def shap_top_features(t: Tables):
    out = explain.shap_importance(t.test, *t.explained).where("Rank <= 10")
    return rounded(out, "MeanAbsoluteSHAP", "StandardizedRidgeCoefficient", digits=5)


@query
def shap_beeswarm(t: Tables):
    out = explain.strongest(explain.shap_values(t.test, *t.explained), explain.shap_importance(t.test, *t.explained))
    return rounded(out, "BaseValue", "SHAP", digits=5)


@query
def shap_representative(t: Tables):
    out = explain.representative(forecast.predict(t.model, t.test), "Predicted")
    return rounded(out, "PredictedNextMonthQuantity", "AbsoluteError", digits=5)


@query
def shap_local(t: Tables):
    row = explain.representative(forecast.predict(t.model, t.test), "Predicted")
    return rounded(explain.shap_local(explain.shap_values(t.test, *t.explained), row), "BaseValue", "SHAP", digits=5)


# One weight per feature, in the order of FEATURES.
LITERAL_WEIGHTS = (0.3, -0.01, 1.5, 0.0005, 0.2, 0.15, 0.1, 0.05, -2.0, 0.7, 0.0004, 0.0003, 0.0002)


@query
def linear_attribution(t: Tables):
    """Importance under literal weights with all training rows as background."""
    fit = explain.LinearForecast(FEATURES, 10.0, LITERAL_WEIGHTS, LITERAL_WEIGHTS)
    out = explain.shap_importance(t.test, fit, explain.background_means(t.train))
    return rounded(out, "MeanAbsoluteSHAP")


@query
def representative_error(t: Tables):
    return explain.representative(t.test, "MonthlyQuantity")


# --- segments ----------------------------------------------------------------------


@query
def customer_zscores(t: Tables):
    scaled = segments.zscores(t.customers).select("CustomerID", *[F.col(f"z_{c}").alias(c) for c in segments.CLUSTER_FEATURES])
    return rounded(scaled, *segments.CLUSTER_FEATURES)


@query
def assign_fixed_centroids(t: Tables):
    return t.fixed_segments.select("CustomerID", "clusters")


@query
def churn_flag(t: Tables):
    return segments.add_churn(t.customers).select("CustomerID", "Recency", "Churn")


@query
def segment_labels(t: Tables):
    return t.fixed_segments.select("CustomerID", "clusters", "segment")


@query
def cluster_summary(t: Tables):
    return rounded(segments.cluster_summary(t.fixed_segments), *segments.SUMMARY)


@query
def segment_sizes(t: Tables):
    return segments.segment_sizes(t.fixed_segments)


@query
def segment_profile(t: Tables):
    return rounded(insights.segment_profile(t.fixed_segments, segments.DORMANT), *segments.SUMMARY)


@query
def segment_members(t: Tables):
    return segments.segment_members(t.fixed_segments, segments.FREQUENT).select("CustomerID", "clusters", "segment", "Churn")


@query
def sample_member(t: Tables):
    return segments.sample_member(t.fixed_segments, segments.FREQUENT)


@query
def customer_text(t: Tables):
    return segments.customer_text(t.fixed_segments).select("CustomerID", "Customer_Text")


@query
def silhouette_fixed(t: Tables):
    scaled = segments.assign(segments.zscores(t.customers), FIXED_CENTROIDS)
    return rounded(segments.cluster_silhouette(scaled), "silhouette")


@query
def customer_segments(t: Tables):
    return t.segmented


@query
def elbow(t: Tables):
    return segments.elbow(t.customers, t.k_scan)


@query
def silhouette_by_k(t: Tables):
    return rounded(segments.silhouette_by_k(t.customers, t.k_scan), "silhouette")


@query
def k_comparison(t: Tables):
    return rounded(segments.k_comparison(t.customers, t.k_scan), *segments.CLUSTER_FEATURES)


# --- insight texts -----------------------------------------------------------------


@query
def segment_text(t: Tables):
    return insights.segment_text(insights.segment_profile(t.fixed_segments))


@query
def insight_requests(t: Tables):
    return insights.insight_requests(segments.customer_text(t.fixed_segments).select("CustomerID", "Customer_Text"))


@query
def insight_resolution(t: Tables):
    return insights.resolve_insights(response_log(t.fixed_segments))


def response_log(labelled: DataFrame) -> DataFrame:
    """Two attempts per customer whose outcome follows from the id: replies and each kind of error."""
    kind = F.col("request_id") % 7 + 3 * (F.col("candidate") - 1)
    error = (
        F.when(kind == 1, "400 API_KEY_INVALID")
        .when(kind.isin(2, 5), "404 model Not Found")
        .when(kind == 3, "429 Too Many Requests")
        .when(kind == 4, "Quota exceeded")
        .when(kind == 6, "connection reset")
        .when(kind == 8, "")
    )
    return labelled.select(
        F.col("CustomerID").alias("request_id"), F.explode(F.array(F.lit(1), F.lit(2))).alias("candidate"), "segment"
    ).select(
        "request_id", "candidate",
        F.when(error.isNull(), F.concat(F.lit("Insight on "), "segment")).alias("response"), error.alias("error"),
    )


# --- questions from the business notes ---------------------------------------------


@query
def cohort_retention(t: Tables):
    return extensions.cohort_retention(t.lines)


@query
def purchase_rhythm(t: Tables):
    return extensions.purchase_rhythm(t.lines)


@query
def revenue_concentration(t: Tables):
    return extensions.revenue_concentration(t.lines)


@query
def product_labels(t: Tables):
    return extensions.product_labels(t.product_kpis)
