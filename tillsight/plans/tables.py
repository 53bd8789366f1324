"""The stage tables of one data set: raw sales, clean sales, features, KPIs, model.

Each is built once per session and handed on as a written table, so a query
starts from the nearest stage and the stages below it are not recomputed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ..functions.staging import release, stage
from ..operators import cleaning, customers, explain, forecast, holidays, kmeans, monthly, products, segments
from ..sources import bridge


def enrich_purchases(bought: DataFrame, fences: cleaning.Fences, calendar: DataFrame,
                     aliases: Mapping[str, str] = holidays.COUNTRY_ALIASES) -> DataFrame:
    """Capped and filtered purchases with revenue, calendar parts, cohort month and holidays.

    The cohort months are joined first: that join moves the lines, so it comes
    before the columns that follow from others.
    """
    priced = cleaning.filter_price(cleaning.cap_quantity(bought, fences.quantity), fences.price)
    dated = cleaning.calendar_parts(cleaning.add_revenue(cleaning.add_cohort(priced)))
    return (
        holidays.add_holidays(dated.select(*[c for c in dated.columns if c != "CohortMonth"], "CohortMonth"), calendar, aliases)
        .dropna(subset=list(cleaning.REQUIRED))
        .withColumnRenamed("Month", "Month_num")
        .withColumn("YearMonth", cleaning.month_start("InvoiceDate"))
    )


def clean_sales(sales: DataFrame, calendar: DataFrame, fences: cleaning.Fences | None = None,
                aliases: Mapping[str, str] = holidays.COUNTRY_ALIASES) -> DataFrame:
    """Raw sale lines and a holiday calendar to clean, enriched purchases.

    The purchases are written once, behind the shuffle that folds repeated
    lines; fences, cohort months and the result then read only what they need.
    """
    bought = stage(cleaning.purchases_of(sales), "purchases")
    return enrich_purchases(bought, fences or cleaning.fit_fences(bought), calendar, aliases)


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    @cached_property
    def raw(self) -> DataFrame:
        return stage(bridge.retail_raw(self.spark, self.sf_dir), "retail_raw")

    @cached_property
    def holidays_raw(self) -> DataFrame:
        return stage(bridge.holidays_raw(self.spark, self.sf_dir), "holidays_raw")

    @cached_property
    def calendar(self) -> DataFrame:
        return stage(holidays.holiday_calendar(self.holidays_raw), "holidays")

    @cached_property
    def purchases(self) -> DataFrame:
        """From the raw lines as they are joined; they are not written for this, but read if they have been."""
        raw = self.raw if "raw" in vars(self) else bridge.retail_raw(self.spark, self.sf_dir)
        return stage(cleaning.purchases_of(raw), "purchases")

    @cached_property
    def fences(self) -> cleaning.Fences:
        return cleaning.fit_fences(self.purchases)

    @cached_property
    def clean(self) -> DataFrame:
        return stage(enrich_purchases(self.purchases, self.fences, self.calendar, bridge.COUNTRY_ALIASES), "retail_clean")

    @cached_property
    def lines(self) -> DataFrame:
        """The clean sales without their text, which most queries never read; it is neither moved nor written for them."""
        if "clean" in vars(self):
            return self.clean.drop("Description")
        return stage(enrich_purchases(self.purchases.drop("Description"), self.fences, self.calendar, bridge.COUNTRY_ALIASES), "retail_lines")

    @cached_property
    def monthly(self) -> DataFrame:
        return stage(monthly.monthly_product(self.lines), "monthly_product")

    @cached_property
    def series(self) -> DataFrame:
        """The features with each row's next month, from the one sort that the features need."""
        sums = self.monthly if "monthly" in vars(self) else monthly.monthly_product(self.lines)
        return stage(forecast.with_next_month(monthly.monthly_features(sums)), "monthly_features")

    @property
    def features(self) -> DataFrame:
        return self.series.drop(*forecast.NEXT)

    @cached_property
    def product_kpis(self) -> DataFrame:
        return stage(products.product_kpis(self.lines), "product_kpis")

    @cached_property
    def customers(self) -> DataFrame:
        return stage(customers.customer_kpis(self.lines), "customer_kpis")

    @cached_property
    def dataset(self) -> DataFrame:
        return forecast.before_latest(self.series)

    @property
    def train(self) -> DataFrame:
        return forecast.time_split(self.dataset, bridge.CUT_OFF)[0]

    @property
    def test(self) -> DataFrame:
        return forecast.time_split(self.dataset, bridge.CUT_OFF)[1]

    @cached_property
    def trained(self) -> forecast.Trained:
        forecast.require_split(self.train, self.test)
        return forecast.train_ridge(self.train)

    @cached_property
    def explained(self) -> tuple[explain.LinearForecast, dict[str, float]]:
        """The forecast's weights and its background: the means of all training rows."""
        return explain.unfold(self.model, self.train.count()), explain.background_means(self.train)

    @cached_property
    def comparison(self) -> DataFrame:
        parts = forecast.time_split(forecast.add_target(self.features), bridge.CUT_OFF)
        return stage(forecast.compare_models(*parts, **COMPARISON), "model_comparison")

    @cached_property
    def k_scan(self) -> dict[int, kmeans.Clustering]:
        return segments.k_scan(self.customers)

    @property
    def model(self) -> PipelineModel:
        return self.trained.model

    @cached_property
    def segmented(self) -> DataFrame:
        return stage(segments.segment_customers(self.customers)[0], "customer_segments")

    @cached_property
    def fixed_segments(self) -> DataFrame:
        """Customers assigned to fixed centroids in z-space, which SQL can repeat."""
        assigned = segments.drop_scores(segments.assign(segments.zscores(self.customers), FIXED_CENTROIDS))
        labelled = segments.label_customers(segments.add_churn(assigned), segments.names_by_rank(FIXED_CENTROIDS))
        return stage(labelled, "fixed_segments")


# The queries grow fewer and shallower trees than the operator's defaults, which take minutes on any size:
# every round and every level of a tree is a Spark job.
COMPARISON = {"trees": 20, "rounds": 20, "depth": 5}

# In the order of segments.CLUSTER_FEATURES; frequent, occasional and dormant customers.
FIXED_CENTROIDS = [(1.0, 1.0, 1.0, -1.0, 1.0), (0.0, 0.0, 0.0, 0.0, 0.0), (-1.0, -1.0, -1.0, 1.0, -1.0)]

_open: dict[tuple[str, str], Tables] = {}


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The stage tables of ``sf_dir`` in this application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _open:
        _open[key] = Tables(spark, sf_dir)
    return _open[key]


def forget(spark: SparkSession, sf_dir: str) -> None:
    """Drop the handles and delete their stage tables; the next use builds them again.

    DataFrames of queries that read these tables cannot run any more.
    """
    gone = _open.pop((spark.sparkContext.applicationId, sf_dir), None)
    for table in vars(gone).values() if gone else ():
        if isinstance(table, DataFrame):
            release(table)


Query = Callable[[SparkSession, str], DataFrame]
