"""Wall time of the stages and headline queries; prints one JSON line.

Every stage that hands on a table (raw sales, clean sales, features, KPIs,
model, segments) is timed by itself, so that a query's time is what it costs
on top of its stage. A run over the smallest tables warms the JVM first.
"""

import json
import os
import sys
import time

from tillsight.plans.queries import registry
from tillsight.plans.tables import tables
from tillsight.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
WARM_DIR = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001")
STAGES = ("raw", "calendar", "purchases", "fences", "clean", "features", "dataset", "customers", "trained", "fixed_segments", "segmented")
QUERIES = (
    "dedup_lines", "split_counts", "iqr_fences", "filter_price", "holiday_enrich", "cohort_month", "duplicate_profile",
    "describe_numeric", "null_profile", "dataset_card", "monthly_product", "product_kpis", "customer_kpis",
    "monthly_features", "forecast_dataset", "monthly_revenue", "weekday_revenue", "top10_revenue", "top10_quantity",
    "histogram_revenue", "boxplot_revenue", "cv_folds", "cv_scores", "predictions", "model_metrics", "baseline_metrics",
    "shap_importance", "representative_error", "customer_zscores", "customer_text", "silhouette_fixed",
    "cohort_retention", "purchase_rhythm", "revenue_concentration",
)


def run(spark, sf_dir):
    times = {}
    shared = tables(spark, sf_dir)
    for stage in STAGES:
        start = time.time()
        getattr(shared, stage)
        times[f"stage_{stage}"] = round(time.time() - start, 3)
    for name in QUERIES:
        start = time.time()
        registry()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    return times


if __name__ == "__main__":
    session = local_session("bench")
    if os.path.isdir(WARM_DIR) and WARM_DIR != SF_DIR.rstrip("/"):
        run(session, WARM_DIR)
    result = run(session, SF_DIR)
    print(json.dumps({
        "metric": "total_wall_time", "value": round(sum(result.values()), 3), "unit": "sec", "queries": result,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))
    sys.stdout.flush()
    session.stop()
