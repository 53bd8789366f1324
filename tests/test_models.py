"""Forecast, attribution and segmentation against closed forms and brute force."""

import datetime as dt
import hashlib
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tillsight.operators import explain, forecast, insights, kmeans, segments
from tillsight.operators.monthly import FEATURES
from tillsight.sources.bridge import CUT_OFF


@pytest.fixture(scope="module")
def train_xy(t):
    rows = t.train.orderBy("YearMonth", "StockCode").toPandas()
    return rows[list(FEATURES)].to_numpy(float), rows["target"].to_numpy(float)


def closed_form(x, y, alpha):
    """Ridge on standardised columns with a free intercept."""
    mean, sd = x.mean(0), x.std(0)
    z = (x - mean) / sd
    w = np.linalg.solve(z.T @ z + alpha * np.eye(x.shape[1]), z.T @ (y - y.mean()))
    return w, lambda rows: (rows - mean) / sd @ w + y.mean()


@pytest.mark.parametrize("alpha", [0.1, 10.0, 100.0])
def test_ridge_equals_closed_form(t, train_xy, alpha):
    fit = explain.unfold(forecast.ridge_fit(t.train, alpha), t.train.count())
    w, predict = closed_form(*train_xy, alpha)
    assert np.allclose(fit.standardized, w, rtol=1e-7, atol=1e-9)
    x = train_xy[0][:50]
    assert np.allclose(fit.intercept + x @ np.array(fit.weights), predict(x), rtol=1e-9)


def test_cross_validation_equals_a_plain_loop(t, train_xy):
    x, y = train_xy
    n, size = len(y), len(y) // 6
    want = {}
    for fold, alpha in itertools.product(range(5), forecast.ALPHAS):
        start = n - (5 - fold) * size
        _, predict = closed_form(x[:start], y[:start], alpha)
        held = slice(start, start + size)
        want[alpha, fold + 1] = (start, size, np.sqrt(np.mean((predict(x[held]) - y[held]) ** 2)))
    rows = t.trained.scores.collect()
    assert len(rows) == 25
    for r in rows:
        start, held, rmse = want[r.alpha, r.fold]
        assert (r.train_rows, r.test_rows) == (start, held)
        assert r.rmse == pytest.approx(rmse, rel=1e-9)
    means = {a: np.mean([want[a, f][2] for f in range(1, 6)]) for a in forecast.ALPHAS}
    assert t.trained.alpha == min(means, key=means.get)


def features_of(spark, rows):
    return spark.createDataFrame([(c, dt.date(2011, m, 1), float(q)) for c, m, q in rows],
                                 "StockCode string, YearMonth date, target double")


@pytest.mark.parametrize("rows,folds", [(7, 5), (23, 5), (60, 5), (10, 3)])
def test_blocks_by_row_count(spark, rows, folds):
    rng = random.Random(rows)
    keys = rng.sample([(f"p{c}", m) for c in range(30) for m in (1, 2, 5)], rows)
    df = features_of(spark, [(c, m, 1) for c, m in keys])
    got = {(r.StockCode, r.YearMonth.month): r.block for r in forecast.cv_blocks(df, folds).collect()}
    size = rows // (folds + 1)
    head = rows - folds * size
    want = {k: 0 if i < head else (i - head) // size + 1 for i, k in enumerate(sorted(keys, key=lambda k: (k[1], k[0])))}
    assert got == want


def test_too_few_rows_for_the_folds(spark):
    with pytest.raises(ValueError, match="too few"):
        forecast.cv_blocks(features_of(spark, [("a", 1, 1), ("b", 1, 1)]))


def test_latest_month_goes_before_the_target(spark):
    df = spark.createDataFrame([("A", dt.date(2011, m, 1), float(m)) for m in (1, 2, 4, 5)],
                               "StockCode string, YearMonth date, MonthlyQuantity double")
    out = forecast.forecast_dataset(df).orderBy("YearMonth").collect()
    assert [(r.YearMonth.month, r.target) for r in out] == [(1, 2.0), (2, 4.0)]
    assert forecast.add_target(df).count() == 3


def test_split_is_inclusive_and_checked(t):
    train, test = forecast.time_split(t.dataset, CUT_OFF)
    assert train.agg(F.max("YearMonth")).first()[0] == dt.date(2001, 1, 1)
    assert train.count() + test.count() == t.dataset.count()
    with pytest.raises(ValueError, match="no rows"):
        forecast.require_split(train, test.limit(0))
    with pytest.raises(ValueError, match="differ"):
        forecast.require_split(train, test.drop("Month"))


def test_metrics(spark):
    row = forecast.metrics(spark.sql("SELECT * FROM VALUES (1D, 2D), (3D, 3D), (5D, 4D) AS t(target, p)"), "p").first()
    assert (row.rows, row.MAE, row.R2) == (3, 2 / 3, 0.75)
    assert row.RMSE == pytest.approx((2 / 3) ** 0.5)


def test_model_round_trip(t, tmp_path):
    t.model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    a = {(r.StockCode, r.YearMonth): r.Predicted for r in forecast.predict(t.model, t.test).collect()}
    assert a == {(r.StockCode, r.YearMonth): r.Predicted for r in forecast.predict(again, t.test).collect()}


def test_pipeline_shape_is_checked(t):
    with pytest.raises(TypeError):
        explain.check_pipeline(object())
    bare = Pipeline(stages=[VectorAssembler(inputCols=["Month"], outputCol="f")]).fit(t.train)
    with pytest.raises(KeyError):
        explain.check_pipeline(bare)


def test_attributions_add_up_to_the_prediction(t):
    fit = explain.unfold(t.model, t.train.count())
    means = explain.background_means(explain.background(t.train))
    sums = explain.shap_values(t.test, fit, means).groupBy("StockCode", "YearMonth").agg(
        (F.max("BaseValue") + F.sum("SHAP")).alias("total"), F.count("Feature").alias("n"))
    both = sums.join(forecast.predict(t.model, t.test), ["StockCode", "YearMonth"]).collect()
    assert len(both) == 73
    assert all(r.n == len(FEATURES) and r.total == pytest.approx(r.Predicted, abs=1e-8) for r in both)


def test_local_attribution_keeps_the_total(t):
    fit = explain.unfold(t.model, t.train.count())
    values = explain.shap_values(t.test, fit, explain.background_means(explain.background(t.train)))
    row = explain.representative(forecast.predict(t.model, t.test), "Predicted")
    local = explain.shap_local(values, row).collect()
    predicted = row.first()
    assert len(local) == 10 and [r.Feature for r in local if r.Rank == 10] == ["4 other features"]
    assert sum(r.SHAP for r in local) + local[0].BaseValue == pytest.approx(predicted.PredictedNextMonthQuantity)


def test_representative_is_the_middle_error(t):
    rows = forecast.predict(t.model, t.test).collect()
    ordered = sorted(rows, key=lambda r: (abs(r.target - r.Predicted), r.StockCode, r.YearMonth))
    got = explain.representative(forecast.predict(t.model, t.test), "Predicted").collect()
    assert [(r.StockCode, r.YearMonth) for r in got] == [(ordered[len(rows) // 2].StockCode, ordered[len(rows) // 2].YearMonth)]


def test_one_hot_dictionary(spark):
    train = spark.createDataFrame([("b", "x"), ("a", "x"), ("b", "y")], "k string, other string")
    test = spark.createDataFrame([("a",), ("new",), (None,)], "k string")
    known, seen = forecast.indexed(train, test, ["k"])
    assert sorted((r.k, r.k_index) for r in known.collect()) == [("a", 0.0), ("b", 1.0), ("b", 1.0)]
    assert {r.k: r.k_index for r in seen.collect()} == {"a": 0.0, "new": 2.0, None: 2.0}


def test_comparison_has_every_model(t):
    rows = {r.model: r for r in t.comparison.collect()}
    assert len(rows) == 6 and all(r.RMSE >= r.MAE > 0 for r in rows.values())


def test_block_elimination_equals_the_dense_solve(t):
    """Least squares of least norm and ridge with a column per product and month, against NumPy on the dense matrix."""
    from tillsight.operators.blocks import fit_by_products, predicted

    train, test = forecast.time_split(forecast.add_target(t.features), CUT_OFF)
    seen, held = train.toPandas(), test.toPandas()
    codes, months = sorted(set(seen.StockCode)), sorted(set(seen.YearMonth))

    def dense(rows):
        hot = [(rows.StockCode.to_numpy() == c).astype(float) for c in codes] + [(rows.YearMonth.to_numpy() == m).astype(float) for m in months]
        return np.column_stack([rows[list(FEATURES)].to_numpy(float), *hot])

    x, y = dense(seen), seen.target.to_numpy(float)
    mean = x.mean(0)
    centred, rest = x - mean, y - y.mean()
    want = {1.0: np.linalg.solve(centred.T @ centred + np.eye(x.shape[1]), centred.T @ rest),
            forecast.LEAST_NORM: np.linalg.lstsq(centred, rest, rcond=1e-12)[0]}
    for alpha, w in want.items():
        got = {(r.StockCode, r.YearMonth): r.Predicted for r in predicted(fit_by_products(train, FEATURES, alpha), test).collect()}
        values = dict(zip(zip(held.StockCode, held.YearMonth, strict=True), (dense(held) - mean) @ w + y.mean(), strict=True))
        assert set(got) == set(values)
        assert max(abs(got[k] - values[k]) for k in got) < 1e-3 * (1 + max(map(abs, values.values())))


def test_background_is_reproducible(t):
    a = explain.background(t.train, 50).collect()
    assert a == explain.background(t.train.repartition(5), 50).collect()
    assert a != explain.background(t.train, 50, seed=1).collect()


# --- segments ----------------------------------------------------------------------


def test_required_columns():
    class Frame:
        columns = ["TotalOrders", "Recency"]

    with pytest.raises(ValueError, match="ActiveMonth, AvgOrderValue, PurchaseFrequency"):
        segments.require_columns(Frame, segments.CLUSTER_FEATURES)


def plain_k_means(ids, points, run, k, seed=42, iterations=300):
    """The operator's K-Means in loops over Python integers."""
    def squared(p, q):
        return sum((a - b) ** 2 for a, b in zip(p, q, strict=True))

    centers = []
    for step in range(k):
        draws = []
        for i, p in zip(ids, points, strict=True):
            weight = min((squared(p, c) for c in centers), default=1)
            if weight:
                u = (int(hashlib.md5(f"{seed}|{run}|{step}|{i}".encode()).hexdigest()[:13], 16) + 1) / 2**52
                draws.append((-math.log(u) / weight, p))
        if not draws:
            break
        centers.append(min(draws)[1])
    for _ in range(iterations):
        groups = [[] for _ in centers]
        for p in points:
            near = [squared(p, c) for c in centers]
            groups[near.index(min(near))].append(p)
        moved = [tuple((2 * sum(x) + len(g)) // (2 * len(g)) for x in zip(*g, strict=True)) if g else c
                 for g, c in zip(groups, centers, strict=True)]
        if moved == centers:
            break
        centers = moved
    return tuple(centers), sum(min(squared(p, c) for c in centers) for p in points)


def grid_points(df, model):
    rows = df.select("CustomerID", *kmeans.on_grid(model.features, model.means, model.deviations)).collect()
    return [r[0] for r in rows], [tuple(r[1:]) for r in rows]


def test_k_means_equals_plain_loops(t):
    x = segments.training_data(t.customers)
    fits = kmeans.fit(x, segments.TRAINED, {0: 3, 1: 3, 7: 5}, "CustomerID")
    ids, points = grid_points(x, fits[0])
    for run, k in ((0, 3), (1, 3), (7, 5)):
        assert (fits[run].centers, fits[run].cost) == plain_k_means(ids, points, run, k)


def test_k_means_assigns_the_nearest_center(t):
    model = segments.fit_k_means(t.customers, starts=3)
    centers = np.array(model.scores())
    rows = segments.zscores(segments.predict_clusters(model, t.customers)).collect()
    for r in rows:
        distance = ((np.array([r[f"z_{c}"] for c in segments.CLUSTER_FEATURES]) - centers) ** 2).sum(1)
        assert distance[r.clusters] <= distance.min() + 1e-2
    assert len({r.clusters for r in rows}) == 3


def test_more_starts_never_cost_more(t):
    costs = [segments.fit_k_means(t.customers, starts=s).cost for s in (1, 4)]
    assert costs[1] <= costs[0]


def test_k_means_of_few_equal_and_no_points(spark):
    schema = "id long, a double, b double"
    df = spark.createDataFrame([(1, 0.0, 5.0), (2, 0.0, 5.0), (3, 9.0, 5.0), (4, 9.0, 5.0)], schema)
    fits = kmeans.fit(df, ["a", "b"], {1: 1, 2: 2, 4: 4}, "id")
    assert [len(fits[r].centers) for r in (1, 2, 4)] == [1, 2, 2]  # two distinct points, a constant feature
    assert fits[1].cost == 4 * kmeans.GRID**2 and fits[2].cost == fits[4].cost == 0
    labels = {r.id: r.clusters for r in kmeans.assign(df, fits[4]).collect()}
    assert labels[1] == labels[2] != labels[3] == labels[4]
    empty = kmeans.fit(df.limit(0), ["a", "b"], {0: 3}, "id")[0]
    assert empty.centers == () and empty.cost == 0
    assert [r.clusters for r in kmeans.assign(df, empty).collect()] == [None] * 4
    tie = kmeans.Clustering(("a", "b"), (0.0, 0.0), (1.0, 1.0), ((-kmeans.GRID, 0), (kmeans.GRID, 0)))
    assert kmeans.assign(spark.createDataFrame([(1, 0.0, 0.0)], schema), tie).first().clusters == 0


def test_k_means_does_not_depend_on_partitions(t):
    one, two = (segments.fit_k_means(df, starts=2) for df in (t.customers, t.customers.repartition(7)))
    assert (one.centers, one.cost) == (two.centers, two.cost)


def test_a_pass_does_not_multiply_the_points(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(str(i), rng.randint(-10**9, 10**9), rng.randint(-10**9, 10**9)) for i in range(200)]
    points = spark.createDataFrame(rows, "id string, x0 long, x1 long").repartition(3)
    runs = {2: [(0, 0), (10**8, 5)], 3: [(0, 0), (0, 0), (-(10**8), 7)]}
    plans, collect = [], type(points).collect
    monkeypatch.setattr(type(points), "collect", lambda df: plans.append(df._jdf.queryExecution().toString()) or collect(df))
    got = {(r.run, r.cluster): tuple(map(int, r[2:])) for r in kmeans._totals(points, runs)}
    assert plans and not any("Generate" in p or "lambdafunction" in p for p in plans)
    want = {}
    for run, centers in runs.items():
        for _, *p in rows:
            cost, c = min((sum((a - b) ** 2 for a, b in zip(p, center)), c) for c, center in enumerate(centers, 1))
            n, total, squares, x, y = want.get((run, c), (0,) * 5)
            want[run, c] = (n + 1, total + cost, squares + sum(a * a for a in p), x + p[0], y + p[1])
    assert got == want and max(w[1] for w in want.values()) > 2**63


def test_saved_clustering_labels_as_before(spark, t, tmp_path):
    model = segments.fit_k_means(t.customers, starts=1)
    kmeans.save(spark, model, str(tmp_path / "model"))
    assert kmeans.load(spark, str(tmp_path / "model")) == model


def test_customers_without_rows_have_no_segments(t):
    labelled, model = segments.segment_customers(t.customers.limit(0))
    assert labelled.count() == 0 and model.centers == ()
    assert segments.names_by_rank([]) == {}


def test_silhouette_equals_all_pairs(t):
    scaled = segments.assign(segments.zscores(t.customers), [(1,) * 5, (0,) * 5, (-1,) * 5])
    rows = scaled.collect()
    x = np.array([[r[f"z_{c}"] for c in segments.CLUSTER_FEATURES] for r in rows])
    label = np.array([r.clusters for r in rows])
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    scores = []
    for i in range(len(x)):
        own = label == label[i]
        if own.sum() == 1:
            scores.append(0.0)
            continue
        a = d[i][own].sum() / (own.sum() - 1)
        b = min(d[i][label == c].mean() for c in set(label) - {label[i]})
        scores.append((b - a) / max(a, b))
    assert segments.cluster_silhouette(scaled).first()[0] == pytest.approx(np.mean(scores))


def test_silhouettes_of_all_runs_equal_all_pairs(spark):
    rng = random.Random(5)
    rows = [(i, rng.gauss(0, 1) + 4 * (i % 3), float(rng.randint(0, 3))) for i in range(60)] + [(60, 90.0, 90.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    fits = kmeans.fit(df, ["a", "b"], {1: 1, 2: 2, 3: 3, 5: 5}, "id")
    far = kmeans.Clustering(fits[2].features, fits[2].means, fits[2].deviations, (*fits[2].centers, (10**7, 10**7)))
    fits[9] = far  # its last center has no rows
    got = {r.run: r.silhouette for r in kmeans.silhouettes(df, fits).collect()}
    assert set(got) == {2, 3, 5, 9} and got[9] == pytest.approx(got[2])
    for run in (2, 3, 5):
        one = kmeans.assign(df, fits[run]).select("clusters", *kmeans.on_grid(far.features, far.means, far.deviations)).collect()
        x, label = np.array([r[1:] for r in one]) / kmeans.GRID, np.array([r.clusters for r in one])
        d = ((x[:, None] - x[None]) ** 2).sum(2)
        scores = []
        for i in range(len(x)):
            own = label == label[i]
            if own.sum() == 1:
                scores.append(0.0)
                continue
            a = d[i][own].sum() / (own.sum() - 1)
            b = min(d[i][label == c].mean() for c in set(label) - {label[i]})
            scores.append((b - a) / max(a, b))
        assert got[run] == pytest.approx(np.mean(scores))
    assert kmeans.silhouettes(df, {1: fits[1]}).count() == 0


def test_names_follow_the_centroids():
    # TotalOrders, ActiveMonth, AvgOrderValue, Recency, PurchaseFrequency
    centers = [(5, 0, 0, -1, 0), (9, 0, 0, 3, 0), (1, 0, 0, 0, 0)]
    assert segments.names_by_rank(centers) == {0: segments.FREQUENT, 1: segments.DORMANT, 2: segments.OCCASIONAL}


def test_literal_names_and_unassigned(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (3,)], "clusters int")
    got = [r.segment for r in segments.label_customers(df).orderBy("clusters").collect()]
    assert got == [segments.DORMANT, segments.OCCASIONAL, segments.FREQUENT, "Unassigned"]


def test_churn_and_text_at_the_threshold(spark):
    df = spark.createDataFrame([(1, 3, 2, 12.345, 180.0, 0.4, 1), (2, 3, 2, 0.125, 180.5, 1.5, 0)],
                               "CustomerID long, TotalOrders long, ActiveMonth long, AvgOrderValue double, Recency double, "
                               "PurchaseFrequency double, clusters int")
    one, two = segments.customer_text(segments.add_churn(df)).orderBy("CustomerID").collect()
    assert (one.Churn, two.Churn) == (0, 1)
    assert one.Customer_Text == (
        "\n       Customer Profile:\n- Orders: 3\n- Active Months: 2\n- Avg Order Value: %.2f\n"
        "- Recency: 180.0 (recently active)\n- Frequency: 0.4 (low engagement)\n- Cluster: 1\n- Churn Risk: No\n" % 12.345)
    assert "Avg Order Value: %.2f\n" % 0.125 in two.Customer_Text and "180.5 (inactive)" in two.Customer_Text
    assert "1.5 (high engagement)" in two.Customer_Text and two.Customer_Text.endswith("Risk: Yes\n")


def test_two_decimals_round_as_python(spark):
    rng = random.Random(3)
    values = [rng.randint(0, 10**7) / d for d in (8, 40, 1000, 3) for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", segments.two_decimals("v").alias("s"))
    assert all(r.s == "%.2f" % r.v for r in df.collect())


def test_sample_member_is_stable(t):
    a = segments.sample_member(t.fixed_segments, segments.FREQUENT).collect()
    assert a == segments.sample_member(t.fixed_segments.repartition(3), segments.FREQUENT).collect() and len(a) == 1


def test_inertia_falls_with_k(t):
    scan = segments.k_scan(t.customers, [2, 4, 8])
    assert scan[2].inertia > scan[4].inertia > scan[8].inertia


# --- insight texts -----------------------------------------------------------------


def test_guard_messages(spark):
    df = spark.createDataFrame([("hello",)], "Customer_Text string")
    assert insights.insight_requests(df.withColumnRenamed("Customer_Text", "x")).first().insights == insights.NO_TEXT
    assert insights.insight_requests(df, has_key=False).first().insights == insights.NO_KEY
    assert insights.insight_requests(df).first().request == insights.PROMPT + "\n\nhello"


@pytest.mark.parametrize("attempts,want", [
    ([("fine", None)], "fine"),
    ([(None, "404 NOT_FOUND"), ("second", None)], "second"),
    ([(None, "404 NOT_FOUND"), (None, "model Not Found here")], "Error: model Not Found here"),
    ([(None, "429 slow down")], insights.FALLBACK),
    ([(None, "Quota is used up"), ("never", None)], insights.FALLBACK),
    ([(None, "400 API_KEY_INVALID")], insights.BAD_KEY),
    ([(None, "API key expired, 404")], insights.BAD_KEY),
    ([(None, "boom"), ("never", None)], "Error: boom"),
    ([(None, "")], insights.NOTHING),
])
def test_responses(spark, attempts, want):
    df = spark.createDataFrame([(1, i, r, e) for i, (r, e) in enumerate(attempts)],
                               "request_id int, candidate int, response string, error string")
    assert [r.insights for r in insights.resolve_insights(df).collect()] == [want]
