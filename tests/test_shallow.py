"""Forests and boosted trees of a few levels beside Spark's estimators on one-hot columns."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from tillsight.functions.ranking import ValueCounts
from tillsight.operators import shallow, trees

COLUMNS, KEYS = ["a", "b"], ["k"]
PRODUCTS, MONTHS = 12, 5


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(8)
    rows = []
    for k in range(600):
        p, m, a, b = int(rng.integers(0, PRODUCTS)), int(rng.integers(0, MONTHS)), float(rng.integers(0, 200)), float(round(rng.normal() * 4, 2))
        rows.append((k, float(p), float(m), a, b, float(round(a * (2 if p == 3 else 1) + b * b + 40 * (p == 7) + 60 * (m == 2) + rng.normal(), 3))))
    return spark.createDataFrame(rows, "k long, p double, m double, a double, b double, target double").repartition(3).cache()


@pytest.fixture(scope="module")
def grown_from(points):
    shape = shallow.Shape(len(COLUMNS), MONTHS, PRODUCTS)
    edges = {c: shallow.cuts(steps) for c, steps in ValueCounts.of(points, COLUMNS).steps(shallow.STEPS).items()}
    blocks = shallow.blocks_of(points, COLUMNS, edges, "p", "m", KEYS, shape)
    told = lambda model: {r.k: r.Predicted for r in shallow.predictions(model, points, COLUMNS, edges, "p", "m", KEYS).collect()}
    return shape, blocks, told


@pytest.fixture(scope="module")
def one_hot(points):
    steps = [OneHotEncoder(inputCols=["p", "m"], outputCols=["ph", "mh"], handleInvalid="keep"), VectorAssembler(inputCols=[*COLUMNS, "ph", "mh"], outputCol="features")]
    return Pipeline(stages=steps).fit(points).transform(points)


def spark_says(estimator, rows):
    return {r.k: r.prediction for r in estimator.setLabelCol("target").fit(rows).transform(rows).collect()}


def test_single_tree_equals_sparks(grown_from, one_hot):
    shape, blocks, told = grown_from
    assert told(shallow.grow_forest(blocks, shape, 1, 5)) == pytest.approx(spark_says(DecisionTreeRegressor(maxDepth=5), one_hot), abs=2e-3)


def test_boosting_equals_sparks(grown_from, one_hot):
    shape, blocks, told = grown_from
    want = spark_says(GBTRegressor(maxIter=7, maxDepth=3), one_hot)
    assert told(shallow.grow_boosted(blocks, shape, 7, 3, refresh=3)) == pytest.approx(want, abs=0.02)


def test_forest_errs_like_sparks(grown_from, one_hot, points):
    """Other draws, the same rules."""
    shape, blocks, told = grown_from
    y = {r.k: r.target for r in points.collect()}
    error = lambda said: np.sqrt(np.mean([(said[k] - y[k]) ** 2 for k in y]))
    ours, theirs = (error(x) for x in (told(shallow.grow_forest(blocks, shape, 40, 5)), spark_says(RandomForestRegressor(numTrees=40, maxDepth=5), one_hot)))
    assert ours == pytest.approx(theirs, rel=0.1)


def test_partitions_and_node_blocks_change_no_tree(grown_from, monkeypatch):
    shape, blocks, told = grown_from
    at_once = told(shallow.grow_forest(blocks, shape, 4, 4))
    monkeypatch.setattr(shallow, "NODES", 3)
    assert told(shallow.grow_forest(blocks.repartition(5), shape, 4, 4)) == at_once


def test_blocks_hold_whole_products(points, monkeypatch):
    """A product's rows lie in one block however small blocks are; rows without a product may be parted."""
    monkeypatch.setattr(shallow, "ROWS", 20)
    shape = shallow.Shape(2, MONTHS, PRODUCTS - 1)
    edges = trees.bin_edges(points, COLUMNS)
    many = points.select("k", F.when(F.col("p") < 11, F.col("p")).otherwise(99.0).alias("p"), "m", "a", "b", "target")
    rows = shallow.blocks_of(many, COLUMNS, edges, "p", "m", KEYS, shape).toArrow().to_batches()
    found = [shallow.Block(batch, k) for batch in rows for k in range(batch.num_rows)]
    assert sum(len(b.code) for b in found) == 600
    seen = [c for b in found for c in b.codes if c < 11]
    assert sorted(seen) == list(range(11))


def test_a_node_may_use_a_third_of_the_columns():
    shape = shallow.Shape(3, 7, 990)
    salt, bound = shallow.drawn_columns(shape, 2, 5, 1 / 3, 42)
    lots = shallow._lots(np.arange(shape.columns), salt)
    assert (lots <= np.uint64(bound)).sum() == 334
    assert shallow.drawn_columns(shape, 2, 6, 1 / 3, 42)[0] != salt


@pytest.mark.parametrize("steps,want", [
    ([(1.0, 5)], [1.0]),
    ([(1.0, 5), (3.0, 6)], [2.0, 3.0]),
    ([(float(v), v + 1) for v in range(8)], [1.5, 3.5, 5.5, 7.0]),
    ([(0.0, 90), (1.0, 91), (2.0, 92), (3.0, 96), (4.0, 100)], [0.5, 1.5, 2.5, 4.0]),
    ([], []),
])
def test_cuts_are_sparks(steps, want):
    assert shallow.cuts(steps, 4) == want
