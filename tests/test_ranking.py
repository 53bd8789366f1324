"""Positions, running totals and quantiles against brute force, also with a hot value."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillsight.functions.ranking import ValueCounts, with_position, with_running_totals
from tillsight.operators import profiling


@pytest.fixture(scope="module")
def values():
    rng = random.Random(5)
    # A third of the rows share one value.
    return [7.0 if rng.random() < 0.34 else rng.choice([rng.gauss(0, 50), float(rng.randint(-20, 20))]) for _ in range(3000)]


@pytest.fixture(scope="module")
def frame(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id int, v double").repartition(7)


def test_positions(frame, values):
    got = {r.id: r.position for r in with_position(frame, "v", "id").collect()}
    want = {i: p for p, i in enumerate(sorted(range(len(values)), key=lambda i: (values[i], i)))}
    assert got == want


def test_running_totals(frame, values):
    whole = frame.withColumn("w", F.round(F.col("v")).cast("long"))
    rows = with_running_totals(whole, [F.desc("v"), F.col("id")], {"upto": "w"}).collect()
    total, want = 0, {}
    weights = {r.id: r.w for r in rows}
    for i in sorted(range(len(values)), key=lambda i: (-values[i], i)):
        total += weights[i]
        want[i] = total
    assert {r.id: r.upto for r in rows} == want


def test_quantiles_equal_numpy(frame, values):
    two = frame.withColumn("w", F.col("v") * 3 + 1)
    probs = [0, 0.01, 0.25, 0.5, 0.77, 0.99, 1]
    got = ValueCounts.of(two, ["v", "w"]).quantiles({"v": probs, "w": probs})
    assert got["v"] == list(np.quantile(values, probs))
    assert got["w"] == list(np.quantile(np.array(values) * 3 + 1, probs))


def test_quantiles_skip_null_and_nan(spark):
    df = spark.sql("SELECT * FROM VALUES (1.0D), (CAST('NaN' AS DOUBLE)), (NULL), (3.0D) AS t(v)")
    assert ValueCounts.of(df, ["v"]).quantiles({"v": [0.5]}) == {"v": [2.0]}


def test_describe(spark, frame, values):
    both = frame.withColumn("none", F.lit(None).cast("double"))
    row, empty = profiling.describe_numeric(both, ["v", "none"]).collect()
    x = np.array(values)
    assert (row["count"], row["min"], row["max"]) == (len(x), x.min(), x.max())
    assert (row["mean"], row["std"]) == pytest.approx((x.mean(), x.std(ddof=1)))
    assert [row["q25"], row["q50"], row["q75"]] == list(np.quantile(x, [0.25, 0.5, 0.75]))
    assert (empty["count"], empty["mean"], empty["std"]) == (0, None, None)
    # A large offset does not wash out a small spread.
    far = spark.sql("SELECT 1e12 + id AS v FROM range(3)")
    assert profiling.describe_numeric(far, ["v"]).first()["std"] == 1.0


def test_histogram_equals_numpy(frame, values):
    rows = sorted(profiling.histogram(frame, "v").collect(), key=lambda r: r.bin)
    counts, edges = np.histogram(values, bins="auto")
    assert [r.lines for r in rows] == list(counts)
    assert [r.left_edge for r in rows] == pytest.approx(list(edges[:-1]), abs=1e-9)


def test_histogram_of_a_constant(spark):
    rows = profiling.histogram(spark.sql("SELECT 4.0D AS v FROM range(10)"), "v").collect()
    assert [(r.left_edge, r.right_edge, r.lines) for r in rows] == [(3.5, 4.5, 10)]


def test_box_plot(frame, values):
    row = profiling.box_plot(frame, "v").first()
    x = np.array(values)
    q1, med, q3 = np.quantile(x, [0.25, 0.5, 0.75])
    inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
    assert (row.q1, row.median, row.q3) == (q1, med, q3)
    assert (row.whisker_low, row.whisker_high) == (inside.min(), inside.max())
    assert row.fliers == len(x) - len(inside)


def test_table_info(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, NULL) AS t(n, s)")
    assert profiling.table_shape(df) == (2, 2)
    assert {r.column: (r.type, r.non_null) for r in profiling.table_info(df).collect()} == {"n": ("int", 2), "s": ("string", 1)}
