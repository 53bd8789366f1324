"""Tree growth against trees grown by trying every split in plain Python."""

import heapq

import numpy as np
import pytest

from tillsight.operators import trees

COLUMNS, KEYS = ["a", "b"], ["k"]


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(5)
    rows = [(k, int(rng.integers(0, 12)), float(rng.integers(0, 40)), float(round(rng.normal() * 4, 1))) for k in range(200)]
    rows = [(k, p, a, b, float(round(a * (2 if p == 3 else 1) + b * b + (30 if p == 7 else 0) + rng.normal(), 3))) for k, p, a, b in rows]
    return spark.createDataFrame(rows, "k long, p long, a double, b double, target double").repartition(3), rows


def variants(rows):
    """Every split of ``rows``, as a test on a row, in the order that ties are broken."""
    for c in (2, 3):
        for cut in sorted({r[c] for r in rows})[:-1]:
            yield lambda r, c=c, cut=cut: r[c] <= cut
    for code in sorted({r[1] for r in rows}):
        yield lambda r, code=code: r[1] == code


def error(ys):
    return sum((y - sum(ys) / len(ys)) ** 2 for y in ys)


def best_split(rows, ys, least):
    best = (1e-9, None)
    for test in variants(rows):
        side = [test(r) for r in rows]
        left, right = [y for y, s in zip(ys, side) if s], [y for y, s in zip(ys, side) if not s]
        if min(len(left), len(right)) >= least:
            gain = error(ys) - error(left) - error(right)
            if gain > best[0] * (1 + 1e-9):
                best = (gain, test)
    return best


def plain_tree(rows, ys):
    gain, test = best_split(rows, ys, 1)
    if test is None:
        mean = sum(ys) / len(ys)
        return lambda r: mean
    side = [test(r) for r in rows]
    left = plain_tree([r for r, s in zip(rows, side) if s], [y for y, s in zip(ys, side) if s])
    right = plain_tree([r for r, s in zip(rows, side) if not s], [y for y, s in zip(ys, side) if not s])
    return lambda r: left(r) if test(r) else right(r)


def told_by(forest, df, edges):
    return {(r.k, r.tree): r.value for r in trees.forest_predictions(forest, df, COLUMNS, edges, "p", KEYS).collect()}


@pytest.mark.parametrize("whole", [1_000, 30])
def test_tree_equals_trying_every_split(points, whole):
    """Also with the upper levels grown from histograms; on rows that the tree has not seen too."""
    df, rows = points
    seen, edges = df.where("k < 150"), None
    edges = trees.bin_edges(seen, COLUMNS)
    binned = trees.training_rows(seen, COLUMNS, edges, "p", KEYS)
    told = told_by(trees.grow_forest(binned, 2, 1, whole=whole), df, edges)
    plain = plain_tree([r for r in rows if r[0] < 150], [r[4] for r in rows if r[0] < 150])
    assert len(told) == 200
    assert all(told[r[0], 0] == pytest.approx(plain(r)) for r in rows)


def test_upper_levels_change_no_tree(points):
    df, _ = points
    edges = trees.bin_edges(df, COLUMNS)
    binned = trees.training_rows(df, COLUMNS, edges, "p", KEYS)
    at_once = told_by(trees.grow_forest(binned, 2, 4, whole=1_000), df, edges)
    by_level = told_by(trees.grow_forest(binned.repartition(5), 2, 4, whole=40), df, edges)
    assert len(at_once) == 800 and at_once == pytest.approx(by_level)


def test_boosting_equals_plain_leaf_wise_growth(points):
    df, rows = points
    edges = trees.bin_edges(df, COLUMNS)
    binned = trees.training_rows(df, COLUMNS, edges, "p", KEYS)
    model = trees.grow_boosted(binned, 2, rounds=4, leaves=6, rate=0.5, least=5, refresh=2)
    told = {r.k: r.Predicted for r in trees.boosted_predictions(model, df, COLUMNS, edges, "p", KEYS).collect()}
    score = {r[0]: sum(r[4] for r in rows) / len(rows) for r in rows}
    for _ in range(4):
        left = {r[0]: round((r[4] - score[r[0]]) * 1000) / 1000 for r in rows}
        gain, test = best_split(rows, [left[r[0]] for r in rows], 5)
        edge, done, number = [(-gain, 0, rows, test)], [], 0
        while edge and len(edge) + len(done) < 6:
            _, _, here, test = heapq.heappop(edge)
            for side in (True, False):
                part = [r for r in here if test(r) == side]
                gain, under = best_split(part, [left[r[0]] for r in part], 5)
                number += 1
                if under:
                    heapq.heappush(edge, (-gain, number, part, under))
                else:
                    done.append(part)
        for part in [*done, *[e[2] for e in edge]]:
            mean = sum(left[r[0]] for r in part) / len(part)
            for r in part:
                score[r[0]] += 0.5 * mean
    assert told == pytest.approx(score, abs=2e-3)


def test_draws_are_poisson_and_depend_on_the_row_alone():
    ids = np.arange(200_000) * 7919 - 3
    w = trees.draws(ids, 3)
    assert abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.02 and abs((w == 0).mean() - np.exp(-1)) < 0.005
    assert (trees.draws(ids[500:600], 3) == w[500:600]).all() and (trees.draws(ids, 4) != w).any()
    assert (trees.draws(ids, 0) == 1).all()


def test_edges_hold_equal_shares(spark):
    df = spark.range(1000).selectExpr("CAST(id AS DOUBLE) AS a", "CAST(IF(id < 900, 0, id) AS DOUBLE) AS b", "CAST(NULL AS DOUBLE) AS c")
    edges = trees.bin_edges(df, ["a", "b", "c"], 4)
    assert edges["a"] == [249.0, 499.0, 749.0, 999.0] and edges["b"] == [0.0, 999.0] and "c" not in edges


def test_missing_values_go_left_and_equal_labels_stay_whole(spark):
    df = spark.createDataFrame([(1, 0, None, 0.0, 5.0), (2, 0, 1.0, 0.0, 9.0), (3, 1, 1.0, 0.0, 9.0)], "k long, p long, a double, b double, target double")
    edges = trees.bin_edges(df, COLUMNS)
    told = told_by(trees.grow_forest(trees.training_rows(df, COLUMNS, edges, "p", KEYS), 2, 1), df, edges)
    assert told == {(1, 0): 5.0, (2, 0): 9.0, (3, 0): 9.0}


@pytest.mark.parametrize("weights", [1, 3])
def test_splitting_off_one_product_after_another_reads_few_rows(monkeypatch, weights):
    """1,500 levels: the sums of the many rows left are not taken anew at each."""
    n, read, bincount = 1_500, [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda x, *more: read.append(len(x)) or bincount(x, *more))
    y = np.rint(1.008 ** np.arange(n) * 1_000).astype(np.int64)
    bins, code = np.ones((n, 2), dtype=np.uint8), np.arange(n) * 7
    tree = trees.grown(bins, code, np.full(n, weights), y)
    told = np.asarray(tree.value)[tree.route(bins, code)]
    assert (abs(told - y) <= 0.5).mean() > 0.9  # equal labels stay together
    assert sum(read) < 20 * n * bins.shape[1]


def test_blocks_of_rows_change_no_tree(monkeypatch):
    rng = np.random.default_rng(3)
    bins, code, w = rng.integers(0, 30, (900, 3)).astype(np.uint8), rng.integers(0, 50, 900), rng.integers(1, 4, 900)
    y = np.rint(rng.normal(size=900) * 1_000 + bins[:, 0].astype(int) * 300).astype(np.int64)
    at_once = trees.grown(bins, code, w, y, 2)
    monkeypatch.setattr(trees, "TAKEN", 37)
    assert trees.grown(bins, code, w, y, 2) == at_once


@pytest.mark.parametrize("stop", [200, 400, 700])
def test_open_leaves_grown_on_give_the_whole_tree(stop):
    """The upper part of a tree, with the subtrees of its open leaves put in their places."""
    rng = np.random.default_rng(stop)
    n = 1_500
    bins, code, w = rng.integers(0, 60, (n, 3)).astype(np.uint8), rng.integers(0, 200, n), np.ones(n, dtype=np.int64)
    y = np.rint(rng.normal(size=n) * 1_000 + bins[:, 0].astype(int) * 300 + (code < 40) * code * 900).astype(np.int64)
    whole, upper = trees.grown(bins, code, w, y), trees.grown(bins, code, w, y, stop=stop)
    opened = [k for k, f in enumerate(upper.feature) if f == trees.OPEN]
    assert opened and len(upper.feature) < len(whole.feature)
    tree = trees.Tree(*[[x] for x in (trees.OPEN, 0, 0, 0, 0.0)])
    opened = tree.graft(0, upper)
    at = tree.route(bins, code)
    for leaf in opened:
        mine = at == leaf
        assert trees.FEW < mine.sum() <= stop
        assert not tree.graft(leaf, trees.grown(bins[mine], code[mine], w[mine], y[mine]))
    assert len(tree.feature) == len(whole.feature)
    told = [np.asarray(t.value)[t.route(bins, code)] for t in (tree, whole)]
    assert (told[0] == told[1]).all() and (told[0] == y).mean() > 0.9


@pytest.mark.parametrize("own", [1_000, 140])
def test_subtrees_of_their_own_change_no_tree(points, own):
    df, _ = points
    edges = trees.bin_edges(df, COLUMNS)
    binned = trees.training_rows(df, COLUMNS, edges, "p", KEYS)
    forest = trees.grow_forest(binned, 2, 3, own=own)
    assert (len(forest.tops[0].feature) > 1) == (own < 200)
    whole = trees.grow_forest(binned, 2, 3, whole=1_000)
    assert told_by(forest, df, edges) == pytest.approx(told_by(whole, df, edges))


def test_many_products_are_tried_as_all_are(monkeypatch):
    rng = np.random.default_rng(9)
    n = 3_000
    bins, code, w = rng.integers(0, 9, (n, 2)).astype(np.uint8), rng.integers(0, 900, n), rng.integers(1, 3, n)
    y = rng.integers(0, 40, n) * 1_000 + code // 9 * 500
    monkeypatch.setattr(trees, "MANY", 10_000)
    every = trees.grown(bins, code, w, y)
    monkeypatch.setattr(trees, "MANY", 1)
    assert trees.grown(bins, code, w, y) == every


def test_products_split_off_are_routed_in_one_step(monkeypatch):
    """3,000 levels took 3,000 steps over the rows."""
    n, steps, search = 3_000, [], np.searchsorted
    y = np.rint(1.004 ** np.arange(n) * 1_000).astype(np.int64)
    bins, code = np.ones((n, 2), dtype=np.uint8), np.arange(n) * 7
    tree = trees.grown(bins, code, np.full(n, 1), y)
    monkeypatch.setattr(np, "searchsorted", lambda *a: steps.append(1) or search(*a))
    told = np.asarray(tree.value)[tree.route(bins, code)]
    assert (abs(told - y) <= 0.5).mean() > 0.9
    assert len(steps) < 100


def test_products_that_wait_hold_no_sums():
    """A chain of 2,000 products of 40 rows each: sums of all bins for every one that waits took 270 MB."""
    import tracemalloc

    n, rows = 2_000, 40
    rng = np.random.default_rng(2)
    bins = rng.integers(0, 250, (n * rows, 32)).astype(np.uint8)
    code = np.repeat(np.arange(n), rows)
    y = np.rint(1.006 ** code * 100_000).astype(np.int64)
    tracemalloc.start()
    tree = trees.grown(bins, code, np.ones(len(code), dtype=np.int64), y, stop=100)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(tree.feature) > n
    assert peak < 100 << 20
