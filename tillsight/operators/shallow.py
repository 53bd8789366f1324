"""Forests and boosted trees of a few levels, by the rules of Spark's estimators, with one 0/1 column per product and month.

Spark's estimators keep a number per row and column, which no cluster holds when
every product has a column. Here a row is one byte per feature and the numbers of
its product and month; a split is ``bin <= cut``, ``product = cut`` or
``month = cut``. Rows lie in blocks of whole products, so a task knows the full
sums of the products it reads, and of those of a node only the best leaves it.

All open nodes of a level, of all trees, are grown in one pass: the tasks sum up
histograms, these are added up per node, and one row per node reaches the driver.
Labels are integers on a grid, so the same trees come out whatever the partitions
are. As in Spark the features have at most 32 bins, a tree of several draws every
row a Poisson number of times and every node a third of the columns, and the
first tree of a boosted model counts whole, the others at twice the rate, because
the gradient of the squared error is twice what is left of the label.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import dbl
from ..functions.staging import release, stage
from .trees import GRID, Split, Tree, _binned, _gains, _mixed, _worth, draws

BINS = 32
STEPS = 10_000  # values of a feature between which its cuts are chosen
ROWS = 65_536  # rows of a block, unless one product has more
NODES = 512  # nodes whose histograms are in memory at once
_TYPES = {"code": np.int64, "month": np.int64, "id": np.int64, "y": np.int64, "bins": np.uint8, "score": np.float64}
_BLOCK = ", ".join(f"{c} binary" for c in _TYPES)


@dataclass(frozen=True)
class Shape:
    """How many features, months and products have columns. A larger number of a month or product is none of them."""

    features: int
    months: int
    products: int

    @property
    def columns(self) -> int:
        return self.features + self.months + self.products


class Block:
    """Rows of whole products, by product."""

    def __init__(self, batch: pa.RecordBatch, k: int):
        for name, kind in _TYPES.items():
            setattr(self, name, np.frombuffer(batch.column(name)[k].as_buffer(), kind))
        self.bins = self.bins.reshape(len(self.code), -1)
        first = np.flatnonzero(np.diff(self.code, prepend=-1))
        self.codes, self.place = self.code[first], np.repeat(np.arange(len(first)), np.diff(first, append=len(self.code)))


#: weights and labels of a block's rows for a tree
Seen = Callable[[Block, int], tuple[np.ndarray, np.ndarray]]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    return (Block(batch, k) for batch in batches for k in range(batch.num_rows))


def blocks_of(rows: DataFrame, columns: Sequence[str], edges: Mapping[str, Sequence[float]], code: str, month: str, keys: Sequence[str],
              shape: Shape, label: str = "target", grid: int = GRID) -> DataFrame:
    """The training rows in blocks of whole products; ``id`` is a hash of a row's keys, from which a tree draws."""
    of, names = _binned(edges, columns), list(_TYPES)[:4]
    taken = rows.select(F.col(code).cast("long").alias("code"), F.col(month).cast("long").alias("month"), F.xxhash64(*keys).alias("id"),
                        F.round(dbl(label) * grid).cast("long").alias("y"), *[dbl(c).alias(f"_x{k}") for k, c in enumerate(columns)])
    # rows without a product need not meet
    home = F.when(F.col("code") < shape.products, F.col("code")).otherwise(F.col("id"))
    taken = taken.repartition(home).sortWithinPartitions("code")

    def packed(held: list[list[np.ndarray]], upto: int | None) -> pa.RecordBatch:
        whole = [np.concatenate(x)[:upto] for x in held]
        whole.append(np.zeros(len(whole[0])))
        return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in whole], names=list(_TYPES))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[] for _ in range(5)]
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            seen = pa.RecordBatch.from_arrays([batch.column(f"_x{k}") for k in range(len(columns))], names=list(columns))
            bins = np.frombuffer(b"".join(of(seen)), np.uint8).reshape(batch.num_rows, -1)
            for x, new in zip(held, (*(batch.column(c).to_numpy() for c in names), bins), strict=True):
                x.append(new)
            size += batch.num_rows
            if size >= ROWS:
                codes = np.concatenate(held[0])
                upto = int(np.searchsorted(codes, codes[-1])) if codes[-1] < shape.products else len(codes)
                if upto:
                    yield packed(held, upto)
                    held = [[np.concatenate(x)[upto:]] for x in held]
                    size -= upto
        if size:
            yield packed(held, None)

    return stage(taken.mapInArrow(task, _BLOCK), "blocks")


def placed(tree: Tree, bins: np.ndarray, code: np.ndarray, month: np.ndarray) -> np.ndarray:
    """The leaf of every row."""
    feature, cut, left, right = (np.asarray(x, dtype=np.int64) for x in (tree.feature, tree.cut, tree.left, tree.right))
    columns = bins.shape[1]
    at = np.zeros(len(code), dtype=np.int64)
    moving = np.arange(len(code))
    while len(moving):
        moving = moving[feature[at[moving]] >= 0]
        node = at[moving]
        column, wanted = feature[node], cut[node]
        yes = bins[moving, np.minimum(column, columns - 1)] <= wanted
        for kind, x in ((columns, code), (columns + 1, month)):
            asks = column == kind
            yes[asks] = x[moving[asks]] == wanted[asks]
        at[moving] = np.where(yes, left[node], right[node])
    return at


def cuts(steps: Sequence[tuple[float, int]], most: int = BINS) -> list[float]:
    """Bounds of at most ``most`` bins between ordered values, given with the rows up to each: Spark's choice; the last is the greatest value.

    A bound lies halfway between two values, where the rows up to the first come
    nearer to the next share of them than those up to the second.
    """
    values, upto = [v for v, _ in steps], [n for _, n in steps]
    middle = [(a + b) / 2 for a, b in zip(values, values[1:], strict=False)]
    if len(middle) >= most:
        wanted = stride = upto[-1] / most
        taken = []
        for between, before, after in zip(middle, upto, upto[1:], strict=False):
            if abs(before - wanted) < abs(after - wanted):
                taken.append(between)
                wanted += stride
        middle = taken
    return [*middle, *values[-1:]]


# --- which columns a node may use -----------------------------------------------------


def _lots(column: np.ndarray, salt: int) -> np.ndarray:
    return _mixed(_mixed(column.astype(np.uint64)) ^ np.uint64(salt))


def _salt(tree: int, node: int, seed: int) -> int:
    return int(_mixed(np.array([(seed * 1_000_003 + tree) * 1_000_003 + node], dtype=np.uint64))[0])


def drawn_columns(shape: Shape, tree: int, node: int, share: float, seed: int) -> tuple[int, int]:
    """Salt and bound of a node: it may use the columns whose lot is at most the bound, the given share of all, rounded up."""
    salt = _salt(tree, node, seed)
    many = math.ceil(shape.columns * share)
    if many >= shape.columns:
        return salt, (1 << 64) - 1
    return salt, int(np.partition(_lots(np.arange(shape.columns), salt), many - 1)[many - 1])


# --- one pass over the rows -----------------------------------------------------------


@dataclass(frozen=True)
class _Ask:
    """An open node with its rows and label sum, and the columns it may use."""

    tree: int
    node: int
    n: int
    s: int
    salt: int
    bound: int


def _splits(blocks: DataFrame, trees: Mapping[int, Tree], asks: Sequence[_Ask], shape: Shape, seen: Seen, least: int) -> list[Split | None]:
    """The best split of each node."""
    out: list[Split | None] = []
    for k in range(0, len(asks), NODES):
        out += _pass(blocks, trees, asks[k:k + NODES], shape, seen, least)
    return out


def _pass(blocks: DataFrame, trees: Mapping[int, Tree], asks: Sequence[_Ask], shape: Shape, seen: Seen, least: int) -> list[Split | None]:
    c, m, wide = shape.features, shape.months, BINS + 1
    cells = c * wide + m
    slots: dict[int, list[int]] = {}
    for slot, ask in enumerate(asks):
        slots.setdefault(ask.tree, []).append(slot)
    needed = {t: trees[t] for t in slots}
    totals = np.array([(a.n, a.s) for a in asks], dtype=float)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(asks), 2, cells))
        best: list[tuple] = [(0.0, 0, 0, 0)] * len(asks)  # gain, product, rows, label sum
        for block in _blocks(batches):
            known = np.flatnonzero(block.codes < shape.products)
            for t, mine in slots.items():
                w, y = seen(block, t)
                of = np.full(len(needed[t].feature), -1)
                of[[asks[slot].node for slot in mine]] = np.arange(len(mine))
                own = of[placed(needed[t], block.bins, block.code, block.month)]
                took = np.flatnonzero((own >= 0) & (w > 0))
                if not len(took):
                    continue
                own, w = own[took], w[took].astype(float)
                wy, bins, month = w * y[took], block.bins[took], block.month[took]
                into = sums[mine[0]:mine[-1] + 1]
                base = own * cells
                parts = [(base + k * wide + bins[:, k], slice(None)) for k in range(c)] + [((base + c * wide + month), month < m)]
                for flat, rows in parts:
                    for k, x in enumerate((w, wy)):
                        into[:, k] += np.bincount(flat[rows], x[rows], len(mine) * cells).reshape(len(mine), cells)
                if not len(known):
                    continue
                flat = own * len(block.codes) + block.place[took]
                n, s = (np.bincount(flat, x, len(mine) * len(block.codes)).reshape(len(mine), -1)[:, known] for x in (w, wy))
                gains = _gains(n, s, totals[mine, :1], totals[mine, 1:], least)
                for k, slot in enumerate(mine):
                    gains[k][_lots(c + m + block.codes[known], asks[slot].salt) > np.uint64(asks[slot].bound)] = -1.0
                    p = int(gains[k].argmax())
                    code = int(block.codes[known[p]])
                    if gains[k, p] > 0 and (gains[k, p], -code) > (best[slot][0], -best[slot][1]):
                        best[slot] = (float(gains[k, p]), code, int(n[k, p]), int(s[k, p]))
        some = np.flatnonzero(sums[:, 0].any(1))
        gain, code, n, s = ([best[k][j] for k in some] for j in range(4))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array([sums[k].tobytes() for k in some], pa.binary()), pa.array(gain, pa.float64()),
             *(pa.array(x, pa.int64()) for x in (code, n, s))], names=["slot", "sums", "gain", "code", "n", "s"])

    def choose(part: pa.Table) -> pa.Table:
        slot = part.column("slot")[0].as_py()
        ask = asks[slot]
        n, s = sum(np.frombuffer(x.as_buffer()).reshape(2, cells) for x in part.column("sums").combine_chunks())
        allowed = _lots(np.arange(c + m), ask.salt) <= np.uint64(ask.bound)
        n_bins, s_bins = (x[:c * wide].reshape(c, wide).cumsum(1) for x in (n, s))
        by_bin = np.where(allowed[:c, None], _gains(n_bins, s_bins, ask.n, float(ask.s), least), -1.0).ravel()
        by_month = np.where(allowed[c:], _gains(n[c * wide:], s[c * wide:], ask.n, float(ask.s), least), -1.0)
        found = (0.0, -1, 0, 0, 0)
        if c:
            k = int(by_bin.argmax())
            found = (float(by_bin[k]), *divmod(k, wide), int(n_bins.ravel()[k]), int(s_bins.ravel()[k]))
        gain, code, its_n, its_s = (part.column(x).to_numpy() for x in ("gain", "code", "n", "s"))
        k = int(np.lexsort((code, -gain))[0])
        if gain[k] > max(found[0], 0.0):
            found = (float(gain[k]), c, int(code[k]), int(its_n[k]), int(its_s[k]))
        if m and by_month.max() > max(found[0], 0.0):
            k = int(by_month.argmax())
            found = (float(by_month[k]), c + 1, k, int(n[c * wide + k]), int(s[c * wide + k]))
        names = ("gain", "feature", "cut", "n", "s")
        return pa.table({"slot": pa.array([slot], pa.int32()), **{x: pa.array([v], pa.float64() if x == "gain" else pa.int64()) for x, v in zip(names, found, strict=True)}})

    partial = blocks.mapInArrow(task, "slot int, sums binary, gain double, code long, n long, s long")
    best = partial.groupBy("slot").applyInArrow(choose, "slot int, gain double, feature long, cut long, n long, s long").collect()
    out: list[Split | None] = [None] * len(asks)
    for r in best:
        ask = asks[r["slot"]]
        if _worth(r["gain"], ask.s):
            out[r["slot"]] = Split(r["gain"], r["feature"], r["cut"], r["n"], r["s"], ask.n - r["n"], ask.s - r["s"])
    return out


def _totals(blocks: DataFrame, trees: Sequence[int], seen: Seen) -> dict[int, tuple[int, int]]:
    """Rows and label sum of each tree."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((2, len(trees)), dtype=np.int64)
        for block in _blocks(batches):
            for k, t in enumerate(trees):
                w, y = seen(block, t)
                out[:, k] += w.sum(), (w * y).sum()
        yield pa.RecordBatch.from_pydict({"tree": pa.array(list(trees), pa.int32()), "n": pa.array(out[0]), "s": pa.array(out[1])})

    found = blocks.mapInArrow(task, "tree int, n long, s long").groupBy("tree").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    return {r["tree"]: (r["n"], r["s"]) for r in found if r["n"]}


def _grown(blocks: DataFrame, numbers: Sequence[int], shape: Shape, depth: int, seen: Seen, share: float, seed: int, least: int) -> dict[int, Tree]:
    """Trees of at most ``depth`` levels of splits, a level of all of them at a time."""
    trees: dict[int, Tree] = {}
    level = []
    for t, (n, s) in sorted(_totals(blocks, numbers, seen).items()):
        trees[t] = Tree()
        level.append((t, trees[t].add(s / n), n, s))
    for _ in range(depth):
        asks = [_Ask(t, node, n, s, *drawn_columns(shape, t, node, share, seed)) for t, node, n, s in level if n > 1]
        level = []
        for ask, found in zip(asks, _splits(blocks, trees, asks, shape, seen, least), strict=True):
            if found:
                left, right = trees[ask.tree].split(ask.node, found)
                level += [(ask.tree, left, found.n, found.s), (ask.tree, right, found.n_right, found.s_right)]
        level.sort()
        if not level:
            break
    return trees


@dataclass
class Model:
    """Trees with their weights, in label steps."""

    trees: list[Tree]
    weights: list[float]
    grid: int


def grow_forest(blocks: DataFrame, shape: Shape, trees: int = 20, depth: int = 5, seed: int = 42, least: int = 1, grid: int = GRID) -> Model:
    """Bagged trees, each node of which tries a third of the columns; a single tree learns from all rows and columns as they are."""
    numbers, share = ([0], 1.0) if trees == 1 else (range(1, trees + 1), 1 / 3)
    found = _grown(blocks, numbers, shape, depth, lambda b, t: (draws(b.id, t, seed), b.y), share, seed, least)
    if not found:
        raise ValueError("a forest needs training rows")
    return Model(list(found.values()), [1 / len(found)] * len(found), grid)


def grow_boosted(blocks: DataFrame, shape: Shape, rounds: int = 20, depth: int = 3, rate: float = 0.1, least: int = 1, refresh: int = 5,
                 grid: int = GRID) -> Model:
    """Trees that each learn what those before leave of the labels; ``refresh`` rounds are kept in the tasks before the scores are written."""
    model, pending, scored = Model([], [], grid), [], blocks
    for done in range(rounds):
        tree = _grown(scored, [0], shape, depth, _residual(pending), 1.0, 0, least).get(0)
        if tree is None:
            raise ValueError("boosting needs training rows")
        model.trees.append(tree)
        model.weights.append(2 * rate if done else 1.0)
        pending.append((tree, model.weights[-1]))
        if len(pending) == refresh and done + 1 < rounds:
            before, scored, pending = scored, stage(scored.mapInArrow(_rescored(pending), _BLOCK), "blocks"), []
            if before is not blocks:
                release(before)
    if scored is not blocks:
        release(scored)
    return model


def _score(pending: Sequence[tuple[Tree, float]], block: Block) -> np.ndarray:
    score = block.score.copy()
    for tree, weight in pending:
        score += weight * np.asarray(tree.value)[placed(tree, block.bins, block.code, block.month)]
    return score


def _residual(pending: Sequence[tuple[Tree, float]]) -> Seen:
    pending = list(pending)
    return lambda block, _: (np.ones(len(block.y), dtype=np.int64), np.rint(block.y - _score(pending, block)).astype(np.int64))


def _rescored(pending: Sequence[tuple[Tree, float]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    pending = list(pending)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [_score(pending, Block(batch, k)).tobytes() for k in range(batch.num_rows)]
            yield batch.set_column(batch.schema.get_field_index("score"), "score", pa.array(scores, pa.binary()))

    return task


def predictions(model: Model, rows: DataFrame, columns: Sequence[str], edges: Mapping[str, Sequence[float]], code: str, month: str, keys: Sequence[str],
                label: str = "target") -> DataFrame:
    """Keys, label and ``Predicted`` of every row."""
    of = _binned(edges, columns)
    named = rows.select(*keys, dbl(label).alias(label), F.col(code).cast("long").alias("_code"), F.col(month).cast("long").alias("_month"),
                        *[dbl(c).alias(f"_x{k}") for k, c in enumerate(columns)])
    out = named.select(*keys, label).schema.add("Predicted", "double")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = pa.RecordBatch.from_arrays([batch.column(f"_x{k}") for k in range(len(columns))], names=list(columns))
            bins = np.frombuffer(b"".join(of(seen)), np.uint8).reshape(-1, len(columns))
            code, month, score = batch.column("_code").to_numpy(), batch.column("_month").to_numpy(), np.zeros(batch.num_rows)
            for tree, weight in zip(model.trees, model.weights, strict=True):
                score += weight * np.asarray(tree.value)[placed(tree, bins, code, month)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in [*keys, label]], pa.array(score / model.grid)], names=out.names)

    return named.mapInArrow(task, out)
