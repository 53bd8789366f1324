"""Regression trees on binned columns: bagged trees of any depth, and leaf-wise boosting.

A row is one byte (its bin) per column and the number of its product; a product
enters as one 0/1 column per value, so a split is ``bin <= cut`` or
``product = cut``. Labels are integers on a grid, sums of them are exact, and
the same trees come out whatever the partitions are.

All open nodes of all trees are grown together: one pass adds up a histogram per
node and column, Spark sums the partial histograms, and only the sums of a block
of ``BLOCK`` nodes reach the driver. Full trees can be thousands of levels deep, as
products are split off one by one, so a node of at most ``whole`` rows is grown on by
one task from its own rows, until its nodes have at most ``own`` rows. Those are
finished by one task each, and such subtrees stay in a table: the driver holds the
upper part of the trees only. Neither bound changes a split.

A missing value counts as smaller than all others. Ties go to the first column,
then to the lowest cut. A split that lowers the squared error by nothing is not made.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import dbl
from ..functions.ranking import ValueCounts
from ..functions.staging import release, stage

BINS = 256
BLOCK = 256  # nodes whose histograms are in memory at once
WHOLE = 4_194_304  # rows of a node that one task grows on
OWN = 16_384  # rows of a subtree that has a task of its own
FEW = 128  # rows of a node that is finished where it comes up
TINY = 32  # rows of the nodes that are split together
MANY = 1_024  # products of a node of which only those that may be the best are tried
TAKEN = 8_192  # rows whose cells are summed at a time
TRIED = 1 << 20  # cells of the nodes that are split together, at a time
SALTED = 65_536  # rows to be predicted that meet a subtree in one task
GRID = 1_000  # steps per unit of the label
_ROW = "id long, code long, bins binary, y long"
_PART = "tree int, node int, code long, bins binary, w long, y long"
_TREE = ("feature", "cut", "left", "right", "value")
_TREE_TYPES = tuple(pa.list_(t) for t in (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64()))
_SUBTREE = "tree int, node int, feature array<int>, cut array<long>, left array<int>, right array<int>, value array<double>"


@dataclass
class Tree:
    """Arrays of nodes; ``feature`` is -1 at a leaf and the number of columns where a product is asked for."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self, value: float) -> int:
        for name, x in (("feature", -1), ("cut", 0), ("left", 0), ("right", 0), ("value", value)):
            getattr(self, name).append(x)
        return len(self.feature) - 1

    def split(self, node: int, found: Split) -> tuple[int, int]:
        """Give ``node`` two leaves below it."""
        self.feature[node], self.cut[node] = found.feature, found.cut
        self.left[node] = self.add(found.s / found.n)
        self.right[node] = self.add(found.s_right / found.n_right)
        return self.left[node], self.right[node]

    def route(self, bins: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The leaf of every row."""
        return Router(self, bins.shape[1]).route(bins, code)

    def graft(self, node: int, below: Tree) -> list[int]:
        """Put ``below`` in the place of the leaf ``node``; the leaves of it that are open (``feature`` -2), by their number here."""
        first = len(self.feature) - 1  # the root of ``below`` is ``node`` itself
        name = lambda k: node if k == 0 else first + k
        for column in ("feature", "cut", "value"):
            getattr(self, column)[node] = getattr(below, column)[0]
            getattr(self, column).extend(getattr(below, column)[1:])
        for column in ("left", "right"):
            named = [k and name(k) for k in getattr(below, column)]  # a leaf has 0
            getattr(self, column)[node] = named[0]
            getattr(self, column).extend(named[1:])
        opened = [name(k) for k, f in enumerate(below.feature) if f == OPEN]
        for k in opened:
            self.feature[k] = -1
        return opened


OPEN = -2  # ``feature`` of a leaf that is to be grown on


class Router:
    """A tree as arrays. Products split off one after another are looked up at once, so that thousands of levels are one step."""

    def __init__(self, tree: Tree, columns: int):
        self.columns = columns
        self.feature, self.cut, self.left, self.right = (np.asarray(x, dtype=np.int64) for x in (tree.feature, tree.cut, tree.left, tree.right))
        nodes = np.flatnonzero(self.feature == columns)
        # a chain goes on from a product's node to its right child while that asks for a product too
        head = np.arange(len(self.feature))
        on = nodes[self.feature[self.right[nodes]] == columns]
        head[self.right[on]] = on
        while True:
            higher = head[head]
            if (higher == head).all():
                break
            head = higher
        self.behind = np.zeros(len(self.feature), dtype=np.int64)  # where a chain leads all other products, by its head
        last = nodes[self.feature[self.right[nodes]] != columns]
        self.behind[head[last]] = self.right[last]
        self.base = int(self.cut[nodes].max(initial=0)) + 2
        key = head[nodes] * self.base + self.cut[nodes]
        order = np.argsort(key)
        self.key, self.to = np.append(key[order], -1), np.append(self.left[nodes][order], 0)

    def route(self, bins: np.ndarray, code: np.ndarray) -> np.ndarray:
        at = np.zeros(len(code), dtype=np.int64)
        code = np.minimum(code, self.base - 1)
        moving = np.arange(len(code))
        while len(moving):
            column = self.feature[at[moving]]
            inside = column >= 0
            moving, column = moving[inside], column[inside]
            by_code = column == self.columns
            rows, some = moving[by_code], moving[~by_code]
            node = at[rows]
            wanted = node * self.base + code[rows]
            place = np.searchsorted(self.key[:-1], wanted)
            at[rows] = np.where(self.key[place] == wanted, self.to[place], self.behind[node])
            node = at[some]
            at[some] = np.where(bins[some, column[~by_code]] <= self.cut[node], self.left[node], self.right[node])
        return at


@dataclass(frozen=True)
class Split:
    """A split with the rows and label sums of its left and right side."""

    gain: float
    feature: int
    cut: int
    n: int
    s: int
    n_right: int
    s_right: int


def _gain(n: np.ndarray, s: np.ndarray, all_n: int, all_s: int, least: int) -> np.ndarray:
    """By how much the squared error falls if ``n`` rows with sum ``s`` go left; -1 where a side has fewer than ``least`` rows."""
    return _gains(n, s, all_n, float(all_s), least)


def _gains(n: np.ndarray, s: np.ndarray, all_n: np.ndarray | int, all_s: np.ndarray | float, least: int) -> np.ndarray:
    """:func:`_gain` of the splits of one node or of many."""
    rest = all_n - n
    apart = s.astype(float) * all_n - all_s * n  # of either side the same, but for its sign
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where((n >= least) & (rest >= least), apart * apart / (n * rest.astype(float)) / all_n, -1.0)


def _worth(gain: float, s: int) -> bool:
    """Whether a gain is more than the rounding of its own computation."""
    return gain > max(1e-6, (1e-14 * s) ** 2)


def _better(found: Split | None, n: np.ndarray, s: np.ndarray, all_n: int, all_s: int, least: int,
            name: Callable[[int], tuple[int, int]]) -> Split | None:
    """The best of the candidates, or ``found`` unless they beat it; ``name`` gives a candidate's column and cut."""
    if not n.size:
        return found
    gains = _gain(n, s, all_n, all_s, least).ravel()
    best = int(gains.argmax())
    if not _worth(gains[best], all_s) or (found and gains[best] <= found.gain):
        return found
    left, total = int(n.ravel()[best]), int(s.ravel()[best])
    return Split(float(gains[best]), *name(best), left, total, all_n - left, all_s - total)


def _of_histogram(n: np.ndarray, s: np.ndarray, all_n: int, all_s: int, least: int) -> Split | None:
    """Best cut of (column, bin) histograms."""
    return _better(None, n.cumsum(1), s.cumsum(1), all_n, all_s, least, lambda k: divmod(k, BINS))


class _Products:
    """Rows and label sums of a node's products, of which some are split off.

    Of the products with equally many rows the one with the least or the greatest
    sum is worth most, so of many products only those are tried.
    """

    def __init__(self, place: np.ndarray, n: np.ndarray, s: np.ndarray):
        self.place, self.n, self.s = place, n, s
        self.ends = []
        if len(place) > MANY:
            size, first, group = np.unique(n, return_index=True, return_inverse=True)
            self.group, self.gone = group, np.zeros(len(n) + 1, dtype=bool)
            behind = np.cumsum(np.bincount(group))
            for sign in (1, -1):  # by sum, equal ones by number
                order = np.lexsort((place, sign * s, group))
                self.ends.append((order, behind - np.bincount(group), behind))

    def tried(self) -> np.ndarray:
        """Places of the products that may be worth most, ascending."""
        if not self.ends:
            return np.arange(len(self.n))
        return np.unique(np.concatenate([order[at[at < behind]] for order, at, behind in self.ends]))

    def drop(self, k: int) -> None:
        self.n[k] = self.s[k] = 0
        if self.ends:
            self.gone[k] = True
            g = self.group[k]
            for order, at, behind in self.ends:
                while at[g] < behind[g] and self.gone[order[at[g]]]:
                    at[g] += 1


def grown(bins: np.ndarray, code: np.ndarray, w: np.ndarray, y: np.ndarray, least: int = 1, stop: int = 0) -> Tree:
    """The whole tree of rows that fit in a task; leaves of more than ``FEW`` and at most ``stop`` rows stay open.

    The sums of the smaller child are taken from its rows, the other's are what
    is left of the node's: a split that takes a few rows off many costs little,
    and products split off leave the others' rows where they are. Nodes of a few
    rows are put off and split all together.
    """
    columns, tree = bins.shape[1], Tree()
    codes, place = np.unique(code, return_inverse=True)
    order = np.argsort(place, kind="stable")  # rows stay by product, so that those of one lie together
    bins, place, w, y = bins[order], place[order], w[order], y[order]
    width = bins.max(0).astype(np.int64) + 1
    offset = np.cumsum([0, *width])
    size, starts, column_of = int(offset[-1]), offset[:-1], np.repeat(np.arange(columns), width)
    weight, total = w.astype(float), (w * y).astype(float)  # sums are far below 2^53, so doubles hold them

    def sums(rows: np.ndarray) -> np.ndarray:
        """Rows and label sums per bin of every column."""
        out = np.zeros((2, size))
        for k in range(0, len(rows), TAKEN):
            some = rows[k:k + TAKEN]
            where = (bins[some] + starts).ravel()
            for sum_, x in zip(out, (weight, total)):
                sum_ += np.bincount(where, np.repeat(x[some], columns), size)
        return out

    def products(rows: np.ndarray) -> tuple[np.ndarray, _Products]:
        """Where the products of a node begin among its rows, and what they sum up to."""
        of = place[rows]
        first = np.flatnonzero(np.diff(of, prepend=-1))
        return np.append(first, len(rows)), _Products(of[first], np.add.reduceat(weight[rows], first), np.add.reduceat(total[rows], first))

    rows = np.arange(len(w))
    all_n, all_s = int(w.sum()), int(total.sum())
    tiny: list[tuple[int, np.ndarray]] = []
    open_nodes = [(tree.add(all_s / all_n), rows, sums(rows), all_n, all_s)]
    while open_nodes:
        node, rows, here, all_n, all_s = open_nodes.pop()
        if FEW < all_n <= stop:
            tree.feature[node] = OPEN
            continue
        if len(rows) <= TINY:
            tiny.append((node, rows))
            continue
        labels = y[rows]
        if (labels == labels[0]).all():
            continue
        here = sums(rows) if here is None else here
        begin, of = products(rows)
        kept = np.ones(len(rows), dtype=bool)
        while True:
            n, s = here.cumsum(1)
            n, s = (x - np.repeat(x[starts] - own[starts], width) for x, own in ((n, here[0]), (s, here[1])))
            gains = _gain(n, s, all_n, all_s, least)
            best = int(gains.argmax())
            tried = of.tried()
            by_product = _gain(of.n[tried], of.s[tried], all_n, all_s, least)
            k = int(tried[by_product.argmax()])
            gain = max(float(gains[best]), float(by_product.max()))
            if not _worth(gain, all_s):
                break
            if gains[best] >= gain:
                break
            # a product goes, and what is left goes on as the same node
            n, s = int(of.n[k]), int(of.s[k])
            left, node = tree.split(node, Split(gain, columns, int(codes[of.place[k]]), n, s, all_n - n, all_s - s))
            mine = slice(begin[k], begin[k + 1])
            open_nodes.append((left, rows[mine], None, n, s))  # thousands may wait, so their sums are taken when it is their turn
            here = here - sums(rows[mine])
            kept[mine] = False
            of.drop(k)
            all_n, all_s = all_n - n, all_s - s
            if FEW < all_n <= stop:
                break
        rows = rows[kept]
        if FEW < all_n <= stop:
            tree.feature[node] = OPEN
            continue
        if not _worth(gain, all_s):
            continue
        column = int(column_of[best])
        cut, n, s = best - int(offset[column]), int(n[best]), int(s[best])
        side = bins[rows, column] <= cut
        children = zip(tree.split(node, Split(gain, column, cut, n, s, all_n - n, all_s - s)), (rows[side], rows[~side]), ((n, s), (all_n - n, all_s - s)))
        small, large = sorted(children, key=lambda c: len(c[1]))
        near = sums(small[1])
        # the smaller one is finished first, so few nodes are open at a time
        open_nodes += [(*large[:2], here - near, *large[2]), (*small[:2], near, *small[2])]
    if tiny:
        _split_together(tree, tiny, bins, codes, place, weight, total, y, least)
    return tree


def _split_together(tree: Tree, tiny: list[tuple[int, np.ndarray]], bins: np.ndarray, codes: np.ndarray, place: np.ndarray, weight: np.ndarray,
                    total: np.ndarray, y: np.ndarray, least: int) -> None:
    """Finish nodes of at most ``TINY`` rows, one level of all of them at a time."""
    columns = bins.shape[1]
    nodes, rows = np.array([node for node, _ in tiny]), np.concatenate([r for _, r in tiny])
    sizes = np.array([len(r) for _, r in tiny])
    known, most = len(tree.feature), 2 * len(rows)
    feature, cut, left, right = (np.concatenate([np.array(x, dtype=np.int64), np.full(most, fill)]) for x, fill in
                                 ((tree.feature, -1), (tree.cut, 0), (tree.left, 0), (tree.right, 0)))
    value = np.concatenate([np.array(tree.value), np.zeros(most)])
    while len(nodes):
        first = np.cumsum(sizes) - sizes
        low, high = (f.reduceat(y[rows], first) for f in (np.minimum, np.maximum))
        todo = np.flatnonzero((sizes > 1) & (low < high))
        todo = todo[np.argsort(sizes[todo], kind="stable")]  # of about the same size, so that little is filled up
        new_nodes, new_rows, new_sizes = [], [], []
        at = 0
        while at < len(todo):
            slots = int(sizes[todo[at]])
            upto = at + max(1, TRIED // (columns * 2 * slots))
            some = todo[at:upto]
            some = some[sizes[some] <= 2 * slots]
            at += len(some)
            slots = int(sizes[some[-1]])
            real = np.arange(slots) < sizes[some][:, None]
            row = rows[first[some][:, None] + np.where(real, np.arange(slots), 0)]
            w, s = np.where(real, weight[row], 0.0), np.where(real, total[row], 0.0)
            all_n, all_s = w.sum(1), s.sum(1)
            # bin and row in one number, so that sorting it sorts the rows; what fills up comes last
            own = bins[row].transpose(0, 2, 1).astype(np.uint16)
            own[np.broadcast_to(~real[:, None, :], own.shape)] = BINS
            own = np.sort(own * TINY + np.arange(slots, dtype=np.uint16), axis=2)
            by, bin_ = own % TINY, own // TINY
            node_of = np.arange(len(some))[:, None, None]
            n, sum_ = w[node_of, by].cumsum(2), s[node_of, by].cumsum(2)
            gains = _gains(n, sum_, all_n[:, None, None], all_s[:, None, None], least)
            gains[:, :, :-1][bin_[:, :, :-1] == bin_[:, :, 1:]] = -1.0
            flat = gains.reshape(len(some), -1)
            best = flat.argmax(1)
            every = np.arange(len(some))
            gain = flat[every, best]
            same = (place[row][:, :, None] == place[row][:, None, :]) & real[:, None, :]
            n_product, s_product = ((same * x[:, None, :]).sum(2) for x in (w, s))
            by_product = _gains(n_product, s_product, all_n[:, None], all_s[:, None], least)
            by_product[~real] = -1.0
            k = by_product.argmax(1)
            product = by_product[every, k] > gain
            gain = np.where(product, by_product[every, k], gain)
            column = np.where(product, columns, best // slots)
            cuts = np.where(product, codes[place[row[every, k]]], bin_.reshape(len(some), -1)[every, best])
            one = np.where(product, n_product[every, k], n.reshape(len(some), -1)[every, best])
            its = np.where(product, s_product[every, k], sum_.reshape(len(some), -1)[every, best])
            goes = np.where(product[:, None], place[row] == place[row[every, k]][:, None], bins[row, np.minimum(column, columns - 1)[:, None]] <= cuts[:, None])
            split = np.flatnonzero(gain > np.maximum(1e-6, (1e-14 * all_s) ** 2))
            here = nodes[some[split]]
            feature[here], cut[here] = column[split], cuts[split]
            left[here], right[here] = known + 2 * np.arange(len(split)), known + 2 * np.arange(len(split)) + 1
            value[left[here]], value[right[here]] = its[split] / one[split], (all_s - its)[split] / (all_n - one)[split]
            inside = real[split]
            child = (2 * np.arange(len(split))[:, None] + ~goes[split])[inside]
            new_rows.append(row[split][inside][np.argsort(child, kind="stable")])
            new_sizes.append(np.bincount(child, minlength=2 * len(split)))
            new_nodes.append(known + np.arange(2 * len(split)))
            known += 2 * len(split)
        nodes, rows, sizes = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (new_nodes, new_rows, new_sizes))
    tree.feature, tree.cut, tree.left, tree.right, tree.value = (x[:known].tolist() for x in (feature, cut, left, right, value))


# --- rows --------------------------------------------------------------------------


def bin_edges(rows: DataFrame, columns: Sequence[str], most: int = BINS - 1) -> dict[str, list[float]]:
    """Largest value of each of at most ``most`` equally filled bins; every value ends a bin where there are no more rows than bins."""
    return ValueCounts.of(rows, columns).edges(most)


def _binned(edges: Mapping[str, Sequence[float]], columns: Sequence[str]) -> Callable[[pa.RecordBatch], list[bytes]]:
    cuts = [np.asarray(edges.get(c, [])[:-1], dtype=float) for c in columns]

    def of(batch: pa.RecordBatch) -> list[bytes]:
        out = np.empty((batch.num_rows, len(columns)), dtype=np.uint8)
        for k, (c, cut) in enumerate(zip(columns, cuts, strict=True)):
            x = batch.column(c).to_numpy(zero_copy_only=False).astype(float)
            out[:, k] = np.where(np.isnan(x), 0, 1 + np.searchsorted(cut, x, "left"))
        return [row.tobytes() for row in out]

    return of


def training_rows(rows: DataFrame, columns: Sequence[str], edges: Mapping[str, Sequence[float]], code: str, keys: Sequence[str],
                  label: str = "target", grid: int = GRID) -> DataFrame:
    """Bins, product number and label steps of every row; ``id`` is a hash of its keys, from which a tree draws."""
    of = _binned(edges, columns)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_pydict({"id": b.column("_id"), "code": b.column("_code"), "bins": pa.array(of(b), pa.binary()), "y": b.column("_y")})

    taken = rows.select(F.xxhash64(*keys).alias("_id"), F.col(code).cast("long").alias("_code"), F.round(dbl(label) * grid).cast("long").alias("_y"),
                        *[dbl(c).alias(c) for c in columns])
    return stage(taken.mapInArrow(task, _ROW), "binned")


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins, product numbers and label steps of a batch."""
    return _matrix(batch.column("bins")), batch.column("code").to_numpy(), batch.column("y").to_numpy()


def _matrix(packed: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Binary values of one length, as rows of bytes."""
    packed = packed.combine_chunks() if isinstance(packed, pa.ChunkedArray) else packed
    _, ends, data = packed.buffers()
    ends = np.frombuffer(ends, np.int64 if pa.types.is_large_binary(packed.type) else np.int32)[packed.offset:packed.offset + len(packed) + 1]
    return np.frombuffer(data, np.uint8)[ends[0]:ends[-1]].reshape(len(packed), -1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def draws(ids: np.ndarray, tree: int, seed: int = 42) -> np.ndarray:
    """How often ``tree`` takes each row: once for tree 0, a Poisson number of mean 1 for the others."""
    if not tree:
        return np.ones(len(ids), dtype=np.int64)
    salt = _mixed(np.array([seed * 1_000_003 + tree], dtype=np.uint64))
    u = (_mixed(_mixed(ids.astype(np.int64).view(np.uint64)) ^ salt) >> np.uint64(11)) / 2.0**53
    upto = np.exp(-1) * np.cumsum(1 / np.cumprod([1.0, *range(1, 17)]))
    return np.searchsorted(upto, u, "right")


# --- one pass over the rows -----------------------------------------------------------

#: (tree, weights and labels) of a batch, for each tree that has an open node
Seen = Callable[[pa.RecordBatch, int], tuple[np.ndarray, np.ndarray]]


def _sums(rows: DataFrame, trees: Mapping[int, Tree], nodes: Sequence[tuple[int, int]], width: int, seen: Seen, products: bool) -> DataFrame:
    """Rows and label sums per (slot of the node, column, bin or product), as partial sums of the tasks added up."""
    slots: dict[int, dict[int, int]] = {}
    for slot, (t, node) in enumerate(nodes):
        slots.setdefault(t, {})[node] = slot
    found_at = {t: np.array([by.get(k, -1) for k in range(len(trees[t].feature))]) for t, by in slots.items()}
    needed = {t: trees[t] for t in slots}
    size = len(nodes) * width * BINS

    def cells(slot, feature, place, n, s) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(slot, pa.int32()), pa.array(feature, pa.int32()), pa.array(place, pa.int64()), pa.array(n, pa.int64()), pa.array(s, pa.int64())],
            names=["slot", "feature", "bin", "n", "s"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        for batch in batches:
            bins, code, _ = _arrays(batch)
            for t, at in found_at.items():
                slot = at[needed[t].route(bins, code)]
                w, y = seen(batch, t)
                took = np.flatnonzero((slot >= 0) & (w > 0))
                if not len(took):
                    continue
                slot, w, wy = slot[took], w[took], w[took] * y[took]
                flat = ((slot[:, None] * width + np.arange(width)) * BINS + bins[took]).ravel()
                # only the cells that the batch touches, unless it may touch them all; its sums are far below 2^53, so doubles hold them
                here, flat = (slice(None), flat) if size <= len(flat) else np.unique(flat, return_inverse=True)
                cells_here = size if isinstance(here, slice) else len(here)
                n[here] += np.rint(np.bincount(flat, np.repeat(w, width), cells_here)).astype(np.int64)
                s[here] += np.rint(np.bincount(flat, np.repeat(wy, width), cells_here)).astype(np.int64)
                if products:
                    base = int(code.max()) + 1
                    pairs, place = np.unique(slot.astype(np.int64) * base + code[took], return_inverse=True)
                    yield cells(pairs // base, np.full(len(pairs), width), pairs % base,
                                np.rint(np.bincount(place, w)).astype(np.int64), np.rint(np.bincount(place, wy)).astype(np.int64))
        some = np.flatnonzero(n)
        yield cells(some // (width * BINS), some // BINS % width, some % BINS, n[some], s[some])

    partial = rows.mapInArrow(task, "slot int, feature int, bin long, n long, s long")
    return partial.groupBy("slot", "feature", "bin").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))


def _best_products(sums: DataFrame, width: int, totals: Sequence[tuple[int, int]], least: int) -> DataFrame:
    """Of the products of a node only the best one; the bins stay."""
    known = sums.sparkSession.createDataFrame([(k, n, s) for k, (n, s) in enumerate(totals)], "slot int, all_n long, all_s long")
    n, all_n = dbl("n"), dbl("all_n")
    apart = dbl("s") * all_n - dbl("all_s") * n
    product = F.col("feature") == width
    gain = F.when(product, F.when((n >= least) & (all_n - n >= least), F.try_divide(F.try_divide(apart * apart, n * (all_n - n)), all_n)).otherwise(-1.0)).otherwise(0.0)
    best = sums.join(F.broadcast(known), "slot").groupBy("slot", "feature", F.when(product, -1).otherwise(F.col("bin")).alias("_bin")).agg(  # at most BLOCK rows
        F.max(F.struct(F.coalesce(gain, F.lit(-1.0)).alias("gain"), (-F.col("bin")).alias("back"), "n", "s")).alias("b"))
    return best.select("slot", "feature", (-F.col("b.back")).alias("bin"), F.col("b.n").alias("n"), F.col("b.s").alias("s"))


def _splits(rows: DataFrame, trees: Mapping[int, Tree], nodes: Sequence[tuple[int, int]], totals: Sequence[tuple[int, int]] | None,
            width: int, seen: Seen, least: int) -> list[tuple[int, int, Split | None]]:
    """Rows, label sum and best split of each of ``nodes``, a block at a time; products are tried if ``totals`` are given."""
    out = []
    for start in range(0, len(nodes), BLOCK):
        block = nodes[start:start + BLOCK]
        sums = _sums(rows, trees, block, width, seen, totals is not None)
        if totals is not None:
            sums = _best_products(sums, width, totals[start:start + BLOCK], least)
        got = sums.toArrow()
        slot, feature, place, n, s = (got.column(c).to_numpy() for c in ("slot", "feature", "bin", "n", "s"))
        dense = np.zeros((2, len(block), width, BINS), dtype=np.int64)
        bins = feature < width
        dense[:, slot[bins], feature[bins], place[bins]] = n[bins], s[bins]
        for k in range(len(block)):
            all_n, all_s = int(dense[0, k, 0].sum()), int(dense[1, k, 0].sum())
            found = _of_histogram(dense[0, k], dense[1, k], all_n, all_s, least) if all_n else None
            for j in np.flatnonzero((slot == k) & ~bins):
                found = _better(found, n[j:j + 1], s[j:j + 1], all_n, all_s, least, lambda _, j=j: (width, int(place[j])))
            out.append((all_n, all_s, found))
    return out


def _totals(rows: DataFrame, trees: Sequence[int], seen: Seen) -> dict[int, tuple[int, int]]:
    """Rows and label sum of each tree."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = np.zeros(len(trees), dtype=np.int64), np.zeros(len(trees), dtype=np.int64)
        for batch in batches:
            for k, t in enumerate(trees):
                w, y = seen(batch, t)
                n[k] += w.sum()
                s[k] += (w * y).sum()
        yield pa.RecordBatch.from_pydict({"tree": pa.array(list(trees), pa.int32()), "n": pa.array(n), "s": pa.array(s)})

    found = rows.mapInArrow(task, "tree int, n long, s long").groupBy("tree").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    return {r["tree"]: (r["n"], r["s"]) for r in found}


# --- bagged trees ------------------------------------------------------------------


@dataclass
class Forest:
    """Upper parts of the trees, and a table of the subtrees below their unfinished leaves."""

    tops: dict[int, Tree]
    subtrees: DataFrame
    unfinished: dict[int, set[int]]
    grid: int


def _drawn(batch: pa.RecordBatch, tree: int) -> tuple[np.ndarray, np.ndarray]:
    return draws(batch.column("id").to_numpy(), tree), batch.column("y").to_numpy()


def grow_forest(rows: DataFrame, width: int, trees: int = 101, least: int = 1, whole: int = WHOLE, grid: int = GRID, own: int = OWN) -> Forest:
    """Trees of any depth; number 0 learns from the rows as they are, the others from Poisson draws of them."""
    totals = {(t, 0): v for t, v in _totals(rows, range(trees), _drawn).items() if v[0]}
    tops: dict[int, Tree] = {}
    for (t, _), (n, s) in sorted(totals.items()):
        tops[t] = Tree()
        tops[t].add(s / n)
    unfinished: dict[int, set[int]] = {t: set() for t in tops}
    new = sorted(totals)
    while new:
        for t, node in new:
            if totals[t, node][0] <= whole:
                unfinished[t].add(node)
        grow = [key for key in new if totals[key][0] > whole]
        new = []
        for (t, node), (_, _, found) in zip(grow, _splits(rows, tops, grow, [totals[k] for k in grow], width, _drawn, least) if grow else (), strict=True):
            if found:
                left, right = tops[t].split(node, found)
                totals[t, left], totals[t, right] = (found.n, found.s), (found.n_right, found.s_right)
                new += [(t, left), (t, right)]

    # Nodes that are too large for a subtree are grown on, each by one task, and what is left open of them goes to the subtrees.
    large = {t: {k for k in nodes if totals[t, k][0] > own} for t, nodes in unfinished.items()}
    if any(large.values()):
        upper = stage(_finished(rows, tops, large, least, own), "upper")
        for r in upper.toLocalIterator():
            unfinished[r["tree"]].remove(r["node"])
            unfinished[r["tree"]].update(tops[r["tree"]].graft(r["node"], Tree(*[list(r[c]) for c in _TREE])))
        release(upper)
    return Forest(tops, stage(_finished(rows, tops, unfinished, least, 0), "subtrees"), unfinished, grid)


def _finished(rows: DataFrame, tops: Mapping[int, Tree], nodes: Mapping[int, set[int]], least: int, stop: int) -> DataFrame:
    """The trees below ``nodes``, as :func:`grown` leaves them; each is grown by one task."""
    parts = rows.mapInArrow(_scattered(tops, nodes), _PART)

    def finish(part: pa.Table) -> pa.Table:
        tree = grown(_matrix(part.column("bins")), *(part.column(c).to_numpy() for c in ("code", "w", "y")), least, stop)
        return pa.table([part.column("tree")[:1], part.column("node")[:1], *(pa.array([getattr(tree, c)], t) for c, t in zip(_TREE, _TREE_TYPES, strict=True))],
                        names=["tree", "node", *_TREE])

    # A subtree costs far more time than bytes, so tasks are not merged by their size.
    parts = parts.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "tree", "node")
    return parts.groupBy("tree", "node").applyInArrow(finish, _SUBTREE)


def _scattered(tops: Mapping[int, Tree], unfinished: Mapping[int, set[int]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each row once per tree that draws it and whose upper part leaves it unfinished."""
    ends = {t: np.array(sorted(nodes), dtype=np.int64) for t, nodes in unfinished.items() if nodes}
    needed = {t: tops[t] for t in ends}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        routers: dict[int, Router] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, code, y = _arrays(batch)
            routers = routers or {t: Router(tree, bins.shape[1]) for t, tree in needed.items()}
            for t, nodes in ends.items():
                node, w = routers[t].route(bins, code), draws(batch.column("id").to_numpy(), t)
                took = np.flatnonzero(np.isin(node, nodes) & (w > 0))
                yield pa.RecordBatch.from_pydict({
                    "tree": pa.array(np.full(len(took), t), pa.int32()), "node": pa.array(node[took], pa.int32()), "code": pa.array(code[took]),
                    "bins": batch.column("bins").take(pa.array(took)), "w": pa.array(w[took].astype(np.int64)), "y": pa.array(y[took])})

    return task


def forest_predictions(forest: Forest, rows: DataFrame, columns: Sequence[str], edges: Mapping[str, Sequence[float]], code: str, keys: Sequence[str],
                       label: str = "target") -> DataFrame:
    """Keys, label and what each tree says of every row; ``keys`` name a row.

    Rows that meet one subtree are dealt to several tasks if they are many.
    """
    of, tops, grid = _binned(edges, columns), forest.tops, forest.grid
    ends = {t: np.array(sorted(nodes), dtype=np.int64) for t, nodes in forest.unfinished.items()}
    width = len(columns)
    named = rows.select(F.struct(*keys, dbl(label).alias(label)).alias("row"), F.col(code).cast("long").alias("_code"), *[dbl(c).alias(c) for c in columns])
    row_type = named.schema["row"].dataType.simpleString()

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        routers: dict[int, Router] = {}
        for batch in batches:
            packed, code = of(batch), batch.column("_code").to_numpy()
            bins = np.frombuffer(b"".join(packed), dtype=np.uint8).reshape(-1, width)
            routers = routers or {t: Router(tree, width) for t, tree in tops.items()}
            for t, tree in tops.items():
                node = routers[t].route(bins, code)
                done = ~np.isin(node, ends[t])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), pa.array(np.full(len(node), t), pa.int32()), pa.array(node, pa.int32()), pa.array(code), pa.array(packed, pa.binary()),
                     pa.array(np.asarray(tree.value)[node] / grid, mask=~done)],
                    names=["row", "tree", "node", "code", "bins", "value"])

    routed = stage(named.mapInArrow(route, f"row {row_type}, tree int, node int, code long, bins binary, value double"), "routed")
    group = ["tree", "node", "salt"]
    open_rows = routed.where(F.col("value").isNull())
    blocks = open_rows.groupBy("tree", "node").agg(F.ceil(F.count(F.lit(1)) / SALTED).alias("blocks"))
    blocks = stage(blocks, "blocks")
    dealt = open_rows.join(blocks, ["tree", "node"]).withColumn("salt", F.pmod(F.xxhash64("row"), "blocks")).drop("blocks")
    salts = blocks.select("tree", "node", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("salt"))
    copies = forest.subtrees.join(salts, ["tree", "node"])

    def walk(part: pa.Table, below: pa.Table) -> pa.Table:
        # every unfinished leaf has training rows, so it has a subtree
        part = part if below.num_rows else part.slice(0, 0)
        value = np.zeros(0)
        if part.num_rows:
            tree = Tree(*[below.column(c)[0].as_py() for c in _TREE])
            value = np.asarray(tree.value)[tree.route(_matrix(part.column("bins")), part.column("code").to_numpy())] / grid
        return pa.table([part.column("row"), part.column("tree"), pa.array(value)], names=["row", "tree", "value"])

    walked = dealt.groupBy(*group).cogroup(copies.groupBy(*group)).applyInArrow(walk, f"row {row_type}, tree int, value double")
    return walked.unionByName(routed.where(F.col("value").isNotNull()).select("row", "tree", "value")).select("row.*", "tree", "value")


# --- boosting ----------------------------------------------------------------------


@dataclass
class Boosted:
    """A constant and one small tree per round, in label steps."""

    start: float
    rate: float
    trees: list[Tree]
    grid: int


def grow_boosted(rows: DataFrame, width: int, rounds: int = 100, leaves: int = 31, rate: float = 0.1, least: int = 20, refresh: int = 10,
                 grid: int = GRID) -> Boosted:
    """Each round grows a tree of at most ``leaves`` leaves on what is left of the labels, always at the leaf with the greatest gain.

    Which leaf that is follows from histograms, so those of all leaves that may
    come next are asked for in one pass. ``refresh`` rounds are kept in the
    tasks before the scores of the rows are written. A product can split only if
    ``least`` rows have it; if none has as many, products are not counted.
    """
    products = bool(rows.groupBy("code").count().where(F.col("count") >= least).take(1))
    n, s = _totals(rows, [0], lambda b, _: (np.ones(b.num_rows, dtype=np.int64), b.column("y").to_numpy()))[0]
    if not n:
        raise ValueError("boosting needs training rows")
    model = Boosted(s / n, rate, [], grid)
    scored, pending = stage(rows.withColumn("score", F.lit(model.start)), "scores"), []
    for done in range(1, rounds + 1):
        residual = _residual(pending, rate)
        tree = _leaf_wise(scored, width, leaves, least, residual, products)
        if tree is None:
            break
        model.trees.append(tree)
        pending.append(tree)
        if done % refresh == 0 and done < rounds:
            before, scored, pending = scored, stage(scored.mapInArrow(_rescored(pending, rate), scored.schema), "scores"), []
            release(before)
    release(scored)
    return model


def _added(pending: Sequence[Tree], rate: float, batch: pa.RecordBatch) -> np.ndarray:
    bins, code, _ = _arrays(batch)
    score = batch.column("score").to_numpy().copy()
    for tree in pending:
        score += rate * np.asarray(tree.value)[tree.route(bins, code)]
    return score


def _residual(pending: Sequence[Tree], rate: float) -> Seen:
    pending = list(pending)
    return lambda batch, _: (np.ones(batch.num_rows, dtype=np.int64), np.rint(batch.column("y").to_numpy() - _added(pending, rate, batch)).astype(np.int64))


def _rescored(pending: Sequence[Tree], rate: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    pending = list(pending)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = _added(pending, rate, batch)
            yield batch.set_column(batch.schema.get_field_index("score"), "score", pa.array(score))

    return task


def _leaf_wise(rows: DataFrame, width: int, leaves: int, least: int, seen: Seen, products: bool) -> Tree | None:
    """One tree; None if not even its root can be split."""
    asked, known = Tree(), {}
    asked.add(0.0)
    sizes = {0: _totals(rows, [0], seen)[0]} if products else {}
    needed = [0]
    while needed:
        totals = [sizes[k] for k in needed] if products else None
        for node, (n, s, found) in zip(needed, _splits(rows, {0: asked}, [(0, node) for node in needed], totals, width, seen, least), strict=True):
            known[node], asked.value[node] = found, s / n
            if found:
                left, right = asked.split(node, found)
                sizes[left], sizes[right] = (found.n, found.s), (found.n_right, found.s_right)
        chosen, needed = _greedy(asked, known, leaves)
    return _kept(asked, chosen) if chosen else None


def _greedy(asked: Tree, known: Mapping[int, Split | None], leaves: int) -> tuple[list[int], list[int]]:
    """The nodes split first by gain, and those whose gain must be known before that is certain."""
    chosen, missing, edge = [], [], [0]
    while edge and len(chosen) < leaves - 1:
        missing += [k for k in edge if k not in known]
        edge = [k for k in edge if known.get(k)]
        if not edge:
            break
        best = max(edge, key=lambda k: known[k].gain)
        chosen.append(best)
        edge.remove(best)
        edge += [asked.left[best], asked.right[best]]
    return chosen, missing


def _kept(asked: Tree, chosen: Sequence[int]) -> Tree:
    """``asked`` with the ``chosen`` splits alone."""
    out, inside = Tree(), set(chosen)
    todo = [(0, out.add(asked.value[0]))]
    while todo:
        old, new = todo.pop()
        if old in inside:
            out.feature[new], out.cut[new] = asked.feature[old], asked.cut[old]
            out.left[new], out.right[new] = out.add(asked.value[asked.left[old]]), out.add(asked.value[asked.right[old]])
            todo += [(asked.left[old], out.left[new]), (asked.right[old], out.right[new])]
    return out


def boosted_predictions(model: Boosted, rows: DataFrame, columns: Sequence[str], edges: Mapping[str, Sequence[float]], code: str, keys: Sequence[str],
                        label: str = "target") -> DataFrame:
    """Keys, label and ``Predicted`` of every row."""
    of = _binned(edges, columns)
    named = rows.select(*keys, dbl(label).alias(label), F.col(code).cast("long").alias("_code"), *[dbl(c).alias(f"_x{k}") for k, c in enumerate(columns)])
    out = named.select(*keys, label).schema.add("Predicted", "double")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = pa.RecordBatch.from_arrays([batch.column(f"_x{k}") for k in range(len(columns))], names=list(columns))
            bins = np.frombuffer(b"".join(of(seen)), dtype=np.uint8).reshape(batch.num_rows, -1)
            code, score = batch.column("_code").to_numpy(), np.full(batch.num_rows, model.start)
            for tree in model.trees:
                score += model.rate * np.asarray(tree.value)[tree.route(bins, code)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in [*keys, label]], pa.array(score / model.grid)], names=out.names)

    return named.mapInArrow(task, out)
