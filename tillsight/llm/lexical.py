"""Ranked lexical search by exact inner products over sparse ball trees.

A document is the sparse vector of its saturated term frequencies, an item the
vector of its term weights; the score is their inner product, in integers. Every
block of documents is a ball tree: a node has a centre (the rounded mean) and a
radius, exact from the centre as it was rounded, and the radius along each column
(how far its documents reach above the centre there). An item visits nodes
best-first by the bound ``item . centre + |item| * radius``, or the lesser one of
the column radii, rounded up by more than doubles can be off, and leaves alone
what cannot reach the item's best documents so far. Leaves are scored exactly.

Items are searched in blocks of a bounded number of terms; such a block is all
that is sent to the tasks. Documents keep only the terms of the block, so a
block's terms are also the columns of the vectors.
"""

from __future__ import annotations

import heapq
import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import with_running_totals
from ..functions.staging import stage
from .words import portions, tidy

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK_TERMS = 1 << 16
BLOCK_CELLS = 1 << 22
ROWS = 4096
LEAF = 16
_NO_ID = -(1 << 63)
# what is neither a letter, a digit nor beyond ASCII becomes a blank; A-Z becomes a-z
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """Terms of a whole text, in UTF-8; none for NULL."""
    return (text or "").encode("utf-8", "replace").translate(_FOLD).split()


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def saturated(tf: np.ndarray, length: np.ndarray, n: int, total: int) -> np.ndarray:
    """Integer term scores of documents of ``length`` terms."""
    m = 100 - 25 + (25 * length * n) // total
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class BallTree:
    """Ball tree over sparse integer vectors: rows ``ids``, row starts, columns (ascending numbers below ``width``) and values."""

    def __init__(self, starts: np.ndarray, cols: np.ndarray, vals: np.ndarray, width: int, leaf: int = LEAF):
        self.squares = np.add.reduceat(vals * vals, starts[:-1])
        self.starts, self.cols, self.vals, self.width, self.leaf = starts, cols, vals, width, leaf
        self.first: list[int] = []
        self.last: list[int] = []
        self.children: list[tuple[int, int] | None] = []
        centers: list[np.ndarray] = []
        above: list[np.ndarray] = []
        radii: list[float] = []
        order: list[np.ndarray] = []
        placed = 0
        todo = [(np.arange(len(starts) - 1), None)]  # depth first, so that a node's rows lie together
        while todo:
            rows, slot = todo.pop()
            node = len(self.first)
            if slot is not None:
                parent, side = slot
                pair = self.children[parent] or (node, node)
                self.children[parent] = (node, pair[1]) if side == 0 else (pair[0], node)
            at, part = self._part(rows)
            c, v = cols[at], vals[at]
            center = np.floor_divide(np.bincount(c, weights=v, minlength=width).astype(np.int64), len(rows))
            away = self.squares[rows] - 2 * np.add.reduceat(v * center[c], part) + int(center @ center)
            centers.append(center.astype(np.float64))
            top = np.zeros(width, np.int64)
            np.maximum.at(top, c, v)
            above.append((top - center).astype(np.float64))
            radii.append(float(away.max()))
            self.first.append(placed)
            self.children.append(None)
            if len(rows) <= leaf or away.max() == 0:
                order.append(rows)
                placed += len(rows)
                self.last.append(placed)
                continue
            self.last.append(placed + len(rows))
            one = self._dense(rows[int(np.argmax(away))])
            far = self.squares[rows] - 2 * np.add.reduceat(v * one[c], part)
            two = self._dense(rows[int(np.argmax(far))])
            side = np.argsort(np.add.reduceat(v * (one - two)[c], part), kind="stable")
            half = len(rows) // 2
            todo += [(rows[side[half:]], (node, 1)), (rows[side[:half]], (node, 0))]
        self.order = np.concatenate(order)
        at, part = self._part(self.order)
        self.leaf_cols, self.leaf_vals, self.leaf_starts = cols[at], vals[at], np.append(part, len(at))
        self.centers, self.above, self.radius = np.array(centers), np.array(above), np.sqrt(np.array(radii))

    def _part(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the rows' entries, and where each row begins among them."""
        begin, size = self.starts[rows], self.starts[rows + 1] - self.starts[rows]
        part = np.cumsum(size) - size
        return np.repeat(begin - part, size) + np.arange(int(size.sum())), part

    def _dense(self, row: int) -> np.ndarray:
        out = np.zeros(self.width, np.int64)
        a, b = self.starts[row], self.starts[row + 1]
        out[self.cols[a:b]] = self.vals[a:b]
        return out

    def bounds(self, cols: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """No document of a node scores more; the margin exceeds the rounding of the products and of the root.

        Weights are not negative, so of the radius only what reaches above the centre counts: that of the ball, or, where
        it is less, those along the item's own columns.
        """
        w = weights.astype(np.float64)
        reach = self.centers[:, cols] @ w + np.minimum(math.sqrt(float(w @ w)) * self.radius, self.above[:, cols] @ w)
        return reach * (1 + 1e-9) + 1

    def search(self, cols: np.ndarray, weights: np.ndarray, keys: np.ndarray, best: list[tuple[int, int]], k: int) -> int:
        """Put the documents that are among the ``k`` best into the heap ``best`` of (score, -key); returns the leaves visited."""
        reach = self.bounds(cols, weights).tolist()
        dense = np.zeros(self.width, np.int64)
        dense[cols] = weights
        todo, visited = [(-reach[0], 0)], 0
        while todo:
            bound, node = heapq.heappop(todo)
            if len(best) == k and -bound < best[0][0]:
                break
            if self.children[node]:
                for child in self.children[node]:
                    heapq.heappush(todo, (max(bound, -reach[child]), child))
                continue
            visited += 1
            a, b = self.first[node], self.last[node]
            s, e = self.leaf_starts[a], self.leaf_starts[b]
            scores = np.add.reduceat(self.leaf_vals[s:e] * dense[self.leaf_cols[s:e]], self.leaf_starts[a:b] - s)
            least = best[0][0] if len(best) == k else 1
            for i in np.flatnonzero(scores >= max(least, 1)).tolist():
                entry = (int(scores[i]), -int(keys[self.order[a + i]]))
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return visited


def _columns(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, n, cols, tfs of every document with a term: its terms among ``vocabulary`` as packed 32-bit numbers."""
    shared = docs.sparkSession.sparkContext.broadcast({t: k for k, t in enumerate(vocabulary)})
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("cols", pa.binary()), ("tfs", pa.binary())])

    @tidy
    def count(batches):
        known = shared.value
        for batch in batches:
            for part in portions(batch):
                out = []
                for i, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    found = terms(text)
                    if found:
                        own = np.fromiter((known[t] for t in found if t in known), np.uint32)
                        cols, tfs = np.unique(own, return_counts=True)
                        out.append((i, len(found), cols.tobytes(), tfs.astype(np.uint32).tobytes()))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return docs.mapInArrow(count, "doc_id long, n long, cols binary, tfs binary")


def _frequencies(rows: DataFrame, many: int) -> tuple[int, int, np.ndarray]:
    """Documents, terms with repeats, and documents holding each term; a task hands on one row of sums."""
    def sums(batches):
        n, total, df = 0, 0, np.zeros(many, np.int64)
        for batch in batches:
            n += batch.num_rows
            total += int(batch.column(0).to_numpy().sum())
            df += np.bincount(np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32), minlength=many)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"col": pa.array([-2, -1, *at.tolist()], pa.int64()), "x": pa.array([n, total, *df[at].tolist()], pa.int64())})

    found = rows.select("n", "cols").mapInArrow(sums, "col long, x long").groupBy("col").agg(F.sum("x").alias("x")).collect()  # a row per term of the block
    by = {r["col"]: r["x"] for r in found}
    df = np.zeros(many, np.int64)
    for col, x in by.items():
        if col >= 0:
            df[col] = x
    return by.get(-2, 0), by.get(-1, 0), df


def _searched(rows: DataFrame, items: list[tuple[int, np.ndarray, np.ndarray]], n: int, total: int, k: int, leaf: int) -> DataFrame:
    """item, doc_id, score: the ``k`` best documents of each task for each item."""
    shared = rows.sparkSession.sparkContext.broadcast(items)  # at most BLOCK_TERMS terms, or one item
    schema = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    @tidy
    def search(batches):
        wanted = shared.value
        best: list[list[tuple[int, int]]] = [[] for _ in wanted]
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                _search_block(batch.slice(a, ROWS), wanted, best)
        out = [(item, None if -key == _NO_ID else -key, score) for (item, _, _), found in zip(wanted, best, strict=True) for score, key in found]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    def _search_block(block, wanted, best):
        sizes = np.array([len(c) // 4 for c in block.column("cols").to_pylist()])
        keep = np.flatnonzero(sizes)
        if not len(keep):
            return
        keys = np.array([_NO_ID if i is None else i for i in block.column("doc_id").to_pylist()], object)[keep]
        length = block.column("n").to_numpy()[keep]
        sizes = sizes[keep]
        cols = np.frombuffer(b"".join(block.column("cols").to_pylist()), np.uint32).astype(np.int64)
        tfs = np.frombuffer(b"".join(block.column("tfs").to_pylist()), np.uint32).astype(np.int64)
        vals = saturated(tfs, np.repeat(length, sizes), n, total)
        here, cols = np.unique(cols, return_inverse=True)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        step = max(2 * leaf, min(ROWS, BLOCK_CELLS * leaf // (4 * len(here))))  # centres of a tree fit into BLOCK_CELLS numbers
        for a in range(0, len(keep), step):
            b = min(a + step, len(keep))
            lo, hi = starts[a], starts[b]
            tree = BallTree(starts[a : b + 1] - lo, cols[lo:hi], vals[lo:hi], len(here), leaf)
            for (_, q, w), heap in zip(wanted, best, strict=True):
                at = np.searchsorted(here, q)
                has = (at < len(here)) & (here[np.minimum(at, len(here) - 1)] == q)
                if has.any():
                    tree.search(at[has], w[has], keys[a:b], heap, k)

    return rows.mapInArrow(search, "item long, doc_id long, score long")


def _item_blocks(items: DataFrame, block_terms: int) -> DataFrame:
    """item_id, number, terms, block of every item with a term; a block has at most ``block_terms`` terms, or one item."""
    found = F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(TERM), 0)).alias("term")
    counted = items.select("item_id", found).groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("times"))
    whole = counted.groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct("term", "times"))).alias("terms"))
    sized = whole.withColumn("size", F.size("terms").cast("long")).withColumn("one", F.lit(1).cast("long"))
    summed = with_running_totals(sized, ["item_id"], {"upto": "size", "number": "one"})
    # an item is of the block in which it ends
    return stage(summed.select("item_id", "number", "terms", F.expr(f"(upto - 1) div {block_terms}").alias("block")), "items")


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
           item_text_col: str = "text", block_terms: int = BLOCK_TERMS, leaf: int = LEAF) -> DataFrame:
    """The ``k`` documents with the highest score above 0 for each item: item_id, rank, doc_id, score.

    Terms are runs of letters, digits and characters beyond ASCII, with A-Z
    lower-cased; every term of every whole text counts. Equal scores go by
    ascending id, NULL first. A text without terms, NULL included, is no
    document, and such an item has no rows. Rows that repeat a document are
    documents of their own; rows that repeat an item id are one item with the
    terms of all. No documents or no items give no rows.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    blocks = _item_blocks(items.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text")), block_terms)
    found = []
    for block in sorted(r["block"] for r in blocks.select("block").distinct().collect()):  # a row per block_terms terms
        own = [(r["number"], [(t["term"].encode(), t["times"]) for t in r["terms"]]) for r in blocks.filter(F.col("block") == block).collect()]
        vocabulary = sorted({t for _, ts in own for t, _ in ts})
        place = {t: c for c, t in enumerate(vocabulary)}
        rows = stage(_columns(docs, vocabulary), "term_rows")
        n, total, df = _frequencies(rows, len(vocabulary))
        if not n:
            continue
        w = [weight(n, int(x)) for x in df]
        vectors = []
        for number, ts in own:
            pairs = sorted((place[t], times * w[place[t]]) for t, times in ts if df[place[t]])
            vectors.append((number, np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)))
        found.append(_searched(rows, vectors, n, total, k, leaf))
    if not found:
        return blocks.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    hits = reduce(DataFrame.unionByName, found)
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(blocks.select("item_id", "number"), F.col("item") == F.col("number")).select("item_id", "rank", "doc_id", "score")
