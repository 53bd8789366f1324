"""Similarity join of word-shingle sets by chosen paths.

Every run puts all sets into one bucket and splits buckets recursively: a
bucket samples one or two positions of the sets' MinHash tokens (1 / threshold
on average) and sends each set to the child named by its token there, so sets
part unless they share a sampled token. Buckets that got small are compared by
brute force; one that its split leaves nearly whole is split no further and
compared around a pivot. Runs repeat until a pair at the threshold is met with
the target recall.

Equal word sequences are one set. A comparison of sketches hands on a forest of
edges, never all pairs; the sets of each connected group are then compared
exactly, block against block, and links are counted where they are found.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import with_position
from ..functions.staging import stage
from .components import components
from .words import Hasher, free_names, groups, mixed, portions, remembered, split_words, tidy

TOKENS = 128
BUCKET = 64
DEPTH = 4
WHOLE = 0.75
ALL = 1 << 62  # size of the bucket that holds everything
COMPARED = 1024
BLOCK = 512
BLOCK_SHINGLES = 1 << 21
_SECOND = 0.25  # a bucket samples a second position this often: 1.25 = 1 / 0.8 on average


def minhash(shingles: np.ndarray, tokens: int = TOKENS) -> np.ndarray:
    """Smallest 32-bit hash of the set under each of ``tokens`` multipliers."""
    odd = mixed(np.arange(1, tokens + 1, dtype=np.uint64)) | np.uint64(1)
    out = np.full(tokens, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(shingles), 1024):
        high = ((shingles[k : k + 1024, None] * odd) >> np.uint64(32)).astype(np.uint32)
        np.minimum(out, high.min(axis=0), out=out)
    return out


def runs_for(threshold: float, recall: float, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold has met in some leaf of ``depth`` splits with probability ``recall``."""
    met = 1.0
    for _ in range(depth):  # a pair goes on together through one or two sampled positions
        one = threshold * met
        met = (1 - _SECOND) * one + _SECOND * (1 - (1 - one) ** 2)
    return math.ceil(math.log(1 - recall) / math.log(1 - met))


def children(paths: np.ndarray, sketches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Child buckets of rows in buckets ``paths``: row numbers and child names (64-bit)."""
    n, tokens = sketches.shape
    p = paths.astype(np.uint64)
    rows, names = [], []
    first = mixed(p ^ np.uint64(0xA5A5A5A5)) % np.uint64(tokens)
    again = mixed(p ^ np.uint64(0x5A5A5A5A)) < np.uint64(int(_SECOND * 2**64))
    second = (first + np.uint64(1) + mixed(p ^ np.uint64(0x33CC33CC)) % np.uint64(tokens - 1)) % np.uint64(tokens)
    for at, chosen in ((first, np.ones(n, bool)), (second, again)):
        who = np.flatnonzero(chosen)
        token = sketches[who, at[who].astype(np.int64)].astype(np.uint64) | (at[who] << np.uint64(32))
        rows.append(who)
        names.append(mixed(mixed(token) ^ (p[who] * np.uint64(0x9E3779B97F4A7C15))))
    return np.concatenate(rows), np.concatenate(names)


def _signatures(df: DataFrame, shingle: int) -> DataFrame:
    """doc_id, text_hash, key (128 bits of the word sequence, NULL without words), shingles (distinct), sketch."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("key", pa.binary()), ("shingles", pa.int64()), ("sketch", pa.binary())])

    @tidy
    def sign(batches):
        hasher = remembered("hashes", Hasher)
        for batch in batches:
            for part in portions(batch, 2):
                out = []
                listed = [split_words(t) for t in part.column(2).to_pylist()]
                for words, s in zip(listed, hasher.shingles_of(listed, shingle), strict=True):
                    s = np.unique(s)
                    out.append((_key(words), len(s), minhash(s).tobytes()) if words else (None, 0, b""))
                found = [pa.array([r[k] for r in out], f.type) for k, f in enumerate(list(schema)[2:])]
                yield pa.RecordBatch.from_arrays([*part.columns[:2], *found], schema=schema)

    return df.mapInArrow(sign, "doc_id long, text_hash long, key binary, shingles long, sketch binary")


def _key(words: list[str]) -> bytes:
    return xxhash.xxh3_128_digest("\n".join(words))


def _split(rows: DataFrame, roots: list[int] | None) -> DataFrame:
    """path, node, before (size of the bucket that was split) of the children.

    rows: path, n, node, sketch, or node, sketch where ``roots`` are the buckets.
    """
    schema = pa.schema([("path", pa.int64()), ("node", pa.int64()), ("before", pa.int64())])

    @tidy
    def split(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sketches = np.frombuffer(b"".join(batch.column(batch.num_columns - 1).to_pylist()), np.uint32).reshape(batch.num_rows, -1)
            nodes = batch.column(batch.num_columns - 2).to_numpy(zero_copy_only=False)
            size = np.full(batch.num_rows, ALL) if roots else batch.column(1).to_numpy()
            starts = [np.full(batch.num_rows, r, np.uint64) for r in roots] if roots else [batch.column(0).to_numpy().view(np.uint64)]
            for start in starts:
                who, names = children(start, sketches)
                yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(nodes[who]), pa.array(size[who])], schema=schema)

    return rows.mapInArrow(split, "path long, node long, before long")


def _crowded(paths: DataFrame) -> DataFrame:
    """Rows of buckets of two or more, with the bucket's size."""
    sizes = paths.groupBy("path").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # both sides of the join are then plain shuffles, which split a hot bucket
    return paths.join(stage(sizes, "bucket_sizes"), "path")


def _block(key: str, blocks) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(5)), blocks).cast("int")


def _each(blocks) -> Column:
    return F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int")))


def _in_blocks(rows: DataFrame, key: str, blocks) -> DataFrame:
    """Each row once for every pair of blocks it takes part in: adds ``lo``, ``hi``, ``own``."""
    rows = rows.withColumn("_n", blocks).withColumn("own", _block("node", F.col("_n")))
    rows = rows.withColumn("_other", _each(F.col("_n")))
    return rows.withColumn("lo", F.least("own", "_other")).withColumn("hi", F.greatest("own", "_other")).drop("_n", "_other")


def _forest(close: np.ndarray, ids: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what ``close`` (a symmetric matrix) connects: each row of a group with the group's smallest id.

    A group that is met again, in another leaf or run, gives the same edges.
    """
    todo, edges = np.ones(len(ids), bool), []
    for start in range(len(ids)):
        if not todo[start]:
            continue
        todo[start], stack, group = False, [start], [start]
        while stack:
            new = np.flatnonzero(close[stack.pop()] & todo)
            todo[new] = False
            stack.extend(new.tolist())
            group.extend(new.tolist())
        members = ids[group]
        root = int(members.min())
        edges += [(root, int(i)) for i in members if i != root]
    return edges


def _agreement(sketches: np.ndarray, one: np.ndarray) -> np.ndarray:
    return (sketches == one).mean(axis=1)


def _bytes_of(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.uint8).reshape(table.num_rows, -1)


def _close(left: np.ndarray, right: np.ndarray, left_size: np.ndarray, right_size: np.ndarray, threshold: float, least: float) -> np.ndarray:
    """Which sketches agree in a share ``least`` of positions; sizes, which are exact, alone can rule a pair out."""
    close = np.array([_agreement(right, one) >= least for one in left]).reshape(len(left), len(right))
    return close & (np.minimum.outer(left_size, right_size) >= threshold * np.maximum.outer(left_size, right_size) - 1e-9)


def _edges_schema(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"a": [e[0] for e in edges], "b": [e[1] for e in edges]})


def _candidates(leaves: DataFrame, threshold: float, least: float) -> DataFrame:
    """Forest edges of the sketches that agree in a share ``least`` of positions, per leaf; leaves: path, node, n, shingles, bytes."""
    @tidy
    def compare(batches):
        for table in groups(batches, 1):
            nodes, size, small = table.column("node").to_numpy(), table.column("shingles").to_numpy(), _bytes_of(table)
            edges = _forest(_close(small, small, size, size, threshold, least), nodes)
            if edges:
                yield _edges_schema(edges)

    rows = leaves.filter(F.col("n") <= COMPARED).select("path", "node", "shingles", "bytes")
    small = rows.repartition("path").sortWithinPartitions("path").mapInArrow(compare, "a long, b long")
    large = leaves.filter(F.col("n") > COMPARED)
    return small if large.isEmpty() else small.unionByName(_around_pivots(stage(large, "whole_buckets"), threshold, least))


def _around_pivots(leaves: DataFrame, threshold: float, least: float) -> DataFrame:
    """Forest edges of leaves that no split makes smaller, as :func:`_candidates` gives them for small ones.

    All rows are compared with a pivot of their leaf, block by block. Those close
    to it hang on it and need not be compared with each other. Sketches differ by
    a metric (the share of positions), so a row far from the pivot is compared
    only with rows that are at most one distance nearer to it.
    """
    pivots = stage(leaves.groupBy("path").agg(F.min("node").alias("pivot"), F.max("n").alias("many")), "pivots")
    named = leaves.join(pivots, "path").withColumn("blocks", F.ceil(F.col("many") / COMPARED))
    lead = named.filter("node = pivot").withColumn("block", _each(F.col("blocks"))).withColumn("role", F.lit(0))
    rest = named.withColumn("block", _block("node", F.col("blocks"))).withColumn("role", F.lit(1))
    columns = ["path", "block", "role", "node", "pivot", "shingles", "bytes"]

    @tidy
    def measure(batches):
        for table in groups(batches, 2):
            small = _bytes_of(table)
            near = _agreement(small, small[0])
            yield from table.slice(1).append_column("near", pa.array(near[1:])).drop_columns(["block", "role"]).combine_chunks().to_batches()

    measured = stage(lead.select(*columns).unionByName(rest.select(*columns)).repartition("path", "block").sortWithinPartitions("path", "block", "role")
                     .mapInArrow(measure, "path long, node long, pivot long, shingles long, bytes binary, near double"), "measured")
    star = measured.filter((F.col("near") >= least) & (F.col("node") != F.col("pivot"))).select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    far = measured.filter(F.col("near") < least)
    reach = stage(far.groupBy("path").agg(F.max("near").alias("most"), F.count(F.lit(1)).alias("left")), "far")
    ring = measured.join(reach, "path").filter(F.col("near") <= F.col("most") + (1 - least) + 1e-9)
    sides = stage(ring.groupBy("path").agg(F.count(F.lit(1)).alias("right")), "ring")
    ring = ring.join(sides, "path").withColumn("lefts", F.ceil(F.col("left") / COMPARED)).withColumn("rights", F.ceil(F.col("right") / COMPARED))
    left = ring.filter(F.col("near") < least).withColumn("lo", _block("node", F.col("lefts"))).withColumn("hi", _each(F.col("rights"))).withColumn("role", F.lit(0))
    right = ring.withColumn("hi", _block("node", F.col("rights"))).withColumn("lo", _each(F.col("lefts"))).withColumn("role", F.lit(1))
    columns = ["path", "lo", "hi", "role", "node", "shingles", "bytes"]

    @tidy
    def compare(batches):
        for table in groups(batches, 3):
            split = int((table.column("role").to_numpy() == 0).sum())
            if not 0 < split < table.num_rows:
                continue
            nodes, size, small = table.column("node").to_numpy(), table.column("shingles").to_numpy(), _bytes_of(table)
            close = np.zeros((len(nodes), len(nodes)), bool)
            close[:split, split:] = _close(small[:split], small[split:], size[:split], size[split:], threshold, least)
            edges = _forest(close | close.T, nodes)
            if edges:
                yield _edges_schema(edges)

    compared = left.select(*columns).unionByName(right.select(*columns)).repartition("path", "lo", "hi").sortWithinPartitions(
        "path", "lo", "hi", "role").mapInArrow(compare, "a long, b long")
    return star.unionByName(compared)


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of sets of distinct numbers, in bounded memory."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(times > 1) - 1
    use = times[column] > 1
    owner, column = owner[use], shared[column[use]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((n, n), np.float64)
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        lo, hi = np.searchsorted(column, [a, a + 4096])
        has = np.zeros((n, min(4096, int(column[-1]) + 1 - a)), np.float32)
        has[owner[lo:hi], column[lo:hi] - a] = 1
        out += has @ has.T
    return out


def _verified(members: DataFrame, texts: DataFrame, shingle: int, threshold: float, block: int, block_shingles: int) -> DataFrame:
    """Exact links inside groups: rows (node, linked, other); ``linked`` counts documents, ``other`` is a forest edge or NULL."""
    sizes = members.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum("shingles").alias("total"))
    blocks = F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("total") / block_shingles))
    wanted = members.join(sizes, "root").select(
        "root", blocks.alias("blocks"), "docs", "node", "key", F.col("rep_id").alias("_id"), F.col("text_hash").alias("_hash"))
    # by merging at every size: a small side that is broadcast would only hide what the join costs
    rows = wanted.hint("merge").join(texts, (F.col("_hash") == F.col("text_hash")) & F.col("_id").eqNullSafe(F.col("doc_id")))
    rows = rows.select("root", "blocks", "docs", "node", "key", "text")
    schema = pa.schema([("root", pa.int64()), ("blocks", pa.int64()), ("docs", pa.int64()), ("node", pa.int64()), ("set", pa.binary())])

    @tidy
    def shingled(batches):
        hasher = remembered("hashes", Hasher)
        for batch in batches:
            for part in portions(batch, 5):
                listed = [split_words(t) for t in part.column(5).to_pylist()]
                own = pa.array([_key(words) == key for words, key in zip(listed, part.column(4).to_pylist(), strict=True)])
                sets = [np.unique(s).tobytes() for s in hasher.shingles_of(listed, shingle)]
                yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(sets, pa.binary())], schema=schema).filter(own)

    @tidy
    def compare(batches):
        for table in groups(batches, 3):
            # a row that stands twice in the table is one
            nodes, first = np.unique(table.column("node").to_numpy(), return_index=True)
            own, docs = (table.column(c).to_numpy()[first] for c in ("own", "docs"))
            lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
            if len(nodes) < 2:
                continue
            sets = [np.frombuffer(s, np.uint64) for s in table.column("set").take(pa.array(first)).to_pylist()]
            both = overlaps(sets)
            size = np.array([len(s) for s in sets], np.float64)
            # |A & B| >= t |A | B| without dividing
            linked = both >= threshold * (size[:, None] + size[None, :] - both) - 1e-9
            np.fill_diagonal(linked, False)
            if lo != hi:  # pairs inside a block are counted where it meets itself
                linked &= own[:, None] != own[None, :]
            count = linked @ docs
            edges = _forest(linked, nodes)
            if count.any():
                at = np.flatnonzero(count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([nodes[at], [e[0] for e in edges]]).astype(np.int64)),
                     pa.array(np.concatenate([count[at], np.zeros(len(edges))]).astype(np.int64)),
                     pa.array([None] * len(at) + [e[1] for e in edges], pa.int64())], names=["node", "linked", "other"])

    sets = rows.mapInArrow(shingled, "root long, blocks long, docs long, node long, set binary")
    paired = _in_blocks(sets, "root", F.col("blocks")).select("root", "lo", "hi", "own", "docs", "node", "set")
    return paired.repartition("root", "lo", "hi").sortWithinPartitions("root", "lo", "hi").mapInArrow(
        compare, "node long, linked long, other long")


def _leaves(sketches: DataFrame, roots: list[int], bucket: int, depth: int) -> DataFrame:
    """path, node, n of all buckets that are small, that their split left (nearly) whole, or that are ``depth`` splits down."""
    leaves = []
    open_rows = _split(sketches, roots)
    for level in range(1, depth + 1):
        found = stage(_crowded(open_rows), "buckets")
        done = (F.col("n") <= bucket) | (F.col("n") >= WHOLE * F.col("before"))
        leaves.append((found if level == depth else found.filter(done)).select("path", "node", "n"))
        if level == depth or found.filter(~done).isEmpty():
            break
        again = found.filter(~done).select("path", "n", "node")
        open_rows = _split(again.join(sketches, "node").select("path", "n", "node", "sketch"), None)
    return reduce(DataFrame.unionByName, leaves)


def _rows(df: DataFrame, id_col: str, text_col: str, shingle: int, threshold: float, recall: float, bucket: int, depth: int) -> DataFrame:
    """The rows of :func:`jaccard_join`, with ``text_hash`` and whether the row is the one that ``stays`` of its class."""
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.select("doc_id", text_hash("text").alias("text_hash"), "text")
    signed = stage(_signatures(docs, shingle), "signatures")
    worded = signed.filter("key IS NOT NULL")
    classes = worded.groupBy("key").agg(F.min("doc_id").alias("rep_id"), F.count(F.lit(1)).alias("docs"))
    # every set of words is a node; the order of nodes is that of their smallest ids
    classes = stage(with_position(classes, F.asc_nulls_last("rep_id"), "key", name="node"), "classes")
    chosen = worded.join(classes.withColumnRenamed("key", "k"), (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("rep_id")))
    reps = stage(chosen.select("node", "key", "rep_id", "text_hash", "shingles", "docs", "sketch").dropDuplicates(["node"]), "representatives")

    roots = [int(x) for x in mixed(np.arange(101, 101 + runs_for(threshold, recall, depth), dtype=np.uint64))]
    met = _leaves(reps.select("node", "sketch"), roots, bucket, depth)
    low_bytes = F.regexp_replace(F.hex("sketch"), "(..)......", "$1")
    met = met.join(reps.select("node", "shingles", F.unhex(low_bytes).alias("bytes")), "node")
    # four standard deviations below the expected agreement at the threshold
    least = threshold - 4 * math.sqrt(threshold * (1 - threshold) / TOKENS)
    near = components(_candidates(met, threshold, least))
    members = stage(near.join(reps.drop("sketch"), "node"), "members")
    links = stage(_verified(members, docs, shingle, threshold, BLOCK, BLOCK_SHINGLES), "links")
    linked = links.groupBy("node").agg(F.sum("linked").alias("linked"))
    joined = components(links.filter("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")))

    by_node = reps.drop("sketch", "shingles").join(linked, "node", "left").join(joined, "node", "left")
    by_node = stage(by_node.select("key", "node", "rep_id", F.col("text_hash").alias("rep_hash"), "docs", F.coalesce("root", "node").alias("root"),
                                   (F.col("docs") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")), "nodes")
    total = by_node.groupBy("root").agg(F.sum("docs").alias("class_size"))
    named = total.join(by_node.select(F.col("node").alias("root"), F.col("rep_id").alias("class_id")), "root")
    by_key = by_node.join(named, "root").withColumn("first", F.col("node") == F.col("root"))
    by_key = stage(by_key.select("key", "rep_id", "rep_hash", "class_id", "class_size", "n_links", "first"), "class_rows")
    stays = F.col("first") & F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("text_hash") == F.col("rep_hash"))
    columns = ["doc_id", "text_hash", "rep_id", "class_id", "class_size", "n_links"]
    found = worded.select("doc_id", "text_hash", "key").join(by_key, "key").select(*columns, stays.alias("stays"))
    alone = signed.filter("key IS NULL").select(
        "doc_id", "text_hash", F.col("doc_id").alias("rep_id"), F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"),
        F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("stays"))
    return found.unionByName(alone)


def text_hash(text: Column | str) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def jaccard_join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, threshold: float = 0.8,
                 recall: float = 0.999, bucket: int = BUCKET, depth: int = DEPTH) -> DataFrame:
    """One row per row: doc_id, rep_id, class_id, class_size, n_links.

    ``rep_id`` is the smallest id with the same words; ``n_links`` the number of
    other documents whose sets of ``shingle``-word shingles have a Jaccard
    similarity of ``threshold`` or more (0.8 or more), copies included;
    ``class_id`` the smallest id that links reach, ``class_size`` its documents.
    Words are lower-case runs of letters and digits (white-space tokens where
    there are none). Fewer than ``shingle`` words are one shingle. A text without
    words, NULL included, is alone. Every row is a document: rows that repeat an
    id are told apart by their words, and rows without an id are linked like any
    other (``rep_id`` and ``class_id`` are NULL where no row that they could name
    has an id). Linked pairs are found with probability ``recall`` or more each,
    and every link given is exact.
    """
    return _rows(df, id_col, text_col, shingle, threshold, recall, bucket, depth).drop("text_hash", "stays")


def without_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, threshold: float = 0.8,
                            recall: float = 0.999, bucket: int = BUCKET, depth: int = DEPTH) -> DataFrame:
    """Rows and columns of ``df`` of which one row of each class of :func:`jaccard_join` stays, one with its smallest id.

    Of rows that repeat that id and its text, any one stays; texts without words all stay.
    """
    rows = stage(_rows(df, id_col, text_col, shingle, threshold, recall, bucket, depth).select("doc_id", "text_hash", "stays", "class_size"), "near_rows")
    own_id, own_hash, mine = free_names(df, 3)
    names = [F.col("doc_id").alias(own_id), F.col("text_hash").alias(own_hash)]
    same = F.col(id_col).cast("long").eqNullSafe(F.col(own_id)) & (F.col(mine) == F.col(own_hash))
    kept = df.withColumn(mine, text_hash(F.col(text_col).cast("string")))
    kept = kept.join(rows.filter("NOT stays").select(*names).distinct(), same, "left_anti")
    again = rows.filter("stays AND class_size > 1").groupBy("doc_id", "text_hash").count().filter("count > 1").select(*names)
    if not again.isEmpty():
        again = stage(again, "repeated_rows")
        once = kept.join(again, same, "left_semi").dropDuplicates([id_col, mine])
        kept = kept.join(again, same, "left_anti").unionByName(once)
    return kept.drop(mine)
