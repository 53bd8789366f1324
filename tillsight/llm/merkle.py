"""A Merkle manifest of a dataset, navigated by nested intervals.

Rows are leaves, ranked over the whole dataset by (group, id). Every node is
labelled with the interval of leaf ranks that it covers, so intervals nest: a
group's subroot covers the ranks of the group, the root covers all. Levels are
built bottom-up, 16 consecutive nodes at a time. Going down again, each node
meets its parent in a join by level and bucket with the test that the parent's
interval contains its own; its siblings are the children of that parent whose
intervals lie outside its own. The way up from a node is thus attached once per
node, and the leaves of one run share it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import with_position
from ..functions.staging import stage

FANOUT = 16
_PATH = "array<struct<before:string,after:string>>"


def field(col: Column | str) -> Column:
    """A value in the input of a leaf: ``-`` for NULL, else the UTF-8 byte count, ``:`` and the value as text."""
    text = (F.col(col) if isinstance(col, str) else col).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: Sequence[Column | str]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]).cast("binary"), 256)


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _joined(children: Column) -> Column:
    return F.array_join(F.transform(children, lambda c: _hex(c["digest"])), "")


@dataclass
class Manifest:
    """``leaves``: the rows with tree, at, count, lo, hi, digest; ``levels``: of the groups' trees, from the first above
    the leaves; ``tops``: the levels above the subroots, subroots first; ``root``: hex digest, None without rows."""

    leaves: DataFrame
    levels: list[DataFrame]
    tops: list[DataFrame]
    root: str | None

    def nodes(self) -> DataFrame:
        """All labels: part (``group`` or ``top``), level, lo, hi, digest (hex)."""
        found = [("group", k, t) for k, t in enumerate([self.leaves, *self.levels])] + [("top", k, t) for k, t in enumerate(self.tops)]
        return reduce(DataFrame.unionByName, [
            t.select(F.lit(part).alias("part"), F.lit(k).alias("level"), "lo", "hi", _hex(F.col("digest")).alias("digest")) for part, k, t in found])


def _above(nodes: DataFrame, fanout: int) -> DataFrame:
    """The next level: runs of ``fanout`` neighbours of one tree; at most so many rows meet per group."""
    child = F.struct("lo", "hi", "digest")
    found = nodes.filter("count > 1").groupBy("tree", F.expr(f"at div {fanout}").alias("at")).agg(
        F.first("count").alias("count"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sort_array(F.collect_list(child)).alias("children"))
    return found.select(
        "tree", "at", F.ceil(F.col("count") / fanout).cast("long").alias("count"), "lo", "hi",
        F.unhex(F.sha2(_joined(F.col("children")).cast("binary"), 256)).alias("digest"), "children")


def _grow(nodes: DataFrame, most: int, fanout: int, name: str) -> list[DataFrame]:
    """Levels above ``nodes`` until the largest tree, of ``most`` nodes, has one."""
    levels = []
    while most > 1:
        nodes = stage(_above(nodes, fanout), name)
        levels.append(nodes)
        most = -(-most // fanout)
    return levels


def build(df: DataFrame, group_col: str, order: Sequence[str], digest: str, keep: Sequence[str] = (), fanout: int = FANOUT) -> Manifest:
    """The manifest of ``df``: leaves with the hex digests in ``digest``, in the ``order`` of columns inside each group.

    Groups go by name, NULL first; NULLs come first in the order of leaves as
    well, and equal rows are ordered by their digests, so that the result does
    not depend on how rows lie. Leaves keep the columns ``keep``.
    """
    rows = df.select(F.col(group_col).alias("_group"), *[F.col(c).alias(f"_by{k}") for k, c in enumerate(order)],
                     F.unhex(F.col(digest)).alias("digest"), *keep)
    ranked = with_position(rows, "_group", *[f"_by{k}" for k in range(len(order))], "digest", name="lo")
    sizes = ranked.groupBy("_group").agg(F.min("lo").alias("tree"), F.count(F.lit(1)).alias("count"))
    trees = stage(with_position(sizes, "tree", name="number"), "trees").withColumnRenamed("_group", "_tree")
    leaves = ranked.join(trees, F.col("_group").eqNullSafe(F.col("_tree"))).select(
        "tree", (F.col("lo") - F.col("tree")).alias("at"), "count", "lo", (F.col("lo") + 1).alias("hi"), "digest", *keep)
    leaves = stage(leaves, "leaves")
    many = trees.agg(F.max("count"), F.count(F.lit(1))).first()
    levels = _grow(leaves.drop(*keep), many[0] or 0, fanout, "group_level")
    label = ["tree", "lo", "hi", "digest"]
    done = reduce(DataFrame.unionByName, [t.filter("count = 1").select(*label) for t in [leaves, *levels]])
    subroots = done.join(trees.select("tree", "number"), "tree").select(
        F.lit(0).cast("long").alias("tree"), F.col("number").alias("at"), F.lit(many[1]).alias("count"), "lo", "hi", "digest")
    subroots = stage(subroots, "subroots")
    tops = [subroots, *_grow(subroots, many[1], fanout, "top_level")]
    root = tops[-1].select(_hex(F.col("digest"))).first()
    return Manifest(leaves, levels, tops, root[0] if root else None)


def _outside(children: Column, lo: Column, hi: Column) -> Column:
    """What the parent's interval has besides [lo, hi): digests of the children before it and after it."""
    return F.struct(_joined(F.filter(children, lambda c: c["hi"] <= lo)).alias("before"),
                    _joined(F.filter(children, lambda c: c["lo"] >= hi)).alias("after"))


def _attached(nodes: DataFrame, parents: DataFrame, fanout: int, keep: Sequence[str]) -> DataFrame:
    """``nodes`` with their ``path``: siblings beside them, then what their parent has; both of one tree and one level apart."""
    up = parents.select(F.col("tree").alias("_tree"), F.col("at").alias("_at"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"),
                        F.col("children").alias("_children"), F.col("path").alias("_up"), "subroot")
    inside = (F.col("tree") == F.col("_tree")) & (F.expr(f"at div {fanout}") == F.col("_at")) & (F.col("lo") >= F.col("_lo")) & (F.col("hi") <= F.col("_hi"))
    path = F.concat(F.array(_outside(F.col("_children"), F.col("lo"), F.col("hi"))), F.col("_up"))
    return nodes.join(up, inside).select(*keep, path.alias("path"), "subroot")


def paths(manifest: Manifest, keep: Sequence[str] = (), fanout: int = FANOUT) -> DataFrame:
    """Leaves with ``leaf`` and ``subroot`` (hex), ``path``: siblings level by level up to the root, as (before, after), and ``keep``."""
    label = ["tree", "at", "count", "lo", "hi", "digest"]
    none = F.array().cast(_PATH)
    tops = manifest.tops
    known = tops[-1].withColumn("path", none).withColumn("subroot", F.lit(None).cast("string"))
    for k in range(len(tops) - 2, -1, -1):
        columns = [*label, *(["children"] if k else [])]
        known = _attached(tops[k], known, fanout, columns)
    # subroots know their way to the root; a group's tree hangs below the one that covers its ranks
    known = stage(known.select(F.col("lo").alias("_tree"), F.col("path").alias("_path"), _hex(F.col("digest")).alias("_subroot")), "subroot_paths")

    def rooted(nodes: DataFrame, columns: Sequence[str]) -> DataFrame:
        return nodes.filter("count = 1").join(known, F.col("tree") == F.col("_tree")).select(
            *columns, F.col("_path").alias("path"), F.col("_subroot").alias("subroot"))

    above = None
    for t in reversed(manifest.levels):
        columns = [*label, "children"]
        found = rooted(t, columns)
        if above is not None:
            found = found.unionByName(_attached(t.filter("count > 1"), above, fanout, columns))
        above = found
    columns = [*label, *keep]
    found = rooted(manifest.leaves, columns)
    if above is not None:
        found = found.unionByName(_attached(manifest.leaves.filter("count > 1"), above, fanout, columns))
    return found.select(*keep, _hex(F.col("digest")).alias("leaf"), "subroot", "path")


def proof(path: Column) -> Column:
    """The siblings of a path as one text, level by level, left to right."""
    return F.array_join(F.transform(path, lambda p: F.concat(p["before"], p["after"])), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda own, p: F.sha2(F.concat(p["before"], own, p["after"]).cast("binary"), 256))


def verified_rows(df: DataFrame, columns: Sequence[str], tampered: dict[str, Column], touched: Column, id_col: str = "doc_id",
                  group_col: str = "source", fanout: int = FANOUT) -> DataFrame:
    """One row per row of ``df``: its id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Leaves are digests of ``columns``; where ``touched`` holds, the columns in
    ``tampered`` take other values before the root is computed again from the
    row and its original siblings. A row with a NULL id or group, or one that
    repeats another, is a leaf like any other; no rows give no rows.
    """
    other = leaf_digest([tampered.get(c, F.col(c)) for c in columns])
    rows = df.select(
        F.col(id_col).alias("_id"), F.col(group_col).alias("_source"), leaf_digest(columns).alias("_leaf"),
        F.when(touched, F.unhex(other)).alias("_other"))
    manifest = build(rows, "_source", ["_id"], "_leaf", ["_id", "_other"], fanout)
    found = paths(manifest, ["_id", "_other"], fanout)
    again = folded(F.coalesce(_hex(F.col("_other")), F.col("leaf")), F.col("path"))
    root = F.lit(manifest.root).cast("string")
    return found.select(F.col("_id").alias(id_col), "leaf", "subroot", root.alias("root"),
                        F.sha2(proof(F.col("path")).cast("binary"), 256).alias("proof_sha256"), again.alias("folded_root")
                        ).withColumn("verified", F.col("folded_root") == F.col("root"))
