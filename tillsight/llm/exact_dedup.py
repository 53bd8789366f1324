"""Exact duplicates by deterministic block naming.

A normalised text is cut into blocks of a fixed number of characters. Distinct
blocks are sorted and numbered; adjacent pairs of numbers are sorted and
numbered again, until each text is left with one number. Two texts of as many
blocks have the same last number exactly if they are equal: every number stands
for one string, so nothing rests on a digest of a whole text.

The blocks themselves are shuffled once, to prove that a 128-bit digest tells
all distinct blocks of the corpus apart (a seed that does not is replaced);
after that only digests and numbers travel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import with_position
from ..functions.staging import stage

SPACE = r"[\x20\x09-\x0D]+"


def normalized(text: Column | str) -> Column:
    """Runs of ASCII white space as one space; NULL as the empty text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _blocks(text: Column, size: int) -> Column:
    """Consecutive pieces of ``size`` characters; one empty piece for the empty text."""
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return F.when(F.length(text) == 0, F.array(F.lit(""))).otherwise(pieces)


def _digest(block: Column, seed: int) -> Column:
    return F.struct(F.xxhash64(block, F.lit(seed)).alias("h1"), F.xxhash64(F.lit(~seed), block).alias("h2"))


def _telling_seed(texts: DataFrame, size: int) -> int:
    """The first seed whose digest differs between any two distinct blocks."""
    blocks = texts.select(F.explode(_blocks(F.col("text"), size)).alias("block"))
    for seed in range(1, 9):
        distinct = blocks.select(_digest(F.col("block"), seed).alias("d"), "block").select("d.h1", "d.h2", "block").distinct()
        if distinct.groupBy("h1", "h2").count().filter("count > 1").isEmpty():
            return seed
    raise RuntimeError("no seed tells the blocks apart")


def _name(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Replace the key columns by the number of their values in sorted order."""
    names = with_position(parts.select(*keys).distinct(), *keys, name="name")
    known = names.select(*[F.col(k).alias(f"n_{k}") for k in keys], "name")
    same = [F.col(k).eqNullSafe(F.col(f"n_{k}")) for k in keys]
    return parts.join(known, same).select("row", "blocks", "at", "left", "name")


def text_identity(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = 4096) -> DataFrame:
    """One row per input row: row, doc_id, text_sha256, blocks, name.

    Rows have equal normalised texts exactly if ``(blocks, name)`` agree. NULL
    ids and repeated ids are rows like any other; ``row`` tells them apart.
    """
    texts = df.select(F.col(id_col).alias("doc_id"), normalized(text_col).alias("text"))
    seed = _telling_seed(texts, block)
    rows = stage(
        texts.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
            F.transform(_blocks(F.col("text"), block), lambda b: _digest(b, seed)).alias("digests"),
        ),
        "identity_rows",
    )
    # left: names the text still consists of; at: the place of this one
    parts = rows.select("row", F.size("digests").alias("blocks"), F.size("digests").alias("left"),
                        F.posexplode("digests").alias("at", "d")).select("row", "blocks", "at", "left", "d.h1", "d.h2")
    parts = stage(_name(parts, ["h1", "h2"]), "identity_names")
    longest = parts.agg(F.max("blocks")).first()[0] or 0
    done = [parts.filter("left = 1")]
    while longest > 1:
        longest = (longest + 1) // 2
        half = F.floor(F.col("at") / 2).cast("int")
        pairs = parts.filter("left > 1").groupBy("row", "blocks", half.alias("at"), F.ceil(F.col("left") / 2).cast("int").alias("left")).agg(
            F.max(F.when(F.col("at") % 2 == 0, F.col("name"))).alias("first"),
            F.max(F.when(F.col("at") % 2 == 1, F.col("name"))).alias("second"),
        )
        # a last name without partner keeps NULL beside it
        pairs = stage(pairs, "identity_pairs")
        # names of texts of different numbers of blocks need not differ
        parts = stage(_name(pairs, ["first", "second"]), "identity_names")
        done.append(parts.filter("left = 1"))
    names = done[0]
    for more in done[1:]:
        names = names.unionByName(more)
    return rows.drop("digests").join(names.select("row", "blocks", "name"), "row")


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = 4096) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of rows with equal normalised texts the one with the smallest id stays (of
    repeated ids, one row; a NULL id only if no other is there). NULL texts are
    empty texts, and empty texts are equal. An empty table gives no rows.
    """
    rows = text_identity(df, id_col, text_col, block)
    rows = rows.withColumn("rank", F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row"))
    groups = rows.groupBy("blocks", "name").agg(F.min("rank").alias("best"), F.count(F.lit(1)).alias("group_size"))
    groups = stage(groups, "identity_groups")  # both sides of the join are then plain shuffles, which split a hot group
    return rows.join(groups, ["blocks", "name"]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
    )
