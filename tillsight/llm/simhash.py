"""SimHash fingerprints and an exact search within a Hamming radius.

Terms are pairs of neighbouring words. Each occurrence votes with its weight on
64 bits. The votes of two bits share one long (32 bits each), so 32 sums make a
fingerprint. The search permutes blocks of the fingerprint: with radius r and b
blocks, two fingerprints within r bits agree on at least b - r blocks, so one
table per choice of b - r blocks finds every such pair by an equality join.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.staging import stage

BITS = 64
NO_WORD = r"[^\p{L}\p{N}]+"


def terms(text: Column) -> Column:
    """Neighbouring words of a text as (first, second); a lone word stands with an empty one, a text without words has none."""
    words = F.array_remove(F.split(F.lower(text), NO_WORD), "")
    before = F.concat(F.array(F.lit("")), words)
    pairs = F.arrays_zip(F.slice(before, 1, F.size(words)).alias("a"), words.alias("b"))
    # the first word has no partner before it and votes alone only if it is the only one
    return F.when(F.size(words) > 1, F.slice(pairs, 2, F.size(words))).otherwise(pairs)


def _lanes(hashed: Column, weight: Column) -> list[Column]:
    """32 sums; the j-th holds the votes of bit j (low half) and of bit j + 32 (high half)."""
    mask = F.lit((1 << 32) | 1)
    return [F.sum(F.shiftrightunsigned(hashed, j).bitwiseAND(mask) * weight).alias(f"v{j}") for j in range(32)]


def _fingerprint(total: str) -> Column:
    """A bit is set where more than half of the weight voted for it."""
    low = F.lit((1 << 32) - 1)
    out = F.lit(0).cast("long")
    for j in range(32):
        for shift, votes in ((j, F.col(f"v{j}").bitwiseAND(low)), (j + 32, F.shiftrightunsigned(F.col(f"v{j}"), 32))):
            out = out.bitwiseOR(F.when(votes * 2 > F.col(total), F.shiftleft(F.lit(1).cast("long"), shift)).otherwise(F.lit(0).cast("long")))
    return out


def fingerprints(df: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """``keys`` and the fingerprint (long) of each row's text; a text without words has 0.

    Every occurrence of a term weighs 1, so a term weighs as often as it
    occurs. Votes are exact up to 2^31 terms a text. Equal rows give one.
    """
    voted = df.select(*keys, F.explode_outer(terms(F.coalesce(F.col(text_col), F.lit("")))).alias("term"))
    hashed = F.xxhash64("term.b", "term.a")
    weight = F.when(F.col("term").isNull(), F.lit(0)).otherwise(F.lit(1)).cast("long")
    votes = voted.groupBy(*keys).agg(*_lanes(hashed, weight), F.sum(weight).alias("weight"))
    return votes.select(*keys, _fingerprint("weight").alias("fingerprint"))


def hamming(a: Column | str, b: Column | str) -> Column:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.bit_count(a.bitwiseXOR(b))


def likeness(a: Column | str, b: Column | str) -> Column:
    """Share of equal bits, 0 to 1."""
    return 1 - hamming(a, b) / F.lit(float(BITS))


def as_hex(fingerprint: Column | str) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def block_masks(blocks: int, radius: int) -> list[int]:
    """Signed masks of every choice of ``blocks - radius`` blocks."""
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [m - (1 << 64) if m >> 63 else m for m in (sum(c) for c in combinations(parts, blocks - radius))]


def near_fingerprints(values: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """Pairs (a, b, distance), a < b, of all distinct fingerprints within ``radius`` bits of each other.

    ``values`` has distinct fingerprints, so copies do not multiply. A pair that
    meets in several tables is given by the first of them. More blocks make the
    keys longer and the tables more: with n fingerprints a key should have log2(n) bits or more.
    """
    masks = block_masks(blocks, radius)
    keys = F.array(*[F.col("fingerprint").bitwiseAND(F.lit(m)) for m in masks])
    table = values.select("fingerprint", F.posexplode(keys).alias("table", "key"))
    # keys without a partner, nearly all of them, go before the join
    crowded = table.groupBy("table", "key").count().filter("count > 1").select("table", "key")
    table = stage(table.join(stage(crowded, "crowded_keys"), ["table", "key"]), "table_rows")
    left = table.select("table", "key", F.col("fingerprint").alias("a"))
    right = table.select("table", "key", F.col("fingerprint").alias("b"))
    met = left.join(right, ["table", "key"]).filter((F.col("a") < F.col("b")) & (hamming("a", "b") <= radius))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    first = F.coalesce(*[F.when(differ.bitwiseAND(F.lit(m)) == 0, F.lit(k)) for k, m in enumerate(masks)])
    return met.filter(F.col("table") == first).select("a", "b", hamming("a", "b").alias("distance"))


def _part(doc_id: Column, cuts: list[int], coarse: int = 64) -> Column:
    """How many cuts lie below an id: first among every ``coarse``-th cut, then among those between two of them."""
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts])
    marks = F.array(*[F.lit(c).cast("long") for c in cuts[coarse - 1 :: coarse]]) if len(cuts) >= coarse else F.array().cast("array<long>")
    skipped = F.size(F.filter(marks, lambda c: c < doc_id)) * coarse
    return F.when(doc_id.isNull(), F.lit(0)).otherwise(
        skipped + F.size(F.filter(F.slice(bounds, skipped + 1, coarse), lambda c: c < doc_id)))


def in_parts(df: DataFrame, id_col: str = "doc_id", rows_per_part: int = 64, most: int = 4096) -> tuple[DataFrame, int]:
    """Add ``part`` (ranges of ids) and ``helper``, and repeat the largest id of each range in the range above it.

    Ranges are cut at ids that occur, so that a window over (part, id descending)
    sees for each row the one that follows it in the order of the whole table;
    the smallest id is followed by the largest. NULL ids lie in the lowest range.
    """
    parts = max(1, min(most, df.count() // rows_per_part))
    found = df.select(
        F.percentile_approx(id_col, [k / parts for k in range(1, parts + 1)], 100_000).alias("cuts"), F.max(id_col).alias("top")
    ).first()
    cuts = sorted({*(found["cuts"] or ()), found["top"]} - {None}) or [0]
    rows = df.withColumn("part", _part(F.col(id_col).cast("long"), cuts))
    known = F.array(*[F.lit(c).cast("long") for c in cuts])
    carried = rows.filter(F.col(id_col) == F.try_element_at(known, F.col("part") + 1))
    carried = carried.withColumn("part", (F.col("part") + 1) % len(cuts)).withColumn("helper", F.lit(True))
    return rows.withColumn("helper", F.lit(False)).unionByName(carried), len(cuts)


def lead_by_id(rows: DataFrame, column: str, name: str, id_col: str = "doc_id", tie: str = "text_sha") -> DataFrame:
    """Add ``name``: the value of ``column`` in the next row by descending id; repeated ids follow each other by ``tie``.

    Where nothing follows (all ids NULL), NULL.
    """
    parted, _ = in_parts(rows, id_col)
    order = Window.partitionBy("part").orderBy("helper", F.col(id_col).desc_nulls_last(), tie)
    return parted.withColumn(name, F.lead(column).over(order)).filter(~F.col("helper")).drop("part", "helper")


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, next_fingerprint (longs).

    The edited text has its last third of code points replaced by the first as
    many of the next text by descending id. A NULL text is empty; the next text
    of the only row is its own.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("text_sha"))
    rows = lead_by_id(rows, "text", "next_text")
    size = F.length("text")
    third = F.floor(size / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), size - third), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), third))
    rows = rows.select("doc_id", "text", "text_sha", size.cast("long").alias("n_chars"), edited.alias("edited"))
    # the order within a range is total up to equal rows, so a repeated task gives the same row numbers
    rows = rows.withColumn("row", F.monotonically_increasing_id()).withColumn("edited_sha", F.unhex(F.sha2(F.col("edited").cast("binary"), 256)))
    both = rows.select("row", "doc_id", "n_chars", "text_sha", "edited_sha",
                       F.explode(F.array(F.struct(F.lit(False).alias("edited"), F.col("text").alias("text")),
                                         F.struct(F.lit(True).alias("edited"), F.col("edited").alias("text")))).alias("side"))
    keys = ["row", "doc_id", "n_chars", "text_sha", "edited_sha"]
    both = both.select(*keys, F.col("side.edited").alias("edited"), F.col("side.text").alias("text"))
    sides = fingerprints(both, [*keys, "edited"])
    pairs = stage(
        sides.groupBy(*keys).agg(
            F.max(F.when(~F.col("edited"), F.col("fingerprint"))).alias("fingerprint"),
            F.max(F.when(F.col("edited"), F.col("fingerprint"))).alias("edited_fingerprint")),
        "fingerprints")
    return lead_by_id(pairs.drop("row"), "fingerprint", "next_fingerprint").select(
        "doc_id", "n_chars", F.lower(F.hex("edited_sha")).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "next_fingerprint")


def near_counts(df: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """Per distinct ``fingerprint`` of ``df``: ``near_docs``, the rows of ``df`` whose fingerprint lies within ``radius`` bits, itself included."""
    values = stage(df.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("docs")), "fingerprint_values")
    pairs = near_fingerprints(values.select("fingerprint"), radius, blocks)
    both = pairs.select(F.col("a").alias("fingerprint"), F.col("b").alias("other")).unionByName(
        pairs.select(F.col("b").alias("fingerprint"), F.col("a").alias("other")))
    more = both.join(values.select(F.col("fingerprint").alias("other"), "docs"), "other").groupBy("fingerprint").agg(F.sum("docs").alias("more"))
    return values.join(more, "fingerprint", "left").select("fingerprint", (F.col("docs") + F.coalesce("more", F.lit(0))).alias("near_docs"))
