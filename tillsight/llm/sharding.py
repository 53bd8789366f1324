"""Shards over fixed virtual slots.

Records hash into a fixed number of slots, once for all. Only slots are dealt
to shards, by a versioned map: version 0 deals them in turn, each later version
is an edit of the one before that moves whole slots from heavy to light shards.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.staging import stage

SLOTS = 4096


def virtual_slot(key: Column | str, slots: int = SLOTS) -> Column:
    """Slot of a record. Rows without a key are spread by their place in the scan, which holds once the result is written."""
    key = F.col(key) if isinstance(key, str) else key
    own = F.when(key.isNull(), F.xxhash64(F.monotonically_increasing_id(), F.lit(7))).otherwise(F.xxhash64(key))
    return F.pmod(own, F.lit(slots)).cast("int")


def first_map(shards: int, slots: int = SLOTS) -> dict[int, int]:
    return {slot: slot % shards for slot in range(slots)}


def rebalanced(assigned: dict[int, int], load: dict[int, int], shards: int) -> dict[int, int]:
    """Edit a map until no single move or exchange between the two extreme shards narrows their gap.

    ``load`` has at most one number per slot, so this small loop is bounded by
    the number of slots, whatever the data.
    """
    edited = dict(assigned)
    held: list[set[int]] = [set() for _ in range(shards)]
    total = [0] * shards
    for slot, shard in edited.items():
        held[shard].add(slot)
        total[shard] += load.get(slot, 0)
    for _ in range(8 * len(edited)):
        high, low = max(range(shards), key=lambda s: (total[s], -s)), min(range(shards), key=lambda s: (total[s], s))
        gap = total[high] - total[low]
        # what moves should weigh half of the gap: one slot, or one for a lighter one
        ours = sorted((load.get(s, 0), s) for s in held[high])
        theirs = [(0, -1), *sorted((load.get(s, 0), s) for s in held[low])]
        best, j = (gap, None, None), 0
        for weight, slot in ours:
            while j + 1 < len(theirs) and weight - theirs[j + 1][0] >= gap / 2:
                j += 1
            for k in (j, j + 1):
                if k < len(theirs):
                    moved = weight - theirs[k][0]
                    if moved > 0 and abs(gap - 2 * moved) < best[0]:
                        best = (abs(gap - 2 * moved), slot, theirs[k][1])
        if best[1] is None:
            break
        _, out, back = best
        for slot, a, b in ((out, high, low), (back, low, high)):
            if slot >= 0:
                held[a].discard(slot)
                held[b].add(slot)
                total[a] -= load.get(slot, 0)
                total[b] += load.get(slot, 0)
                edited[slot] = b
    return edited


def grown(assigned: dict[int, int], load: dict[int, int], shards: int) -> dict[int, int]:
    """One shard more: it takes slots from the heaviest shards up to its share; no other slot moves."""
    edited = dict(assigned)
    share = sum(load.values()) / (shards + 1)
    total = {s: 0 for s in range(shards)}
    held: dict[int, list[tuple[int, int]]] = {s: [] for s in range(shards)}
    for slot, shard in assigned.items():
        total[shard] += load.get(slot, 0)
        heapq.heappush(held[shard], (-load.get(slot, 0), slot))
    taken = 0
    while taken < share:
        shard = max((s for s in total if held[s]), key=lambda s: total[s], default=None)
        if shard is None:
            break
        weight, slot = heapq.heappop(held[shard])
        total[shard] += weight
        if taken - weight <= share * 1.01:
            taken -= weight
            edited[slot] = shards
    return edited


def slot_loads(df: DataFrame) -> dict[int, int]:
    """Bytes per virtual slot; at most as many rows as there are slots."""
    return {r["virtual_slot"]: r["bytes"] for r in df.groupBy("virtual_slot").agg(F.sum("size").alias("bytes")).collect()}


MAP = "version int, virtual_slot int, shard int, moved boolean"


def map_rows(versions: list[dict[int, int]], first: int = 0) -> list[tuple[int, int, int, bool]]:
    """Rows of a map's versions, numbered from ``first``; versions[0] of a later edit is the one before and has no rows."""
    return [
        (first + v, slot, shard, v > 0 and versions[v - 1][slot] != shard)
        for v, assigned in enumerate(versions) if v or not first for slot, shard in sorted(assigned.items())
    ]


def save_map(spark: SparkSession, versions: list[dict[int, int]], path: str, first: int = 0) -> DataFrame:
    """Add versions of the map to the table under ``path``, each in a folder of its own; earlier ones stay as they are."""
    rows = spark.createDataFrame(map_rows(versions, first), MAP)
    rows.coalesce(1).write.partitionBy("version").mode("append").parquet(path)
    return spark.read.schema(MAP).parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, dict[int, int]] | None:
    """Number and content of a version (the latest) of the map stored under ``path``; None if there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    stored = spark.read.schema(MAP).parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    rows = stored.filter(F.col("version") == version).collect()  # one a virtual slot
    return (version, {r["virtual_slot"]: r["shard"] for r in rows}) if rows else None


def shard_by_slots(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 16,
                   slots: int = SLOTS, map_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows with their shard and gapless place in it, and the versioned slot map.

    Columns: doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot. The law is ``bytes``: the second
    version of the map evens out the bytes of the shards, so ``grown_shard`` is
    NULL. A NULL text has size 1 and the checksum of the empty text; rows with a
    NULL id are spread over the virtual slots. With ``map_path`` the latest map
    stored there is loaded, edited for these rows and stored as a new version
    (an empty path gets versions 0 and 1); ``slots`` and ``shards`` are then
    those of the stored map. ``slot`` counts a shard's rows from 0: the
    rows of its lower virtual slots, then the row's place in its own.
    """
    spark = df.sparkSession
    stored = load_map(spark, map_path) if map_path else None
    start = stored[1] if stored else first_map(shards, slots)
    slots, shards = len(start), max(start.values()) + 1
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        virtual_slot(F.col(id_col), slots).alias("virtual_slot"),
    )
    rows = stage(rows, "shard_rows")
    version, even = 1, rebalanced(start, slot_loads(rows), shards)
    if map_path is None:
        slot_map = stage(spark.createDataFrame(map_rows([start, even]), MAP), "slot_map")
    else:
        version = stored[0] + 1 if stored else 1
        slot_map = save_map(spark, [start, even], map_path, version - 1)

    current = slot_map.filter(F.col("version") == version).select("virtual_slot", "shard")
    counts = rows.groupBy("virtual_slot").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    # one row per virtual slot: a proven bound, so it may be broadcast
    starts = current.join(counts, "virtual_slot").select(
        "virtual_slot", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "size", "text_crc32")) - 1
    placed = rows.withColumn("place", place).join(F.broadcast(starts), "virtual_slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("start") + F.col("place")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )
    return placed, slot_map
