"""Repeated runs of lines, found by overlapping windows of three lines.

Every three consecutive lines of a document are one window. A window that
occurs before (in a smaller doc_id, or further up) covers its three lines; the
covered lines of a document are merged and removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.staging import stage
from .words import free_names, fresh

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _runs(lines: Column, window: int) -> Column:
    """The ``window`` consecutive lines from each line on, as structs a0, a1, ...; none for a text of fewer lines."""
    many = F.greatest(F.size(lines) - (window - 1), F.lit(0))
    return F.arrays_zip(*[F.slice(lines, k + 1, many).alias(f"a{k}") for k in range(window)])


def repeated_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row with repeated windows: doc_id, the row's ``text`` digest ``row_key``, and ``covered`` line numbers from 0.

    The first occurrence of a window is the one with the smallest
    (doc_id, line); NULL ids come last. Rows with the same id and text are one.
    """
    # the text ends here: a row per line that carried it would cost its square
    rows = df.select(F.col(id_col).alias("doc_id"), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("row_key"),
                     _runs(_lines(F.col(text_col)), window).alias("runs"))
    rows = rows.select("doc_id", "row_key", F.posexplode("runs").alias("line", "run"))
    run = F.concat_ws("\n", *[F.col(f"run.a{k}") for k in range(window)])
    spots = rows.select("doc_id", "row_key", "line", run.alias("run")).filter(F.col("run").rlike(r"\S"))
    spots = spots.select("doc_id", "row_key", "line", F.unhex(F.md5(F.col("run").cast("binary"))).alias("digest"))
    # NULL ids sort last
    rank = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row_key", "line")
    first = spots.groupBy("digest").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("times")).filter("times > 1")
    first = stage(first, "first_windows")  # both sides of the join are then plain shuffles, which split a hot window
    later = spots.join(first.select("digest", "first"), "digest").filter(
        ~(F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.row_key") == F.col("row_key"))
          & (F.col("first.line") == F.col("line"))))
    covered = F.flatten(F.collect_set(F.sequence("line", F.col("line") + (window - 1))))
    return later.groupBy("doc_id", "row_key").agg(F.array_sort(F.array_distinct(covered)).alias("covered"))


def without_repeated_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """All rows and columns of ``df``; ``text_col`` without the covered lines, and ``lines``, ``removed_lines``.

    Where ``df`` has a column of such a name, it stays, and the new one has an underscore behind its name.
    Texts without covered lines stay as they are, NULL included. A text that is
    covered whole becomes empty. A document of fewer than three lines has no
    window, and a window of blank lines covers nothing.
    """
    mine, span_id, span_key, covered, listed = free_names(df, 5)
    spans = repeated_lines(df, id_col, text_col, window).select(
        F.col("doc_id").alias(span_id), F.col("row_key").alias(span_key), F.col("covered").alias(covered))
    key = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    many, removed = fresh(df, "lines", "removed_lines")
    keyed = df.withColumn(mine, key)
    joined = keyed.join(spans, F.col(id_col).eqNullSafe(F.col(span_id)) & (F.col(mine) == F.col(span_key)), "left")
    # a column of its own: inside the lambda the text would be split again for every line
    places = F.array_except(F.sequence(F.lit(0), F.size(listed) - 1), F.col(covered))  # by a hash table: linear in the lines
    kept = F.transform(places, lambda at: F.get(F.col(listed), at))
    return (
        joined.withColumn(listed, _lines(F.col(text_col)))
        .withColumn(many, F.size(listed))
        .withColumn(removed, F.coalesce(F.size(covered), F.lit(0)))
        .withColumn(text_col, F.when(F.col(covered).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n")))
        .drop(mine, span_id, span_key, covered, listed)
    )
