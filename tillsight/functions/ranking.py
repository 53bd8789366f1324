"""Exact positions, running totals and quantiles over a global order.

None of these sorts the data in one task. Rows are range-partitioned on the
order columns, each range is numbered where it lies, and the few per-range
totals give every range its starting value.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import stage

# monotonically_increasing_id() keeps the row number in its lower 33 bits.
_ROW_MASK = (1 << 33) - 1


def _ranges(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Range-partitioned rows with their range number and place inside the range.

    The result is written before anything counts it, so that the counting pass
    and the numbering pass see the same ranges even after a lost executor.
    """
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_MASK)))
    )
    return stage(ranged, "ranges")


def _starts(ranged: DataFrame, totals: Mapping[str, Column]) -> DataFrame:
    """Per-range starting values; one row per shuffle partition, hence safe to broadcast."""
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    per_range = ranged.groupBy("_range").agg(*[c.alias(n) for n, c in totals.items()])
    return F.broadcast(
        per_range.select(
            "_range",
            *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_start_{n}") for n in totals],
        )
    )


def with_position(df: DataFrame, *order: Column | str, name: str = "position") -> DataFrame:
    """Add the 0-based position of each row in the global order of ``order``."""
    ranged = _ranges(df, order)
    starts = _starts(ranged, {"rows": F.count(F.lit(1))})
    return (
        ranged.join(starts, "_range")
        .withColumn(name, F.col("_start_rows") + F.col("_place"))
        .drop("_range", "_place", "_start_rows")
    )


def with_running_totals(
    df: DataFrame, order: Sequence[Column | str], totals: Mapping[str, str]
) -> DataFrame:
    """Add, for each ``new: source`` pair, the sum of source up to and including the row."""
    ranged = _ranges(df, order)
    starts = _starts(ranged, {new: F.sum(src) for new, src in totals.items()})
    upto = (
        Window.partitionBy("_range")
        .orderBy("_place")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    out = ranged.join(starts, "_range")
    for new, src in totals.items():
        out = out.withColumn(new, F.sum(src).over(upto) + F.col(f"_start_{new}"))
    return out.drop("_range", "_place", *[f"_start_{new}" for new in totals])


class ValueCounts:
    """Distinct values of numeric columns with their row counts, written once.

    Quantiles, fences, box plots and histograms all read this table instead of
    the rows. Building it combines on the map side, so a value that makes up a
    third of the rows costs one row per task.
    """

    def __init__(self, table: DataFrame):
        self.table = table
        self.rows: dict[str, int] = {}
        self.low: dict[str, float] = {}
        self.high: dict[str, float] = {}
        for r in table.groupBy("column").agg(
            F.sum("rows").alias("n"),
            F.min("value").alias("lo"),
            F.max("value").alias("hi"),
        ).collect():
            self.rows[r["column"]], self.low[r["column"]], self.high[r["column"]] = r["n"], r["lo"], r["hi"]

    @classmethod
    def of(cls, df: DataFrame, columns: Sequence[str]) -> ValueCounts:
        pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in columns)
        counts = (
            df.selectExpr(f"stack({len(columns)}, {pairs}) AS (column, value)")
            .where(F.col("value").isNotNull() & ~F.isnan("value"))
            .groupBy("column", "value")
            .agg(F.count(F.lit(1)).alias("rows"))
        )
        return cls(stage(counts, "value_counts"))

    def _numbered(self) -> DataFrame:
        """Each value with the rows before it (``first``) and up to it (``last``), per column."""
        upto = with_running_totals(self.table, ["column", "value"], {"last": "rows"})
        start, skip = F.lit(0), 0
        for column in sorted(self.rows):
            start = F.when(F.col("column") == column, F.lit(skip)).otherwise(start)
            skip += self.rows[column]
        return upto.withColumn("last", F.col("last") - start).withColumn("first", F.col("last") - F.col("rows"))

    def quantiles(self, wanted: Mapping[str, Sequence[float]]) -> dict[str, list]:
        """Exact quantiles with linear interpolation between neighbouring order statistics; None for a column without values."""
        none = {c: [None] * len(probs) for c, probs in wanted.items() if c not in self.rows}
        wanted = {c: probs for c, probs in wanted.items() if c in self.rows}
        if not wanted:
            return none
        ranks = {
            (c, r)
            for c, probs in wanted.items()
            for p in probs
            for r in {math.floor(p * (self.rows[c] - 1)), math.ceil(p * (self.rows[c] - 1))}
        }
        hit = reduce(
            lambda a, b: a | b,
            [(F.col("column") == c) & (F.col("first") <= r) & (F.col("last") > r) for c, r in ranks],
        )
        found = self._numbered().where(hit).collect()  # at most two rows per quantile

        def at(column: str, rank: int) -> float:
            return next(
                f["value"] for f in found
                if f["column"] == column and f["first"] <= rank < f["last"]
            )

        out: dict[str, list] = dict(none)
        for c, probs in wanted.items():
            out[c] = []
            for p in probs:
                pos = p * (self.rows[c] - 1)
                lo, hi, t = at(c, math.floor(pos)), at(c, math.ceil(pos)), pos - math.floor(pos)
                # Measured from the nearer end, as numpy does, so that results agree to the last bit.
                out[c].append(lo + (hi - lo) * t if t < 0.5 else hi - (hi - lo) * (1 - t))
        return out

    def steps(self, parts: int) -> dict[str, list[tuple[float, int]]]:
        """Largest value of each of at most ``parts`` equally filled runs of the ordered values, and the rows up to it, per column.

        If there are no more rows than ``parts`` these are all values.
        """
        n = F.lit(1)
        for column, rows in self.rows.items():
            n = F.when(F.col("column") == column, F.lit(rows)).otherwise(n)
        share = lambda c: F.floor(F.col(c).cast("decimal(38,0)") * parts / n)
        ends = self._numbered().where(share("last") > share("first")).select("column", "value", "last").collect()  # at most ``parts`` a column
        out: dict[str, list[tuple[float, int]]] = {c: [] for c in self.rows}
        for r in sorted(ends, key=lambda r: r["value"]):
            out[r["column"]].append((r["value"], r["last"]))
        return out

    def edges(self, parts: int) -> dict[str, list[float]]:
        """Largest value of each of at most ``parts`` equally filled runs of the ordered values, per column; the last is the maximum."""
        return {c: [value for value, _ in ends] for c, ends in self.steps(parts).items()}

    def moments(self) -> tuple[dict[str, float], dict[str, float | None]]:
        """Mean and sample standard deviation per column."""
        def per_column(x: Column) -> dict[str, float]:
            sums = self.table.groupBy("column").agg(F.sum(x * F.col("rows")).alias("s")).collect()
            return {r["column"]: r["s"] for r in sums}

        mean = {c: s / self.rows[c] for c, s in per_column(F.col("value")).items()}
        center = F.lit(None).cast("double")
        for c, m in mean.items():
            center = F.when(F.col("column") == c, F.lit(m)).otherwise(center)
        squares = per_column((F.col("value") - center) * (F.col("value") - center))
        n = self.rows
        return mean, {c: math.sqrt(s / (n[c] - 1)) if n[c] > 1 else None for c, s in squares.items()}

    def one(self, column: str) -> DataFrame:
        return self.table.where(F.col("column") == column).select("value", "rows")
