"""K-Means that any engine repeats: integer coordinates, exact sums, draws from a hash.

Features are standardised and put on a grid of 1 / ``GRID`` deviations. All runs
(starts, or values of k) go through the same passes: one a center while seeding,
one an iteration after that. Distances are taken in Arrow batches, all runs at
once; only cluster totals leave a task, at most runs x k rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import seeded_hash
from ..functions.staging import release, stage

# Squared distances stay below 2^63 for up to 10^9 rows, whatever the outliers: no score exceeds the root of the rows.
GRID = 10_000
CHUNK = 8192  # rows whose distances are in memory at once
Center = tuple[int, ...]


@dataclass(frozen=True)
class Clustering:
    """Scaling, centers on the grid, and the summed squared distance to them in grid units."""

    features: tuple[str, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]
    centers: tuple[Center, ...]
    cost: int = field(default=0, compare=False)

    @property
    def inertia(self) -> float:
        return self.cost / GRID**2

    def scores(self) -> list[list[float]]:
        """Centers as standardised features."""
        return [[v / GRID for v in c] for c in self.centers]


def scaling(df: DataFrame, features: Sequence[str]) -> tuple[tuple[float, ...], tuple[float, ...]]:
    """Means and population deviations of double columns; 1 for a constant one, (0, 1) without rows."""
    stats = df.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(features)],
                   *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(features)]).first()
    n = range(len(features))
    return tuple(stats[f"m_{i}"] or 0.0 for i in n), tuple(stats[f"s_{i}"] or 1.0 for i in n)


def on_grid(features: Sequence[str], means: Sequence[float], deviations: Sequence[float]) -> list[Column]:
    """Coordinates x0, x1, ... of a row."""
    return [F.floor((F.col(c) - F.lit(m)) / F.lit(s) * GRID + 0.5).cast("long").alias(f"x{i}")
            for i, (c, m, s) in enumerate(zip(features, means, deviations, strict=True))]


def _array(centers: Sequence[Center]) -> str:
    listed = ", ".join("array(" + ", ".join(f"{v}L" for v in c) + ")" for c in centers)
    return f"cast(array({listed}) AS array<array<bigint>>)"


def _coordinates(points: DataFrame) -> list[str]:
    return [c for c in points.columns if c != "id"]


def _chunks(batch: pa.RecordBatch, coordinates: Sequence[str]) -> Iterator[list[np.ndarray]]:
    """The coordinates of a batch, ``CHUNK`` rows at a time."""
    columns = [batch.column(x).to_numpy(zero_copy_only=False) for x in coordinates]
    for low in range(0, batch.num_rows, CHUNK):
        yield [x[low : low + CHUNK] for x in columns]


def _nearest(x: Sequence[np.ndarray], centers: Sequence[Center]) -> tuple[np.ndarray, np.ndarray]:
    """Place of the nearest center of each row, ties to the lower one, and the squared distance to it."""
    label, cost = np.zeros(len(x[0]), np.int64), None
    for i, center in enumerate(centers):
        distance = np.zeros(len(label), np.int64)
        for values, c in zip(x, center, strict=True):
            part = values - c
            part *= part
            distance += part
        if cost is None:
            cost = distance
        else:
            label[distance < cost] = i
            np.minimum(cost, distance, out=cost)
    return label, cost


def _draws(points: DataFrame, runs: Mapping[int, Sequence[Center]], step: int, seed: int) -> dict[int, Center]:
    """One point a run, drawn with a chance in proportion to its squared distance from the run's centers.

    The smallest -ln(u) / weight of all points wins, which needs no running
    total; u comes from a hash of seed, run, step and id. A run all of whose
    points are centers has no draw.
    """
    coordinates, order = _coordinates(points), list(runs)

    def weigh(batches):
        for batch in batches:
            parts = [np.stack([_nearest(x, runs[run])[1] if runs[run] else np.ones(len(x[0]), np.int64) for run in order], axis=1)
                     for x in _chunks(batch, coordinates)]
            flat = np.concatenate(parts).ravel() if parts else np.zeros(0, np.int64)
            listed = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * len(order), pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*batch.columns, listed], names=[*batch.schema.names, "weights"])

    fields = ", ".join(f"{name} {kind}" for name, kind in points.dtypes)
    weighed = points.mapInArrow(weigh, f"{fields}, weights array<bigint>")
    digits = F.conv(F.substring(seeded_hash(seed, "run", "step", "id"), 1, 13), 16, 10).cast("double")
    each = F.inline(F.arrays_zip(F.array(*map(F.lit, order)).alias("run"), F.col("weights").alias("weight")))
    drawn = weighed.select("id", *coordinates, each).where("weight > 0").withColumn("step", F.lit(step))
    drawn = drawn.withColumn("key", -F.log((digits + 1) / F.lit(2.0**52)) / F.col("weight"))
    rows = drawn.groupBy("run").agg(*[F.min_by(x, "key").alias(x) for x in coordinates]).collect()
    return {r.run: tuple(r[x] for x in coordinates) for r in rows}


def seeds(points: DataFrame, ks: Mapping[int, int], seed: int = 42) -> dict[int, list[Center]]:
    """k-means++ centers of every run (run -> k); fewer than k where there are fewer distinct points."""
    chosen: dict[int, list[Center]] = {run: [] for run in ks}
    for step in range(max(ks.values(), default=0)):
        open_ = {run: c for run, c in chosen.items() if len(c) == step < ks[run]}
        drawn = _draws(points, open_, step, seed) if open_ else {}
        for run, center in drawn.items():
            chosen[run].append(center)
        if not drawn:
            break
    return chosen


def _whole(values: np.ndarray) -> int:
    """Sum of numbers from 0 on that may pass 2^63."""
    return (int((values >> 32).sum()) << 32) + int((values & 0xFFFFFFFF).sum())


def _totals(points: DataFrame, runs: Mapping[int, Sequence[Center]]) -> list:
    """Rows, coordinate sums, cost and sum of squared norms of every cluster of every run that has rows."""
    coordinates = _coordinates(points)
    exact = pa.decimal128(38, 0)

    def partial(batches):
        found: dict[tuple[int, int], list[int]] = {}
        for x in (chunk for batch in batches for chunk in _chunks(batch, coordinates)):
            norm = sum(v * v for v in x)
            for run, centers in runs.items():
                label, cost = _nearest(x, centers)
                for cluster in np.flatnonzero(np.bincount(label)).tolist():
                    own = label == cluster
                    sums = [int(own.sum()), _whole(cost[own]), _whole(norm[own]), *[int(v[own].sum()) for v in x]]
                    held = found.get((run, cluster + 1), [0] * len(sums))
                    found[run, cluster + 1] = [a + b for a, b in zip(held, sums, strict=True)]
        if found:
            rows = list(found.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in found], pa.int32()), pa.array([k[1] for k in found], pa.int32()), pa.array([r[0] for r in rows], pa.int64()),
                 *[pa.array([Decimal(r[i]) for r in rows], exact) for i in (1, 2)],
                 *[pa.array([r[i] for r in rows], pa.int64()) for i in range(3, 3 + len(coordinates))]],
                names=["run", "cluster", "n", "cost", "squares", *coordinates])

    fields = ", ".join(f"{x} bigint" for x in coordinates)
    sums = points.select(*coordinates).mapInArrow(
        partial, f"run int, cluster int, n bigint, cost decimal(38,0), squares decimal(38,0), {fields}")
    return sums.groupBy("run", "cluster").agg(*[F.sum(c).alias(c) for c in ("n", "cost", "squares", *coordinates)]).collect()


def _rounded_mean(total: int, n: int) -> int:
    return (2 * total + n) // (2 * n)


def lloyd(points: DataFrame, start: Mapping[int, Sequence[Center]], iterations: int = 300) -> dict[int, tuple[tuple[Center, ...], int]]:
    """Centers and cost of every run after Lloyd's steps, until nothing moves.

    Ties go to the lower cluster; a center that loses all points stays where it is.
    """
    current = {run: list(c) for run, c in start.items()}
    moving = {run: c for run, c in current.items() if c}
    coordinates = _coordinates(points)
    for _ in range(iterations):
        if not moving:
            break
        moved = {run: list(c) for run, c in moving.items()}
        for r in _totals(points, moving):
            moved[r.run][r.cluster - 1] = tuple(_rounded_mean(r[x], r.n) for x in coordinates)
        moving = {run: c for run, c in moved.items() if c != current[run]}
        current.update(moving)
    cost = dict.fromkeys(current, 0)
    filled = {run: c for run, c in current.items() if c}
    for r in _totals(points, filled) if filled else ():
        cost[r.run] += int(r.cost)
    return {run: (tuple(c), cost[run]) for run, c in current.items()}


def fit(df: DataFrame, features: Sequence[str], ks: Mapping[int, int], id_col: str, seed: int = 42,
        iterations: int = 300) -> dict[int, Clustering]:
    """A clustering of double columns for every run (run -> k). ``id_col`` is unique; it only decides the draws.

    A table without rows gives clusterings without centers.
    """
    means, deviations = scaling(df, features)
    points = stage(df.select(F.col(id_col).cast("string").alias("id"), *on_grid(features, means, deviations)), "points")
    try:
        found = lloyd(points, seeds(points, ks, seed), iterations)
    finally:
        release(points)
    return {run: Clustering(tuple(features), means, deviations, centers, cost) for run, (centers, cost) in found.items()}


def best(fits: Mapping[int, Clustering]) -> Clustering:
    """The cheapest run, the first of equal ones."""
    return fits[min(fits, key=lambda run: (fits[run].cost, run))]


def assign(df: DataFrame, model: Clustering, column: str = "clusters") -> DataFrame:
    """Add the nearest center's id, ties to the lower one; a projection. NULL if the model has no centers."""
    coordinates = on_grid(model.features, model.means, model.deviations)
    centers = F.expr(_array(model.centers))

    def squared(c):
        parts = [(x - c[i]) * (x - c[i]) for i, x in enumerate(coordinates)]
        return sum(parts[1:], parts[0])

    distances = F.transform(centers, squared)
    return df.withColumn(column, (F.array_position(distances, F.array_min(distances)) - 1).cast("int"))


def silhouettes(df: DataFrame, fits: Mapping[int, Clustering]) -> DataFrame:
    """Mean silhouette with squared Euclidean distance of each run (columns run, silhouette), linear in the rows.

    The runs share one scaling, as :func:`fit` gives them. The summed squared
    distance from x to a cluster is n|x|^2 - 2 x.S + Q, with n, S and Q the
    cluster's size, vector sum and sum of squared norms; only these totals, at
    most runs x k rows, leave the executors. A row alone in its cluster counts 0;
    a run of fewer than two clusters with rows has no row here.
    """
    spark, model = df.sparkSession, next(iter(fits.values()))
    points = df.select(*on_grid(model.features, model.means, model.deviations))
    coordinates = points.columns
    runs = {run: f.centers for run, f in fits.items() if len(f.centers) > 1}
    totals: dict[int, dict[int, list[float]]] = {run: {} for run in runs}
    for r in _totals(points, runs) if runs else ():
        totals[r.run][r.cluster] = [float(r.n), float(r.squares) / GRID**2, *(r[x] / GRID for x in coordinates)]
    # a center without rows is no cluster
    filled = {run: sorted(t) for run, t in totals.items() if len(t) > 1}
    kept = {run: [fits[run].centers[c - 1] for c in clusters] for run, clusters in filled.items()}
    if not kept:
        return spark.createDataFrame([], "run int, silhouette double")
    sums = {run: np.array([totals[run][c] for c in clusters]) for run, clusters in filled.items()}

    def partial(batches):
        count, found = 0, dict.fromkeys(kept, 0.0)
        for x in (chunk for batch in batches for chunk in _chunks(batch, coordinates)):
            v = np.stack(x, axis=1) / GRID
            norm, count = (v * v).sum(axis=1), count + len(v)
            for run, centers in kept.items():
                n, q, vectors = sums[run][:, 0], sums[run][:, 1], sums[run][:, 2:]
                apart = np.maximum(norm[:, None] * n - 2 * (v @ vectors.T) + q, 0.0)
                label, rows = _nearest(x, centers)[0], np.arange(len(v))
                a = apart[rows, label] / np.maximum(n[label] - 1, 1)
                means = apart / n
                means[rows, label] = np.inf
                b = means.min(axis=1)
                most = np.maximum(a, b)
                s = np.divide(b - a, most, out=np.zeros(len(v)), where=(most > 0) & (n[label] > 1))
                found[run] += float(s.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int32()), pa.array([count] * len(found), pa.int64()), pa.array(list(found.values()))],
            names=["run", "n", "s"])

    scored = points.mapInArrow(partial, "run int, n bigint, s double").groupBy("run").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    return scored.select("run", (F.col("s") / F.col("n")).alias("silhouette"))


SCHEMA = "cluster int, position int, feature string, mean double, deviation double, coordinate long"


def save(spark: SparkSession, model: Clustering, path: str) -> None:
    """Write the clustering as a table, one row a cluster and feature."""
    rows = [(k, i, f, model.means[i], model.deviations[i], c[i])
            for k, c in enumerate(model.centers) for i, f in enumerate(model.features)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> Clustering:
    """A saved clustering; its cost is not kept."""
    rows = spark.read.schema(SCHEMA).parquet(path).orderBy("cluster", "position").collect()
    first = [r for r in rows if r.cluster == 0]
    centers = tuple(tuple(r.coordinate for r in rows if r.cluster == k) for k in range(len({r.cluster for r in rows})))
    return Clustering(tuple(r.feature for r in first), tuple(r["mean"] for r in first), tuple(r.deviation for r in first), centers)
