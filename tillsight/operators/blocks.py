"""Linear models with one column per product, by block elimination.

One-hot products make a diagonal block of the normal equations. Eliminating it
leaves a dense system for features and months alone, whatever the number of
products: what reaches the driver is two matrices of their side. A product's own
weight then follows from its sums, in the table of products.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import dbl
from ..functions.staging import stage
from .forecast import Moments, block_moments


@dataclass
class ProductModel:
    """``columns`` of the dense part with their training means and weights, and a table of product weights."""

    columns: list[str]
    origin: np.ndarray
    intercept: float
    weights: np.ndarray
    products: DataFrame


def with_months(rows: DataFrame, months: Sequence) -> DataFrame:
    """Add a 0/1 column for each of ``months``."""
    return rows.withColumns({month_name(m): (F.col("YearMonth") == F.lit(m)).cast("double") for m in months})


def month_name(day) -> str:
    return f"month_{day:%Y_%m}"


def product_sums(rows: DataFrame, columns: Sequence[str], origin: np.ndarray, label: str) -> DataFrame:
    """Rows, sums of the centred columns and of the label, per product."""
    return rows.groupBy("StockCode").agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        *[F.sum(dbl(c) - F.lit(float(o))).alias(f"s{k}") for k, (c, o) in enumerate(zip(columns, origin, strict=True))],
        F.sum(dbl(label)).alias("y"))


def _eliminated(sums: DataFrame, side: int, alpha: float) -> np.ndarray:
    """Sum over products of v v' / (n + alpha) for v = (n, sums, y); a task hands on one matrix."""
    names = ["n", *[f"s{k}" for k in range(side - 2)], "y"]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((side, side))
        for batch in batches:
            v = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names])
            total += (v / (v[:, :1] + alpha)).T @ v
        yield pa.RecordBatch.from_pydict({"cell": pa.array(np.arange(side * side)), "value": pa.array(total.ravel())})

    cells = sums.select(*names).mapInArrow(partial, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(side * side)
    for r in cells:
        out[r["cell"]] = r["value"]
    return out.reshape(side, side)


def fit_by_products(train: DataFrame, features: Sequence[str], alpha: float, label: str = "target") -> ProductModel:
    """Least squares plus ``alpha`` times the squared weights (not the intercept's) over features, months and products.

    The columns are not scaled. A tiny ``alpha`` gives the least-squares solution
    of least norm, which dependent columns leave open. No rows give no model.
    """
    return fits_by_products(train, features, [alpha], label)[0]


def fits_by_products(train: DataFrame, features: Sequence[str], alphas: Sequence[float], label: str = "target") -> list[ProductModel]:
    """:func:`fit_by_products` for each of ``alphas``, from the same sums."""
    months = [r["YearMonth"] for r in train.select("YearMonth").distinct().orderBy("YearMonth").collect()]  # bounded by time
    if not months:
        raise ValueError("a linear model needs training rows")
    columns = [*features, *[month_name(m) for m in months]]
    rows = with_months(train, months).select("StockCode", *[dbl(c).alias(c) for c in [*columns, label]])
    moments = block_moments(rows.withColumn("block", F.lit(0)), columns, label)
    sums = stage(product_sums(rows, columns, moments.origin, label), "product_sums")
    return [_solved(columns, moments, sums, alpha) for alpha in alphas]


def _solved(columns: list[str], moments: Moments, sums: DataFrame, alpha: float) -> ProductModel:
    reduced = moments.blocks[0] - _eliminated(sums, len(columns) + 2, alpha)
    system = reduced[:-1, :-1] + alpha * np.diag([0.0, *[1.0] * len(columns)])
    scale = 1 / np.sqrt(np.maximum(np.diag(system), 1e-300))
    solved = scale * np.linalg.lstsq(system * np.outer(scale, scale), scale * reduced[:-1, -1], rcond=1e-13)[0]
    rest = F.col("y") - F.col("n") * float(solved[0]) - sum((F.col(f"s{k}") * float(w) for k, w in enumerate(solved[1:])), F.lit(0.0))
    products = stage(sums.select("StockCode", (rest / (F.col("n") + alpha)).alias("own")), "product_weights")
    return ProductModel(columns, moments.origin, float(solved[0]), solved[1:], products)


def predicted(model: ProductModel, rows: DataFrame) -> DataFrame:
    """``rows`` with ``Predicted``; a product or month that training lacks has weight zero."""
    months = {c for c in model.columns if c not in rows.columns}

    def value(c: str) -> Column:
        return (F.date_format("YearMonth", "yyyy_MM") == F.lit(c.removeprefix("month_"))).cast("double") if c in months else dbl(c)

    dense = sum((F.lit(float(w)) * (value(c) - F.lit(float(o))) for c, o, w in zip(model.columns, model.origin, model.weights, strict=True)), F.lit(model.intercept))
    return rows.join(model.products, "StockCode", "left").withColumn("Predicted", dense + F.coalesce("own", F.lit(0.0))).drop("own")
