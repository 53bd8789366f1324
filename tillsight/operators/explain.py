"""Additive attribution of a linear forecast to its features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import StandardScalerModel
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import dbl, seeded_hash
from ..functions.ranking import with_position
from .monthly import FEATURES

KEYS = ("StockCode", "YearMonth")


@dataclass(frozen=True)
class LinearForecast:
    """Raw-scale weights of a fitted pipeline and its coefficients on standardised features."""

    features: tuple[str, ...]
    intercept: float
    weights: tuple[float, ...]
    standardized: tuple[float, ...]


def check_pipeline(model: PipelineModel) -> tuple[StandardScalerModel, LinearRegressionModel]:
    if not isinstance(model, PipelineModel):
        raise TypeError(f"{type(model).__name__} is no PipelineModel")
    scaler = [s for s in model.stages if isinstance(s, StandardScalerModel)]
    ridge = [s for s in model.stages if isinstance(s, LinearRegressionModel)]
    if not scaler or not ridge:
        raise KeyError("among the fitted stages, StandardScalerModel or LinearRegressionModel is missing")
    return scaler[0], ridge[0]


def unfold(model: PipelineModel, train_rows: int, features: Sequence[str] = FEATURES) -> LinearForecast:
    """Weights from the pipeline; the scaler's sample deviation is turned into the population one."""
    scaler, ridge = check_pipeline(model)
    coef, mean, std = ridge.coefficients.toArray(), scaler.mean.toArray(), scaler.std.toArray()
    std = np.where(std == 0, 1.0, std)
    weights = coef / std
    return LinearForecast(
        tuple(features),
        float(ridge.intercept - weights @ mean),
        tuple(map(float, weights)),
        tuple(map(float, coef * np.sqrt((train_rows - 1) / train_rows))),
    )


def background(train: DataFrame, size: int = 500, seed: int = 42) -> DataFrame:
    """Reproducible sample: the rows with the lowest seeded hash of their key."""
    return train.orderBy(seeded_hash(seed, *KEYS), *KEYS).limit(size)


def background_means(rows: DataFrame, features: Sequence[str] = FEATURES) -> dict[str, float]:
    """Mean of each feature over the background: by default all training rows, or a sample of them."""
    return rows.agg(*[F.avg(dbl(c)).alias(c) for c in features]).first().asDict()


def attributions(forecast: LinearForecast, means: dict[str, float]) -> tuple[float, dict[str, Column]]:
    """Base value, and per feature its weight times the distance to the background mean."""
    base = forecast.intercept + sum(w * means[f] for f, w in zip(forecast.features, forecast.weights))
    return base, {f: F.lit(w) * (dbl(f) - F.lit(means[f])) for f, w in zip(forecast.features, forecast.weights)}


def shap_values(rows: DataFrame, forecast: LinearForecast, means: dict[str, float]) -> DataFrame:
    """Long form: one row per forecast and feature."""
    base, phi = attributions(forecast, means)
    items = [F.struct(F.lit(f).alias("Feature"), dbl(f).alias("Value"), c.alias("SHAP")) for f, c in phi.items()]
    return rows.select(*KEYS, F.lit(base).alias("BaseValue"), F.inline(F.array(*items)))


def shap_importance(rows: DataFrame, forecast: LinearForecast, means: dict[str, float]) -> DataFrame:
    """Mean absolute attribution per feature, ranked; one wide aggregate, then one row per feature."""
    _, phi = attributions(forecast, means)
    wide = rows.agg(*[F.avg(F.abs(c)).alias(f) for f, c in phi.items()])
    items = [
        F.struct(F.lit(f).alias("Feature"), F.col(f).alias("MeanAbsoluteSHAP"), F.lit(s).alias("StandardizedRidgeCoefficient"))
        for f, s in zip(forecast.features, forecast.standardized)
    ]
    long = wide.select(F.inline(F.array(*items)))
    rank = F.row_number().over(Window.orderBy(F.desc("MeanAbsoluteSHAP"), "Feature"))  # a row per feature
    return long.select(rank.alias("Rank"), "*")


def strongest(values: DataFrame, importance: DataFrame, top: int = 10) -> DataFrame:
    """Attributions of the ``top`` features: the points of a beeswarm plot."""
    ranked = importance.where(F.col("Rank") <= top).select("Rank", "Feature")  # a row per feature
    return values.join(F.broadcast(ranked), "Feature").select(*values.columns, "Rank")


def representative(rows: DataFrame, predicted: Column | str, actual: str = "target") -> DataFrame:
    """The row in the middle when ordered by absolute error (ties by key), found without a one-task sort."""
    scored = rows.select(
        *KEYS, dbl(actual).alias("ActualNextMonthQuantity"), dbl(predicted).alias("PredictedNextMonthQuantity")
    ).withColumn("AbsoluteError", F.abs(F.col("ActualNextMonthQuantity") - F.col("PredictedNextMonthQuantity")))
    placed = with_position(scored, "AbsoluteError", *KEYS)
    return placed.where(F.col("position") == placed.count() // 2).drop("position")


def shap_local(values: DataFrame, row: DataFrame, top: int = 10) -> DataFrame:
    """Attribution of one forecast: the ``top - 1`` strongest features and the sum of the others."""
    one = values.join(row.select(*KEYS), list(KEYS), "left_semi")  # a row per feature
    strength = F.row_number().over(Window.orderBy(F.desc(F.abs("SHAP")), "Feature"))
    ranked = one.withColumn("Rank", F.least(strength, F.lit(top)))
    return ranked.groupBy(*KEYS, "BaseValue", "Rank").agg(
        F.when(F.count(F.lit(1)) > 1, F.concat(F.count(F.lit(1)).cast("string"), F.lit(" other features")))
        .otherwise(F.max("Feature")).alias("Feature"),
        F.sum("SHAP").alias("SHAP"),
    )
