"""Next-month demand: target, split, time-ordered validation, ridge, metrics."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce
from itertools import accumulate
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import dbl
from ..functions.ranking import with_position
from ..functions.staging import stage
from .monthly import FEATURES

ALPHAS = (0.1, 1.0, 10.0, 50.0, 100.0)
FOLDS = 5
NEXT = ("next_month", "target")  # what with_next_month adds
LEAST_NORM = 1e-6  # a penalty that only settles what least squares leave open


def with_next_month(features: DataFrame, label: str = "MonthlyQuantity") -> DataFrame:
    """Add the next existing month of the product and its value; NULL behind the last one."""
    series = Window.partitionBy("StockCode").orderBy("YearMonth")  # bounded by the number of months
    return features.withColumns({"next_month": F.lead("YearMonth", 1).over(series), "target": F.lead(label, 1).over(series)})


def add_target(features: DataFrame, label: str = "MonthlyQuantity") -> DataFrame:
    """Next existing month's value; the last month of a product has none and goes."""
    return with_next_month(features, label).drop("next_month").dropna(subset=["target"])


def before_latest(series: DataFrame) -> DataFrame:
    """Rows of :func:`with_next_month` whose own and next month lie before the latest, incomplete month of all."""
    latest = F.lit(series.agg(F.max("YearMonth").alias("m")).first()["m"])
    whole = series.where((F.col("YearMonth") < latest) & (F.col("next_month") < latest))
    return whole.drop("next_month").dropna(subset=["target"])


def forecast_dataset(features: DataFrame, label: str = "MonthlyQuantity") -> DataFrame:
    """Features with target; the latest, incomplete month counts neither as a row nor as a target."""
    return before_latest(with_next_month(features, label))


def time_split(dataset: DataFrame, cut_off: str) -> tuple[DataFrame, DataFrame]:
    """Months up to and including ``cut_off`` train, later ones test."""
    day = F.lit(cut_off).cast("date")
    return dataset.where(F.col("YearMonth") <= day), dataset.where(F.col("YearMonth") > day)


def require_split(train: DataFrame, test: DataFrame) -> None:
    if train.schema.names != test.schema.names:
        raise ValueError(f"the parts differ in {sorted(set(train.columns) ^ set(test.columns)) or 'column order'}")
    part = lambda df, name: df.select(F.lit(name).alias("part")).limit(1)
    filled = {r["part"] for r in part(train, "train").unionByName(part(test, "test")).collect()}
    if len(filled) < 2:
        raise ValueError(f"no rows in {sorted({'train', 'test'} - filled)}")


def split_sizes(dataset: DataFrame, cut_off: str) -> DataFrame:
    part = F.when(F.col("YearMonth") <= F.lit(cut_off).cast("date"), "train").otherwise("test")
    return dataset.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))


def scaler_stats(train: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Mean and population standard deviation per feature, one row each."""
    wide = train.agg(
        *[F.avg(dbl(c)).alias(f"{c}|m") for c in features],
        *[F.stddev_pop(dbl(c)).alias(f"{c}|s") for c in features],
    )
    rows = [
        F.struct(F.lit(c).alias("Feature"), F.col(f"{c}|m").alias("mean"), F.col(f"{c}|s").alias("std"))
        for c in features
    ]
    return wide.select(F.inline(F.array(*rows)))


# --- time-ordered cross validation -------------------------------------------------


def block_starts(train: DataFrame, folds: int = FOLDS) -> list[tuple[date, str]]:
    """Key (YearMonth, StockCode) of the first row of blocks 1 to ``folds``.

    Row counts per month tell which months hold a block border; only the product
    codes of those months, at most ``folds`` of them, are put in order.
    """
    months = train.groupBy("YearMonth").agg(F.count(F.lit(1)).alias("n")).orderBy("YearMonth").collect()
    total = sum(m["n"] for m in months)
    size = total // (folds + 1)
    if size == 0:
        raise ValueError(f"{total} rows are too few for {folds} folds")
    ends = list(accumulate(m["n"] for m in months))
    borders = [total - size * (folds - i) for i in range(folds)]
    touched = sorted({bisect_right(ends, b) for b in borders})
    wanted, skipped = [], 0
    for i in touched:
        first = ends[i] - months[i]["n"]
        wanted += [skipped + b - first for b in borders if first <= b < ends[i]]
        skipped += months[i]["n"]
    keys = train.where(F.col("YearMonth").isin([months[i]["YearMonth"] for i in touched])).select("YearMonth", "StockCode")
    placed = with_position(keys, "YearMonth", "StockCode").where(F.col("position").isin(wanted))
    return [(r["YearMonth"], r["StockCode"]) for r in placed.orderBy("position").collect()]


def cv_blocks(train: DataFrame, folds: int = FOLDS) -> DataFrame:
    """Cut the rows, ordered by (YearMonth, StockCode), into ``folds + 1`` blocks.

    Block 0 takes the remainder; fold i tests block i and trains on all blocks
    before it. The rows themselves are neither sorted nor moved.
    """
    block = F.lit(0)
    for month, code in block_starts(train, folds):
        at_or_after = (F.col("YearMonth") > F.lit(month)) | (
            (F.col("YearMonth") == F.lit(month)) & (F.col("StockCode") >= F.lit(code))
        )
        block = block + at_or_after.cast("int")
    return train.withColumn("block", block)


@dataclass(frozen=True)
class Moments:
    """Cross products of (1, x - origin, y) summed per block."""

    origin: np.ndarray
    blocks: dict[int, np.ndarray]

    def upto(self, block: int) -> np.ndarray:
        return sum(m for b, m in self.blocks.items() if b < block)


def block_moments(blocked: DataFrame, features: Sequence[str], label: str = "target") -> Moments:
    """One pass over the rows; each task sends one small matrix per block, summed by Spark.

    What reaches the driver is (folds + 1) matrices of side len(features) + 2,
    whatever the number of rows.
    """
    names = list(features)
    first = blocked.agg(*[F.avg(dbl(c)).alias(c) for c in names]).first()
    origin = np.array([first[c] for c in names])
    side = len(names) + 2

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            rows = np.ones((batch.num_rows, side))
            for i, c in enumerate(columns, start=1):
                rows[:, i] = batch.column(c).to_numpy(zero_copy_only=False)
            rows[:, 1:-1] -= origin
            block = batch.column("block").to_numpy(zero_copy_only=False)
            for b in np.unique(block):
                part = rows[block == b]
                sums[int(b)] = sums.get(int(b), 0.0) + part.T @ part
        for b, m in sums.items():
            yield pa.RecordBatch.from_pydict({
                "block": pa.array(np.full(side * side, b, np.int32)),
                "cell": pa.array(np.arange(side * side, dtype=np.int32)),
                "value": pa.array(m.ravel()),
            })

    columns = [*names, label]
    cells = (
        blocked.select("block", *[dbl(c).alias(c) for c in columns])
        .mapInArrow(partial, "block int, cell int, value double")
        .groupBy("block", "cell")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    blocks: dict[int, np.ndarray] = {}
    for r in cells:
        blocks.setdefault(r["block"], np.zeros(side * side))[r["cell"]] = r["value"]
    return Moments(origin, {b: m.reshape(side, side) for b, m in blocks.items()})


def ridge_from_moments(m: np.ndarray, alpha: float) -> tuple[float, np.ndarray]:
    """Intercept and raw-scale weights of ridge on standardised columns, intercept unpenalised."""
    n = m[0, 0]
    mean_x, mean_y = m[0, 1:-1] / n, m[0, -1] / n
    cov = m[1:-1, 1:-1] / n - np.outer(mean_x, mean_x)
    cross = m[1:-1, -1] / n - mean_x * mean_y
    sd = np.sqrt(np.clip(np.diag(cov), 0, None))
    sd[sd == 0] = 1.0
    w = np.linalg.solve(n * cov / np.outer(sd, sd) + alpha * np.eye(len(sd)), n * cross / sd) / sd
    return float(mean_y - w @ mean_x), w


def rmse_from_moments(m: np.ndarray, intercept: float, w: np.ndarray) -> float:
    residual = np.concatenate([[intercept], w, [-1.0]])
    return float(np.sqrt(max(residual @ m @ residual, 0.0) / m[0, 0]))


def cv_scores(blocked: DataFrame, features: Sequence[str] = FEATURES, alphas: Sequence[float] = ALPHAS) -> DataFrame:
    """RMSE of every (alpha, fold) pair, from block moments alone."""
    moments = block_moments(blocked, features)
    rows = []
    for alpha in alphas:
        for fold in sorted(b for b in moments.blocks if b > 0):
            seen, held = moments.upto(fold), moments.blocks[fold]
            intercept, w = ridge_from_moments(seen, alpha)
            rows.append((float(alpha), fold, int(seen[0, 0]), int(held[0, 0]), rmse_from_moments(held, intercept, w)))
    return blocked.sparkSession.createDataFrame(
        rows, "alpha double, fold int, train_rows long, test_rows long, rmse double"
    )


def best_alpha(scores: DataFrame) -> float:
    """Lowest mean RMSE over the folds; the smaller alpha wins a tie."""
    mean = scores.groupBy("alpha").agg(F.avg("rmse").alias("rmse"))
    return mean.orderBy("rmse", "alpha").first()["alpha"]


# --- model -------------------------------------------------------------------------


def _reg_param(train: DataFrame, alpha: float, label: str = "target") -> float:
    """Spark penalises per row and in units of the label's deviation; this converts alpha."""
    r = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(dbl(label)).alias("s")).first()
    return alpha * r["s"] / r["n"]


def ridge_fit(train: DataFrame, alpha: float, features: Sequence[str] = FEATURES) -> PipelineModel:
    """Assembler, scaler and ridge as one pipeline; the solver needs a single pass."""
    ridge = LinearRegression(
        featuresCol="scaled", labelCol="target", predictionCol="Predicted", solver="normal",
        elasticNetParam=0.0, standardization=True, regParam=_reg_param(train, alpha),
    )
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="features"),
        StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True),
        ridge,
    ]).fit(train)


@dataclass
class Trained:
    model: PipelineModel
    alpha: float
    scores: DataFrame


def train_ridge(train: DataFrame, features: Sequence[str] = FEATURES, alphas: Sequence[float] = ALPHAS,
                folds: int = FOLDS) -> Trained:
    """Pick alpha on time-ordered folds, then refit on all training rows."""
    scores = cv_scores(cv_blocks(train, folds), features, alphas)
    alpha = best_alpha(scores)
    return Trained(ridge_fit(train, alpha, features), alpha, scores)


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows).select(*rows.columns, "Predicted")


def metrics(rows: DataFrame, predicted: Column | str, actual: Column | str = "target") -> DataFrame:
    """MAE, RMSE and R2 in one pass."""
    y, p = dbl(actual), dbl(predicted)
    sums = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.abs(y - p)).alias("abs_error"),
        F.sum((y - p) * (y - p)).alias("sq_error"),
        F.sum(y).alias("y"),
        F.sum(y * y).alias("yy"),
    )
    n = dbl("rows")
    return sums.select(
        "rows",
        F.try_divide("abs_error", n).alias("MAE"),
        F.sqrt(F.try_divide("sq_error", n)).alias("RMSE"),
        (1 - F.try_divide(F.col("sq_error"), F.col("yy") - F.try_divide(F.col("y") * F.col("y"), n))).alias("R2"),
    )


def dummies(rows: DataFrame) -> DataFrame:
    """Sparse one-hot form: one row per (StockCode, YearMonth, indicator that is 1)."""
    return rows.select(
        "StockCode", "YearMonth",
        F.explode(F.array(
            F.concat(F.lit("StockCode_"), "StockCode"),
            F.concat(F.lit("YearMonth_"), F.date_format("YearMonth", "yyyy-MM")),
        )).alias("indicator"),
    )


def aligned_dummies(train: DataFrame, test: DataFrame) -> DataFrame:
    """Indicators of the test rows that also exist in training; the others are dropped, absent means 0.

    A month's indicator can be on a third of the rows; the known indicators are
    written first, so that the join can split such a key.
    """
    known = stage(dummies(train).select("indicator").distinct(), "indicators")
    return dummies(test).join(known, "indicator", "left_semi").select("StockCode", "YearMonth", "indicator")


def indexed(train: DataFrame, test: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Add ``<column>_index``: the place of the value among those of the training rows, their number if it is new.

    The dictionary is numbered range by range and joined in; it never passes through the driver.
    """
    for column in columns:
        name = f"{column}_index"
        known = stage(with_position(train.select(column).distinct(), column, name=name), name)
        size = F.lit(known.count())
        train, test = [
            part.join(known, column, "left").withColumn(name, F.coalesce(name, size).cast("double")) for part in (train, test)
        ]
    return train, test


def compare_models(train: DataFrame, test: DataFrame, features: Sequence[str] = FEATURES, trees: int = 100,
                   rounds: int = 100, depth: int = 30, boosted_depth: int = 3, iterations: int = 1000,
                   parallelism: int = 3) -> DataFrame:
    """MAE and RMSE of six regressors on the same hold-out.

    StockCode and YearMonth enter one-hot, with one column per value of the
    training rows; a value that these lack is zero in all columns. The single
    tree grows until no split helps; the forest's trees end at ``depth`` and
    the boosted ones at ``boosted_depth`` levels.
    """
    from . import shallow, trees as grown
    from .blocks import fits_by_products, month_name, predicted, with_months

    by_name = train, test
    keys, row = ["StockCode", "month_key"], ["StockCode", "YearMonth"]
    train, test = indexed(
        *[part.withColumn("month_key", F.date_format("YearMonth", "yyyy-MM")) for part in (train, test)], keys
    )
    per_month = train.groupBy("YearMonth").count().orderBy("YearMonth").collect()  # bounded by time
    total = sum(m["count"] for m in per_month)
    months = [m["YearMonth"] for m in per_month]
    counts = grown.ValueCounts.of(train, features)

    def linear() -> dict[str, DataFrame]:
        # least squares and ridge: exact for any number of products
        fits = fits_by_products(by_name[0], features, (LEAST_NORM, 1.0))
        return {name: predicted(fit, by_name[1]) for name, fit in zip(("LinearRegression", "Ridge"), fits, strict=True)}

    def single_tree() -> dict[str, DataFrame]:
        columns, seen = [*features, *map(month_name, months)], with_months(train, months)
        # a month's column is 0 or 1, so its bins follow from its rows
        edges = counts.edges(grown.BINS - 1) | {
            month_name(m["YearMonth"]): [0.0, 1.0] if (total - m["count"]) * (grown.BINS - 1) >= total else [1.0] for m in per_month}
        rows = grown.training_rows(seen, columns, edges, "StockCode_index", row)
        forest = grown.grow_forest(rows, len(columns), trees=1)
        return {"Decision Tree": grown.forest_predictions(forest, with_months(test, months), columns, edges, "StockCode_index", row)
                .withColumnRenamed("value", "Predicted")}

    def lasso() -> dict[str, DataFrame]:
        prepare = Pipeline(stages=[
            OneHotEncoder(inputCols=[f"{c}_index" for c in keys], outputCols=[f"{c}_hot" for c in keys], handleInvalid="keep"),
            VectorAssembler(inputCols=[*features, *[f"{c}_hot" for c in keys]], outputCol="features"),
        ])
        fitted = prepare.fit(train)
        # The estimator makes many passes over the assembled rows.
        ready = stage(fitted.transform(train).select("features", "target"), "model_train")
        held = stage(fitted.transform(test).select("features", "target"), "model_test")
        fit = LinearRegression(labelCol="target", predictionCol="Predicted", standardization=False, maxIter=iterations, regParam=1.0, elasticNetParam=1.0)
        return {"Lasso": fit.fit(ready).transform(held)}

    def several_trees() -> dict[str, DataFrame]:
        edges = {c: shallow.cuts(steps) for c, steps in counts.steps(shallow.STEPS).items()}
        shape = shallow.Shape(len(features), len(months), train.select("StockCode").distinct().where("StockCode IS NOT NULL").count())
        index = [f"{c}_index" for c in keys]
        blocks = shallow.blocks_of(train, features, edges, *index, row, shape)
        models = {
            "Random Forest": shallow.grow_forest(blocks, shape, trees, depth, seed=42),
            "Gradient Boosting": shallow.grow_boosted(blocks, shape, rounds, boosted_depth),
        }
        return {name: shallow.predictions(model, test, features, edges, *index, row) for name, model in models.items()}

    # Independent fits share the cluster, as in a parallel grid search.
    with ThreadPool(parallelism) as pool:
        solved = {name: rows for fits in pool.map(lambda fit: fit(), (single_tree, several_trees, lasso, linear), chunksize=1) for name, rows in fits.items()}
    order = ("LinearRegression", "Ridge", "Decision Tree", "Lasso", "Random Forest", "Gradient Boosting")
    scored = [metrics(solved[name], "Predicted").select(F.lit(name).alias("model"), "MAE", "RMSE") for name in order]
    return reduce(DataFrame.unionByName, scored)


def best_model(comparison: DataFrame) -> DataFrame:
    return comparison.orderBy("RMSE", "model").limit(1)
