"""Regression models from distributed normal equations: Spark ML, and ridge with cross-validation from fold sums."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_linear(df: DataFrame, features: Sequence[str], label: str) -> PipelineModel:
    """OLS via ``solver="normal"``: one distributed pass builds the Gram
    matrix (a tree aggregate of k x k partial sums), then a k x k solve."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="skip")
    lr = LinearRegression(featuresCol="_features", labelCol=label, solver="normal",
                          regParam=0.0, elasticNetParam=0.0)
    return Pipeline(stages=[assembler, lr]).fit(df.dropna(subset=[*features, label]))


def coefficients(model: PipelineModel, features: Sequence[str], df: DataFrame, label: str) -> DataFrame:
    """Coefficient table (term, estimate) plus training-fit metrics as extra
    terms (r2 and rmse come from one shared metrics pass of the summary)."""
    lr = model.stages[-1]
    rows = [("intercept", float(lr.intercept))]
    rows += [(f, float(c)) for f, c in zip(features, lr.coefficients.toArray())]
    if lr.hasSummary:
        summary = lr.summary
        r2, rmse = summary.r2, summary.rootMeanSquaredError
    else:  # a model loaded from storage has no training summary
        preds = model.transform(df.dropna(subset=[*features, label]))
        ev = RegressionEvaluator(labelCol=label, predictionCol="prediction")
        r2, rmse = ev.evaluate(preds, {ev.metricName: "r2"}), ev.evaluate(preds, {ev.metricName: "rmse"})
    rows += [("r2", float(r2)), ("rmse", float(rmse))]
    return df.sparkSession.createDataFrame(rows, "term string, estimate double")


def fold_sums(df: DataFrame, features: Sequence[str], label: str, fold: str) -> tuple[list[float], dict[int, np.ndarray]]:
    """(origin, {fold: matrix of sums of products of (1, features, label)}) in one scan: a row a fold.

    Values are taken from an origin near them (one of the rows), so that the sums of squares keep their digits.
    Rows with a null or not finite value, or without a fold, take no part.
    """
    names = [*features, label]
    rows = df.select(F.col(fold).alias("_fold"), *[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(names)])
    rows = rows.dropna()
    for i in range(len(names)):
        rows = rows.where(F.abs(f"_{i}") < F.lit(float("inf")))  # NaN is above it
    first = rows.first()
    if first is None:
        return [0.0] * len(names), {}
    origin = [first[f"_{i}"] for i in range(len(names))]
    z = [F.lit(1.0), *[F.col(f"_{i}") - F.lit(o) for i, o in enumerate(origin)]]
    cells = [(i, j) for i in range(len(z)) for j in range(i, len(z))]
    out = {}
    for r in rows.groupBy("_fold").agg(*[F.sum(z[i] * z[j]).alias(f"s{i}_{j}") for i, j in cells]).collect():
        m = np.zeros((len(z), len(z)))
        for i, j in cells:
            m[i, j] = m[j, i] = r[f"s{i}_{j}"]
        out[r["_fold"]] = m
    return origin, out


def ridge(sums: np.ndarray, penalty: float) -> np.ndarray:
    """Intercept (about the origin) and weights that minimise squares / n + penalty * weights^2, from sums of
    products; the intercept is free. A singular system gives the least weights."""
    n, mean = sums[0, 0], sums[0] / sums[0, 0]
    centred = sums / n - np.outer(mean, mean)
    a, b = centred[1:-1, 1:-1] + penalty * np.eye(len(sums) - 2), centred[1:-1, -1]
    w = np.linalg.lstsq(a, b, rcond=None)[0]
    return np.concatenate(([mean[-1] - w @ mean[1:-1]], w))


def ridge_cv(df: DataFrame, features: Sequence[str], label: str, fold: str, penalties: Sequence[float]) -> DataFrame:
    """fold, penalty, n, rmse: the error on each fold of a ridge regression fitted on the other folds, for every
    penalty. One scan: the sums without a fold are all less its own, and the squared error of a fold follows
    from its sums. A single fold has nothing to be fitted on: no rows."""
    _, sums = fold_sums(df, features, label, fold)
    total = sum(sums.values()) if sums else None
    rows = []
    for k, own in sorted(sums.items()):
        rest = total - own
        if rest[0, 0] <= 0:
            continue
        for p in penalties:
            w = np.concatenate((ridge(rest, p), [-1.0]))
            rows.append((k, float(p), int(round(own[0, 0])), float(np.sqrt(max(w @ own @ w, 0.0) / own[0, 0]))))
    kind = df.schema[fold].dataType.simpleString()
    return df.sparkSession.createDataFrame(rows, f"fold {kind}, penalty double, n long, rmse double")
