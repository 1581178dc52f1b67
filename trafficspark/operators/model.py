"""Linear and ridge regression on hourly features, their metrics and the datasets behind their plots."""

from __future__ import annotations

from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficspark.functions.scalars import absolute_percentage_error
from trafficspark.operators import ordered
from trafficspark.operators.aggregates import histogram, united

ALPHAS = (0.001, 0.01, 0.1, 1.0, 10.0, 100.0)


def assembled(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error").transform(df)


def fit_ols(df: DataFrame, features: list[str], target: str) -> LinearRegressionModel:
    """Least squares with intercept; adds `prediction` when it transforms a table with a `features` vector."""
    return LinearRegression(featuresCol="features", labelCol=target, solver="normal", regParam=0.0).fit(assembled(df, features))


def fit_ridge(df: DataFrame, features: list[str], target: str, alpha: float) -> LinearRegressionModel:
    """Least squares plus alpha times the squared coefficients (not the intercept)."""
    n, spread = df.agg(F.count(F.lit(1)), F.stddev_pop(target)).first()
    # The solver works on a label divided by its spread and on the mean loss.
    return LinearRegression(featuresCol="features", labelCol=target, solver="normal", elasticNetParam=0.0, standardization=False, regParam=alpha * spread / n).fit(assembled(df, features))


def gram_names(k: int) -> list[str]:
    """Names of the sums behind a fit of k features."""
    return [f"g{i}_{j}" for i, j in combinations_with_replacement(range(k + 2), 2)]


def gram_columns(features: list[str], target: str) -> list:
    """Sums of products of 1, the features and the target: all that a linear fit needs."""
    values = [F.lit(1.0), *(F.col(c).cast("double") for c in [*features, target])]
    return [F.sum(a * b).alias(name) for (a, b), name in zip(combinations_with_replacement(values, 2), gram_names(len(features)), strict=True)]


def gram_matrix(row, k: int) -> np.ndarray:
    """The symmetric (k + 2) matrix from a row of sums."""
    g = np.zeros((k + 2, k + 2))
    for i in range(k + 2):
        for j in range(i, k + 2):
            g[i, j] = g[j, i] = row[f"g{i}_{j}"] or 0.0
    return g


def solve(g: np.ndarray, alpha: float = 0.0) -> tuple[float, np.ndarray]:
    """Intercept and coefficients from a matrix of sums; least norm if it is singular."""
    n = g[0, 0]
    mean = g[0, 1:] / n
    centred = g[1:, 1:] - n * np.outer(mean, mean)
    k = len(centred) - 1
    coefficients = np.linalg.lstsq(centred[:k, :k] + alpha * np.eye(k), centred[:k, k], rcond=1e-12)[0]
    return float(mean[k] - coefficients @ mean[:k]), coefficients


def r2_of(g: np.ndarray, intercept: float, coefficients: np.ndarray) -> float:
    """R² of a fit on the rows behind a matrix of sums."""
    w = np.concatenate(([-intercept], -coefficients, [1.0]))
    total = g[-1, -1] - g[0, -1] ** 2 / g[0, 0]
    return float(1 - (w @ g @ w) / total)


def select_alpha(df: DataFrame, features: list[str], target: str, *, order: str = "hour_start", alphas: tuple[float, ...] = ALPHAS, folds: int = 5) -> DataFrame:
    """alpha, mean_r2, best: mean R² over contiguous folds in order; the best alpha is the first of the highest mean.

    One aggregate gives each fold's sums; what is left of a fold is the total minus its own.
    """
    found = ordered.ordered(df, [order], place="__place")
    ends = np.cumsum([found.n // folds + (i < found.n % folds) for i in range(folds)]).tolist()
    fold = F.coalesce(*(F.when(F.col("__place") <= end, i) for i, end in enumerate(ends)))
    rows = found.rows.withColumn("fold", fold).groupBy("fold").agg(*gram_columns(features, target)).collect()  # one row a fold
    grams = {r["fold"]: gram_matrix(r, len(features)) for r in rows}
    total = sum(grams.values())
    means = [float(np.mean([r2_of(g, *solve(total - g, alpha)) for g in grams.values()])) for alpha in alphas]
    best = int(np.argmax(means))
    return df.sparkSession.createDataFrame([(float(a), m, i == best) for i, (a, m) in enumerate(zip(alphas, means, strict=True))], "alpha double, mean_r2 double, best boolean")


def fits_of_sums(sums: DataFrame, keys: list[str], features: list[str], alpha: float = 0.0) -> DataFrame:
    """keys, term, coefficient of the fit behind each row of sums; rows that sum up nothing have none."""
    kinds = "".join(f"`{k}` {sums.schema[k].dataType.simpleString()}, " for k in keys)

    def fits(batches):
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                if row["g0_0"] > 0:
                    intercept, coefficients = solve(gram_matrix(row, len(features)), alpha)
                    out += [{**{k: row[k] for k in keys}, "term": t, "coefficient": float(c)} for t, c in zip(["intercept", *features], [intercept, *coefficients], strict=True)]
            yield pd.DataFrame(out, columns=[*keys, "term", "coefficient"])

    return sums.mapInPandas(fits, f"{kinds}term string, coefficient double")


def fit_by_key(df: DataFrame, keys: list[str], features: list[str], target: str, alpha: float = 0.0) -> DataFrame:
    """keys, term, coefficient: one fit for each key, all in one job; only each key's sums are shuffled."""
    return fits_of_sums(df.groupBy(*keys).agg(*gram_columns(features, target)), keys, features, alpha)


def scale_population(train: DataFrame, others: list[DataFrame], columns: list[str]) -> list[DataFrame]:
    """train and others with the columns centred and divided by the training rows' population deviation (1 if it is 0)."""
    row = train.agg(*(F.avg(c).alias(f"m_{c}") for c in columns), *(F.stddev_pop(c).alias(f"s_{c}") for c in columns)).first()
    scaled = {c: (F.col(c) - F.lit(row[f"m_{c}"])) / F.lit(row[f"s_{c}"] or 1.0) for c in columns}
    return [df.withColumns(scaled) for df in (train, *others)]


def polynomial_terms(df: DataFrame, columns: list[str]) -> tuple[DataFrame, list[str]]:
    """df with all products of two of the columns (squares included) added, and the names of all terms."""
    pairs = list(combinations_with_replacement(columns, 2))
    products = {f"{a}*{b}": F.col(a) * F.col(b) for a, b in pairs}
    return df.withColumns(products), [*columns, *products]


def regression_metrics(df: DataFrame, *, actual: str, predicted: str, by: str = "split") -> DataFrame:
    """by, n, mae, mape (percent), r2; R² is null if the actual values don't vary."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    total = F.var_pop(y) * F.count(y)
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(y - p)).alias("mae"),
        (100.0 * F.avg(absolute_percentage_error(y, p))).alias("mape"),
        F.when(total > 0, 1 - F.sum((y - p) * (y - p)) / total).alias("r2"),
    )


def compare_models(split: DataFrame, features: list[str], target: str, *, order: str = "hour_start", alpha: float = 1.0) -> DataFrame:
    """model, split, n, mae, mape, r2 of five fits: plain, scaled, ridge, polynomial and polynomial ridge with the selected alpha."""
    train, test = split.where("split = 'train'"), split.where("split = 'test'")
    scaled_train, scaled_test = scale_population(train, [test], features)
    (poly_train, terms), (poly_test, _) = polynomial_terms(scaled_train, features), polynomial_terms(scaled_test, features)
    chosen = select_alpha(poly_train, terms, target, order=order).where("best").first()["alpha"]
    fits = {
        "linear": (fit_ols(train, features, target), train, test, features),
        "linear_scaled": (fit_ols(scaled_train, features, target), scaled_train, scaled_test, features),
        "ridge": (fit_ridge(scaled_train, features, target, alpha), scaled_train, scaled_test, features),
        "polynomial": (fit_ols(poly_train, terms, target), poly_train, poly_test, terms),
        "polynomial_ridge": (fit_ridge(poly_train, terms, target, chosen), poly_train, poly_test, terms),
    }
    told = []
    for name, (model, a, b, columns) in fits.items():
        both = model.transform(assembled(a.unionByName(b), columns))
        told.append(regression_metrics(both, actual=target, predicted="prediction").withColumn("model", F.lit(name)))
    return united(told).select("model", "split", "n", "mae", "mape", "r2")


def best_model(metrics: DataFrame) -> DataFrame:
    """The model of least error on the test rows."""
    return metrics.where("split = 'test'").orderBy("mae", "model").limit(1)


def coefficient_table(model: LinearRegressionModel, names: list[str], spark) -> DataFrame:
    """term, coefficient, intercept last."""
    rows = [*zip(names, (float(c) for c in model.coefficients), strict=True), ("intercept", float(model.intercept))]
    return spark.createDataFrame(rows, "term string, coefficient double")


def coefficient_rank(table: DataFrame) -> DataFrame:
    """Coefficients by size, with their sign."""
    rows = table.where("term <> 'intercept'").withColumn("size", F.abs("coefficient")).withColumn("sign", F.signum("coefficient").cast("int"))
    return rows.orderBy(F.desc("size"), "term")


def forecast_band(df: DataFrame, mape: float, *, predicted: str = "prediction") -> DataFrame:
    """df with lower and upper: the prediction less and plus mape (a share) of itself."""
    return df.withColumns({"lower": F.col(predicted) * (1 - mape), "upper": F.col(predicted) * (1 + mape)})


def residuals(df: DataFrame, *, actual: str, predicted: str = "prediction") -> DataFrame:
    return df.withColumn("residual", F.col(actual) - F.col(predicted))


def residual_histogram(df: DataFrame, bins: int = 20, *, actual: str, predicted: str = "prediction") -> DataFrame:
    return histogram(residuals(df, actual=actual, predicted=predicted), "residual", bins)


def pred_vs_actual(df: DataFrame, *, actual: str, predicted: str = "prediction") -> DataFrame:
    """Pairs with line_low and line_high, the ends of the identity line."""
    pairs = df.select(F.col(actual).cast("double").alias("actual"), F.col(predicted).cast("double").alias("predicted"))
    ends = pairs.agg(F.least(F.min("actual"), F.min("predicted")).alias("line_low"), F.greatest(F.max("actual"), F.max("predicted")).alias("line_high"))
    return pairs.join(F.broadcast(ends))  # one row


def log_training_run(spark, root: str, row: dict) -> None:
    """Append one run's parameters and metrics, as text, to the table of training runs."""
    spark.createDataFrame([(k, str(v)) for k, v in row.items()], "name string, value string").agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("entries")).write.mode("append").parquet(root)


def save_model(model: LinearRegressionModel, features: list[str], path: str) -> None:
    """The assembler and the model, as one pipeline that can be loaded again."""
    PipelineModel([VectorAssembler(inputCols=features, outputCol="features"), model]).write().overwrite().save(path)
