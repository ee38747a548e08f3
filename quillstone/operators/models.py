"""Modelling studies on Spark ML: preparation, weighted logistic regression with folds, importance and coefficients."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.functions.hashing import md5_bucket
from quillstone.operators.evaluate import log_loss, weighted_auc

RARE = "<rare>"


def require_predictors(columns: list[str], allowed: list[str], forbidden: list[str]) -> None:
    """Raises if a predictor isn't allowed or is forbidden."""
    if bad := sorted((set(columns) - set(allowed)) | (set(columns) & set(forbidden))):
        raise ValueError(f"predictors that may not be used: {bad}")


def prepare(df: DataFrame, numeric: list[str], categorical: list[str], least: int = 20) -> DataFrame:
    """df with <c>__missing for numeric columns, and categories of fewer than `least` rows, or null, pooled.

    Frequent categories are found by one aggregation per column and joined back, so no list of categories reaches the driver.
    """
    out = df.withColumns({f"{c}__missing": F.col(c).isNull().cast("double") for c in numeric} | {c: F.col(c).cast("double") for c in numeric})
    for c in categorical:
        common = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= least).select(F.col(c).alias("__c"))
        out = out.join(common, F.col(c) == F.col("__c"), "left").withColumn(c, F.coalesce("__c", F.lit(RARE))).drop("__c")
    return out


def stages(numeric: list[str], categorical: list[str]) -> list:
    """Median imputation, scaling without centring, one-hot encoding of all categories."""
    full = [f"{c}__full" for c in numeric]
    index, hot = [f"{c}__i" for c in categorical], [f"{c}__v" for c in categorical]
    out: list = []
    if numeric:
        out += [Imputer(strategy="median", inputCols=numeric, outputCols=full), VectorAssembler(inputCols=full, outputCol="__raw"), StandardScaler(inputCol="__raw", outputCol="__scaled", withMean=False)]
    if categorical:
        out += [StringIndexer(inputCols=categorical, outputCols=index, handleInvalid="keep"), OneHotEncoder(inputCols=index, outputCols=hot, dropLast=False)]
    parts = (["__scaled"] if numeric else []) + [f"{c}__missing" for c in numeric] + hot
    return [*out, VectorAssembler(inputCols=parts, outputCol="features")]


def fit(df: DataFrame, numeric: list[str], categorical: list[str], label: str, weight: str, c: float) -> PipelineModel:
    """A weighted L2 logistic regression; c is the inverse penalty on the weighted sum of losses. Raises if it doesn't converge."""
    total = df.agg(F.sum(weight)).first()[0]
    lr = LogisticRegression(labelCol=label, weightCol=weight, regParam=1 / (c * total), elasticNetParam=0.0, standardization=False, maxIter=200, tol=1e-8)
    model = Pipeline(stages=[*stages(numeric, categorical), lr]).fit(df)
    summary = model.stages[-1].summary
    if summary.totalIterations >= 200:
        raise RuntimeError("the regression did not converge")
    return model


def scored(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).withColumn("score", vector_to_array("probability")[1])


def choose(df: DataFrame, numeric: list[str], categorical: list[str], key: str, label: str, weight: str, grid: tuple[float, ...] = (0.1, 1.0, 10.0), folds: int = 3) -> tuple[float, dict[float, float]]:
    """The inverse penalty of least weighted log loss over hash folds, and all losses."""
    parts = df.withColumn("__fold", md5_bucket(F.col(key).cast("string"), folds))
    losses = {}
    for c in grid:
        total = 0.0
        for k in range(folds):
            model = fit(parts.where(F.col("__fold") != k), numeric, categorical, label, weight, c)
            total += log_loss(scored(model, parts.where(F.col("__fold") == k)), label, "score", F.col(weight)).first()["log_loss"]
        losses[c] = total / folds
    return min(losses, key=losses.get), losses


def metrics(rows: DataFrame, label: str, weight: str) -> DataFrame:
    """One row: ROC-AUC, average precision, log loss, Brier score."""
    return weighted_auc(rows, label, "score", F.col(weight)).crossJoin(log_loss(rows, label, "score", F.col(weight)))  # one row each


def calibration(rows: DataFrame, label: str, weight: str) -> tuple[float, float]:
    """Intercept and slope of the label on the score's log odds."""
    p = F.least(F.greatest("score", F.lit(1e-12)), F.lit(1 - 1e-12))
    odds = VectorAssembler(inputCols=["__o"], outputCol="__f").transform(rows.select(label, weight, F.log(p / (1 - p)).alias("__o")))
    m = LogisticRegression(labelCol=label, weightCol=weight, featuresCol="__f", standardization=False).fit(odds)
    return float(m.intercept), float(m.coefficients[0])


def permutation_importance(model: PipelineModel, df: DataFrame, groups: dict[str, list[str]], key: str, label: str, weight: str, seed: int) -> dict[str, float]:
    """Loss of ROC-AUC when a group of columns is dealt to other rows: rows are ranked by two hashes and joined rank to rank."""
    base = weighted_auc(scored(model, df), label, "score", F.col(weight)).first()["roc_auc"]
    rank = lambda rows, salt: rows.orderBy(F.xxhash64(F.col(key), F.lit(salt)), key).rdd.zipWithIndex().map(lambda r: (*r[0], r[1])).toDF([*rows.columns, "__r"])
    out = {}
    for name, columns in groups.items():
        other = rank(df.select(key, *columns), seed).drop(key)
        mine = rank(df.drop(*columns), seed + 1)
        moved = mine.join(other, "__r").drop("__r").select(*df.columns)
        out[name] = base - weighted_auc(scored(model, moved), label, "score", F.col(weight)).first()["roc_auc"]
    return out


def odds_ratios(model: PipelineModel, numeric: list[str]) -> dict[str, float]:
    """Odds ratio of one unit of each numeric column: the scaled coefficient divided by the column's deviation."""
    import math

    scaler = next(s for s in model.stages if type(s).__name__ == "StandardScalerModel")
    coefficients = model.stages[-1].coefficients
    return {c: math.exp(float(coefficients[i]) / float(scaler.std[i])) if scaler.std[i] else 1.0 for i, c in enumerate(numeric)}


def sample_identity(df: DataFrame, key: str) -> DataFrame:
    """One row: rows and an order-free fingerprint of the keys, to tell whether two samples are the same."""
    h = F.sha2(F.col(key).cast("string"), 256)
    parts = [F.sum(F.conv(F.substring(h, at, 8), 16, 10).cast("decimal(20,0)")).alias(f"s{i}") for i, at in enumerate((1, 9, 17, 25))]
    return df.agg(F.count(F.lit(1)).alias("n"), *parts).select("n", F.sha2(F.concat_ws(",", "n", "s0", "s1", "s2", "s3"), 256).alias("fingerprint"))
