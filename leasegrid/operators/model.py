"""Encoders, boosted trees, search and metrics."""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leasegrid.functions.numbers import finite, log_or_zero
from leasegrid.operators.clean import group_mode
from leasegrid.operators.quantiles import exact_median

# --- preparation ------------------------------------------------------------------


def preprocessor(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], extra: Sequence[str] = (), output: str = "features"
) -> list:
    """Stages: median fill, most-frequent fill, one-hot (unknown -> zeros), assembled vector."""
    stages = []
    if numeric:
        stages.append(Imputer(strategy="median", inputCols=list(numeric), outputCols=[f"{c}__i" for c in numeric]))
    if categorical:
        fills = []
        for c in categorical:
            mode = group_mode(train, c, name="m").first()
            text = "" if mode is None or mode[0] is None else str(mode[0]).replace("\\", "\\\\").replace("'", "\\'")
            fills.append(f"COALESCE(CAST(`{c}` AS STRING), '{text}') AS `{c}__f`")
        stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(fills)} FROM __THIS__"))
        stages.append(
            StringIndexer(inputCols=[f"{c}__f" for c in categorical], outputCols=[f"{c}__x" for c in categorical], handleInvalid="keep")
        )
        # The "keep" slot is the last category, which dropLast encodes as zeros.
        stages.append(
            OneHotEncoder(inputCols=[f"{c}__x" for c in categorical], outputCols=[f"{c}__o" for c in categorical], dropLast=True)
        )
    inputs = [f"{c}__i" for c in numeric] + [f"{c}__o" for c in categorical] + list(extra)
    stages.append(VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid="keep"))
    return stages


def spread_rows(df: DataFrame, most: int = 50_000) -> DataFrame:
    """The rows in partitions of about ``most`` rows at most, unchanged if they are no longer already.

    Trees keep every row's bins in memory, partition by partition, and a file
    split of a well compressed table can hold any number of rows.
    """
    sizes = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).agg(F.max("n").alias("largest"), F.sum("n").alias("all")).first()
    return df if (sizes["largest"] or 0) <= most else df.repartition(math.ceil(sizes["all"] / most))


def target_encoding(train: DataFrame, column: str, target: str) -> tuple[DataFrame, Column]:
    """(value, encoding) table and the scalar overall mean, shrunk by empirical Bayes.

    weight = var(y) n / (var(y) n + var(y | value)); unseen values take the mean.
    """
    known = train.where(F.col(target).isNotNull())
    whole = known.agg(F.struct(F.avg(target).alias("m"), F.var_pop(target).alias("v")).alias("s")).scalar()
    per = known.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count("*").alias("n"), F.avg(target).alias("m"), F.var_pop(target).alias("v")
    )
    prior = known.agg(F.avg(target)).scalar()
    spread = F.col("__s.v") * F.col("n")
    weight = F.coalesce(F.try_divide(spread, spread + F.col("v")), F.lit(1.0))
    table = per.withColumn("__s", whole).select(
        column, (weight * F.col("m") + (1 - weight) * F.col("__s.m")).alias(f"{column}_encoded")
    )
    return table, prior


def apply_target_encoding(df: DataFrame, table: DataFrame, column: str, prior: Column) -> DataFrame:
    name = f"{column}_encoded"
    return df.join(table, column, "left").withColumn(name, F.coalesce(F.col(name), prior))


def log_features(df: DataFrame, target: str = "median_rent", lags: Sequence[str] = (), lag: str = "spatial_lag") -> DataFrame:
    """log_ columns of the target, its lags and the spatial lag; rows without them dropped."""
    out = df.withColumns(
        {f"log_{c}": finite(F.log(c)) for c in (target, *lags)} | {f"log_{lag}": log_or_zero(F.col(lag))}
    )
    return out.na.drop(subset=[f"log_{c}" for c in (target, *lags)])


# --- boosted trees and search --------------------------------------------------------


def boosted_trees(label: str, features: str = "features", validation: str | None = None, **params) -> GBTRegressor:
    """Boosted regression trees: rate 0.05, depth 6, 80 % rows and columns per tree."""
    defaults = {"maxIter": 1000, "stepSize": 0.05, "maxDepth": 6, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8", "seed": 42}
    model = GBTRegressor(labelCol=label, featuresCol=features, **{**defaults, **params})
    return model.setValidationIndicatorCol(validation) if validation else model


class OriginalScaleRmse(Evaluator):
    """RMSE after expm1 of label and prediction (smaller is better)."""

    def __init__(self, label: str, prediction: str = "prediction", log_target: bool = True):
        super().__init__()
        self.label, self.prediction, self.log_target = label, prediction, log_target

    def _evaluate(self, dataset: DataFrame) -> float:
        f = F.expm1 if self.log_target else (lambda c: c)
        gap = f(F.col(self.label)) - f(F.col(self.prediction))
        return float(dataset.agg(F.sqrt(F.avg(gap * gap))).first()[0])

    def isLargerBetter(self) -> bool:
        return False


def random_search(
    train: DataFrame, pipeline: Pipeline, model: GBTRegressor, space: Mapping[str, Sequence], evaluator: Evaluator, n_iter: int = 20, folds: int = 5, seed: int = 42, parallelism: int = 4
):
    """Randomised search: ``n_iter`` sampled settings, k-fold cross-validated. A setting drawn again is not fitted again."""
    rng = random.Random(seed)
    drawn = dict.fromkeys(tuple(rng.choice(list(v)) for v in space.values()) for _ in range(n_iter))
    grid = [{model.getParam(k): v for k, v in zip(space, setting)} for setting in drawn]
    cv = CrossValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds, seed=seed, parallelism=parallelism)
    return cv.fit(train)


def importances(model: PipelineModel, scored: DataFrame, top_k: int = 20, features: str = "features") -> DataFrame:
    """Top feature importances with column names from the vector's metadata."""
    attrs = scored.schema[features].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a.get("name", str(a["idx"])) for group in attrs.values() for a in group}
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(names.get(i, str(i)), float(v)) for i, v in enumerate(weights)]
    table = scored.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(top_k)


def save_model(model: Transformer, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# --- metrics --------------------------------------------------------------------------


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: str | None = None) -> DataFrame:
    """rmse, mae, median_ae, r2, mape, smape in one aggregate plus an exact median."""
    y, p = F.col(actual), F.col(predicted)
    base = df.where(y.isNotNull() & p.isNotNull()).withColumn("__e", F.abs(p - y))
    e = F.col("__e")
    aggs = [
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(e).alias("mae"),
        (1 - F.try_divide(F.avg(e * e), F.var_pop(y))).alias("r2"),
        F.avg(e / F.greatest(F.abs(y), F.lit(2.220446049250313e-16))).alias("mape"),
        F.avg(2 * e / (F.abs(y) + F.abs(p) + F.lit(1e-12))).alias("smape"),
    ]
    if by is None:
        middle = exact_median(base, "__e", name="m").scalar()
        return base.agg(*aggs).withColumn("median_ae", middle)
    return base.groupBy(by).agg(*aggs).join(exact_median(base, "__e", [by], "median_ae"), by)


def generalisation_gap(metrics: DataFrame, split: str = "split", train: str = "train", test: str = "test") -> DataFrame:
    pick = lambda s: F.max(F.when(F.col(split) == s, F.col("r2")))
    return metrics.agg((pick(train) - pick(test)).alias("r2_gap"))
