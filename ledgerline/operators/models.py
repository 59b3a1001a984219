"""Learners as MLlib pipelines, and the tables that describe what they learned."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PolynomialExpansion, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.regression import LinearRegression
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.util import inheritable_thread_target

from ledgerline.operators.evaluation import regression_metrics
from ledgerline.operators.quantiles import iqr_fences
from ledgerline.operators.series import time_blocks
from ledgerline.tables import materialise


class PreviousStep(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Baseline that predicts the last seen value."""

    @keyword_only
    def __init__(self, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._setDefault(outputCol="prediction")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), F.col(self.getInputCol()).cast("double"))


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error").transform(df)


def fit(estimator: Estimator, df: DataFrame, features: Sequence[str]) -> PipelineModel:
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), estimator]).fit(df)


def error_row(model: Model, df: DataFrame, label: str, /, **tags) -> DataFrame:
    """Regression metrics of a model on a frame, tagged."""
    m = regression_metrics(model.transform(df), label, "prediction").select("n", "mae", "rmse", "r2")
    return m.select(*[F.lit(v).alias(k) for k, v in tags.items()], "*")


def stack_rows(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def named_values(df: DataFrame, names: Sequence[str], values: Sequence[float], value: str) -> DataFrame:
    """(feature, value): as many rows as the model has features."""
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return df.sparkSession.createDataFrame(rows, f"feature string, {value} double")


def polynomial(estimator: Estimator, df: DataFrame, features: Sequence[str], degree: int = 2) -> PipelineModel:
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="flat"),
            PolynomialExpansion(degree=degree, inputCol="flat", outputCol="features"),
            estimator,
        ]
    ).fit(df)


def expanding_cv(build, grid: Sequence[Mapping], df: DataFrame, ts: str, features: Sequence[str], label: str, folds: int) -> DataFrame:
    """(params..., cv_mae) of every grid point over growing training windows."""
    cut = materialise(time_blocks(assemble(df, features).select(ts, "features", label), ts, folds), "blocks")
    parts = []
    for params in grid:
        errors = []
        for k in range(1, folds + 1):
            model = build(**params).fit(cut.where(F.col("block") < k))
            scored = model.transform(cut.where(F.col("block") == k))
            errors.append(scored.agg(F.avg(F.abs(F.col(label) - F.col("prediction"))).alias("mae")))
        mean = stack_rows(errors).agg(F.avg("mae").alias("cv_mae"))
        parts.append(mean.select(*[F.lit(v).alias(p) for p, v in params.items()], "cv_mae"))
    return stack_rows(parts)


def out_of_fold(make: Callable[[], Estimator], df: DataFrame, fold: str, folds: int, parallelism: int = 4) -> DataFrame:
    """Every row once, with the prediction of a model that was fitted on the other folds.

    ``fold`` numbers the rows from 0 to ``folds`` - 1. ``df`` holds what the estimator reads; write it before, since
    each fold reads it. Fits run side by side, ``parallelism`` at a time. Rows with a null fold are left out.
    """

    def run(k: int) -> DataFrame:
        return make().fit(df.where(F.col(fold) != k)).transform(df.where(F.col(fold) == k))

    with ThreadPool(min(parallelism, folds)) as pool:
        return stack_rows(pool.map(inheritable_thread_target(df.sparkSession)(run), range(folds)))


def _moment_points(n: float, first: np.ndarray, second: np.ndarray) -> list[tuple[float, list[float], float]]:
    """(label, features, weight) of a few points with exactly the count, means and covariances of rows (features, label).

    From the sums of the rows and of their products: a point on each side of the mean for every direction.
    """
    mean = first / n
    spread = second / n - np.outer(mean, mean)
    scale = np.sqrt(np.maximum(np.diag(spread), 0))
    known = np.where(scale > 0, scale, 1.0)
    values, vectors = np.linalg.eigh(spread / np.outer(known, known))
    steps = known[:, None] * vectors * np.sqrt(np.maximum(values, 0) * len(mean))
    return [(float(z[-1]), z[:-1].tolist(), float(n) / (2 * len(mean))) for step in steps.T for z in (mean + step, mean - step)]


def linear_grid_cv(df: DataFrame, label: str, grid: Sequence[Mapping], folds: int, seed: int = 42, parallelism: int = 4) -> list[float]:
    """Cross-validated RMSE of the linear model at every grid point, in one pass over the rows.

    A linear fit, plain or regularised, and its squared error depend on the rows only by their count, means and
    covariances. These are added up per fold, and each fit and error is taken from those of its folds: the models are
    those of a fit on the rows themselves. ``df`` is a stored table with a ``features`` vector; rows without a label
    are an error.
    """
    spark, z = df.sparkSession, F.concat(vector_to_array("features"), F.array(F.col(label).cast("double")))
    width = len(df.select(z.alias("z")).first()["z"])
    rows = df.select(z.alias("z"), F.floor(F.rand(seed) * folds).cast("int").alias("fold"))
    cells = [(i, j) for i in range(width) for j in range(i + 1)]
    sums = [F.sum(F.col("z")[i]).alias(f"s{i}") for i in range(width)] + [F.sum(F.col("z")[i] * F.col("z")[j]).alias(f"p{i}_{j}") for i, j in cells]
    found = {r["fold"]: r for r in rows.groupBy("fold").agg(F.count("*").alias("n"), F.count(F.col("z")[width - 1]).alias("labels"), *sums).collect()}
    if any(r["n"] != r["labels"] for r in found.values()):
        raise ValueError(f"rows without {label}")
    n, first, second = np.zeros(folds), np.zeros((folds, width)), np.zeros((folds, width, width))
    for k, r in found.items():
        n[k], first[k] = r["n"], [r[f"s{i}"] for i in range(width)]
        for i, j in cells:
            second[k, i, j] = second[k, j, i] = r[f"p{i}_{j}"]

    def error(job: tuple[Mapping, int]) -> float:
        params, k = job
        points = [(y, Vectors.dense(x), w) for y, x, w in _moment_points(n.sum() - n[k], first.sum(0) - first[k], second.sum(0) - second[k])]
        shown = spark.createDataFrame(points, StructType().add(label, "double").add("features", VectorUDT()).add("w", "double")).coalesce(1)
        model = linear(label, weightCol="w", **params).fit(shown)
        v = np.append(-model.coefficients.toArray(), 1.0)
        square = (v @ second[k] @ v - 2 * model.intercept * (v @ first[k])) / n[k] + model.intercept**2
        return float(np.sqrt(max(square, 0.0)))

    jobs = [(params, k) for params in grid for k in range(folds)]
    with ThreadPool(parallelism) as pool:
        errors = pool.map(inheritable_thread_target(spark)(error), jobs)
    return [float(np.mean(errors[i * folds : (i + 1) * folds])) for i in range(len(grid))]


def best_point(runs: DataFrame, params: Sequence[str]) -> dict:
    """The grid point with the lowest error; the run table has one row per point."""
    return runs.orderBy("cv_mae", *params).first().asDict()


def segment(df: DataFrame, features: Sequence[str], k: int, seed: int = 42):
    data = assemble(df, features)
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="segment").fit(data)
    return model, model.transform(data).drop("features")


class Fences(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Fixed fences of two columns: ``outlier`` is -1 beyond only the second, -2 only the first, -3 both, else 0."""

    columns = Param(Params._dummy(), "columns", "the two columns", TypeConverters.toListString)
    bounds = Param(Params._dummy(), "bounds", "low and high of the first, then of the second", TypeConverters.toListFloat)

    def __init__(self) -> None:
        super().__init__()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        low_a, high_a, low_b, high_b = self.getOrDefault(self.bounds)
        a, b = (~F.col(c).between(lo, hi) for c, lo, hi in zip(self.getOrDefault(self.columns), (low_a, low_b), (high_a, high_b), strict=True))
        return dataset.withColumn("outlier", F.when(a & b, -3).when(a, -2).when(b, -1).otherwise(0))


class OutlierFirst(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """The cluster of a row inside the fences, the outlier label of one beyond."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn("segment", F.when(F.col("outlier") != 0, F.col("outlier")).otherwise(F.col("cluster")))


def segment_inliers(df: DataFrame, features: Sequence[str], fenced: Sequence[str], k: int, seed: int = 42) -> PipelineModel:
    """Fences from all rows, scaling and clusters from the rows inside them, as one pipeline for new rows.

    ``df`` is a stored table. The pipeline adds ``outlier`` and ``segment``: a cluster from 0 to ``k`` - 1, or -1 to -3.
    """
    ends = iqr_fences(df, fenced, stored=True)
    row = df.limit(1).select(*[edge.alias(f"{c}{i}") for c, pair in ends.items() for i, edge in enumerate(pair)]).first()
    fences = Fences()._set(columns=list(fenced), bounds=[float(x) for x in row])
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="flat"),
        StandardScaler(inputCol="flat", outputCol="features", withMean=True),
        KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster"),
    ]
    inside = Pipeline(stages=stages).fit(fences.transform(df).where("outlier = 0"))
    return PipelineModel([fences, *inside.stages, OutlierFirst()])


def segment_sweep(df: DataFrame, features: Sequence[str], ks: Sequence[int], seed: int = 42) -> list[tuple[int, float, float]]:
    """(k, within-cluster cost, silhouette) for every k."""
    data = materialise(assemble(df, features).select("features"), "sweep")
    judge = ClusteringEvaluator(featuresCol="features", predictionCol="segment")
    rows = []
    for k in ks:
        model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="segment").fit(data)
        rows.append((k, float(model.summary.trainingCost), float(judge.evaluate(model.transform(data)))))
    return rows


def probability(df: DataFrame, out: str = "p", col: str = "probability") -> DataFrame:
    return df.withColumn(out, vector_to_array(col)[1])


def logistic(label: str, weight: str | None = None, **params) -> LogisticRegression:
    lr = LogisticRegression(featuresCol="features", labelCol=label, **params)
    return lr.setWeightCol(weight) if weight else lr


def linear(label: str, **params) -> LinearRegression:
    return LinearRegression(featuresCol="features", labelCol=label, **params)


def linear_attributions(df: DataFrame, coefficients: Mapping[str, float]) -> DataFrame:
    """(feature, attribution): mean of |coefficient * (x - mean x)|, exact for a linear model."""
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in coefficients]).alias("m")).scalar()
    parts = [F.avg(F.abs(F.lit(float(b)) * (F.col(c) - means.getField(c)))).alias(c) for c, b in coefficients.items()]
    row = df.agg(*parts)
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("attribution")) for c in coefficients])
    return row.select(F.inline(cells))


def score_batch(model: Model, df: DataFrame, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Predictions as whole non-negative numbers, written to the shared folder and read back.

    Rows with a missing feature stop the job: they point at a broken feature table.
    """
    holes = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in features]).first().asDict()
    broken = {c: n for c, n in holes.items() if n}
    if broken:
        raise ValueError(f"missing feature values: {broken}")
    scored = model.transform(df).select(*keys, F.round(F.greatest("prediction", F.lit(0.0)), 0).cast("int").alias("predicted"))
    return materialise(scored, "predictions")
