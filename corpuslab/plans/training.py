"""Training of the repetition classifiers on (repetitions, sequence length)."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.repetition import training_rows
from ..session import materialize
from . import views

FOLDS = 5
MAX_ITER = 1000


def labelled_cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of every cue; the label says whether a loop was put in."""
    cues = views.cues(spark, sf_dir, looped=True)
    ident = (F.col("conv_id") * 1000 + F.col("turn")).alias("cue_id")
    label = ((F.col("conv_id") + F.col("turn")) % 5 == 0).cast("double").alias("label")
    rows = materialize(cues.select(ident, label, "words"), "labelled-cues")
    features = training_rows(rows, "cue_id", "words")
    return features.join(rows.select("cue_id", "label"), "cue_id")


def folded(rows: DataFrame, folds: int = FOLDS) -> DataFrame:
    """Equal (features, label) rows of a fold as one weighted row.

    The features are two small integers, so the training set shrinks to a few
    rows however many texts stand behind it.
    """
    fold = F.pmod(F.xxhash64("cue_id"), F.lit(folds)).cast("int").alias("fold")
    return rows.groupBy("repetitions", "sequence_length", "label", fold).agg(
        F.count(F.lit(1)).cast("double").alias("weight")
    )


def pipelines(regularization: float, max_iter: int = MAX_ITER) -> dict[str, Pipeline]:
    """Linear SVM, logistic and quadratic logistic pipelines."""
    assemble = VectorAssembler(inputCols=["repetitions", "sequence_length"], outputCol="features")
    squared = PolynomialExpansion(degree=2, inputCol="features", outputCol="squared")
    shared = {"regParam": regularization, "maxIter": max_iter, "tol": 1e-4, "weightCol": "weight"}
    return {
        "linear_svm": Pipeline(stages=[assemble, LinearSVC(**shared)]),
        "logistic": Pipeline(stages=[assemble, LogisticRegression(**shared)]),
        "quadratic": Pipeline(stages=[assemble, squared, LogisticRegression(featuresCol="squared", **shared)]),
    }


def _judge() -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(metricName="accuracy", weightCol="weight")


def fit(rows: DataFrame, name: str, folds: int = FOLDS, cost: float = 1.0, max_iter: int = MAX_ITER):
    """Cross-validate and fit one classifier on weighted rows with a ``fold``:
    (model, mean accuracy over the folds, its deviation)."""
    total = rows.agg(F.sum("weight").alias("w")).first()["w"]
    return _fit(rows, pipelines(1.0 / (cost * max(total or 0.0, 1.0)), max_iter)[name], folds)


def _fit(rows: DataFrame, pipeline: Pipeline, folds: int):
    found = CrossValidator(
        estimator=pipeline,
        estimatorParamMaps=ParamGridBuilder().build(),
        evaluator=_judge(),
        numFolds=folds,
        foldCol="fold",
        collectSubModels=False,
    ).fit(rows)
    return found.bestModel, found.avgMetrics[0], found.stdMetrics[0]


def score_models(rows: DataFrame, max_iter: int = MAX_ITER) -> DataFrame:
    """One row per classifier: cross-validated and training accuracy.  The
    classifiers are fitted side by side."""
    stored = materialize(folded(rows), "training-rows")

    def score(name: str) -> tuple[str, float, float, float]:
        model, mean, deviation = fit(stored, name, max_iter=max_iter)
        return name, float(mean), float(deviation), float(_judge().evaluate(model.transform(stored)))

    names = list(pipelines(1.0))
    with ThreadPoolExecutor(len(names)) as pool:
        out = list(pool.map(score, names))
    return rows.sparkSession.createDataFrame(out, "model string, cv_accuracy double, cv_std double, training_accuracy double")
