"""Boosted-tree classifier on Spark ML."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from vitalgrid.config import ID_COLUMN, TARGET_COLUMN, TreeParams
from vitalgrid.operators.features import Encoder, serving_table
from vitalgrid.operators.scoring import Scorer
from vitalgrid.session import shared_dir


def train(
    table: DataFrame,
    features: list[str],
    target: str = TARGET_COLUMN,
    params: TreeParams = TreeParams(),
) -> PipelineModel:
    """Fit on a table of numeric features. MLlib checkpoints its residuals to the
    shared folder, so that a lost executor does not replay every earlier tree."""
    shared_dir(table.sparkSession)
    assembler = VectorAssembler(inputCols=features, outputCol="features")
    trees = GBTClassifier(
        featuresCol="features",
        labelCol=target,
        lossType="logistic",
        maxIter=params.max_iter,
        stepSize=params.step_size,
        maxDepth=params.max_depth,
        subsamplingRate=params.subsampling_rate,
        featureSubsetStrategy=params.feature_subset,
        seed=params.seed,
        checkpointInterval=10,
        maxMemoryInMB=1024,
    )
    return Pipeline(stages=[assembler, trees]).fit(table)


def feature_names(model: PipelineModel) -> list[str]:
    """The features a model was trained with, in order."""
    return list(model.stages[0].getInputCols())


def score(model: PipelineModel, table: DataFrame) -> DataFrame:
    """Add the probability of the positive class as ``score``."""
    out = model.transform(table)
    return out.withColumn("score", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


def serving_scorer(
    model: PipelineModel, expected: list[str], encoder: Encoder, key: str = ID_COLUMN
) -> Scorer:
    """Raw rows under file column names to ``patient_id`` and ``score``; the same
    for a table and for a micro-batch. ``encoder`` is that of the training."""

    def scorer(rows: DataFrame) -> DataFrame:
        scored = score(model, serving_table(rows, expected, encoder, keep=(key,)))
        return scored.select(F.col(f"`{key}`").alias("patient_id"), "score")

    return scorer


def area_under_roc(scored: DataFrame, target: str = TARGET_COLUMN, column: str = "score") -> float | None:
    """Exact area: one curve point per distinct score, counted before the sort. None
    where the rows are not of both classes."""
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol=column, labelCol=target, metricName="areaUnderROC", numBins=0
    )
    typed = scored.select(F.col(f"`{target}`").cast("double").alias(target), F.col(column))
    least, most = typed.agg(F.min(f"`{target}`"), F.max(f"`{target}`")).first()
    return None if least == most else evaluator.evaluate(typed)


def evaluation(scored: DataFrame, target: str = TARGET_COLUMN, column: str = "score") -> DataFrame:
    """The area as a one-row table."""
    value = area_under_roc(scored, target, column)
    return scored.sparkSession.range(1).select(F.lit(value).cast("double").alias("auc"))


def save(model: PipelineModel, path: str, encoder: Encoder) -> None:
    """The model, and the levels it was trained with beside it."""
    model.write().overwrite().save(path)
    spark = SparkSession.getActiveSession()
    text = spark.range(1).select(F.lit(encoder.to_json()).alias("value"))
    text.coalesce(1).write.mode("overwrite").text(f"{path.rstrip('/')}/encoder")


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_encoder(spark: SparkSession, path: str) -> Encoder:
    stored = spark.read.option("wholetext", True).text(f"{path.rstrip('/')}/encoder")
    return Encoder.from_json(stored.first().value)
