"""Churn model on the customer features."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.operators.medallion import FEATURES

# The model's iterations and the weight C of the data against the L2 penalty.
MAX_ITER = 200
C = 1.0


def train_churn(features: DataFrame, max_iter: int = MAX_ITER, c: float = C) -> PipelineModel:
    """Logistic regression of ``churned``; each iteration is one distributed aggregate.

    The penalty is that of a loss summed over rows and weighed by ``c``, on the features as they are.
    """
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    model = LogisticRegression(featuresCol="features", labelCol="churned", maxIter=max_iter,
                               regParam=1.0 / (c * max(1, features.count())), standardization=False)
    return Pipeline(stages=[assembler, model]).fit(features)


def score_churn(model: PipelineModel, features: DataFrame) -> DataFrame:
    """The model's probability to six places, and what it predicts: 1 where that probability is above the threshold.

    The coefficients are put into a plain expression. The model's own transform carries its training summary and with it the
    session to the tasks, which fails once an Observation has been used in that session.
    """
    assembler, logistic = model.stages
    margin = F.lit(float(logistic.intercept))
    for column, weight in zip(assembler.getInputCols(), logistic.coefficients.toArray(), strict=True):
        margin = margin + F.lit(float(weight)) * F.col(column).cast("double")
    scored = features.withColumn("churn_probability", F.round(1 / (1 + F.exp(-margin)), 6))
    return scored.select(
        "customer_id", "churned",
        (F.col("churn_probability") > logistic.getThreshold()).cast("int").alias("predicted"),
        "churn_probability",
    )
