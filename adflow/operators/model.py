"""Binary logistic regression: encode, assemble, split, fit, score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adflow.functions.numbers import draw_below
from adflow.session import fresh_folder

# Survey columns.
FEATURES = (
    "gender",
    "age",
    "yearsmarried",
    "children",
    "religiousness",
    "education",
    "occupation",
    "rating",
)


def encode(survey: DataFrame) -> DataFrame:
    """Survey answers as numbers; other columns pass."""
    return survey.withColumns(
        {
            "affairs": F.when(F.col("affairs") > 0, 1).otherwise(0),
            "gender": F.when(F.col("gender") == "female", 0).otherwise(1),
            "children": F.when(F.col("children") == "yes", 1).otherwise(0),
        }
    )


def assemble(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Feature columns as one vector column."""
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(df)


def split(df: DataFrame, key: str, seed: int = 12345, train_percent: int = 90) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by a random draw per key.

    The same key falls on the same side whatever the partitioning.
    """
    trains = draw_below(F.col(key), seed, 100) < train_percent
    return df.where(trains), df.where(~trains)


def random_split(df: DataFrame, seed: int = 12345, train_share: float = 0.9) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by Spark's own split, which depends on the partitioning."""
    train, test = df.randomSplit([train_share, 1 - train_share], seed)
    return train, test


def fit_logistic(train: DataFrame, label: str = "affairs", **params) -> LogisticRegressionModel:
    """Fit with default parameters unless told otherwise."""
    return LogisticRegression(labelCol=label, featuresCol="features", **params).fit(train)


def coefficients(spark: SparkSession, model: LogisticRegressionModel, features: Sequence[str] = FEATURES) -> DataFrame:
    """One row per feature and one for the intercept."""
    rows = [(name, float(c)) for name, c in zip(features, model.coefficients)]
    return spark.createDataFrame([*rows, ("intercept", float(model.intercept))], "term string, coefficient double")


def model_params(spark: SparkSession, model: LogisticRegressionModel) -> DataFrame:
    """The parameters a model was fitted with, as one row."""
    row = (
        model.getElasticNetParam(),
        model.getRegParam(),
        model.getStandardization(),
        model.getThreshold(),
        model.getTol(),
        model.getMaxIter(),
    )
    schema = (
        "elastic_net double, reg double, standardization boolean, threshold double, tol double, max_iter int"
    )
    return spark.createDataFrame([row], schema)


def predict(model: LogisticRegressionModel, test: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Scores of test rows, next to columns that tell the rows apart.

    A fitted model sends its training summary, and the session with it, to each
    task, which fails once the session has observed a table; a stored model has none.
    """
    folder = fresh_folder(test.sparkSession, "model")
    model.write().save(folder)
    return LogisticRegressionModel.load(folder).transform(test).select(*keep, "features", "rawPrediction", "probability", "prediction")


def objective_history(spark: SparkSession, model: LogisticRegressionModel) -> DataFrame:
    """Loss per iteration."""
    rows = [(i, float(loss)) for i, loss in enumerate(model.summary.objectiveHistory)]
    return spark.createDataFrame(rows, "iteration int, loss double")
