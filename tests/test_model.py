from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from adflow import jobs
from adflow.functions.numbers import draw_unit
from adflow.operators import model


def answers(spark, n: int = 400):
    """Survey answers in which age and rating drive the outcome."""
    i = F.col("id")
    u = [draw_unit(i, seed) for seed in range(1, 9)]
    df = spark.range(n).select(
        i.alias("answer_id"),
        F.when(u[0] < 0.5, "female").otherwise("male").alias("gender"),
        F.floor(u[1] * 40 + 20).cast("double").alias("age"),
        F.round(u[2] * 15, 2).alias("yearsmarried"),
        F.when(u[3] < 0.6, "yes").otherwise("no").alias("children"),
        F.floor(u[4] * 5 + 1).cast("double").alias("religiousness"),
        F.floor(u[5] * 12 + 9).cast("double").alias("education"),
        F.floor(u[6] * 7 + 1).cast("double").alias("occupation"),
        F.floor(u[7] * 5 + 1).cast("double").alias("rating"),
    )
    score = 0.1 * F.col("age") - 0.8 * F.col("rating") - 1 + (draw_unit(F.col("answer_id"), 99) - 0.5) * 6
    return df.withColumn("affairs", F.when(score > 0, 3.0).otherwise(0.0))


def newton(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Maximum-likelihood coefficients, intercept last."""
    x = np.hstack([x, np.ones((len(x), 1))])
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        beta += np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]), x.T @ (y - p))
    return beta


def test_encoding(spark):
    rows = [(0.0, "male", "no"), (2.0, "female", "yes")]
    got = model.encode(spark.createDataFrame(rows, "affairs double, gender string, children string")).collect()
    assert [tuple(r) for r in got] == [(0, 1, 0), (1, 0, 1)]


def test_fit_agrees_with_newton(spark):
    encoded = model.encode(answers(spark)).cache()
    fitted = model.fit_logistic(model.assemble(encoded))
    rows = encoded.select(*model.FEATURES, "affairs").collect()
    data = np.array([[float(v) for v in r] for r in rows])
    expected = newton(data[:, :-1], data[:, -1])
    got = [r["coefficient"] for r in model.coefficients(spark, fitted).collect()]
    assert got == pytest.approx(expected.tolist(), abs=1e-3)
    assert got[1] > 0 > got[7]
    losses = [r["loss"] for r in model.objective_history(spark, fitted).orderBy("iteration").collect()]
    assert losses[-1] < losses[0]
    assert model.model_params(spark, fitted).first().asDict() == {
        "elastic_net": 0.0, "reg": 0.0, "standardization": True, "threshold": 0.5, "tol": 1e-6, "max_iter": 100,
    }
    scored = model.predict(fitted, model.assemble(encoded))
    assert scored.columns == ["features", "rawPrediction", "probability", "prediction"]
    right = sum(r["prediction"] == y for r, y in zip(scored.collect(), data[:, -1]))
    assert right / len(data) > 0.65


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    train, test = model.split(df, "k")
    again, _ = model.split(df.repartition(9), "k")
    assert train.count() + test.count() == 5000 and abs(test.count() - 500) < 80
    assert {r["k"] for r in train.collect()} == {r["k"] for r in again.collect()}


def test_survey_job(spark, folder):
    source, target = folder("survey"), folder("fitted")
    columns = [c.split()[0] for c in jobs.SURVEY.split(", ")]
    answers(spark).select(*columns).write.csv(source, sep="\t")
    jobs.survey(spark, source, target)
    assert spark.read.parquet(f"{target}/coefficients").count() == 9
    assert 10 < spark.read.parquet(f"{target}/scored").count() < 90


def test_scores_after_an_observation(spark):
    seen = Observation()
    spark.range(3).observe(seen, F.count("*").alias("n")).collect()
    assert seen.get["n"] == 3
    rows = model.assemble(model.encode(answers(spark)))
    fitted = model.fit_logistic(rows)
    assert model.predict(fitted, rows, ["answer_id"]).count() == 400
    scores = model.predict(fitted, rows, ["answer_id"]).collect()
    assert {r["prediction"] for r in scores} == {0.0, 1.0}
