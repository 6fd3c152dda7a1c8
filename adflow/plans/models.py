"""Logistic regression on a survey made from line items."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adflow.operators import model
from adflow.plans.registry import draw_sql, joined, query, table
from adflow.session import stored

SURVEY_SQL = """survey AS (
  SELECT l_orderkey * 8 + l_linenumber AS answer_id,
    CASE WHEN l_quantity + 3 * l_linenumber + l_suppkey % 20 > 45 THEN l_linenumber ELSE 0 END AS affairs,
    CASE WHEN l_linestatus = 'F' THEN 'female' ELSE 'male' END AS gender,
    l_quantity + 17 AS age, l_linenumber + 0.75::DOUBLE AS yearsmarried,
    CASE WHEN l_returnflag = 'R' THEN 'yes' ELSE 'no' END AS children,
    CAST(l_suppkey % 5 + 1 AS DOUBLE) AS religiousness, CAST(l_partkey % 12 + 9 AS DOUBLE) AS education,
    CAST(l_orderkey % 7 + 1 AS DOUBLE) AS occupation, CAST(l_partkey % 5 + 1 AS DOUBLE) AS rating
  FROM lineitem),
encoded AS (
  SELECT answer_id, CASE WHEN affairs > 0 THEN 1 ELSE 0 END AS affairs,
    CASE WHEN gender = 'female' THEN 0 ELSE 1 END AS gender, age, yearsmarried,
    CASE WHEN children = 'yes' THEN 1 ELSE 0 END AS children, religiousness, education, occupation, rating
  FROM survey)"""


TRAINS_SQL = f"{draw_sql('answer_id', 12345)} % 100 < 90"


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity, line = F.col("l_quantity"), F.col("l_linenumber")
    supplier, part = F.col("l_suppkey"), F.col("l_partkey")
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 8 + line).alias("answer_id"),
        F.when(quantity + 3 * line + supplier % 20 > 45, line).otherwise(0).alias("affairs"),
        F.when(F.col("l_linestatus") == "F", "female").otherwise("male").alias("gender"),
        (quantity + 17).alias("age"),
        (line + 0.75).alias("yearsmarried"),
        F.when(F.col("l_returnflag") == "R", "yes").otherwise("no").alias("children"),
        (supplier % 5 + 1).cast("double").alias("religiousness"),
        (part % 12 + 9).cast("double").alias("education"),
        (F.col("l_orderkey") % 7 + 1).cast("double").alias("occupation"),
        (part % 5 + 1).cast("double").alias("rating"),
    )


def halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Training and test rows with features, from a table that is written once: a fit reads it often."""
    encoded = model.encode(survey(spark, sf_dir))
    features = model.assemble(encoded).select("answer_id", "affairs", "features")
    return model.split(stored(features, "survey"), "answer_id")


def fitted(spark: SparkSession, sf_dir: str) -> tuple[LogisticRegressionModel, DataFrame]:
    """A fit run until no more digits change that are shown."""
    train, test = halves(spark, sf_dir)
    return model.fit_logistic(train, tol=1e-13, maxIter=500), test


@query("ml_encode", f"WITH {SURVEY_SQL} SELECT * FROM encoded")
def ml_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.encode(survey(spark, sf_dir))


@query(
    "ml_assemble",
    f"""WITH {SURVEY_SQL}
SELECT answer_id, concat_ws(',', gender, CAST(age AS BIGINT), CAST(yearsmarried * 100 AS BIGINT), children,
  CAST(religiousness AS BIGINT), CAST(education AS BIGINT), CAST(occupation AS BIGINT), CAST(rating AS BIGINT))
  AS features FROM encoded""",
)
def ml_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    assembled = model.assemble(model.encode(survey(spark, sf_dir)))
    # Whole numbers, the third in hundredths, so that text is the same in any engine.
    numbers = F.transform(
        vector_to_array("features"), lambda x, i: F.when(i == 2, x * 100).otherwise(x).cast("bigint")
    )
    return assembled.select("answer_id", joined(numbers).alias("features"))


@query(
    "ml_split",
    f"""WITH {SURVEY_SQL}
SELECT answer_id, affairs, CASE WHEN {TRAINS_SQL} THEN 'train' ELSE 'test' END AS side FROM encoded""",
)
def ml_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = halves(spark, sf_dir)
    train = train.select("answer_id", "affairs", F.lit("train").alias("side"))
    return train.unionByName(test.select("answer_id", "affairs", F.lit("test").alias("side")))


def newton_sql(steps: int = 10) -> str:
    """SQL for the maximum-likelihood coefficients by Newton's method, as ``beta`` with b0 to b8, the intercept last.

    Each step sums the gradient and the upper half of the Hessian over the
    training rows and solves the equations by elimination and substitution.
    """
    n = len(model.FEATURES) + 1
    xs = [*(f"CAST({name} AS DOUBLE) AS x{i}" for i, name in enumerate(model.FEATURES)), f"1.0::DOUBLE AS x{n - 1}"]
    parts = [
        f"train AS (SELECT CAST(affairs AS DOUBLE) AS y, {', '.join(xs)} FROM encoded WHERE {TRAINS_SQL})",
        "beta0 AS (SELECT " + ", ".join(f"0.0::DOUBLE AS b{i}" for i in range(n)) + ")",
    ]
    score = " + ".join(f"b{i} * x{i}" for i in range(n))
    upper = [(i, j) for i in range(n) for j in range(i, n)]
    for step in range(steps):
        sums = [f"sum(p * (1 - p) * x{i} * x{j}) AS a{i}_{j}" for i, j in upper]
        sums += [f"sum((y - p) * x{i}) AS g{i}" for i in range(n)]
        parts.append(
            f"e{step}_0 AS (SELECT {', '.join(sums)} FROM (SELECT *, 1 / (1 + exp(-({score}))) AS p FROM train, beta{step}))"
        )
        for k in range(n - 1):
            cells = [f"a{i}_{j} - a{k}_{i} * a{k}_{j} / a{k}_{k} AS a{i}_{j}" if i > k else f"a{i}_{j}" for i, j in upper]
            cells += [f"g{i} - a{k}_{i} * g{k} / a{k}_{k} AS g{i}" if i > k else f"g{i}" for i in range(n)]
            parts.append(f"e{step}_{k + 1} AS (SELECT {', '.join(cells)} FROM e{step}_{k})")
        for i in reversed(range(n)):
            known = "".join(f" - a{i}_{j} * d{j}" for j in range(i + 1, n))
            source = f"d{step}_{i + 1}" if i < n - 1 else f"e{step}_{n - 1}"
            parts.append(f"d{step}_{i} AS (SELECT *, (g{i}{known}) / a{i}_{i} AS d{i} FROM {source})")
        moved = ", ".join(f"b{i} + d{i} AS b{i}" for i in range(n))
        parts.append(f"beta{step + 1} AS (SELECT {moved} FROM beta{step}, d{step}_0)")
    parts.append(f"beta AS (SELECT * FROM beta{steps})")
    return ",\n".join(parts)


NEWTON_SQL = f"{SURVEY_SQL},\n{newton_sql()}"
SCORE_SQL = " + ".join([*(f"b{i} * {name}" for i, name in enumerate(model.FEATURES)), f"b{len(model.FEATURES)}"])
TERMS = [*model.FEATURES, "intercept"]


@query(
    "ml_fit_logistic",
    f"WITH {NEWTON_SQL}\n"
    + " UNION ALL ".join(f"SELECT '{t}' AS term, round(b{i}, 3) + 0.0 AS coefficient FROM beta" for i, t in enumerate(TERMS)),
)
def ml_fit_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = model.coefficients(spark, fitted(spark, sf_dir)[0])
    return found.select("term", (F.round("coefficient", 3) + 0.0).alias("coefficient"))


@query(
    "ml_params",
    """SELECT 0.0::DOUBLE AS elastic_net, 0.0::DOUBLE AS reg, true AS standardization, 0.5::DOUBLE AS threshold,
  1e-6::DOUBLE AS tol, 100 AS max_iter""",
)
def ml_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parameters of a fit that names none."""
    return model.model_params(spark, model.fit_logistic(halves(spark, sf_dir)[0]))


@query(
    "ml_predict",
    f"""WITH {NEWTON_SQL},
scored AS (
  SELECT answer_id, 1 / (1 + exp(-({SCORE_SQL}))) AS p FROM encoded, beta WHERE NOT ({TRAINS_SQL}))
SELECT answer_id, round(p, 2) + 0.0 AS probability, CASE WHEN p > 0.5 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction
FROM scored""",
)
def ml_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained, test = fitted(spark, sf_dir)
    likely = vector_to_array("probability")[1]
    scored = model.predict(trained, test, ["answer_id"])
    return scored.select("answer_id", (F.round(likely, 2) + 0.0).alias("probability"), "prediction")


@query(
    "ml_summary",
    f"""WITH {NEWTON_SQL},
share AS (SELECT avg(y) AS p FROM train),
losses AS (
  SELECT -avg(y * ln(q) + (1 - y) * ln(1 - q)) AS loss
  FROM (SELECT y, 1 / (1 + exp(-({" + ".join(f"b{i} * x{i}" for i in range(len(TERMS)))}))) AS q FROM train, beta))
SELECT 'first' AS iteration, round(-(p * ln(p) + (1 - p) * ln(1 - p)), 6) AS loss FROM share
UNION ALL SELECT 'last', round(loss, 6) FROM losses""",
)
def ml_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loss before the first and after the last iteration."""
    history = model.objective_history(spark, fitted(spark, sf_dir)[0])
    ends = history.agg(
        F.min_by("loss", "iteration").alias("first"), F.max_by("loss", "iteration").alias("last")
    )
    rows = F.array(*[F.struct(F.lit(n).alias("iteration"), F.round(n, 6).alias("loss")) for n in ("first", "last")])
    return ends.select(F.inline(rows))
