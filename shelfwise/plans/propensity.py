"""Next-best-client propensity (L1-L4, M36) with MLlib.

Target: order count at or above the population's median (exact median, a
distributed percentile). Features: loyalty tier one-hot with the first level
(alphabetical) dropped, plus the numeric scorecard columns. The model is the
L2-regularised logistic regression whose optimum equals scikit-learn's default
(C = 1): MLlib averages the loss, so regParam = 1 / n.
"""
from __future__ import annotations

import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

NUMERIC = ["is_cohort_f", "total_units", "total_revenue", "capsule_units"]


def with_target(scorecard: DataFrame, region: str) -> DataFrame:
    """L1: is_high_frequency = n_orders >= median(n_orders) within the region."""
    s = scorecard.where(F.col("home_region") == region)
    med = s.select(F.median("n_orders")).scalar()
    return s.withColumn("is_high_frequency", (F.col("n_orders") >= med).cast("int"))


def fit_propensity(data: DataFrame, max_iter: int = 1000):
    """L2 + L3: tier one-hot (first level dropped) + numerics -> logistic regression.

    The model is written to the shared folder and read back: a fitted one carries its training summary, and with it the
    session, into every task that scores, which fails once anything in the session has used an ``Observation``."""
    n = data.count()
    d = data.withColumn("is_cohort_f", F.col("is_cohort").cast("double"))
    stages = [
        StringIndexer(inputCol="loyalty_tier", outputCol="tier_idx", stringOrderType="alphabetDesc"),
        OneHotEncoder(inputCols=["tier_idx"], outputCols=["tier_oh"], dropLast=True),
        VectorAssembler(inputCols=["tier_oh", *NUMERIC], outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol="is_high_frequency", regParam=1.0 / max(n, 1),
                           elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=1e-10),
    ]
    model = Pipeline(stages=stages).fit(d.withColumn("is_high_frequency", F.col("is_high_frequency").cast("double")))
    path = f"{ensure_checkpoint_dir(data.sparkSession).rstrip('/')}/propensity-{uuid.uuid4().hex}"
    model.write().save(path)
    return PipelineModel.load(path)


def fit_gradient(data: DataFrame, model) -> DataFrame:
    """L3 certificate: one row per weight (the intercept is weight -1) with the gradient of the regularised mean loss at
    the fitted weights, as distributed sums, and the weight's mean absolute feature value, its natural scale.

    The loss is strictly convex in the regularised weights, so a vanishing gradient proves that they are the optimum,
    whatever solver found them."""
    fitted = model.stages[-1]
    scored = model.transform(data.withColumn("is_cohort_f", F.col("is_cohort").cast("double"))
                             .withColumn("is_high_frequency", F.col("is_high_frequency").cast("double")))
    miss = vector_to_array("probability")[1] - F.col("is_high_frequency")
    x = F.concat(F.array(F.lit(1.0)), vector_to_array("features"))
    terms = scored.select(miss.alias("miss"), F.posexplode(x).alias("k", "x"))
    sums = terms.groupBy((F.col("k") - 1).alias("weight")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(F.col("miss") * F.col("x")).alias("loss_gradient"), F.avg(F.abs("x")).alias("scale"))
    weights = data.sparkSession.createDataFrame(
        [(-1, 0.0)] + [(i, float(w)) for i, w in enumerate(fitted.coefficients)], "weight int, w double")  # one row per feature
    lam = fitted.getRegParam()
    return sums.join(F.broadcast(weights), "weight").select(
        "weight", "n_rows", (F.col("loss_gradient") + F.lit(lam) * F.col("w")).alias("gradient"), "scale")


def rank_clients(data: DataFrame, model, n: int = 37) -> DataFrame:
    """L4: clients by propensity, highest first (ties by id), top n."""
    scored = model.transform(data.withColumn("is_cohort_f", F.col("is_cohort").cast("double"))
                             .withColumn("is_high_frequency", F.col("is_high_frequency").cast("double")))
    scored = scored.withColumn("propensity", vector_to_array("probability")[1])
    return (scored.select("customer_id", "loyalty_tier", "is_cohort", "capsule_units", "propensity")
            .orderBy(F.col("propensity").desc(), "customer_id").limit(n))


def outreach_revenue(top: DataFrame, sales: DataFrame, region: str, conversion: float = 0.35) -> DataFrame:
    """N ranked clients × average line revenue in the region × assumed conversion."""
    avg = sales.where(F.col("region_code") == region).agg(F.avg("gross_revenue").alias("avg_order_value"))
    n = top.agg(F.count(F.lit(1)).alias("n_clients"))
    from .analysis import scalars
    row = scalars({"n_clients": n, "avg_order_value": avg})
    return row.withColumn("expected_revenue", F.col("n_clients") * F.col("avg_order_value") * conversion)
