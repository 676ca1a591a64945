"""Gradient boosting by a task for each model, against Spark's own fits."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from terrarank.operators import ml
from terrarank.operators.attribution import tree_attribution

NAMES = ["a", "b", "c"]


def design_of(spark, n=500):
    rng = np.random.default_rng(7)
    x = np.stack([rng.normal(size=n), np.where(rng.random(n) < 0.4, 0.0, rng.integers(0, 20, n)), rng.random(n).round(2)], axis=1)
    y = x[:, 0] * 3 + np.where(x[:, 1] > 7, x[:, 2], 0) + rng.normal(0, 0.2, n)
    df = spark.createDataFrame([(i, *map(float, v), float(l)) for i, (v, l) in enumerate(zip(x, y))], "id long, a double, b double, c double, label double")
    return ml.with_fold(VectorAssembler(inputCols=NAMES, outputCol="features").transform(df), "id")


def test_folds_and_refit_are_sparks_in_few_jobs(spark, monkeypatch):
    """Six fits of 15 trees, which Spark makes by a job a level and more; rows without a fold serve the refit only."""
    design = design_of(spark).withColumn("fold", F.when(F.col("id") >= 30, F.col("fold"))).coalesce(1).persist()
    estimator = ml.InFewTasks(GBTRegressor(maxIter=15, stepSize=0.1, maxDepth=3, seed=42))
    sc = spark.sparkContext
    sc.setJobGroup("gradient", "gradient")
    errors, train, model = estimator.cross_validate(design, 5)
    jobs = len(sc.statusTracker().getJobIdsForGroup("gradient"))
    sc._jsc.clearJobGroup()
    monkeypatch.setattr(ml, "GRADIENT_ROWS", 0)  # tables of more rows are fitted by Spark
    wanted, wanted_train, theirs = estimator.cross_validate(design, 5)
    assert np.allclose(errors, wanted, atol=1e-9) and train == pytest.approx(wanted_train, abs=1e-9) and jobs <= 12
    assert np.allclose(model.featureImportances.toArray(), theirs.featureImportances.toArray(), atol=1e-9)
    shown, spark_shown = ([r.prediction for r in m.transform(design).orderBy("id").collect()] for m in (model, theirs))
    assert np.allclose(shown, spark_shown, atol=1e-9)
    rows, expected = tree_attribution(model, design, NAMES, "id")
    sums = rows.toPandas().set_index("id")[NAMES].sum(axis=1).sort_index() + expected
    assert np.allclose(sums, spark_shown)
    design.unpersist()


def test_labels_must_be_there(spark):
    with pytest.raises(Exception, match="Labels MUST NOT be"):
        ml.make_estimator("gradient_boosting").cross_validate(design_of(spark, 40).withColumn("label", F.lit(None).cast("double")), 5)

