"""Tree SHAP: additivity against Spark's predictions and brute-force Shapley values."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from terrarank.operators.attribution import compile_paths, mean_abs_attribution, shap_values, tree_attribution

FEATS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def design(spark):
    rng = np.random.default_rng(2)
    n = 300
    pdf = pd.DataFrame({"id": np.arange(n), "a": rng.random(n), "b": rng.random(n), "c": rng.integers(0, 3, n) * 1.0})
    pdf["label"] = 3 * pdf.a + (pdf.b > 0.5) * 2 + pdf.a * pdf.c + rng.normal(0, 0.05, n)
    df = spark.createDataFrame(pdf)
    return VectorAssembler(inputCols=FEATS, outputCol="features").transform(df).persist(), pdf


@pytest.mark.parametrize("kind", ["gbt", "rf"])
def test_additivity(spark, design, kind):
    df, _ = design
    est = (GBTRegressor(maxIter=8, maxDepth=3, seed=1) if kind == "gbt"
           else RandomForestRegressor(numTrees=5, maxDepth=4, seed=1))
    model = est.fit(df)
    rows, expected = tree_attribution(model, df, FEATS, "id")
    pred = model.transform(df).select("id", "prediction")
    joined = rows.join(pred, "id").toPandas()
    total = joined[FEATS].sum(axis=1) + expected
    assert np.allclose(total, joined.prediction, atol=1e-9)
    mean_abs = {r.feature: r.mean_abs_shap for r in mean_abs_attribution(rows, FEATS).collect()}
    assert mean_abs["a"] > mean_abs["c"] > 0


def _brute_force(model_paths, x, n_features):
    """Exact path-dependent Shapley values by enumerating feature subsets."""
    def cond_exp(subset):
        # E[f(x) | x_S] under the tree's cover distribution = Σ over leaves of
        # value × Π over path conditions: 1[x follows] if feature in S else z
        total = 0.0
        for value, elems in model_paths:
            w = 1.0
            for feat, conds, z in elems:
                if feat in subset:
                    ok = all((x[feat] <= t) if gl else (x[feat] > t) for t, gl in conds)
                    w *= 1.0 if ok else 0.0
                else:
                    w *= z
            total += value * w
        return total

    phi = np.zeros(n_features)
    for i in range(n_features):
        others = [j for j in range(n_features) if j != i]
        for r in range(len(others) + 1):
            for S in itertools.combinations(others, r):
                wgt = math.factorial(len(S)) * math.factorial(n_features - len(S) - 1) / math.factorial(n_features)
                phi[i] += wgt * (cond_exp(set(S) | {i}) - cond_exp(set(S)))
    return phi


def test_matches_brute_force_shapley(spark, design):
    df, pdf = design
    model = GBTRegressor(maxIter=3, maxDepth=3, seed=3).fit(df)
    paths, _ = compile_paths(model, spark)
    X = pdf[FEATS].to_numpy()[:20]
    fast = shap_values(X, paths, 3)
    for r in range(len(X)):
        assert np.allclose(fast[r], _brute_force(paths, X[r], 3), atol=1e-10)


def test_groups_of_trees_add_up(spark, design):
    """A large ensemble taken in groups of trees gives the same attributions, and leaves no model behind."""
    import os

    from terrarank.session import checkpoint_dir
    df, _ = design
    model = RandomForestRegressor(numTrees=6, maxDepth=3, seed=1).fit(df)
    whole, base = tree_attribution(model, df, FEATS, "id")
    parts, same = tree_attribution(model, df, FEATS, "id", max_nodes=10)
    a, b = (x.toPandas().set_index("id").sort_index() for x in (whole, parts))
    assert abs(base - same) < 1e-9 and np.allclose(a.values, b.values)
    folder = checkpoint_dir(spark).removeprefix("file:")
    assert not [f for f in os.listdir(folder) if f.startswith("tree-model-")]
