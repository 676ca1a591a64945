"""Random forests: whole trees against Spark's, branches against whole tables, and the query's fits."""

import re

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from terrarank.operators import forest as R
from terrarank.operators import ml
from terrarank.operators.attribution import tree_attribution

NAMES = ["a", "b", "c"]


def design_of(spark, n=400, seed=5, twice=False):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, [5, 20, 32], (n, 3))
    y = x[:, 0] * 3.0 + np.where(x[:, 1] > 7, x[:, 2], 0) + rng.normal(size=n)
    rows = [(i, *map(float, v), float(l)) for i, (v, l) in enumerate(zip(x, y))] * (2 if twice else 1)
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, label double")
    return ml.with_fold(VectorAssembler(inputCols=NAMES, outputCol="features").transform(df), "id"), x, y


def test_one_tree_is_sparks(spark):
    design, x, y = design_of(spark)
    cuts = R.forest_cuts(design, NAMES, 32)
    assert [len(c) for c in cuts] == [4, 19, 31]  # between all values
    bins = np.stack([np.searchsorted(c, x[:, i]) for i, c in enumerate(cuts)]).astype("<i2")
    tree = R.grow(bins, y, np.ones(len(y), int), 6)
    wanted = DecisionTreeRegressor(maxDepth=6).fit(design.coalesce(1)).transform(design.coalesce(1)).orderBy("id").toPandas().prediction
    assert np.allclose(tree.predict(bins), wanted, atol=1e-9)


def test_cuts_are_sparks_where_one_value_is_half_the_rows(spark):
    """A value of many rows takes no other value's cuts."""
    rng = np.random.default_rng(3)
    x = np.where(rng.random(500) < 0.5, 0.0, rng.normal(size=500).round(3))
    df = VectorAssembler(inputCols=["a"], outputCol="features").transform(
        spark.createDataFrame([(float(v), float(l)) for v, l in zip(x, rng.normal(size=500))], "a double, label double")).coalesce(1)
    nodes = DecisionTreeRegressor(maxDepth=20).fit(df)
    used = {float(t) for t in re.findall(r"feature 0 <= (\S+?)\)", nodes.toDebugString)}
    cuts = R.forest_cuts(df, ["a"], 32)[0]
    assert len(used) > 20 and all(min(abs(c - u) for c in cuts) < 1e-9 for u in used)
    assert len(R.stride_cuts(*np.unique(x, return_counts=True), 32)) == len(cuts) > 25


def test_draws_are_poisson_and_follow_only_number_model_and_tree():
    numbers = np.arange(50_000) + (3 << 33)
    got = [R.draws(numbers, 42, m, t) for m in (-1, 0) for t in (0, 1)]
    assert all(abs(w.mean() - 1) < 0.03 and abs(w.var() - 1) < 0.05 for w in got)
    assert np.abs(np.corrcoef(got) - np.eye(4)).max() < 0.03
    assert (R.draws(numbers[::-1], 42, 0, 1)[::-1] == got[3]).all()


def test_branches_finished_apart_give_the_same_forest(spark):
    """Tables above the bound are split by histograms first; the trees are those of a table that is below it."""
    design, _, _ = design_of(spark)
    p = R.Forest(trees=6, max_depth=9, seed=1)
    found = []
    for branch_rows in (10_000, 60):
        held, seen, model = R.cross_validate_forest(design, NAMES, p, 5, 100, branch_rows)
        found.append((sorted((r.fold, r.label, round(r.prediction, 9)) for r in held.collect()),
                      sorted((r.label, round(r.prediction, 9)) for r in seen.collect()), model))
    assert found[0][:2] == found[1][:2] and len(found[0][0]) == len(found[0][1]) == 400
    whole, apart = found[0][2], found[1][2]
    assert [len(t.feature) for t in whole.trees] == [len(t.feature) for t in apart.trees]
    assert np.allclose(whole.featureImportances.toArray(), apart.featureImportances.toArray())
    for model in (whole, apart):  # the model of all rows predicts what the cross-validation reported
        got = sorted((r.label, round(r.prediction, 9)) for r in model.transform(design).collect())
        assert got == found[0][1]


def test_folds_are_held_out_and_rows_without_a_fold_serve_the_refit_only(spark):
    design, _, y = design_of(spark)
    marked = design.withColumn("label", F.when(F.col("id") < 40, F.col("label") + 1e6).otherwise(F.col("label"))).withColumn(
        "fold", F.when(F.col("id") < 40, F.lit(None)).otherwise(F.col("fold")).cast("int"))
    held, seen, _ = R.cross_validate_forest(marked, NAMES, R.Forest(trees=4, max_depth=5), 5, 100)
    rows = held.collect()
    assert len(rows) == 360 and max(abs(r.prediction) for r in rows) < 1000  # no fold's model has seen the marked rows
    assert seen.count() == 400 and seen.agg(F.max("prediction")).first()[0] > 10_000


def test_equal_rows_have_draws_of_their_own(spark):
    design, _, _ = design_of(spark, twice=True)
    blocks = R.blocks_of(design, NAMES, R.forest_cuts(design, NAMES, 32), 100).collect()
    numbers = np.concatenate([b["first"] + np.arange(len(b.label) // 8) for b in blocks])
    assert len(numbers) == len(set(numbers.tolist())) == 800


def test_forest_is_as_good_as_sparks_in_few_jobs(spark):
    """Five folds and the refit of 30 trees: Spark's forest takes a job a level and group of nodes, which grew with the rows."""
    design, _, _ = design_of(spark, 800)
    design = design.persist()
    preset = RandomForestRegressor(numTrees=30, featureSubsetStrategy="all", maxDepth=15, seed=42)
    sc = spark.sparkContext
    sc.setJobGroup("forest", "forest")
    errors, train, model = ml.SettledForest(preset, 400).cross_validate(design, 5)
    jobs = len(sc.statusTracker().getJobIdsForGroup("forest"))
    sc._jsc.clearJobGroup()
    assert jobs <= 40
    wanted = []
    for k in range(5):
        fit = preset.fit(design.where(F.col("fold") != k))
        wanted += ml._fold_errors(fit.transform(design.where(F.col("fold") == k)).select("fold", "label", "prediction"))
    assert np.mean([e[0] for e in errors]) == pytest.approx(np.mean([e[0] for e in wanted]), rel=0.1)
    assert train > 0.97 and hasattr(ml.make_estimator("random_forest"), "cross_validate")
    design.unpersist()


def test_attribution_adds_up_to_the_forest(spark):
    design, _, _ = design_of(spark, 120)
    model = ml.SettledForest(RandomForestRegressor(numTrees=3, maxDepth=4, seed=1), 100).fit(design)
    rows, expected = tree_attribution(model, design, NAMES, "id")
    predicted = {r.id: r.prediction for r in model.transform(design).collect()}
    for r in rows.collect():
        assert r.a + r.b + r.c + expected == pytest.approx(predicted[r.id])


def test_labels_must_be_there(spark):
    design, _, _ = design_of(spark, 40)
    with pytest.raises(Exception, match="Labels MUST NOT be"):
        ml.SettledForest(RandomForestRegressor(numTrees=2, maxDepth=2), 100).fit(design.withColumn("label", F.lit(None).cast("double")))


@pytest.mark.parametrize("level_rows", [1, 40, 400])
def test_large_trees_grown_node_by_node_are_the_same(level_rows):
    rng = np.random.default_rng(2)
    bins = rng.integers(0, [[5], [20], [32]], (3, 900)).astype(np.uint8)
    y = bins[0] * 3.0 + np.where(bins[1] > 7, bins[2], 0) + rng.normal(size=900)
    times = rng.poisson(1, 900)
    for depth in (0, 1, 4, 12):
        want, got = R.grow(bins, y, times, depth), R.grow_whole(bins, y, times, depth, level_rows)
        assert len(want.feature) == len(got.feature) and np.allclose(want.predict(bins), got.predict(bins))
        assert sorted(zip(want.feature, want.cut, want.rows)) == sorted(zip(got.feature, got.cut, got.rows))
        assert np.allclose(sorted(want.gain), sorted(got.gain))


def test_whole_tables_are_read_where_they_lie(spark, monkeypatch):
    """No row is sent: a shuffle of the rows once every few trees grew with the number of trees."""
    design, _, _ = design_of(spark)
    p = R.Forest(trees=6, max_depth=5)
    cuts, blocks, n = R._prepared(design, NAMES, p, 100)
    found, _ = R._finished(blocks, n, 3, range(6), 5, p, (1000, 1000), "predictions")
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString() and found.rdd.getNumPartitions() == 3 + 2  # two trees a task, and two with nothing to do
    want = sorted(found.collect())
    monkeypatch.setattr(R, "LOT_ROWS", 400)  # as many trees in one task as keep what is predicted below it
    found, _ = R._finished(blocks, n, 3, range(6), 5, p, (1000, 1000), "predictions")
    assert found.rdd.getNumPartitions() == 1 + 2

    def sums(rows):
        out = {}
        for r in rows:
            out[r.row] = out.get(r.row, 0.0) + r.held + r.seen
        return out

    got, want = sums(found.collect()), sums(want)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    model = R.ForestModel(blocks, n, NAMES, cuts, p, 5, (1000, 1000))
    whole = np.zeros(3)
    for t in model.trees:
        own = np.bincount(t.feature[t.feature >= 0], t.gain[t.feature >= 0], 3)
        whole += own / own.sum()
    assert np.allclose(model.featureImportances.toArray(), whole / whole.sum())
