"""Elastic net from sums of products, and histogram boosting, against plain NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrarank.operators import boosting as B
from terrarank.operators import linear as L
from terrarank.operators import ml


def table(spark, n=500, seed=0, nulls=True):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)) * [1, 5, 100, 1]
    x[:, 3] = rng.integers(0, 3, n)
    y = np.sin(x[:, 0]) * 10 + np.where(x[:, 1] > 2, 8, 0) + x[:, 3] + rng.normal(0, 0.3, n)
    rows = []
    for i in range(n):
        a = [None if nulls and (i * 7 + j * 13) % 11 == 0 else float(v) for j, v in enumerate(x[i])]
        rows.append((i, *a, float(y[i])))
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double, label double"), rows


NAMES = ["a", "b", "c", "d"]


# ----------------------------------------------------------------- elastic net
def plain_elastic_net(x, y, alpha=1.0, l1=0.5):
    w, xc, yc = np.zeros(x.shape[1]), x - x.mean(axis=0), y - y.mean()
    for _ in range(3000):
        for j in range(len(w)):
            r = yc - xc @ w + xc[:, j] * w[j]
            rho = xc[:, j] @ r / len(y)
            w[j] = np.sign(rho) * max(abs(rho) - alpha * l1, 0) / (xc[:, j] @ xc[:, j] / len(y) + alpha * (1 - l1))
    return w, y.mean() - x.mean(axis=0) @ w


def test_all_folds_from_one_pass(spark):
    df, rows = table(spark, nulls=False)
    df = ml.with_fold(df.select("id", *[((F.col(c) - 1) / (2 if c == "b" else 1)).alias(c) for c in NAMES], "label"), "id")
    data = df.toPandas()
    held, train, model = L.cross_validate_elastic_net(df, NAMES)
    x, y, fold = data[NAMES].values, data.label.values, data.fold.values
    for k, (rmse, r2) in enumerate(held):
        w, b = plain_elastic_net(x[fold != k], y[fold != k])
        e = y[fold == k] - x[fold == k] @ w - b
        assert rmse == pytest.approx(np.sqrt((e ** 2).mean()), rel=1e-8)
        assert r2 == pytest.approx(1 - (e ** 2).mean() / y[fold == k].var(), abs=1e-9)
    w, b = plain_elastic_net(x, y)
    assert np.allclose(model.weights, w, atol=1e-9) and model.intercept == pytest.approx(b)
    assert train == pytest.approx(1 - ((y - x @ w - b) ** 2).mean() / y.var())
    shown = model.transform(df).select("prediction", *NAMES).toPandas()
    assert np.allclose(shown.prediction, shown[NAMES].values @ w + b)


def test_elastic_net_reads_the_rows_twice_whatever_the_folds(spark):
    """One aggregate for the label's mean, one for the sums of all folds."""
    df, _ = table(spark, nulls=False)
    got = L.products_by_fold(ml.with_fold(df, "id"), [F.col(c) for c in NAMES], F.col("label"))
    assert sum(p.n for p in got.values()) == 500 and len(got) == 5
    first, *rest = got.values()
    total = sum(rest, first)
    assert abs(total.sums[-1]) < 1e-8  # the label is centred


def test_correlated_and_constant_features():
    gram = np.array([[1.0, 1.0, 0.0], [1.0, 1.0, 0.0], [0.0, 0.0, 0.0]])
    w = L.coordinate_descent(gram, np.array([3.0, 3.0, 0.0]))
    assert w[2] == 0 and w[0] == pytest.approx(w[1], abs=1e-6) and w[0] + w[1] == pytest.approx(2.5 / 1.25, abs=1e-6)
    assert L.coordinate_descent(np.eye(2), np.array([0.4, -0.5])).tolist() == [0.0, 0.0]  # below the threshold


# ----------------------------------------------------------------- forest
def test_forest_does_not_depend_on_partitions(spark):
    from pyspark.ml.regression import RandomForestRegressor
    df, _ = table(spark, 300, nulls=False)
    design = ml.design_matrix(df, NAMES, ml.fit_standardizer(df, NAMES), False)
    found = []
    for parts in (1, 16):
        forest = ml.SettledForest(RandomForestRegressor(numTrees=5, maxDepth=4, seed=1), rows_per_task=100)
        found.append(forest.fit(design.repartition(parts)).featureImportances.toArray())
    assert found[0].tolist() == found[1].tolist()


# ----------------------------------------------------------------- boosting
def plain_tree(bins, r, p, cuts):
    """Strict best-first growth, counting after every split."""
    def best(rows):
        out = None
        for f in range(bins.shape[1]):
            for c in range(len(cuts[f])):
                for null_left in (False, True):
                    go = np.where(bins[rows, f] < 0, null_left, bins[rows, f] <= c)
                    n, m = go.sum(), (~go).sum()
                    if min(n, m) < max(p.min_rows, 1):
                        continue
                    x = r[rows]
                    gain = round(x[go].sum() ** 2 / (n + p.l2) + x[~go].sum() ** 2 / (m + p.l2) - x.sum() ** 2 / (len(rows) + p.l2), 6)
                    key = (-gain, f, c, null_left)
                    if gain > 0 and (out is None or key < out[0]):
                        out = key, rows[go], rows[~go]
        return out

    nodes = [np.arange(len(r))]
    depth, split, splits = [0], {0: best(nodes[0])}, []
    while len(splits) + 1 < p.max_leaves:
        live = [(s[0][0], n) for n, s in split.items() if s and depth[n] < p.max_depth]
        if not live:
            break
        n = min(live)[1]
        key, left, right = split.pop(n)
        splits.append((n, *key))
        for part in (left, right):
            split[len(nodes)] = best(part)
            depth.append(depth[n] + 1)
            nodes.append(part)
    out = np.zeros(len(r))
    for n in split:
        out[nodes[n]] = r[nodes[n]].sum() / (len(nodes[n]) + p.l2)
    return splits, out


SMALL = [B.Boosting(rounds=4, max_leaves=7, min_rows=5, rate=0.3), B.Boosting(rounds=3, max_leaves=64, max_depth=3, min_rows=1, l2=1.0)]


@pytest.mark.parametrize("few", [0, 60, 1000])
@pytest.mark.parametrize("p", SMALL)
def test_trees_are_those_of_strict_best_first_growth(spark, monkeypatch, p, few):
    monkeypatch.setattr(B, "FLUSH", 2)
    monkeypatch.setattr(B, "FEW_ROWS", few)  # leaves of at most so many rows are grown from their rows
    df, rows = table(spark, 300)
    cuts = B.bin_cuts(df, NAMES, 12)
    binned = B.with_bins(df, NAMES, cuts)
    got = binned.orderBy("id").collect()
    bins = np.array([r.bins for r in got])
    for f, name in enumerate(NAMES):
        assert bins[:, f].tolist() == [-1 if r[name] is None else int(np.searchsorted(cuts[f], r[name], "left")) for r in got]
    booster = B.fit_boosters(binned.withColumn("model", F.lit(0)).repartition(5), NAMES, cuts, p)[0]
    y = np.array([r.label for r in got])
    at = np.full(len(y), y.mean())
    assert booster.start == pytest.approx(y.mean()) and len(booster.trees) == p.rounds
    for tree in booster.trees:
        splits, value = plain_tree(bins, y - at, p, cuts)
        inner = np.flatnonzero(tree.feature >= 0)
        order = sorted(inner, key=lambda n: tree.left[n])
        assert [(n, tree.feature[n], tree.cut[n], bool(tree.null_left[n])) for n in order] == [(s[0], *s[2:]) for s in splits]
        assert np.allclose(tree.predict(bins), value)
        at += p.rate * value
    shown = booster.transform(df).orderBy("id").toPandas()
    assert np.allclose(shown.prediction, at) and "bins" not in shown


def test_a_tree_takes_a_pass_a_level_that_can_be_split(spark, monkeypatch):
    """Root, its children, theirs: what is known is followed down, and the leaves at the greatest depth are never counted."""
    monkeypatch.setattr(B, "FEW_ROWS", 0)
    monkeypatch.setattr(B, "BLOCK_ROWS", 64)  # several blocks a task
    passes, count = [], B._histograms
    monkeypatch.setattr(B, "_histograms", lambda *a: passes.append(1) or count(*a))
    df, _ = table(spark, 400)
    cuts = B.bin_cuts(df, NAMES, 12)
    p = B.Boosting(rounds=2, max_leaves=8, max_depth=3, min_rows=1, l2=1.0)
    booster = B.fit_boosters(B.with_bins(df, NAMES, cuts).withColumn("model", F.lit(0)), NAMES, cuts, p)[0]
    assert [(t.feature < 0).sum() for t in booster.trees] == [8, 8] and len(passes) <= 2 * 3


def test_models_grow_in_step_as_they_would_alone(spark):
    df, _ = table(spark, 400)
    p = B.Boosting(rounds=3, max_leaves=6, min_rows=10)
    df = ml.with_fold(df, "id")
    held, seen, whole = B.cross_validate_boosting(df, NAMES, p, 5)
    cuts = B.bin_cuts(df, NAMES, p.max_bins)
    alone = B.fit_boosters(B.with_bins(df.where("fold <> 2"), NAMES, cuts).withColumn("model", F.lit(0)), NAMES, cuts, p)[0]
    want = alone.transform(df.where("fold = 2")).toPandas().prediction
    assert np.allclose(sorted(held.where("fold = 2").toPandas().prediction), sorted(want))
    assert held.count() == 400 and seen.count() == 400
    errors, train, model = ml.HistogramBoosting(p).cross_validate(ml.design_matrix(df, NAMES, ml.fit_standardizer(df, NAMES), False), 5)
    assert len(errors) == 5 and 0 < train < 1 and sum(model.importances) == pytest.approx(1)


def test_boosting_learns_and_attributions_add_up(spark):
    from terrarank.operators.attribution import tree_attribution
    df, _ = table(spark, 500, nulls=False)
    design = ml.design_matrix(df, NAMES, ml.fit_standardizer(df, NAMES), False)
    model = ml.HistogramBoosting(B.Boosting(rounds=30, max_leaves=8, min_rows=5)).fit(design)
    shown = model.transform(design).toPandas()
    assert 1 - ((shown.label - shown.prediction) ** 2).mean() / shown.label.var(ddof=0) > 0.9
    rows, expected = tree_attribution(model, design, NAMES, "id")
    sums = rows.toPandas().set_index("id")[NAMES].sum(axis=1) + expected
    assert np.allclose(sums.sort_index().values, shown.sort_values("id").prediction.values)
    imp = ml.importances(model, NAMES, spark).toPandas()
    assert set(imp.feature) == set(NAMES) and imp.iloc[0].importance > 0


@pytest.mark.parametrize("p", [B.Boosting(rounds=3, max_leaves=4, max_depth=2, min_rows=1, l2=1.0), B.Boosting(rounds=2, max_leaves=7, min_rows=5)])
def test_coalitions_equal_the_kernel(spark, p):
    from terrarank.operators.attribution import coalition_attribution, tree_attribution
    df, _ = table(spark, 120, nulls=False)
    cuts = B.bin_cuts(df, NAMES, 16)
    binned = B.with_bins(df, NAMES, cuts)
    model = B.fit_boosters(binned.withColumn("model", F.lit(0)), NAMES, cuts, p)[0]
    want = tree_attribution(model, df, NAMES, "id")[0].toPandas().set_index("id").sort_index()
    got = coalition_attribution(model, binned, "id").toPandas().pivot(index="id", columns="feature", values="attribution").sort_index()
    for c in NAMES:
        assert np.allclose(got[c].fillna(0) if c in got else 0, want[c], atol=1e-10)


def test_degenerate_tables(spark):
    df = spark.createDataFrame([(1, None, 2.0, 5.0), (2, None, 2.0, 7.0)], "id long, a double, b double, label double")
    cuts = B.bin_cuts(df, ["a", "b"], 16)
    assert cuts == [[], []]
    model = B.fit_boosters(B.with_bins(df, ["a", "b"], cuts).withColumn("model", F.lit(0)), ["a", "b"], cuts, B.LEAF_WISE)[0]
    assert {r.prediction for r in model.transform(df).collect()} == {6.0}
    assert B.fit_boosters(B.with_bins(df.limit(0), ["a", "b"], cuts).withColumn("model", F.lit(0)), ["a", "b"], cuts, B.LEAF_WISE) == {}


@pytest.mark.parametrize("p", [B.Boosting(rounds=12, max_leaves=7, min_rows=5, rate=0.3), B.Boosting(rounds=12, max_leaves=64, max_depth=3, min_rows=1, l2=1.0)])
def test_models_of_one_task_are_those_of_passes_over_blocks(spark, monkeypatch, p):
    """Rows without a fold or label serve no model. All rounds of all models take a few jobs, not some for each round."""
    df, _ = table(spark, 300)
    df = ml.with_fold(df, "id").withColumn("fold", F.when(F.col("id") % 50 > 0, F.col("fold"))).withColumn(
        "label", F.when(F.col("id") % 40 > 0, F.col("label"))).persist()
    sc, found = spark.sparkContext, []
    for rows in (B.ONE_TASK_ROWS, 0):
        monkeypatch.setattr(B, "ONE_TASK_ROWS", rows)
        sc.setJobGroup(f"one-task-{rows}", "boosting")
        held, seen, model = B.cross_validate_boosting(df, NAMES, p, 5)
        found.append((len(sc.statusTracker().getJobIdsForGroup(f"one-task-{rows}")), model,
                      *[sorted((str(r.fold), r.label, round(r.prediction, 6)) for r in x.collect()) for x in (held, seen)]))
        sc._jsc.clearJobGroup()
    (jobs, one, *shown), (_, passes, *wanted) = found
    assert shown == wanted and len(shown[0]) == len(shown[1]) > 250 and jobs <= 25
    assert one.start == pytest.approx(passes.start) and len(one.trees) == len(passes.trees) == 12
    for a, b in zip(one.trees, passes.trees):
        for name in ("feature", "cut", "null_left", "left", "right", "rows"):
            assert np.array_equal(getattr(a, name), getattr(b, name)), name
        assert np.allclose(a.value, b.value) and np.allclose(a.gain, b.gain, atol=1e-5)
    df.unpersist()


@pytest.mark.parametrize("few", [0, 60, 1000])
@pytest.mark.parametrize("p", SMALL)
def test_passes_over_blocks_are_best_first_growth_too(spark, monkeypatch, p, few):
    monkeypatch.setattr(B, "ONE_TASK_ROWS", 0)
    test_trees_are_those_of_strict_best_first_growth(spark, monkeypatch, p, few)


def test_passes_over_blocks_take_a_pass_a_level(spark, monkeypatch):
    monkeypatch.setattr(B, "ONE_TASK_ROWS", 0)
    test_a_tree_takes_a_pass_a_level_that_can_be_split(spark, monkeypatch)
