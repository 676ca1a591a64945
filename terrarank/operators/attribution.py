"""Tree SHAP attribution for Spark tree ensembles (path-dependent TreeSHAP,
Lundberg, Erion & Lee 2018) as a Spark job.

* the fitted ensemble is written to the shared checkpoint folder and its node
  table is read back with Spark (one row per node; bounded by model size);
* each tree becomes root→leaf paths (feature, threshold, direction, cover
  fraction); repeated features on a path are merged, as in the published
  path formulation, so a path has at most (#features + 1) elements;
* ``mapInPandas`` evaluates every row of a batch at once: the EXTEND / UNWIND
  recursions run over NumPy vectors of the batch's rows, one path at a time;
* Spark aggregates mean |attribution| per feature.

Additivity holds: Σ attributions + expected value = the model's prediction.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrarank.operators.boosting import Booster
from terrarank.operators.forest import ForestModel
from terrarank.session import checkpoint_dir, cut_lineage
from terrarank.sources.sinks import remove_dataset


MAX_NODES = 200_000  # nodes compiled on the driver and broadcast at once


NODE = ("treeID int, id int, prediction double, impurityStats array<double>, leftChild int, rightChild int, featureIndex int, "
        "threshold double")


def _own_nodes(model: Booster, session) -> DataFrame:
    """A booster's nodes in the same form; they are on the driver already."""
    rows = []
    for n, t in enumerate(model.trees):
        for i in range(len(t.feature)):
            leaf = t.feature[i] < 0
            rows.append((n, i, float(t.value[i]), [float(t.rows[i])], -1 if leaf else int(t.left[i]), -1 if leaf else int(t.right[i]),
                         int(t.feature[i]), None if leaf else float(model.cuts[t.feature[i]][t.cut[i]])))
    return session.createDataFrame(rows, NODE)


def _saved_nodes(model, session) -> tuple[DataFrame, str | None]:
    """The node data of a tree ensemble, read from its saved form, and where that lies."""
    if isinstance(model, Booster):
        return _own_nodes(model, session), None
    if isinstance(model, ForestModel):
        return model.nodes(session), None
    path = f"{checkpoint_dir(session).rstrip('/')}/tree-model-{uuid.uuid4().hex}"
    model.write().overwrite().save(path)
    return session.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.impurityStats",
        "nodeData.leftChild", "nodeData.rightChild", "nodeData.split.featureIndex",
        F.try_element_at("nodeData.split.leftCategoriesOrThreshold", F.lit(1)).alias("threshold"),
    ), path


def _groups(nodes: DataFrame, max_nodes: int) -> list[list[int]]:
    """Trees in groups of at most ``max_nodes`` nodes (a single larger tree is a group of its own)."""
    groups: list[list[int]] = []
    held = 0
    for r in sorted(nodes.groupBy("treeID").count().collect(), key=lambda r: r.treeID):  # one row a tree
        if not groups or held + r["count"] > max_nodes:
            groups.append([])
            held = 0
        groups[-1].append(r.treeID)
        held += r["count"]
    return groups


def _tree_maps(nodes: DataFrame, ids: Sequence[int]) -> list[tuple[int, dict]]:
    """(tree id, node map) of the given trees."""
    found = nodes.where(F.col("treeID").isin(list(ids))).toPandas()
    out = []
    for tid in sorted(found.treeID.unique()):
        t = found[found.treeID == tid]
        out.append((int(tid), {int(r.id): (int(r.leftChild), int(r.rightChild), int(r.featureIndex),
                                           float(r.threshold) if r.threshold is not None else 0.0,
                                           float(r.prediction), float(r.impurityStats[0]))
                               for r in t.itertuples()}))
    return out


def _paths(tree: dict) -> list[tuple[float, float, list]]:
    """Leaves as (value, cover fraction, [(feature, threshold, goes_left, z)])."""
    out = []
    root_cover = tree[0][5]
    stack = [(0, [])]
    while stack:
        nid, conds = stack.pop()
        left, right, feat, thr, pred, cover = tree[nid]
        if left < 0:
            out.append((pred, cover / root_cover if root_cover else 0.0, conds))
            continue
        for child, goes_left in ((left, True), (right, False)):
            z = tree[child][5] / cover if cover else 0.0
            stack.append((child, conds + [(feat, thr, goes_left, z)]))
    return out


def _scales(model) -> list[float]:
    """What each tree's prediction is multiplied by in the ensemble's."""
    if isinstance(model, Booster):
        return [model.params.rate] * len(model.trees)
    if isinstance(model, ForestModel):
        return [1.0 / len(model.trees)] * len(model.trees)
    weights = [float(w) for w in model.treeWeights]
    return [w / len(weights) if type(model).__name__.startswith("RandomForest") else w for w in weights]


def _compiled(trees: Sequence[tuple[int, dict]], scales: Sequence[float]) -> tuple[list, float]:
    flat, expected = [], 0.0
    for tid, tree in trees:
        for value, frac, conds in _paths(tree):
            v = value * scales[tid]
            expected += v * frac
            merged: dict[int, list] = {}
            for feat, thr, goes_left, z in conds:
                merged.setdefault(feat, []).append((thr, goes_left, z))
            flat.append((v, [(feat, [(t, g) for t, g, _ in cs], float(np.prod([z for _, _, z in cs])))
                             for feat, cs in merged.items()]))
    return flat, expected


def compile_paths(model, session) -> tuple[list, float]:
    """Model → flat list of weighted paths and the expected value (all trees at once: for small models)."""
    nodes, path = _saved_nodes(model, session)
    scales = _scales(model)
    trees = _tree_maps(nodes, list(range(len(scales))))
    if path:
        remove_dataset(session, path)
    flat, expected = _compiled(trees, scales)
    return flat, expected + getattr(model, "start", 0.0)


def shap_values(X: np.ndarray, paths: list, n_features: int) -> np.ndarray:
    """Path-dependent TreeSHAP for every row of ``X`` (rows vectorised)."""
    n = X.shape[0]
    phi = np.zeros((n, n_features))
    for value, elems in paths:
        d = len(elems)
        if d == 0:
            continue
        zs = [1.0] + [e[2] for e in elems]
        os_ = [np.ones(n)]
        for feat, conds, _ in elems:
            o = np.ones(n)
            x = X[:, feat]
            for thr, goes_left in conds:
                o = o * ((x <= thr) if goes_left else (x > thr))
            os_.append(o)
        # EXTEND over the root dummy + d elements
        w = [np.ones(n)]
        for l in range(1, d + 1):
            z, o = zs[l], os_[l]
            w.append(np.zeros(n))
            for i in range(l - 1, -1, -1):
                w[i + 1] = w[i + 1] + o * w[i] * (i + 1) / (l + 1)
                w[i] = z * w[i] * (l - i) / (l + 1)
        L = d  # index of the last element
        for k in range(1, d + 1):
            z, o = zs[k], os_[k]
            total = np.zeros(n)
            next_one = w[L].copy()
            safe_o = np.where(o != 0, o, 1.0)
            for j in range(L - 1, -1, -1):
                tmp = next_one * (L + 1) / ((j + 1) * safe_o)
                alt = (w[j] / z) / ((L - j) / (L + 1)) if z != 0 else np.zeros(n)
                total = total + np.where(o != 0, tmp, alt)
                next_one = np.where(o != 0, w[j] - tmp * z * (L - j) / (L + 1), next_one)
            phi[:, elems[k - 1][0]] += total * (o - z) * value
    return phi


def tree_attribution(model, design: DataFrame, features: Sequence[str], key: str,
                     max_nodes: int = MAX_NODES) -> tuple[DataFrame, float]:
    """Per-row attributions (key, one column per feature) and the expected value.

    Attributions add up over trees, so a large ensemble is taken in groups of
    trees with at most ``max_nodes`` nodes: each group is compiled, broadcast and
    added to what the rows hold so far, which is kept between groups.
    """
    spark = design.sparkSession
    feats = list(features)
    sums = [f"phi_{i}" for i in range(len(feats))]
    rows = design.select(F.col(key).alias("key"), F.array(*[F.col(f"`{c}`").cast("double") for c in feats]).alias("x"),
                         *[F.lit(0.0).alias(s) for s in sums])
    schema = rows.schema
    nodes, path = _saved_nodes(model, spark)
    scales, expected = _scales(model), getattr(model, "start", 0.0)
    groups = _groups(nodes, max_nodes)
    for n, ids in enumerate(groups):
        paths, part = _compiled(_tree_maps(nodes, ids), scales)
        expected += part
        shared = spark.sparkContext.broadcast(paths)

        def run(batches, shared=shared):
            for pdf in batches:
                if len(pdf):
                    X = np.stack(pdf["x"].to_numpy()).astype(float)
                    pdf[sums] = pdf[sums].to_numpy() + shap_values(X, shared.value, len(feats))
                yield pdf

        rows = rows.mapInPandas(run, schema)
        if n + 1 < len(groups):
            rows = cut_lineage(rows)
    if path:
        remove_dataset(spark, path)
    return rows.select(F.col("key").alias(key), *[F.col(s).alias(c) for s, c in zip(sums, feats)]), expected


def mean_abs_attribution(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, mean_abs_shap), largest first — one aggregate."""
    wide = rows.agg(*[F.avg(F.abs(F.col(f"`{c}`"))).alias(c) for c in features])
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("mean_abs_shap")) for c in features])
    return wide.select(F.explode(arr).alias("e")).select("e.*").orderBy(F.col("mean_abs_shap").desc())


# ----------------------------------------------------------------- small models, as joins
def path_elements(model: Booster, session) -> DataFrame:
    """(path, value, feature, low, high, null_ok, z, nth, of): the conditions of every root-to-leaf path, one row a feature.

    A row of the data follows an element if its bin lies between low and high
    (or is NULL's, -1, and null_ok); z is the share of the training rows at the
    splits on that feature that did.
    """
    rows, path = [], 0
    for tree in model.trees:
        stack = [(0, {})]
        while stack:
            node, own = stack.pop()
            f = int(tree.feature[node])
            if f < 0:
                value = float(tree.value[node]) * model.params.rate
                for n, (g, (low, high, null_ok, z)) in enumerate(sorted(own.items())):
                    rows.append((path, value, g, low, high, null_ok, z, n, len(own)))
                if not own:
                    rows.append((path, value, -1, 0, 0, False, 1.0, 0, 0))
                path += 1
                continue
            for child, left in ((int(tree.left[node]), True), (int(tree.right[node]), False)):
                low, high, null_ok, z = own.get(f, (0, 1 << 15, True, 1.0))
                low, high = (low, min(high, int(tree.cut[node]))) if left else (max(low, int(tree.cut[node]) + 1), high)
                share = float(tree.rows[child]) / float(tree.rows[node])
                stack.append((child, {**own, f: (low, high, null_ok and bool(tree.null_left[node]) == left, z * share)}))
    return session.createDataFrame(
        rows, "path int, value double, feature int, low int, high int, null_ok boolean, z double, nth int, of int")


def coalition_attribution(model: Booster, binned: DataFrame, key: str) -> DataFrame:
    """(key, feature, attribution): Shapley values of a small booster, every coalition of a path's features a row.

    The same game as ``tree_attribution``: features outside a coalition follow a
    path as often as the training rows did. Rows x paths x 2^(features of a path) rows are joined and
    summed, so this is for trees of a few levels. ``binned`` carries ``bins``.
    """
    elements = path_elements(model, binned.sparkSession).where("feature >= 0")
    mask = F.explode(F.sequence(F.lit(0), F.call_function("shiftleft", F.lit(1), F.col("of")) - 1)).alias("mask")
    bit = F.call_function("shiftright", F.col("mask"), F.col("nth")).bitwiseAND(F.lit(1))
    # weight |S|! (d - |S| - 1)! / d! of a coalition S without the feature
    size = F.bit_count("mask")
    weight = F.factorial(size) * F.factorial(F.col("of") - size - 1) / F.factorial("of")
    coalitions = elements.select("path", "value", "of", "nth", mask).where(bit == 0).select(
        "path", F.col("nth").alias("own"), "mask", (weight * F.col("value")).alias("weight"))
    rows = binned.select(F.col(key).alias("key"), F.posexplode("bins").alias("feature", "bin"))
    met = rows.join(elements, "feature").withColumn(
        "o", F.when(F.col("bin") < 0, F.col("null_ok")).otherwise(F.col("bin").between(F.col("low"), F.col("high"))).cast("double"))
    each = met.select("key", "path", "feature", "nth", "o", "z").join(coalitions, "path")
    factor = (F.when(F.col("nth") == F.col("own"), F.col("o") - F.col("z"))
              .when(bit == 1, F.col("o")).otherwise(F.col("z")))
    parts = each.groupBy("key", "path", "own", "mask").agg(
        F.product(factor).alias("p"), F.first("weight").alias("weight"), F.max(F.when(F.col("nth") == F.col("own"), F.col("feature"))).alias("feature"))
    sums = parts.groupBy("key", "feature").agg(F.sum(F.col("p") * F.col("weight")).alias("attribution"))
    name = F.element_at(F.array(*map(F.lit, model.features)), F.col("feature") + 1)
    return sums.select(F.col("key").alias(key), name.alias("feature"), "attribution")
