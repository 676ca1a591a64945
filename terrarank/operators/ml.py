"""Regression models, cross-validation, importances, attribution and k-means
profiles on ``pyspark.ml``.

Model fitting is distributed by Spark ML; the driver only orchestrates fold
fits (run concurrently from a thread pool, like ``CrossValidator``'s
``parallelism``) and receives k-sized results (metrics, coefficients,
importances, centres).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrarank.config import FEATURE_COLS, PROFILE_LABELS
from terrarank.operators.boosting import LEAF_WISE, SECOND_ORDER, TASK_ROWS, Booster, Boosting, bin_cuts, cross_validate_boosting, fit_boosters, with_bins
from terrarank.operators.forest import Forest, ForestModel, cross_validate_forest, fit_forest
from terrarank.operators.gradient import GRADIENT_ROWS, cross_validate_gradient
from terrarank.operators.linear import ElasticNet, cross_validate_elastic_net, products_by_fold
from terrarank.operators.silhouette import hashed_sample, mean_silhouette
from terrarank.operators.stats import exact_quantiles
from terrarank.session import checkpoint_dir
from terrarank.session import keep as keep_frame

SEED = 42
N_FOLDS = 5
TREE_MODELS = ("random_forest", "gradient_boosting", "boosting_deep", "boosting_leafy")


# ----------------------------------------------------------------- features
def prepare_features(ranking: DataFrame, master: DataFrame, key: str, label: str = "score",
                     features: Sequence[str] = FEATURE_COLS) -> tuple[DataFrame, list[str]]:
    """Master INNER JOIN the score on the key; the features that are present."""
    df = master.join(ranking.select(key, label), on=key, how="inner")
    available = [c for c in features if c in df.columns]
    return df.select(key, *[F.col(c).cast("double").alias(c) for c in available], F.col(label).alias("label")), available


def non_null_features(df: DataFrame, features: Sequence[str]) -> list[str]:
    """Features with at least one non-NULL value (one aggregate)."""
    r = df.agg(*[F.count(c).alias(c) for c in features]).collect()[0]
    return [c for c in features if r[c] > 0]


@dataclass
class Standardizer:
    medians: dict
    means: dict
    stds: dict

    def imputed(self, c: str):
        return F.coalesce(F.col(c), F.lit(self.medians[c]))

    def scaled(self, c: str):
        sd = self.stds[c] if self.stds[c] not in (None, 0.0) else 1.0
        return (self.imputed(c) - F.lit(self.means[c])) / F.lit(sd)


def fit_standardizer(df: DataFrame, features: Sequence[str]) -> Standardizer:
    """Exact medians for imputation; mean and population std of the imputed
    columns; a zero std scales by 1."""
    q = exact_quantiles(df, list(features), [0.5]).collect()
    med = {r["column"]: r["value"] for r in q}
    imp = [F.coalesce(F.col(c), F.lit(med[c])) for c in features]
    r = df.agg(*[F.avg(e).alias(f"m_{c}") for e, c in zip(imp, features)],
               *[F.stddev_pop(e).alias(f"s_{c}") for e, c in zip(imp, features)]).collect()[0]
    return Standardizer(med, {c: r[f"m_{c}"] for c in features}, {c: r[f"s_{c}"] for c in features})


def with_fold(df: DataFrame, key: str, n_folds: int = N_FOLDS) -> DataFrame:
    """Deterministic fold id from the first 32 bits of the key's MD5 (no shuffle, no sort, any engine can repeat it)."""
    head = F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8), 16, 10).cast("long")
    return df.withColumn("fold", (head % n_folds).cast("int"))


# ----------------------------------------------------------------- models
FOREST_DEPTH = 15


def feature_names(design: DataFrame) -> list[str]:
    """The columns behind the design's feature vector, in order."""
    attrs = design.schema["features"].metadata["ml_attr"]["attrs"]
    return [a["name"] for a in sorted((a for kind in attrs.values() for a in kind), key=lambda a: a["idx"])]


@dataclass(frozen=True)
class SettledForest:
    """A random forest that does not depend on how its rows were partitioned (``operators.forest``), with the
    number of trees, depth, bins and seed of ``forest``; all folds are fitted from the same blocks of rows."""

    forest: RandomForestRegressor
    rows_per_task: int = 20_000

    @property
    def params(self) -> Forest:
        f = self.forest
        return Forest(f.getNumTrees(), f.getMaxDepth(), f.getMaxBins(), f.getSeed())

    def fit(self, design: DataFrame) -> ForestModel:
        return fit_forest(design, feature_names(design), self.params, self.rows_per_task)

    def cross_validate(self, design: DataFrame, n_folds: int):
        held, seen, model = cross_validate_forest(design, feature_names(design), self.params, n_folds, self.rows_per_task)
        return _fold_errors(held), _train_r2(seen), model


def in_few_tasks(df: DataFrame) -> DataFrame:
    """The rows in as many tasks as their count calls for: fits of many short passes cost mostly what their tasks cost."""
    return df.coalesce(max(1, -(-df.count() // TASK_ROWS)))


@dataclass(frozen=True)
class InFewTasks:
    """An estimator of many short passes, fitted in as many tasks as the rows call for; the models of a
    cross-validation are grown by a task each if there are not too many rows (``operators.gradient``)."""

    estimator: GBTRegressor

    def fit(self, design: DataFrame):
        return self.estimator.fit(in_few_tasks(design))

    def cross_validate(self, design: DataFrame, n_folds: int):
        n = design.count()
        if n > GRADIENT_ROWS:
            return cross_validate_apart(self, design, n_folds)
        held, seen, model = cross_validate_gradient(design, n, feature_names(design), self.estimator, n_folds)
        return _fold_errors(held), _train_r2(seen), model


class GramElasticNet:
    """Elastic net from one pass over the rows, whatever the number of folds (``operators.linear``)."""

    def fit(self, design: DataFrame) -> ElasticNet:
        names = feature_names(design)
        one = design.withColumn("fold", F.lit(0))
        return ElasticNet(products_by_fold(one, [F.col(f"`{c}`") for c in names], F.col("label"))[0], names)

    def cross_validate(self, design: DataFrame, n_folds: int):
        return cross_validate_elastic_net(design, feature_names(design))


@dataclass(frozen=True)
class HistogramBoosting:
    """Boosting over histograms; all folds are taken at the same time (``operators.boosting``)."""

    params: Boosting

    def fit(self, design: DataFrame) -> Booster:
        names = feature_names(design)
        cuts = bin_cuts(design, names, self.params.max_bins)
        return fit_boosters(with_bins(design, names, cuts).withColumn("model", F.lit(0)), names, cuts, self.params)[0]

    def cross_validate(self, design: DataFrame, n_folds: int):
        held, seen, model = cross_validate_boosting(design, feature_names(design), self.params, n_folds)
        return _fold_errors(held), _train_r2(seen), model


def make_estimator(name: str, label_std: float | None = None, forest_depth: int = FOREST_DEPTH):
    """Regressor presets. The reproduced forest grows without a bound on depth;
    here ``forest_depth`` bounds it (30 is Spark's limit). ``boosting_deep`` and ``boosting_leafy`` are the
    two external boosting methods at their defaults: second-order gains with an L2 penalty by depth, and
    leaf-wise growth. Elastic net has α=1, l1_ratio=0.5."""
    if name == "random_forest":
        return SettledForest(RandomForestRegressor(numTrees=100, featureSubsetStrategy="all", maxDepth=forest_depth, seed=SEED))
    if name == "gradient_boosting":
        return InFewTasks(GBTRegressor(maxIter=100, stepSize=0.1, maxDepth=3, seed=SEED, checkpointInterval=10))
    if name == "boosting_deep":
        return HistogramBoosting(SECOND_ORDER)
    if name == "boosting_leafy":
        return HistogramBoosting(LEAF_WISE)
    if name == "elastic_net":
        return GramElasticNet()
    raise ValueError(name)


MODEL_NAMES = ("random_forest", "gradient_boosting", "boosting_deep", "boosting_leafy", "elastic_net")


def design_matrix(df: DataFrame, features: Sequence[str], std: Standardizer, scaled: bool) -> DataFrame:
    cols = [(std.scaled(c) if scaled else std.imputed(c)).alias(c) for c in features]
    base = df.select(*[c for c in df.columns if c not in features], *cols)
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(base)


def _fold_metrics(pred: DataFrame) -> DataFrame:
    """Per-fold RMSE and R² from predictions, in one aggregate."""
    g = pred.groupBy("fold").agg(
        F.sum((F.col("label") - F.col("prediction")) ** 2).alias("sse"),
        F.count(F.lit(1)).alias("n"),
        F.var_pop("label").alias("var"),
    )
    return g.select("fold", F.sqrt(F.col("sse") / F.col("n")).alias("rmse"),
                    (1 - (F.col("sse") / F.col("n")) / F.col("var")).alias("r2"))


def _fold_errors(held: DataFrame) -> list[tuple[float, float]]:
    return [(r.rmse, r.r2) for r in _fold_metrics(held).orderBy("fold").collect()]


def _train_r2(seen: DataFrame) -> float:
    return _fold_metrics(seen.withColumn("fold", F.lit(0))).first()["r2"]


def cross_validate_apart(estimator, design: DataFrame, n_folds: int, parallelism: int = 6):
    """(errors of each fold, training R², model of all rows): a fit for each of them, at the same time."""
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        fitted = list(pool.map(lambda k: estimator.fit(design if k is None else design.where(F.col("fold") != k)), [*range(n_folds), None]))
    held = reduce(DataFrame.unionByName, [
        fitted[k].transform(design.where(F.col("fold") == k)).select("fold", "label", "prediction") for k in range(n_folds)])
    return _fold_errors(held), _train_r2(fitted[-1].transform(design)), fitted[-1]


def cross_validate(df: DataFrame, features: Sequence[str], key: str, names: Sequence[str] = MODEL_NAMES,
                   n_folds: int = N_FOLDS, parallelism: int = 6):
    """K-fold CV of each model + a refit on all rows.

    Returns (metrics DataFrame, fitted models, design frames). Metrics:
    CV RMSE / R² mean and population std over folds, training R². Models that know how to take all
    folds in one go do so; up to ``parallelism`` models run at the same time.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)  # boosting checkpoints its lineage every 10 rounds
    feats = non_null_features(df, features)
    std = fit_standardizer(df, feats)
    base = with_fold(df, key, n_folds)
    designs = {scaled: keep_frame(design_matrix(base, feats, std, scaled)) for scaled in (False, True)}
    with ThreadPoolExecutor(max(1, min(parallelism, len(names)))) as pool:
        estimators = {n: make_estimator(n) for n in names}
        running = {n: pool.submit(getattr(e, "cross_validate", partial(cross_validate_apart, e)), designs[n == "elastic_net"], n_folds)
                   for n, e in estimators.items()}
        settled = {n: f.result() for n, f in running.items()}
    rows = []
    for name, (errors, train, _) in settled.items():
        rm, r2 = [e[0] for e in errors], [e[1] for e in errors]
        rows.append((name, _mean(rm), _pstd(rm), _mean(r2), _pstd(r2), train))
    return spark.createDataFrame(rows, METRICS), {n: model for n, (_, _, model) in settled.items()}, designs, feats


METRICS = ("model string, cv_rmse_mean double, cv_rmse_std double, cv_r2_mean double, cv_r2_std double, "
           "train_r2 double")


def cross_validate_ols(df: DataFrame, features: Sequence[str], key: str, label: str = "label",
                       n_folds: int = N_FOLDS) -> DataFrame:
    """K-fold metrics of the least-squares line on each single feature (same columns as ``cross_validate``).

    The sums of each fold are all it takes to fit on the others, so every
    feature costs one aggregate for the fits and one for the errors.
    """
    rows = []
    for feature in features:
        x, y = F.col(feature), F.col(label)
        d = with_fold(df.where(x.isNotNull() & y.isNotNull()), key, n_folds)
        sums = {r.fold: r for r in d.groupBy("fold").agg(
            F.count(F.lit(1)).alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"), F.sum(x * x).alias("sxx"),
            F.sum(x * y).alias("sxy")).collect()}

        def line(folds):
            n, sx, sy, sxx, sxy = (sum(sums[k][c] for k in folds) for c in ("n", "sx", "sy", "sxx", "sxy"))
            slope = (n * sxy - sx * sy) / (n * sxx - sx * sx) if n * sxx != sx * sx else 0.0
            return slope, (sy - slope * sx) / n

        fitted = {k: line([j for j in sums if j != k]) for k in sums}
        prediction = F.lit(None).cast("double")
        for k, (slope, offset) in fitted.items():
            prediction = F.when(F.col("fold") == k, F.lit(slope) * x + F.lit(offset)).otherwise(prediction)
        fm = _fold_metrics(d.select("fold", y.alias("label"), prediction.alias("prediction"))).collect()
        slope, offset = line(list(sums))
        train = _fold_metrics(d.select(F.lit(0).alias("fold"), y.alias("label"),
                                       (F.lit(slope) * x + F.lit(offset)).alias("prediction"))).first()["r2"]
        rm, r2 = [r["rmse"] for r in fm], [r["r2"] for r in fm]
        rows.append((feature, _mean(rm), _pstd(rm), _mean(r2), _pstd(r2), train))
    return df.sparkSession.createDataFrame(rows, METRICS)


def _mean(xs):
    return sum(xs) / len(xs)


def _pstd(xs):
    m = _mean(xs)
    return math.sqrt(sum((x - m) ** 2 for x in xs) / len(xs))


def best_model(metrics: DataFrame) -> str:
    """Model with the least CV RMSE."""
    return metrics.agg(F.min_by("model", "cv_rmse_mean")).collect()[0][0]


def importances(model, features: Sequence[str], spark) -> DataFrame:
    """Tree importances, else |coefficients|, else uniform; sorted descending."""
    if hasattr(model, "featureImportances"):
        vals = model.featureImportances.toArray().tolist()
    elif hasattr(model, "coefficients"):
        vals = [abs(v) for v in model.coefficients.toArray().tolist()]
    else:
        vals = [1.0 / len(features)] * len(features)
    df = spark.createDataFrame(list(zip(features, [float(v) for v in vals])), "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), "feature")


def linear_attribution(model, design: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean |coef_j · (x_j − mean x_j)| per feature for a linear model
    (the exact Shapley values of a linear model with independent features)."""
    return attribution_of(model.coefficients.toArray().tolist(), design, features)


def attribution_of(coefs: Sequence[float], design: DataFrame, features: Sequence[str]) -> DataFrame:
    """``linear_attribution`` for given coefficients."""
    means = design.agg(*[F.avg(c).alias(c) for c in features]).collect()[0]
    aggs = [F.avg(F.abs(F.lit(coefs[i]) * (F.col(c) - F.lit(means[c])))).alias(c) for i, c in enumerate(features)]
    wide = design.agg(*aggs)
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("mean_abs_attribution")) for c in features])
    return wide.select(F.explode(arr).alias("e")).select("e.*").orderBy(F.col("mean_abs_attribution").desc())


# ----------------------------------------------------------------- profiles
def _kmeans(data: DataFrame, k: int, seed: int):
    return KMeans(k=k, seed=seed, maxIter=100, tol=1e-4, featuresCol="features").fit(data)


def kmeans_best_of(data: DataFrame, k: int, restarts: int = 10, seed: int = SEED, parallelism: int = 8):
    """k-means with ``restarts`` seeds; the fit with least within-cluster cost."""
    with ThreadPoolExecutor(max_workers=parallelism) as ex:
        fits = list(ex.map(lambda i: _kmeans(data, k, seed + i), range(restarts)))
    return min(fits, key=lambda m: m.summary.trainingCost)


CANDIDATE_KS = (3, 4, 5, 6, 7, 8, 9)


def choose_k(data: DataFrame, key: str, ks: Sequence[int] = CANDIDATE_KS, restarts: int = 10, parallelism: int = 8):
    """The candidate k with the greatest silhouette (ties: the smallest): (k, silhouette, model).

    The reproduced method tries 3 … min(10, rows // 100) − 1 and takes 6 below
    400 rows; pass those candidates for parity.

    All (k, seed) fits are submitted to one pool of concurrent Spark jobs, over all rows. The
    silhouette is that of plain Euclidean distances over a bounded sample by hash of the key (``operators.silhouette``).
    """
    jobs = [(k, SEED + i) for k in ks for i in range(restarts)]
    few = in_few_tasks(data)
    with ThreadPoolExecutor(max_workers=parallelism) as ex:
        fits = list(ex.map(lambda js: (js[0], _kmeans(few, *js)), jobs))
    best_per_k = {}
    for k, m in fits:
        if k not in best_per_k or m.summary.trainingCost < best_per_k[k].summary.trainingCost:
            best_per_k[k] = m
    names = feature_names(data)
    sample = keep_frame(hashed_sample(data, key))  # at most SAMPLE_ROWS rows
    sils = {k: mean_silhouette(best_per_k[k].transform(sample), key, names, "prediction") for k in ks}
    best_k = max(ks, key=lambda k: (-1.0 if sils[k] is None else sils[k], -k))
    return best_k, sils[best_k], best_per_k[best_k]


def cluster_profiles(df: DataFrame, key: str, features: Sequence[str], keep: Sequence[str] = (),
                     score: str = "score", labels: Sequence[str] = PROFILE_LABELS,
                     ks: Sequence[int] = CANDIDATE_KS, restarts: int = 10) -> tuple[DataFrame, int, float]:
    """Standardised k-means profiles labelled by ascending mean score.

    Returns (key, keep…, cluster, cluster_rank, cluster_label, score), k and
    the silhouette. Ranks beyond the label list get a NULL label.
    """
    cols = [c for c in [*features, score] if c in df.columns]
    cols = non_null_features(df, cols)
    std = fit_standardizer(df, cols)
    base = keep_frame(df.select(key, *keep, F.col(score).alias("_score"), *[std.scaled(c).alias(c) for c in cols]))
    data = VectorAssembler(inputCols=cols, outputCol="features").transform(base)
    k, sil, model = choose_k(data, key, ks, restarts)
    assigned = model.transform(data).withColumnRenamed("prediction", "cluster")
    means = assigned.groupBy("cluster").agg(F.avg("_score").alias("_m"))
    order = Window.orderBy(F.col("_m").asc(), F.col("cluster").asc())
    ranks = means.select("cluster", (F.row_number().over(order) - 1).cast("int").alias("cluster_rank"))
    label_map = F.create_map(*[x for i, lab in enumerate(labels) for x in (F.lit(i), F.lit(lab))])
    out = assigned.join(F.broadcast(ranks), "cluster").select(
        key, *keep, F.col("cluster").cast("int").alias("cluster"), "cluster_rank",
        F.try_element_at(label_map, F.col("cluster_rank")).alias("cluster_label"), F.col("_score").alias(score))
    return out, k, sil
