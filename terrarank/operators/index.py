"""Composite index: orient → median-impute → min-max → PCA/entropy weights →
weighted score → rescale → rank.

``fit`` learns k-sized statistics with a handful of aggregate jobs over the
entity table (only k-vectors reach the driver); ``transform`` applies them as
plain column expressions, so scoring another frame with the same statistics
(the fit/apply split) costs one pass. Jobs per fit:

* medians, minima and maxima (``stats.order_statistics``: one aggregate, then
  narrowing passes over the columns in question);
* covariance pairs (sums of products of median-shifted, [0,100]-scaled
  columns) and entropy sums in ONE aggregate over the normalised columns;
* the k×k eigen-decomposition for the PCA weights runs on the driver;
* score min/max (one aggregate).
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrarank.config import DEFAULT_INDICATORS, ECONOMY_SUBINDEX, ENVIRONMENT_SUBINDEX, Indicator
from terrarank.operators.rank import rank_desc
from terrarank.operators.stats import order_statistics

EPS_SHIFT = 1e-6  # fixed value: shift before the entropy normalisation
EPS_LOG = 1e-10   # fixed value: offset inside the logarithm
MAX_PCA_COMPONENTS = 3


def available_indicators(df: DataFrame, indicators: Sequence[Indicator]) -> tuple[list[Indicator], list[str]]:
    """Indicators present in the frame, and the names that are missing."""
    present = [i for i in indicators if i.name in df.columns]
    missing = [i.name for i in indicators if i.name not in df.columns]
    if missing:
        warnings.warn(f"indicators missing, excluded from the index: {missing}", stacklevel=2)
    return present, missing


def oriented(ind: Indicator) -> Column:
    """Direction flip: higher must mean better."""
    c = F.col(ind.name).cast("double")
    return -c if ind.direction == -1 else c


@dataclass
class IndexModel:
    indicators: list[Indicator]
    medians: dict[str, float]
    mins: dict[str, float]
    maxs: dict[str, float]
    n_rows: int
    entropy_weights: dict[str, float]
    pca_weights: dict[str, float] | None
    weights: dict[str, float]
    score_min: float | None = None
    score_max: float | None = None
    explained_variance_ratio: list[float] = field(default_factory=list)
    covariance: np.ndarray | None = None  # of the normalised indicators, where components are fitted

    # -- expressions ---------------------------------------------------------
    def imputed(self, ind: Indicator) -> Column:
        return F.coalesce(oriented(ind), F.lit(self.medians[ind.name]))

    def normalized(self, ind: Indicator) -> Column:
        lo, hi = self.mins[ind.name], self.maxs[ind.name]
        if hi == lo:
            return F.lit(0.0)  # constant indicator → lower bound of the range
        return (self.imputed(ind) - F.lit(lo)) / F.lit(hi - lo) * 100

    def normalized_value(self, ind: Indicator, oriented_value: float) -> float:
        """Scaled value of one (already oriented) number, on the driver."""
        lo, hi = self.mins[ind.name], self.maxs[ind.name]
        return 0.0 if hi == lo else (oriented_value - lo) / (hi - lo) * 100

    def raw_score(self, norm_prefix: str = "norm_") -> Column:
        terms = [F.col(f"{norm_prefix}{i.name}") * F.lit(self.weights[i.name]) for i in self.indicators]
        out = terms[0]
        for t in terms[1:]:
            out = out + t
        return out

    def transform(self, df: DataFrame, key: str, keep: Sequence[str] = (), score: str = "score",
                  rank: str = "rank", round_score: int | None = None) -> DataFrame:
        """Score, rank and sub-indices for every row of ``df``.

        ``round_score`` rounds the score before ranking (ties are then decided
        on the published precision)."""
        names = [i.name for i in self.indicators]
        base = df.select(key, *[c for c in keep if c != key],
                         *[self.normalized(i).alias(f"norm_{i.name}") for i in self.indicators])
        if self.score_min is None or self.score_max is None or self.score_max == self.score_min:
            scaled = F.lit(None).cast("double")  # constant score: no ranking possible
        else:
            scaled = (self.raw_score() - F.lit(self.score_min)) / F.lit(self.score_max - self.score_min) * 100
        if round_score is not None:
            scaled = F.round(scaled, round_score)
        env = [f"norm_{c}" for c in ENVIRONMENT_SUBINDEX if c in names]
        eco = [f"norm_{c}" for c in ECONOMY_SUBINDEX if c in names]
        extra = []
        if env:
            extra.append((sum((F.col(c) for c in env[1:]), F.col(env[0])) / len(env)).alias("subindex_environment"))
        if eco:
            extra.append((sum((F.col(c) for c in eco[1:]), F.col(eco[0])) / len(eco)).alias("subindex_economy"))
        scored = base.select(key, *[c for c in keep if c != key], scaled.alias(score), *extra,
                             *[f"norm_{n}" for n in names])
        return rank_desc(scored, score, rank)


def entropy_weights_from_sums(sums: dict[str, float], n: int) -> dict[str, float]:
    """``E_j = -S_j / ln n``, ``w_j = (1 - E_j) / Σ(1 - E)``."""
    if n < 2:
        raise ValueError("entropy weights need at least two rows")
    e = {c: -s / math.log(n) for c, s in sums.items()}
    d = {c: 1.0 - v for c, v in e.items()}
    tot = sum(d.values())
    w = {c: v / tot for c, v in d.items()}
    if any(v < 0 for v in w.values()):
        warnings.warn("negative entropy weight (row-normalised entropy exceeds 1)", stacklevel=2)
    return w


def pca_weights_from_cov(cov: np.ndarray, names: Sequence[str], n_components: int | None = None):
    """Weights ∝ Σ_c |loading_c| · explained-variance-ratio_c over the top components."""
    k = len(names)
    n_components = n_components or min(k, MAX_PCA_COMPONENTS)
    vals, vecs = np.linalg.eigh(cov)
    order = np.argsort(vals)[::-1]
    vals, vecs = vals[order], vecs[:, order]
    total = vals.sum()
    ratio = vals[:n_components] / total if total > 0 else np.zeros(n_components)
    loadings = np.abs(vecs[:, :n_components].T)  # (components, features)
    raw = (loadings * ratio[:, None]).sum(axis=0)
    w = raw / raw.sum() if raw.sum() > 0 else np.full(k, 1.0 / k)
    return dict(zip(names, w.tolist())), ratio.tolist()


def fit_index(
    df: DataFrame,
    indicators: Sequence[Indicator] = DEFAULT_INDICATORS,
    weighting: str = "pca+entropy",
    entropy_mode: str = "row",
) -> IndexModel:
    """Learn the index statistics from ``df`` (persist ``df`` first: 3-4 passes).

    ``weighting``: ``"pca+entropy"`` (mean of both, renormalised), ``"entropy"``
    or ``"pca"``. ``entropy_mode``: ``"row"`` normalises each row by its sum
    (the reproduced method); ``"column"`` is the textbook column normalisation.
    """
    present, _ = available_indicators(df, indicators)
    if not present:
        raise ValueError("no index indicator present")
    o = df.select(*[oriented(i).alias(i.name) for i in present])
    # medians, minima and maxima of all indicators by the same narrowing passes
    found = {r["column"]: r for r in order_statistics(o, [i.name for i in present], [0.5]).collect()}
    med = {c: r["value"] for c, r in found.items()}
    # An all-NULL indicator has no median: it is treated as missing.
    used = [i for i in present if med.get(i.name) is not None]
    if not used:
        raise ValueError("every index indicator is entirely NULL")
    model = IndexModel(
        indicators=used,
        medians={i.name: float(med[i.name]) for i in used},
        mins={i.name: float(found[i.name]["low"]) for i in used},
        maxs={i.name: float(found[i.name]["high"]) for i in used},
        n_rows=0,
        entropy_weights={}, pca_weights=None, weights={},
    )
    names = [i.name for i in used]
    norm = df.select(*[model.normalized(i).alias(i.name) for i in used])
    k = len(names)
    # Per-row quantities are projected once below the aggregate (the row sum
    # feeds every entropy term), which keeps the aggregate's expressions small.
    cols = []
    if entropy_mode == "row":
        row_sum = F.col(names[0]) + F.lit(EPS_SHIFT)
        for c in names[1:]:
            row_sum = row_sum + (F.col(c) + F.lit(EPS_SHIFT))
        cols.append(row_sum.alias("_rs"))
    pca = weighting in ("pca+entropy", "pca")
    if pca:
        # Covariance from sums of products of shifted columns. Every column
        # is scaled to [0, 100] and shifted by its (scaled) median, so the
        # one-pass formula is well conditioned; plain sums keep the aggregate
        # in fixed-width buffers (fast codegen) for k(k+1)/2 pairs.
        shift = {c: float(model.normalized_value(i, model.medians[c])) for i, c in zip(used, names)}
        cols += [(F.col(c) - F.lit(shift[c])).alias(f"_dv_{c}") for c in names]
    stage = norm.select(*names, *cols)
    aggs = [F.count(F.lit(1)).alias("_n")]
    if entropy_mode == "row":
        stage = stage.select("*", *[((F.col(c) + F.lit(EPS_SHIFT)) / F.col("_rs")).alias(f"_pr_{c}") for c in names])
        for c in names:
            p = F.col(f"_pr_{c}")
            aggs.append(F.sum(p * F.log(p + F.lit(EPS_LOG))).alias(f"_s_{c}"))
    elif entropy_mode == "column":
        for c in names:
            sh = F.col(c) + F.lit(EPS_SHIFT)
            aggs += [F.sum(sh).alias(f"_cs_{c}"), F.sum(sh * F.log(sh)).alias(f"_cl_{c}")]
    else:
        raise ValueError(entropy_mode)
    if pca:
        for c in names:
            aggs.append(F.sum(f"_dv_{c}").alias(f"_d_{c}"))
        for a in range(k):
            for b in range(a, k):
                aggs.append(F.sum(F.col(f"_dv_{names[a]}") * F.col(f"_dv_{names[b]}")).alias(f"_p_{a}_{b}"))
    norm = stage
    r = norm.agg(*aggs).collect()[0]
    n = int(r["_n"])
    model.n_rows = n
    if entropy_mode == "row":
        sums = {c: float(r[f"_s_{c}"]) for c in names}
    else:
        sums = {}
        for c in names:
            cs, cl = float(r[f"_cs_{c}"]), float(r[f"_cl_{c}"])
            sums[c] = cl / cs - math.log(cs)
    if weighting in ("pca+entropy", "entropy"):
        model.entropy_weights = entropy_weights_from_sums(sums, n)
    if weighting in ("pca+entropy", "pca"):
        cov = np.zeros((k, k))
        d = [float(r[f"_d_{c}"]) for c in names]
        for a in range(k):
            for b in range(a, k):
                p = float(r[f"_p_{a}_{b}"])
                cov[a, b] = cov[b, a] = (p - d[a] * d[b] / n) / (n - 1) if n > 1 else 0.0
        model.covariance = cov
        model.pca_weights, model.explained_variance_ratio = pca_weights_from_cov(cov, names)
    if weighting == "pca+entropy":
        comb = np.array([(model.pca_weights[c] + model.entropy_weights[c]) / 2 for c in names])
        comb = comb / comb.sum()
        model.weights = dict(zip(names, comb.tolist()))
    elif weighting == "entropy":
        model.weights = dict(model.entropy_weights)
    elif weighting == "pca":
        model.weights = dict(model.pca_weights)
    else:
        raise ValueError(weighting)
    scored = norm.select(sum((F.col(c) * F.lit(model.weights[c]) for c in names[1:]),
                             F.col(names[0]) * F.lit(model.weights[names[0]])).alias("_s"))
    sr = scored.agg(F.min("_s").alias("lo"), F.max("_s").alias("hi")).collect()[0]
    model.score_min, model.score_max = sr["lo"], sr["hi"]
    return model


def weights_frame(model: IndexModel, spark) -> DataFrame:
    """(indicator, label, direction, pca_weight, entropy_weight, weight), sorted by weight."""
    rows = [(i.name, i.label, i.direction,
             None if model.pca_weights is None else model.pca_weights.get(i.name),
             model.entropy_weights.get(i.name), model.weights[i.name]) for i in model.indicators]
    df = spark.createDataFrame(rows, "indicator string, label string, direction int, pca_weight double, "
                                     "entropy_weight double, weight double")
    return df.orderBy(F.col("weight").desc())


def build_index(df: DataFrame, key: str, keep: Sequence[str] = (), indicators=DEFAULT_INDICATORS,
                weighting: str = "pca+entropy", entropy_mode: str = "row",
                round_score: int | None = None) -> tuple[DataFrame, IndexModel]:
    """End to end: fit on ``df`` and score ``df``. Returns (ranking, model)."""
    model = fit_index(df, indicators, weighting=weighting, entropy_mode=entropy_mode)
    return model.transform(df, key, keep, round_score=round_score), model


def entity_profile(ranking: DataFrame, key: str, value) -> DataFrame:
    """One entity's normalised indicators as (indicator, value) rows (radar vector)."""
    norm_cols = [c for c in ranking.columns if c.startswith("norm_")]
    row = ranking.where(F.col(key) == F.lit(value))
    return row.unpivot([key], norm_cols, "indicator", "value").select(
        key, F.regexp_replace("indicator", "^norm_", "").alias("indicator"), "value")
