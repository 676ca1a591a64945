"""End-to-end jobs with Parquet in and out: transform, index, models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrarank.config import DEFAULT_INDICATORS, FEATURE_COLS, Indicator
from terrarank.operators import explore, ml
from terrarank.operators.index import build_index, weights_frame
from terrarank.operators.rank import sort_by_rank
from terrarank.session import keep as keep_frame
from terrarank.session import release
from terrarank.sources import write_parquet


def index_job(spark: SparkSession, master_path: str, out_path: str, key: str = "entity_key",
              keep_columns: Sequence[str] = ("name", "state", "area_km2", "population", "gdp_k"),
              indicators: Sequence[Indicator] = DEFAULT_INDICATORS, weighting: str = "pca+entropy") -> DataFrame:
    """Read the wide table, build the index, write the ranking sorted by rank
    and the weights next to it. Returns the weights frame."""
    master = keep_frame(spark.read.parquet(master_path))
    keep_cols = [c for c in keep_columns if c in master.columns]
    ranking, model = build_index(master, key, keep_cols, indicators, weighting=weighting)
    write_parquet(sort_by_rank(ranking, "rank", [key]), f"{out_path}/ranking")
    weights = weights_frame(model, spark)
    write_parquet(weights, f"{out_path}/weights")
    out = spark.read.schema(weights.schema).parquet(f"{out_path}/weights").orderBy(F.col("weight").desc())
    release()
    return out


def model_job(spark: SparkSession, master: DataFrame, ranking: DataFrame, out_path: str,
              key: str = "entity_key", keep: Sequence[str] = ("name", "state"),
              features: Sequence[str] = FEATURE_COLS) -> Mapping[str, DataFrame]:
    """All regressors under 5-fold CV, the best one (least CV RMSE), its
    importances and attributions (TreeSHAP for tree models, the closed form
    for the linear one), and k-means profiles; each written as Parquet."""
    df, feats = ml.prepare_features(ranking, master, key, features=features)
    df = keep_frame(df)
    metrics, models, designs, used = ml.cross_validate(df, feats, key)
    best = ml.best_model(metrics)
    imp = ml.importances(models[best], used, spark)
    if best in ml.TREE_MODELS:
        from terrarank.operators.attribution import mean_abs_attribution, tree_attribution
        rows, _ = tree_attribution(models[best], designs[False], used, key)
        attribution = mean_abs_attribution(rows, used)
    else:
        attribution = ml.linear_attribution(models[best], designs[True], used)
    joined = master.join(ranking.select(key, "score"), key, "inner")
    profiles, k, sil = ml.cluster_profiles(joined, key, features, keep=list(keep))
    out = {
        "metrics": metrics.withColumn("best", F.col("model") == F.lit(best)),
        "importances": imp,
        "attribution": attribution,
        "profiles": profiles,
        "profile_summary": explore.score_stats_by_group(profiles, "cluster_label"),
    }
    for name, frame in out.items():
        write_parquet(frame, f"{out_path}/{name}")
    release()
    return {name: spark.read.schema(frame.schema).parquet(f"{out_path}/{name}") for name, frame in out.items()}
