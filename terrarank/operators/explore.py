"""Exploration views over a ranking: display table, filters, KPIs, group
summaries, threshold counts, correlations with the score.

All are single aggregates or joins on the key; filter predicates are plain
column expressions, so they reach the Parquet scan when the view is read
from files.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def display_table(ranking: DataFrame, profiles: DataFrame | None, master: DataFrame, key: str,
                  master_cols: Sequence[str], label_col: str = "cluster_label") -> DataFrame:
    """Ranking LEFT JOIN profile labels LEFT JOIN selected master columns."""
    out = ranking
    if profiles is not None:
        out = out.join(profiles.select(key, label_col), on=key, how="left")
    extra = [c for c in master_cols if c not in out.columns]
    return out.join(master.select(key, *extra), on=key, how="left")


def apply_filters(df: DataFrame, ranges: Mapping[str, tuple] | None = None,
                  choices: Mapping[str, Sequence] | None = None) -> DataFrame:
    """Inclusive range filters (NULL fails) and optional multi-select filters
    (an empty selection means no filter)."""
    cond = F.lit(True)
    for c, (lo, hi) in (ranges or {}).items():
        cond = cond & F.col(c).between(F.lit(lo), F.lit(hi))
    for c, vals in (choices or {}).items():
        if vals:
            cond = cond & F.col(c).isin(list(vals))
    return df.where(cond)


def filter_choices(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values, sorted (filter options)."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def bounds(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Min and max of each column (slider bounds), one aggregate."""
    return df.agg(*[a for c in cols for a in (F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))])


def kpis(df: DataFrame, score: str = "score", native: str = "pct_native", gdp_pc: str = "gdp_per_capita") -> DataFrame:
    """KPI strip: count, mean and max score, mean native share, mean GDP per capita."""
    return df.agg(
        F.count(F.lit(1)).alias("entities"),
        F.avg(score).alias("mean_score"),
        F.max(score).alias("max_score"),
        F.avg(native).alias("mean_pct_native"),
        F.avg(gdp_pc).alias("mean_gdp_per_capita"),
    )


def mean_by_group(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, entities, mean_<value>) — e.g. mean score by state or region."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("entities"), F.avg(value).alias(f"mean_{value}"))


def threshold_counts(df: DataFrame, native: str = "pct_native", score: str = "score",
                     low_native: float = 10.0, high_native: float = 80.0, low_score: float = 25.0) -> DataFrame:
    """Entities below/above fixed thresholds, in one aggregate."""
    return df.agg(
        F.count_if(F.col(native) < low_native).alias("native_below_10"),
        F.count_if(F.col(native) > high_native).alias("native_above_80"),
        F.count_if(F.col(score) < low_score).alias("score_below_25"),
        F.count(F.lit(1)).alias("entities"),
    )


def score_correlations(df: DataFrame, score: str, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of the score with each column (pairwise complete)."""
    wide = df.agg(*[F.corr(score, c).alias(c) for c in cols])
    arr = F.array(*[F.struct(F.lit(c).alias("indicator"), F.col(c).alias("r")) for c in cols])
    return wide.select(F.explode(arr).alias("e")).select("e.*")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns minus exclusions (schema only, no job)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def group_summary(df: DataFrame, group: str, key: str, score: str, native: str, gdp_pc: str,
                  digits: int = 2) -> DataFrame:
    """Per-group count and means, rounded half-to-even; NULL groups dropped."""
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(
        F.count(key).alias("entities"),
        F.bround(F.avg(score), digits).alias("mean_score"),
        F.bround(F.avg(native), digits).alias("mean_pct_native"),
        F.bround(F.avg(gdp_pc), digits).alias("mean_gdp_per_capita"),
    )


def group_sizes(df: DataFrame, group: str) -> DataFrame:
    """Value counts, largest first."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), F.col(group))


def score_stats_by_group(df: DataFrame, group: str, score: str = "score") -> DataFrame:
    """count / mean / min / max of the score per group."""
    return df.groupBy(group).agg(F.count(score).alias("count"), F.avg(score).alias("mean"),
                                 F.min(score).alias("min"), F.max(score).alias("max"))


def ranking_label(df: DataFrame, name: str = "name", state: str = "state", out: str = "label") -> DataFrame:
    """``name - state`` display label (NULL if either is NULL)."""
    return df.withColumn(out, F.concat(F.col(name), F.lit(" - "), F.col(state)))


def rename_for_display(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Project and rename columns for presentation (only those present)."""
    return df.select(*[F.col(c).alias(n) for c, n in names.items() if c in df.columns])


def explore_view(ranking: DataFrame, profiles: DataFrame | None, master: DataFrame, key: str,
                 ranges: Mapping[str, tuple] | None = None, choices: Mapping[str, Sequence] | None = None,
                 master_cols: Sequence[str] = ("pct_native", "pct_forest", "pct_agro", "gdp_per_capita",
                                               "native_change_pp", "population")) -> tuple[DataFrame, DataFrame]:
    """The filtered analysis view and its KPI strip: (rows, kpis)."""
    rows = apply_filters(display_table(ranking, profiles, master, key, master_cols), ranges, choices)
    return rows, kpis(rows)
