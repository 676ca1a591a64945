"""Equi-joins of the panel: spine joins, outer economy join, enrichments.

Every join here is on the entity key (optionally with the year). Spark picks
the physical strategy: tables under the broadcast threshold are broadcast
(Spark checks their size), otherwise both sides are hash-partitioned on the
key; after the first join the output is already partitioned on the key, so a
chain of left joins on the same key shuffles only each new right side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def spine_join(spine: DataFrame, others: Sequence[DataFrame], key: str,
               protected: Sequence[str] = ()) -> DataFrame:
    """Spine LEFT JOIN each frame on ``key``: every spine row survives.

    Columns of a right side that already exist on the left (e.g. names) are
    dropped from the right side, so no suffixed duplicates appear.
    """
    out = spine
    for o in others:
        if o is None:
            continue
        keep = [c for c in o.columns if c == key or (c not in out.columns and c not in protected)]
        out = out.join(o.select(*keep), on=key, how="left")
    return out


def outer_join_coalesced(left: DataFrame, right: DataFrame, keys: Sequence[str],
                         coalesce_cols: Sequence[str] = ("name",)) -> DataFrame:
    """FULL OUTER on ``keys``; shared descriptive columns are coalesced left-first.

    With USING-columns the keys come out coalesced; a name present on both
    sides is kept once (a right-only row keeps the right-side name).
    """
    shared = [c for c in coalesce_cols if c in left.columns and c in right.columns]
    if not shared:
        return left.join(right, on=list(keys), how="full")
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in shared else F.col(c) for c in right.columns])
    j = left.join(r, on=list(keys), how="full")
    cols = []
    for c in j.columns:
        if c.startswith("_r_"):
            continue
        cols.append(F.coalesce(F.col(c), F.col(f"_r_{c}")).alias(c) if c in shared else F.col(c))
    return j.select(*cols)


def left_enrich(base: DataFrame, extra: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """LEFT join of an optional enrichment; duplicate non-key columns dropped."""
    if extra is None:
        return base
    keep = [c for c in extra.columns if c in keys or c not in base.columns]
    return base.join(extra.select(*keep), on=list(keys), how="left")


def derived_indicators(df: DataFrame, gdp: str = "gdp_k", pop: str = "population",
                       area: str = "area_km2") -> DataFrame:
    """Per-capita and per-km² indicators; zero inputs become NULL, never ±inf.

    Conditional on the columns present: cropped share needs ``planted_area_ha``,
    herd density needs ``herd_total``, pressure needs ``pct_agro`` and ``pct_native``.
    """
    cols = df.columns
    p = F.nullif(F.col(pop), F.lit(0))
    a = F.nullif(F.col(area), F.lit(0))
    g = F.nullif(F.col(gdp), F.lit(0))
    new = {
        "gdp_per_capita": g * 1000 / p,
        "gdp_per_km2": g * 1000 / a,
        "pop_density": p / a,
    }
    if "planted_area_ha" in cols:
        new["pct_cropped_area"] = F.col("planted_area_ha") / (a * 100) * 100
    if "herd_total" in cols:
        new["herd_per_km2"] = F.col("herd_total") / a
    if "pct_native" in cols:
        new["conservation_index"] = F.col("pct_native")
    if "pct_forest" in cols:
        new["forest_index"] = F.col("pct_forest")
    if "pct_agro" in cols and "pct_native" in cols:
        new["pressure_index"] = F.col("pct_agro") / (F.nullif(F.col("pct_native"), F.lit(0)) + 1)
    return df.select(*[c for c in cols if c not in new], *[e.alias(n) for n, e in new.items()])


def attach_geography(scores: DataFrame, geo_keys: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Scores joined to a geographic key table (the data half of a map view):
    ``inner`` keeps mapped entities only, ``left`` keeps every score."""
    keep = [c for c in geo_keys.columns if c == key or c not in scores.columns]
    return scores.join(geo_keys.select(*keep), on=key, how=how)
