"""Class-composition aggregates over an entity × class × year table.

One hash aggregate per call, with partial (map-side) aggregation, so a key
that holds a large share of the rows collapses to one row per task before the
shuffle. The per-group Python lambdas of a pandas design become conditional
sums inside the same aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrarank.functions import in_group, safe_div
from terrarank.session import cut_lineage

def class_composition(
    df: DataFrame,
    keys: Sequence[str],
    class_col: str,
    measure: str,
    groups: Mapping[str, Sequence],
    total_name: str = "total_area",
    rows_name: str | None = None,
) -> DataFrame:
    """Total and per-group measure sums, and each group's share (%) of the total.

    A NULL measure counts as 0; a zero total gives NULL shares; a group with no
    rows gives 0 area. ``rows_name`` adds the number of input rows.
    """
    m = F.coalesce(F.col(measure).cast("double"), F.lit(0.0))
    aggs = [F.sum(m).alias(total_name)]
    if rows_name:
        aggs.append(F.count(F.lit(1)).alias(rows_name))
    for g, codes in groups.items():
        aggs.append(F.sum(F.when(in_group(class_col, codes), m).otherwise(F.lit(0.0))).alias(f"{g}_area"))
    out = df.groupBy(*keys).agg(*aggs)
    shares = [(safe_div(F.col(f"{g}_area"), F.col(total_name)) * 100).alias(f"pct_{g}") for g in groups]
    return out.select("*", *shares)


def year_row_counts(df: DataFrame, year: str) -> DataFrame:
    return df.groupBy(year).agg(F.count(F.lit(1)).alias("rows"))


def year_gate(df: DataFrame, year: str, min_rows: int) -> DataFrame:
    """Keep only rows of years that have at least ``min_rows`` rows (a semi join with the few years that pass)."""
    passing = year_row_counts(df, year).where(F.col("rows") >= min_rows).select(year)
    return df.join(passing, year, "left_semi")


def composition_panel(
    df: DataFrame,
    key: str,
    year: str,
    class_col: str,
    measure: str,
    groups: Mapping[str, Sequence],
    min_rows: int | None = None,
) -> DataFrame:
    """Per (key, year) composition; optionally only for years passing the gate.

    The gate counts the rows behind the panel, so the class table is read once.
    """
    if not min_rows:
        return class_composition(df, [key, year], class_col, measure, groups)
    return gated_panel(cut_lineage(class_composition(df, [key, year], class_col, measure, groups, rows_name="_rows")),
                       year, min_rows)


def gated_panel(panel: DataFrame, year: str, min_rows: int) -> DataFrame:
    """Panel rows of years with at least ``min_rows`` input rows (counted in ``_rows``)."""
    passing = panel.groupBy(year).agg(F.sum("_rows").alias("rows")).where(F.col("rows") >= min_rows).select(year)
    return panel.join(passing, year, "left_semi").drop("_rows")


def as_of_year_frame(df: DataFrame, year: str, ref_year: int, out: str = "asof_year") -> DataFrame:
    """One-row frame with the as-of year of ``ref_year`` (lazy: no job runs).

    It is a global aggregate, so joining it back is a broadcast of one row.
    """
    return df.agg(F.coalesce(F.max(F.when(F.col(year) <= ref_year, F.col(year))), F.min(year)).alias(out))


def composition_as_of_lazy(panel: DataFrame, year: str, ref_year: int) -> DataFrame:
    """Rows of a (key, year) panel for the as-of year, resolved inside the plan."""
    y = as_of_year_frame(panel, year, ref_year, "_asof")
    return panel.join(F.broadcast(y), F.col(year) == F.col("_asof"), "inner").drop("_asof", year)


def composition_as_of(
    df: DataFrame,
    key: str,
    year: str,
    class_col: str,
    measure: str,
    groups: Mapping[str, Sequence],
    ref_year: int,
) -> DataFrame:
    """Composition per key for the as-of year of ``ref_year``, with that year as ``asof_year``.

    As-of year: ``ref_year`` if present, else the greatest year below it, else
    the earliest. The class table is read once, for the panel of all years.
    """
    panel = cut_lineage(composition_panel(df, key, year, class_col, measure, groups))
    y = as_of_year_frame(panel, year, ref_year)
    return panel.join(F.broadcast(y), F.col(year) == F.col("asof_year")).drop(year)


def temporal_change(
    df: DataFrame,
    key: str,
    year: str,
    class_col: str,
    measure: str,
    codes: Sequence,
    year_start: int,
    year_end: int,
    name: str = "native",
) -> DataFrame:
    """Group share in two years, its change in points and as % of the start.

    One scan with ``year IN (y0, y1)`` and conditional sums: this equals a
    full outer join of the two yearly shares on the key, without the join.
    A key with no rows in a year gets a NULL share for that year.
    """
    m = F.coalesce(F.col(measure).cast("double"), F.lit(0.0))
    member = in_group(class_col, codes)
    y = F.col(year)
    parts = []
    for tag, yr in (("s", year_start), ("e", year_end)):
        parts += [
            F.count_if(y == yr).alias(f"n_{tag}"),
            F.sum(F.when(y == yr, m)).alias(f"t_{tag}"),
            F.sum(F.when((y == yr) & member, m).when(y == yr, F.lit(0.0))).alias(f"g_{tag}"),
        ]
    agg = df.where(y.isin(year_start, year_end)).groupBy(key).agg(*parts)
    p0 = F.when(F.col("n_s") > 0, safe_div(F.col("g_s"), F.col("t_s")) * 100)
    p1 = F.when(F.col("n_e") > 0, safe_div(F.col("g_e"), F.col("t_e")) * 100)
    c0, c1 = f"pct_{name}_{year_start}", f"pct_{name}_{year_end}"
    out = agg.select(key, p0.alias(c0), p1.alias(c1))
    change = F.col(c1) - F.col(c0)
    return out.select(
        key,
        c0,
        c1,
        change.alias(f"{name}_change_pp"),
        (safe_div(change, F.col(c0)) * 100).alias(f"{name}_change_rate_pct"),
    )


def event_counts(df: DataFrame, key: str, tag_col: str | None = None, tag_value=None,
                 name: str = "events") -> DataFrame:
    """Number of events per key, with an optional literal tag column (e.g. a year)."""
    out = df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    if tag_col is not None:
        out = out.withColumn(tag_col, F.lit(tag_value))
    return out


def distinct_count(df: DataFrame, col: str, name: str = "distinct_entities") -> DataFrame:
    """Exact number of distinct non-null values (two-phase distinct aggregate)."""
    return distinct_counts(df, {col: name})


def distinct_counts(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """``distinct_count`` of several columns (column → output name) in one row."""
    return df.agg(*[F.count_distinct(c).alias(n) for c, n in names.items()])
