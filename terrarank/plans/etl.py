"""ETL jobs: cleaned extracts → yearly facts and the wide entity table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrarank.operators.composition import class_composition, composition_as_of_lazy, composition_panel, gated_panel
from terrarank.operators.joins import derived_indicators, left_enrich, outer_join_coalesced, spine_join
from terrarank.operators.reshape import dedup_first
from terrarank.session import cut_lineage


def fact_economy(gdp: DataFrame, pop: DataFrame, crops: DataFrame | None, herd: DataFrame | None,
                 key: str = "entity_key", year: str = "year") -> DataFrame:
    """GDP FULL OUTER population on (key, year), then LEFT crops and herd."""
    econ = outer_join_coalesced(gdp, pop, [key, year], coalesce_cols=("name",))
    econ = left_enrich(econ, crops, [key, year])
    return left_enrich(econ, herd, [key, year])


def fact_environment(landuse: DataFrame, key: str, year: str, class_col: str, measure: str,
                     groups: Mapping[str, Sequence], min_rows: int | None = None) -> DataFrame:
    """Per (key, year) class composition; with ``min_rows`` only of years with so many rows."""
    return composition_panel(landuse, key, year, class_col, measure, groups, min_rows=min_rows)


def _year_slice(df: DataFrame | None, key: str, year: str, ref_year: int, cols: Sequence[str]) -> DataFrame | None:
    if df is None:
        return None
    present = [c for c in cols if c in df.columns]
    sl = df.where(F.col(year) == ref_year).select(key, *present)
    return dedup_first(sl, [key])


def land_panel(landuse: DataFrame, groups: Mapping[str, Sequence], key: str = "entity_key",
               year: str = "year", class_col: str = "class_code", measure: str = "area") -> DataFrame:
    """The class table aggregated ONCE to (key, year) composition.

    The as-of composition, the change between two years and the yearly fact
    are all derived from this panel, so the (large) class table is scanned
    and shuffled a single time. ``_rows`` counts the rows behind each line, for
    the year gate. The panel is kept in the shared checkpoint folder: its
    consumers push different year filters below the aggregate, which would
    otherwise defeat exchange reuse, and a lost executor never re-reads the
    class table.
    """
    return cut_lineage(class_composition(landuse, [key, year], class_col, measure, groups, rows_name="_rows"))


def change_from_panel(panel: DataFrame, year_start: int, year_end: int, key: str = "entity_key",
                      year: str = "year", group: str = "native") -> DataFrame:
    """Share change between two years from a (key, year) panel.

    A key without a panel row in a year has a NULL share for that year, as
    in ``composition.temporal_change`` on the raw rows.
    """
    share = f"pct_{group}"
    y = F.col(year)
    c0, c1 = f"pct_{group}_{year_start}", f"pct_{group}_{year_end}"
    agg = panel.where(y.isin(year_start, year_end)).groupBy(key).agg(
        F.max(F.when(y == year_start, F.col(share))).alias(c0),
        F.max(F.when(y == year_end, F.col(share))).alias(c1),
    )
    change = F.col(c1) - F.col(c0)
    return agg.select(key, c0, c1, change.alias(f"{group}_change_pp"),
                      (change / F.nullif(F.col(c0), F.lit(0)) * 100).alias(f"{group}_change_rate_pct"))


def base_indicators(
    dim: DataFrame,
    gdp: DataFrame,
    pop: DataFrame,
    panel: DataFrame | None,
    ref_year: int,
    crops: DataFrame | None = None,
    herd: DataFrame | None = None,
    key: str = "entity_key",
    year: str = "year",
) -> DataFrame:
    """Entity dimension LEFT JOIN the reference-year slices and the land
    composition of the as-of year, plus derived indicators.

    ``panel`` is the (key, year) composition from ``land_panel``; the as-of
    year is resolved inside the plan (a one-row broadcast), so building the
    frame runs no job.
    """
    pop_y = _year_slice(pop, key, year, ref_year, ["population"])
    gdp_y = _year_slice(gdp, key, year, ref_year, ["gdp_k"])
    crops_y = _year_slice(crops, key, year, ref_year,
                          [c for c in (crops.columns if crops is not None else []) if c not in (key, year, "name")])
    herd_y = _year_slice(herd, key, year, ref_year, ["herd_total"])
    comp = composition_as_of_lazy(panel, year, ref_year) if panel is not None else None
    joined = spine_join(dim, [pop_y, gdp_y, crops_y, herd_y, comp], key)
    return derived_indicators(joined)


def build_master(
    dim: DataFrame,
    gdp: DataFrame,
    pop: DataFrame,
    landuse: DataFrame | None,
    groups: Mapping[str, Sequence],
    ref_year: int,
    change_start: int,
    crops: DataFrame | None = None,
    herd: DataFrame | None = None,
    key: str = "entity_key",
    year: str = "year",
    class_col: str = "class_code",
    measure: str = "area",
    panel: DataFrame | None = None,
) -> DataFrame:
    """Wide entity table: base indicators LEFT JOIN the change of the native
    share between ``change_start`` and ``ref_year``.

    The change uses exact years (no as-of fallback), like the reference job.
    The panel of the class table (``land_panel``; built here unless it is
    given) feeds the as-of year, the composition and the change.
    """
    if panel is None and landuse is not None:
        panel = land_panel(landuse, groups, key, year, class_col, measure)
    if panel is not None:
        panel = panel.drop("_rows")
    base = base_indicators(dim, gdp, pop, panel, ref_year, crops, herd, key, year)
    if panel is None:
        return base
    change = change_from_panel(panel, change_start, ref_year, key, year, "native")
    return left_enrich(base, change, [key])


def clean_all(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Clean every landed extract (flat extracts, crop pivot, area dimension);
    other sources pass through unchanged."""
    from terrarank.operators.reshape import clean_area, clean_gdp, clean_herd, clean_pivot, clean_population
    cleaners = {"gdp": clean_gdp, "population": clean_population, "crops": clean_pivot,
                "herd": clean_herd, "area": clean_area}
    return {name: (cleaners[name](df) if name in cleaners and len(df.columns) > 1 else df)
            for name, df in raw.items()}


def build_fact_tables(clean: Mapping[str, DataFrame], groups: Mapping[str, Sequence],
                      key: str = "entity_key", year: str = "year", class_col: str = "class_code",
                      measure: str = "area", min_rows: int | None = None,
                      panel: DataFrame | None = None) -> dict[str, DataFrame]:
    """Star schema: entity dimension, economy fact, yearly environment fact
    (with ``min_rows``: of years with so many rows), other yearly sources passed through.
    ``panel``: the ``land_panel`` of the class table, if it has been built already."""
    facts = {"dim_entity": clean["area"]}
    facts["fact_economy"] = fact_economy(clean["gdp"], clean["population"], clean.get("crops"),
                                         clean.get("herd"), key, year)
    lu = clean.get("landuse")
    if panel is not None:
        facts["fact_environment"] = gated_panel(panel, year, min_rows) if min_rows else panel.drop("_rows")
    elif lu is not None and class_col in lu.columns:
        facts["fact_environment"] = fact_environment(lu, key, year, class_col, measure, groups, min_rows)
    for name in ("education", "deforestation", "fires", "finance", "spending", "registry"):
        if name in clean:
            facts[f"fact_{name}"] = clean[name]
    return facts


#: Sources the wide table can do without; absent ones add no columns.
OPTIONAL = ("crops", "herd", "landuse", "education", "deforestation", "fires", "finance", "spending", "registry")


def present(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The sources without the optional ones that have no row (one row at most is read of each)."""
    return {name: df for name, df in raw.items() if name not in OPTIONAL or not df.isEmpty()}


def transform(raw: Mapping[str, DataFrame], groups: Mapping[str, Sequence], ref_year: int, change_start: int,
              min_rows: int | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """Landed sources → (facts by name, wide table). Absent optional sources are left out.

    The class table is read once, for the panel that feeds both.
    """
    clean = clean_all(present(raw))
    lu = clean.get("landuse")
    panel = land_panel(lu, groups) if lu is not None else None
    facts = build_fact_tables(clean, groups, min_rows=min_rows, panel=panel)
    master = build_master(clean["area"], clean["gdp"], clean["population"], None, groups, ref_year, change_start,
                          crops=clean.get("crops"), herd=clean.get("herd"), panel=panel)
    return facts, master


def run_transform(spark, paths: Mapping[str, str], out_dir: str, groups: Mapping[str, Sequence],
                  ref_year: int, change_start: int, min_rows: int | None = None,
                  catalog: str | None = None) -> DataFrame:
    """Load → clean → facts → wide table → Parquet (facts partitioned by year).

    A rerun writes only the years of a fact whose rows changed. ``catalog``: a
    prefix under which every written dataset is also a catalog table over the
    written files. Returns the wide table as written.
    """
    from terrarank.sources import load_sources, refresh_partitions, register_dataset, write_parquet
    from terrarank.sources.sinks import remove_dataset
    facts, master = transform(load_sources(spark, paths), groups, ref_year, change_start, min_rows)
    for name, df in {**facts, "master": master}.items():
        path = f"{out_dir}/{name}"
        if name.startswith("fact_") and "year" in df.columns:
            df = df.persist()  # compared, then written
            written = not df.isEmpty()
            if written:
                refresh_partitions(df, path, "year")
            else:
                remove_dataset(spark, path)
            df.unpersist()
        else:
            written = write_parquet(df, path)
        if written and catalog is not None:
            register_dataset(spark, f"{catalog}{name}", path)
    return spark.read.schema(master.schema).parquet(f"{out_dir}/master")
