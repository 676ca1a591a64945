"""Cleaning and reshaping: flat extracts, long→wide pivots, wide→long melts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrarank.config import CROP_VARIABLES, FLAT_EXTRACT_ALIASES
from terrarank.functions import normalize_key, to_integer, to_numeric
from terrarank.sources.harmonize import harmonize_columns


def clean_flat(
    df: DataFrame,
    value_col: str,
    aliases: Mapping[str, Sequence[str]] = FLAT_EXTRACT_ALIASES,
    key: str = "entity_key",
    name: str = "name",
    year: str = "year",
) -> DataFrame:
    """Flat statistics extract → (key, name?, year, value).

    Keys are normalised, the ``..`` marker and unparseable values become NULL,
    rows without key or year are dropped; rows with a NULL value are kept.
    """
    targets = {key: aliases["key"], year: aliases["year"], value_col: aliases["value"]}
    if any(a in df.columns for a in aliases.get("name", ())):
        targets[name] = aliases["name"]
    h = harmonize_columns(df, targets)
    if key not in h.columns:
        raise ValueError("no key column among the aliases")
    cols = [normalize_key(key).alias(key)]
    if name in h.columns:
        cols.append(F.col(name).cast("string").alias(name))
    cols.append(to_integer(year).alias(year) if year in h.columns else F.lit(None).cast("int").alias(year))
    cols.append(to_numeric(value_col).alias(value_col) if value_col in h.columns
                else F.lit(None).cast("double").alias(value_col))
    return h.select(*cols).dropna(subset=[key, year])


def clean_gdp(df: DataFrame, **kw) -> DataFrame:
    """GDP extract → (key, name?, year, gdp_k)."""
    return clean_flat(df, "gdp_k", **kw)


def clean_population(df: DataFrame, **kw) -> DataFrame:
    """Population extract → (key, name?, year, population)."""
    return clean_flat(df, "population", **kw)


def clean_herd(df: DataFrame, **kw) -> DataFrame:
    """Herd extract → (key, name?, year, herd_total)."""
    return clean_flat(df, "herd_total", **kw)


def keep_entity_level(df: DataFrame, raw_key: str, width: int = 7) -> DataFrame:
    """Drop aggregate rows (state/country totals) whose raw key is not ``width``
    characters long. Applied to the raw key, before normalisation pads it."""
    return df.where(F.length(F.trim(F.col(raw_key).cast("string"))) == width)


def clean_pivot(
    df: DataFrame,
    variables: Mapping[int, str] = CROP_VARIABLES,
    key: str = "entity_key",
    year: str = "year",
    var_col: str = "D3C",
    value_col: str = "V",
    key_col: str = "D1C",
    year_col: str = "D2C",
) -> DataFrame:
    """Long variable/value extract → one row per (key, year), one column per variable.

    Unknown variable codes and NULL values are dropped first; duplicates are
    summed. The pivot values are a fixed list, so no extra job discovers them
    and the output schema is stable even when a variable is absent.
    """
    codes = list(variables)
    names = [variables[c] for c in codes]
    code = to_integer(var_col)
    long = df.select(
        normalize_key(key_col).alias(key),
        to_integer(year_col).alias(year),
        code.alias("_code"),
        to_numeric(value_col).alias("_value"),
    ).where(F.col("_code").isin(codes) & F.col("_value").isNotNull())
    return pivot_sum(long, [key, year], "_code", codes, "_value", names)


def pivot_sum(df: DataFrame, keys: Sequence[str], pivot_col: str, values: Sequence,
              measure: str, names: Sequence[str] | None = None) -> DataFrame:
    """Fixed-list pivot with sum (absent combinations are NULL).

    Written as conditional sums in ONE hash aggregate: one shuffle, where
    ``groupBy().pivot()`` plans two aggregations."""
    names = list(names) if names else [str(v) for v in values]
    p = F.col(pivot_col)
    return df.groupBy(*keys).agg(*[F.sum(F.when(p == F.lit(v), F.col(measure))).alias(n)
                                   for v, n in zip(values, names)])


def clean_area(df: DataFrame, key: str = "entity_key", name: str = "name", state: str = "state",
               area: str = "area_km2", state_from_key: Mapping | None = None) -> DataFrame:
    """Dimension standardisation: normalised key, name, optional state, numeric area."""
    cols = [normalize_key(key).alias(key)]
    if name in df.columns:
        cols.append(F.col(name).cast("string").alias(name))
    if state in df.columns:
        cols.append(F.col(state).cast("string").alias(state))
    elif state_from_key:
        from terrarank.functions import code_label
        cols.append(code_label(F.substring(normalize_key(key), 1, 2), state_from_key).alias(state))
    cols.append(to_numeric(area).alias(area))
    return df.select(*cols).dropna(subset=[key])


def melt_years(
    df: DataFrame,
    ids: Sequence[str],
    year: str = "year",
    value: str = "area",
    first_year: int = 1985,
    last_year: int = 2024,
) -> DataFrame:
    """Wide table with one column per year → long (ids, year, value).

    Year columns are recognised by an all-digit name within the range. Values
    are coerced to numbers; NULL and non-positive values are dropped.
    """
    year_cols = [c for c in df.columns if str(c).isdigit() and first_year <= int(c) <= last_year]
    if not year_cols:
        return df.select(*ids, F.lit(None).cast("int").alias(year), F.lit(None).cast("double").alias(value)).limit(0)
    cast_cols = [to_numeric(F.col(f"`{c}`")).alias(c) for c in year_cols]
    wide = df.select(*ids, *cast_cols)
    long = wide.unpivot(list(ids), year_cols, year, value)
    return (
        long.select(*ids, F.col(year).cast("int").alias(year), F.col(value))
        .where(F.col(value).isNotNull() & (F.col(value) > 0))
    )


def dedup_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the row with the smallest ``order_by`` tuple.

    Implemented as ``min_by`` in a hash aggregate (partial aggregation, no sort,
    no single hot task), not ``dropDuplicates`` which keeps an arbitrary row.
    Without ``order_by`` the remaining columns themselves are the tie-break.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    if not order_by and len(rest) == 1:
        # a single value column: its smallest value, as a plain hash aggregate
        return df.groupBy(*keys).agg(F.min(rest[0]).alias(rest[0]))
    order = list(order_by) if order_by else rest
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order])).alias("_first")
    )
    return picked.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in rest])
