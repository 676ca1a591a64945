"""DuckDB oracle SQL for the registered queries, built from shared CTEs.

The SQL restates each query's semantics independently of the Spark plans;
the driver runs both and compares rows.
"""

from __future__ import annotations

from terrarank.config import DEFAULT_INDICATORS, ECONOMY_SUBINDEX, ENVIRONMENT_SUBINDEX
from terrarank.plans.analog import ANALOG_GROUPS, CHANGE_START, EVENT_GROUPS, REF_YEAR


def q(v) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def inlist(vals) -> str:
    return ", ".join(q(v) for v in vals)


LANDUSE = """landuse AS (
  SELECT o.o_custkey AS entity_key, o.o_orderpriority AS class_code,
         CAST(year(o.o_orderdate) AS INTEGER) AS year, l.l_quantity AS area
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

EVENTS_LONG = """ev AS (
  SELECT user_id AS entity_key, event_type AS class_code, CAST(year(ts) AS INTEGER) AS year, value AS area
  FROM events)"""

DIM = """dim AS (
  SELECT c.c_custkey AS entity_key, c.c_name AS name, n.n_name AS state, r.r_name AS region,
         ABS(c.c_acctbal) AS area_km2
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
                  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""

GDP = """gdp AS (
  SELECT o_custkey AS entity_key, CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS gdp_k
  FROM orders GROUP BY 1, 2)"""

POP = """pop AS (
  SELECT o.o_custkey AS entity_key, CAST(year(l.l_shipdate) AS INTEGER) AS year,
         CAST(COUNT(*) AS DOUBLE) AS population
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2)"""

HERD = """herd AS (
  SELECT o_custkey AS entity_key, CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(COUNT(*) AS DOUBLE) AS herd_total
  FROM orders GROUP BY 1, 2)"""

CROPS = """crops AS (
  SELECT o.o_custkey AS entity_key, CAST(year(l.l_shipdate) AS INTEGER) AS year,
         SUM(l.l_quantity) AS crop_production_t,
         CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS crop_value_k,
         SUM(l.l_quantity * (1 - l.l_discount)) AS planted_area_ha
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2)"""


def composition_select(src: str, keys: list[str], groups=ANALOG_GROUPS, where: str = "") -> str:
    m = "COALESCE(area, 0)"
    parts = [f"SUM({m}) AS total_area"]
    for g, codes in groups.items():
        parts.append(f"SUM(CASE WHEN class_code IN ({inlist(codes)}) THEN {m} ELSE 0 END) AS {g}_area")
    for g, codes in groups.items():
        parts.append(f"SUM(CASE WHEN class_code IN ({inlist(codes)}) THEN {m} ELSE 0 END) "
                     f"/ NULLIF(SUM({m}), 0) * 100 AS pct_{g}")
    k = ", ".join(keys)
    w = f" WHERE {where}" if where else ""
    return f"SELECT {k}, " + ", ".join(parts) + f" FROM {src}{w} GROUP BY {k}"


def change_select(src: str, y0: int, y1: int, codes=ANALOG_GROUPS["native"], name: str = "native") -> str:
    m = "COALESCE(area, 0)"
    mem = f"class_code IN ({inlist(codes)})"

    def pct(y):
        return (f"CASE WHEN COUNT(*) FILTER (WHERE year = {y}) > 0 THEN "
                f"SUM(CASE WHEN year = {y} AND {mem} THEN {m} WHEN year = {y} THEN 0 END) "
                f"/ NULLIF(SUM(CASE WHEN year = {y} THEN {m} END), 0) * 100 END")
    c0, c1 = f"pct_{name}_{y0}", f"pct_{name}_{y1}"
    return (f"SELECT entity_key, {c0}, {c1}, {c1} - {c0} AS {name}_change_pp, "
            f"({c1} - {c0}) / NULLIF({c0}, 0) * 100 AS {name}_change_rate_pct FROM ("
            f"SELECT entity_key, {pct(y0)} AS {c0}, {pct(y1)} AS {c1} FROM {src} "
            f"WHERE year IN ({y0}, {y1}) GROUP BY entity_key) t")


COMP_COLS = ["total_area"] + [f"{g}_area" for g in ANALOG_GROUPS] + [f"pct_{g}" for g in ANALOG_GROUPS]


def master_ctes(ref_year: int = REF_YEAR, change_start: int = CHANGE_START) -> str:
    comp = composition_select("landuse", ["entity_key"], where=f"year = {ref_year}")
    change = change_select("landuse", change_start, ref_year)
    comp_cols = ", ".join(f"cp.{c}" for c in COMP_COLS)
    return ",\n".join([
        LANDUSE, DIM, GDP, POP, HERD, CROPS,
        f"comp AS ({comp})",
        f"chg AS ({change})",
        f"""master AS (
  SELECT d.entity_key, d.name, d.state, d.region, d.area_km2,
         p.population, g.gdp_k, c.crop_production_t, c.crop_value_k, c.planted_area_ha, h.herd_total,
         {comp_cols},
         NULLIF(g.gdp_k, 0) * 1000 / NULLIF(p.population, 0) AS gdp_per_capita,
         NULLIF(g.gdp_k, 0) * 1000 / NULLIF(d.area_km2, 0) AS gdp_per_km2,
         NULLIF(p.population, 0) / NULLIF(d.area_km2, 0) AS pop_density,
         c.planted_area_ha / (NULLIF(d.area_km2, 0) * 100) * 100 AS pct_cropped_area,
         h.herd_total / NULLIF(d.area_km2, 0) AS herd_per_km2,
         cp.pct_native AS conservation_index, cp.pct_forest AS forest_index,
         cp.pct_agro / (NULLIF(cp.pct_native, 0) + 1) AS pressure_index,
         ch.pct_native_{change_start}, ch.pct_native_{ref_year}, ch.native_change_pp, ch.native_change_rate_pct
  FROM dim d
  LEFT JOIN (SELECT entity_key, population FROM pop WHERE year = {ref_year}) p ON d.entity_key = p.entity_key
  LEFT JOIN (SELECT entity_key, gdp_k FROM gdp WHERE year = {ref_year}) g ON d.entity_key = g.entity_key
  LEFT JOIN (SELECT * FROM crops WHERE year = {ref_year}) c ON d.entity_key = c.entity_key
  LEFT JOIN (SELECT entity_key, herd_total FROM herd WHERE year = {ref_year}) h ON d.entity_key = h.entity_key
  LEFT JOIN comp cp ON d.entity_key = cp.entity_key
  LEFT JOIN chg ch ON d.entity_key = ch.entity_key)""",
    ])


IND = [i.name for i in DEFAULT_INDICATORS]


def sql_quantile(col: str, p: float) -> str:
    """Exact linear-interpolated quantile of ``col`` (aggregate context)."""
    lst = f"list_sort(list({col}) FILTER (WHERE {col} IS NOT NULL))"
    pos = f"((len({lst}) - 1) * CAST({p} AS DOUBLE))"
    v1 = f"{lst}[CAST(floor({pos}) AS BIGINT) + 1]"
    v2 = f"{lst}[CAST(ceil({pos}) AS BIGINT) + 1]"
    return (f"(CASE WHEN floor({pos}) = ceil({pos}) OR {v1} = {v2} THEN {v1} "
            f"ELSE (ceil({pos}) - {pos}) * {v1} + ({pos} - floor({pos})) * {v2} END)")


def norm_ctes(indicators=DEFAULT_INDICATORS) -> str:
    """o (oriented) → st (median/min/max) → nm (normalised) over ``master``."""
    o_cols = ", ".join(f"{'-' if i.direction == -1 else ''}CAST({i.name} AS DOUBLE) AS {i.name}" for i in indicators)
    st_cols = ", ".join(f"{sql_quantile(i.name, 0.5)} AS med_{i.name}, MIN({i.name}) AS lo_{i.name}, MAX({i.name}) AS hi_{i.name}"
                        for i in indicators)
    nm_cols = ", ".join(
        f"CASE WHEN st.hi_{i.name} = st.lo_{i.name} THEN 0.0 ELSE "
        f"(COALESCE(o.{i.name}, st.med_{i.name}) - st.lo_{i.name}) / (st.hi_{i.name} - st.lo_{i.name}) * 100 END "
        f"AS {i.name}" for i in indicators)
    return (f"o AS (SELECT entity_key, name, state, region, {o_cols} FROM master),\n"
            f"st AS (SELECT {st_cols}, COUNT(*) AS n FROM o),\n"
            f"nm AS (SELECT o.entity_key, o.name, o.state, o.region, {nm_cols} FROM o CROSS JOIN st)")


def entropy_ctes(indicators=DEFAULT_INDICATORS) -> str:
    names = [i.name for i in indicators]
    row_sum = " + ".join(f"({n} + CAST(1e-6 AS DOUBLE))" for n in names)
    s_cols = ", ".join(
        f"SUM((({n} + CAST(1e-6 AS DOUBLE)) / row_sum) * LN(({n} + CAST(1e-6 AS DOUBLE)) / row_sum + CAST(1e-10 AS DOUBLE))) AS s_{n}"
        for n in names)
    e_cols = ", ".join(f"1 - (-s_{n} / LN(n)) AS d_{n}" for n in names)
    dsum = " + ".join(f"d_{n}" for n in names)
    w_cols = ", ".join(f"d_{n} / ({dsum}) AS w_{n}" for n in names)
    return (f"rs AS (SELECT nm.*, {row_sum} AS row_sum FROM nm),\n"
            f"es AS (SELECT {s_cols}, COUNT(*) AS n FROM rs),\n"
            f"ed AS (SELECT {e_cols} FROM es),\n"
            f"ew AS (SELECT {w_cols} FROM ed)")


def entropy_score_ctes(indicators=DEFAULT_INDICATORS) -> str:
    names = [i.name for i in indicators]
    raw = " + ".join(f"nm.{n} * ew.w_{n}" for n in names)
    return (f"sc AS (SELECT nm.*, {raw} AS raw FROM nm CROSS JOIN ew),\n"
            f"smm AS (SELECT MIN(raw) AS lo, MAX(raw) AS hi FROM sc),\n"
            f"ranked AS (SELECT sc.*, ROUND(CASE WHEN smm.hi = smm.lo THEN NULL ELSE "
            f"(raw - smm.lo) / (smm.hi - smm.lo) * 100 END, 6) + 0.0 AS score FROM sc CROSS JOIN smm),\n"
            f"ranking AS (SELECT ranked.*, CASE WHEN score IS NULL THEN NULL ELSE "
            f"CAST(RANK() OVER (ORDER BY score DESC NULLS LAST) AS BIGINT) END AS rank FROM ranked)")


def index_prefix() -> str:
    return "WITH " + master_ctes() + ",\n" + norm_ctes() + ",\n" + entropy_ctes() + ",\n" + entropy_score_ctes()


def subindex_cols(prefix: str = "") -> str:
    env = [c for c in ENVIRONMENT_SUBINDEX if c in IND]
    eco = [c for c in ECONOMY_SUBINDEX if c in IND]
    envx = " + ".join(f"{prefix}{c}" for c in env)
    ecox = " + ".join(f"{prefix}{c}" for c in eco)
    return f"({envx}) / {len(env)} AS subindex_environment, ({ecox}) / {len(eco)} AS subindex_economy"


