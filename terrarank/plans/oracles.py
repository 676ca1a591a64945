"""Oracle SQL (DuckDB dialect) for each registered query, keyed like the catalog."""

from __future__ import annotations

from terrarank.config import DEFAULT_INDICATORS, FEATURE_COLS, LAND_COVER_LABELS
from terrarank.plans.analog import (
    ABSENT_INDICATOR, ASOF_REF_YEAR, CHANGE_END, KPI_STATES, CHANGE_START, EVENT_GROUPS, GATE_MIN_ROWS, LEAF_WISE_SMALL, REF_YEAR, SECOND_ORDER_SMALL,
    TREE_CUTS,
)
from terrarank.plans.sqlparts import (
    COMP_COLS, DIM, DIM as DIM_SQL, EVENTS_LONG, GDP, HERD, IND, LANDUSE, POP, CROPS, change_select, composition_select,
    entropy_ctes, entropy_score_ctes, index_prefix, inlist, sql_quantile, master_ctes, norm_ctes, q, subindex_cols,
)

NUM_RE = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def r6(expr: str, alias: str) -> str:
    # "+ 0.0" turns DuckDB's -0.0 (from rounding tiny negatives or negating 0)
    # into +0.0, as Spark's round() returns
    return f"ROUND({expr}, 6) + 0.0 AS {alias}"


def round_all(cols: list[str], src: str = "") -> str:
    p = f"{src}." if src else ""
    return ", ".join(r6(f"{p}{c}", c) for c in cols)


COMP_R = round_all(COMP_COLS)


def sql_numeric(s: str) -> str:
    return (f"CASE WHEN regexp_matches(NULLIF(CAST({s} AS VARCHAR), '..'), '{NUM_RE}') "
            f"THEN TRY_CAST(trim(CAST({s} AS VARCHAR)) AS DOUBLE) END")


def sql_normalize_key(s: str) -> str:
    d = f"CAST(CAST(trunc({sql_numeric(s)}) AS BIGINT) AS VARCHAR)"
    return (f"(CASE WHEN length({d}) >= 7 THEN substr({d}, 1, 7) "
            f"WHEN {d} LIKE '-%' THEN '-' || lpad(substr({d}, 2), 6, '0') ELSE lpad({d}, 7, '0') END)")


def _events_rank() -> str:
    comp = composition_select("ev", ["entity_key"], groups=EVENT_GROUPS)
    cols = ["total_area"] + [f"{g}_area" for g in EVENT_GROUPS] + [f"pct_{g}" for g in EVENT_GROUPS]
    return (f"WITH {EVENTS_LONG}, c AS ({comp}), "
            f"r AS (SELECT entity_key, {round_all(cols)}, "
            f"ROUND(pct_agro / (NULLIF(pct_native, 0) + 1), 6) + 0.0 AS pressure_index FROM c) "
            f"SELECT r.*, CASE WHEN pct_native IS NULL THEN NULL ELSE "
            f"CAST(RANK() OVER (ORDER BY pct_native DESC NULLS LAST) AS BIGINT) END AS rank FROM r")


def _comp(keys, where=""):
    inner = composition_select("landuse", keys, where=where)
    return f"WITH {LANDUSE} SELECT {', '.join(keys)}, {COMP_R} FROM ({inner}) t"


def _year_gate():
    inner = composition_select(
        "shipped", ["entity_key", "year"],
        where=f"year IN (SELECT year FROM shipped GROUP BY year HAVING COUNT(*) >= {GATE_MIN_ROWS})")
    shipped = ("shipped AS (SELECT o.o_custkey AS entity_key, o.o_orderpriority AS class_code, "
               "CAST(year(l.l_shipdate) AS INTEGER) AS year, l.l_quantity AS area "
               "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)")
    return f"WITH {shipped} SELECT entity_key, year, {COMP_R} FROM ({inner}) t"


def _change():
    ch = change_select("landuse", CHANGE_START, CHANGE_END)
    cols = [f"pct_native_{CHANGE_START}", f"pct_native_{CHANGE_END}", "native_change_pp", "native_change_rate_pct"]
    return f"WITH {LANDUSE} SELECT entity_key, {round_all(cols)} FROM ({ch}) t"


def _asof():
    y = f"COALESCE((SELECT MAX(year) FROM landuse WHERE year <= {ASOF_REF_YEAR}), (SELECT MIN(year) FROM landuse))"
    inner = composition_select("landuse", ["entity_key"], where=f"year = {y}")
    return (f"WITH {LANDUSE} SELECT entity_key, {COMP_R}, CAST({y} AS INTEGER) AS asof_year FROM ({inner}) t")


def _pivot_classes():
    codes = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    names = ["urgent_area", "high_area", "medium_area", "not_specified_area", "low_area"]
    cols = ", ".join(f"ROUND(SUM(CASE WHEN class_code = {q(c)} THEN area END), 6) + 0.0 AS {n}" for c, n in zip(codes, names))
    return f"WITH {LANDUSE} SELECT entity_key, year, {cols} FROM landuse GROUP BY entity_key, year"


def _unpivot():
    return (f"WITH {LANDUSE} SELECT entity_key, class_code, year, ROUND(SUM(area), 6) + 0.0 AS area FROM landuse "
            f"WHERE year BETWEEN 1985 AND 2024 GROUP BY entity_key, class_code, year HAVING SUM(area) > 0")


MASTER_COLS = [
    "area_km2", "population", "gdp_k", "crop_production_t", "crop_value_k", "planted_area_ha", "herd_total",
    *COMP_COLS, "gdp_per_capita", "gdp_per_km2", "pop_density", "pct_cropped_area", "herd_per_km2",
    "conservation_index", "forest_index", "pressure_index", f"pct_native_{CHANGE_START}", f"pct_native_{REF_YEAR}",
    "native_change_pp", "native_change_rate_pct",
]


def _master():
    return (f"WITH {master_ctes()} SELECT entity_key, name, state, region, {round_all(MASTER_COLS)} FROM master")


def _economy():
    cols = ["gdp_k", "population", "crop_production_t", "crop_value_k", "planted_area_ha", "herd_total"]
    return (f"WITH {GDP}, {POP}, {HERD}, {CROPS}, "
            f"e AS (SELECT COALESCE(g.entity_key, p.entity_key) AS entity_key, COALESCE(g.year, p.year) AS year, "
            f"g.gdp_k, p.population FROM gdp g FULL OUTER JOIN pop p ON g.entity_key = p.entity_key AND g.year = p.year) "
            f"SELECT e.entity_key, e.year, {round_all(cols[:2], 'e')}, {round_all(cols[2:5], 'c')}, "
            f"{r6('h.herd_total', 'herd_total')} FROM e "
            f"LEFT JOIN crops c ON e.entity_key = c.entity_key AND e.year = c.year "
            f"LEFT JOIN herd h ON e.entity_key = h.entity_key AND e.year = h.year")


def _normalize_keys():
    return (f"SELECT o_orderkey, {sql_normalize_key('o_totalprice')} AS key_from_price, "
            f"{sql_normalize_key('o_orderkey')} AS key_from_id, "
            f"{sql_normalize_key(chr(40) + 'CAST(o_custkey AS VARCHAR) || ' + q('0000') + chr(41))} AS key_from_long, "
            f"CASE WHEN regexp_matches(trim(CAST(o_totalprice AS VARCHAR)), '^[0-9]+$') "
            f"THEN {sql_normalize_key('o_totalprice')} END AS key_guarded FROM orders")


def _coerce():
    k = "NULLIF(regexp_extract(props, ':\\s*([0-9]+)', 1), '')"
    return (f"SELECT event_id, ROUND({sql_numeric('value')}, 6) + 0.0 AS value_num, "
            f"ROUND({sql_numeric('props')}, 6) + 0.0 AS props_num, ROUND({sql_numeric('event_type')}, 6) + 0.0 AS type_num, "
            f"ROUND({sql_numeric(k)}, 6) + 0.0 AS k_num FROM events")


def _code_labels():
    cases = " ".join(f"WHEN {k} THEN {q(v)}" for k, v in LAND_COVER_LABELS.items())
    return f"SELECT p_partkey, p_size, CASE p_size {cases} END AS class_label FROM part"


def _detect_key():
    return (
        "WITH sheet AS (SELECT l_orderkey * 100 + l_linenumber AS row_no, CAST(l_orderkey AS VARCHAR) AS order_ref, "
        "l_returnflag AS flag, CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS price_cents "
        "FROM lineitem), "
        "s AS (SELECT 'order_ref' AS \"column\", 0 AS position, row_no, order_ref AS v FROM sheet "
        "UNION ALL SELECT 'flag', 1, row_no, flag FROM sheet "
        "UNION ALL SELECT 'price_cents', 2, row_no, price_cents FROM sheet), "
        "h AS (SELECT *, row_number() OVER (PARTITION BY \"column\" ORDER BY row_no) AS rn FROM s WHERE v IS NOT NULL) "
        "SELECT \"column\", CAST(position AS INTEGER) AS position, "
        "bool_or(regexp_matches(v, '^[0-9]{6,7}$')) AS is_key FROM h WHERE rn <= 20 GROUP BY 1, 2")


def _harmonized_union():
    def part(status):
        return (f"SELECT {sql_normalize_key('CAST(o_custkey AS VARCHAR)')} AS entity_key, "
                f"CAST(year(o_orderdate) AS INTEGER) AS year, ROUND({sql_numeric('o_totalprice')}, 6) + 0.0 AS order_value, "
                f"{q(status)} AS status FROM orders WHERE o_orderstatus = {q(status)}")
    return " UNION ALL ".join(part(s) for s in ("F", "O", "P"))


def _source_status():
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
    parts = [f"SELECT {q(n)} AS source, COUNT(*) AS rows FROM {n}" for n in names]
    return (f"SELECT source, rows, CASE WHEN rows > 100 THEN 'REAL' ELSE 'STUB' END AS status FROM "
            f"({' UNION ALL '.join(parts)}) t")


def _minmax():
    return f"WITH {master_ctes()}, {norm_ctes()} SELECT entity_key, {round_all(IND)} FROM nm"


def _median_impute():
    sel = " UNION ALL ".join(
        f"SELECT {q(i)} AS indicator, ROUND(med_{i}, 6) + 0.0 AS median, ROUND(lo_{i}, 6) + 0.0 AS min, ROUND(hi_{i}, 6) + 0.0 AS max FROM st"
        for i in IND)
    return f"WITH {master_ctes()}, {norm_ctes()} {sel}"


def _entropy_weights():
    sel = " UNION ALL ".join(f"SELECT {q(i)} AS indicator, ROUND(w_{i}, 6) + 0.0 AS weight FROM ew" for i in IND)
    return f"{index_prefix()} {sel}"


def _entropy_rank():
    return f"{index_prefix()} SELECT entity_key, score, rank FROM ranking"


def _subindices():
    return (f"{index_prefix()} SELECT entity_key, ROUND(subindex_environment, 6) + 0.0 AS subindex_environment, "
            f"ROUND(subindex_economy, 6) + 0.0 AS subindex_economy FROM (SELECT entity_key, {subindex_cols()} FROM ranking) t")


def _topn(n, desc=True):
    order = "score DESC NULLS LAST, entity_key" if desc else "score ASC NULLS LAST, entity_key"
    return f"{index_prefix()} SELECT entity_key, name, state, score, rank FROM ranking ORDER BY {order} LIMIT {n}"


def _mean_by(group):
    return (f"{index_prefix()} SELECT {group}, COUNT(*) AS entities, ROUND(AVG(score), 6) + 0.0 AS mean_score "
            f"FROM ranking GROUP BY {group}")


def _group_rank():
    return (f"{index_prefix()}, g AS (SELECT state, COUNT(*) AS entities, ROUND(AVG(score), 6) + 0.0 AS mean_score "
            f"FROM ranking GROUP BY state) SELECT g.*, CAST(RANK() OVER (ORDER BY mean_score DESC NULLS LAST) "
            f"AS BIGINT) AS state_rank, COUNT(*) OVER () AS of FROM g")


DISPLAY = ("disp AS (SELECT r.entity_key, r.name, r.state, r.region, r.score, r.rank, m.pct_native, m.pct_forest, "
           "m.pct_agro, m.gdp_per_capita, m.native_change_pp, m.population "
           "FROM ranking r LEFT JOIN master m ON r.entity_key = m.entity_key)")


def _threshold():
    return (f"{index_prefix()}, {DISPLAY} SELECT COUNT(*) FILTER (WHERE pct_native < 10) AS native_below_10, "
            f"COUNT(*) FILTER (WHERE pct_native > 80) AS native_above_80, "
            f"COUNT(*) FILTER (WHERE score < 25) AS score_below_25, COUNT(*) AS entities FROM disp")


def _kpis():
    states = inlist(KPI_STATES)
    return (f"{index_prefix()}, {DISPLAY} SELECT COUNT(*) AS entities, ROUND(AVG(score), 6) + 0.0 AS mean_score, "
            f"ROUND(MAX(score), 6) + 0.0 AS max_score, ROUND(AVG(pct_native), 6) + 0.0 AS mean_pct_native, "
            f"ROUND(AVG(gdp_per_capita), 6) + 0.0 AS mean_gdp_per_capita FROM disp "
            f"WHERE population BETWEEN 2.0 AND 40.0 AND state IN ({states})")


def _profile_lookup():
    sel = " UNION ALL ".join(f"SELECT entity_key, {q(i)} AS indicator, ROUND({i}, 6) + 0.0 AS value FROM ranking "
                             f"WHERE entity_key = 7" for i in IND)
    return f"{index_prefix()} {sel}"


def _score_corr():
    cols = ["gdp_per_capita", "pct_native", "pct_agro"]
    sel = " UNION ALL ".join(f"SELECT {q(c)} AS indicator, ROUND(corr(score, {c}), 6) + 0.0 AS r FROM disp" for c in cols)
    return f"{index_prefix()}, {DISPLAY} {sel}"


def _corr_matrix():
    cols = MASTER_COLS
    parts = []
    for i, a in enumerate(cols):
        parts.append(f"SELECT {q(a)} AS x, {q(a)} AS y, CAST(1.0 AS DOUBLE) AS r")
        for b in cols[i + 1:]:
            parts.append(f"SELECT {q(a)} AS x, {q(b)} AS y, ROUND(corr({a}, {b}), 6) + 0.0 AS r FROM master")
            parts.append(f"SELECT {q(b)} AS x, {q(a)} AS y, ROUND(corr({a}, {b}), 6) + 0.0 AS r FROM master")
    return f"WITH {master_ctes()} " + " UNION ALL ".join(parts)


def _ols():
    return (f"{index_prefix()}, {DISPLAY} SELECT state, ROUND(regr_slope(score, gdp_per_capita), 6) + 0.0 AS slope, "
            f"ROUND(regr_intercept(score, gdp_per_capita), 6) + 0.0 AS intercept, "
            f"ROUND(regr_r2(score, gdp_per_capita), 6) + 0.0 AS r2, CAST(regr_count(score, gdp_per_capita) AS BIGINT) AS n "
            f"FROM disp WHERE score IS NOT NULL AND gdp_per_capita IS NOT NULL GROUP BY state")


def _histogram():
    return (f"WITH {master_ctes()}, v AS (SELECT native_change_pp AS x FROM master WHERE native_change_pp IS NOT NULL), "
            f"b AS (SELECT MIN(x) AS lo, MAX(x) AS hi FROM v), "
            f"h AS (SELECT CAST(COALESCE(LEAST(FLOOR((x - lo) / NULLIF((hi - lo) / 50, 0)), 49), 0) AS INTEGER) AS bin, "
            f"COUNT(*) AS count FROM v CROSS JOIN b GROUP BY 1) "
            f"SELECT bin, ROUND(lo + bin * ((hi - lo) / 50), 6) + 0.0 AS bin_start, "
            f"ROUND(lo + (bin + 1) * ((hi - lo) / 50), 6) + 0.0 AS bin_end, count FROM h CROSS JOIN b")


def _box():
    return (f"{index_prefix()} SELECT region, MIN(score) AS min, MAX(score) AS max, "
            f"COUNT(score) AS n, {sql_quantile('score', 0.25)} AS q1, "
            f"{sql_quantile('score', 0.5)} AS median, "
            f"{sql_quantile('score', 0.75)} AS q3 FROM ranking WHERE region IS NOT NULL GROUP BY region")


def _group_summary():
    return (f"{index_prefix()}, {DISPLAY} SELECT state, COUNT(entity_key) AS entities, "
            f"round_even(AVG(score), 2) AS mean_score, round_even(AVG(pct_native), 2) AS mean_pct_native, "
            f"round_even(AVG(gdp_per_capita), 2) AS mean_gdp_per_capita FROM disp WHERE state IS NOT NULL GROUP BY state")


def _global_rank():
    return ("SELECT o_orderkey, o_totalprice, CAST(RANK() OVER (ORDER BY o_totalprice DESC) AS BIGINT) AS rank "
            "FROM orders")


def _bucketed_rank():
    return ("SELECT l_orderkey, l_linenumber, l_extendedprice, "
            "CAST(RANK() OVER (ORDER BY l_extendedprice DESC) AS BIGINT) AS rank FROM lineitem")


def _event_counts():
    return "SELECT user_id, COUNT(*) AS events, 2024 AS year FROM events GROUP BY user_id"


def _distinct_entities():
    return (f"WITH {LANDUSE} SELECT (SELECT COUNT(DISTINCT entity_key) FROM landuse) AS distinct_entities, "
            f"(SELECT COUNT(DISTINCT year) FROM landuse) AS years")


FEATURES = ["gdp_per_capita", "pop_density", "pct_native", "pct_forest", "pct_agro", "pct_urban",
            "native_change_pp", "pressure_index", "area_km2", "population", "herd_per_km2"]


def _prepare_features():
    cols = ", ".join(f"ROUND(CAST(m.{c} AS DOUBLE), 6) + 0.0 AS {c}" for c in FEATURES)
    return (f"{index_prefix()} SELECT m.entity_key, {cols}, r.score AS label "
            f"FROM master m JOIN ranking r ON m.entity_key = r.entity_key")


def _standardize():
    meds = ", ".join(f"{sql_quantile(c, 0.5)} AS med_{c}" for c in FEATURES)
    imp = ", ".join(f"COALESCE(CAST(m.{c} AS DOUBLE), md.med_{c}) AS {c}" for c in FEATURES)
    mom = ", ".join(f"AVG({c}) AS mean_{c}, stddev_pop({c}) AS sd_{c}" for c in FEATURES)
    sc = ", ".join(f"ROUND(({c} - mean_{c}) / (CASE WHEN sd_{c} = 0 OR sd_{c} IS NULL THEN 1 ELSE sd_{c} END), 6) + 0.0 AS {c}"
                   for c in FEATURES)
    return (f"WITH {master_ctes()}, md AS (SELECT {meds} FROM master), "
            f"imp AS (SELECT m.entity_key, {imp} FROM master m CROSS JOIN md), mo AS (SELECT {mom} FROM imp) "
            f"SELECT entity_key, {sc} FROM imp CROSS JOIN mo")


def _clean_pivot():
    v = sql_numeric("v_txt")
    return (
        "WITH raw AS (SELECT CAST(o.o_custkey AS VARCHAR) AS k_txt, CAST(CAST(year(l.l_shipdate) AS INTEGER) AS VARCHAR) AS y_txt, "
        "s.code AS code, CAST(s.val AS VARCHAR) AS v_txt FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey, "
        "LATERAL (SELECT * FROM (VALUES (214, l.l_quantity), (215, l.l_extendedprice), "
        "(216, l.l_quantity * (1 - l.l_discount))) t(code, val)) s), "
        f"p AS (SELECT {sql_normalize_key('k_txt')} AS entity_key, CAST(y_txt AS INTEGER) AS year, code, {v} AS value "
        "FROM raw) "
        "SELECT entity_key, year, ROUND(SUM(CASE WHEN code = 214 THEN value END), 6) + 0.0 AS crop_production_t, "
        "ROUND(SUM(CASE WHEN code = 215 THEN value END), 6) + 0.0 AS crop_value_k, "
        "ROUND(SUM(CASE WHEN code = 216 THEN value END), 6) + 0.0 AS planted_area_ha "
        "FROM p WHERE value IS NOT NULL AND code IN (214, 215, 216) GROUP BY entity_key, year")


def _clean_area():
    return (f"WITH {DIM_SQL} SELECT {sql_normalize_key('CAST(entity_key AS VARCHAR)')} AS entity_key, name, state, "
            f"ROUND({sql_numeric('CAST(area_km2 AS VARCHAR)')}, 6) + 0.0 AS area_km2 FROM dim")


ORACLES = {
    "clean_pivot_extract": _clean_pivot(),
    "clean_area_dim": _clean_area(),
    "prepare_features": _prepare_features(),
    "standardize": _standardize(),
    "events_composition_rank": _events_rank(),
    "composition_by_entity": _comp(["entity_key"], where=f"year = {REF_YEAR}"),
    "composition_by_entity_year": _comp(["entity_key", "year"]),
    "year_gate": _year_gate(),
    "temporal_change": _change(),
    "asof_year_composition": _asof(),
    "national_series": _comp(["year"]),
    "event_counts": _event_counts(),
    "distinct_entities": _distinct_entities(),
    "pivot_sum_classes": _pivot_classes(),
    "unpivot_years": _unpivot(),
    "spine_join_master": _master(),
    "economy_full_outer": _economy(),
    "normalize_keys": _normalize_keys(),
    "coerce_numeric": _coerce(),
    "code_labels": _code_labels(),
    "json_flatten": "SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS INTEGER) AS props_k FROM events",
    "detect_key_column": _detect_key(),
    "harmonized_union": _harmonized_union(),
    "source_status": _source_status(),
    "minmax_scores": _minmax(),
    "median_impute": _median_impute(),
    "entropy_weights": _entropy_weights(),
    "entropy_index_rank": _entropy_rank(),
    "subindices": _subindices(),
    "global_rank_min": _global_rank(),
    "bucketed_rank": _bucketed_rank(),
    "group_rank": _group_rank(),
    "topn": _topn(50),
    "bottomn": _topn(20, desc=False),
    "score_by_state": _mean_by("state"),
    "score_by_region": _mean_by("region"),
    "threshold_counts": _threshold(),
    "filtered_kpis": _kpis(),
    "profile_lookup": _profile_lookup(),
    "score_correlations": _score_corr(),
    "corr_matrix": _corr_matrix(),
    "ols_by_group": _ols(),
    "histogram": _histogram(),
    "box_summary": _box(),
    "group_summary": _group_summary(),
}


# ---------------------------------------------------------------- weights by principal components
def _pca_ctes(components: int = 3, squarings: int = 40) -> str:
    """Leading projectors of the covariance by repeated squaring and deflation: |loading| = sqrt of the diagonal."""
    k = len(IND)
    cells = " UNION ALL ".join(
        f"SELECT {i} AS i, {j} AS j, covar_samp({a}, {b}) AS v FROM nm"
        for i, a in enumerate(IND) for j, b in enumerate(IND))
    out = [f"c0 AS ({cells})", "tr AS (SELECT SUM(v) AS t FROM c0 WHERE i = j)"]
    for c in range(components):
        out += [
            f"p{c} AS (SELECT 0 AS n, i, j, v / (SELECT SUM(v) FROM c{c} WHERE i = j) AS v FROM c{c} UNION ALL "
            f"SELECT a.n + 1, a.i, b.j, SUM(a.v * b.v) / (SELECT SUM(v * v) FROM p{c}) FROM p{c} a JOIN p{c} b ON a.j = b.i "
            f"WHERE a.n < {squarings} GROUP BY a.n, a.i, b.j)",
            f"f{c} AS (SELECT i, j, v FROM p{c} WHERE n = {squarings})",
            f"l{c} AS (SELECT SUM(c{c}.v * f{c}.v) AS lam FROM c{c} JOIN f{c} USING (i, j))",
            f"c{c + 1} AS (SELECT i, j, c{c}.v - lam * f{c}.v AS v FROM c{c} JOIN f{c} USING (i, j), l{c})",
        ]
    load = " + ".join(f"SQRT(GREATEST(f{c}.v, 0)) * (SELECT lam FROM l{c}) / (SELECT t FROM tr)" for c in range(components))
    joins = " ".join(f"JOIN f{c} ON f{c}.i = f0.i AND f{c}.j = f0.j" for c in range(1, components))
    out.append(f"pl AS (SELECT f0.i, {load} AS raw FROM f0 {joins} WHERE f0.i = f0.j)")
    wide = ", ".join(f"SUM(raw) FILTER (WHERE i = {i}) / SUM(raw) AS w_{n}" for i, n in enumerate(IND))
    out.append(f"pw AS (SELECT {wide} FROM pl)")
    assert k == len(DEFAULT_INDICATORS)
    return ",\n".join(out)


def _full_prefix() -> str:
    """Everything up to ``ranking``, with the mean of both weightings in place of the entropy weights."""
    both = ", ".join(f"(pw.w_{n} + en.w_{n}) / 2 AS w_{n}" for n in IND)
    total = " + ".join(f"w_{n}" for n in IND)
    scaled = ", ".join(f"w_{n} / ({total}) AS w_{n}" for n in IND)
    entropy = entropy_ctes().replace("\new AS (", "\nen AS (")
    return ("WITH RECURSIVE " + master_ctes() + ",\n" + norm_ctes() + ",\n" + entropy + ",\n" + _pca_ctes() + ",\n"
            + f"mean_w AS (SELECT {both} FROM pw CROSS JOIN en),\new AS (SELECT {scaled} FROM mean_w),\n"
            + entropy_score_ctes())


def _pca_weights():
    rows = " UNION ALL ".join(
        f"SELECT {q(i.name)} AS indicator, {q(i.label)} AS label, {i.direction} AS direction, "
        f"{r6(f'pw.w_{i.name}', 'pca_weight')}, {r6(f'en.w_{i.name}', 'entropy_weight')}, {r6(f'ew.w_{i.name}', 'weight')} "
        f"FROM pw CROSS JOIN en CROSS JOIN ew" for i in DEFAULT_INDICATORS)
    return f"{_full_prefix()} {rows}"


def _full_index():
    norm = ", ".join(r6(i, f"norm_{i}") for i in IND)
    return (f"{_full_prefix()} SELECT entity_key, name, state, region, score, rank, {norm}, "
            f"ROUND(subindex_environment, 6) + 0.0 AS subindex_environment, ROUND(subindex_economy, 6) + 0.0 AS subindex_economy "
            f"FROM (SELECT ranking.*, {subindex_cols()} FROM ranking) t")


def _covariance_pairs():
    rows = " UNION ALL ".join(f"SELECT {q(a)} AS x, {q(b)} AS y, {r6(f'covar_samp({a}, {b})', 'covariance')} FROM nm"
                              for i, a in enumerate(IND) for b in IND[i:])
    return f"WITH {master_ctes()}, {norm_ctes()} {rows}"


# ---------------------------------------------------------------- groups, labels, payloads, jobs
def _quantiles_by_group():
    rows = " UNION ALL ".join(
        f"SELECT grp, 'price' AS \"column\", COUNT(v) AS n, CAST({p} AS DOUBLE) AS prob, {sql_quantile('v', p)} AS value "
        f"FROM g GROUP BY grp" for p in (0.25, 0.5, 0.75))
    return ("WITH g AS (SELECT CASE WHEN l_orderkey % 10 <> 0 THEN l_orderkey END AS grp, l_extendedprice AS v FROM lineitem) "
            + rows)


def _unwrap_items():
    return ("WITH e AS (SELECT event_id, event_id % 6 AS form, CAST(regexp_extract(props, ':\\s*([0-9]+)', 1) AS INTEGER) AS k "
            "FROM events) "
            "SELECT event_id, k FROM e WHERE form <> 2 UNION ALL SELECT event_id, k FROM e WHERE form IN (0, 4)")


LABELLED = (f"{{prefix}}, {DISPLAY}, sm AS (SELECT state, RANK() OVER (ORDER BY ROUND(AVG(score), 6) DESC NULLS LAST) AS sr "
            "FROM ranking GROUP BY state), "
            "lab AS (SELECT disp.*, 'profile ' || chr(CAST(65 + (sr - 1) // 5 AS INTEGER)) AS cluster_label "
            "FROM disp JOIN sm ON disp.state IS NOT DISTINCT FROM sm.state)")


def _labelled() -> str:
    return LABELLED.format(prefix=index_prefix())


def _display_with_labels():
    return (f"{_labelled()} SELECT entity_key, name || ' - ' || state AS label, score, rank, cluster_label, "
            f"{r6('pct_native', 'pct_native')}, {r6('population', 'population')} FROM lab "
            f"WHERE population BETWEEN 2.0 AND 40.0 AND cluster_label IN ('profile A', 'profile C')")


def _label_summary():
    return (f"{_labelled()} SELECT cluster_label, COUNT(score) AS count, {r6('AVG(score)', 'mean')}, MIN(score) AS min, "
            f"MAX(score) AS max FROM lab GROUP BY cluster_label")


def _label_sizes():
    return f"{_labelled()} SELECT cluster_label, COUNT(*) AS count FROM lab GROUP BY cluster_label"


def _label_box():
    return (f"{_labelled()} SELECT cluster_label, MIN(score) AS min, MAX(score) AS max, COUNT(score) AS n, "
            f"{sql_quantile('score', 0.25)} AS q1, {sql_quantile('score', 0.5)} AS median, {sql_quantile('score', 0.75)} AS q3 "
            f"FROM lab GROUP BY cluster_label")


def _labels_by_mean():
    return (f"{_labelled()}, m AS (SELECT cluster_label, COUNT(*) AS entities, {r6('AVG(score)', 'mean_score')} FROM lab "
            f"GROUP BY cluster_label) SELECT m.*, CAST(ROW_NUMBER() OVER (ORDER BY mean_score, cluster_label) - 1 AS INTEGER) "
            f"AS position FROM m")


def _filter_choices():
    return f"{index_prefix()} SELECT DISTINCT state FROM ranking WHERE state IS NOT NULL"


def _bounds():
    return (f"{index_prefix()}, {DISPLAY} SELECT {r6('MIN(population)', 'min_population')}, {r6('MAX(population)', 'max_population')}, "
            f"{r6('MIN(pct_native)', 'min_pct_native')}, {r6('MAX(pct_native)', 'max_pct_native')} FROM disp")


def _dedup_rows():
    return ("SELECT l_orderkey, l_linenumber, l_extendedprice FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey "
            "ORDER BY l_linenumber, l_extendedprice) AS rn FROM lineitem) t WHERE rn = 1")


def _raw_key(col: str) -> str:
    return f"lpad(CAST({col} AS VARCHAR), 7, '0')"


def _transform_absent():
    """The wide table without crops, herd and land use."""
    return (f"WITH {DIM}, {GDP}, {POP} SELECT {_raw_key('d.entity_key')} AS entity_key, d.name, d.state, {r6('d.area_km2', 'area_km2')}, "
            f"{r6('p.population', 'population')}, {r6('g.gdp_k', 'gdp_k')}, "
            f"{r6('NULLIF(g.gdp_k, 0) * 1000 / NULLIF(p.population, 0)', 'gdp_per_capita')}, "
            f"{r6('NULLIF(g.gdp_k, 0) * 1000 / NULLIF(d.area_km2, 0)', 'gdp_per_km2')}, "
            f"{r6('NULLIF(p.population, 0) / NULLIF(d.area_km2, 0)', 'pop_density')} FROM dim d "
            f"LEFT JOIN (SELECT * FROM pop WHERE year = {REF_YEAR}) p ON d.entity_key = p.entity_key "
            f"LEFT JOIN (SELECT * FROM gdp WHERE year = {REF_YEAR}) g ON d.entity_key = g.entity_key")


def _fact_tables():
    parts = [f"SELECT 'dim_entity' AS fact, COUNT(*) AS rows, COUNT(DISTINCT entity_key) AS entities FROM dim",
             "SELECT 'fact_economy', COUNT(*), COUNT(DISTINCT COALESCE(g.entity_key, p.entity_key)) FROM gdp g FULL OUTER JOIN pop p "
             "ON g.entity_key = p.entity_key AND g.year = p.year",
             "SELECT 'fact_environment', COUNT(*), COUNT(DISTINCT entity_key) FROM (SELECT DISTINCT entity_key, year FROM landuse) t"]
    return f"WITH {LANDUSE}, {DIM}, {GDP}, {POP} " + " UNION ALL ".join(parts)


ORACLES.update({
    "pca_weights": _pca_weights(),
    "full_index": _full_index(),
    "covariance_pairs": _covariance_pairs(),
    "quantiles_by_group": _quantiles_by_group(),
    "unwrap_items": _unwrap_items(),
    "display_with_labels": _display_with_labels(),
    "label_summary": _label_summary(),
    "label_sizes": _label_sizes(),
    "label_box": _label_box(),
    "labels_by_mean": _labels_by_mean(),
    "filter_choices": _filter_choices(),
    "bounds": _bounds(),
    "dedup_rows": _dedup_rows(),
    "transform_absent_sources": _transform_absent(),
    "fact_tables": _fact_tables(),
})


OLS_FEATURES = ("pct_native", "pct_agro", "gdp_per_capita")


def _cv_ols():
    folds = "CAST(('0x' || substr(md5(CAST(m.entity_key AS VARCHAR)), 1, 8)) AS BIGINT) % 5"
    data = " UNION ALL ".join(
        f"SELECT {q(f)} AS model, {folds} AS fold, CAST(m.{f} AS DOUBLE) AS x, r.score AS y "
        f"FROM master m JOIN ranking r ON m.entity_key = r.entity_key "
        f"WHERE m.{f} IS NOT NULL AND r.score IS NOT NULL" for f in OLS_FEATURES)
    return (f"{index_prefix()}, d AS ({data}), k AS (SELECT DISTINCT model, fold FROM d), "
            "l AS (SELECT k.model, k.fold, regr_slope(d.y, d.x) AS s, regr_intercept(d.y, d.x) AS i "
            "FROM k JOIN d ON d.model = k.model AND d.fold <> k.fold GROUP BY k.model, k.fold), "
            "f AS (SELECT d.model, d.fold, AVG((d.y - l.s * d.x - l.i) ** 2) AS mse, var_pop(d.y) AS var "
            "FROM d JOIN l ON l.model = d.model AND l.fold = d.fold GROUP BY d.model, d.fold), "
            "t AS (SELECT model, regr_r2(y, x) AS train FROM d GROUP BY model), "
            "m AS (SELECT model, AVG(SQRT(mse)) AS a, stddev_pop(SQRT(mse)) AS b, AVG(1 - mse / var) AS c, "
            "stddev_pop(1 - mse / var) AS e FROM f GROUP BY model) "
            f"SELECT m.model, {r6('a', 'cv_rmse_mean')}, {r6('b', 'cv_rmse_std')}, {r6('c', 'cv_r2_mean')}, "
            f"{r6('e', 'cv_r2_std')}, {r6('train', 'train_r2')}, a = (SELECT MIN(a) FROM m) AS best "
            "FROM m JOIN t ON m.model = t.model")


def _attribution():
    rows = " UNION ALL ".join(
        f"SELECT {q(f)} AS feature, {r6(f'AVG(ABS({c} * (m.{f} - (SELECT AVG({f}) FROM master))))', 'mean_abs_attribution')} "
        f"FROM master m" for f, c in (("pct_native", 0.75), ("pct_agro", -0.5)))
    return f"WITH {master_ctes()} {rows}"


ORACLES["cv_ols_metrics"] = _cv_ols()
ORACLES["attribution_of_coefficients"] = _attribution()


# ---------------------------------------------------------------- elastic net by coordinate descent over the Gram matrix
SWEEPS = 150


def _cv_elastic_net():
    """All folds' sums of products at once; a recursive query visits one weight of every fold's fit a step."""
    k = len(FEATURE_COLS)
    medians = ", ".join(f"{sql_quantile(f, 0.5)} AS {f}" for f in FEATURE_COLS)
    imputed = ", ".join(f"COALESCE(CAST(m.{f} AS DOUBLE), md.{f}) AS {f}" for f in FEATURE_COLS)
    moments = ", ".join(f"AVG({f}) AS a_{f}, stddev_pop({f}) AS s_{f}" for f in FEATURE_COLS)
    scaled = ", ".join(f"(i.{f} - a_{f}) / CASE WHEN s_{f} = 0 THEN 1 ELSE s_{f} END" for f in FEATURE_COLS)
    new = f"(CASE WHEN ABS(rho) > 0.5 THEN (ABS(rho) - 0.5) * SIGN(rho) ELSE 0 END) / (diag + 0.5)"
    return f"""{_full_prefix()},
lab AS (SELECT sc.entity_key, (sc.raw - smm.lo) / (smm.hi - smm.lo) * 100 AS label FROM sc CROSS JOIN smm),
md AS (SELECT {medians} FROM master),
imp AS (SELECT m.entity_key, {imputed} FROM master m CROSS JOIN md),
mo AS (SELECT {moments} FROM imp),
z AS (SELECT CAST(('0x' || substr(md5(CAST(i.entity_key AS VARCHAR)), 1, 8)) AS BIGINT) % 5 AS fold,
             [{scaled}, l.label - (SELECT AVG(label) FROM lab), 1.0] AS v
      FROM imp i CROSS JOIN mo JOIN lab l ON l.entity_key = i.entity_key),
own AS (SELECT fold, i, j, SUM(v[i] * v[j]) AS p FROM z, range(1, {k + 3}) a(i), range(1, {k + 3}) b(j) GROUP BY fold, i, j),
total AS (SELECT i, j, SUM(p) AS p FROM own GROUP BY i, j),
train AS (SELECT o.fold AS t, i, j, total.p - o.p AS p FROM own o JOIN total USING (i, j) UNION ALL SELECT -1, i, j, p FROM total),
held AS (SELECT fold AS t, i, j, p FROM own UNION ALL SELECT -1, i, j, p FROM total),
cnt AS (SELECT t, p AS n FROM train WHERE i = {k + 2} AND j = {k + 2}),
mean AS (SELECT t, i, p / n AS m FROM train JOIN cnt USING (t) WHERE j = {k + 2}),
cov AS (SELECT train.t, train.i, train.j, p / n - a.m * b.m AS c FROM train JOIN cnt USING (t)
        JOIN mean a ON a.t = train.t AND a.i = train.i JOIN mean b ON b.t = train.t AND b.i = train.j),
gram AS (SELECT t, i, list(c ORDER BY j) FILTER (WHERE j <= {k}) AS row, MAX(c) FILTER (WHERE j = {k + 1}) AS target,
                MAX(c) FILTER (WHERE j = i) AS diag FROM cov WHERE i <= {k} GROUP BY t, i),
steps AS (SELECT t, 0 AS s, list_value({", ".join(["CAST(0 AS DOUBLE)"] * k)}) AS w FROM cnt
          UNION ALL
          SELECT t, s + 1, list_concat(list_concat(list_slice(w, 1, i - 1), [{new}]), list_slice(w, i + 1, {k}))
          FROM (SELECT st.t, s, w, g.i, g.diag, g.target - list_dot_product(g.row, w) + g.diag * w[g.i] AS rho
                FROM steps st JOIN gram g ON g.t = st.t AND g.i = st.s % {k} + 1 WHERE st.s < {k * SWEEPS}) x),
fit AS (SELECT t, w FROM steps WHERE s = {k * SWEEPS}),
xw AS (SELECT t, i, CASE WHEN i <= {k} THEN -w[i] ELSE 1 END AS c FROM fit, range(1, {k + 2}) a(i)),
off AS (SELECT xw.t, SUM(c * m) AS b FROM xw JOIN mean ON mean.t = xw.t AND mean.i = xw.i GROUP BY xw.t),
sse AS (SELECT h.t, SUM(a.c * b.c * p) AS q FROM held h JOIN xw a ON a.t = h.t AND a.i = h.i JOIN xw b ON b.t = h.t AND b.i = h.j
        GROUP BY h.t),
lin AS (SELECT h.t, SUM(a.c * p) AS s FROM held h JOIN xw a ON a.t = h.t AND a.i = h.i WHERE j = {k + 2} GROUP BY h.t),
sums AS (SELECT t, MAX(p) FILTER (WHERE i = {k + 2} AND j = {k + 2}) AS n, MAX(p) FILTER (WHERE i = {k + 1} AND j = {k + 1}) AS yy,
                MAX(p) FILTER (WHERE i = {k + 1} AND j = {k + 2}) AS y FROM held GROUP BY t),
err AS (SELECT t, SQRT((q - 2 * b * s + n * b * b) / n) AS rmse, 1 - (q - 2 * b * s + n * b * b) / (yy - y * y / n) AS r2
        FROM sse JOIN lin USING (t) JOIN off USING (t) JOIN sums USING (t))
SELECT 'elastic_net' AS model, {r6('AVG(rmse) FILTER (WHERE t >= 0)', 'cv_rmse_mean')},
       {r6('stddev_pop(rmse) FILTER (WHERE t >= 0)', 'cv_rmse_std')}, {r6('AVG(r2) FILTER (WHERE t >= 0)', 'cv_r2_mean')},
       {r6('stddev_pop(r2) FILTER (WHERE t >= 0)', 'cv_r2_std')}, {r6('MAX(r2) FILTER (WHERE t = -1)', 'train_r2')} FROM err"""


ORACLES["cv_elastic_net"] = _cv_elastic_net()


# ---------------------------------------------------------------- one boosted tree on given bins
def _tree_ctes(cuts: dict, p) -> list[str]:
    """Best-first growth written out: histograms, running sums and the best split of every open leaf, one split after another."""
    names = list(cuts)
    bins = " UNION ALL ".join(
        f"SELECT entity_key, {i} AS f, CASE WHEN {f} IS NULL THEN -1 ELSE "
        + (" + ".join(f"CAST({f} > CAST({c} AS DOUBLE) AS INTEGER)" for c in cuts[f]) or "0") + f" END AS b FROM t0" for i, f in enumerate(names))
    every = " UNION ALL ".join(f"SELECT {i} AS f, unnest(range(0, {len(cuts[f])})) AS cut" for i, f in enumerate(names))
    out = [f"t0 AS (SELECT m.entity_key, {', '.join(f'CAST(m.{f} AS DOUBLE) AS {f}' for f in names)}, r.score AS y "
           "FROM master m JOIN ranking r ON r.entity_key = m.entity_key WHERE r.score IS NOT NULL)",
           "res AS (SELECT entity_key, y - (SELECT AVG(y) FROM t0) AS r FROM t0)",
           f"bins AS ({bins})", f"cuts AS ({every})", "a0 AS (SELECT entity_key, 0 AS node FROM t0)",
           "d0 AS (SELECT 0 AS node, 0 AS depth)"]
    for s in range(p.max_leaves - 1):
        out += [
            f"n{s} AS (SELECT node, SUM(r) AS r, COUNT(*) AS n FROM a{s} JOIN res USING (entity_key) GROUP BY node)",
            f"h{s} AS (SELECT node, f, b, SUM(r) AS r, COUNT(*) AS n FROM a{s} JOIN res USING (entity_key) JOIN bins USING (entity_key) GROUP BY node, f, b)",
            f"l{s} AS (SELECT n{s}.node, c.f, c.cut, side.nl AS null_left, n{s}.r AS tr, n{s}.n AS tn, "
            f"COALESCE(SUM(h.r) FILTER (WHERE h.b BETWEEN 0 AND c.cut OR (h.b = -1 AND side.nl)), 0) AS lr, "
            f"COALESCE(SUM(h.n) FILTER (WHERE h.b BETWEEN 0 AND c.cut OR (h.b = -1 AND side.nl)), 0) AS ln "
            f"FROM n{s} CROSS JOIN cuts c CROSS JOIN (SELECT false AS nl UNION ALL SELECT true) side "
            f"LEFT JOIN h{s} h ON h.node = n{s}.node AND h.f = c.f GROUP BY n{s}.node, c.f, c.cut, side.nl, n{s}.r, n{s}.n)",
            f"g{s} AS (SELECT l.*, ROUND(lr * lr / (ln + {p.l2}) + (tr - lr) * (tr - lr) / (tn - ln + {p.l2}) - tr * tr / (tn + {p.l2}), 6) AS gain "
            f"FROM l{s} l JOIN d{s} ON d{s}.node = l.node WHERE ln >= {max(p.min_rows, 1)} AND tn - ln >= {max(p.min_rows, 1)} AND depth < {p.max_depth})",
            f"b{s} AS (SELECT * FROM g{s} WHERE gain > 0 ORDER BY gain DESC, node, f, cut, null_left LIMIT 1)",
            f"a{s + 1} AS (SELECT a.entity_key, CASE WHEN b{s}.node IS NULL THEN a.node WHEN (x.b = -1 AND b{s}.null_left) OR (x.b BETWEEN 0 AND b{s}.cut) "
            f"THEN {2 * s + 1} ELSE {2 * s + 2} END AS node FROM a{s} a LEFT JOIN b{s} ON b{s}.node = a.node "
            f"LEFT JOIN bins x ON x.entity_key = a.entity_key AND x.f = b{s}.f)",
            f"d{s + 1} AS (SELECT * FROM d{s} UNION ALL SELECT {2 * s + 1} + k, depth + 1 FROM b{s} JOIN d{s} USING (node), (SELECT 0 AS k UNION ALL SELECT 1) kk)",
        ]
    last = p.max_leaves - 1
    out.append(f"n{last} AS (SELECT node, SUM(r) AS r, COUNT(*) AS n FROM a{last} JOIN res USING (entity_key) GROUP BY node)")
    splits = " UNION ALL ".join(f"SELECT {s} AS s, node, f, cut, null_left, gain, tr, tn FROM b{s}" for s in range(last))
    out.append(f"splits AS ({splits})")
    out.append(f"nodes AS (SELECT node, s, f, cut, null_left, gain, tr / (tn + {p.l2}) AS value, tn AS n FROM splits UNION ALL "
               f"SELECT node, NULL, NULL, NULL, NULL, NULL, r / (n + {p.l2}), n FROM n{last})")
    return out


def _boosted_tree(cuts: dict, p) -> str:
    pick = " ".join(f"WHEN {i} THEN {q(f)}" for i, f in enumerate(cuts))
    return (f"{index_prefix()}, " + ",\n".join(_tree_ctes(cuts, p))
            + f" SELECT CAST(node AS INTEGER) AS node, CASE f {pick} END AS feature, CAST(cut AS INTEGER) AS cut, null_left, {r6('gain', 'gain')}, "
            f"{r6('value', 'value')}, CAST(n AS BIGINT) AS n FROM nodes t")


def _tree_attribution(cuts: dict, p) -> str:
    """Paths by walking up from the leaves, then every coalition of a path's features."""
    pick = " ".join(f"WHEN {i} THEN {q(f)}" for i, f in enumerate(cuts))
    fact = "CASE {0} WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 6 END"
    return (f"{index_prefix().replace('WITH ', 'WITH RECURSIVE ', 1)}, " + ",\n".join(_tree_ctes(cuts, p)) + f""",
edges AS (SELECT 2 * s + 1 + k AS child, node, f, CASE WHEN k = 0 THEN 0 ELSE cut + 1 END AS low, CASE WHEN k = 0 THEN cut ELSE 32768 END AS high,
                 null_left = (k = 0) AS null_ok FROM nodes, (SELECT 0 AS k UNION ALL SELECT 1) x WHERE s IS NOT NULL),
walk AS (SELECT node AS leaf, node AS at, CAST(NULL AS BIGINT) AS f, 0 AS low, 0 AS high, true AS null_ok, CAST(1 AS DOUBLE) AS z FROM nodes WHERE s IS NULL
         UNION ALL
         SELECT w.leaf, e.node, e.f, e.low, e.high, e.null_ok, CAST(c.n AS DOUBLE) / q.n FROM walk w JOIN edges e ON e.child = w.at
         JOIN nodes c ON c.node = e.child JOIN nodes q ON q.node = e.node),
els AS (SELECT leaf, f, MAX(low) AS low, MIN(high) AS high, bool_and(null_ok) AS null_ok, product(z) AS z FROM walk WHERE f IS NOT NULL GROUP BY leaf, f),
el AS (SELECT els.*, ROW_NUMBER() OVER (PARTITION BY leaf ORDER BY f) - 1 AS nth, COUNT(*) OVER (PARTITION BY leaf) AS d FROM els),
coal AS (SELECT el.leaf, el.f AS own, m, v.value * {p.rate} * ({fact.format('bit_count(m)')}) * ({fact.format('(d - bit_count(m) - 1)')}) / CAST({fact.format('d')} AS DOUBLE) AS w
         FROM el JOIN nodes v ON v.node = el.leaf, range(0, 4) r(m) WHERE m < (1 << d) AND ((m >> nth) & 1) = 0),
met AS (SELECT b.entity_key, el.leaf, el.f, el.nth, el.z, CAST(CASE WHEN b.b < 0 THEN null_ok ELSE b.b BETWEEN low AND high END AS DOUBLE) AS o
        FROM bins b JOIN el ON el.f = b.f),
parts AS (SELECT met.entity_key, met.leaf, coal.own, coal.m, MAX(w) AS w,
                 product(CASE WHEN met.f = coal.own THEN o - z WHEN ((m >> nth) & 1) = 1 THEN o ELSE z END) AS p
          FROM met JOIN coal ON coal.leaf = met.leaf GROUP BY met.entity_key, met.leaf, coal.own, coal.m)
SELECT entity_key, CASE own {pick} END AS feature, {r6('SUM(p * w)', 'attribution')} FROM parts GROUP BY entity_key, own""")


ORACLES["tree_attribution_small"] = _tree_attribution(TREE_CUTS, SECOND_ORDER_SMALL)
ORACLES["boosted_tree_leaf_wise"] = _boosted_tree(TREE_CUTS, LEAF_WISE_SMALL)
ORACLES["boosted_tree_second_order"] = _boosted_tree(TREE_CUTS, SECOND_ORDER_SMALL)


# ---------------------------------------------------------------- sheets and sinks
def _header_offsets():
    """Line n of a sheet (from 0) is row n - 7; the header line tried is 9, 10, 8, then 7."""
    return """
WITH o AS (SELECT o_orderkey, o_orderstatus, o_orderkey // 12500 AS block,
                  row_number() OVER (PARTITION BY o_orderkey // 12500 ORDER BY o_orderkey) AS nth FROM orders),
s AS (SELECT *, CASE WHEN block = 0 AND nth = 1 THEN 0 WHEN block = 0 AND nth <= 3 THEN 1 WHEN block = 0 AND nth <= 43 THEN 2 ELSE block + 3 END AS sheet FROM o),
l AS (SELECT *, row_number() OVER (PARTITION BY sheet ORDER BY o_orderkey) AS line FROM s),
k AS (SELECT *, CASE WHEN sheet = 2 AND line <= 22 THEN 'n/a' ELSE CAST(o_orderkey + 1000000 AS VARCHAR) END AS cell FROM l),
c AS (SELECT DISTINCT sheet, CASE sheet WHEN 0 THEN 7 WHEN 1 THEN 8 WHEN 2 THEN 10 ELSE 9 END AS off FROM k)
SELECT CAST(k.sheet AS BIGINT) AS sheet, CAST(off AS INTEGER) AS "offset", CASE WHEN off = 7 THEN 'order' ELSE h.cell END AS key_name,
       k.cell AS key, k.o_orderstatus AS status
FROM k JOIN c ON c.sheet = k.sheet LEFT JOIN k h ON h.sheet = k.sheet AND h.line = off - 7
WHERE k.line > off - 7 AND k.cell <> 'n/a'"""


ORACLES["header_offsets"] = _header_offsets()
ORACLES["skipped_and_replaced_writes"] = (
    "SELECT c_custkey, c_nationkey, 'complete' AS target FROM customer WHERE c_custkey % 2 = 0 UNION ALL "
    "SELECT c_custkey, c_nationkey, t FROM customer, (SELECT 'half' AS t UNION ALL SELECT 'absent') x WHERE c_custkey % 2 = 1")
ORACLES["refreshed_years"] = (
    f"WITH {GDP} SELECT year, COUNT(*) AS entities, {r6('CAST(SUM(CAST(gdp_k + CASE WHEN year = 1997 THEN 1 ELSE 0 END AS DECIMAL(18,2))) AS DOUBLE)', 'gdp_k')}, "
    "year = 1997 AS rewritten FROM gdp WHERE year <> 1998 GROUP BY year")
ORACLES["swapped_table"] = "SELECT s_suppkey, s_nationkey FROM supplier"


def _silhouette():
    return f"""{_labelled()},
pts AS MATERIALIZED (SELECT entity_key, cluster_label, score AS x, COALESCE(pct_native, 0) AS y, COALESCE(population, 0) AS z FROM lab
        WHERE score IS NOT NULL AND cluster_label IS NOT NULL ORDER BY md5(CAST(entity_key AS VARCHAR)), entity_key LIMIT 2000),
sizes AS (SELECT cluster_label, COUNT(*) AS n FROM pts GROUP BY cluster_label),
sums AS (SELECT a.entity_key, a.cluster_label, b.cluster_label AS other,
                SUM(SQRT((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2)) AS s FROM pts a CROSS JOIN pts b
         GROUP BY a.entity_key, a.cluster_label, b.cluster_label),
ab AS (SELECT entity_key, sums.cluster_label, MAX(own.n) AS n, MAX(s) FILTER (WHERE other = sums.cluster_label) / NULLIF(MAX(own.n) - 1, 0) AS a,
              MIN(s / sizes.n) FILTER (WHERE other <> sums.cluster_label) AS b
       FROM sums JOIN sizes ON sizes.cluster_label = other JOIN sizes own ON own.cluster_label = sums.cluster_label GROUP BY entity_key, sums.cluster_label)
SELECT cluster_label, COUNT(*) AS n, {r6('AVG(CASE WHEN n > 1 THEN (b - a) / GREATEST(a, b) ELSE 0 END)', 'silhouette')} FROM ab GROUP BY cluster_label"""


ORACLES["silhouette_of_labels"] = _silhouette()


# ---------------------------------------------------------------- landed forms and cleaning rules
def _flat(value: str) -> str:
    return (f"CASE WHEN o_orderkey % 7 <> 0 THEN {value} END")


def _index_without_indicator() -> str:
    left = [i for i in DEFAULT_INDICATORS if i.name != ABSENT_INDICATOR]
    return (f"WITH {master_ctes()}, {norm_ctes(left)}, {entropy_ctes(left)}, {entropy_score_ctes(left)} "
            "SELECT entity_key, score, rank FROM ranking")


ORACLES.update({
    "missing_tokens": f"SELECT event_id, {r6('CASE WHEN event_id % 5 > 1 THEN value END', 'value_num')}, "
                      "CASE WHEN event_id % 3 > 0 THEN CAST(user_id AS INTEGER) END AS who_int FROM events",
    "clean_herd_extract": "SELECT CAST(o_orderkey + 1000000 AS VARCHAR) AS entity_key, CAST(year(o_orderdate) AS INTEGER) AS year, "
                          f"CAST({_flat('o_custkey')} AS DOUBLE) AS herd_total FROM orders",
    "entity_level_rows": "SELECT o_orderkey, CAST(o_orderkey + 1000000 AS VARCHAR) AS key FROM orders WHERE o_orderkey % 9 <> 0",
    "flat_json_extract": "SELECT CAST(o_orderkey + 1000000 AS VARCHAR) AS entity_key, CAST(year(o_orderdate) AS INTEGER) AS year, "
                         f"CAST({_flat('ROUND(o_totalprice, 2)')} AS DOUBLE) AS gdp_k FROM orders",
    "csv_extract": "SELECT p_partkey, p_size, 'size \"' || p_size || '\", of ' || p_partkey AS label FROM part",
    "score_geography": f"{index_prefix()} SELECT ranking.entity_key, score, rank, 'shape ' || c_nationkey AS geom_ref "
                       "FROM ranking JOIN customer ON c_custkey = ranking.entity_key WHERE c_nationkey < 15",
    "index_without_indicator": _index_without_indicator(),
})
