"""Class composition, year gate, as-of year, temporal change: edge rows."""

import pytest
from pyspark.sql import functions as F

from terrarank.config import LAND_COVER_GROUPS
from terrarank.operators import composition as comp
from terrarank.plans.etl import change_from_panel, land_panel

SCHEMA = "entity_key string, class_code int, year int, area double"


@pytest.fixture(scope="module")
def landuse(spark):
    rows = [
        # A: native 3 (forest too) + agro 15 + urban 24
        ("A", 3, 2015, 60.0), ("A", 15, 2015, 30.0), ("A", 24, 2015, 10.0),
        ("A", 3, 2021, 50.0), ("A", 15, 2021, 40.0), ("A", 24, 2021, 10.0),
        # B: only agro in 2021 (native share 0 → pressure NULL), absent in 2015
        ("B", 15, 2021, 20.0),
        # C: total area 0 in 2021, null area and unknown class in 2015
        ("C", 3, 2021, 0.0), ("C", 99, 2015, 5.0), ("C", 3, 2015, None),
        # D: only in 2015
        ("D", 12, 2015, 8.0),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_composition_edge_rows(landuse):
    out = {r.entity_key: r for r in comp.class_composition(
        landuse.where("year = 2021"), ["entity_key"], "class_code", "area", LAND_COVER_GROUPS).collect()}
    a = out["A"]
    assert (a.total_area, a.native_area, a.forest_area, a.agro_area, a.urban_area) == (100, 50, 50, 40, 10)
    assert (a.pct_native, a.pct_agro, a.pct_urban) == (50.0, 40.0, 10.0)
    assert out["B"].native_area == 0 and out["B"].pct_native == 0.0
    assert out["C"].total_area == 0 and out["C"].pct_native is None
    assert "D" not in out


def test_null_area_counts_as_zero_and_unknown_class(landuse):
    out = {r.entity_key: r for r in comp.class_composition(
        landuse.where("year = 2015"), ["entity_key"], "class_code", "area", LAND_COVER_GROUPS).collect()}
    c = out["C"]
    assert c.total_area == 5.0 and c.native_area == 0.0 and c.pct_native == 0.0


def test_temporal_change(landuse):
    out = {r.entity_key: r for r in comp.temporal_change(
        landuse, "entity_key", "year", "class_code", "area", LAND_COVER_GROUPS["native"], 2015, 2021).collect()}
    a = out["A"]
    assert a.pct_native_2015 == 60.0 and a.pct_native_2021 == 50.0
    assert a.native_change_pp == -10.0 and abs(a.native_change_rate_pct - (-10 / 60 * 100)) < 1e-12
    assert out["B"].pct_native_2015 is None and out["B"].native_change_pp is None
    assert out["C"].pct_native_2021 is None  # total 0
    assert out["D"].pct_native_2015 == 100.0 and out["D"].pct_native_2021 is None
    assert set(out) == {"A", "B", "C", "D"}


def test_change_from_panel_equals_raw(landuse):
    panel = land_panel(landuse, LAND_COVER_GROUPS)
    a = sorted(map(tuple, change_from_panel(panel, 2015, 2021).collect()), key=lambda t: t[0])
    b = sorted(map(tuple, comp.temporal_change(landuse, "entity_key", "year", "class_code", "area",
                                               LAND_COVER_GROUPS["native"], 2015, 2021).collect()),
               key=lambda t: t[0])
    assert a == b


def test_year_gate(spark, landuse):
    def years(least):
        return sorted(r.year for r in comp.year_gate(landuse, "year", least).select("year").distinct().collect())

    assert years(5) == [2015, 2021] and years(6) == [2015] and years(100) == []
    panel = comp.composition_panel(landuse, "entity_key", "year", "class_code", "area", LAND_COVER_GROUPS, min_rows=6)
    assert {r.year for r in panel.collect()} == {2015} and "_rows" not in panel.columns


def test_as_of_year(spark, landuse):
    for ref, found in ((2021, 2021), (2019, 2015), (2000, 2015)):  # nothing before: earliest
        assert comp.as_of_year_frame(landuse, "year", ref).collect()[0][0] == found
        out = comp.composition_as_of(landuse, "entity_key", "year", "class_code", "area", LAND_COVER_GROUPS, ref)
        assert {r.asof_year for r in out.collect()} == {found}


def test_composition_plan_has_no_python(landuse):
    plan = comp.class_composition(landuse, ["entity_key", "year"], "class_code", "area",
                                  LAND_COVER_GROUPS)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
    assert "HashAggregate" in plan  # partial + final hash aggregation


def test_event_counts_and_distinct(spark, landuse):
    ec = {r.entity_key: r.events for r in comp.event_counts(landuse, "entity_key", "year", 2021).collect()}
    assert ec == {"A": 6, "B": 1, "C": 3, "D": 1}
    assert comp.distinct_count(landuse, "entity_key").collect()[0][0] == 4


def test_scan_reads_only_needed_columns(spark):
    """The class table's scans read only the columns the composition uses."""
    from terrarank.plans import analog as A
    d = "/root/testdata/sf0.001"
    plan = comp.class_composition(A.landuse(spark, d), [A.KEY, A.YEAR], A.CLASS, A.AREA,
                                  A.ANALOG_GROUPS)._jdf.queryExecution().executedPlan().toString()
    schemas = [line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema" in line]
    assert any(s == "struct<l_orderkey:bigint,l_quantity:double>" for s in schemas), schemas
    assert not any("l_extendedprice" in s or "o_totalprice" in s for s in schemas)


def test_master_reads_the_largest_table_once(spark, monkeypatch):
    """One join of lineitem and orders, persisted; all extracts come from it."""
    from terrarank.plans import analog as A
    from terrarank.plans import catalog as C
    read = []
    table = A.table
    monkeypatch.setattr(A, "table", lambda s, d, name: read.append(name) or table(s, d, name))
    for q in (C.q_spine_join_master, C.q_full_index):
        read.clear()
        plan = q(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert read.count("lineitem") == 1
        # every reference to the table stands inside the one persisted relation
        assert "InMemoryRelation" in plan and "Relation [l_orderkey" not in plan


def test_year_filters_reach_the_scan(spark):
    from terrarank.plans import catalog as C
    for q in (C.q_temporal_change, C.q_composition_by_entity):
        plan = q(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        pushed = [line for line in plan.splitlines() if "PushedFilters" in line and "o_orderdate" in line]
        assert pushed and all("GreaterThanOrEqual(o_orderdate" in p and "LessThan(o_orderdate" in p for p in pushed)
