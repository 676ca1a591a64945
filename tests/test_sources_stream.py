"""Sources, sinks, schema negotiation and the streaming panel."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from terrarank.config import LAND_COVER_GROUPS
from terrarank.operators.composition import class_composition
from terrarank.sources import (
    detect_key_column, empty_like, first_nonempty, flatten_json_dimension, harmonize_columns, load_sources,
    read_csv_extract, read_flat_json, source_status, tag_from_path, union_extracts, unwrap_items,
    write_if_absent, write_parquet,
)
from terrarank.streaming import start_panel_stream


def test_harmonize_aliases(spark):
    df = spark.createDataFrame([("1", None, "x", 3)], "src_code string, alt_id string, other string, n int")
    out = harmonize_columns(df, {"entity_key": ("unit_code", "src_code", "alt_id"), "absent": ("zz",)})
    assert out.columns == ["entity_key", "other", "n"]
    assert out.collect()[0].entity_key == "1"


def test_union_with_tags_and_missing_columns(spark):
    a = spark.createDataFrame([("k1", 1.0)], "k string, v double")
    b = spark.createDataFrame([("k2", "n")], "k string, name string")
    out = union_extracts([a, b], tag_col="year", tags=[2020, 2021]).orderBy("k").collect()
    assert [(r.k, r.v, r.name, r.year) for r in out] == [("k1", 1.0, None, 2020), ("k2", None, "n", 2021)]


def test_empty_like_and_first_nonempty(spark):
    e = empty_like(spark, "entity_key string, year int, fires long")
    assert e.count() == 0 and e.columns == ["entity_key", "year", "fires"]
    full = spark.createDataFrame([("a",)], "x string")
    assert first_nonempty([e, lambda: full]).collect()[0].x == "a"
    assert first_nonempty([e]) is None


def test_unwrap_items(spark):
    rows = [(1, json.dumps([{"a": 1}, {"a": 2}])), (2, json.dumps({"items": [{"a": 3}]})), (3, json.dumps({"a": 4}))]
    df = spark.createDataFrame(rows, "id int, payload string")
    out = sorted((r.id, r.a) for r in unwrap_items(df, "payload", "a int").collect())
    assert out == [(1, 1), (1, 2), (2, 3), (3, 4)]


def test_unwrap_items_forms(spark):
    rows = [(1, '{"hasMore": false, "items": [{"a": 3}, {"a": 4}]}'), (2, '{"count": 0, "items": []}'), (3, "[]"),
            (4, ' { "items":[{"a":5}]}'), (5, '{"a": 6, "note": "items"}'), (6, None), (7, '{"items": null}')]
    df = spark.createDataFrame(rows, "id int, payload string")
    assert sorted((r.id, r.a) for r in unwrap_items(df, "payload", "a int").collect()) == [(1, 3), (1, 4), (4, 5), (5, 6)]


def test_only_an_absent_path_means_no_data(spark):
    d = tempfile.mkdtemp(prefix="bad-")
    with open(os.path.join(d, "part.parquet"), "w") as f:
        f.write("not a parquet file")
    with pytest.raises(Exception):
        load_sources(spark, {"gdp": d})
    assert load_sources(spark, {"gdp": d + "/none"})["gdp"].count() == 0
    empty = load_sources(spark, {"fires": d + "/none", "unknown": d + "/none"})
    assert list(empty) == ["fires"] and empty["fires"].columns == ["entity_key", "year", "fire_spots"]


def test_landed_names_become_canonical(spark):
    d = tempfile.mkdtemp(prefix="alias-")
    spark.createDataFrame([("1", 2020, 4.5)], "geocodigo string, ano int, ideb double").write.parquet(d + "/education")
    got = load_sources(spark, {"education": d + "/education"})["education"]
    assert got.columns == ["entity_key", "year", "school_index"]


def test_read_flat_json_keeps_rows_with_odd_keys(spark):
    d = tempfile.mkdtemp(prefix="oddjson-")
    recs = [{"D1C": "Code", "D2C": "Year", "V": "Value"}, {"D1C": "abc", "D2C": "2020", "V": "7"},
            {"D1C": "12", "D2C": "2020", "V": ".."}]
    with open(os.path.join(d, "x.json"), "w") as f:
        json.dump(recs, f)
    assert sorted(r.D1C for r in read_flat_json(spark, d).collect()) == ["12", "abc"]


def test_read_flat_json_drops_header(spark):
    d = tempfile.mkdtemp(prefix="flatjson-")
    for year in (2020, 2021):
        recs = [{"D1C": "Município (Código)", "D2C": "Ano", "V": "Valor"},
                {"D1C": "1100015", "D2C": str(year), "V": "10"}]
        with open(os.path.join(d, f"pib_{year}.json"), "w") as f:
            json.dump(recs, f)
    df = read_flat_json(spark, d)
    df = tag_from_path(df, "file_year", r"pib_([0-9]{4})\.json")
    out = sorted((r.D1C, r.D2C, r.file_year) for r in df.collect())
    assert out == [("1100015", "2020", 2020), ("1100015", "2021", 2021)]


def test_read_csv_extract(spark):
    d = tempfile.mkdtemp(prefix="csv-")
    p = os.path.join(d, "fires.csv")
    with open(p, "w") as f:
        f.write("geocode,year,count\n1100015,2021,3\n3550308,2021,5\n")
    df = read_csv_extract(spark, p, "geocode string, year int, count int")
    assert df.agg(F.sum("count")).collect()[0][0] == 8


def test_flatten_json_dimension(spark):
    rec = {"id": 1100015, "nome": "X", "microrregiao": {"mesorregiao": {"UF": {"id": 11, "sigla": "RO", "nome": "R"}}},
           "regiao-imediata": {"regiao-intermediaria": {"macrorregiao": {"id": 1, "sigla": "N", "nome": "Norte"}}}}
    df = spark.read.json(spark.sparkContext.parallelize([json.dumps(rec)]))
    out = flatten_json_dimension(df, {
        "entity_key": "id", "name": "nome", "state": "microrregiao.mesorregiao.UF.sigla",
        "region": "regiao-imediata.regiao-intermediaria.macrorregiao.nome"}).collect()[0]
    assert (out.entity_key, out.state, out.region) == (1100015, "RO", "Norte")


def test_detect_key_column(spark):
    rows = [(i, f"Escola {i}", str(1100000 + i) if i > 2 else None, "x") for i in range(30)]
    df = spark.createDataFrame(rows, "ord int, name string, code string, flag string")
    out = {r.column: r.is_key for r in detect_key_column(df, "ord").collect()}
    assert out == {"name": False, "code": True, "flag": False}


def test_load_sources_and_status(spark):
    d = tempfile.mkdtemp(prefix="src-")
    spark.range(150).write.parquet(os.path.join(d, "big"))
    spark.range(5).write.parquet(os.path.join(d, "small"))
    frames = load_sources(spark, {"big": os.path.join(d, "big"), "small": os.path.join(d, "small"),
                                  "missing": os.path.join(d, "nope")}, schemas={"missing": "id long"})
    st = {r.source: (r.rows, r.status) for r in source_status(frames).collect()}
    assert st == {"big": (150, "REAL"), "small": (5, "STUB"), "missing": (0, "STUB")}


def test_sinks(spark):
    d = tempfile.mkdtemp(prefix="sink-")
    df = spark.createDataFrame([("a", 2020), ("b", 2021)], "k string, year int")
    assert write_parquet(df, os.path.join(d, "t"), partition_by=["year"])
    assert not write_parquet(df.limit(0), os.path.join(d, "empty"))
    write_if_absent(df.limit(1), os.path.join(d, "t"))  # existing: left alone
    assert spark.read.parquet(os.path.join(d, "t")).count() == 2


def test_streaming_update_mode_two_batches(spark):
    from terrarank.streaming import read_panel
    base = tempfile.mkdtemp(prefix="stream-upd-")
    landing = os.path.join(base, "landing")
    schema = "entity_key string, class_code int, year int, area double"
    b1 = spark.createDataFrame([("A", 3, 2021, 10.0), ("A", 15, 2021, 30.0)], schema)
    b2 = spark.createDataFrame([("A", 3, 2021, 20.0), ("B", 24, 2020, 5.0)], schema)
    out, ckpt = os.path.join(base, "panel"), os.path.join(base, "ckpt")
    for i, b in enumerate((b1, b2)):
        b.coalesce(1).write.mode("append").parquet(landing)
        q = start_panel_stream(spark, landing, schema, out, ckpt, LAND_COVER_GROUPS, available_now=True)
        q.awaitTermination(120)
    got = {(r.entity_key, r.year): (r.total_area, r.pct_native)
           for r in read_panel(spark, out, LAND_COVER_GROUPS).collect()}
    exp = {(r.entity_key, r.year): (r.total_area, r.pct_native) for r in class_composition(
        b1.union(b2), ["entity_key", "year"], "class_code", "area", LAND_COVER_GROUPS).collect()}
    assert got == exp


def test_streaming_panel_equals_batch(spark):
    base = tempfile.mkdtemp(prefix="stream-")
    schema = "entity_key string, class_code int, year int, area double"
    b1 = spark.createDataFrame([("A", 3, 2021, 10.0), ("A", 15, 2021, 30.0)], schema)
    b2 = spark.createDataFrame([("A", 3, 2021, 20.0), ("B", 24, 2020, 5.0)], schema)
    landing_flat = os.path.join(base, "flat")
    b1.union(b2).coalesce(1).write.parquet(landing_flat)
    q = start_panel_stream(spark, landing_flat, schema, os.path.join(base, "panel"), os.path.join(base, "ckpt"),
                           LAND_COVER_GROUPS, available_now=True, mode="complete")
    q.awaitTermination(120)
    got = {(r.entity_key, r.year): (r.total_area, r.pct_native) for r in spark.read.parquet(os.path.join(base, "panel")).collect()}
    exp = {(r.entity_key, r.year): (r.total_area, r.pct_native) for r in class_composition(
        b1.union(b2), ["entity_key", "year"], "class_code", "area", LAND_COVER_GROUPS).collect()}
    assert got == exp


def test_catalog_table_and_csv_export(spark):
    from terrarank.sources import export_csv, save_table
    d = tempfile.mkdtemp(prefix="tbl-")
    df = spark.createDataFrame([("a", 1.5), ("b", 2.5)], "k string, v double")
    save_table(df, "terrarank_test_tbl", options={"path": os.path.join(d, "tbl")})
    assert spark.table("terrarank_test_tbl").count() == 2
    save_table(df.limit(1), "terrarank_test_tbl", options={"path": os.path.join(d, "tbl")})  # replaced
    assert spark.table("terrarank_test_tbl").count() == 1
    spark.sql("DROP TABLE terrarank_test_tbl")
    save_table(df, "terrarank_view", temp_view=True)
    assert spark.sql("SELECT SUM(v) FROM terrarank_view").collect()[0][0] == 4.0
    export_csv(df, os.path.join(d, "top.csv"), single_file=True)
    back = spark.read.option("header", True).csv(os.path.join(d, "top.csv"))
    assert sorted(r.k for r in back.collect()) == ["a", "b"]


def test_filter_choices_bounds_positions(spark):
    from terrarank.operators.explore import bounds, filter_choices
    from terrarank.operators.rank import positional_index
    df = spark.createDataFrame([("SP", 3.0), ("AM", 1.0), (None, 2.0), ("SP", 5.0)], "state string, v double")
    assert [r.state for r in filter_choices(df, "state").collect()] == ["AM", "SP"]
    b = bounds(df, ["v"]).collect()[0]
    assert (b.min_v, b.max_v) == (1.0, 5.0)
    means = df.groupBy("state").agg(F.avg("v").alias("m")).where("state IS NOT NULL")
    pos = {r.state: r.position for r in positional_index(means, "m").collect()}
    assert pos == {"AM": 0, "SP": 1}


def test_detect_key_column_limits_before_shuffle(spark):
    df = spark.createDataFrame([(i, str(1000000 + i), "x") for i in range(100)], "ord int, code string, flag string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = detect_key_column(df, "ord")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = plan.splitlines()
    ex = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert "WindowGroupLimit" in lines[ex + 1] and "Partial" in lines[ex + 1]
