"""End-to-end jobs on landed raw extracts (Parquet in, Parquet out)."""

import os
import tempfile

from pyspark.sql import functions as F

from terrarank.config import LAND_COVER_GROUPS
from terrarank.operators.explore import ranking_label, rename_for_display
from terrarank.operators.joins import attach_geography
from terrarank.plans.etl import run_transform
from terrarank.plans.jobs import index_job


def _land(spark, base):
    keys = [f"{1100000 + i}" for i in range(12)]
    gdp = [(k, f"Entity {i}", "2021", str(1000 + 37 * i)) for i, k in enumerate(keys)] + [(keys[0], "x", "2020", "..")]
    pop = [(k, f"Entity {i}", "2021", str(50 + 11 * i)) for i, k in enumerate(keys[:-1])]
    area = [(k, f"Entity {i}", ["RO", "SP", "MG"][i % 3], 100.0 + i) for i, k in enumerate(keys)]
    land = []
    for i, k in enumerate(keys):
        for yr in (2015, 2021):
            land += [(k, 3, yr, 50.0 + i + (yr - 2015)), (k, 15, yr, 30.0 + 2 * i), (k, 24, yr, 5.0)]
    paths = {
        "gdp": ("D1C string, D1N string, D2C string, V string", gdp),
        "population": ("D1C string, D1N string, D2C string, V string", pop),
        "area": ("entity_key string, name string, state string, area_km2 double", area),
        "landuse": ("entity_key string, class_code int, year int, area double", land),
    }
    out = {}
    for name, (schema, rows) in paths.items():
        p = os.path.join(base, "raw", name)
        spark.createDataFrame(rows, schema).write.parquet(p)
        out[name] = p
    return out


def test_transform_then_index_job(spark):
    base = tempfile.mkdtemp(prefix="jobs-")
    paths = _land(spark, base)
    master = run_transform(spark, paths, os.path.join(base, "out"), LAND_COVER_GROUPS, 2021, 2015)
    m = master.toPandas().set_index("entity_key")
    assert len(m) == 12
    assert m.loc["1100011", "population"] != m.loc["1100011", "population"]  # NULL: absent from the extract
    assert abs(m.loc["1100000", "native_change_pp"] - (56 / 91 * 100 - 50 / 85 * 100)) < 1e-9
    env = spark.read.parquet(os.path.join(base, "out", "fact_environment"))
    assert env.count() == 24 and "_rows" not in env.columns
    # with the gate on, every year has too few rows: the fact is empty and leaves no files
    run_transform(spark, paths, os.path.join(base, "gated"), LAND_COVER_GROUPS, 2021, 2015, min_rows=100, catalog="gated_")
    assert not os.path.exists(os.path.join(base, "gated", "fact_environment"))
    assert spark.table("gated_master").count() == 12
    econ = spark.read.parquet(os.path.join(base, "out", "fact_economy"))
    assert econ.count() == 13
    weights = index_job(spark, os.path.join(base, "out", "master"), os.path.join(base, "index"))
    w = weights.toPandas()
    assert abs(w.weight.sum() - 1) < 1e-9 and w.weight.is_monotonic_decreasing
    ranking = spark.read.parquet(os.path.join(base, "index", "ranking")).toPandas()
    assert len(ranking) == 12 and ranking["rank"].min() == 1


def test_each_optional_source_may_be_absent(spark):
    base = tempfile.mkdtemp(prefix="absent-")
    paths = _land(spark, base)
    flat = "D1C string, D2C string, D3C string, V string"
    extra = {"crops": [(f"{1100000 + i}", "2021", str(v), "5") for i in range(12) for v in (214, 215, 216)],
             "herd": [(f"{1100000 + i}", "2021", "1", "9") for i in range(12)]}
    for name, rows in extra.items():
        paths[name] = os.path.join(base, "raw", name)
        spark.createDataFrame(rows, flat).write.parquet(paths[name])
    columns = {"crops": "planted_area_ha", "herd": "herd_total", "landuse": "pct_native"}
    for gone in ("crops", "herd", "landuse"):
        landed = {**paths, gone: os.path.join(base, "nowhere"), "education": os.path.join(base, "nowhere")}
        m = run_transform(spark, landed, os.path.join(base, f"no-{gone}"), LAND_COVER_GROUPS, 2021, 2015)
        assert m.count() == 12
        assert {c for c in columns.values() if c in m.columns} == {c for n, c in columns.items() if n != gone}


def test_model_job(spark, monkeypatch):
    """The whole model job on a small table, with light estimators in place of the presets."""
    from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
    from terrarank.operators import ml
    from terrarank.plans.jobs import model_job
    monkeypatch.setattr(ml, "MODEL_NAMES", ("elastic_net", "tree"))
    monkeypatch.setattr(ml.cross_validate, "__defaults__", (("elastic_net", "tree"), 5, 6))
    monkeypatch.setattr(ml, "make_estimator", lambda name, label_std=None: LinearRegression(regParam=0.01)
                        if name == "elastic_net" else DecisionTreeRegressor(maxDepth=2, seed=1))
    monkeypatch.setattr(ml, "CANDIDATE_KS", (3,))
    monkeypatch.setattr(ml.cluster_profiles, "__defaults__", ((), "score", ml.PROFILE_LABELS, (3, 4), 2))
    rows = [(str(i), f"n{i}", "S", float(i % 17), float(i * 7 % 13), float(i % 5)) for i in range(120)]
    master = spark.createDataFrame(rows, "entity_key string, name string, state string, pct_native double, pct_agro double, "
                                         "pop_density double")
    ranking = master.selectExpr("entity_key", "pct_native * 3 - pct_agro as score")
    out = model_job(spark, master, ranking, tempfile.mkdtemp(prefix="model-") + "/out")
    metrics = {r.model: r for r in out["metrics"].collect()}
    assert metrics["elastic_net"].best and metrics["elastic_net"].cv_rmse_mean < 0.5
    assert out["profiles"].count() == 120
    assert {r.feature for r in out["importances"].collect()} == {"pct_native", "pct_agro", "pop_density"}
    labels = [r.cluster_label for r in out["profile_summary"].orderBy("mean").collect()]
    assert labels == sorted(labels) and labels[0] == "profile A"


def test_explore_view_on_the_engines_own_profiles(spark):
    from terrarank.operators.explore import explore_view
    ranking = spark.createDataFrame([("1", "A", "S", 9.0, 1), ("2", "B", "S", 5.0, 2)],
                                    "entity_key string, name string, state string, score double, rank int")
    profiles = spark.createDataFrame([("1", "profile B"), ("2", "profile A")], "entity_key string, cluster_label string")
    master = spark.createDataFrame([("1", 50.0, 1.0), ("2", 20.0, 2.0)], "entity_key string, pct_native double, gdp_per_capita double")
    rows, kpi = explore_view(ranking, profiles, master, "entity_key", choices={"cluster_label": ["profile A"]},
                             master_cols=("pct_native", "gdp_per_capita"))
    assert [r.entity_key for r in rows.collect()] == ["2"] and kpi.collect()[0].entities == 1


def test_geography_and_display_helpers(spark):
    scores = spark.createDataFrame([("1", "A", "RO", 90.0), ("2", "B", None, 80.0)],
                                   "entity_key string, name string, state string, score double")
    geo = spark.createDataFrame([("1", "POLYGON_1")], "entity_key string, geom_ref string")
    assert attach_geography(scores, geo, "entity_key").count() == 1
    assert attach_geography(scores, geo, "entity_key", how="left").count() == 2
    labels = [r.label for r in ranking_label(scores).orderBy("entity_key").collect()]
    assert labels == ["A - RO", None]
    disp = rename_for_display(scores, {"name": "Entity", "score": "Index", "missing": "X"})
    assert disp.columns == ["Entity", "Index"]
