"""Distributed rank and exact quantiles against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from terrarank.operators import stats
from terrarank.operators.rank import bottom_n, rank_desc, top_n


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value (hot key), plus ties and NULLs."""
    rng = np.random.default_rng(7)
    n = 3000
    v = np.round(rng.normal(50, 20, n), 1)
    v[: n // 3] = 42.0
    pdf = pd.DataFrame({"id": np.arange(n), "v": v})
    pdf.loc[5:9, "v"] = np.nan
    sdf = spark.createDataFrame(pdf).withColumn("v", F.when(F.isnan("v"), None).otherwise(F.col("v")))
    return sdf.persist(), pdf


def test_bucketed_rank_equals_window_rank(skewed):
    sdf, pdf = skewed
    expected = pdf.set_index("id").v.rank(ascending=False, method="min")
    for buckets in (None, 1, 7, 200):
        got = rank_desc(sdf, "v", "r", buckets=buckets)
        assert dict(got.dtypes)["r"] == "bigint"
        r = got.toPandas().set_index("id").r
        assert np.array_equal(expected.sort_index().fillna(-1).values, r.sort_index().fillna(-1).values)


def _single_partition_exchanges(df):
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return [lines[i + 1] for i, line in enumerate(lines) if "Exchange SinglePartition" in line]


def test_rank_plan_has_no_single_partition_on_rows(skewed):
    sdf, _ = skewed
    single = _single_partition_exchanges(rank_desc(sdf, "v", "r", buckets=4))
    # exactly one unpartitioned exchange, and it carries the per-bucket totals
    assert len(single) == 1
    assert "keys=[_b" in single[0]


def test_model_fitted_on_few_rows_ranks_many_without_one_task(spark):
    from terrarank.config import Indicator
    from terrarank.operators.index import fit_index
    indicators = (Indicator("x", 1), Indicator("y", -1))
    small = spark.range(20).selectExpr("id", "cast(id as double) x", "cast(id * id as double) y")
    model = fit_index(small, indicators, weighting="entropy")
    many = spark.range(50_000).selectExpr("id", "cast(id % 977 as double) x", "cast(id % 31 as double) y")
    single = _single_partition_exchanges(model.transform(many, "id"))
    assert all("keys=[_b" in line for line in single)


@pytest.mark.parametrize("accuracy", [10_000, 500, 60, 20])
def test_exact_quantiles_match_numpy(skewed, monkeypatch, accuracy):
    monkeypatch.setattr(stats, "ACCURACY", accuracy)
    monkeypatch.setattr(stats, "SMALL", 2 * accuracy)
    sdf, pdf = skewed
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    out = stats.exact_quantiles(sdf, ["v"], probs).collect()
    got = {r.prob: r.value for r in out}
    vals = pdf.v.dropna().values
    for p in probs:
        assert abs(got[p] - np.quantile(vals, p)) < 1e-9, (p, got[p])


@pytest.mark.parametrize("accuracy", [10_000, 25])
def test_grouped_quantiles(spark, monkeypatch, accuracy):
    """A large group, small ones, groups of two and one rows, one constant group, and the NULL group."""
    monkeypatch.setattr(stats, "ACCURACY", accuracy)
    monkeypatch.setattr(stats, "SMALL", 2 * accuracy)
    rng = np.random.default_rng(3)
    names = ["a"] * 3000 + ["b"] * 40 + ["c"] * 2 + ["d"] + [None] * 700 + ["e"] * 50
    values = np.where(np.array(names) == "e", 7.0, rng.normal(0, 1e6, len(names)))
    values[:1000] = 3.5
    sdf = spark.createDataFrame(list(zip(names, values.tolist())), "g string, v double").repartition(5)
    out = stats.exact_quantiles(sdf, ["v"], [0.25, 0.5, 1.0], group_cols=["g"]).collect()
    assert len(out) == 18
    for r in out:
        own = [v for g, v in zip(names, values) if g == r.g]
        assert r.n == len(own) and abs(r.value - np.quantile(own, r.prob)) < 1e-9


def test_brackets_hold_few_rows_and_a_miss_is_an_error(spark, monkeypatch):
    df = spark.range(60_000).selectExpr("cast(hash(id) as double) as v", "id % 2 as g").persist()
    t = stats._targets(df, ["v"], [0.25, 0.5], ["g"])
    inside = df.join(t, "g").where("v between lo and hi").groupBy("g", "prob").count().collect()
    assert len(inside) == 4 and max(r["count"] for r in inside) < 30_000 * 10 / stats.ACCURACY
    plan = stats.order_statistics(df, ["v"], [0.5])._jdf.queryExecution().toString()
    assert "BatchEvalPython" not in plan and "CartesianProduct" not in plan
    monkeypatch.setattr(stats, "_targets", lambda *a: t.withColumn("hi", F.col("lo")).withColumn("lo", F.col("lo") - 1))
    with pytest.raises(Exception, match="missed its rank"):
        stats.order_statistics(df, ["v"], [0.25, 0.5], ["g"]).collect()


def test_all_null_column_median(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0)], "a double, b double")
    med = stats.column_medians(df, ["a", "b"])
    assert med == {"a": None, "b": 2.0}


def test_corr_matrix_pairwise_complete(spark):
    rows = [(1.0, 2.0, None), (2.0, 4.1, 1.0), (3.0, 6.3, 2.0), (4.0, None, 2.5), (5.0, 9.9, 4.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    out = {(r.x, r.y): r.r for r in stats.corr_matrix(df, ["a", "b", "c"]).collect()}
    pdf = pd.DataFrame(rows, columns=["a", "b", "c"], dtype=float)
    exp = pdf.corr()
    for (x, y), r in out.items():
        assert abs(r - exp.loc[x, y]) < 1e-12


def test_ols_histogram_box(spark):
    rng = np.random.default_rng(5)
    x = rng.random(400)
    pdf = pd.DataFrame({"g": np.where(x > 0.5, "hi", "lo"), "x": x, "y": 3 * x + 1 + rng.normal(0, 0.01, 400)})
    df = spark.createDataFrame(pdf)
    ols = {r.g: r for r in stats.ols_by_group(df, "g", "x", "y").collect()}
    for g, sub in pdf.groupby("g"):
        slope, icpt = np.polyfit(sub.x, sub.y, 1)
        assert abs(ols[g].slope - slope) < 1e-9 and abs(ols[g].intercept - icpt) < 1e-9
    h = stats.histogram(df, "x", bins=10).toPandas()
    counts, _ = np.histogram(x, bins=10)
    assert h.sort_values("bin")["count"].tolist() == counts.tolist()
    box = {r.g: r for r in stats.box_summary(df, "g", "y").collect()}
    for g, sub in pdf.groupby("g"):
        assert abs(box[g].q1 - np.quantile(sub.y, 0.25)) < 1e-12
        assert box[g].max == sub.y.max()


def test_top_and_bottom_n(skewed):
    sdf, pdf = skewed
    t = [r.id for r in top_n(sdf, "v", 5, tie_break=["id"]).collect()]
    exp = pdf.dropna().sort_values(["v", "id"], ascending=[False, True]).id.head(5).tolist()
    assert t == exp
    b = [r.id for r in bottom_n(sdf, "v", 5, tie_break=["id"]).collect()]
    assert b == pdf.dropna().sort_values(["v", "id"]).id.head(5).tolist()
