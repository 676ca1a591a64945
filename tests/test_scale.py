"""Steps whose tasks must not grow with the tables."""

import datetime

from pyspark.sql import functions as F

from terrarank.operators import ml, stats
from terrarank.plans import analog as A


def test_shared_join_is_dealt_out_by_size(spark, tmp_path, monkeypatch):
    day = datetime.datetime(1998, 5, 1)
    orders = [(i, i % 40 if i % 9 else None, "1-URGENT" if i % 2 else None, day.replace(year=1995 + i % 5)) for i in range(200)]
    lines = [(i % 210 if i % 13 else None, day.replace(year=1996 + i % 4), float(i % 7), float(i), 0.25) for i in range(800)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderpriority string, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_shipdate timestamp, l_quantity double, l_extendedprice double, l_discount double").write.parquet(
        f"{tmp_path}/lineitem.parquet")

    def found():
        act = A.activity(spark, str(tmp_path))
        rows = sorted(map(repr, act.collect()))
        parts = act.select(F.spark_partition_id().alias("p")).distinct().count()
        act.unpersist()
        return rows, parts

    few, _ = found()
    monkeypatch.setattr(A, "LINES_A_TASK", 10)
    many, parts = found()
    assert many == few and parts > 20  # 80 parts for 40 customers


def test_short_passes_run_in_few_tasks(spark, monkeypatch):
    """Boosting and k-means take as many tasks as the rows call for, not as the tables came in."""
    rows = [(i, float(i % 7), float(i * i % 11), float(i % 5)) for i in range(60)]
    base = spark.createDataFrame(rows, "id int, a double, b double, label double").repartition(6)
    design = ml.VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(base)
    seen = []

    def fit(self, df, params=None):
        seen.append(df.rdd.getNumPartitions())

    monkeypatch.setattr(ml.GBTRegressor, "fit", fit)
    ml.make_estimator("gradient_boosting").fit(design)
    own = ml._kmeans
    monkeypatch.setattr(ml, "_kmeans", lambda df, *a: seen.append(df.rdd.getNumPartitions()) or own(df, *a))
    ml.choose_k(design, "id", ks=(2, 3), restarts=1)
    assert seen == [1, 1, 1]
    monkeypatch.setattr(ml, "TASK_ROWS", 20)
    assert ml.in_few_tasks(design).rdd.getNumPartitions() == 3


def test_json_files_follow_the_rows_not_their_keys(spark, tmp_path, monkeypatch):
    from terrarank.plans import catalog
    day = datetime.datetime(1998, 5, 1)
    orders = [(i * 1000 if i % 50 else None, 2.5 * i, day) for i in range(1, 301)]
    spark.createDataFrame(orders * 2, "o_orderkey long, o_totalprice double, o_orderdate timestamp").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(catalog, "_scratch", lambda spark, name: f"{tmp_path}/{name}")
    monkeypatch.setattr(catalog, "JSON_FILE_ROWS", 250)
    found = catalog.q_flat_json_extract(spark, str(tmp_path)).collect()
    want = [(str(k + 1_000_000)[:7], 1998, None if k % 7 == 0 else v) for k, v, _ in orders if k is not None] * 2  # rows without a key are cleaned away
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, want))
    assert 3 <= len(list((tmp_path / "flat-json").glob("*/*.txt"))) <= 8  # 600 rows, 250 a file and task


def test_grouped_quantiles_are_dealt_out_by_size(spark, monkeypatch):
    """Groups of a few rows, a NULL group larger than a part, NULL values: the same rows, in more parts."""
    rows = [(None if i % 3 == 0 else i // 4, "x" if i % 2 else None, float(i * 37 % 101) if i % 13 else None, float(i)) for i in range(900)]
    df = spark.createDataFrame(rows + [(5000, "x", None, None)], "g long, h string, v double, w double")

    def found(group_cols, cols, empty):
        out = stats.order_statistics(df, cols, [0.25, 0.5, 0.9], group_cols, empty)
        return out.columns, sorted(map(repr, map(tuple, out.collect()))), out.select(F.spark_partition_id()).distinct().count()

    cases = [(["g"], ["v"], False), (["g"], ["v", "w"], True), (["g", "h"], ["w"], False)]
    before = [found(*c) for c in cases]
    monkeypatch.setattr(stats, "GROUPED_ROWS", 40)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where the brackets are too many to broadcast
    try:
        after = [found(*c) for c in cases]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for (names, few, _), (same, many, parts) in zip(before, after):
        assert same == names and many == few and parts > 10
