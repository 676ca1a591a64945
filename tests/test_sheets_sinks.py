"""Header offsets of landed sheets; skipped, refreshed and swapped writes; sampled silhouettes."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrarank.operators import silhouette as S
from terrarank.sources import (
    cell, header_choices, is_complete, read_lines, read_sheets, refresh_partitions, register_dataset, swap_table, write_if_absent,
)


def land(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")


def plain_choice(lines, offsets=(9, 10, 8, 7)):
    """Read with so many lines skipped, first offset whose columns hold a key in their first 20 values."""
    table = [[c.strip() or None for c in line.split(";")] for line in lines]
    for h in offsets:
        if h >= len(table):
            continue
        body = table[h + 1:]
        for c in range(max(map(len, body), default=0)):
            head = [r[c] for r in body if c < len(r) and r[c]][:20]
            if any(v.isdigit() and len(v) in (6, 7) for v in head):
                return h, c
    return None


def sheet(top, rows):
    return [f"note {i}" for i in range(top)] + ["uf;code;value"] + rows


CASES = {
    "ten.csv": sheet(9, [f"RO;{1100000 + i};{i}" for i in range(60)]),
    "short.csv": sheet(7, ["SP;3550308;1"]),
    "two.csv": sheet(7, ["SP;3550308;1", "SP;3550309;2"]),
    "late.csv": sheet(7, [f"SP;n/a;{i}" for i in range(22)] + [f"SP;{3550308 + i};2" for i in range(9)]),
    "blank.csv": sheet(9, ["RO;;1"] * 40 + ["RO;110001;7", "RO; 1100015 ;8", "RO;total;9"]),
    "none.csv": sheet(9, ["a;b;c"] * 5),
    "tiny.csv": ["only", "a", "few", "1100015"],
}


def test_header_offsets(spark, tmp_path):
    for name, lines in CASES.items():
        land(str(tmp_path), name, lines)
    lines = read_lines(spark, str(tmp_path))
    got = {os.path.basename(r.file): (r.offset, r.key_position) for r in header_choices(lines).collect()}
    assert got == {n: c for n, v in CASES.items() if (c := plain_choice(v))}
    assert {o for o, _ in got.values()} == {9, 10, 8, 7}
    rows = read_sheets(spark, str(tmp_path)).withColumn("uf", cell("uf")).withColumn("absent", cell("nowhere")).collect()
    by = {}
    for r in rows:
        by.setdefault(os.path.basename(r.file), []).append(r)
    assert sorted(r.key for r in by["ten.csv"]) == [str(1100000 + i) for i in range(60)]
    assert {(r.uf, r.key_name, r.absent) for r in by["ten.csv"]} == {("RO", "code", None)}
    assert sorted(r.key for r in by["blank.csv"]) == ["0110001", "1100015"] and len(by["short.csv"]) == 1 and "none.csv" not in by


def test_small_blocks_keep_the_order_of_lines(spark, tmp_path):
    """A file cut into many blocks: only its first one holds the header."""
    land(str(tmp_path), "long.csv", sheet(9, [f"RO;{1100000 + i};{'x' * 50}" for i in range(3000)]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = read_lines(spark, str(tmp_path))
        assert lines.select("block").distinct().count() > 3
        assert read_sheets(spark, str(tmp_path)).select("key").distinct().count() == 3000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_half_written_targets_are_written_anew(spark, tmp_path):
    df = spark.range(10)
    path = str(tmp_path / "t")
    assert write_if_absent(df, path) and is_complete(spark, path) and not write_if_absent(df.limit(1), path)
    assert spark.read.parquet(path).count() == 10
    os.remove(f"{path}/_SUCCESS")  # a job killed before it committed leaves none
    assert not is_complete(spark, path) and write_if_absent(df.limit(3), path)
    assert spark.read.parquet(path).count() == 3 and is_complete(spark, path)


def test_a_write_killed_half_way_is_not_complete(spark, tmp_path):
    path = str(tmp_path / "killed")
    broken = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        write_if_absent(broken, path)
    assert not is_complete(spark, path)
    assert write_if_absent(spark.range(5), path) and spark.read.parquet(path).count() == 5


def test_only_changed_years_are_written(spark, tmp_path):
    path = str(tmp_path / "years")
    df = spark.createDataFrame([(k, y, float(k * y)) for y in (2000, 2001, 2002) for k in range(50)], "k int, year int, v double")
    assert refresh_partitions(df, path, "year") == ([2000, 2001, 2002], [])
    first = files(path)
    assert refresh_partitions(df.repartition(7), path, "year") == ([], []) and files(path) == first  # order does not matter
    changed = df.where("year <> 2002 and not (year = 2001 and k = 3)").unionByName(spark.createDataFrame([(1, 2005, 1.0)], df.schema))
    assert refresh_partitions(changed, path, "year") == ([2001, 2005], [2002])
    now = files(path)
    assert {f for f in first if "year=2000" in f} == {f for f in now if "year=2000" in f and now[f] == first[f]}
    assert not any(f in now for f in first if "year=2000" not in f)
    assert sorted(map(tuple, spark.read.schema(df.schema).parquet(path).select(df.columns).collect())) == sorted(map(tuple, changed.collect()))


def test_tables_are_swapped(spark, tmp_path):
    name = "terrarank_swap_test"
    try:
        one = swap_table(spark.range(3), name, str(tmp_path))
        assert spark.table(name).count() == 3
        two = swap_table(spark.range(5), name, str(tmp_path))
        assert spark.table(name).count() == 5 and os.path.exists(one)  # readers of the old version can finish
        broken = spark.range(9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("id"))
        with pytest.raises(Exception, match="lost"):
            swap_table(broken, name, str(tmp_path))
        assert spark.table(name).count() == 5
        swap_table(spark.range(7), name, str(tmp_path))
        assert spark.table(name).count() == 7 and not os.path.exists(one) and os.path.exists(two)
        swap_table(spark.range(2).selectExpr("id", "'x' as other"), name, str(tmp_path))
        assert spark.table(name).columns == ["id", "other"]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_registered_datasets_follow_their_partitions(spark, tmp_path):
    name, path = "terrarank_years_test", str(tmp_path / "y")
    try:
        df = spark.createDataFrame([(1, 2000), (2, 2001)], "k int, year int")
        refresh_partitions(df, path, "year")
        register_dataset(spark, name, path)
        assert spark.table(name).where("year = 2001").count() == 1
        refresh_partitions(df.where("year = 2000").unionByName(spark.createDataFrame([(3, 2002), (4, 2002)], df.schema)), path, "year")
        register_dataset(spark, name, path)
        assert sorted((r.k, r.year) for r in spark.table(name).collect()) == [(1, 2000), (3, 2002), (4, 2002)]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


# ----------------------------------------------------------------- silhouette
def plain_silhouettes(x, labels):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    out = []
    for i, own in enumerate(labels):
        same = [j for j in range(len(x)) if labels[j] == own and j != i]
        if not same:
            out.append(0.0)
            continue
        a = d[i, same].mean()
        b = min(d[i, [j for j in range(len(x)) if labels[j] == k]].mean() for k in set(labels) if k != own)
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return out


def test_silhouettes_equal_plain_distances(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 17)
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(c, 1, (40, 3)) for c in (0, 4, 9)] + [[[50, 50, 50]], [[0, 0, 0]] * 3])
    labels = ["a"] * 40 + ["b"] * 40 + ["c"] * 40 + ["alone"] + ["a"] * 3
    rows = [(i, lab, *map(float, v)) for i, (lab, v) in enumerate(zip(labels, x))] + [(900, None, 1.0, 1.0, 1.0), (901, "a", None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "id int, label string, p double, q double, r double")
    got = {r.id: r.silhouette for r in S.silhouettes(df.repartition(6), "id", ["p", "q", "r"], "label").collect()}
    assert len(got) == len(x) and np.allclose([got[i] for i in range(len(x))], plain_silhouettes(x, labels), atol=1e-9)
    some = S.silhouettes(df, "id", ["p", "q", "r"], "label", rows=30).collect()
    again = S.silhouettes(df.repartition(3), "id", ["p", "q", "r"], "label", rows=30).collect()
    assert len(some) == 30 and sorted(map(tuple, some)) == sorted(map(tuple, again))
    assert S.mean_silhouette(df.where("label = 'a'"), "id", ["p"], "label") is None
