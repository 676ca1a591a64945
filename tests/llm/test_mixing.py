"""Targets by a plain loop, the order sample against a plain sort, and the cases."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from terrarank.llm import mixing as M


def slow_targets(sizes):
    """Reshare by weight until none is above three times its size."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, free, left = {}, set(names), sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        capped = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not capped:
            return target | {s: level * weight[s] for s in free}
        target |= {s: 3.0 * sizes[s] for s in capped}
        left -= sum(3 * sizes[s] for s in capped)
        free -= capped
    return target


def corpus(seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(600):
        source = rnd.choice(["a"] * 12 + ["b", "é", "Z", "zz", None, "tiny" if i < 40 else "b"])
        rows.append((i, " ".join("w" * rnd.randrange(1, 4) for _ in range(int(rnd.paretovariate(1.1) * 5))), source))
    return rows + [(1000, None, "a"), (1001, "", "b"), (1002, " \n", None), (1003, "x " * 30_000, "a"), (5, rows[5][1], rows[5][2]),
                   (5, rows[5][1], rows[5][2]), (None, "some words here", "a"), (1004, None, "empty source")]


@pytest.mark.parametrize("seed", [0, 1])
def test_mixture(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, 1.5) for r in rows], "doc_id long, text string, source string, size double")
    got = M.mixture(df).collect()
    assert len(got) == len(rows)
    count = {(d, t): len((t or "").split()) for d, t, _ in rows}
    source_of = {(d, n): s for (d, t, s) in rows for n in [count[d, t]]}
    sizes, taken, smallest = defaultdict(int), defaultdict(int), {}
    for d, t, s in rows:
        sizes[s] += count[d, t]
    want = slow_targets(dict(sizes))
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    for r in got:
        s = source_of[r.doc_id, r.size]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.size * r.copies
        taken[s] += r.taken
    longest = defaultdict(int)
    for (d, t), n in count.items():
        longest[source_of[d, n]] = max(longest[source_of[d, n]], n)
    for s in sizes:
        near = longest[s] / 2 if s == "a" else 0.02 * want[s] + 5  # "a" holds one document of most of its words
        assert abs(want[s] - taken[s]) <= near, (s, want[s], taken[s])
    again = M.mixture(df.repartition(5)).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, got), key=str)
    mixed = M.mix(df)
    assert mixed.schema == df.schema
    assert sorted(r.doc_id or -1 for r in mixed.collect()) == sorted(r.doc_id or -1 for r in got for _ in range(r.copies))


def scale_by_hand(sizes, rest):
    """c of min(1, c * size): sizes that reach 1 are certain, one at a time, from the largest."""
    sizes, left = sorted((x for x in sizes if x), reverse=True), rest
    while sizes:
        c = left / sum(x * x for x in sizes)
        if c * sizes[0] < 1:
            return c
        left -= sizes.pop(0)
    return 0.0


def test_first_round_is_the_order_sample(spark):
    rows = corpus(2)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sized = df.select("source", M.word_count(F.col("text")).alias("size"), M.uniform(F.col("doc_id"), F.col("text")).alias("u"))
    plan = {r.source: r for r in M.sampling_plan(sized).collect()}
    by = defaultdict(list)
    for r in sized.collect():
        by[r.source].append((r.u, r["size"]))
    for s, p in plan.items():
        if not p.share:
            continue
        assert p.scale == pytest.approx(scale_by_hand([n for _, n in by[s]], p.rest), rel=1e-9)
        groups = defaultdict(int)
        for u, n in by[s]:
            if n:
                chance = min(1.0, p.scale * n)
                groups[(u * (1 - chance)) / ((1 - u) * chance), u, n] += n
        left, taken = p.rest, set()
        for key in sorted(groups):
            if groups[key] > left:
                break
            left -= groups[key]
            taken.add(key)
        odds = p.share / (1 - p.share)
        assert taken == {g for g in groups if int(g[0] * odds / (1 + g[0] * odds) * 2**48) <= p.cut0}, s


def test_inclusion_is_proportional_to_size(spark):
    """Many sources of the same sizes and weight: how often the order sample takes a document of each size, against
    its probability. (The rounds after it fill the gap with documents that fit, and so prefer short ones.)"""
    sizes = [1, 2, 3, 5, 8, 13, 21, 34] * 6
    rows = [(1000 * k + i, "w " * n, f"s{k:04d}") for k in range(600) for i, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sized = df.select("source", M.word_count(F.col("text")).alias("size"), M.uniform(F.col("doc_id"), F.col("text")).alias("u"))
    plan = M.sampling_plan(sized)
    light = plan.where("whole = 0")  # weight 1: half of its size
    assert light.count() == 200
    got = {r["size"]: r.n for r in M._keyed(sized, light).where(M._chosen(1)).groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    c = scale_by_hand(sizes, sum(sizes) / 2)
    for n in set(sizes):
        assert abs(got.get(n, 0) / 1200 - min(1.0, c * n)) < 0.05, (n, got.get(n, 0) / 1200, c * n)


@pytest.mark.parametrize("share", [1e-7, 1e-3, 0.5, 1 - 1e-7])
def test_order_is_spread_at_any_share(spark, share):
    """No place of the order's first two levels gathers the documents, however small the share."""
    rows = spark.range(200_000).select(((F.col("id") + 0.5) / 200_000).alias("u"))
    key = M.order_key(F.col("u"), F.lit(share), F.lit(share))
    first = M.ORDER_BITS - M.STRETCH_BITS
    most = rows.groupBy(F.shiftright(key, first)).count().agg(F.max("count")).first()[0]
    assert most <= 200_000 / 4096 + 2


def test_empty_and_single(spark):
    df = spark.createDataFrame([(1, "a b c", "x")], "doc_id long, text string, source string")
    assert [tuple(r) for r in M.mixture(df).collect()] == [(1, 3, 3, 3.0, 3, 1)]
    assert M.mixture(df.limit(0)).count() == 0
    assert M.mix(df.limit(0)).count() == 0
    none = spark.createDataFrame([(1, None, None)], "doc_id long, text string, source string")
    assert [tuple(r) for r in M.mixture(none).collect()] == [(1, 0, 0, 0.0, 0, 0)]


def test_sources_are_numbered_in_order_in_many_tasks(spark, monkeypatch):
    names = [f"s{i:04d}" for i in random.Random(6).sample(range(3000), 900)] + [None, ""]
    rows = spark.createDataFrame([(n, 1 + i % 5) for i, n in enumerate(names)], "source string, source_size long")
    tasks = []
    small = M._small
    monkeypatch.setattr(M, "_small", lambda df: tasks.append(
        df.select(F.spark_partition_id().alias("p")).distinct().count()) or small(df))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.source: r.place for r in M._places(rows).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    want = [*sorted(n for n in names if n is not None), None]
    assert got == {n: i for i, n in enumerate(want)}
    assert max(tasks) > 1
