"""NB-SVM classifier: features and counts by brute force, the dual solution, held-out accuracy, cases."""

import random
import zlib

import numpy as np
import pytest

from terrarank.llm import quality as Q


def prose(rnd, n=60):
    return " ".join("".join(rnd.choice("abcdeilnorst") for _ in range(rnd.randrange(2, 9))) for _ in range(n)) + "."


def junk(rnd):
    words = prose(rnd).split()
    kind = rnd.randrange(3)
    if kind == 0:
        return " ".join(w.upper() + "!!" for w in words)
    if kind == 1:
        return " | ".join(words)
    return " ".join(w for w in words[:12] for _ in range(8))


def slow_features(text):
    data, out = (text or "").encode(), set()
    size = (1 << 32) - 1

    def bucket(code):
        return ((code * 2654435761) & size) >> (32 - 17)

    for i in range(len(data) - 2):
        out.add(bucket(data[i] << 16 | data[i + 1] << 8 | data[i + 2]))

    def kind(b):
        return 0 if b >= 128 or 97 <= b <= 122 else 1 if 65 <= b <= 90 else 2 if 48 <= b <= 57 else 3

    words = data.split()
    shape = [16 if i and w == words[i - 1] else 4 * kind(w[0]) + kind(w[-1]) for i, w in enumerate(words)]
    for n in (1, 2, 3):
        for i in range(len(shape) - n + 1):
            out.add(bucket((n << 24) + sum(shape[i + k] << 5 * k for k in range(n))))
    return sorted(out)


@pytest.mark.parametrize("text", [None, "", "a", " ab ", "The the THE the!! 9é\n\t é9 é9 é9", "x " * 3000])
def test_features(text):
    f = Q.Features()
    assert f(text).tolist() == slow_features(text)
    assert not f.mark.any()


def test_dual_solution_is_optimal():
    rnd = np.random.default_rng(0)
    rows = [np.unique(rnd.integers(0, 30, 8)) for _ in range(60)]
    labels = np.array([int(3 in r or 4 in r) for r in rows])
    scale = rnd.normal(size=30)
    w, b = Q.dual_coordinate_descent(rows, labels, scale, epochs=4000)
    x = np.zeros((60, 30))
    for i, r in enumerate(rows):
        x[i, r] = scale[r] / np.linalg.norm(scale[r])
    y = np.where(labels, 1, -1)

    def loss(w, b):
        return 0.5 * (w @ w + b * b) + (np.maximum(0, 1 - y * (x @ w + b)) ** 2).sum()

    best = loss(w, b)
    for _ in range(200):
        assert loss(w + 0.01 * rnd.normal(size=30), b + 0.01 * rnd.normal()) >= best - 1e-4


def tables(spark, n=400):
    rnd = random.Random(1)
    docs, labels = [], []
    for i in range(n):
        bad = rnd.random() < 0.25
        docs.append((i, junk(rnd) if bad else prose(rnd), "x"))
        labels.append((i, 0 if bad else 1))
    return docs, labels


def test_held_out_accuracy_and_counts(spark):
    docs, labels = tables(spark)
    extra = [(1000, None, "x"), (1001, "", "x"), (None, "some text", "x"), (3, docs[3][1], "x"), (1002, prose(random.Random(9)) * 3000, "x")]
    df = spark.createDataFrame(docs + extra, "doc_id long, text string, label string")
    marks = spark.createDataFrame([*labels, (1000, None), (None, 1), (5, 1 - labels[5][1])], "doc_id long, quality int")
    got = Q.classify(df, marks).collect()
    assert len(got) == len(docs) + len(extra)
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 40
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    kept = Q.keep_good(df, marks)
    assert kept.schema == df.schema
    assert kept.count() == sum(r.predicted for r in got)

    rows = df.where("doc_id < 50").selectExpr("text", "cast(doc_id % 2 as int) label")
    n, counts = Q.class_counts(rows.repartition(3))
    want = np.zeros((2, Q.BUCKETS))
    for r in rows.collect():
        want[r.label][slow_features(r.text)] += 1
    assert np.array_equal(counts, want) and n.sum() == rows.count()


def test_held_out_labels_are_not_read(spark):
    docs, labels = tables(spark, 200)
    df = spark.createDataFrame(docs, "doc_id long, text string, label string")
    flipped = [(d, 1 - q if zlib.crc32(str(d).encode()) % 5 == 0 else q) for d, q in labels]
    a, b = (sorted(map(tuple, Q.classify(df, spark.createDataFrame(m, "doc_id long, quality int")).collect()))
            for m in (labels, flipped))
    assert a == b


def test_too_few_labels(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert {r.score for r in Q.classify(df, none).collect()} == {0.5}
    assert {r.score for r in Q.classify(df, one).collect()} <= {0.5, 1.0}
    assert Q.classify(df.limit(0), none).count() == 0


def test_sample_is_bounded(spark):
    docs, labels = tables(spark, 200)
    df = spark.createDataFrame(docs, "doc_id long, text string, label string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    assert isinstance(Q.fit(df, marks, sample_rows=20, sample_ids=8000), Q.Model)
