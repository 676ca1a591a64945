"""Consistent weighted sampling against the exact similarity; neighbours against a plain loop."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from terrarank.llm import fingerprints as C


def similarity(a, b):
    x, y = (Counter(zip([None, *t.split()], t.split())) for t in (a, b))
    top = sum((x | y).values())
    return sum((x & y).values()) / top if top else 1.0


def prose(rnd, n, vocabulary=2000):
    return " ".join(f"w{int(vocabulary * rnd.random() ** 2)}" for _ in range(n))


def test_collision_rate_equals_generalised_jaccard():
    rnd = random.Random(0)
    errors = []
    for share in (0.0, 0.2, 0.5, 0.8, 1.0):
        for weight in (1, 4):
            for _ in range(12):
                common, a, b = (prose(rnd, int(n)) for n in (300 * share, 300 * (1 - share), 300 * (1 - share)))
                x, y = ((" ".join([t, common]) + " ") * k for t, k in ((a, 1), (b, weight)))
                errors.append(C.likeness(C.fingerprint(x), C.fingerprint(y)) - similarity(x, y))
    assert abs(np.mean(errors)) < 0.015 and np.abs(errors).max() < 0.2


def test_weights_scale_smoothly():
    sampler = C.Sampler(samples=96)
    terms = np.unique(np.random.default_rng(0).integers(0, 2**63, 400, dtype=np.uint64))
    one = sampler.fingerprint(terms, np.full(len(terms), 4))
    got = np.mean([C.likeness(one, sampler.fingerprint(terms, np.full(len(terms), k))) for k in (5, 3)])
    assert got == pytest.approx((4 / 5 + 3 / 4) / 2, abs=0.1)


def test_chunks_do_not_matter(monkeypatch):
    text = prose(random.Random(1), 3000, 300)
    whole = C.fingerprint(text)
    monkeypatch.setattr(C, "CHUNK", 37)
    assert C.fingerprint(text) == whole


def rows_of_case():
    rnd = random.Random(5)
    rows = [(i * 3, prose(rnd, rnd.choice([0, 1, 2, 9, 200]))) for i in range(70)]
    return rows + [(500, None), (501, ""), (502, " \n"), (503, "ñandú 👩‍👩 x" * 40), (9, rows[3][1]), (9, rows[3][1]),
                   (None, "no id"), (504, prose(rnd, 60_000))]


def slow(rows):
    out = []
    # the hash that orders rows of one id is not rebuilt here; only ids with equal texts repeat
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    for (key, text), (_, following) in zip(order, order[1:] + order[:1]):
        text, following = text or "", following or ""
        half = len(text) // 2
        changed = text[:len(text) - half] + following[:half]
        out.append((key, len(text), hashlib.sha256(changed.encode()).hexdigest(), C.fingerprint(text).hex(),
                    C.fingerprint(changed).hex(), C.likeness(C.fingerprint(text), C.fingerprint(changed)),
                    C.likeness(C.fingerprint(text), C.fingerprint(following))))
    return sorted(out, key=str)


@pytest.mark.parametrize("parts", ["1", "7"])
def test_neighbours(spark, parts):
    rows = [r for r in rows_of_case() if r[0] != 9] + [(9, "same text")] * 3
    before = spark.conf.get("spark.sql.shuffle.partitions")
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame([(d, t, 1, True) for d, t in rows], "doc_id long, text string, id int, seam boolean")
        got = C.fingerprint_neighbours(df).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    assert sorted(map(tuple, got), key=str) == slow(rows)


def test_one_row_and_none(spark):
    df = spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")
    (row,) = C.fingerprint_neighbours(df).collect()
    assert row.near_next == 1.0 and row.n_chars == 7
    assert C.fingerprint_neighbours(df.limit(0)).count() == 0


def test_blank_texts():
    assert C.fingerprint(None) == C.fingerprint("  ") == bytes(2 * C.SAMPLES)
    assert C.likeness(C.fingerprint(""), C.fingerprint("x")) == 0
