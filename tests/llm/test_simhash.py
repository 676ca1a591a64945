"""SimHash near-duplicates against brute force, and the defined edge cases."""

import random

import numpy as np
import pytest
import xxhash

from terrarank.llm import simhash as S

SCHEMA = "doc_id long, text string, fp string, root int"  # fp and root clash with names used inside


def slow_fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [words] if len(words) < width else [words[i:i + width] for i in range(len(words) - width + 1)]
    hashes = [xxhash.xxh64(b" ".join(s), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows, radius=3):
    fps = [slow_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, f"{fps[i]:016x}", low.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def corpus():
    rnd = random.Random(5)
    rows = []
    for i in range(60):
        words = [f"w{rnd.randrange(400)}" for _ in range(rnd.choice([1, 2, 3, 40, 300]))]
        rows.append((i, " ".join(words)))
        for k in range(rnd.choice([0, 0, 3])):
            copy = list(words)
            copy[rnd.randrange(len(copy))] = f"x{k}"
            rows.append((1000 + 10 * i + k, "\n".join(copy)))
    rows += [(2000, None), (2001, ""), (2002, " \t\n"), (2003, "Q"), (2004, "q"), (2004, "q"), (None, "q"),
             (None, "alone here now"), (2005, "ÀB c " * 20_000)]
    return rows


def test_components_equal_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA)
    got = S.simhash_components(df, tile=8).collect()
    assert sorted(map(tuple, got), key=str) == slow_components(rows)


def test_one_row_per_component_stays_with_its_columns(spark):
    rows = corpus()
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA)
    kept = S.keep_one_per_component(df)
    assert kept.schema == df.schema
    comps = {(f, c) for _, f, c in slow_components(rows)}
    want = {c for _, c in comps if c is not None}
    got = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in got if x is not None) == sorted(want)
    assert sum(x is None for x in got) == 1  # the component without any id


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert S.simhash_components(df).count() == 0
    assert S.keep_one_per_component(df).count() == 0


@pytest.mark.parametrize("dense", [False, True])
def test_forest_keeps_connectivity(dense):
    rnd = np.random.default_rng(0)
    base = rnd.integers(0, 2**63, 4, dtype=np.uint64)
    flips = rnd.integers(0, 4 if dense else 64, 300)
    fps = np.unique(base[rnd.integers(0, 4, 300)] ^ (np.uint64(1) << flips.astype(np.uint64)))
    u, v = S.forest(fps, fps, 3)
    assert len(u) <= 2 * len(fps) + len(fps)

    def classes(pairs):
        label = {x: x for x in fps}
        changed = True
        while changed:
            changed = False
            for a, b in pairs:
                low = min(label[a], label[b])
                if label[a] != low or label[b] != low:
                    label[a] = label[b] = low
                    changed = True
        return label

    every = [(a, b) for a in fps for b in fps if bin(int(a) ^ int(b)).count("1") <= 3]
    assert classes(list(zip(u, v))) == classes(every)


def test_population_counts_reach_every_link():
    rnd = np.random.default_rng(1)
    steps = set(S._offsets(3))
    for _ in range(500):
        a = int(rnd.integers(0, 2**63))
        b = a
        for bit in rnd.choice(64, 3, replace=False):
            b ^= 1 << int(bit)
        quarters = [tuple(bin(x >> 16 * q & 0xFFFF).count("1") for q in range(4)) for x in (a, b)]
        d = tuple(y - x for x, y in zip(*quarters))
        assert d in steps or tuple(-x for x in d) in steps
