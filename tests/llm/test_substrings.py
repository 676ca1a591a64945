"""Window dedup against brute force over many chunkings; the estimate loses nothing."""

import random

import numpy as np
import pytest

from terrarank.llm import substrings as S


def slow(rows, n):
    """Rows must be given in the order that settles equal ids."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, k))
    words = [(t or "").encode().split() for _, t in rows]
    seen, out = set(), {}
    for k in order:
        w, gone = words[k], set()
        for i in range(len(w) - n + 1):
            key = tuple(w[i:i + n])
            if key in seen:
                gone.update(range(i, i + n))
            seen.add(key)
        out[k] = (rows[k][0], len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode())
    return sorted(out.values(), key=str)


def corpus(seed, letters):
    rnd = random.Random(seed)

    def prose(n):
        return [f"{rnd.choice('abcdefghij' * 9 + 'é')}{rnd.randrange(letters)}" for _ in range(n)]

    passage = prose(60)
    rows = []
    for i in range(80):
        text = prose(rnd.choice([0, 1, 4, 5, 40, 120]))
        for _ in range(rnd.choice([0, 1, 1, 2])):
            a = rnd.randrange(40)
            at = rnd.randrange(len(text) + 1)
            text[at:at] = passage[a:a + rnd.randrange(3, 21)]
        rows.append((rnd.randrange(10**6) * 100 + i, rnd.choice([" ", "\n", " \t "]).join(text)))
    rows += [(10**9 + k, rows[5][1]) for k in range(12)]
    return rows + [(-5, None), (-4, ""), (-3, "same " * 50), (-2, " ".join(passage) + " " + " ".join(passage)),
                   (10**10, " ".join(prose(20_000) + passage))]


@pytest.mark.parametrize("seed, letters, window, chunk", [(0, 50, 5, 300), (1, 3, 5, 1000), (2, 50, 20, 1 << 22), (3, 4, 9, 1)])
def test_equals_brute_force(spark, seed, letters, window, chunk):
    rows = corpus(seed, letters)
    df = spark.createDataFrame([(d, t, 7) for d, t in rows], "doc_id long, text string, chunk int").repartition(3)
    got = S.remove_repeated_windows(df, window=window, chunk_bytes=chunk).collect()
    assert sorted(map(tuple, got), key=str) == slow(rows, window)


def test_repeated_rows_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text), (1, text), (1, text), (2, "x " + text)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_removed) for r in S.remove_repeated_windows(df).collect())
    assert got == [("1", 30), ("1", 30), ("2", 30), ("None", 0)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.remove_repeated_windows(df).count() == 0


def test_equal_windows_share_a_key_and_its_places_are_enough():
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice("ab") for _ in range(rnd.randrange(60))).encode() for _ in range(40)] + [b"a " * 90]
    chunk = S.Chunk(texts, 12)
    key, distinct, places = chunk.keys()
    flat = [w for t in texts for w in t.split()]
    by_window = {}
    for s, k in zip(chunk.starts.tolist(), key.tolist()):
        by_window.setdefault(tuple(flat[s:s + 12]), []).append(k)
    count = dict(zip(distinct.tolist(), places.tolist()))
    assert len(by_window) > 100
    for keys in by_window.values():
        assert len(set(keys)) == 1
        assert count[keys[0]] >= len(keys)


def test_packing_of_numbers():
    for kind in (np.uint8, np.uint32, np.int64):
        x = np.random.default_rng(0).integers(0, 200, 1000).astype(kind)
        assert np.array_equal(S._unzip(S._zip(x), kind), x)
        assert len(S._unzip(S._zip(x[:0]), kind)) == 0


def test_groups_grow_in_number_not_in_size(spark):
    docs = spark.range(1)
    tasks = S.n_tasks(docs)
    for sent in (0, S.GROUP_BYTES * 10, S.GROUP_BYTES * 5000):
        bits = S._group_bits(docs, sent)
        assert sent / (1 << bits) <= S.GROUP_BYTES and 1 << bits >= tasks and (1 << bits) <= 2 * max(tasks, sent // S.GROUP_BYTES + 1)
