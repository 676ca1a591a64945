"""Greedy string tiling against a plain search for the longest match, and both ways to find candidates."""

import random

import numpy as np
import pytest

from terrarank.llm import decontaminate as D


def slow_tile(item, doc, least=5):
    least = min(least, len(item))
    a, b, tiles = [False] * len(item), [False] * len(doc), []
    while least:
        best = (0, 0, 0)
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while (i + n < len(item) and d + n < len(doc) and not a[i + n] and not b[d + n]
                       and item[i + n] == doc[d + n] != 0):
                    n += 1
                if n > best[0]:
                    best = (n, i, d)
        if best[0] < least:
            break
        n, i, d = best
        tiles.append(best)
        a[i:i + n], b[d:d + n] = [True] * n, [True] * n
    return tiles


def test_tiles_equal_plain_search():
    rnd = random.Random(0)
    for round_ in range(250):
        letters = rnd.choice([1, 2, 3, 30])
        item = [rnd.randrange(1, letters + 1) for _ in range(rnd.randrange(0, 26))]
        parts = [item[i:i + 6] for i in range(0, len(item), 6)]
        rnd.shuffle(parts)
        doc = [x for p in parts for x in [*p, *[rnd.randrange(0, letters + 1)] * rnd.randrange(3)]]
        got = D.tile(np.array(item, np.uint64), np.array(doc, np.uint64))
        assert got == slow_tile(item, doc), (round_, item, doc)
        bound = D.coverage_bound(np.array(item, np.uint64), np.array(doc, np.uint64))
        if item:
            assert bound >= sum(t[0] for t in got) / len(item) - 1e-12


def words(rnd, n):
    return ["".join(rnd.choice("abcdefgh") for _ in range(4)) for _ in range(n)]


def corpus():
    rnd = random.Random(2)
    items = [(i, " ".join(words(rnd, rnd.choice([3, 5, 20, 60])))) for i in range(12)]
    items += [(50, None), (51, ""), (52, items[3][1]), (None, " ".join(words(rnd, 30)))]
    docs = []
    for i in range(60):
        text = words(rnd, rnd.choice([0, 3, 40, 200]))
        if i % 3 == 0:
            passage = (items[i % 12][1] or "").split()
            kind = i % 4
            if kind == 1:  # reordered
                cut = len(passage) // 2
                passage = passage[cut:] + ["x"] + passage[:cut]
            if kind == 2:  # too little
                passage = passage[:len(passage) // 2]
            if kind == 3:
                passage = [w.upper() for w in passage]
            text[len(text) // 2:len(text) // 2] = passage
        docs.append((i, "\n".join(text)))
    docs += [(100, None), (101, ""), (3, docs[3][1]), (3, "clean text under the same id as another row"), (None, docs[6][1]),
             (None, "clean and without an id"), (102, " ".join(words(rnd, 60_000)) + " " + items[2][1])]
    return docs, items


def slow_pairs(docs, items):
    out = {}
    for d, text in docs:
        for i, item in items:
            a, b = D.words_of(item), D.words_of(text)
            if not a or not b or len(b) > 10_000:
                continue
            got = sum(t[0] for t in slow_tile(a, b)) / len(a)
            if got >= 0.8:
                out[d, i] = max(out.get((d, i), 0), got)
    return out


@pytest.fixture(scope="module")
def frames(spark):
    docs, items = corpus()
    return (spark.createDataFrame([(d, t, "x", 1.0) for d, t in docs], "doc_id long, text string, item string, coverage double"),
            spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int"),
            slow_pairs(docs, items))


@pytest.mark.parametrize("limit", [10**6, 0])
def test_pairs_equal_plain_search(frames, limit):
    docs, items, want = frames
    got = {(r.doc_id, r.item_id): r.coverage for r in D.contaminated_pairs(docs, items, broadcast_words=limit).collect()}
    long_doc = {k for k in got if k[0] == 102}
    assert (102, 2) in long_doc
    assert {k: v for k, v in got.items() if k not in long_doc} == pytest.approx(want)


@pytest.mark.parametrize("limit", [10**6, 0])
def test_clean_documents_stay(frames, limit):
    docs, items, want = frames
    kept = D.drop_contaminated(docs, items, broadcast_words=limit)
    assert kept.columns == docs.columns
    texts, items_ = corpus()
    bad = {(d, t) for d, t in texts if d == 102 or slow_pairs([(d, t)], items_)}
    assert len(bad) > 5
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    clean = [r for r in texts if r not in bad]
    assert sorted(rows, key=str) == sorted(clean, key=str)


def test_empty_tables(spark, frames):
    docs, items, _ = frames
    for limit in (10**6, -1):
        assert D.contaminated_pairs(docs.limit(0), items, broadcast_words=limit).count() == 0
        assert D.contaminated_pairs(docs, items.limit(0), broadcast_words=limit).count() == 0


def test_repetitive_texts_take_bounded_memory():
    import tracemalloc
    item, doc = np.full(200, 7, np.uint64), np.full(60_000, 7, np.uint64)
    tracemalloc.start()
    tiles = D.tile(item, doc)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(n for n, _, _ in tiles) == 200 and peak < 60_000 * 1000


def test_blocks_of_pairs_do_not_change_matches(monkeypatch):
    rnd = np.random.default_rng(2)
    for _ in range(30):
        item, doc = rnd.integers(1, 4, 40).astype(np.uint64), rnd.integers(1, 4, 300).astype(np.uint64)
        args = D.Running(item), D.Running(doc), np.arange(36), np.arange(296), 5
        monkeypatch.setattr(D, "PAIRS", 1 << 18)
        whole = sorted(D._matches(*args))
        monkeypatch.setattr(D, "PAIRS", 7)
        assert sorted(D._matches(*args)) == whole


def test_a_one_word_item_meets_frequent_words_by_join(spark):
    """A word in every document, as an item of its own: one seed of size one a document passes the filter."""
    docs = spark.range(3000).selectExpr("id as doc_id", "concat('the ', repeat('the word ', 30), id) as text")
    items = spark.createDataFrame([(1, "the"), (2, "no such words stand anywhere here"), (3, "word the word the word the word")], "item_id int, text string")
    found = D.contaminated_pairs(docs, items, broadcast_words=0)
    assert sorted(found.groupBy("item_id").count().collect()) == [(1, 3000), (3, 3000)]
    seeds = D._seed_rows(items.selectExpr("item_id as item_key", "text"), "item_key")
    sizes = sorted({r["size"] for r in seeds.collect()})
    assert sizes == [1, 5]
    passed = D._seed_rows(docs.selectExpr("doc_id as row_key", "text"), "row_key", sizes, D._seed_filter(seeds))
    assert passed.where("size = 1").count() == 3000 and passed.where("size = 5").count() <= 3000 * 3
