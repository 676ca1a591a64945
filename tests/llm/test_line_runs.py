"""Line dedup against brute force, its SQL, and the plan: no Python on the main path."""

import random

import pytest

from terrarank.llm import line_runs as R


def slow(rows, n):
    seen, gone = set(), {}
    keys = sorted({(d, t) for d, t in rows if t is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    for d, t in keys:
        lines = t.split("\n")
        gone[d, t] = set()
        for i in range(len(lines) - n + 1):
            run = tuple(lines[i:i + n])
            if run in seen:
                gone[d, t].update(range(i, i + n))
            seen.add(run)
    out = []
    for d, t in rows:
        lines = t.split("\n") if t is not None else []
        cut = gone.get((d, t), set())
        out.append((d, len(lines), len(cut), "\n".join(x for i, x in enumerate(lines) if i not in cut)))
    return sorted(out, key=str)


def corpus(seed, letters):
    rnd = random.Random(seed)
    passage = [f"p{i}" for i in range(25)]
    rows = []
    for i in range(50):
        lines = [rnd.choice(["hot", "", f"l{rnd.randrange(letters)}", f"l{rnd.randrange(letters)}"]) for _ in range(rnd.choice([1, 2, 9, 30]))]
        if i % 2:
            a = rnd.randrange(20)
            lines[len(lines) // 2:len(lines) // 2] = passage[a:a + rnd.randrange(1, 25)]
        rows.append((rnd.randrange(10**6) * 100 + i, "\n".join(lines)))
    rows += [(10**9 + k, rows[3][1]) for k in range(9)]
    return rows + [(-9, None), (-8, ""), (-7, "\n\n\n\n\n\n\n"), (-6, "a\nb\na\nb\na\nb\na"), (5, "x\ny"), (5, "x\ny"),
                   (10**10, "\n".join(["u%d" % i for i in range(3000)] + passage)), (None, "p1\np2\np3")]


@pytest.mark.parametrize("seed, letters, min_run", [(0, 30, 2), (1, 3, 3), (2, 8, 1), (3, 5, 5)])
def test_equals_brute_force(spark, seed, letters, min_run):
    rows = corpus(seed, letters)
    df = spark.createDataFrame([(d, t, 3) for d, t in rows], "doc_id long, text string, pos int").repartition(3)
    got = R.remove_repeated_lines(df, min_run=min_run).collect()
    assert sorted(map(tuple, got), key=str) == slow(rows, min_run)


def test_ranks_keep_the_order_of_a_suffix_array(spark):
    rows = [(i, t) for i, (_, t) in enumerate(corpus(4, 4)[:40])]
    docs = spark.createDataFrame(rows, "id long, text string").selectExpr("id", "1L tie", "text")
    step, size = R._first_step(docs, 1), 1
    import hashlib

    lines = {d: [hashlib.md5(x.encode()).digest() for x in t.split("\n")] for d, t in rows}
    while not step.isEmpty():
        ranked = sorted((r["rank"], lines[r.id][r.pos:r.pos + size]) for r in step.collect())
        assert all(len(x) == size for _, x in ranked)
        for (ra, a), (rb, b) in zip(ranked, ranked[1:]):
            assert (ra == rb) == (a == b) and (a <= b)
        step, size = R._step(step, size, size), 2 * size
    assert size > 4


def test_empty_and_clean(spark):
    df = spark.createDataFrame([(1, "a\nb"), (2, "c")], "doc_id long, text string")
    assert sorted(map(tuple, R.remove_repeated_lines(df).collect())) == [(1, 2, 0, "a\nb"), (2, 1, 0, "c")]
    assert R.remove_repeated_lines(df.limit(0)).count() == 0


def slow_passages(rows, least):
    """Lines of ``least`` words, and lines that are a whole document, that stand at a smaller (id, place) before."""
    places = {}
    for d, t in sorted(rows):
        for i, line in enumerate(t.split("\n")):
            places.setdefault(line, []).append((d, i))
    gone = {}
    for d, t in rows:
        lines = t.split("\n")
        gone[d] = {i for i, x in enumerate(lines) if (d, i) != places[x][0]
                   and (len(x.split()) >= least or len(lines) == 1 and x.split())}
    return gone


def test_a_single_line_that_is_a_passage_or_a_document(spark):
    rnd = random.Random(3)
    passages = [" ".join(f"w{rnd.randrange(99)}" for _ in range(n)) for n in (4, 5, 6, 60)]
    rows = [(1, passages[3]), (2, "a\n" + passages[3] + "\nb"), (3, passages[3]), (4, "c\n" + passages[0] + "\nd"),
            (5, "e\n" + passages[0] + "\nf"), (6, passages[0]), (7, "g"), (8, "g"), (9, ""), (10, ""), (11, "  "), (12, "  "),
            (13, passages[1] + "\nh\n" + passages[1]), (14, "i\n" + passages[2]), (15, passages[2] + "\nj")]
    rows += [(100 + i, "\n".join([f"{i} x", rnd.choice(passages), f"{i} y", rnd.choice(passages)])) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    cut = slow_passages(rows, 5)
    assert cut[3] == {0} and cut[2] == {1} and cut[6] == {0} and cut[8] == {0} and not cut[5] and not cut[10] and not cut[12]
    want = []
    for d, t in rows:
        lines = t.split("\n")
        want.append((d, len(lines), len(cut[d]), "\n".join(x for i, x in enumerate(lines) if i not in cut[d])))
    # with min_run out of reach only passages go; with it the runs go as before, and passages besides
    got = R.remove_repeated_lines(df, min_run=99, passage_words=5).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    runs = {r[0]: r[2] for r in R.remove_repeated_lines(df).collect()}
    both = {r[0]: r[2] for r in R.remove_repeated_lines(df, passage_words=5).collect()}
    assert all(both[d] >= max(runs[d], len(cut[d])) for d, _ in rows)


def test_the_registered_query_removes_passages_of_one_line(spark, tmp_path):
    from terrarank.llm.queries import op1_line_dedup

    passage = " ".join(f"w{i}" for i in range(50))
    rows = [(1, "short\n" + passage), (2, passage + "\nother"), (3, "one line"), (4, "one line"), (5, "x\nshort\ny")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.n_removed for r in op1_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: 0, 2: 1, 3: 0, 4: 1, 5: 0}


def test_plans_hold_no_python(spark):
    df = spark.createDataFrame([(1, "a\nb"), (2, "a\nb")], "doc_id long, text string")
    plan = R.remove_repeated_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
