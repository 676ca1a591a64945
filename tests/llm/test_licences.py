"""Licence scan against a plain word-by-word search; the expression parser."""

import random
import re

import pytest

from terrarank.llm import licences as L


def slow(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, base = [], set()
    for phrase, label in L.BASE.items():
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        places += at
        if at:
            base.add(label)
    extra = {label for phrase, label in L.NOTICES.items()
             if any(words[i:i + len(phrase.split())] == phrase.split() for i in range(len(words)))}
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            base | extra)


def corpus():
    rnd = random.Random(3)
    pool = ["CC", "BY", "by-NC", "General", "Public", "License,", "all", "rights", "reserved.", "x", "é9", "cc", "MIT", "\n"]
    texts = ["".join(rnd.choice(pool) + rnd.choice([" ", "-", "\n", "--"]) for _ in range(rnd.choice([3, 30, 200])))
             for _ in range(120)]
    return texts + [None, "", "ccby", "cc by", "CC BY cc by", "occ by", "cc byé", "ALL RIGHTS reserved all rights Reserved",
                    "all rights reserved " * 30_000, "general public license version 3", "\x00cc\x00by\x7f"]


def test_scan_equals_plain_search(spark):
    rows = [(i, t, "x") for i, t in enumerate(corpus())] + [(0, "cc by", "x"), (None, "cc by", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, labels string")
    got = L.scan_licences(df).collect()
    want = sorted(
        ((d, *slow(t)[:5]) for d, t, _ in rows), key=str)
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=str) == want
    texts = {d: t for d, t, _ in rows[:len(corpus())]}
    for r in got:
        if r.doc_id in texts and r.doc_id:
            assert r.labels == ",".join(sorted(slow(texts[r.doc_id])[5]))
        assert 0 <= r.score <= 1


def test_empty_table(spark):
    assert L.scan_licences(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("expression, score, named", [
    ("MIT", 0.95, {"mit"}),
    ("MIT OR GPL-3.0", 0.95, {"mit", "gpl-3.0"}),
    ("MIT and GPL-3.0", 0.4, {"mit", "gpl-3.0"}),
    ("GPL-2.0 WITH Classpath-exception-2.0", 0.4 + 0.2 * 0.6, {"gpl-2.0"}),
    ("Apache-2.0 OR MIT AND GPL-3.0", 0.9, {"apache-2.0", "mit", "gpl-3.0"}),
    ("(Apache-2.0 OR MIT) AND GPL-3.0", 0.4, {"apache-2.0", "mit", "gpl-3.0"}),
    ("((Foo-1.0))", 0.5, {"foo-1.0"}),
])
def test_expressions(expression, score, named):
    got = L.evaluate(expression)
    assert got[0] == pytest.approx(score) and got[1] == named


@pytest.mark.parametrize("bad", ["", "MIT OR", "AND MIT", "(MIT", "MIT)", "MIT GPL", "()", "MIT (GPL)"])
def test_malformed(bad):
    with pytest.raises(ValueError):
        L.parse(bad)


def test_tags():
    m = L._automaton()
    r = L.scan("x\n// SPDX-License-Identifier: MIT OR GPL-3.0\nall rights reserved", m)
    assert r["labels"] == "gpl-3.0,mit,reserved" and r["score"] == 0.0 and r["base_labels"] == "reserved"
    assert L.scan("SPDX-License-Identifier: (MIT", m)["labels"] == "unparsed"
    assert L.scan("nothing here", m)["score"] == 0.5
    assert L.scan("under CC BY-NC 4.0.", m)["score"] == 0.25


@pytest.mark.parametrize("text, labels, score", [
    ("<!-- SPDX-License-Identifier: MIT -->", "mit", 0.95),
    ("<!-- SPDX-License-Identifier: MIT-->", "mit", 0.95),
    ("SPDX-License-Identifier: MIT Copyright 2020 Foo", "copyright,mit", 0.3),
    ("SPDX-License-Identifier: (Apache-2.0 OR MIT) AND GPL-3.0. All of it", "apache-2.0,gpl-3.0,mit", 0.4),
    ("SPDX-License-Identifier: GPL-2.0+ WITH Foo-exception --", "gpl-2.0+", 0.4 + 0.2 * 0.6),
    ("SPDX-License-Identifier: MIT. And so on", "mit", 0.95),
    ("SPDX-License-Identifier: MIT) x", "mit", 0.95),
    ("SPDX-License-Identifier: -->", "unparsed", 0.5),
])
def test_an_expression_ends_before_what_cannot_follow(text, labels, score):
    r = L.scan(text, L._automaton())
    assert r["labels"] == labels and r["score"] == pytest.approx(score)


def test_many_matches_take_linear_time():
    import time
    machine = L._automaton()
    start = time.perf_counter()
    got = L.scan("cc by all rights reserved " * 60_000, machine)
    assert time.perf_counter() - start < 3
    assert (got["n_base"], got["first_word"], got["last_word"]) == (120_000, 0, 5 * 59_999 + 2)
    # a match may begin before the one found last
    mixed = L.scan("x cc by general public license cc by", machine)
    assert (mixed["first_word"], mixed["last_word"], mixed["n_base"]) == (1, 6, 3)
