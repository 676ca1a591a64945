"""The pipeline against a plain run of its stages on a small corpus with planted cases."""

import random
import uuid
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from terrarank.llm import decontaminate, mixing, quality, simhash
from terrarank.session import checkpoint_dir


def prose(rnd, n):
    return " ".join("".join(rnd.choice("abcdeilnorst") for _ in range(rnd.randrange(2, 9))) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def folder(spark):
    """A folder with documents, labels and benchmark; and the planted ids."""
    rnd = random.Random(8)
    items = [(i, prose(rnd, 25)) for i in range(6)]
    docs, labels, planted = [], [], {"junk": set(), "copy": set(), "leak": set()}
    for i in range(300):
        text = prose(rnd, rnd.randrange(30, 90))
        kind = rnd.random()
        if kind < 0.2:
            text = " ".join(w.upper() + "!!" for w in text.split())
            planted["junk"].add(i)
        elif kind < 0.26:
            item = items[i % 6][1].split()
            text = " ".join([text, *item[12:], "x", *item[:12], prose(rnd, 20)])
            planted["leak"].add(i)
        docs.append((i, text, "en", f"s{i % 4}", len(text)))
        labels.append((i, int(i not in planted["junk"]), 0))
    clean = [d for d in docs if d[0] not in planted["junk"] | planted["leak"]]
    for k, d in enumerate(clean[:20]):
        docs.append((1000 + k, d[1].replace(" ", "\n") if k % 2 else d[1].upper().lower(), *d[2:]))
        planted["copy"].add(1000 + k)
    docs += [(2000, None, "en", "s0", 0), (2001, "", None, None, None)]
    path = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, rows, schema in (
            ("documents", docs, "doc_id long, text string, lang string, source string, n_chars long"),
            ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return path, docs, planted


def staged(spark, path):
    """Every stage's rows, each fed with the one before."""
    docs, out = spark.read.parquet(f"{path}/documents.parquet"), []
    for _, stage in P.STAGES:
        made = stage(spark, docs, path)
        rows = made.collect()
        out.append(rows)
        docs = spark.createDataFrame(rows, made.schema)
    return out


def test_stages_take_effect(spark, folder):
    path, docs, planted = folder
    assert [n for n, _ in P.STAGES] == ["quality", "near_dedup", "decontaminate", "mix_sources", "tokens"]
    good, single, clean, mixed, ids = staged(spark, path)
    every = {d[0]: d for d in docs}
    for rows in (good, single, clean, mixed):
        assert all(tuple(r) == every[r.doc_id] for r in rows)
    kept = {r.doc_id for r in good}
    assert not kept & planted["junk"]
    assert len(kept & planted["leak"]) == len(planted["leak"])
    assert len(set(every) - kept - planted["junk"]) <= 0.05 * len(every)

    # near copies: brute force over all pairs of what the first stage kept
    prints = {d: simhash.fingerprint(every[d][1]) for d in kept}
    root = {d: d for d in kept}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in kept:
        for b in kept:
            if a < b and bin(prints[a] ^ prints[b]).count("1") <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert sorted(r.doc_id for r in single) == sorted({find(d) for d in kept})
    assert not {r.doc_id for r in single} & planted["copy"]

    bench = decontaminate.Benchmark([tuple(r) for r in spark.read.parquet(f"{path}/benchmark.parquet").collect()])
    bad = {r.doc_id for r in single if any(
        decontaminate.compare(item, bench.word_ids(r.text), 0.8) for item in bench.ids)}
    assert planted["leak"] & {r.doc_id for r in single} <= bad
    assert sorted(r.doc_id for r in clean) == sorted(r.doc_id for r in single if r.doc_id not in bad)

    want = {r.doc_id: r.copies for r in mixing.mixture(spark.createDataFrame(clean, spark.read.parquet(f"{path}/documents.parquet").schema)).collect()}
    assert Counter(r.doc_id for r in mixed) == Counter({d: n for d, n in want.items() if n})

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    at, order = 0, sorted(mixed, key=lambda r: r.doc_id)
    got = sorted(ids, key=lambda r: r.start)
    assert len(got) == len(order)
    for r, d in zip(got, order):
        code = t.encode(d.text or "", add_special_tokens=False).ids + [2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (
            d.doc_id, at, len(code), zlib.crc32(np.array(code, "<u4").tobytes()))
        at += len(code)
    assert sorted(map(tuple, P.run(spark, path).collect())) == sorted(map(tuple, ids))


def test_empty_documents(spark, folder):
    path, _, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for name, stage in P.STAGES:
        made = stage(spark, docs, path)
        assert made.count() == 0
        if name != "tokens":
            assert made.columns == docs.columns
            docs = spark.createDataFrame([], made.schema)


def test_clashing_columns_stay(spark, folder):
    path, _, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").selectExpr(
        "*", "1 as fp", "2 as root", "3 as id", "4 as row", "5 as size", "6 as u", "7 as score", "8 as text_key", "9 as copies")
    cols = docs.columns
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, path)
        assert docs.columns == cols and docs.count() > 50, name
    assert isinstance(quality.REJECT_BELOW, float)
