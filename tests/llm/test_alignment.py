"""Cross-tokenizer alignment against a plain walk over both token lists."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from terrarank.llm import alignment as al

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain_bytes():
    """The libraries' own entries as bytes."""
    import sentencepiece
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}

    def of_a(n):
        return bytes(byte[c] for c in tok.id_to_token(n))

    def of_b(n):
        piece = model.id_to_piece(n)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(n) else piece.replace("▁", " ").encode()

    return tok, model, of_a, of_b


def spans(pieces):
    out, at = [], 0
    for p in pieces:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def slow(rows):
    tok, model, of_a, of_b = plain_bytes()
    links, found = Counter(), []
    for key, text in rows:
        ids_a = tok.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = model.encode(text) if text else []
        whole = (" " + text).encode() if text else b""
        bytes_a, bytes_b = [of_a(n) for n in ids_a], [of_b(n) for n in ids_b]
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            ids_a, ids_b, bytes_a, bytes_b = [], [], [], []
        at_a, at_b = spans(bytes_a), spans(bytes_b)
        own, j = [], 0
        for x, (s, e) in zip(ids_a, at_a):
            while at_b[j][1] <= s:
                j += 1
            k = j
            while k < len(at_b) and at_b[k][0] < e:
                own.append((x, ids_b[k]))
                k += 1
        groups = []
        start = 0
        for end in sorted({e for _, e in at_a} & {e for _, e in at_b}):
            sides = [",".join(str(x) for x, (s, e) in zip(ids, at) if start <= s and e <= end) for ids, at in ((ids_a, at_a), (ids_b, at_b))]
            groups.append("|".join(sides))
            start = end
        links.update(own)
        found.append((key, len(ids_a), len(ids_b), groups, own))
    top = Counter()
    for (_, b), n in links.items():
        top[b] = max(top[b], n)
    return sorted(((key, a, b, len(g), len(own), sum(links[p] == top[p[1]] for p in own), sum(links[p] for p in own), ";".join(g))
                   for key, a, b, g, own in found), key=str)


def corpus():
    rnd = random.Random(3)
    words = ["the", "tokenization", "naïve", "日本語", "x1y2", "hello-world", "🎉🎉", "foo_bar", "\tq", "ab\ncd", "3.14159", "Ünïcode"]
    rows = [(n, " ".join(rnd.choice(words) for _ in range(rnd.choice([1, 3, 40])))) for n in range(40)]
    rows += [(100, None), (101, ""), (102, " "), (103, "  two  spaces  "), (104, "mark ▁ here"), (105, "<|endoftext|> <s> <0x41>"),
             (106, "zero\0byte"), (107, "\n\n\nlines\r\n\n"), (108, "hot " * 3000), (108, "hot " * 3000), (None, "no id"),
             (109, "é" * 7), (110, "a" * 5000), (111, " ".join(rnd.choice(words) for _ in range(4000)))]
    return rows


@pytest.mark.parametrize("piece", [7, 1 << 20])
def test_equals_plain_walk(spark, piece):
    rows = corpus() if piece > 7 else corpus()[:44]
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, block string, n_a int")
    got = al.align(docs, A, B, piece=piece)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == slow(rows)


def test_blocks_and_digest_do_not_change_results(spark, monkeypatch):
    import hashlib

    rows = corpus()[:30]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    whole = al.align(docs, A, B).collect()
    short = {r.doc_id: r.groups for r in al.align(docs.coalesce(1), A, B, digest=True).collect()}
    assert short == {r.doc_id: hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "" for r in whole}


def test_empty_table_gives_no_rows(spark):
    assert al.align(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []


def test_merge_path_splits_anywhere():
    rnd = np.random.default_rng(0)
    for _ in range(50):
        end = int(rnd.integers(1, 60))
        a, b = (np.append(np.flatnonzero(rnd.random(end) < p), end) for p in rnd.random(2))
        a, b = a[a > 0], b[b > 0]
        whole = [np.concatenate(x) for x in zip(*al.merge(a, b, 10**6))]
        union = np.union1d(a, b)
        assert whole[0].tolist() == np.searchsorted(a, union).tolist() and whole[1].tolist() == np.searchsorted(b, union).tolist()
        for piece in (1, 2, 5):
            parts = list(al.merge(a, b, piece))
            assert len(parts) == -(-(len(a) + len(b)) // piece)  # equal work
            for x, y in zip(whole, [np.concatenate(x) for x in zip(*parts)]):
                assert x.tolist() == y.tolist()


def test_word_memo_equals_whole_texts():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=B)
    texts = [t or "" for _, t in corpus()] + [" lead", "trail ", "\nfirst", "a \n b", " x", "x y", "\r x"]
    ids, sizes = al.Pieces(B).encode(pa.array(texts))
    assert np.split(ids, np.cumsum(sizes)[:-1])[0].tolist() == model.encode(texts[0])
    assert [p.tolist() for p in np.split(ids, np.cumsum(sizes)[:-1])] == [model.encode(t) for t in texts]
