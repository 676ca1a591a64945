"""Wavelet matrix operations against plain numpy, token shards against the tokenizer itself."""

import random
import uuid
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from terrarank.llm import tokens as T
from terrarank.llm.wavelet import WaveletMatrix
from terrarank.session import checkpoint_dir

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n, top, width", [(0, 1, 4), (1, 9, 4), (512, 16, 4), (5000, 50_000, 16), (1300, 70_000, 17)])
def test_wavelet_matrix(n, top, width):
    rnd = np.random.default_rng(n)
    ids = rnd.integers(0, top, n).astype(np.uint16 if width <= 16 else np.uint32)
    ids[: n // 3] = 1  # a token with a third of all places
    m = WaveletMatrix.from_bytes(WaveletMatrix.build(ids, width).to_bytes())
    assert np.array_equal(m.decode(), ids)
    if n:
        at = rnd.integers(0, n, 50)
        assert np.array_equal(m.access(at), ids[at])
    for token in {1, 2, top - 1, top + 5, 1 << width}:
        places = np.flatnonzero(ids == token)
        assert m.count(token) == len(places)
        assert np.array_equal(m.occurrences(token), places)
        for end in (0, n // 2, n):
            assert m.rank(token, end) == (places < end).sum()


SLOW = Tokenizer.from_file(PATH)
SLOW.encode_special_tokens = True


def slow_ids(text):
    return SLOW.encode(text or "", add_special_tokens=False).ids


TEXTS = ["plain words, and more words", " lead and trail ", "two  spaces", "line\nbreak \n mixed\n\nend\n", "tab\there",
         "it's we'll 's 'll don 't", "1234 56a7 ..., !!! ümlaut ñ 漢字 👩‍👩‍👧", "a<|endoftext|>b", " nbsp em ​",
         "Üben, ñandú. Ébène! a; b: c? d,. e.. ª º µ ß ÿ", "x\nÉa,\nb.", "", None, "x" * 3000, "\x1c\x1d odd", "The\nEnd", "a\r\nb", "<| half", "it\n's ' s"]


def test_word_by_word_equals_whole():
    rnd = random.Random(1)
    e = T.Encoder(PATH)
    texts = TEXTS + ["".join(rnd.choice(["a", "B", "9", " ", "\n", "'", "s", ".", "é", "\t", "ll"]) for _ in range(60))
                     for _ in range(400)]
    ids, lengths = e.encode_batch(pa.array([*texts, "a\0b", "\0", " x\0"]))
    ends = np.cumsum(lengths)
    for text, a, b in zip([*texts, "a\0b", "\0", " x\0"], ends - lengths, ends):
        assert ids[a:b].tolist() == slow_ids(text), repr(text)
    part = pa.array(texts)[5:9]
    assert e.encode_batch(part)[0].tolist() == [x for t in texts[5:9] for x in slow_ids(t)]


def test_memo_is_bounded(monkeypatch):
    monkeypatch.setattr(T, "MEMO", 5)
    e = T.Encoder(PATH)
    text = " ".join(f"w{i}" for i in range(50))
    assert e.encode_batch(pa.array([text]))[0].tolist() == slow_ids(text)
    for k in range(20):
        more = f"w1 w{k} w{k + 1} x{k}"
        assert e.encode_batch(pa.array([more]))[0].tolist() == slow_ids(more)
    assert len(e.words) <= 8


def test_round_trip(spark):
    rows = [(i * 7 % 101, t, "x") for i, t in enumerate(TEXTS * 3)] + [(None, "no id", "x"), (5, "same id", "x"), (5, "same id", "x")]
    path = f"{checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"
    T.write_tokens(spark.createDataFrame(rows, "doc_id long, text string, part string"), path, PATH, 2, shard_tokens=300)
    got = sorted(T.read_token_ids(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id is not None for r in got] == sorted(r.doc_id is not None for r in got)
    ids = [r.doc_id for r in got if r.doc_id is not None]
    assert ids == sorted(ids)
    at = 0
    for r in got:
        assert r.start == at and len(r.ids) == r.n_tokens
        at += r.n_tokens
    want = sorted((d is not None, d or 0, slow_ids(t) + [2]) for d, t, _ in rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.ids) for r in got) == want
    crc = {(r.doc_id, r.start): r.ids_crc32 for r in T.read_token_digests(spark, path).collect()}
    assert crc == {(r.doc_id, r.start): zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got}
    flat = [x for r in got for x in r.ids]
    assert sum(r.n for r in T.count_token(spark, path, 2).collect()) == flat.count(2)


def test_empty_table(spark):
    path = f"{checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"
    T.write_tokens(spark.createDataFrame([], "doc_id long, text string"), path, PATH, 2)
    assert T.read_token_digests(spark, path).count() == 0


def test_the_query_encodes_special_tokens_as_the_plain_call_does(spark, tmp_path):
    from terrarank.llm.queries import op3_token_output

    plain = Tokenizer.from_file(PATH)
    texts = ["a<|endoftext|>b", "<|endoftext|>", "x y <|endoftext|> z\nw", "<| half", "plain words"]
    rows = list(enumerate(texts))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in op3_token_output(spark, str(tmp_path)).collect()}
    start = 0
    for i, text in rows:
        ids = plain.encode(text, add_special_tokens=False).ids
        assert i > 2 or 50256 in ids
        ids = np.array([*ids, 2])
        assert got[i].ids_crc32 in {zlib.crc32(ids.astype(t).tobytes()) for t in ("<u2", "<u4", "<i8")}
        assert got[i].start == start and got[i].n_tokens in (len(ids), len(ids) - 1)
        start += len(ids)
