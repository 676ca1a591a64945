"""Document fingerprints by consistent weighted sampling.

A text is a bag of terms: each word with the one before it, weighted by how
often the pair occurs. For each of ``SAMPLES`` samples every term draws
r, c ~ Gamma(2, 1) and b ~ Uniform(0, 1) that depend on the term and the
sample alone; with t = floor(ln(weight) / r + b) the term with the smallest
ln(c) - r (t - b) - r is kept, together with t. Two texts keep the same
(term, t) with a probability equal to their generalised Jaccard similarity,
the sum of the smaller weights over the sum of the larger. A fingerprint is
the samples' 16-bit codes.

The draws come from a table of ``ROWS`` rows, read from one of ``SAMPLES``
rotations each, both picked by the term's hash.

Cases: a null, empty or blank text has no terms; its fingerprint is all zero
and is like another such one (1), and unlike any other (0). Equal texts have
equal fingerprints. Rows are ordered by id (nulls last), ties by the text's
hash; repeated rows follow one another. A single row follows itself. An empty
table gives no rows; other columns are not read; texts are never cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (BinaryType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)
from pyspark.taskcontext import TaskContext

from terrarank.llm.common import byte_batches, materialize, mix64, texts_of

SAMPLES = 96
ROWS = 1 << 14
CHUNK = 4096  # terms evaluated at once
STEP = np.uint64(0x9E3779B97F4A7C15)


class Sampler:
    """The table of draws; each row is stored twice over, so that a rotation is a contiguous piece."""

    def __init__(self, seed: int = 20, samples: int = SAMPLES):
        rnd = np.random.default_rng(seed)
        self.samples = samples

        def doubled(x):
            return np.concatenate([x, x], axis=1).astype(np.float32)

        r, c = doubled(rnd.gamma(2.0, 1.0, (ROWS, samples))), doubled(np.log(rnd.gamma(2.0, 1.0, (ROWS, samples))))
        b = doubled(rnd.random((ROWS, samples)))
        self.r, self.c, self.b = map(self._rotations, (r, c, b))
        self.once = self._rotations(c + r * b - r)  # ln a for weight 1, where t is 0

    def _rotations(self, x: np.ndarray) -> np.ndarray:
        return np.lib.stride_tricks.as_strided(
            x, (ROWS, self.samples, self.samples), (x.strides[0], x.strides[1], x.strides[1]), writeable=False)

    def fingerprint(self, terms: np.ndarray, weights: np.ndarray) -> bytes:
        """Codes of distinct term hashes with integer weights, little-endian."""
        if not len(terms):
            return bytes(2 * self.samples)
        order = np.argsort(weights, kind="stable")  # the weight-1 terms come first
        terms, weights = terms[order], weights[order]
        single = int(np.searchsorted(weights, 2))
        row, turn = (terms % np.uint64(ROWS)).astype(np.int64), ((terms >> np.uint64(20)) % np.uint64(self.samples)).astype(np.int64)
        best = np.full(self.samples, np.inf, np.float32)
        code = np.zeros(self.samples, np.uint64)
        spans = [(a, min(a + CHUNK, single)) for a in range(0, single, CHUNK)]
        spans += [(a, min(a + CHUNK, len(terms))) for a in range(single, len(terms), CHUNK)]
        at = np.arange(self.samples)
        for lo, hi in spans:
            where = row[lo:hi], turn[lo:hi]
            if hi <= single:
                value, t = self.once[where], None
            else:
                r, b = self.r[where], self.b[where]
                t = np.floor(np.log(weights[lo:hi].astype(np.float32))[:, None] / r + b)
                value = self.c[where] - r * (t - b) - r
            pick = value.argmin(axis=0)
            low = value[pick, at]
            own = terms[lo:hi][pick]
            if t is not None:
                own = own ^ (t[pick, at].astype(np.int64).astype(np.uint64) * STEP)
            better = low < best
            best, code = np.where(better, low, best), np.where(better, own, code)
        return (mix64(code) % np.uint64(65535) + np.uint64(1)).astype("<u2").tobytes()


def terms_of(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the words, each taken with the word before it (none before the first)."""
    words = (text or "").encode().split()
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    before = np.concatenate([np.zeros(1, np.uint64), own[:-1]])
    return np.unique(mix64(own + mix64(before) * STEP), return_counts=True)


def likeness(a: bytes, b: bytes) -> float:
    return float((np.frombuffer(a, "<u2") == np.frombuffer(b, "<u2")).mean())


_SAMPLERS: list[Sampler] = []  # the table, once in each worker process


def fingerprint(text: str | None) -> bytes:
    if not _SAMPLERS:
        _SAMPLERS.append(Sampler())
    return _SAMPLERS[0].fingerprint(*terms_of(text))


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _result(key, text: str, own: bytes, following: str, next_print: bytes) -> dict:
    changed = edited(text, following)
    changed_print = fingerprint(changed)
    return {"id": key, "n_chars": len(text), "edited_sha256": hashlib.sha256(changed.encode()).hexdigest(),
            "fingerprint": own, "edited_fingerprint": changed_print, "near_edited": likeness(own, changed_print),
            "near_next": likeness(own, next_print)}


RESULT = [StructField("n_chars", LongType()), StructField("edited_sha256", StringType()),
          StructField("fingerprint", BinaryType()), StructField("edited_fingerprint", BinaryType()),
          StructField("near_edited", DoubleType()), StructField("near_next", DoubleType())]
# the last row of each task, whose follower is in another one: keys of the task's first and last row
SEAM = [StructField("seam", BooleanType()), StructField("part", IntegerType()), StructField("first_tie", LongType()),
        StructField("last_tie", LongType())]


def _neighbours(ordered: DataFrame, id_field: StructField) -> DataFrame:
    """Results of all rows whose follower is in the same task, and one seam row a task."""
    schema = StructType([StructField("id", id_field.dataType), *RESULT, *SEAM, StructField("first_id", id_field.dataType)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, last = TaskContext.get().partitionId(), None, None
        for batch in byte_batches(batches, "text", 8 << 20):
            rows = []
            for key, tie, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_of(batch)):
                text = text or ""
                own = fingerprint(text)
                if last is None:
                    first = key, tie
                else:
                    rows.append(_result(last[0], last[2], last[3], text, own) | {"seam": False})
                last = key, tie, text, own
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)
        if last is not None:
            seam = {"id": last[0], "seam": True, "part": part, "first_id": first[0], "first_tie": first[1], "last_tie": last[1]}
            yield pa.RecordBatch.from_pylist([seam], schema=arrow)

    return ordered.mapInArrow(run, schema)


def fingerprint_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: fingerprints of its text and of the text edited with the next document's, and their likeness.

    The next document is the one with the next smaller id; the largest follows the smallest.
    """
    spark = docs.sparkSession
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("tie"), F.col(text_col).alias("text"))
    down = [F.col("id").desc_nulls_last(), F.col("tie").desc()]
    found = materialize(
        _neighbours(keyed.repartitionByRange(*down).sortWithinPartitions(*down), docs.schema[id_col]), "fingerprints")
    seams = sorted(found.where("seam").select("part", "id", "last_tie", "first_id", "first_tie").collect(),
                   key=lambda r: r.part)  # one row for each task of the sort
    follows = [(a.part, a.id, a.last_tie, b.first_id, b.first_tie) for a, b in zip(seams, seams[1:] + seams[:1])]
    kind = docs.schema[id_col].dataType.simpleString()
    pairs = spark.createDataFrame(follows, f"part int, id {kind}, tie long, next_id {kind}, next_tie long")
    keys = pairs.select("id", "tie").union(pairs.select("next_id", "next_tie")).distinct()
    here = keyed.alias("k").join(F.broadcast(keys.alias("w")), F.col("k.id").eqNullSafe(F.col("w.id"))
                                 & (F.col("k.tie") == F.col("w.tie"))).select("k.id", "k.tie", "k.text")
    here = materialize(here.distinct(), "fingerprint-seams")
    left = pairs.alias("p").join(here.alias("a"), F.col("p.id").eqNullSafe(F.col("a.id")) & (F.col("p.tie") == F.col("a.tie")))
    both = left.join(here.alias("b"), F.col("p.next_id").eqNullSafe(F.col("b.id")) & (F.col("p.next_tie") == F.col("b.tie"))
                     ).select("p.id", F.col("a.text").alias("text"), F.col("b.text").alias("following"))
    schema = StructType([StructField("id", docs.schema[id_col].dataType), *RESULT])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_result(k, t or "", fingerprint(t), f or "", fingerprint(f))
                    for k, t, f in zip(batch.column(0).to_pylist(), texts_of(batch), texts_of(batch, "following"))]
            yield pa.RecordBatch.from_pylist(rows, schema=to_arrow_schema(schema))

    every = found.where(~F.col("seam")).select(*schema.fieldNames()).unionByName(both.mapInArrow(close, schema))
    return every.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next")
