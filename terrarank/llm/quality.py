"""Quality classifier: Naive Bayes scaled n-gram indicators and a linear hinge-loss model (NB-SVM).

A text is the set of its n-grams, hashed into ``BUCKETS`` indicators: byte
trigrams, and 1- to 3-grams over the shapes of its words (kind of first and
last character, or the sign for a word that repeats the one before). Counts
per class come from a bounded sample of the labelled training rows
(``COUNT_ROWS`` a class, those with the smallest hashes of their id); they
scale each indicator by its log-count ratio. The hinge-loss model is fitted by dual coordinate descent
on a bounded sample (``SAMPLE_ROWS`` rows a class, those with the smallest
hashes of their id, and at most ``SAMPLE_IDS`` indicators), its weights are
interpolated with their mean size, and out-of-fold margins weighted to the
classes' true shares turn margins into probabilities.

Cases: a null or empty text has no n-grams and gets the score of the bias;
rows with a null label or contradicting labels, and null ids, are not learned
from; with only one class labelled every score is that class (0.5 with no
label); ties can't occur in a hash order of distinct ids; repeated rows score
alike; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from terrarank.llm.common import byte_batches, texts_of

BUCKETS = 1 << 17
COUNT_ROWS = 30_000
SAMPLE_ROWS = 4000
SAMPLE_IDS = 20_000_000
SMOOTH = 1.0
MIX = 0.5  # share of the fitted weights; the rest is their mean size
COST = 1.0
REJECT_BELOW = 0.3

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# kind of a byte: 0 lower-case letter or beyond ASCII, 1 upper-case, 2 digit, 3 other
_KIND = np.full(256, 3, np.uint32)
_KIND[range(ord("a"), ord("z") + 1)] = 0
_KIND[range(128, 256)] = 0
_KIND[range(ord("A"), ord("Z") + 1)] = 1
_KIND[range(ord("0"), ord("9") + 1)] = 2
REPEAT = 16  # shape of a word equal to the one before it
_MUL = np.uint32(2654435761)
_SHIFT = np.uint32(32 - BUCKETS.bit_length() + 1)


class Features:
    """Indicator buckets of a text; keeps one scratch array between calls."""

    def __init__(self):
        self.mark = np.zeros(BUCKETS, bool)

    def _add(self, codes: np.ndarray) -> None:
        self.mark[(codes * _MUL) >> _SHIFT] = True

    def __call__(self, text: str | None) -> np.ndarray:
        data = (text or "").encode()
        buf = np.frombuffer(data, np.uint8)
        for at in range(0, max(0, len(buf) - 2), 1 << 20):  # bounded memory for very long texts
            part = buf[at:at + (1 << 20) + 2].astype(np.uint32)
            self._add(part[:-2] << np.uint32(16) | part[1:-1] << np.uint32(8) | part[2:])
        words = data.split()
        if words:
            blank = _SPACE[buf]
            edge = np.flatnonzero(np.diff(blank, prepend=True, append=True))
            shape = _KIND[buf[edge[0::2]]] * 4 + _KIND[buf[edge[1::2] - 1]]
            if len(words) > 1:
                same = np.fromiter(map(operator.eq, words, words[1:]), bool, len(words) - 1)
                shape[1:][same] = REPEAT
            code = np.uint32(1 << 24)  # beyond all byte trigrams
            for n in range(1, 4):
                if len(shape) >= n:
                    gram = code * np.uint32(n)
                    for k in range(n):
                        gram = gram + (shape[k:len(shape) - n + 1 + k] << np.uint32(5 * k))
                    self._add(gram)
        ids = np.flatnonzero(self.mark)
        self.mark[ids] = False
        return ids


def held_out(id_col: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text leaves no remainder by 5."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(False))


def class_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(documents per class, indicator counts per class) over all rows (text, label)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, counts, docs = Features(), np.zeros((2, BUCKETS), np.int64), np.zeros(2, np.int64)
        for batch in byte_batches(batches, "text", 8 << 20):
            for text, label in zip(texts_of(batch), batch.column(1).to_pylist()):
                counts[label][features(text)] += 1
                docs[label] += 1
        seen = np.flatnonzero(counts.any(axis=0))
        cols = [np.append(seen, -1), np.append(counts[0][seen], docs[0]), np.append(counts[1][seen], docs[1])]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["bucket", "zero", "one"])

    sums = (rows.select("text", "label").mapInArrow(count, "bucket long, zero long, one long")
            .groupBy("bucket").agg(F.sum("zero").alias("zero"), F.sum("one").alias("one")).toPandas())
    counts, docs = np.zeros((2, BUCKETS)), np.zeros(2)  # at most BUCKETS + 1 rows came back
    own = sums[sums.bucket >= 0]
    counts[0][own.bucket], counts[1][own.bucket] = own.zero, own.one
    for r in sums[sums.bucket < 0].itertuples():
        docs += [r.zero, r.one]
    return docs, counts


def log_count_ratio(counts: np.ndarray) -> np.ndarray:
    p, q = counts[1] + SMOOTH, counts[0] + SMOOTH
    return np.log((p / p.sum()) / (q / q.sum()))


def dual_coordinate_descent(rows: list[np.ndarray], labels: np.ndarray, scale: np.ndarray, cost: float = COST,
                            epochs: int = 12, seed: int = 3) -> tuple[np.ndarray, float]:
    """Weights and bias of the L2-regularised squared hinge loss over rows of scaled indicators of unit length."""
    rnd = np.random.default_rng(seed)
    values = []
    for ids in rows:
        x = scale[ids]
        size = np.sqrt((x ** 2).sum())
        values.append(x / size if size else x)
    weights, bias, alpha = np.zeros(len(scale)), 0.0, np.zeros(len(rows))
    sign, ridge = np.where(labels > 0, 1.0, -1.0), 0.5 / cost
    for _ in range(epochs):
        most = 0.0
        for i in rnd.permutation(len(rows)):
            ids, x = rows[i], values[i]
            q = x @ x + 1.0 + ridge
            slope = sign[i] * (weights[ids] @ x + bias) - 1.0 + ridge * alpha[i]
            new = max(alpha[i] - slope / q, 0.0)
            step = (new - alpha[i]) * sign[i]
            if step:
                weights[ids] += step * x
                bias += step
                most = max(most, abs(step))
                alpha[i] = new
        if most < 1e-3:
            break
    return weights, bias


def interpolated(weights: np.ndarray) -> np.ndarray:
    used = weights != 0
    mean = np.abs(weights[used]).mean() if used.any() else 0.0
    return (1 - MIX) * mean + MIX * weights


def platt(margins: np.ndarray, labels: np.ndarray, weight: np.ndarray, rounds: int = 60) -> tuple[float, float]:
    """Slope and offset of the weighted logistic fit (Newton steps, lightly regularised)."""
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g = np.array([(weight * (p - labels) * margins).sum() + 0.01 * a, (weight * (p - labels)).sum() + 0.01 * b])
        s = weight * p * (1 - p)
        h = np.array([[(s * margins ** 2).sum() + 0.01, (s * margins).sum()], [(s * margins).sum(), s.sum() + 0.01]])
        step = np.linalg.solve(h, g)
        size = np.abs(step).max()
        a, b = np.array([a, b]) - step * min(1.0, 5.0 / size if size else 1.0)
        if size < 1e-8:
            break
    return float(a), float(b)


class Model:
    """Fitted weights; ``score`` maps indicator buckets to the probability of label 1."""

    def __init__(self, scale: np.ndarray, weights: np.ndarray, bias: float, slope: float, offset: float):
        self.square = (scale ** 2).astype(np.float32)
        self.weight = (scale * weights).astype(np.float32)
        self.bias, self.slope, self.offset = bias, slope, offset

    def margin(self, ids: np.ndarray) -> float:
        size = float(np.sqrt(self.square[ids].sum()))
        return (float(self.weight[ids].sum()) / size if size else 0.0) + self.bias

    def score(self, ids: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(ids) + self.offset, -30, 30))))


class Constant:
    """Where fewer than two classes are labelled."""

    def __init__(self, value: float):
        self.value = value

    def score(self, ids: np.ndarray) -> float:
        return self.value


def fit_rows(rows: list[np.ndarray], labels: np.ndarray, shares: np.ndarray, counts: np.ndarray) -> Model:
    """Fit on sampled rows; ``shares`` are the classes' rows among all labels."""
    scale = log_count_ratio(counts)
    half = np.zeros(len(rows), bool)
    for c in (0, 1):  # every second row of each class
        half[np.flatnonzero(labels == c)[::2]] = True
    margins = np.zeros(len(rows))
    for side in (half, ~half):
        w, b = dual_coordinate_descent([rows[i] for i in np.flatnonzero(side)], labels[side], scale)
        part = Model(scale, interpolated(w), b, 1.0, 0.0)
        for i in np.flatnonzero(~side):
            margins[i] = part.margin(rows[i])
    sampled = np.bincount(labels, minlength=2)
    slope, offset = platt(margins, labels, (shares / np.maximum(sampled, 1))[labels])
    w, b = dual_coordinate_descent(rows, labels, scale)
    return Model(scale, interpolated(w), b, slope, offset)


def _smallest(known: DataFrame, order: Column, rows: int, shares: np.ndarray) -> DataFrame:
    """(id, label): at most ``rows`` labelled ids of each class, those with the smallest hashes."""
    out = None
    for c in (0, 1):
        # few more than wanted pass the threshold, so the sort sees a bounded number of rows too
        threshold = min(int(min(1.0, (1.2 * rows + 100) / shares[c]) * (1 << 64)) - (1 << 63), (1 << 63) - 1)
        part = known.where((F.col("label") == c) & (order <= F.lit(threshold))).orderBy(order, "id").limit(rows)
        out = part if out is None else out.unionByName(part)
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", count_rows: int = COUNT_ROWS, sample_rows: int = SAMPLE_ROWS,
        sample_ids: int = SAMPLE_IDS) -> Model | Constant:
    """Fit from labelled rows outside the held-out fold."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
             .where(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
             .groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("high"))
             .where(F.col("label") == F.col("high")).select("id", "label"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shares = np.zeros(2)
    for r in known.groupBy("label").count().collect():
        shares[r.label] = r["count"]
    if not shares.all():
        return Constant(float(shares[1] / shares.sum()) if shares.any() else 0.5)
    order = F.xxhash64(F.col("id").cast("string"))
    counted = _smallest(known, order, count_rows, shares)
    counts = class_counts(texts.join(F.broadcast(counted), "id"))[1]
    sample = _smallest(known, order, sample_rows, shares)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in byte_batches(batches, "text", 8 << 20):
            found = [features(t).astype(np.int32) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))], names=["h", "label", "ids"])

    # both samples have at most 2 * rows rows (a proven bound); rows in hash order as long as their indicators fit
    picked = (texts.join(F.broadcast(sample), "id").select(order.alias("h"), "label", "text")
              .mapInArrow(extract, "h long, label int, ids array<int>").orderBy("h").limit(4 * sample_rows))
    rows, marks, held = [], [], 0
    for r in picked.toPandas().itertuples():
        held += len(r.ids)
        if held > sample_ids:
            break
        rows.append(np.asarray(r.ids, np.int64))
        marks.append(r.label)
    marks = np.array(marks, np.int64)
    if len(set(marks.tolist())) < 2:
        return Constant(float(shares[1] / shares.sum()))
    return fit_rows(rows, marks, shares, counts)


def score_quality(docs: DataFrame, model: Model | Constant, text_col: str = "text", out: str = "score") -> DataFrame:
    """All columns of ``docs`` and the probability of label 1; every text is read whole."""
    cols = docs.columns
    at = cols.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            scores = [model.score(features(batch.column(at)[i].as_py())) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*cols, out])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(out, DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) for every document."""
    model = fit(docs, labels, id_col, text_col)
    return score_ids(docs, model, id_col, text_col)


def score_ids(docs: DataFrame, model: Model | Constant, id_col: str, text_col: str) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in byte_batches(batches, text_col, 8 << 20):
            scores = [model.score(features(t)) for t in texts_of(batch, text_col)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=[id_col, "score"])

    scored = docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, score double")
    return scored.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score",
                         (F.col("score") >= REJECT_BELOW).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents the classifier doesn't reject, with their own columns."""
    model = fit(docs, labels, id_col, text_col)
    mark = "__quality_score"
    while mark in docs.columns:
        mark += "_"
    return score_quality(docs, model, text_col, mark).where(F.col(mark) >= REJECT_BELOW).drop(mark)
