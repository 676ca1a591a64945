"""Embedding whitening: principal components of unit variance, fitted on weighted distinct vectors.

Entries become integers, floor(scale * entry), so that equal vectors are equal
to the bit. Identical vectors are grouped first (partial sums in each task, so
a vector in a third of all rows is one row there); a distinct vector counts
once, or as often as it occurs (``weights="count"``), in everything that is
fitted. Sums are exact integers. The covariance is the weighted product of
the centred vectors (X - mean)' W (X - mean), block by block: a task adds up
its blocks' d x d products and gives d (d + 1) / 2 numbers. Its eigenvectors
are found on the driver. Every distinct vector is whitened once, and the
result is joined back to the rows by a 128-bit hash of the vector; vectors of
very many rows (at most a few for each task of a shuffle, whatever the data)
are broadcast, the others are shuffled.

Cases: rows whose vector is null or holds a null or a number that is not
finite are left out, and so are vectors without entries or with another number
of entries than most rows have (of equally frequent ones the smaller number);
repeated rows each have their result, null ids are kept; entries beyond a
long's range become the nearest long; a deviation that no long holds is null; a
component without variance has no whitened value (null) and is left out of
the identity error; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string
from pyspark.sql.pandas.types import to_arrow_schema

from terrarank.llm.common import join_back, materialize

SCALE = 256
COMPONENTS = 4
KEY = ["key1", "key2"]
SAFE = 2.0 ** 62  # integers below are exact in 64 bits, sums of two included


def usable(vector: Column) -> Column:
    """Whether a vector has entries and all of them are finite numbers."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return F.coalesce(finite & (F.size(vector) > 0), F.lit(False))


def whole_numbers(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))


def _keys(x: Column) -> list[Column]:
    return [F.xxhash64(x).alias(KEY[0]), F.xxhash64(F.lit(1), x).alias(KEY[1])]


def distinct_vectors(rows: DataFrame) -> tuple[DataFrame, int]:
    """The written table (x, times, key1, key2) of the distinct vectors of the usual length, and that length."""
    every = materialize(rows.groupBy("x").agg(F.count(F.lit(1)).alias("times")).select("x", "times", *_keys(F.col("x"))), "vectors")
    length = F.size("x")
    usual = (every.groupBy(length.alias("length")).agg(F.sum("times").alias("rows"))
             .orderBy(F.col("rows").desc(), "length").limit(1).collect())
    dim = usual[0].length if usual else 0
    return every.where(length == dim), dim


def _matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _weights(batch: pa.RecordBatch, weights: str) -> np.ndarray:
    times = batch.column(1).to_numpy(zero_copy_only=False)
    return times if weights == "count" else np.ones_like(times)


class Centre:
    """Exact sums of the fit list, and vectors minus their mean."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.whole = [s // n for s in sums]
        self.part = np.array([(s - w * n) / n for s, w in zip(sums, self.whole)])
        self.large = max(map(abs, self.whole), default=0) >= SAFE

    def centred(self, x: np.ndarray) -> np.ndarray:
        if self.large or len(x) and np.abs(x.astype(np.float64)).max() >= SAFE:
            return x.astype(np.float64) - np.array([s / self.n for s in self.sums])
        return (x - np.array(self.whole, np.int64)).astype(np.float64) - self.part

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums over the entries of (n x - S)^2; None beyond a long."""
        if not len(x):
            return []
        reach = self.n * np.abs(x.astype(np.float64)).max() + max(abs(s) for s in self.sums)
        if reach < 2.0 ** 31 and reach * reach * x.shape[1] < SAFE:
            d = self.n * x - np.array(self.sums, np.int64)
            return (d * d).sum(axis=1).tolist()
        exact = (sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist())
        return [e if e < 1 << 63 else None for e in exact]


def fit_centre(vectors: DataFrame, dim: int, weights: str) -> Centre:
    """Count and sums of the fit list; each task adds up its own and gives one row a dimension."""
    schema = _parse_datatype_string("i int, total decimal(38,0)")

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [0] * (dim + 1)  # the last one counts
        for batch in batches:
            if not batch.num_rows:
                continue
            x, w = _matrix(batch, dim), _weights(batch, weights)
            n = int(w.sum())
            if np.abs(x.astype(np.float64)).max() * n < SAFE:
                sums = (x * w[:, None]).sum(axis=0).tolist()
            else:
                sums = [sum(a * b for a, b in zip(column, w.tolist())) for column in x.T.tolist()]
            totals = [a + b for a, b in zip(totals, [*sums, n])]
        yield pa.RecordBatch.from_pylist([{"i": i, "total": Decimal(t)} for i, t in enumerate(totals)], schema=to_arrow_schema(schema))

    found = vectors.select("x", "times").mapInArrow(partial, schema).groupBy("i").agg(F.sum("total").alias("total")).collect()
    totals = {r.i: int(r.total) for r in found}  # a row a dimension
    return Centre(totals.get(dim, 0), [totals.get(i, 0) for i in range(dim)])


def fit_covariance(vectors: DataFrame, centre: Centre, weights: str) -> np.ndarray:
    """Covariance of the fit list, divisor its weight; d (d + 1) / 2 numbers from each task, summed by Spark."""
    dim = len(centre.sums)
    above = np.triu_indices(dim)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            c = centre.centred(_matrix(batch, dim))
            total += (c * _weights(batch, weights)[:, None]).T @ c
        yield pa.RecordBatch.from_arrays([pa.array(above[0], pa.int32()), pa.array(above[1], pa.int32()), pa.array(total[above])],
                                         names=["i", "j", "v"])

    sums = (vectors.select("x", "times").mapInArrow(partial, "i int, j int, v double")
            .groupBy("i", "j").agg(F.sum("v").alias("v")).collect())
    out = np.zeros((dim, dim))
    for r in sums:
        out[r.i, r.j] = out[r.j, r.i] = r.v / centre.n
    return out


class Whitening:
    """Components of a covariance by falling eigenvalue, their largest entry positive."""

    def __init__(self, covariance: np.ndarray, components: int):
        values, vectors = np.linalg.eigh(covariance)
        order = np.argsort(values)[::-1][:components]
        self.values, self.axes = np.maximum(values[order], 0.0), vectors[:, order]
        top = np.abs(self.axes).argmax(axis=0)
        self.axes = self.axes * np.sign(self.axes[top, np.arange(len(order))])
        trace = float(np.trace(covariance))
        self.explained = [float(v) / trace if trace > 0 else None for v in self.values]
        self.live = self.values > len(covariance) * np.finfo(float).eps * max(float(values.max()), 0.0)

    def project(self, centred: np.ndarray) -> np.ndarray:
        """Whitened values; not a number for components without variance."""
        scale = np.where(self.live, np.sqrt(np.where(self.live, self.values, 1.0)), np.nan)
        return centred @ self.axes / scale


def identity_error(whitened: DataFrame, count: int, weights: str) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    w = F.col("times").cast("double") if weights == "count" else F.lit(1.0)
    values = [F.col("whitened")[a] for a in range(count)]
    means = whitened.agg(F.sum(w).alias("n"), *[F.sum(w * v).alias(f"m{a}") for a, v in enumerate(values)]).first()
    off = [v - F.lit(means[f"m{a}"] / means["n"]) if means[f"m{a}"] is not None else v for a, v in enumerate(values)]
    pairs = [(a, b) for a in range(count) for b in range(a, count)]
    sums = whitened.agg(*[F.sum(w * off[a] * off[b]).alias(f"s{a}_{b}") for a, b in pairs]).first()
    errors = [abs(sums[f"s{a}_{b}"] / means["n"] - (a == b)) for a, b in pairs if sums[f"s{a}_{b}"] is not None]
    return max(errors, default=None)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE,
           components: int = COMPONENTS, weights: str = "one") -> DataFrame:
    """Per usable row and component: (id, component, n, deviation, whitened, explained, identity_error)."""
    if weights not in ("one", "count"):
        raise ValueError(weights)
    kind = vectors.schema[id_col].dataType
    rows = vectors.where(usable(F.col(vec_col))).select(F.col(id_col).alias("id"), whole_numbers(F.col(vec_col), scale).alias("x"))
    fit, dim = distinct_vectors(rows.select("x"))
    if not dim:
        empty = StructType().add(id_col, kind).add("component", "integer").add("n", "long").add("deviation", "long")
        return vectors.sparkSession.createDataFrame([], empty.add("whitened", "double").add("explained", "double").add("identity_error", "double"))
    centre = fit_centre(fit, dim, weights)
    model = Whitening(fit_covariance(fit, centre, weights), components)
    schema = _parse_datatype_string("key1 long, key2 long, times long, deviation long, whitened array<double>")

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, dim)
            values = [[None if v != v else v for v in row] for row in model.project(centre.centred(x)).tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(3), batch.column(1), pa.array(centre.deviations(x), pa.int64()),
                                              pa.array(values, pa.list_(pa.float64()))], schema=to_arrow_schema(schema))

    done = materialize(fit.select("x", "times", *KEY).mapInArrow(project, schema), "whitened")
    error = identity_error(done, len(model.values), weights)
    n_rows = done.agg(F.sum("times")).first()[0]
    keyed = rows.where(F.size("x") == dim).select("id", *_keys(F.col("x")))
    both = join_back(keyed, done, KEY, "times", n_rows)
    each = both.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.element_at(F.array(*[F.lit(e).cast("double") for e in model.explained]), F.col("at") + 1)
    return each.select(F.col("id").alias(id_col), (F.col("at") + 1).cast("int").alias("component"), F.lit(centre.n).cast("long").alias("n"),
                       "deviation", "whitened", explained.alias("explained"), F.lit(error).cast("double").alias("identity_error"))
