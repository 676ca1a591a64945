"""Silhouette of labels by plain Euclidean distance, on a bounded sample.

The sample is the rows with the smallest hashes of their key, at most
``SAMPLE_ROWS`` of them: the same rows whatever the partitioning, and few
enough to travel to every task. Each task takes a block of the sample's rows
against all of it: for a row, a is its mean distance to the others of its
label, b the least mean distance to another label, and the value
(b - a) / max(a, b); 0 for a label of one row. With fewer than two labels there is none.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 2000
BLOCK = 250


def hashed_sample(df: DataFrame, key: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows with the smallest MD5 of their key; each task keeps its own smallest, and only those are merged."""
    digest = F.md5(F.col(key).cast("string").cast("binary"))
    return df.withColumn("_h", digest).orderBy("_h", key).limit(rows).drop("_h")


def row_silhouettes(x: np.ndarray, codes: np.ndarray, points: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Silhouettes of the points among the sample (x, codes), which holds them."""
    squares = (points ** 2).sum(axis=1)[:, None] + (x ** 2).sum(axis=1) - 2 * points @ x.T
    distances = np.zeros_like(squares)
    near = squares < 1e-9 * (1 + np.abs(squares).max(initial=0.0))
    distances[~near] = np.sqrt(squares[~near])
    for i, j in zip(*np.nonzero(near)):  # where squares cancel, the difference itself
        distances[i, j] = np.sqrt(((points[i] - x[j]) ** 2).sum())
    n = np.bincount(codes)
    sums = np.stack([distances[:, codes == k].sum(axis=1) for k in range(len(n))], axis=1)
    own = np.arange(len(points)), labels
    with np.errstate(divide="ignore", invalid="ignore"):
        a = sums[own] / (n[labels] - 1)
        means = sums / n
        means[own] = np.inf
        b = means.min(axis=1)
        value = (b - a) / np.maximum(a, b)
    return np.where(n[labels] > 1, np.nan_to_num(value), 0.0)


def silhouettes(df: DataFrame, key: str, features: Sequence[str], label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(key, label, silhouette) of the sampled rows; rows without a label or a feature are left out."""
    spark = df.sparkSession
    whole = df.dropna(subset=[label, *features])
    sample = hashed_sample(whole, key, rows).select(key, label, F.array(*[F.col(f"`{c}`").cast("double") for c in features]).alias("x"))
    found = sample.toArrow()  # at most ``rows`` rows
    names = sorted(set(found.column(label).to_pylist()))
    schema = sample.drop("x").schema.add("silhouette", "double")
    if len(names) < 2:
        return spark.createDataFrame([], schema)
    x = np.array(found.column("x").to_pylist())
    codes = np.array([names.index(v) for v in found.column(label).to_pylist()])
    shared = spark.sparkContext.broadcast((x, codes))
    keys, labels = found.column(key), found.column(label)
    blocks = -(-len(x) // BLOCK)
    parts = spark.range(0, blocks, 1, blocks)  # the numbers of the blocks, one a task
    at_key, at_label = keys.combine_chunks(), labels.combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, all_codes = shared.value
        for batch in batches:
            for n in batch.column(0).to_pylist():
                here = slice(n * BLOCK, (n + 1) * BLOCK)
                values = row_silhouettes(every, all_codes, every[here], all_codes[here])
                yield pa.RecordBatch.from_arrays([at_key.slice(n * BLOCK, BLOCK), at_label.slice(n * BLOCK, BLOCK), pa.array(values)],
                                                 names=[key, label, "silhouette"])

    return parts.mapInArrow(run, schema)


def mean_silhouette(df: DataFrame, key: str, features: Sequence[str], label: str, rows: int = SAMPLE_ROWS) -> float | None:
    return silhouettes(df, key, features, label, rows).agg(F.avg("silhouette")).first()[0]
