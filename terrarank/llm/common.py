"""Small helpers shared by the text operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrarank.session import checkpoint_dir
from terrarank.sources.sinks import remove_dataset

#: Words are runs of anything but ASCII white space (what ``bytes.split`` yields).
WORD_REGEX = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def materialize(df: DataFrame, name: str, result: bool = False) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts the lineage in a form every executor can reread, so a lost executor
    costs a re-read and never a recomputation of what stands above. Within
    ``scratch`` the table goes with the block it was written in, unless it is its ``result``.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    written = _SCRATCH.get()
    if written is not None and not result:
        written.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


@contextmanager
def scratch(spark: SparkSession):
    """Removes, at its end, the tables that operators wrote on their way inside: for callers that have their result written by then."""
    token = _SCRATCH.set([])
    try:
        yield
    finally:
        paths = _SCRATCH.get()
        _SCRATCH.reset(token)
        for path in paths:
            remove_dataset(spark, path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000):
    """Arrow batches of at most ``rows`` rows for what is written inside: texts then take little room in a task."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def byte_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds about ``limit`` bytes in each (one row at least)."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(batch.schema.get_field_index(column))).fill_null(0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // limit
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list:
    return batch.column(batch.schema.get_field_index(column)).to_pylist()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (shift-multiply rounds), vectorised."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_REGEX)), F.lit(0)).cast("long")


def n_tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


HOT_PER_TASK = 4


def join_back(rows: DataFrame, groups: DataFrame, keys: list[str], times: str, n_rows: int, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of their group, whatever share of the rows one group holds.

    ``groups`` has one row a key (the first key column a long), with its number of rows in ``times``. Groups
    that hold at least 1 / (HOT_PER_TASK x tasks of a shuffle) of all ``n_rows``
    rows, so at most HOT_PER_TASK x tasks of them, are broadcast; their rows
    take a key of their own in the shuffle that joins the others, which
    spreads them evenly (should it meet another group, the broadcast one counts).
    """
    spread = HOT_PER_TASK * n_tasks(rows)
    heavy = F.col(times) * spread >= max(n_rows, 1)
    extra = [c for c in groups.columns if c not in keys]
    hot = groups.where(heavy).select(*[F.col(k).alias(f"h_{k}") for k in keys], F.struct(*extra).alias("h_group"))
    met = rows.join(F.broadcast(hot), [F.col(k) == F.col(f"h_{k}") for k in keys], "left").drop(*[f"h_{k}" for k in keys])
    own = F.when(F.col("h_group").isNotNull(), F.xxhash64(F.monotonically_increasing_id())).otherwise(F.col(keys[0]))
    cold = groups.where(~heavy).select(*[F.col(k).alias(f"c_{k}") for k in keys], F.struct(*extra).alias("c_group"))
    on = [F.col("own") == F.col(f"c_{keys[0]}")] + [F.col(k) == F.col(f"c_{k}") for k in keys[1:]]
    found = met.withColumn("own", own).join(cold, on, "left").withColumn("found", F.coalesce("h_group", "c_group"))
    if how == "inner":
        found = found.where(F.col("found").isNotNull())
    return found.select(*rows.columns, *[F.col("found").getField(c).alias(c) for c in extra])
