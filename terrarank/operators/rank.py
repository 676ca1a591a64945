"""Ranking, ordering and top-k.

Global rank
-----------
``rank() OVER (ORDER BY score DESC)`` without a partition moves every row to
one task. ``rank_desc`` gives the same numbers with one distributed plan, whatever
the number of rows:

1. ``groupBy(score).count()`` — ties collapse map-side, so even a value held
   by a third of all rows becomes one row;
2. equal-depth range buckets over the distinct values (bounds from a quantile
   sketch, the only thing that is fetched); a value finds its bucket by binary
   search;
3. per-bucket totals (one row per bucket — a proven size bound) give each
   bucket's offset; a window partitioned by bucket gives the count of larger
   values inside the bucket;
4. rank(value) = offset + larger-in-bucket + 1, joined back on the value
   (a skewed value is split by AQE skew-join handling).

Ties share the minimum rank; NULL scores get a NULL rank. Ranks are 64-bit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrarank.session import keep

def _bucket(v: Column, bounds: Sequence[float], first: int = 0) -> Column:
    """Number of bounds below ``v``: a tree of comparisons, as deep as the logarithm of their count."""
    if not bounds:
        return F.lit(first)
    mid = len(bounds) // 2
    return F.when(v <= F.lit(float(bounds[mid])), _bucket(v, bounds[:mid], first)).otherwise(
        _bucket(v, bounds[mid + 1:], first + mid + 1))


def rank_desc(df: DataFrame, col: str, out: str = "rank", buckets: int | None = None, accuracy: int = 1000) -> DataFrame:
    """Descending rank with ties at the minimum rank (``method='min'``).

    ``buckets`` defaults to the number of shuffle partitions. ``accuracy``: a bucket's depth is off by
    1 / ``accuracy`` of the distinct values at most; the ranks are exact all the same.
    """
    if buckets is None:
        buckets = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    counts = keep(df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_cnt")))
    probs = [i / buckets for i in range(1, buckets)] or [0.5]
    found = counts.agg(F.percentile_approx(F.col(col).cast("double"), probs, max(accuracy, 10 * buckets))).first()[0]
    bounds = sorted(set(found or [])) if buckets > 1 else []
    v = F.col(col)
    placed = counts.withColumn("_b", _bucket(v, bounds))
    totals = placed.groupBy("_b").agg(F.sum("_cnt").alias("_bt"))
    above = Window.orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    offsets = totals.select("_b", F.coalesce(F.sum("_bt").over(above), F.lit(0)).alias("_off"))
    larger = Window.partitionBy("_b").orderBy(v.desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranked = (placed.withColumn("_gt", F.coalesce(F.sum("_cnt").over(larger), F.lit(0)))
              .join(F.broadcast(offsets), on="_b")
              .select(v, (F.col("_off") + F.col("_gt") + 1).alias(out)))
    return df.join(ranked, on=col, how="left").select(*df.columns, out)


def positional_index(df: DataFrame, order_col: str, out: str = "position") -> DataFrame:
    """0-based position by ascending ``order_col`` — for small aggregated frames only."""
    w = Window.orderBy(F.col(order_col).asc(), *[F.col(c) for c in df.columns if c != order_col])
    return df.withColumn(out, (F.row_number().over(w) - 1).cast("int"))


def group_rank(df: DataFrame, value: str, out: str = "rank") -> DataFrame:
    """Rank of aggregated groups (one row per group, few rows) — e.g. "25th of 27"."""
    w = Window.orderBy(F.col(value).desc_nulls_last())
    return df.withColumn(out, F.rank().over(w).cast("long")).withColumn("of", F.count(F.lit(1)).over(Window.partitionBy()))


def top_n(df: DataFrame, col: str, n: int, tie_break: Sequence[str] = (), ascending: bool = False) -> DataFrame:
    """The ``n`` rows with the largest (or smallest) ``col`` → TakeOrderedAndProject.

    Each task keeps its own ``n`` best rows; only those reach the final merge.
    """
    first: Column = F.col(col).asc_nulls_last() if ascending else F.col(col).desc_nulls_last()
    return df.orderBy(first, *[F.col(c).asc() for c in tie_break]).limit(n)


def bottom_n(df: DataFrame, col: str, n: int, tie_break: Sequence[str] = ()) -> DataFrame:
    return top_n(df, col, n, tie_break, ascending=True)


def sort_by_rank(df: DataFrame, rank: str = "rank", tie_break: Sequence[str] = ()) -> DataFrame:
    """Full sort (range-partitioned, distributed) by rank then tie-break columns."""
    return df.orderBy(F.col(rank).asc_nulls_last(), *[F.col(c).asc() for c in tie_break])
