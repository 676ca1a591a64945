"""Column statistics: exact quantiles that scale, min/max, correlation, OLS,
histograms and box summaries.

Exact quantiles
---------------
Spark's exact ``percentile`` keeps every distinct value of a group in one
buffer, at scale one task with a whole column. Here two scans do, in one lazy
plan without a driver round trip:

1. one aggregate gives each (group, column) its count, minimum, maximum and a
   mergeable quantile sketch whose rank error is proven to be at most
   1 / ``ACCURACY`` of the rows. The values it gives for the wanted shares
   plus and minus three times that error bracket every target rank;
2. one aggregate counts the rows below each bracket (one number a task) and
   the distinct values inside it, exactly; a window over these few walks to the rank.

A bracket holds about 6 / ``ACCURACY`` of its group's rows (all rows of
a group of up to ``SMALL``, for which one rank may be more than the sketch's
error). Rows are always pre-aggregated per task, a group is never gathered,
and a value held by any share of the rows is one counted value. Should a
bracket ever miss its rank the job fails; it never returns another value. Group
keys are compared null-safely, so a NULL group is a group. Values are interpolated between
the order statistics at ``pos = (n-1)·p`` as
``(ceil(pos) - pos)·v1 + (pos - floor(pos))·v2`` (the formula of Spark's ``percentile``).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrarank.session import cut_lineage, keep

ACCURACY = 10_000
SMALL = 2 * ACCURACY
GROUPED_ROWS = 250_000  # rows of a task where groups are dealt out


def _long_form(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str]) -> DataFrame:
    """(group..., _c, _v) with one row per non-null value of each column, columns by number."""
    if len(cols) == 1:
        long = df.select(*group_cols, F.lit(0).alias("_c"), F.col(f"`{cols[0]}`").cast("double").alias("_v"))
    else:
        long = df.select(*group_cols, _stack([(F.lit(i), F.col(f"`{c}`").cast("double")) for i, c in enumerate(cols)], ["_c", "_v"]))
    return long.where(F.col("_v").isNotNull())


def _targets(df: DataFrame, cols: Sequence[str], probs: Sequence[float], group_cols: Sequence[str]) -> DataFrame:
    """(group..., _c, prob, n, low, high, lo, hi): the bracket of each group, column and share; one aggregate over ``df``."""
    slack = 3 / ACCURACY
    edges = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-slack, slack)})
    shares = ", ".join(f"{e!r}D" for e in edges)
    sketches = [F.expr(f"struct({i} AS _c, count(v) AS n, min(v) AS low, max(v) AS high, percentile_approx(v, array({shares}), {ACCURACY}) AS q)"
                       .replace("(v", f"(CAST(`{c}` AS DOUBLE)")).alias(f"_s{i}") for i, c in enumerate(cols)]
    st = (df.groupBy(*group_cols) if group_cols else df).agg(*sketches)
    st = st.select(*group_cols, F.expr(f"inline(array({', '.join(f'_s{i}' for i in range(len(cols)))}))"))

    def bound(p: float, d: float, end: str) -> str:
        at = min(1.0, max(0.0, p + d))
        return end if at in (0.0, 1.0) else f"IF(n <= {SMALL}, {end}, q[{edges.index(at)}])"

    each = ", ".join(f"struct({float(p)!r}D AS prob, {bound(p, -slack, 'low')} AS lo, {bound(p, slack, 'high')} AS hi)" for p in probs)
    return st.select(*group_cols, "_c", "n", "low", "high", F.expr(f"inline(array({each}))"))


def order_statistics(df: DataFrame, cols: Sequence[str], probs: Sequence[float], group_cols: Sequence[str] = (),
                     empty: bool = False) -> DataFrame:
    """(group..., column, prob, n, low, high, value): exact quantiles, with the count, minimum and maximum.

    One row for every group, column and probability with a non-null value; with ``empty`` also for those
    without one, n 0. ``df`` is scanned twice: persist it if it is dear.

    More grouped rows than the session's shuffle partitions take at ``GROUPED_ROWS`` each are dealt out by
    group to as many parts as that asks for; the groups of more rows than a part are few, and stay where they are.
    """
    parts = -(-df.count() // GROUPED_ROWS) if group_cols else 0
    if parts <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return _order_statistics(df, cols, probs, group_cols, empty)
    group = F.struct(*group_cols)  # never NULL, and equal where its fields are, NULLs too
    large = F.broadcast(df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > GROUPED_ROWS).select(group.alias("_l")))
    keyed = df.select(group.alias("_g"), *cols)
    in_large = F.col("_g") == F.col("_l")
    dealt = _order_statistics(keyed.join(large, in_large, "left_anti").repartition(parts, "_g"), cols, probs, ["_g"], empty, parts)
    whole = _order_statistics(keyed.join(large, in_large, "left_semi"), cols, probs, ["_g"], empty, few_groups=True)
    both = dealt.unionByName(whole)
    return both.select(*[F.col("_g").getField(c).alias(c) for c in group_cols], *both.columns[1:])


def _order_statistics(df: DataFrame, cols: Sequence[str], probs: Sequence[float], group_cols: Sequence[str], empty: bool,
                      parts: int = 0, few_groups: bool = False) -> DataFrame:
    keys = [*group_cols, "_c"]
    targets = _targets(df, cols, probs, group_cols)
    carried = ["n", "low", "high"]
    t = targets.select(*[F.col(k).alias(f"_t{k}") for k in keys], "prob", *carried, "lo", "hi")
    long = _long_form(df, cols, group_cols)
    shared = keys
    if parts and len(cols) == 1:  # both sides are dealt out by the group, which is all they share
        shared = group_cols
    elif parts:  # a join takes sides as they are if they are dealt out by all of its keys
        long, t = long.repartition(parts, *keys), t.repartition(parts, *[f"_t{k}" for k in keys])
    on = F.col("_v") <= F.col("hi")
    for k in shared:
        on = on & (F.col(k) == F.col(f"_t{k}") if parts or few_groups else F.col(k).eqNullSafe(F.col(f"_t{k}")))
    near = long.join(F.broadcast(t) if few_groups else t, on).drop(*[f"_t{k}" for k in keys])
    # rows below a bracket are one number, under the value NULL
    values = near.groupBy(*keys, "prob", *carried, F.when(F.col("_v") >= F.col("lo"), F.col("_v")).alias("_x")).agg(
        F.count(F.lit(1)).alias("_cnt"))
    ids = [*keys, "prob", *carried]
    w = Window.partitionBy(*ids).orderBy(F.col("_x").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pos = (F.col("n") - 1) * F.col("prob")
    lower, higher = F.floor(pos), F.ceil(pos)
    inside = F.col("_x").isNotNull()
    found = values.withColumn("_r", F.sum("_cnt").over(w)).groupBy(*ids).agg(
        F.min(F.when(inside & (F.col("_r") > lower), F.col("_x"))).alias("v1"),
        F.min(F.when(inside & (F.col("_r") > higher), F.col("_x"))).alias("v2"),
        F.coalesce(F.max(F.when(~inside, F.col("_r"))), F.lit(0)).alias("below"))
    held = (F.col("below") <= lower) & F.col("v1").isNotNull() & F.col("v2").isNotNull()
    value = F.when((lower == higher) | (F.col("v1") == F.col("v2")), F.col("v1")).otherwise(
        (higher - pos) * F.col("v1") + (pos - lower) * F.col("v2"))
    checked = F.when(held, value).otherwise(F.raise_error(F.lit("a quantile sketch missed its rank")).cast("double"))
    out = found.select(*keys, "prob", *carried, checked.alias("value"))
    if empty:
        out = out.unionByName(targets.where("n = 0").select(*keys, "prob", *carried, F.lit(None).cast("double").alias("value")))
    name = F.element_at(F.array(*map(F.lit, cols)), F.col("_c") + 1)
    return out.select(*group_cols, name.alias("column"), "prob", *carried, "value")


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    group_cols: Sequence[str] = ()) -> DataFrame:
    """Exact linear-interpolated quantiles → (group..., column, n, prob, value).

    NULLs are skipped; an all-NULL column gives a NULL value (global
    statistics), an all-NULL group of a column no row.
    """
    return order_statistics(df, cols, probs, group_cols, empty=not group_cols).select(*group_cols, "column", "n", "prob", "value")


def column_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    """Exact median of each column (midpoint for even counts, NULLs skipped)."""
    rows = exact_quantiles(df, cols, [0.5]).collect()
    return {r["column"]: r["value"] for r in rows}


def _stack(rows: Sequence[Sequence], names: Sequence[str]):
    """``stack`` generator: one output row per tuple of column expressions.

    Spark's ``stack`` compiles to a compact generator; an ``explode`` over a
    literal array of many structs generates code too large to compile and
    runs interpreted (measured 10-20× slower for 105 pairs).
    """
    args = [F.lit(len(rows))] + [e for row in rows for e in row]
    return F.stack(*args).alias(*names)


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlations as (x, y, r); r is NULL where one of the two does not vary.

    A row becomes one vector of its k values (0 where NULL, less the column's
    mean), of k marks (1 where not NULL) and of the values' squares. The Gram matrix of these
    vectors holds every pair's count, sums, sums of squares and sum of
    products over the rows that have both values: one aggregate of (3 k)^2 / 2
    numbers a task, added up as a tree, whatever the rows. The means come from an aggregate before it.
    """
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], "x string, y string, r double")
    k = len(cols)
    values = keep(df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)]))
    means = values.selectExpr(*[f"coalesce(avg(c{i}), 0D) AS m{i}" for i in range(k)]).first()
    shifted = values.selectExpr(*[f"coalesce(c{i} - {float(means[i])!r}D, 0D) AS c{i}" for i in range(k)],
                                *[f"CAST(c{i} IS NOT NULL AS DOUBLE) AS n{i}" for i in range(k)])
    every = shifted.selectExpr("*", *[f"c{i} * c{i} AS q{i}" for i in range(k)])
    vectors = VectorAssembler(inputCols=[f"{p}{i}" for p in "cnq" for i in range(k)], outputCol="v").transform(every).select("v")
    gram = RowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "v")).computeGramianMatrix().toArray()
    c, n, q = (slice(i * k, (i + 1) * k) for i in range(3))
    count, sums, squares = gram[n, n], gram[c, n], gram[q, n]  # [i, j]: of column i where j is there too
    with np.errstate(divide="ignore", invalid="ignore"):
        cov = gram[c, c] - sums * sums.T / count
        var = squares - sums ** 2 / count
        r = cov / np.sqrt(var * var.T)
    flat = (var <= 1e-12 * squares) | (var.T <= 1e-12 * squares.T) | (count < 2)
    rows = [(x, y, 1.0 if i == j else None if flat[i, j] else float(min(1.0, max(-1.0, r[i, j]))))
            for i, x in enumerate(cols) for j, y in enumerate(cols)]
    return spark.createDataFrame(rows, "x string, y string, r double")


def ols_by_group(df: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """Least-squares line of ``y`` on ``x`` per group (slope, intercept, R², n)."""
    pair = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return pair.groupBy(group).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("n"),
    )


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram between the observed min and max.

    The maximum falls in the last bin. Values are counted first (one
    aggregate over the input, ties collapse per task); bounds and bins then
    come from the counted values alone.
    """
    vals = df.select(F.col(col).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    counted = cut_lineage(vals.groupBy("_x").agg(F.count(F.lit(1)).alias("_n")))
    lo, hi = counted.agg(F.min("_x"), F.max("_x")).first()
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin int, bin_start double, bin_end double, count long")
    width = (hi - lo) / bins
    x = F.col("_x")
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)) if width > 0 else F.lit(0)
    out = counted.groupBy(b.cast("int").alias("bin")).agg(F.sum("_n").alias("count"))
    return out.select(
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_start"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_end"),
        "count",
    )


def box_summary(df: DataFrame, group: str, col: str) -> DataFrame:
    """Per-group min, quartiles and max (exact, linear interpolation); NULL groups are left out."""
    src = keep(df.where(F.col(group).isNotNull()).select(group, col))  # read by both scans
    q = order_statistics(src, [col], [0.25, 0.5, 0.75], group_cols=[group], empty=True)  # groups whose values are all NULL stay

    def at(p):
        return F.max(F.when(F.col("prob") == p, F.col("value")))

    return q.groupBy(group).agg(F.max("low").alias("min"), F.max("high").alias("max"), F.max("n").alias("n"),
                                at(0.25).alias("q1"), at(0.5).alias("median"), at(0.75).alias("q3"))
