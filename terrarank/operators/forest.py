"""Random forests for squared error whose small branches are finished from their rows.

Feature values become bins once (``forest_cuts``). Every tree of every model (the folds of a
cross-validation and the fit on all rows) has its own bootstrap: a row's Poisson(1) draw is a hash of
the row's number, the model and the tree, so no draw travels and none depends on tasks. A row's number is its
place among all rows, which are dealt out and sorted by their values.

Tables of at most ``WHOLE_ROWS`` rows are read as they are stored by tasks that grow a few trees of all models each, so no
row is sent. Of larger tables a branch of at most ``BRANCH_ROWS`` rows goes to one task; larger ones are split first,
from histograms of (tree, branch, feature, bin) that each task adds up and Spark sums, one pass a level. What such
tables send is their rows once a tree and model.

A node's best split is the one that lowers the sum of squares most. Equal gains: the lower feature, the lower
cut. A node is a leaf at the greatest depth or if no split gains.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from terrarank.operators.boosting import in_one_task_each, with_bins
from terrarank.session import cut_lineage

COUNTED = 10_000  # values of a feature that are counted one by one
SKETCHED = 1_000  # steps of the sketch of a feature with more
WHOLE_ROWS = 6_000_000  # rows of a table that is not cut into branches: some 80 bytes each in a task
BRANCH_ROWS = 1_000_000  # rows of a branch that one task finishes: some 200 bytes each
LEVEL_ROWS = 50_000  # rows of a branch that is grown level by level; above, node by node
LOT_TREES = 2  # trees that a task grows from the same rows, or more:
LOT_ROWS = 100_000_000  # predictions that all lots together may send
DRAWN = 1 << 18  # rows whose draws are made at a time
LARGE_LOTS = 4  # large branches that a task finishes, one after the other
EQUAL = 1 - 1e-9  # gains this close are equal, whatever order the sums came in
LEAST_GAIN = 1e-16  # of the labels' variance: what is below is rounding


@dataclass(frozen=True)
class Forest:
    trees: int = 100
    max_depth: int = 15
    max_bins: int = 32
    seed: int = 42


# ----------------------------------------------------------------- bins
def stride_cuts(values: Sequence[float], times: Sequence[float], max_bins: int) -> list[float]:
    """Cuts of ascending values: between all of them if they are few, else at about equal steps of their counts.

    A value that takes several steps moves the next cuts up to the values that follow it, so none is lost (as in Spark's trees).
    """
    between = [a + (b - a) / 2 for a, b in zip(values, values[1:])]
    if len(values) <= max_bins:
        return between
    step = sum(times) / max_bins
    cuts, target, seen = [], step, times[0]
    for cut, more in zip(between, times[1:]):
        if abs(seen - target) < abs(seen + more - target):
            cuts.append(cut)
            target += step
        seen += more
    return cuts[:max_bins - 1]


def forest_cuts(df: DataFrame, features: Sequence[str], max_bins: int) -> list[list[float]]:
    """``stride_cuts`` of each feature: of all its values with their counts if it has at most ``COUNTED``, else of a sketch of all rows."""
    if not features:
        raise ValueError("a forest needs features")
    counts = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(f"`{c}`").cast("double").alias("v"))
                                           for i, c in enumerate(features)])).alias("e")).select("e.*").groupBy("f", "v").count()
    few = {r.f for r in counts.groupBy("f").agg(F.count("v").alias("n")).where(F.col("n") <= COUNTED).collect()}
    found: dict[int, dict[float, float]] = {f: {} for f in range(len(features))}
    for r in counts.where(F.col("f").isin(few) & F.col("v").isNotNull()).collect() if few else []:  # COUNTED a feature at most
        found[r.f][r.v] = r["count"]
    many = [f for f in found if f not in few]
    if many:
        shares = [i / SKETCHED for i in range(SKETCHED + 1)]
        row = df.agg(*[F.percentile_approx(F.col(f"`{features[f]}`").cast("double"), shares, 40 * SKETCHED).alias(f"q{f}") for f in many]).first()
        for f in many:
            for v in row[f"q{f}"]:
                found[f][v] = found[f].get(v, 0) + 1
    return [stride_cuts(*zip(*sorted(own.items())), max_bins) if own else [] for own in found.values()]


# ----------------------------------------------------------------- draws
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(18)])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def draws(numbers: np.ndarray, seed: int, model: int, tree: int) -> np.ndarray:
    """How often each row, by its number, is drawn for a tree: Poisson with mean 1."""
    at = np.array([seed], np.int64).astype(np.uint64)
    for part in (model, tree):
        at = _mixed(at * GOLDEN + np.array([part], np.int64).astype(np.uint64))
    u = (_mixed(_mixed(numbers.astype(np.uint64) + GOLDEN) ^ at) >> np.uint64(11)) * 2.0 ** -53
    return np.searchsorted(POISSON, u, side="right")


# ----------------------------------------------------------------- one tree
@dataclass
class Tree:
    """Nodes by number; ``feature`` is -1 in leaves. Bins up to ``cut`` go to ``left``, others to ``left`` + 1."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    rows: np.ndarray  # draws
    gain: np.ndarray

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        """Leaves of rows; ``bins`` has a line a feature."""
        node, here = np.zeros(bins.shape[1], np.int32), np.arange(bins.shape[1])
        while len(here):
            at = node[here]
            feature = self.feature[at]
            inner = feature >= 0
            here, at, feature = here[inner], at[inner], feature[inner]
            node[here] = self.left[at] + (bins[feature, here] > self.cut[at])
        return node

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.leaf_of(bins)]


FIELDS = {"feature": "<i2", "cut": "<i2", "left": "<i4", "value": "<f8", "rows": "<f8", "gain": "<f8"}


def _tree(**parts: list[np.ndarray]) -> Tree:
    return Tree(**{name: np.concatenate(parts[name]).astype(kind) for name, kind in FIELDS.items()})


def grow(bins: np.ndarray, label: np.ndarray, times: np.ndarray, max_depth: int) -> Tree:
    """A tree of rows drawn ``times`` often; ``bins`` has a line a feature. Each level reads every row once a feature."""
    drawn = np.flatnonzero(times)
    bins, w = np.ascontiguousarray(bins[:, drawn]), times[drawn].astype(float)
    mean = float(np.average(label[drawn], weights=w)) if len(drawn) else 0.0
    y = (label[drawn] - mean) * w
    least = LEAST_GAIN * float((y * y / w).sum() / max(w.sum(), 1))
    slot = np.zeros(len(drawn), np.int64)  # the row's node among those of this level
    orders = [np.argsort(b, kind="stable") for b in bins]  # rows by node and bin
    parts: dict[str, list[np.ndarray]] = {name: [] for name in FIELDS}
    known, active = 1, 1
    for depth in range(max_depth + 1):
        n, s = np.bincount(slot[slot >= 0], w[slot >= 0], active), np.bincount(slot[slot >= 0], y[slot >= 0], active)
        gain, feature, cut = np.full(active, least), np.full(active, -1), np.zeros(active, np.int64)
        for f in range(len(bins) if depth < max_depth else 0):
            order = orders[f]
            of = slot[order]
            order, of = order[of >= 0], of[of >= 0]
            by_node = np.argsort(of.astype(np.uint16) if active <= 1 << 16 else of, kind="stable")
            orders[f] = order = order[by_node]
            of, b = of[by_node], bins[f][order]
            ends = np.flatnonzero((of[1:] == of[:-1]) & (b[1:] != b[:-1]))  # last rows left of a cut
            if not len(ends):
                continue
            first = np.searchsorted(of, np.arange(active))
            sums_w, sums_y = np.cumsum(w[order]), np.concatenate([[0.0], np.cumsum(y[order])])
            node = of[ends]
            left_n = sums_w[ends] - np.concatenate([[0.0], sums_w])[first][node]
            left_s = sums_y[ends + 1] - sums_y[first][node]
            own = (left_s - s[node] / n[node] * left_n) ** 2 * (1 / left_n + 1 / (n[node] - left_n))
            starts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            most = np.maximum.reduceat(own, starts)
            hit = np.flatnonzero(own >= EQUAL * np.repeat(most, np.diff(np.append(starts, len(node)))))[::-1]
            at = np.empty(active, np.int64)
            at[node[hit]] = ends[hit]  # the lowest cut is written last
            better = EQUAL * most > gain[node[starts]]
            won = node[starts][better]
            gain[won], feature[won], cut[won] = most[better], f, b[at[won]]
        inner = feature >= 0
        child = np.cumsum(inner) - 1  # the inner nodes' children, by pairs
        for name, own in (("feature", feature), ("cut", cut), ("left", np.where(inner, known + 2 * child, 0)),
                          ("value", mean + np.divide(s, n, out=np.zeros(active), where=n > 0) if len(drawn) else np.zeros(1)), ("rows", n),
                          ("gain", np.where(inner, gain, 0.0))):
            parts[name].append(own)
        if not inner.any():
            break
        here = np.flatnonzero(slot >= 0)
        here, done = here[inner[slot[here]]], here[~inner[slot[here]]]
        at = slot[here]
        slot[done] = -1
        slot[here] = 2 * child[at] + (bins[feature[at], here] > cut[at])
        active = 2 * int(inner.sum())
        known += active
    return _tree(**parts)


def grow_whole(lines: np.ndarray, label: np.ndarray, times: np.ndarray, max_depth: int, level_rows: int | None = None) -> Tree:
    """``grow`` in less memory: branches of more than ``level_rows`` rows are split node by node from histograms, of two children the smaller counted."""
    drawn, level_rows = np.flatnonzero(times), level_rows or LEVEL_ROWS
    if len(drawn) <= level_rows:
        return grow(lines, label, times, max_depth)
    width, k = int(lines.max()) + 1, len(lines)
    mean = float(np.average(label[drawn], weights=times[drawn]))

    def counted(some: np.ndarray) -> np.ndarray:
        w = times[some].astype(float)
        y = (label[some] - mean) * w
        out = np.empty((2, k, width))
        for f in range(k):
            b = lines[f][some].astype(np.intp)
            out[0, f], out[1, f] = np.bincount(b, w, width), np.bincount(b, y, width)
        return out

    y = label[drawn] - mean
    least = LEAST_GAIN * float((y * y * times[drawn]).sum() / times[drawn].sum())
    del y
    parts: dict[str, list[float]] = {name: [] for name in FIELDS}

    def node(value: float, rows: float) -> int:
        for name, own in zip(FIELDS, (-1, 0, 0, value, rows, 0.0)):
            parts[name].append(own)
        return len(parts["feature"]) - 1

    hist = counted(drawn)
    open_, branches = [(node(mean + hist[1, 0].sum() / hist[0, 0].sum(), hist[0, 0].sum()), 0, drawn, hist)], {}
    del drawn, hist
    while open_:
        at, depth, some, (w, s) = open_.pop()
        n, total = w[0].sum(), s[0].sum()
        left_n, left_s = np.cumsum(w, axis=1)[:, :-1], np.cumsum(s, axis=1)[:, :-1]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = (left_s - total / n * left_n) ** 2 * (1 / left_n + 1 / (n - left_n))
        gain = np.where((left_n > 0) & (left_n < n), gain, -np.inf)
        if depth == max_depth or not gain.size or not gain.max() > least:
            continue
        f, c = np.unravel_index((gain >= EQUAL * gain.max()).argmax(), gain.shape)
        goes_left = lines[f][some] <= c
        sides = [some[goes_left], some[~goes_left]]
        parts["feature"][at], parts["cut"][at], parts["left"][at], parts["gain"][at] = int(f), int(c), len(parts["feature"]), float(gain[f, c])
        sums = [(left_n[f, c], left_s[f, c]), (n - left_n[f, c], total - left_s[f, c])]
        children = [node(mean + own_s / own_n, own_n) for own_n, own_s in sums]
        fewer = int(len(sides[1]) < len(sides[0]))
        hists: list = [None, None]
        if max(map(len, sides)) > level_rows and depth + 1 < max_depth:
            hists[fewer] = counted(sides[fewer])
            hists[1 - fewer] = np.stack([w, s]) - hists[fewer]
        del some, goes_left
        for child, side, own in zip(children, sides, hists):
            if len(side) > level_rows and depth + 1 < max_depth:
                open_.append((child, depth + 1, side, own))
            elif depth + 1 < max_depth:
                branches[child] = grow(lines[:, side], label[side], times[side], max_depth - depth - 1)
        del sides
    return _grafted(_tree(**{name: [np.array(own)] for name, own in parts.items()}), branches)


# ----------------------------------------------------------------- rows
BLOCKS = "first long, bins binary, label binary, fold binary"


def blocks_of(design: DataFrame, features: Sequence[str], cuts: list[list[float]], rows_per_task: int) -> DataFrame:
    """Numbered rows in blocks, each with the number of its first row: rows are dealt out by a hash of their values and sorted."""
    rows = design.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(features)],
                         F.when(F.col("label").isNull() | F.isnan(F.col("label").cast("double")), F.raise_error(F.lit("Labels MUST NOT be Null or NaN")))
                         .otherwise(F.col("label").cast("double")).alias("label"),
                         (F.col("fold") if "fold" in design.columns else F.lit(0)).cast("int").alias("fold"))
    names, tasks = [f"x{i}" for i in range(len(features))], max(1, -(-design.count() // rows_per_task))
    dealt = rows.withColumn("_h", F.xxhash64(*names, "label")).repartition(tasks, "_h").sortWithinPartitions("_h", *names, "label", "fold")
    binned = with_bins(dealt.withColumn("row", F.monotonically_increasing_id()), names, cuts).select("row", "bins", "label", "fold")
    k = len(features)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            row, bins, label, fold = (np.concatenate(part) for part in zip(*held))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([row[0]], pa.int64()), *[pa.array([x.tobytes()], pa.binary()) for x in (
                np.maximum(bins, 0).astype("<i2"), label.astype("<f8"), fold.astype("<i2"))]], names=["first", "bins", "label", "fold"])

        for batch in batches:
            fold = batch.column(3).fill_null(-1).to_numpy(zero_copy_only=False)
            held.append((batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, k),
                         batch.column(2).to_numpy(zero_copy_only=False), fold))
            if sum(len(x[0]) for x in held) >= rows_per_task:
                yield block()
        if held:
            yield block()

    return binned.mapInArrow(pack, BLOCKS)


def _unpacked(first: int, bins: bytes, label: bytes, fold: bytes, k: int) -> tuple[np.ndarray, ...]:
    label = np.frombuffer(label, "<f8")
    return first + np.arange(len(label)), np.frombuffer(bins, "<i2").reshape(len(label), k), label, np.frombuffer(fold, "<i2")


def _learns(fold: np.ndarray, model: int, n_folds: int) -> np.ndarray:
    """The rows that a model is fitted on: all but its fold; rows without a fold only serve the model of all rows."""
    return (fold >= 0) & (fold != model) if model < n_folds else np.ones(len(fold), bool)


def _times(numbers: np.ndarray, fold: np.ndarray, seed: int, model: int, tree: int, n_folds: int) -> np.ndarray:
    """The draws of the rows that a model is fitted on, 0 for others; the model of all rows draws the same whatever the folds."""
    times = np.zeros(len(fold), np.uint8)
    for at in range(0, len(fold), DRAWN):
        part = slice(at, at + DRAWN)
        times[part] = np.where(_learns(fold[part], model, n_folds), draws(numbers[part], seed, model if model < n_folds else -1, tree), 0)
    return times


def _asks(fold: np.ndarray, model: int, n_folds: int) -> np.ndarray:
    """The rows that a model predicts: its fold, or all."""
    return fold == model if model < n_folds else np.ones(len(fold), bool)


# ----------------------------------------------------------------- large branches
def _split_large(blocks: DataFrame, n: int, k: int, models: Sequence[int], n_folds: int, p: Forest, branch_rows: int) -> dict[tuple[int, int], Tree]:
    """The upper part of each tree: branches above ``branch_rows`` rows are split by histograms, one pass a level."""
    stump = Tree(*[np.array([v], kind) for v, kind in zip((-1, 0, 0, 0.0, 0.0, 0.0), FIELDS.values())])
    tops = {(m, t): stump for m in models for t in range(p.trees)}
    large = {(m, t): [0] for m, t in tops} if n > branch_rows else {}
    width, seed = p.max_bins, p.seed
    for _ in range(p.max_depth):
        if not large:
            break
        sketches = {key: (tops[key], np.array(nodes)) for key, nodes in large.items()}

        def count(batches, sketches=sketches):
            hists: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                for block in zip(*(c.to_pylist() for c in batch.columns)):
                    numbers, bins, label, fold = _unpacked(*block, k)
                    lines = np.ascontiguousarray(bins.T)
                    for (m, t), (top, nodes) in sketches.items():
                        times = _times(numbers, fold, seed, m, t, n_folds)
                        place = np.full(len(top.feature), -1)
                        place[nodes] = np.arange(len(nodes))
                        slot = place[top.leaf_of(lines)]
                        here = np.flatnonzero((slot >= 0) & (times > 0))
                        # rows, draws, and the labels' sums and squares of each (node, feature, bin)
                        own = hists.setdefault((m, t), np.zeros((4, len(nodes) * k * width)))
                        w, y = times[here].astype(float), label[here]
                        for f in range(k):
                            cells = (slot[here] * k + f) * width + lines[f, here]
                            for i, what in enumerate((None, w, w * y, w * y * y)):
                                own[i] += np.bincount(cells, what, own.shape[1])
            for (m, t), own in hists.items():
                own = own.reshape(4, -1, k * width)
                for j, node in enumerate(sketches[m, t][1].tolist()):
                    yield pa.RecordBatch.from_arrays([*[pa.array([x], pa.int32()) for x in (m, t, node)], pa.array([own[:, j].tobytes()], pa.binary())],
                                                     names=["model", "tree", "node", "sums"])

        def best(key, parts):
            rows, w, s, ss = sum(np.frombuffer(x) for x in parts["sums"]).reshape(4, k, width)
            n, total, squares = w[0].sum(), s[0].sum(), ss[0].sum()
            left_n, left_s = np.cumsum(w, axis=1)[:, :-1], np.cumsum(s, axis=1)[:, :-1]
            fits = (left_n > 0) & (left_n < n)
            with np.errstate(divide="ignore", invalid="ignore"):
                mean = total / n
                gain = (left_s - mean * left_n) ** 2 * (1 / left_n + 1 / (n - left_n))
            gain = np.where(fits, gain, -np.inf)
            f, c = np.unravel_index((gain >= EQUAL * gain.max()).argmax(), gain.shape)
            gains = gain[f, c] > LEAST_GAIN * max(squares / n - mean ** 2, 0.0)
            return pd.DataFrame([(*key, int(f) if gains else -1, int(c), float(gain[f, c]) if gains else 0.0, float(n), float(mean),
                                  int(rows[f, :c + 1].sum()), int(rows[f, c + 1:].sum()), float(left_n[f, c]), float(left_s[f, c]),
                                  float(total))])

        schema = ("model int, tree int, node int, feature int, cut int, gain double, n double, mean double, left_rows long, right_rows long, "
                  "left_n double, left_s double, total double")
        found = blocks.mapInArrow(count, "model int, tree int, node int, sums binary").groupBy("model", "tree", "node").applyInPandas(best, schema).collect()
        large = {}
        for r in sorted(found, key=lambda r: (r.model, r.tree, r.node)):
            top = tops[r.model, r.tree]
            parts = {name: getattr(top, name).copy() for name in FIELDS}
            parts["value"][r.node], parts["rows"][r.node] = r.mean, r.n
            if r.feature >= 0:
                left = len(top.feature)
                parts["feature"][r.node], parts["cut"][r.node], parts["left"][r.node], parts["gain"][r.node] = r.feature, r.cut, left, r.gain
                below = {"feature": (-1, -1), "cut": (0, 0), "left": (0, 0), "gain": (0.0, 0.0), "rows": (r.left_n, r.n - r.left_n),
                         "value": (r.left_s / r.left_n, (r.total - r.left_s) / (r.n - r.left_n))}
                parts = {name: np.append(own, np.array(below[name], own.dtype)) for name, own in parts.items()}
                large.setdefault((r.model, r.tree), []).extend(
                    c for c, rows in ((left, r.left_rows), (left + 1, r.right_rows)) if rows > branch_rows)
            tops[r.model, r.tree] = Tree(**parts)
        large = {key: nodes for key, nodes in large.items() if nodes}
    return tops


def _depths(top: Tree) -> np.ndarray:
    depth = np.zeros(len(top.feature), np.int64)
    for node in np.flatnonzero(top.feature >= 0):  # children come after their parents
        depth[top.left[node]] = depth[top.left[node] + 1] = depth[node] + 1
    return depth


# ----------------------------------------------------------------- forests
SENT = "lot int, first long, numbers binary, bins binary, label binary, fold binary"


def _finished(blocks: DataFrame, n: int, k: int, models: Sequence[int], n_folds: int, p: Forest, bounds: tuple[int, int], what: str):
    """(all branches grown, upper parts): "predictions" (row, fold, label, held, seen), the "trees" (model, tree, node, fields)
    or the "gains" of their features (model, tree, gains). ``bounds``: rows of a table that is not cut, rows of a branch."""
    whole, branch_rows = n <= bounds[0], bounds[1]
    tops = _split_large(blocks, n, k, models, n_folds, p, n if whole else branch_rows)
    if not whole:  # a lot: one branch of one tree
        lots = [[(m, t, int(node))] for (m, t), top in tops.items() for node in np.flatnonzero(top.feature < 0)]
    else:  # a lot: a few trees of all models, from the same rows
        each = max(LOT_TREES, -(-p.trees * n // LOT_ROWS))
        lots = [[(m, t, 0) for t in range(at, min(at + each, p.trees)) for m in models] for at in range(0, p.trees, each)]
    places: dict[tuple[int, int], np.ndarray] = {}  # the lot of each leaf of an upper part
    for lot, branches in enumerate(lots):
        for m, t, node in branches:
            places.setdefault((m, t), np.full(len(tops[m, t].feature), -1))[node] = lot
    depths = [[int(_depths(tops[m, t])[node]) for m, t, node in branches] for branches in lots] if not whole else None
    seed, max_depth, uppers = p.seed, p.max_depth, None if whole else tops
    n_lots = len(lots)
    schema = {"trees": "model int, tree int, node int, " + ", ".join(f"`{c}` binary" for c in FIELDS), "gains": "model int, tree int, gains binary",
              "predictions": "row long, fold int, label double, held double, seen double"}[what]
    names = [c.split()[0].strip("`") for c in schema.split(", ")]

    def grown(lot: int, numbers: np.ndarray, lines: np.ndarray, label: np.ndarray, fold: np.ndarray) -> Iterator[pa.RecordBatch]:
        held, seen = (np.zeros(len(label)) for _ in range(2)) if what == "predictions" else (None, None)
        asked = np.zeros(len(label), bool)
        for i, (m, t, node) in enumerate(lots[lot]):
            tree = grow_whole(lines, label, _times(numbers, fold, seed, m, t, n_folds), max_depth - (depths[lot][i] if depths else 0))
            if what == "trees":
                yield pa.RecordBatch.from_arrays([*[pa.array([x], pa.int32()) for x in (m, t, node)],
                                                  *[pa.array([getattr(tree, name).tobytes()], pa.binary()) for name in FIELDS]], names=names)
            elif what == "gains":
                inner = tree.feature >= 0
                yield pa.RecordBatch.from_arrays([*[pa.array([x], pa.int32()) for x in (m, t)], pa.array(
                    [np.bincount(tree.feature[inner], tree.gain[inner], k).tobytes()], pa.binary())], names=names)
            else:
                for at in range(0, len(label), DRAWN):
                    asks = at + np.flatnonzero(_asks(fold[at:at + DRAWN], m, n_folds))
                    asked[asks] = True
                    (held if m < n_folds else seen)[asks] += tree.predict(lines[:, asks])
        for at in range(0, len(label) if what == "predictions" else 0, DRAWN):
            here = at + np.flatnonzero(asked[at:at + DRAWN])
            yield pa.RecordBatch.from_arrays([pa.array(x[here]) for x in (numbers, fold.astype(np.int32), label, held, seen)], names=names)

    if whole:
        def fit(lot: int, own: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
            parts = []
            for numbers, bins, label, fold in (_unpacked(*block, k) for block in own):
                parts.append((numbers, np.ascontiguousarray(bins.T, np.uint8 if bins.max(initial=0) < 256 else np.int16), label, fold))
            parts.sort(key=lambda part: part[0][0])
            if parts:
                arrays = [np.concatenate([part[i] for part in parts], axis=-1) for i in range(4)]
                parts.clear()
                yield from grown(lot, *arrays)

        return in_one_task_each(blocks, range(n_lots), lambda lot: lambda first: True, fit, schema), tops

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def record(lot, first, *parts):
            return pa.RecordBatch.from_arrays([pa.array([lot], pa.int32()), pa.array([first], pa.int64()), *[pa.array([x], pa.binary()) for x in parts]],
                                              names=["lot", "first", "numbers", "bins", "label", "fold"])

        for batch in batches:
            for block in zip(*(c.to_pylist() for c in batch.columns)):
                numbers, bins, label, fold = _unpacked(*block, k)
                lines = np.ascontiguousarray(bins.T)
                for (m, t), top in uppers.items():
                    needed = _asks(fold, m, n_folds) | (_times(numbers, fold, seed, m, t, n_folds) > 0)
                    at = np.where(needed, places[m, t][top.leaf_of(lines)], -1)
                    for lot in np.unique(at[at >= 0]).tolist():
                        own = at == lot
                        yield record(lot, int(numbers[own][0]), *[x[own].tobytes() for x in (numbers, bins, label, fold)])

    def finish(key, sent):
        sent = sent.sort_values("first")
        parts = [_unpacked(*row, k) for row in zip(sent["first"], sent["bins"], sent["label"], sent["fold"])]
        numbers = np.concatenate([np.frombuffer(own, "<i8") for own in sent["numbers"]])
        bins, label, fold = (np.concatenate([part[i] for part in parts]) for i in (1, 2, 3))
        return pa.Table.from_batches(list(grown(key[0], numbers, np.ascontiguousarray(bins.T), label, fold))).to_pandas()

    sent = blocks.mapInArrow(send, SENT)
    return sent.repartition(max(1, n_lots // LARGE_LOTS), "lot").groupBy("lot").applyInPandas(finish, schema), tops


def _grafted(top: Tree, branches: dict[int, Tree]) -> Tree:
    """An upper part with its branches in the place of its leaves."""
    parts, known = {name: [getattr(top, name).copy()] for name in FIELDS}, len(top.feature)
    for node, branch in sorted(branches.items()):
        shift = known - 1  # the branch's node 0 is the leaf itself
        for name in FIELDS:
            own = getattr(branch, name).copy()
            if name == "left":
                own = np.where(branch.feature >= 0, own + shift, 0)
            parts[name][0][node] = own[0]
            parts[name].append(own[1:])
        known += len(branch.feature) - 1
    return _tree(**parts)


class ForestModel:
    """A fitted forest over named features and their cuts; its trees are fetched when they are asked for."""

    def __init__(self, blocks: DataFrame, n: int, features: Sequence[str], cuts: list[list[float]], p: Forest, model: int, bounds: tuple[int, int]):
        self.features, self.cuts, self.params = list(features), cuts, p
        self._fit = blocks, n, model, bounds

    @cached_property
    def trees(self) -> list[Tree]:
        blocks, n, model, bounds = self._fit
        found, tops = _finished(blocks, n, len(self.features), [model], model, self.params, bounds, "trees")
        branches: dict[int, dict[int, Tree]] = {t: {} for t in range(self.params.trees)}
        for r in found.collect():  # 30 bytes a node
            branches[r.tree][r.node] = Tree(**{name: np.frombuffer(r[name], kind) for name, kind in FIELDS.items()})
        return [_grafted(tops[model, t], own) for t, own in branches.items()]

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802 - the name Spark's tree models have
        """Each tree's gains by feature as shares, added up over the trees, as shares; the tasks send the gains, not the trees."""
        whole = np.zeros(len(self.features))
        blocks, n, model, bounds = self._fit
        found, tops = _finished(blocks, n, len(whole), [model], model, self.params, bounds, "gains")
        gains = {t: np.bincount(top.feature[top.feature >= 0], top.gain[top.feature >= 0], len(whole)) for (_, t), top in tops.items()}
        for r in sorted(found.collect(), key=lambda r: (r.tree, r.gains)):
            gains[r.tree] = gains[r.tree] + np.frombuffer(r.gains)
        for own in gains.values():
            whole += own / own.sum() if own.sum() > 0 else 0.0
        return DenseVector((whole / whole.sum() if whole.sum() > 0 else whole).tolist())

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction``, the mean of the trees'."""
        trees, k, kept = self.trees, len(self.features), df.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins = np.ascontiguousarray(batch.column(len(kept)).flatten().to_numpy(zero_copy_only=False).reshape(-1, k).T)
                prediction = sum((t.predict(bins) for t in trees), np.zeros(bins.shape[1])) / len(trees)
                yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], pa.array(prediction)], names=[*kept, "prediction"])

        return with_bins(df, self.features, self.cuts).mapInArrow(run, StructType([*df.schema.fields, StructField("prediction", DoubleType())]))

    def nodes(self, session) -> DataFrame:
        """(treeID, id, prediction, impurityStats, leftChild, rightChild, featureIndex, threshold), a row a node."""
        def column(f):
            return np.concatenate([f(t) for t in self.trees])

        ends = [np.array(c or [0.0]) for c in self.cuts]
        table = pa.table({
            "treeID": pa.array(np.repeat(np.arange(len(self.trees)), [len(t.feature) for t in self.trees]), pa.int32()),
            "id": pa.array(column(lambda t: np.arange(len(t.feature))), pa.int32()), "prediction": column(lambda t: t.value),
            "rows": column(lambda t: t.rows), "leftChild": pa.array(column(lambda t: np.where(t.feature < 0, -1, t.left)), pa.int32()),
            "rightChild": pa.array(column(lambda t: np.where(t.feature < 0, -1, t.left + 1)), pa.int32()),
            "featureIndex": pa.array(column(lambda t: t.feature), pa.int32()),
            "threshold": column(lambda t: np.array([ends[f][c] if f >= 0 else np.nan for f, c in zip(t.feature, t.cut)]))})
        return session.createDataFrame(table).select(
            "treeID", "id", "prediction", F.array("rows").alias("impurityStats"), "leftChild", "rightChild", "featureIndex",
            F.when(F.col("featureIndex") >= 0, F.col("threshold")).alias("threshold"))


def _prepared(design: DataFrame, features: Sequence[str], p: Forest, rows_per_task: int):
    cuts = forest_cuts(design, features, p.max_bins)
    blocks = cut_lineage(blocks_of(design, features, cuts, rows_per_task))
    sizes = blocks.agg(F.sum(F.length("label") / 8).cast("long")).first()[0]
    if not sizes:
        raise ValueError("a forest needs rows to be fitted on")
    return cuts, blocks, sizes


def _bounds(branch_rows: int | None) -> tuple[int, int]:
    return branch_rows or WHOLE_ROWS, branch_rows or BRANCH_ROWS


def fit_forest(design: DataFrame, features: Sequence[str], p: Forest, rows_per_task: int, branch_rows: int | None = None) -> ForestModel:
    cuts, blocks, n = _prepared(design, features, p, rows_per_task)
    return ForestModel(blocks, n, features, cuts, p, 0, _bounds(branch_rows))


def cross_validate_forest(design: DataFrame, features: Sequence[str], p: Forest, n_folds: int, rows_per_task: int,
                          branch_rows: int | None = None) -> tuple[DataFrame, DataFrame, ForestModel]:
    """(fold, label, prediction) of every row by the model that has not seen it; the same of the model of all rows; that model."""
    cuts, blocks, n = _prepared(design, features, p, rows_per_task)
    found, _ = _finished(blocks, n, len(features), range(n_folds + 1), n_folds, p, _bounds(branch_rows), "predictions")
    rows = cut_lineage(found.groupBy("row", "fold", "label").agg((F.sum("held") / p.trees).alias("held"), (F.sum("seen") / p.trees).alias("seen")))
    return (rows.where("fold >= 0").select("fold", "label", F.col("held").alias("prediction")),
            rows.select("fold", "label", F.col("seen").alias("prediction")), ForestModel(blocks, n, features, cuts, p, n_folds, _bounds(branch_rows)))
