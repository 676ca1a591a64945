"""Gradient boosting over histograms, leaf by leaf, for squared error.

Feature values become bins once (equal-depth cuts from one sketch aggregate; a
NULL is a bin of its own that no cut orders). A split needs the sums of the
residuals and the row counts of every (leaf, feature, bin). Each task adds up
dense histograms of its rows and Spark sums the cells; only they reach the
driver: features x bins numbers a leaf, whatever the rows. Of two children the
smaller one is counted and the larger one is its parent less that.

A tree grows best-first: the leaf whose split gains most is split next, up to
``max_leaves``. Which leaves these are is not known ahead, so one pass counts
the children of all candidates that could still be among them, and growth goes
on until it needs children nobody counted. A leaf of at most ``FEW_ROWS`` rows sends
those (their bins and residuals) instead of histograms, and what grows below it
needs no further pass. The tree is exactly the one that counting after every
split would give, in about as many passes as it has levels of larger leaves.

With sums R of residuals and n of rows, a leaf's value is R / (n + l2) and a
split gains R_l^2 / (n_l + l2) + R_r^2 / (n_r + l2) - R^2 / (n + l2). NULLs go to
the side where they gain more (right if none are there). Equal gains: the lower feature, the lower cut,
NULLs right.

Children that no split can follow (at the greatest depth, with too few rows, or
of the last split) are not counted: their sums are known from the split that made them.

A model of at most ``ONE_TASK_ROWS`` rows is grown by one task, all rounds of it, from its rows: short passes cost
mostly their starts. The tasks of several models read the same stored blocks, each one after the other, so no row is
shuffled. What follows is the way of larger models.

Several models (the folds of a cross-validation and the fit on all rows) grow
in step: rows carry their model's number, and one pass serves ``MODELS_IN_STEP`` of them; such groups grow
at the same time, each in its own jobs. The rows are kept in
blocks of up to ``BLOCK_ROWS`` rows of one model, so that a pass hands over a few arrays instead of
rows. The first pass of a round adds the last round's tree to the blocks, which are persisted for the
others; every ``FLUSH`` rounds they are checkpointed.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType
from pyspark.taskcontext import TaskContext

from terrarank.session import cut_lineage

FLUSH = 10
TASK_ROWS = 60_000  # rows of a histogram task, so that small tables take few tasks
MODELS_IN_STEP = 2  # models that share a pass; such groups grow at the same time
ONE_TASK_ROWS = 6_000_000  # rows of a model that one task grows: some 100 bytes each
BLOCK_ROWS = 16_384  # rows of a block, which bounds a task's arrays
FEW_ROWS = 256  # a leaf's rows that are sent as they are: max_leaves times as many at most in one pass
DIGITS = 6  # gains are compared on this many decimals, whatever order the sums came in


@dataclass(frozen=True)
class Boosting:
    rounds: int = 100
    rate: float = 0.1
    max_leaves: int = 31
    max_depth: int = 64
    min_rows: int = 20
    l2: float = 0.0
    max_bins: int = 255
    importance: str = "split"


#: The defaults of the two external methods.
LEAF_WISE = Boosting()
SECOND_ORDER = Boosting(rate=0.3, max_leaves=64, max_depth=6, min_rows=1, l2=1.0, max_bins=256, importance="gain")


# ----------------------------------------------------------------- bins
def bin_cuts(df: DataFrame, features: Sequence[str], max_bins: int) -> list[list[float]]:
    """Ascending cuts of each feature: equal-depth quantiles of its values, from one aggregate."""
    if not features:
        return []
    shares = [i / max_bins for i in range(1, max_bins)]
    found = df.agg(*[F.percentile_approx(F.col(f"`{c}`").cast("double"), shares, 40 * max_bins).alias(f"q{i}")
                     for i, c in enumerate(features)], *[F.max(F.col(f"`{c}`").cast("double")).alias(f"m{i}") for i, c in enumerate(features)]).first()
    # nothing lies above the largest value
    return [sorted({v for v in found[f"q{i}"] or [] if v < found[f"m{i}"]}) for i in range(len(features))]


def bin_of(value: Column, cuts: Sequence[float]) -> Column:
    """How many cuts lie below the value, by binary search; -1 for NULL."""
    if not cuts:
        return F.when(value.isNull(), -1).otherwise(0)
    table, n = F.array(*[F.lit(float(c)) for c in cuts]), len(cuts)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(n.bit_length()))])
    place = F.aggregate(steps, F.lit(0), lambda at, s: F.when(
        F.when(at + s <= n, F.element_at(table, F.least(at + s, F.lit(n))) < value.cast("double")).otherwise(False), at + s).otherwise(at))
    return F.when(value.isNull(), F.lit(-1)).otherwise(place)


def with_bins(df: DataFrame, features: Sequence[str], cuts: Sequence[Sequence[float]]) -> DataFrame:
    return df.withColumn("bins", F.array(*[bin_of(F.col(f"`{c}`"), k).cast("short") for c, k in zip(features, cuts)]))


# ----------------------------------------------------------------- trees
@dataclass
class Split:
    gain: float
    feature: int
    cut: int  # bins up to this one go left
    null_left: bool
    left: tuple[float, int]  # residuals, rows
    right: tuple[float, int]


@dataclass
class Tree:
    """Nodes by number; ``feature`` is -1 in leaves. Split s of a tree makes the nodes 2 s + 1 and 2 s + 2."""

    feature: np.ndarray
    cut: np.ndarray
    null_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    rows: np.ndarray
    gain: np.ndarray

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        node, here = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while len(here):
            at = node[here]
            feature = self.feature[at]
            inner = feature >= 0
            here, at, feature = here[inner], at[inner], feature[inner]
            b = bins[here, feature]
            node[here] = np.where(np.where(b < 0, self.null_left[at], b <= self.cut[at]), self.left[at], self.right[at])
        return node

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.leaf_of(bins)]


def best_split(residuals: np.ndarray, rows: np.ndarray, p: Boosting) -> Split | None:
    """The split of (feature, bin) histograms that gains most; the last bin holds the NULLs."""
    total, n = float(residuals[0].sum()), int(rows[0].sum())
    best = None
    r, m = np.cumsum(residuals[:, :-1], axis=1)[:, :-1], np.cumsum(rows[:, :-1], axis=1)[:, :-1]
    if not r.size:
        return None
    for null_left in (False, True) if rows[:, -1].any() else (False,):  # without NULLs both are the same split
        left_r, left_n = (r + residuals[:, -1:], m + rows[:, -1:]) if null_left else (r, m)
        right_r, right_n = total - left_r, n - left_n
        fits = (left_n >= max(p.min_rows, 1)) & (right_n >= max(p.min_rows, 1))
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left_r ** 2 / (left_n + p.l2) + right_r ** 2 / (right_n + p.l2) - total ** 2 / (n + p.l2)
        gain = np.where(fits, np.round(gain, DIGITS), -np.inf)
        f, c = np.unravel_index(gain.argmax(), gain.shape)  # the first of equals: lower feature, lower cut
        key = (-gain[f, c], int(f), int(c), null_left)
        if gain[f, c] > 0 and (best is None or key < best[0]):
            best = key, Split(float(gain[f, c]), int(f), int(c), null_left, (float(left_r[f, c]), int(left_n[f, c])),
                              (float(right_r[f, c]), int(right_n[f, c])))
    return best[1] if best else None


@dataclass
class Held:
    """Rows of a node that are here: some of ``lines``, which has a line a feature with the NULLs in the last bin."""

    lines: np.ndarray
    residual: np.ndarray
    some: np.ndarray

    def counted(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        every = len(self.some) == len(self.residual)
        own = [line if every else line[self.some] for line in self.lines]
        residual = self.residual if every else self.residual[self.some]
        return (np.stack([np.bincount(b, residual, width) for b in own]), np.stack([np.bincount(b, minlength=width) for b in own]))

    def halves(self, s: Split, width: int) -> tuple[Held, Held]:
        b = self.lines[s.feature][self.some]
        left = (b <= s.cut) | (b == width - 1) if s.null_left else b <= s.cut
        return Held(self.lines, self.residual, self.some[left]), Held(self.lines, self.residual, self.some[~left])


def lines_of(bins: np.ndarray, width: int) -> np.ndarray:
    """Bins of rows as a line a feature, the NULLs in the last bin, in as few bytes as hold them."""
    kind = np.uint8 if bins.max(initial=0) < 256 and (width <= 256 or bins.min(initial=0) >= 0) else np.uint16
    lines = np.empty(bins.shape[::-1], kind)
    for line, b in zip(lines, bins.T):
        line[:] = np.where(b < 0, width - 1, b)
    return lines


class Growing:
    """One tree while it grows: counted nodes, of which the finished tree uses some."""

    def __init__(self, p: Boosting):
        self.p = p
        self.split: list[Split | None] = [None]
        self.depth, self.sums = [0], [(0.0, 0)]
        self.children: list[tuple[int, int] | None] = [None]
        self.hists: list[tuple[np.ndarray, np.ndarray] | None] = [None]
        self.asked: list[tuple[int, int]] = [(0, -1)]  # nodes to count, each with the sibling that is the rest
        self.fetch: list[int] = []  # nodes whose rows are to be sent
        self.rows: list[Held | None] = [None]
        self.final: list[int] = [0]  # the nodes of the finished tree

    def counted(self, hists: dict[int, tuple[np.ndarray, np.ndarray]], sent: dict[int, Held], parents: dict[int, int]) -> None:
        for node, other in self.asked:
            own = hists[node]
            self._set(node, own)
            if other >= 0:
                whole = self.hists[parents[node]]
                self._set(other, (whole[0] - own[0], whole[1] - own[1]))
                self.hists[parents[node]] = None
        for node, rows in sent.items():
            self.rows[node] = rows
        self.asked, self.fetch = [], []

    def held(self, rows: Held, hist: tuple[np.ndarray, np.ndarray]) -> None:
        """All rows are here, and nothing is asked for."""
        self.asked, self.rows[0] = [], rows
        self._set(0, hist)

    def _split_here(self, node: int, last: bool = False) -> None:
        """Children of a node whose rows are here; they are not counted if no split follows them."""
        counts = not last and self._splits_below(node)
        few, more = self._expand(node)
        width = self.hists[node][0].shape[1]
        self.rows[self.children[node][0]], self.rows[self.children[node][1]] = self.rows[node].halves(self.split[node], width)
        if counts:
            whole, own = self.hists[node], self.rows[few].counted(width)
            self._set(few, own)
            self._set(more, (whole[0] - own[0], whole[1] - own[1]))
        self.rows[node] = self.hists[node] = None

    def _set(self, node: int, hist: tuple[np.ndarray, np.ndarray]) -> None:
        self.hists[node] = hist
        if node == 0:
            self.sums[0] = float(hist[0][0].sum()), int(hist[1][0].sum())
        self.split[node] = best_split(*hist, self.p) if self.depth[node] < self.p.max_depth else None

    def grow(self) -> Tree | None:
        """The tree, or None if children must be counted first (then ``asked`` names them)."""
        order, final = [(self._key(0), 0, 0)] if self.split[0] else [], [0]
        inner: dict[int, tuple[int, int]] = {}
        while order and len(inner) + 1 < self.p.max_leaves:
            _, number, node = order[0]
            left = self.p.max_leaves - len(inner) - 1  # splits still to be made
            if self.children[node] is None and self.rows[node] is not None:
                self._split_here(node, left == 1)
            if self.children[node] is None and (left == 1 or not self._splits_below(node)):
                self._expand(node)
            if self.children[node] is None:
                wanted = self._wanted(order, left)
                self.fetch = [n for n in wanted if self.sums[n][1] <= FEW_ROWS and self.rows[n] is None]
                self.asked = [self._expand(n) for n in wanted if self.sums[n][1] > FEW_ROWS]
                return None
            heapq.heappop(order)
            inner[number] = len(final), len(final) + 1
            for child in self.children[node]:
                if self.split[child]:
                    heapq.heappush(order, (self._key(child), len(final), child))
                final.append(child)
        self.final = final
        return self._tree(final, inner)

    def _wanted(self, order: list[tuple[float, int, int]], left: int) -> list[int]:
        """Nodes to be counted below: those among the next splits if what is not known yet gains nothing.

        What is known is followed down, so that a pass counts below every node that can be reached. The last of
        these splits can only come later or not at all, so what is below it is never asked for."""
        ahead, wanted = list(order), []
        while ahead and left > 1:
            _, _, node = heapq.heappop(ahead)
            left -= 1
            if self.children[node] is None and self.rows[node] is not None:
                self._split_here(node)
            if self.children[node] is None:
                wanted += [node] if self._splits_below(node) else []
                continue
            for child in self.children[node]:
                if self.split[child]:
                    heapq.heappush(ahead, (self._key(child), len(self.split) + child, child))
        return wanted

    def _key(self, node: int) -> float:
        return -self.split[node].gain

    def _splits_below(self, node: int) -> bool:
        """Whether a child of this node could be split in turn."""
        s = self.split[node]
        return self.depth[node] + 1 < self.p.max_depth and max(s.left[1], s.right[1]) >= 2 * max(self.p.min_rows, 1)

    def _expand(self, node: int) -> tuple[int, int]:
        s, pair = self.split[node], (len(self.split), len(self.split) + 1)
        self.children[node] = pair
        for sums in (s.left, s.right):
            self.split.append(None)
            self.children.append(None)
            self.hists.append(None)
            self.rows.append(None)
            self.sums.append(sums)
            self.depth.append(self.depth[node] + 1)
        return pair if s.left[1] <= s.right[1] else pair[::-1]

    def _tree(self, nodes: list[int], inner: dict[int, tuple[int, int]]) -> Tree:
        splits = [self.split[n] if i in inner else None for i, n in enumerate(nodes)]
        pairs = [inner.get(i, (0, 0)) for i in range(len(nodes))]
        return Tree(np.array([s.feature if s else -1 for s in splits]), np.array([s.cut if s else 0 for s in splits]),
                    np.array([bool(s and s.null_left) for s in splits]), np.array([a for a, _ in pairs]), np.array([b for _, b in pairs]),
                    np.array([self.sums[n][0] / (self.sums[n][1] + self.p.l2) if self.sums[n][1] else 0.0 for n in nodes]),
                    np.array([self.sums[n][1] for n in nodes]), np.array([s.gain if s else 0.0 for s in splits]))

    def sketch(self) -> tuple[Tree, dict[int, int]]:
        """All counted and asked nodes as a tree to find rows' nodes by, and the parent of each node."""
        inner = {n: pair for n, pair in enumerate(self.children) if pair}
        return self._tree(list(range(len(self.split))), inner), {c: n for n, pair in inner.items() for c in pair}


# ----------------------------------------------------------------- blocks
BLOCKS = "model int, bins binary, label binary, base binary"


def _blocks(rows: DataFrame, k: int, start: dict[int, float]) -> DataFrame:
    """Rows (model, bins, label) as blocks of one model each: arrays of bins, labels and what the model predicts so far."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def block(m: int) -> pa.RecordBatch:
            bins, label = (np.concatenate(parts) for parts in zip(*held.pop(m)))
            parts = bins.astype("<i2"), label, np.full(len(label), start[m])
            return pa.RecordBatch.from_arrays([pa.array([m], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in parts]],
                                              names=["model", "bins", "label", "base"])

        for batch in batches:
            model, label = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 2))
            bins = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            for m in np.unique(model).tolist():
                own = held.setdefault(m, [])
                own.append((bins[model == m], label[model == m]))
                if sum(len(x) for _, x in own) >= BLOCK_ROWS:
                    yield block(m)
        for m in list(held):
            yield block(m)

    return rows.select("model", "bins", "label").mapInArrow(pack, BLOCKS)


def _each_block(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for m, bins, label, base in zip(*(c.to_pylist() for c in batch.columns)):
            yield m, np.frombuffer(bins, "<i2").reshape(-1, k), np.frombuffer(label), np.frombuffer(base)


def _added(state: DataFrame, trees: dict[int, Tree], k: int, rate: float) -> DataFrame:
    """The blocks with a tree of each model added to what it predicts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base = [(own + rate * trees[m].predict(bins)).tobytes() for m, bins, _, own in _each_block([batch], k)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(base, pa.binary())], names=batch.schema.names)

    return state.mapInArrow(run, BLOCKS)


# ----------------------------------------------------------------- histograms
def _histograms(state: DataFrame, k: int, width: int, growing: dict[int, Growing]):
    """({model: {node: (residuals, rows)}} of the nodes to count, the same of the rows to send, parents): one pass."""
    sketches = {m: g.sketch() for m, g in growing.items()}
    slots, where, few = {}, [], []
    for m, g in growing.items():
        own, sent = np.full(len(g.split), -1), np.full(len(g.split), -1)
        first = len(where)
        for n, (node, _) in enumerate(g.asked):
            own[node] = n
            where.append((m, node))
        for node in g.fetch:
            sent[node] = len(few)
            few.append((m, node))
        slots[m] = own, sent, sketches[m][0], first
    words = -(-k // 4)  # the bins of a sent row, four to a number

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(where) * k * width
        sums, rows = np.zeros(size), np.zeros(size, np.int64)
        seen = TaskContext.get().partitionId() << 40
        for m, bins, label, base in _each_block(batches, k):
            if m not in slots:
                continue
            own, sent, tree, first = slots[m]
            residual = label - base
            leaf = tree.leaf_of(bins)
            send = np.flatnonzero(sent[leaf] >= 0)
            if len(send):
                packed = np.zeros((len(send), 4 * words), "<i2")
                packed[:, :k] = bins[send]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(-1 - sent[leaf[send]]), pa.array(seen + 1 + send), pa.array(residual[send]), pa.array(np.ones(len(send), np.int64)),
                     *[pa.array(w) for w in packed.view("<i8").T]], names=names)
            here = np.flatnonzero(own[leaf] >= 0)
            if len(here):
                slot, r, b = own[leaf[here]] * (k * width), residual[here], bins[here]
                at = slice(first * k * width, (first + int(own.max()) + 1) * k * width)
                for f in range(k):
                    cells = slot + (f * width + np.where(b[:, f] < 0, width - 1, b[:, f]))
                    sums[at] += np.bincount(cells, r, at.stop - at.start)
                    rows[at] += np.bincount(cells, minlength=at.stop - at.start)
            seen += len(label)
        used = np.flatnonzero(rows)
        none = pa.array(np.zeros(len(used), np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(used), none, pa.array(sums[used]), pa.array(rows[used]), *[none] * words], names=names)

    packs = [f"b{i}" for i in range(words)]
    names = ["cell", "row", "r", "n", *packs]  # cells below 0 are rows sent as they are, each with a number of its own
    found = state.mapInArrow(count, ", ".join(["cell long", "row long", "r double", "n long", *[f"{w} long" for w in packs]])).groupBy("cell", "row").agg(
        F.sum("r").alias("r"), F.sum("n").alias("n"), *[F.max(w).alias(w) for w in packs]).toArrow()
    sums, rows = np.zeros(len(where) * k * width), np.zeros(len(where) * k * width, np.int64)
    cell, r = found.column("cell").to_numpy(), found.column("r").to_numpy()
    whole = cell >= 0
    sums[cell[whole]], rows[cell[whole]] = r[whole], found.column("n").to_numpy()[whole]
    sums, rows = sums.reshape(-1, k, width), rows.reshape(-1, k, width)
    sent: dict[int, dict] = {m: {} for m in growing}
    if few:
        at = np.flatnonzero(~whole)
        at = at[np.lexsort((found.column("row").to_numpy()[at], -cell[at]))]
        bins = np.ascontiguousarray(np.stack([found.column(w).to_numpy()[at] for w in packs], axis=1)).view("<i2")[:, :k]
        ends = np.searchsorted(-1 - cell[at], np.arange(len(few) + 1))
        for i, (m, node) in enumerate(few):
            part = slice(ends[i], ends[i + 1])
            own = lines_of(bins[part], width)
            sent[m][node] = Held(own, r[at][part], np.arange(own.shape[1]))
    out: dict[int, dict] = {m: {} for m in growing}
    for i, (m, node) in enumerate(where):
        out[m][node] = sums[i], rows[i]
    return out, sent, {m: parents for m, (_, parents) in sketches.items()}


def grow_trees(state: DataFrame, models: Sequence[int], k: int, p: Boosting, width: int) -> dict[int, Tree]:
    """The next tree of every model."""
    growing, done = {m: Growing(p) for m in models}, {}
    while growing:
        hists, sent, parents = _histograms(state, k, width, growing)
        for m, g in list(growing.items()):
            g.counted(hists[m], sent[m], parents[m])
            tree = g.grow()
            if tree is not None:
                done[m] = tree
                del growing[m]
    return done


# ----------------------------------------------------------------- models of one task
def boosted(lines: np.ndarray, label: np.ndarray, start: float, p: Boosting, width: int) -> list[Tree]:
    """The trees of a model from its rows (``lines_of`` them): those that passes over blocks would give."""
    residual, every = label - start, np.arange(len(label))
    rows, trees = None, []  # the rows of each bin are the same in all rounds
    for _ in range(p.rounds):
        g, whole = Growing(p), Held(lines, residual, every)
        if rows is None:
            sums, rows = whole.counted(width)
        else:
            sums = np.stack([np.bincount(line, residual, width) for line in lines])
        g.held(whole, (sums, rows))
        tree = g.grow()
        trees.append(tree)
        if len(tree.feature) == 1:
            break  # nothing left to split: further rounds would change nothing
        for node, value in zip(g.final, tree.value):
            if g.rows[node] is not None:
                residual[g.rows[node].some] -= p.rate * value
    return trees


TREE = {"feature": "<i4", "cut": "<i4", "null_left": "?", "left": "<i4", "right": "<i4", "value": "<f8", "rows": "<i8", "gain": "<f8"}


def in_one_task_each(blocks: DataFrame, models: Sequence[int], learns: Callable[[int], Callable[[int], bool]], fit: Callable, out: str) -> DataFrame:
    """``fit(model, blocks)`` of each model in a task of its own, over the blocks whose number ``learns(model)``, as rows of ``out``.

    The tasks read the blocks as they are stored, one after the other; no block is sent."""

    def of(m: int) -> DataFrame:
        wanted = learns(m)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from fit(m, (block for batch in batches for block in zip(*(c.to_pylist() for c in batch.columns)) if wanted(block[0])))

        return blocks.coalesce(1).mapInArrow(run, out)

    # a union of nothing but single partitions would make one task of them all (spark.sql.unionOutputPartitioning)
    other = blocks.sparkSession.range(0, 2, 1, 2).mapInArrow(lambda batches: (b for _ in batches for b in ()), out)
    return reduce(DataFrame.union, [*[of(m) for m in models], other])


def _grown_in_tasks(blocks: DataFrame, models: Sequence[int], learns: Callable[[int], Callable[[int], bool]], starts: dict[int, float],
                    k: int, p: Boosting, width: int) -> dict[int, list[Tree]]:
    """The trees of each model from blocks (number, bins, label)."""
    names = ["model", *TREE]

    def fit(m: int, own: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        lines, label = [], []
        for _, b, y in own:
            lines.append(lines_of(np.frombuffer(b, "<i2").reshape(-1, k), width))
            label.append(np.frombuffer(y))
        if label:
            for t in boosted(np.concatenate(lines, axis=1), np.concatenate(label), starts[m], p, width):
                yield pa.RecordBatch.from_arrays([pa.array([m], pa.int32()), *[pa.array([getattr(t, c).astype(kind).tobytes()], pa.binary())
                                                                               for c, kind in TREE.items()]], names=names)

    trees: dict[int, list[Tree]] = {m: [] for m in models}
    for r in in_one_task_each(blocks, models, learns, fit, "model int, " + ", ".join(f"`{c}` binary" for c in TREE)).collect():  # in the order they were grown
        trees[r.model].append(Tree(**{c: np.frombuffer(r[c], kind) for c, kind in TREE.items()}))
    return trees


class Booster:
    """A fitted ensemble over named features and their cuts."""

    def __init__(self, features: Sequence[str], cuts: list[list[float]], start: float, trees: list[Tree], p: Boosting):
        self.features, self.cuts, self.start, self.trees, self.params = list(features), cuts, start, trees, p

    @property
    def importances(self) -> list[float]:
        """Splits a feature makes, or its mean gain a split (the two methods' defaults), or its gains added up (Spark's), as shares."""
        times, gains = np.zeros(len(self.features)), np.zeros(len(self.features))
        for t in self.trees:
            inner = t.feature >= 0
            np.add.at(times, t.feature[inner], 1)
            np.add.at(gains, t.feature[inner], t.gain[inner])
        own = {"split": times, "gain": gains / np.maximum(times, 1), "total": gains}[self.params.importance]
        return (own / own.sum() if own.sum() > 0 else own).tolist()

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802 - the name Spark's tree models have
        return DenseVector(self.importances)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction``."""
        return predict(with_bins(df, self.features, self.cuts).withColumn("model", F.lit(0)), {0: self}).drop("bins", "model")


def predict(df: DataFrame, boosters: dict[int, Booster]) -> DataFrame:
    """Rows that carry ``bins`` and the number of a ``model``, with that model's ``prediction``."""
    names = df.columns
    at_bins, at_model = names.index("bins"), names.index("model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            model = batch.column(at_model).to_numpy(zero_copy_only=False)
            out = np.zeros(len(model))
            for m, b in boosters.items():
                here = np.flatnonzero(model == m)
                bins = batch.column(at_bins).flatten().to_numpy(zero_copy_only=False).reshape(len(model), len(b.features))[here]
                out[here] = b.start + sum((b.params.rate * t.predict(bins) for t in b.trees), np.zeros(len(here)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*names, "prediction"])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField("prediction", DoubleType())]))


def fit_boosters(rows: DataFrame, features: Sequence[str], cuts: list[list[float]], p: Boosting) -> dict[int, Booster]:
    """Boosters of all models in ``rows`` (model int, bins array<short>, label double); models of more rows than a task grows grow in step."""
    k, width = len(features), _width(cuts)
    # the plan behind the rows runs once, in as many tasks as it has; the blocks are made from the result
    rows = cut_lineage(rows.where(F.col("label").isNotNull()).select("model", "bins", F.col("label").cast("double")))
    means = {r.model: (r.mean, r.n) for r in rows.groupBy("model").agg(F.avg("label").alias("mean"), F.count(F.lit(1)).alias("n")).collect()}
    trees: dict[int, list[Tree]] = {m: [] for m in means}
    small = sorted(m for m in means if means[m][1] <= ONE_TASK_ROWS) if k else []
    if small:
        blocks = cut_lineage(_blocks(rows.where(F.col("model").isin(small)), k, defaultdict(float)).drop("base"))
        trees |= _grown_in_tasks(blocks, small, lambda m: lambda number: number == m, {m: means[m][0] for m in small}, k, p, width)
    models = sorted(set(means) - set(small)) if k else []
    groups = [models[i:i + MODELS_IN_STEP] for i in range(0, len(models), MODELS_IN_STEP)]

    def grow(group: list[int]) -> None:
        tasks = max(1, -(-sum(means[m][1] for m in group) // TASK_ROWS))
        state = _blocks(rows.where(F.col("model").isin(group)).coalesce(tasks), k, {m: means[m][0] for m in group}).persist()
        before = []
        for n in range(p.rounds):
            for m, tree in grow_trees(state, group, k, p, width).items():
                trees[m].append(tree)
            for old in before:  # the first pass has read what it needs of them
                old.unpersist()
            if all(len(trees[m][-1].feature) == 1 for m in group):
                break  # nothing left to split: further rounds would change nothing
            if n + 1 < p.rounds:
                before, state = [state], _added(state, {m: trees[m][-1] for m in group}, k, p.rate).persist()
                if (n + 1) % FLUSH == 0:
                    before, state = [*before, state], cut_lineage(state).coalesce(tasks).persist()
        for old in (*before, state):
            old.unpersist()

    with ThreadPoolExecutor(max(1, len(groups))) as pool:
        list(pool.map(grow, groups))
    return {m: Booster(features, cuts, means[m][0], trees[m], p) for m in sorted(means)}


def _width(cuts: Sequence[Sequence[float]]) -> int:
    """Bins of a histogram: those of the feature with most cuts, and the NULLs'."""
    return max((len(c) + 1 for c in cuts), default=1) + 1


def _fold_boosters(binned: DataFrame, features: Sequence[str], cuts: list[list[float]], p: Boosting, n_folds: int) -> dict[int, Booster]:
    """Boosters of rows (bins, label, fold): one without each fold, and number ``n_folds`` of all rows with a fold."""
    k = len(features)
    rows = binned.where(F.col("label").isNotNull() & F.col("fold").isNotNull()).select(
        F.col("fold").cast("int").alias("model"), "bins", F.col("label").cast("double").alias("label"))
    sums = {r.model: (r.s, r.n) for r in rows.groupBy("model").agg(F.sum("label").alias("s"), F.count(F.lit(1)).alias("n")).collect()}
    if not k or not sums or sum(n for _, n in sums.values()) > ONE_TASK_ROWS:
        models = F.filter(F.array(*[F.lit(m) for m in range(n_folds + 1)]), lambda m: m != F.col("fold"))
        return fit_boosters(binned.select(F.explode(models).alias("model"), "bins", "label"), features, cuts, p)
    own = {m: [sums[f] for f in sorted(sums) if f != m] for m in range(n_folds + 1)}
    starts = {m: sum(s for s, _ in parts) / sum(n for _, n in parts) for m, parts in own.items() if parts}
    blocks = cut_lineage(_blocks(rows, k, defaultdict(float)).drop("base"))
    trees = _grown_in_tasks(blocks, sorted(starts), lambda m: lambda fold: fold != m, starts, k, p, _width(cuts))
    return {m: Booster(features, cuts, starts[m], trees[m], p) for m in starts}


def cross_validate_boosting(df: DataFrame, features: Sequence[str], p: Boosting, n_folds: int, label: str = "label",
                            fold: str = "fold") -> tuple[DataFrame, DataFrame, Booster]:
    """(fold, label, prediction) of every row by the model that has not seen it; the same of the model of all rows; that model."""
    cuts = bin_cuts(df, features, p.max_bins)
    binned = with_bins(df, features, cuts).select("bins", F.col(label).alias("label"), F.col(fold).alias("fold"))
    boosters = _fold_boosters(binned, features, cuts, p, n_folds)
    held = predict(binned.where(F.col("label").isNotNull()).withColumn("model", F.col("fold").cast("int")), boosters)
    seen = predict(binned.where(F.col("label").isNotNull()).withColumn("model", F.lit(n_folds)), boosters)
    return held.select("fold", "label", "prediction"), seen.select("fold", "label", "prediction"), boosters[n_folds]
