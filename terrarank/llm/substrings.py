"""Substring dedup: windows of words that occurred before are removed; a count-min prefilter keeps the work small.

Documents are packed into chunks, written once, and gone over three times.

1. Sketch. A window's key is the smallest hash of the short word runs in it,
   so equal windows have equal keys, and a key's places are never fewer than
   the places of any window that has it. Each chunk sends the cells and counts of
   its keys (a sparse sketch, ``DEPTH`` rows); a Spark group for each stretch
   of cells merges them by adding, and tells each chunk which of its cells
   count two or more. The estimate is never too small, so no repeated window is lost.
2. Exact. Windows whose cells are repeated in every row are sent on as
   128-bit hashes, the first of each chunk alone, and grouped exactly: all but
   the first by (id, place in the document) are later copies.
3. Removal. Words under a later copy go; later copies within a chunk are
   found there and then.

The sketch is as wide as the counted words ask for, in stretches of about
``GROUP_BYTES`` of cells sent; the exact groups are as many as the keys
estimated repeated ask for, of about that size too. Both, and the tasks that
take them, grow in number with the input, not in size, and nothing passes through the driver or a broadcast.

Cases: null and empty texts have no words; fewer words than a window stay as
they are; windows may overlap their own copy; rows with the same id are
ordered by their chunk and place in it (repeated rows: all but one lose their
windows); null ids come first; a window held by any share of all
documents reaches its group once per chunk; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType
from pyspark.taskcontext import TaskContext

from terrarank.llm.common import byte_batches, materialize, mix64, n_tasks, texts_of

WINDOW = 20
RUN = 8  # words hashed together for a window's key
CHUNK_BYTES = 4 << 20
DEPTH = 2
CELLS_PER_KEY = 4
KEY_DENSITY = 2 / (WINDOW - RUN + 2)  # expected share of places that are some window's key
LEAST_STRETCH, MOST_STRETCH = 14, 26  # bits
GROUP_BYTES = 8 << 20  # sent to one group
CELL_BYTES, WINDOW_BYTES = 3, 24  # what a key's cell and a window take on the way, at most

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
_ROWS = [np.uint64(0x165667B19E3779F9 * (k + 1) % (1 << 64)) for k in range(DEPTH)]
NO_ID = np.iinfo(np.int64).min


def _zip(array: np.ndarray) -> bytes:
    """Bytes by significance, then compressed: small numbers take little room."""
    return zstandard.compress(np.ascontiguousarray(array.view(np.uint8).reshape(-1, array.itemsize).T).tobytes(), 1)


def _unzip(data: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def _rolling(flat: np.ndarray, size: int, factor: np.uint64) -> np.ndarray:
    """Polynomial hashes of all runs of ``size`` words."""
    n = len(flat) - size + 1
    out = flat[:n].copy()
    for k in range(1, size):
        out *= factor
        out += flat[k:n + k]
    return mix64(out)


def _sliding(x: np.ndarray, size: int, pick) -> np.ndarray:
    """Smallest or largest value of every ``size`` neighbours."""
    width = 1
    while 2 * width <= size:
        x, width = pick(x[:-width], x[width:]), 2 * width
    rest = size - width
    return pick(x[:len(x) - rest], x[rest:]) if rest else x


class Chunk:
    """Words and windows of some documents; windows are numbered by their first word in the chunk."""

    def __init__(self, texts: list[bytes], window: int = WINDOW):
        self.words = [t.split() for t in texts]
        self.counts = np.array([len(w) for w in self.words], np.int64)
        self.ends = np.cumsum(self.counts)
        self.size, self.window = int(self.counts.sum()), window
        every = itertools.chain.from_iterable(self.words)
        self.flat = np.fromiter(map(xxhash.xxh3_64_intdigest, every), np.uint64, self.size)
        if self.size >= window:
            fits = np.arange(self.size - window + 1) + window <= np.repeat(self.ends, self.counts)[:self.size - window + 1]
            self.starts = np.flatnonzero(fits)
        else:
            fits, self.starts = np.zeros(0, bool), np.zeros(0, np.int64)
        self.fits = fits

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(key of every window in ``starts``, distinct keys, their places)."""
        if not len(self.starts):
            return tuple(np.zeros(0, np.uint64) for _ in range(3))
        run = min(RUN, self.window)
        runs = _rolling(self.flat, run, _A) | np.uint64(1)
        span = self.window - run + 1
        key = np.where(self.fits, _sliding(runs, span, np.minimum), np.uint64(0))
        pad = np.zeros(span - 1, np.uint64)
        used = runs == _sliding(np.concatenate([pad, key, pad]), span, np.maximum)
        distinct, places = np.unique(runs[used], return_counts=True)
        return key[self.starts], distinct, places

    def exact(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """128-bit hashes of windows."""
        if not len(starts):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        return tuple(_rolling(flat, self.window, factor)[starts]
                     for flat, factor in ((self.flat, _B), (mix64(self.flat ^ _A), _C)))

    def in_order(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Rank of each window's document in the chunk by (id, row)."""
        rank = np.empty(len(ids), np.int64)
        rank[np.lexsort((np.arange(len(ids)), ids))] = np.arange(len(ids))
        return rank[np.searchsorted(self.ends, starts, "right")]

    def first_of_each(self, ids: np.ndarray, starts: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Marks the first window of every distinct sequence."""
        order = np.lexsort((starts, self.in_order(ids, starts), h2, h1))
        new = np.ones(len(starts), bool)
        new[1:] = (np.diff(h1[order]) != 0) | (np.diff(h2[order]) != 0)
        out = np.zeros(len(starts), bool)
        out[order[new]] = True
        return out


def _cells(keys: np.ndarray, row: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the keys in one sketch row, ascending, and the order that sorts them."""
    cells = mix64(keys ^ _ROWS[row]) >> np.uint64(64 - bits)
    order = np.argsort(cells, kind="stable")
    return cells[order], order


PACKED = StructType([StructField("chunk", LongType()), StructField("ids", ArrayType(LongType())),
                     StructField("lengths", ArrayType(IntegerType())), StructField("texts", BinaryType()),
                     StructField("n_words", LongType())])


def pack(docs: DataFrame, id_col: str, text_col: str, chunk_bytes: int) -> DataFrame:
    """Chunks of whole documents, written once: their numbers must not change between the passes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        ids, texts, held, n_words = [], [], 0, 0
        schema = pa.schema([("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())),
                            ("texts", pa.binary()), ("n_words", pa.int64())])

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [{"chunk": part << 32 | seq, "ids": ids, "lengths": [len(t) for t in texts],
                  "texts": zstandard.compress(b"".join(texts), 5), "n_words": n_words}], schema=schema)

        for batch in byte_batches(batches, "text", 8 << 20):
            for key, text in zip(batch.column(0).to_pylist(), texts_of(batch)):
                data = (text or "").encode()
                ids.append(key)
                texts.append(data)
                held += len(data)
                n_words += len(data.split())
                if held >= chunk_bytes:
                    yield row()
                    ids, texts, held, n_words, seq = [], [], 0, 0, seq + 1
        if ids:
            yield row()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return materialize(rows.mapInArrow(run, PACKED), "substring-chunks")


def _texts(lengths: list[int], data: bytes) -> list[bytes]:
    raw = zstandard.decompress(data)
    ends = np.cumsum(lengths).tolist()
    return [raw[e - n:e] for n, e in zip(lengths, ends)]


def _ids(ids: list) -> np.ndarray:
    return np.array([NO_ID if i is None else i for i in ids], np.int64)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {n: c[k].as_py() for n, c in zip(batch.schema.names, batch.columns)}


def _tasks(packed: DataFrame, groups: int) -> int:
    """Tasks for so many groups of ``GROUP_BYTES``: a few each, and no fewer tasks than other shuffles have."""
    return max(n_tasks(packed), groups // 2)


def _estimates(packed: DataFrame, window: int, bits: int, stretch: int) -> tuple[DataFrame, int]:
    """The written table (chunk, found): for each chunk which of its cells are repeated, row by row and stretch by
    stretch; and how many windows their keys may stand for."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(batches):
            _, keys, places = Chunk(_texts(r["lengths"], r["texts"]), window).keys()
            out = []
            for row in range(DEPTH):
                cells, order = _cells(keys, row, bits)
                count = np.minimum(places[order], 2).astype(np.uint8)
                at = cells >> np.uint64(stretch)
                edges = np.flatnonzero(np.diff(at, prepend=np.uint64(1 << 63))).tolist() + [len(at)]
                for a, b in zip(edges, edges[1:]):
                    local = (cells[a:b] & np.uint64((1 << stretch) - 1)).astype(np.uint32)
                    out.append((row, int(at[a]), r["chunk"], _zip(np.diff(local, prepend=np.uint32(0))), _zip(count[a:b])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[k] for o in out], kind) for k, kind in enumerate(
                    (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                names=["row", "stretch", "chunk", "cells", "counts"])

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(1 << stretch, np.uint8)
        own = [np.cumsum(_unzip(c, np.uint32), dtype=np.int64) for c in group["cells"]]
        for cells, counts in zip(own, group["counts"]):
            # counts of two or more are all alike, so the sums may stop at two
            distinct, at = np.unique(cells, return_inverse=True)
            added = np.bincount(at, weights=_unzip(counts, np.uint8))
            total[distinct] = np.minimum(total[distinct] + added, 2).astype(np.uint8)
        bits_ = [np.packbits(total[cells] > 1).tobytes() for cells in own]
        return pd.DataFrame({"chunk": group["chunk"], "row": group["row"], "stretch": group["stretch"],
                             "n": [len(c) for c in own], "hits": [int((total[c] > 1).sum()) for c in own], "bits": bits_})

    parts = (packed.select("chunk", "lengths", "texts")
             .mapInArrow(sketch, "row int, stretch long, chunk long, cells binary, counts binary")
             .repartition(_tasks(packed, DEPTH << (bits - stretch)), "row", "stretch")
             .groupBy("row", "stretch").applyInPandas(merge, "chunk long, row int, stretch long, n int, hits int, bits binary"))
    found = parts.groupBy("chunk").agg(F.collect_list(F.struct("row", "stretch", "n", "bits")).alias("found"),
                                       F.sum(F.when(F.col("row") == 0, F.col("hits"))).alias("keys"))
    found = materialize(found, "substring-estimates")
    keys = found.agg(F.sum("keys")).first()[0] or 0  # in one row of the sketch: no fewer than in all
    return found.drop("keys"), int(keys / KEY_DENSITY)


def _repeated(found: list[dict], keys: np.ndarray, bits: int) -> np.ndarray:
    """Marks the keys estimated repeated in every row."""
    out = np.ones(len(keys), bool)
    for row in range(DEPTH):
        order = _cells(keys, row, bits)[1]
        parts = sorted((f for f in found if f["row"] == row), key=lambda f: f["stretch"])
        flags = [np.unpackbits(np.frombuffer(f["bits"], np.uint8), count=f["n"]) for f in parts]
        marks = np.zeros(len(keys), bool)
        marks[order] = np.concatenate(flags).astype(bool)
        out &= marks
    return out


def _later(packed: DataFrame, estimates: DataFrame, window: int, bits: int, group_bits: int) -> DataFrame:
    """(chunk, later): first words of windows that occur before in another chunk (the first of each chunk alone)."""
    joined = packed.select("chunk", "ids", "lengths", "texts").join(estimates, "chunk")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(batches):
            chunk, ids = Chunk(_texts(r["lengths"], r["texts"]), window), _ids(r["ids"])
            key, distinct, _ = chunk.keys()
            marked = _repeated(r["found"], distinct, bits)
            starts = chunk.starts[marked[np.searchsorted(distinct, key)]] if len(distinct) else chunk.starts
            h1, h2 = chunk.exact(starts)
            first = chunk.first_of_each(ids, starts, h1, h2)
            starts, h1, h2 = starts[first], h1[first], h2[first]
            doc = np.searchsorted(chunk.ends, starts, "right")
            at = (h1 >> np.uint64(64 - group_bits)).astype(np.int64) if group_bits else np.zeros(len(h1), np.int64)
            order = np.lexsort((starts, at))
            edges = np.flatnonzero(np.diff(at[order], prepend=-1)).tolist() + [len(order)]
            out = []
            for a, b in zip(edges, edges[1:]):
                take = order[a:b]
                out.append((int(at[take[0]]), r["chunk"], np.stack([h1[take], h2[take]], 1).tobytes(),
                            _zip(ids[doc[take]]), _zip(np.diff(starts[take].astype(np.uint32), prepend=np.uint32(0)))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[k] for o in out], kind) for k, kind in enumerate(
                    (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
                names=["part", "chunk", "hashes", "ids", "starts"])

    def settle(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("chunk")
        hashes = np.concatenate([np.frombuffer(h, np.uint64).reshape(-1, 2) for h in group["hashes"]])
        ids = np.concatenate([_unzip(i, np.int64) for i in group["ids"]])
        starts = [np.cumsum(_unzip(s, np.uint32), dtype=np.uint32) for s in group["starts"]]
        sizes = [len(s) for s in starts]
        order = np.lexsort((np.repeat(np.arange(len(sizes)), sizes), ids, hashes[:, 1], hashes[:, 0]))
        later = np.zeros(len(ids), bool)
        later[order[1:]] = (hashes[order[1:]] == hashes[order[:-1]]).all(axis=1)
        marks = np.split(later, np.cumsum(sizes)[:-1])
        return pd.DataFrame({"chunk": group["chunk"].to_numpy(),
                             "later": [_zip(np.diff(s[m], prepend=np.uint32(0))) for s, m in zip(starts, marks)]})

    return (joined.mapInArrow(send, "part long, chunk long, hashes binary, ids binary, starts binary")
            .repartition(_tasks(packed, 1 << group_bits), "part").groupBy("part").applyInPandas(settle, "chunk long, later binary")
            .groupBy("chunk").agg(F.collect_list("later").alias("later")))


def _group_bits(docs: DataFrame, sent: int) -> int:
    """Bits for groups of ``GROUP_BYTES``, and no fewer groups than a shuffle has tasks."""
    return max(-(-sent // GROUP_BYTES) - 1, n_tasks(docs) - 1, 1).bit_length()


def remove_repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                            chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(id, n_words, n_removed, text): the words of each document that no later copy of a window covers."""
    packed = pack(docs, id_col, text_col, chunk_bytes)
    words = packed.agg(F.sum("n_words")).first()[0] or 0
    bits = max(LEAST_STRETCH, int(words * KEY_DENSITY * CELLS_PER_KEY).bit_length())
    sent = int(words * KEY_DENSITY * CELL_BYTES)  # by each row of the sketch
    stretch = min(MOST_STRETCH, max(LEAST_STRETCH, bits - _group_bits(docs, sent)))
    estimates, windows = _estimates(packed, window, bits, stretch)
    later = _later(packed, estimates, window, bits, _group_bits(docs, windows * WINDOW_BYTES))
    joined = packed.select("chunk", "ids", "lengths", "texts").join(later, "chunk", "left")
    schema = StructType([StructField(id_col, LongType()), StructField("n_words", LongType()),
                         StructField("n_removed", LongType()), StructField("text", StringType())])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(batches):
            chunk = Chunk(_texts(r["lengths"], r["texts"]), window)
            ids = _ids(r["ids"])
            again = ~chunk.first_of_each(ids, chunk.starts, *chunk.exact(chunk.starts))
            before = [np.cumsum(_unzip(x, np.uint32), dtype=np.int64) for x in r["later"] or []]
            # a window that is later than another chunk's makes its own copies here later too: they are in ``again``
            cover = np.zeros(chunk.size + 1, np.int64)
            for starts in [chunk.starts[again], *before]:
                np.add.at(cover, starts, 1)
                np.add.at(cover, starts + window, -1)
            keep = np.cumsum(cover[:-1]) == 0
            kept, texts, removed, at = keep.tolist(), [], [], 0
            for own in chunk.words:
                left = list(itertools.compress(own, kept[at:at + len(own)]))
                texts.append(b" ".join(left).decode())
                removed.append(len(own) - len(left))
                at += len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(r["ids"], pa.int64()), pa.array(chunk.counts), pa.array(removed, pa.int64()), pa.array(texts)],
                names=schema.fieldNames())

    return joined.mapInArrow(remove, schema)
