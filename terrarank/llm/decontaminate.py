"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items that share a seed (``SEED_WORDS`` consecutive
words, ASCII lower-cased) are tiled: the longest match of unmarked words is
marked, again and again, until no match of seed length is left. Matches of at
least ``s`` words are found by running Karp-Rabin hashes, with ``s`` halved
from the item's length down to the seed's, and merged along their diagonals.
The share of an item's words under tiles is its coverage; it is insensitive
to the order of the passages. A document that covers ``COVERAGE`` of an item
is contaminated.

While the benchmark holds at most ``BROADCAST_WORDS`` words (counted first) it
travels to the tasks and the documents are read once without a shuffle;
beyond that, document and item seeds meet in a Spark join: seeds of the sizes
that items have, and of those only the ones that pass a filter of the items'
seeds of fixed size, are shuffled.

Cases: null or empty texts and items share no seed; an item shorter than a
seed is one seed; equal lengths are marked in the order of the item, then of
the document; repeated documents or items give one row for a pair of ids, the
one with the largest coverage; null ids are kept as such; very long texts are
tiled whole; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from terrarank.llm.common import byte_batches, materialize, mix64, texts_of, word_count

SEED_WORDS = 5
COVERAGE = 0.8
BROADCAST_WORDS = 300_000
PAIRS = 1 << 18  # pairs of equal windows looked at together
FILTER_BITS = 27  # of the filter that the seeds of documents pass before they are shuffled
ITEMS_PER_ROW = 256  # items compared with one copy of a document's text

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2 ** 64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


class Running:
    """Karp-Rabin hashes of all windows of a sequence, any length, from one prefix sum (modulo 2 ** 64)."""

    def __init__(self, ids: np.ndarray):
        n = len(ids)
        steps = np.full(n, BASE, np.uint64)
        back = np.full(n, INVERSE, np.uint64)
        if n:
            steps[0] = back[0] = 1
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(ids) * np.cumprod(steps), dtype=np.uint64)])
        self.back = np.cumprod(back)

    def windows(self, size: int) -> np.ndarray:
        return (self.sums[size:] - self.sums[:-size]) * self.back[:len(self.sums) - size]


def _free(marked: np.ndarray, size: int) -> np.ndarray:
    """Starts of the windows without a marked place."""
    total = np.concatenate([[0], np.cumsum(marked)])
    return np.flatnonzero(total[size:] == total[:-size])


def _runs(diagonal: np.ndarray, own: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces (diagonal, item start, length) that follow one another on a diagonal, joined."""
    by = np.lexsort((own, diagonal))
    diagonal, own, count = diagonal[by], own[by], count[by]
    new = np.ones(len(own), bool)
    new[1:] = (np.diff(diagonal) != 0) | (own[1:] != own[:-1] + count[:-1])
    starts = np.flatnonzero(new)
    return diagonal[starts], own[starts], np.add.reduceat(count, starts) if len(starts) else count


def _matches(item: Running, doc: Running, item_free: np.ndarray, doc_free: np.ndarray, size: int):
    """Maximal diagonal runs (length, item start, doc start) of equal free windows."""
    a, b = item.windows(size)[item_free], doc.windows(size)[doc_free]
    order = np.argsort(a, kind="stable")
    low, high = np.searchsorted(a[order], b, "left"), np.searchsorted(a[order], b, "right")
    times = high - low
    if not times.any():
        return []
    # pairs of equal windows, so many at a time; runs cut by a block's end are joined afterwards
    parts = []
    block = np.cumsum(times) // PAIRS
    edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(times)]
    for lo, hi in zip(edges, edges[1:]):
        t = times[lo:hi]
        at = np.repeat(doc_free[lo:hi], t)
        first = np.repeat(low[lo:hi] - (np.cumsum(t) - t), t)
        own = item_free[order[first + np.arange(len(at))]]
        parts.append(_runs(at - own, own, np.ones(len(at), np.int64)))
    diagonal, own, count = parts[0] if len(parts) == 1 else _runs(*(np.concatenate(p) for p in zip(*parts)))
    return list(zip((count + size - 1).tolist(), own.tolist(), (own + diagonal).tolist()))


def tile(item: np.ndarray, doc: np.ndarray, least: int = SEED_WORDS) -> list[tuple[int, int, int]]:
    """Tiles (length, item start, document start) by greedy string tiling; 0 in ``doc`` equals nothing."""
    least = min(least, len(item))
    tiles: list[tuple[int, int, int]] = []
    if not least or len(doc) < least:
        return tiles
    in_item, in_doc = np.zeros(len(item), bool), doc == 0
    hash_item, hash_doc = Running(item), Running(doc)
    size = len(item)
    while True:
        if len(doc) >= size:
            found = _matches(hash_item, hash_doc, _free(in_item, size), _free(in_doc, size), size)
            heap = [(-n, i, d) for n, i, d in found]
            heapq.heapify(heap)
            while heap:
                n, i, d = heapq.heappop(heap)
                n = -n
                free = ~(in_item[i:i + n] | in_doc[d:d + n])
                if free.all():
                    in_item[i:i + n] = in_doc[d:d + n] = True
                    if np.array_equal(item[i:i + n], doc[d:d + n]):  # hashes only propose
                        tiles.append((n, i, d))
                    continue
                edge = np.flatnonzero(np.diff(free, prepend=False, append=False))
                for a, b in zip(edge[0::2].tolist(), edge[1::2].tolist()):
                    if b - a >= size:
                        heapq.heappush(heap, (a - b, i + a, d + a))
        if size == least:
            return tiles
        size = max(least, size // 2)


def coverage_bound(item: np.ndarray, doc: np.ndarray) -> float:
    """Share of the item's words under seeds that also stand in the document: no tiling covers more."""
    size = min(SEED_WORDS, len(item))
    if not size or len(doc) < size:
        return 0.0
    hit = np.isin(Running(item).windows(size), Running(doc).windows(size))
    covered = np.zeros(len(item) + 1, np.int64)
    starts = np.flatnonzero(hit)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + size, -1)
    return float((np.cumsum(covered[:-1]) > 0).mean())


def compare(item: np.ndarray, doc: np.ndarray, threshold: float) -> tuple[float, int] | None:
    """(coverage, tiles) if the document reaches the threshold."""
    if coverage_bound(item, doc) < threshold:
        return None
    tiles = tile(item, doc)
    covered = sum(n for n, _, _ in tiles) / len(item)
    return (covered, len(tiles)) if covered >= threshold else None


class Benchmark:
    """All items in one task: vocabulary, word ids of each item, and sorted seeds with their items."""

    def __init__(self, items: list[tuple]):
        self.vocabulary: dict[bytes, int] = {}
        self.keys, self.ids = [], []
        for key, text in items:
            found = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            if found:
                self.keys.append(key)
                self.ids.append(np.array(found, np.uint64))
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in {min(SEED_WORDS, len(x)) for x in self.ids}:
            own = [n for n, x in enumerate(self.ids) if min(SEED_WORDS, len(x)) == size]
            seeds = [np.unique(Running(self.ids[n]).windows(size)) for n in own]
            flat, item = np.concatenate(seeds), np.repeat(own, [len(s) for s in seeds])
            order = np.argsort(flat, kind="stable")
            self.by_size[size] = (flat[order], item[order])

    def word_ids(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        return np.fromiter((self.vocabulary.get(w, 0) for w in words), np.uint64, len(words))

    def sharing(self, doc: np.ndarray) -> set[int]:
        """Items with a seed in the document."""
        out: set[int] = set()
        running = None
        for size, (seeds, items) in self.by_size.items():
            starts = _free(doc == 0, size) if len(doc) >= size else []
            if len(starts):
                running = running or Running(doc)
                own = np.unique(running.windows(size)[starts])
                low, high = np.searchsorted(seeds, own, "left"), np.searchsorted(seeds, own, "right")
                for a, b in zip(low[high > low].tolist(), high[high > low].tolist()):
                    out.update(items[a:b].tolist())
        return out


FIELDS = [StructField("coverage", DoubleType()), StructField("n_tiles", IntegerType())]


def _with_broadcast(rows: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast([tuple(r) for r in items.collect()])  # at most BROADCAST_WORDS words
    schema = StructType([StructField("id", rows.schema["id"].dataType), StructField("text_key", LongType()),
                         StructField("item", items.schema["item"].dataType), *FIELDS])
    kinds = [to_arrow_type(f.dataType) for f in schema.fields[2:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        benchmark = Benchmark(shared.value)
        for batch in byte_batches(batches, "text", 8 << 20):
            where, out = [], []
            for n, text in enumerate(texts_of(batch)):
                doc = benchmark.word_ids(text)
                for item in sorted(benchmark.sharing(doc)):
                    found = compare(benchmark.ids[item], doc, threshold)
                    if found:
                        where.append(n)
                        out.append((benchmark.keys[item], *found))
            take = pa.array(where, pa.int64())
            cols = [pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), *cols],
                names=["id", "text_key", "item", "coverage", "n_tiles"])

    return rows.mapInArrow(run, schema)


def _seed_rows(rows: DataFrame, name: str, sizes: list[int] | None = None, seen: Broadcast | None = None) -> DataFrame:
    """(size, seed, name) of every text: for items one size each, for documents the ``sizes`` that items have, seeds that
    pass the filter ``seen`` alone."""
    kind = rows.schema[name].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_batches(batches, "text", 4 << 20):
            for n, text in enumerate(texts_of(batch)):
                words = words_of(text)
                ids = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
                running = Running(ids)
                for size in {min(SEED_WORDS, len(ids))} if sizes is None else sizes:
                    if size and len(ids) >= size:
                        seeds = np.unique(running.windows(size))
                        if seen is not None:
                            places = _filter_place(seeds, size)
                            seeds = seeds[(seen.value[places >> np.uint64(6)] >> (places & np.uint64(63)) & np.uint64(1)).astype(bool)]
                        if len(seeds):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(seeds), size, np.int32)), pa.array(seeds.view(np.int64)),
                                 batch.column(0).take(pa.array(np.full(len(seeds), n)))], names=["size", "seed", name])

    return rows.select(name, "text").mapInArrow(run, f"size int, seed long, {name} {kind}")


def _filter_place(seeds: np.ndarray, size: int) -> np.ndarray:
    return mix64(seeds + np.uint64(size)) >> np.uint64(64 - FILTER_BITS)


def _seed_filter(item_seeds: DataFrame) -> Broadcast:
    """A bit for each place that some item's seed has, 2 ** FILTER_BITS in all, however many items there are.

    Tasks send the words of 64 bits that they set, Spark joins them by or.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, seeds = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(2))
            places = mix64(seeds.view(np.uint64) + sizes.astype(np.uint64)) >> np.uint64(64 - FILTER_BITS)
            at, which = np.unique(places >> np.uint64(6), return_inverse=True)
            bits = np.zeros(len(at), np.uint64)
            np.bitwise_or.at(bits, which, np.uint64(1) << (places & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(bits.view(np.int64))], names=["at", "bits"])

    words = item_seeds.select("size", "seed").mapInArrow(run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(1 << (FILTER_BITS - 6), np.uint64)  # 16 MB
    table[words.column("at").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return item_seeds.sparkSession.sparkContext.broadcast(table)


def _with_join(rows: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    items = items.withColumn("item_key", F.xxhash64("item", "text"))
    item_seeds = materialize(_seed_rows(items.select("item_key", "text"), "item_key"), "benchmark-seeds")
    sizes = [r["size"] for r in item_seeds.select("size").distinct().collect()]  # at most SEED_WORDS of them
    rows = rows.withColumn("row_key", F.xxhash64("id", "text_key"))
    doc_seeds = _seed_rows(rows.select("row_key", "text"), "row_key", sizes, _seed_filter(item_seeds))
    pairs = doc_seeds.join(item_seeds, ["size", "seed"]).select("row_key", "item_key").distinct()
    # a document's items in groups, so that its text travels once for a group
    nth = F.row_number().over(Window.partitionBy("row_key").orderBy("item_key")) - 1
    named = items.select("item_key", F.struct("item", F.col("text").alias("item_text")).alias("one"))
    groups = (pairs.withColumn("part", F.floor(nth / ITEMS_PER_ROW)).join(named, "item_key")
              .groupBy("row_key", "part").agg(F.collect_list("one").alias("items")))
    both = groups.join(rows, "row_key").select("id", "text_key", "text", "items")
    schema = StructType([both.schema["id"], both.schema["text_key"], StructField("item", items.schema["item"].dataType), *FIELDS])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_batches(batches, "text", 8 << 20):
            out = []
            for key, text_key, text, own in zip(*(c.to_pylist() for c in batch.columns)):
                benchmark = Benchmark([(i["item"], i["item_text"]) for i in own])
                doc = benchmark.word_ids(text)
                for item, ids in zip(benchmark.keys, benchmark.ids):
                    found = compare(ids, doc, threshold)
                    if found:
                        out.append({"id": key, "text_key": text_key, "item": item, "coverage": found[0], "n_tiles": found[1]})
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return both.mapInArrow(run, schema)


def _tiled(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str,
           threshold: float, broadcast_words: int) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    items = items.select(F.col(item_col).alias("item"), F.col(item_text).alias("text"))
    size = items.agg(F.sum(word_count(F.col("text")) + 1)).first()[0] or 0
    way = _with_broadcast if size <= broadcast_words else _with_join
    return way(rows, items, threshold)


def contaminated_pairs(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text: str = "text", threshold: float = COVERAGE,
                       broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """(document id, item id, coverage, n_tiles) of every pair that reaches the threshold."""
    found = _tiled(docs, items, id_col, text_col, item_col, item_text, threshold, broadcast_words)
    best = found.groupBy("id", "item").agg(F.max(F.struct("coverage", "n_tiles")).alias("best"))
    return best.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "best.coverage", "best.n_tiles")


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      item_col: str = "item_id", item_text: str = "text", threshold: float = COVERAGE,
                      broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """The documents that reach no item's threshold, with their own columns."""
    found = _tiled(docs, items, id_col, text_col, item_col, item_text, threshold, broadcast_words)
    bad = materialize(found.select("id", "text_key").distinct(), "contaminated")
    return docs.join(bad, docs[id_col].eqNullSafe(bad["id"]) & (F.xxhash64(docs[text_col]) == bad["text_key"]), "left_anti")
