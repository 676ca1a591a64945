"""SimHash near-duplicates: exact Hamming search over popcount-ordered tiles.

Documents are reduced to 64-bit fingerprints; equal fingerprints collapse to
one entry at once. The distinct fingerprints are put into cells by the
population counts of their four 16-bit quarters. The distance of two
fingerprints is at least the sum of the differences of these counts, so only
cells within the radius are compared; all other tile pairs are skipped. Large
cells are split into tiles of bounded size, every surviving tile pair is one
row of a Spark join, and numpy compares it exactly (exclusive-or, bit count).
A tile pair answers with a spanning forest of its links, which keeps
connectivity without writing all pairs of a dense group.

Cases: a null or empty text (or one of white space only) has fingerprint
zero, linked like any other; fewer words than the shingle length give one
shingle; ties and repeated rows share a fingerprint; an empty table gives an
empty result; columns other than id and text are not read. A null id takes
part with its text and never becomes a component id unless its whole
component has none.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from terrarank.llm.common import materialize
from terrarank.llm.components import connected_components

SEED = 42
BITS = np.arange(64, dtype=np.uint64)
QUARTERS = 4
SPAN = 64 // QUARTERS + 1  # values of one quarter's population count


def fingerprint(text: str | None, width: int = 3) -> int:
    """64-bit SimHash of word shingles (ASCII lower-cased, XXH64 with seed 42), unsigned."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    k = min(width, len(words))
    shingles = map(b" ".join, zip(*(itertools.islice(words, i, None) for i in range(k))))
    n = len(words) - k + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, itertools.repeat(SEED)), np.uint64, n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 4096):  # bounded memory for very long texts
        part = hashes[at:at + 4096].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.bitwise_or.reduce(np.where(2 * ones > n, np.uint64(1) << BITS, np.uint64(0))))


def with_fingerprint(docs: DataFrame, text_col: str, width: int, out: str) -> DataFrame:
    """Add the fingerprint as a signed 64-bit column."""

    @pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, width) for t in texts], dtype=np.uint64).view(np.int64))

    return docs.withColumn(out, simhash(F.col(text_col)))


def _offsets(radius: int) -> list[tuple[int, ...]]:
    """Half of the differences of quarter counts within the radius: each unordered pair of cells once."""
    steps = range(-radius, radius + 1)
    return [d for d in itertools.product(steps, repeat=QUARTERS) if sum(map(abs, d)) <= radius and d >= (0,) * QUARTERS]


def forest(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a tile pair, thinned to a spanning forest when there are more links than members."""
    i, j = np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= radius)
    u, v = a[i], b[j]
    keep = u != v
    u, v = u[keep], v[keep]
    if len(u) <= len(a) + len(b):
        return u, v
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    x, y = at[:len(u)], at[len(u):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    far = label != np.arange(len(nodes))
    return nodes[far], nodes[label[far]]


def links(fps: DataFrame, radius: int = 3, tile: int = 1024) -> DataFrame:
    """Edges (u, v) that connect exactly the distinct fingerprints ``fp`` within ``radius`` bits (transitively)."""
    quarter = [F.bit_count(F.shiftrightunsigned("fp", 16 * q).bitwiseAND(F.lit(0xFFFF))) for q in range(QUARTERS)]
    cell = F.lit(0)
    for q in quarter:
        cell = cell * SPAN + q
    cells = fps.select("fp", cell.alias("cell"))
    # at most SPAN ** 4 = 83,521 rows whatever the input: a proven bound for the broadcast
    sizes = cells.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("subs"))
    tiles = (cells.join(F.broadcast(sizes), "cell")
             .withColumn("sub", F.pmod(F.xxhash64("fp"), F.col("subs")).cast("int"))
             .groupBy("cell", "sub").agg(F.collect_list("fp").alias("members")))
    parts = [F.floor(F.col("cell") / SPAN ** (QUARTERS - 1 - q)) % SPAN for q in range(QUARTERS)]
    steps = F.array(*[F.array(*map(F.lit, d)) for d in _offsets(radius)])
    moved = [p + F.col("step")[q] for q, p in enumerate(parts)]
    inside, cell2 = F.lit(True), F.lit(0)
    for p in moved:
        inside, cell2 = inside & p.between(0, SPAN - 1), cell2 * SPAN + p
    other = sizes.select(F.col("cell").alias("cell2"), F.col("subs").alias("subs2"))
    left = (tiles.withColumn("step", F.explode(steps)).where(inside).withColumn("cell2", cell2.cast("int"))
            .join(F.broadcast(other), "cell2")
            .withColumn("sub2", F.explode(F.sequence(F.lit(0), F.col("subs2") - 1)))
            .where((F.col("cell") != F.col("cell2")) | (F.col("sub") <= F.col("sub2")))
            .select("cell2", "sub2", F.col("members").alias("a")))
    right = tiles.select(F.col("cell").alias("cell2"), F.col("sub").alias("sub2"), F.col("members").alias("b"))

    def compare(batches):
        for batch in batches:
            us, vs = [], []
            cols = [batch.column(k) for k in (0, 1)]
            for r in range(batch.num_rows):
                a, b = (c[r].values.to_numpy(zero_copy_only=False).view(np.uint64) for c in cols)
                u, v = forest(a, b, radius)
                us.append(u)
                vs.append(v)
            if us:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).view(np.int64)) for x in (us, vs)], names=["u", "v"])

    return left.join(right, ["cell2", "sub2"]).select("a", "b").mapInArrow(compare, "u long, v long")


def fingerprint_components(rows: DataFrame, id_col: str, radius: int, tile: int) -> DataFrame:
    """(fp, component_id) for every distinct ``fp`` of ``rows``; component_id is the smallest id reachable."""
    nodes = rows.groupBy("fp").agg(F.min(id_col).alias("low"))
    nodes = materialize(nodes, "simhash-nodes")
    comps = connected_components(links(nodes.select("fp"), radius, tile))
    rooted = nodes.join(comps.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return rooted.join(lows, "root").select("fp", "root", "component_id")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                       radius: int = 3, tile: int = 1024) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits), ``component_id`` (smallest linked id)."""
    rows = materialize(
        with_fingerprint(docs.select(id_col, text_col), text_col, width, "fp").select(id_col, "fp"), "simhash")
    comps = fingerprint_components(rows, id_col, radius, tile).select("fp", "component_id")
    return rows.join(comps, "fp").select(
        id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                           radius: int = 3, tile: int = 1024) -> DataFrame:
    """The documents' own columns, one row per component: its smallest id (ties: the smallest text)."""
    cols = docs.columns
    marked = docs.select(F.struct(*[docs[c] for c in cols]).alias("row"), docs[id_col].alias("id"), docs[text_col].alias("body"))
    rows = materialize(with_fingerprint(marked, "body", width, "fp").drop("body"), "simhash-rows")
    comps = fingerprint_components(rows, "id", radius, tile)
    first = (rows.join(comps, "fp").where(F.col("id").eqNullSafe(F.col("component_id")))
             .groupBy("root").agg(F.min_by("row", F.struct(F.xxhash64(F.col(f"row.{text_col}")), F.col(f"row.{text_col}")))
                                  .alias("row")))
    return first.select(*[F.col("row").getField(c).alias(c) for c in cols])
