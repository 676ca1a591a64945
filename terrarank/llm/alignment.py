"""Cross-tokenizer alignment: which tokens of two tokenizers overlap, and where both end together.

Both tokenizers cut the bytes of a space and the text. With the byte offsets
where tokens end as two sorted lists, alignment is their merge: every distinct
end closes one link (an A and a B token whose ranges overlap), every end in
both lists closes one group.

The documents of a block stand one behind the other, so that a block is one
pair of lists. Merge-path partitioning cuts it into pieces of equal work,
however long the documents are: the path of the merge crosses each diagonal
i + j = d once, and a binary search along the diagonal finds where. A piece
emits its overlaps and the ends it saw twice; an end that one piece saw in A
and the next one in B is counted once, and groups that reach over pieces are
stitched by the running count of common ends.

How often an id pair is linked is counted over all documents: a piece names
its distinct pairs once, Spark sums them by pair, and every piece gets the
totals of its own pairs back, so no task holds more than a piece's pairs and
nothing goes through the driver. A piece is a row of a written table, which a
lost executor's work is read from again.

Cases: a null or empty text, and one whose tokens' bytes do not join to the
space and the text (a tokenizer that changes characters), has no tokens: zeros,
and the groups ''. Equal rows are counted as often as they stand there and each
has its own result; null ids are kept; an empty table gives no rows; other
columns are not read; a text longer than a block makes a longer block of the
same pieces. Strings of special tokens inside a text are plain text.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string
from pyspark.taskcontext import TaskContext

from terrarank.llm.common import byte_batches, materialize, small_batches
from terrarank.llm.tokens import BYTE_CHARS, FIRST, Encoder, encoder_for

PIECE = 1 << 20  # ends in a piece
BLOCK_BYTES = 3 << 19
SPACE_MARK = "▁"

PIECE_FIELDS = ("piece long, block long, pairs array<long>, times array<long>, codes binary, places array<long>, links array<long>, "
                "docs array<struct<id: {id}, n_a: long, n_b: long, n_groups: long, n_links: long, groups: string>>")


# ----------------------------------------------------------------- the two tokenizers
def _byte_lengths(pieces: list[bytes]) -> np.ndarray:
    return np.array([len(p) for p in pieces], np.int64)


class ByteLevel:
    """Ids of a byte-level BPE file of the tokenizers library and the bytes of each id."""

    def __init__(self, path: str):
        self.encoder = encoder_for(path, True)
        code = {c: n for n, c in enumerate(BYTE_CHARS)}
        vocab = self.encoder.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes_of = [b""] * (max(vocab.values()) + 1)
        for entry, n in vocab.items():
            self.bytes_of[n] = bytes(code[c] for c in entry) if all(c in code for c in entry) else entry.encode()
        self.lengths = _byte_lengths(self.bytes_of)

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        return self.encoder.encode_batch(pc.binary_join_element_wise("", texts, " "))


class _PieceWords(Encoder):
    """Batches of texts through a sentencepiece model, by way of their distinct words.

    No piece of the model holds a space mark behind another character, or a line
    break, so merges never reach over the start of a word or of a line.
    """

    def __init__(self, model):
        self.model = model
        self.code, self.dtype = "H", np.dtype("<u2")
        if model.get_piece_size() > 1 << 16:
            self.code, self.dtype = "I", np.dtype("<u4")
        self.lead = model.piece_to_id(SPACE_MARK)
        pieces = [model.id_to_piece(n) for n in range(model.get_piece_size())]
        self.by_word = not any(SPACE_MARK in p.lstrip(SPACE_MARK) or "\n" in p for p in pieces)
        self.words = pa.array([], pa.string())
        self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, self.dtype)

    def whole(self, text: str) -> bytes:
        return array(self.code, self.model.encode(text)).tobytes()

    def word(self, word: str) -> bytes | None:
        """Ids of a space and the word, or of a line break and the word; None for what stands in a run of spaces."""
        body = word[1:] if word[:1] == FIRST else word
        if not body or not self.by_word:
            return None
        ids = self.model.encode(body)
        if word[:1] == "\n":  # the model's own leading space is none of the text's
            if ids[0] != self.lead:
                return None
            ids = ids[1:]
        return array(self.code, ids).tobytes()


class Pieces:
    """Ids of a sentencepiece model, which adds the leading space itself, and the bytes of each id."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.encoder = _PieceWords(model)
        self.bytes_of = []
        for n in range(model.get_piece_size()):
            piece = model.id_to_piece(n)
            self.bytes_of.append(bytes([int(piece[3:5], 16)]) if model.is_byte(n) else piece.replace(SPACE_MARK, " ").encode())
        self.lengths = _byte_lengths(self.bytes_of)

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        return self.encoder.encode_batch(texts)


_LOADED: dict[tuple[str, str], tuple] = {}  # one for each worker process, so that the memos outlive a task


def _tokenizers(path_a: str, path_b: str) -> tuple:
    if (path_a, path_b) not in _LOADED:
        a, b = ByteLevel(path_a), Pieces(path_b)
        entries = [f"{n}{sep}" for n in range(max(len(a.bytes_of), len(b.bytes_of))) for sep in ",|;"]
        _LOADED[path_a, path_b] = a, b, entries
    return _LOADED[path_a, path_b]


# ----------------------------------------------------------------- merging
def merge_path(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of each diagonal d = i + j: how many of the first d ends in order are of a, how many of b; equal ends: a first."""
    low, high = np.maximum(diagonals - len(b), 0), np.minimum(diagonals, len(a))
    while True:
        at = np.flatnonzero(low < high)
        if not len(at):
            return low, diagonals - low
        mid = (low[at] + high[at]) // 2
        right = a[mid] <= b[diagonals[at] - 1 - mid]
        low[at[right]] = mid[right] + 1
        high[at[~right]] = mid[~right]


def merge_piece(a: np.ndarray, b: np.ndarray, i0: int, i1: int, j0: int, j1: int) -> tuple:
    """Links (A tokens, B tokens, in the order of their ends) and which of the piece's A and B ends are common.

    Token numbers are those of the whole lists; a link may name the token that the next piece ends.
    """
    ends_a, ends_b = a[i0:i1], b[j0:j1]
    b_of = j0 + np.searchsorted(ends_b, ends_a)
    a_of = i0 + np.searchsorted(ends_a, ends_b)
    if i0 and j1 > j0 and a[i0 - 1] == b[j0]:
        a_of[0] = i0 - 1  # the piece before has emitted this end
    common_a = b[b_of] == ends_a
    common_b = a[a_of] == ends_b
    own = np.flatnonzero(~common_b)
    before = np.concatenate([[0], np.cumsum(~common_b)])
    links_a, links_b = np.empty((2, i1 - i0 + len(own)), np.int64)
    at = np.arange(i1 - i0) + before[b_of - j0]
    links_a[at], links_b[at] = np.arange(i0, i1), b_of
    at = before[own] + a_of[own] - i0
    links_a[at], links_b[at] = a_of[own], own + j0
    return links_a, links_b, common_a, common_b


def merge(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> Iterator[tuple]:
    """The pieces of the merge of two strictly ascending lists with the same last end, as ``merge_piece`` gives them."""
    cuts = np.unique(np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b)))
    i, j = merge_path(a, b, cuts)
    for i0, i1, j0, j1 in zip(i[:-1].tolist(), i[1:].tolist(), j[:-1].tolist(), j[1:].tolist()):
        yield merge_piece(a, b, i0, i1, j0, j1)


def _order(common_a: np.ndarray, common_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the A and of the B tokens in the order of groups, A tokens first within each."""
    group_a, group_b = np.cumsum(common_a) - common_a, np.cumsum(common_b) - common_b
    first_b = np.concatenate([[0], np.flatnonzero(common_b) + 1])
    past_a = np.flatnonzero(common_a) + 1
    return np.arange(len(common_a)) + first_b[group_a], np.arange(len(common_b)) + past_a[group_b]


def _packed(codes: np.ndarray) -> bytes:
    """Small numbers byte by significance, compressed."""
    planes = codes.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _joined_equal(tokens, ids: np.ndarray, sizes: np.ndarray, wanted: list[bytes]) -> np.ndarray:
    """Whether each text's tokens join to the wanted bytes."""
    edges = np.concatenate([[0], np.cumsum(sizes)])
    totals = np.concatenate([[0], np.cumsum(tokens.lengths[ids])])[edges]
    every, table = ids.tolist(), tokens.bytes_of.__getitem__
    fits = np.diff(totals) == np.array([len(w) for w in wanted], np.int64)
    for n in np.flatnonzero(fits).tolist():
        fits[n] = b"".join(map(table, every[edges[n]:edges[n + 1]])) == wanted[n]
    return fits


def _block(tokenizers: tuple, keys: list, texts: pa.StringArray, digest: bool, piece: int) -> Iterator[dict]:
    """Rows of a block's pieces; the first one carries the documents."""
    tok_a, tok_b, entries = tokenizers
    texts = texts.fill_null("")
    (ids_a, n_a), (ids_b, n_b) = tok_a.encode(texts), tok_b.encode(texts)
    wanted = [b" " + t.encode() for t in texts.to_pylist()]
    good = _joined_equal(tok_a, ids_a, n_a, wanted) & _joined_equal(tok_b, ids_b, n_b, wanted)
    good &= np.array([len(w) > 1 for w in wanted], bool)
    del wanted
    ids_a, ids_b = ids_a[np.repeat(good, n_a)], ids_b[np.repeat(good, n_b)]
    n_a, n_b = np.where(good, n_a, 0), np.where(good, n_b, 0)
    ends_a, ends_b = np.cumsum(tok_a.lengths[ids_a]), np.cumsum(tok_b.lengths[ids_b])
    from_a, from_b = (np.concatenate([[0], np.cumsum(n)]) for n in (n_a, n_b))
    rows, common_a, common_b = [], [np.zeros(0, bool)], [np.zeros(0, bool)]
    for links_a, links_b, last_a, last_b in merge(ends_a, ends_b, piece):
        pairs, codes, times = np.unique(ids_a[links_a].astype(np.int64) << 32 | ids_b[links_b], return_inverse=True, return_counts=True)
        per_doc = np.diff(np.searchsorted(links_a, from_a))
        places = np.flatnonzero(per_doc)
        rows.append({"pairs": pairs, "times": times, "codes": _packed(codes), "places": places, "links": per_doc[places]})
        common_a.append(last_a)
        common_b.append(last_b)
    common_a, common_b = np.concatenate(common_a), np.concatenate(common_b)  # stitched: groups count on over pieces
    n_groups = np.diff(np.concatenate([[0], np.cumsum(common_a)])[from_a])
    order_a, order_b = _order(common_a, common_b)
    shown = np.empty(len(ids_a) + len(ids_b), np.int64)
    shown[order_a] = ids_a.astype(np.int64) * 3 + common_a
    shown[order_b] = ids_b.astype(np.int64) * 3 + 2 * common_b
    starts = (from_a + from_b).tolist()
    docs = []
    for n, key in enumerate(keys):
        groups = "".join(map(entries.__getitem__, shown[starts[n]:starts[n + 1]].tolist()))[:-1]
        if digest and groups:
            groups = hashlib.sha256(groups.encode()).hexdigest()
        a, b, g = int(n_a[n]), int(n_b[n]), int(n_groups[n])
        docs.append({"id": key, "n_a": a, "n_b": b, "n_groups": g, "n_links": a + b - g, "groups": groups})
    none = {"pairs": [], "times": [], "codes": _packed(np.zeros(0)), "places": [], "links": []}
    for n, row in enumerate(rows or [none]):
        yield row | {"docs": docs if n == 0 else []}


def aligned_pieces(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
                   digest: bool = False, piece: int = PIECE) -> DataFrame:
    """The written table of pieces: distinct id pairs and their counts, every link's pair, and the documents' groups."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema: StructType = _parse_datatype_string(PIECE_FIELDS.format(id=kind))
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers, part, seq = _tokenizers(path_a, path_b), TaskContext.get().partitionId(), 0
        for batch in byte_batches(batches, "text", BLOCK_BYTES):
            block = part << 32 | seq
            for row in _block(tokenizers, batch.column(0).to_pylist(), batch.column(1), digest, piece):
                yield pa.RecordBatch.from_pylist([row | {"piece": part << 32 | seq, "block": block}], schema=arrow)
                seq += 1

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    with small_batches(docs.sparkSession, 4000):
        return materialize(texts.mapInArrow(run, schema), "alignment")


def pair_counts(pieces: DataFrame) -> DataFrame:
    """(pair, count, best): corpus-wide links of each pair of an A id (upper 32 bits) and a B id (lower), and whether no
    pair with the same B id has more."""
    named = pieces.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("p.pairs", "p.times")
    totals = named.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("count"))
    totals = materialize(totals.withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))), "alignment-pairs")
    most = totals.groupBy("b").agg(F.max("count").alias("most"))  # a B id has at most as many pairs as there are A ids
    return totals.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
          digest: bool = False, piece: int = PIECE) -> DataFrame:
    """Per document: (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups).

    ``groups``: A and B ids of every group as ``a1,a2|b1;a3|b2,b3``, or with ``digest`` the SHA-256 of that.
    """
    pieces = aligned_pieces(docs, path_a, path_b, id_col, text_col, digest, piece)
    asked = pieces.select("piece", F.explode("pairs").alias("pair"))
    counted = asked.join(pair_counts(pieces), "pair").groupBy("piece").agg(  # a piece's distinct pairs
        F.sort_array(F.collect_list(F.struct("pair", "count", "best"))).alias("found"))
    both = pieces.join(counted, "piece", "left").select("block", "codes", "places", "links", "docs", F.col("found.count").alias("counts"),
                                                        F.col("found.best").alias("bests"))
    doc = pieces.schema["docs"].dataType.elementType
    out = StructType().add("block", "long").add("place", "long").add("n_best", "long").add("count_sum", "long").add("doc", doc)
    arrow = to_arrow_schema(out)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block, codes, places, links, own, counts, bests = (c[row] for c in batch.columns)
                codes = _unpacked(codes.as_py())
                found = {}
                if len(codes):
                    counts, bests = (c.values.to_numpy(zero_copy_only=False) for c in (counts, bests))
                    starts = np.cumsum(links.values.to_numpy()) - links.values.to_numpy()
                    best = np.add.reduceat(bests.astype(np.int64)[codes], starts).tolist()
                    total = np.add.reduceat(counts[codes], starts).tolist()
                    found = dict(zip(places.as_py(), zip(best, total)))
                docs_here = own.as_py()
                rows = [{"block": block.as_py(), "place": p, "n_best": b, "count_sum": t, "doc": docs_here[p] if docs_here else None}
                        for p, (b, t) in found.items()]
                rows += [{"block": block.as_py(), "place": p, "n_best": 0, "count_sum": 0, "doc": d}
                         for p, d in enumerate(docs_here) if p not in found]
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    with small_batches(docs.sparkSession, 4):
        parts = materialize(both.mapInArrow(sums, out), "alignment-sums")
    whole = parts.groupBy("block", "place").agg(F.first("doc", ignorenulls=True).alias("doc"), F.sum("n_best").alias("n_best"),
                                                F.sum("count_sum").alias("count_sum"))
    return whole.select(F.col("doc.id").alias(id_col), *[f"doc.{c}" for c in ("n_a", "n_b", "n_groups", "n_links")], "n_best",
                        "count_sum", "doc.groups")
