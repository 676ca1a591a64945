"""Token-id output: documents in id order, encoded and kept as wavelet matrix shards.

Rows are range-partitioned and sorted by document id, encoded by a public
tokenizer, and gathered into shards of whole documents. A shard is one row of
the written table: the ids of its documents and one block of bytes with the
documents' lengths, the token ids in use, and a wavelet matrix of all the
documents' tokens (as places among the ids in use), the end id included. Spark's committed writer makes the files, so a retried task leaves
no half shard behind.

Pre-tokens of the byte-level tokenizer never reach over a single space between
two other characters, so a text whose spaces all stand so is encoded piece by
piece through a bounded memo; every other text, and any with the opening of a
special token, goes through the tokenizer whole.

Cases: a null or empty text is the end id alone; null ids come first;
rows with equal ids are ordered by their text's hash (equal rows are
interchangeable); an empty table gives empty files and no rows; other columns
are not read. A document longer than a shard makes a longer shard.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from terrarank.llm.common import byte_batches, small_batches, texts_of
from terrarank.llm.wavelet import WaveletMatrix

SHARD_SCHEMA = "part int, seq int, start_in_part long, n_tokens long, doc_ids array<long>, block binary"
#: Opening of the special tokens.
SPECIAL = "<|"
FIRST = "\0"  # stands before the first word of a text; a text that has it is encoded whole
MEMO = 500_000  # words
GATHER = 1 << 17  # words put together at once
#: Marks that may follow a word as a pre-token of their own; letters below this character are letters to every library.
MARKS = tuple(".,;:!?")
LATIN_END = "\u0250"
# The byte-level alphabet: printable characters stand for their byte, the others are moved behind 255 in order.
_PRINTED = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_MOVED = {byte: 256 + n for n, byte in enumerate(sorted({*range(256)} - _PRINTED))}
BYTE_CHARS = [chr(_MOVED.get(byte, byte)) for byte in range(256)]

_ENCODERS: dict[tuple[str, bool], Encoder] = {}  # one for each worker process, so that the memo outlives a task


def encoder_for(path: str, special_as_text: bool = True) -> Encoder:
    if (path, special_as_text) not in _ENCODERS:
        _ENCODERS[path, special_as_text] = Encoder(path, special_as_text)
    return _ENCODERS[path, special_as_text]


class Encoder:
    """Token ids of whole batches of texts, by way of their distinct words and a bounded memo of words."""

    def __init__(self, path: str, special_as_text: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.tokenizer.encode_special_tokens = special_as_text  # False, the library's default: their strings are tokens
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.code, self.dtype = ("H", np.dtype("<u2")) if size <= 1 << 16 else ("I", np.dtype("<u4"))
        self.marks = {m: self.whole(m) for m in MARKS}
        self.line_break = self.whole("\n")
        # the memo: words, and where each one's ids stand in one array; -1 ids for words that need their context
        self.words = pa.array([], pa.string())
        self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, self.dtype)

    def whole(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _letters(self, text: str) -> bytes:
        """Ids of letters with at most one space before them: one pre-token, given to the model as it is."""
        found = self.model.tokenize("".join(map(BYTE_CHARS.__getitem__, text.encode())))
        return array(self.code, [t.id for t in found]).tobytes()

    def word(self, word: str) -> bytes | None:
        """Ids of a space and the word, of a line break and the word after it, or of a text's first word.

        None where white space at the word's ends, or a special token, needs the context.
        """
        before = word[:1] if word[:1] in ("\n", FIRST) else " "
        body = word if before == " " else word[1:]
        head = "" if before == FIRST else before
        core = body[:-1] if body[-1:] in MARKS else body
        if core.isalpha() and (core.isascii() or max(core) < LATIN_END):
            found = (self.line_break if before == "\n" else b"") + self._letters(core if before == "\n" else head + core)
            return found + self.marks[body[-1]] if core is not body else found
        if not body:
            return b"" if before == FIRST else None
        if body[-1].isspace() or body[0].isspace() and before != FIRST or SPECIAL in body:
            return None
        return self.whole(head + body)

    def _places(self, words: pa.StringArray) -> np.ndarray:
        """Places of distinct words in the memo, which takes up those it lacks; over MEMO words it keeps these alone."""
        at = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy().copy()
        new = np.flatnonzero(at < 0)
        if len(new):
            if len(self.words) + len(new) > MEMO:
                old = np.flatnonzero(at >= 0)
                self.ids = _gather(self.ids, self.size, at[old])[0]
                self.words, self.size = words.take(pa.array(old)), self.size[at[old]]
                at[old] = np.arange(len(old))
            missing = words.take(pa.array(new))
            found = list(map(self.word, missing.to_pylist()))
            at[new] = len(self.words) + np.arange(len(new))
            self.words = pa.concat_arrays([self.words, missing])
            step = self.dtype.itemsize
            self.size = np.concatenate([self.size, np.array([-1 if f is None else len(f) // step for f in found], np.int64)])
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(f or b"" for f in found), self.dtype)])
        return at

    def encode_batch(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, ids of each text)."""
        texts = texts.fill_null("")
        spaced = pc.binary_join_element_wise(FIRST, pc.replace_substring(texts, "\n", " \n"), "")
        parts = pc.split_pattern(spaced, " ")
        coded = parts.flatten().dictionary_encode()
        at = self._places(coded.dictionary)[coded.indices.to_numpy()]
        edges = parts.offsets.to_numpy()
        edges = edges - edges[0]
        del spaced, parts, coded
        pa.default_memory_pool().release_unused()
        hard = self.size[at] < 0
        ids, ends = _gather(self.ids, self.size, at)
        bounds = np.concatenate([[0], ends])[edges]
        lengths = np.diff(bounds)
        redo = pc.match_substring(texts, FIRST).to_numpy(zero_copy_only=False)
        if hard.any():
            redo = redo | (np.diff(np.concatenate([[0], np.cumsum(hard)])[edges]) > 0)
        if redo.any():
            own = [np.frombuffer(self.whole(texts[n].as_py()), self.dtype) if redo[n] else ids[a:b]
                   for n, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist()))]
            ids, lengths = np.concatenate(own), np.array([len(o) for o in own], np.int64)
        return ids, lengths


def _gather(ids: np.ndarray, size: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the words at the places, one after the other, and where each one's end; in blocks of places."""
    size = np.maximum(size, 0)
    begin = np.cumsum(size) - size
    ends = np.cumsum(size[at])
    out = np.empty(ends[-1] if len(ends) else 0, ids.dtype)
    done = 0
    for k in range(0, len(at), GATHER):
        part = at[k:k + GATHER]
        own = size[part]
        n = int(own.sum())
        shift = np.repeat(begin[part] - (np.cumsum(own) - own), own)
        shift += np.arange(n)
        out[done:done + n] = ids[shift]
        done += n
    return out, ends


class Shard:
    """Whole documents' ids: their lengths, the ids in use (ascending), and a wavelet matrix of places among these."""

    def __init__(self, lengths: np.ndarray, alphabet: np.ndarray, matrix: WaveletMatrix):
        self.lengths, self.alphabet, self.matrix = lengths, alphabet, matrix

    @classmethod
    def build(cls, ids: np.ndarray, lengths: list[int]) -> Shard:
        used = np.bincount(ids) > 0
        alphabet = np.flatnonzero(used).astype(np.uint32)
        place = (np.cumsum(used) - 1).astype(ids.dtype)
        width = max(1, (len(alphabet) - 1).bit_length())
        return cls(np.array(lengths, np.int64), alphabet, WaveletMatrix.build(place[ids], width))

    def to_bytes(self) -> bytes:
        head = struct.pack("<QQ", len(self.lengths), len(self.alphabet))
        return head + self.lengths.astype("<u8").tobytes() + self.alphabet.astype("<u4").tobytes() + self.matrix.to_bytes()

    @classmethod
    def from_bytes(cls, block: bytes) -> Shard:
        docs, used = struct.unpack_from("<QQ", block)
        at = 16 + 8 * docs + 4 * used
        return cls(np.frombuffer(block, "<u8", docs, 16).astype(np.int64), np.frombuffer(block, "<u4", used, 16 + 8 * docs),
                   WaveletMatrix.from_bytes(memoryview(block)[at:]))

    def decode(self) -> np.ndarray:
        return self.alphabet[self.matrix.decode()]

    def access(self, places) -> np.ndarray:
        return self.alphabet[self.matrix.access(places)]

    def _place(self, token: int) -> int:
        at = int(np.searchsorted(self.alphabet, token))
        return at if at < len(self.alphabet) and self.alphabet[at] == token else 1 << 32  # in no matrix

    def count(self, token: int) -> int:
        return self.matrix.count(self._place(token))

    def occurrences(self, token: int) -> np.ndarray:
        return self.matrix.occurrences(self._place(token))


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text", shard_tokens: int = 1 << 19, special_as_text: bool = True) -> None:
    """Write the documents as token shards in ascending id order.

    ``special_as_text``: special tokens' strings in a text are ordinary text; otherwise they get their own ids.
    """
    ordered = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
               .repartitionByRange("id").sortWithinPartitions("id", F.xxhash64("text")).select("id", "text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = encoder_for(tokenizer, special_as_text), TaskContext.get().partitionId()
        end = np.array([end_id], encoder.dtype)
        ids, pieces, lengths, held, seq, start = [], [], [], 0, 0, 0
        schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("start_in_part", pa.int64()),
                            ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("block", pa.binary())])

        def shard() -> pa.RecordBatch:
            row = {"part": part, "seq": seq, "start_in_part": start, "n_tokens": held, "doc_ids": ids,
                   "block": Shard.build(np.concatenate(pieces), lengths).to_bytes()}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in byte_batches(batches, "text", 12 << 20):
            found, sizes = encoder.encode_batch(batch.column(1))
            at = 0
            for key, n in zip(batch.column(0).to_pylist(), sizes.tolist()):
                ids.append(key)
                pieces += [found[at:at + n], end]
                lengths.append(n + 1)
                at += n
                held += n + 1
                if held >= shard_tokens:
                    yield shard()
                    ids, pieces, lengths, held, seq, start = [], [], [], 0, seq + 1, start + held
        if ids:
            yield shard()

    with small_batches(docs.sparkSession, 4000):
        ordered.mapInArrow(encode, SHARD_SCHEMA).write.option("compression", "zstd").parquet(path)


def read_tokens(spark: SparkSession, path: str, per_doc: Callable[[np.ndarray], dict], fields: list[tuple],
                schema: str) -> DataFrame:
    """Read shards back: (doc_id, start, n_tokens) and what ``per_doc`` makes of each document's ids.

    ``start`` counts the ids of all documents before it: a running sum within
    the writing task, plus the sums of the tasks before (one row per task).
    """
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    sums = shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()  # one row per writing task
    offsets, total = {}, 0
    for r in sorted(sums, key=lambda r: r.part):
        offsets[r.part], total = total, total + r.n

    arrow = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), *fields])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, start, ids, block = (batch.column(k)[row].as_py() for k in range(4))
                shard = Shard.from_bytes(block)
                seq, ends = shard.decode(), np.cumsum(shard.lengths)
                begins = ends - shard.lengths
                out = [{"doc_id": key, "start": offsets[part] + start + int(b), "n_tokens": int(e - b)} | per_doc(seq[b:e])
                       for key, b, e in zip(ids, begins, ends)]
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return shards.select("part", "start_in_part", "doc_ids", "block").mapInArrow(
        decode, f"doc_id long, start long, n_tokens long, {schema}")


def _crc(ids: np.ndarray) -> dict:
    return {"ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())}


def _list(ids: np.ndarray) -> dict:
    return {"ids": ids.astype(np.int32)}


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document written under ``path``."""
    return read_tokens(spark, path, _list, [("ids", pa.list_(pa.int32()))], "ids array<int>")


def read_token_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): the checksum of the ids read back, as 32-bit little-endian integers."""
    return read_tokens(spark, path, _crc, [("ids_crc32", pa.int64())], "ids_crc32 long")


def count_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """(part, seq, n, positions): occurrences of one token in each shard, looked up without decoding it."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, seq, start, block = (batch.column(k)[row].as_py() for k in range(4))
                shard = Shard.from_bytes(block)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                    "n": pa.array([shard.count(token)], pa.int64()),
                    "positions": pa.array([start + shard.occurrences(token)], pa.list_(pa.int64()))})

    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    return shards.select("part", "seq", "start_in_part", "block").mapInArrow(
        look, "part int, seq int, n long, positions array<long>")
