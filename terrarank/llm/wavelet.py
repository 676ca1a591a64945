"""Wavelet matrix over a token sequence: bit-planes with rank and select in one block of bytes.

Plane by plane (highest bit first) the sequence is split stably into zeros and
ones. Access, rank, count and select of any token take one rank or select per
plane. The block holds, after a fixed header, for each plane its zero count, a
running count of ones for every 512 bits, and the packed bits.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"WMX1"
HEADER = struct.Struct("<4sIQ")  # magic, planes, length
BLOCK = 512  # bits


class WaveletMatrix:
    """Immutable; positions and results are numpy integer arrays."""

    def __init__(self, length: int, zeros: list[int], counts: list[np.ndarray], planes: list[np.ndarray]):
        self.length, self.zeros, self.counts, self.planes = length, zeros, counts, planes

    @classmethod
    def build(cls, ids: np.ndarray, width: int) -> WaveletMatrix:
        n, seq = len(ids), ids
        zeros, counts, planes = [], [], []
        for k in range(width - 1, -1, -1):
            bit = (seq & seq.dtype.type(1 << k)) != 0
            packed = np.zeros(-(-n // BLOCK) * (BLOCK // 8), dtype=np.uint8)
            packed[:-(-n // 8)] = np.packbits(bit, bitorder="little")
            ones = np.bitwise_count(packed.view(np.uint64)).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.uint32)
            counts.append(np.concatenate([np.zeros(1, np.uint32), np.cumsum(ones, dtype=np.uint32)]))
            planes.append(packed)
            low, high = np.flatnonzero(~bit), np.flatnonzero(bit)  # far faster to index with than the bits
            zeros.append(len(low))
            seq = np.concatenate([seq[low], seq[high]])
        return cls(n, zeros, counts, planes)

    def to_bytes(self) -> bytes:
        out = [HEADER.pack(MAGIC, len(self.planes), self.length)]
        for z, c, p in zip(self.zeros, self.counts, self.planes):
            out += [struct.pack("<Q", z), c.astype("<u4").tobytes(), p.tobytes()]
        return b"".join(out)

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        magic, width, n = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a wavelet matrix block")
        blocks, at = -(-n // BLOCK), HEADER.size
        zeros, counts, planes = [], [], []
        for _ in range(width):
            zeros.append(struct.unpack_from("<Q", data, at)[0])
            counts.append(np.frombuffer(data, "<u4", blocks + 1, at + 8))
            planes.append(np.frombuffer(data, np.uint8, blocks * BLOCK // 8, at + 8 + 4 * (blocks + 1)))
            at += 8 + 4 * (blocks + 1) + blocks * BLOCK // 8
        return cls(n, zeros, counts, planes)

    def _ones(self, k: int, pos: np.ndarray) -> np.ndarray:
        """Ones of plane ``k`` before each position."""
        block, rest = pos // BLOCK, pos % BLOCK
        out = self.counts[k][block].astype(np.int64)
        words = np.append(self.planes[k].view(np.uint64), np.zeros(BLOCK // 64, np.uint64))
        for j in range(BLOCK // 64):
            take = np.clip(rest - 64 * j, 0, 64)
            mask = np.where(take == 64, ~np.uint64(0), (np.uint64(1) << (take % 64).astype(np.uint64)) - np.uint64(1))
            out += np.bitwise_count(words[block * (BLOCK // 64) + j] & mask)
        return out

    def _select(self, k: int, one: bool, nth: np.ndarray) -> np.ndarray:
        """Position in plane ``k`` of the ``nth`` (from 0) one or zero."""
        counts = self.counts[k].astype(np.int64)
        if not one:
            counts = np.arange(len(counts)) * BLOCK - counts
        block = np.searchsorted(counts, nth, side="right") - 1
        bits = np.unpackbits(self.planes[k].reshape(-1, BLOCK // 8)[block], axis=1, bitorder="little")
        seen = np.cumsum(bits == one, axis=1, dtype=np.int32)
        return block * BLOCK + (seen > (nth - counts[block])[:, None]).argmax(axis=1)

    def access(self, pos) -> np.ndarray:
        """Tokens at the positions."""
        pos = np.atleast_1d(np.asarray(pos, dtype=np.int64))
        out = np.zeros(len(pos), dtype=np.int64)
        for k in range(len(self.planes)):
            bit = (self.planes[k][pos // 8] >> (pos % 8).astype(np.uint8)) & 1
            ones = self._ones(k, pos)
            pos = np.where(bit, self.zeros[k] + ones, pos - ones)
            out = out << 1 | bit
        return out

    def _range(self, token: int, end: int) -> tuple[int, int]:
        lo, hi = np.array([0]), np.array([end])
        for k in range(len(self.planes)):
            a, b = self._ones(k, lo), self._ones(k, hi)
            if token >> (len(self.planes) - 1 - k) & 1:
                lo, hi = self.zeros[k] + a, self.zeros[k] + b
            else:
                lo, hi = lo - a, hi - b
        return int(lo[0]), int(hi[0])

    def rank(self, token: int, end: int) -> int:
        """Occurrences of the token before position ``end``."""
        if token >> len(self.planes) or not self.length:
            return 0
        lo, hi = self._range(token, end)
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.length)

    def occurrences(self, token: int) -> np.ndarray:
        """All positions of the token, ascending."""
        if token >> len(self.planes) or not self.length:
            return np.zeros(0, np.int64)
        pos = np.arange(*self._range(token, self.length))
        if len(pos):
            for k in range(len(self.planes) - 1, -1, -1):
                one = bool(token >> (len(self.planes) - 1 - k) & 1)
                pos = self._select(k, one, pos - self.zeros[k] if one else pos)
        return pos

    def decode(self) -> np.ndarray:
        """The whole sequence: the stable splits are undone from the last plane up."""
        n, width = self.length, len(self.planes)
        seq = np.zeros(n, dtype=np.uint16 if width <= 16 else np.uint32)
        for k in range(width - 1, -1, -1):
            bit = np.unpackbits(self.planes[k], count=n, bitorder="little").view(bool)
            out = np.empty_like(seq)
            out[np.flatnonzero(~bit)] = seq[:self.zeros[k]]
            out[np.flatnonzero(bit)] = seq[self.zeros[k]:] | seq.dtype.type(1 << (width - 1 - k))
            seq = out
        return seq
