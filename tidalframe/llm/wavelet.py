"""Wavelet matrix over token ids: bit-planes with rank and select, and a shard file of them.

A symbol is first replaced by its place among the symbols that occur, so the number of
planes follows the symbols in use. Plane k holds bit k (highest first) of all symbols in
the order reached so far; the symbols are then parted stably, zeros first.
"""

from __future__ import annotations

import struct

import numpy as np

# Bits whose ones are counted together in the rank directory.
WORD = 64


class Plane:
    """Bits with rank and select."""

    def __init__(self, packed: np.ndarray, n: int):
        self.n, self.packed = n, packed
        padded = np.zeros(-(-max(n, 1) // WORD) * 8 + 8, np.uint8)
        padded[: len(packed)] = packed
        self.words = padded.view(">u8").astype(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.ones = int(self.before[-1])

    def bits(self) -> np.ndarray:
        return np.unpackbits(self.packed, count=self.n).astype(bool)

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i // WORD] >> (np.uint64(WORD - 1) - (i % WORD).astype(np.uint64))) & np.uint64(1)).astype(bool)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each position i (0 to n)."""
        word, bit = i // WORD, (i % WORD).astype(np.uint64)
        high = np.where(bit > 0, self.words[word] >> (np.uint64(WORD) - np.maximum(bit, np.uint64(1))), np.uint64(0))
        return self.before[word] + np.bitwise_count(high)

    def select(self, j: int, one: bool) -> int:
        """Position of the j-th (from 0) one or zero."""
        lo, hi = 0, self.n
        while lo < hi:
            mid = (lo + hi) // 2
            ones = int(self.rank(np.array([mid + 1]))[0])
            if (ones if one else mid + 1 - ones) > j:
                hi = mid
            else:
                lo = mid + 1
        return lo


class WaveletMatrix:
    """Access, rank, select and count over a sequence of ids."""

    def __init__(self, symbols: np.ndarray, planes: list[Plane], n: int):
        self.symbols, self.planes, self.n = symbols, planes, n
        self.zeros = [n - p.ones for p in planes]

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        top = int(ids.max()) + 1 if len(ids) else 0
        symbols = np.flatnonzero(np.bincount(ids, minlength=top)) if top <= 1 << 22 else np.unique(ids)
        if top <= 1 << 22:
            place = np.zeros(max(top, 1), np.uint32)
            place[symbols] = np.arange(len(symbols), dtype=np.uint32)
            rest = place[ids]
        else:
            rest = np.searchsorted(symbols, ids).astype(np.uint32)
        if len(symbols) <= 1 << 16:
            rest = rest.astype(np.uint16)
        planes = []
        for k in reversed(range(max(1, int(len(symbols) - 1).bit_length()))):
            bit = (rest >> k) & 1 != 0
            planes.append(Plane(np.packbits(bit), len(rest)))
            rest = np.concatenate([np.compress(~bit, rest), np.compress(bit, rest)])
        return cls(symbols, planes, len(ids))

    def decode(self) -> np.ndarray:
        """All ids: the parting of each plane undone, from the last one up."""
        value = np.zeros(self.n, np.uint32 if len(self.symbols) > 1 << 16 else np.uint16)
        for k, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros), strict=True)):
            bit, above = plane.bits(), np.empty_like(value)
            above[np.flatnonzero(~bit)] = value[:zeros]
            above[np.flatnonzero(bit)] = value[zeros:] | (1 << k)
            value = above
        return self.symbols[value] if self.n else np.zeros(0, np.int64)

    def access(self, i: np.ndarray) -> np.ndarray:
        """Ids at positions."""
        i, value = np.asarray(i, np.int64), np.zeros(len(i), np.int64)
        for plane, zeros in zip(self.planes, self.zeros, strict=True):
            bit, ones = plane.get(i), plane.rank(i)
            i = np.where(bit, zeros + ones, i - ones)
            value = (value << 1) | bit
        return self.symbols[value]

    def code(self, ids: np.ndarray) -> np.ndarray:
        """Places of ids among the symbols, -1 for those that do not occur."""
        at = np.searchsorted(self.symbols, ids)
        inside = at < len(self.symbols)
        return np.where(inside & (self.symbols[np.minimum(at, max(len(self.symbols) - 1, 0))] == ids), at, -1) if len(self.symbols) else np.full(len(ids), -1)

    def ranks(self, codes: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often symbol number ``codes[k]`` occurs before position ``i[k]``."""
        start = np.zeros(len(i), np.int64)
        for k, (plane, zeros) in zip(reversed(range(len(self.planes))), zip(self.planes, self.zeros, strict=True), strict=True):
            bit = (codes >> k) & 1 != 0
            a, b = plane.rank(start), plane.rank(i)
            start, i = np.where(bit, zeros + a, start - a), np.where(bit, zeros + b, i - b)
        return i - start

    def rank(self, token: int, i: int) -> int:
        code = self.code(np.array([token]))
        return int(self.ranks(code, np.array([i]))[0]) if code[0] >= 0 else 0

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, j: int) -> int:
        """Position of the j-th (from 0) occurrence of a token."""
        code = int(self.code(np.array([token]))[0])
        if code < 0 or j >= self.count(token):
            raise IndexError("no such occurrence")
        start = np.zeros(1, np.int64)
        for k, (plane, zeros) in zip(reversed(range(len(self.planes))), zip(self.planes, self.zeros, strict=True), strict=True):
            a = plane.rank(start)
            start = zeros + a if code >> k & 1 else start - a
        at = int(start[0]) + j
        for k, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros), strict=True)):
            at = plane.select(at - zeros, True) if code >> k & 1 else plane.select(at, False)
        return at


# A block: number of ids, of symbols and of planes, size of the compressed symbol list
# and of each compressed plane, then these.
HEAD = struct.Struct("<QIHI")


def block_bytes(ids: np.ndarray, level: int = 1) -> bytes:
    import zstandard

    matrix, squeeze = WaveletMatrix.build(ids), zstandard.ZstdCompressor(level=level).compress
    symbols = squeeze(np.diff(matrix.symbols, prepend=0).astype("<u4").tobytes())
    planes = [squeeze(p.packed.tobytes()) for p in matrix.planes]
    return HEAD.pack(matrix.n, len(matrix.symbols), len(planes), len(symbols)) + struct.pack(f"<{len(planes)}I", *map(len, planes)) + symbols + b"".join(planes)


def block_matrix(data: memoryview) -> WaveletMatrix:
    import zstandard

    n, n_symbols, n_planes, size = HEAD.unpack_from(data, 0)
    sizes, at = struct.unpack_from(f"<{n_planes}I", data, HEAD.size), HEAD.size + 4 * n_planes
    open_up = zstandard.ZstdDecompressor().decompress
    symbols = np.cumsum(np.frombuffer(open_up(data[at : at + size]), "<u4").astype(np.int64))
    at, planes = at + size, []
    for size in sizes:
        planes.append(Plane(np.frombuffer(open_up(data[at : at + size]), np.uint8), n))
        at += size
    if len(symbols) != n_symbols:
        raise ValueError("damaged block")
    return WaveletMatrix(symbols, planes, n)
