"""A sequence of small numbers as a wavelet matrix.

One bit-plane per bit of a symbol, highest first; after each plane the sequence
is parted stably into the symbols with a zero and those with a one there.  Ones
before a place are counted from the counts at every 512th bit and the bits after
it, so access, counting and finding take one step per plane.
"""

from __future__ import annotations

import struct

import numpy as np
import zstandard

MAGIC = b"FLWM\x01\n"
BLOCK_WORDS = 8


def pack(data: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(data).tobytes())


def unpack(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


class Plane:
    """A bit sequence with rank and select."""

    def __init__(self, words: np.ndarray, size: int, counts: np.ndarray | None = None):
        self.words, self.size = words, size
        if counts is None:
            per_block = np.add.reduceat(np.bitwise_count(words).astype(np.int64), np.arange(0, len(words), BLOCK_WORDS)) if len(words) else []
            counts = np.r_[0, np.cumsum(per_block)].astype(np.int64)
        self.counts = counts
        self.ones = int(counts[-1])

    @classmethod
    def of(cls, flags: np.ndarray) -> Plane:
        data = np.packbits(flags, bitorder="little")
        return cls(np.frombuffer(data.tobytes() + bytes(-len(data) % 8), np.uint64), len(flags))

    def flags(self) -> np.ndarray:
        return np.unpackbits(self.words.view(np.uint8), count=self.size, bitorder="little").astype(bool)

    def bit(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        block = at >> 9
        total = self.counts[block]
        first = block * BLOCK_WORDS
        for k in range(BLOCK_WORDS):
            word = first + k
            bits = np.clip(at - (word << 6), 0, 64)
            inside = bits > 0
            mask = np.where(bits == 64, ~np.uint64(0), (np.uint64(1) << (bits % 64).astype(np.uint64)) - np.uint64(1))
            total = total + np.where(inside, np.bitwise_count(self.words[np.minimum(word, len(self.words) - 1)] & mask), 0)
        return total

    def select(self, which: np.ndarray, one: bool) -> np.ndarray:
        """Places of the ``which``-th ones or zeros, from 0, by bisection on the rank."""
        low, high = np.zeros(len(which), np.int64), np.full(len(which), self.size, np.int64)
        while (low < high).any():
            middle = (low + high) >> 1
            ones = self.rank(middle + 1)
            enough = (ones if one else middle + 1 - ones) > which
            high = np.where(enough & (low < high), middle, high)
            low = np.where(~enough & (low < high), middle + 1, low)
        return low


class WaveletMatrix:
    def __init__(self, planes: list[Plane], size: int):
        self.planes, self.size, self.bits = planes, size, len(planes)
        self.zeros = [size - p.ones for p in planes]

    @classmethod
    def of(cls, symbols: np.ndarray, bits: int) -> WaveletMatrix:
        planes = []
        for b in range(bits - 1, -1, -1):
            flags = (symbols & symbols.dtype.type(1 << b)).astype(bool)
            planes.append(Plane.of(flags))
            symbols = np.concatenate([symbols.compress(~flags), symbols.compress(flags)])
        return cls(planes, len(symbols))

    def all(self, kind=np.uint32) -> np.ndarray:
        """The whole sequence: the partings undone from the last plane up."""
        values = np.zeros(self.size, kind)
        for b, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros))):
            flags = plane.flags()
            before = np.empty_like(values)
            before[~flags] = values[:zeros]
            before[flags] = values[zeros:] | kind(1 << b)
            values = before
        return values

    def access(self, at) -> np.ndarray:
        at = np.atleast_1d(np.asarray(at, np.int64))
        value = np.zeros(len(at), np.int64)
        for plane, zeros in zip(self.planes, self.zeros):
            one = plane.bit(at)
            ones = plane.rank(at)
            at = np.where(one, zeros + ones, at - ones)
            value = (value << 1) | one
        return value

    def span(self, symbol: int, begin: int, end: int) -> tuple[int, int]:
        """Where the symbol's occurrences in a range lie after the last parting."""
        if symbol >> self.bits:
            return 0, 0
        ends = np.array([begin, end], np.int64)
        for k, (plane, zeros) in enumerate(zip(self.planes, self.zeros)):
            ones = plane.rank(ends)
            ends = zeros + ones if symbol >> (self.bits - 1 - k) & 1 else ends - ones
        return int(ends[0]), int(ends[1])

    def count(self, symbol: int, begin: int = 0, end: int | None = None) -> int:
        low, high = self.span(symbol, begin, self.size if end is None else end) if self.size else (0, 0)
        return high - low

    def find(self, symbol: int, begin: int = 0, end: int | None = None) -> np.ndarray:
        """Places of all occurrences in a range, in order."""
        if not self.size:
            return np.zeros(0, np.int64)
        low, high = self.span(symbol, begin, self.size if end is None else end)
        at = np.arange(low, high, dtype=np.int64)
        for k in range(self.bits - 1, -1, -1):
            one = bool(symbol >> (self.bits - 1 - k) & 1)
            at = self.planes[k].select(at - self.zeros[k] if one else at, one)
        return at


def to_bytes(ids: np.ndarray, ends: np.ndarray, matrix: WaveletMatrix, missing: np.ndarray) -> bytes:
    """A file: magic, sizes, lengths of the sections, sections (document ids, which are null, ends, planes), each compressed."""
    sections = [pack(ids.astype(np.int64)), pack(missing.astype(np.uint8)), pack(ends.astype(np.int64))]
    for plane in matrix.planes:
        sections += [pack(plane.words), pack(plane.counts)]
    lengths = np.array([len(s) for s in sections], np.int64)
    return b"".join([MAGIC, struct.pack("<qqqq", len(ids), matrix.size, matrix.bits, len(sections)), lengths.tobytes(), *sections])


HEADER = len(MAGIC) + 32


def header(data: bytes) -> tuple[int, int, int, int]:
    """Documents, symbols, bits and sections of a file, from its first ``HEADER`` bytes."""
    if data[:len(MAGIC)] != MAGIC:
        raise ValueError("not a wavelet matrix file")
    return struct.unpack("<qqqq", data[len(MAGIC):HEADER])


def from_bytes(data: bytes) -> tuple[np.ndarray, np.ndarray, WaveletMatrix, np.ndarray]:
    _, size, bits, count = header(data)
    lengths = np.frombuffer(data[HEADER:HEADER + 8 * count], np.int64)
    starts = HEADER + 8 * count + np.r_[0, np.cumsum(lengths)]
    section = lambda k, kind: unpack(data[starts[k]:starts[k + 1]], kind)
    planes = [Plane(section(3 + 2 * k, np.uint64), size, section(4 + 2 * k, np.int64)) for k in range(bits)]
    return section(0, np.int64), section(2, np.int64), WaveletMatrix(planes, size), section(1, np.uint8).astype(bool)
