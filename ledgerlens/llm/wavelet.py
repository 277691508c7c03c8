"""A wavelet matrix over token ids as one compressed byte string: access, rank, select, counting, occurrences.

Layout (little-endian): magic, header, JSON directory; then, per bit from the highest, the bit-plane in
blocks of 65,536 bits, each compressed on its own.  The directory holds for every plane the number of
zeros and for every block its place and the ones before it, so a query opens only the blocks it needs.
"""

from __future__ import annotations

import json
import struct
from functools import lru_cache

import numpy as np

MAGIC = b"LWVM0001"
BLOCK = 1 << 16
_HEAD = struct.Struct("<8sQIQ")  # magic, tokens, bits, bytes of the directory


def _parted(plane: np.ndarray) -> np.ndarray:
    """Positions of the zeros, then of the ones: by list, as masks over bits without a pattern are slow to follow."""
    return np.concatenate([np.flatnonzero(~plane), np.flatnonzero(plane)])


def build(ids: np.ndarray) -> bytes:
    """The file of a sequence of non-negative ids."""
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=3)
    bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    values = ids.astype(np.uint16 if bits <= 16 else np.uint32)
    planes, body, at = [], [], 0
    for level in range(bits - 1, -1, -1):
        plane = (values & values.dtype.type(1 << level)) != 0
        ones, before, places = 0, [], []
        for begin in range(0, len(plane), BLOCK):
            part = plane[begin : begin + BLOCK]
            packed = squeeze.compress(np.packbits(part).tobytes())
            before.append(ones)
            places.append(at)
            ones += int(part.sum())
            at += len(packed)
            body.append(packed)
        planes.append({"zeros": len(plane) - ones, "before": before, "places": places})
        values = values[_parted(plane)]
    directory = json.dumps({"planes": planes, "end": at}, separators=(",", ":")).encode()
    return b"".join([_HEAD.pack(MAGIC, len(ids), bits, len(directory)), directory, *body])


class WaveletFile:
    """Queries on one file."""

    def __init__(self, data: bytes):
        magic, self.length, self.bits, size = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a wavelet file")
        start = _HEAD.size + size
        directory = json.loads(data[_HEAD.size : start])
        self.planes, self.body = directory["planes"], memoryview(data)[start:]
        self.block = lru_cache(maxsize=64)(self._block)
        flat = [p for plane in self.planes for p in plane["places"]]
        self.ends = dict(zip(flat, [*flat[1:], directory["end"]]))

    def _block(self, level: int, number: int) -> np.ndarray:
        import zstandard

        place = self.planes[level]["places"][number]
        raw = zstandard.ZstdDecompressor().decompress(bytes(self.body[place : self.ends[place]]))
        size = min(BLOCK, self.length - number * BLOCK)
        return np.unpackbits(np.frombuffer(raw, np.uint8), count=size)

    def _ones(self, level: int, at: int) -> int:
        """Ones of a plane before position ``at``."""
        number, inside = divmod(at, BLOCK)
        if number == len(self.planes[level]["before"]):
            return self.length - self.planes[level]["zeros"]
        return self.planes[level]["before"][number] + int(self.block(level, number)[:inside].sum())

    def _step(self, level: int, bit: int, at: int) -> int:
        ones = self._ones(level, at)
        return self.planes[level]["zeros"] + ones if bit else at - ones

    def access(self, at: int) -> int:
        """The id at a position."""
        if not 0 <= at < self.length:
            raise IndexError(at)
        value = 0
        for level in range(self.bits):
            bit = int(self.block(level, at // BLOCK)[at % BLOCK])
            value = value << 1 | bit
            at = self._step(level, bit, at)
        return value

    def _range(self, token: int, begin: int, end: int) -> tuple[int, int]:
        if token < 0 or token >> self.bits:
            return 0, 0
        for level in range(self.bits):
            bit = token >> (self.bits - 1 - level) & 1
            begin, end = self._step(level, bit, begin), self._step(level, bit, end)
        return begin, end

    def count(self, token: int, begin: int = 0, end: int | None = None) -> int:
        """How often ``token`` stands in positions begin ≤ p < end."""
        lo, hi = self._range(token, begin, self.length if end is None else end)
        return hi - lo

    def select(self, token: int, k: int) -> int:
        """Position of the k-th occurrence (from 0)."""
        lo, hi = self._range(token, 0, self.length)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        at = lo + k
        for level in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - level) & 1
            at = self._nth(level, bit, at - self.planes[level]["zeros"] if bit else at)
        return at

    def _nth(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th ``bit`` of a plane."""
        before = np.array(self.planes[level]["before"])
        if not bit:
            before = np.arange(len(before)) * BLOCK - before
        number = int(np.searchsorted(before, k, side="right")) - 1
        return number * BLOCK + int(np.flatnonzero(self.block(level, number) == bit)[k - int(before[number])])

    def occurrences(self, token: int, begin: int = 0, end: int | None = None) -> list[int]:
        """Positions of ``token`` in begin ≤ p < end."""
        first = self.count(token, 0, begin)
        return [self.select(token, first + i) for i in range(self.count(token, begin, end))]

    def all(self) -> np.ndarray:
        """The whole sequence, by undoing the partitions from the last plane to the first."""
        out = np.zeros(self.length, np.uint16 if self.bits <= 16 else np.uint32)
        for level in range(self.bits - 1, -1, -1):
            parts = [self._block(level, i) for i in range(len(self.planes[level]["places"]))]
            plane = np.concatenate(parts).view(bool) if parts else np.zeros(0, bool)
            out[self.planes[level]["zeros"]:] |= out.dtype.type(1 << (self.bits - 1 - level))
            before = np.empty_like(out)
            before[_parted(plane)] = out
            out = before
        return out.astype(np.uint32)
