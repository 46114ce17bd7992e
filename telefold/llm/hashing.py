"""64-bit hashes of many substrings at once, in numpy."""

from __future__ import annotations

import functools

import numpy as np

from .held import for_task

BASE = np.uint64(0xD6E8FEB86659FD93)
TABLE = 1 << 20  # powers kept for runs of at most so many bytes; longer runs get their own


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    both = []
    for b in (BASE, np.uint64(pow(int(BASE), -1, 1 << 64))):
        steps = np.full(n, b, np.uint64)
        steps[:1] = 1
        both.append(np.multiply.accumulate(steps))
    return both[0], both[1]


@for_task
def _kept_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers(TABLE)


@functools.cache
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * BASE)


class Bytes:
    """A run of bytes; equal substrings have equal hashes, wherever they stand."""

    def __init__(self, raw: bytes):
        self.raw = np.frombuffer(raw, np.uint8)
        powers, self.inverse = _kept_powers() if len(raw) <= TABLE else _powers(len(raw))
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        values = _byte_values()[self.raw]
        values *= powers[:len(raw)]
        np.cumsum(values, out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])


#: by number of bytes, a mask of so many of the low ones
_LOW = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def hash_runs(raw: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the runs [start, end), none of them empty. A run is cut into pieces of eight bytes, each mixed with
    its place before they are added up: unlike a polynomial's, such sums have no equal runs by their algebra."""
    if not len(start):
        return np.zeros(0, np.uint64)
    padded = raw + bytes(8)
    eight = np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    pieces = (end - start + 7) >> 3
    first = np.cumsum(pieces) - pieces
    owner = np.repeat(np.arange(len(start)), pieces)
    place = np.arange(len(owner)) - first[owner]
    at = start[owner] + 8 * place
    values = eight[at] & _LOW[np.minimum(end[owner] - at, 8)]
    values = mix(values ^ mix((place + 1).astype(np.uint64) * BASE))
    return mix(np.add.reduceat(values, first) + (end - start).astype(np.uint64) * BASE)
