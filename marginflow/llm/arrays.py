"""Words and hashes of whole Arrow batches in numpy: no Python loop over words.

A word is a run of bytes outside 0x20 and 0x09-0x0D; A-Z count as a-z. A word's hash is a
polynomial over random byte values, read off one prefix sum over the buffer. That arithmetic wraps
at 64 bits, and a power of two as the modulus lets certain long sequences of two values collide
whatever the values are; long ranges are digested one by one instead, and ``Rolling`` adds sums
modulo a prime where ranges of any length must be compared with parts of others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19  # texts are taken together up to this size; one longer text is taken alone

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_VALUE = np.random.default_rng(7).integers(1, 2**64, 256, dtype=np.uint64)
_MULTIPLIER = 0x9E3779B97F4A7C15
LONG = 128  # ranges of more values are digested
PRIME = 2**31 - 1
_PRIME_BASES = (1_103_515_245, 845_343_211)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    """``_MULTIPLIER`` to 0..n-1, or its inverse."""
    if len(_powers[kind]) < n:
        factor = _MULTIPLIER if kind == "up" else pow(_MULTIPLIER, -1, 2**64)
        row = np.full(max(n, 1 << 21), factor, dtype=np.uint64)
        row[0] = 1
        _powers[kind] = np.cumprod(row, dtype=np.uint64)
    return _powers[kind][:n]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x + np.uint64((seed * 0xD1342543DE82EF95 + 0x2545F4914F6CDD1D) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ranges_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of ``values[start:end]`` for each pair of bounds; equal content, equal hash."""
    n = len(values)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * _power("up", n), out=sums[1:])
    length = (end - start).astype(np.uint64)
    out = mix((sums[end] - sums[start]) * _power("down", n + 1)[start] + length)
    for i in np.flatnonzero(length > LONG):
        content = values[start[i]:end[i]].tobytes()
        out[i] = int.from_bytes(hashlib.blake2b(content, digest_size=8).digest(), "little")
    return out


def _prime_powers(base: int, n: int) -> np.ndarray:
    """``base`` to 0..n-1 modulo the prime."""
    key = f"prime {base}"
    if len(_powers.get(key, ())) < n:
        row, step = np.ones(1, np.uint64), base % PRIME
        while len(row) < n:
            row = np.concatenate([row, row * np.uint64(step) % np.uint64(PRIME)])
            step = step * step % PRIME
        _powers[key] = row
    return _powers[key][:n]


class Rolling:
    """Hashes of ranges of ``values`` and of ranges without one value, by the same sums: a
    polynomial modulo 2^64 and two modulo a prime, mixed."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.n = n
        wide = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * _power("up", n), out=wide[1:])
        self.parts = [(wide, _power("down", n + 2), None)]
        for base in _PRIME_BASES:
            sums = np.zeros(n + 1, dtype=np.uint64)  # of numbers below 2^31: never wraps
            np.cumsum(values % np.uint64(PRIME) * _prime_powers(base, n) % np.uint64(PRIME),
                      out=sums[1:])
            self.parts.append((sums, _prime_powers(pow(base, -1, PRIME), n + 2),
                               np.uint64(PRIME)))

    def _mixed(self, pieces: list[list[tuple[np.ndarray, np.ndarray]]],
               length: np.ndarray) -> np.ndarray:
        """``pieces[k]``: (sum, shift) terms of the k-th polynomial."""
        out = length.astype(np.uint64)
        for (_, _, prime), terms in zip(self.parts, pieces):
            if prime is None:
                total = sum(value * shift for value, shift in terms)
            else:
                total = sum(value % prime * shift % prime for value, shift in terms) % prime
            out = mix(out + total)
        return out

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self._mixed([[(sums[end] - sums[start], down[start])]
                            for sums, down, _ in self.parts], end - start)

    def without_one(self, bounds: np.ndarray) -> np.ndarray:
        """At each place the hash, as by ``ranges``, of its run of ``bounds`` without it."""
        sizes = np.diff(bounds)
        start, end = np.repeat(bounds[:-1], sizes), np.repeat(bounds[1:], sizes)
        at = np.arange(self.n)
        return self._mixed([[(sums[at] - sums[start], down[start]),
                             (sums[end] - sums[at + 1], down[start + 1])]
                            for sums, down, _ in self.parts], end - start - 1)


@dataclass
class Words:
    """The words of several texts, one after the other."""

    hash: np.ndarray    # of each word
    start: np.ndarray   # byte offsets into the chunk
    end: np.ndarray
    bounds: np.ndarray  # text i has the words bounds[i]:bounds[i + 1]

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of each run of ``k`` words within one text."""
        first = np.arange(len(self.hash))
        last = np.repeat(self.bounds[1:], np.diff(self.bounds))
        first = first[first + k <= last]
        return first, ranges_hash(self.hash, first, first + k)


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """``data``: UTF-8 bytes; text i lies at ``offsets[i]:offsets[i + 1]``."""
    n = len(data)
    inside = ~SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    hashes = ranges_hash(_BYTE_VALUE[_LOWER[data]], start, end)
    return Words(hashes, start, end, np.searchsorted(start, offsets))


@dataclass
class Chunk:
    first: int            # row of the batch
    count: int
    data: np.ndarray      # UTF-8 bytes of these texts
    offsets: np.ndarray   # count + 1


def text_chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """A text column cut into runs of rows of bounded size; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("") if texts.null_count else \
        texts.cast(pa.large_string())
    _, where, content = texts.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = (np.frombuffer(content, dtype=np.uint8) if content is not None
            else np.zeros(0, np.uint8))
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield Chunk(first, last - first, data[offsets[first]:offsets[last]],
                    offsets[first:last + 1] - offsets[first])
        first = last


def as_long(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's signed LONG."""
    return x.view(np.int64)


def list_column(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list per text from one flat array."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)),
                                    pa.array(values, type=kind))
