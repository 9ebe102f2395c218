"""Words and byte spans of Arrow string columns as numpy arrays with 64-bit hashes, without a Python object per word.

A word's hash takes its bytes in steps of eight, each step mixed into the last one's state; no sum of powers is in it that two
different words could share for a reason other than chance (about 2**-64). Spans that overlap, as ``substrings`` needs them, are
hashed from running sums over all bytes: two polynomials modulo the prime 2**31 - 1 with bases and byte values of their own, mixed
with the length. Modulo a power of two, words made of a word and its complement would meet for certain.
"""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
import sys
import types
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def process_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python process, so that tasks of one worker share it."""
    holder = sys.modules.setdefault("_pulseframe_process_cache", types.ModuleType("_pulseframe_process_cache"))
    return holder.__dict__.setdefault(name, {})


def begin(work: str) -> None:
    """Called where a task starts: a worker that goes over to other work gives up what it has kept for the last one.

    Workers live as long as their executor; a cache of pieces would otherwise stay in memory through all later operators.
    """
    holder = process_cache("work")
    if holder.get("now") != work:
        caches = sys.modules["_pulseframe_process_cache"].__dict__
        for name, held in list(caches.items()):
            if isinstance(held, dict) and name != "work":
                held.clear()
        holder["now"] = work
        trim()


def mix(h: np.ndarray) -> np.ndarray:
    """The finishing steps of the 64-bit Murmur hash."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


PRIME = (1 << 31) - 1
#: Of the two polynomials.
BASES = (0x2F0B4C47, 0x5A1E3D29)


def powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each polynomial, powers of its base and of the base's inverse, at least ``n`` of each."""
    held = process_cache("powers")
    if len(held.get("up", ((),))[0]) < n:
        size = max(n, (1 << 19) + (1 << 16))
        for name, sign in (("up", 1), ("down", -1)):
            held[name] = [geometric(pow(b, sign, PRIME), size) for b in BASES]
    return list(zip(held["up"], held["down"], strict=True))


def geometric(base: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), PRIME)) % np.uint64(PRIME)])
    return out[:n].astype(np.uint32)


def folded(data: np.ndarray, lower: bool, accents: bool = False) -> np.ndarray:
    """Bytes with A-Z as a-z where ``lower`` is set.

    ``accents`` also gives the second bytes of Latin capitals with accents those of their small letters (other scripts' letters
    32 apart meet too), so it is for searches that are verified or need no exact spelling.
    """
    as_is = np.arange(256, dtype=np.uint8)
    if lower:
        as_is[65:91] = as_is[97:123]
    if accents:
        as_is[0x80:0x9F] = as_is[0xA0:0xBF]
    return as_is[data] if lower or accents else data


def trim() -> None:
    """Give memory that is free back to the system: workers live on between tasks and would hold their largest need."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


class Texts(NamedTuple):
    """UTF-8 ``data`` of a run of rows; row ``i`` is ``data[bounds[i]:bounds[i + 1]]``; null rows are empty."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    def text(self, i: int) -> bytes:
        return self.data[self.bounds[i] : self.bounds[i + 1]].tobytes()


def runs(column: pa.Array, most: int = 1 << 19) -> Iterator[Texts]:
    """The rows of a string or binary column in runs of about ``most`` bytes; a longer row is a run of its own."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + most, side="right")) - 1)
        yield Texts(at, raw[bounds[at] : bounds[end]], bounds[at : end + 1] - bounds[at])
        at = end
    trim()


class Spans(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray

    def first_of_rows(self, rows: int) -> np.ndarray:
        """Where each row's words start, and the number of words last."""
        return np.searchsorted(self.row, np.arange(rows + 1))


def word_spans(t: Texts, spaces: tuple[int, ...] = SPACES) -> Spans:
    """Words split at the bytes ``spaces``, ASCII white space by default; no word crosses a row."""
    inside = np.ones(256, bool)
    inside[list(spaces)] = False
    w = inside[t.data]
    n = len(w)
    before = np.zeros(n, bool)
    before[1:] = w[:-1]
    after = np.zeros(n, bool)
    after[:-1] = w[1:]
    edge = t.bounds[(t.bounds > 0) & (t.bounds < n)]
    before[edge] = False
    after[edge - 1] = False
    start, end = np.flatnonzero(w & ~before), np.flatnonzero(w & ~after) + 1
    return Spans(start, end, np.searchsorted(t.bounds, start, side="right") - 1)


#: Steps of eight bytes that are taken for all words together; what a word has beyond them is hashed by itself.
STEPS = 8


def word_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each span of ``data``; its length counts too."""
    eight = eights(data)
    left = end - start
    h = mix(left.astype(np.uint64) * np.uint64(BASE))
    live, at = np.flatnonzero(left > 0), start[left > 0]
    left = left[left > 0]
    for _ in range(STEPS):
        if not len(live):
            return h
        h[live] = mix(h[live] ^ (eight[at] & KEEP[np.minimum(left, 8)]))
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    for i, a, n in zip(live.tolist(), at.tolist(), left.tolist(), strict=True):
        rest = int.from_bytes(hashlib.blake2b(data[a : a + n].tobytes(), digest_size=8).digest(), "little")
        h[i : i + 1] = mix(h[i : i + 1] ^ np.uint64(rest))
    return h


#: Masks that keep the first so many bytes of eight.
KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def eights(data: np.ndarray) -> np.ndarray:
    """At each place the eight bytes from there on, zeros beyond the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))


def running(data: np.ndarray) -> np.ndarray:
    """The running sums that ``span_hash`` reads, a row for each polynomial."""
    out = np.zeros((2, len(data) + 1), np.uint32)
    values = np.random.default_rng(20240229).integers(1, PRIME, (2, 256), dtype=np.uint64)
    for k, (up, _) in enumerate(powers(len(data) + 1)):
        terms = values[k][data]
        terms *= up[: len(data)]
        terms %= np.uint64(PRIME)
        np.cumsum(terms, out=terms)
        terms %= np.uint64(PRIME)
        out[k, 1:] = terms
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each span; its length counts too."""
    both = []
    for row, (_, down) in zip(sums, powers(sums.shape[1]), strict=True):
        x = row[end].astype(np.uint64)
        x += np.uint64(PRIME)
        x -= row[start]
        x %= np.uint64(PRIME)
        x *= down[start]
        x %= np.uint64(PRIME)
        both.append(x)
    h = both[0] | both[1] << np.uint64(31)
    return mix(h + (end - start).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))


def shingle_hash(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of ``n`` successive words each; the caller leaves out windows that cross a row."""
    m = len(words) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    h = words[:m].copy()
    for k in range(1, n):
        h = mix(h * np.uint64(BASE) + words[k : k + m])
    return h


class Shingles(NamedTuple):
    """Distinct shingles of each row, sorted: row ``i`` has ``hashes[bounds[i]:bounds[i + 1]]``."""

    hashes: np.ndarray
    bounds: np.ndarray


def shingle_sets(t: Texts, size: int, lower: bool = True) -> Shingles:
    """Each row's set of ``size``-word shingles; a row with fewer words has one of all its words, one without words none."""
    rows = len(t.bounds) - 1
    spans = word_spans(t)
    words = word_hash(folded(t.data, lower), spans.start, spans.end)
    first = spans.first_of_rows(rows)
    count = np.diff(first)
    h = shingle_hash(words, size)
    row = spans.row[: len(h)]
    inside = row == spans.row[size - 1 : size - 1 + len(h)] if len(h) else np.empty(0, bool)
    h, row = h[inside], row[inside]
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        whole = np.empty(len(short), np.uint64)
        for k, r in enumerate(short):
            x = np.full(1, count[r], np.uint64)
            for j in range(first[r], first[r + 1]):
                x = mix(x * np.uint64(BASE) + words[j : j + 1])
            whole[k] = x[0]
        h, row = np.concatenate([h, whole]), np.concatenate([row, short])
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[new], row[new]
    return Shingles(h, np.searchsorted(row, np.arange(rows + 1)))
