"""Sampled positions of byte strings, in numpy.

Of every ``size``-byte string the position with the least hash among its ``gram``-byte strings is its anchor (the leftmost of
equal ones). Equal strings have equal anchors at equal offsets, so strings need only be compared where their anchors'
grams agree, and one position in about ``(size - gram) / 2`` is an anchor.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from pulseframe.llm.bytewords import Texts, span_hash

GRAM = 16


def window_min(x: np.ndarray, w: int) -> np.ndarray:
    """``min(x[i:i + w])`` for each i, from running minima of blocks of ``w`` from both sides."""
    n = len(x)
    pad = np.full(-n % w + w, np.iinfo(x.dtype).max, x.dtype)
    blocks = np.concatenate([x, pad]).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


class Segments(NamedTuple):
    """Runs of starts that share an anchor: ``row``, ``anchor``, first start ``low`` and last start ``high`` in the data."""

    row: np.ndarray
    anchor: np.ndarray
    low: np.ndarray
    high: np.ndarray


def segments(t: Texts, sums: np.ndarray, size: int) -> Segments:
    n, w = len(t.data), size - GRAM + 1
    none = np.empty(0, np.int64)
    lengths = np.diff(t.bounds)
    if n < size or not (lengths >= size).any():
        return Segments(none, none, none, none)
    at = np.arange(n - GRAM + 1)
    h = span_hash(sums, at, at + GRAM)
    bits = np.uint64((1 << max(1, int(n).bit_length())) - 1)
    least = window_min((h & ~bits) | at.astype(np.uint64), w)
    row = np.repeat(np.arange(len(lengths)), np.maximum(lengths - size + 1, 0))
    start = np.arange(len(row)) + np.repeat(
        t.bounds[:-1] - np.cumsum(np.maximum(lengths - size + 1, 0)) + np.maximum(lengths - size + 1, 0), np.maximum(lengths - size + 1, 0)
    )
    anchor = (least[start] & bits).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return Segments(row[first], anchor[first], start[first], start[last])
