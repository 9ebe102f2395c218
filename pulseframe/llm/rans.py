"""A static range asymmetric numeral system (rANS) codec in numpy.

One frequency table, shared by all blocks, codes token ids. A block is independent of the others: it holds the final states
of its interleaved lanes and the 32-bit words they shed. Token ``i`` of a block belongs to lane ``i % lanes``, so one numpy
step codes a whole row of lanes. States live in [2**31, 2**63) and shed 32 bits at a time.
"""

from __future__ import annotations

import json
import struct
import zlib
from typing import NamedTuple

import numpy as np

LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
MAGIC = b"PFRANS01"
CHECKPOINT = "<QIIII"  # payload offset, words, tokens, crc of the payload, crc of the ids


class Table(NamedTuple):
    """``freq`` of each id sums to ``2**bits``; ``start`` is its running sum; ``symbol`` names the id of each slot."""

    bits: int
    freq: np.ndarray
    start: np.ndarray
    symbol: np.ndarray


def table(freq: np.ndarray) -> Table:
    freq = np.asarray(freq, dtype=np.uint64)
    total = int(freq.sum())
    bits = total.bit_length() - 1
    if total != 1 << bits:
        raise ValueError(f"frequencies sum to {total}, not to a power of two")
    start = np.concatenate([np.zeros(1, np.uint64), np.cumsum(freq)[:-1]])
    return Table(bits, freq, start, np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64)))


def normalised(counts: np.ndarray, bits: int | None = None) -> np.ndarray:
    """Frequencies that sum to ``2**bits``, at least 1 for every id that occurs.

    The default gives the ids that occur eight slots each on average, and never less than 2**16 in all.
    """
    counts = np.asarray(counts, dtype=np.int64)
    used = int((counts > 0).sum())
    if used == 0:
        counts, used = np.ones(1, np.int64), 1
    bits = bits or max(16, (used - 1).bit_length() + 3)
    size = 1 << bits
    freq = np.where(counts > 0, np.maximum(1, counts * (size / counts.sum())).astype(np.int64), 0)
    order = np.argsort(-freq, kind="stable")
    off = size - int(freq.sum())
    if off > 0:
        freq[order[0]] += off
    while off < 0:
        spare = freq[order[:used]] - 1
        take = np.minimum(spare, np.maximum(1, spare * -off // max(1, int(spare.sum()))))
        take = np.where(np.cumsum(take) <= -off, take, 0)
        if not take.any():
            take[0] = min(-off, int(spare[0]))
        freq[order[:used]] -= take
        off += int(take.sum())
    return freq


def encode_block(ids: np.ndarray, t: Table, lanes: int) -> tuple[np.ndarray, np.ndarray]:
    """Final lane states and the words in the order a decoder reads them."""
    state = np.full(lanes, LOW, dtype=np.uint64)
    freq, start = t.freq[ids], t.start[ids]
    if len(ids) and not freq.all():
        raise ValueError("the table gives an id of the block no frequency")
    bits, shed = np.uint64(t.bits), []
    room = np.uint64(63 - t.bits)
    for at in range((len(ids) - 1) // lanes * lanes if len(ids) else -1, -1, -lanes):
        f, c = freq[at : at + lanes], start[at : at + lanes]
        x = state[: len(f)]
        full = x >= (f << room)
        shed.append(x[full].astype(np.uint32))
        x = np.where(full, x >> WORD, x)
        q = x // f
        state[: len(f)] = (q << bits) + (x - q * f) + c
    words = np.concatenate(shed[::-1]) if shed else np.empty(0, np.uint32)
    return state, words


def decode_block(state: np.ndarray, words: np.ndarray, n: int, t: Table) -> np.ndarray:
    lanes, state, at = len(state), state.copy(), 0
    out = np.empty(n, dtype=np.uint32)
    bits, mask = np.uint64(t.bits), np.uint64((1 << t.bits) - 1)
    words = words.astype(np.uint64)
    for first in range(0, n, lanes):
        m = min(lanes, n - first)
        x = state[:m]
        slot = x & mask
        ids = t.symbol[slot]
        x = t.freq[ids] * (x >> bits) + slot - t.start[ids]
        low = np.flatnonzero(x < LOW)
        x[low] = (x[low] << WORD) | words[at : at + len(low)]
        at += len(low)
        state[:m] = x
        out[first : first + m] = ids
    if at != len(words) or (state != LOW).any():
        raise ValueError("the block does not decode to its start state")
    return out


def pack(doc_ids: list, lengths: np.ndarray, ids: np.ndarray, t: Table, first_token: int, block: int, lanes: int) -> bytes:
    """A file: header, documents, one checkpoint per block, then the blocks."""
    docs = zlib.compress(json.dumps([doc_ids, lengths.tolist()]).encode(), 1)
    points, payloads, offset = [], [], 0
    for at in range(0, len(ids), block):
        part = ids[at : at + block]
        state, words = encode_block(part, t, lanes)
        payload = state.astype("<u8").tobytes() + words.astype("<u4").tobytes()
        points.append(struct.pack(CHECKPOINT, offset, len(words), len(part), zlib.crc32(payload), zlib.crc32(part.astype("<u4").tobytes())))
        payloads.append(payload)
        offset += len(payload)
    head = json.dumps({
        "first_token": first_token, "tokens": len(ids), "docs": len(lengths), "docs_bytes": len(docs), "blocks": len(points),
        "block": block, "lanes": lanes, "bits": t.bits, "table_crc": zlib.crc32(t.freq.astype("<u8").tobytes()),
    }).encode()
    front = MAGIC + struct.pack("<I", len(head)) + head + docs + b"".join(points)
    return b"".join([front, struct.pack("<I", zlib.crc32(front)), *payloads])


class Packed(NamedTuple):
    """An opened file; blocks can be decoded in any order, or alone."""

    head: dict
    doc_ids: list
    lengths: np.ndarray
    points: list[tuple]
    data: memoryview

    def block(self, k: int, t: Table) -> np.ndarray:
        offset, n_words, n, crc, ids_crc = self.points[k]
        lanes = self.head["lanes"]
        payload = self.data[offset : offset + 8 * lanes + 4 * n_words]
        if zlib.crc32(payload) != crc:
            raise ValueError(f"block {k}: the payload does not match its checksum")
        ids = decode_block(np.frombuffer(payload[: 8 * lanes], "<u8"), np.frombuffer(payload[8 * lanes :], "<u4"), n, t)
        if zlib.crc32(ids.astype("<u4").tobytes()) != ids_crc:
            raise ValueError(f"block {k}: the ids do not match their checksum")
        return ids

    def tokens(self, t: Table, begin: int = 0, end: int | None = None) -> np.ndarray:
        """Ids ``begin`` to ``end`` of the file; only the blocks that hold them are read."""
        end = self.head["tokens"] if end is None else end
        size = self.head["block"]
        first = begin // size
        parts = [self.block(k, t) for k in range(first, min(len(self.points), -(-end // size)))]
        ids = np.concatenate(parts) if parts else np.empty(0, np.uint32)
        return ids[begin - first * size : end - first * size]


def unpack(content: bytes, t: Table | None = None) -> Packed:
    if content[:8] != MAGIC:
        raise ValueError("not a file of this format")
    size = struct.unpack_from("<I", content, 8)[0]
    head = json.loads(content[12 : 12 + size])
    docs_at, points_at = 12 + size, 12 + size + head["docs_bytes"]
    end = points_at + struct.calcsize(CHECKPOINT) * head["blocks"]
    if zlib.crc32(content[:end]) != struct.unpack_from("<I", content, end)[0]:
        raise ValueError("the header does not match its checksum")
    if t is not None and head["table_crc"] != zlib.crc32(t.freq.astype("<u8").tobytes()):
        raise ValueError("the file was written under another frequency table")
    doc_ids, lengths = json.loads(zlib.decompress(content[docs_at:points_at]))
    points = list(struct.iter_unpack(CHECKPOINT, content[points_at:end]))
    return Packed(head, doc_ids, np.array(lengths, dtype=np.int64), points, memoryview(content)[end + 4 :])
