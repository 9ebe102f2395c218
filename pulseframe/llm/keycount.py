"""Which 64-bit keys occur more than once in a whole table, told back to where they came from.

The table comes in chunks, each a row with an array of keys. A chunk counts its own keys first and sends each distinct one once,
packed by range of the key: a frequent key costs one entry per chunk, however often it occurs. Each range adds up its entries
and answers each chunk with the keys that occur twice or more, their counts, and whether the chunk is the key's owner (one
chunk per key is). The driver sees nothing.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.bytewords import trim
from pulseframe.llm.exprs import partitions


#: Keys of a range, about: fewer ranges would leave tasks large, more would leave answers tiny.
BUCKET_KEYS = 1 << 17


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The range a key falls in; sorted keys have sorted buckets."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def split(buckets: int):
    def run(batches):
        for batch in batches:
            for chunk, keys in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                key, n = np.unique(np.frombuffer(keys.as_buffer(), np.uint64), return_counts=True)
                at = np.searchsorted(bucket_of(key, buckets), np.arange(buckets + 1))
                full = np.flatnonzero(np.diff(at))
                parts = [key[at[b] : at[b + 1]].tobytes() + n[at[b] : at[b + 1]].astype(np.uint32).tobytes() for b in full]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full, pa.int32()), pa.array([chunk] * len(full), pa.int64()), pa.array(parts, pa.binary())],
                    ["bucket", "chunk", "part"],
                )

    return run


def add_up(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("chunk")
    parts = [p.as_py() for p in rows.column("part")]
    sizes = np.array([len(p) // 12 for p in parts])
    key = np.concatenate([np.frombuffer(p, np.uint64, n) for p, n in zip(parts, sizes, strict=True)])
    count = np.concatenate([np.frombuffer(p, np.uint32, n, 8 * n) for p, n in zip(parts, sizes, strict=True)])
    order = np.argsort(key, kind="stable")
    new = np.ones(len(key), bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    first = np.flatnonzero(new)
    total = np.add.reduceat(count[order].astype(np.int64), first)
    group = np.cumsum(new) - 1
    many, owner = np.empty(len(key), np.uint32), np.zeros(len(key), np.uint8)
    many[order] = np.minimum(total, 0xFFFFFFFF)[group]
    owner[order[first]] = 1
    ends, chunks, hits = np.cumsum(sizes), [], []
    for chunk, a, b in zip(rows.column("chunk").to_pylist(), ends - sizes, ends, strict=True):
        k = np.flatnonzero(many[a:b] > 1) + a
        if len(k):
            chunks.append(chunk)
            hits.append(key[k].tobytes() + many[k].tobytes() + owner[k].tobytes())
    trim()
    return pa.table({"chunk": pa.array(chunks, pa.int64()), "hits": pa.array(hits, pa.binary())})


def with_repeats(chunks: DataFrame) -> DataFrame:
    """``chunks`` (chunk, keys, ...; written, as it is read twice) with ``hits``, to be read by ``repeats``."""
    total = chunks.agg(F.sum(F.octet_length("keys"))).first()[0] or 0
    buckets = min(2 * partitions(chunks.sparkSession), total // (8 * BUCKET_KEYS) + 1)
    parts = chunks.select("chunk", "keys").mapInArrow(split(buckets), "bucket int, chunk long, part binary")
    hits = parts.groupBy("bucket").applyInArrow(add_up, "chunk long, hits binary")
    listed = hits.groupBy("chunk").agg(F.collect_list("hits").alias("hits"))
    return chunks.join(listed, "chunk", "left")


class Repeats(NamedTuple):
    """Keys of a chunk that occur twice or more overall, sorted, with counts and ownership."""

    key: np.ndarray
    count: np.ndarray
    owner: np.ndarray

    def of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The count of each key (1 where it does not repeat), and whether this is its owner's first one."""
        if not len(self.key):
            return np.ones(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.key, keys), len(self.key) - 1)
        known = self.key[at] == keys
        first = np.zeros(len(keys), bool)
        first[np.unique(keys, return_index=True)[1]] = True
        return np.where(known, self.count[at], 1).astype(np.int64), known & (self.owner[at] > 0) & first


def repeats(hits: list[bytes] | None) -> Repeats:
    hits = hits or []
    sizes = [len(h) // 13 for h in hits]
    if not sizes:
        return Repeats(np.empty(0, np.uint64), np.empty(0, np.uint32), np.empty(0, np.uint8))
    key = np.concatenate([np.frombuffer(h, np.uint64, n) for h, n in zip(hits, sizes, strict=True)])
    count = np.concatenate([np.frombuffer(h, np.uint32, n, 8 * n) for h, n in zip(hits, sizes, strict=True)])
    owner = np.concatenate([np.frombuffer(h, np.uint8, n, 12 * n) for h, n in zip(hits, sizes, strict=True)])
    order = np.argsort(key)
    return Repeats(key[order], count[order], owner[order])
