"""Sharding by fixed virtual slots: records hash into slots, and a stored, versioned map says which shard holds each slot.

The number of slots is fixed and larger than any number of shards, so a record's slot never changes; only the map does. Bytes
and rows are added up per slot before anything is moved, and the map is then edited: slots go from the fullest shard to the
emptiest until the shards are about even, or into a new shard. An edit is stored as a further version; earlier ones stay.

The usage table and the map have a row per slot (``SLOTS`` and at most ``PIECES`` for each shard), whatever the table's size;
they alone come to the driver and are broadcast.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulseframe.llm.exprs import add_columns, free_name
from pulseframe.session import pin

SLOTS = 4096
#: One record that comes so often that its copies are over 1/PIECES of a shard's even share is spread over slots of its own.
PIECES = 64
#: Shards are even when the fullest and the emptiest differ by no more than this share of the mean.
EVEN = 1e-4

USAGE = "slot int, bytes long, rows long"
MAP = "version int, slot int, shard int, bytes long, rows long, first long"
SPLIT = "record long, first_slot int, slots int"


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A written narrow table: the key, bytes of the text plus one as ``size``, its ``text_crc32``, the ``record`` hash, ``copy``.

    ``copy`` tells equal rows apart. The table is written once, so all later steps see the same numbers.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    return pin(docs.select(
        F.col(key).alias("key"), (F.octet_length(whole) + 1).cast("long").alias("size"), F.crc32(whole.cast("binary")).alias("text_crc32"),
        F.xxhash64(F.col(key), whole).alias("record"), F.monotonically_increasing_id().alias("copy"),
    ))


def slot_of(record: Column, slots: int = SLOTS) -> Column:
    return F.pmod(record, F.lit(slots)).cast("int")


def frequent_records(rows: DataFrame, shards: int, slots: int = SLOTS) -> DataFrame:
    """Records whose copies outweigh a piece, with slots of their own: SPLIT, at most ``PIECES * shards`` rows.

    Only slots that outweigh a piece are searched.
    """
    spark = rows.sparkSession
    per_slot = rows.groupBy(slot_of(F.col("record"), slots).alias("slot")).agg(F.sum("size").alias("bytes")).collect()
    piece = sum(r["bytes"] for r in per_slot) / (shards * PIECES)
    heavy = sorted(r["slot"] for r in per_slot if r["bytes"] > piece)
    if not heavy:
        return spark.createDataFrame([], SPLIT)
    wanted = F.broadcast(spark.createDataFrame([(s,) for s in heavy], "slot int"))
    inside = rows.select("record", "size", slot_of(F.col("record"), slots).alias("slot")).join(wanted, "slot", "left_semi")
    found = inside.groupBy("record").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    listed = sorted(map(tuple, found.where((F.col("bytes") > piece) & (F.col("n") > 1)).collect()))
    out, at = [], slots
    for record, size, n in listed:
        out.append((record, at, min(n, int(size // piece) + 1)))
        at += out[-1][2]
    return spark.createDataFrame(out, SPLIT)


def with_slots(rows: DataFrame, split: DataFrame, slots: int = SLOTS, record: str = "record", copy: str = "copy", slot: str = "slot") -> DataFrame:
    """``rows`` (record, copy, ...) with ``slot``; copies of a frequent record are dealt over its own slots."""
    of, first, n = (free_name(rows, f"{slot}_{c}") for c in ("of", "first", "n"))
    frequent = split.withColumnsRenamed({"record": of, "first_slot": first, "slots": n})
    joined = rows.join(F.broadcast(frequent), F.col(record) == F.col(of), "left")
    own = F.col(first) + F.pmod(F.xxhash64(copy), F.col(n).cast("long")).cast("int")
    return joined.withColumn(slot, F.coalesce(own, slot_of(F.col(record), slots))).drop(of, first, n)


def slot_usage(rows: DataFrame) -> DataFrame:
    """USAGE: bytes and rows of each slot that has any."""
    return rows.groupBy("slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def even_out(size: np.ndarray, shard: np.ndarray, shards: int) -> np.ndarray:
    """An edit of ``shard``: slots move, or change places, between the fullest and the emptiest shard while that brings the two
    nearer to each other. A shard that nothing helps, as it holds one huge record, is left out from then on."""
    shard, load = shard.copy(), np.bincount(shard, size, shards).astype(np.int64)
    stuck: set[int] = set()
    while len(stuck) < shards - 1:
        full = max((s for s in range(shards) if s not in stuck), key=lambda s: load[s])
        low = int(np.argmin(load))
        gap = int(load[full] - load[low])
        if gap <= EVEN * load.mean():
            break
        ours, theirs = np.flatnonzero(shard == full), np.flatnonzero(shard == low)
        # An empty place on the other side makes a move a change of places with nothing.
        theirs = np.append(theirs[np.argsort(size[theirs], kind="stable")], -1)
        held = np.append(size[theirs[:-1]], 0)
        order = np.argsort(held, kind="stable")
        theirs, held = theirs[order], held[order]
        at = np.searchsorted(held, size[ours] - gap / 2)
        best = None
        for side in (np.clip(at - 1, 0, len(held) - 1), np.clip(at, 0, len(held) - 1)):
            moved = size[ours] - held[side]
            off = np.where((moved > 0) & (moved < gap), np.abs(2 * moved - gap), np.inf)
            k = int(np.argmin(off)) if len(off) else -1
            if k >= 0 and np.isfinite(off[k]) and (best is None or off[k] < best[0]):
                best = (off[k], ours[k], theirs[side[k]], moved[k])
        if best is None:
            stuck.add(full)
            continue
        _, mine, other, moved = best
        shard[mine] = low
        if other >= 0:
            shard[other] = full
        load[full] -= moved
        load[low] += moved
    return shard


def grow(size: np.ndarray, shard: np.ndarray, shards: int) -> np.ndarray:
    """An edit for one more shard: slots of the fullest move into it until it has its even share; no other slot moves."""
    shard, load = shard.copy(), np.append(np.bincount(shard, size, shards), 0).astype(np.int64)
    stuck: set[int] = set()
    while len(stuck) < shards:
        full = max((s for s in range(shards) if s not in stuck), key=lambda s: load[s])
        room = load.sum() / (shards + 1) - load[shards]
        gap = load[full] - load[shards]
        ours = np.flatnonzero(shard == full)
        fit = ours[(size[ours] > 0) & (size[ours] < gap) & (size[ours] <= 2 * room)]
        if room <= EVEN * load.mean():
            break
        if not len(fit):
            stuck.add(full)
            continue
        best = fit[np.argmin(np.abs(size[fit] - min(gap / 2, room)))]
        shard[best] = shards
        load[full] -= size[best]
        load[shards] += size[best]
    return shard


class SlotMap(NamedTuple):
    """The stored map below ``path``: a folder per version, and the slots of frequent records."""

    path: str
    shards: int
    slots: int = SLOTS

    def versions(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(MAP).parquet(f"{self.path}/map")

    def version(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """One version of the map, the newest by default; at most a row per slot."""
        held = self.versions(spark)
        if version is None:
            version = held.agg(F.max("version")).first()[0] or 0
        return held.where(F.col("version") == version)

    def split(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(SPLIT).parquet(f"{self.path}/split")

    def store(self, spark: SparkSession, version: int, usage: list, shard: np.ndarray) -> None:
        """Add a version: a row per slot with its shard and the rows of that shard in slots before it."""
        held: dict[int, int] = {}
        rows = []
        for (slot, size, n), s in zip(usage, shard.tolist(), strict=True):
            rows.append((version, slot, s, size, n, held.get(s, 0)))
            held[s] = held.get(s, 0) + n
        spark.createDataFrame(rows, MAP).coalesce(1).write.mode("append").parquet(f"{self.path}/map")


def plan(rows: DataFrame, path: str, shards: int, slots: int = SLOTS) -> SlotMap:
    """The map of a ``measured`` table, stored: version 1 deals slots evenly by number, version 2 evens out their bytes, version 3
    takes in one more shard."""
    if not 0 < shards < slots:
        raise ValueError("more slots than shards are needed")
    spark = rows.sparkSession
    made = SlotMap(path, shards, slots)
    frequent_records(rows, shards, slots).coalesce(1).write.mode("overwrite").parquet(f"{path}/split")
    usage = sorted(map(tuple, slot_usage(with_slots(rows, made.split(spark), slots)).collect()))
    size = np.array([u[1] for u in usage], np.int64)
    shard = np.array([u[0] % shards for u in usage], np.int64)
    even = even_out(size, shard, shards)
    for version, edited in enumerate((shard, even, grow(size, even, shards)), start=1):
        made.store(spark, version, usage, edited)
    return made


def place(rows: DataFrame, made: SlotMap) -> DataFrame:
    """Rows of a ``measured`` table with ``virtual_slot``, ``shard``, ``place`` (gapless from 0 in each shard) and ``next_shard``, the
    shard once there is one more.

    Rows are numbered inside their slot; the map knows how many rows of the shard stand before it.
    """
    spark = rows.sparkSession
    now = made.version(spark, 2).select("slot", "shard", "first")
    later = made.version(spark, 3).select("slot", F.col("shard").alias("next_shard"))
    held = with_slots(rows, made.split(spark), made.slots)
    inside = Window.partitionBy("slot").orderBy("key", "record", "copy")
    numbered = held.withColumn("within", F.row_number().over(inside) - 1)
    joined = numbered.join(F.broadcast(now), "slot").join(F.broadcast(later), "slot")
    return joined.select(
        "key", "size", "text_crc32", F.col("slot").alias("virtual_slot"), "shard", (F.col("first") + F.col("within")).alias("place"), "next_shard",
    )


def shard_documents(docs: DataFrame, path: str, made: SlotMap, version: int = 2, key: str = "doc_id", text: str = "text") -> None:
    """Write ``docs`` with all their columns below ``path``, a folder per shard, by one version of the map.

    Nulls: a null text has no bytes (size 1), a null key is a key. Records are key and text, so equal keys with different texts may
    part; of equal rows that come so often that one slot cannot hold them, which copy goes where depends on the files' order.
    Texts pass whole. An empty table writes none. An input column named ``shard`` gives way.
    """
    spark = docs.sparkSession
    record, copy, slot = (free_name(docs, c) for c in ("record", "copy", "slot"))
    marked = docs.withColumns({
        record: F.xxhash64(F.col(key), F.coalesce(F.col(text), F.lit(""))), copy: F.monotonically_increasing_id()})
    dealt = with_slots(marked, made.split(spark), made.slots, record, copy, slot)
    held = made.version(spark, version).select(F.col("slot").alias(f"{slot}_of"), F.col("shard").alias(f"{slot}_shard"))
    placed = dealt.join(F.broadcast(held), F.col(slot) == F.col(f"{slot}_of")).repartition(F.col(slot))
    columns = [c for c in docs.columns if c.lower() != "shard"]
    add_columns(placed, {"shard": F.col(f"{slot}_shard")}).select(*columns, "shard").write.partitionBy("shard").parquet(path)


def shards_of(docs: DataFrame, path: str, shards: int = 8, slots: int = SLOTS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document with its shard, by shards near equal in bytes: ``plan`` and ``place`` in one.

    Nulls: a null text has no bytes and size 1, the key may be null. Ties: rows of a slot are numbered by key, then hash; repeated
    rows each have a place. A text of any length counts whole; one longer than a shard's even share makes that shard the
    fullest. An empty table gives an empty map and no rows. Other columns are not read.
    """
    rows = measured(docs, key, text)
    return place(rows, plan(rows, path, shards, slots)).withColumnRenamed("key", key)
