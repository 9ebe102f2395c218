"""Joining a large table to one row per key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.names import ref

BROADCAST_BYTES = 64 << 20
SALTS = 32


def row_bytes(df: DataFrame) -> int:
    """Upper estimate of one row's width in memory: wide for text and arrays, 16 bytes for the rest."""
    wide = ("string", "array", "binary", "map", "struct")
    return 32 + sum(256 if kind.startswith(wide) else 16 for _, kind in df.dtypes)


def fits_broadcast(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a table stays below the limit. Where its row count is unknown, count no further than the limit."""
    allowed = limit // row_bytes(df)
    return (df.limit(allowed + 1).count() if rows is None else rows) <= allowed


def lookup(
    df: DataFrame,
    table: DataFrame,
    keys: list[str],
    rows: int | None = None,
    limit: int = BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """Left join ``df`` to ``table`` (unique on ``keys``), in which a NULL key finds the NULL key's row.

    A table whose size is checked to be small (``rows`` if the caller has counted it, else a count here) is
    broadcast, so ``df`` is not shuffled. A larger one is repeated once per salt and joined on key and salt, so
    that no single key, however frequent in ``df``, lands in one task.
    """
    renamed = {k: f"__key_{i}" for i, k in enumerate(keys)}
    right = table.withColumnsRenamed(renamed)
    same = [ref(k).eqNullSafe(ref(r)) for k, r in renamed.items()]
    if fits_broadcast(table, rows, limit):
        joined = df.join(F.broadcast(right), reduce(lambda a, b: a & b, same), "left")
        return joined.drop(*renamed.values())
    # The salt depends on the row alone: a retried task deals its rows as the lost one did.
    hashed = [ref(c) for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    left = df.withColumn("__salt", F.pmod(F.xxhash64(*hashed), F.lit(salts)).cast("int"))
    right = right.withColumn("__salt_of", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    same.append(F.col("__salt") == F.col("__salt_of"))
    joined = left.join(right, reduce(lambda a, b: a & b, same), "left")
    return joined.drop("__salt", "__salt_of", *renamed.values())
