"""Column expressions shared by the operators of this subpackage."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WORD_SQL = r"[^\x20\x09-\x0D]+"
#: Bytes of rows that go to a worker at once; a pair of sets, or a long text, is many times as large as a row of most tables.
BATCH_BYTES = 4 << 20


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body reads it, also inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words of a text, split at ASCII white space; null gives no words."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def n_words(text: Column) -> Column:
    return F.size(words(text))


def count_chars(text: Column, chars: str) -> Column:
    """How many characters of ``text`` are among ``chars``."""
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def free_name(df: DataFrame, base: str) -> str:
    """``base``, or with underscores before it until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def add_columns(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with ``columns``; a column of the input that has one of these names gives way."""
    new = {c.lower() for c in columns}
    return df.select(
        *[F.col(f"`{c}`") for c in df.columns if c.lower() not in new], *[v.alias(c) for c, v in columns.items()]
    )


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of steps whose result is written: it does so once the JVM has collected
    their plans."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Rows go to workers in batches of ``BATCH_BYTES`` while the steps inside are written."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, before)
