"""Session builder for tests and benchmarks, and the shared-folder helpers."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Largest method, in bytes of bytecode, that the JVM compiles.
COMPILED_BYTES = 8000


def local_session(app: str = "pulseframe", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and bench runs; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only where nothing is set and all runs in one process, as in a local
    test, is a temporary folder made and set.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None and sc.getCheckpointDir() is None and not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="pulseframe-"))
    return named or sc.getCheckpointDir()


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete what a step wrote below the shared folder, in whatever store that is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def small_methods(spark: SparkSession) -> SparkSession:
    """Let Spark run a stage operator by operator where its fused code would be a method the JVM never compiles (over 8,000 bytes).

    Typing, filling and checking some forty columns in one stage makes such methods, which run several times slower. A limit that the
    session has already lowered stays.
    """
    limit = int(spark.conf.get("spark.sql.codegen.hugeMethodLimit"))
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", str(min(limit, COMPILED_BYTES)))
    return spark


def pin(df: DataFrame, parts: int | None = None) -> DataFrame:
    """Write a small derived table once, so that later steps and task retries all see the same rows.

    ``parts``: at most so many files. Each partition is a file, also an empty one, and on a local disk Hadoop starts a process or more
    for each file it makes.
    """
    shared_dir(df.sparkSession)
    return (df if parts is None else df.coalesce(parts)).checkpoint(eager=True)


def parts_of(spark: SparkSession, rows: int, most: int) -> int:
    """In how many partitions ``rows`` go: ``most`` in each, but two for each core at least."""
    return max(2 * spark.sparkContext.defaultParallelism, -(-rows // most))
