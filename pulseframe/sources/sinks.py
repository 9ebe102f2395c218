"""Writers: rejects, catalog table, rule outcomes, JSON results."""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.functions.names import ref
from pulseframe.operators.quality import SINK_RULES, Rule, require

log = logging.getLogger(__name__)


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: list[str] | tuple[str, ...] = (),
    rules: list[Rule] | None = None,
) -> None:
    """Snappy Parquet, unpartitioned unless asked for. Overwrite is the default so that a re-run adds nothing."""
    writer = require(df, SINK_RULES if rules is None else rules).write.mode(mode).option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def fit_to_table(df: DataFrame, table: str) -> DataFrame:
    """Project to an existing table's columns. Drift is logged, not applied to the table."""
    spark = df.sparkSession
    target = spark.table(table).schema
    have, want = dict(df.dtypes), {f.name: f.dataType.simpleString() for f in target}
    extra = [c for c in have if c not in want]
    absent = [c for c in want if c not in have]
    changed = [c for c in want if c in have and have[c] != want[c]]
    if extra or absent or changed:
        log.warning("schema of %s differs: new %s, absent %s, retyped %s", table, extra, absent, changed)
    return df.select(
        *[
            (ref(c).try_cast(kind) if c in have else F.lit(None).cast(kind)).alias(c)
            for c, kind in want.items()
        ]
    )


def write_table(
    df: DataFrame, table: str, path: str | None = None, mode: str = "overwrite", rules: list[Rule] | None = None
) -> None:
    """Snappy Parquet that is also registered in the catalog."""
    spark: SparkSession = df.sparkSession
    require(df, SINK_RULES if rules is None else rules)
    if spark.catalog.tableExists(table):
        df = fit_to_table(df, table)
    writer = df.write.format("parquet").mode(mode).option("compression", "snappy")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def swap_table(df: DataFrame, table: str, root: str, rules: list[Rule] | None = None) -> str:
    """Replace a table's rows as one step: write a folder of its own below ``root``, then point the catalog at it; returns that folder.

    Until the catalog points elsewhere, readers see the old rows, also when the write fails midway. The version before is left in place for
    readers that have started on it; versions before that one are deleted.
    """
    spark: SparkSession = df.sparkSession
    require(df, SINK_RULES if rules is None else rules)
    there = spark.catalog.tableExists(table)
    before = _location(spark, table) if there else None
    fitted = fit_to_table(df, table) if there else df
    version = f"{root.rstrip('/')}/version-{uuid.uuid4().hex}"
    fitted.write.option("compression", "snappy").parquet(version)
    if there:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=version, source="parquet", schema=fitted.schema)
    where = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for held in files.listStatus(where):
        name = held.getPath().getName()
        if name.startswith("version-") and name not in (version.rpartition("/")[2], (before or "").rpartition("/")[2]):
            files.delete(held.getPath(), True)
    return version


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else ""


def publish_outcomes(outcomes: DataFrame, path: str, run_id: str) -> None:
    """Rule outcomes of one run; each run owns its folder, so publishing twice changes nothing."""
    outcomes.write.mode("overwrite").parquet(f"{path}/run_id={run_id}")


def to_json_results(df: DataFrame, columns: list[str], out: str = "result", keep: list[str] | None = None) -> DataFrame:
    """One JSON text per row, next to the columns to ``keep``."""
    return df.select(*map(ref, keep or []), F.to_json(F.struct(*map(ref, columns))).alias(out))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)
