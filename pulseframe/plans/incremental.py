"""The batch job over files that have not been taken up yet: a manifest per run, staged sinks, and one commit record.

A run first writes down which files it takes, then its sinks, each into a folder of its own, and last a commit record. Readers go by the
commit records, so a run that dies leaves nothing that anyone reads. The next start finds the manifest without a commit and does
that run again, over the same files and into the same folders, before it looks for new files. Steps that the dead run had finished
under the same rules and options are not done twice; under others, all are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseframe.functions.names import ref
from pulseframe.operators.mapping import apply_mapping, raw_mapping
from pulseframe.operators.quality import CORRUPT, SILVER_RULES, WELL_FORMED, Rule, row_outcomes, rule_outcomes
from pulseframe.plans.etl import ClinicalFill, route
from pulseframe.session import discard, small_methods
from pulseframe.sources.files import read_bronze
from pulseframe.sources.sinks import write_parquet

MANIFEST = "file string, bytes bigint, modified timestamp"
COMMIT = "files bigint"
SINKS = ("silver", "rejected", "outcomes")


@dataclass(frozen=True)
class Bookmark:
    """The state below ``root``: ``manifests/run=N``, ``commits/run=N`` and ``<sink>/run=N``."""

    root: str

    def _numbers(self, spark: SparkSession, what: str) -> list[int]:
        """Runs that have a folder of this kind; one small file each."""
        try:
            held = spark.read.schema(f"{MANIFEST if what == 'manifests' else COMMIT}, run int").json(f"{self.root}/{what}")
            return sorted(r["run"] for r in held.select("run").distinct().collect())
        except Exception as problem:
            if "PATH_NOT_FOUND" in str(problem):
                return []
            raise

    def committed(self, spark: SparkSession) -> list[int]:
        return self._numbers(spark, "commits")

    def unfinished(self, spark: SparkSession) -> int | None:
        """The run that wrote its manifest and not its commit record."""
        done = set(self.committed(spark))
        return next((r for r in self._numbers(spark, "manifests") if r not in done), None)

    def manifest(self, spark: SparkSession, run: int) -> DataFrame:
        return spark.read.schema(MANIFEST).json(f"{self.root}/manifests/run={run}")

    def finished(self, spark: SparkSession, run: int, plan: str) -> set[str]:
        """Steps of an unfinished run that were done under this plan."""
        try:
            held = spark.read.schema("plan string, run int, step string").json(f"{self.root}/steps")
            return {r["step"] for r in held.where((F.col("run") == run) & (F.col("plan") == plan)).select("step").collect()}
        except Exception as problem:
            if "PATH_NOT_FOUND" in str(problem):
                return set()
            raise

    def do(self, spark: SparkSession, run: int, step: str, plan: str, work: Callable[[], None]) -> None:
        """Do a step whose folder may have an older one's rows: its record goes first and is written again last."""
        record = f"{self.root}/steps/run={run}/step={step}"
        discard(spark, record)
        work()
        spark.createDataFrame([(plan,)], "plan string").coalesce(1).write.mode("overwrite").json(record)

    def new_files(self, spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
        """Files below ``path`` that no run has in its manifest; a file that was written again is a new one."""
        listed = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
        found = listed.select(F.col("path").alias("file"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
        if not self._numbers(spark, "manifests"):
            return found
        taken = spark.read.schema(MANIFEST).json(f"{self.root}/manifests")
        return found.join(taken.select("file", "bytes", "modified"), ["file", "bytes", "modified"], "left_anti")

    def read(self, spark: SparkSession, sink: str) -> DataFrame:
        """The rows of all committed runs."""
        runs = self.committed(spark)
        if not runs:
            raise FileNotFoundError(f"no run below {self.root} has been committed")
        return spark.read.parquet(*[f"{self.root}/{sink}/run={r}" for r in runs])


def run_new_files(
    spark: SparkSession,
    bronze_path: str,
    root: str,
    schema: T.StructType | None = None,
    keep: tuple[str, ...] = (),
    rules: list[Rule] | None = None,
    protect: tuple[str, ...] = (),
    exact: bool = False,
    reached: Callable[[str], None] = lambda step: None,
) -> int | None:
    """Take up the files that no run has taken, or do an unfinished run again; returns the run's number, None if there is nothing to do.

    Medians are those of the run's own well-formed rows. ``reached`` is told each step that is done: manifest, then each sink, then commit.
    """
    mark = Bookmark(root)
    run = mark.unfinished(spark)
    if run is None:
        fresh = mark.new_files(spark, bronze_path)
        if fresh.isEmpty():
            return None
        run = max(mark.committed(spark), default=0) + 1
        fresh.coalesce(1).write.mode("overwrite").json(f"{root}/manifests/run={run}")
    reached("manifest")
    files = [r["file"] for r in mark.manifest(spark, run).select("file").collect()]  # as Spark's own listing has them
    rules = [*(SILVER_RULES if rules is None else rules), WELL_FORMED]
    told = (files, schema and schema.json(), keep, rules, protect, exact)
    plan = hashlib.blake2b(repr(told).encode(), digest_size=16).hexdigest()
    finished = mark.finished(spark, run, plan)

    def step(name: str, work: Callable[[], None]) -> None:
        if name not in finished:
            mark.do(spark, run, name, plan, work)

    staged, medians = f"{root}/staged/run={run}", f"{root}/medians/run={run}"
    bronze = read_bronze(small_methods(spark), files, schema)
    step("typed", lambda: apply_mapping(bronze, raw_mapping(keep=[*keep, CORRUPT])).write.mode("overwrite").parquet(staged))
    typed = spark.read.parquet(staged)
    whole = typed.filter(ref(CORRUPT).isNull()).drop(CORRUPT, *keep)
    step("medians", lambda: ClinicalFill.fit(whole, protect=protect, exact=exact).save(medians))
    filled = ClinicalFill.load(spark, medians).apply(typed)
    checked = row_outcomes(filled, rules)
    parts = route(checked, list(keep)) | {"outcomes": rule_outcomes(checked.select(*filled.drop(*keep).columns), rules)}
    for sink in SINKS:
        step(sink, lambda: write_parquet(parts[sink], f"{root}/{sink}/run={run}"))  # noqa: B023
        reached(sink)
    spark.createDataFrame([(len(files),)], COMMIT).coalesce(1).write.mode("overwrite").json(f"{root}/commits/run={run}")
    discard(spark, staged)
    reached("commit")
    return run
