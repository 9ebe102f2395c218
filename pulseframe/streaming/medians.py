"""Medians that stay up to date with a stream."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.plans.etl import ClinicalFill, clinical_counts
from pulseframe.session import pin
from pulseframe.sources.sinks import write_parquet


@dataclass(frozen=True)
class MedianCounts:
    """Counted values below ``path``, a folder for each batch; their sum gives the medians of all rows seen so far.

    A batch overwrites the folder of its id, so a batch that runs again after a failure adds nothing. The rows themselves are not kept.
    """

    path: str
    protect: tuple[str, ...] = ()

    def add(self, typed: DataFrame, batch_id: int) -> None:
        write_parquet(clinical_counts(typed, self.protect), f"{self.path}/batch_id={batch_id}")

    def total(self, spark: SparkSession) -> DataFrame:
        held = spark.read.parquet(self.path)
        return held.groupBy("Sex", "Age", "cell", "value").agg(F.sum("n").alias("n"))

    def fit(self, spark: SparkSession) -> ClinicalFill:
        """Exact medians of all tiers, as one batch over all rows would have them."""
        return ClinicalFill.from_counts(pin(self.total(spark)), self.protect)
