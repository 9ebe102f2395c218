"""Continuous bronze to silver and rejected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulseframe.functions.names import ref
from pulseframe.operators.mapping import apply_mapping, raw_mapping
from pulseframe.operators.quality import CORRUPT, SILVER_RULES, WELL_FORMED, Rule, row_outcomes, rule_outcomes
from pulseframe.plans.etl import ClinicalFill, route
from pulseframe.session import small_methods
from pulseframe.sources.sinks import publish_outcomes, write_parquet
from pulseframe.streaming.medians import MedianCounts


def stream_to_silver(
    bronze: DataFrame,
    fill: ClinicalFill,
    out_dir: str,
    checkpoint: str,
    rules: list[Rule] | None = None,
    keep: tuple[str, ...] = (),
    trigger: dict | None = None,
    counts: MedianCounts | None = None,
) -> StreamingQuery:
    """Type, fill, check and route each batch.

    Missing cells take the stored reference medians, so the result does not depend on how the input was cut into
    batches. With ``counts`` the values of each batch are counted there too, so that later runs can take medians of all rows seen. Every batch owns a folder per sink and overwrites it, so a batch that runs twice is written once.
    """
    small_methods(bronze.sparkSession)
    rules = SILVER_RULES if rules is None else rules
    text = [CORRUPT] if CORRUPT in bronze.columns else []
    rules = [*rules, WELL_FORMED] if text else rules

    def write(batch: DataFrame, batch_id: int) -> None:
        typed = apply_mapping(batch, raw_mapping(keep=[*keep, *text]))
        if counts is not None:
            counts.add(typed.filter(ref(CORRUPT).isNull()) if text else typed, batch_id)
        filled = fill.apply(typed)
        checked = row_outcomes(filled, rules).persist()
        try:
            routed = route(checked, keep)
            write_parquet(routed["silver"], f"{out_dir}/silver/batch_id={batch_id}")
            write_parquet(routed["rejected"], f"{out_dir}/rejected/batch_id={batch_id}")
            outcomes = rule_outcomes(checked.select(*filled.drop(*keep).columns), rules)
            publish_outcomes(outcomes, f"{out_dir}/outcomes", f"stream-{batch_id}")
        finally:
            checked.unpersist()

    return (
        bronze.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def total_outcomes(outcomes: DataFrame) -> DataFrame:
    """Rule outcomes of all batches together."""
    return outcomes.groupBy("rule").agg(
        F.when(F.sum("failed") == 0, F.lit("Passed")).otherwise(F.lit("Failed")).alias("outcome"),
        F.sum("failed").alias("failed"),
        F.sum("total").alias("total"),
    )
