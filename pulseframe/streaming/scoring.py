"""Scoring of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from pulseframe.operators.risk import RiskModel


def score_stream(
    rows: DataFrame, model: RiskModel, out_dir: str, checkpoint: str, trigger: dict | None = None
) -> tuple[StreamingQuery, StreamingQuery]:
    """Score rows as they arrive; rows with a category the model does not know go to a side output.

    Both outputs are file sinks, which record their batches and so write each row once.
    """
    known, unknown = model.scorable(rows)
    return (
        _to_parquet(model.score(known), f"{out_dir}/scored", f"{checkpoint}/scored", trigger),
        _to_parquet(unknown, f"{out_dir}/unscored", f"{checkpoint}/unscored", trigger),
    )


def _to_parquet(df: DataFrame, path: str, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
