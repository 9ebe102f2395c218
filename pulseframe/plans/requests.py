"""Scoring of request bodies: JSON in, JSON out, bad bodies aside, in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pulseframe.functions.names import ref
from pulseframe.operators.cohorts import CLUSTER, Cohorts
from pulseframe.operators.risk import LEVEL_OUT, SCORE_OUT, RiskModel
from pulseframe.sources.files import parse_requests
from pulseframe.sources.sinks import to_json_results


def score_requests(
    df: DataFrame, model: RiskModel, body: str = "body", content_type: str | None = None, keep: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """(``keep`` columns and a JSON ``result`` with level and score per request, requests that cannot be scored).

    A body that cannot be used goes aside with its reason, and so does a request whose category the model does not know.
    """
    good, bad = parse_requests(df, body, content_type)
    known, unknown = model.scorable(good)
    scored = model.score(known)
    results = to_json_results(scored, [LEVEL_OUT, SCORE_OUT], keep=list(keep))
    aside = bad.select(*map(ref, keep), "reason").unionByName(unknown.select(*map(ref, keep), "reason"))
    return results, aside


def what_if(rows: DataFrame, model: RiskModel, cohorts: Cohorts) -> DataFrame:
    """Level, score and cohort of each row, next to its own columns."""
    names = [*rows.columns, LEVEL_OUT, SCORE_OUT, CLUSTER, "cohort"]
    return cohorts.assign(model.score(rows)).select(*map(ref, names))
