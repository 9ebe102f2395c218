"""The dashboard's figures as tables: every tile is a function of the silver table with a small result."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pulseframe.functions.names import with_suffix
from pulseframe.operators import profile as P
from pulseframe.operators.cohorts import sweep
from pulseframe.operators.risk import RiskModel
from pulseframe.operators.stats import box_stats, welch
from pulseframe.plans.training import hold_out_report
from pulseframe.schema import NUMERIC_FEATURES, SCORE
from pulseframe.sources.sinks import write_parquet


def tiles(silver: DataFrame) -> dict[str, DataFrame]:
    return {
        "headline": P.headline(silver),
        "imputation_audit": P.imputation_audit(silver, with_suffix(silver.columns)),
        "correlation": P.correlation(silver, [*NUMERIC_FEATURES, SCORE]),
        "level_by_band": P.level_by_band(silver),
        "bp_categories": P.category_shares(silver, "Blood Pressure Category"),
        "hypertension": P.hypertension_prevalence(silver),
        "factor_distribution": P.factor_distribution(silver, P.risk_factors()),
        "factor_prevalence": P.factor_prevalence(silver, P.risk_factors()),
        "smoking_box": box_stats(silver, "Smoking Status", SCORE),
        "smoking_welch": welch(silver, "Smoking Status", SCORE, "Y", "N"),
    }


def model_tiles(silver: DataFrame, model: RiskModel, held_out: DataFrame) -> dict[str, DataFrame]:
    """The tiles that rest on fitted models: the cluster sweep and the hold-out figures."""
    return {"cluster_sweep": sweep(silver), "hold_out": hold_out_report(model, held_out)}


def write_report(silver: DataFrame, out_dir: str, more: dict[str, DataFrame] | None = None) -> list[str]:
    """Write every tile as a table of its own; returns their names."""
    made = tiles(silver) | (more or {})
    for name, df in made.items():
        write_parquet(df, f"{out_dir}/{name}")
    return list(made)
