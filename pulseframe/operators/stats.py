"""Group statistics, box-plot figures, Welch's test and regression metrics."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.lookup import lookup
from pulseframe.functions.names import ref
from pulseframe.functions.quantiles import exact_quantiles
from pulseframe.session import pin


def moments(df: DataFrame, group: str, value: str) -> DataFrame:
    """Count, mean and sample variance of the known values per group."""
    return df.groupBy(ref(group)).agg(
        F.count(ref(value)).alias("n"), F.avg(ref(value)).alias("mean"), F.var_samp(ref(value)).alias("variance")
    )


def box_stats(df: DataFrame, group: str, value: str, reach: float = 1.5, **options) -> DataFrame:
    """Quartiles (linear interpolation), whisker ends, and the number of values beyond them, per group."""
    rows = df.select(ref(group), ref(value).cast("double").alias("__value")).filter(F.col("__value").isNotNull())
    found = exact_quantiles(rows, [group], ["__value"], [0.25, 0.5, 0.75], interpolate=True, **options)
    fences = pin(
        found.select(ref(group), *[F.get("__value", F.lit(i)).alias(q) for i, q in enumerate(("q1", "median", "q3"))])
    )
    spread = (F.col("q3") - F.col("q1")) * F.lit(reach)
    inside = F.col("__value").between(F.col("q1") - spread, F.col("q3") + spread)
    joined = lookup(rows, fences, [group])
    return joined.groupBy(ref(group)).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.max(q).alias(q) for q in ("q1", "median", "q3")],
        F.min(F.when(inside, F.col("__value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("__value"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def welch(df: DataFrame, group: str, value: str, first: object, second: object) -> DataFrame:
    """Two-sample t-test without equal variances: one row with t, degrees of freedom and the two-sided p."""
    parts = []
    for i, label in enumerate((first, second)):
        mine = F.when(ref(group) == F.lit(label), ref(value))
        parts += [
            F.count(mine).cast("double").alias(f"n{i}"),
            F.avg(mine).alias(f"mean{i}"),
            F.var_samp(mine).alias(f"var{i}"),
        ]
    one = df.filter(ref(group).isin(first, second)).agg(*parts)
    e0, e1 = (F.col(f"var{i}") / F.col(f"n{i}") for i in (0, 1))
    stat = one.select(
        "*",
        F.try_divide(F.col("mean0") - F.col("mean1"), F.sqrt(e0 + e1)).alias("t"),
        F.try_divide(
            F.pow(e0 + e1, F.lit(2.0)),
            F.pow(e0, F.lit(2.0)) / (F.col("n0") - 1) + F.pow(e1, F.lit(2.0)) / (F.col("n1") - 1),
        ).alias("df"),
    )
    return stat.withColumn("p", two_sided_p("t", "df"))


NODES, NODE_WEIGHTS = np.polynomial.legendre.leggauss(400)
GAMMA_SHIFT = 30


def log_gamma_step(a: float) -> float:
    """log(gamma(a + 1/2) / gamma(a)): its asymptotic series at ``a + 30``, brought back by the recurrence."""
    up = a + GAMMA_SHIFT
    series = 0.5 * math.log(up) - 1 / (8 * up) + 1 / (192 * up**3) - 1 / (640 * up**5)
    return series - sum(math.log1p(0.5 / (a + k)) for k in range(GAMMA_SHIFT))


def student_p(t: float, df: float) -> float:
    """Two-sided tail probability of Student's t, by one formula for all degrees of freedom.

    With w = df/2 * log((1 + u^2/df) / (1 + t^2/df)) the tail of the density is a constant times the integral of
    exp(-w) * sqrt(q) / u, where q = 1 + u^2/df; w = t^2/2 * sinh(z)^2 makes that smooth down to t = 0.
    """
    if t is None or df is None or math.isnan(t) or math.isnan(df):
        return float("nan")
    t = abs(t)
    if t == 0:
        return 1.0
    if math.isinf(t):
        return 0.0
    end = math.asinh(7 * math.sqrt(2) / t)
    z = (NODES + 1) * end / 2
    s = t / math.sqrt(2) * np.sinh(z)
    start = t * t / df
    grown = np.expm1(np.minimum(2 * s * s / df, 700))
    above = start + (1 + start) * grown
    inside = np.exp(-s * s) * np.sqrt((1 + above) / (df * above)) * 2 * s * t / math.sqrt(2) * np.cosh(z)
    area = float((inside * NODE_WEIGHTS).sum()) * end / 2
    front = log_gamma_step(df / 2) - 0.5 * math.log(df * math.pi) - df / 2 * math.log1p(start)
    return min(1.0, 2 * math.exp(front) * area)


def two_sided_p(t: str, df: str) -> Column:
    """``student_p`` for the few rows of a test result."""

    @F.pandas_udf("double")
    def p_value(t_value: pd.Series, freedom: pd.Series) -> pd.Series:
        return pd.Series([student_p(a, b) for a, b in zip(t_value, freedom, strict=True)], dtype="float64")

    return p_value(F.col(t), F.col(df))


def regression_metrics(df: DataFrame, actual: str, predicted: str, *more: Column) -> DataFrame:
    """R2, mean absolute error and root mean squared error over the rows where both are known, in one pass.

    ``more`` are further aggregates, over all rows.
    """
    y, p = ref(actual).cast("double"), ref(predicted).cast("double")
    both = y.isNotNull() & p.isNotNull()
    y, error = F.when(both, y), y - p
    return df.agg(
        F.count(y).alias("n"),
        (F.lit(1.0) - F.try_divide(F.sum(error * error), F.var_pop(y) * F.count(y))).alias("r2"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        *more,
    )
