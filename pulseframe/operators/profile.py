"""Population profiles: each is one aggregation over the silver table, with a small result."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseframe.functions.names import ref
from pulseframe.functions.scalar import half_even, is_one_of, is_value, share_of
from pulseframe.schema import HYPERTENSION

PAIRS_COMPILED = 14


def headline(df: DataFrame, score: str = "CVD Risk Score", level: str = "CVD Risk Level", high: str = "HIGH") -> DataFrame:
    """Row count, mean score and share of high-risk rows in percent."""
    return df.agg(
        F.count(F.lit(1)).alias("records"),
        F.avg(ref(score)).alias("mean_score"),
        share_of(is_value(ref(level), high)).alias("high_pct"),
    )


def long_form(one_row: DataFrame, names: list[str], name: str, value: str) -> DataFrame:
    """One row of many columns to (name, value) rows."""
    return one_row.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias(name), ref(n).alias(value)) for n in names]))
    )


def imputation_audit(df: DataFrame, flags: list[str]) -> DataFrame:
    """Share of filled cells per flag in percent, rounded to two digits, half to even."""
    shares = df.agg(*[share_of(ref(f)).alias(f) for f in flags])
    return long_form(shares, flags, "flag", "rate_pct").withColumn("rate_pct", half_even(F.col("rate_pct"), 2))


def correlation(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson matrix in long form (a, b, r), each pair over the rows where both values are known.

    Pairs are computed once, in aggregates of few enough buffer fields (six a pair) that each is compiled; the mirror is
    filled in. A column with itself gives 1 where its values differ.
    """
    values = df.select(*[ref(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    pairs, parts = list(combinations(range(len(cols)), 2)), []
    for at in range(0, len(pairs), PAIRS_COMPILED):
        some = pairs[at : at + PAIRS_COMPILED]
        one = values.agg(*[F.corr(f"c{i}", f"c{j}").alias(f"r{i}_{j}") for i, j in some])
        parts.append(one.select(F.inline(F.array(*[
            _cell(cols[x], cols[y], F.col(f"r{i}_{j}")) for i, j in some for x, y in ((i, j), (j, i))
        ]))))
    spread = values.agg(*[F.when(F.min(f"c{i}") < F.max(f"c{i}"), F.lit(1.0)).alias(f"r{i}") for i in range(len(cols))])
    parts.append(spread.select(F.inline(F.array(*[_cell(c, c, F.col(f"r{i}")) for i, c in enumerate(cols)]))))
    return reduce(DataFrame.unionByName, parts)


def _cell(a: str, b: str, r: Column) -> Column:
    return F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), r.alias("r"))


def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Missing cells per column, and under ``*`` the rows with at least one missing cell."""
    cols = cols or df.columns
    any_null = F.lit(False)
    for c in cols:
        any_null = any_null | ref(c).isNull()
    counts = df.agg(
        *[F.count_if(ref(c).isNull()).alias(c) for c in cols],
        F.count_if(any_null).alias("*"),
        F.count(F.lit(1)).alias("__rows"),
    )
    names = [*cols, "*"]
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("column"),
                        ref(n).alias("nulls"),
                        (F.try_divide(ref(n).cast("double"), F.col("__rows")) * 100).alias("null_pct"),
                    )
                    for n in names
                ]
            )
        )
    )


def level_by_band(
    df: DataFrame, band: str = "age_band", level: str = "CVD Risk Level", small: int = 100
) -> DataFrame:
    """Share of each level within a band, with the band's size and a mark on small bands.

    Rows are counted before the shuffle; the window only sees one row per band and level.
    """
    counts = df.groupBy(ref(band), ref(level)).agg(F.count(F.lit(1)).alias("n"))
    in_band = F.sum("n").over(Window.partitionBy(ref(band)))
    return counts.withColumn("band_n", in_band).select(
        ref(band), ref(level), "n", "band_n",
        (F.col("n").cast("double") / F.col("band_n") * 100).alias("share_pct"),
        (F.col("band_n") < small).alias("small_band"),
    )


def category_shares(df: DataFrame, column: str) -> DataFrame:
    """Count and share of each value."""
    counts = df.groupBy(ref(column)).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share_pct", F.col("n").cast("double") / F.lit(df.count()) * 100)


def hypertension_prevalence(df: DataFrame, column: str = "Blood Pressure Category") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(is_one_of(ref(column), HYPERTENSION)).alias("hypertensive"),
        share_of(is_one_of(ref(column), HYPERTENSION)).alias("prevalence_pct"),
    )


def risk_factors(
    smoking: str = "Smoking Status",
    diabetes: str = "Diabetes Status",
    family: str = "Family History of CVD",
    pressure: str = "Blood Pressure Category",
) -> dict:
    """The four tracked factors as row predicates; an unknown value counts as absent."""
    return {
        "smoking": is_value(ref(smoking), "Y"),
        "diabetes": is_value(ref(diabetes), "Y"),
        "family_history": is_value(ref(family), "Y"),
        "hypertension": is_one_of(ref(pressure), HYPERTENSION),
    }


def factor_count(factors: dict):
    """How many factors a row shows."""
    total = F.lit(0)
    for flag in factors.values():
        total = total + flag.cast("int")
    return total


def factor_distribution(df: DataFrame, factors: dict) -> DataFrame:
    return df.groupBy(factor_count(factors).alias("factors")).agg(F.count(F.lit(1)).alias("n"))


def factor_prevalence(df: DataFrame, factors: dict, top: int | None = None) -> DataFrame:
    """Share of rows with each factor, the most common first; ``top`` keeps the first few."""
    shares = df.agg(*[share_of(flag).alias(name) for name, flag in factors.items()])
    ranked = long_form(shares, list(factors), "factor", "prevalence_pct").orderBy(
        F.col("prevalence_pct").desc(), F.col("factor")
    )
    return ranked if top is None else ranked.limit(top)


def categories(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct known values."""
    return df.select(ref(column)).filter(ref(column).isNotNull()).distinct().orderBy(ref(column))
