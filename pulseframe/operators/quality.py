"""Declarative quality rules: row outcomes, rule outcomes and routing."""

from __future__ import annotations

import operator
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.names import ref
from pulseframe.schema import FAILED_RULES, OUTCOME

COMPARE = {
    ">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le, "=": operator.eq, "!=": operator.ne,
}


class Rule(NamedTuple):
    """``kind`` is complete, values, absent or column_count."""

    id: str
    kind: str
    column: str | None = None
    op: str | None = None
    value: float | int | None = None

    @property
    def is_row_rule(self) -> bool:
        return self.kind != "column_count"

    def holds(self) -> Column:
        """Row predicate that is never NULL: a missing value does not meet a value rule."""
        if self.kind == "complete":
            return ref(self.column).isNotNull()
        if self.kind == "absent":
            return ref(self.column).isNull()
        return F.coalesce(COMPARE[self.op](ref(self.column), F.lit(self.value)), F.lit(False))

    def holds_for(self, df: DataFrame) -> bool:
        """Dataset rule, answered from the schema alone."""
        return COMPARE[self.op](len([c for c in df.columns if c != CORRUPT]), self.value)


def complete(*columns: str) -> list[Rule]:
    return [Rule(f"IsComplete {c}", "complete", c) for c in columns]


def values(column: str, op: str, value: float | int) -> Rule:
    return Rule(f"ColumnValues {column} {op} {value}", "values", column, op, value)


def column_count(op: str, value: int) -> Rule:
    return Rule(f"ColumnCount {op} {value}", "column_count", None, op, value)


# The rules of the silver table.
SILVER_RULES = [
    column_count("=", 35),
    *complete(
        "Age", "Sex", "Weight (kg)", "Height (m)", "BMI", "Abdominal Circumference (cm)", "Waist-to-Height Ratio",
        "Total Cholesterol (mg/dL)", "HDL (mg/dL)", "Fasting Blood Sugar (mg/dL)", "Estimated LDL (mg/dL)",
        "Systolic BP", "Diastolic BP", "CVD Risk Score",
    ),
    values("Age", ">", 0),
    values("Weight (kg)", ">", 0),
    values("Height (m)", ">", 0),
    values("BMI", ">", 0),
    values("Abdominal Circumference (cm)", ">", 0),
    values("Total Cholesterol (mg/dL)", ">", 0),
    values("HDL (mg/dL)", ">", 0),
    values("Fasting Blood Sugar (mg/dL)", ">", 0),
    values("Systolic BP", ">=", 70),
    values("Diastolic BP", ">=", 40),
]
# A line of a text file that has more or fewer fields than the header.
CORRUPT = "_corrupt_record"
WELL_FORMED = Rule("WellFormedLine", "absent", CORRUPT)
SINK_RULES = [column_count(">", 0)]


def row_outcomes(df: DataFrame, rules: list[Rule], outcome: str = OUTCOME, failed: str = FAILED_RULES) -> DataFrame:
    """Add the list of failed row rules and ``Passed``/``Failed``, in one projection without a shuffle."""
    row_rules = [r for r in rules if r.is_row_rule]
    broken = F.array_compact(F.array(*[F.when(~r.holds(), F.lit(r.id)) for r in row_rules]))
    passed = F.lit(True)
    for rule in row_rules:
        passed = passed & rule.holds()
    return df.withColumns(
        {outcome: F.when(passed, F.lit("Passed")).otherwise(F.lit("Failed")), failed: broken}
    )


def passed_rows(df: DataFrame, outcome: str = OUTCOME) -> DataFrame:
    return df.filter(ref(outcome).startswith("Passed"))


def failed_rows(df: DataFrame, outcome: str = OUTCOME) -> DataFrame:
    return df.filter(ref(outcome).startswith("Failed"))


def rule_metrics(rules: list[Rule]) -> list[Column]:
    """One failure count per row rule plus the row count, as aggregates."""
    counts = [F.count_if(~r.holds()).alias(f"f{i}") for i, r in enumerate(rules) if r.is_row_rule]
    return [F.count(F.lit(1)).alias("total"), *counts]


def outcome_rows(df: DataFrame, rules: list[Rule], checked: DataFrame) -> DataFrame:
    """Long form of one row of ``rule_metrics``: rule, outcome, failed, total."""
    rows = []
    for i, rule in enumerate(rules):
        failed = F.col(f"f{i}") if rule.is_row_rule else F.lit(0 if rule.holds_for(df) else 1).cast("bigint")
        rows.append(
            F.struct(
                F.lit(rule.id).alias("rule"),
                F.when(failed == 0, F.lit("Passed")).otherwise(F.lit("Failed")).alias("outcome"),
                failed.alias("failed"),
                F.col("total").alias("total"),
            )
        )
    return checked.select(F.inline(F.array(*rows)))


def rule_outcomes(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rule, from a single aggregation over the table."""
    return outcome_rows(df, rules, df.agg(*rule_metrics(rules)))


def require(df: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Stop before a write if a dataset rule does not hold."""
    broken = [r.id for r in (SINK_RULES if rules is None else rules) if not r.is_row_rule and not r.holds_for(df)]
    if broken:
        raise ValueError(f"quality rules do not hold: {broken}")
    return df
