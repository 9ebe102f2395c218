"""Column-name rules. Names are metadata, so this runs on the driver over the header only."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ref(name: str) -> Column:
    """A column by its literal name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def flag_name(column: str) -> str:
    """Name of the boolean that tells whether a cell of ``column`` was filled."""
    # The replacements that define flag names.
    for old, new in ((" (", "_"), (")", ""), (" ", "_"), ("-", "_"), ("/", "_")):
        column = column.replace(old, new)
    return column.lower() + "_was_imputed"


def with_suffix(columns: list[str], suffix: str = "_was_imputed") -> list[str]:
    return [c for c in columns if c.endswith(suffix)]


class NameRule(NamedTuple):
    """Matches a cleaned name that holds all of ``has``, any of ``any_of`` and none of ``lacks``."""

    target: str
    has: tuple[str, ...] = ()
    any_of: tuple[str, ...] = ()
    lacks: tuple[str, ...] = ()
    exact: bool = False

    def matches(self, name: str) -> bool:
        if self.exact:
            return name in self.has
        return (
            all(word in name for word in self.has)
            and (not self.any_of or any(word in name for word in self.any_of))
            and not any(word in name for word in self.lacks)
        )


WAS = ("was",)

# Keyword rules in evaluation order, full set (display names).
DISPLAY_RULES = (
    NameRule("Sex", has=("sex",)),
    NameRule("Weight (kg)", has=("weight",), lacks=WAS),
    NameRule("Height (m)", has=("height", "m"), lacks=("was", "cm")),
    NameRule("Height (cm)", has=("height", "cm"), lacks=WAS),
    NameRule("BMI", has=("bmi",), exact=True),
    NameRule("Abdominal Circumference (cm)", has=("abdominal",), lacks=WAS),
    NameRule("Waist-to-Height Ratio", has=("waist",), lacks=WAS),
    NameRule("Systolic BP", has=("systolic",), lacks=WAS),
    NameRule("Diastolic BP", has=("diastolic",), lacks=WAS),
    NameRule("Blood Pressure Category", has=("blood pressure category",)),
    NameRule("Total Cholesterol (mg/dL)", any_of=("total", "cholesterol"), lacks=WAS),
    NameRule("HDL (mg/dL)", has=("hdl",), lacks=WAS),
    NameRule("Estimated LDL (mg/dL)", has=("ldl",), lacks=WAS),
    NameRule("Fasting Blood Sugar (mg/dL)", any_of=("sugar", "fasting"), lacks=WAS),
    NameRule("Smoking Status", has=("smok",)),
    NameRule("Diabetes Status", has=("diabe",), lacks=WAS),
    NameRule("Physical Activity Level", any_of=("activity", "physical")),
    NameRule("Family History of CVD", any_of=("family", "history")),
    NameRule("CVD Risk Level", has=("level", "risk")),
    NameRule("CVD Risk Score", has=("score", "risk"), lacks=WAS),
)

# The subset, and the two spellings, that the training input uses.
_TRAINING_SPELLING = {"Weight (kg)": "Weight_kg", "Height (m)": "Height_m"}
_DISPLAY_ONLY = {
    "Height (cm)", "BMI", "Abdominal Circumference (cm)", "Waist-to-Height Ratio", "Blood Pressure Category",
    "Estimated LDL (mg/dL)",
}
TRAINING_RULES = tuple(
    rule._replace(target=_TRAINING_SPELLING.get(rule.target, rule.target))
    for rule in DISPLAY_RULES
    if rule.target not in _DISPLAY_ONLY
)


def canonical_names(columns: list[str], rules: tuple[NameRule, ...] = DISPLAY_RULES) -> dict[str, str]:
    """Old name to new name. The ``#12`` kind of suffix goes from every column, matched or not."""
    renamed = {}
    for column in columns:
        bare = re.sub(r"#\d+$", "", column)
        words = bare.lower().replace("_", " ").strip()
        renamed[column] = next((r.target for r in rules if r.matches(words)), bare)
    return renamed


def clean_names(df: DataFrame, rules: tuple[NameRule, ...] = DISPLAY_RULES) -> DataFrame:
    """Rename to canonical names; two inputs with one resulting name are an error, never silent duplicates."""
    renamed = canonical_names(df.columns, rules)
    clashes = {new: [o for o, n in renamed.items() if n == new] for new in renamed.values()}
    clashes = {new: olds for new, olds in clashes.items() if len(olds) > 1}
    if clashes:
        raise ValueError(f"several columns map to one name: {clashes}")
    return df.toDF(*renamed.values())
