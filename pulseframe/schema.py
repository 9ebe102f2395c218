"""Column names, types and groups of the patient tables.

Fixed values: the names, their order, types, groups and thresholds in this file are part of the data contract.
"""

from __future__ import annotations

from pyspark.sql import types as T

BP_TEXT = "Blood Pressure (mmHg)"
OUTCOME = "DataQualityEvaluationResult"
FAILED_RULES = "dq_failed_rules"
AGE_BAND = "age_band"
LEVEL = "CVD Risk Level"
SCORE = "CVD Risk Score"

# Raw header in file order, with the type each field is cast to.
RAW_TYPES = {
    "Sex": "string",
    "Age": "int",
    "Weight (kg)": "double",
    "Height (m)": "double",
    "BMI": "double",
    "Abdominal Circumference (cm)": "double",
    BP_TEXT: "string",
    "Total Cholesterol (mg/dL)": "double",
    "HDL (mg/dL)": "int",
    "Fasting Blood Sugar (mg/dL)": "int",
    "Smoking Status": "string",
    "Diabetes Status": "string",
    "Physical Activity Level": "string",
    "Family History of CVD": "string",
    "Height (cm)": "int",
    "Waist-to-Height Ratio": "double",
    "Systolic BP": "int",
    "Diastolic BP": "bigint",
    "Blood Pressure Category": "string",
    "Estimated LDL (mg/dL)": "int",
    SCORE: "double",
    LEVEL: "string",
}

# Numeric columns that are filled and flagged.
IMPUTED = [
    "Weight (kg)",
    "Height (m)",
    "Height (cm)",
    "BMI",
    "Abdominal Circumference (cm)",
    "Waist-to-Height Ratio",
    "Total Cholesterol (mg/dL)",
    "HDL (mg/dL)",
    "Fasting Blood Sugar (mg/dL)",
    "Estimated LDL (mg/dL)",
    "Systolic BP",
    "Diastolic BP",
    SCORE,
]

# Column groups used by profiles and models.
GROUPS = {
    "demographic": ["Sex", "Age"],
    "anthropometric": [
        "Weight (kg)", "Height (m)", "Height (cm)", "BMI", "Abdominal Circumference (cm)", "Waist-to-Height Ratio",
    ],
    "vitals": ["Systolic BP", "Diastolic BP", "Blood Pressure Category"],
    "biochemical": [
        "Total Cholesterol (mg/dL)", "HDL (mg/dL)", "Estimated LDL (mg/dL)", "Fasting Blood Sugar (mg/dL)",
    ],
    "lifestyle": ["Smoking Status", "Diabetes Status", "Physical Activity Level", "Family History of CVD"],
    "target": [LEVEL, SCORE],
    "derived": [AGE_BAND],
}
NUMERIC_FEATURES = [
    "Age", "BMI", "Systolic BP", "Diastolic BP", "Total Cholesterol (mg/dL)", "HDL (mg/dL)",
    "Fasting Blood Sugar (mg/dL)",
]
CATEGORY_FEATURES = [
    "Sex", "Smoking Status", "Diabetes Status", "Physical Activity Level", "Family History of CVD",
]
COHORT_FEATURES = [
    "Age", "BMI", "Systolic BP", "Diastolic BP", "Total Cholesterol (mg/dL)", "Fasting Blood Sugar (mg/dL)",
]
LEVEL_ORDER = ["LOW", "INTERMEDIARY", "HIGH"]
HYPERTENSION = ["Hypertension Stage 1", "Hypertension Stage 2"]


def raw_schema() -> T.StructType:
    """Bronze files are read as text only; typing happens in a later, failure-free step."""
    return T.StructType([T.StructField(name, T.StringType()) for name in RAW_TYPES])


def request_schema() -> T.StructType:
    """One scoring request: the numeric features as numbers, the categories as text."""
    return T.StructType(
        [T.StructField(c, T.DoubleType()) for c in NUMERIC_FEATURES]
        + [T.StructField(c, T.StringType()) for c in CATEGORY_FEATURES]
    )


def silver_types() -> dict[str, str]:
    """The 35 silver columns in order."""
    from pulseframe.functions.names import flag_name

    kept = {name: kind for name, kind in RAW_TYPES.items() if name != BP_TEXT}
    return kept | {AGE_BAND: "int"} | {flag_name(c): "boolean" for c in IMPUTED}
