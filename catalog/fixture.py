"""Patients derived from ``orders`` by arithmetic: one patient per order, the same expressions in Spark and SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulseframe.session import small_methods


def h(factor: int, key: str = "k") -> str:
    """A spread-out number below 1000003 for each key."""
    return f"(({key} * {factor} + {factor % 997}) % 1000003)"


# Values before holes are punched.
BASE = {
    "k": "o_orderkey",
    "sex": f"CASE WHEN {h(104729, 'o_orderkey')} % 2 = 0 THEN 'M' ELSE 'F' END",
    "age0": f"20 + {h(224737, 'o_orderkey')} % 60",
    "weight0": f"45 + {h(350377, 'o_orderkey')} % 75",
    "hcm0": f"150 + {h(479909, 'o_orderkey')} % 45",
    "bmi10": f"170 + {h(611953, 'o_orderkey')} % 230",
    "abd0": f"65 + {h(746773, 'o_orderkey')} % 60",
    "sys0": f"CASE WHEN {h(541721, 'o_orderkey')} % 211 = 0 THEN 60 ELSE 95 + {h(413527, 'o_orderkey')} % 85 END",
    "dia0": f"55 + {h(674269, 'o_orderkey')} % 55",
    "tc0": f"120 + {h(882377, 'o_orderkey')} % 180",
    "hdl0": f"25 + {h(15485, 'o_orderkey')} % 65",
    "ldl0": f"50 + {h(926017, 'o_orderkey')} % 120",
    "fbs0": f"70 + {h(287117, 'o_orderkey')} % 110",
    "smk": f"CASE WHEN {h(812761, 'o_orderkey')} % 3 = 0 THEN 'Y' ELSE 'N' END",
    "dbt": f"CASE WHEN {h(951109, 'o_orderkey')} % 2 = 0 THEN 'Y' ELSE 'N' END",
    "act": f"CASE {h(163841, 'o_orderkey')} % 3 WHEN 0 THEN 'Low' WHEN 1 THEN 'Moderate' ELSE 'High' END",
    "fam": f"CASE WHEN {h(725111, 'o_orderkey')} % 2 = 0 THEN 'Y' ELSE 'N' END",
}

SC0 = (
    "(6 * age0 + 3 * sys0 + dia0 + tc0 + fbs0 - 2 * hdl0 + bmi10 + CASE WHEN smk = 'Y' THEN 120 ELSE 0 END"
    " + CASE WHEN dbt = 'Y' THEN 90 ELSE 0 END + CASE WHEN fam = 'Y' THEN 40 ELSE 0 END)"
)


def hole(expr: str, factor: int, modulus: int, also: str = "") -> str:
    return f"CASE WHEN {h(factor)} % {modulus} = 0{also} THEN NULL ELSE {expr} END"


PATIENT = {
    "k": "k",
    "sex": "sex",
    "age": hole("CAST(age0 AS INT)", 331999, 29),
    "weight_kg": hole("CAST(weight0 AS DOUBLE)", 427169, 23),
    "height_cm": hole("CAST(hcm0 AS INT)", 531457, 41),
    "height_m": hole("CAST(hcm0 AS DOUBLE) / 100", 519227, 23),
    "bmi": hole("CAST(bmi10 AS DOUBLE) / 10", 603901, 31),
    "abdominal_cm": hole("CAST(abd0 AS DOUBLE)", 639157, 37),
    "whr": hole("CAST(abd0 AS DOUBLE) / CAST(hcm0 AS DOUBLE)", 765949, 19),
    "bp_text": "concat(CAST(sys0 AS VARCHAR(8)), '/', CAST(dia0 AS VARCHAR(8)))",
    "systolic": hole("CAST(sys0 AS INT)", 794641, 17),
    "diastolic": hole("CAST(dia0 AS BIGINT)", 888887, 17),
    "total_cholesterol": hole("CAST(tc0 AS DOUBLE)", 240007, 11),
    "hdl": hole("CAST(hdl0 AS INT)", 698239, 19, " OR (sex = 'F' AND age0 >= 70)"),
    "ldl": hole("CAST(ldl0 AS INT)", 437653, 29),
    "fbs": hole("CAST(fbs0 AS INT)", 57737, 37),
    "smk": "smk",
    "dbt": "dbt",
    "act": "act",
    "fam": "fam",
    "bpc": (
        "CASE WHEN sys0 >= 140 OR dia0 >= 90 THEN 'Hypertension Stage 2' WHEN sys0 >= 130 OR dia0 >= 80 THEN"
        " 'Hypertension Stage 1' WHEN sys0 >= 120 THEN 'Elevated' ELSE 'Normal' END"
    ),
    "score": hole(f"CAST({SC0} AS DOUBLE) / 50", 366031, 13),
    "lvl": f"CASE WHEN {SC0} >= 1450 THEN 'HIGH' WHEN {SC0} >= 1280 THEN 'INTERMEDIARY' ELSE 'LOW' END",
}

# Short name to the header name of the clinical files.
HEADER = {
    "sex": "Sex",
    "age": "Age",
    "weight_kg": "Weight (kg)",
    "height_m": "Height (m)",
    "bmi": "BMI",
    "abdominal_cm": "Abdominal Circumference (cm)",
    "bp_text": "Blood Pressure (mmHg)",
    "total_cholesterol": "Total Cholesterol (mg/dL)",
    "hdl": "HDL (mg/dL)",
    "fbs": "Fasting Blood Sugar (mg/dL)",
    "smk": "Smoking Status",
    "dbt": "Diabetes Status",
    "act": "Physical Activity Level",
    "fam": "Family History of CVD",
    "height_cm": "Height (cm)",
    "whr": "Waist-to-Height Ratio",
    "systolic": "Systolic BP",
    "diastolic": "Diastolic BP",
    "bpc": "Blood Pressure Category",
    "ldl": "Estimated LDL (mg/dL)",
    "score": "CVD Risk Score",
    "lvl": "CVD Risk Level",
}


def _dirty(short: str) -> str:
    """Text form of a field, with the flaws that real files show."""
    text = f"CAST({short} AS STRING)"
    if short == "sex":
        return f"CASE WHEN {h(611957)} % 401 = 0 THEN NULL ELSE sex END"
    if short in ("age", "hdl", "systolic"):
        return (
            f"CASE WHEN {h(350381)} % 89 = 0 THEN 'n/a' WHEN {h(350381)} % 83 = 1 THEN {text} || '.0'"
            f" WHEN {h(350381)} % 79 = 2 THEN ' ' || {text} || ' ' ELSE {text} END"
        )
    if short == "bp_text":
        return (
            f"CASE WHEN {h(479923)} % 53 = 0 THEN '125' WHEN {h(479923)} % 53 = 1 THEN '125/'"
            f" WHEN {h(479923)} % 53 = 2 THEN '/79' WHEN {h(479923)} % 53 = 3 THEN 'abc'"
            f" WHEN {h(479923)} % 53 = 4 THEN NULL ELSE bp_text END"
        )
    if short in ("bmi", "score"):
        return (
            f"CASE WHEN {h(287131)} % 97 = 0 THEN 'NaN' WHEN {h(287131)} % 97 = 1 THEN 'Infinity'"
            f" WHEN {h(287131)} % 97 = 2 THEN '-Infinity' ELSE {text} END"
        )
    return text


def _select(columns: dict[str, str], source: str) -> str:
    inner = ", ".join(f'{expr} AS "{name}"' for name, expr in columns.items())
    return f"SELECT {inner} FROM {source}"


BRONZE = {"k": "CAST(k AS STRING)"} | {name: _dirty(short) for short, name in HEADER.items()}

BASE_SQL = _select(BASE, "orders")
PATIENT_SQL = _select(PATIENT, f"({BASE_SQL}) AS base")
BRONZE_SQL = _select(BRONZE, f"({PATIENT_SQL}) AS patient")


def with_patients(query: str) -> str:
    """SQL over ``p``, the derived patients."""
    return f"WITH p AS ({PATIENT_SQL}) {query}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return small_methods(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expr} AS `{name}`" for name, expr in columns.items()])


def patients_from(orders: DataFrame) -> DataFrame:
    return project(project(orders, BASE), PATIENT)


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patients_from(table(spark, sf_dir, "orders"))


def clinical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived patients, typed, under the header names of the clinical files, with the record id ``k``."""
    return patients(spark, sf_dir).withColumnsRenamed(HEADER).select("k", *[f"`{c}`" for c in HEADER.values()])


def bronze_from(orders: DataFrame) -> DataFrame:
    return project(patients_from(orders), BRONZE)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw record: text only, flaws included, with the record id ``k``."""
    return bronze_from(table(spark, sf_dir, "orders"))
