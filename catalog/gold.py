"""Queries of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import sqltext as S
from catalog.registry import query
from catalog.repair import checked_patients
from pulseframe.functions.names import ref
from pulseframe.operators import profile as P
from pulseframe.operators.star import build_star, join_star, write_star
from pulseframe.plans.etl import route
from pulseframe.session import scratch


def silver(spark: SparkSession, sf: str) -> DataFrame:
    """The silver table as files: every table of the star reads it, none makes it again."""
    path = scratch(spark, "silver")
    route(checked_patients(spark, sf), keep=["k"])["silver"].write.parquet(path)
    return spark.read.parquet(path)


def star(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The star written to files once, and read back."""
    path = scratch(spark, "gold")
    made = build_star(silver(spark, sf), "k")
    write_star(made, None, path)
    return {name: spark.read.parquet(f"{path}/{name}") for name in made}


LIFE = ["Smoking Status", "Diabetes Status", "Physical Activity Level", "Family History of CVD"]
RANK = "CASE \"CVD Risk Level\" WHEN 'LOW' THEN 0 WHEN 'INTERMEDIARY' THEN 1 WHEN 'HIGH' THEN 2 END"


@query("j1_star_join", S.bronze_filled(
    f'SELECT k AS patient_key, "Sex", "Age", age_band, "BMI", {S.names(LIFE)}, "Blood Pressure Category",'
    f' "CVD Risk Level", {RANK} AS level_rank, "Systolic BP", "CVD Risk Score", bmi_was_imputed'
    f" FROM filled WHERE {S.SILVER_PASS}"))
def j1(spark: SparkSession, sf: str) -> DataFrame:
    joined = join_star(star(spark, sf))
    columns = ["Sex", "Age", "age_band", "BMI", *LIFE, "Blood Pressure Category", "CVD Risk Level", "level_rank",
               "Systolic BP", "CVD Risk Score", "bmi_was_imputed"]
    return joined.select("patient_key", *map(ref, columns))


PASSED = f"(SELECT * FROM filled WHERE {S.SILVER_PASS})"


@query("s8_gold_tables", S.bronze_filled(
    f"SELECT 'fact_patient_risk' AS name, count(*) AS n FROM {PASSED} UNION ALL"
    f" SELECT 'dim_patient', count(*) FROM {PASSED} UNION ALL"
    f" SELECT 'dim_lifestyle', count(*) FROM (SELECT DISTINCT {S.names(LIFE)} FROM {PASSED}) UNION ALL"
    f" SELECT 'dim_bp_category', count(DISTINCT \"Blood Pressure Category\") FROM {PASSED} UNION ALL"
    f" SELECT 'dim_risk_level', count(DISTINCT \"CVD Risk Level\") FROM {PASSED}"))
def s8(spark: SparkSession, sf: str) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        for name, df in star(spark, sf).items()
    ]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


@query("j1_level_by_band_from_gold", S.bronze_filled(
    'SELECT age_band, "CVD Risk Level", count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY age_band) AS BIGINT)'
    " AS band_n, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY age_band) * 100, 6) AS share_pct,"
    " sum(count(*)) OVER (PARTITION BY age_band) < 100 AS small_band"
    f' FROM {PASSED} GROUP BY age_band, "CVD Risk Level"'))
def gold_bands(spark: SparkSession, sf: str) -> DataFrame:
    shares = P.level_by_band(join_star(star(spark, sf), "patient", "risk_level"))
    return shares.withColumn("share_pct", F.round("share_pct", 6))


@query("j1_factor_distribution_from_gold", S.bronze_filled(
    "SELECT CASE WHEN \"Smoking Status\" = 'Y' THEN 1 ELSE 0 END + CASE WHEN \"Diabetes Status\" = 'Y' THEN 1 ELSE 0"
    " END + CASE WHEN \"Family History of CVD\" = 'Y' THEN 1 ELSE 0 END + CASE WHEN \"Blood Pressure Category\" IN"
    " ('Hypertension Stage 1', 'Hypertension Stage 2') THEN 1 ELSE 0 END AS factors, count(*) AS n"
    f" FROM {PASSED} GROUP BY 1"))
def gold_factors(spark: SparkSession, sf: str) -> DataFrame:
    return P.factor_distribution(join_star(star(spark, sf), "lifestyle", "bp_category"), P.risk_factors())


@query("j1_bp_categories_from_gold", S.bronze_filled(
    'SELECT "Blood Pressure Category", count(*) AS n, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () * 100, 6)'
    f" AS share_pct FROM {PASSED} GROUP BY 1"))
def gold_pressure(spark: SparkSession, sf: str) -> DataFrame:
    shares = P.category_shares(join_star(star(spark, sf), "bp_category"), "Blood Pressure Category")
    return shares.withColumn("share_pct", F.round("share_pct", 6))


@query("j1_factor_prevalence_from_gold", S.bronze_filled(" UNION ALL ".join(
    f"SELECT '{name}' AS factor, round(avg(CASE WHEN {test} THEN 1 ELSE 0 END) * 100, 6) AS prevalence_pct FROM {PASSED}"
    for name, test in {
        "smoking": "\"Smoking Status\" = 'Y'", "diabetes": "\"Diabetes Status\" = 'Y'", "family_history": "\"Family History of CVD\" = 'Y'",
        "hypertension": "\"Blood Pressure Category\" IN ('Hypertension Stage 1', 'Hypertension Stage 2')",
    }.items())))
def gold_prevalence(spark: SparkSession, sf: str) -> DataFrame:
    shares = P.factor_prevalence(join_star(star(spark, sf), "lifestyle", "bp_category"), P.risk_factors())
    return shares.withColumn("prevalence_pct", F.round("prevalence_pct", 6))


@query("j1_star_default_key", S.bronze_filled(
    'SELECT CAST(sum(c) AS BIGINT) AS n, round(sum(c * "CVD Risk Score"), 4) AS score, round(sum(c * "BMI"), 4) AS bmi FROM'
    f" (SELECT *, CAST(k AS BIGINT) % 3 + 1 AS c FROM {PASSED})"))
def default_key(spark: SparkSession, sf: str) -> DataFrame:
    """Silver without an id, in which rows occur once to three times: the joined star has as many rows as silver."""
    copies = F.explode(F.sequence(F.lit(0), (F.col("k").cast("bigint") % 3).cast("int")))
    rows = silver(spark, sf).withColumn("copy", copies).drop("copy", "k")
    path = scratch(spark, "gold")
    made = build_star(rows)
    write_star(made, None, path)
    joined = join_star({name: spark.read.parquet(f"{path}/{name}") for name in made})
    return joined.agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("`CVD Risk Score`"), 4).alias("score"), F.round(F.sum("BMI"), 4).alias("bmi"))
