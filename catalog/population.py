"""Queries of the population profiles and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import sqltext as S
from catalog.fixture import patients, table, with_patients
from catalog.registry import query
from catalog.repair import repaired, typed_bronze
from pulseframe.functions.names import flag_name
from pulseframe.operators import profile as P
from pulseframe.operators.stats import box_stats, moments, regression_metrics, welch
from pulseframe.plans.etl import repair

NUMBERS = ["age", "bmi", "systolic", "diastolic", "total_cholesterol", "hdl", "fbs", "score"]


def factors() -> dict:
    return P.risk_factors("smk", "dbt", "fam", "bpc")


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


@query("a3_a4_a5_headline", with_patients(
    "SELECT count(*) AS records, round(avg(score), 6) AS mean_score,"
    " round(avg(CASE WHEN lvl = 'HIGH' THEN 1 ELSE 0 END) * 100, 6) AS high_pct FROM p"))
def a3(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(P.headline(patients(spark, sf), "score", "lvl"), "mean_score", "high_pct")


AUDIT = " UNION ALL ".join(
    f"SELECT '{flag_name(c)}' AS flag, round_even(avg(CASE WHEN {flag_name(c)} THEN 1 ELSE 0 END) * 100, 2) AS rate_pct"
    " FROM filled" for c in S.SHORT_IMPUTED
)


@query("a6_imputation_audit", S.patients_filled(AUDIT))
def a6(spark: SparkSession, sf: str) -> DataFrame:
    return P.imputation_audit(repaired(spark, sf), [flag_name(c) for c in S.SHORT_IMPUTED])


@query("a7_correlation", with_patients(" UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM p" for a in NUMBERS for b in NUMBERS)))
def a7(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(P.correlation(patients(spark, sf), NUMBERS), "r")


LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_tax"]


@query("a7_correlation_lineitem", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem"
    for a in LINE_NUMBERS for b in LINE_NUMBERS))
def a7_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(P.correlation(table(spark, sf, "lineitem"), LINE_NUMBERS), "r")


COHORT_SHORT = ["age", "bmi", "systolic", "diastolic", "total_cholesterol", "fbs"]


@query("a8_interpolated_medians", with_patients(
    "SELECT " + ", ".join(f"CAST(median({c}) AS DOUBLE) AS {c}" for c in COHORT_SHORT) + " FROM p"))
def a8(spark: SparkSession, sf: str) -> DataFrame:
    from pulseframe.functions.quantiles import exact_medians

    return exact_medians(patients(spark, sf), [], COHORT_SHORT, interpolate=True)


def box_sql(source: str, group: str, value: str) -> str:
    return (
        f"SELECT r.{group}, count(*) AS n, round(any_value(q1), 6) AS q1, round(any_value(m), 6) AS median,"
        f" round(any_value(q3), 6) AS q3,"
        f" round(min({value}) FILTER ({value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_low,"
        f" round(max({value}) FILTER ({value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,"
        f" count(*) FILTER ({value} NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers"
        f" FROM {source} r JOIN (SELECT {group}, quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS m,"
        f" quantile_cont({value}, 0.75) AS q3 FROM {source} GROUP BY {group}) b ON r.{group} = b.{group}"
        f" WHERE {value} IS NOT NULL GROUP BY r.{group}"
    )


BOX = ("q1", "median", "q3", "whisker_low", "whisker_high")


@query("a9_box_score_by_smoking", with_patients(box_sql("p", "smk", "score")))
def a9(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(box_stats(patients(spark, sf), "smk", "score"), *BOX)


@query("a9_box_balance_by_segment", box_sql("customer", "c_mktsegment", "c_acctbal"))
def a9_customer(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(box_stats(table(spark, sf, "customer"), "c_mktsegment", "c_acctbal"), *BOX)


@query("a9_box_events", box_sql("events", "event_type", "value"))
def a9_events(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(box_stats(table(spark, sf, "events"), "event_type", "value"), *BOX)


@query("a10_moments", with_patients(
    "SELECT smk, count(score) AS n, round(avg(score), 6) AS mean, round(var_samp(score), 6) AS variance"
    " FROM p GROUP BY smk"))
def a10(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(moments(patients(spark, sf), "smk", "score"), "mean", "variance")


@query("a11_l1_sorted_categories", "SELECT p_brand, CAST(row_number() OVER (ORDER BY p_brand) - 1 AS BIGINT) AS code"
       " FROM (SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL)")
def a11(spark: SparkSession, sf: str) -> DataFrame:
    from pulseframe.operators.encode import label_codes

    listed = P.categories(table(spark, sf, "part"), "p_brand")
    return label_codes(listed, "p_brand").select(F.col("label").alias("p_brand"), "code")


@query("a12_level_by_band", S.bronze_filled(
    'SELECT age_band, "CVD Risk Level", count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY age_band) AS BIGINT)'
    " AS band_n, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY age_band) * 100, 6) AS share_pct,"
    " sum(count(*)) OVER (PARTITION BY age_band) < 100 AS small_band"
    ' FROM filled GROUP BY age_band, "CVD Risk Level"'))
def a12(spark: SparkSession, sf: str) -> DataFrame:
    filled = repair(typed_bronze(spark, sf), exact=True)
    return rounded(P.level_by_band(filled), "share_pct")


@query("a13_bp_categories", with_patients(
    "SELECT bpc, count(*) AS n, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () * 100, 6) AS share_pct"
    " FROM p GROUP BY bpc"))
def a13(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(P.category_shares(patients(spark, sf), "bpc"), "share_pct")


@query("a13_hypertension", with_patients(
    "SELECT count(*) AS records, count(*) FILTER (bpc IN ('Hypertension Stage 1', 'Hypertension Stage 2')) AS"
    " hypertensive, round(avg(CASE WHEN bpc IN ('Hypertension Stage 1', 'Hypertension Stage 2') THEN 1 ELSE 0 END)"
    " * 100, 6) AS prevalence_pct FROM p"))
def a13_any(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(P.hypertension_prevalence(patients(spark, sf), "bpc"), "prevalence_pct")


FACTOR_SQL = {
    "smoking": "smk = 'Y'", "diabetes": "dbt = 'Y'", "family_history": "fam = 'Y'",
    "hypertension": "bpc IN ('Hypertension Stage 1', 'Hypertension Stage 2')",
}
FACTOR_SUM = " + ".join(f"CASE WHEN {test} THEN 1 ELSE 0 END" for test in FACTOR_SQL.values())
FACTOR_SHARES = " UNION ALL ".join(
    f"SELECT '{name}' AS factor, round(avg(CASE WHEN {test} THEN 1 ELSE 0 END) * 100, 6) AS prevalence_pct FROM p"
    for name, test in FACTOR_SQL.items()
)


@query("a14_factor_distribution", with_patients(f"SELECT {FACTOR_SUM} AS factors, count(*) AS n FROM p GROUP BY 1"))
def a14(spark: SparkSession, sf: str) -> DataFrame:
    return P.factor_distribution(patients(spark, sf), factors())


@query("a14_factor_count_per_patient", with_patients(f"SELECT k, {FACTOR_SUM} AS factors FROM p"))
def a14_rows(spark: SparkSession, sf: str) -> DataFrame:
    return patients(spark, sf).select("k", P.factor_count(factors()).alias("factors"))


@query("a15_factor_prevalence", with_patients(FACTOR_SHARES))
def a15(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(P.factor_prevalence(patients(spark, sf), factors()), "prevalence_pct")


@query("l2_top_factors", with_patients(f"SELECT * FROM ({FACTOR_SHARES}) ORDER BY prevalence_pct DESC, factor LIMIT 2"))
def l2(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(P.factor_prevalence(patients(spark, sf), factors(), top=2), "prevalence_pct")


PROFILED = ["age", "weight_kg", "height_m", "bmi", "total_cholesterol", "hdl", "fbs", "systolic", "diastolic", "score"]
ANY_NULL = " OR ".join(f"{c} IS NULL" for c in PROFILED)


@query("a16_null_profile", with_patients(" UNION ALL ".join(
    f"SELECT '{name}' AS \"column\", count(*) FILTER ({test}) AS nulls,"
    f" round(CAST(count(*) FILTER ({test}) AS DOUBLE) / count(*) * 100, 6) AS null_pct FROM p"
    for name, test in [(c, f"{c} IS NULL") for c in PROFILED] + [("*", ANY_NULL)])))
def a16(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(P.null_profile(patients(spark, sf), PROFILED), "null_pct")


@query("a17_regression_metrics", with_patients(
    "SELECT count(*) AS n, round(1 - sum((score - y) * (score - y)) / (var_pop(score) * count(*)), 6) AS r2,"
    " round(avg(abs(score - y)), 6) AS mae, round(sqrt(avg((score - y) * (score - y))), 6) AS rmse FROM"
    " (SELECT score, score + CAST((k % 7) - 3 AS DOUBLE) / 10 AS y FROM p) WHERE score IS NOT NULL"))
def a17(spark: SparkSession, sf: str) -> DataFrame:
    guess = F.col("score") + ((F.col("k") % 7) - 3).cast("double") / 10
    df = patients(spark, sf).select("score", guess.alias("guess"))
    return rounded(regression_metrics(df, "score", "guess"), "r2", "mae", "rmse")


def welch_sql(source: str, group: str, value: str, first: str, second: str) -> str:
    return (
        "SELECT n0, round(mean0, 6) AS mean0, round(var0, 6) AS var0, n1, round(mean1, 6) AS mean1,"
        " round(var1, 6) AS var1, round((mean0 - mean1) / sqrt(var0 / n0 + var1 / n1), 6) AS t,"
        " round(pow(var0 / n0 + var1 / n1, 2) / (pow(var0 / n0, 2) / (n0 - 1) + pow(var1 / n1, 2) / (n1 - 1)), 6) AS df"
        f" FROM (SELECT CAST(count({value}) FILTER ({group} = '{first}') AS DOUBLE) AS n0,"
        f" avg({value}) FILTER ({group} = '{first}') AS mean0, var_samp({value}) FILTER ({group} = '{first}') AS var0,"
        f" CAST(count({value}) FILTER ({group} = '{second}') AS DOUBLE) AS n1,"
        f" avg({value}) FILTER ({group} = '{second}') AS mean1, var_samp({value}) FILTER ({group} = '{second}') AS var1"
        f" FROM {source})"
    )


WELCH = ("mean0", "var0", "mean1", "var1", "t", "df")


@query("m13_welch_score_by_smoking", with_patients(welch_sql("p", "smk", "score", "Y", "N")))
def m13(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(welch(patients(spark, sf), "smk", "score", "Y", "N").drop("p"), *WELCH)


@query("m13_welch_events", welch_sql("events", "event_type", "value", "click", "view"))
def m13_events(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(welch(table(spark, sf, "events"), "event_type", "value", "click", "view").drop("p"), *WELCH)


STEPS = 20_000
# The tail is one less twice the density's integral from 0 to t, by the midpoint rule.
P_SQL = f"""WITH w AS ({welch_sql("events", "event_type", "value", "click", "view")}),
  u AS (SELECT abs(t) AS t, df, (i + 0.5) * abs(t) / {STEPS} AS u FROM w, range({STEPS}) AS r(i))
SELECT round(1 - 2 * sum(exp(lgamma((df + 1) / 2) - lgamma(df / 2) - 0.5 * ln(df * pi()) - (df + 1) / 2 * ln(1 + u * u / df)))
  * max(t) / {STEPS}, 5) AS p, any_value(t) > 0 AS some_difference FROM u"""


@query("m13_welch_p_value", P_SQL)
def m13_p(spark: SparkSession, sf: str) -> DataFrame:
    found = welch(table(spark, sf, "events"), "event_type", "value", "click", "view")
    return found.select(F.round("p", 5).alias("p"), (F.abs("t") > 0).alias("some_difference"))
