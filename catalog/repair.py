"""Queries of the repair path: typing, pairs, medians, tiers, rules and routing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import sqltext as S
from catalog.fixture import BRONZE_SQL, bronze, clinical, patients, table, with_patients
from catalog.registry import query
from pulseframe.functions import scalar as X
from pulseframe.functions.names import clean_names, flag_name, ref, with_suffix
from pulseframe.functions.quantiles import approx_quantiles, exact_medians
from pulseframe.operators import mapping as M
from pulseframe.operators import quality as Q
from pulseframe.operators.impute import impute
from pulseframe.plans.etl import ClinicalFill, repair, route
from pulseframe.schema import GROUPS, SCORE

SHORT_PAIR = {"text": "bp_text", "first": "systolic", "second": "diastolic"}


# ---- projections -------------------------------------------------------------------------------------------------

@query("p1_apply_mapping", f"WITH bronze AS ({BRONZE_SQL}) {S.TYPED_SELECT} FROM bronze")
def p1(spark: SparkSession, sf: str) -> DataFrame:
    return typed_bronze(spark, sf)


def typed_bronze(spark: SparkSession, sf: str) -> DataFrame:
    return M.apply_mapping(bronze(spark, sf), M.raw_mapping(keep=["k"]))


@query(
    "p2_prune_and_order",
    with_patients("SELECT k, sex AS \"Sex\", age AS \"Age\", score AS \"CVD Risk Score\" FROM p"),
)
def p2(spark: SparkSession, sf: str) -> DataFrame:
    plan = [("k", "k", "bigint"), ("Sex", "Sex", "string"), ("Age", "Age", "int"), (SCORE, SCORE, "double")]
    return M.apply_mapping(clinical(spark, sf), plan)


@query(
    "p3_p4_add_and_drop_columns",
    with_patients(
        "SELECT * EXCLUDE (bp_text), systolic - diastolic AS pulse_pressure, bmi >= 30 AS obese FROM p"
    ),
)
def p3(spark: SparkSession, sf: str) -> DataFrame:
    df = patients(spark, sf).withColumns(
        {"pulse_pressure": F.col("systolic") - F.col("diastolic"), "obese": F.col("bmi") >= 30}
    )
    return df.drop("bp_text")


@query(
    "p5_clean_names",
    with_patients(
        'SELECT k AS "k", sex AS "Sex", weight_kg AS "Weight (kg)", height_m AS "Height (m)", height_cm AS'
        ' "Height (cm)", bmi AS "BMI", age AS "Age", systolic AS "Systolic BP", total_cholesterol AS'
        ' "Total Cholesterol (mg/dL)", fbs AS "Fasting Blood Sugar (mg/dL)", lvl AS "CVD Risk Level",'
        ' weight_kg IS NULL AS "weight_kg_was_imputed" FROM p'
    ),
)
def p5(spark: SparkSession, sf: str) -> DataFrame:
    foreign = {
        "k": "k", "sex": "SEX#1", "weight_kg": "weight_kg#2", "height_m": "Height_(m)#3", "height_cm": "height_cm#4",
        "bmi": "BMI#5", "age": "Age#6", "systolic": "Systolic_BP#12", "total_cholesterol": "total_cholesterol#7",
        "fbs": "fasting sugar#8", "lvl": "cvd_risk_level#9",
    }
    df = patients(spark, sf)
    marked = df.select(
        *[F.col(c).alias(name) for c, name in foreign.items()],
        F.col("weight_kg").isNull().alias("weight_kg_was_imputed#20"),
    )
    return clean_names(marked)


@query(
    "p7_select_by_suffix",
    S.patients_filled(f"SELECT k, {S.names([flag_name(c) for c in S.SHORT_IMPUTED])} FROM filled"),
)
def p7(spark: SparkSession, sf: str) -> DataFrame:
    filled = repaired(spark, sf)
    return filled.select("k", *map(ref, with_suffix(filled.columns)))


@query(
    "p9_age_from_band",
    with_patients(
        "SELECT k, age_text, CAST(coalesce(TRY_CAST(nullif(regexp_extract(age_text, '(\\d+)', 1), '') AS DOUBLE),"
        " 50.0) AS DOUBLE) AS age FROM (SELECT k, CASE WHEN age IS NULL THEN NULL WHEN k % 11 = 0 THEN 'unknown'"
        " ELSE concat(CAST((age // 10) * 10 AS VARCHAR), '-', CAST((age // 10) * 10 + 9 AS VARCHAR)) END AS age_text"
        " FROM p)"
    ),
)
def p9(spark: SparkSession, sf: str) -> DataFrame:
    low = X.band(F.col("age")).cast("string")
    text = F.when(F.col("age").isNull(), None).when(F.col("k") % 11 == 0, "unknown").otherwise(
        F.concat(low, F.lit("-"), (X.band(F.col("age")) + 9).cast("string"))
    )
    df = patients(spark, sf).select("k", text.alias("age_text"))
    return M.with_age(df, "age", "age_text")


@query(
    "p10_bmi_from_weight",
    with_patients(
        "SELECT k, round(CASE WHEN h <> 0 THEN weight_kg / pow(h, 2) END, 6) AS bmi FROM"
        " (SELECT *, CASE WHEN k % 17 = 0 THEN 0.0 ELSE height_m END AS h FROM p)"
    ),
)
def p10(spark: SparkSession, sf: str) -> DataFrame:
    height = F.when(F.col("k") % 17 == 0, F.lit(0.0)).otherwise(F.col("height_m"))
    df = patients(spark, sf).select("k", "weight_kg", height.alias("height_m"))
    return M.with_bmi(df, "bmi", "weight_kg", "height_m").select("k", F.round("bmi", 6).alias("bmi"))


@query(
    "p11_p13_column_groups",
    with_patients(
        'SELECT k, total_cholesterol AS "Total Cholesterol (mg/dL)", hdl AS "HDL (mg/dL)", ldl AS'
        ' "Estimated LDL (mg/dL)", fbs AS "Fasting Blood Sugar (mg/dL)" FROM p'
    ),
)
def p11(spark: SparkSession, sf: str) -> DataFrame:
    df = M.require_columns(clinical(spark, sf), GROUPS["biochemical"])
    return df.select("k", *map(ref, M.present_groups(df, GROUPS)["biochemical"]))


# ---- filters -----------------------------------------------------------------------------------------------------

@query("f3_equality_filter", with_patients("SELECT k, smk, score FROM p WHERE smk = 'Y'"))
def f3(spark: SparkSession, sf: str) -> DataFrame:
    return patients(spark, sf).filter(F.col("smk") == "Y").select("k", "smk", "score")


@query("f4_null_flag", with_patients("SELECT k, hdl, hdl IS NULL AS hdl_was_imputed FROM p"))
def f4(spark: SparkSession, sf: str) -> DataFrame:
    return patients(spark, sf).select("k", "hdl", F.col("hdl").isNull().alias(flag_name("hdl")))


HOLED_LEVEL = "CASE WHEN k % 9 = 0 THEN NULL ELSE lvl END"


@query(
    "f5_indicator_with_nulls",
    with_patients(
        f"SELECT k, coalesce({HOLED_LEVEL} = 'HIGH', FALSE) AS high, {HOLED_LEVEL} = 'HIGH' AS high_or_null FROM p"
    ),
)
def f5(spark: SparkSession, sf: str) -> DataFrame:
    level = F.when(F.col("k") % 9 == 0, None).otherwise(F.col("lvl"))
    return patients(spark, sf).select(
        "k", X.is_value(level, "HIGH").alias("high"), (level == "HIGH").alias("high_or_null")
    )


# ---- scalar functions --------------------------------------------------------------------------------------------

@query(
    "x1_split_pair",
    f"WITH bronze AS ({BRONZE_SQL}), typed AS ({S.TYPED_SELECT} FROM bronze), {S.clinical_fill('typed')} "
    'SELECT k, "Systolic BP", "Diastolic BP" FROM paired',
)
def x1(spark: SparkSession, sf: str) -> DataFrame:
    return M.split_pair(typed_bronze(spark, sf)).select("k", "`Systolic BP`", "`Diastolic BP`")


@query(
    "x2_x3_x7_cast_coalesce_fill",
    with_patients(
        "SELECT k, TRY_CAST(split_part(bp_text, '/', 1) AS INTEGER) AS from_text,"
        " coalesce(systolic, TRY_CAST(split_part(bp_text, '/', 1) AS INTEGER), 120) AS systolic,"
        " coalesce(fbs, 99) AS fbs FROM p"
    ),
)
def x2(spark: SparkSession, sf: str) -> DataFrame:
    part = X.pair_part(F.col("bp_text"), 0)
    return patients(spark, sf).select(
        "k",
        part.alias("from_text"),
        F.coalesce(F.col("systolic"), part, F.lit(120)).alias("systolic"),
        F.coalesce(F.col("fbs"), F.lit(99)).alias("fbs"),
    )


@query(
    "x4_age_band",
    with_patients(
        "SELECT k, CAST(trunc((age - 45) / 10.0) AS INTEGER) * 10 AS centred_band, (age // 10) * 10 AS age_band FROM p"
    ),
)
def x4(spark: SparkSession, sf: str) -> DataFrame:
    return patients(spark, sf).select(
        "k", X.band(F.col("age") - 45).alias("centred_band"), X.band(F.col("age")).alias("age_band")
    )


@query(
    "x5_x10_power_and_root",
    with_patients(
        "SELECT k, round(pow(bmi, 2), 6) AS squared, round(sqrt(score), 6) AS root,"
        " round(weight_kg / (height_m * height_m), 6) AS ratio FROM p"
    ),
)
def x5(spark: SparkSession, sf: str) -> DataFrame:
    return patients(spark, sf).select(
        "k",
        F.round(F.pow("bmi", F.lit(2.0)), 6).alias("squared"),
        F.round(F.sqrt("score"), 6).alias("root"),
        F.round(X.body_mass_index(F.col("weight_kg"), F.col("height_m")), 6).alias("ratio"),
    )


@query(
    "x6_first_digits",
    with_patients("SELECT k, TRY_CAST(nullif(regexp_extract(bp_text, '(\\d+)', 1), '') AS DOUBLE) AS digits FROM p"),
)
def x6(spark: SparkSession, sf: str) -> DataFrame:
    return patients(spark, sf).select("k", X.first_digits(F.col("bp_text")).alias("digits"))


@query(
    "x8_x12_text_forms",
    with_patients(
        f"SELECT k, coalesce({HOLED_LEVEL}, 'None') AS level_text, coalesce(CAST(hdl AS VARCHAR), 'None') AS hdl_text,"
        " concat('Cluster ', CAST(k % 4 AS VARCHAR)) AS cohort FROM p"
    ),
)
def x8(spark: SparkSession, sf: str) -> DataFrame:
    level = F.when(F.col("k") % 9 == 0, None).otherwise(F.col("lvl"))
    return patients(spark, sf).select(
        "k",
        X.as_category(level).alias("level_text"),
        X.as_category(F.col("hdl")).alias("hdl_text"),
        X.cohort_label(F.col("k") % 4).alias("cohort"),
    )


@query(
    "x9_round_half_even",
    with_patients(
        "SELECT k, CAST(CASE WHEN (k * 5) % 10 = 0 THEN (k * 5) // 10 WHEN ((k * 5) // 10) % 2 = 0 THEN (k * 5) // 10"
        " ELSE (k * 5) // 10 + 1 END AS DOUBLE) AS halves, round(score, 2) AS score FROM p"
    ),
)
def x9(spark: SparkSession, sf: str) -> DataFrame:
    half = F.col("k").cast("double") / 2
    return patients(spark, sf).select(
        "k", X.half_even(half, 0).alias("halves"), X.half_even(F.col("score"), 2).alias("score")
    )


@query(
    "x11_display_formats",
    with_patients(
        "SELECT format('{:,}', count(*)) AS records, format('{:.2f}', avg(score)) AS mean_score,"
        " format('{:.1f}%', avg(CASE WHEN lvl = 'HIGH' THEN 1 ELSE 0 END) * 100) AS high_pct FROM p"
    ),
)
def x11(spark: SparkSession, sf: str) -> DataFrame:
    from pulseframe.operators.profile import headline

    figures = headline(patients(spark, sf), "score", "lvl")
    return figures.select(
        X.thousands(F.col("records")).alias("records"),
        X.fixed_point(F.col("mean_score"), 2).alias("mean_score"),
        X.percent(F.col("high_pct"), 1).alias("high_pct"),
    )


@query(
    "x13_x16_match_and_equality",
    with_patients(
        "SELECT k, regexp_matches(bpc, '^(?:Hyper)') AS starts_hyper, starts_with(bpc, 'Normal') AS starts_normal,"
        " lvl = 'HIGH' AS is_high FROM p"
    ),
)
def x13(spark: SparkSession, sf: str) -> DataFrame:
    return patients(spark, sf).select(
        "k",
        X.starts_with_pattern(F.col("bpc"), "Hyper").alias("starts_hyper"),
        F.col("bpc").startswith("Normal").alias("starts_normal"),
        (F.col("lvl") == "HIGH").alias("is_high"),
    )


@query(
    "x14_text_cleanup",
    with_patients(
        "SELECT k, trim(replace(lower(regexp_replace(raw, '#\\d+$', '')), '_', ' ')) AS cleaned,"
        " contains(lower(raw), 'stage') AS has_stage FROM"
        " (SELECT k, concat(' ', replace(bpc, ' ', '_'), '#', CAST(k % 40 AS VARCHAR)) AS raw FROM p)"
    ),
)
def x14(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.concat(F.lit(" "), F.replace("bpc", F.lit(" "), F.lit("_")), F.lit("#"), (F.col("k") % 40).cast("string"))
    bare = F.regexp_replace(F.col("raw"), r"#\d+$", "")
    return patients(spark, sf).select("k", raw.alias("raw")).select(
        "k",
        F.trim(F.replace(F.lower(bare), F.lit("_"), F.lit(" "))).alias("cleaned"),
        F.lower("raw").contains("stage").alias("has_stage"),
    )


# ---- medians and tiers -------------------------------------------------------------------------------------------

MEDIAN_COLUMNS = ["age", "weight_kg", "hdl", "diastolic", "score"]
MEDIANS_SQL = ", ".join(f"quantile_disc({c}, 0.5) AS {c}" for c in MEDIAN_COLUMNS)


@query("a1_median_by_group", with_patients(f"SELECT sex, act, {MEDIANS_SQL} FROM p GROUP BY sex, act"))
def a1(spark: SparkSession, sf: str) -> DataFrame:
    return exact_medians(patients(spark, sf), ["sex", "act"], MEDIAN_COLUMNS)


@query("a1_median_summary", with_patients(f"SELECT sex, act, smk, {MEDIANS_SQL} FROM p GROUP BY sex, act, smk"))
def a1_summary(spark: SparkSession, sf: str) -> DataFrame:
    """The one-pass summary; groups here are far below its accuracy, so its answer is an exact element."""
    return approx_quantiles(patients(spark, sf), ["sex", "act", "smk"], MEDIAN_COLUMNS)


@query("a2_median_overall", with_patients(f"SELECT {MEDIANS_SQL} FROM p"))
def a2(spark: SparkSession, sf: str) -> DataFrame:
    return exact_medians(patients(spark, sf), [], MEDIAN_COLUMNS)


@query(
    "a2_median_lineitem",
    "SELECT l_returnflag, quantile_disc(l_extendedprice, 0.5) AS l_extendedprice, quantile_disc(l_quantity, 0.5) AS"
    " l_quantity FROM lineitem GROUP BY l_returnflag",
)
def a2_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return exact_medians(table(spark, sf, "lineitem"), ["l_returnflag"], ["l_extendedprice", "l_quantity"])


@query(
    "w1_fill_age_by_sex",
    with_patients("SELECT k, sex, coalesce(age, quantile_disc(age, 0.5) OVER (PARTITION BY sex)) AS age FROM p"),
)
def w1(spark: SparkSession, sf: str) -> DataFrame:
    df = patients(spark, sf).select("k", "sex", "age")
    return impute(df, ["age"], [["sex"]], flags=False, exact=True)


BANDED = with_patients("").rstrip() + ", banded AS (SELECT *, (age // 10) * 10 AS age_band FROM p)"


@query(
    "w2_fill_by_group",
    f"{BANDED} SELECT k, sex, age_band,"
    " coalesce(total_cholesterol, quantile_disc(total_cholesterol, 0.5) OVER g) AS total_cholesterol,"
    " coalesce(hdl, quantile_disc(hdl, 0.5) OVER g) AS hdl,"
    " total_cholesterol IS NULL AS total_cholesterol_was_imputed, hdl IS NULL AS hdl_was_imputed"
    " FROM banded WINDOW g AS (PARTITION BY sex, age_band)",
)
def w2(spark: SparkSession, sf: str) -> DataFrame:
    df = patients(spark, sf).select(
        "k", "sex", X.band(F.col("age")).alias("age_band"), "total_cholesterol", "hdl"
    )
    return impute(df, ["total_cholesterol", "hdl"], [["sex", "age_band"]], exact=True)


@query(
    "w3_fill_overall",
    with_patients("SELECT k, coalesce(hdl, (SELECT quantile_disc(hdl, 0.5) FROM p)) AS hdl,"
                  " coalesce(score, (SELECT quantile_disc(score, 0.5) FROM p)) AS score FROM p"),
)
def w3(spark: SparkSession, sf: str) -> DataFrame:
    df = patients(spark, sf).select("k", "hdl", "score")
    return impute(df, ["hdl", "score"], [[]], flags=False, exact=True)


def repaired(spark: SparkSession, sf: str, exact: bool = True) -> DataFrame:
    """Patients under short names with pairs split, bands set and all tiers filled."""
    paired = M.split_pair(patients(spark, sf), **SHORT_PAIR)
    aged = impute(paired, ["age"], [["sex"]], flags=False, exact=exact)
    banded = aged.withColumn("age_band", X.band(F.col("age")).cast("int"))
    return impute(banded, S.SHORT_IMPUTED, [["sex", "age_band"], []], exact=exact)


@query("w4_tiered_fill", S.patients_filled("SELECT * FROM filled"))
def w4(spark: SparkSession, sf: str) -> DataFrame:
    return repaired(spark, sf)


@query("w4_tiered_fill_bronze", S.bronze_filled("SELECT * FROM filled"))
def w4_bronze(spark: SparkSession, sf: str) -> DataFrame:
    return repair(typed_bronze(spark, sf), exact=True)


@query(
    "w4_protected_target",
    S.bronze_filled(
        f'SELECT k, "CVD Risk Score", cvd_risk_score_was_imputed, CASE WHEN {S.SILVER_PASS} THEN \'Passed\' ELSE'
        " 'Failed' END AS outcome FROM filled",
        protect=(SCORE,),
    ),
)
def w4_protected(spark: SparkSession, sf: str) -> DataFrame:
    filled = repair(typed_bronze(spark, sf), protect=[SCORE], exact=True)
    checked = Q.row_outcomes(filled, Q.SILVER_RULES)
    return checked.select("k", ref(SCORE), flag_name(SCORE), ref(Q.OUTCOME).alias("outcome"))


LINES = (
    "SELECT l_orderkey, l_linenumber, l_returnflag, CAST(round(l_discount * 100) AS INTEGER) AS discount_pct,"
    " CASE WHEN l_orderkey % 7 = 0 OR (l_returnflag = 'N' AND round(l_discount * 100) = 3) THEN NULL ELSE"
    " l_extendedprice END AS l_extendedprice,"
    " CASE WHEN (l_orderkey + l_linenumber) % 5 = 0 THEN NULL ELSE l_quantity END AS l_quantity FROM lineitem"
)


@query(
    "w4_tiered_fill_lineitem",
    f"WITH t AS ({LINES}), g AS (SELECT l_returnflag, discount_pct, quantile_disc(l_extendedprice, 0.5) AS price,"
    " quantile_disc(l_quantity, 0.5) AS quantity FROM t GROUP BY 1, 2), f AS (SELECT t.* REPLACE ("
    "coalesce(l_extendedprice, price) AS l_extendedprice, coalesce(l_quantity, quantity) AS l_quantity),"
    " l_extendedprice IS NULL AS l_extendedprice_was_imputed, l_quantity IS NULL AS l_quantity_was_imputed"
    " FROM t JOIN g USING (l_returnflag, discount_pct))"
    " SELECT * REPLACE (coalesce(l_extendedprice, (SELECT quantile_disc(l_extendedprice, 0.5) FROM f)) AS"
    " l_extendedprice, coalesce(l_quantity, (SELECT quantile_disc(l_quantity, 0.5) FROM f)) AS l_quantity) FROM f",
)
def w4_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    pct = F.round(F.col("l_discount") * 100).cast("int")
    bare = (F.col("l_returnflag") == "N") & (pct == 3)
    df = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", pct.alias("discount_pct"),
        F.when((F.col("l_orderkey") % 7 == 0) | bare, None).otherwise(F.col("l_extendedprice")).alias("l_extendedprice"),
        F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 5 == 0, None)
        .otherwise(F.col("l_quantity")).alias("l_quantity"),
    )
    return impute(df, ["l_extendedprice", "l_quantity"], [["l_returnflag", "discount_pct"], []], exact=True)


@query(
    "j2_group_medians_joined",
    f"{BANDED}, g AS (SELECT sex, age_band, quantile_disc(score, 0.5) AS score_median, quantile_disc(bmi, 0.5) AS"
    " bmi_median FROM banded GROUP BY sex, age_band) SELECT k, b.sex, b.age_band, score, score_median, bmi_median"
    " FROM banded b LEFT JOIN g ON b.sex IS NOT DISTINCT FROM g.sex AND b.age_band IS NOT DISTINCT FROM g.age_band",
)
def j2(spark: SparkSession, sf: str) -> DataFrame:
    from pulseframe.functions.lookup import lookup
    from pulseframe.session import pin

    df = patients(spark, sf).withColumn("age_band", X.band(F.col("age")))
    medians = pin(exact_medians(df, ["sex", "age_band"], ["score", "bmi"]))
    medians = medians.withColumnsRenamed({"score": "score_median", "bmi": "bmi_median"})
    joined = lookup(df.select("k", "sex", "age_band", "score"), medians, ["sex", "age_band"])
    return joined.select("k", "sex", "age_band", "score", "score_median", "bmi_median")


@query("w4_stored_medians", S.bronze_filled("SELECT * FROM filled"))
def w4_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Medians fitted, stored, read back and applied, as a later batch or a stream does."""
    from pulseframe.session import scratch

    typed = typed_bronze(spark, sf)
    path = scratch(spark, "medians")
    ClinicalFill.fit(typed, exact=True).save(path)
    return ClinicalFill.load(spark, path).apply(typed)


# ---- quality -----------------------------------------------------------------------------------------------------

CUSTOMER_RULES = [
    Q.column_count(">", 0), *Q.complete("c_name"), Q.values("c_acctbal", ">", 0), Q.values("c_nationkey", ">=", 1),
]


def checked_customer(spark: SparkSession, sf: str) -> DataFrame:
    return Q.row_outcomes(table(spark, sf, "customer"), CUSTOMER_RULES)


CUSTOMER_PASS = S.all_hold(CUSTOMER_RULES)


@query("f1_keep_passed", f"SELECT c_custkey, c_acctbal, c_nationkey FROM customer WHERE {CUSTOMER_PASS}")
def f1(spark: SparkSession, sf: str) -> DataFrame:
    return Q.passed_rows(checked_customer(spark, sf)).select("c_custkey", "c_acctbal", "c_nationkey")


@query(
    "f2_keep_failed",
    f"SELECT c_custkey, {S.failed_text(CUSTOMER_RULES)} AS failed_rules FROM customer WHERE NOT ({CUSTOMER_PASS})",
)
def f2(spark: SparkSession, sf: str) -> DataFrame:
    failed = Q.failed_rows(checked_customer(spark, sf))
    return failed.select("c_custkey", F.concat_ws(";", Q.FAILED_RULES).alias("failed_rules"))


def checked_patients(spark: SparkSession, sf: str) -> DataFrame:
    return Q.row_outcomes(repair(typed_bronze(spark, sf), exact=True), Q.SILVER_RULES)


@query("q1_column_count", "SELECT 'ColumnCount = 5' AS rule, 'Passed' AS outcome, CAST(0 AS BIGINT) AS failed,"
       " count(*) AS total FROM customer UNION ALL SELECT 'ColumnCount > 0', 'Passed', CAST(0 AS BIGINT), count(*)"
       " FROM customer UNION ALL SELECT 'ColumnCount = 35', 'Failed', CAST(1 AS BIGINT), count(*) FROM customer")
def q1(spark: SparkSession, sf: str) -> DataFrame:
    rules = [Q.column_count("=", 5), Q.column_count(">", 0), Q.column_count("=", 35)]
    return Q.rule_outcomes(table(spark, sf, "customer"), rules)


@query(
    "q2_q3_q4_row_rules",
    with_patients(
        "SELECT k, hdl IS NOT NULL AS hdl_known, coalesce(hdl > 0, FALSE) AS hdl_positive,"
        " coalesce(systolic >= 70, FALSE) AS systolic_in_range FROM p"
    ),
)
def q2(spark: SparkSession, sf: str) -> DataFrame:
    return patients(spark, sf).select(
        "k",
        Q.complete("hdl")[0].holds().alias("hdl_known"),
        Q.values("hdl", ">", 0).holds().alias("hdl_positive"),
        Q.values("systolic", ">=", 70).holds().alias("systolic_in_range"),
    )


@query(
    "q5_row_outcomes",
    S.bronze_filled(
        f"SELECT k, CASE WHEN {S.SILVER_PASS} THEN 'Passed' ELSE 'Failed' END AS \"DataQualityEvaluationResult\","
        f" {S.failed_text(Q.SILVER_RULES)} AS failed_rules FROM filled"
    ),
)
def q5(spark: SparkSession, sf: str) -> DataFrame:
    checked = checked_patients(spark, sf)
    return checked.select("k", Q.OUTCOME, F.concat_ws(";", Q.FAILED_RULES).alias("failed_rules"))


@query("q6_rule_outcomes", S.bronze_filled(S.outcomes_sql("filled", Q.SILVER_RULES, 35)))
def q6(spark: SparkSession, sf: str) -> DataFrame:
    filled = repair(typed_bronze(spark, sf), exact=True)
    return Q.rule_outcomes(filled.drop("k"), Q.SILVER_RULES)


@query("q6_rule_outcomes_customer", S.outcomes_sql("customer", CUSTOMER_RULES, 5))
def q6_customer(spark: SparkSession, sf: str) -> DataFrame:
    return Q.rule_outcomes(table(spark, sf, "customer"), CUSTOMER_RULES)


@query(
    "q7_u2_routed_silver",
    S.bronze_filled(f"SELECT {S.names(S.SILVER_COLUMNS)} FROM filled WHERE {S.SILVER_PASS}"),
)
def q7(spark: SparkSession, sf: str) -> DataFrame:
    return route(checked_patients(spark, sf))["silver"]


@query(
    "q7_u2_routed_rejected",
    S.bronze_filled(
        f"SELECT * , 'Failed' AS \"DataQualityEvaluationResult\", {S.failed_text(Q.SILVER_RULES)} AS failed_rules"
        f" FROM filled WHERE NOT ({S.SILVER_PASS})"
    ),
)
def q7_rejected(spark: SparkSession, sf: str) -> DataFrame:
    rejected = route(checked_patients(spark, sf))["rejected"]
    return rejected.withColumn("failed_rules", F.concat_ws(";", Q.FAILED_RULES)).drop(Q.FAILED_RULES)


@query(
    "q8_rules_before_sink",
    with_patients("SELECT k, sex, score FROM p"),
)
def q8(spark: SparkSession, sf: str) -> DataFrame:
    return Q.require(patients(spark, sf).select("k", "sex", "score"))


