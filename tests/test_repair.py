import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pulseframe.operators import quality as Q
from pulseframe.operators.impute import impute

ROWS = [
    ("M", 40, 1.0, None), ("M", 40, 3.0, 5), ("M", 40, None, 7), ("M", 40, 2.0, 9), ("M", 40, 4.0, 11),
    ("F", 50, None, None), ("F", 50, None, 1), (None, 30, 8.0, None), (None, 30, None, 2), ("F", 60, 6.0, 4),
]
SCHEMA = "sex string, band int, x double, y int"


def by_windows(df):
    """The same fill written with whole-partition windows: fine for ten rows, not for a table."""
    whole = [Window.partitionBy("sex", "band"), Window.partitionBy(F.lit(1))]
    for c in ("x", "y"):
        df = df.withColumn(f"{c}_was_imputed", F.col(c).isNull())
        for w in whole:
            df = df.withColumn(c, F.coalesce(F.col(c), F.percentile_approx(c, 0.5).over(w)))
    return df


@pytest.mark.parametrize("exact", [False, True])
def test_lookup_form_equals_window_form(spark, exact):
    df = spark.createDataFrame(ROWS, SCHEMA)
    ours = impute(df, ["x", "y"], [["sex", "band"], []], exact=exact)
    theirs = by_windows(df).select(*ours.columns)
    assert ours.dtypes == theirs.dtypes
    assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()


def test_fill_keeps_known_cells_and_is_idempotent(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    once = impute(df, ["x", "y"], [["sex", "band"], []])
    assert once.filter("x IS NULL OR y IS NULL").isEmpty()
    again = impute(once.select(*df.columns), ["x", "y"], [["sex", "band"], []], flags=False)
    assert again.exceptAll(once.select(*df.columns)).isEmpty()


def test_empty_column_stays_empty_and_protected_column_is_not_filled(spark):
    df = spark.createDataFrame([("M", None, 1.0), ("F", None, None)], "sex string, e double, s double")
    filled = impute(df, ["e", "s"], [["sex"], []], protect=["s"])
    assert sorted((r.e is None, r.s is None, r.s_was_imputed) for r in filled.collect()) == [
        (True, False, False), (True, True, False),
    ]


def test_rules_route_every_row_once(spark):
    rules = [Q.column_count("=", 2), *Q.complete("a"), Q.values("a", ">", 0), Q.values("b", ">=", 70)]
    df = spark.createDataFrame([(1, 80), (None, 80), (-1, 60), (2, None)], "a int, b int")
    checked = Q.row_outcomes(df, rules)
    failed = {r.a: r[Q.FAILED_RULES] for r in Q.failed_rows(checked).collect()}
    assert failed == {
        None: ["IsComplete a", "ColumnValues a > 0"],
        -1: ["ColumnValues a > 0", "ColumnValues b >= 70"],
        2: ["ColumnValues b >= 70"],
    }
    assert Q.passed_rows(checked).count() + Q.failed_rows(checked).count() == 4
    found = {r.rule: (r.outcome, r.failed, r.total) for r in Q.rule_outcomes(df, rules).collect()}
    assert found["ColumnCount = 2"] == ("Passed", 0, 4)
    assert found["ColumnValues a > 0"] == ("Failed", 2, 4)


def test_dataset_rule_stops_a_write(spark):
    with pytest.raises(ValueError, match="ColumnCount = 9"):
        Q.require(spark.range(1), [Q.column_count("=", 9)])
