"""Inputs the fixture lacks: unknown groups, spoilt numbers, repeated rows, empty folders, unset shared folders."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from pulseframe.functions.scalar import to_type
from pulseframe.operators.impute import TierFill, fit_tiers
from pulseframe.operators.stats import student_p
from pulseframe.session import discard, scratch, shared_dir
from pulseframe.sources.files import parse_requests, read_bronze, read_parts
from pulseframe.schema import raw_schema


def test_a_stored_fill_reaches_groups_it_was_not_fitted_on(spark):
    known = spark.createDataFrame([("M", 30, 1.0), ("F", 30, 3.0)], "s string, b int, v double")
    path = scratch(spark, "fill")
    fit_tiers(known, ["v"], [["s", "b"], []]).save(path)
    new = spark.createDataFrame([("M", 40, None), (None, None, None), ("F", 30, None)], "s string, b int, v double")
    got = {(r["s"], r["b"]): (r["v"], r["v_was_imputed"]) for r in TierFill.load(spark, path).apply(new).collect()}
    assert got == {("M", 40): (1.0, True), (None, None): (1.0, True), ("F", 30): (3.0, True)}


def test_a_fill_of_protected_columns_is_stored_too(spark):
    df = spark.createDataFrame([("M", None)], "s string, v double")
    path = scratch(spark, "fill")
    fit_tiers(df, ["v"], [["s"], []], protect=["v"]).save(path)
    assert TierFill.load(spark, path).apply(df).first().asDict() == {"s": "M", "v": None, "v_was_imputed": False}


@pytest.mark.parametrize("text", ["NaN", "Infinity", "-Infinity", "1e999"])
def test_numbers_that_are_not_finite_are_missing(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(to_type(F.col("t"), "double"), to_type(F.col("t"), "int")).first() == (None, None)


def test_the_caller_s_schema_is_left_alone(spark):
    path, schema = scratch(spark, "csv"), raw_schema()
    spark.range(1).select(F.lit("x").alias("a")).write.csv(path)
    before = len(schema)
    read_bronze(spark, path, schema)
    assert len(read_bronze(spark, path, schema).columns) == before + 1 and len(schema) == before


def test_an_empty_folder_has_no_parts(spark):
    path = scratch(spark, "empty")
    spark.range(1).write.csv(path)
    with pytest.raises(FileNotFoundError):
        read_parts(spark, path)


def test_off_local_the_shared_folder_must_be_named():
    context = SimpleNamespace(master="spark://somewhere:7077", getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="checkpoint"):
        shared_dir(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default)))


def test_discard_deletes_what_was_written(spark):
    path = scratch(spark, "gone")
    spark.range(3).write.parquet(path)
    discard(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_body_reasons(spark):
    categories = '"Sex":"M","Smoking Status":"Y","Diabetes Status":"N","Physical Activity Level":"Low","Family History of CVD":"N"'
    bodies = [("{%s}" % categories, None), ("[{%s},{%s}]" % (categories, categories), None), ("[{%s}, null]" % categories, "an element is null"),
              ("5", "body is no JSON object or array"), (None, "body is no JSON object or array"), ('{"Age":"x",%s}' % categories, "Age is no number")]
    df = spark.createDataFrame([(i, b) for i, (b, _) in enumerate(bodies)], "i int, body string")
    good, bad = parse_requests(df)
    assert {r["i"]: r["reason"] for r in bad.collect()} == {i: r for i, (_, r) in enumerate(bodies) if r}
    assert sorted(r["i"] for r in good.collect()) == [0, 1, 1]


@pytest.mark.parametrize("df", [1.0, 2.5, 40.0, 1e4, 1e9, 1e13])
def test_tail_probabilities_fall_and_meet_the_limits(df):
    values = [student_p(t, df) for t in (0.0, 1e-9, 1e-3, 0.5, 2.0, 9.0, 40.0)]
    assert values[0] == 1.0 and all(a > b >= 0 for a, b in zip(values[1:], values[2:], strict=False))
    assert values[1] == pytest.approx(1.0, abs=1e-8)
    if df == 1.0:
        assert student_p(1.0, 1.0) == pytest.approx(0.5, rel=1e-10)
    if df >= 1e9:
        assert student_p(1.959963984540054, df) == pytest.approx(0.05, rel=1e-6)
