import random

import pytest

from pulseframe.functions.lookup import lookup
from pulseframe.functions.names import TRAINING_RULES, canonical_names, clean_names, flag_name
from pulseframe.functions.quantiles import exact_quantiles
from pulseframe.operators import mapping as M
from pulseframe.operators.stats import student_p
from pulseframe.schema import silver_types


def test_flag_names_and_silver_width():
    assert flag_name("Total Cholesterol (mg/dL)") == "total_cholesterol_mg_dl_was_imputed"
    assert flag_name("Waist-to-Height Ratio") == "waist_to_height_ratio_was_imputed"
    assert len(silver_types()) == 35


def test_names_lose_their_suffix():
    names = canonical_names(["Age#1", "BMI#4", "Systolic_BP#12", "weight_kg_was_imputed#20", "Height_(cm)#3"])
    assert list(names.values()) == ["Age", "BMI", "Systolic BP", "weight_kg_was_imputed", "Height (cm)"]
    assert canonical_names(["weight_kg#1"], TRAINING_RULES) == {"weight_kg#1": "Weight_kg"}


def test_two_names_for_one_column_are_refused(spark):
    with pytest.raises(ValueError, match="several columns"):
        clean_names(spark.createDataFrame([(1, 2)], "`sex#1` int, `Sex_code` int"))


def test_required_columns(spark):
    with pytest.raises(KeyError, match="b"):
        M.require_columns(spark.range(1), ["id", "b"])


def test_typed_fields_never_fail(spark):
    df = spark.createDataFrame([("12",), ("12.0",), (" 12 ",), ("",), ("x",), (None,)], "a string")
    got = [r.a for r in M.apply_mapping(df, [("a", "a", "int")]).collect()]
    assert got == [12, 12, 12, None, None, None]


def test_pairs_fill_only_what_is_missing(spark):
    rows = [(None, None, "125/79"), (120, None, "125/79"), (None, None, "125"), (None, None, "125/"),
            (None, None, "/79"), (None, None, "abc"), (None, None, None)]
    df = spark.createDataFrame(rows, "s int, d bigint, t string")
    got = [tuple(r) for r in M.split_pair(df, "t", "s", "d").collect()]
    assert got == [(125, 79), (120, 79), (125, None), (125, None), (None, 79), (None, None), (None, None)]


@pytest.mark.parametrize(("t", "df", "p"), [(12.706, 1, 0.05), (2.228, 10, 0.05), (2.750, 30, 0.01), (1.960, 1e9, 0.05)])
def test_p_values_against_t_tables(t, df, p):
    assert student_p(t, df) == pytest.approx(p, rel=2e-3)
    assert student_p(0.0, df) == pytest.approx(1.0)


@pytest.mark.parametrize(
    "how", [{}, {"few_values": 0}, {"few_values": 0, "accuracy": 50, "max_values": 8}, {"few_values": 60, "accuracy": 50}]
)
@pytest.mark.parametrize("interpolate", [False, True])
def test_exact_quantiles_against_sorting(spark, how, interpolate):
    """Counting, searching and narrowing all give what sorting gives; one group holds most rows."""
    random.seed(3)
    rows = [
        (random.choice(["hot"] * 8 + ["cold", None]), random.lognormvariate(2, 2), random.randint(0, 40))
        for _ in range(900)
    ] + [("cold", None, None)]
    df = spark.createDataFrame(rows, "g string, x double, y int").coalesce(2)
    found = {r.g: r for r in exact_quantiles(df, ["g"], ["x", "y"], [0.25, 0.5], interpolate, **how).collect()}
    for group in ("hot", "cold", None):
        for i, name in ((1, "x"), (2, "y")):
            data = sorted(float(r[i]) for r in rows if r[0] == group and r[i] is not None)
            for j, prob in enumerate((0.25, 0.5)):
                if interpolate:
                    at = (len(data) - 1) * prob
                    low = data[int(at)]
                    want = low + (data[min(int(at) + 1, len(data) - 1)] - low) * (at - int(at))
                else:
                    want = data[max(-(-len(data) * prob // 1), 1).__int__() - 1]
                assert found[group][name][j] == pytest.approx(want, rel=1e-12)


def test_lookup_beyond_the_broadcast_limit(spark):
    left = spark.createDataFrame([("a", 1)] * 50 + [(None, 2), ("z", 3)], "k string, n int")
    right = spark.createDataFrame([("a", 10.0), (None, 20.0)], "k string, v double")
    small = sorted(map(tuple, lookup(left, right, ["k"]).collect()), key=str)
    salted = lookup(left, right, ["k"], limit=0, salts=4)
    assert sorted(map(tuple, salted.collect()), key=str) == small
    assert "BroadcastHint" not in salted._jdf.queryExecution().logical().toString()
    assert sum(1 for r in small if r[2] == 10.0) == 50 and ("z", 3, None) in small and (None, 2, 20.0) in small
