"""Medians from counts, exact splits, and codes by tables."""

import random

import pytest
from pyspark.sql import functions as F

from pulseframe.functions.quantiles import exact_quantiles, quantiles_of_counts
from pulseframe.operators.encode import encode_by_tables, exact_hold_out, label_codes
from pulseframe.operators.impute import count_cells, fit_tiers


def cells(spark, n, seed):
    draw = random.Random(seed)
    pick = lambda *x: draw.choice([*x, None])
    rows = [(pick("M", "F"), pick(1, 2, 3), pick(*range(9)), pick(*[k / 4 for k in range(50)]), None if k % 5 else 7.0) for k in range(n)]
    return spark.createDataFrame(rows, "s string, b int, x int, y double, z double").repartition(3)


def lower_median(values):
    known = sorted(v for v in values if v is not None)
    return known[(len(known) + 1) // 2 - 1] if known else None


@pytest.mark.parametrize("n", [0, 1, 2, 37, 400])
def test_tiers_from_counts_equal_a_plain_fill(spark, n):
    df = cells(spark, n, n)
    rows = [list(r) for r in df.collect()]
    for group in ((0, 1), (0,), ()):
        for column in (2, 3, 4):
            held = {}
            for r in rows:
                held.setdefault(tuple(r[k] for k in group), []).append(r[column])
            for r in rows:
                if r[column] is None:
                    r[column] = ("fill", lower_median(held[tuple(r[k] for k in group)]))
        for r in rows:
            r[2:] = [v[1] if isinstance(v, tuple) else v for v in r[2:]]
    fill = fit_tiers(df, ["x", "y", "z"], [["s", "b"], ["s"], []], flags=False, exact=True)
    assert sorted(map(tuple, fill.apply(df).collect()), key=str) == sorted(map(tuple, rows), key=str)


def test_counts_are_read_once_from_the_source(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = cells(spark, 200, 3)
    fit_tiers(df.mapInArrow(count, df.schema), ["x", "y", "z"], [["s", "b"], []], exact=True)
    assert seen.value == 200


@pytest.mark.parametrize("max_values", [3, 1 << 20])
def test_quantiles_of_counts(spark, max_values):
    df, probs = cells(spark, 300, 8), [0.1, 0.5, 0.9]
    for interpolate in (False, True):
        want = exact_quantiles(df, ["s"], ["x", "y"], probs, interpolate)
        got = quantiles_of_counts(count_cells(df, ["s"], ["x", "y"]), ["s"], ["x", "y"], probs, interpolate, max_values)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


@pytest.mark.parametrize(("n", "percent"), [(0, 20), (1, 20), (2, 50), (101, 20), (1000, 7), (1000, 100), (1000, 0)])
def test_the_split_has_its_size(spark, n, percent):
    df = spark.range(n).select(F.when(F.col("id") % 50 > 0, F.col("id") * 7919 - (1 << 62)).alias("k"), (F.col("id") % 3).alias("h"), "id")
    for bins in (2, 1 << 16):
        held = exact_hold_out(df, [F.col("h"), F.col("k"), F.col("id")], percent, bins)
        got = [r["id"] for r in df.filter(held).collect()]
        rows = sorted(((r["h"], r["k"] is not None, r["k"] or 0, r["id"]) for r in df.collect()))
        assert sorted(got) == sorted(r[-1] for r in rows[: -(-n * percent // 100)])
        assert df.filter(held).count() + df.filter(~held).count() == n


def test_equal_rows_stay_together(spark):
    df = spark.createDataFrame([(1,)] * 6 + [(2,)] * 4, "k long")
    assert df.filter(exact_hold_out(df, [F.col("k")], 20)).count() == 6


def test_codes_of_many_labels(spark):
    labels = [f"{k * 7919 % 5003:04d}é" if k % 3 else f"x{k}" for k in range(3000)] + [None, "", "None", "Ω"]
    df = spark.createDataFrame([(x,) for x in labels * 2], "v string").repartition(9)
    order = sorted({"None" if x is None else x for x in labels}, key=lambda x: x.encode())
    assert dict(map(tuple, label_codes(df, "v").collect())) == {x: i for i, x in enumerate(order)}
    coded, tables = encode_by_tables(df.withColumn("w", F.lit(3)), ["v", "w"])
    assert coded.columns == ["v", "w", "v__code", "w__code"] and coded.count() == len(labels) * 2
    assert all(r["w__code"] == 0 and order[r["v__code"]] == ("None" if r["v"] is None else r["v"]) for r in coded.collect())
    assert label_codes(df.limit(0), "v").count() == 0
