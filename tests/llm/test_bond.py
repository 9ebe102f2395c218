"""Hard negatives against scoring every pair in plain Python."""

import math

import numpy as np
from pyspark.sql import functions as F

from pulseframe.llm import bond
from pulseframe.llm.bond import hard_negatives, scan

SCHEMA = "vec_id long, embedding array<float>, label int, anchor_id string"


def plain(rows, every, positives=5, negatives=3):
    def whole(x):
        return x is not None and math.isfinite(x) and abs(256 * x) < 1 << 23

    kept = [
        (i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows if lab is not None and v is not None and all(map(whole, v))
    ]
    order = lambda p: (-p[0], p[1] is None, p[1] or 0)
    out = []
    for a, (i, v, lab) in enumerate(kept):
        if i is None or i % every:
            continue
        score = [(sum(x * y for x, y in zip(v, w, strict=False)), j, m) for b, (j, w, m) in enumerate(kept) if b != a]
        same = sorted([(s, j) for s, j, m in score if m == lab], key=order)[:positives]
        for p, j in same:
            fit = sorted([(s, n) for s, n, m in score if m != lab and 50 * p <= 100 * s <= 95 * p], key=order)[:negatives]
            out += [(i, j, r + 1, n, p, s) for r, (s, n) in enumerate(fit)]
    return sorted(out, key=str)


def check(spark, rows, every):
    df = spark.createDataFrame([(i, v, lab, "x") for i, v, lab in rows], SCHEMA).repartition(3)
    got = sorted(map(tuple, hard_negatives(df, F.col("vec_id") % every == 0).collect()), key=str)
    assert got == plain(rows, every)
    return got


def vectors(n, width, seed, labels=4, spread=1.0):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, 0.2, (labels, width))
    out = []
    for i in range(n):
        lab = int(rng.integers(labels))
        out.append((i, np.float32(centre[lab] * 0.5 + centre[0] * 0.5 + rng.normal(0, 0.1 * spread, width)).tolist(), lab))
    return out


def test_equals_all_pairs(spark):
    assert len(check(spark, vectors(400, 40, 1), 10)) > 100


def test_odd_rows(spark):
    rows = vectors(120, 16, 2)
    rows += [
        (None, rows[5][1], 1), (200, None, 1), (210, rows[3][1], None), (220, [float("nan")] * 16, 1), (230, [float("inf")] * 16, 1),
        (240, [0.1, None], 1), (250, [0.2, 0.3], 1), (260, [], 2), (270, [-x for x in rows[1][1]], 1), (280, [40000.0] * 16, 1), (10, rows[9][1], 3),
    ]
    check(spark, rows, 10)


def test_ties_and_repeated_rows(spark):
    same = [0.25] * 8
    rows = [(i, same, 0) for i in range(30)] + [(i, [0.2] * 8, 1) for i in range(30, 60)] + [(0, same, 0), (0, same, 0), (45, [0.2] * 8, 1)]
    assert len(check(spark, rows, 10)) > 30


def test_small_and_empty_tables(spark):
    check(spark, [(0, [0.5], 1)], 10)
    check(spark, [(0, [0.5], 1), (1, [0.5], 1), (2, [0.3], 2)], 10)
    check(spark, [(0, [0.0], 1), (1, [0.0], 1), (2, [0.0], 2)], 1)
    assert hard_negatives(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 10 == 0).count() == 0


def test_many_groups(spark, monkeypatch):
    monkeypatch.setattr(bond, "GROUP_ROWS", 16)
    check(spark, vectors(300, 20, 3), 10)


def test_scan_drops_rows_before_the_last_column():
    rng = np.random.default_rng(4)
    columns = rng.integers(-40, 40, (64, 5000))
    columns[:, :20] += 60
    anchor = rng.integers(20, 60, 64)
    seen = []

    def keep(lower, upper):
        seen.append(len(lower))
        return upper >= np.sort(lower)[-5]

    live, score = scan(columns, anchor, np.ones(5000, bool), columns.min(axis=1), columns.max(axis=1), keep)
    exact = anchor @ columns
    assert seen[-1] < 2500 and (score == exact[live]).all()
    assert set(np.argsort(-exact)[:5]) <= set(live)
