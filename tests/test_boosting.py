"""Boosting against a plain version that grows one tree at a time, row by row."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pulseframe.operators import boosting as B
from pulseframe.operators.boosting import MISSING, Growth, Task, bin_edges, fit_boosted

FEATURES = ["a", "b", "c"]


def rows(n, seed):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = draw.random() * 10, draw.randint(0, 5), draw.gauss(0, 1)
        score = 3 * a + (8 if b > 2 else 0) + (c if a > 5 else -c) + draw.gauss(0, 0.5)
        # Missing values that say something, in both directions.
        a = None if (score > 30 and draw.random() < 0.4) else a
        c = float("nan") if (score < 10 and draw.random() < 0.4) else c
        out.append((i, a, b, c, int(score > 15) + int(score > 25), score))
    return out


def frame(spark, data, parts=3):
    return spark.createDataFrame(data, "k long, a double, b int, c double, level int, score double").repartition(parts)


def binned(value, edges):
    return MISSING if value is None or math.isnan(value) else sum(e < value for e in edges)


class Plain:
    """One tree, best leaf first; each leaf looks at every split of its own rows."""

    def __init__(self, x, g, h, unit, growth):
        self.x, self.g, self.h, self.unit, self.growth = x, g, h, unit, growth
        self.value = [0.0] * len(x)
        leaves = [(list(range(len(x))), self.best(list(range(len(x)))), 0)]
        made = 0
        while len(leaves) < growth.leaves and any(s for _, s, _ in leaves):
            at = max((i for i, (_, s, _) in enumerate(leaves) if s), key=lambda i: (leaves[i][1][0], -leaves[i][2]))
            mine, (_, f, cut, missing_left), _ = leaves.pop(at)
            left = [i for i in mine if (missing_left if x[i][f] == MISSING else x[i][f] <= cut)]
            right = [i for i in mine if i not in set(left)]
            for part in (left, right):
                made += 1
                leaves.append((part, self.best(part), made))
        self.sizes = sorted(len(p) for p, _, _ in leaves)
        for part, _, _ in leaves:
            for i in part:
                self.value[i] = -growth.step * sum(g[j] for j in part) * unit[0] / (sum(h[j] for j in part) * unit[1])

    def best(self, mine):
        total = sum(self.g[i] for i in mine), sum(self.h[i] for i in mine), len(mine)
        found = None
        for side in (False, True):
            for f in range(len(self.x[0])):
                missing = [i for i in mine if self.x[i][f] == MISSING]
                if side and not missing:
                    continue
                for cut in range(MISSING):
                    left = [i for i in mine if (side if self.x[i][f] == MISSING else self.x[i][f] <= cut)]
                    sums = sum(self.g[i] for i in left), sum(self.h[i] for i in left), len(left)
                    rest = [a - b for a, b in zip(total, sums, strict=True)]
                    if min(sums[2], rest[2]) < self.growth.smallest_leaf or min(sums[1], rest[1]) * self.unit[1] < 1e-3:
                        if not [i for i in mine if self.x[i][f] != MISSING and self.x[i][f] > cut]:
                            break
                        continue
                    worth = lambda s: (s[0] * self.unit[0]) ** 2 / (s[1] * self.unit[1])
                    gain = worth(sums) + worth(rest) - worth(total)
                    if gain > 0 and (found is None or gain > found[0]):
                        found = gain, f, cut, side if missing else 2 * sums[2] > total[2]
        return found


def plain_fit(data, edges, growth, classes):
    x = [[binned(r[1 + i], e) for i, e in enumerate(edges)] for r in data]
    y = [r[4] if classes else r[5] for r in data]
    if classes:
        margin = [[math.log(max(sum(t == k for t in y), 0.5) / len(y))] * len(y) for k in range(classes)]
        unit = (2.0**-28, 2.0**-28)
    else:
        mean = sum(y) / len(y)
        margin = [[mean] * len(y)]
        unit = (2.0 ** (math.ceil(math.log2(max(max(y) - mean, mean - min(y)))) - 28), 1.0)
    sizes = []
    for _ in range(growth.rounds):
        new = []
        for k in range(len(margin)):
            if classes:
                e = [[math.exp(m[i] - max(c[i] for c in margin)) for i in range(len(y))] for m in margin]
                p = [e[k][i] / sum(c[i] for c in e) for i in range(len(y))]
                g, h = [p[i] - (y[i] == k) for i in range(len(y))], [q * (1 - q) for q in p]
            else:
                g, h = [margin[0][i] - y[i] for i in range(len(y))], None
            g = [round(v / unit[0]) for v in g]
            h = [round(v / unit[1]) for v in h] if h else [1] * len(y)
            tree = Plain(x, g, h, unit, growth)
            sizes.append(tree.sizes)
            new.append(tree.value)
        margin = [[a + b for a, b in zip(m, v, strict=True)] for m, v in zip(margin, new, strict=True)]
    return np.array(margin), sizes


def columns(data):
    return [np.array([np.nan if r[1 + i] is None else r[1 + i] for r in data], float) for i in range(3)]


@pytest.mark.parametrize("small", [0, 90, 1 << 17])
def test_equals_the_plain_version(spark, small):
    data, growth = rows(240, 1), Growth(rounds=3, bins=12, leaves=6, smallest_leaf=8)
    df = frame(spark, data)
    edges = bin_edges(df, FEATURES, growth.bins)
    level, score = fit_boosted(df, FEATURES, [Task("level", 3, (0, 1, 2)), Task("score", 0, (0, 1, 2))], growth, small)
    for model, classes in ((level, 3), (score, 0)):
        margin, sizes = plain_fit(data, edges, growth, classes)
        assert np.abs(model.margins(columns(data)) - margin).max() < 1e-9
        assert [sum(t.feature < 0) for r in model.trees for t in r] == [len(s) for s in sizes]


def test_trees_do_not_depend_on_how_rows_are_dealt(spark):
    data, growth = rows(900, 2), Growth(rounds=12)
    made = [
        fit_boosted(frame(spark, data, p).orderBy(F.rand(p)), FEATURES, [Task("score", 0, (0, 1, 2))], growth, small)[0]
        for p, small in ((1, 1 << 17), (5, 300))
    ]
    for a, b in zip(made[0].trees, made[1].trees, strict=True):
        assert all(np.array_equal(x, y) for s, t in zip(a, b, strict=True) for x, y in zip(s, t, strict=True))


def test_a_task_sees_its_own_features_only(spark):
    data = rows(400, 3)
    both = fit_boosted(frame(spark, data), FEATURES, [Task("score", 0, (0, 2)), Task("score", 0, (0, 1, 2))], Growth(rounds=4))
    assert not any(1 in t.feature for r in both[0].trees for t in r) and any(1 in t.feature for r in both[1].trees for t in r)


def test_missing_values_go_where_they_fit(spark):
    data = [(i, None if i % 2 else float(i % 7), 0, 0.0, 0, 10.0 if i % 2 else 1.0) for i in range(400)]
    model = fit_boosted(frame(spark, data), FEATURES, [Task("score", 0, (0, 1, 2))], Growth(rounds=60))[0]
    got = model.margins(columns(data))[0]
    assert np.abs(got - [r[5] for r in data]).max() < 0.1


def test_leaves_and_sizes(spark):
    data = rows(3000, 4)
    model = fit_boosted(frame(spark, data), FEATURES, [Task("score", 0, (0, 1, 2))], Growth(rounds=2))[0]
    for trees in model.trees:
        assert sum(trees[0].feature < 0) == 31
        leaf = np.zeros(3000)
        bins = np.stack([np.array([binned(v, e) for v in c], np.uint8) for c, e in zip(columns(data), model.edges, strict=True)])
        trees[0].add_to(leaf, bins)
        assert min(np.unique(leaf, return_counts=True)[1]) >= 20


@pytest.mark.parametrize("n", [0, 1, 39])
def test_small_tables_give_start_values(spark, n):
    data = rows(n, 5)
    level, score = fit_boosted(frame(spark, data), FEATURES, [Task("level", 3, (0, 1, 2)), Task("score", 0, (0, 1, 2))], Growth(rounds=3))
    if n:
        assert np.allclose(score.margins(columns(data))[0], np.mean([r[5] for r in data]))
    assert level.margins([np.array([1.0])] * 3).shape == (3, 1)


def test_edges(spark):
    df = spark.range(5000).select(
        (F.col("id") % 3).alias("few"), F.col("id").alias("many"), F.lit(None).cast("double").alias("none"), F.lit(4).alias("one"))
    few, many, none, one = bin_edges(df, df.columns, 255)
    assert few.tolist() == [0.5, 1.5] and len(none) == 0 and len(one) == 0
    assert 250 <= len(many) <= 254
    sizes = np.diff(np.concatenate([[-1], many, [4999]]))
    assert sizes.max() < 2.5 * 5000 / 255


def grown(bins, g, leaves):
    tree = B.Growing(tuple(range(len(bins))), Growth(leaves=leaves, smallest_leaf=2), (2.0**-28, 1.0), bins.shape[1], 0, False)
    codes, held = B.fused(bins), {0: np.arange(bins.shape[1])}
    while wanted := tree.wanted():
        B.dropped(held, bins, tree.shape())
        tree.take({n: B.histogram(codes, held[n], g, None) for n in wanted}, len(bins))
    return tree.finished()


def some_bins(n, seed):
    draw = np.random.default_rng(seed)
    bins = np.stack([draw.integers(0, k, n) for k in (200, 2, 3, 90, 4)]).astype(np.uint8)
    bins[:, draw.random(n) < 0.1] = MISSING
    return bins, draw.integers(-(2**27), 2**27, n)


@pytest.mark.parametrize("leaves", [1, 2, 31, 50, 80])
def test_all_trees_at_once_add_what_each_tree_adds(leaves):
    bins, g = some_bins(3000, leaves)
    rounds = [[grown(bins, np.roll(g, 2 * r + k), leaves) for k in range(2)] for r in range(3)]
    plain, margin = np.zeros((2, 3000)), np.zeros((2, 3000))
    for trees in rounds:
        for k, tree in enumerate(trees):
            tree.add_to(plain[k], bins)
    B.Forest(rounds).add_to(margin, bins)
    assert (margin == plain).all() and (leaves == 1 or plain.std() > 0)


def test_features_that_share_a_code_keep_their_own_sums():
    bins, g = some_bins(2000, 5)
    codes, mine = B.fused(bins), np.arange(0, 2000, 3)
    assert len(codes) < len(bins) and sorted(f for c in codes for f in c.features) == list(range(len(bins)))
    for h in (np.abs(g), None):
        got = B.histogram(codes, mine, g, h)
        for f, b in enumerate(bins):
            for k, weight in enumerate((g, np.ones(2000, np.int64) if h is None else h, np.ones(2000, np.int64))):
                want = np.zeros(256, np.int64)
                np.add.at(want, b[mine], weight[mine])
                assert (got[k, f] == want).all()


def test_numbers_handed_over_come_back_whole():
    small, large = np.array([5, -7, 2**31 - 1]), np.array([2**40, -3])
    sizes, held = [3, 2], [B.thin(x, np.arange(len(x))) for x in (small, large)]
    assert [len(x) for x in held] == [12, 16]
    assert B.thick([pa.scalar(x, pa.binary()) for x in held], sizes).tolist() == [*small, *large]
    assert B.thin(None, np.arange(3)) == b"" and B.thick([pa.scalar(b"", pa.binary())], [3]) is None


def test_features_of_some_sixty_bins_share_a_code():
    """Two codes for five features, and the sums are those of each feature by itself."""
    rng = np.random.default_rng(3)
    bins = np.stack([rng.integers(0, n, 5000) for n in (60, 3, 65, 110, 2)]).astype(np.uint8)
    codes = B.fused(bins)
    assert sorted(len(c.features) for c in codes) == [2, 3]
    g, h = rng.integers(-1 << 27, 1 << 27, 5000), rng.integers(0, 1 << 26, 5000)
    mine = np.flatnonzero(rng.random(5000) < 0.4)
    for f, sums in enumerate(B.histogram(codes, mine, g, h).transpose(1, 0, 2)):
        for weight, got in zip((g, h, np.ones(5000, np.int64)), sums, strict=True):
            assert got.tolist() == np.bincount(bins[f, mine], weight[mine], 256).astype(np.int64).tolist()


def test_all_rounds_are_one_job_and_the_trees_those_of_the_waves(spark, monkeypatch):
    """Several tasks hold the rows between them; the driver starts no job for a wave."""
    data, growth = rows(2000, 6), Growth(rounds=6)
    tasks = [Task("level", 3, (0, 1, 2)), Task("score", 0, (2, 0)), Task("score", 0, (0, 1, 2))]
    df = frame(spark, data, 8).persist()
    waves = fit_boosted(df, FEATURES, tasks, growth, small=300)
    monkeypatch.setattr(B, "TASK_ROWS", 500)
    tracker, seen = spark.sparkContext.statusTracker(), "boosting-jobs"
    spark.sparkContext.setJobGroup(seen, seen)
    together = fit_boosted(df, FEATURES, tasks, growth)
    jobs = tracker.getJobIdsForGroup(seen)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    df.unpersist()
    assert len(jobs) < 12
    for a, b in zip(waves, together, strict=True):
        assert len(a.trees) == len(b.trees) == growth.rounds
        for s, t in zip(a.trees, b.trees, strict=True):
            assert all(np.array_equal(x, y) for p, q in zip(s, t, strict=True) for x, y in zip(p, q, strict=True))


def test_rows_of_many_features_in_words():
    """Sums of rows whose codes stand four in a word are those of the plain codes, with and without second derivatives."""
    rng = np.random.default_rng(8)
    bins = rng.integers(0, 200, (9, 3000)).astype(np.uint8)
    held, mine = B.Held.of(bins), np.flatnonzero(rng.random(3000) < 0.3)
    assert len(held.words) > 1
    pairs = rng.integers(-(2**28), 2**28, (3000, 2)).astype(np.int32)
    plain = [pairs[:, i].astype(np.int64) for i in range(2)]
    for some in (mine, np.arange(3000)):
        assert (held.histogram(some, pairs.view(np.int64)[:, 0]) == B.histogram(B.fused(bins), some, *plain)).all()
        assert (held.histogram(some, np.ascontiguousarray(pairs[:, 0])) == B.histogram(B.fused(bins), some, plain[0], None)).all()
