"""K-means and silhouettes against plain versions, and the risk model's edges."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from catalog import load
from pulseframe.operators import kmeans as K
from pulseframe.operators.cohorts import FEATURES, Cohorts, fit_cohorts, fit_scaler, sweep_models
from pulseframe.operators.risk import LEVEL_OUT, SCORE_OUT, RiskModel, Settings, train, train_variants
from pulseframe.plans.training import level_report
from pulseframe.schema import CATEGORY_FEATURES, LEVEL, NUMERIC_FEATURES, SCORE
from pulseframe.session import scratch


def points(n, seed, width=3):
    draw = np.random.default_rng(seed)
    return np.round(draw.normal(0, 1, (n, width)) + 4 * draw.integers(0, 3, (n, 1)), 3)


def frame(spark, x):
    return spark.createDataFrame([(p.tolist(),) for p in x], f"{K.POINT} array<double>").repartition(3)


def lloyd(x, centres, tol=1e-4, steps=300):
    scale = tol * x.var(axis=0).mean()
    for _ in range(steps):
        own = ((x[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
        new = np.array([x[own == k].mean(axis=0) if (own == k).any() else centres[k] for k in range(len(centres))])
        shift = ((new - centres) ** 2).sum()
        centres = new
        if shift <= scale:
            break
    return centres, ((x[:, None] - centres) ** 2).sum(axis=2).min(axis=1).sum()


def silhouette(x, own, squared):
    apart = ((x[:, None] - x) ** 2).sum(axis=2)
    apart = apart if squared else np.sqrt(apart)
    out = []
    for i in range(len(x)):
        mine = own == own[i]
        if mine.sum() < 2:
            out.append(0.0)
            continue
        a = apart[i][mine].sum() / (mine.sum() - 1)
        b = min(apart[i][own == k].mean() for k in set(own) - {own[i]})
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


def test_all_models_move_as_each_alone_would(spark):
    x = points(400, 1)
    df = frame(spark, x)
    blocks = K.point_blocks(df).persist()
    wanted = [(k, s) for k in (2, 3, 5) for s in (1, 2)]
    models = K.fit_many(df, blocks, wanted)
    start = K.sampled(df)
    assert sorted(map(tuple, start)) == sorted(map(tuple, x))
    for (k, seed), m in zip(wanted, models, strict=True):
        centres, cost = lloyd(x, K.first_centres(start, k, seed))
        assert (m.k, m.seed) == (k, seed) and np.allclose(m.centres, centres) and m.cost == pytest.approx(cost)
        assert m.sizes.sum() == 400
    best = list(K.best_of(models).values())
    squared, plain = K.squared_silhouettes(blocks, best), K.euclidean_silhouettes(df, blocks, best)
    sampled = K.euclidean_silhouettes(df, blocks, best, sample=150)
    for m, s, (e, error, n), (part, spread, few) in zip(best, squared, plain, sampled, strict=True):
        own = ((x[:, None] - m.centres) ** 2).sum(axis=2).argmin(axis=1)
        assert s == pytest.approx(silhouette(x, own, True)) and e == pytest.approx(silhouette(x, own, False))
        assert (error, n, few) == (0.0, 400, 150) and abs(part - e) < 4 * spread and spread > 0
    blocks.unpersist()


def test_few_and_equal_rows(spark):
    df = frame(spark, np.ones((5, 2)))
    blocks = K.point_blocks(df)
    (m,) = K.fit_many(df, blocks, [(3, 0)])
    assert m.cost == 0 and sorted(m.sizes) == [0, 0, 5]
    assert np.isnan(K.squared_silhouettes(blocks, [m])[0]) and np.isnan(K.euclidean_silhouettes(df, blocks, [m])[0][0])
    assert K.fit_many(df.limit(0), blocks, [(3, 0)]) == []


def test_cohorts_are_stored(spark):
    df = spark.createDataFrame([(i, float(i % 7), None if i % 9 == 0 else i % 5) for i in range(200)], "k int, a double, b int")
    fitted = fit_cohorts(df, ["a", "b"], 3, 2)
    path = scratch(spark, "cohorts")
    fitted.save(path)
    rows = sorted(map(tuple, fitted.assign(df).collect()), key=str)
    assert rows == sorted(map(tuple, Cohorts.load(path).assign(df).collect()), key=str) and len(fitted.tried) == 2
    scaled = fit_scaler(df, ["a", "b"]).transform(df).select(vector_to_array(F.col(FEATURES)).alias("p")).collect()
    x = np.array([r["p"] for r in scaled])
    assert fitted.cost == pytest.approx(((x[:, None] - np.array(fitted.centres)) ** 2).sum(axis=2).min(axis=1).sum())
    assert sweep_models(df.limit(0), ["a", "b"], [2], 1, figures=False)[1] == []
    with pytest.raises(ValueError):
        fit_cohorts(df.limit(0), ["a", "b"])


def screened(spark, n):
    k = F.col("id")
    numbers = {c: F.when((k + i) % 11 > 0, (k * (7 + i) % 53).cast("double")) for i, c in enumerate(NUMERIC_FEATURES)}
    labels = {c: F.when((k + i) % 13 > 0, F.element_at(F.array(F.lit("N"), F.lit("Y")), (k * (3 + i) % 2 + 1).cast("int"))) for i, c in enumerate(CATEGORY_FEATURES)}
    score = (k * 7 % 53) + F.when(k * 3 % 2 == 1, 20).otherwise(0)
    level = F.when(score > 45, "HIGH").when(score > 20, "INTERMEDIARY").otherwise("LOW")
    columns = numbers | labels | {SCORE: score.cast("double"), LEVEL: level}
    return spark.range(n).select("id", *[v.alias(c) for c, v in columns.items()])


def test_a_stored_model_scores_alike_and_missing_numbers_are_scored(spark):
    df = screened(spark, 900)
    settings = Settings(rounds=8)
    with_signal, without = train_variants(df, settings)
    path = scratch(spark, "risk")
    with_signal.save(path)
    loaded = RiskModel.load(spark, path)
    assert loaded.settings == settings and not without.settings.use_signal
    rows = lambda m: sorted(map(tuple, m.score(df).select("id", LEVEL_OUT, SCORE_OUT).collect()))
    assert rows(loaded) == rows(with_signal) and rows(without) != rows(with_signal)
    empty = df.limit(5).withColumns({c: F.lit(None).cast("double") for c in NUMERIC_FEATURES})
    assert loaded.score(empty).where(f"{SCORE_OUT} IS NULL OR {LEVEL_OUT} IS NULL").count() == 0
    figures = {r["level"]: r for r in level_report(loaded, df).collect()}
    assert sum(r["n"] for r in figures.values()) == 900 == sum(r["predicted"] for r in figures.values())
    scored = loaded.score(df).persist()
    for level, r in figures.items():
        assert r["right"] == scored.where((F.col(LEVEL) == level) & (F.col(LEVEL_OUT) == level)).count()


def test_unknown_categories(spark):
    df = screened(spark, 300)
    odd = df.limit(4).withColumn("Sex", F.lit("X"))
    model = train(df, Settings(rounds=2))
    good, bad = model.scorable(df.limit(3).unionByName(odd))
    assert (good.count(), bad.count()) == (3, 4) and bad.first()["reason"] == "Sex: X"
    with pytest.raises(Exception, match="unknown label X"):
        model.score(odd).collect()
    assert train(df, Settings(rounds=2, unseen="keep")).score(odd).count() == 4
    assert train(df, Settings(rounds=2, unseen="skip")).score(df.limit(3).unionByName(odd)).count() == 3


def test_several_classes_are_no_worse_than_one_against_the_rest(spark):
    df = screened(spark, 1500)
    learn, test = df.where("id % 5 > 0"), df.where("id % 5 = 0")
    right = {}
    for kind in ("boosted", "one_vs_rest"):
        scored = train(learn, Settings(rounds=12, kind=kind, bins=64)).score(test)
        right[kind] = scored.agg(F.avg((F.col(LEVEL) == F.col(LEVEL_OUT)).cast("int"))).first()[0]
    assert right["boosted"] >= right["one_vs_rest"]


def test_the_pairwise_silhouette_covers_all_rows_in_blocks(spark):
    draw = np.random.default_rng(8)
    x = np.concatenate([draw.normal(c, 1, (60, 2)) for c in (-2, 0, 3)])
    x = np.concatenate([x, x[:45]])  # equal rows
    rows = spark.createDataFrame([(p.tolist(),) for p in x], "point array<double>").repartition(5)
    models = [K.Fitted(3, 0, np.array([[-2.0, -2], [0, 0], [3, 3]])), K.Fitted(1, 0, np.zeros((1, 2))), K.Fitted(2, 0, np.array([[-1.0, 0], [2, 2]]))]
    got = K.exact_silhouettes(rows, models, rows=16)
    apart = np.sqrt(((x[:, None] - x) ** 2).sum(axis=2))
    for model, (mean, n) in zip(models, got, strict=True):
        own = ((x[:, None] - model.centres) ** 2).sum(axis=2).argmin(axis=1)
        if model.k == 1:
            assert np.isnan(mean)
            continue
        sums = np.stack([apart[:, own == c].sum(axis=1) for c in range(model.k)], axis=1)
        sizes = np.bincount(own, minlength=model.k)
        a = sums[np.arange(len(x)), own] / (sizes[own] - 1)
        b = np.where(np.arange(model.k) == own[:, None], np.inf, sums / sizes).min(axis=1)
        assert n == len(x) and mean == pytest.approx(((b - a) / np.maximum(a, b)).mean(), abs=1e-9)
    assert all(np.isnan(m) for m, _ in K.exact_silhouettes(rows.limit(0), models))


def test_the_silhouette_query_takes_no_sample(spark, monkeypatch):
    monkeypatch.setattr(K, "sampled", None)
    n = spark.read.parquet("/root/testdata/sf0.001/customer.parquet").count()
    assert tuple(load()["a18_euclidean_silhouette"].run(spark, "/root/testdata/sf0.001").first())[1:] == (0.0, n)


@pytest.mark.parametrize("rows", [5, 700])
def test_a_step_holds_few_distances_and_gives_ties_to_the_first_centre(monkeypatch, rows):
    """Sums of all models, some with equal centres, are those of the nearest centre by itself, in chunks of a fixed number of cells."""
    monkeypatch.setattr(K, "HELD_CELLS", 64 * 9)
    draw = np.random.default_rng(rows)
    x = draw.integers(-2, 3, (rows, 2)).astype(float)
    stacked, starts = np.array([[0, 0], [1, 1], [0, 0], [1, 0], [-1, 0], [2, 2], [2, 2], [2, 2], [0, 1]], float), np.array([0, 2, 4, 6])
    members = K.Members(stacked, starts)
    assert members.runs == [(0, 3, 2), (6, 1, 3)] and members.cells.size == members.apart.cells.size == 64 * 9
    batch = pa.RecordBatch.from_arrays([pa.array([rows], pa.int32()), pa.array([x.tobytes()], pa.binary())], ["n", "points"])
    told = {r["centre"]: r for b in K.added_up(stacked, starts)(iter([batch])) for r in b.to_pylist()}
    for a, b in ((0, 2), (2, 4), (4, 6), (6, 9)):
        apart = ((x[:, None] - stacked[a:b]) ** 2).sum(axis=2)
        own = apart.argmin(axis=1)
        for i in range(b - a):
            mine = own == i
            if not mine.any():
                assert a + i not in told
                continue
            row = told[a + i]
            assert row["n"] == mine.sum() and row["sums"] == x[mine].sum(axis=0).tolist()
            assert abs(row["cost"] - apart[mine, i].sum()) < 1e-9 and abs(row["squares"] - (x[mine] ** 2).sum()) < 1e-9
