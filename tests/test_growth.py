"""What must not grow with the tables: files, passes and uncompiled code."""

import numpy as np
from pyspark.sql import functions as F

from catalog import gold, models
from catalog.files import malformed_csv, per_batch, pieces_of
from catalog.fixture import table
from pulseframe.operators import boosting, kmeans
from pulseframe.session import small_methods

SMALL = "/root/testdata/sf0.001"


def test_a_stage_too_wide_for_the_compiler_is_not_fused(spark):
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    try:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
        assert small_methods(spark).conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "4000")
        assert small_methods(spark).conf.get("spark.sql.codegen.hugeMethodLimit") == "4000"
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", before)


def test_derived_files_grow_in_number_not_in_size(spark):
    assert [pieces_of(spark, SMALL, 4, rows) for rows in (10**9, 100)] == [4, -(-table(spark, SMALL, "orders").count() // 100)]
    lines = spark.read.text(malformed_csv(spark, SMALL, 9)).groupBy(F.input_file_name()).agg(F.count_if(F.col("value").startswith('"Sex","Age"')), F.count("*"))
    got = [tuple(r)[1:] for r in lines.collect()]
    assert len(got) == 9 and all(headers == 1 for headers, _ in got) and max(n for _, n in got) < 2 * min(n for _, n in got)


def test_a_stream_takes_up_a_bounded_number_of_files_at_a_time():
    assert [per_batch(n, 3) for n in (3, 9, 540)] == [1, 3, 24]


def test_the_star_is_built_from_silver_files(spark):
    assert gold.silver(spark, SMALL).inputFiles()[0].split("/")[-2].startswith("silver-")


def test_blocks_are_dealt_over_all_cores_however_few_files_there_are(spark, monkeypatch):
    rows = spark.range(1000).select((F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 5).cast("double").alias("y")).coalesce(1)
    seen, plain = [], boosting.packed
    monkeypatch.setattr(boosting, "packed", lambda df, *more: seen.append(df.rdd.getNumPartitions()) or plain(df, *more))
    boosting.fit_boosted(rows, ["x"], [boosting.Task("y", 0, (0,))], boosting.Growth(rounds=1))
    assert seen == [max(spark.sparkContext.defaultParallelism, 1)]


def test_points_are_dealt_over_all_cores_and_none_is_lost(spark):
    rows = spark.range(1000).select(F.array(F.col("id").cast("double")).alias("point")).coalesce(1)
    blocks = kmeans.dealt_blocks(rows)
    assert blocks.rdd.getNumPartitions() == max(spark.sparkContext.defaultParallelism, 1)
    assert blocks.agg(F.sum("n")).first()[0] == 1000


def test_each_model_s_nearest_centre_is_its_first_least(spark):
    draw = np.random.default_rng(3)
    x, stacked, starts = draw.integers(0, 4, (500, 2)).astype(float), draw.integers(0, 4, (9, 2)).astype(float), np.array([0, 2, 5])
    apart = ((x[:, None] - stacked) ** 2).sum(axis=2)
    for i, (a, b) in enumerate(((0, 2), (2, 5), (5, 9))):
        got = [(owner[i], least[i]) for _, owner, least in kmeans.nearest(x, stacked, starts, 128)]
        assert (np.concatenate([o for o, _ in got]) == a + apart[:, a:b].argmin(axis=1)).all()
        assert np.allclose(np.concatenate([d for _, d in got]), apart[:, a:b].min(axis=1))


def test_a_model_query_makes_silver_once_and_over_all_cores(spark, monkeypatch):
    made, plain = [], models.silver_from
    monkeypatch.setattr(models, "silver_from", lambda orders: made.append(plain(orders)) or made[-1])
    monkeypatch.setattr(models, "_BUNDLES", {})
    monkeypatch.setattr(models, "load_or_train", lambda spark, source, path, prepare: (prepare(source), "trained"))
    rest, test = models.held_out(spark, SMALL)
    assert len(made) == 1 and rest.count() + test.count() == made[0].count()
    assert len(made[0].inputFiles()) == spark.sparkContext.defaultParallelism


def test_filters_on_requests_do_not_copy_what_bodies_are_made_of(spark):
    """Known, unknown and bad requests each rest on the parsed body; their plans stay small, whatever the body is made of."""
    from pulseframe.operators.risk import RiskModel, Settings
    from pulseframe.schema import CATEGORY_FEATURES
    from pulseframe.sources.files import parse_requests

    body = F.concat(F.lit('{"Age": '), F.col("id"), *[F.lit(f', "{c}": "x"') for c in CATEGORY_FEATURES], F.lit("}"))
    for k in range(6):
        body = F.when(F.col("id") % 11 == k, F.lit(f"[{k}")).otherwise(F.upper(F.lower(body)) if k == 0 else body)
    df = spark.range(22).select("id", body.alias("body"))
    good, bad = parse_requests(df.withColumn("body", F.regexp_replace("body", "X", "x")))
    known, unknown = RiskModel([], [["x"]] * len(CATEGORY_FEATURES), Settings()).scorable(good)
    for part in (known, unknown, bad):
        assert part._jdf.queryExecution().optimizedPlan().toString().count("CASE WHEN") <= 60
    assert bad.count() == 22 and known.count() + unknown.count() == 0
