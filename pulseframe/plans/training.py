"""Load or train, refresh on new data, and the hold-out report."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.functions.names import ref
from pulseframe.operators.encode import exact_hold_out
from pulseframe.operators.risk import LEVEL_OUT, SCORE_OUT, RiskModel, Settings, train, train_variants
from pulseframe.operators.stats import regression_metrics
from pulseframe.schema import LEVEL, SCORE

log = logging.getLogger(__name__)

FINGERPRINT = "files bigint, bytes bigint, digest bigint, rows bigint"


def fingerprint(source: DataFrame) -> DataFrame:
    """Which files a table consists of, in one row. Reads file metadata only and does not depend on order."""
    files = source.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    per_file = files.groupBy("file_path", "file_size", "file_modification_time").agg(F.count(F.lit(1)).alias("rows"))
    return per_file.agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("file_size").alias("bytes"),
        F.bit_xor(F.xxhash64("file_path", "file_size", F.unix_micros("file_modification_time"))).alias("digest"),
        F.sum("rows").alias("rows"),
    )


def load_or_train(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    prepare=None,
    settings: Settings | None = None,
    refresh: bool = True,
) -> tuple[RiskModel, str]:
    """The stored model if there is one for this data, else a newly trained and stored one.

    ``source`` is read from files; ``prepare`` turns it into training rows. With ``refresh`` a model trained on other
    files is replaced. Returns the model and how it came about: loaded, trained or refreshed.
    """
    settings = settings or Settings()
    now = fingerprint(source).first()
    how = "trained"
    try:
        then = spark.read.schema(FINGERPRINT).json(f"{path}/source").first()
        if not refresh or tuple(then) == tuple(now):
            model = RiskModel.load(spark, path)
            if model.settings == settings:
                return model, "loaded"
        how = "refreshed"
    except Exception as problem:
        log.info("no usable model at %s: %s", path, str(problem).splitlines()[0])
    model = train(prepare(source) if prepare else source, settings)
    try:
        model.save(path)
        spark.createDataFrame([tuple(now)], FINGERPRINT).coalesce(1).write.mode("overwrite").json(f"{path}/source")
    except Exception as problem:
        log.warning("model could not be stored at %s: %s", path, str(problem).splitlines()[0])
    return model, how


def split_rows(df: DataFrame, key: Column, percent: int = 20, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test): exactly ``percent`` % of the rows, rounded up, are held out, those with the least hashes of their key.

    Rows of one key are on one side; a second hash orders keys that share the first.
    """
    held = exact_hold_out(df, [F.xxhash64(key, F.lit(s)) for s in (seed, seed + 1)], percent)
    return df.filter(~held), df.filter(held)


def hold_out_report(model: RiskModel, test: DataFrame) -> DataFrame:
    """R2, MAE, RMSE of the score and the share of right levels on held-out rows."""
    right = F.avg((ref(LEVEL) == ref(LEVEL_OUT)).cast("int")).alias("accuracy")
    return regression_metrics(model.score(test), SCORE, SCORE_OUT, right)


def level_report(model: RiskModel, test: DataFrame) -> DataFrame:
    """One row per level, true or predicted: rows of it, rows predicted as it, right ones, precision and recall."""
    pairs = model.score(test).groupBy(ref(LEVEL).alias("truth"), ref(LEVEL_OUT).alias("guess")).agg(F.count(F.lit(1)).alias("n"))
    sides = F.explode(F.array_distinct(F.array("truth", "guess"))).alias("level")
    own = {side: F.when(F.col(side) == F.col("level"), F.col("n")).otherwise(0) for side in ("truth", "guess")}
    both = F.when((F.col("truth") == F.col("level")) & (F.col("guess") == F.col("level")), F.col("n")).otherwise(0)
    counts = pairs.select("*", sides).where(F.col("level").isNotNull()).groupBy("level").agg(
        F.sum(own["truth"]).alias("n"), F.sum(own["guess"]).alias("predicted"), F.sum(both).alias("right"))
    return counts.select(
        "*", F.try_divide("right", "predicted").alias("precision"), F.try_divide("right", "n").alias("recall"))


def ablation(train_rows: DataFrame, test_rows: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Hold-out figures with and without the level as an input to the score."""
    reports = [
        hold_out_report(model, test_rows).withColumn("use_signal", F.lit(model.settings.use_signal))
        for model in train_variants(train_rows, settings or Settings())
    ]
    return reports[0].unionByName(reports[1])
