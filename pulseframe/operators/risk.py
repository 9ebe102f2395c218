"""Two-stage risk model: level first, then the score with the level as a further input.

By default both stages are boosted over histograms (``boosting``), the level with all its classes at once. Spark's own boosted
classifier is binary: ``kind="one_vs_rest"`` fits one of them per level and lets the highest margin win; ``kind="forest"`` is the
cheapest choice. All kinds score tables and streams on the executors.
"""

from __future__ import annotations

from dataclasses import astuple, dataclass, replace
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.functions.names import ref
from pulseframe.functions.quantiles import approx_quantiles
from pulseframe.functions.scalar import as_category, half_even
from pulseframe.operators.boosting import Boosted, Growth, Task, fit_boosted, load_boosted, save_boosted, two_stage
from pulseframe.operators.encode import coder, decode, quoted, text_categories
from pulseframe.operators.mapping import require_columns
from pulseframe.schema import CATEGORY_FEATURES, LEVEL, NUMERIC_FEATURES, SCORE
from pulseframe.session import shared_dir

INPUTS = "risk_inputs"
INPUTS_WITH_LEVEL = "risk_inputs_with_level"
SIGNAL = "CVD_Risk_Level_Signal"
LEVEL_OUT = "predicted_risk_level"
SCORE_OUT = "predicted_risk_score"


@dataclass(frozen=True)
class Settings:
    """Boosting settings. Rounds, step, bins, leaves, smallest leaf and seed of the risk model.

    ``kind`` is boosted, one_vs_rest or forest; ``depth`` and ``seed`` are for the last two, ``leaves`` and ``smallest_leaf`` for the
    first. ``unseen`` is what becomes of a category that the model does not know: error, keep (a code of its own) or skip (the row).
    """

    rounds: int = 100
    step: float = 0.1
    bins: int = 255
    depth: int = 5
    seed: int = 42
    kind: str = "boosted"
    use_signal: bool = True
    unseen: str = "error"
    leaves: int = 31
    smallest_leaf: int = 20

    def growth(self) -> Growth:
        return Growth(self.rounds, self.step, self.bins, self.leaves, self.smallest_leaf)


ABOUT = (
    "labels array<string>, categories array<array<string>>, rounds int, step double, bins int, depth int, seed int, kind string, "
    "use_signal boolean, unseen string, leaves int, smallest_leaf int"
)


@dataclass
class RiskModel:
    """What all kinds share: ``categories`` are the known labels of each category feature."""

    labels: list[str]
    categories: list[list[str]]
    settings: Settings

    def scorable(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(rows whose categories the model knows, the other rows with the reason)."""
        unknown = [
            F.when(~as_category(ref(c)).isin(known), F.concat(F.lit(f"{c}: "), as_category(ref(c))))
            for c, known in zip(CATEGORY_FEATURES, self.categories, strict=True)
        ]
        marked = df.withColumn("reason", F.concat_ws("; ", *unknown))
        return marked.filter(F.col("reason") == "").drop("reason"), marked.filter(F.col("reason") != "")

    def score(self, df: DataFrame) -> DataFrame:
        """Every input row with its level and its score rounded to two digits."""
        raise NotImplementedError

    def save(self, path: str) -> None:
        self._save_stages(path)
        about = [(self.labels, self.categories, *astuple(self.settings))]
        SparkSession.active().createDataFrame(about, ABOUT).coalesce(1).write.mode("overwrite").json(f"{path}/about")

    def _save_stages(self, path: str) -> None:
        raise NotImplementedError

    @staticmethod
    def load(spark: SparkSession, path: str) -> RiskModel:
        row = spark.read.schema(ABOUT).json(f"{path}/about").first().asDict()
        labels, categories = list(row.pop("labels")), [list(c) for c in row.pop("categories")]
        settings = Settings(**row)
        if settings.kind == "boosted":
            return BoostedRisk(labels, categories, settings, *load_boosted(spark, path))
        stages = (PipelineModel.load(f"{path}/{stage}") for stage in ("stage1", "stage2"))
        return StagedRisk(labels, categories, settings, *stages)


@dataclass
class BoostedRisk(RiskModel):
    stage1: Boosted
    stage2: Boosted

    def score(self, df: DataFrame) -> DataFrame:
        require_columns(df, NUMERIC_FEATURES + CATEGORY_FEATURES)
        if self.settings.unseen == "skip":
            df = self.scorable(df)[0]
        found = df.withColumn("risk_found", two_stage(model_inputs(self.categories, self.settings.unseen), self.stage1, self.stage2))
        return found.select(
            *map(ref, df.columns),
            decode(F.col("risk_found.class"), self.labels).alias(LEVEL_OUT),
            half_even(F.col("risk_found.number"), 2).alias(SCORE_OUT),
        )

    def _save_stages(self, path: str) -> None:
        save_boosted(SparkSession.active(), [self.stage1, self.stage2], path)


@dataclass
class StagedRisk(RiskModel):
    """Both stages as pipelines of Spark's own models."""

    stage1: PipelineModel
    stage2: PipelineModel

    def score(self, df: DataFrame) -> DataFrame:
        require_columns(df, NUMERIC_FEATURES + CATEGORY_FEATURES)
        staged = self.stage1.transform(df).withColumn(SIGNAL, self._level_code())
        out = self.stage2.transform(staged)
        return out.select(
            *map(ref, df.columns),
            decode(ref(SIGNAL), self.labels).alias(LEVEL_OUT),
            half_even(ref("stage2_prediction"), 2).alias(SCORE_OUT),
        )

    def _level_code(self) -> Column:
        if self.settings.kind == "forest":
            return ref("stage1_prediction")
        margins = [vector_to_array(ref(f"margin_{i}"))[1] for i in range(len(self.labels))]
        highest = F.greatest(*margins) if len(margins) > 1 else margins[0]
        return (F.array_position(F.array(*margins), highest) - 1).cast("double")

    def _save_stages(self, path: str) -> None:
        self.stage1.write().overwrite().save(f"{path}/stage1")
        self.stage2.write().overwrite().save(f"{path}/stage2")


def known_labels(df: DataFrame, cols: list[str]) -> list[list[str]]:
    """The labels of a few category columns in order, from one aggregate; a model's categories are few by nature."""
    row = df.agg(*[F.sort_array(F.collect_set(as_category(ref(c)))).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    return [list(found) for found in row]


def label_code(column: str, labels: list[str], unseen: str = "error") -> Column:
    """Code of a label as a double; ``unseen`` keep gives an unknown one the code after the last."""
    text = as_category(ref(column))
    at = F.array_position(F.array(*map(F.lit, labels)).cast("array<string>"), text)
    other = F.lit(len(labels)) if unseen == "keep" else F.raise_error(F.concat(F.lit(f"{column}: unknown label "), text)).cast("int")
    return F.when(at > 0, at - 1).otherwise(other).cast("double")


def model_inputs(categories: list[list[str]], unseen: str = "error") -> list[Column]:
    """Numbers, empty where they are missing, then category codes."""
    return [ref(c).cast("double") for c in NUMERIC_FEATURES] + [
        label_code(c, known, unseen) for c, known in zip(CATEGORY_FEATURES, categories, strict=True)]


def fit_inputs(df: DataFrame, unseen: str = "error") -> PipelineModel:
    """Seven numbers and five category codes as one vector; missing numbers take the training median."""
    medians = approx_quantiles(df, [], NUMERIC_FEATURES).first()
    filled = ", ".join(
        f"coalesce(CAST({quoted(c)} AS DOUBLE), CAST('{float(medians[c])!r}' AS DOUBLE)) AS risk_n{i}"
        for i, c in enumerate(NUMERIC_FEATURES)
    )
    numbers = SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__")
    text = text_categories(CATEGORY_FEATURES)
    codes = coder([f"{c}__text" for c in CATEGORY_FEATURES], unseen).fit(text.transform(df))
    vector = VectorAssembler(
        inputCols=[f"risk_n{i}" for i in range(len(NUMERIC_FEATURES))] + codes.getOutputCols(), outputCol=INPUTS
    )
    return PipelineModel([numbers, text, codes, vector])


def train(df: DataFrame, settings: Settings | None = None) -> RiskModel:
    """Fit both stages. Stage 2 learns from the true level and is given the predicted one when scoring.

    Rows without a known level or score carry no target and cannot be learned from.
    """
    settings = settings or Settings()
    return train_variants(df, settings, (settings.use_signal,))[0]


def train_variants(df: DataFrame, settings: Settings, signals: tuple[bool, ...] = (True, False)) -> list[RiskModel]:
    """A model for each choice of ``use_signal``; they share the first stage, which does not depend on it."""
    shared_dir(df.sparkSession)
    require_columns(df, [*NUMERIC_FEATURES, *CATEGORY_FEATURES, LEVEL, SCORE])
    known = df.filter(ref(LEVEL).isNotNull() & ref(SCORE).isNotNull())
    return _train_boosted(known, settings, signals) if settings.kind == "boosted" else _train_staged(df, known, settings, signals)


def _train_boosted(known: DataFrame, settings: Settings, signals: tuple[bool, ...]) -> list[RiskModel]:
    """The second stage learns from the true level, so both stages, and all variants, grow side by side in the same passes."""
    known = known.select(*map(ref, [*NUMERIC_FEATURES, *CATEGORY_FEATURES, LEVEL, SCORE])).persist()
    try:
        *categories, labels = known_labels(known, [*CATEGORY_FEATURES, LEVEL])
        inputs = model_inputs(categories)
        features = [f"risk_x{i}" for i in range(len(inputs))]
        ready = known.select(
            *[x.alias(c) for x, c in zip(inputs, features, strict=True)], label_code(LEVEL, labels).alias(SIGNAL),
            ref(SCORE).cast("double").alias("score"),
        )
        plain, wide = tuple(range(len(inputs))), tuple(range(len(inputs) + 1))
        tasks = [Task(SIGNAL, max(len(labels), 1), plain)] + [Task("score", 0, wide if s else plain) for s in signals]
        stage1, *others = fit_boosted(ready, [*features, SIGNAL], tasks, settings.growth())
    finally:
        known.unpersist()
    return [
        BoostedRisk(labels, categories, replace(settings, use_signal=s), stage1, stage2) for s, stage2 in zip(signals, others, strict=True)]


def _train_staged(df: DataFrame, known: DataFrame, settings: Settings, signals: tuple[bool, ...]) -> list[RiskModel]:
    inputs = fit_inputs(df, settings.unseen)
    categories = [list(c) for c in next(s for s in inputs.stages if isinstance(s, StringIndexerModel)).labelsArray]
    target = coder([LEVEL]).setOutputCols(["level_code"]).fit(known)
    labels = list(target.labelsArray[0])
    ready = target.transform(inputs.transform(known)).select(
        INPUTS,
        F.col("level_code"),
        ref(SCORE).cast("double").alias("score"),
        *[(F.col("level_code") == i).cast("double").alias(f"is_{i}") for i in range(len(labels))],
    )
    ready = ready.persist()
    try:
        stage1 = PipelineModel([*inputs.stages, *_fit_levels(ready, labels, settings)])
        models = []
        for use_signal in signals:
            columns = [INPUTS, SIGNAL] if use_signal else [INPUTS]
            vector = VectorAssembler(inputCols=columns, outputCol=INPUTS_WITH_LEVEL)
            scorer = GBTRegressor(
                featuresCol=INPUTS_WITH_LEVEL, labelCol="score", predictionCol="stage2_prediction",
                maxIter=settings.rounds, stepSize=settings.step, maxBins=settings.bins, maxDepth=settings.depth,
                seed=settings.seed,
            ).fit(vector.transform(ready.withColumnRenamed("level_code", SIGNAL)))
            stage2 = PipelineModel([vector, scorer])
            models.append(StagedRisk(labels, categories, replace(settings, use_signal=use_signal), stage1, stage2))
    finally:
        ready.unpersist()
    return models


def _fit_levels(ready: DataFrame, labels: list[str], settings: Settings) -> list[Transformer]:
    if settings.kind == "forest":
        forest = RandomForestClassifier(
            featuresCol=INPUTS, labelCol="level_code", predictionCol="stage1_prediction",
            rawPredictionCol="stage1_raw", probabilityCol="stage1_probability", maxBins=settings.bins,
            maxDepth=settings.depth, seed=settings.seed,
        )
        return [forest.fit(ready)]

    def fit(i: int) -> Transformer:
        boosted = GBTClassifier(
            featuresCol=INPUTS, labelCol=f"is_{i}", predictionCol=f"level_{i}", maxIter=settings.rounds,
            stepSize=settings.step, maxBins=settings.bins, maxDepth=settings.depth, seed=settings.seed,
        )
        return boosted.setRawPredictionCol(f"margin_{i}").setProbabilityCol(f"probability_{i}").fit(ready)

    session = ready.sparkSession
    with ThreadPool(len(labels)) as pool:
        return pool.map(inheritable_thread_target(session)(fit), range(len(labels)))
