"""Bronze to silver and rejected, as a batch job."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pulseframe.functions.names import ref
from pulseframe.functions.quantiles import ACCURACY
from pulseframe.functions.scalar import band
from pulseframe.operators.impute import TierFill, count_cells, fit_counted, fit_tiers
from pulseframe.operators.mapping import apply_mapping, raw_mapping, silver_mapping, split_pair
from pulseframe.operators.quality import (
    CORRUPT, SILVER_RULES, WELL_FORMED, Rule, failed_rows, outcome_rows, passed_rows, row_outcomes, rule_metrics,
)
from pulseframe.schema import AGE_BAND, IMPUTED, RAW_TYPES
from pulseframe.session import discard, pin, scratch, small_methods
from pulseframe.sources.files import read_bronze
from pulseframe.sources.sinks import publish_outcomes, write_parquet, write_table


@dataclass
class ClinicalFill:
    """Fitted medians: age by sex, then the clinical values by sex and age band, then overall."""

    age: TierFill
    values: TierFill

    @staticmethod
    def fit(
        typed: DataFrame,
        protect: list[str] | tuple[str, ...] = (),
        exact: bool = False,
        accuracy: int = ACCURACY,
    ) -> ClinicalFill:
        """``protect`` names columns that must stay empty where they are empty, so that the rules reject the row."""
        if exact:
            return ClinicalFill.from_counts(pin(clinical_counts(typed, protect)), protect, dict(split_pair(typed).dtypes))
        paired = split_pair(typed)
        age = fit_tiers(paired, ["Age"], [["Sex"]], flags=False, accuracy=accuracy)
        banded = with_band(age.apply(paired))
        values = fit_tiers(banded, IMPUTED, [["Sex", AGE_BAND], []], protect=protect, accuracy=accuracy)
        return ClinicalFill(age, values)

    @staticmethod
    def from_counts(counts: DataFrame, protect: list[str] | tuple[str, ...] = (), kinds: dict[str, str] | None = None) -> ClinicalFill:
        """Exact medians of all tiers from ``clinical_counts``, which may be those of several batches together."""
        kinds = kinds or RAW_TYPES
        ages = counts.where(F.col("cell") == "Age").select("Sex", "cell", F.col("Age").cast("double").alias("value"), "n")
        age = TierFill(["Age"], fit_counted(ages, ["Age"], [["Sex"]], kinds), flags=False)
        open_columns = [c for c in IMPUTED if c not in protect]
        banded = with_band(age.apply(counts.where(F.col("cell") != "Age"))).drop("Age")
        steps = fit_counted(pin(banded), open_columns, [["Sex", AGE_BAND], []], kinds) if open_columns else []
        return ClinicalFill(age, TierFill(IMPUTED, steps, True, list(protect)))

    def apply(self, typed: DataFrame) -> DataFrame:
        """Narrow work only (lookups of small tables), so it also runs on a stream."""
        return self.values.apply(with_band(self.age.apply(split_pair(typed))))

    def save(self, path: str) -> None:
        self.age.save(f"{path}/age")
        self.values.save(f"{path}/values")

    @staticmethod
    def load(spark: SparkSession, path: str) -> ClinicalFill:
        return ClinicalFill(TierFill.load(spark, f"{path}/age"), TierFill.load(spark, f"{path}/values"))


def clinical_counts(typed: DataFrame, protect: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Values of the clinical columns, and of Age itself, counted by Sex and Age as they came in, in one scan of the typed rows."""
    paired = split_pair(typed).withColumn("age_value", ref("Age"))
    columns = [c for c in IMPUTED if c not in protect]
    counts = count_cells(paired, ["Sex", "Age"], [*columns, "age_value"])
    return counts.withColumn("cell", F.when(F.col("cell") == "age_value", F.lit("Age")).otherwise(F.col("cell")))


def with_band(df: DataFrame) -> DataFrame:
    return df.withColumn(AGE_BAND, band(F.col("Age")).cast("int"))


def repair(typed: DataFrame, **options) -> DataFrame:
    """Typed rows to complete, flagged rows."""
    return ClinicalFill.fit(typed, **options).apply(typed)


def route(checked: DataFrame, keep: list[str] | tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Passed rows in the silver layout, failed rows as they are."""
    silver = apply_mapping(passed_rows(checked), silver_mapping() + [(c, c, dict(checked.dtypes)[c]) for c in keep])
    return {"silver": silver, "rejected": failed_rows(checked)}


def run_batch(
    spark: SparkSession,
    bronze_path: str,
    out_dir: str,
    table: str | None = None,
    run_id: str | None = None,
    rules: list[Rule] | None = None,
    protect: list[str] | tuple[str, ...] = (),
    exact: bool = False,
    accuracy: int = ACCURACY,
) -> dict[str, DataFrame]:
    """The whole job: silver, rejected, outcomes, and the medians that were used.

    The text files are parsed once into a typed copy in the shared folder; the median passes then read only the
    columns they need from it. Filling and checking are narrow, so both sinks read the typed copy without a shuffle of
    rows, and the rules are counted while the first one is written. Lines with too many or too few fields are rejected
    with their text and take no part in the medians. Each run publishes its outcomes under an id of its own.
    """
    rules = [*(SILVER_RULES if rules is None else rules), WELL_FORMED]
    run_id = run_id or f"{datetime.now(UTC):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    typed_path = scratch(spark, "typed")
    bronze = read_bronze(small_methods(spark), bronze_path)
    apply_mapping(bronze, raw_mapping(keep=[CORRUPT])).write.parquet(typed_path)
    try:
        typed = spark.read.parquet(typed_path)
        whole = typed.filter(ref(CORRUPT).isNull()).drop(CORRUPT)
        fill = ClinicalFill.fit(whole, protect=protect, exact=exact, accuracy=accuracy)
        fill.save(f"{out_dir}/medians")
        repaired = fill.apply(typed)
        counts = Observation(f"rules-{uuid.uuid4().hex}")
        checked = row_outcomes(repaired, rules)
        write_parquet(failed_rows(checked.observe(counts, *rule_metrics(rules))), f"{out_dir}/rejected")
        silver = route(checked)["silver"]
        if table is None:
            write_parquet(silver, f"{out_dir}/silver")
        else:
            write_table(silver, table, f"{out_dir}/silver")
        found = counts.get
        totals = spark.createDataFrame([tuple(found.values())], ", ".join(f"{name} long" for name in found))
        publish_outcomes(outcome_rows(repaired, rules, totals), f"{out_dir}/outcomes", run_id)
    finally:
        discard(spark, typed_path)
    return {
        "silver": spark.read.parquet(f"{out_dir}/silver"),
        "rejected": spark.read.parquet(f"{out_dir}/rejected"),
        "outcomes": spark.read.parquet(f"{out_dir}/outcomes"),
    }
