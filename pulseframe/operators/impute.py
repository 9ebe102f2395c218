"""Tiered median fill.

The medians of a tier are a small table, fitted once and then looked up by every row; the rows themselves are never
sorted or gathered by group. The fitted tables can be stored and applied to later batches or to a stream.

Exact medians of all tiers come from one counted table: one scan counts each value of each column, missing ones included, by the keys of
all tiers. A tier's medians are read off its counts; the missing cells it fills join the counts at its median, and the next tier goes on from
there. Counts of several batches add up, so medians can be kept up to date without the rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.functions.lookup import lookup
from pulseframe.functions.names import flag_name, ref
from pulseframe.functions.quantiles import ACCURACY, approx_quantiles, exact_medians, quantiles_of_counts
from pulseframe.session import pin


@dataclass
class FillStep:
    """Medians of ``columns`` per ``keys``; without keys, one row for the whole table."""

    keys: list[str]
    columns: list[str]
    medians: DataFrame
    rows: int

    def apply(self, df: DataFrame) -> DataFrame:
        if not self.columns:
            return df
        if not self.keys:
            row = self.medians.first()
            fill = {c: F.coalesce(ref(c), F.lit(row[c]).cast(self.medians.schema[c].dataType)) for c in self.columns}
            return df.withColumns(fill)
        staged = {c: f"__median_{i}" for i, c in enumerate(self.columns)}
        joined = lookup(df, self.medians.withColumnsRenamed(staged), self.keys, self.rows)
        filled = {c: F.coalesce(ref(c), F.col(m)) for c, m in staged.items()}
        return joined.select(*[filled[c].alias(c) if c in filled else ref(c) for c in df.columns])


def fit_step(
    df: DataFrame, columns: list[str], keys: list[str], exact: bool = False, accuracy: int = ACCURACY
) -> FillStep:
    """Medians for one tier. Both kinds are actual elements, the lower one of a middle pair."""
    if exact:
        table = exact_medians(df, keys, columns, accuracy=accuracy)
    else:
        table = approx_quantiles(df, keys, columns, accuracy=accuracy)
    table = pin(table)
    return FillStep(keys, columns, table, table.count())


@dataclass
class TierFill:
    """Fitted tiers for one list of columns."""

    columns: list[str]
    steps: list[FillStep]
    flags: bool = True
    protect: list[str] = field(default_factory=list)

    def apply(self, df: DataFrame) -> DataFrame:
        """Fill missing cells tier by tier; flags describe the cells as they came in."""
        names = df.columns
        if self.flags:
            df = df.withColumns({flag_name(c): self._flag(c) for c in self.columns})
        for step in self.steps:
            df = step.apply(df)
        extra = [flag_name(c) for c in self.columns] if self.flags else []
        return df.select(*map(ref, names), *[ref(f) for f in extra if f not in names])

    def _flag(self, column: str):
        # A protected column is never filled, so its flag must not claim it was.
        return F.lit(False) if column in self.protect else ref(column).isNull()

    def save(self, path: str) -> None:
        """Store the medians as one table per tier, plus a small description (its first row is that of the whole fill)."""
        spark = SparkSession.active()
        for i, step in enumerate(self.steps):
            step.medians.write.mode("overwrite").parquet(f"{path}/tier-{i}")
        about = [(-1, [], [], 0, self.columns, self.flags, self.protect)] + [
            (i, step.keys, step.columns, step.rows, self.columns, self.flags, self.protect)
            for i, step in enumerate(self.steps)
        ]
        schema = (
            "tier int, keys array<string>, filled array<string>, rows bigint, columns array<string>, flags boolean, "
            "protect array<string>"
        )
        spark.createDataFrame(about, schema).coalesce(1).write.mode("overwrite").json(f"{path}/about")

    @staticmethod
    def load(spark: SparkSession, path: str) -> TierFill:
        schema = (
            "tier int, keys array<string>, filled array<string>, rows bigint, columns array<string>, flags boolean, "
            "protect array<string>"
        )
        whole, *tiers = spark.read.schema(schema).json(f"{path}/about").orderBy("tier").collect()
        steps = [
            FillStep(list(a.keys), list(a.filled), spark.read.parquet(f"{path}/tier-{a.tier}"), a.rows) for a in tiers
        ]
        return TierFill(list(whole.columns), steps, whole.flags, list(whole.protect))


def fit_tiers(
    df: DataFrame,
    columns: list[str],
    tiers: list[list[str]],
    flags: bool = True,
    protect: list[str] | tuple[str, ...] = (),
    exact: bool = False,
    accuracy: int = ACCURACY,
) -> TierFill:
    """Fit one tier after the other, each on the values the tiers before it have filled.

    Every tier covers every column that is not protected: the fill may be applied to rows of groups that the fitted
    rows did not have.
    """
    open_columns = [c for c in columns if c not in protect]
    keys = list(dict.fromkeys(k for tier in tiers for k in tier))
    if exact and open_columns and not set(keys) & set(open_columns):
        kinds = dict(df.dtypes)
        counts = pin(count_cells(df, keys, open_columns))
        return TierFill(columns, fit_counted(counts, open_columns, tiers, kinds), flags, list(protect))
    steps: list[FillStep] = []
    current = df
    for keys in tiers:
        if not open_columns:
            break
        step = fit_step(current, open_columns, keys, exact, accuracy)
        steps.append(step)
        current = step.apply(current)
    return TierFill(columns, steps, flags, list(protect))


def count_cells(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, ``cell``, ``value``, ``n``): how often each value of each column comes in each group, a missing one as null. One scan, combined before
    the shuffle."""
    values = df.select(*map(ref, keys), *[ref(c).cast("double").alias(c) for c in columns])
    cells = values.unpivot([ref(k) for k in keys], [ref(c) for c in columns], "cell", "value")
    return cells.groupBy(*map(ref, keys), "cell", "value").agg(F.count(F.lit(1)).alias("n"))


def fit_counted(counts: DataFrame, columns: list[str], tiers: list[list[str]], kinds: dict[str, str]) -> list[FillStep]:
    """The steps of ``fit_tiers`` from ``count_cells``, whose keys must be those of all tiers. ``kinds`` are the types of the medians."""
    steps: list[FillStep] = []
    for keys in tiers:
        if steps and steps[-1].columns:
            counts = _filled_counts(counts, steps[-1])
        found = quantiles_of_counts(counts, keys, columns, [0.5])
        typed = found.select(*map(ref, keys), *[F.get(ref(c), F.lit(0)).cast(kinds[c]).alias(c) for c in columns])
        # A group without any value has no medians, but its row counts: the fill must not take it for unknown.
        groups = counts.select(*map(ref, keys)).distinct() if keys else None
        medians = pin(lookup(groups, pin(typed), keys) if keys else typed)
        steps.append(FillStep(keys, columns, medians, medians.count()))
    return steps


def _filled_counts(counts: DataFrame, step: FillStep) -> DataFrame:
    """Missing cells at the median of their group."""
    doubles = step.medians.select(*map(ref, step.keys), *[ref(c).cast("double").alias(c) for c in step.columns])
    table = doubles.unpivot([ref(k) for k in step.keys], [ref(c) for c in step.columns], "cell", "median")
    joined = lookup(counts, table, [*step.keys, "cell"], step.rows * len(step.columns))
    names = [c for c in counts.columns if c not in ("value", "n")]
    return joined.select(*map(ref, names), F.coalesce("value", "median").alias("value"), "n")


def impute(df: DataFrame, columns: list[str], tiers: list[list[str]], **options) -> DataFrame:
    """Fit the tiers on ``df`` and fill it: ``impute(df, cols, tiers=[["Sex", "age_band"], []])``."""
    return fit_tiers(df, columns, tiers, **options).apply(df)
