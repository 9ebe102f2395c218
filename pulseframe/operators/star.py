"""Gold star schema: keys are hashes of the natural key, so they are the same in every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.lookup import lookup
from pulseframe.functions.names import ref, with_suffix
from pulseframe.schema import GROUPS, LEVEL, LEVEL_ORDER, SCORE

UNKNOWN = "UNKNOWN"

# Which silver columns each dimension holds.
DIMENSIONS = {
    "lifestyle": GROUPS["lifestyle"],
    "bp_category": ["Blood Pressure Category"],
    "risk_level": [LEVEL],
}
PATIENT_COLUMNS = ["Sex", "Age", "age_band", *GROUPS["anthropometric"]]
MEASURES = [
    "Systolic BP", "Diastolic BP", "Total Cholesterol (mg/dL)", "HDL (mg/dL)", "Estimated LDL (mg/dL)",
    "Fasting Blood Sugar (mg/dL)", SCORE,
]


def member(column: str) -> Column:
    """A category with a name for the missing one, so that no row loses its dimension."""
    return F.coalesce(ref(column), F.lit(UNKNOWN))


def natural_key(columns: list[str]) -> Column:
    return F.xxhash64(*[member(c) for c in columns])


def row_key(df: DataFrame, *more: Column) -> Column:
    """Key of a table without an id: a 128-bit digest of the whole row, missing cells included.

    64 bits would collide somewhere in some billions of rows. Identical rows share a key and one row of ``dim_patient``.
    """
    return F.md5(F.to_json(F.struct(*map(ref, df.columns), *more), {"ignoreNullFields": "false"}))


def dimension(df: DataFrame, name: str) -> DataFrame:
    """Distinct members of a small dimension with their key."""
    columns = DIMENSIONS[name]
    members = df.select(*[member(c).alias(c) for c in columns]).distinct()
    keyed = members.select(natural_key(columns).alias(f"{name}_key"), *map(ref, columns))
    if name != "risk_level":
        return keyed
    rank = F.nullif(F.array_position(F.array(*map(F.lit, LEVEL_ORDER)), ref(LEVEL)), F.lit(0)) - 1
    return keyed.withColumn("level_rank", rank.cast("int"))


def build_star(silver: DataFrame, patient_key: str | None = None) -> dict[str, DataFrame]:
    """One fact and four dimensions. Fact keys are computed from the row itself; building needs no join."""
    key = ref(patient_key) if patient_key else row_key(silver)
    keyed = silver.withColumn("patient_key", key)
    fact = keyed.select(
        "patient_key",
        *[natural_key(columns).alias(f"{name}_key") for name, columns in DIMENSIONS.items()],
        *map(ref, MEASURES),
        *map(ref, with_suffix(silver.columns)),
    )
    tables = {
        "fact_patient_risk": fact,
        "dim_patient": keyed.select("patient_key", *map(ref, PATIENT_COLUMNS)).dropDuplicates(["patient_key"]),
    }
    return tables | {f"dim_{name}": dimension(silver, name) for name in DIMENSIONS}


def write_star(tables: dict[str, DataFrame], database: str | None, path: str) -> None:
    from pulseframe.sources.sinks import write_parquet, write_table

    for name, df in tables.items():
        if database is None:
            write_parquet(df, f"{path}/{name}")
        else:
            write_table(df, f"{database}.{name}", f"{path}/{name}")


def join_star(tables: dict[str, DataFrame], *names: str) -> DataFrame:
    """The fact joined to the named dimensions.

    The category dimensions are broadcast behind a check of their size. ``dim_patient`` has a row per distinct patient and
    is joined by a sort-merge on its key, whose skewed partitions (many identical fact rows) adaptive execution splits.
    """
    joined = tables["fact_patient_risk"]
    for name in names or ("patient", *DIMENSIONS):
        if name == "patient":
            joined = joined.join(tables["dim_patient"], "patient_key", "left")
        else:
            joined = lookup(joined, tables[f"dim_{name}"], [f"{name}_key"])
    return joined
