"""Projections and schema operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.names import ref
from pulseframe.functions.scalar import body_mass_index, finite, first_digits, pair_part, to_type
from pulseframe.schema import BP_TEXT, RAW_TYPES, silver_types

Mapping = list[tuple[str, str, str]]


def apply_mapping(df: DataFrame, mapping: Mapping) -> DataFrame:
    """Select, rename and cast in one projection: (source, target, type). Unlisted columns go; bad fields are NULL."""
    kinds = dict(df.dtypes)
    return df.select(
        *[
            (
                ref(source) if kinds[source] == kind and kind not in ("double", "float")
                else to_type(ref(source), kind, kinds[source] == "string")
            ).alias(to)
            for source, to, kind in mapping
        ]
    )


def raw_mapping(keep: list[str] | tuple[str, ...] = ()) -> Mapping:
    """Bronze text to typed columns; ``keep`` passes further text columns through, such as a record id."""
    return [(c, c, kind) for c, kind in RAW_TYPES.items()] + [(c, c, "string") for c in keep]


def silver_mapping() -> Mapping:
    return [(c, c, kind) for c, kind in silver_types().items()]


def split_pair(
    df: DataFrame, text: str = BP_TEXT, first: str = "Systolic BP", second: str = "Diastolic BP", keep: bool = False
) -> DataFrame:
    """Fill the members of a pair from their ``first/second`` text where they are missing, then drop the text."""
    kinds = dict(df.dtypes)
    filled = {
        c: F.coalesce(ref(c), pair_part(ref(text), i).cast(kinds[c])) for i, c in enumerate((first, second))
    }
    df = df.withColumns(filled)
    return df if keep else df.drop(text)


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise KeyError(f"required columns are missing: {missing}")
    return df


def with_age(df: DataFrame, age: str = "Age", age_band: str = "age_band", default: float = 50.0) -> DataFrame:
    """Add a missing age column: from the band's digits where there is a band, else a constant."""
    if age in df.columns:
        return df
    if age_band in df.columns:
        return df.withColumn(age, F.coalesce(first_digits(ref(age_band)), F.lit(default)))
    return df.withColumn(age, F.lit(default))


def with_bmi(
    df: DataFrame, bmi: str = "BMI", weight: str = "Weight_kg", height: str = "Height_m", default: float = 25.0
) -> DataFrame:
    """Add a missing body mass index: from weight and height where both exist, else a constant."""
    if bmi in df.columns:
        return df
    if weight in df.columns and height in df.columns:
        return df.withColumn(bmi, body_mass_index(ref(weight), ref(height)))
    return df.withColumn(bmi, F.lit(default))


def finite_numbers(df: DataFrame) -> DataFrame:
    """Turn NaN and the infinities into NULL in every double column, as files written by other tools may carry them."""
    doubles = [c for c, kind in df.dtypes if kind in ("double", "float")]
    return df.withColumns({c: finite(ref(c)) for c in doubles}) if doubles else df


def present_groups(df: DataFrame, groups: dict[str, list[str]]) -> dict[str, list[str]]:
    """Column groups restricted to the columns a table has, with the ``flags`` group added."""
    from pulseframe.functions.names import with_suffix

    found = {name: [c for c in cols if c in df.columns] for name, cols in groups.items()}
    return found | {"flags": with_suffix(df.columns)}
