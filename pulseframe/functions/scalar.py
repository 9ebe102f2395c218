"""Row-level expressions; all of them stay inside JVM code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHOLE_TYPES = {"int", "integer", "bigint", "long", "smallint", "tinyint"}


def to_type(col: Column, kind: str, from_text: bool = True) -> Column:
    """Cast that gives NULL where the field does not parse. Whole numbers accept ``12.0`` through a double."""
    if kind in WHOLE_TYPES and from_text:
        return col.try_cast("double").try_cast(kind)
    return finite(col.try_cast(kind)) if kind in ("double", "float") else col.try_cast(kind)


def pair_part(text: Column, index: int, kind: str = "int", sep: str = "/") -> Column:
    """One side of an ``a/b`` text as a number; NULL where the side is absent or no number."""
    return F.get(F.split(text, F.lit(sep), -1), F.lit(index)).try_cast(kind)


def band(col: Column, width: int = 10) -> Column:
    """Lower edge of the band a value lies in, truncating towards zero."""
    return (col / F.lit(width)).cast("int") * F.lit(width)


def first_digits(col: Column) -> Column:
    """First run of digits in a value's text as a double, NULL if there is none."""
    digits = F.regexp_extract(col.cast("string"), r"(\d+)", 1)
    return F.nullif(digits, F.lit("")).try_cast("double")


def is_value(col: Column, value: object) -> Column:
    """Equality where NULL counts as False, so that it stays in a share's denominator."""
    return F.coalesce(col == F.lit(value), F.lit(False))


def is_one_of(col: Column, values: list) -> Column:
    return F.coalesce(col.isin(values), F.lit(False))


def share_of(flag: Column, scale: float = 100.0) -> Column:
    """Share of rows for which a flag holds, as an aggregate."""
    return F.avg(flag.cast("int")) * F.lit(scale)


def half_even(col: Column, digits: int = 2) -> Column:
    return F.bround(col, digits)


def as_category(col: Column) -> Column:
    """Text form of a value in which a missing value is a category of its own."""
    return F.coalesce(col.cast("string"), F.lit("None"))


def finite(col: Column) -> Column:
    """NULL for NaN and the infinities: they compare above every bound and would spoil every sum they enter."""
    return F.when(F.abs(col) < F.lit(float("inf")), col)


def body_mass_index(weight: Column, height: Column) -> Column:
    """kg / m^2; a zero height gives NULL."""
    return F.try_divide(weight, F.pow(height, F.lit(2.0)))


def starts_with_pattern(col: Column, pattern: str) -> Column:
    """Regex match anchored at the start of the value."""
    return col.rlike(f"^(?:{pattern})")


def cohort_label(cluster: Column) -> Column:
    return F.concat(F.lit("Cluster "), cluster.cast("string"))


def thousands(col: Column) -> Column:
    return F.format_number(col, 0)


def fixed_point(col: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", col)


def percent(col: Column, digits: int = 1) -> Column:
    return F.format_string(f"%.{digits}f%%", col)
