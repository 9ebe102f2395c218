"""SQL building blocks of the oracle side, parameterised by column names."""

from __future__ import annotations

from catalog.fixture import BRONZE_SQL, HEADER, PATIENT_SQL
from pulseframe.functions.names import flag_name
from pulseframe.operators.quality import SILVER_RULES, Rule
from pulseframe.schema import IMPUTED, RAW_TYPES, silver_types

SHORT = {name: short for short, name in HEADER.items()}
SHORT_IMPUTED = [SHORT[c] for c in IMPUTED]


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def names(columns: list[str]) -> str:
    return ", ".join(map(q, columns))


def typed_cell(name: str, kind: str) -> str:
    if kind == "string":
        return f"{q(name)} AS {q(name)}"
    if kind == "double":
        return f"CASE WHEN isfinite(TRY_CAST({q(name)} AS DOUBLE)) THEN TRY_CAST({q(name)} AS DOUBLE) END AS {q(name)}"
    target = {"int": "INTEGER", "bigint": "BIGINT"}[kind]
    return f"TRY_CAST(trunc(TRY_CAST({q(name)} AS DOUBLE)) AS {target}) AS {q(name)}"


TYPED_SELECT = "SELECT k, " + ", ".join(typed_cell(c, kind) for c, kind in RAW_TYPES.items())


def fill_ctes(
    source: str,
    age: str = "age",
    sex: str = "sex",
    text: str = "bp_text",
    first: str = "systolic",
    second: str = "diastolic",
    columns: list[str] | None = None,
    protect: tuple[str, ...] = (),
) -> str:
    """CTEs paired, aged, banded, medians, grouped and filled over ``source``."""
    columns = columns or SHORT_IMPUTED
    open_columns = [c for c in columns if c not in protect]
    group = ", ".join(f"quantile_disc({q(c)}, 0.5) AS {q(c)}" for c in open_columns)
    by_group = ", ".join(f"coalesce(b.{q(c)}, g.{q(c)}) AS {q(c)}" for c in open_columns)
    overall = ", ".join(
        f"coalesce({q(c)}, (SELECT quantile_disc({q(c)}, 0.5) FROM grouped)) AS {q(c)}" for c in open_columns
    )
    flags = ", ".join(
        f"{'FALSE' if c in protect else f'b.{q(c)} IS NULL'} AS {q(flag_name(c))}" for c in columns
    )
    return f"""
      paired AS (SELECT * REPLACE (
          coalesce({q(first)}, TRY_CAST(split_part({q(text)}, '/', 1) AS INTEGER)) AS {q(first)},
          coalesce({q(second)}, TRY_CAST(split_part({q(text)}, '/', 2) AS INTEGER)) AS {q(second)}) FROM {source}),
      aged AS (SELECT * EXCLUDE ({q(text)})
          REPLACE (coalesce({q(age)}, quantile_disc({q(age)}, 0.5) OVER (PARTITION BY {q(sex)})) AS {q(age)})
          FROM paired),
      banded AS (SELECT *, ({q(age)} // 10) * 10 AS age_band FROM aged),
      medians AS (SELECT {q(sex)}, age_band, {group} FROM banded GROUP BY {q(sex)}, age_band),
      grouped AS (SELECT b.* REPLACE ({by_group}), {flags} FROM banded b LEFT JOIN medians g
          ON b.{q(sex)} IS NOT DISTINCT FROM g.{q(sex)} AND b.age_band IS NOT DISTINCT FROM g.age_band),
      filled AS (SELECT * REPLACE ({overall}) FROM grouped)"""


def patients_filled(query: str) -> str:
    """SQL over ``filled``, the repaired patients under their short names."""
    return f"WITH p AS ({PATIENT_SQL}), {fill_ctes('p')} {query}"


def clinical_fill(source: str, protect: tuple[str, ...] = ()) -> str:
    return fill_ctes(
        source, "Age", "Sex", "Blood Pressure (mmHg)", "Systolic BP", "Diastolic BP", IMPUTED, protect
    )


def bronze_filled(query: str, protect: tuple[str, ...] = ()) -> str:
    """SQL over ``filled``, the repaired records of the raw text table under their header names."""
    return (
        f"WITH bronze AS ({BRONZE_SQL}), typed AS ({TYPED_SELECT} FROM bronze), "
        f"{clinical_fill('typed', protect)} {query}"
    )


def rule_sql(rule: Rule) -> str:
    if rule.kind == "complete":
        return f"{q(rule.column)} IS NOT NULL"
    return f"coalesce({q(rule.column)} {rule.op} {rule.value}, FALSE)"


def all_hold(rules: list[Rule]) -> str:
    return " AND ".join(f"({rule_sql(r)})" for r in rules if r.is_row_rule)


def failed_text(rules: list[Rule]) -> str:
    """Failed rule ids in order, joined by a semicolon."""
    parts = ", ".join(f"CASE WHEN NOT ({rule_sql(r)}) THEN '{r.id}' END" for r in rules if r.is_row_rule)
    return f"concat_ws(';', {parts})"


def outcomes_sql(source: str, rules: list[Rule], columns: int) -> str:
    parts = []
    for rule in rules:
        if rule.is_row_rule:
            failed = f"CAST(count(*) FILTER (NOT ({rule_sql(rule)})) AS BIGINT)"
        else:
            op = {"=": "==", "!=": "!="}.get(rule.op, rule.op)
            failed = f"CAST(CASE WHEN {columns} {op} {rule.value} THEN 0 ELSE 1 END AS BIGINT)"
        parts.append(
            f"SELECT '{rule.id}' AS rule, CASE WHEN {failed} = 0 THEN 'Passed' ELSE 'Failed' END AS outcome, "
            f"{failed} AS failed, count(*) AS total FROM {source}"
        )
    return " UNION ALL ".join(parts)


SILVER_COLUMNS = list(silver_types())
SILVER_PASS = all_hold(SILVER_RULES)
