"""Line-first quality rules.

Each line is judged on its own by punctuation, navigation and boilerplate rules; failing lines go; a document whose
remaining lines hold too few of its words goes too. Everything is a column expression on the document's own row: no
shuffle, no explode.

Defined cases: a null or empty text has no words, fails the base rules and is not kept, its cleaned text is empty; a line
without words is neither judged nor removed; repeated rows are judged alike; columns of the input that have the name of a
result column give way, all others stay.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.exprs import add_columns, count_chars, free_name, let, n_words, words

SYMBOLS = "#*$%&|<>"
# Phrases of pages' own machinery.
BOILERPLATE = (
    "cookie policy", "use of cookies", "uses cookies", "enable javascript", "terms of use", "terms of service",
    "privacy policy", "all rights reserved", "lorem ipsum", "licensed under the", "click here", "sign up", "log in",
    "read more", "subscribe to",
)


class LineRules(NamedTuple):
    """Bounds of the rules; a line or document at a bound passes."""

    symbol_share: float = 0.3
    shout_share: float = 0.5
    boilerplate_words: int = 30
    min_words: int = 50
    max_repeat_share: float = 0.5
    max_lost_share: float = 0.5


def repeat_words(word_array: Column) -> Column:
    """Words inside three-word windows that occur twice or more in the text, first occurrences included."""

    def window(w: Column, i: Column) -> Column:
        text = F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        return F.struct(text.alias("t"), i.alias("i"))

    def covered(s: Column) -> Column:
        twins = F.filter(s, lambda x, k: (F.get(s, k - 1)["t"] == x["t"]) | (F.get(s, k + 1)["t"] == x["t"]))
        spots = F.transform(twins, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))
        return F.size(F.array_distinct(F.flatten(spots)))

    def count(w: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: window(w, i))
        return F.when(F.size(w) < 3, F.lit(0)).otherwise(let(F.sort_array(windows), covered))

    return let(word_array, count)


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line of the text."""
    worded = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(worded, lambda lines: F.size(lines) - F.size(F.array_distinct(lines)))


def line_rule(line: Column, size: Column, rules: LineRules) -> Column:
    """The first rule the line fails, else null."""
    sentence_end = r"""[.!?…。！？]["')\]»”’]*([\x20\x09-\x0D]|$)"""
    phrase = "(?i)" + "|".join(BOILERPLATE)
    shouts = F.size(F.split(line, "!![\\x20\\x09-\\x0D]")) - 1
    return (
        F.when(size == 0, F.lit(None).cast("string"))
        .when(count_chars(line, SYMBOLS) > size * F.lit(rules.symbol_share), "navigation")
        .when((size < rules.boilerplate_words) & line.rlike(phrase), "boilerplate")
        .when(shouts > size * F.lit(rules.shout_share), "boilerplate")
        .when(~line.rlike(sentence_end), "punctuation")
    )


def judge_lines(text: Column, rules: LineRules) -> Column:
    """Per line: its text, its words and the rule it fails."""

    def one(line: Column) -> Column:
        return let(n_words(line), lambda size: F.struct(
            line.alias("line"), size.alias("size"), line_rule(line, size, rules).alias("rule")
        ))

    return F.transform(F.split(text, "\n"), one)


def line_quality(df: DataFrame, text: str = "text", rules: LineRules = LineRules()) -> DataFrame:
    """``df`` with base counts, ``base_failed``, ``kept``, the cleaned text and the lines removed by rule."""
    body, ws, judged = (free_name(df, n) for n in ("body_", "words_", "lines_"))
    held = df.withColumn(body, F.coalesce(F.col(f"`{text}`"), F.lit("")))
    held = held.withColumn(ws, words(F.col(body)))
    held = held.withColumn(judged, judge_lines(F.col(body), rules))
    passing = F.filter(F.col(judged), lambda x: x["rule"].isNull())

    def removed(rule: str) -> Column:
        return F.size(F.filter(F.col(judged), lambda x: x["rule"] == rule)).cast("long")

    counted = add_columns(held, {
        "n_words": F.size(ws).cast("long"),
        "word_chars": F.char_length(F.regexp_replace(body, r"[\x20\x09-\x0D]+", "")).cast("long"),
        "n_symbols": count_chars(F.col(body), SYMBOLS).cast("long"),
        "n_dup_lines": duplicate_lines(F.col(body)).cast("long"),
        "n_repeat_words": repeat_words(F.col(ws)).cast("long"),
        "kept_words": F.aggregate(passing, F.lit(0), lambda a, x: a + x["size"]).cast("long"),
        "lines_punctuation": removed("punctuation"),
        "lines_navigation": removed("navigation"),
        "lines_boilerplate": removed("boilerplate"),
        "cleaned": F.array_join(F.transform(passing, lambda x: x["line"]), "\n"),
    }).drop(body, ws, judged)
    failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > F.lit(100 * rules.max_repeat_share) * F.col("n_words")
    )
    enough = F.col("kept_words") >= F.lit(1 - rules.max_lost_share) * F.col("n_words")
    return add_columns(counted, {"base_failed": failed, "kept": ~failed & enough})


def drop_rejected(df: DataFrame, text: str = "text", rules: LineRules = LineRules()) -> DataFrame:
    """The documents that pass, with their columns as they were and the lines that fail removed from the text."""
    rows = df.select(F.col(f"`{text}`").alias("text"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    kept = line_quality(rows, rules=rules).where("kept")
    return kept.select(*[F.col("cleaned" if c == text else f"row.`{c}`").alias(c) for c in df.columns])


ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
 w AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM t),
 p AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
 g AS (SELECT doc_id, i, CASE WHEN lead(word, 2) OVER o IS NOT NULL THEN
        word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o END AS tri
       FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
 f AS (SELECT doc_id, i, tri IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, tri) > 1 AS twin FROM g),
 c AS (SELECT doc_id, twin OR coalesce(lag(twin, 1) OVER o, FALSE) OR coalesce(lag(twin, 2) OVER o, FALSE) AS cov
       FROM f WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
 r AS (SELECT doc_id, CAST(count(*) FILTER (cov) AS BIGINT) AS n_repeat_words FROM c GROUP BY doc_id),
 l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t),
 s AS (SELECT doc_id, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS size FROM l),
 j AS (SELECT doc_id, line, size,
        len(regexp_extract_all(line, '[#*$%&|<>]')) > size * 0.3
        OR (size < 30 AND regexp_matches(line, '(?i)__PHRASES__'))
        OR len(regexp_extract_all(line, '!![\x20\x09-\x0D]')) > size * 0.5
        OR NOT regexp_matches(line, '[.!?…。！？]["'')\]»”’]*([\x20\x09-\x0D]|$)') AS bad
       FROM s WHERE size > 0),
 k AS (SELECT doc_id, CAST(sum(size) FILTER (NOT bad) AS BIGINT) AS kept_words,
        CAST(count(*) - count(DISTINCT line) AS BIGINT) AS n_dup_lines FROM j GROUP BY doc_id),
 a AS (SELECT t.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        coalesce(kept_words, 0) AS kept_words
       FROM t JOIN w USING (doc_id) LEFT JOIN r USING (doc_id) LEFT JOIN k USING (doc_id)),
 b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
 NOT base_failed AND kept_words >= 0.5 * n_words AS kept, kept_words FROM b
""".replace("__PHRASES__", "|".join(BOILERPLATE))
