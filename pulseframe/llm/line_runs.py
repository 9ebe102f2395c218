"""Repeated runs of lines, by prefix doubling over the sequences of line ids.

A document is its sequence of lines that hold a word. A run is lines that follow each other; it counts if it has at least
``lines`` lines and ``words`` words, so one long line is a run that counts. A line is deleted if it is part of a run that counts
and occurs earlier too, in order of document id and line.

1. Documents of one sequence are one class, of which the first takes part. Ranks of runs of one line are line ids that occur twice or
   more. Stretches of such lines that are too short to count are left out.
2. Only shortest runs that count need a look, those from each line on and those up to each line: a longer run is a union of them, as
   each of its lines is in the shortest one from its start on or in the shortest one up to the line. They have few lines.
3. A round ranks runs of twice the length by the ranks of their halves and drops those that are unique, until the longest of the shortest
   runs is ranked or none is left. A run whose length is no power of two is ranked by two overlapping halves.
4. Shortest runs of one rank are an interval of the suffix array whose longest common prefix counts. All but its first are later
   copies; where they overlap they join into the maximal ones. Siblings in the order stand by first position, not by text.

A rank is named by its first position, found by a map-side aggregate, so a frequent line costs one row per task in the count
and is split by skew handling in the join back.

Defined cases: null text has no lines; lines without a word are no part of runs and stay where they are, but go with a later
copy of a whole row; a row that equals an earlier one in id and text is a later copy as a whole if it counts; null ids
come first, equal ids by a hash of their texts; documents that do not count keep everything; a text may be as long as a row may be, its
lines become rows; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseframe.llm.exprs import free_shuffles, let, n_words
from pulseframe.session import pin

HOLDS_WORD = r"[^\x20\x09-\x0D]"


def worded(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(HOLDS_WORD))


def position(pos: str = "pos") -> Column:
    return F.struct("key", F.col(pos).alias("pos"))


def named(runs: DataFrame, by: list[str], pos: str = "pos") -> DataFrame:
    """The runs whose ``by`` columns repeat, with ``home``, the first position that has them."""
    groups = runs.groupBy(*by).agg(F.count("*").alias("n"), F.min(position(pos)).alias("home")).where("n > 1")
    return runs.join(groups.drop("n"), by)


def sequences(slim: DataFrame, lines: int, words: int) -> DataFrame:
    """(key, seq) of the first document of each sequence of lines, if the whole of it counts."""
    seq = F.transform(worded(F.col("text")), lambda x: F.struct(F.xxhash64(x).alias("h"), F.xxhash64(F.lit(1), x).alias("g"), n_words(x).alias("w")))
    whole = slim.where("text IS NOT NULL").select("key", seq.alias("seq")).select("key", "seq", F.xxhash64("seq.h").alias("h"), F.xxhash64("seq.g").alias("g"))
    first = whole.groupBy("h", "g").agg(F.min("key").alias("key"), F.min_by("seq", "key").alias("seq"))
    enough = F.aggregate("seq", F.lit(0).cast("long"), lambda n, x: n + x["w"]) >= words
    return first.where((F.size("seq") >= lines) & enough).select("key", "seq")


def stretches(first: DataFrame, lines: int, words: int) -> DataFrame:
    """(key, pos, rank, ahead, behind) of lines that occur twice or more, in stretches that count; the last two are the lengths of
    the shortest run that counts from the line on, and up to it."""
    seq = first.select("key", F.posexplode("seq").alias("pos", "x")).select("key", "pos", "x.h", "x.g", F.col("x.w").cast("long").alias("w"))
    ranks = named(seq, ["h", "g"]).drop("h", "g").withColumnRenamed("home", "rank")
    ranks = ranks.withColumn("stretch", F.col("pos") - F.row_number().over(Window.partitionBy("key").orderBy("pos")))
    inside = Window.partitionBy("key", "stretch")
    ordered = inside.orderBy("pos")
    ranks = ranks.select(
        "*", F.row_number().over(ordered).alias("at"), F.count("*").over(inside).alias("n"), F.sum("w").over(inside).alias("total"),
        F.sum("w").over(ordered.rowsBetween(Window.unboundedPreceding, 0)).alias("until"),
    )
    ranks = ranks.where((F.col("total") >= words) & (F.col("n") >= lines)).withColumn("before", F.col("until") - F.col("w"))
    on = F.greatest(F.lit(lines), F.count("*").over(inside.orderBy("before").rangeBetween(0, words - 1)))
    back = F.greatest(F.lit(lines), F.count("*").over(inside.orderBy("until").rangeBetween(1 - words, 0)))
    ranks = ranks.withColumns({"on": on, "back": back})
    ahead = F.when((F.col("total") - F.col("before") >= words) & (F.col("n") - F.col("at") + 1 >= F.col("on")), F.col("on"))
    behind = F.when((F.col("until") >= words) & (F.col("at") >= F.col("back")), F.col("back"))
    return ranks.select("key", "pos", "rank", ahead.cast("int").alias("ahead"), behind.cast("int").alias("behind"))


def paired(ranks: DataFrame, shift: int) -> DataFrame:
    """Ranks joined with those ``shift`` lines further on in the same document."""
    later = ranks.select("key", (F.col("pos") - shift).alias("pos"), F.col("rank").alias("next"))
    return ranks.join(later, ["key", "pos"])


def later_copies(runs: DataFrame, ranks: DataFrame, length: int) -> DataFrame:
    """Those of ``runs`` (key, first, len) that occur earlier, by the ranks of runs of ``length`` lines, at most twice as short."""
    head = ranks.select("key", F.col("pos").alias("first"), F.col("rank").alias("head"))
    tail = ranks.select("key", F.col("pos").alias("last"), F.col("rank").alias("tail"))
    met = runs.join(head, ["key", "first"])
    even = met.where(F.col("len") == length).where(F.col("head") != position("first"))
    halves = met.where(F.col("len") > length).withColumn("last", F.col("first") + F.col("len") - length).join(tail, ["key", "last"])
    odd = named(halves, ["len", "head", "tail"], "first").where(F.col("home") != position("first"))
    return even.select("key", "first", "len").union(odd.select("key", "first", "len"))


def repeated_lines(first: DataFrame, lines: int, words: int) -> DataFrame:
    """(key, gone): the places of the lines of each document that are part of a later copy, in order."""
    spark = first.sparkSession
    base = pin(stretches(first, lines, words))
    free_shuffles(spark)
    each = F.array_compact(F.array(
        F.when(F.col("ahead").isNotNull(), F.struct(F.col("pos").alias("first"), F.col("ahead").alias("len"))),
        F.when(F.col("behind").isNotNull(), F.struct((F.col("pos") - F.col("behind") + 1).alias("first"), F.col("behind").alias("len"))),
    ))
    runs = base.select("key", F.explode(F.array_distinct(each)).alias("r")).select("key", "r.*")
    longest = base.agg(F.max(F.greatest("ahead", "behind"))).first()[0] or 0
    ranks, length, found = base.select("key", "pos", "rank"), 1, []
    while True:
        found.append(pin(later_copies(runs.where(F.col("len").between(length, 2 * length - 1)), ranks, length)))
        free_shuffles(spark)
        if 2 * length > longest:
            break
        longer = named(paired(ranks, length), ["rank", "next"])
        ranks, length = pin(longer.select("key", "pos", F.col("home").alias("rank"))), 2 * length
        free_shuffles(spark)
        if ranks.isEmpty():
            break
    spots = F.flatten(F.collect_set(F.sequence(F.col("first"), F.col("first") + F.col("len") - 1)))
    return reduce(DataFrame.union, found).groupBy("key").agg(F.array_sort(F.array_distinct(spots)).alias("gone"))


def delete_repeats(docs: DataFrame, lines: int = 2, doc_id: str = "doc_id", text: str = "text", words: int = 1) -> DataFrame:
    """Per document: ``kept`` text, lines with a word, lines deleted and maximal runs deleted; a run has ``lines`` lines and
    ``words`` words at least."""
    lines, words = max(lines, 1), max(words, 1)
    slim = docs.select(F.struct(F.col(f"`{doc_id}`").alias("id"), F.xxhash64(f"`{text}`").alias("mark")).alias("key"), F.col(f"`{text}`").alias("text"))
    first = pin(sequences(slim, lines, words))
    free_shuffles(docs.sparkSession)
    known = first.select("key", F.lit(True).alias("known")).join(repeated_lines(first, lines, words), "key", "left")
    rows = slim.groupBy("key").agg(F.first("text").alias("text"), F.count("*").alias("rows"))
    met = rows.join(known, "key", "left").select("key", F.coalesce("text", F.lit("")).alias("text"), "known", "gone", F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("copy"))
    met = met.select("*", F.size(worded(F.col("text"))).alias("n_lines"), n_words(F.col("text")).alias("n_words"))
    counts = (F.col("n_lines") >= lines) & (F.col("n_words") >= words)
    whole = counts & (F.col("known").isNull() | (F.col("copy") > 1))
    found = F.when(whole, F.sequence(F.lit(0), F.col("n_lines") - 1)).otherwise(F.coalesce("gone", F.array().cast("array<int>")))
    met = met.select("key.id", "text", "copy", "n_lines", found.alias("gone"))
    starts = F.filter("gone", lambda p, k: F.coalesce(F.get("gone", k - 1) != p - 1, F.lit(True)))

    def without(lines_: Column) -> Column:
        spots = F.sequence(F.lit(0), F.size(lines_) - 1)
        of_worded = F.filter(spots, lambda i: F.get(lines_, i).rlike(HOLDS_WORD))
        dropped = let(of_worded, lambda at: F.transform("gone", lambda p: F.get(at, p)))
        return F.array_join(F.transform(F.array_except(spots, dropped), lambda i: F.get(lines_, i)), "\n")

    walk = let(F.split("text", "\n"), without)
    kept = F.when(F.size("gone") == 0, F.col("text")).when(F.col("copy") > 1, "").otherwise(walk)
    return met.select(
        F.col("id").alias("doc_id"), kept.alias("kept"), F.col("n_lines").cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_removed"), F.size(starts).cast("long").alias("n_runs"),
    )


#: The query's threshold: a run of one line or more with 30 words or more.
WORDS = 30

ORACLE_SQL = rf"""
WITH l AS (SELECT doc_id, i, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w FROM (
   SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
 p AS (SELECT doc_id, i, line, w, row_number() OVER d AS pos, sum(w) OVER d AS until FROM l WHERE w > 0 WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
 ahead AS (SELECT doc_id, pos AS a, count(*) OVER r AS len, sum(w) OVER r AS words, list(line) OVER r AS body FROM p
   WINDOW r AS (PARTITION BY doc_id ORDER BY until - w RANGE BETWEEN CURRENT ROW AND {WORDS - 1} FOLLOWING)),
 behind AS (SELECT doc_id, pos - count(*) OVER r + 1 AS a, count(*) OVER r AS len, sum(w) OVER r AS words, list(line) OVER r AS body FROM p
   WINDOW r AS (PARTITION BY doc_id ORDER BY until RANGE BETWEEN {WORDS - 1} PRECEDING AND CURRENT ROW)),
 runs AS (SELECT DISTINCT doc_id, a, len, array_to_string(body, chr(10)) AS body FROM (SELECT * FROM ahead UNION ALL SELECT * FROM behind) WHERE words >= {WORDS}),
 copies AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, a) > 1 AS later FROM runs),
 gone AS (SELECT DISTINCT doc_id, unnest(range(a, a + len)) AS pos FROM copies WHERE later),
 f AS (SELECT p.doc_id, p.i, p.pos, g.pos IS NOT NULL AS gone FROM p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.pos = g.pos),
 s AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), FALSE) AS starts FROM f),
 a AS (SELECT l.doc_id, count(*) FILTER (l.w > 0) AS n_lines, count(*) FILTER (s.gone) AS n_removed, count(*) FILTER (s.starts) AS n_runs,
   coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (NOT coalesce(s.gone, FALSE)), '') AS kept
   FROM l LEFT JOIN s ON l.doc_id = s.doc_id AND l.i = s.i GROUP BY l.doc_id)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_removed AS BIGINT) AS n_removed, CAST(n_runs AS BIGINT) AS n_runs,
 CAST(length(kept) AS BIGINT) AS kept_chars, sha256(kept) AS kept_sha256 FROM a
"""
