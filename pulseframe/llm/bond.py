"""Hard negatives by a vertical scan (branch and bound on decomposed vectors).

Vectors are held by column, in groups of rows. For each anchor a group's columns are read in descending order of the anchor's
own magnitude there; what the columns not yet read can still add lies between sums of their smallest and largest products, so
each row's score has a lower and an upper bound all along. A bitmap holds the rows that can still matter: first those that may
be among the anchor's best rows of its label, then, in a second pass in which those scores are known, the rows of other labels
that may fall in a positive's score window and be among its best there. After the last column what is left is exact.

The table is dealt into groups of bounded size and stays where it is; anchors, a stated small share of the rows, visit every
group. A task holds one group and reads the anchors as they come. Each group answers with a few rows per anchor, which a ranked
window puts together. Nothing goes through the driver but three numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseframe.llm.exprs import let, partitions
from pulseframe.session import pin

#: Most rows of a group, about.
GROUP_ROWS = 1 << 18
#: Columns read between two looks at the bounds.
STEP = 16
#: Quantised components stay below this in magnitude, so that scores fit in a long.
LARGEST = 1 << 23

FOUND = "anchor long, no int, id long, score long, other long"


class Group:
    """Rows of a group by column. Rows are sorted by label, and by id within it; ``place`` is their order by id, nulls last."""

    def __init__(self, batches: list[pa.RecordBatch], width: int):
        table = pa.Table.from_batches(batches)
        label = table.column("label").to_numpy()
        ids = table.column("id")
        self.null = ids.is_null().to_numpy()
        plain = ids.fill_null(0).to_numpy()
        row = table.column("row").to_numpy()
        order = np.lexsort((row, plain, self.null, label))
        place = np.empty(len(row), np.int64)
        place[np.lexsort((row, plain, self.null))] = np.arange(len(row))
        self.label, self.id, self.null, self.row, self.place = (x[order] for x in (label, plain, self.null, row, place))
        values = table.column("parts").combine_chunks().flatten().to_numpy().reshape(len(row), width)
        self.columns = np.ascontiguousarray(values[order].T.astype(np.int64))
        self.labels, first = np.unique(self.label, return_index=True)
        self.bounds = np.append(first, len(row))

    def of_label(self, label: int) -> slice:
        at = int(np.searchsorted(self.labels, label))
        known = at < len(self.labels) and self.labels[at] == label
        return slice(int(self.bounds[at]), int(self.bounds[at + 1])) if known else slice(0, 0)


def scan(columns: np.ndarray, anchor: np.ndarray, bitmap: np.ndarray, low: np.ndarray, high: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
    """Rows (of ``bitmap``, which shrinks) that ``keep`` never gave up, with their exact scores.

    ``keep(lower, upper)`` says which rows the bounds still allow; it must allow a row whose bounds have met and that counts.
    """
    order = np.argsort(-np.abs(anchor), kind="stable")
    a = anchor[order]
    ends = np.sort(np.stack([a * low[order], a * high[order]]), axis=0)
    rest = np.concatenate([np.cumsum(ends[:, ::-1], axis=1)[:, ::-1], np.zeros((2, 1), np.int64)], axis=1)
    sums = np.zeros(len(bitmap), np.int64)
    for at in range(0, len(a), STEP):
        live = np.flatnonzero(bitmap)
        if not len(live):
            break
        read = order[at : at + STEP]
        part = columns[read] if len(live) == len(bitmap) else columns[np.ix_(read, live)]
        sums[live] += a[at : at + STEP] @ part
        end = min(at + STEP, len(a))
        bitmap[live] = keep(sums[live] + rest[0, end], sums[live] + rest[1, end])
    live = np.flatnonzero(bitmap)
    return live, sums[live]


def kth(values: np.ndarray, k: int) -> int | None:
    """The ``k``-th largest, None if there are fewer."""
    return int(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else None


def best(score: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Where the ``k`` highest scores are, ties by place."""
    if len(score) > 4 * k:
        near = np.flatnonzero(score >= kth(score, k))
        return near[np.lexsort((place[near], -score[near]))[:k]]
    return np.lexsort((place, -score))[:k]


def positives_of(group: Group, anchor: np.ndarray, label: int, row: int, k: int) -> Iterator[tuple[int, int, int]]:
    """(no, row of the group, score) of the anchor's best rows of its label here; ``no`` is 0."""
    own = group.of_label(label)
    columns = group.columns[:, own]
    if not columns.shape[1]:
        return
    bitmap = group.row[own] != row

    def keep(lower, upper):
        least = kth(lower, k)
        return np.ones(len(lower), bool) if least is None else upper >= least

    live, score = scan(columns, anchor, bitmap, columns.min(axis=1), columns.max(axis=1), keep)
    for i in best(score, group.place[own][live], k):
        yield 0, own.start + int(live[i]), int(score[i])


def negatives_of(
    group: Group, anchor: np.ndarray, label: int, windows: list[tuple[int, int, int]], k: int, low: np.ndarray, high: np.ndarray
) -> Iterator[tuple[int, int, int]]:
    """(no, row of the group, score) of the best rows of other labels in each score window (no, least, most)."""
    windows = [w for w in windows if w[1] <= w[2]]
    if not windows:
        return
    bitmap = np.ones(len(group.row), bool)
    bitmap[group.of_label(label)] = False

    def keep(lower, upper):
        out = np.zeros(len(lower), bool)
        for _, least, most in windows:
            sure = lower[(lower >= least) & (upper <= most)]
            reached = kth(sure, k)
            out |= (lower <= most) & (upper >= (least if reached is None else reached))
        return out

    live, score = scan(group.columns, anchor, bitmap, low, high, keep)
    place = group.place[live]
    for no, least, most in windows:
        inside = np.flatnonzero((score >= least) & (score <= most))
        for i in best(score[inside], place[inside], k):
            yield no, int(live[inside[i]]), int(score[inside[i]])


def visits(width: int, answer):
    """Task function: rows sorted by group, a group's own rows before the anchors that visit it. ``answer(group, bounds, anchor row)``
    gives (no, row of the group, score)."""

    def emit(group: Group, anchors: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        low, high = group.columns.min(axis=1), group.columns.max(axis=1)
        vectors = anchors.column("parts").flatten().to_numpy().reshape(-1, width).astype(np.int64)
        out: list[tuple] = []
        for i, (row, label, windows) in enumerate(zip(*(anchors.column(c).to_pylist() for c in ("row", "label", "windows")), strict=True)):
            out += [(row, no, at, s) for no, at, s in answer(group, low, high, vectors[i], label, row, windows)]
        if out:
            anchor, no, at, score = (np.array(x, np.int64) for x in zip(*out, strict=True))
            columns = [anchor, no.astype(np.int32), pa.array(group.id[at], mask=group.null[at]), score, group.row[at]]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["anchor", "no", "id", "score", "other"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, group = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("group", "kind")], axis=1)
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if keys[a, 0] != current:
                    current, held, group = keys[a, 0], [], None
                part = batch.slice(a, b - a)
                if keys[a, 1] == 0:
                    held.append(part)
                elif held:
                    group = group or Group(held, width)
                    yield from emit(group, part)

    return run


def floor_div(value: Column, by: int) -> Column:
    return F.call_function("div", value - F.pmod(value, F.lit(by)), F.lit(by))


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))


def sound(vector: Column, scale: int) -> Column:
    """No component is null, NaN, infinite or, scaled, ``LARGEST`` or more in magnitude."""
    return F.forall(vector, lambda x: F.coalesce(F.abs(F.lit(scale) * x.cast("double")) < LARGEST, F.lit(False)))


def dealt(rows: DataFrame, anchors: DataFrame, groups: int) -> DataFrame:
    """Each row in its group, each anchor in all, sorted as ``visits`` reads them."""
    columns = ["group", "kind", "row", "id", "label", "parts"]
    own = rows.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int")).withColumn("kind", F.lit(0))
    guests = anchors.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("kind", F.lit(1))
    none = F.lit(None).cast("array<struct<no:int,least:bigint,most:bigint>>").alias("windows")
    both = own.select(*columns, none).unionByName(guests.select(*columns, "windows"))
    return both.repartitionById(groups, "group").sortWithinPartitions("group", "kind", "row")


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, lower: int = 50, upper: int = 95,
    scale: int = 256, key: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor and each of its positives.

    A score is the whole inner product of components floor(scale * x); higher comes first, ties by smaller key, a null key last.
    Positives are the anchor's best ``positives`` other rows of its label, an anchor's negatives for one of them the best
    ``negatives`` rows of other labels whose score is ``lower`` to ``upper`` percent of the positive's. Rows with a null label, a
    null vector, or a component that is null, not finite or, scaled, 2**23 or more in magnitude take no part. A shorter vector
    counts as filled with zeros; an empty one scores 0. Repeated rows are rows of their own: each copy of an anchor gives its
    rows, and is a positive of the other copies. A null key is never an anchor where ``is_anchor`` is null for it. Of rows equal
    in key and score any may stand for the others, as all that is returned is equal. An empty table gives none. Other columns
    are not read, so their names cannot clash.
    """
    spark = vectors.sparkSession
    usable = F.col(label).isNotNull() & F.col(vector).isNotNull() & sound(F.col(vector), scale)
    parts = quantised(F.col(vector), scale).cast("array<int>")
    rows = pin(vectors.where(F.coalesce(usable, F.lit(False))).select(
        F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
        parts.alias("parts"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    ))
    n, width = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("parts")), F.lit(0))).first()
    groups = max(partitions(spark), -(-n // GROUP_ROWS))
    width = max(1, width)
    full = let(F.col("parts"), lambda p: F.concat(p, F.array_repeat(F.lit(0), F.lit(width) - F.size(p))))
    rows = rows.withColumn("parts", full)
    anchors = rows.where("is_anchor")
    windows = F.lit(None).cast("array<struct<no:int,least:bigint,most:bigint>>")

    def nearest(group, low, high, values, of_label, row, _):
        return positives_of(group, values, of_label, row, positives)

    best_first = [F.desc("score"), F.asc_nulls_last("id"), F.asc("other")]
    first = dealt(rows, anchors.withColumn("windows", windows), groups).mapInArrow(visits(width, nearest), FOUND)
    ranked = first.withColumn("no", F.row_number().over(Window.partitionBy("anchor").orderBy(*best_first)))
    chosen = pin(ranked.where(F.col("no") <= positives).select("anchor", "no", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))

    p = F.col("positive_score")
    least, most = -floor_div(-lower * p, 100), floor_div(upper * p, 100)
    each = F.struct("no", least.alias("least"), most.alias("most"))
    listed = chosen.groupBy("anchor").agg(F.sort_array(F.collect_list(each)).alias("windows"))
    guests = anchors.join(listed, F.col("row") == F.col("anchor")).drop("anchor")

    def in_windows(group, low, high, values, of_label, row, asked):
        return negatives_of(group, values, of_label, [(w["no"], w["least"], w["most"]) for w in asked], negatives, low, high)

    second = dealt(rows, guests, groups).mapInArrow(visits(width, in_windows), FOUND)
    per_pair = Window.partitionBy("anchor", "no").orderBy(*best_first)
    kept = second.withColumn("rank", F.row_number().over(per_pair)).where(F.col("rank") <= negatives)
    ids = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return kept.join(chosen, ["anchor", "no"]).join(ids, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a, v b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
), n AS (
  SELECT p.anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
