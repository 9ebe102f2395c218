"""Quantiles per group, over any number of columns at once.

``approx_quantiles`` is one pass with a bounded summary per group and column. ``exact_quantiles`` finds the exact
order statistics without ever holding a group in one task. A distinct-count sketch sorts the columns into two kinds.

Columns with few distinct values, as measurements have, are counted by group and value in one pass. The counts are
combined before the shuffle, so the shuffle carries distinct values, not rows, and a running sum over them picks the
ranks.

Columns with many distinct values are searched:

1. a bounded summary gives each group's size and an interval around the wanted rank;
2. one pass counts the values below the interval, one counts the distinct values inside it (pre-aggregated before
   the shuffle, and spread over tasks by value);
3. where an interval still holds too many distinct values, it is cut into equal bins until it does not;
4. a running sum over the few values that are left picks the ranks.

The sketches only steer. The counts decide, and intervals that miss are widened to the full range.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from pulseframe.functions.lookup import lookup
from pulseframe.functions.names import ref
from pulseframe.session import pin

ACCURACY = 10_000
MAX_VALUES = 1_000_000
BINS = 1024
FEW_VALUES = 20_000


def approx_quantiles(
    df: DataFrame, keys: list[str], cols: list[str], prob: float = 0.5, accuracy: int = ACCURACY
) -> DataFrame:
    """Keys plus one column per input: an actual element near the wanted rank, in the input's own type."""
    return df.groupBy(*map(ref, keys)).agg(
        *[F.percentile_approx(ref(c), prob, accuracy).alias(c) for c in cols]
    )


@dataclass(frozen=True)
class _Slot:
    """One column at one probability."""

    number: int
    value: str
    size: str
    grid: str
    at: int
    prob: float


def _ranks(n: Column, prob: float, interpolate: bool) -> tuple[Column, Column]:
    """The one or two 1-based ranks that define the quantile of ``n`` values."""
    if interpolate:
        position = (n - 1).cast("double") * F.lit(float(prob))
        return (F.floor(position) + 1).cast("bigint"), (F.ceil(position) + 1).cast("bigint")
    rank = F.greatest(F.ceil(n.cast("double") * F.lit(float(prob))), F.lit(1)).cast("bigint")
    return rank, rank


def _summary(df: DataFrame, keys: list[str], columns: int, probs: list[float], accuracy: int) -> DataFrame:
    """Per group: count of each column, and per slot [min, low, element, high, max]."""
    margin = 3.0 / accuracy
    aggregates = []
    for i in range(columns):
        points = [p for q in probs for p in (0.0, max(q - margin, 0.0), q, min(q + margin, 1.0), 1.0)]
        aggregates.append(F.count(f"v{i}").alias(f"n{i}"))
        aggregates.append(
            F.percentile_approx(f"v{i}", F.array(*[F.lit(float(p)) for p in points]), F.lit(accuracy)).alias(f"g{i}")
        )
    return df.groupBy(*map(ref, keys)).agg(*aggregates)


def _attach(df: DataFrame, table: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """Bring a per-group table to the rows; a table without keys is a single row and travels as literals."""
    if keys:
        return lookup(df, table, keys, rows)
    row: Row = table.first()
    return df.select("*", *[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in table.schema])


def exact_quantiles(
    df: DataFrame,
    keys: list[str],
    cols: list[str],
    probs: list[float],
    interpolate: bool = False,
    accuracy: int = ACCURACY,
    max_values: int = MAX_VALUES,
    few_values: int = FEW_VALUES,
) -> DataFrame:
    """Keys plus an array column per input: its exact quantiles at ``probs`` (doubles).

    ``interpolate=False`` returns elements, the lower one of a middle pair; ``True`` interpolates linearly between
    neighbours. Integers are exact up to 2**53.
    """
    values = df.select(*map(ref, keys), *[ref(c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)])
    # A coarse sketch is enough to tell few from many, and keeps the aggregation buffer narrow.
    seen = values.agg(*[F.approx_count_distinct(f"v{i}", 0.2).alias(f"d{i}") for i in range(len(cols))]).first()
    few = [i for i in range(len(cols)) if seen[f"d{i}"] <= few_values]
    many = [i for i in range(len(cols)) if i not in few]
    found: DataFrame | None = None
    if few:
        found = _by_counting(values, keys, [f"v{i}" for i in few], probs, interpolate)
    if many:
        searched = _by_search(values, keys, [f"v{i}" for i in many], probs, interpolate, accuracy, max_values)
        if found is None:
            found = searched
        elif keys:
            found = lookup(found, pin(searched), keys)
        else:
            found = _attach(found, searched, keys, 1)
    return found.select(*map(ref, keys), *[F.col(f"v{i}").alias(c) for i, c in enumerate(cols)])


def _by_counting(df: DataFrame, keys: list[str], cols: list[str], probs: list[float], interpolate: bool) -> DataFrame:
    """One pass over the rows; from the shuffle on, one row per group, column and distinct value."""
    by_group = [ref(k) for k in keys]
    counts = (
        df.unpivot(by_group, [F.col(c) for c in cols], "slot", "v")
        .groupBy(*by_group, "slot", "v")
        .agg(F.count(F.lit(1)).alias("c"))
    )
    slot = Window.partitionBy(*by_group, "slot")
    known = F.when(F.col("v").isNotNull(), F.col("c")).otherwise(F.lit(0))
    ranked = counts.select(
        *by_group, "slot", "v",
        F.sum(known).over(slot.orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        F.sum(known).over(slot).alias("n"),
    )
    answers = {}
    for c in cols:
        answers[c] = []
        for prob in probs:
            low_rank, high_rank = _ranks(F.col("n"), prob, interpolate)
            mine = F.col("slot") == c
            low = F.min(F.when(mine & (F.col("upto") >= low_rank), F.col("v")))
            if interpolate:
                high = F.min(F.when(mine & (F.col("upto") >= high_rank), F.col("v")))
                low = _between(low, high, F.max(F.when(mine, F.col("n"))), prob)
            answers[c].append(low)
    return ranked.groupBy(*by_group).agg(*[F.array(*found).alias(c) for c, found in answers.items()])


def _between(low: Column, high: Column, n: Column, prob: float) -> Column:
    position = (n - 1).cast("double") * F.lit(float(prob))
    return low + (high - low) * (position - F.floor(position))


def _by_search(
    values: DataFrame,
    keys: list[str],
    cols: list[str],
    probs: list[float],
    interpolate: bool,
    accuracy: int,
    max_values: int,
) -> DataFrame:
    search = _Search(keys, cols, probs, interpolate, accuracy)
    values = values.select(*map(ref, keys), *[ref(c).alias(f"v{i}") for i, c in enumerate(cols)])
    summary = pin(_summary(values, keys, len(cols), probs, accuracy))
    groups = summary.count()
    for full_range in (False, True):
        counted, inside = search.count(values, summary, groups, full_range)
        state = counted.agg(
            F.count(F.lit(1)).alias("rows"),
            F.max("inside").alias("inside"),
            F.bool_or((F.col("below") >= F.col("r1")) | (F.col("below") + F.col("inside") < F.col("r2"))).alias("missed"),
        ).first()
        if not state["missed"]:
            break
    if (state["inside"] or 0) > max_values:
        counted, inside = _narrow(counted, pin(inside), [*keys, "slot"], state["rows"], max_values)
    return search.pick(counted, inside, state["rows"])


def quantiles_of_counts(
    counts: DataFrame, keys: list[str], cols: list[str], probs: list[float], interpolate: bool = False, max_values: int = MAX_VALUES
) -> DataFrame:
    """The quantiles of values that are already counted: (keys, ``cell``, ``value``, ``n``), a row or more per value; null values are left out.

    ``cell`` names the column that a value is of. The result is that of ``exact_quantiles`` over the rows that were counted.
    """
    search = _Search(keys, cols, probs, interpolate, ACCURACY)
    number = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(c), F.lit(i))])[F.col("cell")]
    slots = F.explode(F.array(*[F.lit(j) for j in range(len(probs))]))
    known = counts.where(F.col("value").isNotNull() & F.col("cell").isin(cols)).groupBy(*search.by_group, number.alias("of"), F.col("value").alias("v"))
    inside = pin(known.agg(F.sum("n").alias("c")).select("*", slots.alias("j")).withColumn("slot", F.col("of") * len(probs) + F.col("j")).drop("of", "j"))
    sizes = inside.groupBy(*search.by_group, "slot").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("inside"))
    ranks = [_ranks(F.col("n"), p, interpolate) for p in probs]

    def by_prob(side: int) -> Column:
        out = ranks[0][side]
        for j, r in enumerate(ranks[1:], start=1):
            out = F.when(F.col("slot") % len(probs) == j, r[side]).otherwise(out)
        return out

    counted = pin(sizes.select(*search.by_group, "slot", "n", by_prob(0).alias("r1"), by_prob(1).alias("r2"), F.lit(0).cast("long").alias("below"), "inside"))
    state = counted.agg(F.count(F.lit(1)).alias("rows"), F.max("inside").alias("inside")).first()
    if (state["inside"] or 0) > max_values:
        counted, inside = _narrow(counted, inside, [*keys, "slot"], state["rows"], max_values)
    return search.pick(counted, inside, state["rows"])


class _Search:
    """The two data passes of the search, and the final pick."""

    def __init__(self, keys: list[str], cols: list[str], probs: list[float], interpolate: bool, accuracy: int):
        self.keys, self.cols, self.probs = keys, cols, probs
        self.interpolate, self.accuracy = interpolate, accuracy
        self.by_group = [ref(k) for k in keys]
        # A slot is one column at one probability.
        self.slots = [
            _Slot(i * len(probs) + j, f"v{i}", f"n{i}", f"g{i}", 5 * j, float(p))
            for i in range(len(cols))
            for j, p in enumerate(probs)
        ]

    def count(
        self, values: DataFrame, summary: DataFrame, groups: int, full_range: bool
    ) -> tuple[DataFrame, DataFrame]:
        """Counts below and inside each slot's interval, and the counted distinct values inside it."""
        sizes = [F.col(f"n{i}") for i in range(len(self.cols))]
        interval = []
        for s in self.slots:
            whole = F.lit(True) if full_range else F.col(s.size) < self.accuracy
            grid = F.col(s.grid)
            low = F.when(whole, F.get(grid, F.lit(s.at))).otherwise(F.get(grid, F.lit(s.at + 1)))
            high = F.when(whole, F.get(grid, F.lit(s.at + 4))).otherwise(F.get(grid, F.lit(s.at + 3)))
            interval += [low.alias(f"lo{s.number}"), high.alias(f"hi{s.number}")]
        placed = _attach(values, summary.select(*self.by_group, *sizes, *interval), self.keys, groups)

        def within(s: _Slot) -> Column:
            return F.col(s.value).between(F.col(f"lo{s.number}"), F.col(f"hi{s.number}"))

        wide = placed.groupBy(*self.by_group).agg(
            *[F.max(f"n{i}").alias(f"n{i}") for i in range(len(self.cols))],
            *[F.count_if(F.col(s.value) < F.col(f"lo{s.number}")).alias(f"below{s.number}") for s in self.slots],
            *[F.count_if(within(s)).alias(f"inside{s.number}") for s in self.slots],
        )
        targets = []
        for s in self.slots:
            low_rank, high_rank = _ranks(F.col(s.size), s.prob, self.interpolate)
            targets.append(
                F.struct(
                    F.lit(s.number).alias("slot"), F.col(s.size).alias("n"),
                    low_rank.alias("r1"), high_rank.alias("r2"),
                    F.col(f"below{s.number}").alias("below"), F.col(f"inside{s.number}").alias("inside"),
                )
            )
        counted = pin(wide.select(*self.by_group, F.inline(F.array(*targets))).filter("n > 0"))
        hits = [
            F.when(within(s), F.struct(F.lit(s.number).alias("slot"), F.col(s.value).alias("v"))) for s in self.slots
        ]
        inside = (
            placed.select(*self.by_group, F.explode(F.array_compact(F.array(*hits))).alias("hit"))
            .groupBy(*self.by_group, F.col("hit.slot").alias("slot"), F.col("hit.v").alias("v"))
            .agg(F.count(F.lit(1)).alias("c"))
        )
        return counted, inside

    def pick(self, counted: DataFrame, inside: DataFrame, rows: int) -> DataFrame:
        """Read the wanted ranks off a running sum over the values that are left."""
        by = [*self.by_group, F.col("slot")]
        running = Window.partitionBy(*by).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
        ranked = lookup(
            inside.withColumn("upto", F.sum("c").over(running)), counted, [*self.keys, "slot"], rows
        ).withColumn("upto", F.col("upto") + F.col("below"))
        answers = []
        for s in self.slots:
            mine = F.col("slot") == s.number
            low = F.min(F.when(mine & (F.col("upto") >= F.col("r1")), F.col("v")))
            if self.interpolate:
                high = F.min(F.when(mine & (F.col("upto") >= F.col("r2")), F.col("v")))
                low = _between(low, high, F.max(F.when(mine, F.col("n"))), s.prob)
            answers.append(low)
        k = len(self.probs)
        return ranked.groupBy(*self.by_group).agg(
            *[F.array(*answers[i * k:(i + 1) * k]).alias(c) for i, c in enumerate(self.cols)]
        )


def _narrow(
    counted: DataFrame, inside: DataFrame, by: list[str], rows: int, max_values: int
) -> tuple[DataFrame, DataFrame]:
    """Cut intervals into equal bins until none holds more than ``max_values`` distinct values."""
    refs = [ref(k) for k in by]
    for _ in range(64):
        extent = pin(
            inside.groupBy(*refs).agg(
                F.count(F.lit(1)).alias("values"), F.min("v").alias("lo"), F.max("v").alias("hi")
            )
        )
        if extent.filter(F.col("values") > max_values).isEmpty():
            return counted, inside
        spread = (F.col("v") - F.col("lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0))
        bin_no = F.coalesce(F.least(F.floor(spread * BINS), F.lit(BINS - 1)), F.lit(0)).cast("int")
        binned = lookup(inside, extent, by, rows).withColumn("bin", bin_no).drop("values", "lo", "hi")
        # At most BINS rows per interval reach the running sum.
        per_bin = binned.groupBy(*refs, "bin").agg(F.sum("c").alias("in_bin"))
        running = Window.partitionBy(*refs).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        per_bin = per_bin.withColumn("before", F.coalesce(F.sum("in_bin").over(running), F.lit(0)))
        found = lookup(per_bin, counted, by, rows).withColumn("start", F.col("below") + F.col("before"))

        def holds(rank: str) -> Column:
            return (F.col("start") < F.col(rank)) & (F.col("start") + F.col("in_bin") >= F.col(rank))

        kept = pin(
            found.groupBy(*refs).agg(
                F.min(F.when(holds("r1"), F.col("bin"))).alias("first_bin"),
                F.max(F.when(holds("r2"), F.col("bin"))).alias("last_bin"),
                F.min(F.when(holds("r1"), F.col("start"))).alias("below"),
            )
        )
        inside = pin(
            lookup(binned, kept.drop("below"), by, rows)
            .filter(F.col("bin").between(F.col("first_bin"), F.col("last_bin")))
            .drop("bin", "first_bin", "last_bin")
        )
        counted = pin(lookup(counted.drop("below"), kept.select(*refs, "below"), by, rows))
    raise RuntimeError("quantile interval did not shrink")


def exact_medians(df: DataFrame, keys: list[str], cols: list[str], interpolate: bool = False, **options) -> DataFrame:
    """Keys plus one median per column: an element in the column's own type, or an interpolated double."""
    found = exact_quantiles(df, keys, cols, [0.5], interpolate, **options)
    kinds = dict(df.dtypes)
    return found.select(
        *map(ref, keys),
        *[F.get(ref(c), F.lit(0)).cast("double" if interpolate else kinds[c]).alias(c) for c in cols],
    )
