"""Category codes, their inverse, scaling, and the hold-out split."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.feature import IndexToString, SQLTransformer, StringIndexer, StringIndexerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.lookup import lookup
from pulseframe.functions.names import ref
from pulseframe.functions.scalar import as_category
from pulseframe.session import pin


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_categories(cols: list[str]) -> SQLTransformer:
    """Missing values become a category of their own before coding; original columns stay."""
    parts = ", ".join(f"coalesce(CAST({quoted(c)} AS STRING), 'None') AS {quoted(c + '__text')}" for c in cols)
    return SQLTransformer(statement=f"SELECT *, {parts} FROM __THIS__")


def coder(cols: list[str], unseen: str = "error") -> StringIndexer:
    """Codes in alphabetical order of the labels; a label not seen at fitting is an error unless kept apart."""
    return StringIndexer(
        inputCols=cols, outputCols=[f"{c}__code" for c in cols], stringOrderType="alphabetAsc", handleInvalid=unseen
    )


def encode(df: DataFrame, cols: list[str]) -> tuple[DataFrame, StringIndexerModel]:
    """Fit and apply codes; the codes come back as integers in ``<column>__code``."""
    text = text_categories(cols).transform(df)
    model = coder([f"{c}__text" for c in cols]).fit(text)
    coded = model.transform(text)
    codes = [ref(f"{c}__text__code").cast("int").alias(f"{c}__code") for c in cols]
    return coded.select(*map(ref, df.columns), *codes), model


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """(label, code): the place of each label of a column among its sorted labels; missing values are the label None.

    Distinct labels are dealt by range and sorted inside their partition. A label's code is its place there after the labels of the
    partitions before it, whose sizes, one number each, are all that reaches the driver.
    """
    labels = df.select(as_category(ref(column)).alias("label")).distinct()
    spread = labels.repartitionByRange("label").sortWithinPartitions("label")
    at = pin(spread.withColumn("at", F.monotonically_increasing_id()))  # partition number above PLACE_BITS bits of place
    part = F.shiftright("at", PLACE_BITS)
    sizes = dict(map(tuple, at.groupBy(part).agg(F.count(F.lit(1))).collect()))
    before, ahead = {}, 0
    for p in sorted(sizes):
        before[p], ahead = ahead, ahead + sizes[p]
    offset = F.create_map(*[F.lit(x).cast("long") for pair in before.items() for x in pair]) if before else F.lit(None).cast("map<bigint,bigint>")
    return at.select("label", (offset[part.cast("long")] + F.col("at").bitwiseAND((1 << PLACE_BITS) - 1)).cast("long").alias("code"))


PLACE_BITS = 33


def encode_by_tables(df: DataFrame, cols: list[str]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """``df`` with ``<column>__code``, and each column's table of labels and codes; for columns with any number of labels."""
    tables, out = {}, df
    for c in cols:
        tables[c] = pin(label_codes(df, c))
        key, code = f"{c}__label", f"{c}__code"
        coded = tables[c].select(F.col("label").alias(key), F.col("code").alias(code))
        out = lookup(out.withColumn(key, as_category(ref(c))), coded, [key]).drop(key)
    return out, tables


def decoder(labels: list[str], code: str, out: str) -> Transformer:
    return IndexToString(inputCol=code, outputCol=out, labels=labels)


def decode(code: Column, labels: list[str]) -> Column:
    """Label of a code as an expression."""
    return F.get(F.array(*map(F.lit, labels)), code.cast("int"))


def hash_bucket(key: Column, seed: int = 42, buckets: int = 100) -> Column:
    """A stable bucket per key, independent of partitioning and of run."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(buckets))


def arithmetic_bucket(key: Column, seed: int = 42, buckets: int = 100, factor: int = 7919) -> Column:
    """The same idea for integer keys, in arithmetic that any SQL engine shares."""
    return F.pmod(F.pmod(key, F.lit(1_000_003)) * F.lit(factor) + F.lit(seed), F.lit(1_000_003)) % F.lit(buckets)


def hold_out(df: DataFrame, bucket: Column, percent: int = 20) -> tuple[DataFrame, DataFrame]:
    """(train, test). A row's side depends on its bucket only, so it never changes between runs or reports."""
    return df.filter(bucket >= percent), df.filter(bucket < percent)


def exact_hold_out(df: DataFrame, order: list[Column], percent: int = 20, bins: int = 1 << 16) -> Column:
    """A condition for exactly ``percent`` % of the rows, rounded up: those that come first by ``order`` (whole numbers).

    The last of these rows is searched for one number after the other: rows are counted in bins of the range, then in bins of the bin
    that holds the wanted rank, until it holds one value; rows equal in it are ordered by the next number. Only bin counts reach the
    driver. A null comes first. Rows equal in all numbers are on one side, so such rows can move the size; an empty table holds none.
    """
    columns = [F.coalesce(c.cast("decimal(38,0)"), _whole(NULL_RANK)) for c in order]
    names = [f"o{i}" for i in range(len(columns))]
    tied = df.select(*[c.alias(n) for c, n in zip(columns, names, strict=True)])
    wanted = -(-tied.count() * percent // 100)
    held, equal = F.lit(False), F.lit(True)
    if wanted == 0:
        return held
    for i, (column, name) in enumerate(zip(columns, names, strict=True)):
        value, below, same = rank_value(tied, name, wanted, bins)
        edge = _whole(value)
        held, equal = held | (equal & (column < edge)), equal & (column == edge)
        wanted -= below
        if same == wanted or i == len(names) - 1:
            break
        tied = tied.filter(F.col(name) == edge)
    return held | equal


NULL_RANK = -(1 << 63) - 1


def _whole(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(38,0)")


def rank_value(df: DataFrame, name: str, rank: int, bins: int) -> tuple[int, int, int]:
    """(the value of the row of this rank, counted from 1, rows below it, rows of it)."""
    low, high = (int(x) for x in df.agg(F.min(name), F.max(name)).first())
    below = 0
    while True:
        width = (high - low) // bins + 1
        inside = df.filter(F.col(name).between(_whole(low), _whole(high)))
        place = F.call_function("div", F.col(name) - _whole(low), _whole(width))
        for at, n in sorted(map(tuple, inside.groupBy(place.alias("at")).agg(F.count(F.lit(1))).collect())):
            if below + n >= rank:
                break
            below += n
        low, high = low + at * width, min(high, low + (at + 1) * width - 1)
        if low == high:
            return low, below, n


def scale_parameters(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column, from one aggregation with a one-row result."""
    row = df.agg(
        *[F.avg(ref(c)).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.stddev_pop(ref(c)).alias(f"s{i}") for i, c in enumerate(cols)],
    ).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)}


def scaled(col: Column, mean: float, deviation: float) -> Column:
    """Centred and scaled value; a constant column is only centred."""
    return (col - F.lit(mean)) / F.lit(deviation or 1.0)
