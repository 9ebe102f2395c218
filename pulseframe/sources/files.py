"""Readers: bronze CSV, Parquet parts, JSON requests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from pulseframe.functions.names import ref
from pulseframe.operators.mapping import finite_numbers
from pulseframe.operators.quality import CORRUPT
from pulseframe.schema import CATEGORY_FEATURES, raw_schema, request_schema

# Dialect of the bronze files. Whole lines are parsed whatever columns are read, or a line's flaws would
# depend on the columns.
CSV_OPTIONS = {
    "header": "true", "quote": '"', "sep": ",", "mode": "PERMISSIVE", "columnPruning": "false",
    "columnNameOfCorruptRecord": CORRUPT,
}
JSON_TYPE = "application/json"


def read_bronze(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """A directory of CSV files, or a list of files, as text columns, never inferred; short or long lines keep their text aside."""
    return spark.read.schema(_with_corrupt(schema)).options(**CSV_OPTIONS).csv(path)


def _with_corrupt(schema: T.StructType | None) -> T.StructType:
    return T.StructType([*(schema or raw_schema()).fields, T.StructField(CORRUPT, T.StringType())])


def stream_bronze(spark: SparkSession, path: str, schema: T.StructType | None = None, **options) -> DataFrame:
    """The same directory as a stream of files; each run takes up only files not seen before."""
    reader: DataStreamReader = spark.readStream.schema(_with_corrupt(schema)).options(**CSV_OPTIONS, **options)
    return reader.csv(path)


def read_parts(spark: SparkSession, *paths: str, merge: bool = True) -> DataFrame:
    """All Parquet parts below the paths, matched by column name, columns absent from a part being NULL."""
    reader = spark.read.option("pathGlobFilter", "*.parquet").option("mergeSchema", str(merge).lower())
    reader = reader.option("recursiveFileLookup", "true")
    try:
        found = reader.parquet(*paths)
    except Exception as problem:
        if "UNABLE_TO_INFER_SCHEMA" in str(problem) or "PATH_NOT_FOUND" in str(problem):
            raise FileNotFoundError(f"no .parquet files below {', '.join(paths)}") from problem
        raise
    return finite_numbers(found)


def union_by_name(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name; a column a frame lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


#: A file that is one body comes as one row, so it must not be larger.
LARGEST_BODY = 64 << 20


def read_requests(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multiline: bool = False, largest: int = LARGEST_BODY
) -> tuple[DataFrame, DataFrame]:
    """JSON files of scoring requests: (one row per request, unreadable ones with file and reason).

    An object is one request, an array one per element. With ``multiline`` a file is one body, and a file of over ``largest`` bytes goes
    aside unread; without it each line is a body and files may be of any size.
    """
    text = spark.read.option("wholetext", str(multiline).lower()).text(path)
    if multiline:
        text = text.filter(F.col("_metadata.file_size") <= largest)
    bodies = text.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("body"))
    good, bad = parse_requests(bodies.filter(F.trim("body") != ""), "body", schema=schema)
    if multiline:
        listed = spark.read.format("binaryFile").load(path).filter(F.col("length") > largest)
        reason = F.format_string(f"the file has %d bytes, over {largest}; read it by lines", F.col("length"))
        bad = bad.unionByName(listed.select(F.col("path").alias("file"), F.lit(None).cast("string").alias("body"), reason.alias("reason")))
    return good.drop("file"), bad


def _problem(element: Column, fields: T.StructType, required: list[str]) -> Column:
    """What is wrong with one request, given as a map of texts; NULL if nothing is."""
    numbers = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    no_number = [
        F.when(element[c].isNotNull() & element[c].try_cast("double").isNull(), F.lit(f"{c} is no number")) for c in numbers
    ]
    absent = [F.when(element[c].isNull(), F.lit(f"{c} is missing")) for c in required if c in fields.names]
    return F.when(element.isNull(), F.lit("an element is null")).otherwise(F.coalesce(*no_number, *absent, F.lit(None)))


def _worked_out(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with ``columns`` in the place of those of the same name, worked out once a row.

    They come from a generator of one element: a filter on them stays above it. Else each filter would hold a copy of whatever they, and the
    columns they rest on, are made of, and plans of several filters outgrow the driver's memory.
    """
    kept = [ref(c) for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[x.alias(c) for c, x in columns.items()]))))


def parse_requests(
    df: DataFrame,
    body: str = "body",
    content_type: str | None = None,
    schema: T.StructType | None = None,
    required: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Request bodies in a column: (one row per request element, bodies that cannot be used with the reason).

    Missing numbers are left to the model, which fills them; the ``required`` fields, by default the categories, must be
    there. One bad element makes the body bad.
    """
    fields = schema or request_schema()
    required = CATEGORY_FEATURES if required is None else required
    text = F.trim(ref(body))
    listed = F.when(text.startswith("{"), F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
    texts = F.from_json(listed, T.ArrayType(T.MapType(T.StringType(), T.StringType())), {"mode": "PERMISSIVE"})
    parsed = _worked_out(df, {
        "__texts": F.when(F.try_parse_json(ref(body)).isNotNull(), texts),
        "__rows": F.from_json(ref(body), T.ArrayType(fields), {"mode": "PERMISSIVE"}),
    })
    problems = F.array_compact(F.transform("__texts", lambda e: _problem(e, fields, required)))
    reason = (
        F.when(F.col("__texts").isNull(), F.lit("body is no JSON object or array"))
        .when(F.size("__texts") == 0, F.lit("the array is empty"))
        .otherwise(F.get(problems, F.lit(0)))
    )
    if content_type is not None:
        known = F.coalesce(ref(content_type) == JSON_TYPE, F.lit(False))
        reason = F.when(~known, F.concat(F.lit("unsupported content type: "), F.coalesce(ref(content_type), F.lit("")))).otherwise(reason)
    parsed = _worked_out(parsed, {"reason": reason})
    kept = [c for c in df.columns if c not in (body, content_type)]
    good = parsed.filter(F.col("reason").isNull()).select(*map(ref, kept), F.inline("__rows"))
    bad = parsed.filter(F.col("reason").isNotNull()).select(*map(ref, df.columns), "reason")
    return good, bad
