"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.llm import decontaminate, jaccard_join, line_quality, mixing, token_files
from pulseframe.llm.exprs import free_name, table
from pulseframe.llm.queries import tokenizer_file
from pulseframe.session import scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: rejected documents go, the lines that fail go from the others."""
    return line_quality.drop_rejected(docs)


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key of each row: a hash of id and text, so that ids that are null or come again tell rows apart."""
    key = free_name(docs, "row_key")
    return docs.withColumn(key, F.xxhash64("doc_id", F.xxhash64("text"))), key


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near duplicates: of each group of linked documents the one with the least id stays, a null id last, ties by text.

    Rows that are equal in id and text count as one. Documents without words are linked with nothing and stay. An empty table
    gives none.
    """
    rows, key = keyed(docs)
    groups = jaccard_join.jaccard_components(rows, doc_id=key).select(F.col("doc_id").alias("key_"), F.col("component_id").alias("group_"))
    named = rows.select(F.col(key).alias("key_"), F.col("doc_id").alias("id_")).distinct().join(groups.distinct(), "key_")
    first = named.groupBy("group_").agg(F.min(F.struct(F.col("id_").isNull().alias("none"), "id_", "key_")).alias("first"))
    kept = rows.join(first.select(F.col("first.key_").alias("key_")), F.col(key) == F.col("key_"), "left_semi")
    return kept.dropDuplicates([key]).select(*docs.columns)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold an item go, other rows of the same id or without one stay.

    Repeated rows go together; null texts hold nothing; an empty table gives none.
    """
    rows, key = keyed(docs)
    found = decontaminate.leaks(rows, table(spark, sf_dir, "benchmark"), doc_id=key).select(F.col("doc_id").alias("leak_")).distinct()
    return rows.join(found, F.col(key) == F.col("leak_"), "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Source mix: a row for each time the mix takes a document, dealt to the tree's shards and shuffled in each."""
    return mixing.in_shards(mixing.mixed_rows(mixing.plan_mix(docs))).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left, listed by document as they read back."""
    path = scratch(spark, "pipeline-tokens")
    token_files.write_token_files(docs, path, tokenizer_file())
    return token_files.read_token_files(spark, path, digest=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", clean), ("n-gram Jaccard join", one_of_each), ("benchmark decontamination", without_leaks),
    ("mixing sources to target weights", mix), ("token-ID / binary output", tokens),
]
# The mix draws by hash and the last stage writes tokens: SQL states neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = scratch(spark, f"stage-{k + 1}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
