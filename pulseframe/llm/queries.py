"""The registered queries of this subpackage: each operator over its whole table, with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.llm import (
    bond, chat, decontaminate, fill_middle, jaccard_join, line_quality, line_runs, mixing, substrings, token_files, toxicity, url_rules,
    virtual_slots,
)
from pulseframe.llm.exprs import table
from pulseframe.session import scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def register(name: str, sql: str | None = None):
    def put(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return put


@register("op1_quality_lines", line_quality.ORACLE_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.line_quality(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "kept_words"
    )


@register("op2_chat_format", chat.ORACLE_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.with_probe(table(spark, sf_dir, "conversations"))
    parts = turns.select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts"))
    return chat.chat_digests(chat.format_chat(parts))


@register("op3_url_rules", url_rules.ORACLE_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(url_rules.RULES, "host string, path string, verdict string")
    return url_rules.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select(
        "page_id", "host", "path", "rule", "verdict"
    )


@register("op4_token_files")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_file())
    return token_files.read_token_files(spark, path, digest=True)


@register("op9_mix_sources")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan_mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    taken = F.aggregate(mixing.whole_draws(), F.lit(0).cast("long"), lambda a, x: a + x["words"])
    return planned.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


@register("op8_substring_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


@register("op7_jaccard_join")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


@register("op5_line_runs", line_runs.ORACLE_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_runs.delete_repeats(table(spark, sf_dir, "documents"), lines=1, words=line_runs.WORDS)
    return kept.select(
        "doc_id", "n_lines", "n_removed", "n_runs", F.char_length("kept").cast("long").alias("kept_chars"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@register("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    fitted = toxicity.train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    scored = toxicity.score(docs, fitted)
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "threshold", "flagged",
    )


@register("op6_decontaminate")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op11_virtual_slots")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = virtual_slots.shards_of(table(spark, sf_dir, "documents"), scratch(spark, "slot-map"), 8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("place").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "next_shard",
    )


@register("op12_bond_negatives", bond.ORACLE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return bond.hard_negatives(vectors, F.col("vec_id") % 50 == 0)


@register("op13_fill_middle", fill_middle.ORACLE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id", "n", "form", F.col("prefix_end").alias("prefix_chars"),
        (F.col("middle_end") - F.col("prefix_end")).alias("middle_chars"), F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
