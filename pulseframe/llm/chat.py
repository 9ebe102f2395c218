r"""Chat formatting of typed content parts.

A turn is a list of parts (text, image, audio, document). A visitor turns each part into text: a text part is escaped, the
others become one placeholder each, in order, with a record of the attachment and the tokens it expands to. Turns are
joined under a template whose control strings cannot come from a text: every control string in a text gets a backslash
after its first character, one more if it has some already, and reading back takes one away, so that each text returns
as it was.

Defined cases: null text or role counts as empty; a part of unknown kind is an empty text; turns are ordered by turn
number (null first), ties by role and content, and repeated turns all stay; an empty table gives no rows. Extra columns of
the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, BODY, END = "<|turn|>", "<|text|>", "<|end|>"
# The control strings a text may not carry raw; the first character opens, the rest follows.
CONTROL = r"\|[a-z_]+\|>|/?s>|/?INST\]"
PLACEHOLDER = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
TOKENS_PER_UNIT = {"image": 1, "audio": 25, "document": 512}
PARTS = "array<struct<kind:string,text:string,ref:string,units:bigint>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), rf"([<\[])(\\*)({CONTROL})", r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)\\({CONTROL})", "$1$2$3")


def text_part(text: Column) -> Column:
    """A turn of one text part."""
    null = F.lit(None)
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"), null.alias("ref"), null.alias("units"))).cast(PARTS)


def visit(part: Column) -> Column:
    """What a part becomes: its rendered text and the tokens an attachment expands to (one per placeholder at least)."""
    shown, tokens = F.when(part["kind"] == "text", escape(part["text"])), F.when(part["kind"] == "text", F.lit(0))
    for kind, mark in PLACEHOLDER.items():
        shown = shown.when(part["kind"] == kind, F.lit(mark))
        size = F.greatest(F.lit(1), F.coalesce(part["units"], F.lit(1)) * TOKENS_PER_UNIT[kind])
        tokens = tokens.when(part["kind"] == kind, size)
    return F.struct(
        part["kind"].alias("kind"), part["ref"].alias("ref"), F.coalesce(shown, F.lit("")).alias("shown"),
        F.coalesce(tokens, F.lit(0)).cast("long").alias("tokens"),
    )


def format_chat(
    df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts",
    train_role: str = "assistant",
) -> DataFrame:
    """One row per conversation.

    ``formatted`` is the text, ``loss_mask`` says per turn whether its body is trained on, ``attachments`` lists the
    parts other than text in order, ``expanded_tokens`` the tokens that their placeholders stand for.
    """
    row = F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(parts), F.array().cast(PARTS)).alias("parts"),
    )
    turns = df.groupBy(F.col(key).alias("conv_id")).agg(F.sort_array(F.collect_list(row)).alias("turns"))
    seen = F.transform("turns", lambda t: F.struct(t["turn"].alias("turn"), t["role"].alias("role"), F.transform(t["parts"], visit).alias("parts")))
    visited = turns.select("conv_id", seen.alias("turns"))

    def render(t: Column) -> Column:
        body = F.array_join(F.transform(t["parts"], lambda p: p["shown"]), "")
        return F.concat(F.lit(TURN), escape(t["role"]), F.lit(BODY), body, F.lit(END))

    def attached(t: Column) -> Column:
        others = F.filter(t["parts"], lambda p: p["kind"].isin(list(PLACEHOLDER)))
        return F.transform(others, lambda p, i: F.struct(
            t["turn"].alias("turn"), i.alias("ordinal"), p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens")
        ))

    out = visited.select(
        "conv_id",
        F.array_join(F.transform("turns", render), "").alias("formatted"),
        F.transform("turns", lambda t: t["role"] == train_role).alias("loss_mask"),
        F.flatten(F.transform("turns", attached)).alias("attachments"),
    )
    total = F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + x["tokens"])
    return out.withColumn("expanded_tokens", total)


def read_chat(df: DataFrame) -> DataFrame:
    """The turns as they were: ``turns`` of (role, text, trained), read from ``formatted`` and ``loss_mask``."""
    pieces = F.slice(F.split("formatted", r"<\|turn\|>"), 2, F.size("loss_mask"))
    mark, end = len(BODY), len(END)

    def turn(piece: Column, trained: Column) -> Column:
        at = F.instr(piece, BODY)
        body = piece.substr(at + mark, F.char_length(piece) - at - mark - end + 1)
        return F.struct(
            unescape(piece.substr(F.lit(1), at - 1)).alias("role"), unescape(body).alias("text"), trained.alias("trained")
        )

    return df.withColumn("turns", F.zip_with(pieces, "loss_mask", turn))


def chat_digests(df: DataFrame) -> DataFrame:
    """Digest columns of formatted conversations, all read back from the formatted text."""
    back = read_chat(df)
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["trained"]), lambda t: t["text"]), "")
    texts = back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), whole.alias("whole"), loss.alias("loss"), F.col("formatted"))
    return texts.select(
        "conv_id", "n_turns", F.sha2("whole", 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


PROBE_ID, PROBE_TEXT = -7, "</s>[INST] ok [/INST]"


def with_probe(df: DataFrame) -> DataFrame:
    """``df`` plus a conversation of a user and an assistant turn that both carry control strings."""
    probe = df.sparkSession.range(2).select(
        F.lit(PROBE_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE_TEXT).alias("text"),
    )
    return df.select("conv_id", "turn", "role", "text").unionByName(probe)


ORACLE_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
 e AS (SELECT *, regexp_replace(text, '([<\[])(\\*)(\|[a-z_]+\|>|/?s>|/?INST\])', '\1\2\\\3', 'g') AS safe FROM c),
 g AS (SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS whole,
  coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
  string_agg('<|turn|>' || role || '<|text|>' || safe || '<|end|>', '' ORDER BY turn, role, text) AS formatted
  FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
 sha256(loss) AS loss_sha256, CAST(length(formatted) AS BIGINT) AS formatted_chars FROM g
"""
