"""Fill-in-the-middle: a text is cut at two of its unit boundaries and its three parts are put in another order.

The boundaries of a text (ends of its units, in code points) form a set kept as Roaring bitmaps keep theirs: offsets that share
their upper bits are one container, held as a sorted array, as a bitmap or as runs, whichever is smallest, next to the
cumulative cardinalities of the containers. The end of the k-th unit is then a search in the cumulative cardinalities and a
select inside one container. Tasks build the sets of a batch of texts at once and answer with two offsets; the cutting, the
sentinels and the way back are column expressions.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.bytewords import Texts, runs, word_spans
from pulseframe.llm.exprs import add_columns, free_name

#: A container spans so many offsets.
SPAN = 1 << 16
WORDS = SPAN // 64


class Container(NamedTuple):
    """``kind`` array: ``data`` is the offsets; bitmap: 64-bit words, ``before`` the ones ahead of each; run: the first offset of
    each run, ``before`` the members ahead of it."""

    kind: str
    data: np.ndarray
    before: np.ndarray | None

    def select(self, k: int) -> int:
        """The member that has ``k`` members below it."""
        if self.kind == "array":
            return int(self.data[k])
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        rest = k - int(self.before[at])
        if self.kind == "run":
            return int(self.data[at]) + rest
        word = np.unpackbits(self.data[at : at + 1].view(np.uint8), bitorder="little")
        return 64 * at + int(np.flatnonzero(word)[rest])


def container(low: np.ndarray) -> Container:
    """The smallest form of sorted distinct offsets below ``SPAN``."""
    starts = np.flatnonzero(np.diff(low, prepend=-2) != 1)
    sizes = {"array": 2 * len(low), "run": 4 * len(starts), "bitmap": SPAN // 8}
    kind = min(sizes, key=sizes.get)
    if kind == "array":
        return Container(kind, low.astype(np.uint16), None)
    if kind == "run":
        return Container(kind, low[starts].astype(np.uint16), starts)
    bits = np.zeros(SPAN, np.uint8)
    bits[low] = 1
    ahead = np.concatenate([[0], np.cumsum(bits.reshape(WORDS, 64).sum(axis=1))[:-1]])
    return Container(kind, np.packbits(bits, bitorder="little").view(np.uint64), ahead)


class Boundaries(NamedTuple):
    """A set of offsets: containers, the upper bits of each, and the cardinality up to the end of each."""

    upper: np.ndarray
    upto: np.ndarray
    containers: list[Container]

    def __len__(self) -> int:
        return int(self.upto[-1]) if len(self.upto) else 0

    def end_of(self, units: int) -> int:
        """The offset after so many units, 0 before the first."""
        if units == 0:
            return 0
        at = int(np.searchsorted(self.upto, units))
        ahead = int(self.upto[at - 1]) if at else 0
        return int(self.upper[at]) * SPAN + self.containers[at].select(units - 1 - ahead)


def boundaries(offsets: np.ndarray) -> Boundaries:
    """The set of sorted distinct ``offsets``."""
    upper = offsets // SPAN
    first = np.flatnonzero(np.diff(upper, prepend=-1))
    ends = np.append(first[1:], len(offsets)) if len(first) else first
    low = offsets % SPAN
    return Boundaries(upper[first], ends, [container(low[a:b]) for a, b in zip(first, ends, strict=True)])


def token_ends(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the tokens of a run of rows in code points of their row, and where each row's ends start.

    A token is white space with the word after it; white space at the end of a text is one too.
    """
    rows = len(t.bounds) - 1
    spans = word_spans(t)
    points = np.concatenate([[0], np.cumsum((t.data & 0xC0) != 0x80)])
    last = np.searchsorted(spans.row, np.arange(rows), side="right") - 1
    worded = (last >= 0) & (spans.row[last] == np.arange(rows)) if len(spans.row) else np.zeros(rows, bool)
    reached = np.where(worded, spans.end[last] if len(spans.end) else 0, t.bounds[:-1])
    tail = np.flatnonzero(reached < t.bounds[1:])
    row = np.concatenate([spans.row, tail])
    order = np.argsort(row, kind="stable")
    end, row = np.concatenate([spans.end, t.bounds[1:][tail]])[order], row[order]
    return points[end] - points[t.bounds[row]], np.searchsorted(row, np.arange(rows + 1))


def character_ends(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The end of every character, for cuts inside words."""
    points = np.concatenate([[0], np.cumsum((t.data & 0xC0) != 0x80)])[t.bounds]
    count = np.diff(points)
    return np.arange(1, points[-1] - points[0] + 1) - np.repeat(points[:-1] - points[0], count), points - points[0]


ENDS = {"token": token_ends, "character": character_ends}
CUTS = "struct<n: bigint, prefix_end: bigint, middle_end: bigint>"


def cutter(unit: str):
    """An Arrow function of (text, draw, draw): units of the text, and the offsets after the smaller and the larger cut."""
    ends_of = ENDS[unit]

    @F.arrow_udf(CUTS)
    def cuts(text: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
        draws = np.stack([one.to_numpy(zero_copy_only=False), two.to_numpy(zero_copy_only=False)], axis=1)
        out = np.zeros((len(text), 3), np.int64)
        for t in runs(text):
            offsets, first = ends_of(t)
            for i in range(len(first) - 1):
                held = boundaries(offsets[first[i] : first[i + 1]])
                cut = sorted(int(d) % (len(held) + 1) for d in draws[t.first + i])
                out[t.first + i] = len(held), held.end_of(cut[0]), held.end_of(cut[1])
        return pa.StructArray.from_arrays([pa.array(x) for x in out.T.copy()], ["n", "prefix_end", "middle_end"])

    return cuts


class Sentinels(NamedTuple):
    """What stands before each part. A sentinel's first character must not come again in it: then no text next to one can
    make up a second one, and the first find is the real one."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def check(self) -> Sentinels:
        if len(set(self)) < 3 or any(not s or s[0] in s[1:] for s in self) or any(a != b and a in b for a in self for b in self):
            raise ValueError(f"sentinels {tuple(self)} cannot be told apart in a text")
        return self


def fill_in_middle(
    docs: DataFrame, seed: int = 42, percent: int = 50, spm_percent: int = 80, sentinels: Sentinels = Sentinels(),
    unit: str = "token", key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``docs`` with ``n`` (units), ``form`` (plain, psm or spm), ``prefix_end``, ``middle_end`` (code points, null if plain) and
    ``output``, the training text.

    A row's draws are the hash of the seed and its key, so they depend on nothing else and equal keys are cut by equal draws;
    repeated rows give repeated results. ``percent`` of the rows are cut, ``spm_percent`` of these with the suffix first. A null
    text counts as empty; empty texts and texts that hold a sentinel stay plain. A null key is drawn for as an empty one.
    Texts of any length are cut whole: a task holds the boundaries of one text, or of a run of short ones, at a time. An empty
    table gives an empty one. Columns of the input that have one of the five names give way, others pass.
    """
    marks = sentinels.check()
    held = free_name(docs, "cut_")
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    draw = [F.conv(F.substring(hashed, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    whole = F.coalesce(F.col(text), F.lit(""))
    cut = docs.withColumn(held, cutter(unit)(whole, draw[0], draw[1]))
    plain = (whole == "") | (draw[2] % 100 >= percent)
    for mark in marks:
        plain = plain | F.contains(whole, F.lit(mark))
    form = F.when(plain, "plain").when(draw[3] % 100 < spm_percent, "spm").otherwise("psm")
    at = {c: F.col(f"{held}.{c}") for c in ("n", "prefix_end", "middle_end")}
    prefix = F.substr(whole, F.lit(1), at["prefix_end"].cast("int"))
    middle = F.substr(whole, (at["prefix_end"] + 1).cast("int"), (at["middle_end"] - at["prefix_end"]).cast("int"))
    suffix = F.substr(whole, (at["middle_end"] + 1).cast("int"))
    mark = {k: F.lit(v) for k, v in marks._asdict().items()}
    psm = F.concat(mark["prefix"], prefix, mark["suffix"], suffix, mark["middle"], middle)
    spm = F.concat(mark["suffix"], suffix, mark["prefix"], prefix, mark["middle"], middle)
    output = F.when(form == "plain", whole).when(form == "psm", psm).otherwise(spm)
    ends = {c: F.when(form != "plain", at[c]) for c in ("prefix_end", "middle_end")}
    return add_columns(cut, {"n": at["n"], "form": form, **ends, "output": output}).drop(held)


def restored(output: Column, form: Column, sentinels: Sentinels = Sentinels()) -> Column:
    """The text that ``fill_in_middle`` has made ``output`` from."""
    marks = sentinels.check()

    def between(start: Column, mark: str, end: Column | None = None) -> Column:
        begin = start + len(mark)
        return F.substr(output, begin, end - begin) if end is not None else F.substr(output, begin)

    at = {k: F.locate(v, output) for k, v in marks._asdict().items()}
    middle = between(at["middle"], marks.middle)
    psm = F.concat(between(at["prefix"], marks.prefix, at["suffix"]), middle, between(at["suffix"], marks.suffix, at["middle"]))
    spm = F.concat(between(at["prefix"], marks.prefix, at["middle"]), middle, between(at["suffix"], marks.suffix, at["prefix"]))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents
), u AS (
  SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
    ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2, ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4
  FROM d
), c AS (
  SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
         WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), p AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS pre, coalesce(array_to_string(u[a + 1:b], ''), '') AS mid,
    coalesce(array_to_string(u[b + 1:n], ''), '') AS suf
  FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""
