"""Benchmark decontamination: a BM25 index of the test items, searched by every training passage.

The items are the index, the documents' passages the queries: each window of words, half overlapping, asks for all items whose
BM25 score is at least ``share`` of the score the item gives itself. Scores are kept in that unit, so one threshold serves all
items. The search is a block-max WAND in numpy: the weakest terms, which together cannot reach half the threshold, are set
apart; only passages whose other terms can make up the rest are looked at (one running sum over all words of a run tells
that); for those, the greatest weights per block of items rule out blocks, and what is left is scored in full. A pair is a leak
if enough of the item's question and of its answer (its last sentence) stands in the passage, or enough of the whole item, as
shingles: of five words, of fewer in short parts, so that one changed word leaves half of them.

Windows are at least twice as long as the longest item and advance by half, so an item that stands in a document stands in one
window. Items are indexed in blocks of bounded size, each a pass over the documents; term statistics cover all items. All
windows of a document are in one task, and a document's rows come out of it: nothing is shuffled.

Defined cases: null and empty texts match nothing; items without words are left out; equal items all match; repeated documents
each get their rows; empty tables give no rows; a text that is shorter than a window is one window; extra columns are not read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.bytewords import Texts, folded, runs, shingle_hash, word_hash, word_spans

PUNCTUATION = tuple(i for i in range(128) if not chr(i).isalnum())
SENTENCE_END = r"(?s)^(.*[.!?\n])[\x20\x09-\x0D]*([^\x20\x09-\x0D].*?)$"


class Bounds(NamedTuple):
    share: float = 0.5
    question: float = 0.5
    answer: float = 0.5
    whole: float = 0.7
    least_window: int = 64
    k1: float = 1.2
    b: float = 0.75
    items_per_block: int = 64
    items_per_pass: int = 100_000


class Index(NamedTuple):
    """Postings by term: ``item`` and ``weight`` of term ``t`` are at ``cut[t]:cut[t + 1]``."""

    ids: list
    term: np.ndarray
    cut: np.ndarray
    item: np.ndarray
    weight: np.ndarray
    block_max: np.ndarray
    top: np.ndarray
    weak: np.ndarray
    weak_sum: float
    question: list[tuple[int, np.ndarray]]
    answer: list[tuple[int, np.ndarray]]
    whole: list[tuple[int, np.ndarray]]


def hashed_words(t: Texts):
    spans = word_spans(t, PUNCTUATION)
    return word_hash(folded(t.data, True, accents=True), spans.start, spans.end), spans


def shingles(words: np.ndarray) -> tuple[int, np.ndarray]:
    """Distinct shingles, and of how many words they are: five, or a third of fewer than 14 words."""
    n = min(5, max(1, (len(words) + 1) // 3), len(words))
    return n, np.unique(shingle_hash(words, n)) if n else np.empty(0, np.uint64)


def hashes_of(texts: list[str]) -> list[np.ndarray]:
    out = []
    for t in runs(pa.array(texts, pa.string())):
        words, spans = hashed_words(t)
        first = spans.first_of_rows(len(t.bounds) - 1)
        out += [words[a:b] for a, b in zip(first, first[1:], strict=False)]
    return out


def terms_of(batches):
    """(term, items with it) of batches of item texts; a row without a term has the counts of items and words."""
    for batch in batches:
        words = hashes_of([x or "" for x in batch.column(0).to_pylist()])
        words = [w for w in words if len(w)]
        seen = np.concatenate([np.unique(w) for w in words] or [np.empty(0, np.uint64)])
        term, n = np.unique(seen, return_counts=True)
        yield pa.RecordBatch.from_pydict({
            "term": pa.array(np.append(term.view(np.int64), 0)), "n": pa.array(np.append(n, 0).astype(np.int64)),
            "items": pa.array([0] * len(term) + [len(words)], pa.int64()), "words": pa.array([0] * len(term) + [sum(map(len, words))], pa.int64()),
            "longest": pa.array([0] * len(term) + [max(map(len, words), default=0)], pa.int64()),
        })


def build(rows: list, df: dict[int, int], items: int, mean: float, p: Bounds) -> Index:
    words = hashes_of([r["text"] or "" for r in rows])
    question, answer = hashes_of([r["question"] for r in rows]), hashes_of([r["answer"] for r in rows])
    keep = [i for i, w in enumerate(words) if len(w)]
    rows, words = [rows[i] for i in keep], [words[i] for i in keep]
    question, answer = [shingles(question[i]) for i in keep], [shingles(answer[i]) for i in keep]
    whole = [shingles(w) for w in words]
    term, item, weight = [], [], []
    for i, w in enumerate(words):
        t, tf = np.unique(w, return_counts=True)
        n = np.array([df[x] for x in t.view(np.int64).tolist()])
        idf = np.log(1 + (items - n + 0.5) / (n + 0.5))
        s = idf * tf * (p.k1 + 1) / (tf + p.k1 * (1 - p.b + p.b * len(w) / mean))
        term.append(t)
        item.append(np.full(len(t), i))
        weight.append(s / s.sum())
    term, item, weight = (np.concatenate(x or [np.empty(0)]) for x in (term, item, weight))
    names, at = np.unique(term.astype(np.uint64), return_inverse=True)
    order = np.argsort(at, kind="stable")
    at, item, weight = at[order], item[order].astype(np.int64), weight[order].astype(np.float64)
    cut = np.searchsorted(at, np.arange(len(names) + 1))
    blocks = max(1, -(-len(rows) // p.items_per_block))
    block_max = np.zeros((len(names), blocks), np.float32)
    np.maximum.at(block_max, (at, item // p.items_per_block), weight.astype(np.float32))
    top = block_max.max(axis=1) if len(names) else np.empty(0, np.float32)
    rank = np.argsort(top)
    weak = np.zeros(len(names), bool)
    weak[rank[np.cumsum(top[rank]) <= p.share / 2]] = True
    return Index([r["item_id"] for r in rows], names, cut, item, weight, block_max, top, weak, float(top[weak].sum()), question, answer, whole)


def search(words: np.ndarray, first: np.ndarray, index: Index, window: int, p: Bounds):
    """(row, item, score, question share, answer share) of the leaks among the rows' passages."""
    at = np.minimum(np.searchsorted(index.term, words), len(index.term) - 1)
    known = index.term[at] == words
    strong = np.where(known & ~index.weak[at], index.top[at], 0).astype(np.float64)
    sums = np.concatenate([[0.0], np.cumsum(strong)])
    step = window // 2
    count = np.diff(first)
    n = np.maximum(1, -(-np.maximum(count - step, 0) // step)) * (count > 0)
    row = np.repeat(np.arange(len(count)), n)
    start = first[:-1][row] + (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * step
    end = np.minimum(start + window, first[1:][row])
    slack = p.share * (1 - 1e-6)
    best: dict[tuple[int, int], tuple] = {}
    for k in np.flatnonzero(sums[end] - sums[start] + index.weak_sum >= slack):
        a, b = start[k], end[k]
        terms = np.unique(at[a:b][known[a:b]])
        bound = index.block_max[terms].sum(axis=0)
        live = bound >= slack
        if not live.any():
            continue
        size = index.cut[terms + 1] - index.cut[terms]
        spot = np.repeat(index.cut[terms] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        item = index.item[spot]
        inside = live[item // p.items_per_block]
        score = np.bincount(item[inside], weights=index.weight[spot][inside], minlength=len(index.ids))
        hits = np.flatnonzero(score >= slack)
        if not len(hits):
            continue
        mine: dict[int, np.ndarray] = {}
        for i in hits:
            shares = [overlap(part, words[a:b], mine) for part in (index.question[i], index.answer[i])]
            key = (int(row[k]), int(i))
            held = (shares[0] >= p.question and shares[1] >= p.answer) or overlap(index.whole[i], words[a:b], mine) >= p.whole
            if held and (key not in best or best[key][0] < score[i]):
                best[key] = (float(score[i]), *shares)
    return best


def overlap(part: tuple[int, np.ndarray], words: np.ndarray, mine: dict[int, np.ndarray]) -> float:
    """The share of ``part``'s shingles in the passage; an empty part is there."""
    n, wanted = part
    if not len(wanted):
        return 1.0
    if n not in mine:
        mine[n] = np.unique(shingle_hash(words, n))
    return float(np.isin(wanted, mine[n], assume_unique=True).mean())


LEAKS = "doc_id long, item_id long, score double, question_share double, answer_share double"


def searcher(index: Index, window: int, p: Bounds):
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for t in runs(batch.column(1)):
                words, spans = hashed_words(t)
                found = search(words, spans.first_of_rows(len(t.bounds) - 1), index, window, p)
                if found:
                    keys = sorted(found)
                    cols = list(zip(*(found[k] for k in keys), strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array([t.first + r for r, _ in keys])), pa.array([index.ids[i] for _, i in keys], pa.int64()), *(pa.array(c, pa.float64()) for c in cols)],
                        ["doc_id", "item_id", "score", "question_share", "answer_share"],
                    )

    return run


def leaks(
    docs: DataFrame, items: DataFrame, bounds: Bounds = Bounds(), doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Pairs of a document and an item that it holds: one row per row of ``docs`` and item, with the best passage's score."""
    spark = docs.sparkSession
    slim = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    body = F.coalesce(F.col(f"`{item_text}`"), F.lit(""))
    split = [F.regexp_extract(body, SENTENCE_END, k) for k in (1, 2)]
    parted = items.select(
        F.col(f"`{item_id}`").cast("long").alias("item_id"), body.alias("text"),
        F.when(split[1] != "", split[0]).otherwise(body).alias("question"), F.when(split[1] != "", split[1]).otherwise("").alias("answer"),
    )
    schema = "term long, n long, items long, words long, longest long"
    stats = parted.select("text").mapInArrow(terms_of, schema)
    whole = stats.agg(F.sum("items").alias("items"), F.sum("words").alias("words"), F.max("longest").alias("longest")).first()
    n = whole["items"] or 0
    if n == 0:
        return spark.createDataFrame([], LEAKS)
    window = 2 * max(bounds.least_window, whole["longest"])
    passes, out = -(-n // bounds.items_per_pass), None
    terms = stats.where("n > 0").groupBy("term").agg(F.sum("n").alias("n"))
    for k in range(passes):
        part = parted.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k)
        own = part.select("text").mapInArrow(terms_of, schema).where("n > 0").select("term").distinct()
        df = {r["term"]: r["n"] for r in terms.join(own, "term").toLocalIterator()}
        index = build(part.orderBy("item_id", "text").collect(), df, n, whole["words"] / n, bounds)
        if index.ids:
            found = slim.mapInArrow(searcher(index, window, bounds), LEAKS)
            out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], LEAKS)
