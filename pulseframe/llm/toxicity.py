"""A convolutional text classifier for toxicity, trained in numpy.

A word's vector is the sum of those of its hash and of the hash of its first bytes, so that inflected and compound words share.
Filters of several widths run over the words, each gives its largest value in the text, and a logistic layer scores those.
Training reads a bounded sample of labelled rows; scoring runs over all whole texts, in tasks. Thresholds are calibrated by
language on all labelled rows that are not held out, so that their mix is the true one: the rows of the sample are scored by
models fitted on its other folds, the rest by the model itself, in tasks that count them by score. A language never enters a
score; one with under ``least`` toxic or other rows in all takes the cut of all languages together.

Defined cases: null and empty texts have all filters at 0 and get the score of that; rows whose label is null or whose id is in
the held-out fifth are not learnt from; without both labels the score is the (smoothed) share of toxic rows; ties in the
sample's order are broken by id; repeated rows score alike; an empty table gives no rows.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.bytewords import folded, runs, word_hash, word_spans
from pulseframe.session import pin

PUNCTUATION = tuple(i for i in range(128) if not chr(i).isalnum())


CUTS = np.linspace(0.05, 0.95, 91)


class Settings(NamedTuple):
    """``positives`` and ``negatives`` bound the rows that are learnt from."""

    positives: int = 3000
    negatives: int = 5000
    bits: int = 17
    dim: int = 8
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8
    prefix_bytes: int = 6
    epochs: int = 12
    rate: float = 0.05
    batch: int = 32
    folds: int = 3
    least: int = 5
    seed: int = 11


class Words(NamedTuple):
    """Word and prefix buckets of a run of texts, and where each text's words start."""

    word: np.ndarray
    prefix: np.ndarray
    first: np.ndarray

    def take(self, rows: np.ndarray) -> Words:
        sizes = (self.first[1:] - self.first[:-1])[rows]
        first = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(first[-1]) + np.repeat(self.first[:-1][rows] - first[:-1], sizes)
        return Words(self.word[at], self.prefix[at], first)


def words_of(column: pa.Array, bits: int, prefix_bytes: int):
    for t in runs(column):
        spans = word_spans(t, PUNCTUATION)
        data = folded(t.data, True, accents=True)
        mask = np.uint64((1 << bits) - 1)
        word = word_hash(data, spans.start, spans.end) & mask
        prefix = word_hash(data, spans.start, np.minimum(spans.start + prefix_bytes, spans.end)) >> np.uint64(20) & mask
        yield t, Words(word.astype(np.int64), prefix.astype(np.int64), spans.first_of_rows(len(t.bounds) - 1))


class Model(NamedTuple):
    embed: np.ndarray  # (2, buckets, dim): of words and of prefixes
    kernels: list[np.ndarray]  # per width: (width, dim, filters)
    weights: np.ndarray
    bias: float
    prefix_bytes: int

    def pooled(self, w: Words) -> np.ndarray:
        """Largest value of each filter per text, 0 at least."""
        rows, n = len(w.first) - 1, len(w.word)
        x = self.embed[0][w.word] + self.embed[1][w.prefix]
        row = np.repeat(np.arange(rows), np.diff(w.first))
        out = []
        for k in self.kernels:
            width, _, filters = k.shape
            top = np.zeros((rows, filters), np.float32)
            m = n - width + 1
            if m > 0:
                z = x[:m] @ k[0]
                for j in range(1, width):
                    z += x[j : j + m] @ k[j]
                if width > 1:
                    z[row[:m] != row[width - 1 :]] = 0
                some = np.flatnonzero(w.first[:-1] < np.minimum(w.first[1:], m))
                if len(some):
                    top[some] = np.maximum(np.maximum.reduceat(z, w.first[:-1][some], axis=0), 0)
            out.append(top)
        return np.concatenate(out, axis=1)

    def score(self, w: Words) -> np.ndarray:
        z = self.pooled(w).astype(np.float64) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def positions(model: Model, w: Words, x: np.ndarray) -> list[np.ndarray]:
    """Per width, the word at which each text's filters peak, -1 where they stay at 0 or below."""
    out = []
    for k in model.kernels:
        width, _, filters = k.shape
        best = np.full((len(w.first) - 1, filters), -1)
        for r, (a, b) in enumerate(zip(w.first[:-1], w.first[1:] - width + 1, strict=True)):
            if b > a:
                z = sum(x[a + j : b + j] @ k[j] for j in range(width))
                at = z.argmax(axis=0)
                best[r] = np.where(z[at, np.arange(filters)] > 0, a + at, -1)
        out.append(best)
    return out


def presence(w: Words, labels: np.ndarray, buckets: int, of: np.ndarray) -> np.ndarray:
    """How clearly each bucket's presence speaks for the label: smoothed log odds over their spread, 0 for rare buckets."""
    row = np.repeat(np.arange(len(labels)), np.diff(w.first))
    seen = np.unique(row * buckets + of)
    row, bucket = seen // buckets, seen % buckets
    yes = np.bincount(bucket[labels[row] > 0], minlength=buckets) + 0.5
    no = np.bincount(bucket[labels[row] == 0], minlength=buckets) + 0.5
    odds = np.log(yes / (labels.sum() + 1)) - np.log(no / (len(labels) - labels.sum() + 1))
    z = odds / np.sqrt(1 / yes + 1 / no)
    return np.where(yes + no >= 4, z, 0)


def fit(w: Words, labels: np.ndarray, weights: np.ndarray, s: Settings) -> Model:
    """Stochastic gradient descent with a step per parameter that shrinks with its past gradients."""
    rng, buckets = np.random.default_rng(s.seed), 1 << s.bits
    embed = rng.normal(0, 0.05, (2, buckets, s.dim)).astype(np.float32)
    kernels = [rng.normal(0, 0.2, (k, s.dim, s.filters)).astype(np.float32) for k in s.widths]
    share = (float((weights * labels).sum()) + 0.5) / (float(weights.sum()) + 1)
    dense, bias = np.zeros(len(s.widths) * s.filters), float(np.log(share / (1 - share)))
    if not 0 < labels.sum() < len(labels):
        return Model(embed, kernels, dense, bias, s.prefix_bytes)
    for k, of in enumerate((w.word, w.prefix)):
        z = presence(w, labels, buckets, of)
        embed[k, :, 0] += (z / 4).astype(np.float32)
        embed[k, :, 1] -= (z / 4).astype(np.float32)
    kernels[0][0, 0, 0] = kernels[0][0, 1, 1] = 1.0
    dense[:] = rng.normal(0, 0.1, len(dense))
    dense[0] = 0.5
    past = [np.full_like(embed[..., :1], 1e-3), [np.full_like(k, 1e-3) for k in kernels], np.full(len(dense), 1e-3), 1e-3]
    model = Model(embed, kernels, dense, bias, s.prefix_bytes)
    for _ in range(s.epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), s.batch):
            rows = order[at : at + s.batch]
            b = w.take(rows)
            x = embed[0][b.word] + embed[1][b.prefix]
            where = positions(model, b, x)
            values, taps = [], []
            for k, best in zip(kernels, where, strict=True):
                tap = np.stack([x[np.maximum(best, 0) + j] for j in range(len(k))], axis=2) if len(x) else np.zeros((*best.shape, len(k), s.dim), np.float32)
                taps.append(tap)
                values.append(np.where(best >= 0, np.einsum("rfjd,jdf->rf", tap, k), 0))
            top = np.concatenate(values, axis=1)
            p = 1 / (1 + np.exp(-np.clip(top @ model.weights + model.bias, -40, 40)))
            err = (p - labels[rows]) * weights[rows]
            grad = (err @ top) / len(rows) + 1e-4 * model.weights
            past[2] += grad**2
            slope = err[:, None] * model.weights[None, :] / len(rows)
            new_weights = model.weights - s.rate * grad / np.sqrt(past[2])
            g = float(err.mean())
            past[3] += g * g
            model = model._replace(weights=new_weights, bias=model.bias - s.rate * g / np.sqrt(past[3]))
            for i, (k, best, tap) in enumerate(zip(kernels, where, taps, strict=True)):
                d = np.where(best >= 0, slope[:, i * s.filters : (i + 1) * s.filters], 0).astype(np.float32)
                gk = np.einsum("rf,rfjd->jdf", d, tap)
                gx = np.einsum("rf,jdf->rfjd", d, k)
                past[1][i] += gk**2
                k -= s.rate * gk / np.sqrt(past[1][i])
                r, f = np.nonzero(best >= 0)
                for j in range(len(k)):
                    step = gx[r, f, j]
                    for e, of in enumerate((b.word, b.prefix)):
                        bucket = of[best[r, f] + j]
                        np.add.at(past[0][e], bucket, (step**2).mean(axis=1, keepdims=True))
                        np.add.at(embed[e], bucket, -0.5 * s.rate * step / np.sqrt(past[0][e][bucket]))
    return model


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def sample(docs: DataFrame, labels: DataFrame, s: Settings) -> tuple[pa.Table, DataFrame, float]:
    """Labelled rows to learn from, least hashes of the id first; the other labels; and how many more negatives each of the
    rows stands for."""
    known = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull()).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("doc_id", F.lit(s.seed)), F.col("doc_id")]
    picked = known.where("toxic = 1").orderBy(*order).limit(s.positives).unionByName(known.where("toxic = 0").orderBy(*order).limit(s.negatives))
    picked = pin(picked)
    rows = docs.join(F.broadcast(picked), "doc_id").select("doc_id", "toxic", "lang", "text").toArrow()
    share = [counts.get(k, 0) / max(1, min(counts.get(k, 0), m)) for k, m in ((0, s.negatives), (1, s.positives))]
    others = known.where("doc_id IS NOT NULL AND toxic IN (0, 1)").join(F.broadcast(picked.select("doc_id")), "doc_id", "left_anti")
    return rows, others, share[0] / max(share[1], 1e-9) if share[1] else 1.0


class Classifier(NamedTuple):
    """``thresholds`` by language, ``default`` for the others; ``counts`` are the labelled rows they come from."""

    model: Model
    thresholds: dict[str | None, float]
    default: float
    counts: dict[str | None, np.ndarray]
    bits: int


def cut_bin(scores: np.ndarray) -> np.ndarray:
    """How many of the cuts a score reaches."""
    return np.searchsorted(CUTS, scores, side="right")


def best_cut(counts: np.ndarray, default: float) -> float:
    """The cut with the best F1 for ``counts`` of rows by label and bin."""
    toxic, flagged = counts[1].sum(), np.cumsum(counts[:, ::-1], axis=1)[:, ::-1][:, 1:]
    if not toxic:
        return default
    f1 = 2 * flagged[1] / np.maximum(1, flagged.sum(axis=0) + toxic)
    best = np.flatnonzero(np.isclose(f1, f1.max()))
    return float(CUTS[best[len(best) // 2]])


def thresholds(counts: dict[str | None, np.ndarray], least: int) -> tuple[dict, float]:
    """Per language the cut with the best F1, and that of all rows together."""
    whole = sum(counts.values(), np.zeros((2, len(CUTS) + 1), np.int64))
    default = best_cut(whole, 0.5) if whole.sum(axis=1).min() >= least else 0.5
    return {lang: best_cut(c, default) for lang, c in counts.items() if c.sum(axis=1).min() >= least}, default


def fold_of(ids: list, labels: np.ndarray, langs: list, s: Settings) -> np.ndarray:
    """A fold per row, dealt in turn to the documents of a label and language; rows of one id share it."""
    of, turn = {}, {}
    for k in np.random.default_rng(s.seed).permutation(len(ids)):
        if ids[k] not in of:
            group = (labels[k], langs[k])
            turn[group] = turn.get(group, -1) + 1
            of[ids[k]] = turn[group] % s.folds
    return np.array([of[i] for i in ids], np.int64)


def counted(docs: DataFrame, others: DataFrame, model: Model, bits: int):
    """(lang, toxic, bin, rows) of the labelled rows that are not in the sample."""

    def run(batches):
        for batch in batches:
            for t, w in words_of(batch.column(2), bits, model.prefix_bytes):
                bins = cut_bin(model.score(w))
                ids, langs = (batch.column(k).slice(t.first, len(bins)) for k in (0, 1))
                yield pa.RecordBatch.from_arrays([ids, langs, pa.array(bins, pa.int32())], ["doc_id", "lang", "bin"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    binned = docs.select("doc_id", "lang", "text").mapInArrow(run, f"doc_id {kind}, lang string, bin int")
    return binned.join(others, "doc_id").groupBy("lang", "toxic", "bin").agg(F.count("*").alias("rows")).collect()


def train(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Classifier:
    rows, others, negative_weight = sample(docs, labels, s)
    rows = rows.sort_by("doc_id").combine_chunks()
    y = rows.column("toxic").to_numpy().astype(np.float64)
    column = rows.column("text").combine_chunks() if rows.num_rows else pa.array([], pa.string())
    parts = [w for _, w in words_of(column, s.bits, s.prefix_bytes)]
    offsets = np.cumsum([0, *(len(p.word) for p in parts)])
    w = Words(
        np.concatenate([p.word for p in parts] or [np.empty(0, np.int64)]), np.concatenate([p.prefix for p in parts] or [np.empty(0, np.int64)]),
        np.concatenate([np.zeros(1, np.int64), *(p.first[1:] + k for p, k in zip(parts, offsets, strict=False))]),
    )
    weight = np.where(y > 0, 1.0, negative_weight)
    weight = weight / max(1e-9, weight.mean()) if len(y) else weight
    model = fit(w, y, weight, s)
    langs = rows.column("lang").to_pylist()
    fold = fold_of(rows.column("doc_id").to_pylist(), y, langs, s)
    counts: dict[str | None, np.ndarray] = {}
    for k in np.unique(fold):
        mine, rest = np.flatnonzero(fold == k), np.flatnonzero(fold != k)
        bins = cut_bin(fit(w.take(rest), y[rest], weight[rest], s).score(w.take(mine)))
        for i, b in zip(mine, bins, strict=True):
            counts.setdefault(langs[i], np.zeros((2, len(CUTS) + 1), np.int64))[int(y[i]), b] += 1
    for r in counted(docs, others, model, s.bits):
        counts.setdefault(r["lang"], np.zeros((2, len(CUTS) + 1), np.int64))[r["toxic"], r["bin"]] += r["rows"]
    return Classifier(model, *thresholds(counts, s.least), counts, s.bits)


def scorer(c: Classifier):
    def run(batches):
        for batch in batches:
            for t, w in words_of(batch.column(2), c.bits, c.model.prefix_bytes):
                score = c.model.score(w)
                ids, langs = (batch.column(k).slice(t.first, len(score)) for k in (0, 1))
                cut = np.array([c.thresholds.get(x, c.default) for x in langs.to_pylist()])
                yield pa.RecordBatch.from_arrays([ids, pa.array(score), pa.array(cut), pa.array(score >= cut)], ["doc_id", "score", "threshold", "flagged"])

    return run


def score(docs: DataFrame, c: Classifier) -> DataFrame:
    """(doc_id, score, threshold of the language, flagged) for each row of ``docs`` (doc_id, lang, text)."""
    return docs.select("doc_id", "lang", "text").mapInArrow(scorer(c), "doc_id long, score double, threshold double, flagged boolean")
