"""Exact Jaccard join of documents by their word shingles: T-occurrence search with skipped long lists.

A pair links when the intersection of the two sets is at least ``percent`` of their union. A partner of a set of n shingles then
shares at least T = ceil(percent * n / 100) of them. Of a set's n inverted lists the T - 1 longest can be left out: a partner is
in at least one of the others. So the short lists are merged for candidates, and a candidate's long lists are probed in
the candidate's own sorted set (its lists hold it exactly when its set holds the shingle).

1. Documents with one set are one class. A pass over the texts sends each shingle, packed by range, to be counted; what comes
   back per document is how many of its shingles occur in another. Sets where that is below T have no partner.
2. The sets that are left come back with the length of each shingle's list among them; each gives its short lists.
3. Links are wanted up to components. Each member of a list is first held against the list's head, the one with the fewest
   shingles of its own, which is linear in the list. Then members of different components in a list are held against each
   other; pairs inside a component need no check. Lists are never collected.
4. Of a long list (over ``LONG`` sets) only some members are held against the others. Call a set's shingles with long
   lists its common ones. Say A and B link and share no other shingles, and B' is the set with B's common shingles and the
   fewest besides. Then A shares with B' as much at least, and B' is no larger than B, so A and B' link, for the same reason
   B and A', and A' and B'. So of all sets with the same common shingles the one with the fewest besides stands for the others.
   A pair that shares other shingles meets in a list that is not long, as the rarest common shingle is in both short parts.
5. A pair is held against each other only where its first shingle in common could be: with ``pos`` shingles before it in one
   set and ``pos`` in the other, no more than the rest of either can be in common, and that must reach the bound.

``jaccard_components`` is this; ``jaccard_pairs`` gives all links between classes instead.

Defined cases: null text and texts without words have an empty set and no links; repeated rows and ids are fine, null ids too
(the class's least non-null id names it); an empty table gives no rows; extra columns are not read. Sets are compared by
64-bit hashes of shingles, and told apart by a 128-bit sum of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.llm.bytewords import begin, mix, runs, shingle_sets, trim
from pulseframe.llm.components import components
from pulseframe.llm.exprs import free_shuffles, partitions, small_batches
from pulseframe.llm.keycount import bucket_of
from pulseframe.session import parts_of, pin

#: A chunk ends with so many shingles, or documents.
CHUNK_KEYS = 1 << 18
CHUNK_DOCS = 1 << 16
#: Documents whose sets, lists and pairs go to a partition, about: however many a shuffle has, no more partitions are written.
PART_DOCS = 1 << 12
LONG = 64
LOW48 = np.uint64((1 << 48) - 1)
PARTS = "bucket int, chunk long, kind int, counts binary, keys binary, ids array<long>, marks array<long>, sets array<binary>"
NAMES = ["bucket", "chunk", "kind", "counts", "keys", "ids", "marks", "sets"]
TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary())]


def set_ids(hashes: np.ndarray, bounds: np.ndarray) -> list[bytes | None]:
    """A 128-bit name of each set, the same for equal sets; none for an empty one."""
    sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes * np.uint64(k)), dtype=np.uint64)]) for k in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
    size = np.diff(bounds).astype(np.uint64)
    both = np.stack([mix((s[bounds[1:]] - s[bounds[:-1]]) + size) for s in sums], axis=1)
    return [x.tobytes() if n else None for x, n in zip(both, size, strict=True)]


def table_of(rows: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), TYPES, strict=True)], NAMES)


def sparse(counts: np.ndarray) -> bytes:
    """Numbers of the documents of a chunk, without the zeros: a range of shingles has some of few documents."""
    at = np.flatnonzero(counts)
    return at.astype(np.uint32).tobytes() + counts[at].astype(np.uint32).tobytes()


def dense(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(documents, their numbers) of ``sparse``."""
    both = np.frombuffer(blob, np.uint32).reshape(2, -1)
    return both[0], both[1]


def send(chunk: int, seq: int, held: list, buckets: int, full: bool) -> pa.RecordBatch:
    """A chunk's shingles by range, in order of document; one more row names its documents."""
    doc = np.concatenate([np.repeat(np.arange(len(b) - 1), np.diff(b)) + k for k, (_, b, *_) in zip(np.cumsum([0, *(len(h[1]) - 1 for h in held)]), held, strict=False)])
    hashes = np.concatenate([h[0] for h in held])
    docs = sum(len(h[1]) - 1 for h in held)
    at = bucket_of(hashes, buckets)
    order = np.argsort(at, kind="stable")
    at, doc, hashes = at[order], doc[order], hashes[order]
    cuts = np.searchsorted(at, np.arange(buckets + 1))
    rows = []
    for b in np.flatnonzero(np.diff(cuts)):
        x, y = cuts[b], cuts[b + 1]
        key = hashes[x:y]
        if not full:
            key = key & LOW48
            packed = (key & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes() + (key >> np.uint64(32)).astype(np.uint16).tobytes()
        else:
            packed = key.tobytes()
        counts = sparse(np.bincount(doc[x:y], minlength=docs))
        rows.append([int(b), chunk, 0, counts, packed, None, None, None])
    names = [[x for h in held for x in h[k]] for k in (2, 3, 4)]
    sizes = np.concatenate([np.diff(h[1]) for h in held]).astype(np.uint32).tobytes()
    rows.append([int((chunk + seq) % buckets), chunk, 1, sizes, None, *names])
    return table_of(rows)


def sender(buckets: int, full: bool, shingles):
    """Rows of (id, mark, text) or of sets to packed shingles; ``shingles`` reads a batch."""

    def run(batches):
        from pyspark import TaskContext

        begin("jaccard join")
        part, seq, held, n, docs = TaskContext.get().partitionId(), 0, [], 0, 0
        for batch in batches:
            for item in shingles(batch):
                held.append(item)
                n, docs = n + len(item[0]), docs + len(item[1]) - 1
                if n >= CHUNK_KEYS or docs >= CHUNK_DOCS:
                    yield send(part << 32 | seq, seq, held, buckets, full)
                    seq, held, n, docs = seq + 1, [], 0, 0
        if held:
            yield send(part << 32 | seq, seq, held, buckets, full)

    return run


def of_texts(size: int):
    def read(batch):
        ids, marks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for t in runs(batch.column(2)):
            s = shingle_sets(t, size)
            n = len(t.bounds) - 1
            yield s.hashes, s.bounds, ids[t.first : t.first + n], marks[t.first : t.first + n], set_ids(s.hashes, s.bounds)

    return read


def of_sets(batch):
    sets = batch.column(0).to_pylist()
    hashes = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(1)]
    if sets:
        yield np.concatenate(hashes), np.cumsum([0, *map(len, hashes)]), [None] * len(sets), [None] * len(sets), sets


def count_lists(full: bool):
    """A range of shingles: per chunk, how many of each document's occur twice or more (or all of them, with their counts)."""

    def run(rows: pa.Table) -> pa.Table:
        begin("jaccard join")
        rows = rows.sort_by([("chunk", "ascending"), ("kind", "ascending")]).to_pylist()
        parts = [r for r in rows if r["kind"] == 0]
        out = [[r["bucket"], r["chunk"], 1, r["counts"], None, r["ids"], r["marks"], r["sets"]] for r in rows if r["kind"] == 1]
        if parts:
            keys = []
            for r in parts:
                n = len(r["keys"]) // (8 if full else 6)
                if full:
                    keys.append(np.frombuffer(r["keys"], np.uint64))
                else:
                    high = np.frombuffer(r["keys"], np.uint16, n, 4 * n).astype(np.uint64)
                    keys.append(high << np.uint64(32) | np.frombuffer(r["keys"], np.uint32, n))
            key = np.concatenate(keys)
            order = np.argsort(key, kind="stable")
            ranked = key[order]
            new = np.ones(len(key), bool)
            new[1:] = ranked[1:] != ranked[:-1]
            group = np.cumsum(new) - 1
            length = np.empty(len(key), np.uint32)
            length[order] = np.bincount(group)[group]
            at = 0
            for r, k in zip(parts, keys, strict=True):
                mine = length[at : at + len(k)]
                at += len(k)
                if full:
                    out.append([r["bucket"], r["chunk"], 0, r["counts"], k.tobytes() + mine.tobytes(), None, None, None])
                else:
                    docs, counts = dense(r["counts"])
                    shared = np.bincount(np.repeat(np.arange(len(docs)), counts)[mine > 1], minlength=len(docs))
                    some = shared > 0
                    if some.any():
                        blob = docs[some].tobytes() + shared[some].astype(np.uint32).tobytes()
                        out.append([r["bucket"], r["chunk"], 0, blob, None, None, None, None])
        trim()
        batch = table_of(out) if out else pa.RecordBatch.from_arrays([pa.array([], t) for t in TYPES], NAMES)
        return pa.Table.from_batches([batch])

    return run


def per_document(rows: pa.Table) -> pa.Table:
    """A chunk's documents with the size of their sets and how many of their shingles others have too."""
    rows = rows.to_pylist()
    head = next(r for r in rows if r["kind"] == 1)
    shared = np.zeros(len(head["sets"]), np.int64)
    for r in rows:
        if r["kind"] == 0:
            docs, counts = dense(r["counts"])
            shared[docs] += counts
    return pa.table({
        "doc_id": pa.array(head["ids"], pa.int64()), "mark": pa.array(head["marks"], pa.int64()),
        "set_id": pa.array(head["sets"], pa.binary()), "n": np.frombuffer(head["counts"], np.uint32).astype(np.int64), "shared": shared,
    })


def short_lists(percent: int):
    """A chunk's sets with the shingles of their short lists."""

    def run(rows: pa.Table) -> pa.Table:
        begin("jaccard join")
        rows = rows.sort_by("bucket").to_pylist()
        sets = next(r for r in rows if r["kind"] == 1)["sets"]
        doc, key, length = [], [], []
        for r in rows:
            if r["kind"] == 0:
                docs, counts = dense(r["counts"])
                n = int(counts.sum())
                doc.append(np.repeat(docs.astype(np.int64), counts))
                key.append(np.frombuffer(r["keys"], np.uint64, n))
                length.append(np.frombuffer(r["keys"], np.uint32, n, 8 * n))
        out = {"set_id": [], "n": [], "own": [], "common": [], "shingle": [], "long": [], "pos": []}
        if doc:
            doc, key, length = map(np.concatenate, (doc, key, length))
            order = np.lexsort((key, length, doc))
            doc, key, length = doc[order], key[order], length[order]
            cuts = np.searchsorted(doc, np.arange(len(sets) + 1))
            for s, a, b in zip(sets, cuts, cuts[1:], strict=False):
                n = int(b - a)
                least = -(-percent * n // 100)
                short = slice(a, b - (least - 1))
                shared = length[short] > 1
                mine = key[short][shared]
                common = np.sort(key[a:b][length[a:b] > LONG])
                out["set_id"] += [s] * len(mine)
                out["n"] += [n] * len(mine)
                out["own"] += [n - len(common)] * len(mine)
                out["common"] += [set_ids(common, np.array([0, len(common)]))[0] or b""] * len(mine)
                out["shingle"].append(mine.view(np.int64))
                out["long"].append(length[short][shared] > LONG)
                out["pos"].append(np.flatnonzero(shared))
        trim()
        columns = [np.concatenate(out[k]) if out[k] else np.empty(0, t) for k, t in (("shingle", np.int64), ("long", bool), ("pos", np.int64))]
        return pa.table({
            "set_id": pa.array(out["set_id"], pa.binary()), "n": pa.array(out["n"], pa.int64()), "own": pa.array(out["own"], pa.int64()),
            "common": pa.array(out["common"], pa.binary()), "shingle": columns[0], "long": columns[1], "pos": columns[2],
        })

    return run


def own_sets(size: int):
    """The set of each text that is the one asked for."""

    def run(batches):
        begin("jaccard join")
        for batch in batches:
            asked = batch.column(0).to_pylist()
            for t in runs(batch.column(1)):
                s = shingle_sets(t, size)
                found = set_ids(s.hashes, s.bounds)
                keep = [i for i, x in enumerate(found) if x == asked[t.first + i]]
                blobs = [s.hashes[s.bounds[i] : s.bounds[i + 1]].tobytes() for i in keep]
                yield pa.RecordBatch.from_arrays([pa.array([found[i] for i in keep], pa.binary()), pa.array(blobs, pa.binary())], ["set_id", "hashes"])

    return run


def probe(percent: int):
    """Pairs of sets that link: the long lists are probed in the other's sorted set."""

    def run(batches):
        begin("jaccard join")
        for batch in batches:
            trim()
            keep = []
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(a) > len(b):
                    a, b = b, a
                at = np.searchsorted(b, a)
                common = int((b[np.minimum(at, len(b) - 1)] == a).sum())
                if 100 * common >= percent * (len(a) + len(b) - common):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), batch.column(1).take(pa.array(keep, pa.int64()))], ["a", "b"])

    return run


class SetJoin:
    """The steps over one table of documents."""

    def __init__(self, docs: DataFrame, percent: int, size: int, doc_id: str, text: str):
        self.spark, self.percent, self.size = docs.sparkSession, percent, size
        self.slim = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(f"`{text}`").alias("mark"), F.col(f"`{text}`").alias("text"))
        buckets = 2 * partitions(self.spark)
        parts = self.slim.mapInArrow(sender(buckets, False, of_texts(size)), PARTS)
        counted = parts.groupBy("bucket").applyInArrow(count_lists(False), PARTS)
        schema = "doc_id long, mark long, set_id binary, n long, shared long"
        self.parts = parts_of(self.spark, self.slim.count(), PART_DOCS)
        self.docs = self.pin(counted.groupBy("chunk").applyInArrow(per_document, schema))
        free_shuffles(self.spark)

    def pin(self, df: DataFrame) -> DataFrame:
        return pin(df, self.parts)

    def candidates(self) -> tuple[DataFrame, DataFrame]:
        """Sets that may have a partner, with their hashes; and their short lists: (shingle, long, set_id, n), with the number
        of shingles whose lists are not long and the name of the set of the others."""
        enough = F.expr(f"100 * shared >= {self.percent} * n")
        first = F.struct("doc_id", "mark")
        classes = self.docs.where(F.col("set_id").isNotNull() & enough).groupBy("set_id").agg(F.min(first).alias("at"))
        asked = classes.select("set_id", F.col("at.doc_id").alias("id_"), F.col("at.mark").alias("mark_"))
        texts = self.slim.join(asked, F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("mark") == F.col("mark_")))
        sets = self.pin(texts.select("set_id", "text").mapInArrow(own_sets(self.size), "set_id binary, hashes binary").dropDuplicates(["set_id"]))
        free_shuffles(self.spark)
        parts = sets.mapInArrow(sender(2 * partitions(self.spark), True, of_sets), PARTS)
        counted = parts.groupBy("bucket").applyInArrow(count_lists(True), PARTS)
        lists = self.pin(counted.groupBy("chunk").applyInArrow(short_lists(self.percent), "set_id binary, n long, own long, common binary, shingle long, long boolean, pos long"))
        free_shuffles(self.spark)
        return sets, lists

    def links(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Those of ``pairs`` (a, b) that link."""
        a = sets.select(F.col("set_id").alias("a"), F.col("hashes").alias("x"))
        b = sets.select(F.col("set_id").alias("b"), F.col("hashes").alias("y"))
        return pairs.join(a, "a").join(b, "b").select("a", "b", "x", "y").mapInArrow(probe(self.percent), "a binary, b binary")

    def near(self, n: str, m: str):
        return F.expr(f"100 * least({n}, {m}) >= {self.percent} * greatest({n}, {m})")

    def head_pairs(self, lists: DataFrame, *by: Column) -> DataFrame:
        """Each set with the head it shares most short lists with; the head of a list is the least of its sets by ``by``."""
        entry = F.struct(*by, "n", "set_id")
        heads = lists.groupBy("shingle").agg(F.min(entry).alias("head"), F.count("*").alias("size")).where("size > 1")
        met = lists.join(heads, "shingle").where(F.col("set_id") != F.col("head.set_id")).where(self.near("n", "head.n"))
        shared = met.groupBy("set_id", F.col("head.set_id").alias("b")).agg(F.count("*").alias("hits"))
        best = shared.groupBy(F.col("set_id").alias("a")).agg(F.max(F.struct("hits", "b")).alias("best"))
        return best.select("a", F.col("best.b").alias("b"))

    def mixed(self, lists: DataFrame) -> DataFrame:
        """The lists with sets of more than one label."""
        some = lists.groupBy("shingle").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("shingle")
        return self.pin(lists.join(some, "shingle", "left_semi"))

    def cross_pairs(self, lists: DataFrame, every: bool = False) -> DataFrame:
        """Pairs of sets in one short list that are of different labels; of a long list those with a set that stands for
        others, unless ``every`` one is wanted."""
        left = lists.withColumnRenamed("set_id", "a")
        right = lists.select("shingle", F.col("set_id").alias("b"), F.col("n").alias("m"), F.col("label").alias("other"), F.col("pos").alias("at"), "long", "common", "own")
        if every:
            met = left.join(right.drop("long", "common", "own"), "shingle").where("label < other")
        else:
            first = lists.where("long").groupBy("common").agg(F.min(F.struct("own", "set_id")).alias("first"))
            stands = first.select(F.col("first.set_id").alias("b"))
            few = right.where("NOT long").drop("long", "common", "own")
            many = right.where("long").join(stands, "b", "left_semi").drop("long", "common", "own")
            short = left.where("NOT long").join(few, "shingle").where("label < other")
            met = short.unionByName(left.where("long").join(many, "shingle").where("label <> other"))
        reach = F.expr(f"{100 + self.percent} * least(n - pos, m - at) >= {self.percent} * (n + m)")
        met = met.where(self.near("n", "m") & reach)
        return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def labelled(self, lists: DataFrame, links: DataFrame | None) -> DataFrame:
        if links is None:
            return lists.withColumn("label", F.col("set_id"))
        labels = components(links).select(F.col("node").alias("set_id"), F.col("label").alias("l"))
        return lists.drop("label").join(labels, "set_id", "left").withColumn("label", F.coalesce("l", "set_id")).drop("l")


def jaccard_pairs(docs: DataFrame, percent: int = 80, size: int = 5, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """All links (a, b) between different sets, and the membership (doc_id, set_id, n) of documents."""
    join = SetJoin(docs, percent, size, doc_id, text)
    sets, lists = join.candidates()
    return join.links(join.cross_pairs(join.labelled(lists, None), every=True), sets), join.docs.select("doc_id", "set_id", "n")


def jaccard_components(docs: DataFrame, percent: int = 80, size: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document ``n_shingles`` and ``component_id``, the least document id that links reach."""
    with small_batches(docs.sparkSession):
        join = SetJoin(docs, percent, size, doc_id, text)
        sets, lists = join.candidates()
        links = join.pin(join.links(join.head_pairs(lists, F.col("own"), (-F.col("n")).alias("size")), sets))
        known = join.mixed(join.labelled(lists, links))
        links = join.pin(links.union(join.links(join.head_pairs(known), sets)))
        free_shuffles(join.spark)
        known = join.mixed(join.labelled(known, links))
        links = join.pin(links.union(join.links(join.cross_pairs(known), sets)))
        free_shuffles(join.spark)
    labels = components(links).select(F.col("node").alias("set_id"), "label")
    classes = join.docs.where("set_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("first"))
    classes = join.pin(classes.join(labels, "set_id", "left").withColumn("label", F.coalesce("label", "set_id")))
    named = classes.join(classes.groupBy("label").agg(F.min("first").alias("component_id")), "label").select("set_id", "component_id")
    out = join.docs.join(named, "set_id", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
