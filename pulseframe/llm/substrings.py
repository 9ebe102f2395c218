"""Exact removal of byte strings that occur more than once, by rank doubling over sampled positions.

The operator marks each byte that lies in some ``size``-byte string that also starts elsewhere. Doubling ranks for every byte
position would shuffle 16 bytes per byte of text and round, so the rounds run on anchors (see ``anchors``): the first rank is
that of the 16 bytes at an anchor, and each round reranks by a longer string around it, until a position is unique, its whole
surroundings repeat, or the full size is reached. A string around an anchor is named by its offset to the anchor; a round
narrows the range of offsets (all, then 24, 4 and 1 of them), which lengthens what all strings of the range share. Where a
range's shared part is unique, none of its strings repeats. Where the part that the strings of the range cover repeats as a
whole, all do; one occurrence of it stays in the rounds for the sake of others. The rest goes on.

Counts come from ``keycount``: a frequent string costs an entry per chunk. Strings are compared by 64-bit hash.

Defined cases: null text is empty and has nothing removed; texts shorter than ``size`` keep all; repeated rows are
occurrences of each other; rows whose ids are null or repeat are told apart by a hash of their text; an empty table gives no
rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.anchors import GRAM, segments
from pulseframe.llm.bytewords import mix, running, runs, span_hash
from pulseframe.llm.keycount import repeats, with_repeats
from pulseframe.llm.exprs import free_shuffles
from pulseframe.session import pin

WIDTHS = (24, 4, 1)
CHUNK_KEYS = 1 << 19
CHUNK_BYTES = 8 << 20
CHUNKS = "chunk long, keys binary, body binary"
FOUND = "doc_id long, mark long, found binary, open binary"


def zipped(value) -> bytes:
    data = pickle.dumps(value, protocol=5)
    return len(data).to_bytes(8, "little") + pa.Codec("zstd").compress(data, asbytes=True)


def unzipped(data: bytes):
    return pickle.loads(pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True))


def chunk_row(seq: int, keys: np.ndarray, body) -> pa.RecordBatch:
    from pyspark import TaskContext

    chunk = (TaskContext.get().partitionId() << 32) | seq
    return pa.RecordBatch.from_pydict({"chunk": [chunk], "keys": [keys.tobytes()], "body": [zipped(body)]})


def salted(h: np.ndarray, *numbers) -> np.ndarray:
    for x in numbers:
        h = mix(h + np.asarray(x).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    return h


def first_round(size: int):
    """Documents to chunks of segments, keyed by the anchor's gram and by all that the segment's strings cover."""

    def run(batches):
        seq, held, n = 0, [], 0
        for batch in batches:
            ids, marks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for t in runs(batch.column(2)):
                sums = running(t.data)
                s = segments(t, sums, size)
                if not len(s.row):
                    continue
                gram = salted(span_hash(sums, s.anchor, s.anchor + GRAM), 7)
                cover = salted(span_hash(sums, s.low, s.high + size), s.anchor - s.low, s.high - s.low)
                rows, row = np.unique(s.row, return_inverse=True)
                at = t.bounds[s.row]
                held.append((
                    [ids[t.first + r] for r in rows], [marks[t.first + r] for r in rows], row.astype(np.int32),
                    *((x - at).astype(np.uint32) for x in (s.anchor, s.low, s.high)), gram, cover,
                ))
                n += len(gram)
                if n >= CHUNK_KEYS:
                    yield first_chunk(seq, held)
                    seq, held, n = seq + 1, [], 0
        if held:
            yield first_chunk(seq, held)

    return run


def first_chunk(seq: int, held: list) -> pa.RecordBatch:
    sizes = np.cumsum([0, *(len(h[0]) for h in held)])
    row = np.concatenate([h[2] + k for h, k in zip(held, sizes[:-1], strict=True)]).astype(np.int32)
    keys = np.concatenate([h[6] for h in held] + [h[7] for h in held])
    body = ([d for h in held for d in h[0]], [m for h in held for m in h[1]], row, *(np.concatenate([h[k] for h in held]) for k in (3, 4, 5)))
    return chunk_row(seq, keys, body)


def pairs(a: np.ndarray, b: np.ndarray) -> bytes:
    return np.stack([a, b], axis=1).astype("<u4").tobytes()


def by_row(row: np.ndarray, *columns: np.ndarray):
    """The values of each row that has some."""
    if not len(row):
        return
    order = np.argsort(row, kind="stable")
    row = row[order]
    first = np.flatnonzero(np.diff(row, prepend=-1))
    for a, b in zip(first, np.append(first[1:], len(row)), strict=True):
        yield int(row[a]), [c[order[a:b]] for c in columns]


def found_rows(ids, marks, found: dict, rest: dict) -> pa.RecordBatch:
    rows = sorted(found.keys() | rest.keys())
    return pa.RecordBatch.from_arrays(
        [pa.array([ids[r] for r in rows], pa.int64()), pa.array([marks[r] for r in rows], pa.int64()),
         pa.array([found.get(r, b"") for r in rows], pa.binary()), pa.array([rest.get(r) for r in rows], pa.binary())],
        ["doc_id", "mark", "found", "open"],
    )


def after_first(batches):
    """Per document: the starts known to repeat, and the segments that go on, with whether they still ask."""
    for batch in batches:
        for keys, body, hits in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
            ids, marks, row, anchor, low, high = unzipped(body.as_py())
            known = repeats(hits.as_py())
            key = np.frombuffer(keys.as_buffer(), np.uint64)
            gram, _ = known.of(key[: len(row)])
            cover, owner = known.of(key[len(row) :])
            whole = cover > 1
            more = (gram > 1) & (~whole | (owner & (gram > cover)))
            found = {r: pairs(*c) for r, c in by_row(row[whole], low[whole], high[whole])}
            asks = ~whole[more]
            rest = {r: np.stack(c, axis=1).astype("<u4").tobytes() for r, c in by_row(row[more], anchor[more], low[more], high[more], asks)}
            yield found_rows(ids, marks, found, rest)


def node_keys(text: np.ndarray, at: np.ndarray, anchor, d0, d1, a, b, size: int):
    """Keys of offset ranges ``d0`` to ``d1``: of what their strings share, and of what those from ``a`` to ``b`` cover.

    ``at`` is where each context begins in ``text``; ``anchor`` counts from there.
    """
    sums = running(text)
    m = at + anchor
    shared = salted(span_hash(sums, m - d0, m - d1 + size), d0, d1)
    cover = salted(span_hash(sums, m - b, m - a + size), a, b, d1)
    return shared, cover


def spread(node: dict, width: int, size: int) -> dict:
    """Each node's offsets cut at multiples of ``width``."""
    w = size - GRAM + 1
    n = node["b"] // width - node["a"] // width + 1
    k = np.repeat(np.arange(len(n)), n)
    part = node["a"][k] // width + np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n)
    d0 = part * width
    d1 = np.minimum(d0 + width, w) - 1
    return {
        "segment": node["segment"][k], "asks": node["asks"][k], "d0": d0, "d1": d1,
        "a": np.maximum(d0, node["a"][k]), "b": np.minimum(d1, node["b"][k]),
    }


def node_chunk(seq: int, body: dict, level: int, size: int) -> pa.RecordBatch:
    """Cut the nodes for ``level`` and key them."""
    body["node"] = n = spread(body["node"], WIDTHS[level], size)
    s = n["segment"]
    text = np.frombuffer(body["text"], np.uint8)
    shared, cover = node_keys(text, body["at"][s], body["anchor"][s], n["d0"], n["d1"], n["a"], n["b"], size)
    return chunk_row(seq, np.concatenate([shared, cover]), body)


def open_chunks(size: int):
    """Documents with open segments to chunks that hold each segment's surroundings."""

    def run(batches):
        seq, held, n = 0, [], 0
        for batch in batches:
            for doc_id, mark, text, rest in zip(*(batch.column(k) for k in range(4)), strict=True):
                seg = np.unique(np.frombuffer(b"".join(rest.as_py()), "<u4").reshape(-1, 4), axis=0).astype(np.int64)
                data = text.as_py().encode("utf-8", "surrogatepass")
                contexts = [data[a : b + size] for a, b in zip(seg[:, 1].tolist(), seg[:, 2].tolist(), strict=True)]
                held.append((doc_id.as_py(), mark.as_py(), seg, contexts))
                n += sum(map(len, contexts))
                if n >= CHUNK_BYTES:
                    yield node_chunk(seq, open_body(held), 0, size)
                    seq, held, n = seq + 1, [], 0
        if held:
            yield node_chunk(seq, open_body(held), 0, size)

    return run


def open_body(held: list) -> dict:
    seg = np.concatenate([h[2] for h in held])
    sizes = np.array([len(c) for h in held for c in h[3]], dtype=np.int64)
    return {
        "ids": [h[0] for h in held], "marks": [h[1] for h in held],
        "row": np.repeat(np.arange(len(held)), [len(h[2]) for h in held]), "low": seg[:, 1],
        "text": b"".join(c for h in held for c in h[3]), "at": np.cumsum(sizes) - sizes, "anchor": seg[:, 0] - seg[:, 1],
        "node": {"segment": np.arange(len(seg)), "asks": seg[:, 3] > 0, "a": seg[:, 0] - seg[:, 2], "b": seg[:, 0] - seg[:, 1]},
        "done": [],
    }


def next_level(level: int, size: int):
    """Settle the nodes of ``level`` and cut the open ones for the next; after the last, give each document its starts."""

    def run(batches):
        seq = 0
        for batch in batches:
            for keys, body, hits in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                body, known = unzipped(body.as_py()), repeats(hits.as_py())
                node = body["node"]
                key = np.frombuffer(keys.as_buffer(), np.uint64)
                half = len(key) // 2
                shared, _ = known.of(key[:half])
                cover, owner = known.of(key[half:])
                whole = cover > 1
                sure = node["asks"] & whole
                s = node["segment"][sure]
                m = body["low"][s] + body["anchor"][s]
                body["done"].append((body["row"][s].astype(np.int32), (m - node["b"][sure]).astype(np.uint32), (m - node["a"][sure]).astype(np.uint32)))
                if level + 1 == len(WIDTHS):
                    row, low, high = (np.concatenate(x) for x in zip(*body["done"], strict=True))
                    found = {r: pairs(*c) for r, c in by_row(row, low, high)}
                    yield found_rows(body["ids"], body["marks"], found, {})
                    continue
                more = (shared > 1) & (~whole | (owner & (shared > cover)))
                body["node"] = {k: node[k][more] for k in ("segment", "a", "b")} | {"asks": node["asks"][more] & ~whole[more]}
                yield node_chunk(seq, body, level + 1, size)
                seq += 1

    return run


def merged_spans(blobs: list[bytes], size: int) -> np.ndarray:
    """Maximal runs of bytes that starts ``low`` to ``high`` cover."""
    x = np.concatenate([np.frombuffer(b, "<u4").reshape(-1, 2) for b in blobs]).astype(np.int64)
    x = x[np.argsort(x[:, 0], kind="stable")]
    reach = np.maximum.accumulate(x[:, 1] + size)
    new = np.ones(len(x), bool)
    new[1:] = x[1:, 0] > reach[:-1]
    first = np.flatnonzero(new)
    return np.stack([x[first, 0], reach[np.append(first[1:], len(x)) - 1]], axis=1)


def assemble(size: int, with_text: bool):
    def run(batches):
        for batch in batches:
            out = []
            for doc_id, text, blobs in zip(*(batch.column(k) for k in range(3)), strict=True):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                blobs = [b for b in blobs.as_py() or [] if b]
                spans = merged_spans(blobs, size) if blobs else np.empty((0, 2), np.int64)
                kept, at = [], 0
                for a, b in spans.tolist():
                    kept.append(data[at:a])
                    at = b
                rest = b"".join([*kept, data[at:]])
                row = {
                    "doc_id": doc_id.as_py(), "n_bytes": len(data), "n_removed": len(data) - len(rest), "n_spans": len(spans),
                    "kept_sha256": hashlib.sha256(rest).hexdigest(),
                }
                out.append(row | ({"spans": spans.tolist(), "kept": rest} if with_text else {}))
            fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
            fields += [("spans", pa.list_(pa.list_(pa.int64()))), ("kept", pa.binary())] if with_text else []
            yield pa.RecordBatch.from_pylist(out, pa.schema(fields))

    return run


def remove_repeats(docs: DataFrame, size: int = 200, doc_id: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """Per document: bytes, bytes removed, maximal removed runs and a digest of the rest; with ``with_text`` also the runs
    and the remaining bytes themselves."""
    if size < 4 * GRAM:
        raise ValueError(f"strings of at least {4 * GRAM} bytes")
    spark = docs.sparkSession
    slim = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(f"`{text}`").alias("mark"), F.col(f"`{text}`").alias("text"))
    chunks = pin(slim.mapInArrow(first_round(size), CHUNKS))
    # Of equal rows only the one that owns a segment's key holds it open.
    rows = with_repeats(chunks).select("keys", "body", "hits").mapInArrow(after_first, FOUND).groupBy("doc_id", "mark")
    first = pin(rows.agg(F.max("found").alias("found"), F.collect_set("open").alias("open")))
    del chunks
    free_shuffles(spark)
    asked = first.where(F.size("open") > 0).select(F.col("doc_id").alias("id_"), F.col("mark").alias("mark_"), "open")
    texts = slim.where("text IS NOT NULL").join(asked, F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("mark") == F.col("mark_")))
    level = pin(texts.select("doc_id", "mark", "text", "open").mapInArrow(open_chunks(size), CHUNKS))
    free_shuffles(spark)
    for k in range(len(WIDTHS)):
        last = k + 1 == len(WIDTHS)
        level = pin(with_repeats(level).select("keys", "body", "hits").mapInArrow(next_level(k, size), FOUND if last else CHUNKS))
        free_shuffles(spark)
    found = first.select("doc_id", "mark", "found").unionByName(level.select("doc_id", "mark", "found")).where(F.octet_length("found") > 0)
    spans = found.groupBy(F.col("doc_id").alias("id_"), F.col("mark").alias("mark_")).agg(F.collect_list("found").alias("found"))
    whole = slim.join(spans, F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("mark") == F.col("mark_")), "left")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return whole.select("doc_id", "text", "found").mapInArrow(
        assemble(size, with_text), schema + (", spans array<array<long>>, kept binary" if with_text else "")
    )
