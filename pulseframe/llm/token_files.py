"""Token-id files: documents in ascending id order, coded by a static rANS under one shared frequency table.

Writing takes three passes: encode the texts, dealt by range of the id, into rows of whole documents; count ids (a row per id
of the vocabulary); code each row into a file of independent blocks. The driver sees the count of each id and one total per
partition, nothing else. A task that is lost starts its files over under temporary names; a finished file appears whole.
Reading takes the files in any order and in parallel, checks every block, and returns documents with their place in the
whole stream.

Defined cases: a null or empty text is the end id alone; null ids come first; rows with one id are ordered by a hash of their
text, each keeps its own row; an empty table writes no file and reads back as no rows; extra columns are not read.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.llm import rans
from pulseframe.llm.bytewords import BASE, KEEP, SPACES, Texts, begin, eights, mix, process_cache, runs
from pulseframe.llm.exprs import partitions, small_batches

CHUNKS = "part int, seq int, local_first long, n_tokens long, doc_ids array<long>, lengths array<int>, tokens binary"
DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long"
#: Bytes of text that are cut and looked up at once.
RUN_BYTES = 1 << 20


class Layout(NamedTuple):
    """Tokens of a file at most (whole documents, so a longer document makes a longer file), of a block, and its lanes.

    A worker keeps the ids of so many words that the library cuts, and of so many short pieces.
    """

    file_tokens: int = 1 << 22
    row_tokens: int = 1 << 20
    block_tokens: int = 1 << 18
    lanes: int = 1024
    cached_pieces: int = 200_000
    short_pieces: int = 1 << 20


#: Classes of bytes; no class: signs that the library must judge.
WHITE, LETTER, DIGIT, SIGN = range(1, 5)
CLASS = np.zeros(256, np.uint8)
CLASS[0x21:0x7F] = SIGN
CLASS[0x30:0x3A] = DIGIT
CLASS[0x41:0x5B] = CLASS[0x61:0x7B] = LETTER
CLASS[list(SPACES)] = WHITE
CLASS[0x27] = 0  # may start a contraction


def byte_letters() -> str:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints, else one from 256 on."""
    out = [chr(b) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE else "" for b in range(256)]
    others = iter(range(256, 512))
    return "".join(x or chr(next(others)) for x in out)


def pieces_of(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces start, and which of them the library must cut further.

    A byte-level pre-tokenizer cuts between letters, digits and other signs, leaves a blank with what follows it, and of several
    white-space characters in a row gives the last one, unless the text ends there, a piece of its own. That is done here for ASCII
    and the letters from U+00C0 to U+023F; a word, between white space, with any other byte in it stays whole, with its blank.
    """
    n, kind = len(t.data), CLASS[t.data]
    lead = np.flatnonzero((t.data >= 0xC3) & (t.data <= 0xC8))
    lead = lead[(t.data[lead] != 0xC3) | ((t.data[lead + 1] != 0x97) & (t.data[lead + 1] != 0xB7))]
    kind[lead] = kind[lead + 1] = LETTER
    first = np.zeros(n + 1, bool)
    first[t.bounds] = True
    white = kind == WHITE
    after_white = np.concatenate([[True], white[:-1]])
    odd = np.flatnonzero(kind == 0)
    if len(odd):
        word = np.cumsum(~white & (first[:-1] | after_white), dtype=np.int32)
        bad = np.zeros(int(word[-1]) + 1, bool)
        bad[word[odd]] = True
        kind[bad[word] & ~white] = 0
    changes = np.concatenate([[True], kind[1:] != kind[:-1]])
    after_blank = np.concatenate([[False], t.data[:-1] == 0x20])
    last = np.concatenate([~white[1:], [False]]) & ~first[1:]
    begins = np.where(white, ~after_white | last, changes & ~after_blank) | first[:-1]
    start = np.flatnonzero(begins)
    return start, kind[np.append(start[1:], n) - 1] == 0


#: Bytes of a piece that two whole numbers hold, with its length.
SHORT = 15


def short_keys(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of up to ``SHORT`` bytes as two whole numbers each, which are equal for equal pieces only."""
    eight = eights(data)
    low = eight[start] & KEEP[np.minimum(length, 8)]
    high = eight[np.minimum(start + 8, len(data))] & KEEP[np.clip(length - 8, 0, 7)]
    return low, high | length.astype(np.uint64) << np.uint64(56)


class ShortPieces:
    """Ids of up to ``most`` short pieces, in arrays: found by a hash of their keys, told apart by the keys themselves."""

    def __init__(self, most: int):
        self.most, self.n, self.turn = most, 0, 0
        self.hash, self.row = np.empty(0, np.uint64), np.empty(0, np.int32)
        self.low, self.high = np.empty(most, np.uint64), np.empty(most, np.uint64)
        self.begin, self.size, self.used = (np.empty(most, np.int32) for _ in range(3))
        self.pool = np.empty(0, "<u4")

    @staticmethod
    def hashed(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return mix(low ^ mix(high + np.uint64(BASE)))

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The row of each piece, -1 for those that are not here."""
        self.turn += 1
        if not self.n:
            return np.full(len(low), -1)
        row = self.row[np.minimum(np.searchsorted(self.hash, self.hashed(low, high)), self.n - 1)]
        row = np.where((self.low[row] == low) & (self.high[row] == high), row, -1)
        self.used[row[row >= 0]] = self.turn
        return row

    def add(self, low: np.ndarray, high: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        """Take new pieces in. Without room for them, the half that was used last stays; more than ``most`` are not taken."""
        if self.n + len(low) > self.most:
            self.keep(np.sort(np.argsort(-self.used[: self.n], kind="stable")[: max(0, min(self.most // 2, self.most - len(low)))]))
        if len(low) > self.most:
            return
        a, b = self.n, self.n + len(low)
        self.low[a:b], self.high[a:b], self.size[a:b], self.used[a:b] = low, high, size, self.turn
        self.begin[a:b] = len(self.pool) + np.cumsum(size) - size
        self.pool, self.n = np.concatenate([self.pool, ids]), b
        h = self.hashed(low, high)
        order = np.argsort(h)
        at = np.searchsorted(self.hash, h[order])
        self.hash, self.row = np.insert(self.hash, at, h[order]), np.insert(self.row, at, a + order)

    def keep(self, rows: np.ndarray) -> None:
        size, ends = self.size[rows], np.cumsum(self.size[rows], dtype=np.int64)
        self.pool = self.pool[np.repeat(self.begin[rows] - (ends - size), size) + np.arange(size.sum())]
        n = self.n = len(rows)
        self.low[:n], self.high[:n], self.used[:n], self.size[:n], self.begin[:n] = self.low[rows], self.high[rows], self.used[rows], size, ends - size
        h = self.hashed(self.low[:n], self.high[:n])
        order = np.argsort(h)
        self.hash, self.row = h[order], order.astype(np.int32)


class TextEncoder:
    """Ids of whole texts by a ``tokenizers`` file.

    Where its pre-tokenizer is the byte-level one, ids of a text are those of its pieces (``pieces_of``) in order. Each distinct
    piece goes through the library's model once while it stays in a cache, which knows it by its bytes: short pieces in arrays
    (``ShortPieces``), others in a dictionary. Words that the library must cut go through all of it. Texts whose words have other
    white space at their ends, or with the text of one of the tokenizer's added tokens in them, go through it whole.
    """

    def __init__(self, path: str, cached: int, short: int = Layout().short_pieces):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        held = process_cache(f"tokenizer {path}")
        if "it" not in held:
            held["it"] = Tokenizer.from_file(path)
        self.tokenizer = held["it"]
        self.model = self.tokenizer.model
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        cutter, self.letters = str(self.tokenizer.pre_tokenizer), byte_letters()
        self.by_piece = (
            cutter.startswith("ByteLevel(add_prefix_space=False") and "use_regex=True" in cutter and self.tokenizer.normalizer is None
            and all(self.tokenizer.token_to_id(x) is not None for x in self.letters)
        )
        self.cached, self.known, self.old = cached, process_cache(f"new pieces {path}"), process_cache(f"old pieces {path}")
        tables = process_cache(f"short pieces {path}")
        self.short = tables.setdefault(short, ShortPieces(short))
        self.line_feed = self.tokenizer.token_to_id("\u010a")
        self.batch = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.batch(texts, add_special_tokens=False)]

    def learn(self, pieces: list[bytes]) -> None:
        """Encode words that the library must cut. One with white space at an end has no ids of its own.

        They go through the library in runs with line feeds between them: a line feed is then a token of its own and marks
        where a word ends.
        """
        plain, other = [], []
        for raw in pieces:
            p = raw.decode("utf-8", "replace")
            if p[-1].isspace() or p[p[0] == " "].isspace():
                self.known[raw] = None
            else:
                (other if any(x in raw for x in self.added) else plain).append((raw, p))
        for at in range(0, len(plain), 20_000):
            part = plain[at : at + 20_000]
            ids = np.array(self.batch(["\n".join(p for _, p in part)], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = np.flatnonzero(ids == self.line_feed)
            if self.line_feed is None or len(cuts) != len(part) - 1:
                other += part
                continue
            found, starts = ids.tobytes(), [0, *((cuts + 1) * 4).tolist()]
            self.known.update((k, found[a:b]) for (k, _), a, b in zip(part, starts, [*(cuts * 4).tolist(), len(found)], strict=True))
        self.known.update(zip((k for k, _ in other), self.whole([p for _, p in other]), strict=True))

    def tokens_of(self, pieces: list[bytes]) -> tuple[np.ndarray, list[int]]:
        """Ids of pieces that need no further cutting, one after another, and where each piece's ids start, the end last."""
        ids, cuts, run, a = [], [0], self.model.tokenize, 0
        text = b"".join(pieces).decode("latin-1").translate(self.letters)
        for n in map(len, pieces):
            ids += [x.id for x in run(text[a : a + n])]
            cuts.append(len(ids))
            a += n
        return np.array(ids, "<u4"), cuts

    def look_up(self, pieces: list[bytes], odd: list[bool]) -> list[bytes | None]:
        """Ids of pieces. Of the cache's two generations the older goes when the newer is full."""
        if len(self.known) > self.cached // 2:
            self.old.clear()
            self.old.update(self.known)
            self.known.clear()
        known, old, words, new = self.known, self.old, [], []
        for p, by_library in zip(pieces, odd, strict=True):
            if p not in known:
                if p in old:
                    known[p] = old[p]
                else:
                    (words if by_library else new).append(p)
        ids, cuts = self.tokens_of(new)
        found = ids.tobytes()
        known.update((p, found[4 * a : 4 * b]) for p, a, b in zip(new, cuts, cuts[1:], strict=False))
        self.learn(words)
        return list(map(known.__getitem__, pieces))

    def ids_of(self, pieces: pa.Array, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of distinct pieces: a pool of ids, where in it each piece's ids are, how many, and which pieces have none of their own."""
        _, offsets, data = pieces.buffers()
        offsets, data = np.frombuffer(offsets, np.int64)[: len(pieces) + 1], np.frombuffer(data, np.uint8)
        length = np.diff(offsets)
        short = np.flatnonzero((length <= SHORT) & ~odd)
        others = np.flatnonzero((length > SHORT) | odd)
        first, size, none = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64), np.zeros(len(pieces), bool)
        low, high = short_keys(data, offsets[short], length[short])
        row = self.short.find(low, high)
        is_new = row < 0
        new, known = short[is_new], short[~is_new]
        first[known], size[known] = self.short.begin[row[~is_new]], self.short.size[row[~is_new]]
        ids, cuts = self.tokens_of(pieces.take(pa.array(new)).to_pylist())
        size[new], first[new] = np.diff(cuts), len(self.short.pool) + np.array(cuts[:-1], np.int64)
        found = self.look_up(pieces.take(pa.array(others)).to_pylist(), odd[others].tolist())
        size[others], none[others] = [len(x or b"") // 4 for x in found], [x is None for x in found]
        first[others] = len(self.short.pool) + len(ids) + np.cumsum(size[others]) - size[others]
        pool = np.concatenate([self.short.pool, ids, np.frombuffer(b"".join(x or b"" for x in found), "<u4")])
        self.short.add(low[is_new], high[is_new], ids, size[new])
        return pool, first, size, none

    def with_added(self, data: bytes, bounds: np.ndarray) -> np.ndarray:
        """Rows that hold the text of an added token."""
        found = []
        for x in self.added:
            at = data.find(x)
            while at >= 0:
                found.append(at)
                at = data.find(x, at + 1)
        return np.unique(np.searchsorted(bounds, np.array(found, np.int64), side="right") - 1)

    def encode(self, t: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, one after another, and how many each row has."""
        rows, n = len(t.bounds) - 1, len(t.data)
        if not self.by_piece or not n:
            return self.joined(self.whole([t.text(i).decode("utf-8", "replace") for i in range(rows)]))
        start, by_library = pieces_of(t)
        buffers = [None, pa.py_buffer(np.append(start, n)), pa.py_buffer(t.data)]
        coded = pa.Array.from_buffers(pa.large_binary(), len(start), buffers).dictionary_encode()
        back = coded.indices.to_numpy()
        odd = np.zeros(len(coded.dictionary), bool)
        odd[back[by_library]] = True
        pool, first, size, unknown = self.ids_of(coded.dictionary, odd)
        lengths = size[back]
        ends = np.cumsum(lengths)
        kind = np.int32 if max(len(pool), ends[-1]) < 1 << 31 else np.int64
        at = np.repeat((first[back] - (ends - lengths)).astype(kind), lengths)
        at += np.arange(ends[-1], dtype=kind)
        ids = pool[at]
        per_row = np.diff(np.append(0, ends)[np.searchsorted(start, t.bounds)])
        of_unknown = np.searchsorted(t.bounds, start[unknown[back]], side="right") - 1
        whole = np.union1d(of_unknown, self.with_added(t.data.tobytes(), t.bounds))
        if not len(whole):
            return ids, per_row
        stops = np.cumsum(per_row)
        parts = [ids[b - k : b].tobytes() for b, k in zip(stops.tolist(), per_row.tolist(), strict=True)]
        for i, x in zip(whole.tolist(), self.whole([t.text(i).decode("utf-8", "replace") for i in whole.tolist()]), strict=True):
            parts[i] = x
        return self.joined(parts)

    @staticmethod
    def joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(b"".join(parts), "<u4"), np.array([len(p) // 4 for p in parts], dtype=np.int64)


def encoder(path: str, end_id: int, layout: Layout):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        begin("token files")
        part, seq, first = TaskContext.get().partitionId(), 0, 0
        encode = TextEncoder(path, layout.cached_pieces, layout.short_pieces)
        width = np.dtype("<u2" if encode.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        doc_ids, lengths, parts, n = [], [], [], 0

        def flush() -> pa.RecordBatch:
            row = [[part], [seq], [first], [n], [doc_ids], [np.concatenate(lengths)], [b"".join(parts)]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
            names = ["part", "seq", "local_first", "n_tokens", "doc_ids", "lengths", "tokens"]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, types, strict=True)], names)

        for batch in batches:
            for t in runs(batch.column(1), RUN_BYTES):
                ids, sizes = encode.encode(t)
                with_end = sizes + 1
                out = np.full(len(ids) + len(sizes), end_id, dtype=width)
                out[np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes)] = ids
                doc_ids += batch.column(0).slice(t.first, len(sizes)).to_pylist()
                lengths.append(with_end)
                parts.append(out.tobytes())
                n += len(out)
                if n >= layout.row_tokens:
                    yield flush()
                    seq, first = seq + 1, first + n
                    doc_ids, lengths, parts, n = [], [], [], 0
        if doc_ids:
            yield flush()

    return run


def counter(width: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            for x in batch.column(0):
                found = np.bincount(np.frombuffer(x.as_buffer(), width))
                if len(found) > len(total):
                    total = np.concatenate([total, np.zeros(len(found) - len(total), np.int64)])
                total[: len(found)] += found
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "n"])

    return run


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace("file:", "", 1))


def writer(folder: str, freq: np.ndarray, before: dict[int, int], width: str, layout: Layout):
    """Codes rows that follow one another into files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = filesystem(folder)
        store.create_dir(base, recursive=True)
        t = rans.table(freq)
        held: list[dict] = []

        def save() -> pa.RecordBatch:
            ids = np.concatenate([np.frombuffer(r["tokens"], width) for r in held])
            doc_ids = [d for r in held for d in r["doc_ids"]]
            lengths = np.array([n for r in held for n in r["lengths"]], dtype=np.int64)
            first = before[held[0]["part"]] + held[0]["local_first"]
            content = rans.pack(doc_ids, lengths, ids, t, first, layout.block_tokens, layout.lanes)
            name = f"{held[0]['part']:08d}-{held[0]['seq']:08d}.rans"
            part = f"{base}/.{name}.{uuid.uuid4().hex}"
            with store.open_output_stream(part) as out:
                out.write(content)
            store.move(part, f"{base}/{name}")
            return pa.RecordBatch.from_pylist([{
                "file": name, "first_token": int(first), "n_tokens": len(ids), "n_docs": len(doc_ids), "n_bytes": len(content),
            }])

        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                follows = held and (row["part"], row["seq"]) == (held[-1]["part"], held[-1]["seq"] + 1)
                if held and (not follows or sum(r["n_tokens"] for r in held) + row["n_tokens"] > layout.file_tokens):
                    yield save()
                    held = []
                held.append(row)
        if held:
            yield save()

    return run


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text: str = "text",
    layout: Layout = Layout(),
) -> DataFrame:
    """Write ``docs`` below ``path`` (a folder all executors reach); returns the list of files."""
    spark = docs.sparkSession
    dealt = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    # An id that very many rows share is dealt by text, equal rows, which may stand for each other, by where they come from.
    mark, copy = F.xxhash64("text"), F.monotonically_increasing_id()
    dealt = dealt.withColumn("mark", mark).withColumn("copy", copy).repartitionByRange(partitions(spark), "id", "mark", "copy")
    dealt = dealt.sortWithinPartitions("id", "mark").select("id", "text")
    with small_batches(spark):
        dealt.mapInArrow(encoder(tokenizer, end_id, layout), CHUNKS).write.parquet(f"{path}/encoded")
    rows = spark.read.parquet(f"{path}/encoded")
    from tokenizers import Tokenizer

    width = "<u2" if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else "<u4"
    with small_batches(spark):
        found = rows.select("tokens").mapInArrow(counter(width), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in found), default=0) + 1, np.int64)
    for r in found:
        counts[r["id"]] = r["n"]
    freq = rans.normalised(counts)
    spark.createDataFrame([(freq.astype("<u8").tobytes(),)], "freq binary").coalesce(1).write.parquet(f"{path}/table")
    before, total = {}, 0
    for r in rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect():
        before[r["part"]], total = total, total + r["n"]
    listed = "file string, first_token long, n_tokens long, n_docs long, n_bytes long"
    with small_batches(spark):
        rows.mapInArrow(writer(f"{path}/files", freq, before, width, layout), listed).write.parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


def reader(freq: np.ndarray, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = rans.table(freq)
        for batch in batches:
            for content in batch.column(0):
                f = rans.unpack(content.as_py(), t)
                ids = f.tokens(t)
                ends = np.cumsum(f.lengths)
                starts = ends - f.lengths
                if digest:
                    raw = memoryview(ids.astype("<u4").tobytes())
                    last = pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], pa.int64())
                else:
                    last = pa.ListArray.from_arrays(pa.array(np.append(starts, ends[-1]), pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f.doc_ids, pa.int64()), pa.array(starts + f.head["first_token"]), pa.array(f.lengths), last],
                    ["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"],
                )

    return run


def read_token_files(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """Documents from the files: (doc_id, start, n_tokens, ids), or with ``digest`` the CRC-32 of the ids instead."""
    freq = np.frombuffer(spark.read.parquet(f"{path}/table").first()["freq"], "<u8")
    schema = DOCS if digest else "doc_id long, start long, n_tokens long, ids array<int>"
    if spark.read.parquet(f"{path}/manifest").isEmpty():
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.rans").load(f"{path}/files")
    return files.select("content").mapInArrow(reader(freq, digest), schema)
