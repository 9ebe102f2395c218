"""Words that a sum of powers cannot tell apart, added tokens, and rows without an id or with one that comes again."""

import itertools
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from brute import jaccard_components as plain_components
from brute import repeated_bytes
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as C
from pulseframe.llm import bytewords as W
from pulseframe.llm import jaccard_join, mixing, substrings, token_files
from pulseframe.llm.components import components
from pulseframe.llm.queries import tokenizer_file
from pulseframe.session import scratch

SF = "/root/testdata/sf0.001"


def twins(n):
    """A word over a and b in which no run comes three times, and the word with both letters swapped."""
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [1024, 2048, 65536])
def test_hashes_tell_twins_apart(n):
    t = next(W.runs(pa.array([" ".join(twins(n))]), 1 << 22))
    spans = W.word_spans(t)
    assert len(set(W.word_hash(t.data, spans.start, spans.end).tolist())) == 2
    assert len(set(W.span_hash(W.running(t.data), spans.start, spans.end).tolist())) == 2


def test_word_hash_counts_every_byte_and_the_length():
    words = sorted({bytes(np.random.default_rng(k).integers(1, 255, n).tolist()) for n in range(1, 140) for k in range(3)})
    words += [w + b"\0" for w in words] + [w[:-1] + bytes([w[-1] ^ 1]) for w in words]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    h = W.word_hash(data, ends - [len(w) for w in words], ends)
    assert len(set(h.tolist())) == len(set(words))
    alone = [W.word_hash(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0] for w in words]
    assert h.tolist() == [int(x) for x in alone]


def test_equal_spans_have_equal_hashes_wherever_they_stand():
    data = np.random.default_rng(1).integers(0, 4, 4000).astype(np.uint8)
    sums = W.running(np.concatenate([data, data[:100], data]))
    at = np.arange(0, 3000, 7)
    assert (W.span_hash(sums, at, at + 300) == W.span_hash(sums, at + 4100, at + 4400)).all()
    assert len(set(W.span_hash(sums, at, at + 300).tolist())) == len(at)


def test_token_files_of_twins_and_added_tokens(spark):
    plain = Tokenizer.from_file(tokenizer_file())
    a, b = twins(1024)
    texts = [
        f"x {a} y", f"x {b} y", f"{a} {b}", "a <|endoftext|> b", "a<|endoftext|>", "<|endoftext|>", "half <|endof text|>", " ".join(twins(2048)),
        "x <|endoftext|>\n<|endoftext|> y", "same", "same", None, "", "long " * 40000,
    ]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "no id"), (None, "nor this"), (None, None), (3, "again"), (3, "again"), (9, "same")]
    path = scratch(spark, "tokens")
    token_files.write_token_files(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), path, tokenizer_file())
    got = token_files.read_token_files(spark, path).orderBy("start").collect()
    want = Counter((d, (*plain.encode(t or "", add_special_tokens=False).ids, 0)) for d, t in rows)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == want
    assert [r["start"] for r in got] == np.cumsum([0, *[r["n_tokens"] for r in got]])[:-1].tolist()
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))


def test_pieces_have_the_library_s_ids():
    """All rows of up to three signs of all kinds, and mixed texts; few of them need the library whole, and words it has seen no second time."""
    plain = Tokenizer.from_file(tokenizer_file())
    kinds = ["a", "B", "\u00e9", "7", ".", "*", "'s", "'", " ", " ", "\n", "\t", "\r\n", "\u00d7", "\u4e2d", "\u00a0", "\u2028", "\x1c", "\x85", "\u0301"]
    texts = ["".join(x) for n in range(1, 4) for x in itertools.product(kinds, repeat=n)]
    rng = np.random.default_rng(5)
    texts += ["".join(rng.choice(kinds, n)) for n in rng.integers(4, 40, 3000)]
    enc = token_files.TextEncoder(tokenizer_file(), 1000)
    ids, sizes = enc.encode(next(W.runs(pa.array(texts), 1 << 24)))
    want = [x.ids for x in plain.encode_batch(texts, add_special_tokens=False)]
    assert sizes.tolist() == list(map(len, want)) and ids.tolist() == [i for x in want for i in x]

    prose = ["Word, 12 words.\nAnd *** caf\u00e9  so", "so words.\n\nAnd\n", "\t12 caf\u00e9"] * 50
    enc.known.clear(), enc.old.clear()
    enc.whole, enc.learn = None, lambda words: words and pytest.fail("a plain word went through all of the library")
    ids, _ = enc.encode(next(W.runs(pa.array(prose), 1 << 24)))
    assert ids.tolist() == [i for x in plain.encode_batch(prose, add_special_tokens=False) for i in x.ids]
    assert len(enc.known) < 25


def test_twins_in_the_pair_joins(spark):
    a, b = twins(1024)
    tail = " ".join(f"w{k}" for k in range(4))
    rows = [(1, f"{a} {tail}"), (2, f"{b} {tail}"), (3, f"{a} {tail}"), (4, None), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, jaccard_join.jaccard_components(df).collect()), key=str) == plain_components(rows)
    found = substrings.remove_repeats(df).collect()
    assert sorted([(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found], key=str) == repeated_bytes(rows, 200)


def test_many_short_texts_and_few_words(spark):
    """Chunks that end by documents, ranges that hold few of them."""
    rows = [(k, f"a b c d e{k % 700}") for k in range(1500)] + [(k, None) for k in range(1500, 1600)]
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert all(r["component_id"] == (r["doc_id"] % 700 if r["doc_id"] < 1500 else r["doc_id"]) for r in got)


def test_chunks_end_by_documents(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CHUNK_DOCS", 7)
    rows = [(k, None if k % 3 == 0 else f"one two three four five six seven eight nine {k % 5}") for k in range(120)]
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()
    assert sorted(map(tuple, got), key=str) == plain_components(rows)


def mix_of(df):
    return Counter(map(tuple, mixing.mixed_rows(mixing.plan_mix(df)).drop("shard").collect()))


def test_the_mix_agrees_with_itself_without_ids(spark):
    rows = [(None if k % 2 else k % 9, f"text {k} " + "word " * (k % 23), "abc"[k % 3] if k % 7 else None) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first = mix_of(df)
    assert all(mix_of(df.orderBy(F.rand(s)).repartition(n)) == first for s, n in ((1, 3), (2, 7)))


BASE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
OTHER = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"


def documents(spark, rows):
    return spark.createDataFrame([(d, t, "en", "web", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")


def kept(df):
    return sorted([(r["doc_id"], r["text"]) for r in df.collect()], key=str)


def test_one_of_each_tells_rows_apart(spark):
    rows = [
        (1, BASE), (None, BASE), (5, OTHER), (5, BASE + " phi"), (7, OTHER + " eighteen"), (None, "alone " + OTHER[::-1]), (9, None), (9, None),
        (10, ""), (2, BASE), (2, BASE), (None, "nothing else here is like this one at all"), (None, None),
    ]
    got = kept(C.one_of_each(spark, documents(spark, rows), SF))
    want = [(1, BASE), (5, OTHER), (None, "alone " + OTHER[::-1]), (9, None), (10, ""), (None, "nothing else here is like this one at all"), (None, None)]
    assert got == sorted(want, key=str)
    assert C.one_of_each(spark, documents(spark, []), SF).count() == 0


def test_leaks_take_their_own_rows_only(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    rows = [(None, f"before {item} after"), (None, BASE), (4, item), (4, OTHER), (6, None), (6, ""), (8, OTHER), (8, OTHER)]
    got = kept(C.without_leaks(spark, documents(spark, rows), SF))
    assert got == sorted([(None, BASE), (4, OTHER), (6, None), (6, ""), (8, OTHER), (8, OTHER)], key=str)
    assert C.without_leaks(spark, documents(spark, []), SF).count() == 0


def test_short_pieces_are_kept_in_arrays():
    """Plain short words go through the library's model once, take no place among Python's objects, and come back right after others went."""
    plain = Tokenizer.from_file(tokenizer_file())
    rng = np.random.default_rng(8)
    texts = [" ".join("".join(rng.choice(list("abcdef0.é"), n)) for n in rng.integers(1, 20, 60)) + "\x00" * (k % 3) for k in range(60)] + [None, ""]
    want = [x.ids for x in plain.encode_batch([t or "" for t in texts], add_special_tokens=False)]

    class Counted:
        def __init__(self, model):
            self.model, self.n = model, 0

        def tokenize(self, text):
            self.n += 1
            return self.model.tokenize(text)

    for most, again in ((5, True), (300, True), (1 << 16, False)):
        enc = token_files.TextEncoder(tokenizer_file(), 10_000, most)
        enc.known.clear(), enc.old.clear()
        enc.model = Counted(enc.model)
        for _ in range(2):
            before = enc.model.n
            for t in W.runs(pa.array(texts), 2000):
                ids, sizes = enc.encode(t)
                mine = want[t.first : t.first + len(sizes)]
                assert sizes.tolist() == list(map(len, mine)) and ids.tolist() == [i for x in mine for i in x]
                assert enc.short.n <= most
        assert (enc.model.n > before) == again
        assert all(len(p) > token_files.SHORT or not p.isalnum() for p in map(bytes.strip, enc.known))


def test_few_rows_are_written_to_few_files(spark):
    """However many partitions a shuffle has: a file for each, of 200 and mostly empty, is what a step over few documents wrote before."""
    rows = [(k, f"one two three four five six seven eight nine {k % 7}") for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    held = {"spark.sql.shuffle.partitions": "200", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    most = 2 * spark.sparkContext.defaultParallelism
    assert most < 200
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        join = jaccard_join.SetJoin(df, 80, 5, "doc_id", "text")
        sets, lists = join.candidates()
        links = spark.createDataFrame([(b"a", b"b"), (b"c", b"b"), (b"d", b"e")], "a binary, b binary")
        named = components(links)
        assert all(0 < x.rdd.getNumPartitions() <= most for x in (join.docs, sets, lists, named))
        assert sorted((bytes(n), bytes(label)) for n, label in named.collect()) == [(b"a", b"a"), (b"b", b"a"), (b"c", b"a"), (b"d", b"d"), (b"e", b"d")]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
