"""Virtual slots: the stored map, its edits, and placed rows."""

import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from pulseframe.llm.exprs import table
from pulseframe.llm.queries import QUERIES
from pulseframe.llm.virtual_slots import SLOTS, SlotMap, even_out, grow, measured, plan, shard_documents, shards_of
from pulseframe.session import scratch

SF = "/root/testdata/sf0.001"


def laws(rows, shards=8):
    """Gapless places, one shard for each slot, and the bytes of each shard."""
    places, load, of_slot = defaultdict(list), Counter({s: 0 for s in range(shards)}), {}
    for r in rows:
        places[r["shard"]].append(r["place"])
        load[r["shard"]] += r["size"]
        assert of_slot.setdefault(r["virtual_slot"], (r["shard"], r["next_shard"])) == (r["shard"], r["next_shard"])
        assert r["next_shard"] in (r["shard"], shards)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    return load


def test_query_over_the_table(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in table(spark, SF, "documents").collect()}
    got = QUERIES["op11_virtual_slots"](spark, SF).withColumnRenamed("slot", "place").collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    for r in got:
        raw = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
    load = laws(got)
    assert max(load.values()) - min(load.values()) <= 0.01 * sum(load.values()) / 8


def test_odd_rows_and_reruns(spark):
    texts = ["a", "bb", None, "", "é" * 40, "long " * 50000, "same", "same"]
    rows = [(i, texts[i % 8] if i % 8 != 5 or i < 8 else "medium " * (i % 50)) for i in range(800)] + [(None, "x"), (None, None), (3, "other"), (3, "other")]
    df = spark.createDataFrame([(d, t, 1, "s") for d, t in rows], "doc_id long, text string, slot int, shard string")
    got = shards_of(df, scratch(spark, "map")).collect()
    assert sorted((str(r["doc_id"]), r["size"]) for r in got) == sorted((str(d), len((t or "").encode()) + 1) for d, t in rows)
    *others, fullest = sorted(laws(got).values())
    assert 250001 <= fullest < 250100 and others[-1] - others[0] < 10
    again = shards_of(df.orderBy(F.rand(5)), scratch(spark, "map")).collect()
    assert Counter(got) == Counter(again)


def test_one_record_with_most_of_the_bytes_is_spread(spark):
    rows = [(None, "the same row again")] * 3000 + [(i, f"text {i}") for i in range(3000)]
    got = shards_of(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), scratch(spark, "map")).collect()
    load = laws(got)
    assert len(got) == 6000 and max(load.values()) - min(load.values()) < 0.02 * sum(load.values()) / 8
    assert len({r["virtual_slot"] for r in got if r["virtual_slot"] >= SLOTS}) > 100


def test_map_versions_and_written_shards(spark):
    docs = table(spark, SF, "documents").withColumn("shard", F.lit("own"))
    path, out = scratch(spark, "map"), scratch(spark, "shards")
    made = plan(measured(docs), path, 8)
    again = SlotMap(path, 8)
    versions = {v: again.version(spark, v).collect() for v in (1, 2, 3)}
    assert [r["shard"] for r in versions[1]] == [r["slot"] % 8 for r in versions[1]]
    by_slot = {v: {r["slot"]: r["shard"] for r in versions[v]} for v in versions}
    assert all(by_slot[3][s] in (by_slot[2][s], 8) for s in by_slot[2])
    assert again.version(spark).first()["version"] == 3
    shard_documents(docs, out, made)
    back = spark.read.parquet(out)
    assert back.columns == [*[c for c in docs.columns if c != "shard"], "shard"]
    assert {(r["doc_id"], r["shard"]) for r in back.collect()} == {
        (r["doc_id"], r["shard"]) for r in shards_of(docs, scratch(spark, "map")).collect()}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert shards_of(empty, scratch(spark, "map")).count() == 0


def test_edits_against_all_choices():
    rng = np.random.default_rng(3)
    for _ in range(20):
        size = rng.integers(1, 1000, 400)
        start = rng.integers(0, 3, 400)
        even = even_out(size, start, 8)
        load = np.bincount(even, size, 8)
        assert load.max() - load.min() <= max(2, 0.001 * load.mean())
        more = grow(size, even, 8)
        assert set(even[more != even].tolist()) <= set(range(8)) and set(more[more != even].tolist()) == {8}
        after = np.bincount(more, size, 9)
        assert after.max() - after.min() <= 0.05 * after.mean()
    alone = even_out(np.array([10_000, 1, 1, 1]), np.array([0, 0, 0, 0]), 2)
    assert sorted(np.bincount(alone, [10_000, 1, 1, 1], 2)) == [3, 10_000]
    assert even_out(np.zeros(5, np.int64), np.arange(5) % 3, 3).tolist() == [0, 1, 2, 0, 1]
