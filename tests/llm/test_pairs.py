"""Jaccard join, substring removal and line runs against plain Python."""

import random
import sys
from pathlib import Path

import pytest

from pulseframe.llm.jaccard_join import jaccard_components, jaccard_pairs
from pulseframe.llm.line_runs import delete_repeats
from pulseframe.llm.substrings import remove_repeats

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

SCHEMA = "doc_id long, text string, mark string, label string, rank int, hits int"


def words(rng, n):
    return " ".join(rng.choice(["alpha", "Beta", "gé", "x", "yy", f"z{rng.randint(0, 60)}"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    base, passage = [words(rng, 70) for _ in range(4)], words(rng, 45)
    out = [(1, None), (2, ""), (3, "ab" * 300), (4, "a" * 1000), (5, "one two"), (6, "One\ttwo"), (7, " \n "), (None, base[0])]
    for i in range(10, 60):
        w = rng.choice(base).split(" ")
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = f"E{i}"
        out.append((i, words(rng, rng.randint(0, 20)) + " " + passage + " ".join(w) if rng.random() < 0.3 else " ".join(w)))
    out += [(60, words(rng, 20000)), (61, out[20][1]), (61, out[20][1])]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "m", "l", 1, 2) for d, t in rows], SCHEMA).repartition(3)


def test_jaccard_components(spark, rows):
    got = sorted((tuple(r) for r in jaccard_components(frame(spark, rows)).collect()), key=str)
    assert got == brute.jaccard_components(rows)


def test_jaccard_pairs_are_all_links_of_different_sets(spark, rows):
    links, members = jaccard_pairs(frame(spark, rows))
    sets, pairs = brute.jaccard_links(rows)
    wanted = {frozenset((sets[a], sets[b])) for a, b in pairs if sets[a] != sets[b]}
    assert links.distinct().count() == links.count() == len(wanted)
    assert members.count() == len(rows)


def test_a_chain_of_near_copies_is_one_component(spark):
    w = [f"w{i}" for i in range(200)]
    chain = [(k, " ".join([f"n{j}" for j in range(6 * k)] + w[6 * k :])) for k in range(12)]
    got = {r["doc_id"]: r["component_id"] for r in jaccard_components(frame(spark, chain)).collect()}
    assert got == {d: c for d, _, c in brute.jaccard_components(chain)}
    assert set(got.values()) == {0}


@pytest.mark.parametrize("size", [64, 200])
def test_removed_bytes(spark, rows, size):
    got = sorted((tuple(r) for r in remove_repeats(frame(spark, rows), size).collect()), key=str)
    assert got == brute.repeated_bytes(rows, size)


def test_remaining_bytes_and_spans(spark):
    passage = "p" * 50 + "q" * 170
    out = remove_repeats(spark.createDataFrame([(1, "aa" + passage + "b"), (2, passage)], "doc_id long, text string"), with_text=True)
    got = {r["doc_id"]: r for r in out.collect()}
    assert bytes(got[1]["kept"]) == b"aab" and got[1]["spans"] == [[2, 222]]
    assert bytes(got[2]["kept"]) == b""


def test_equal_rows_of_different_partitions_stand_for_others(spark):
    rng = random.Random(9)
    twins = [(7 if k % 2 else None, words(rng, 150)) for k in range(12)]
    rows = twins + [(100 + k, words(rng, 40) + t[130:470] + words(rng, 40)) for k, (_, t) in enumerate(twins)] + twins
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 12), "doc_id long, text string")
    plain = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in plain}
    try:
        for k, v in plain.items():
            spark.conf.set(k, v)
        got = remove_repeats(docs).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted((tuple(r) for r in got), key=str) == brute.repeated_bytes(rows, 200)


@pytest.mark.parametrize("lines", [1, 2, 3])
def test_line_runs(spark, lines):
    rng = random.Random(3)
    docs = [(k, "\n".join(rng.choice(["a", "b b", "", " ", f"u{rng.randint(0, 40)}"]) for _ in range(rng.randint(0, 25)))) for k in range(40)]
    docs += [(None, "a\nb b\nc"), (50, None), (51, ""), (52, docs[7][1])]
    got = delete_repeats(frame(spark, docs), lines).select("doc_id", "kept", "n_lines", "n_removed").collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute.delete_lines(docs, lines), key=str)


def test_a_repeated_row_is_a_later_copy_as_a_whole(spark):
    got = delete_repeats(frame(spark, [(1, "a\nb\nc"), (1, "a\nb\nc"), (1, "z")])).collect()
    assert sorted((r["kept"], r["n_removed"]) for r in got) == [("", 3), ("a\nb\nc", 0), ("z", 0)]


@pytest.mark.parametrize(("lines", "least"), [(1, 1), (1, 4), (1, 9), (1, 30), (3, 6)])
def test_line_runs_by_words(spark, lines, least):
    rng = random.Random(17)
    line = [" ".join(rng.choice("abcdefgh") for _ in range(rng.choice([1, 2, 3, 12]))) for _ in range(60)]
    passage = [f"shared {k} " + line[k] for k in range(20)]
    docs = []
    for k in range(36):
        body = [rng.choice([*line[:12], "", f"own {rng.randint(0, 400)} words"]) for _ in range(rng.randint(0, 12))]
        cut = rng.randint(0, 20)
        docs.append((k, "\n".join(body + passage[cut : cut + 1 + k % 20] + body[:3])))
    docs += [(90, docs[4][1]), (91, docs[4][1] + "\n\n"), (92, None), (93, "")]
    got = delete_repeats(frame(spark, docs), lines, words=least).select("doc_id", "kept", "n_lines", "n_removed").collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute.delete_repeated_runs(docs, lines, least), key=str)


def test_a_long_line_between_different_neighbours_is_a_run(spark):
    long = " ".join(f"w{k}" for k in range(60))
    got = delete_repeats(frame(spark, [(1, f"a\n{long}\nb"), (2, f"c\n{long}\nd"), (None, long)]), 1, words=30).collect()
    assert sorted((str(r["doc_id"]), r["kept"]) for r in got) == [("1", "a\nb"), ("2", "c\nd"), ("None", long)]


@pytest.mark.parametrize("run", [jaccard_components, remove_repeats, delete_repeats])
def test_empty_table(spark, run):
    assert run(frame(spark, [])).count() == 0
