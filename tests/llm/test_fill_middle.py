"""Fill-in-the-middle against plain Python: boundary sets, cuts, forms and the way back."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulseframe.llm.fill_middle import SPAN, Sentinels, boundaries, container, fill_in_middle, restored

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, n string, output int"
TEXTS = [
    "one two three four five", "", None, " ", " \n ", "  lead and trail \t", "é ü 漢字 emoji 😀 done", "has <P> inside", "ends <", "<S",
    "a", "word " * 30000, "x" * 100000, "\x0b\x0c mixed\r\nlines\n\nand more\n", "nb space stays", "<P", "P> <", "same text", "same text",
]


def expected(doc_id, text, units=TOKEN.findall, percent=50, spm=80):
    t, d = text or "", hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * i : 8 * i + 8], 16) for i in range(4)]
    u = units(t)
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    pre, mid, suf = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not t or any(s in t for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return len(u), "plain", None, None, t
    if h[3] % 100 < spm:
        return len(u), "spm", len(pre), len(pre) + len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(u), "psm", len(pre), len(pre) + len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.mark.parametrize("members", [
    [0], [65535], [65536], list(range(70000)), list(range(0, 200000, 3)), list(range(0, 200000, 2)), [5, 6, 7, 9, 65534, 65535, 65536, 400000],
    list(range(4096)), list(range(0, 8192, 2)), list(range(0, 8194, 2)), sorted(np.random.default_rng(1).choice(300000, 90000, False).tolist()),
])
def test_every_member_is_selected(members):
    held = boundaries(np.array(members))
    assert len(held) == len(members) and held.end_of(0) == 0
    some = range(len(members)) if len(members) < 9000 else range(0, len(members), 97)
    assert [held.end_of(k + 1) for k in some] == [members[k] for k in some]
    assert held.end_of(len(members)) == members[-1]


def test_containers_take_the_smallest_form():
    assert container(np.arange(SPAN)).kind == "run"
    assert container(np.arange(0, SPAN, 2)).kind == "bitmap"
    assert container(np.arange(0, SPAN, 100)).kind == "array"
    assert container(np.array([3, 4, 5, 6, 7, 8, 9])).kind == "run"
    assert len(boundaries(np.array([], np.int64))) == 0


def test_equals_plain_python(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS * 12)] + [(None, "null key here"), (7, "a repeated row of words"), (7, "a repeated row of words")]
    df = spark.createDataFrame([(d, t, "own", 1) for d, t in rows], SCHEMA).repartition(3)
    out = fill_in_middle(df)
    assert out.columns == ["doc_id", "text", "n", "form", "prefix_end", "middle_end", "output"]
    got = out.withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    key = lambda x: tuple(map(str, x))
    mine = sorted([(r["doc_id"], r["n"], r["form"], r["prefix_end"], r["middle_end"], r["output"]) for r in got], key=key)
    assert mine == sorted([(d, *expected(d, t)) for d, t in rows], key=key)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert all(r["back"] == (r["text"] or "") for r in got)


def test_character_units_and_shares(spark):
    df = spark.createDataFrame([(i, f"tëxt number {i} 😀") for i in range(300)] + [(300, "ab" * 50000)], "doc_id long, text string")
    got = fill_in_middle(df, percent=100, spm_percent=0, unit="character").collect()
    assert {r["form"] for r in got} == {"psm"}
    assert all((r["n"], r["form"], r["prefix_end"], r["middle_end"], r["output"]) == expected(r["doc_id"], r["text"], list, 100, 0) for r in got)


def test_sentinels_that_could_be_mistaken_are_refused(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    for bad in (Sentinels("", "<S>", "<M>"), Sentinels("aXa", "<S>", "<M>"), Sentinels("<P>", "<P>", "<M>"), Sentinels("<P>", "<P>x", "<M>")):
        with pytest.raises(ValueError):
            fill_in_middle(df, sentinels=bad)


def test_empty_table(spark):
    assert fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).count() == 0
