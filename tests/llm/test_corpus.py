"""Token files, mixing, decontamination, toxicity and the pipeline."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pulseframe.llm import decontaminate, mixing, rans, token_files, toxicity
from pulseframe.llm.queries import QUERIES, tokenizer_file
from pulseframe.session import scratch

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", " a", "a  b", "a\n b\n\nc", "don't stop  now\t\n x", "a\u3000b \u2003c", "<|endoftext|> x", "word " * 3000, "été Été ß"]


@pytest.mark.parametrize("n", [0, 1, 5, 1000, 70000])
def test_rans_round_trip(n):
    ids = np.minimum(np.random.default_rng(n).zipf(1.3, n), 50000).astype(np.uint32)
    t = rans.table(rans.normalised(np.bincount(ids, minlength=50257)))
    f = rans.unpack(rans.pack([1], np.array([n]), ids, t, 0, 4096, 64), t)
    assert (f.tokens(t) == ids).all() and (f.tokens(t, n // 3, n // 2) == ids[n // 3 : n // 2]).all()


def test_rans_notices_damage():
    ids = np.arange(5000, dtype=np.uint32) % 97
    t = rans.table(rans.normalised(np.bincount(ids)))
    data = bytearray(rans.pack([1], np.array([5000]), ids, t, 0, 1024, 16))
    data[-3] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        rans.unpack(bytes(data), t).tokens(t)


def test_token_files_hold_the_library_s_ids(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_file())
    df = spark.createDataFrame([(7 * k % 11, t, "x") for k, t in enumerate(ODD)], "doc_id long, text string, start string").repartition(3)
    path = scratch(spark, "test-tokens")
    token_files.write_token_files(df, path, tokenizer_file(), layout=token_files.Layout(64, 32, 16, 4, 8))
    rows = token_files.read_token_files(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == sorted(7 * k % 11 for k in range(len(ODD)))
    texts, at = {7 * k % 11: t or "" for k, t in enumerate(ODD)}, 0
    for r in rows:
        assert r["ids"] == [*whole.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 0] and r["start"] == at
        at += r["n_tokens"]
    digest = token_files.read_token_files(spark, path, digest=True).orderBy("start").collect()
    assert [d["ids_crc32"] for d in digest] == [zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in rows]


def test_token_files_of_nothing(spark):
    path = scratch(spark, "test-tokens")
    token_files.write_token_files(spark.createDataFrame([], "doc_id long, text string"), path, tokenizer_file())
    assert token_files.read_token_files(spark, path).count() == 0


def water_fill(sizes, weights, budget, cap):
    target, full = {}, set()
    while True:
        left = budget - sum(cap * sizes[s] for s in full)
        open_ = [s for s in sizes if s not in full]
        target = {s: cap * sizes[s] if s in full else left * weights[s] / sum(weights[x] for x in open_) for s in sizes}
        over = {s for s in open_ if target[s] > cap * sizes[s]}
        if not over:
            return target
        full |= over


def test_mix_meets_its_targets(spark):
    rows = [(k, None if k % 9 == 0 else f"s{k % 9 % 4}", " ".join(["w"] * (k * 37 % 190)) or None, "z") for k in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, target string").repartition(4)
    got = mixing.plan_mix(df, shard_words=2000).collect()
    again = {r["doc_id"]: r["draws"] for r in mixing.plan_mix(df.repartition(2), shard_words=2000).collect()}
    names = ["s0", "s1", "s2", "s3", None]
    sizes = {s: sum(len((t or "").split()) for _, x, t, _ in rows if x == s) for s in names}
    wanted = water_fill(sizes, dict(zip(names, [3, 1, 2, 3, 1], strict=True)), 1.5 * sum(sizes.values()), 2)
    taken, shards = dict.fromkeys(names, 0), {}
    for r in got:
        s = rows[r["doc_id"]][1]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(wanted[s])
        words = sum(d["words"] for d in r["draws"])
        assert words <= 2 * r["size"] and again[r["doc_id"]] == r["draws"]
        taken[s] += words
        for d in r["draws"]:
            shards[d["shard"]] = shards.get(d["shard"], 0) + d["words"]
    assert all(abs(taken[s] - wanted[s]) <= 1 for s in names)
    assert len(shards) > 20 and max(shards.values()) < 4 * sum(shards.values()) / len(shards)


def test_mix_draws_whole_documents(spark):
    rows = [(k, f"s{k % 4}", "\n".join(["w x"] * (1 + k * 37 % 90))) for k in range(120)]
    planned = mixing.plan_mix(spark.createDataFrame(rows, "doc_id long, source string, text string"), shard_words=2000).cache()
    texts = {k: t for k, _, t in rows}
    drawn = mixing.mixed_rows(planned).collect()
    assert drawn and all(r["text"] == texts[r["doc_id"]] for r in drawn)
    plan = planned.collect()
    assert any(d["words"] < r["size"] for r in plan for d in r["draws"])
    targets, size = {r["source"]: r["target"] for r in plan}, {r["doc_id"]: r["size"] for r in plan}
    taken, edge = dict.fromkeys(targets, 0), dict.fromkeys(targets, 0)
    for r in drawn:
        taken[r["source"]] += size[r["doc_id"]]
    for r in plan:
        edge[r["source"]] = max([edge[r["source"]]] + [r["size"] for d in r["draws"] if d["words"] < r["size"]])
    assert all(abs(taken[s] - targets[s]) <= edge[s] / 2 + 1 for s in targets)


def test_hypergeometric_has_the_right_mean_and_spread(spark):
    u = mixing.uniform(F.lit(1), F.col("id"))
    n = F.lit
    r = spark.range(4000).select(mixing.hypergeometric(n(1000), n(300), n(200), u).alias("k")).agg(F.avg("k"), F.stddev("k")).first()
    assert r[0] == pytest.approx(60, abs=0.5) and r[1] == pytest.approx((200 * 0.3 * 0.7 * 800 / 999) ** 0.5, rel=0.1)


def test_shards_lie_in_one_partition_in_order_of_place(spark):
    rows = [(k, "abc"[k % 3], f"w{k} " * (1 + k % 30)) for k in range(300)]
    planned = mixing.plan_mix(spark.createDataFrame(rows, "doc_id long, source string, text string"), shard_words=500).cache()
    drawn = mixing.mixed_rows(planned)
    got = mixing.in_shards(drawn).select(F.spark_partition_id().alias("part"), "shard", "place", "doc_id").collect()
    assert sorted((r["shard"], r["place"]) for r in got) == sorted((r["shard"], r["place"]) for r in drawn.collect())
    parts = {}
    for r in got:
        parts.setdefault(r["part"], []).append((r["shard"], r["place"], r["doc_id"]))
    assert len({r["shard"] for r in got}) > 5
    assert all(p == sorted(p) for p in parts.values())
    assert sum(len({s for s, *_ in p}) for p in parts.values()) == len({r["shard"] for r in got})


def test_mix_of_nothing_and_of_empty_texts(spark):
    assert mixing.plan_mix(spark.createDataFrame([], "doc_id long, source string, text string")).count() == 0
    rows = mixing.plan_mix(spark.createDataFrame([(1, "a", None), (2, None, "")], "doc_id long, source string, text string")).collect()
    assert [(r["size"], r["draws"]) for r in rows] == [(0, []), (0, [])]


def test_leaks(spark):
    item = "What is the tall thing that stands by the old harbour of the northern town? It is the white lighthouse built by sailors."
    items = spark.createDataFrame([(1, item, 0), (2, "Other words make another question entirely here. An answer.", 0), (3, None, 0), (4, item, 0)], "item_id long, text string, score int")
    noise = " ".join(f"n{i}" for i in range(700))
    docs = [(1, noise + " " + item + " " + noise), (2, noise), (3, item.upper()), (4, item.split("?")[0]), (5, None), (6, ""), (7, "the of that is it by")]
    got = decontaminate.leaks(spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int"), items)
    assert sorted((r["doc_id"], r["item_id"]) for r in got.collect()) == [(1, 1), (1, 4), (3, 1), (3, 4)]
    parts = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), items, decontaminate.Bounds(items_per_pass=1))
    assert sorted((r["doc_id"], r["item_id"]) for r in parts.collect()) == [(1, 1), (1, 4), (3, 1), (3, 4)]
    assert decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), items.where("false")).count() == 0


def test_near_copies_of_items_with_short_answers_are_leaks(spark):
    question = "What is the tall thing that stands by the old harbour of the northern town and shines at night?"
    answers = ["Lighthouse.", "A lighthouse.", "The white lighthouse.", "It is a lighthouse.", "It is the white lighthouse built by sailors."]
    items = [(k, f"{question} {a}") for k, a in enumerate(answers)]
    docs, wanted = [], set()
    for k, text in items:
        w = text.split(" ")
        for i in range(len(w)):
            wanted.add((len(docs), k))
            docs.append((len(docs), " ".join([*w[:i], "changed", *w[i + 1 :]])))
    wanted.add((len(docs), 0))
    docs.append((len(docs), question))
    wanted_not = len(docs)
    docs.append((wanted_not, " ".join(question.split(" ")[:9])))
    got = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    found = {(r["doc_id"], r["item_id"]) for r in got.collect()}
    assert wanted <= found and wanted_not not in {d for d, _ in found}


def test_search_equals_full_scoring():
    rng = np.random.default_rng(2)
    names = [f"w{int(k)}" for k in rng.zipf(1.4, 4000) % 500]
    texts = [" ".join(names[20 * i : 20 * i + 15]) + ". " + " ".join(names[20 * i + 15 : 20 * i + 20]) for i in range(150)]
    rows = [{"item_id": i, "text": t, "question": t.split(". ")[0], "answer": t.split(". ")[1]} for i, t in enumerate(texts)]
    words = decontaminate.hashes_of(texts)
    df = {}
    for w in words:
        for x in np.unique(w).view(np.int64).tolist():
            df[x] = df.get(x, 0) + 1
    p = decontaminate.Bounds(share=0.4, question=0, answer=0, items_per_block=7)
    index = decontaminate.build(rows, df, len(rows), float(np.mean([len(w) for w in words])), p)
    docs = decontaminate.hashes_of([" ".join(rng.choice(names, 40)) + " " + t for t in texts[:40]])
    first = np.cumsum([0, *map(len, docs)])
    got = decontaminate.search(np.concatenate(docs), first, index, 64, p)
    full = set()
    for d, w in enumerate(docs):
        score = np.zeros(len(rows))
        for k, t in enumerate(index.term):
            if t in w:
                score[index.item[index.cut[k] : index.cut[k + 1]]] += index.weight[index.cut[k] : index.cut[k + 1]]
        full |= {(d, int(i)) for i in np.flatnonzero(score >= p.share)}
    assert set(got) == full and len(full) >= 40


def test_toxicity_on_rows_it_has_not_seen(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op10_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    rows = got.select("score", "predicted", "toxic").toPandas()
    rank, yes = rows.score.rank(), rows.toxic == 1
    auc = (rank[yes].mean() - (yes.sum() + 1) / 2) / (~yes).sum()
    assert auc > 0.93 and (rows.predicted == rows.toxic).mean() > 0.95


def test_thresholds_come_from_all_labelled_rows_in_their_true_mix(spark):
    rng = np.random.default_rng(4)
    rows = []
    for k in range(1500):
        toxic = int(k % 25 == 0)
        vile = rng.random() < (0.8 if toxic else 0.1)
        rows.append((k, ["en", "es"][k % 50 == 0 or k % 7 == 0], " ".join(rng.choice(["a", "b", "c", "d"], 20)) + (" vile" if vile else ""), toxic))
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, lang string, text string").repartition(4)
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    fitted = toxicity.train(docs, labels, toxicity.Settings(positives=30, negatives=50, epochs=3))
    held = {r[0] for r in labels.select("doc_id", toxicity.held_out(F.col("doc_id"))).collect() if r[1]}
    for lang in ("en", "es"):
        known = [r[3] for r in rows if r[0] not in held and r[1] == lang]
        assert fitted.counts[lang].sum(axis=1).tolist() == [known.count(0), known.count(1)]
        assert lang in fitted.thresholds


def test_best_cut_counts_rows():
    scores, labels = np.array([0.1, 0.32, 0.32, 0.6, 0.7, 0.96]), np.array([0, 0, 1, 0, 1, 1])
    counts = np.zeros((2, len(toxicity.CUTS) + 1), np.int64)
    np.add.at(counts, (labels, toxicity.cut_bin(scores)), 1)
    f1 = [2 * (labels[scores >= c]).sum() / ((scores >= c).sum() + 3) for c in toxicity.CUTS]
    cut = toxicity.best_cut(counts, 0.5)
    assert 2 * labels[scores >= cut].sum() / ((scores >= cut).sum() + 3) == pytest.approx(max(f1))


def test_toxicity_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, None), (2, "en", ""), (3, "en", "x " * 50000), (3, "en", "x"), (None, "de", "y z")], "doc_id long, lang string, text string")
    labels = spark.createDataFrame([(1, 1), (2, None), (3, 0), (3, 0)], "doc_id long, toxic int")
    for known in (labels, labels.where("false")):
        rows = toxicity.score(docs, toxicity.train(docs, known)).collect()
        assert len(rows) == 5 and all(0 <= r["score"] <= 1 for r in rows)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before, columns = docs.count(), docs.columns
    for name, stage in corpus_pipeline.STAGES[:4]:
        path = scratch(spark, "test-stage")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns, name
        assert 0 < docs.count() <= 2 * before
    found = decontaminate.leaks(docs, spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert found.count() == 0
    last = corpus_pipeline.STAGES[4][1](spark, docs, SF)
    assert last.count() == docs.count() and last.agg(F.sum("n_tokens")).first()[0] > 0
