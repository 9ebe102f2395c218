"""Mix sources to target weights by a splitting tree.

Documents of a source fall into blocks by hash; the blocks of a source stand in a keyed random order. A source's target words
are whole passes over its blocks plus a prefix of that order, so that each source has an exact quota of block draws. A binary
tree over the output shards then splits all quotas at once: at a node, the draws of the left half are a multivariate
hypergeometric sample of the node's, so every shard holds a random share of each source and the shares add up to the quotas.
A shard's share of a source is the next run of that source's draws: runs are disjoint. Order inside a shard is by hash.

All of it is column expressions and joins. Running sums over the blocks of a source are taken in two levels (hash ranges, then
blocks inside a range), so that a source that holds most rows does not meet in one task. Randomness is a hash of the
seed and of what is drawn, so reruns agree. Sources are the recipe's: their table, one row each, is what the tree's rows carry.

Defined cases: null text has size 0; a null source is a source of its own, the last in order; documents of size 0 take
nothing; repeated rows are separate documents; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseframe.llm.exprs import add_columns, let, n_words, partitions
from pulseframe.session import pin

RANGES = 4096
SPREAD = 12.0
SPLIT_NODES_FROM = 10


def source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def targets(sized: DataFrame, weights: list[float], share: float, cap: float) -> DataFrame:
    """One row per source: order ``sid``, size, and target words.

    Sources by code point, null last, get ``weights`` in turn. Targets are in proportion to weight up to ``cap`` times the
    source's size; what that cuts off goes to the others by weight. In order of cap over weight, the sources that reach
    their cap come first, and each is known from the sums before it.
    """
    per = sized.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("sid", F.row_number().over(by_name) - 1)
    per = per.withColumn("weight", F.get(F.array(*map(F.lit, map(float, weights))), F.col("sid") % len(weights)))
    per = per.withColumn("most", F.col("source_size") * F.lit(float(cap)))
    whole = Window.orderBy(F.col("most") / F.col("weight"), "sid")
    everything = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumns({
        "budget": F.lit(float(share)) * F.sum("source_size").over(everything),
        "before": F.coalesce(F.sum("most").over(whole.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "open_weight": F.sum("weight").over(whole.rowsBetween(0, Window.unboundedFollowing)),
    })
    per = per.withColumn("full", F.col("most") * F.col("open_weight") <= F.col("weight") * (F.col("budget") - F.col("before")))
    held = F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))).over(everything), F.lit(0.0))
    left = F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    level = (F.col("budget") - held) / left
    target = F.when(F.col("full"), F.col("most")).otherwise(F.col("weight") * level)
    return per.select("key", "sid", "source_size", target.alias("target"))


def block_order(sized: DataFrame, seed: int) -> DataFrame:
    """Blocks with ``rank`` and ``words_before`` in their source's random order."""
    blocks = sized.groupBy("key", "block").agg(F.sum("size").alias("words"))
    blocks = pin(blocks.withColumn("draw", F.xxhash64("key", "block", F.lit(seed))).withColumn("range", F.shiftrightunsigned("draw", 52)))
    ranges = blocks.groupBy("key", "range").agg(F.sum("words").alias("w"), F.count("*").alias("n"))
    before = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("key", "range", F.coalesce(F.sum("w").over(before), F.lit(0)).alias("w0"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"))
    inside = Window.partitionBy("key", "range").orderBy("draw", "block")
    earlier = F.coalesce(F.sum("words").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = blocks.withColumns({"r": F.row_number().over(inside) - 1, "e": earlier}).join(ranges, ["key", "range"])
    return placed.select("key", "block", "words", (F.col("r") + F.col("n0")).alias("rank"), (F.col("e") + F.col("w0")).alias("words_before"))


def uniform(*parts: Column) -> Column:
    return (F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) + 0.5) / float(1 << 52)


def hypergeometric(total: Column, good: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` out of ``total``, of which ``good`` count, count: the inverse of the distribution at ``u``.

    Weights relative to the first value follow from the ratio of neighbours. Values further than ``SPREAD`` standard
    deviations from the mean have a chance below 1e-30 and are left out.
    """
    t, g, d = total.cast("double"), good.cast("double"), drawn.cast("double")
    mean = d * g / t
    sd = F.sqrt(d * g * (t - g) * (t - d) / (t * t * F.greatest(t - 1, F.lit(1.0))))
    least = F.greatest(F.lit(0.0), d - (t - g), F.floor(mean - SPREAD * sd - 2)).cast("long")
    most = F.least(g, d, F.ceil(mean + SPREAD * sd + 2).cast("double")).cast("long")

    def ratio(k: Column) -> Column:
        return (g - k) * (d - k) / ((k + 1) * (t - g - d + k + 1))

    def draw(ks: Column) -> Column:
        one = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("above"))
        total_weight = F.aggregate(ks, one, lambda a, k: F.struct(
            (a["w"] * ratio(k.cast("double"))).alias("w"), (a["sum"] + a["w"]).alias("sum"), a["above"].alias("above")))["sum"]
        return let(total_weight * u, lambda goal: F.aggregate(ks, one, lambda a, k: F.struct(
            (a["w"] * ratio(k.cast("double"))).alias("w"), (a["sum"] + a["w"]).alias("sum"),
            (a["above"] + F.when(a["sum"] + a["w"] < goal, 1).otherwise(0)).alias("above")))["above"])

    sampled = let(F.sequence(least, most), lambda ks: F.element_at(ks, 1) + F.least(draw(ks), F.size(ks) - 1))
    return F.when(least >= most, least).otherwise(sampled).cast("long")


def split_tree(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(sid, shard, start, n): shard ``shard`` takes draws ``start`` to ``start + n - 1`` of source ``sid``."""
    listed = F.sort_array(F.collect_list(F.struct("sid", "quota")))
    root = quotas.groupBy().agg(F.transform(listed, lambda x: x["quota"]).alias("quota"))
    all_draws = F.aggregate("quota", F.lit(0).cast("long"), lambda a, x: a + x)
    zero = F.lit(0).cast("long")
    nodes = root.select(
        zero.alias("lo"), F.lit(shards).cast("long").alias("hi"), "quota",
        F.transform("quota", lambda _: zero).alias("start"), all_draws.alias("all"),
    )

    def edge(shard: Column) -> Column:
        return F.floor(F.col("all") * shard / F.lit(shards)).cast("long")

    for depth in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        if depth == SPLIT_NODES_FROM:
            nodes = nodes.repartition(partitions(quotas.sparkSession), "lo")
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("long")
        state = F.struct(
            F.aggregate("quota", zero, lambda a, x: a + x).alias("total"), (edge(mid) - edge(F.col("lo"))).alias("drawn"),
            F.array().cast("array<bigint>").alias("left"),
        )

        def step(a: Column, q: Column) -> Column:
            u = uniform(F.lit(seed), F.col("lo"), F.col("hi"), F.size(a["left"]))
            some = F.when(a["drawn"] * q == 0, zero).otherwise(hypergeometric(a["total"], q, a["drawn"], u))
            return let(some, lambda k: F.struct(
                (a["total"] - q).alias("total"), (a["drawn"] - k).alias("drawn"), F.concat(a["left"], F.array(k)).alias("left")))

        leaf = F.col("hi") - F.col("lo") <= 1
        nodes = nodes.withColumn("left", F.when(leaf, F.col("quota")).otherwise(F.aggregate("quota", state, step)["left"]))
        first = F.struct(F.col("lo").alias("lo"), F.when(leaf, F.col("hi")).otherwise(mid).alias("hi"), F.col("left").alias("quota"), F.col("start").alias("start"))
        second = F.struct(
            mid.alias("lo"), F.col("hi").alias("hi"), F.zip_with("quota", "left", lambda q, k: q - k).alias("quota"),
            F.zip_with("start", "left", lambda s, k: s + k).alias("start"))
        halves = F.when(leaf, F.array(first)).otherwise(F.array(first, second))
        nodes = nodes.select("all", F.explode(halves).alias("node")).select("all", "node.*")
    shares = nodes.select(F.col("lo").alias("shard"), F.posexplode(F.arrays_zip("quota", "start")).alias("sid", "x"))
    return shares.select("sid", "shard", F.col("x.start").alias("start"), F.col("x.quota").alias("n")).where("n > 0")


def plan_mix(
    docs: DataFrame, weights: list[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: int = 17,
    source: str = "source", text: str = "text", doc_id: str = "doc_id", shard_words: int = 1 << 22, block_docs: int = 16,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``draws``: (copy, shard, words) of each time the mix takes it."""
    new = {"key": source_key(F.col(f"`{source}`")), "size": n_words(F.col(f"`{text}`")).cast("long")}
    slim = docs.select(F.col(f"`{source}`").alias("source"), F.col(f"`{text}`").alias("text"), F.col(f"`{doc_id}`").alias("doc_id"))
    total = slim.agg(F.count("*").alias("n")).first()["n"]
    ident = F.xxhash64(F.col("doc_id"), F.xxhash64("text"), F.lit(seed))
    block = F.pmod(ident, F.lit(max(1, total // block_docs)))
    # Sizes are counted once; later steps read the small table.
    sized = pin(slim.select("source", new["key"].alias("key"), new["size"].alias("size"), block.alias("block")))
    per = pin(targets(sized, list(weights), share, cap))
    goal = per.agg(F.sum("target").alias("t")).first()["t"] or 0.0
    shards = max(1, math.ceil(goal / shard_words))
    whole = F.when(F.col("source_size") > 0, F.floor(F.round("target") / F.col("source_size"))).otherwise(0).cast("long")
    per = per.withColumn("whole", whole).withColumn("rest", F.round("target").cast("long") - F.col("whole") * F.col("source_size"))
    blocks = pin(block_order(sized, seed).join(per.select("key", "sid", "whole", "rest"), "key"))
    extra = (F.col("words_before") < F.col("rest")).cast("int")
    counted = blocks.groupBy("sid").agg(
        F.count("*").alias("blocks"), (F.first("whole") * F.count("*") + F.sum(extra)).cast("long").alias("quota"))
    counted = pin(counted)
    runs = split_tree(counted.select("sid", "quota"), shards, seed)
    # Spark takes the exploded runs for as small as the runs are and would broadcast them; they are as many as the draws.
    slots = runs.select("sid", "shard", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("at"))
    draws = blocks.join(counted.select("sid", "blocks"), "sid").where(F.col("whole") + extra > 0)
    draws = draws.select("sid", "key", "block", "rank", "blocks", "whole", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") + extra - 1)).alias("copy"),
                         (F.col("rest") - F.col("words_before")).alias("room"))
    draws = draws.withColumn("at", F.col("copy") * F.col("blocks") + F.col("rank")).join(slots.hint("merge"), ["sid", "at"])
    limit = F.when(F.col("copy") < F.col("whole"), F.lit((1 << 62))).otherwise(F.col("room"))
    drawn = draws.groupBy("key", "block").agg(F.sort_array(F.collect_list(F.struct("copy", "shard", limit.alias("room")))).alias("drawn"))

    kept = {"mix_key": new["key"], "mix_block": F.pmod(F.xxhash64(F.col(f"`{doc_id}`"), F.xxhash64(F.col(f"`{text}`")), F.lit(seed)), F.lit(max(1, total // block_docs))), "mix_size": new["size"]}
    rows = add_columns(docs, kept)
    inside = Window.partitionBy("mix_key", "mix_block").orderBy(
        F.xxhash64(F.col(f"`{doc_id}`"), F.lit(seed + 1)), F.col(f"`{doc_id}`"), F.xxhash64(F.col(f"`{text}`")))
    rows = rows.withColumn("mix_before", F.coalesce(F.sum("mix_size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rows = rows.join(drawn.withColumnsRenamed({"key": "mix_key", "block": "mix_block"}), ["mix_key", "mix_block"], "left")
    rows = rows.join(per.select(F.col("key").alias("mix_key"), F.col("source_size").alias("mix_source"), F.col("target").alias("mix_target")), "mix_key")

    def take(x: Column) -> Column:
        room = F.greatest(F.lit(0), x["room"] - F.col("mix_before"))
        return F.struct(x["copy"].alias("copy"), x["shard"].alias("shard"), F.least(F.col("mix_size"), room).cast("long").alias("words"))

    taken = F.filter(F.transform(F.coalesce("drawn", F.array()), take), lambda x: x["words"] > 0)
    out = add_columns(rows, {"size": F.col("mix_size"), "source_size": F.col("mix_source"), "target": F.col("mix_target"), "draws": taken})
    return out.drop("mix_key", "mix_block", "mix_before", "mix_size", "mix_source", "mix_target", "drawn")


def whole_draws() -> Column:
    """``draws`` of whole documents only: one of a part, at the end of a source's target, is taken where half of the document
    or more is wanted, which is nearer to the target than leaving it, and else left."""
    near = F.filter("draws", lambda x: 2 * x["words"] >= F.col("size"))
    return F.transform(near, lambda x: x.withField("words", F.col("size")))


def mixed_rows(planned: DataFrame, text: str = "text", doc_id: str = "doc_id", seed: int = 17) -> DataFrame:
    """One row per draw of a whole document, with ``shard`` and ``place``, the sort key inside the shard."""
    names = [c for c in planned.columns if c not in ("size", "source_size", "target", "draws")]
    rows = planned.select(*names, F.explode(whole_draws()).alias("draw"))
    place = F.xxhash64(F.lit(seed), "draw.copy", F.col(f"`{doc_id}`"), F.col(f"`{text}`"))
    return rows.select(*[F.col(f"`{c}`") for c in names], F.col("draw.shard").alias("shard"), place.alias("place"))


def in_shards(rows: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``mixed_rows`` as the tree deals them: a shard lies in one partition, its rows in the order of their places.

    Written as it is, a file holds whole shards one after the other. A shard has a bounded number of words, so none is hot.
    """
    dealt = rows.repartition(partitions(rows.sparkSession), "shard")
    return dealt.sortWithinPartitions("shard", "place", F.col(f"`{doc_id}`"))
