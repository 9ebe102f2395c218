"""Runs that take up new files only, tables that are swapped, and files that are too large to be one body."""

import pytest
from pyspark.sql import functions as F

from pulseframe.operators.quality import SILVER_RULES
from pulseframe.plans import incremental
from pulseframe.plans.incremental import SINKS, Bookmark, run_new_files
from pulseframe.schema import raw_schema
from pulseframe.session import scratch
from pulseframe.sources.files import read_requests
from pulseframe.sources.sinks import swap_table


class Killed(Exception):
    pass


def deliver(spark, path, first, last, mode="append"):
    rows = spark.range(first, last)
    level = F.lit("LOW")
    filled = {f.name: F.lit("1") for f in raw_schema()} | {"Sex": F.lit("M"), "Age": (30 + F.col("id") % 40).cast("string"), "Blood Pressure (mmHg)": F.lit("120/80"), "CVD Risk Level": level}
    names = [f.name for f in raw_schema()]
    rows.select(*[filled[c].alias(c) for c in names], F.col("id").cast("string").alias("k")).write.mode(mode).option("header", "true").csv(path)


@pytest.mark.parametrize("step", ["manifest", *SINKS])
def test_a_killed_run_is_done_again(spark, step):
    path, root, schema = scratch(spark, "in"), scratch(spark, "out"), raw_schema().add("k", "string")
    deliver(spark, path, 0, 20)

    def dies(done):
        if done == step:
            raise Killed

    with pytest.raises(Killed):
        run_new_files(spark, path, root, schema, ("k",), reached=dies)
    assert Bookmark(root).committed(spark) == [] and Bookmark(root).unfinished(spark) == 1
    with pytest.raises(FileNotFoundError):
        Bookmark(root).read(spark, "silver")
    deliver(spark, path, 20, 30)  # comes before the restart: the restarted run keeps to its own files
    assert run_new_files(spark, path, root, schema, ("k",)) == 1
    assert run_new_files(spark, path, root, schema, ("k",)) == 2
    assert run_new_files(spark, path, root, schema, ("k",)) is None
    mark = Bookmark(root)
    seen = [r["k"] for s in ("silver", "rejected") for r in mark.read(spark, s).select("k").collect()]
    assert sorted(map(int, seen)) == list(range(30)) and mark.committed(spark) == [1, 2]
    assert mark.read(spark, "outcomes").agg(F.max("total")).first()[0] == 20


def test_a_run_goes_on_where_the_last_start_died(spark, monkeypatch):
    """Finished steps are done once; a start under other rules does all of them."""
    path, root, schema, written, parsed = scratch(spark, "in"), scratch(spark, "out"), raw_schema().add("k", "string"), [], []
    deliver(spark, path, 0, 20)
    plain, plain_do = incremental.write_parquet, Bookmark.do
    monkeypatch.setattr(incremental, "write_parquet", lambda df, to: written.append(to.split("/")[-2]) or plain(df, to))
    monkeypatch.setattr(Bookmark, "do", lambda self, spark, run, step, *more: parsed.append(step) or plain_do(self, spark, run, step, *more))

    def dies_at(step):
        def reached(done):
            if done == step:
                raise Killed

        return reached

    for step in ("silver", "rejected"):
        with pytest.raises(Killed):
            run_new_files(spark, path, root, schema, ("k",), reached=dies_at(step))
    assert written == ["silver", "rejected"] and parsed == ["typed", "medians", "silver", "rejected"]
    fewer = SILVER_RULES[:-2]
    with pytest.raises(Killed):
        run_new_files(spark, path, root, schema, ("k",), rules=fewer, reached=dies_at("silver"))
    assert written == ["silver", "rejected", "silver"]
    assert run_new_files(spark, path, root, schema, ("k",), rules=fewer) == 1
    assert written == ["silver", "rejected", "silver", "rejected", "outcomes"]
    mark = Bookmark(root)
    assert sorted(int(r["k"]) for s in ("silver", "rejected") for r in mark.read(spark, s).select("k").collect()) == list(range(20))
    assert mark.read(spark, "outcomes").count() == len(fewer) + 1


def test_a_step_that_broke_off_is_done_again(spark):
    """The record of a step goes before its rows do."""
    mark, out = Bookmark(scratch(spark, "out")), []
    mark.do(spark, 1, "silver", "a", lambda: out.append(1))
    assert mark.finished(spark, 1, "a") == {"silver"} and mark.finished(spark, 1, "b") == set() == mark.finished(spark, 2, "a")

    def breaks():
        raise Killed

    with pytest.raises(Killed):
        mark.do(spark, 1, "silver", "b", breaks)
    assert mark.finished(spark, 1, "a") == set()


def test_a_failing_write_leaves_the_table(spark):
    name, root = "swapped_rows", scratch(spark, "table")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df = spark.range(10).withColumn("v", F.lit("a"))
    first = swap_table(df, name, root)
    with pytest.raises(Exception, match="broken"):
        swap_table(df.withColumn("v", F.when(F.col("id") == 7, F.raise_error(F.lit("broken")).cast("string")).otherwise("b")), name, root)
    assert {r["v"] for r in spark.table(name).collect()} == {"a"}
    started = spark.read.parquet(first)
    swap_table(df.withColumn("v", F.lit("c")).withColumn("more", F.lit(1)), name, root)
    assert spark.table(name).columns == ["id", "v"] and {r["v"] for r in spark.table(name).collect()} == {"c"}
    assert started.count() == 10  # the version before is still there
    swap_table(df.limit(3), name, root)
    assert spark.table(name).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND|FILE_NOT_EXIST"):
        spark.read.parquet(first).count()
    spark.sql(f"DROP TABLE {name}")


def test_files_too_large_for_one_body_go_aside(spark):
    path = scratch(spark, "requests")
    body = '{"Sex":"M","Smoking Status":"Y","Diabetes Status":"N","Physical Activity Level":"Low","Family History of CVD":"N"}'
    spark.createDataFrame([(body,)], "value string").coalesce(1).write.text(f"{path}/small")
    spark.createDataFrame([(body,)] * 30, "value string").coalesce(1).write.text(f"{path}/large")
    both = f"{path}/*/*.txt"
    good, bad = read_requests(spark, both, multiline=True, largest=1000)
    assert good.count() == 1 and [r["reason"][:14] for r in bad.collect()] == ["the file has 3"]
    good, bad = read_requests(spark, both)
    assert good.count() == 31 and bad.count() == 0
