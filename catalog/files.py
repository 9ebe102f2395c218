"""Queries of the sources and sinks: data derived from the tables goes out and comes back whole."""

from __future__ import annotations

import contextlib
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import sqltext as S
from catalog.fixture import BRONZE_SQL, bronze, bronze_from, clinical, patients, table, with_patients
from catalog.registry import query
from catalog.repair import CUSTOMER_PASS, CUSTOMER_RULES, checked_customer
from pulseframe.functions.names import ref
from pulseframe.operators import quality as Q
from pulseframe.plans.etl import run_batch
from pulseframe.plans.incremental import Bookmark, run_new_files
from pulseframe.schema import CATEGORY_FEATURES, NUMERIC_FEATURES, raw_schema, request_schema
from pulseframe.session import scratch
from pulseframe.sources import files, sinks

CSV_WRITE = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


#: Rows of a derived text file (some 17 MB), and files that a stream's batch takes up at most.
FILE_ROWS = 100_000
BATCH_FILES = 24


def pieces_of(spark: SparkSession, sf: str, least: int, rows: int = FILE_ROWS) -> int:
    """Files that the derived records go to: more of them, not larger ones, as the table grows."""
    return max(least, -(-table(spark, sf, "orders").count() // rows))


def bronze_in(spark: SparkSession, sf: str, pieces: int) -> DataFrame:
    """The raw records in ``pieces`` partitions; only the keys they are derived from are dealt, not the records."""
    return bronze_from(table(spark, sf, "orders").select("o_orderkey").repartition(pieces))


def per_batch(pieces: int, batches: int, most: int = BATCH_FILES) -> int:
    """Files a batch of a stream takes up: ``batches`` batches, more where these would be large."""
    return min(most, -(-pieces // batches))


def bronze_csv(spark: SparkSession, sf: str, pieces: int | None = None, keep_id: bool = True) -> str:
    """The derived raw table as a directory of CSV files."""
    path = scratch(spark, "bronze")
    columns = [f.name for f in raw_schema()] + (["k"] if keep_id else [])
    raw = bronze_in(spark, sf, pieces or pieces_of(spark, sf, 4))
    raw.select(*map(ref, columns)).write.options(**CSV_WRITE).csv(path)
    return path


def bronze_schema():
    return raw_schema().add("k", "string")


@query("s1_bronze_csv", f"SELECT * FROM ({BRONZE_SQL})")
def s1(spark: SparkSession, sf: str) -> DataFrame:
    return files.read_bronze(spark, bronze_csv(spark, sf), bronze_schema()).drop(Q.CORRUPT)


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


@query("s3_parquet_scan", f"SELECT {S.names(ORDER_COLUMNS)}, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders")
def s3(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(*ORDER_COLUMNS, F.to_date("o_orderdate").alias("o_orderdate"))


PARTS_SQL = (
    "SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS o_orderstatus,"
    " CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS o_orderpriority FROM orders"
)


def order_parts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf, "orders")
    even = orders.filter("o_orderkey % 2 = 0").select("o_orderkey", "o_totalprice", "o_orderstatus")
    odd = orders.filter("o_orderkey % 2 = 1").select("o_totalprice", "o_orderkey", "o_orderpriority")
    return even, odd


@query("s4_parquet_parts", PARTS_SQL)
def s4(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "parts")
    for i, part in enumerate(order_parts(spark, sf)):
        part.write.parquet(f"{path}/part-{i}")
    return files.read_parts(spark, path)


@query("u1_union_by_name", PARTS_SQL)
def u1(spark: SparkSession, sf: str) -> DataFrame:
    return files.union_by_name(*order_parts(spark, sf))


@query(
    "s5_reject_sink",
    f"SELECT c_custkey, c_acctbal, 'Failed' AS outcome, {S.failed_text(CUSTOMER_RULES)} AS failed_rules FROM customer"
    f" WHERE NOT ({CUSTOMER_PASS})",
)
def s5(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "rejected")
    sinks.write_parquet(Q.failed_rows(checked_customer(spark, sf)), path)
    back = spark.read.parquet(path)
    return back.select(
        "c_custkey", "c_acctbal", ref(Q.OUTCOME).alias("outcome"), F.concat_ws(";", Q.FAILED_RULES).alias("failed_rules")
    )


@query(
    "s6_catalog_table",
    "SELECT c_custkey, c_name, c_acctbal FROM customer UNION ALL SELECT c_custkey + 1000000000, NULL, c_acctbal"
    " FROM customer WHERE c_acctbal > 0",
)
def s6(spark: SparkSession, sf: str) -> DataFrame:
    """A first write sets the table's layout; a later one with drifted columns is fitted to it."""
    name, path = f"customers_{uuid.uuid4().hex}", scratch(spark, "customers")
    customer = table(spark, sf, "customer")
    sinks.write_table(customer.select("c_custkey", "c_name", "c_acctbal"), name, path)
    drifted = customer.filter("c_acctbal > 0").select(
        (F.col("c_custkey") + 1_000_000_000).alias("c_custkey"), "c_acctbal", F.col("c_mktsegment").alias("segment")
    )
    sinks.write_table(drifted, name, path, mode="append")
    return spark.table(name)


@query("s7_catalog_sql", with_patients(
    "SELECT sex, lvl, count(*) AS n, round(avg(score), 6) AS mean_score FROM p WHERE systolic >= 130 GROUP BY sex, lvl"))
def s7(spark: SparkSession, sf: str) -> DataFrame:
    name = f"patient_data_{uuid.uuid4().hex}"
    sinks.write_table(patients(spark, sf), name, scratch(spark, "patient-data"))
    return spark.sql(
        f"SELECT sex, lvl, count(*) AS n, round(avg(score), 6) AS mean_score FROM {name} WHERE systolic >= 130"
        " GROUP BY sex, lvl"
    )


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """One request per patient: mostly objects, some arrays of two, some unreadable, some of another type."""
    known = clinical(spark, sf)
    one = F.to_json(F.struct(*map(ref, NUMERIC_FEATURES + CATEGORY_FEATURES)))
    other = F.to_json(
        F.struct(F.lit(50.0).alias("Age"), *map(ref, NUMERIC_FEATURES[1:] + CATEGORY_FEATURES))
    )
    body = (
        F.when(F.col("k") % 7 == 1, F.lit("oops"))
        .when(F.col("k") % 3 == 0, F.concat(F.lit("["), one, F.lit(", "), other, F.lit("]")))
        .otherwise(one)
    )
    kind = F.when(F.col("k") % 13 == 0, F.lit("text/plain")).otherwise(F.lit("application/json"))
    return known.select("k", body.alias("body"), kind.alias("content_type"))


REQUEST_SQL = 'k, CAST(age AS DOUBLE) AS "Age", bmi AS "BMI", CAST(hdl AS DOUBLE) AS "HDL (mg/dL)", sex AS "Sex"'


@query("s9_x15_json_requests", with_patients(
    f"SELECT {REQUEST_SQL} FROM p WHERE k % 13 <> 0 AND k % 7 <> 1 UNION ALL SELECT {REQUEST_SQL} FROM"
    " (SELECT * REPLACE (50 AS age) FROM p) WHERE k % 13 <> 0 AND k % 7 <> 1 AND k % 3 = 0"))
def s9(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = files.parse_requests(requests(spark, sf), "body", "content_type")
    return good.select("k", "Age", "BMI", "`HDL (mg/dL)`", "Sex")


@query("s9_bad_requests", with_patients(
    "SELECT k, CASE WHEN k % 13 = 0 THEN 'unsupported content type: text/plain' ELSE"
    " 'body is no JSON object or array' END AS reason FROM p WHERE k % 13 = 0 OR k % 7 = 1"))
def s9_bad(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = files.parse_requests(requests(spark, sf), "body", "content_type")
    return bad.select("k", "reason")


MALFORMED_SQL = f"SELECT * FROM ({BRONZE_SQL}) WHERE CAST(k AS BIGINT) % 5 <> 0"


# A line is one cell that is written as it is.
LINE_WRITE = CSV_WRITE | {"quote": "", "sep": "\x01"}


def malformed_csv(spark: SparkSession, sf: str, pieces: int | None = None) -> str:
    """The raw records as lines of text, of which every fifth has fields too few or two too many."""
    path = scratch(spark, "malformed")
    raw = bronze_in(spark, sf, pieces or pieces_of(spark, sf, 4))
    names = [f.name for f in raw_schema()]
    cells = [F.coalesce(F.concat(F.lit('"'), ref(c), F.lit('"')), F.lit("")) for c in names]
    line = F.concat_ws(",", *cells)
    key = F.col("k").cast("bigint")
    text = F.when(key % 10 == 0, F.concat(F.lit("M,40,garbage-"), F.col("k"))).when(key % 5 == 0, F.concat(line, F.lit(",x,y"))).otherwise(line)
    header = ",".join(f'"{c}"' for c in names)
    raw.select(text.alias(header)).write.options(**LINE_WRITE).csv(path)
    return path


@query("s1_malformed_lines", f"SELECT * EXCLUDE (k), FALSE AS malformed FROM ({MALFORMED_SQL}) UNION ALL"
       f" SELECT {', '.join('NULL' for _ in raw_schema())}, TRUE FROM ({BRONZE_SQL}) WHERE CAST(k AS BIGINT) % 5 = 0")
def s1_malformed(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with too many or too few fields are told apart, also where few columns are read."""
    read = files.read_bronze(spark, malformed_csv(spark, sf))
    bad = ref(Q.CORRUPT).isNotNull()
    return read.select(*[F.when(~bad, ref(f.name)).alias(f.name) for f in raw_schema()], bad.alias("malformed"))


MALFORMED_FILL = (
    f"WITH bronze AS ({MALFORMED_SQL}), typed AS ({S.TYPED_SELECT} FROM bronze), {S.clinical_fill('typed')} "
)
MALFORMED_PARTS = MALFORMED_FILL + (
    f"SELECT 'passed' AS part, count(*) AS n, round(sum(\"BMI\"), 6) AS bmi FROM filled WHERE {S.SILVER_PASS} UNION ALL"
    f" SELECT 'rejected', (SELECT count(*) FROM orders) - (SELECT count(*) FROM filled WHERE {S.SILVER_PASS}), NULL"
)


def parts_of(silver: DataFrame, rejected: DataFrame) -> DataFrame:
    passed = silver.agg(F.lit("passed").alias("part"), F.count(F.lit(1)).alias("n"), F.round(F.sum("BMI"), 6).alias("bmi"))
    return passed.unionByName(rejected.agg(F.lit("rejected").alias("part"), F.count(F.lit(1)).alias("n"), F.lit(None).cast("double").alias("bmi")))


@query("q7_batch_run_malformed", MALFORMED_PARTS)
def batch_malformed(spark: SparkSession, sf: str) -> DataFrame:
    """Passed and rejected rows are all lines; the medians come from well-formed ones."""
    out = run_batch(spark, malformed_csv(spark, sf), scratch(spark, "batch"), exact=True)
    return parts_of(out["silver"], out["rejected"])


@query("a4_a7_non_finite_parquet", "SELECT count(x) AS n, round(avg(x), 6) AS mean, round(corr(x, y), 6) AS r FROM (SELECT"
       " CASE WHEN o_orderkey % 7 > 2 THEN CAST(o_totalprice AS DOUBLE) END AS x, CAST(o_custkey AS DOUBLE) AS y FROM orders)")
def non_finite(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "non-finite")
    price, odd = F.col("o_totalprice").cast("double"), F.col("o_orderkey") % 7
    spoilt = F.when(odd == 0, F.lit(float("nan"))).when(odd == 1, F.lit(float("inf"))).when(odd == 2, F.lit(float("-inf"))).otherwise(price)
    table(spark, sf, "orders").select(spoilt.alias("x"), F.col("o_custkey").cast("double").alias("y")).write.parquet(path)
    return files.read_parts(spark, path).agg(
        F.count("x").alias("n"), F.round(F.avg("x"), 6).alias("mean"), F.round(F.corr("x", "y"), 6).alias("r")
    )


BODIES = {
    0: ("oops{", "body is no JSON object or array"), 1: ("[null]", "an element is null"), 2: ('{"Age":"abc"}', "Age is no number"),
    3: ("{}", "Sex is missing"), 4: ("[]", "the array is empty"), 5: ('{"Age":1.0} trailing', "body is no JSON object or array"),
}


def odd_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """A request per patient; those with k % 11 below six have one of the bodies that cannot be used."""
    good = clinical(spark, sf).select("k", F.to_json(F.struct(*map(ref, NUMERIC_FEATURES + CATEGORY_FEATURES))).alias("body"))
    body = F.col("body")
    for k, (text, _) in BODIES.items():
        body = F.when(F.col("k") % 11 == k, F.lit(text)).otherwise(body)
    return good.select("k", body.alias("body"))


BAD_REASON_SQL = "CASE " + " ".join(f"WHEN k % 11 = {k} THEN '{reason}'" for k, (_, reason) in BODIES.items()) + " END"


@query("s9_bad_files", with_patients(
    f"SELECT {BAD_REASON_SQL} AS reason, count(*) AS n FROM p WHERE k % 11 < 6 GROUP BY ALL"
    " UNION ALL SELECT 'good', count(*) FROM p WHERE k % 11 >= 6"))
def s9_bad_files(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "bodies")
    odd_bodies(spark, sf).select("body").write.text(path)
    good, bad = files.read_requests(spark, path, multiline=False)
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).unionByName(
        good.agg(F.lit("good").alias("reason"), F.count(F.lit(1)).alias("n"))
    )


@query("s9_json_files", with_patients(f"SELECT {REQUEST_SQL} FROM p"))
def s9_files(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "requests")
    sinks.write_json(clinical(spark, sf).select("k", *map(ref, NUMERIC_FEATURES + CATEGORY_FEATURES)), path)
    schema = request_schema().add("k", "long")
    return files.read_requests(spark, path, schema, multiline=False)[0].select(
        "k", "Age", "BMI", "`HDL (mg/dL)`", "Sex"
    )


@query("s10_json_results", with_patients(
    "SELECT '{\"k\":' || CAST(k AS VARCHAR) || ',\"lvl\":\"' || lvl || '\"' || coalesce(',\"score\":' ||"
    " CAST(round(score, 2) AS VARCHAR), '') || '}' AS result FROM p"))
def s10(spark: SparkSession, sf: str) -> DataFrame:
    df = patients(spark, sf).select("k", "lvl", F.bround("score", 2).alias("score"))
    return sinks.to_json_results(df, ["k", "lvl", "score"])


@query("s11_published_outcomes", " UNION ALL ".join(
    f"SELECT *, '{run}' AS run_id FROM ({S.outcomes_sql('customer', CUSTOMER_RULES, 5)})" for run in ("one", "two")))
def s11(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "outcomes")
    outcomes = Q.rule_outcomes(table(spark, sf, "customer"), CUSTOMER_RULES)
    for run in ("one", "two", "two"):
        sinks.publish_outcomes(outcomes, path, run)
    return spark.read.parquet(path)


@query("s2_incremental_csv", f"SELECT * FROM ({BRONZE_SQL})")
def s2(spark: SparkSession, sf: str) -> DataFrame:
    """Two deliveries and three runs: each file is taken up once."""
    landing, out, log = scratch(spark, "landing"), scratch(spark, "taken"), scratch(spark, "progress")
    raw = bronze(spark, sf)
    schema = raw.schema

    def run() -> None:
        stream = files.stream_bronze(spark, landing, schema).drop(Q.CORRUPT)
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", log).trigger(
            availableNow=True
        ).start().awaitTermination()

    for half in (0, 1):
        part = raw.filter(F.col("k").cast("bigint") % 2 == half)
        part.write.mode("append").options(**CSV_WRITE).csv(landing)
        run()
    run()
    return spark.read.parquet(out)


@query("q7_batch_run_silver", S.bronze_filled(f"SELECT {S.names(S.SILVER_COLUMNS)} FROM filled WHERE {S.SILVER_PASS}"))
def batch_silver(spark: SparkSession, sf: str) -> DataFrame:
    """The whole batch job, from CSV files to the silver table."""
    out = run_batch(spark, bronze_csv(spark, sf, keep_id=False), scratch(spark, "batch"), exact=True)
    return out["silver"]


class Killed(Exception):
    """Stands for a run that dies."""


def dies_after(step: str):
    def reached(done: str) -> None:
        if done == step:
            raise Killed(step)

    return reached


@query("s2_q7_killed_run_silver", S.bronze_filled(f"SELECT k, {S.names(S.SILVER_COLUMNS)} FROM filled WHERE {S.SILVER_PASS}"))
def killed_run(spark: SparkSession, sf: str) -> DataFrame:
    """A run that dies between its sinks and is started again gives the rows of one clean run."""
    path, root = bronze_csv(spark, sf), scratch(spark, "bookmarked")
    for step in ("manifest", "silver", "rejected"):
        with contextlib.suppress(Killed):
            run_new_files(spark, path, root, bronze_schema(), ("k",), exact=True, reached=dies_after(step))
    run_new_files(spark, path, root, bronze_schema(), ("k",), exact=True)
    return Bookmark(root).read(spark, "silver")


@query("s2_bookmarked_deliveries", with_patients(
    "SELECT CAST(k AS VARCHAR) AS k, CASE WHEN k % 3 = 0 THEN 2 ELSE 1 END AS run FROM p"))
def bookmarked(spark: SparkSession, sf: str) -> DataFrame:
    """Two deliveries and three starts: each row is taken up once, by the run that its file came with."""
    path, root = scratch(spark, "deliveries"), scratch(spark, "bookmarked")
    raw = bronze(spark, sf).select(*map(ref, bronze_schema().names))
    runs = []
    for first, mode in ((True, "error"), (False, "append")):
        raw.filter((F.col("k").cast("long") % 3 > 0) == first).write.mode(mode).options(**CSV_WRITE).csv(path)
        runs += [run_new_files(spark, path, root, bronze_schema(), ("k",)) for _ in range(2)]
    assert runs == [1, None, 2, None]
    sinks_of = [spark.read.parquet(f"{root}/{s}/run={r}").select("k", F.lit(r).alias("run")) for s in ("silver", "rejected") for r in (1, 2)]
    return reduce(DataFrame.unionByName, sinks_of)


@query("s6_swapped_table", "SELECT c_custkey, c_name, c_acctbal, (SELECT count(*) FROM customer WHERE c_custkey % 2 = 0) AS seen_after_failure FROM customer")
def s6_swapped(spark: SparkSession, sf: str) -> DataFrame:
    """Rows are replaced as one step; a write that fails midway leaves the old ones."""
    name, root = f"customers_{uuid.uuid4().hex}", scratch(spark, "customers")
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    sinks.swap_table(customer.filter("c_custkey % 2 = 0"), name, root)
    broken = customer.withColumn("c_name", F.when(F.col("c_custkey") % 97 == 13, F.raise_error(F.lit("broken")).cast("string")).otherwise(F.col("c_name")))
    with contextlib.suppress(Exception):
        sinks.swap_table(broken, name, root)
    seen = spark.table(name).count()
    sinks.swap_table(customer, name, root)
    return spark.table(name).withColumn("seen_after_failure", F.lit(seen).cast("long"))


@query("q6_batch_run_outcomes", S.bronze_filled(
    f"SELECT *, 'night' AS run_id FROM ({S.outcomes_sql('filled', Q.SILVER_RULES, 35)} UNION ALL"
    " SELECT 'WellFormedLine', 'Passed', CAST(0 AS BIGINT), count(*) FROM filled)"))
def batch_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    path = bronze_csv(spark, sf, keep_id=False)
    out = run_batch(
        spark, path, scratch(spark, "batch"), table=f"patient_data_{uuid.uuid4().hex}", run_id="night", exact=True
    )
    return out["outcomes"]


