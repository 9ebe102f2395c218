"""Queries of encoding, splitting, clustering, the risk model, and streams."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import sqltext as S
from catalog.files import FILE_ROWS, MALFORMED_PARTS, bronze_csv, bronze_schema, malformed_csv, odd_bodies, parts_of, per_batch, pieces_of
from catalog.fixture import bronze_from, clinical, patients, table, with_patients
from catalog.population import COHORT_SHORT, box_sql, welch_sql
from catalog.registry import query
from catalog.repair import typed_bronze
from pulseframe.functions.names import flag_name, ref
from pulseframe.operators import cohorts as C
from pulseframe.operators import encode as E
from pulseframe.operators import kmeans as K
from pulseframe.operators.mapping import apply_mapping, raw_mapping
from pulseframe.operators.quality import CORRUPT, SILVER_RULES, row_outcomes
from pulseframe.operators.risk import LEVEL_OUT, SCORE_OUT, RiskModel, Settings
from pulseframe.operators.stats import regression_metrics
from pulseframe.plans.etl import ClinicalFill, repair, route
from pulseframe.plans.report import model_tiles, write_report
from pulseframe.plans.requests import score_requests, what_if
from pulseframe.plans.training import ablation, hold_out_report, level_report, load_or_train, split_rows
from pulseframe.schema import CATEGORY_FEATURES, IMPUTED, LEVEL, NUMERIC_FEATURES, SCORE
from pulseframe.session import scratch
from pulseframe.sources.files import read_bronze, stream_bronze
from pulseframe.streaming.ingest import stream_to_silver, total_outcomes
from pulseframe.streaming.medians import MedianCounts
from pulseframe.streaming.scoring import score_stream

# ---- encoding and split ------------------------------------------------------------------------------------------

CATEGORIES = ["sex", "smk", "dbt", "act", "fam_or_none"]
HOLED_FAM = "(SELECT *, CASE WHEN k % 9 = 0 THEN NULL ELSE fam END AS fam_or_none FROM p)"


def code_sql(column: str) -> str:
    return (
        f"CAST(dense_rank() OVER (ORDER BY coalesce(CAST({column} AS VARCHAR), 'None')) - 1 AS INTEGER)"
        f" AS {column}__code"
    )


@query("m1_category_codes", with_patients(f"SELECT k, {', '.join(map(code_sql, CATEGORIES))} FROM {HOLED_FAM}"))
def m1(spark: SparkSession, sf: str) -> DataFrame:
    fam = F.when(F.col("k") % 9 == 0, None).otherwise(F.col("fam"))
    coded, _ = E.encode(patients(spark, sf).withColumn("fam_or_none", fam), CATEGORIES)
    return coded.select("k", *[f"{c}__code" for c in CATEGORIES])


@query("m1_codes_by_tables", with_patients(f"SELECT k, {', '.join(map(code_sql, CATEGORIES))} FROM {HOLED_FAM}"))
def m1_tables(spark: SparkSession, sf: str) -> DataFrame:
    fam = F.when(F.col("k") % 9 == 0, None).otherwise(F.col("fam"))
    coded, _ = E.encode_by_tables(patients(spark, sf).withColumn("fam_or_none", fam), CATEGORIES)
    return coded.select("k", *[F.col(f"{c}__code").cast("int").alias(f"{c}__code") for c in CATEGORIES])


@query("m1_codes_of_a_wide_column", f"SELECT p_partkey, {code_sql('p_name')} FROM part")
def m1_wide(spark: SparkSession, sf: str) -> DataFrame:
    """A column with about as many labels as rows: no list of them in the plan or on the driver."""
    coded, _ = E.encode_by_tables(table(spark, sf, "part"), ["p_name"])
    return coded.select("p_partkey", F.col("p_name__code").cast("int").alias("p_name__code"))


@query("m1_segment_codes", f"SELECT c_custkey, c_mktsegment, {code_sql('c_mktsegment')} FROM customer")
def m1_customer(spark: SparkSession, sf: str) -> DataFrame:
    coded, _ = E.encode(table(spark, sf, "customer"), ["c_mktsegment"])
    return coded.select("c_custkey", "c_mktsegment", "c_mktsegment__code")


@query("m2_target_codes", with_patients(
    "SELECT k, lvl, CASE lvl WHEN 'HIGH' THEN 0 WHEN 'INTERMEDIARY' THEN 1 ELSE 2 END AS lvl__code FROM p"))
def m2(spark: SparkSession, sf: str) -> DataFrame:
    coded, _ = E.encode(patients(spark, sf), ["lvl"])
    return coded.select("k", "lvl", "lvl__code")


@query("m3_decoded_target", with_patients("SELECT k, lvl AS decoded, lvl AS by_stage FROM p"))
def m3(spark: SparkSession, sf: str) -> DataFrame:
    coded, model = E.encode(patients(spark, sf), ["lvl"])
    labels = list(model.labelsArray[0])
    staged = E.decoder(labels, "code", "by_stage").transform(coded.withColumn("code", F.col("lvl__code").cast("double")))
    return staged.select("k", E.decode(F.col("lvl__code"), labels).alias("decoded"), "by_stage")


@query("m4_split_by_key_arithmetic", with_patients(
    "SELECT k, (((k % 1000003) * 7919 + 42) % 1000003) % 100 < 20 AS held_out FROM p"))
def m4(spark: SparkSession, sf: str) -> DataFrame:
    bucket = E.arithmetic_bucket(F.col("k"))
    rest, test = E.hold_out(patients(spark, sf), bucket)
    return rest.select("k", F.lit(False).alias("held_out")).unionByName(test.select("k", F.lit(True).alias("held_out")))


@query("m4_exact_split", with_patients(
    "SELECT k, row_number() OVER (ORDER BY (k * 7919 + 42) % 1009, k) <= (SELECT (count(*) * 20 + 99) // 100 FROM p) AS held_out FROM p"))
def m4_exact(spark: SparkSession, sf: str) -> DataFrame:
    """A fifth of the rows to the row; many keys share a hash, so the key decides at the edge."""
    df = patients(spark, sf)
    return df.select("k", E.exact_hold_out(df, [(F.col("k") * 7919 + 42) % 1009, F.col("k")]).alias("held_out"))


@query("m4_exact_sizes", with_patients("SELECT (count(*) * 20 + 99) // 100 AS held_out, count(*) - (count(*) * 20 + 99) // 100 AS kept FROM p"))
def m4_sizes(spark: SparkSession, sf: str) -> DataFrame:
    rest, test = split_rows(patients(spark, sf), F.col("k"))
    n = F.count(F.lit(1))
    return test.agg(n.alias("held_out")).crossJoin(F.broadcast(rest.agg(n.alias("kept"))))


@query("m4_split_by_hash", with_patients("SELECT count(*) AS n, TRUE AS whole, TRUE AS near_a_fifth FROM p"))
def m4_hash(spark: SparkSession, sf: str) -> DataFrame:
    df = patients(spark, sf)
    rest, test = split_rows(df, F.col("k"))
    sides = rest.select("k", F.lit(0).alias("side")).unionByName(test.select("k", F.lit(1).alias("side")))
    return sides.agg(
        F.count(F.lit(1)).alias("n"),
        (F.count_distinct("k") == F.count(F.lit(1))).alias("whole"),
        F.avg("side").between(0.17, 0.23).alias("near_a_fifth"),
    )


# ---- cohorts -----------------------------------------------------------------------------------------------------

SCALED_SQL = (
    "f AS (SELECT k, " + ", ".join(
        f"coalesce(CAST({c} AS DOUBLE), (SELECT median({c}) FROM p)) AS {c}" for c in COHORT_SHORT) + " FROM p),"
    " z AS (SELECT k, " + ", ".join(
        f"({c} - (SELECT avg({c}) FROM f)) / (SELECT stddev_pop({c}) FROM f) AS z{i}"
        for i, c in enumerate(COHORT_SHORT)) + " FROM f)"
)
Z = [f"z{i}" for i in range(len(COHORT_SHORT))]
# Fixed centres in scaled space, for assignment without fitting.
CENTRES = [
    [-0.9, -0.4, -0.7, -0.6, 0.2, 0.3],
    [0.8, 0.5, -0.5, 0.7, -0.6, 0.4],
    [-0.6, 0.7, 0.9, -0.3, 0.5, -0.8],
    [0.7, -0.8, 0.6, 0.4, 0.8, 0.5],
]


def scaled_sql(query_text: str) -> str:
    return f"{with_patients('').rstrip()}, {SCALED_SQL} {query_text}"


def scaled(spark: SparkSession, sf: str) -> DataFrame:
    df = patients(spark, sf)
    out = C.fit_scaler(df, COHORT_SHORT).transform(df)
    return out.select("k", *[F.col(f"cohort_z{i}").alias(z) for i, z in enumerate(Z)])


@query("m9_scaled_features", scaled_sql(f"SELECT k, {', '.join(f'round({z}, 6) AS {z}' for z in Z)} FROM z"))
def m9(spark: SparkSession, sf: str) -> DataFrame:
    return scaled(spark, sf).select("k", *[F.round(z, 6).alias(z) for z in Z])


DISTANCES = [
    "(" + " + ".join(f"(z{i} - ({v})) * (z{i} - ({v}))" for i, v in enumerate(centre)) + ")" for centre in CENTRES
]
NEAREST = "CASE least({0}) {1} END".format(
    ", ".join(DISTANCES), " ".join(f"WHEN {d} THEN {i}" for i, d in enumerate(DISTANCES))
)


@query("m11_nearest_centre", scaled_sql(
    f"SELECT k, {NEAREST} AS cluster, concat('Cluster ', CAST({NEAREST} AS VARCHAR)) AS cohort FROM z"))
def m11(spark: SparkSession, sf: str) -> DataFrame:
    near = C.nearest_centre([F.col(z) for z in Z], CENTRES)
    return scaled(spark, sf).select("k", near.alias("cluster"), C.cohort_label(near).alias("cohort"))


# Squared distances average to |x|^2 + mean|y|^2 - 2 x.mean(y), so no pair of rows is ever formed.
SILHOUETTE = scaled_sql(
    f", c AS (SELECT *, {NEAREST} AS cl, {' + '.join(f'{z} * {z}' for z in Z)} AS sq FROM z),"
    f" m AS (SELECT cl, count(*) AS n, avg(sq) AS psi, {', '.join(f'avg({z}) AS m{z}' for z in Z)} FROM c GROUP BY cl),"
    " d AS (SELECT c.k, c.cl, m.cl AS other, m.n,"
    f" sq + psi - 2 * ({' + '.join(f'{z} * m{z}' for z in Z)}) AS dist FROM c, m),"
    " s AS (SELECT k, max(CASE WHEN cl = other THEN CASE WHEN n > 1 THEN dist * n / (n - 1) ELSE 0 END END) AS a,"
    " min(CASE WHEN cl <> other THEN dist END) AS b FROM d GROUP BY k)"
    " SELECT round(avg((b - a) / greatest(a, b)), 6) AS silhouette FROM s"
).replace("FROM f) ,", "FROM f),")


@query("a18_silhouette", SILHOUETTE)
def a18(spark: SparkSession, sf: str) -> DataFrame:
    near = C.nearest_centre([F.col(z) for z in Z], CENTRES)
    df = VectorAssembler(inputCols=Z, outputCol=C.FEATURES).transform(scaled(spark, sf))
    value = C.silhouette(df.withColumn(C.CLUSTER, near))
    return spark.createDataFrame([(value,)], "silhouette double").select(F.round("silhouette", 6).alias("silhouette"))


# Scaled to mean 0 and deviation 1, rows of customers against fixed centres; SQL goes through all pairs.
FEW = ["c_acctbal", "c_nationkey"]
FEW_CENTRES = [[-1.0, -0.5], [0.9, -0.8], [0.1, 1.1]]
FEW_SQL = (
    "WITH z AS (SELECT c_custkey AS k, " + ", ".join(
        f"(CAST({c} AS DOUBLE) - (SELECT avg({c}) FROM customer)) / (SELECT stddev_pop({c}) FROM customer) AS z{i}" for i, c in enumerate(FEW))
    + " FROM customer), s AS (SELECT *, " + ", ".join(
        f"(z0 - ({x})) * (z0 - ({x})) + (z1 - ({y})) * (z1 - ({y})) AS d{i}" for i, (x, y) in enumerate(FEW_CENTRES))
    + " FROM z), c AS (SELECT k, z0, z1, CASE least(d0, d1, d2) WHEN d0 THEN 0 WHEN d1 THEN 1 ELSE 2 END AS cl FROM s),"
    " p AS (SELECT a.k, a.cl, b.cl AS other, count(*) AS n,"
    " sum(sqrt((a.z0 - b.z0) * (a.z0 - b.z0) + (a.z1 - b.z1) * (a.z1 - b.z1))) AS d FROM c a, c b GROUP BY 1, 2, 3),"
    " v AS (SELECT k, max(CASE WHEN cl = other THEN CASE WHEN n > 1 THEN d / (n - 1) ELSE 0 END END) AS a,"
    " min(CASE WHEN cl <> other THEN d / n END) AS b FROM p GROUP BY k)"
    " SELECT round(avg((b - a) / greatest(a, b)), 6) AS silhouette, CAST(0 AS DOUBLE) AS standard_error, CAST(count(*) AS INTEGER) AS sampled FROM v"
)


@query("a18_euclidean_silhouette", FEW_SQL)
def a18_euclidean(spark: SparkSession, sf: str) -> DataFrame:
    """The pairwise silhouette over all pairs of rows, so without a sampling error."""
    scaled = C.fit_scaler(table(spark, sf, "customer"), FEW).transform(table(spark, sf, "customer"))
    rows = scaled.select(vector_to_array(F.col(C.FEATURES)).alias(K.POINT)).persist()
    (mean, n), = K.exact_silhouettes(rows, [K.Fitted(3, 0, np.array(FEW_CENTRES))])
    rows.unpersist()
    return spark.createDataFrame([(mean, 0.0, n)], "silhouette double, standard_error double, sampled int").withColumn("silhouette", F.round("silhouette", 6))


def squared_distances(centres: list[list[float]]) -> list[Column]:
    """Of each row of a scaled frame to each centre, coordinate by coordinate."""
    at = vector_to_array(F.col(C.FEATURES))
    return [
        F.aggregate(F.zip_with(at, F.array(*map(F.lit, c)), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda a, x: a + x) for c in centres]


@query("m10_cohort_rows")
def m10_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Cluster and cohort of every patient."""
    df = clinical(spark, sf)
    return C.fit_cohorts(df).assign(df).select("k", C.CLUSTER, "cohort")


@query("m10_kmeans_assignment", with_patients("SELECT k, TRUE AS nearest FROM p"))
def m10(spark: SparkSession, sf: str) -> DataFrame:
    """Every row has the cluster of the centre it is nearest to."""
    df = clinical(spark, sf)
    fitted = C.fit_cohorts(df)
    apart = squared_distances(fitted.centres)
    scaled = fitted.scaler.transform(fitted.assign(df).drop("cohort"))
    return scaled.select("k", (F.get(F.array(*apart), F.col(C.CLUSTER)) <= F.least(*apart) * (1 + 1e-9)).alias("nearest"))


def summary_of(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Clusters in use, rows in all of them, and whether the ten restarts' best beats a single cluster and each restart."""
    fitted = C.fit_cohorts(df, columns)
    sizes = fitted.assign(df).groupBy(C.CLUSTER).agg(F.count(F.lit(1)).alias("n"))
    least = len(fitted.tried) == C.RESTARTS and all(fitted.cost <= m.cost for m in fitted.tried)
    return sizes.agg(
        F.count(F.lit(1)).cast("int").alias("clusters"), F.sum("n").alias("assigned"), F.lit(least).alias("least_of_ten"),
        (F.lit(fitted.cost) < F.sum("n") * len(columns or C.COHORT_FEATURES)).alias("tighter_than_one"),
    )


WHOLE = "SELECT 4 AS clusters, count(*) AS assigned, TRUE AS least_of_ten, TRUE AS tighter_than_one FROM "


@query("m10_kmeans_whole", with_patients(f"{WHOLE} p"))
def m10_whole(spark: SparkSession, sf: str) -> DataFrame:
    return summary_of(clinical(spark, sf))


@query("m10_kmeans_lineitem", f"{WHOLE} lineitem")
def m10_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", "l_discount")
    return summary_of(df, df.columns)


@query("m12_cluster_sweep", with_patients(
    "SELECT CAST(k AS INTEGER) AS k, (SELECT count(*) FROM p) AS n, CAST(10 AS BIGINT) AS restarts, TRUE AS cost_is_of_its_centres,"
    " TRUE AS silhouette_in_bounds FROM range(2, 9) AS t(k)"))
def m12(spark: SparkSession, sf: str) -> DataFrame:
    """Each k's cost, worked out anew from its centres, is the one that the sweep tells."""
    df = clinical(spark, sf)
    scaler, models, figures = C.sweep_models(df)
    best = K.best_of(models)
    scaled = scaler.transform(df).select(C.FEATURES)
    costs = scaled.agg(*[F.sum(F.least(*squared_distances(m.centres.tolist()))).alias(f"k{k}") for k, m in best.items()]).first()
    rows = [
        (f["k"], int(best[f["k"]].sizes.sum()), sum(m.k == f["k"] for m in models),
         abs(costs[f"k{f['k']}"] - f["cost"]) <= 1e-6 * f["cost"], -1 <= f["silhouette"] <= 1 and -1 <= f["euclidean_silhouette"] <= 1)
        for f in figures.collect()
    ]
    return spark.createDataFrame(rows, "k int, n long, restarts long, cost_is_of_its_centres boolean, silhouette_in_bounds boolean")


@query("m12_sweep_figures")
def m12_figures(spark: SparkSession, sf: str) -> DataFrame:
    """Cost and both silhouettes of the best model for each number of clusters."""
    return C.sweep(clinical(spark, sf))


# ---- risk model --------------------------------------------------------------------------------------------------

_BUNDLES: dict[tuple[str, str], str] = {}


def training_rows(orders: DataFrame) -> DataFrame:
    """Silver rows of the derived patients that the split does not hold out."""
    return split_rows(silver_from(orders), F.col("k"))[0]


def silver_from(orders: DataFrame) -> DataFrame:
    """Silver as files: splits, training and reports read it many times. The keys are dealt over all cores."""
    spark = orders.sparkSession
    pieces = max(spark.sparkContext.defaultParallelism, -(-orders.count() // FILE_ROWS))
    typed = apply_mapping(bronze_from(orders.select("o_orderkey").repartition(pieces)), raw_mapping(keep=["k"]))
    path, staged = scratch(spark, "silver"), scratch(spark, "typed")
    typed.write.parquet(staged)
    typed = spark.read.parquet(staged)
    route(row_outcomes(repair(typed), SILVER_RULES), keep=["k"])["silver"].write.parquet(path)
    return spark.read.parquet(path)


def bundle(spark: SparkSession, sf: str, rest: DataFrame | None = None) -> RiskModel:
    """One stored model per session and data set; later queries load what the first one trained. ``rest`` are ``training_rows`` that the
    caller has already."""
    where = (spark.sparkContext.applicationId, sf)
    path = _BUNDLES.setdefault(where, scratch(spark, "risk-model"))
    model, _ = load_or_train(spark, table(spark, sf, "orders"), path, training_rows if rest is None else lambda _: rest)
    return model


def held_out(spark: SparkSession, sf: str) -> tuple[RiskModel, DataFrame]:
    """(the model, silver rows that its training did not see); silver is made once for both."""
    rest, test = split_rows(silver_from(table(spark, sf, "orders")), F.col("k"))
    return bundle(spark, sf, rest), test


def all_scored(spark: SparkSession, sf: str) -> DataFrame:
    """Every silver row with its level and score."""
    silver = silver_from(table(spark, sf, "orders"))
    return bundle(spark, sf, split_rows(silver, F.col("k"))[0]).score(silver)


@query("m5_m6_m7_held_out_quality", S.bronze_filled(
    f"SELECT TRUE AS level_beats_majority, TRUE AS score_beats_mean, count(*) > 0 AS some FROM filled WHERE {S.SILVER_PASS}"))
def m5_m6(spark: SparkSession, sf: str) -> DataFrame:
    """On rows that the training did not see, levels are right more often than the commonest one and R2 is above zero."""
    model, test = held_out(spark, sf)
    majority = F.greatest(*[F.avg((ref(LEVEL) == v).cast("int")) for v in ("LOW", "INTERMEDIARY", "HIGH")]).alias("majority")
    right = F.avg((ref(LEVEL) == ref(LEVEL_OUT)).cast("int")).alias("right")
    found = regression_metrics(model.score(test), SCORE, SCORE_OUT, right, majority)
    return found.select(
        (F.col("right") > F.col("majority")).alias("level_beats_majority"), (F.col("r2") > 0).alias("score_beats_mean"), (F.col("n") > 0).alias("some"))


@query("m5_m6_m7_scored_rows")
def m5_m6_m7_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Level, predicted level and score of every silver row."""
    return all_scored(spark, sf).select("k", LEVEL, LEVEL_OUT, SCORE_OUT)


@query("m5_level_figures")
def m5_levels(spark: SparkSession, sf: str) -> DataFrame:
    """One row per level of the rows that the training did not see: how many, precision and recall."""
    return level_report(*held_out(spark, sf))


@query("m16_hold_out_figures")
def m16_figures(spark: SparkSession, sf: str) -> DataFrame:
    """R2, mean absolute and root mean squared error of the score, and the share of right levels."""
    return hold_out_report(*held_out(spark, sf))


@query("m7_every_row_scored", S.bronze_filled(
    f"SELECT count(*) AS scored, TRUE AS levels_known, TRUE AS rounded, TRUE AS beats_majority FROM filled"
    f" WHERE {S.SILVER_PASS}"))
def m7_whole(spark: SparkSession, sf: str) -> DataFrame:
    scored = all_scored(spark, sf)
    right = F.avg((ref(LEVEL) == ref(LEVEL_OUT)).cast("int"))
    majority = F.greatest(*[F.avg((ref(LEVEL) == v).cast("int")) for v in ("LOW", "INTERMEDIARY", "HIGH")])
    return scored.agg(
        F.count(SCORE_OUT).alias("scored"),
        F.bool_and(ref(LEVEL_OUT).isin("LOW", "INTERMEDIARY", "HIGH")).alias("levels_known"),
        F.bool_and(F.abs(ref(SCORE_OUT) * 100 - F.round(ref(SCORE_OUT) * 100)) < 1e-6).alias("rounded"),
        (right > majority).alias("beats_majority"),
    )


def ablated(spark: SparkSession, sf: str) -> tuple[DataFrame, int]:
    """(hold-out figures with and without the level as an input, held-out rows with a score)."""
    rest, test = split_rows(silver_from(table(spark, sf, "orders")), F.col("k"))
    rest, test = rest.persist(), test.persist()
    try:
        return spark.createDataFrame(ablation(rest, test).collect()), test.filter(ref(SCORE).isNotNull()).count()
    finally:
        rest.unpersist()
        test.unpersist()


@query("m8_ablation_figures")
def m8_figures(spark: SparkSession, sf: str) -> DataFrame:
    return ablated(spark, sf)[0]


@query("m8_level_signal_ablation", "SELECT use_signal, TRUE AS all_held_out, TRUE AS beats_mean FROM (VALUES (TRUE), (FALSE)) AS t(use_signal)")
def m8(spark: SparkSession, sf: str) -> DataFrame:
    figures, n = ablated(spark, sf)
    return figures.select("use_signal", (F.col("n") == n).alias("all_held_out"), (F.col("r2") > 0).alias("beats_mean"))


@query("m14_m15_load_train_refresh",
       "SELECT 1 AS step, 'trained' AS how UNION ALL SELECT 2, 'loaded' UNION ALL SELECT 3, 'refreshed'")
def m14(spark: SparkSession, sf: str) -> DataFrame:
    """First run trains, the second loads, and after a new delivery the third trains again."""
    landing, path, settings = scratch(spark, "landing"), scratch(spark, "risk-model"), Settings()
    orders = table(spark, sf, "orders")
    orders.filter("o_orderkey % 4 > 0").write.parquet(landing)
    steps = []
    for step in (1, 2, 3):
        if step == 3:
            orders.filter("o_orderkey % 4 = 0").write.mode("append").parquet(landing)
        _, how = load_or_train(spark, spark.read.parquet(landing), path, training_rows, settings)
        steps.append((step, how))
    return spark.createDataFrame(steps, "step int, how string")


@query("m16_hold_out_report", "SELECT TRUE AS n_same, TRUE AS r2_same, TRUE AS mae_same, TRUE AS rmse_same, TRUE AS accuracy_same")
def m16(spark: SparkSession, sf: str) -> DataFrame:
    """The one-pass report equals its figures worked out one by one on the stored scores."""
    model, test = held_out(spark, sf)
    path = scratch(spark, "held-out")
    model.score(test).write.parquet(path)
    told = hold_out_report(model, test).first()
    rows = spark.read.parquet(path)
    known = rows.filter(ref(SCORE).isNotNull())
    mean = known.agg(F.avg(ref(SCORE))).first()[0]
    error, apart = ref(SCORE) - ref(SCORE_OUT), ref(SCORE) - F.lit(mean)
    found = known.agg(
        F.count(F.lit(1)).alias("n"), (1 - F.sum(error * error) / F.sum(apart * apart)).alias("r2"),
        F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse"))
    right = rows.agg(F.avg((ref(LEVEL) == ref(LEVEL_OUT)).cast("int")).alias("accuracy"))
    return found.crossJoin(F.broadcast(right)).select(*[
        (F.abs(F.col(c) - F.lit(told[c])) < 1e-6).alias(f"{c}_same") for c in ("n", "r2", "mae", "rmse", "accuracy")])


# ---- requests, what-if and report --------------------------------------------------------------------------------

@query("g3_request_job", with_patients(
    "SELECT 'bad' AS part, count(*) AS n, TRUE AS complete FROM p WHERE k % 11 < 6 UNION ALL SELECT 'good', count(*), TRUE FROM p WHERE k % 11 >= 6"))
def g3(spark: SparkSession, sf: str) -> DataFrame:
    """Good and bad requests are all requests; each result has a level and a score."""
    results, bad = score_requests(odd_bodies(spark, sf), bundle(spark, sf), keep=("k",))
    level, score = F.get_json_object("result", f"$.{LEVEL_OUT}"), F.get_json_object("result", f"$.{SCORE_OUT}").cast("double")
    whole = level.isin("LOW", "INTERMEDIARY", "HIGH") & score.isNotNull()
    return results.agg(F.lit("good").alias("part"), F.count(F.lit(1)).alias("n"), F.bool_and(whole).alias("complete")).unionByName(
        bad.agg(F.lit("bad").alias("part"), F.count(F.lit(1)).alias("n"), F.bool_and(F.col("reason").isNotNull()).alias("complete")))


@query("g4_what_if", with_patients("SELECT count(*) AS n, TRUE AS levels, TRUE AS scores, TRUE AS cohorts FROM p"))
def g4_what_if(spark: SparkSession, sf: str) -> DataFrame:
    df = clinical(spark, sf)
    rows = what_if(df, bundle(spark, sf), C.fit_cohorts(df))
    return rows.agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(ref(LEVEL_OUT).isin("LOW", "INTERMEDIARY", "HIGH")).alias("levels"),
        F.bool_and(ref(SCORE_OUT).isNotNull()).alias("scores"),
        F.bool_and(F.col("cohort") == F.concat(F.lit("Cluster "), F.col(C.CLUSTER).cast("string"))).alias("cohorts"))


# Rows of each tile: fixed by the silver columns and categories.
TILE_ROWS = {
    "headline": 1, "imputation_audit": 13, "correlation": 64, "bp_categories": 4, "hypertension": 1, "factor_distribution": 5,
    "factor_prevalence": 4, "smoking_box": 2, "smoking_welch": 1, "cluster_sweep": 7, "hold_out": 1,
}


@query("g4_report_tiles", "SELECT * FROM (VALUES " + ", ".join(f"('{t}', CAST({n} AS BIGINT))" for t, n in TILE_ROWS.items()) + ") AS t(tile, n)"
       + S.bronze_filled(f" SELECT count(*) FROM (SELECT DISTINCT age_band, \"CVD Risk Level\" FROM filled WHERE {S.SILVER_PASS})").join(
           [" UNION ALL SELECT 'level_by_band', (", ")"]))
def g4_tiles(spark: SparkSession, sf: str) -> DataFrame:
    """The whole dashboard report, written and counted."""
    silver = silver_from(table(spark, sf, "orders")).persist()
    out = scratch(spark, "report")
    rest, test = split_rows(silver, F.col("k"))
    names = write_report(silver.drop("k"), out, model_tiles(silver, bundle(spark, sf, rest), test))
    silver.unpersist()
    counts = [(name, spark.read.parquet(f"{out}/{name}").count()) for name in names]
    return spark.createDataFrame(counts, "tile string, n long")


# Key columns of the tiles that rest on the silver table alone; the other columns are their figures.
TILE_KEYS = {
    "headline": [], "imputation_audit": ["flag"], "correlation": ["a", "b"], "level_by_band": ["age_band", LEVEL],
    "bp_categories": ["Blood Pressure Category"], "hypertension": [], "factor_distribution": ["factors"], "factor_prevalence": ["factor"],
    "smoking_box": ["Smoking Status"], "smoking_welch": [],
}
HYPERTENSIVE = "\"Blood Pressure Category\" IN ('Hypertension Stage 1', 'Hypertension Stage 2')"
FACTOR_TESTS = {
    "smoking": "\"Smoking Status\" = 'Y'", "diabetes": "\"Diabetes Status\" = 'Y'", "family_history": "\"Family History of CVD\" = 'Y'",
    "hypertension": HYPERTENSIVE,
}
SCORE_SQL, SMOKING_SQL = S.q(SCORE), S.q("Smoking Status")


def share_sql(test: str) -> str:
    return f"avg(CASE WHEN {test} THEN 1 ELSE 0 END) * 100"


# SQL of each tile over ``silver``, and its figures.
TILE_SQL = {
    "headline": (f"SELECT count(*) AS records, avg({SCORE_SQL}) AS mean_score, {share_sql(S.q(LEVEL) + " = 'HIGH'")} AS high_pct FROM silver",
                 ["records", "mean_score", "high_pct"]),
    "imputation_audit": (" UNION ALL ".join(
        f"SELECT '{flag_name(c)}' AS flag, round_even({share_sql(flag_name(c))}, 2) AS rate_pct FROM silver" for c in IMPUTED), ["rate_pct"]),
    "correlation": (" UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, corr({S.q(a)}, {S.q(b)}) AS r FROM silver" for a in [*NUMERIC_FEATURES, SCORE] for b in [*NUMERIC_FEATURES, SCORE]), ["r"]),
    "level_by_band": (
        f"SELECT age_band, {S.q(LEVEL)}, count(*) AS n, sum(count(*)) OVER (PARTITION BY age_band) AS band_n, CAST(count(*) AS DOUBLE)"
        f" / sum(count(*)) OVER (PARTITION BY age_band) * 100 AS share_pct, sum(count(*)) OVER (PARTITION BY age_band) < 100 AS small_band"
        f" FROM silver GROUP BY age_band, {S.q(LEVEL)}", ["n", "band_n", "share_pct", "small_band"]),
    "bp_categories": ("SELECT \"Blood Pressure Category\", count(*) AS n, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () * 100 AS share_pct"
                      " FROM silver GROUP BY 1", ["n", "share_pct"]),
    "hypertension": (f"SELECT count(*) AS records, count(*) FILTER ({HYPERTENSIVE}) AS hypertensive, {share_sql(HYPERTENSIVE)} AS prevalence_pct FROM silver",
                     ["records", "hypertensive", "prevalence_pct"]),
    "factor_distribution": (f"SELECT {' + '.join(f'CASE WHEN {t} THEN 1 ELSE 0 END' for t in FACTOR_TESTS.values())} AS factors, count(*) AS n"
                            " FROM silver GROUP BY 1", ["n"]),
    "factor_prevalence": (" UNION ALL ".join(
        f"SELECT '{name}' AS factor, {share_sql(test)} AS prevalence_pct FROM silver" for name, test in FACTOR_TESTS.items()), ["prevalence_pct"]),
    "smoking_box": (box_sql("silver", SMOKING_SQL, SCORE_SQL), ["n", "q1", "median", "q3", "whisker_low", "whisker_high", "outliers"]),
    "smoking_welch": (welch_sql("silver", SMOKING_SQL, SCORE_SQL, "Y", "N"), ["n0", "mean0", "var0", "n1", "mean1", "var1", "t", "df"]),
}


def melted_sql(tile: str) -> str:
    body, figures = TILE_SQL[tile]
    item = f"concat_ws('|', {', '.join(f'CAST({S.q(k)} AS VARCHAR)' for k in TILE_KEYS[tile])})" if TILE_KEYS[tile] else "''"
    return " UNION ALL ".join(
        f"SELECT '{tile}' AS tile, {item} AS item, '{f}' AS figure, round(CAST({S.q(f)} AS DOUBLE), 6) AS value FROM ({body})" for f in figures)


@query("g4_tile_values", S.bronze_filled(
    f", silver AS (SELECT * FROM filled WHERE {S.SILVER_PASS}) {' UNION ALL '.join(map(melted_sql, TILE_KEYS))}"))
def g4_values(spark: SparkSession, sf: str) -> DataFrame:
    """Every figure of the tiles that rest on the silver table, as they read back from the written report."""
    typed = apply_mapping(bronze_from(table(spark, sf, "orders")), raw_mapping(keep=["k"]))
    silver = route(row_outcomes(repair(typed, exact=True), SILVER_RULES))["silver"].persist()
    out, parts = scratch(spark, "report"), []
    for tile in write_report(silver, out):
        df = spark.read.parquet(f"{out}/{tile}")
        figures = [c for c in df.columns if c in TILE_SQL[tile][1]]
        each = F.array(*[F.struct(F.lit(c).alias("figure"), F.round(ref(c).cast("double"), 6).alias("value")) for c in figures])
        parts.append(df.select(F.lit(tile).alias("tile"), F.concat_ws("|", *[ref(k).cast("string") for k in TILE_KEYS[tile]]).alias("item"), F.inline(each)))
    silver.unpersist()
    return reduce(DataFrame.unionByName, parts)


# ---- streams -----------------------------------------------------------------------------------------------------

def bronze_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The raw table as a stream of CSV files in three batches, more where these would be large."""
    pieces = pieces_of(spark, sf, 3)
    return stream_bronze(spark, bronze_csv(spark, sf, pieces), bronze_schema(), maxFilesPerTrigger=per_batch(pieces, 3))


def streamed(spark: SparkSession, sf: str) -> str:
    """CSV files through the stream in several batches, with medians fitted beforehand."""
    out = scratch(spark, "stream")
    fill = ClinicalFill.fit(typed_bronze(spark, sf), exact=True)
    source = bronze_stream(spark, sf)
    stream_to_silver(source, fill, out, f"{out}/progress", keep=("k",)).awaitTermination()
    return out


@query("st1_stream_silver", S.bronze_filled(f"SELECT k, {S.names(S.SILVER_COLUMNS)} FROM filled WHERE {S.SILVER_PASS}"))
def st1(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{streamed(spark, sf)}/silver").drop("batch_id")


@query("w4_stored_medians_new_groups", S.bronze_filled("SELECT count(*) AS n, CAST(0 AS BIGINT) AS empty_cells FROM filled"))
def w4_new_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Medians of some groups, stored, read back and applied to all: no cell that the fitted rows have values for stays empty."""
    typed, path = typed_bronze(spark, sf), scratch(spark, "medians")
    young_men = typed.filter((F.col("Sex") == "M") & (F.col("Age") < 40))
    ClinicalFill.fit(young_men, exact=True).save(path)
    filled = ClinicalFill.load(spark, path).apply(typed)
    empty = sum((ref(c).isNull().cast("int") for c in IMPUTED), F.lit(0))
    return filled.agg(F.count(F.lit(1)).alias("n"), F.sum(empty).alias("empty_cells"))


@query("st1_stream_new_groups", S.bronze_filled("SELECT count(*) AS n, CAST(0 AS BIGINT) AS differ FROM filled"))
def st1_new_groups(spark: SparkSession, sf: str) -> DataFrame:
    """A stream with medians of some groups gives the rows that one batch with them gives."""
    typed, out = typed_bronze(spark, sf), scratch(spark, "stream")
    fill = ClinicalFill.fit(typed.filter((F.col("Sex") == "M") & (F.col("Age") < 40)), exact=True)
    source = bronze_stream(spark, sf)
    stream_to_silver(source, fill, out, f"{out}/progress", keep=("k",)).awaitTermination()
    both = route(row_outcomes(fill.apply(typed), SILVER_RULES), keep=["k"])
    columns = [*S.SILVER_COLUMNS, "k"]
    batch = both["silver"].select(*map(ref, columns))
    online = spark.read.parquet(f"{out}/silver").select(*map(ref, columns))
    n = F.count(F.lit(1))
    rejected = spark.read.parquet(f"{out}/rejected").agg(n.alias("rejected"))
    differ = batch.exceptAll(online).unionByName(online.exceptAll(batch)).agg(n.alias("differ"))
    return online.agg(n.alias("kept")).crossJoin(F.broadcast(rejected)).crossJoin(F.broadcast(differ)).select(
        (F.col("kept") + F.col("rejected")).alias("n"), "differ")


@query("st1_refreshed_medians", S.bronze_filled("SELECT * FROM filled"))
def st1_refreshed(spark: SparkSession, sf: str) -> DataFrame:
    """Medians of a few rows fill the stream, whose batches are counted; the medians of all batches then fill the table as one batch's do."""
    typed, out = typed_bronze(spark, sf), scratch(spark, "stream")
    counts = MedianCounts(f"{out}/counts")
    first = ClinicalFill.fit(typed.filter((F.col("Sex") == "M") & (F.col("Age") < 40)), exact=True)
    source = bronze_stream(spark, sf)
    stream_to_silver(source, first, out, f"{out}/progress", keep=("k",), counts=counts).awaitTermination()
    return counts.fit(spark).apply(typed)


@query("st1_stream_malformed", MALFORMED_PARTS)
def st1_malformed(spark: SparkSession, sf: str) -> DataFrame:
    pieces = pieces_of(spark, sf, 4)
    out, path = scratch(spark, "stream"), malformed_csv(spark, sf, pieces)
    read = read_bronze(spark, path)
    whole = apply_mapping(read.filter(ref(CORRUPT).isNull()), raw_mapping())
    source = stream_bronze(spark, path, maxFilesPerTrigger=per_batch(pieces, 2))
    stream_to_silver(source, ClinicalFill.fit(whole, exact=True), out, f"{out}/progress").awaitTermination()
    return parts_of(spark.read.parquet(f"{out}/silver"), spark.read.parquet(f"{out}/rejected"))


@query("st1_stream_outcomes", S.bronze_filled(S.outcomes_sql("filled", SILVER_RULES, 35).replace(
    "CAST(CASE WHEN 35 == 35 THEN 0 ELSE 1 END AS BIGINT)", "CAST(0 AS BIGINT)")
    + " UNION ALL SELECT 'WellFormedLine', 'Passed', CAST(0 AS BIGINT), count(*) FROM filled"))
def st1_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return total_outcomes(spark.read.parquet(f"{streamed(spark, sf)}/outcomes").drop("run_id"))


@query("st2_stream_scores", with_patients("SELECT count(*) AS n, count(*) AS same_as_batch FROM p"))
def st2(spark: SparkSession, sf: str) -> DataFrame:
    model = bundle(spark, sf)
    landing, out = scratch(spark, "requests"), scratch(spark, "scores")
    rows = clinical(spark, sf).select("k", *map(ref, NUMERIC_FEATURES + CATEGORY_FEATURES))
    rows.repartition(3).write.parquet(landing)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(landing)
    for running in score_stream(stream, model, out, f"{out}/progress"):
        running.awaitTermination()
    online = spark.read.parquet(f"{out}/scored").select("k", LEVEL_OUT, SCORE_OUT)
    batch = model.score(rows).select("k", F.col(LEVEL_OUT).alias("level"), F.col(SCORE_OUT).alias("score"))
    return online.join(batch, "k", "full").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((F.col(LEVEL_OUT) == F.col("level")) & (F.col(SCORE_OUT) == F.col("score"))).alias("same_as_batch"),
    )
