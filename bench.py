"""Headline timings on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR``; prints one JSON line.

The derived patients are written once as Parquet files, as the batch job stages its typed rows; each query then reads
them.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from catalog.fixture import HEADER, bronze, patients
from pulseframe.operators import profile as P
from pulseframe.operators.cohorts import fit_cohorts
from pulseframe.operators.mapping import apply_mapping, raw_mapping
from pulseframe.operators.quality import SILVER_RULES, row_outcomes
from pulseframe.operators.risk import train
from pulseframe.operators.stats import box_stats, welch
from pulseframe.plans.etl import repair
from pulseframe.schema import NUMERIC_FEATURES, SCORE
from pulseframe.session import local_session, scratch


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    staged = scratch(spark, "bench")
    apply_mapping(bronze(spark, sf_dir), raw_mapping()).repartition(int(cpus) if cpus.isdigit() else 8).write.parquet(
        f"{staged}/typed"
    )
    typed = spark.read.parquet(f"{staged}/typed")
    repair(typed).write.parquet(f"{staged}/silver")
    silver = spark.read.parquet(f"{staged}/silver")
    numbers = [*NUMERIC_FEATURES, SCORE]
    work = {
        "w4_tiered_fill": lambda: repair(typed),
        "w4_tiered_fill_exact": lambda: repair(typed, exact=True),
        "q5_row_outcomes": lambda: row_outcomes(silver, SILVER_RULES),
        "a7_correlation": lambda: P.correlation(silver, numbers),
        "a9_box_stats": lambda: box_stats(silver, "Smoking Status", SCORE),
        "a12_level_by_band": lambda: P.level_by_band(silver),
        "a16_null_profile": lambda: P.null_profile(patients(spark, sf_dir).withColumnsRenamed(HEADER)),
        "m13_welch": lambda: welch(silver, "Smoking Status", SCORE, "Y", "N"),
        "m10_kmeans": lambda: fit_cohorts(silver).assign(silver),
        "m5_m6_m7_risk_model": lambda: train(silver).score(silver),
    }
    wanted = sys.argv[1:]
    times = {}
    for name, make in work.items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        make().write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": times,
                      "sf": Path(sf_dir).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
