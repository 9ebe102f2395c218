"""The quick queries against their SQL twins at the smallest scale; check_oracle.py runs all of them."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import compare, connect

SF = "/root/testdata/sf0.001"
QUICK = (
    "p1_", "p2_", "p5_", "p9_", "p10_", "f1_", "f2_", "f5_", "x1_", "x4_", "x9_", "x14_", "a1_median_by", "a3_", "a7_corr",
    "a10_", "a13_", "a14_", "a15_", "a16_", "a17_", "m1_", "m2_", "m4_", "m13_welch_s", "q1_", "q2_", "s4_", "s9_", "s10_",
    "u1_", "w2_", "w4_tiered_fill_line", "s1_", "a4_a7", "j1_star", "m10_kmeans_line", "st1_stream_silver", "q7_batch_run_malformed",
    "m7_every", "g3_", "m5_m6_m7_held", "m8_level", "m12_cluster", "m14_", "m16_hold_out_report", "g4_", "st2_",
    "w4_stored_medians", "s6_swapped", "a18_eu", "a11_",
)
NAMES = [n for n in oracle_sql() if n.startswith(QUICK)]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    assert compare(queries()[name](spark, SF), con, oracle_sql()[name]) == ""


def test_entry(spark):
    assert entry(spark).count() > 0
