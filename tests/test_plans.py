"""Scale invariants of the registered queries' physical plans.

No cartesian or nested-loop joins and no Python evaluation; every window
either keeps the first rows of a group behind a partial group limit, or runs
over totals per block; scans read the columns that the query names; the
number of hash exchanges of the costly queries does not creep up.
"""

import re

import pytest

from matchlake.plans import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "CollectLimit")


@pytest.fixture(scope="module")
def scale_mode(spark):
    """Plan as on large inputs: no broadcast by size, no runtime re-plan."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def plan_of(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_invariants(scale_mode, name):
    plan = plan_of(scale_mode, name)
    for bad in FORBIDDEN:
        assert bad not in plan, (name, bad)
    for window in re.findall(r"Window \[([a-z_]+)\(", plan):
        assert window != "row_number" or "WindowGroupLimit" in plan or "_deal" in plan, name


# Hash exchanges as planned at scale.
MOST_EXCHANGES = {"mart_first_event_impact": 12, "outcome_split": 12, "mart_first_event_ratio": 11, "mart_consolidated": 12,
                  "left_join_2key": 5, "case_outcome": 3, "incremental_batch": 2, "mart_rate_by_group": 8}


def exchanges(plan):
    return len(re.findall(r"(?<!Reused)Exchange hashpartitioning", plan))


@pytest.mark.parametrize("name", sorted(MOST_EXCHANGES))
def test_exchanges(scale_mode, name):
    assert exchanges(plan_of(scale_mode, name)) <= MOST_EXCHANGES[name]


def test_impact_in_the_default_plan(scale_mode):
    """With small sides broadcast by measured size, as Spark does by default."""
    scale_mode.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        assert exchanges(plan_of(scale_mode, "mart_first_event_impact")) <= 8
    finally:
        scale_mode.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


# The columns each scan of the table reads.
READS = {
    "case_outcome": {"l_orderkey,l_suppkey,l_linestatus", "o_orderkey,o_orderstatus"},
    "left_to_inner": {"l_orderkey,l_suppkey", "o_orderkey,o_orderpriority"},
    "left_join_2key": {"l_orderkey,l_suppkey,l_linestatus", "l_orderkey,l_suppkey,l_quantity,l_returnflag", "o_orderkey"},
    "incremental_batch": {"l_orderkey,l_suppkey", "o_orderkey,o_orderdate"},
    "uuid5_key": {"o_orderkey,o_orderpriority"},
}


@pytest.mark.parametrize("name", sorted(READS))
def test_scans_read_only_their_columns(scale_mode, name):
    schemas = {",".join(sorted(f.split(":")[0] for f in m.split(","))) for m in re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(scale_mode, name))}
    want = {",".join(sorted(x.split(","))) for x in READS[name]}
    assert want <= schemas, schemas


def test_one_digest_for_a_key(spark):
    assert plan_of(spark, "uuid5_key").count("sha1(") == 1
