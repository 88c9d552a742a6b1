"""What the physical plans look like."""

import re

import pytest

from veilframe import LinkSpec, Policy, link, profile, pseudonymize
from veilframe.catalogue import QUERIES, table

FOLDER = "/root/testdata/sf0.001"
STATELESS = {
    "l_orderkey": ["Encryption"],
    "l_partkey": ["Masking", "1:0-:1"],
    "l_suppkey": ["PartDelete", "1:0-"],
    "l_discount": ["Round", "R", 2],
    "l_tax": ["Delete"],
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def lineitem(spark):
    return table(spark, FOLDER, "lineitem")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_runs_python_or_a_cross_join(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for node in ("EvalPython", "MapInPandas", "CartesianProduct", "NestedLoopJoin"):
        assert node not in text


def test_stateless_policies_do_not_shuffle(lineitem):
    policy = Policy.from_dict(STATELESS)
    text = plan(pseudonymize(lineitem, policy))
    assert "Exchange" not in text and "Subquery" not in text
    # One compiled stage from the scan to the result.
    assert text.count("*(1) Project") == 1 and "*(2)" not in text


def test_deleted_and_unselected_columns_are_not_read(lineitem):
    policy = Policy.from_dict({"l_tax": ["Delete"], "l_orderkey": ["Encryption"]})
    text = plan(pseudonymize(lineitem, policy).select("l_orderkey"))
    assert "ReadSchema: struct<l_orderkey:bigint>" in text


def test_statistics_are_one_aggregate_over_the_needed_columns(lineitem):
    policy = Policy.from_dict(
        {
            "l_quantity": ["Random"],
            "l_extendedprice": ["TopBottom"],
            "l_tax": ["MicroAggregation", "l_returnflag=R"],
        }
    )
    text = plan(pseudonymize(lineitem, policy))
    assert text.count("Exchange SinglePartition") == 1 and text.count("Exchange") == 1
    assert len(set(re.findall(r"Subquery subquery#\d+", text))) == 1
    read = "l_quantity:double,l_extendedprice:double,l_tax:double,l_returnflag:string"
    assert f"ReadSchema: struct<{read}>" in text


def test_conditions_reach_the_scan(spark, lineitem):
    policy = Policy.from_dict({"l_tax": ["MicroAggregation", "l_returnflag=R", "l_linenumber=3"]})
    text = plan(profile(lineitem, policy))
    assert "EqualTo(l_returnflag,R)" in text and "EqualTo(l_linenumber,3)" in text
    assert "ReadSchema: struct<l_linenumber:int,l_tax:double,l_returnflag:string>" in text


def test_links_shuffle_only_the_token_and_the_wanted_columns(spark, lineitem):
    part = table(spark, FOLDER, "part")
    spec = LinkSpec(["l_partkey"], ["p_partkey"], ["l_orderkey"], ["p_name"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(link(lineitem, part, spec))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and text.count("Exchange hashpartitioning(__token") == 2
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in text


def test_small_sides_are_broadcast_by_their_measured_size(spark, lineitem):
    nation, supplier = (table(spark, FOLDER, name) for name in ("nation", "supplier"))
    spec = LinkSpec(["s_nationkey"], ["n_nationkey"], ["s_name"], ["n_name"])
    assert "BroadcastHashJoin" in plan(link(supplier, nation, spec))


def test_hot_keys_are_found_before_the_link(spark, lineitem):
    part = table(spark, FOLDER, "part")
    spec = LinkSpec(["l_partkey"], ["p_partkey"], ["l_orderkey"], ["p_name"])
    text = plan(link(lineitem, part, spec, split_hot_keys=True, pairs_per_cell=1))
    assert "count(1)" not in text and text.count("LeftOuter, BuildRight") == 2
    assert text.count("ReadSchema: struct<key:bigint,pieces_a:int,pieces_b:int>") == 2
