from collections import Counter

import pytest
from pyspark.sql import functions as F

from benchloom.operators import keysets
from benchloom.plans.workflow import generator

VALUES = [0, 1, 1, -1, -1, -1, 32767, 32768, 32769, -32767, -32768, -32769, 2**40, 2**40, 2**63 - 1, -(2**63), None, None]


@pytest.mark.parametrize("scattered", [False, True])
def test_facts(spark, scattered):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(VALUES)], "k long, i int").repartition(5)
    sets = keysets.table_key_sets({"t": df}, {"t": {"k": "k", "i": "i"}}, scattered)
    found = {r["key"]: r.asDict() for r in keysets.key_facts(sets).collect()}
    known = Counter(v for v in VALUES if v is not None)
    assert found["k"] == dict(
        table="t", key="k", rows=len(VALUES), null_rows=2, distinct_keys=len(known), duplicate_rows=sum(known.values()) - len(known)
    )
    assert found["i"]["distinct_keys"] == len(VALUES) and found["i"]["duplicate_rows"] == 0


def test_orphans(spark):
    tables = {
        "c": spark.createDataFrame([(v,) for v in (1, 1, 5, 40_000, -7, None)], "k long"),
        "p": spark.createDataFrame([(v,) for v in (1, 2, 3, 40_000)], "k long"),
        "none": spark.createDataFrame([], "k long"),
    }
    sets = keysets.table_key_sets(tables, {name: {"k": "k"} for name in tables})
    links = [("c", "k", "p", "k"), ("p", "k", "c", "k"), ("none", "k", "p", "k"), ("c", "k", "none", "k")]
    found = keysets.orphan_keys(sets, links).collect()
    assert {(r.child, r.parent): r.orphan_keys for r in found} == {("c", "p"): 2, ("p", "c"): 2, ("none", "p"): 0, ("c", "none"): 4}


def test_one_pass_without_an_exchange_of_keys(spark):
    sets = keysets.key_set(spark.range(200_000), {"id": "id", "half": "id div 2"})
    plan = sets._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(key") == 1 and plan.count("Range (") == 1
    # One bucket for each 32,768 values: what travels does not follow the rows.
    assert sets.where("key = 'id'").count() == 8 and sets.where("key = 'half'").count() == 5


def test_tpch_keys(spark):
    tables = generator(spark, "tpch", "0.01")  # with ten suppliers the rule for offers repeats pairs
    assert keysets.tpch_key_violations(tables).isEmpty()
    few = tables["orders"].where("o_orderkey = 1")
    broken = tables | {
        "orders": tables["orders"].unionByName(few).unionByName(few),
        "part": tables["part"].withColumn("p_partkey", F.when(F.col("p_partkey") != 7, F.col("p_partkey"))),
        "partsupp": tables["partsupp"].unionByName(tables["partsupp"].where("ps_partkey = 3")),
    }
    found = {(r.check, r.table, r.subject): r.actual for r in keysets.tpch_key_violations(broken).collect()}
    assert found == {
        ("duplicate_key", "orders", "o_orderkey"): "2",
        ("null_key", "part", "p_partkey"): "1",
        ("duplicate_key", "partsupp", "ps_partkey,ps_suppkey"): "4",
        ("orphan_key", "partsupp", "ps_partkey"): "1",
        ("orphan_key", "lineitem", "l_partkey"): "1",
    }
    with pytest.raises(ValueError, match="nation"):
        keysets.tpch_key_violations({k: v for k, v in tables.items() if k != "nation"})
