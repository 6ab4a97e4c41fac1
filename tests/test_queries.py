import os

import pytest

import __spark_entry__ as contract
from compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_against_sql(spark, con, name):
    """Same result as the SQL, by a plan without any product of two tables."""
    built = []

    def query(*args):
        built.append(contract.queries()[name](*args))
        return built[0]

    assert compare(spark, con, query, contract.oracle_sql()[name], SF_DIR) is None
    plan = built[0]._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_contract(spark):
    without = set(contract.queries()) - set(contract.oracle_sql())
    assert {n for n in without if not n.startswith(("op", "pipeline"))} == set()
    assert contract.entry(spark).count() > 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark):
    queries = contract.queries()
    for name in ("q19_topk_minmax", "q07_sequence_pack"):
        assert "WindowGroupLimit" in plan_of(queries[name](spark, SF_DIR)), name
    chunks = queries["q10b_match_chunks"](spark, SF_DIR)
    chunks.collect()
    assert "ReusedExchange" in plan_of(chunks)
    assert "ReadSchema: struct<doc_id:bigint>" in plan_of(queries["q11_split_exact"](spark, SF_DIR))
    assert "text" not in plan_of(queries["q19_topk_minmax"](spark, SF_DIR)).split("ReadSchema: ")[1].split(">")[0]
    assert plan_of(queries["q35_batch_infer"](spark, SF_DIR)).count("MapInArrow") == 1
    assert "TakeOrderedAndProject" in plan_of(queries["q29b_sample_source"](spark, SF_DIR))
    assert "PushedFilters: [IsNotNull(source), EqualTo(source,src0)]" in plan_of(queries["q29b_sample_source"](spark, SF_DIR))
