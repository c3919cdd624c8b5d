"""What the optimiser must make of the queries."""

import pytest
from oracle import DATA

from tessera import queries

queries.load()


def plan(spark, name):
    return queries.QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name, parts",
    [
        ("filter_compare", ["GreaterThan(l_quantity,45.0)", "LessThanOrEqual(l_discount,0.03)", "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_discount:double,l_tax:double>"]),
        ("filter_in", ["In(o_orderpriority, [1-URGENT,2-HIGH])", "EqualTo(o_orderstatus,F)"]),
        ("filter_dates", ["GreaterThanOrEqual(o_orderdate,1995-01-01T00:00)"]),
        ("fn_date", ["PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate,1995-01-01T00:00)"]),
        ("scan_zero_columns", ["ReadSchema: struct<>"]),
        ("join_broadcast", ["BroadcastHashJoin"]),
        ("join_semi", ["LeftSemi", "GreaterThan(l_quantity,49.0)"]),
        ("join_anti", ["LeftAnti"]),
        ("join_existence_or", ["ExistenceJoin"]),
        ("topk", ["TakeOrderedAndProject"]),
        ("win_rank", ["WindowGroupLimit"]),
        ("agg_group", ["partial_count"]),
        ("table_scan_pruned", ["GreaterThan(o_totalprice,250000.0)", "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>"]),
    ],
)
def test_plan(spark, name, parts):
    text = plan(spark, name)
    for p in parts:
        assert p in text, text
    assert "CartesianProduct" not in text and "Python" not in text


def test_cross_of_scalars_is_one_pass(spark):
    assert plan(spark, "join_cross_scalars").count("FileScan") == 1
