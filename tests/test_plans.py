"""Plan checks: no cross joins anywhere, and column pruning reaches the scan."""

import pytest

from __spark_entry__ import oracle_sql, queries
from partqc.operators import evaluate
from partqc.sources.tables import events_view

from conftest import SF01

CROSS = ("CartesianProduct", "BroadcastNestedLoopJoin")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_no_cross_join(spark, name):
    plan = _plan(queries()[name](spark, SF01))
    assert not any(op in plan for op in CROSS), name


def test_pruned_scan(spark):
    plan = _plan(queries()["select_columns"](spark, SF01))
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan
    ev = events_view(spark, SF01)  # ROC and AUC read this table of counts, kept once
    plan = _plan(evaluate.score_counts(ev, "y", "value"))
    assert "ReadSchema: struct<event_type:string,value:double>" in plan


def test_json_parse_is_map_only(spark):
    plan = _plan(queries()["json_flatten"](spark, SF01))
    assert "Exchange" not in plan and plan.count("from_json") == 1
