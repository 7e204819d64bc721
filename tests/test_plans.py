"""Plan guards: no cross / nested-loop joins and no Python evaluation in any registered query."""

import __spark_entry__ as E
from squall.plans import standins

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas"]


def test_registered_query_plans_avoid_forbidden_operators(spark):
    offenders = {}
    for name in standins.QUERIES:
        fn = E.queries()[name]
        plan = fn(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        hits = [op for op in FORBIDDEN if op in plan]
        if hits:
            offenders[name] = hits
    assert offenders == {}


def test_scans_prune_columns_and_push_filters(spark):
    plan = E.queries()["asof_nearest"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_id)]" in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan  # documents: two of five columns
