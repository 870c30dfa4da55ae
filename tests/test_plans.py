"""Plan lint over every registered query: the shapes that do not survive 100 TB."""

import pytest

from tallyspark.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = {
    "CartesianProduct": "cross join",
    "BroadcastNestedLoopJoin": "nested-loop join (non-equi or missing key)",
    "BatchEvalPython": "row-at-a-time Python UDF",
    "ArrowEvalPython": "Python UDF in a registered query",
    "RoundRobinPartitioning": "shuffle that no operator asks for",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op, why in FORBIDDEN.items():
        assert op not in plan, f"{name}: {why}"
    # column pruning: no query needs all 11 lineitem columns, so no scan may read them all
    for line in plan.splitlines():
        if "FileScan parquet" in line and "lineitem.parquet" in line:
            schema = line.split("ReadSchema: struct<", 1)[1].split(">", 1)[0]
            assert schema.count(":") < 11, f"{name}: lineitem scan not pruned: {schema}"
