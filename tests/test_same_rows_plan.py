"""How the query of same_rows joins."""

from sqlyard.plans import catalog


def test_lines_are_joined_without_a_sort(spark, sf):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = catalog.same_rows(spark, sf)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
        assert found.collect() == [(True,)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
