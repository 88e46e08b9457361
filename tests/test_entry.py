import __spark_entry__
from spantrack import queries


def test_entry(spark):
    out = __spark_entry__.entry(spark)
    assert out.columns == ["pair", "chrom", "bin_start", "bin_end", "value"] and out.limit(1).count() == 1


def test_every_core_query_has_sql():
    found, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(queries.queries()) <= set(found) and set(queries.queries()) <= set(sql) <= set(found)


def test_flagship_plan_reads_what_it_needs(spark):
    """One scan's columns are pruned, and nothing is a cross product or a Python call."""
    plan = __spark_entry__.entry(spark)._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" not in plan and "CartesianProduct" not in plan and "Python" not in plan and "NestedLoop" not in plan
