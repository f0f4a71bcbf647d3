"""Plan assertions: pruning and push-down reach the scan, fixed-size tables
are broadcast, no Python UDF in any registered query, gates in the build."""

import pytest

from conftest import SF_SMALL
from wattflow.plans import registry as R

# keys that run writes / streams while being defined
SIDE_EFFECT_KEYS = {"silver_generation_csv", "silver_registry_csv", "full_refresh_table",
                    "raw_landing", "latest_snapshot", "incremental_period",
                    "silver_generation_stream", "named_sources", "medallion_build"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_pruning_and_pushdown(spark):
    import re
    plan = _plan(R.stg_gen(spark, SF_SMALL))
    assert "PushedFilters" in plan or "DataFilters" in plan
    # only the six lineitem columns the adapter needs are read
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    li = [s for s in scans if "l_orderkey" in s]
    assert li and all(re.sub(r"#\d+L?", "", s) ==
                      "l_orderkey,l_partkey,l_suppkey,l_quantity,l_returnflag,l_shipdate"
                      for s in li)
    # fixed-size tables are broadcast; growing ones are left to the planner and adaptive execution
    assert "BroadcastExchange" in plan


@pytest.mark.parametrize("key", sorted(set(R.QUERIES) - SIDE_EFFECT_KEYS))
def test_no_python_udf_in_plan(spark, key):
    plan = _plan(R.QUERIES[key](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan, f"{key} plans a Python node {node}"


def test_latest_snapshot_prunes_partitions(spark, tmp_path):
    from wattflow.sinks import land_raw
    from wattflow.sources.delimited import read_registry_bronze
    from wattflow.sources.fixtures import reg_snapshot
    root = str(tmp_path / "reg")
    land_raw(reg_snapshot(spark, SF_SMALL, 0), root, {"snapshot_date": "2024-01-01"})
    land_raw(reg_snapshot(spark, SF_SMALL, 1), root, {"snapshot_date": "2024-02-01"})
    df = read_registry_bronze(spark, root, "latest")
    assert {r.snapshot_date.isoformat() for r in df.select("snapshot_date").distinct().collect()} \
        == {"2024-02-01"}
    assert "PartitionFilters" in _plan(df) or "partitionFilters" in _plan(df).lower()


@pytest.mark.parametrize("key", sorted(set(R.QUERIES) - SIDE_EFFECT_KEYS))
def test_no_cross_or_nested_loop_join(spark, key):
    plan = _plan(R.QUERIES[key](spark, SF_SMALL))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, f"{key} plans {node}"


def test_cluster_needs_a_shared_checkpoint_folder():
    from types import SimpleNamespace
    import pytest
    from wattflow.session import ensure_checkpoint_dir

    conf = SimpleNamespace(get=lambda k, d=None: d)
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None, getConf=lambda: conf)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=conf))


def test_planning_the_landing_check_moves_nothing(spark):
    assert "Exchange" not in _plan(R.QUERIES["landing_check"](spark, "/root/testdata/sf0.001"))
