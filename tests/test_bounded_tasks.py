"""Plans whose tasks, shuffles and files stay small as the tables grow."""

import glob

from conftest import SF_SMALL

from wattflow.operators import dims
from wattflow.plans import build, registry as R
from wattflow.session import PIECES, bounded_pieces
from wattflow.sinks import files
from wattflow.sources import fixtures as fx
from wattflow.streaming import incremental


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bounded_pieces_keep_what_the_session_sets(spark):
    scan, initial = PIECES
    before = [spark.conf.get(k, None) for k in PIECES]  # None: not set
    with bounded_pieces(spark):
        assert spark.conf.get(scan) == "8m" and spark.conf.get(initial) == "600"
    assert [spark.conf.get(k, None) for k in PIECES] == before
    spark.conf.set(initial, "7")
    try:
        with bounded_pieces(spark):
            assert spark.conf.get(initial) == "7"
        assert spark.conf.get(initial) == "7"
    finally:
        spark.conf.unset(initial)


def test_marts_are_aggregated_in_small_pieces(spark, monkeypatch):
    from wattflow.plans import marts
    seen = []
    real = marts.stage
    monkeypatch.setattr(marts, "stage", lambda df, name: seen.append(
        spark.conf.get("spark.sql.files.maxPartitionBytes")) or real(df, name))
    R.marts_gen(spark, SF_SMALL)
    assert seen == ["8m"]


def test_small_tables_are_not_shuffled_with_the_large_one(spark):
    for df in (fx.gen_raw(spark, SF_SMALL), fx.reg_raw(spark, SF_SMALL)):
        assert "SortMergeJoin" not in _plan(df)


def test_collapse_does_not_sort_the_input_rows(spark):
    df = spark.createDataFrame([("A", "x", True), ("A", "y", False), ("A", "y", False), (None, "z", True)],
                               "k string, d string, f boolean")
    out = dims.collapse_dim(df, "k", ["d"], ["f"])
    # rows are combined by hash first: the sort is above an exchange of the combinations
    plan = _plan(out)
    assert plan.count("HashAggregate") >= 2 + plan.count("ObjectHashAggregate")
    assert [tuple(r) for r in out.collect()] == [("A", "y", True)]


def test_silver_of_landed_months_is_written_without_a_shuffle(spark, tmp_path, monkeypatch):
    asked = []

    def write(df, path, keys=(), **kw):
        asked.append((path.rsplit("/", 1)[-1].split("-")[0], kw.get("rebalance", True)))
        return files.write_partitioned(df, path, keys, **kw)

    monkeypatch.setattr(build, "write_partitioned", write)
    monkeypatch.setattr(incremental, "write_partitioned", write)
    bronze = R._land_generation(spark, SF_SMALL)
    incremental.run_silver_generation(spark, bronze, str(tmp_path / "stream"), str(tmp_path / "ckpt"), lineage=False)
    build.build_silver(spark, bronze, R._land_snapshots(spark, SF_SMALL), str(tmp_path / "out"))
    assert dict(asked) == {"stream": False, "generation": False, "registry": True}
    whole = R.silver_gen(spark, SF_SMALL)
    for path in (f"{tmp_path}/stream", f"{tmp_path}/out/silver/generation"):
        got = spark.read.parquet(path)
        cols = [c for c in whole.columns if c in got.columns]
        assert got.select(cols).exceptAll(whole.select(cols)).count() == 0 and got.count() == whole.count()


def test_landings_are_packed_and_read_back_whole(spark):
    root = R._land_snapshots(spark, SF_SMALL)
    landed = glob.glob(f"{root.removeprefix('file:')}/*/*.csv*")
    assert landed and all(f.endswith(".csv.gz") for f in landed)
    from wattflow.schemas import REGISTRY_RAW
    from wattflow.sources.delimited import read_delimited
    got = read_delimited(spark, root, REGISTRY_RAW, encoding="ISO-8859-1").drop("snapshot_date")
    want = fx.reg_snapshot(spark, SF_SMALL, 0).unionByName(fx.reg_snapshot(spark, SF_SMALL, 1))
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()
