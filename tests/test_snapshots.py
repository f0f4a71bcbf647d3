"""Snapshot change detection on hand-built snapshots."""

from wattflow.operators.snapshots import snapshot_delta


def test_delta_statuses_and_null_positions(spark):
    prev = spark.createDataFrame(
        [("a", "1", None), ("b", "2", "x"), ("c", "3", "y"), ("d", None, "z")],
        "id string, p string, q string")
    curr = spark.createDataFrame(
        [("a", "1", None), ("b", "2", "CHANGED"), ("d", "z", None), ("e", "5", "w")],
        "id string, p string, q string")
    got = {r.id: r.status for r in snapshot_delta(prev, curr, "id").collect()}
    # d swaps a value between columns and moves the null: must count as changed
    assert got == {"a": "unchanged", "b": "changed", "c": "removed", "d": "changed", "e": "added"}


def test_delta_repeated_key_is_one_row(spark):
    prev = spark.createDataFrame([("k", "1")] * 50, "id string, p string")
    curr = spark.createDataFrame([("k", "1")] * 50 + [("k", "2")], "id string, p string")
    out = snapshot_delta(prev, curr, "id").collect()
    assert [(r.id, r.status) for r in out] == [("k", "changed")]
