"""Marts written once and read by every report."""

import re

from conftest import SF_SMALL

from wattflow.plans import marts
from wattflow.plans import registry as R


def _scans(df) -> str:
    text = df._jdf.queryExecution().toString()
    return " ".join(re.findall(r"Location: [^\n]*|parquet [^\n]*", text))


def test_reports_share_one_build(spark, monkeypatch):
    built = []
    real = R.marts_gen
    monkeypatch.setattr(R, "marts_gen", lambda *a: built.append(1) or real(*a))
    marts._STORED.clear()
    first = R.QUERIES["kpi_total"](spark, SF_SMALL)
    assert first.count() == 1
    for key in ("top_states_renewable", "share_by_source", "drill_across"):
        df = R.QUERIES[key](spark, SF_SMALL)
        assert df.count() > 0 and "lineitem" not in _scans(df)
    assert len(built) == 1


def test_marts_are_rebuilt_when_inputs_change_or_they_are_gone(spark, tmp_path):
    root = str(tmp_path / "in")
    built = []

    def build():
        built.append(1)
        return {"t": spark.read.parquet(f"{root}/a.parquet").groupBy().sum("id")}

    def total():
        return marts.stored_marts(spark, root, "test", build)["t"].first()[0]

    spark.range(10).write.parquet(f"{root}/a.parquet")
    assert total() == 45 and total() == 45 and len(built) == 1
    spark.range(20).write.mode("overwrite").parquet(f"{root}/a.parquet")
    assert total() == 190 and len(built) == 2
    marts._STORED.update({k: (state, str(tmp_path / "gone"), schemas) for k, (state, _, schemas) in marts._STORED.items()})
    assert total() == 190 and len(built) == 3
