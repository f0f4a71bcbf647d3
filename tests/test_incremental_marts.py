"""Refreshed marts equal rebuilt ones; untouched months keep their files."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from wattflow.operators import silver
from wattflow.plans.incremental import in_months, refresh_generation
from wattflow.schemas import GENERATION_RAW
from wattflow.sinks import write_partitioned


def _silver(spark, rows):
    """Silver generation of (timestamp or None, state, fuel, plant, value)."""
    raw = spark.createDataFrame(rows, "t timestamp, uf string, fuel string, plant string, v double")
    names = {"din_instante": F.col("t"), "id_estado": F.col("uf"), "nom_estado": F.col("uf"),
             "nom_tipocombustivel": F.col("fuel"), "id_ons": F.col("plant"), "val_geracao": F.col("v")}
    cols = [names.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in GENERATION_RAW.fields]
    return silver.silver_generation(raw.select(*cols), lineage=False)


def _t(month, day=1, year=2024):
    return dt.datetime(year, month, day)


BASE = [(_t(1), "BB", "Gas", "p1", 1.0), (_t(1, 2), "BB", "Gas", "p2", 2.0), (_t(2), "BB", "Gas", "p1", 4.0),
        (_t(2), "DD", "Gas", "p3", 8.0), (_t(3), "DD", "Gas", "p3", 16.0), (None, "BB", "Gas", "p1", 0.5)]


def _files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def _load(spark, tmp_path, before, after, months):
    """Marts of ``before``, refreshed for ``months`` of ``after``; and rebuilt."""
    path, root, anew = (str(tmp_path / n) for n in ("silver", "marts", "anew"))
    write_partitioned(_silver(spark, before), path, ["ano", "mes"])
    first = refresh_generation(spark, path, root)
    old = _files(first.paths["fact_generation_monthly"])
    write_partitioned(_silver(spark, after), path, ["ano", "mes"])
    done = refresh_generation(spark, path, root, months)
    want = refresh_generation(spark, path, anew)
    for name in done.paths:
        a, b = (spark.read.parquet(r.paths[name]) for r in (done, want))
        a = a.select(*b.columns)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name
    return done, old, _files(done.paths["fact_generation_monthly"])


def test_a_load_rewrites_its_month_alone(spark, tmp_path):
    after = BASE[:2] + [(_t(2), "BB", "Gas", "p1", 5.0)] + BASE[3:]
    done, old, new = _load(spark, tmp_path, BASE, after, [(2024, 2)])
    assert not done.whole_fact
    kept = {f for f in old if "mes_geracao=2" not in f}
    assert kept and kept == {f for f in new if "mes_geracao=2" not in f} and all(old[f] == new[f] for f in kept)
    assert not set(old) & {f for f in new if "mes_geracao=2" in f}


def test_null_months_and_new_months(spark, tmp_path):
    after = BASE[:-1] + [(None, "BB", "Gas", "p9", 0.25), (_t(4), "BB", "Gas", "p1", 3.0)]
    done, _, _ = _load(spark, tmp_path, BASE, after, [(None, None), (2024, 4)])
    assert not done.whole_fact


def test_a_month_that_lost_its_rows_leaves_the_fact(spark, tmp_path):
    after = [r for r in BASE if r[0] != _t(3)]
    done, _, new = _load(spark, tmp_path, BASE, after, [(2024, 3)])
    assert not done.whole_fact and not any("mes_geracao=3" in f for f in new)


def test_a_new_last_state_moves_no_key(spark, tmp_path):
    done, _, _ = _load(spark, tmp_path, BASE, [*BASE, (_t(2), "ZZ", "Gas", "p7", 1.0)], [(2024, 2)])
    assert not done.whole_fact


def test_moved_keys_rewrite_the_whole_fact(spark, tmp_path):
    done, _, _ = _load(spark, tmp_path, BASE, [*BASE, (_t(2), "CC", "Coal", "p7", 1.0)], [(2024, 2)])
    assert done.whole_fact


def test_a_lost_state_rewrites_the_whole_fact(spark, tmp_path):
    after = [(t, "DD" if uf == "BB" else uf, f, p, v) for t, uf, f, p, v in BASE]
    months = [(2024, 1), (2024, 2), (2024, 3), (None, None)]
    done, _, _ = _load(spark, tmp_path, BASE, after, months)
    assert done.whole_fact


def test_no_months_change_nothing(spark, tmp_path):
    done, old, new = _load(spark, tmp_path, BASE, BASE, [])
    assert not done.whole_fact and old == new


def test_months_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "silver")
    write_partitioned(_silver(spark, BASE), path, ["ano", "mes"])
    df = spark.read.parquet(path).filter(in_months([(2024, 2), (None, None)], "ano", "mes"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert "Filter (" not in plan  # the partitions alone decide
    assert df.count() == 3
