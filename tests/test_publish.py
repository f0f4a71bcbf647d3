"""Publishing, persistent views, audited writes, catalogues, versions, gates."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from wattflow.functions import exact
from wattflow.operators import facts, quality
from wattflow.operators.snapshots import newest_records, snapshot_delta
from wattflow.plans.build import build_marts
from wattflow.sinks import (PublishRefused, create_view, ensure_namespace, publish, read_audit, write_audited)
from wattflow.sources.catalogue import read_catalogues, select_resources, write_catalogues


def test_a_refused_or_failing_rebuild_leaves_the_old_rows(spark, tmp_path):
    ensure_namespace(spark, "pub")
    root = str(tmp_path / "pub")
    check = lambda t: quality.not_null(t, "t", ["k"])
    old, n = publish(spark.range(10).select(F.col("id").alias("k")), "pub", "t", root, check)
    assert n == 10 and old.count() == 10
    running = spark.table("pub.t")
    bad = spark.range(5).select(F.when(F.col("id") > 2, F.col("id")).alias("k"))
    with pytest.raises(PublishRefused):
        publish(bad, "pub", "t", root, check)
    assert spark.table("pub.t").count() == 10
    broken = spark.range(5).select(F.raise_error(F.lit("lost")).cast("bigint").alias("k"))
    with pytest.raises(PySparkException):
        publish(broken, "pub", "t", root, check)
    assert spark.table("pub.t").count() == 10
    with pytest.raises(ValueError):
        publish(spark.range(3).select(F.col("id").cast("string").alias("k")), "pub", "t", root)
    new, _ = publish(spark.range(100, 103).select(F.col("id").alias("k")), "pub", "t", root, check)
    assert sorted(r.k for r in new.collect()) == [100, 101, 102]
    assert running.count() == 10  # a query that was there before reads the old folder
    assert spark.newSession().table("pub.t").count() == 3


def test_views_are_seen_by_other_sessions(spark, tmp_path):
    ensure_namespace(spark, "viewed")
    spark.range(7).write.parquet(str(tmp_path / "a"))
    create_view(spark, "viewed", "v", f"SELECT id FROM parquet.`{tmp_path}/a` WHERE id > 2")
    other = spark.newSession()
    assert other.table("viewed.v").count() == 4
    create_view(spark, "viewed", "v", f"SELECT id FROM parquet.`{tmp_path}/a` WHERE id > 5")
    assert other.table("viewed.v").count() == 1


def test_audit_counts_what_was_written(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, t), (2, t), (3, None)], "k int, processed_at timestamp")
    audit = str(tmp_path / "audit")
    assert write_audited(df, str(tmp_path / "a"), "a", audit, ["k"]) == 3
    assert write_audited(df.limit(0), str(tmp_path / "b"), "b", audit) == 0
    got = {r.table_name: r for r in read_audit(spark, audit).collect()}
    assert (got["a"].rows, got["a"].lineage_nulls, got["a"].lineage_first, got["a"].lineage_last) == (3, 1, t, t)
    assert got["b"].rows == 0 and got["b"].lineage_first is None and got["b"].written_at is not None


def test_newest_records(spark):
    rows = [("a", 1, "x"), ("a", 2, None), ("a", 2, "y"), ("a", 2, "y"), ("b", None, "z"), ("c", None, "z"),
            ("c", 1, None), (None, 1, "p"), (None, 2, "q")]
    got = newest_records(spark.createDataFrame(rows, "k string, v int, x string"), "k", "v").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [("a", 2, "y"), ("b", None, "z"), ("c", 1, None), (None, 1, "p"), (None, 2, "q")], key=str)


def test_fingerprints_refuse_more_columns_than_the_mask_holds(spark):
    wide = spark.range(1).select("id", *[F.lit(1).alias(f"c{i}") for i in range(63)])
    with pytest.raises(ValueError):
        snapshot_delta(wide, wide, "id")


def test_amounts_that_are_no_number_raise(spark):
    for v in ("NaN", "Infinity", "-Infinity"):
        df = spark.createDataFrame([(1.5,), (None,), (float(v.lower().replace("infinity", "inf")),)], "x double")
        with pytest.raises(PySparkException, match="finite"):
            df.agg(F.sum(exact("x"))).collect()
    assert spark.createDataFrame([(1.5,), (None,)], "x double").agg(F.sum(exact("x"))).first()[0] == 1.5


def test_catalogues(spark, tmp_path):
    rows = [(1, 5, None, "csv", "u/GEN_2024_03.csv"), (1, 2, "GEN_2024_03", "pdf", None), (1, 9, "gen_2024_03", "CSV", "v"),
            (2, 1, "GEN_2024_04", "CSV", None)]
    df = spark.createDataFrame(rows, "catalogue bigint, pos bigint, name string, format string, url string")
    write_catalogues(df, str(tmp_path / "c"))
    back = read_catalogues(spark, str(tmp_path / "c"))
    assert [tuple(r) for r in select_resources(back, 2024, 3).collect()] == [(1, 1, None, "u/GEN_2024_03.csv")]
    assert sorted((r.catalogue, r.pos, r.name) for r in back.collect()) == [
        (1, 0, "GEN_2024_03"), (1, 1, None), (1, 2, "gen_2024_03"), (2, 0, "GEN_2024_04")]


def test_sketches_add_up(spark):
    rows = [("A", y, m, "f", True, u) for y in (1, 2) for m in range(1, 13) for u in range(m, m + 40)]
    pre = spark.createDataFrame(rows, "sigla_uf string, ano_geracao int, mes_geracao int, fonte_combustivel string, "
                                      "eh_brasil boolean, id_usina int")
    got = facts.rolled_up_plants(facts.plant_sketches(pre), "sigla_uf").first()
    assert abs(got.num_usinas_estimado - 51) <= 2


def test_checks_that_were_not_run_block(spark, tmp_path):
    results = quality.union_results([])
    assert results.count() == 0 and results.columns == quality.RESULT_COLUMNS
    assert quality.blocking(results, "fact_capacity") == [
        "not_run_dim_state", "not_run_stg_generation", "not_run_stg_registry"]
    from conftest import SF_SMALL
    from wattflow.plans import registry as R
    R.silver_gen(spark, SF_SMALL).write.parquet(str(tmp_path / "g"))
    R.silver_reg(spark, SF_SMALL).write.parquet(str(tmp_path / "r"))
    res = build_marts(spark, str(tmp_path / "g"), str(tmp_path / "r"), str(tmp_path / "out"), suite=quality.CheckSuite())
    assert not res.rows and res.blocked["dim_state"] == ["not_run_stg_generation"]
    assert res.checks.count() == 0
