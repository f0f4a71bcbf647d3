"""Scans and sinks on small hand-written files: CSV binding, encodings,
partition discovery, snapshot selection, catalogue choice, landing checks."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from wattflow.schemas import GENERATION_RAW, REGISTRY_RAW
from wattflow.sinks import land_raw, write_partitioned
from wattflow.sources.catalogue import read_catalogue, resolve_resource, select_resource
from wattflow.sources.delimited import (read_delimited, read_generation_bronze,
                                        read_registry_bronze, select_snapshot)
from wattflow.sources.landing import landing_check

HEADER = ";".join(f.name for f in GENERATION_RAW.fields)


def _write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding) as f:
        f.write(text)


def test_csv_positional_binding_and_bad_fields(spark, tmp_path):
    root = tmp_path / "bronze"
    _write(str(root / "year=2024" / "month=12" / "a.csv"), "\n".join([
        HEADER,
        "2024-12-01 10:00:00;1;SE;SP;Sao Paulo;TIPO I;UHE;Hidráulica;U1;1;C1;10.5",
        "not-a-time;1;SE;SP;Sao Paulo;TIPO I;UHE;Hidráulica;U1;1;C1;3",   # bad timestamp
        "2024-12-01 11:00:00;1;SE",                                        # short row
        "2024-12-01 12:00:00;1;SE;SP;S;T;U;F;N;1;C;4;extra;more",          # long row
        "2024-12-01 13:00:00;1;SE;SP;S;T;U;F;N;1;C;32,5",                  # comma decimal
    ]) + "\n")
    df = read_generation_bronze(spark, str(root))
    rows = df.orderBy(F.col("din_instante").asc_nulls_first(), "val_geracao").collect()
    assert df.columns[-2:] == ["year", "month"]          # partition columns leak in
    assert all(r.year == 2024 and r.month == 12 for r in rows)
    bad_ts = [r for r in rows if r.din_instante is None]
    assert len(bad_ts) == 1 and bad_ts[0].val_geracao == 3.0
    short = [r for r in rows if r.din_instante == dt.datetime(2024, 12, 1, 11)][0]
    assert short.id_estado is None and short.val_geracao is None
    long_ = [r for r in rows if r.din_instante == dt.datetime(2024, 12, 1, 12)][0]
    assert long_.val_geracao == 4.0
    comma = [r for r in rows if r.din_instante == dt.datetime(2024, 12, 1, 13)][0]
    assert comma.val_geracao is None
    fuel = [r for r in rows if r.val_geracao == 10.5][0]
    assert fuel.nom_tipocombustivel == "Hidráulica"


def test_corrupt_record_column(spark, tmp_path):
    path = str(tmp_path / "c.csv")
    _write(path, HEADER + "\nnot-a-time;1;SE;SP;S;T;U;F;N;1;C;3\n")
    df = read_delimited(spark, path, GENERATION_RAW, corrupt_column="_corrupt_record")
    r = df.first()
    assert r.din_instante is None and r._corrupt_record.startswith("not-a-time")


def test_latin1_landing_round_trip_and_snapshots(spark, tmp_path):
    cols = [f.name for f in REGISTRY_RAW.fields]
    base = {c: None for c in cols}
    rows = [{**base, "CodEmpreendimento": "GD.1", "DscFonteGeracao": "Radiação solar",
             "MdaPotenciaInstaladaKW": "5,00", "SigUF": "SP", "CodUFibge": 35},
            {**base, "CodEmpreendimento": "GD.2", "DscFonteGeracao": "Eólica; \"quoted\"",
             "MdaPotenciaInstaladaKW": "1,5", "SigUF": "RJ"}]
    df = spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], REGISTRY_RAW)
    root = str(tmp_path / "reg")
    assert land_raw(df, root, {"snapshot_date": "2024-01-01"}, encoding="ISO-8859-1") == 2
    assert land_raw(df.limit(1), root, {"snapshot_date": "2024-02-01"},
                    encoding="ISO-8859-1") == 1
    # the landed bytes really are latin-1
    files = [os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".csv")]
    assert any("Radiação".encode("latin-1") in open(f, "rb").read() for f in files)
    all_ = read_registry_bronze(spark, root, "all")
    latest = read_registry_bronze(spark, root, "latest")
    assert all_.count() == 3
    got = latest.collect()
    assert len(got) == 1 and got[0].snapshot_date == dt.date(2024, 2, 1)
    fonte = {r.CodEmpreendimento: r.DscFonteGeracao for r in all_.collect()}
    assert fonte["GD.2"] == 'Eólica; "quoted"' and fonte["GD.1"] == "Radiação solar"
    assert {r.CodUFibge for r in all_.collect()} == {35, None}
    # re-landing one snapshot replaces only that snapshot
    land_raw(df, root, {"snapshot_date": "2024-02-01"}, encoding="ISO-8859-1")
    assert read_registry_bronze(spark, root, "all").count() == 4
    with pytest.raises(ValueError):
        select_snapshot(all_, mode="first")


def test_write_partitioned_counts_and_dynamic_overwrite(spark, tmp_path):
    out = str(tmp_path / "silver")
    df = spark.createDataFrame([(2024, 1, 1.0), (2024, 1, 2.0), (2024, 2, 3.0)],
                               "ano int, mes int, v double")
    assert write_partitioned(df, out, ["ano", "mes"]) == 3
    repl = spark.createDataFrame([(2024, 2, 9.0)], "ano int, mes int, v double")
    assert write_partitioned(repl, out, ["ano", "mes"], dynamic=True) == 1
    back = spark.read.parquet(out)
    assert sorted(r.v for r in back.collect()) == [1.0, 2.0, 9.0]
    plan = back.filter("ano = 2024 AND mes = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "partitionFilters" in plan.lower()


CATALOGUE = {"result": {"resources": [
    {"name": "GEN_2024_12", "format": "pdf", "url": "http://x/a.pdf"},        # right period, not CSV
    {"name": None, "format": "csv", "url": "http://x/gen_2024_12.csv"},       # url only, lower case
    {"name": "GEN_2024_12_B", "format": "CSV", "url": "http://x/b.csv"},      # later match
    {"name": "GEN_2024_11", "format": "CSV", "url": "http://x/c.csv"},
]}}


def test_catalogue_first_match_in_order(spark, tmp_path):
    path = str(tmp_path / "cat.json")
    _write(path, json.dumps(CATALOGUE))
    res = read_catalogue(spark, path)
    assert resolve_resource(res, 2024, 12) == {"url": "http://x/gen_2024_12.csv", "name": None}
    assert resolve_resource(res, 2024, 11)["name"] == "GEN_2024_11"
    assert select_resource(res, 2023, 1).count() == 0
    with pytest.raises(ValueError):
        resolve_resource(res, 2023, 1)


def test_landing_check_files(spark, tmp_path):
    root = tmp_path / "landing"
    _write(str(root / "good.csv"), "a;b\n1;2\n")
    _write(str(root / "error.csv"), "<!DOCTYPE html>\n<HTML><body>error</body></HTML>")
    _write(str(root / "late_html.csv"), "x" * 120 + "<html>")
    _write(str(root / "empty.csv"), "")
    expected = spark.createDataFrame(
        [(f"file:{root}/{n}",) for n in ["good.csv", "error.csv", "late_html.csv", "empty.csv"]],
        "path string")
    out = {os.path.basename(r.path): r for r in landing_check(spark, str(root), expected).collect()}
    assert out["good.csv"].ok and not out["good.csv"].is_html
    assert out["error.csv"].is_html and not out["error.csv"].ok
    assert out["late_html.csv"].ok            # marker beyond the first 100 bytes
    assert not out["empty.csv"].ok and out["empty.csv"].reason == "missing_or_empty"


def test_materialize_view_and_table(spark, tmp_path):
    from wattflow.sinks import ensure_namespace, materialize
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    view, n = materialize(df, "wf_test_view", "view")
    assert n is None and spark.table("wf_test_view").count() == 2
    ensure_namespace(spark, "wf_test_ns", str(tmp_path / "ns"))
    tab, n = materialize(df, "t1", "table", "wf_test_ns", path=str(tmp_path / "t1"))
    assert n == 2 and tab.count() == 2
    tab, n = materialize(df.filter("k = 1"), "t1", "table", "wf_test_ns",
                         path=str(tmp_path / "t1b"))
    assert n == 1 and spark.table("wf_test_ns.t1").count() == 1   # full refresh


def test_latest_partition_value_types(spark, tmp_path):
    from wattflow.sources.delimited import latest_partition_value
    for name, vals, want in [("i", [9, 10, 2], "10"), ("d", ["2024-01-31", "2024-10-01"], "2024-10-01")]:
        df = spark.createDataFrame([(v, 1) for v in vals], f"{name} {'int' if name == 'i' else 'string'}, x int")
        if name == "d":
            df = df.withColumn("d", F.to_date("d"))
        out = str(tmp_path / name)
        df.write.partitionBy(name).parquet(out)
        back = spark.read.parquet(out)
        assert latest_partition_value(back, name) == want
        assert select_snapshot(back, name, "latest").count() == 1
    assert latest_partition_value(spark.range(3), "id") is None


def test_latest_folder_looks_at_the_first_level(spark, tmp_path):
    import datetime as dt
    from pyspark.sql.types import DateType, IntegerType
    from wattflow.sources.delimited import latest_folder

    root = tmp_path / "landed"
    for day, name, data in (("2024-01-31", "a.csv", b"x"), ("2024-02-01", "a.csv", b"x"), ("2024-03-01", "a.csv", b""),
                            ("2024-04-01", "_SUCCESS", b"x"), ("__HIVE_DEFAULT_PARTITION__", "a.csv", b"x")):
        (root / f"snapshot_date={day}").mkdir(parents=True)
        (root / f"snapshot_date={day}" / name).write_bytes(data)
    assert latest_folder(spark, str(root), "snapshot_date", DateType()) == dt.date(2024, 2, 1).isoformat()
    for n in (9, 10):
        (tmp_path / "n" / f"run={n}" / "sub").mkdir(parents=True)
        (tmp_path / "n" / f"run={n}" / "sub" / "a.csv").write_bytes(b"x")
    assert latest_folder(spark, str(tmp_path / "n"), "run", IntegerType()) == "10"
    assert latest_folder(spark, str(tmp_path / "absent"), "run", IntegerType()) is None


def test_declared_sources_stay_while_they_grow(spark, tmp_path):
    from wattflow.sources.named import register_sources, source

    path, flat = str(tmp_path / "t"), str(tmp_path / "flat")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    rows.write.partitionBy("p").parquet(path)
    rows.write.parquet(flat)
    register_sources(spark, "wattflow_grow", {"t": path, "flat": flat}, location=str(tmp_path / "ns"))
    for t in ("t", "flat"):
        spark.sql(f"ALTER TABLE wattflow_grow.{t} SET TBLPROPERTIES ('mark'='1')")

    def marked(t):
        return spark.sql(f"SHOW TBLPROPERTIES wattflow_grow.{t}").filter("key = 'mark'").count() == 1

    rows.withColumn("p", F.lit("c")).write.mode("append").partitionBy("p").parquet(path)
    for f in (tmp_path / "t" / "p=a").iterdir():
        f.unlink()
    (tmp_path / "t" / "p=a").rmdir()
    moved = str(tmp_path / "flat2")
    rows.limit(1).write.parquet(moved)
    register_sources(spark, "wattflow_grow", {"t": path, "flat": moved})
    assert sorted(map(tuple, source(spark, "wattflow_grow", "t").collect())) == [(1, "c"), (2, "b"), (2, "c")]
    assert source(spark, "wattflow_grow", "flat").count() == 1 and marked("t") and marked("flat")
    # other columns: declared anew
    rows.withColumn("w", F.lit(1)).write.mode("overwrite").parquet(moved)
    register_sources(spark, "wattflow_grow", {"flat": moved})
    assert source(spark, "wattflow_grow", "flat").columns == ["v", "p", "w"] and not marked("flat")


def test_writes_without_rows_are_counted(spark, tmp_path):
    from wattflow.sinks import write_partitioned

    none = spark.createDataFrame([], "v int, p string")
    assert write_partitioned(none, str(tmp_path / "a"), ["p"]) == 0
    none.write.parquet(str(tmp_path / "b"))
    read = spark.read.schema("v int, p string").parquet(str(tmp_path / "b"))
    assert write_partitioned(read, str(tmp_path / "c"), ["p"], dynamic=True) == 0
