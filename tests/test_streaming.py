"""Incremental silver load: each landed file is processed once across runs."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from wattflow.operators.silver import silver_generation
from wattflow.schemas import GENERATION_RAW, SMALL_PLANTS_MODE
from wattflow.sinks import land_raw
from wattflow.sources import fixtures as fx
from wattflow.streaming import run_silver_generation


def test_stream_resumes_from_checkpoint(spark, tmp_path):
    raw = fx.gen_raw(spark, SF_SMALL).withColumns({
        "year": F.date_format("din_instante", "yyyy"),
        "month": F.date_format("din_instante", "MM")})
    early = raw.filter(F.col("year") < "1998")
    late = raw.filter(F.col("year") >= "1998")
    bronze, out, ckpt = str(tmp_path / "bronze"), str(tmp_path / "silver"), str(tmp_path / "ckpt")

    land_raw(early, bronze, partition_cols=["year", "month"])
    run_silver_generation(spark, bronze, out, ckpt, lineage=False)
    first = spark.read.parquet(out).count()
    assert first == silver_generation(early.drop("year", "month"), lineage=False).count()

    land_raw(late, bronze, partition_cols=["year", "month"])     # the next months arrive
    run_silver_generation(spark, bronze, out, ckpt, lineage=False)
    run_silver_generation(spark, bronze, out, ckpt, lineage=False)  # nothing new: no-op
    back = spark.read.parquet(out)
    want = silver_generation(fx.gen_raw(spark, SF_SMALL), lineage=False)
    assert back.count() == want.count()
    cols = [c for c in want.columns]
    assert back.select(*cols).exceptAll(want).count() == 0


def test_a_period_landed_again_is_there_once(spark, tmp_path):
    raw = fx.gen_raw(spark, SF_SMALL).where("year(din_instante) = 1996 and month(din_instante) < 4").withColumns({
        "year": F.date_format("din_instante", "yyyy"),
        "month": F.date_format("din_instante", "MM")})
    bronze, out, ckpt = str(tmp_path / "bronze"), str(tmp_path / "silver"), str(tmp_path / "ckpt")
    land_raw(raw, bronze, partition_cols=["year", "month"])
    run_silver_generation(spark, bronze, out, ckpt, lineage=False)
    want = spark.read.parquet(out).count()
    march = raw.where("month = '03'").drop("year", "month").withColumn("val_geracao", F.col("val_geracao") + 1000)
    land_raw(march, bronze, {"year": "1996", "month": "03"}, encoding="UTF-8")
    run_silver_generation(spark, bronze, out, ckpt, lineage=False)
    back = spark.read.parquet(out)
    again = silver_generation(march, lineage=False).count()
    assert back.where("mes < 3").count() + again == back.count()
    assert back.where("mes = 3 and val_geracao < 900").count() == 0
    assert back.where("mes < 3").count() < want


def test_rows_off_their_landing_period_survive_refreshes(spark, tmp_path):
    """Rows without a readable instant, rows of another month and the null period, over several runs."""
    bronze, out, ckpt = str(tmp_path / "bronze"), str(tmp_path / "silver"), str(tmp_path / "ckpt")

    def land(name, instants, year="2024", month="__HIVE_DEFAULT_PARTITION__", mode="TIPO I", value="1.0"):
        rows = [(i, *[name] * 4, mode, *[name] * 5, value) for i in instants]
        cols = [f.name for f in GENERATION_RAW.fields]
        spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols)).coalesce(1).write.mode("overwrite").csv(
            f"{bronze}/year={year}/month={month}", sep=";", header=True, emptyValue="")

    def refreshed():
        run_silver_generation(spark, bronze, out, ckpt, lineage=False)
        return sorted((r.nom_usina, str(r.din_instante), r.mes, r.year, r.month) for r in spark.read.parquet(out).collect())

    null = "__HIVE_DEFAULT_PARTITION__"
    land("march", ["2024-03-01 00:00:00", "not a time", None, "2024-04-30 23:00:00"], month="03")
    land("lost", [None], year=null)
    march = [("march", "2024-03-01 00:00:00", 3, 2024, 3), ("march", "2024-04-30 23:00:00", 4, 2024, 3),
             ("march", "None", None, 2024, 3), ("march", "None", None, 2024, 3)]
    assert refreshed() == [("lost", "None", None, None, None), *march]

    land("april", ["2024-04-01 00:00:00", None, "2024-03-31 23:00:00"], month="04")
    april = [("april", "2024-03-31 23:00:00", 3, 2024, 4), ("april", "2024-04-01 00:00:00", 4, 2024, 4),
             ("april", "None", None, 2024, 4)]
    assert refreshed() == [*april, ("lost", "None", None, None, None), *march]

    land("found", [None, None], year=null)  # the null period landed anew
    assert refreshed() == [*april, *[("found", "None", None, None, None)] * 2, *march]
    assert refreshed() == [*april, *[("found", "None", None, None, None)] * 2, *march]  # nothing new

    land("noise", ["2024-04-01 00:00:00"], month="04", mode=SMALL_PLANTS_MODE, value="0")  # all of it is filtered out
    assert refreshed() == [*[("found", "None", None, None, None)] * 2, *march]
