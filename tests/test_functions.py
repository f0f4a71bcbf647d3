"""Hand-built cases for the column functions and row filters (null semantics)."""

import datetime as dt

from pyspark.sql import functions as F

from wattflow.functions import br_number, classify, flag_in, flag_not_equal, parse_date
from wattflow.functions.numeric import exact, rounded_mean
from wattflow.operators.clean import noise_filter, rename_columns
from wattflow.schemas import (RENEWABLE_FUELS, SMALL_PLANTS_MODE, SOURCE_CATEGORY_DEFAULT,
                              SOURCE_CATEGORY_RULES)

M = SMALL_PLANTS_MODE


def test_noise_filter_three_valued(spark):
    rows = [(M, 0.0), (M, 1.0), (M, None), (None, 0.0), (None, 1.0), (None, None),
            ("X", 0.0), ("X", None)]
    df = spark.createDataFrame(rows, "mode string, val double")
    kept = {tuple(r) for r in noise_filter(df, "mode", M, "val").collect()}
    assert kept == {(M, 1.0), (None, 1.0), ("X", 0.0), ("X", None)}


def test_br_number_cases(spark):
    df = spark.createDataFrame(
        [("32,50",), ("-10,00",), (",50",), (" 7,5 ",), ("1.234,56",), ("x",), ("",), (None,)],
        "t string")
    got = [r[0] for r in df.select(br_number("t")).collect()]
    assert got == [32.5, -10.0, 0.5, 7.5, None, None, None, None]
    thousands = [r[0] for r in df.select(br_number("t", thousands=True)).collect()]
    assert thousands[4] == 1234.56


def test_parse_date_strict(spark):
    df = spark.createDataFrame(
        [("2024-03-05",), ("2024-3-5",), ("05/2024",), ("2024-03-05 10:00:00",),
         ("2024-02-30",), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(parse_date("t")).collect()]
    assert got == [dt.date(2024, 3, 5), None, None, None, None, None, None]


def test_flags_null_semantics(spark):
    df = spark.createDataFrame([("PARAGUAI", "Eólica"), (None, None), ("SUL", "Gás")],
                               "sub string, fuel string")
    out = df.select(flag_not_equal("sub", "PARAGUAI").alias("br"),
                    flag_in("fuel", RENEWABLE_FUELS).alias("ren")).collect()
    assert [tuple(r) for r in out] == [(False, True), (True, None), (True, False)]


def test_classifier_accents_and_order(spark):
    df = spark.createDataFrame(
        [("EÓLICA",), ("Eólica",), ("Óleo Diesel",), ("Gás",), ("Hidráulica",),
         ("Fotovoltaica",), ("Nuclear",), ("Biomassa",), (None,)], "f string")
    got = [r[0] for r in df.select(
        classify("f", SOURCE_CATEGORY_RULES, SOURCE_CATEGORY_DEFAULT)).collect()]
    assert got == ["Eólica", "Eólica", "Térmica/Outras", "Térmica/Outras", "Hídrica", "Solar",
                   "Nuclear", "Biomassa", "Térmica/Outras"]


def test_rounded_mean_half_up(spark):
    df = spark.createDataFrame([(5, 2), (1, 3), (2, 3), (100005, 10)], "s long, n long")
    got = [r[0] for r in df.selectExpr("cast(s * 0.01BD as decimal(36,12)) as t", "n").select(rounded_mean("t", "n")).collect()]
    # 2.5 cents -> 0.03; 0.333 -> 0.00; 0.666 -> 0.01; 10000.5 cents -> 100.01
    assert got == [0.03, 0.0, 0.01, 100.01]


def test_rename_ignores_missing(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rename_columns(df, {"a": "x", "zz": "y"}).columns == ["x", "b"]


def test_exact_sum_keeps_small_amounts_and_any_order(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(0.125,), (0.124,), (0.004,)] + [(0.1,)] * 10, "x double")
    total = [d.agg(F.sum(exact("x")).cast("double")).first()[0]
             for d in (df, df.orderBy("x"), df.repartition(5))]
    assert total == [1.253] * 3
