"""Dimensions: collapse, surrogate keys (range method == global window)."""

import random

from wattflow.operators import dims


def test_collapse_one_row_per_key_independent_max(spark):
    df = spark.createDataFrame(
        [("SP", "Sao Paulo", "SE", True), ("SP", "S. Paulo", "SUL", None),
         ("RJ", "Rio", None, False), (None, "x", "y", True)],
        "uf string, nome string, sub string, br boolean")
    out = {r.uf: r for r in dims.collapse_dim(df, "uf", ["nome", "sub"], ["br"]).collect()}
    assert set(out) == {"SP", "RJ"}
    assert out["SP"].nome == "Sao Paulo" and out["SP"].sub == "SUL" and out["SP"].br is True
    assert out["RJ"].sub is None and out["RJ"].br is False


def test_surrogate_key_range_equals_global(spark):
    rnd = random.Random(7)
    keys = list({"".join(rnd.choice("abcdefÓé") for _ in range(rnd.randint(1, 6)))
                 for _ in range(3000)})
    df = spark.createDataFrame([(k,) for k in keys] + [(None,)], "k string")
    a = {r.k: r.sk for r in dims.surrogate_key(df, ["k"], "sk", num_partitions=7).collect()}
    b = {r.k: r.sk for r in dims.surrogate_key(df, ["k"], "sk", method="global").collect()}
    assert a == b
    assert sorted(a.values()) == list(range(1, len(keys) + 2))
    assert a[None] == 1  # nulls first, like ORDER BY ... ASC


def test_dim_source_clean_flag(spark):
    stg = spark.createDataFrame(
        [("Nuclear", False), ("Hidráulica", True), ("Gás", False), ("Óleo", None)],
        "fonte_combustivel string, eh_renovavel boolean")
    out = {r.fonte_combustivel: r for r in dims.dim_source(stg).collect()}
    assert out["Nuclear"].eh_limpa and out["Hidráulica"].eh_limpa
    assert out["Gás"].eh_limpa is False and out["Óleo"].eh_limpa is False
    assert [out[k].sk_fonte for k in sorted(out)] == [1, 2, 3, 4]


def test_surrogate_key_collation(spark):
    df = spark.createDataFrame([("Zinco",), ("Óleo",), ("Gás",)], "f string")
    binary = {r.f: r.sk for r in dims.surrogate_key(df, ["f"], "sk").collect()}
    assert binary == {"Gás": 1, "Zinco": 2, "Óleo": 3}
    uni = {r.f: r.sk for r in dims.surrogate_key(df, ["f"], "sk", collation="UNICODE").collect()}
    assert uni == {"Gás": 1, "Óleo": 2, "Zinco": 3}
    glob = {r.f: r.sk for r in dims.surrogate_key(df, ["f"], "sk", method="global",
                                                   collation="UNICODE").collect()}
    assert glob == uni


def test_surrogate_key_many_keys_with_other_columns(spark, tmp_path):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    n = 1_000_000
    df = spark.range(n).select(F.md5(F.col("id").cast("string")).alias("k"),
                               (F.col("id") * 2).alias("a"), F.concat(F.lit("x"), "id").alias("b"))
    path = str(tmp_path / "keyed")
    dims.surrogate_key(df, ["k"], "sk", num_partitions=40).write.parquet(path)
    back = spark.read.parquet(path)
    r = back.agg(F.count_distinct("sk").alias("d"), F.min("sk").alias("lo"), F.max("sk").alias("hi")).first()
    assert (r.d, r.lo, r.hi) == (n, 1, n)
    want = df.withColumn("want", F.row_number().over(Window.orderBy("k")))
    assert back.join(want.select("a", "want"), "a").where("sk <> want or b is null").count() == 0
