"""Each check kind with a passing and a failing input; counting rules."""

from wattflow.operators import quality


def _failures(df):
    return {r.check_id: r.failures for r in df.collect()}


def test_not_null_counts_rows_in_one_scan(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "a")], "a int, b string")
    res = quality.not_null(df, "t", ["a", "b"])
    assert _failures(res) == {"not_null_t_a": 1, "not_null_t_b": 2}
    ok = quality.not_null(spark.createDataFrame([(1,)], "a int"), "t", ["a"]).first()
    assert ok.failures == 0 and ok.should_error is False


def test_unique_counts_keys_not_rows(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "k int")
    res = quality.unique(df, "t", "k").first()
    assert res.failures == 1 and res.should_warn and res.should_error
    assert quality.unique(spark.createDataFrame([(1,), (2,)], "k int"), "t", "k").first().failures == 0


def test_accepted_values_counts_distinct_bad_values_null_passes(spark):
    df = spark.createDataFrame([("a",), ("x",), ("x",), ("y",), (None,)], "c string")
    assert quality.accepted_values(df, "t", "c", ["a", "b"]).first().failures == 2
    good = spark.createDataFrame([("a",), (None,)], "c string")
    assert quality.accepted_values(good, "t", "c", ["a"]).first().failures == 0


def test_relationships_counts_orphan_rows_null_child_passes(spark):
    parent = spark.createDataFrame([("SP",), ("RJ",)], "uf string")
    child = spark.createDataFrame([("SP",), ("XX",), ("XX",), (None,)], "uf string")
    assert quality.relationships(child, "f", "uf", parent, "uf").first().failures == 2
    good = spark.createDataFrame([("SP",), (None,)], "uf string")
    assert quality.relationships(good, "f", "uf", parent, "uf").first().failures == 0


def test_gate_blocks_only_downstream(spark):
    res = quality.union_results([
        quality.not_null(spark.createDataFrame([(None,)], "a int"), "stg_registry", ["a"]),
        quality.not_null(spark.createDataFrame([(1,)], "a int"), "stg_generation", ["a"]),
    ])
    status = {r.model: r.status for r in quality.gate(res).collect()}
    assert status["fact_capacity"] == "blocked"
    assert status["fact_generation_monthly"] == "not_run"  # its dimensions have no results
    assert status["dim_state"] == "ready"
    import pytest
    with pytest.raises(RuntimeError):
        quality.enforce(res, "fact_capacity")
    quality.enforce(res, "dim_state")


ONCE = quality.CheckSuite(
    not_null={"f": ["k", "v"], "d": ["k"], "gone": ["x"]}, unique={"d": ["k", "code"]},
    accepted_values={"d": [("kind", ["a", "b"]), ("code", [1, 2])]}, relationships={"f": [("k", "d", "k"), ("v", "gone", "x")]})


def _once_models(spark, empty=False):
    f = spark.createDataFrame([("A", 1.0), ("A", None), ("X", 2.0), ("X", 2.0), (None, None)], "k string, v double")
    d = spark.createDataFrame([("A", 1, "a"), ("A", 2, "z"), ("B", 2, "y"), ("C", None, None), (None, 9, "a")],
                              "k string, code int, kind string")
    return {m: t.limit(0) if empty else t for m, t in (("f", f), ("d", d))}


def test_one_pass_equals_the_single_checks(spark):
    for empty in (False, True):
        models = _once_models(spark, empty)
        once, single = ONCE.run_once(models), ONCE.run(models)
        assert once.columns == single.columns == quality.RESULT_COLUMNS
        assert sorted(map(tuple, once.collect())) == sorted(map(tuple, single.collect()))
    got = _failures(ONCE.run_once(_once_models(spark)))
    assert got == {"not_null_f_k": 1, "not_null_f_v": 2, "not_null_d_k": 1, "unique_d_k": 1, "unique_d_code": 1,
                   "accepted_values_d_kind": 2, "accepted_values_d_code": 1, "relationships_f_k": 2}
    assert ONCE.run_once({}).isEmpty()


def test_one_pass_reads_each_table_once(spark, tmp_path):
    models = {}
    for m, df in _once_models(spark).items():
        df.write.parquet(str(tmp_path / m))
        models[m] = spark.read.parquet(str(tmp_path / m))
    plan = ONCE.ledger(models)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2
    results = ONCE.run_once(models)._jdf.queryExecution().optimizedPlan().toString()
    assert "code#" not in results  # the results come from the written ledger


def test_one_pass_compares_columns_of_one_type(spark):
    import pytest
    models = {"f": spark.createDataFrame([(1,)], "k int"), "d": spark.createDataFrame([("1",)], "k string")}
    with pytest.raises(ValueError, match="differ in type"):
        quality.CheckSuite(relationships={"f": [("k", "d", "k")]}).run_once(models)


def test_suite_builds_only_the_models_its_checks_read(spark):
    from wattflow.plans.registry import _OnDemand
    built = []

    def make(name):
        def build():
            built.append(name)
            return spark.createDataFrame([("a",)], "k string")
        return build

    models = _OnDemand({m: make(m) for m in ["dim_state", "dim_source", "fact_capacity"]})
    res = quality.CheckSuite(unique={"dim_state": ["k"]},
                             relationships={"fact_capacity": [("k", "dim_state", "k")]})
    res.run(models, only=["unique"]).collect()
    assert built == ["dim_state"]
    res.run(models).collect()
    assert built == ["dim_state", "fact_capacity"]  # each model built once


def test_gate_blocks_unchecked_models(spark):
    from wattflow.operators.quality import enforce, gate
    import pytest

    results = spark.createDataFrame([("c1", "dim_state", 0)], "check_id string, model string, failures long")
    status = {r.model: r.status for r in gate(results).collect()}
    assert set(status.values()) == {"not_run"}
    with pytest.raises(RuntimeError, match="no check results"):
        enforce(results, "fact_capacity")
