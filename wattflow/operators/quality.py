"""Distributed data-quality checks, their summary and the build gate.

A check is a query for violating rows/keys/values; it fails when its count
is above zero. Results share one schema (``RESULT_COLUMNS``) so any number
of checks union into one small table. Counting rules follow the source
checks: ``not_null`` counts rows, ``unique`` counts duplicated keys (nulls
skipped), ``accepted_values`` counts distinct bad values (null never
fails), ``relationships`` counts orphan child rows (null child skipped).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattflow.schemas import SOURCE_CATEGORIES
from wattflow.session import stage

RESULT_COLUMNS = ["check_id", "model", "column_name", "test", "failures", "should_warn",
                  "should_error"]
RESULT_SCHEMA = ("check_id string, model string, column_name string, test string, failures bigint, "
                 "should_warn boolean, should_error boolean")


def _result(df_counts: DataFrame, model: str, column: str, test: str) -> DataFrame:
    """Single-row ``failures`` frame -> a check-result row."""
    return df_counts.select(
        F.lit(f"{test}_{model}_{column}").alias("check_id"),
        F.lit(model).alias("model"),
        F.lit(column).alias("column_name"),
        F.lit(test).alias("test"),
        F.coalesce(F.col("failures").cast("bigint"), F.lit(0).cast("bigint")).alias("failures"),
    ).withColumns({
        "should_warn": F.col("failures") != 0,
        "should_error": F.col("failures") != 0,
    })


def not_null(df: DataFrame, model: str, cols: Sequence[str]) -> DataFrame:
    """All not-null checks of one table fused into a single scan (``count_if``)."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = agg.unpivot([], list(cols), "column_name", "failures")
    return long.select(
        F.concat(F.lit(f"not_null_{model}_"), F.col("column_name")).alias("check_id"),
        F.lit(model).alias("model"),
        "column_name",
        F.lit("not_null").alias("test"),
        F.col("failures").cast("bigint").alias("failures"),
    ).withColumns({
        "should_warn": F.col("failures") != 0,
        "should_error": F.col("failures") != 0,
    })


def unique(df: DataFrame, model: str, col: str) -> DataFrame:
    """Number of distinct non-null keys that occur more than once."""
    dup = (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
           .filter(F.col("n") > 1))
    return _result(dup.agg(F.count(F.lit(1)).alias("failures")), model, col, "unique")


def accepted_values(df: DataFrame, model: str, col: str, values: Sequence) -> DataFrame:
    """Number of distinct values outside ``values`` (null is never a failure)."""
    bad = df.filter(~F.col(col).isin(list(values))).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return _result(bad.agg(F.count(F.lit(1)).alias("failures")), model, col, "accepted_values")


def relationships(child: DataFrame, model: str, col: str, parent: DataFrame,
                  parent_col: str) -> DataFrame:
    """Child rows whose non-null key has no parent row.

    Child keys are pre-aggregated (one row per key with its row count) before
    the anti join, so a hot key costs one row in the join, not a third of the
    table in one task.
    """
    keys = child.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    parents = parent.select(F.col(parent_col).alias(col))
    orphans = keys.join(parents, col, "left_anti")
    return _result(orphans.agg(F.sum("n").alias("failures")), model, col, "relationships")


LEDGER_SCHEMA = "model string, column_name string, value string, n bigint"


def value_ledger(df: DataFrame, model: str, keys: Sequence[str],
                 required: Sequence[str] = ()) -> DataFrame:
    """Rows per value of every column in ``keys``, from one pass over a table:
    ``(model, column_name, value, n)``, values as text.

    Columns that are only ``required`` enter their null rows alone, so a
    column that no check compares costs one count. Rows are combined before
    the shuffle; a hot value is one row a task.
    """
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
               for c in dict.fromkeys(keys)]
    entries += [F.when(F.col(c).isNull(), F.struct(F.lit(c).alias("column_name"),
                                                   F.lit(None).cast("string").alias("value")))
                for c in dict.fromkeys(required) if c not in set(keys)]
    if not entries:
        return df.sparkSession.createDataFrame([], LEDGER_SCHEMA)
    seen = df.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")
    return seen.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(model).alias("model"), "column_name", "value", "n")


def union_results(results: Sequence[DataFrame]) -> DataFrame:
    """All check results in one table; an empty one if there are none."""
    if not results:
        return SparkSession.active().createDataFrame([], RESULT_SCHEMA)
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


@dataclass
class CheckSuite:
    """Declarative checks per model (the shape of a models YAML file)."""

    not_null: dict[str, list[str]] = field(default_factory=dict)
    unique: dict[str, list[str]] = field(default_factory=dict)
    accepted_values: dict[str, list[tuple[str, list]]] = field(default_factory=dict)
    relationships: dict[str, list[tuple[str, str, str]]] = field(default_factory=dict)

    def run(self, models: Mapping[str, DataFrame], only: Sequence[str] | None = None) -> DataFrame:
        """Run the checks of the models given (``only``: restrict to these test
        kinds); a relationship runs when both its tables are given."""
        kinds = set(only or ["not_null", "unique", "accepted_values", "relationships"])
        have = set(models)
        out: list[DataFrame] = []
        if "not_null" in kinds:
            out += [not_null(models[m], m, cols) for m, cols in self.not_null.items() if m in have]
        if "unique" in kinds:
            out += [unique(models[m], m, c) for m, cols in self.unique.items() if m in have
                    for c in cols]
        if "accepted_values" in kinds:
            out += [accepted_values(models[m], m, c, vals)
                    for m, specs in self.accepted_values.items() if m in have for c, vals in specs]
        if "relationships" in kinds:
            out += [relationships(models[m], m, c, models[p], pc)
                    for m, specs in self.relationships.items() if m in have
                    for c, p, pc in specs if p in have]
        return union_results(out)

    def ledger(self, models: Mapping[str, DataFrame]) -> DataFrame:
        """``value_ledger`` of every given model: what all checks of the suite
        need, each table read once."""
        keys: dict[str, list[str]] = {m: list(self.unique.get(m, [])) for m in models}
        for m in models:
            keys[m] += [c for c, _ in self.accepted_values.get(m, [])]
            for c, p, pc in self.relationships.get(m, []):
                if p in keys:
                    if models[m].schema[c].dataType != models[p].schema[pc].dataType:
                        raise ValueError(f"{m}.{c} and {p}.{pc} differ in type: values are compared as text")
                    keys[m].append(c)
                    keys[p].append(pc)
        out = None
        for m, df in models.items():
            one = value_ledger(df, m, keys[m], self.not_null.get(m, []))
            out = one if out is None else out.unionByName(one)
        return out

    def run_once(self, models: Mapping[str, DataFrame]) -> DataFrame:
        """The results of ``run``, from one pass over each model.

        The ledger is written under the shared folder; null counts, repeated
        keys, foreign values and orphans are all read from it. It has a row a
        distinct value, so orphans are joined without a hot key.
        """
        models = {m: models[m] for m in models}
        if not models:
            return union_results([])
        edges = [(m, c, p, pc) for m, specs in self.relationships.items() if m in models
                 for c, p, pc in specs if p in models]
        specs = [("not_null", m, c) for m, cols in self.not_null.items() if m in models for c in cols]
        specs += [("unique", m, c) for m, cols in self.unique.items() if m in models for c in cols]
        specs += [("accepted_values", m, c) for m, vals in self.accepted_values.items() if m in models
                  for c, _ in vals]
        specs += [("relationships", m, c) for m, c, _, _ in edges]
        ledger = stage(self.ledger(models), "value-ledger")
        spark = ledger.sparkSession

        foreign = F.lit(False)
        for m, vals in self.accepted_values.items():
            for c, allowed in vals:
                # text of the allowed values as the column's own type writes it
                kind = models[m].schema[c].dataType if m in models else None
                if kind is not None:
                    texts = [F.lit(v).cast(kind).cast("string") for v in allowed]
                    foreign = foreign | ((F.col("model") == m) & (F.col("column_name") == c)
                                         & ~F.col("value").isin(texts))
        present = F.col("value").isNotNull()
        counts = ledger.groupBy("model", "column_name").agg(
            F.sum(F.when(~present, F.col("n"))).alias("not_null"),
            F.count_if(present & (F.col("n") > 1)).alias("unique"),
            F.count_if(present & foreign).alias("accepted_values"),
        ).unpivot(["model", "column_name"], ["not_null", "unique", "accepted_values"], "test", "failures")
        if edges:
            edge = spark.createDataFrame(
                edges, "model string, column_name string, parent string, parent_column string")
            parents = ledger.select(F.col("model").alias("parent"),
                                    F.col("column_name").alias("parent_column"), "value")
            orphans = ledger.filter(present).join(edge, ["model", "column_name"]).join(
                parents, ["parent", "parent_column", "value"], "left_anti")
            counts = counts.unionByName(orphans.groupBy("model", "column_name").agg(
                F.sum("n").alias("failures")).withColumn("test", F.lit("relationships")))
        checks = spark.createDataFrame(specs, "test string, model string, column_name string")
        failures = F.coalesce(F.col("failures").cast("bigint"), F.lit(0).cast("bigint"))
        return checks.join(counts, ["test", "model", "column_name"], "left").select(
            F.concat_ws("_", "test", "model", "column_name").alias("check_id"), "model", "column_name",
            "test", failures.alias("failures"), (failures != 0).alias("should_warn"),
            (failures != 0).alias("should_error"))


# FIXED VALUES: the 23 checks of the source models (17 not_null, 3 unique,
# 1 accepted_values, 2 relationships), on our table names.
REFERENCE_SUITE = CheckSuite(
    not_null={
        "stg_generation": ["ts_geracao", "sigla_uf", "geracao_mwh", "eh_renovavel"],
        "stg_registry": ["id_empreendimento", "sigla_uf", "potencia_kw", "data_conexao",
                         "ano_conexao"],
        "dim_state": ["sigla_uf", "sk_uf"],
        "dim_source": ["fonte_combustivel", "categoria_simplificada"],
        "fact_generation_monthly": ["sigla_uf", "geracao_total_mwh"],
        "fact_capacity": ["sigla_uf", "potencia_kw_novos"],
    },
    unique={
        "dim_state": ["sigla_uf", "sk_uf"],
        "dim_source": ["fonte_combustivel"],
    },
    accepted_values={
        "dim_source": [("categoria_simplificada", SOURCE_CATEGORIES)],
    },
    relationships={
        "fact_generation_monthly": [("sigla_uf", "dim_state", "sigla_uf")],
        "fact_capacity": [("sigla_uf", "dim_state", "sigla_uf")],
    },
)

# FIXED VALUES: which models' checks must pass before a model is built.
GATES = {
    "dim_state": ["stg_generation"],
    "dim_source": ["stg_generation"],
    "fact_generation_monthly": ["stg_generation", "dim_state", "dim_source"],
    "fact_capacity": ["stg_generation", "stg_registry", "dim_state"],
}


def gate(results: DataFrame, gates: Mapping[str, Sequence[str]] = GATES) -> DataFrame:
    """Per downstream model: checks that gate it, how many failed, status.

    ``gates`` is configuration (models x upstream models), so its frame is
    small by construction; ``results`` has one row per check. An upstream
    model without results has not been checked: status ``not_run``, which
    blocks like a failure.
    """
    spark: SparkSession = results.sparkSession
    edges = spark.createDataFrame(
        [(m, u) for m, ups in gates.items() for u in ups], "model string, upstream string")
    joined = edges.join(results.withColumnRenamed("model", "upstream"), "upstream", "left")
    return joined.groupBy("model").agg(
        F.count("check_id").alias("n_checks"),
        F.count_if(F.col("failures") > 0).alias("n_failed"),
        F.count_if(F.col("check_id").isNull()).alias("n_missing"),
    ).withColumn(
        "status", F.when(F.col("n_failed") > 0, F.lit("blocked"))
        .when(F.col("n_missing") > 0, F.lit("not_run")).otherwise(F.lit("ready"))
    ).drop("n_missing")


def blocking(results: DataFrame, model: str,
             gates: Mapping[str, Sequence[str]] = GATES) -> list[str]:
    """Why ``model`` must not be built: its failing gating checks, and
    ``not_run_<upstream>`` for every upstream model without any result.

    Only check ids and failure counts (a row a check) reach the driver.
    """
    ups = list(gates.get(model, []))
    rows = results.filter(F.col("model").isin(ups)).select("model", "check_id", "failures").collect()
    failed = [r.check_id for r in rows if r.failures is None or r.failures > 0]
    return sorted(failed) + [f"not_run_{u}" for u in sorted(set(ups) - {r.model for r in rows})]


def enforce(results: DataFrame, model: str, gates: Mapping[str, Sequence[str]] = GATES) -> None:
    """Raise before building ``model`` when a gating check failed or an
    upstream model has no results."""
    reasons = blocking(results, model, gates)
    missing = [r.removeprefix("not_run_") for r in reasons if r.startswith("not_run_")]
    failed = [r for r in reasons if not r.startswith("not_run_")]
    if failed:
        raise RuntimeError(f"{model} blocked by failing checks: {failed}")
    if missing:
        raise RuntimeError(f"{model} blocked: no check results for {missing}")
