"""Adapters from the star-schema test tables to the two domain shapes.

The source pipeline ships no data; these adapters derive domain-shaped raw
tables from the driver tables with deterministic column expressions, and
inject nulls, zeros, negatives and malformed text through key arithmetic on
every row (no row is dropped). ``plans/oracle.py`` holds the same adapters in
DuckDB SQL.

Scale notes: ``nation`` (25 rows) and ``region`` (5 rows) have a fixed size
by definition of the schema and are broadcast explicitly; how ``supplier``,
``part`` and ``customer``, which grow with the data, are joined is left to the
planner's size threshold and adaptive execution. Each is joined on its own:
the size of a join is guessed as the product of its sides, so ``supplier``
already joined to ``nation`` would never count as small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattflow.schemas import GENERATION_RAW, REGISTRY_RAW, SMALL_PLANTS_MODE

# FIXED VALUES of the fixture mapping (part type prefix -> fuel label).
FUEL_BY_PART_TYPE = [
    ("ECONOMY", "Hidráulica"),
    ("LARGE", "Eólica"),
    ("MEDIUM", "Gás"),
    ("PROMO", "Fotovoltaica"),
    ("SMALL", "Biomassa"),
]
FUEL_OTHER = "Nuclear"
# nation whose plants all report this fuel (placed before the null-fuel
# injection), so one state is fully renewable
ALL_RENEWABLE_NATION = ("NATION_18", "Hidráulica")
# order status -> registry source label
SOURCE_BY_ORDER_STATUS = [("O", "Radiação solar"), ("F", "Eólica")]
SOURCE_OTHER = "Biomassa"


# FIXED VALUES: schemas of the driver tables (read without an inference job).
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "pages": "page_id bigint, url string, html string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Scan the needed columns of one driver table."""
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    df = reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def _mod0(c: str, k: int) -> Column:
    return (F.col(c) % F.lit(k)) == F.lit(0)


def _br_text(c: Column, scale: int = 2) -> Column:
    """Number -> text with a decimal comma (e.g. ``-12,30``)."""
    return F.translate(c.cast(f"decimal(18,{scale})").cast("string"), ".", ",")


def gen_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly-generation raw shape (``GENERATION_RAW``) from lineitem."""
    li = table(spark, sf_dir, "lineitem",
               "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_shipdate")
    sup = table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    nat = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    reg = table(spark, sf_dir, "region", "r_regionkey", "r_name")
    part = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type")

    df = (li.join(part, li.l_partkey == part.p_partkey)
          .join(sup, li.l_suppkey == sup.s_suppkey)
          .join(F.broadcast(nat), sup.s_nationkey == nat.n_nationkey)
          .join(F.broadcast(reg), nat.n_regionkey == reg.r_regionkey))

    fuel = (F.when(F.col("n_name") == F.lit(ALL_RENEWABLE_NATION[0]), F.lit(ALL_RENEWABLE_NATION[1]))
            .when(_mod0("l_partkey", 103), F.lit(None).cast("string")))
    for prefix, label in FUEL_BY_PART_TYPE:
        fuel = fuel.when(F.col("p_type").startswith(prefix), F.lit(label))
    fuel = fuel.otherwise(F.lit(FUEL_OTHER))

    out = df.select(
        F.col("l_shipdate").cast("timestamp").alias("din_instante"),
        F.col("r_regionkey").cast("string").alias("id_subsistema"),
        F.when(_mod0("l_orderkey", 89), F.lit(None).cast("string"))
        .when(F.col("r_name") == "MIDDLE EAST", F.lit("PARAGUAI"))
        .otherwise(F.col("r_name")).alias("nom_subsistema"),
        F.when(_mod0("l_orderkey", 101), F.lit(None).cast("string"))
        .otherwise(F.col("n_name")).alias("id_estado"),
        F.concat(F.lit("Estado "), F.col("n_name")).alias("nom_estado"),
        F.when(_mod0("l_orderkey", 97), F.lit(None).cast("string"))
        .when(F.col("l_returnflag") == "N", F.lit(SMALL_PLANTS_MODE))
        .otherwise(F.concat(F.lit("TIPO "), F.col("l_returnflag"))).alias("cod_modalidadeoperacao"),
        F.col("p_brand").alias("nom_tipousina"),
        fuel.alias("nom_tipocombustivel"),
        F.col("s_name").alias("nom_usina"),
        F.when(_mod0("l_orderkey", 107), F.lit(None).cast("string"))
        .otherwise(F.col("l_suppkey").cast("string")).alias("id_ons"),
        F.col("p_name").alias("ceg"),
        ((F.nullif(F.col("l_quantity") - F.lit(2), F.lit(7.0)) * F.lit(1000) + F.col("l_orderkey") % 13)
         / F.lit(1000)).alias("val_geracao"),
    )
    return out.select(*[F.col(f.name).cast(f.dataType) for f in GENERATION_RAW.fields])


def _reg_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
                   "o_totalprice", "o_orderdate", "o_orderpriority")
    cust = table(spark, sf_dir, "customer",
                 "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    nat = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    reg = table(spark, sf_dir, "region", "r_regionkey", "r_name")
    return (orders.join(cust, orders.o_custkey == cust.c_custkey)
            .join(F.broadcast(nat), cust.c_nationkey == nat.n_nationkey)
            .join(F.broadcast(reg), nat.n_regionkey == reg.r_regionkey))


def _reg_columns(power: Column, prefix: str = "GD.") -> list[Column]:
    source = F.lit(SOURCE_OTHER)
    for status, label in reversed(SOURCE_BY_ORDER_STATUS):
        source = F.when(F.col("o_orderstatus") == status, F.lit(label)).otherwise(source)
    given = {
        "CodEmpreendimento": F.concat(F.lit(prefix), F.col("o_orderkey").cast("string")),
        "SigUF": F.when(_mod0("o_orderkey", 101), F.lit(None).cast("string")).otherwise(F.col("n_name")),
        "DthAtualizaCadastralEmpreend": F.when(_mod0("o_orderkey", 89), F.lit(None).cast("string"))
        .when(_mod0("o_orderkey", 97), F.lit("05/2024"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")),
        "MdaPotenciaInstaladaKW": power,
        "DscFonteGeracao": source,
        "DscClasseConsumo": F.col("c_mktsegment"),
        "DscPorte": F.col("o_orderpriority"),
        "NumCoordNEmpreendimento": _br_text(F.col("c_acctbal")),
        "NumCoordEEmpreendimento": _br_text(F.col("c_acctbal") - F.lit(5000)),
        "CodUFibge": F.col("n_nationkey"),
        "CodRegiao": F.col("n_regionkey"),
        "NomRegiao": F.col("r_name"),
        "NumCPFCNPJ": F.col("c_custkey").cast("string"),
        "NomTitularEmpreendimento": F.col("c_name"),
    }
    return [given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in REGISTRY_RAW.fields]


def _reg_power() -> Column:
    return (F.when(_mod0("o_orderkey", 83), F.lit("0,00"))
            .when(_mod0("o_orderkey", 79), F.lit("1.234,56"))
            .when(_mod0("o_orderkey", 73), F.lit("0,004"))
            .otherwise(_br_text(F.col("o_totalprice").cast("decimal(18,2)")
                                + (F.col("o_orderkey") % 97).cast("decimal(18,4)") * F.expr("0.0001BD"), 4)))


def reg_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry raw shape (``REGISTRY_RAW``, 33 columns, text) from orders."""
    return _reg_base(spark, sf_dir).select(*_reg_columns(_reg_power()))


# Two registry snapshots: (snapshot date, rows absent when key % k = 0 (None:
# the whole registry), power replaced by '10,00' when key % j = 0 (None:
# unchanged)). The older one also has an installation of its own for each
# key % GONE = 0, which the newer one no longer lists.
SNAPSHOTS = [("2024-01-01", 10, None), ("2024-02-01", None, 7)]
GONE = 11


def reg_snapshot(spark: SparkSession, sf_dir: str, which: int) -> DataFrame:
    """One registry snapshot (raw shape) per ``SNAPSHOTS[which]``."""
    _, absent_mod, change_mod = SNAPSHOTS[which]
    power = _reg_power()
    if change_mod is not None:
        power = F.when(_mod0("o_orderkey", change_mod), F.lit("10,00")).otherwise(power)
    base = _reg_base(spark, sf_dir)
    if absent_mod is None:
        return base.select(*_reg_columns(power))
    kept = base.filter(~_mod0("o_orderkey", absent_mod)).select(*_reg_columns(power))
    return kept.unionByName(base.filter(_mod0("o_orderkey", GONE)).select(*_reg_columns(power, "OLD.")))


def catalogue_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resource catalogue (pos, name, format, url) derived from ``pages``.

    One resource per page in ``page_id`` order: name ``GEN_<year>_<MM>``
    (null every 7th page, whose period is then only in the url); format
    pdf / csv / CSV by ``page_id % 3``.
    """
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    period = F.format_string("%d_%02d", F.lit(2020) + F.col("page_id") % 5,
                             F.lit(1) + F.col("page_id") % 12)
    return pages.select(
        F.col("page_id").alias("pos"),
        F.when(_mod0("page_id", 7), F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("GEN_"), period)).alias("name"),
        F.when(_mod0("page_id", 3), F.lit("pdf"))
        .when((F.col("page_id") % 3) == 1, F.lit("csv"))
        .otherwise(F.lit("CSV")).alias("format"),
        F.when(_mod0("page_id", 7), F.concat(F.col("url"), F.lit("/GEN_"), period, F.lit(".csv")))
        .otherwise(F.col("url")).alias("url"),
    )
