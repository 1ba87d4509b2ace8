"""Data-quality report over a written gold layer (DQ1-DQ7, JN3 on the star).

One row per check: ``check``, ``table_name``, ``n_bad``.  All foreign keys and
the uniqueness of the keys they point to are counted in one pass over each
table; every other check is an aggregation ending in a single count.  The
report is a handful of rows whatever the size of the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alloy.operators import quality
from alloy.operators.clean import clean
from alloy.plans import marketplace as mp
from alloy.sources.parquet import read_table


def _count(name: str, table: str, df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_bad")).select(
        F.lit(name).alias("check"), F.lit(table).alias("table_name"), "n_bad")


def _bad_rows(name: str, table: str, summary: DataFrame) -> DataFrame:
    return summary.agg(F.coalesce(F.sum("rows_bad"), F.lit(0)).cast("long").alias("n_bad")).select(
        F.lit(name).alias("check"), F.lit(table).alias("table_name"), "n_bad")


def gold_checks(gold: dict[str, DataFrame]) -> DataFrame:
    """The checks over gold frames keyed by table name."""
    fact, payments = gold["fato_vendas"], gold["dim_pagamentos"]

    def dim(table: str, key: str) -> quality.ForeignKey:
        return quality.ForeignKey("orphan_key", table, fact, (key,), gold[table], (key,), "duplicate_key")

    parts = [
        quality.integrity([
            dim("dim_clientes", "nk_cliente"), dim("dim_produtos", "nk_produto"), dim("dim_vendedores", "nk_vendedor"),
            quality.ForeignKey("order_without_items", "dim_pagamentos", payments, ("sk_pedido",), fact, ("sk_pedido",))]),
        _count("zip_fanout", "dim_geolocalizacao_clientes",
               quality.check_fanout(gold["dim_geolocalizacao_clientes"].select(
                   "nk_cep_prefixo_cliente", "cidade_cliente", "estado_cliente"),
                   ["nk_cep_prefixo_cliente"])),
        _bad_rows("score_out_of_range", "dim_avaliacoes",
                  quality.check_range(gold["dim_avaliacoes"], "nota_avaliacao", 1, 5)),
        _bad_rows("negative_value", "dim_pagamentos",
                  quality.check_min(payments, "valor_pagamento", 0)),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


GOLD_INPUTS = ("fato_vendas", "dim_clientes", "dim_produtos", "dim_vendedores", "dim_pagamentos",
               "dim_geolocalizacao_clientes", "dim_avaliacoes")


def quality_report(spark: SparkSession, gold_root: str) -> DataFrame:
    """Run ``gold_checks`` on the tables below ``gold_root``."""
    return gold_checks({t: read_table(spark, gold_root, t) for t in GOLD_INPUTS})


def bronze_checks(spark: SparkSession, bronze_root: str) -> DataFrame:
    """Keys that bronze holds more than once among its valid rows: what silver's dedup removes."""
    out = None
    for name in (mp.CUSTOMERS, mp.PRODUCTS, mp.SELLERS):
        spec = mp.SILVER_SPECS[name]
        valid = clean(read_table(spark, bronze_root, name), spec, dedup=False)
        part = _count("repeated_input_key", name, quality.check_unique(valid, spec.key))
        out = part if out is None else out.unionByName(part)
    return out
