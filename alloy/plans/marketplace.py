"""The marketplace lake: 8 silver specs (SV1-SV8) and 8 gold builders (GD1-GD8).

Defaults reproduce the reference tables column by column.  Differences,
each one on purpose: raw columns stay text until silver (zip prefixes keep
their leading zeros), casts are safe (bad values become NULL instead of
failing the table), and the surviving duplicate is chosen by a declared
order instead of at random.

Grain notes for users of the gold tables:
* ``quantidade_itens`` is the item's line number within the order, as in
  the reference; count fact rows to count items.
* the two geolocation dimensions have one row per (zip, city, state), so a
  zip may appear more than once; join facts to ``zip_centroid`` output, or
  check with ``quality.check_fanout`` first.
* ``dim_pagamentos`` and ``dim_avaliacoes`` have many rows per order.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from alloy.operators import aggregate, kpi, star
from alloy.operators.clean import TableSpec, code, trimmed, typed

# The raw table (landing file) names of the public marketplace
# dataset, in the order the silver stage processes them.  Silver tables keep
# these names; the gold table and column names below are fixed values too.
ORDERS = "olist_orders_dataset"
ITEMS = "olist_order_items_dataset"
PAYMENTS = "olist_order_payments_dataset"
PRODUCTS = "olist_products_dataset"
CUSTOMERS = "olist_customers_dataset"
SELLERS = "olist_sellers_dataset"
REVIEWS = "olist_order_reviews_dataset"
GEOLOCATION = "olist_geolocation_dataset"

TS = "timestamp"

SILVER_SPECS: dict[str, TableSpec] = {
    ORDERS: TableSpec(
        ORDERS,
        (trimmed("order_id"), trimmed("customer_id"), code("order_status"),
         typed("order_purchase_timestamp", TS), typed("order_approved_at", TS),
         typed("order_delivered_carrier_date", TS), typed("order_delivered_customer_date", TS),
         typed("order_estimated_delivery_date", "date")),
        required=("order_id", "customer_id"), non_blank=("order_id", "customer_id"),
        key=("order_id",), order_by=(("order_purchase_timestamp", "desc"),)),
    ITEMS: TableSpec(
        ITEMS,
        (trimmed("order_id"), typed("order_item_id", "int"), trimmed("product_id"),
         trimmed("seller_id"), typed("shipping_limit_date", TS), typed("price", "double"),
         typed("freight_value", "double")),
        required=("order_id", "product_id", "seller_id"),
        non_blank=("order_id", "product_id", "seller_id"),
        key=("order_id", "order_item_id"), order_by=(("shipping_limit_date", "desc"),)),
    PAYMENTS: TableSpec(
        PAYMENTS,
        (trimmed("order_id"), typed("payment_sequential", "int"), code("payment_type"),
         typed("payment_installments", "int"), typed("payment_value", "double")),
        required=("order_id",), non_blank=("order_id",),
        key=("order_id", "payment_sequential")),
    PRODUCTS: TableSpec(
        PRODUCTS,
        (trimmed("product_id"), code("product_category_name"),
         typed("product_name_lenght", "int", "product_name_length"),
         typed("product_description_lenght", "int", "product_description_length"),
         typed("product_photos_qty", "int"), typed("product_weight_g", "double"),
         typed("product_length_cm", "double"), typed("product_height_cm", "double"),
         typed("product_width_cm", "double")),
        required=("product_id",), non_blank=("product_id",), key=("product_id",)),
    CUSTOMERS: TableSpec(
        CUSTOMERS,
        (trimmed("customer_id"), trimmed("customer_unique_id"),
         trimmed("customer_zip_code_prefix"), code("customer_city"), code("customer_state")),
        required=("customer_id", "customer_unique_id"),
        non_blank=("customer_id", "customer_unique_id"), key=("customer_id",)),
    SELLERS: TableSpec(
        SELLERS,
        (trimmed("seller_id"), trimmed("seller_zip_code_prefix"), code("seller_city"),
         code("seller_state")),
        required=("seller_id",), non_blank=("seller_id",), key=("seller_id",)),
    REVIEWS: TableSpec(
        REVIEWS,
        (trimmed("review_id"), trimmed("order_id"), typed("review_score", "int"),
         trimmed("review_comment_title"), trimmed("review_comment_message"),
         typed("review_creation_date", TS), typed("review_answer_timestamp", TS)),
        required=("review_id", "order_id"), non_blank=("review_id", "order_id"),
        key=("review_id", "order_id"), order_by=(("review_answer_timestamp", "desc"),)),
    # Geolocation is not de-duplicated: it is averaged per (zip, city, state).
    GEOLOCATION: TableSpec(
        GEOLOCATION,
        (trimmed("geolocation_zip_code_prefix"), typed("geolocation_lat", "double"),
         typed("geolocation_lng", "double"), code("geolocation_city", fold=True),
         code("geolocation_state")),
        required=("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng")),
}


def silver_post(name: str, cleaned: DataFrame) -> DataFrame:
    """Table-specific step after cleaning (the geolocation centroid)."""
    if name == GEOLOCATION:
        return aggregate.centroid(cleaned, "geolocation_zip_code_prefix", "geolocation_lat",
                                  "geolocation_lng", "geolocation_city", "geolocation_state")
    return cleaned


# ------------------------------------------------------------------ gold

FACT_COLUMNS = [
    ("order_id", "sk_pedido"),
    ("customer_id", "nk_cliente"),
    ("product_id", "nk_produto"),
    ("seller_id", "nk_vendedor"),
    ("order_item_id", "quantidade_itens"),
    ("price", "valor_produto"),
    ("freight_value", "valor_frete"),
    (None, "valor_total_item"),  # price + freight_value
    ("order_purchase_timestamp", "data_compra"),
    ("order_approved_at", "data_aprovacao"),
    ("order_delivered_carrier_date", "data_postagem"),
    ("order_delivered_customer_date", "data_entrega"),
    ("order_estimated_delivery_date", "data_estimada_entrega"),
    ("order_status", "status_pedido"),
]

PRODUCT_COLUMNS = [
    ("product_id", "nk_produto"),
    ("product_category_name", "categoria_produto"),
    ("product_name_length", "comprimento_nome_produto"),
    ("product_description_length", "comprimento_descricao_produto"),
    ("product_photos_qty", "qtd_fotos_produto"),
    ("product_weight_g", "peso_gramas"),
    ("product_length_cm", "comprimento_cm"),
    ("product_height_cm", "altura_cm"),
    ("product_width_cm", "largura_cm"),
]

CUSTOMER_COLUMNS = [
    ("customer_id", "nk_cliente"),
    ("customer_unique_id", "id_unico_cliente"),
    ("customer_zip_code_prefix", "cep_prefixo_cliente"),
    ("customer_city", "cidade_cliente"),
    ("customer_state", "estado_cliente"),
]

SELLER_COLUMNS = [
    ("seller_id", "nk_vendedor"),
    ("seller_zip_code_prefix", "cep_prefixo_vendedor"),
    ("seller_city", "cidade_vendedor"),
    ("seller_state", "estado_vendedor"),
]

PAYMENT_COLUMNS = [
    ("order_id", "sk_pedido"),
    ("payment_sequential", "sequencial_pagamento"),
    ("payment_type", "tipo_pagamento"),
    ("payment_installments", "qtd_parcelas"),
    ("payment_value", "valor_pagamento"),
]

GEO_ROLE_COLUMNS = [
    ("geolocation_zip_code_prefix", "nk_cep_prefixo_{role}"),
    ("geolocation_lat", "latitude_{role}"),
    ("geolocation_lng", "longitude_{role}"),
    ("geolocation_city", "cidade_{role}"),
    ("geolocation_state", "estado_{role}"),
]

REVIEW_COLUMNS = [
    ("review_id", "sk_avaliacao"),
    ("order_id", "sk_pedido"),
    ("review_score", "nota_avaliacao"),
    ("review_comment_title", "titulo_comentario"),
    ("review_comment_message", "mensagem_comentario"),
    ("review_creation_date", "data_criacao_avaliacao"),
    ("review_answer_timestamp", "data_resposta_vendedor"),
]


# Silver tables that may be laid out in buckets of one key, for the fact's join.
COLOCATED: dict[str, tuple[str, ...]] = {ORDERS: ("order_id",), ITEMS: ("order_id",)}


def build_fact(items: DataFrame, orders: DataFrame) -> DataFrame:
    """fato_vendas: items ⋈ orders on order_id, 14 business columns."""
    return fact_of(star.fact_join(items, orders, "order_id"))


def fact_of(joined: DataFrame) -> DataFrame:
    """The fact's columns of the joined items and orders."""
    mapping = [(star.total("price", "freight_value") if s is None else s, d)
               for s, d in FACT_COLUMNS]
    return star.rename(joined, mapping)


@dataclass(frozen=True)
class GoldTable:
    """A gold table: the tables it reads, silver or (``from_gold``) gold, and how it is built from them.

    ``of_join`` builds it from the inner join of its two inputs, where these
    are laid out in the same buckets.
    """

    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    from_gold: bool = False
    of_join: Callable[[DataFrame], DataFrame] | None = None


GOLD_TABLES: dict[str, GoldTable] = {
    "fato_vendas": GoldTable((ITEMS, ORDERS), build_fact, of_join=fact_of),
    "dim_produtos": GoldTable((PRODUCTS,), lambda p: star.rename(p, PRODUCT_COLUMNS)),
    "dim_clientes": GoldTable((CUSTOMERS,), lambda c: star.rename(c, CUSTOMER_COLUMNS)),
    "dim_vendedores": GoldTable((SELLERS,), lambda s: star.rename(s, SELLER_COLUMNS)),
    "dim_pagamentos": GoldTable((PAYMENTS,), lambda p: star.rename(p, PAYMENT_COLUMNS)),
    "dim_geolocalizacao_clientes": GoldTable(
        (GEOLOCATION,), lambda g: star.role_view(g, GEO_ROLE_COLUMNS, "cliente")),
    "dim_geolocalizacao_vendedores": GoldTable(
        (GEOLOCATION,), lambda g: star.role_view(g, GEO_ROLE_COLUMNS, "vendedor")),
    "dim_avaliacoes": GoldTable((REVIEWS,), lambda r: star.rename(r, REVIEW_COLUMNS)),
}


# Aggregate tables (business indicators) the readme promises for gold; not
# part of the reference's eight tables, so written only when asked for.  They
# read the fact and the customers that the same run has written.
KPI_TABLES: dict[str, GoldTable] = {
    "kpi_vendas_mensais": GoldTable(
        ("fato_vendas",),
        lambda fact: kpi.monthly_sales(
            fact, order_key="sk_pedido", date_col="data_compra", value="valor_produto"),
        from_gold=True),
    "kpi_vendas_por_estado": GoldTable(
        ("fato_vendas", "dim_clientes"),
        lambda fact, customers: kpi.sales_by_group(
            fact, customers.withColumnRenamed("estado_cliente", "customer_state"),
            customer="nk_cliente", attr="status_pedido", attr_name="order_status",
            customer_key="nk_cliente", group_col="customer_state", value="valor_produto"),
        from_gold=True),
}
