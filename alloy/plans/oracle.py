"""Oracle SQL for the registered queries (DuckDB dialect).

Each text computes what the matching query in ``alloy.plans.tpch`` computes,
written independently as plain SQL over the same tables.  Column names and
types match the Spark results (integers cast where DuckDB widens them).
"""

from __future__ import annotations

# The dirty orders view: the same fixed defect injection as tpch.dirty_orders.
DIRTY_ORDERS = """
SELECT o_orderkey AS row_id,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL
            WHEN o_orderkey % 89 = 0 THEN '   '
            ELSE concat(' ', CAST(o_orderkey AS VARCHAR), '  ') END AS order_id,
       CASE WHEN o_orderkey % 83 = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
       concat('  ', o_orderstatus, ' ') AS order_status,
       CASE WHEN o_orderkey % 71 = 0 THEN 'n/a' ELSE CAST(o_orderdate AS VARCHAR) END AS purchased_at,
       CAST(o_totalprice AS VARCHAR) AS total_raw
FROM orders
"""

_D = f"({DIRTY_ORDERS}) d"

_SUPPLIER_GEO = """
SELECT s_nationkey % 7 AS zip, lower(n_name) AS city, r_name AS state,
       s_acctbal AS lat, CAST(s_suppkey AS DOUBLE) AS lng
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""

_LOCATED = f"""
(SELECT * FROM ({_SUPPLIER_GEO}) g
 WHERE zip IS NOT NULL AND lat IS NOT NULL AND NOT isnan(lat)
   AND lng IS NOT NULL AND NOT isnan(lng)) geo
"""


def _one_per_key(source: str, key: str, order: str) -> str:
    """The first row per key by ``order``."""
    return (f"(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) "
            f"AS rn FROM {source}) ranked WHERE rn = 1)")


def _exact_avg(x: str) -> str:
    """The average of doubles that are whole multiples of 2^-64: an exact sum, rounded once."""
    whole, low = f"CAST({x} * pow(2, 64) AS HUGEINT)", 2 ** 40
    total = (f"(CAST(sum(CAST({whole} // {low} AS BIGINT)) AS HUGEINT) * {low} "
             f"+ CAST(sum(CAST({whole} % {low} AS BIGINT)) AS HUGEINT))")
    return (f"(CAST(CAST({total} // {low} AS BIGINT) AS DOUBLE) * {low} "
            f"+ CAST(CAST({total} % {low} AS BIGINT) AS DOUBLE)) / pow(2, 64) / count(*)")


def _asc(columns: str) -> str:
    return ", ".join(f"{c.strip()} ASC NULLS FIRST" for c in columns.split(","))


# The silver tables of the lake (tpch_landing injects the same defects): the
# valid rows of each, typed, then one row per key (itd, od, pay, prod, cust, sell, rev).
LAKE = f"""
it AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
         CASE WHEN l_partkey % 109 = 0 THEN 'x' ELSE '' END || l_partkey AS product_id,
         CASE WHEN l_partkey % 107 = 0 THEN 'x' ELSE '' END || l_suppkey AS seller_id,
         l_shipdate AS shipping_limit_date,
         CASE WHEN l_partkey % 103 = 0 THEN NULL WHEN l_partkey % 499 = 0 THEN CAST('1e40' AS DOUBLE)
              ELSE l_extendedprice END AS price,
         l_tax AS freight_value
  FROM lineitem WHERE l_partkey % 113 <> 0 AND l_partkey % 127 <> 0),
itd AS (SELECT * FROM {_one_per_key("it", "order_id, order_item_id",
    "shipping_limit_date DESC NULLS LAST, " + _asc("product_id, seller_id, price, freight_value"))} x),
o AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
         CASE WHEN o_orderkey % 79 = 0 THEN 'x' ELSE '' END || o_custkey AS customer_id,
         CASE WHEN v = 1 THEN 'z' ELSE lower(o_orderstatus) END AS order_status,
         o_orderdate + to_days(v) AS purchased,
         CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate + to_hours(o_orderkey % 5 + 1) END AS approved,
         o_orderdate + to_days(CAST(o_orderkey % 3 + 1 AS INTEGER)) + to_hours(2) AS posted,
         CASE WHEN o_orderkey % 13 <> 0
              THEN o_orderdate + to_days(CAST(o_orderkey % 4 + 5 AS INTEGER)) END AS delivered,
         CAST(CAST(o_orderdate AS DATE) + 30 AS DATE) AS estimated
  FROM (SELECT *, 0 AS v FROM orders UNION ALL SELECT *, 1 FROM orders WHERE o_orderkey % 53 = 0) both_versions
  WHERE o_orderkey % 89 <> 0 AND o_orderkey % 97 <> 0 AND o_orderkey % 83 <> 0),
od AS (SELECT * FROM {_one_per_key("o", "order_id", "purchased DESC NULLS LAST, "
    + _asc("customer_id, order_status, approved, posted, delivered, estimated"))} x),
p AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, seq, kind, parts, amount FROM (
    SELECT o_orderkey, 1 AS seq, lower(o_orderpriority) AS kind, CAST(o_orderkey % 4 + 1 AS INTEGER) AS parts,
           CASE WHEN o_orderkey % 61 = 0 THEN -o_totalprice ELSE o_totalprice END AS amount FROM orders
    UNION ALL SELECT o_orderkey, 2, 'voucher', 1, o_orderkey % 100 + CAST(0.5 AS DOUBLE) FROM orders
      WHERE o_orderkey % 3 = 0
    UNION ALL SELECT o_orderkey, 1, '0-other', 9, CAST(1 AS DOUBLE) FROM orders WHERE o_orderkey % 59 = 0) all_payments
  WHERE o_orderkey % 89 <> 0 AND o_orderkey % 97 <> 0),
pay AS (SELECT * FROM {_one_per_key("p", "order_id, seq", _asc("kind, parts, amount"))} x),
pr AS (
  SELECT p_partkey, lower(p_type) AS category, CAST(length(p_name) AS INTEGER) AS name_length,
         CAST(length(p_brand) * 7 AS INTEGER) AS description_length, CAST(p_size % 6 AS INTEGER) AS photos,
         p_retailprice AS weight, CAST(p_size AS DOUBLE) AS len,
         CAST(p_size * 2 + 0.5 AS DOUBLE) AS height, CAST(p_size * 3 + 0.25 AS DOUBLE) AS width
  FROM part UNION ALL SELECT p_partkey, '0dup', 1, 2, 3, 4, 5, 6, 7 FROM part WHERE p_partkey % 47 = 0),
prv AS (SELECT * FROM pr WHERE p_partkey % 91 <> 0 AND p_partkey % 93 <> 0),
prod AS (SELECT CAST(p_partkey AS VARCHAR) AS product_id, x.* EXCLUDE (p_partkey) FROM {_one_per_key(
    "prv", "p_partkey", _asc("category, name_length, description_length, photos, weight, len, height, width"))} x),
place AS (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
cuv AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, unique_id, lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip,
         CASE WHEN c_custkey % 2 = 0 THEN 'são ' ELSE '' END || lower(n_name) AS city, lower(r_name) AS state
  FROM (SELECT *, c_name AS unique_id FROM customer
        UNION ALL SELECT *, '0' FROM customer WHERE c_custkey % 45 = 0) c JOIN place ON c_nationkey = n_nationkey
  WHERE c_custkey % 67 <> 0),
cust AS (SELECT * FROM {_one_per_key("cuv", "customer_id", _asc("unique_id, zip, city, state"))} x),
sev AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
         CASE WHEN v = 1 THEN '00000' ELSE lpad(CAST(s_nationkey AS VARCHAR), 5, '0') END AS zip,
         CASE WHEN v = 1 THEN 'a' ELSE 'é ' || lower(n_name) END AS city, lower(r_name) AS state
  FROM (SELECT *, 0 AS v FROM supplier UNION ALL SELECT *, 1 FROM supplier WHERE s_suppkey % 9 = 0) s
  JOIN place ON s_nationkey = n_nationkey
  WHERE s_suppkey % 31 <> 0),
sell AS (SELECT * FROM {_one_per_key("sev", "seller_id", _asc("zip, city, state"))} x),
r AS (
  SELECT conv_id || '-' || turn AS review_id, CAST(conv_id AS VARCHAR) AS order_id,
         CAST(CASE WHEN conv_id % 13 = 0 THEN 0 WHEN conv_id % 17 = 0 THEN 9
              WHEN conv_id % 19 <> 0 THEN length(role) % 5 + 1 END AS INTEGER) AS score,
         CASE WHEN v = 1 THEN 'dup' ELSE trim(role) END AS title, trim(text) AS message,
         TIMESTAMP '2018-01-01' + to_days(CAST(conv_id % 300 AS INTEGER)) AS created,
         CASE WHEN v = 0 THEN TIMESTAMP '2018-01-01' + to_days(CAST(conv_id % 300 AS INTEGER))
              + to_hours(turn + 1) END AS answered
  FROM (SELECT *, 0 AS v FROM conversations
        UNION ALL SELECT *, 1 FROM conversations WHERE conv_id % 7 = 0) c
  WHERE conv_id % 23 <> 0),
rev AS (SELECT * FROM {_one_per_key("r", "review_id, order_id",
    "answered DESC NULLS LAST, " + _asc("score, title, message, created"))} x),
geo AS (
  SELECT CASE WHEN c_custkey % 41 = 0 THEN '' ELSE lpad(CAST(c_nationkey AS VARCHAR), 5, '0') END AS zip,
         translate(CASE WHEN c_custkey % 3 = 0 THEN 'águas ' ELSE '' END || lower(n_name),
                   'áàâãéèêíìîóòôõúùûç', 'aaaaeeeiiioooouuuc') AS city,
         lower(r_name) AS state, {_exact_avg("c_acctbal")} AS lat, {_exact_avg("CAST(c_custkey AS DOUBLE)")} AS lng
  FROM customer JOIN place ON c_nationkey = n_nationkey
  WHERE c_custkey % 37 <> 0 AND c_custkey % 39 <> 0
  GROUP BY 1, 2, 3),
fact AS (SELECT itd.*, od.* EXCLUDE (order_id) FROM itd JOIN od ON itd.order_id = od.order_id)
"""

# Line items with a third of the rows moved onto order key 1 (tpch.hot_items).
_HOT_ITEMS = """
(SELECT CASE WHEN l_partkey % 3 = 0 THEN CAST(1 AS BIGINT) ELSE l_orderkey END AS l_orderkey,
        l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
        l_returnflag, l_linestatus, l_shipdate
 FROM lineitem) hot
"""

ORACLE_SQL: dict[str, str] = {
    "project_rename": """
SELECT p_partkey AS nk_part, p_type AS category, p_size AS size_cm FROM part
""",
    "trim_lower": """
SELECT c_custkey, lower(trim(concat('  ', c_mktsegment, ' '))) AS segment,
       CAST(length(trim(concat('  ', c_mktsegment, ' '))) AS INTEGER) AS n
FROM customer
""",
    "translate_accents": """
SELECT doc_id, translate(lower(trim(text)), 'áàâãéèêíìîóòôõúùûç', 'aaaaeeeiiioooouuuc') AS folded
FROM documents
""",
    "cast_int_safe": """
SELECT o_orderkey,
       TRY_CAST(CASE WHEN o_orderkey % 5 = 0 THEN 'abc' ELSE CAST(o_custkey AS VARCHAR) END AS INTEGER) AS v
FROM orders
""",
    "cast_double_safe": """
SELECT o_orderkey,
       TRY_CAST(CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE CAST(o_totalprice AS VARCHAR) END AS DOUBLE) AS v
FROM orders
""",
    "to_date_safe": """
SELECT o_orderkey,
       TRY_CAST(CASE WHEN o_orderkey % 71 = 0 THEN 'n/a' ELSE CAST(o_orderdate AS VARCHAR) END AS DATE) AS d
FROM orders
""",
    "to_timestamp_safe": """
SELECT o_orderkey,
       TRY_CAST(CASE WHEN o_orderkey % 71 = 0 THEN 'n/a' ELSE CAST(o_orderdate AS VARCHAR) END AS TIMESTAMP) AS t
FROM orders
""",
    "cast_failure_profile": f"""
SELECT count(CASE WHEN purchased_at IS NOT NULL AND TRY_CAST(purchased_at AS DATE) IS NULL THEN 1 END)
         AS purchased_at_bad,
       count(CASE WHEN total_raw IS NOT NULL AND TRY_CAST(total_raw AS DOUBLE) IS NULL THEN 1 END)
         AS total_raw_bad
FROM {_D}
""",
    "computed_sum_col": """
SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice + l_tax, 4) AS total FROM lineitem
""",
    "drop_null_keys": f"""
SELECT count(*) AS n FROM {_D} WHERE order_id IS NOT NULL AND customer_id IS NOT NULL
""",
    "drop_blank_keys": f"""
SELECT trim(order_id) AS order_id, trim(customer_id) AS customer_id FROM {_D}
WHERE trim(order_id) <> '' AND trim(customer_id) <> ''
""",
    "silver_orders": f"""
SELECT order_id, customer_id, order_status, purchased_on, total FROM (
  SELECT *, row_number() OVER (
           PARTITION BY order_id
           ORDER BY purchased_on DESC NULLS LAST, customer_id ASC NULLS FIRST,
                    order_status ASC NULLS FIRST, total ASC NULLS FIRST) AS rn
  FROM (SELECT trim(order_id) AS order_id, trim(customer_id) AS customer_id,
               lower(trim(order_status)) AS order_status,
               TRY_CAST(purchased_at AS DATE) AS purchased_on,
               TRY_CAST(total_raw AS DOUBLE) AS total
        FROM {_D}) p
  WHERE order_id IS NOT NULL AND customer_id IS NOT NULL
    AND order_id <> '' AND customer_id <> '') x
WHERE rn = 1
""",
    "quarantine_rows": f"""
SELECT row_id, reject_reason FROM (
  SELECT row_id,
         CASE WHEN order_id IS NULL OR customer_id IS NULL THEN 'null_key'
              WHEN trim(order_id) = '' OR trim(customer_id) = '' THEN 'blank_key' END AS reject_reason
  FROM {_D}) q
WHERE reject_reason IS NOT NULL
""",
    "null_blank_profile": f"""
SELECT count(*) AS n_rows,
       count(*) FILTER (WHERE order_id IS NULL) AS order_id_null,
       count(*) FILTER (WHERE trim(order_id) = '') AS order_id_blank,
       count(*) FILTER (WHERE customer_id IS NULL) AS customer_id_null,
       count(*) FILTER (WHERE trim(customer_id) = '') AS customer_id_blank
FROM {_D}
""",
    "dedup_composite_key": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM (
  SELECT *, row_number() OVER (
           PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_shipdate DESC NULLS LAST, l_partkey ASC NULLS FIRST, l_suppkey ASC NULLS FIRST,
                    l_quantity ASC NULLS FIRST, l_extendedprice ASC NULLS FIRST,
                    l_discount ASC NULLS FIRST, l_tax ASC NULLS FIRST,
                    l_returnflag ASC NULLS FIRST, l_linestatus ASC NULLS FIRST) AS rn
  FROM lineitem) x
WHERE rn = 1
""",
    "dedup_key_count": """
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys, CAST(sum(n - 1) AS BIGINT) AS n_dropped
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) g
""",
    "dedup_single_key": """
SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (
           PARTITION BY user_id
           ORDER BY ts DESC NULLS LAST, event_id ASC NULLS FIRST, event_type ASC NULLS FIRST,
                    value ASC NULLS FIRST, props ASC NULLS FIRST) AS rn
  FROM events) x
WHERE rn = 1
""",
    "dedup_hot_key": f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM (
  SELECT *, row_number() OVER (
           PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_shipdate DESC NULLS LAST, l_partkey ASC NULLS FIRST, l_suppkey ASC NULLS FIRST,
                    l_quantity ASC NULLS FIRST, l_extendedprice ASC NULLS FIRST,
                    l_discount ASC NULLS FIRST, l_tax ASC NULLS FIRST,
                    l_returnflag ASC NULLS FIRST, l_linestatus ASC NULLS FIRST) AS rn
  FROM {_HOT_ITEMS}) x
WHERE rn = 1
""",
    "fact_join_hot_order": f"""
SELECT o_orderkey AS sk_order, o_custkey AS nk_customer, l_partkey AS nk_part, l_suppkey AS nk_supplier,
       l_linenumber AS line_no, l_extendedprice AS item_value, l_tax AS freight_value,
       round(l_extendedprice + l_tax, 4) AS total_value, o_orderdate AS ordered_at,
       l_shipdate AS shipped_at, o_orderstatus AS order_status
FROM {_HOT_ITEMS} JOIN orders ON l_orderkey = o_orderkey
""",
    "key_uniqueness": """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""",
    "group_avg_two": """
SELECT o_orderstatus, o_orderpriority, round(avg(o_totalprice), 2) AS avg_price,
       round(avg(o_custkey), 4) AS avg_cust
FROM orders GROUP BY o_orderstatus, o_orderpriority
""",
    "centroid_3key": f"""
SELECT zip, city, state, round(avg(lat), 4) AS lat, round(avg(lng), 4) AS lng
FROM {_LOCATED} GROUP BY zip, city, state
""",
    "centroid_exact": f"""
SELECT c_nationkey % 7 AS zip, n_name AS city, c_mktsegment AS state,
       {_exact_avg("c_acctbal")} AS lat, {_exact_avg("(c_acctbal / 3 - 7)")} AS lng
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_acctbal IS NOT NULL AND NOT isnan(c_acctbal)
GROUP BY 1, 2, 3
""",
    "zip_centroid": f"""
SELECT zip, round(avg(lat), 4) AS lat, round(avg(lng), 4) AS lng, min(city) AS city, min(state) AS state
FROM {_LOCATED} GROUP BY zip
""",
    "dim_fanout_check": f"""
SELECT zip, count(*) AS n_rows FROM (SELECT DISTINCT zip, city, state FROM {_LOCATED}) x
GROUP BY zip HAVING count(*) > 1
""",
    "fact_sales_join": """
SELECT o_orderkey AS sk_order, o_custkey AS nk_customer, l_partkey AS nk_part, l_suppkey AS nk_supplier,
       l_linenumber AS line_no, l_extendedprice AS item_value, l_tax AS freight_value,
       round(l_extendedprice + l_tax, 4) AS total_value, o_orderdate AS ordered_at,
       l_shipdate AS shipped_at, o_orderstatus AS order_status
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""",
    "role_playing_dims": """
SELECT o.o_orderkey, cn.n_name AS customer_nation, l.l_linenumber, l.l_partkey, sn.n_name AS supplier_nation
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation cn ON c.c_nationkey = cn.n_nationkey
JOIN nation sn ON s.s_nationkey = sn.n_nationkey
""",
    "rule_score_range": """
SELECT event_type, count(*) AS rows_seen,
       count(*) FILTER (WHERE value BETWEEN 1 AND 100) AS rows_ok,
       count(*) FILTER (WHERE NOT (value BETWEEN 1 AND 100)) AS rows_bad
FROM events GROUP BY event_type
""",
    "rule_money_min": """
SELECT l_returnflag, count(*) AS rows_seen,
       count(*) FILTER (WHERE l_extendedprice >= 1000.0) AS rows_ok,
       count(*) FILTER (WHERE l_extendedprice < 1000.0) AS rows_bad
FROM lineitem GROUP BY l_returnflag
""",
    "ri_orphans": """
SELECT i.l_orderkey, i.l_linenumber, i.l_partkey FROM (
  SELECT CASE WHEN l_partkey % 101 <> 0
              THEN CASE WHEN l_partkey % 7 = 0 THEN -l_orderkey ELSE l_orderkey END END AS l_orderkey,
         l_linenumber, l_partkey FROM lineitem) i
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = i.l_orderkey)
""",
    "kpi_monthly_sales": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
       count(DISTINCT o_orderkey) AS n_orders,
       CAST(sum(TRY_CAST(l_extendedprice AS DECIMAL(38,2))) AS DOUBLE) AS revenue,
       count(*) FILTER (WHERE l_extendedprice IS NOT NULL
                          AND TRY_CAST(l_extendedprice AS DECIMAL(38,2)) IS NULL) AS n_bad_values
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
GROUP BY year(o_orderdate), month(o_orderdate)
""",
    "kpi_sales_by_region": """
SELECT r_name, o_orderstatus, count(*) AS n_items,
       CAST(sum(TRY_CAST(l_extendedprice AS DECIMAL(38,2))) AS DOUBLE) AS revenue,
       count(*) FILTER (WHERE l_extendedprice IS NOT NULL
                          AND TRY_CAST(l_extendedprice AS DECIMAL(38,2)) IS NULL) AS n_bad_values
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY r_name, o_orderstatus
""",
    "csv_multiline_roundtrip": """
SELECT conv_id, turn, role, text FROM conversations
""",
    "landing_glob_scan": """
SELECT 'customer' AS table_name, count(*) AS n_rows FROM customer
UNION ALL SELECT 'supplier', count(*) FROM supplier
UNION ALL SELECT 'orders', count(*) FROM orders
""",
    "landing_misfits": """
SELECT reason, CASE WHEN reason IS NULL THEN CAST(k AS VARCHAR) END AS order_id,
       CASE WHEN reason IS NULL THEN CASE kind WHEN 5 THEN c || chr(10) || 'next, "q"' WHEN 6 THEN '5" ' || c ELSE c END END
         AS customer_id,
       CASE WHEN reason IS NULL THEN s END AS status,
       CASE kind WHEN 1 THEN k || ',' || c WHEN 2 THEN k || ',' || c || ',' || s || ',extra'
                 WHEN 3 THEN k || ',"' || c || '"x,' || s WHEN 4 THEN k || ',' || c || ',' || s || ',,two' END AS record
FROM (SELECT *, CASE kind WHEN 1 THEN 'too_few_fields' WHEN 2 THEN 'surplus_fields' WHEN 3 THEN 'text_after_quote'
                          WHEN 4 THEN 'surplus_fields' END AS reason
      FROM (SELECT o_orderkey AS k, CAST(o_custkey AS VARCHAR) AS c, o_orderstatus AS s,
                   CASE WHEN o_orderkey % 7 = 1 THEN 1 WHEN o_orderkey % 11 = 2 THEN 2 WHEN o_orderkey % 13 = 3 THEN 3
                        WHEN o_orderkey % 17 = 4 THEN 4 WHEN o_orderkey % 19 = 5 THEN 5 WHEN o_orderkey % 23 = 6 THEN 6
                        ELSE 0 END AS kind FROM orders) x) y
""",
    "atomic_replace": """
SELECT o_orderkey, o_totalprice * 2 AS o_totalprice FROM orders
""",
    "stream_ingest": """
SELECT conv_id, turn, role, text FROM conversations
""",
    "parquet_roundtrip": """
SELECT * FROM orders
""",
    "medallion_fact": f"""
WITH {LAKE}
SELECT order_id AS sk_pedido, customer_id AS nk_cliente, product_id AS nk_produto,
       seller_id AS nk_vendedor, order_item_id AS quantidade_itens, price AS valor_produto,
       freight_value AS valor_frete, price + freight_value AS valor_total_item,
       purchased AS data_compra, approved AS data_aprovacao, posted AS data_postagem,
       delivered AS data_entrega, estimated AS data_estimada_entrega, order_status AS status_pedido
FROM fact
""",
    "medallion_products": f"""
WITH {LAKE}
SELECT product_id AS nk_produto, category AS categoria_produto, name_length AS comprimento_nome_produto,
       description_length AS comprimento_descricao_produto, photos AS qtd_fotos_produto,
       weight AS peso_gramas, len AS comprimento_cm, height AS altura_cm, width AS largura_cm
FROM prod
""",
    "medallion_customers": f"""
WITH {LAKE}
SELECT customer_id AS nk_cliente, unique_id AS id_unico_cliente, zip AS cep_prefixo_cliente,
       city AS cidade_cliente, state AS estado_cliente
FROM cust
""",
    "medallion_sellers": f"""
WITH {LAKE}
SELECT seller_id AS nk_vendedor, zip AS cep_prefixo_vendedor, city AS cidade_vendedor,
       state AS estado_vendedor
FROM sell
""",
    "medallion_payments": f"""
WITH {LAKE}
SELECT order_id AS sk_pedido, seq AS sequencial_pagamento, kind AS tipo_pagamento,
       parts AS qtd_parcelas, amount AS valor_pagamento
FROM pay
""",
    "medallion_geo_dim": f"""
WITH {LAKE}
SELECT zip AS nk_cep_prefixo_cliente, lat AS latitude_cliente, lng AS longitude_cliente,
       city AS cidade_cliente, state AS estado_cliente
FROM geo
""",
    "medallion_geo_sellers": f"""
WITH {LAKE}
SELECT zip AS nk_cep_prefixo_vendedor, lat AS latitude_vendedor, lng AS longitude_vendedor,
       city AS cidade_vendedor, state AS estado_vendedor
FROM geo
""",
    "medallion_reviews": f"""
WITH {LAKE}
SELECT review_id AS sk_avaliacao, order_id AS sk_pedido, score AS nota_avaliacao,
       title AS titulo_comentario, message AS mensagem_comentario,
       created AS data_criacao_avaliacao, answered AS data_resposta_vendedor
FROM rev
""",
    "medallion_kpi_monthly": f"""
WITH {LAKE}
SELECT CAST(year(purchased) AS INTEGER) AS y, CAST(month(purchased) AS INTEGER) AS m,
       count(DISTINCT order_id) AS n_orders,
       CAST(sum(TRY_CAST(price AS DECIMAL(38,2))) AS DOUBLE) AS revenue,
       count(*) FILTER (WHERE price IS NOT NULL AND TRY_CAST(price AS DECIMAL(38,2)) IS NULL) AS n_bad_values
FROM fact GROUP BY year(purchased), month(purchased)
""",
    "medallion_kpi_state": f"""
WITH {LAKE}
SELECT state AS customer_state, order_status, count(*) AS n_items,
       CAST(sum(TRY_CAST(price AS DECIMAL(38,2))) AS DOUBLE) AS revenue,
       count(*) FILTER (WHERE price IS NOT NULL AND TRY_CAST(price AS DECIMAL(38,2)) IS NULL) AS n_bad_values
FROM fact JOIN cust ON fact.customer_id = cust.customer_id
GROUP BY state, order_status
""",
    "medallion_quality": f"""
WITH {LAKE}
SELECT 'orphan_key' AS "check", 'dim_clientes' AS table_name,
       (SELECT count(*) FROM fact WHERE customer_id NOT IN (SELECT customer_id FROM cust)) AS n_bad
UNION ALL SELECT 'orphan_key', 'dim_produtos',
       (SELECT count(*) FROM fact WHERE product_id NOT IN (SELECT product_id FROM prod))
UNION ALL SELECT 'orphan_key', 'dim_vendedores',
       (SELECT count(*) FROM fact WHERE seller_id NOT IN (SELECT seller_id FROM sell))
UNION ALL SELECT 'order_without_items', 'dim_pagamentos',
       (SELECT count(*) FROM pay WHERE order_id NOT IN (SELECT order_id FROM fact))
UNION ALL SELECT 'duplicate_key', 'dim_clientes',
       (SELECT count(*) FROM (SELECT 1 FROM cust GROUP BY customer_id HAVING count(*) > 1) x)
UNION ALL SELECT 'duplicate_key', 'dim_produtos',
       (SELECT count(*) FROM (SELECT 1 FROM prod GROUP BY product_id HAVING count(*) > 1) x)
UNION ALL SELECT 'duplicate_key', 'dim_vendedores',
       (SELECT count(*) FROM (SELECT 1 FROM sell GROUP BY seller_id HAVING count(*) > 1) x)
UNION ALL SELECT 'repeated_input_key', 'olist_customers_dataset',
       (SELECT count(*) FROM (SELECT 1 FROM cuv GROUP BY customer_id HAVING count(*) > 1) x)
UNION ALL SELECT 'repeated_input_key', 'olist_products_dataset',
       (SELECT count(*) FROM (SELECT 1 FROM prv GROUP BY p_partkey HAVING count(*) > 1) x)
UNION ALL SELECT 'repeated_input_key', 'olist_sellers_dataset',
       (SELECT count(*) FROM (SELECT 1 FROM sev GROUP BY seller_id HAVING count(*) > 1) x)
UNION ALL SELECT 'zip_fanout', 'dim_geolocalizacao_clientes',
       (SELECT count(*) FROM (SELECT zip FROM geo GROUP BY zip HAVING count(*) > 1) x)
UNION ALL SELECT 'score_out_of_range', 'dim_avaliacoes',
       (SELECT count(*) FROM rev WHERE NOT (score BETWEEN 1 AND 5))
UNION ALL SELECT 'negative_value', 'dim_pagamentos',
       (SELECT count(*) FROM pay WHERE amount < 0)
""",
    "gold_gate": f"""
WITH {LAKE}
SELECT 'fato_vendas' AS table_name, 'held' AS status, count(*) AS n_rows FROM fact
UNION ALL SELECT 'dim_produtos', 'held', count(*) FROM prod
UNION ALL SELECT 'dim_clientes', 'held', count(*) FROM cust
UNION ALL SELECT 'dim_vendedores', 'held', count(*) FROM sell
UNION ALL SELECT 'dim_pagamentos', 'held', count(*) FROM pay
UNION ALL SELECT 'dim_geolocalizacao_clientes', 'held', count(*) FROM geo
UNION ALL SELECT 'dim_geolocalizacao_vendedores', 'held', count(*) FROM geo
UNION ALL SELECT 'dim_avaliacoes', 'held', count(*) FROM rev
""",
}

# The same rows, whatever the layout of the joined tables.
ORACLE_SQL["colocated_fact_join"] = ORACLE_SQL["fact_sales_join"]
ORACLE_SQL["colocated_hot_order"] = ORACLE_SQL["fact_join_hot_order"]

_CUBE = """
SELECT CASE grouping_id(y, m, state, status) WHEN 3 THEN 'y+m' WHEN 12 THEN 'state+status' WHEN 7 THEN 'y'
            WHEN 13 THEN 'state' WHEN 14 THEN 'status' ELSE 'all' END AS level,
       y, m, state, status, count(*) AS n_items,
       CAST(sum(TRY_CAST(l_extendedprice AS DECIMAL(38,2))) AS DOUBLE) AS revenue,
       count(*) FILTER (WHERE l_extendedprice IS NOT NULL
                          AND TRY_CAST(l_extendedprice AS DECIMAL(38,2)) IS NULL) AS n_bad_values,
       count(DISTINCT o_orderkey) AS n_orders{extra}
FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, r_name AS state,
             o_orderstatus AS status, l_extendedprice, o_orderkey
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) x
GROUP BY GROUPING SETS ((y, m), (state, status), (y), (state), (status), ())
"""
ORACLE_SQL["kpi_cube"] = _CUBE.format(extra=", true AS near")
ORACLE_SQL["kpi_cube_merged"] = _CUBE.format(extra="")
ORACLE_SQL["medallion_kpi_cube"] = f"""
SELECT y, m, n_orders, revenue, n_bad_values, NULL AS customer_state, NULL AS order_status, NULL AS n_items
FROM ({ORACLE_SQL["medallion_kpi_monthly"]}) a
UNION ALL SELECT NULL, NULL, NULL, revenue, n_bad_values, customer_state, order_status, n_items
FROM ({ORACLE_SQL["medallion_kpi_state"]}) b
"""
