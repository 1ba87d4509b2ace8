"""Landing CSV fixtures → bronze → silver → gold, all 16 output tables checked."""

import os

import pytest

from alloy.plans import marketplace as mp
from alloy.plans.medallion import MISSING, SKIPPED, Layout, LayerError, run_layers
from alloy.sources.parquet import read_table

from conftest import rows

FIXTURES = {
    mp.ORDERS: [
        "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
        "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date",
        ' o1 ,c1, Delivered ,2017-10-02 10:56:33,2017-10-02 11:07:15,,,2017-10-18 00:00:00',
        ',c2,shipped,2017-10-03 10:00:00,,,,2017-10-20',
        '"   ",c3,shipped,2017-10-03 10:00:00,,,,2017-10-20',
        'o4,"",shipped,2017-10-03 10:00:00,,,,2017-10-20',
        'o5,c1,invoiced,n/a,,,,2017-10-20',
        'o6,c2,canceled,2018-01-01 00:00:00,,,,',
        'o6,c2,delivered,2018-02-01 00:00:00,,,,',
    ],
    mp.ITEMS: [
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value",
        "o1,1,p1,s1,2017-10-06 11:07:15,10.5,2.5",
        "o1,2,p2,s1,2017-10-06 11:07:15,5,",
        "o1,2,p2,s1,2017-10-07 11:07:15,6,1",
        "o5,,p1,s2,2017-10-06 00:00:00,abc,1",
        "o5,,p1,s2,2017-10-05 00:00:00,,1",
        "o9,1,p1,s2,2017-10-06 00:00:00,1,1",
    ],
    mp.PAYMENTS: [
        "order_id,payment_sequential,payment_type,payment_installments,payment_value",
        "o1,1,CREDIT_CARD,3,13.0",
        "o1,2,voucher,1,5.0",
        "o1,2,voucher,1,5.0",
        "o5,1,boleto,1,-1.0",
    ],
    mp.PRODUCTS: [
        "product_id,product_category_name,product_name_lenght,product_description_lenght,"
        "product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm",
        "p1, Beleza_Saude ,40,287,1,225,16,10,14",
        "p2,,44,276,1,1000,30,18,20",
        '"",x,1,1,1,1,1,1,1',
    ],
    mp.CUSTOMERS: [
        "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state",
        'c1,u1,"01037",SÃO PAULO,SP',
        "c2,,09000,campinas,SP",
        "c2,u2,09000,campinas,SP",
    ],
    mp.SELLERS: [
        "seller_id,seller_zip_code_prefix,seller_city,seller_state",
        "s1,09000,  Campinas ,SP",
        ",01037,x,SP",
    ],
    mp.REVIEWS: [
        "review_id,order_id,review_score,review_comment_title,review_comment_message,"
        "review_creation_date,review_answer_timestamp",
        'r1,o1,5,,"Recebi bem antes do prazo.\nRecomendo!",2018-01-18 00:00:00,2018-01-18 21:46:59',
        'r2,o1,0,Ruim,"disse ""ok"", mas não veio",2018-01-19 00:00:00,',
        'r1,o5,6,,"\tcomeça com tab",2018-01-20 00:00:00,2018-01-21 00:00:00',
        'r3,o5,,,,2018-01-20 00:00:00,',
    ],
    mp.GEOLOCATION: [
        "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state",
        '"01037",-23.5,-46.6,São Paulo,SP',
        '"01037",-23.7,-46.8,sao paulo,SP',
        '"01037",-20.0,-40.0,Osasco,SP',
        "09000,,-46.0,campinas,SP",
        "09000,NaN,-46.0,campinas,SP",
        "09000,-22.9,-47.0,,SP",
    ],
}


def _write_landing(root):
    os.makedirs(root, exist_ok=True)
    for name, lines in FIXTURES.items():
        with open(os.path.join(root, f"{name}.csv"), "w", encoding="utf-8") as f:
            f.write("\n".join(lines) + "\n")
    with open(os.path.join(root, "readme.txt"), "w") as f:
        f.write("ignored\n")


def _layout(tmp):
    return Layout(*(os.path.join(tmp, x) for x in ("landing", "bronze", "silver", "gold", "quarantine")))


def _gold(spark, layout, name):
    return read_table(spark, layout.gold, name)


def test_full_run_outputs(spark, tmp_dir):
    layout = _layout(tmp_dir)
    _write_landing(layout.landing)
    report = run_layers(spark, layout)
    assert set(report.silver.values()) == {"ok"} and set(report.gold.values()) == {"ok"}

    fact = _gold(spark, layout, "fato_vendas")
    assert len(fact.columns) == 14
    got = rows(fact.select("sk_pedido", "quantidade_itens", "nk_produto", "valor_produto",
                           "valor_frete", "valor_total_item", "status_pedido", "nk_cliente"))
    assert got == [
        ("o1", 1, "p1", 10.5, 2.5, 13.0, "delivered", "c1"),
        ("o1", 2, "p2", 6.0, 1.0, 7.0, "delivered", "c1"),  # later shipping date wins
        ("o5", None, "p1", None, 1.0, None, "invoiced", "c1"),  # bad price → NULL
    ]
    assert rows(_gold(spark, layout, "dim_produtos").select("nk_produto", "categoria_produto",
                                                           "comprimento_nome_produto")) == [
        ("p1", "beleza_saude", 40), ("p2", None, 44)]
    assert rows(_gold(spark, layout, "dim_clientes")) == [
        ("c1", "u1", "01037", "são paulo", "sp"), ("c2", "u2", "09000", "campinas", "sp")]
    assert rows(_gold(spark, layout, "dim_vendedores")) == [("s1", "09000", "campinas", "sp")]
    assert rows(_gold(spark, layout, "dim_pagamentos")) == [
        ("o1", 1, "credit_card", 3, 13.0), ("o1", 2, "voucher", 1, 5.0), ("o5", 1, "boleto", 1, -1.0)]
    geo = [(r[0], r[3], r[4], round(r[1], 6), round(r[2], 6))
           for r in rows(_gold(spark, layout, "dim_geolocalizacao_clientes"))]
    assert sorted(geo, key=repr) == sorted([
        ("01037", "osasco", "sp", -20.0, -40.0),
        ("01037", "sao paulo", "sp", -23.6, -46.7),
        ("09000", None, "sp", -22.9, -47.0),
    ], key=repr)
    assert _gold(spark, layout, "dim_geolocalizacao_vendedores").columns[0] == "nk_cep_prefixo_vendedor"
    reviews = {r.sk_avaliacao + "/" + r.sk_pedido: r for r in _gold(spark, layout, "dim_avaliacoes").collect()}
    assert set(reviews) == {"r1/o1", "r2/o1", "r1/o5", "r3/o5"}
    assert reviews["r1/o1"].mensagem_comentario == "Recebi bem antes do prazo.\nRecomendo!"
    assert reviews["r2/o1"].mensagem_comentario == 'disse "ok", mas não veio'
    assert reviews["r1/o5"].mensagem_comentario == "\tcomeça com tab"
    assert reviews["r1/o5"].nota_avaliacao == 6 and reviews["r3/o5"].nota_avaliacao is None

    silver_rows = {t: read_table(spark, layout.silver, t).count() for t in mp.SILVER_SPECS}
    assert silver_rows == {
        mp.ORDERS: 3,       # o1, o5, o6 (later of two rows)
        mp.ITEMS: 4,        # o1/1, o1/2 (deduped), o5/NULL (deduped), o9/1 (no order yet)
        mp.PAYMENTS: 3,     # duplicate (o1, 2) kept once
        mp.PRODUCTS: 2,     # blank id dropped
        mp.CUSTOMERS: 2,    # c2 without unique id dropped, c2/u2 kept
        mp.SELLERS: 1,      # blank id dropped
        mp.REVIEWS: 4,      # (review, order) pairs are unique
        mp.GEOLOCATION: 3,  # two groups for 01037, NULL-city group for 09000
    }
    q = read_table(spark, layout.quarantine, mp.ORDERS)
    # "" in CSV reads as NULL, so only the "   " id counts as blank
    assert sorted(r.reject_reason for r in q.collect()) == ["blank_key", "null_key", "null_key"]
    assert read_table(spark, layout.silver, mp.ORDERS).count() == 3


def test_rerun_is_idempotent(spark, tmp_dir):
    layout = _layout(tmp_dir)
    _write_landing(layout.landing)
    run_layers(spark, layout)
    first = {t: rows(_gold(spark, layout, t)) for t in mp.GOLD_TABLES}
    run_layers(spark, layout)
    assert {t: rows(_gold(spark, layout, t)) for t in mp.GOLD_TABLES} == first


def test_broken_table_is_isolated_and_raised(spark, tmp_dir):
    layout = _layout(tmp_dir)
    _write_landing(layout.landing)
    # products lose a column the spec needs
    with open(os.path.join(layout.landing, f"{mp.PRODUCTS}.csv"), "w") as f:
        f.write("product_id,other\np1,x\n")
    with pytest.raises(LayerError) as err:
        run_layers(spark, layout)
    report = err.value.report
    assert report["silver"][mp.PRODUCTS].startswith("failed")
    assert report["gold"]["dim_produtos"] == SKIPPED
    assert report["gold"]["fato_vendas"] == "ok"
    assert _gold(spark, layout, "fato_vendas").count() == 3


def test_quality_report_and_indicators_on_fixtures(spark, tmp_dir):
    from alloy.plans.lake_checks import quality_report

    layout = _layout(tmp_dir)
    _write_landing(layout.landing)
    run_layers(spark, layout, kpis=True)
    report = {(r.check, r.table_name): r.n_bad for r in quality_report(spark, layout.gold).collect()}
    assert report == {
        ("orphan_key", "dim_clientes"): 0,
        ("orphan_key", "dim_produtos"): 0,
        ("orphan_key", "dim_vendedores"): 1,        # item of o5 sold by s2, dropped (blank id row)
        ("order_without_items", "dim_pagamentos"): 0,
        ("duplicate_key", "dim_clientes"): 0,
        ("duplicate_key", "dim_produtos"): 0,
        ("duplicate_key", "dim_vendedores"): 0,
        ("zip_fanout", "dim_geolocalizacao_clientes"): 1,  # 01037: sao paulo and osasco
        ("score_out_of_range", "dim_avaliacoes"): 2,       # scores 0 and 6
        ("negative_value", "dim_pagamentos"): 1,
    }
    monthly = rows(_gold(spark, layout, "kpi_vendas_mensais"))
    assert monthly == [(None, None, 1, None, 0), (2017, 10, 1, 16.5, 0)]
    by_state = rows(_gold(spark, layout, "kpi_vendas_por_estado"))
    assert by_state == [("sp", "delivered", 2, 16.5, 0), ("sp", "invoiced", 1, None, 0)]


def test_command_line_runs_each_stage(spark, tmp_dir, capsys):
    import json

    from alloy.__main__ import main

    layout = _layout(tmp_dir)
    _write_landing(layout.landing)
    paths = ["--landing", layout.landing, "--bronze", layout.bronze, "--silver", layout.silver,
             "--gold", layout.gold]
    for stage in ("bronze", "silver"):
        assert main([stage, *paths]) == 0
    capsys.readouterr()
    assert main(["gold", *paths, "--checks"]) == 0
    out = json.loads(capsys.readouterr().out)
    assert set(out["report"]["gold"].values()) == {"ok"}
    assert len(out["checks"]) == 10
    assert _gold(spark, layout, "fato_vendas").count() == 3


def test_single_line_bronze_gives_the_same_gold(spark, tmp_dir):
    a, b = _layout(os.path.join(tmp_dir, "a")), _layout(os.path.join(tmp_dir, "b"))
    _write_landing(a.landing)
    _write_landing(b.landing)
    run_layers(spark, a)
    run_layers(spark, b, single_line=[mp.ORDERS, mp.ITEMS])
    for t in mp.GOLD_TABLES:
        assert rows(_gold(spark, a, t)) == rows(_gold(spark, b, t)), t


def test_no_landing_files_stops_early(spark, tmp_dir):
    from alloy.plans.medallion import NoLandingFiles, run_bronze

    layout = _layout(tmp_dir)
    assert run_bronze(spark, layout).bronze == {}          # root does not exist
    os.makedirs(layout.landing)
    with open(os.path.join(layout.landing, "notes.txt"), "w") as f:
        f.write("no tables here\n")
    with pytest.raises(NoLandingFiles):
        run_layers(spark, layout)
    assert not os.path.exists(layout.silver)


def test_a_withheld_file_is_missing_not_stale(spark, tmp_dir):
    layout = _layout(tmp_dir)
    _write_landing(layout.landing)
    run_layers(spark, layout)
    os.remove(os.path.join(layout.landing, f"{mp.PRODUCTS}.csv"))
    report = run_layers(spark, layout)
    assert mp.PRODUCTS not in report.bronze
    assert report.silver[mp.PRODUCTS] == MISSING and report.missing() == [mp.PRODUCTS]
    assert report.gold["dim_produtos"] == SKIPPED
    assert report.gold["fato_vendas"] == "ok"


def test_a_price_beyond_any_decimal_is_counted(spark, tmp_dir):
    layout = _layout(tmp_dir)
    _write_landing(layout.landing)
    with open(os.path.join(layout.landing, f"{mp.ITEMS}.csv"), "a") as f:
        f.write("o1,3,p1,s1,2017-10-06 11:07:15,1e20,0\no1,4,p1,s1,2017-10-06 11:07:15,1e40,0\n")
    run_layers(spark, layout, kpis=True)
    assert rows(_gold(spark, layout, "kpi_vendas_mensais")) == [
        (None, None, 1, None, 0), (2017, 10, 1, 1e20 + 16.5, 1)]
    assert _gold(spark, layout, "fato_vendas").count() == 5


def test_single_line_table_with_an_open_quote_fails(spark, tmp_dir):
    layout = _layout(tmp_dir)
    _write_landing(layout.landing)
    with pytest.raises(LayerError, match="OpenQuote"):
        run_layers(spark, layout, single_line=[mp.REVIEWS])


def test_quarantine_is_empty_after_a_clean_run(spark, tmp_dir):
    layout = _layout(tmp_dir)
    _write_landing(layout.landing)
    run_layers(spark, layout)
    assert read_table(spark, layout.quarantine, mp.SELLERS).count() == 1
    with open(os.path.join(layout.landing, f"{mp.SELLERS}.csv"), "w") as f:
        f.write("seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,09000,x,SP\n")
    report = run_layers(spark, layout)
    q = read_table(spark, layout.quarantine, mp.SELLERS)
    assert q.count() == 0 and "reject_reason" in q.columns
    assert report.largest_file[mp.SELLERS] > 0
