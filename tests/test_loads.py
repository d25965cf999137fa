"""Loads write the tables asked for and those they depend on, each once."""

import os
from datetime import date, datetime

from bazaarlake.operators import facts
from bazaarlake.plans import batch, registry, star, store
from bazaarlake.plans.star import read_star, star_of
from test_warehouse import rows, shop


def loads(spark, root):
    warehouse = store.Warehouse(spark, root)
    first = batch.Load(warehouse, shop(spark), "2024-01-01 09:00:00")
    second = batch.Load(warehouse, shop(spark, day=2), "2024-01-02 09:00:00", before=first)
    return warehouse, first, second


def written(root):
    return {name for name in os.listdir(root) if name in star.TABLES} if os.path.isdir(root) else set()


def test_a_load_writes_what_is_asked_for(spark, tmp_path):
    root = str(tmp_path / "w")
    _, first, second = loads(spark, root)
    assert star_of(second).dim_merchant.count() > 1
    assert written(root) == {"dim_merchant"}
    star_of(first).fact_order_line_item.count()
    assert written(root) == {"dim_merchant", "dim_product", "fact_order_line_item"}
    folders = first.folders("fact_order_line_item")
    assert star_of(first).order_sums.by("customer_key").count() > 0
    assert "dim_date" not in written(root)
    assert first.folders("fact_order_line_item") == folders


def test_tables_on_demand_equal_those_of_whole_batches(spark, tmp_path):
    whole = store.Warehouse(spark, str(tmp_path / "whole"))
    batch.run_batch(whole, shop(spark), "2024-01-01 09:00:00")
    batch.run_batch(whole, shop(spark, day=2), "2024-01-02 09:00:00")
    warehouse, first, second = loads(spark, str(tmp_path / "w"))
    # The later load first, facts before dimensions.
    for version, load in [(2, second), (1, first)]:
        expected, found = read_star(whole, version), star_of(load)
        for table in star.TABLES:
            assert rows(found.tables()[table]) == rows(expected.tables()[table]), table
        assert rows(found.order_sums.by("merchant_key")) == rows(expected.order_sums.by("merchant_key"))
    assert second.publish() == 2 and second.publish() == 2
    assert rows(read_star(warehouse).fact_order) == rows(read_star(whole).fact_order)


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lines_are_matched_without_product_names(spark):
    clean = batch.clean_sources(shop(spark))
    products = "product_id string, product_key bigint, is_current boolean"
    lines = batch.incoming_lines(clean, spark.createDataFrame([("P1", 1, True)], products))
    paired = [line for line in plan_of(lines).splitlines() if "struct(" in line]
    assert paired and not any("product_name" in line for line in paired)
    named = facts.match_lines(clean["product_lines"], clean["price_lines"])
    assert "product_name" in named.columns


def test_customers_are_looked_up_without_keys_of_the_bridge(spark):
    orders = spark.createDataFrame([("O1", "U1", date(2024, 1, 1))], "order_id string, user_id string, transaction_date date")
    bridge = spark.createDataFrame([("O1", "m", "s")], "order_id string, merchant_bk string, staff_bk string")

    def dimension(on, key):
        versions = f"{on} string, {key} bigint, effective_date timestamp, end_date timestamp"
        return spark.createDataFrame([({"user_id": "U1"}.get(on, on[0]), 7, datetime(1900, 1, 1), None)], versions)

    members = [("user_id", "customer_key"), ("merchant_bk", "merchant_key"), ("staff_bk", "staff_key")]
    found = facts.orders_with_versions(orders, bridge, *[dimension(on, key) for on, key in members])
    # The deepest join of the plan is printed last.
    joins = [line for line in plan_of(found).splitlines() if " Join " in line or line.startswith("Join ")]
    assert "_on" in joins[-1] and "merchant_bk" not in joins[-1]
    assert [(r.customer_key, r.merchant_key, r.staff_key) for r in found.collect()] == [(7, 7, 7)]


def test_an_ingest_has_its_department_delivered(spark, tmp_path):
    driver = str(tmp_path)
    part = "p_partkey int, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    parts = [(1, "ring", "Brand#1", "LARGE", 3, 9.0), (2, "bolt", "Brand#2", "PROMO", 4, 7.5)]
    spark.createDataFrame(parts, part).write.parquet(f"{driver}/part.parquet")
    found = registry.queries()["ingest_stg_product_list"](spark, driver)
    assert sorted(r.product_id.strip().upper() for r in found.collect()) == ["P1", "P2"]
    root = registry.delivery(spark, driver, "delivery", "stg_product_list")
    assert os.listdir(root) == ["business_department"]
