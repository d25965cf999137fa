"""A reload tells its orders apart once, and looks no further where a first part of them settles it."""

import pytest
from pyspark.sql import functions as F

from bazaarlake.operators import checks, facts, ordinal
from bazaarlake.plans import batch, filters, store
from test_loads import plan_of
from test_warehouse import shop

DAYS = ["2024-01-01 09:00:00", "2024-01-02 09:00:00"]


def test_a_reload_tells_its_orders_apart_once(spark, tmp_path, monkeypatch):
    """Filters, folders and old lines meet ids written once, not all lines of the delivery again."""
    given, replaced = [], []
    touched, replace = store.Warehouse.touched, facts.replace_lines

    def asked(self, table, folders, order_ids, known=None):
        if table == "fact_order_line_item" and folders:
            given.append(order_ids)
        return touched(self, table, folders, order_ids, known)

    def kept(existing, reloaded, *rest, **named):
        replaced.append(reloaded)
        return replace(existing, reloaded, *rest, **named)

    monkeypatch.setattr(store.Warehouse, "touched", asked)
    monkeypatch.setattr(facts, "replace_lines", kept)
    warehouse = store.Warehouse(spark, str(tmp_path / "w"), filter_from=0)
    for day, now in enumerate(DAYS, 1):
        batch.run_batch(warehouse, shop(spark, day=day), now)
    (ids,) = given
    assert ids is replaced[1] and ids.columns == ["order_id"]
    assert all("staged/reloaded_orders" in f for f in ids.inputFiles())
    lines = batch.clean_sources(shop(spark, day=2))["product_lines"]
    assert ids.count() == lines.select("order_id").distinct().count() < lines.count()


@pytest.mark.parametrize("filter_from", [0, 1 << 40])
def test_folders_without_an_order_of_the_first_part_are_met_by_all(spark, tmp_path, monkeypatch, filter_from):
    warehouse = store.Warehouse(spark, str(tmp_path / "w"), filter_from=filter_from)
    named = spark.range(4000).select(F.concat(F.lit("O"), "id").alias("order_id")).withColumn(
        "first", filters.in_first_part()
    )
    first = sorted(r.order_id for r in named.filter("first").collect())
    others = sorted(r.order_id for r in named.filter("not first").collect())
    held = [first[:5] + others[:50], others[50:90], others[90:400]]
    folders = []
    for n, ids in enumerate(held):
        rows = spark.createDataFrame([(i, o) for i, o in enumerate(ids)], "line_item_key long, order_id string")
        folders.append(f"{warehouse.root}/fact_order_line_item/load=0{n}")
        rows.write.parquet(folders[-1])
    known = warehouse.filters_of("fact_order_line_item", folders)
    assert len(known) == (3 if filter_from == 0 else 0)

    looked = []
    met = store.Warehouse._holders
    monkeypatch.setattr(
        store.Warehouse, "_holders", lambda self, t, f, *rest: looked.append(list(f)) or met(self, t, f, *rest)
    )

    def touched(ids):
        looked.clear()
        asked = spark.createDataFrame([(o,) for o in ids] + [(None,)], "order_id string")
        return warehouse.touched("fact_order_line_item", folders, asked, known)

    # Found by an id of the first part: the folder is not looked at again.
    assert touched([first[2], others[80]]) == folders[:2]
    assert folders[0] in looked[0] and folders[0] not in looked[1] and folders[1] in looked[1]
    # Found by an id outside it only.
    assert touched([others[0]]) == folders[:1] and touched([others[300]]) == folders[2:]
    assert touched(["elsewhere", first[-1] + "x"]) == [] and touched([]) == []


def test_blocks_are_put_together_in_one_place(spark, tmp_path):
    """Each block of a filter is one row, with 12 bits for each id, however many tasks read ids."""
    many = spark.range(30_000).select(
        F.concat(F.lit("load=0"), (F.col("id") % 2).cast("string")).alias("_folder"),
        F.concat(F.lit("O"), "id").alias("order_id"),
    )
    facts_of = filters.build(spark, many.repartition(7), str(tmp_path / "f"))
    blocks = spark.read.parquet(*{f["at"] for f in facts_of.values()})
    counts = {r._folder: (r.n, r.bits) for r in blocks.groupBy("_folder").agg(
        F.countDistinct("block").alias("n"), F.sum(F.bitmap_count("bits")).alias("bits")).collect()}
    assert blocks.count() == sum(n for n, _ in counts.values())
    for name, (n, bits) in counts.items():
        assert n == facts_of[name]["blocks"] == 16
        assert 0.75 * 15_000 * filters.PROBES < bits <= 15_000 * filters.PROBES
    asked = many.filter("_folder = 'load=01'").select("order_id")
    assert filters.may_hold(spark, facts_of, asked) == {"load=01"}


def test_entries_of_rules_are_not_listed_through_lambdas(spark):
    """Entries without a rule are filtered rows, not array members taken out one by one."""
    tables = {
        "dim_product": "product_key long, product_bk string, is_current boolean",
        "dim_merchant": "merchant_key long, merchant_bk string, is_current boolean",
        "dim_staff": "staff_key long, staff_bk string, is_current boolean",
        "dim_customer": "customer_key long, user_bk string, is_current boolean",
        "dim_campaign": "campaign_key long, campaign_id string",
        "dim_date": "date_key int",
        "fact_order": "order_id string, customer_key long, merchant_key long, staff_key long, campaign_key long, "
        "transaction_date_key int, estimated_arrival_date_key int, actual_arrival_date_key int",
        "fact_order_line_item": "line_item_key long, product_key long",
    }
    rows = {
        "dim_product": [(1, "a", True), (1, "a", True), (2, None, True)],
        "dim_customer": [(1, "u", False), (2, "u", True)],
        "fact_order": [("O1", 1, 9, None, 9, 20240101, None, None), ("O1", 3, 9, None, 9, 20240101, None, None),
                       (None, 1, None, None, None, None, None, None)],
        "fact_order_line_item": [(1, 1), (2, 7), (3, 7), (None, None)],
        "dim_date": [(20240101,), (None,)],
    }
    made = {name: spark.createDataFrame(rows.get(name, []), schema) for name, schema in tables.items()}
    report = checks.integrity_report(made)
    assert "lambda" not in plan_of(report)
    found = {r.rule: r.violations for r in report.collect()}
    assert len(found) == 25 and {rule: n for rule, n in found.items() if n} == {
        "unique dim_product.product_key": 1,
        "one current row dim_product.product_bk": 1,
        "required dim_product.product_bk": 1,
        "unique fact_order.order_id": 1,
        "reference fact_order.customer_key": 1,
        "reference fact_order.merchant_key": 1,
        "reference fact_order.campaign_key": 1,
        "reference fact_order_line_item.product_key": 1,
    }


def test_lines_are_numbered_before_they_are_written(spark, tmp_path, monkeypatch):
    """Written lines have their place in their key bucket: they are not shuffled and sorted again for the keys."""
    staged, written = {}, []
    stage, write = store.Warehouse.stage, store.Warehouse.write

    def kept(self, rows, name):
        staged[name] = stage(self, rows, name)
        return staged[name]

    def seen(self, table, rows):
        if table == "fact_order_line_item":
            written.append(rows)
        return write(self, table, rows)

    monkeypatch.setattr(store.Warehouse, "stage", kept)
    monkeypatch.setattr(store.Warehouse, "write", seen)
    warehouse = store.Warehouse(spark, str(tmp_path / "w"))
    batch.run_batch(warehouse, shop(spark), DAYS[0])
    assert {"_bucket", "_inside"} <= set(staged["incoming_lines"].columns)
    (lines,) = written
    assert "md5" not in plan_of(lines) and lines.count() == staged["incoming_lines"].count() > 0
    assert sorted(r.line_item_key for r in lines.collect()) == list(range(1, lines.count() + 1))


def test_keys_are_the_same_with_numbered_rows_written(spark, tmp_path):
    warehouse = store.Warehouse(spark, str(tmp_path / "w"))
    rows = spark.range(3000).select(F.concat(F.lit("O"), F.col("id") % 700).alias("order_id"), "id")

    def keyed(**named):
        found = ordinal.surrogate_keys(rows, "key", F.md5("order_id"), ["order_id", "id"], F.lit(10), 2, **named)
        return sorted(map(tuple, found.select("id", "order_id", "key").collect()))

    plain = keyed()
    assert keyed(stage=lambda numbered: warehouse.stage(numbered, "numbered")) == plain
    assert sorted(key for *_, key in plain) == list(range(11, 3011))
