"""Loads on a few rows written for these tests: versions, late campaigns, reloads."""

import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from bazaarlake.operators import checks, cleaning, identity
from bazaarlake.operators.latest import newest_per
from bazaarlake.plans.batch import run_batch
from bazaarlake.plans.star import read_star
from bazaarlake.plans.store import Warehouse
from bazaarlake.sources.schemas import STAGING, conform

DAY = "2024-01-0{} 08:00:00"


def table(spark, name, rows, day=1):
    """Staging rows as texts in column order, with lineage added."""
    fields = STAGING[name].fields
    data = [
        tuple(None if v is None else str(v) for v in row) + (f"{name}.csv", DAY.format(day), str(i))
        for i, row in enumerate(rows)
    ]
    texts = ", ".join(f"{f.name} string" for f in fields)
    return conform(spark.createDataFrame(data, texts), STAGING[name])


def shop(spark, day=1, **changed):
    """A small delivery; ``changed`` replaces whole tables."""
    rows = {
        "stg_product_list": [
            ("p1", "men's shirt", "clothing_top", "10"),
            ("P2 ", "o'neil cap", "clothing_hat", "7.5"),
            ("n/a", "nothing", "x", "1"),
        ],
        "stg_orders": [
            ("O1", "U1", "3days", "2023-05-01"),
            ("O2", "U2", "", "2023-06-01"),
            ("O3", "U9", "1days", "2023-06-02"),
            ("O4", "U1", "2days", "2023-06-03"),
        ],
        "stg_order_delays": [("O1", 2), ("O2", None)],
        "stg_line_items_products": [
            ("O1", "shirt", "p1"),
            ("O1", "gone", "p7"),
            ("O1", "cap", "p2"),
            ("O2", "cap", "p2"),
            ("O3", "cap", "P2"),
        ],
        "stg_line_items_prices": [
            ("O1", "10.00", "2pieces"),
            ("O1", "99.00", "0"),
            ("O1", "5.00", "1"),
            ("O1", "7.50", "4"),
            ("O2", "7.50", "1"),
            ("O3", None, "3"),
        ],
        "stg_user_data": [
            ("U1", "2020-01-01 01:02:03", "ann lee", "1 a st", "s", "manila ", "PH",
             "1990-01-01", "F", "aa", "Gold"),
            ("U2", "2020-01-02 00:00:00", None, None, "s", "nan", "Nan",
             None, None, None, "basic"),
        ],
        "stg_user_job": [("U1", "Ann Lee", "clerk", "N/A")],
        "stg_user_credit_card": [("U1", "ANN LEE", "4111", "BPI"), ("U2", None, None, "BDO")],
        "stg_merchant_data": [
            ("M1", "2019-01-01", "corner shop", "x", "y", "z", "PH", "(02) 555-1234")
        ],
        "stg_order_merchant": [("O1", "M1", "S1"), ("O2", "M8", "S8")],
        "stg_staff": [
            ("s1", "bo", "senior", "x", "y", "z", "ph", "09", "2018-01-01")
        ],
        "stg_campaign": [("c1", "don't wait", "d", "12.5%")],
        "stg_campaign_transactions": [
            ("2023-05-01", "C1", "O1", "3days", 1),
            ("2023-06-01", "c2", "O2", "1days", 1),
        ],
    }
    rows.update(changed)
    return {name: table(spark, name, data, day) for name, data in rows.items()}


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / uuid.uuid4().hex))


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def assert_sound(star):
    report = checks.integrity_report(star.tables()).collect()
    assert {r.rule: r.violations for r in report if r.violations} == {}
    for dimension, bk in [
        (star.dim_customer, "user_bk"),
        (star.dim_merchant, "merchant_bk"),
        (star.dim_staff, "staff_bk"),
        (star.dim_product, "product_bk"),
    ]:
        a = dimension.select(bk, "effective_date", "end_date")
        b = dimension.select(
            bk, F.col("effective_date").alias("e2"), F.col("end_date").alias("x2")
        )
        overlap = a.join(b, bk).filter(
            "effective_date < e2 and (end_date is null or end_date > e2)"
        )
        assert overlap.count() == 0
    totals = star.fact_order_line_item.groupBy("order_id").agg(
        F.sum("line_total_amount").alias("lines")
    )
    more = star.fact_order.join(totals, "order_id").filter("lines > order_total_amount")
    assert more.count() == 0


def test_first_load(spark, warehouse):
    run_batch(warehouse, shop(spark), "2024-01-01 09:00:00")
    star = read_star(warehouse)
    assert_sound(star)
    orders = {r.order_id: r for r in star.fact_order.collect()}
    # O4 has no priced line.
    assert sorted(orders) == ["O1", "O2", "O3"]
    one, two, three = orders["O1"], orders["O2"], orders["O3"]
    assert float(one.order_total_amount) == 55.0  # the line with quantity 0 is gone
    assert float(one.discount_amount) == 7.15  # 12.5 % is stored as 0.13
    assert float(one.net_order_amount) == 47.85
    assert (one.number_of_items, one.delay_in_days, one.availed_flag) == (7, 2, True)
    assert one.estimated_arrival_date_key == 20230504
    assert one.actual_arrival_date_key == 20230506
    assert (two.estimated_arrival_date_key, two.actual_arrival_date_key) == (None, None)
    # Campaign c2 is not known, merchant and staff of O2 do not exist, user of O3 neither.
    assert (two.campaign_key, two.merchant_key, two.staff_key) == (-1, -1, -1)
    assert three.customer_key == -1
    assert two.availed_flag and float(two.discount_amount) == 0.0
    # Second and third product line take the second and third price line that is left.
    lines = rows(star.fact_order_line_item.select("order_id", "quantity", "line_total_amount"))
    found = {(o, q, float(t)) for o, q, t in lines}
    assert found == {
        ("O1", 2, 20.0),
        ("O1", 4, 30.0),
        ("O2", 1, 7.5),
        ("O3", 3, 0.0),
    }
    ann = star.dim_customer.filter("user_id = 'U1'").first()
    assert (ann.name, ann.city, ann.job_level, ann.issuing_bank) == (
        "Ann Lee",
        "Manila",
        "N/A",
        "bpi",
    )
    other = star.dim_customer.filter("user_id = 'U2'").first()
    assert (other.name, other.city, other.country, other.credit_card_number) == (
        "Unknown",
        "Unknown",
        "Unknown",
        "Unknown",
    )
    assert {r.product_name for r in star.dim_product.collect()} == {"Men's Shirt", "O'Neil Cap"}


def test_same_delivery_twice_changes_nothing(spark, warehouse):
    run_batch(warehouse, shop(spark), "2024-01-01 09:00:00")
    before = {t: rows(df) for t, df in read_star(warehouse).tables().items()}
    run_batch(warehouse, shop(spark, day=2), "2024-01-02 09:00:00")
    after = {t: rows(df) for t, df in read_star(warehouse).tables().items()}
    for name in before:
        if name == "fact_order_line_item":  # replaced lines take new keys
            strip = [Counter(r[1:] for r in x[name].elements()) for x in (before, after)]
            assert strip[0] == strip[1]
        else:
            assert before[name] == after[name], name


def test_changed_customer_and_late_campaign(spark, warehouse):
    run_batch(warehouse, shop(spark), "2023-05-20 09:00:00")
    moved = [
        ("U1", "2020-01-01 01:02:03", "ann lee", "1 a st", "s", "cebu", "PH",
         "1990-01-01", "F", "aa", "Gold"),
    ]
    second = shop(
        spark,
        day=2,
        stg_user_data=moved,
        stg_campaign=[("c2", "late one", "d", "10")],
        stg_orders=[("O1", "U1", "9days", "2023-05-01"), ("O5", "U1", "1days", "2023-06-09")],
        stg_line_items_products=[("O1", "shirt", "p1"), ("O5", "cap", "p2")],
        stg_line_items_prices=[("O1", "11.00", "1"), ("O5", "7.50", "2")],
        stg_campaign_transactions=[("2023-05-01", "c2", "O1", "3days", 1)],
        stg_order_delays=[("O1", 5)],
    )
    run_batch(warehouse, second, "2023-06-05 09:00:00")
    star = read_star(warehouse)
    assert_sound(star)
    versions = star.dim_customer.filter("user_id = 'U1'").orderBy("customer_key").collect()
    assert [(v.city, v.is_current) for v in versions] == [("Manila", False), ("Cebu", True)]
    assert str(versions[0].end_date) == "2023-06-05 08:59:59"
    assert str(versions[1].effective_date) == "2023-06-05 09:00:00"
    orders = {r.order_id: r for r in star.fact_order.collect()}
    assert sorted(orders) == ["O1", "O2", "O3", "O5"]
    # Updated: amounts, campaign, delay. Kept: estimated arrival and customer version.
    assert float(orders["O1"].net_order_amount) == 9.9
    assert orders["O1"].delay_in_days == 5
    assert orders["O1"].estimated_arrival_date_key == 20230504
    assert orders["O1"].actual_arrival_date_key == 20230515
    assert orders["O1"].customer_key == versions[0].customer_key
    assert orders["O5"].customer_key == versions[1].customer_key
    campaigns = {r.campaign_id: r.campaign_key for r in star.dim_campaign.collect()}
    assert set(campaigns) == {"C1", "C2", "UNKNOWN"}
    assert orders["O1"].campaign_key == campaigns["C2"]
    # Lines of O1 were replaced, those of O2 and O3 stay.
    lines = Counter(r.order_id for r in star.fact_order_line_item.collect())
    assert lines == {"O1": 1, "O2": 1, "O3": 1, "O5": 1}


def test_published_versions_stay_readable(spark, warehouse):
    run_batch(warehouse, shop(spark), "2024-01-01 09:00:00")
    run_batch(warehouse, shop(spark, day=2, stg_orders=[]), "2024-01-02 09:00:00")
    assert len(warehouse.versions()) == 2
    assert warehouse.read("fact_order", 1).count() == 3


def test_reused_merchant_id_does_not_multiply_orders(spark):
    merchants = table(
        spark,
        "stg_merchant_data",
        [
            ("M1", "2019-01-01", "a", "x", "y", "z", "PH", "1"),
            ("M1", "2019-01-01", "b", "x", "y", "z", "PH", "1"),
        ],
    )
    keys = identity.merchant_identity(merchants)
    staff = identity.staff_identity(table(spark, "stg_staff", []))
    bridge = cleaning.clean_order_merchant(
        table(spark, "stg_order_merchant", [("O1", "M1", "S1")]), keys, staff
    )
    smallest = min(r.merchant_bk for r in keys.collect())
    assert [(r.order_id, r.merchant_bk) for r in bridge.collect()] == [("O1", smallest)]


def test_newest_row_wins(spark):
    both = table(spark, "stg_orders", [("O1", "U1", "1", "2023-01-01")], 1).unionByName(
        table(spark, "stg_orders", [("O1", "U2", "1", "2023-01-01")], 2)
    )
    assert [r.user_id for r in newest_per(both, ["order_id"]).collect()] == ["U2"]


def test_ranked_dedup_prunes_before_the_shuffle(spark):
    orders = cleaning.clean_orders(table(spark, "stg_orders", [("O1", "U1", "1", "2023-01-01")]))
    plan = orders._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_a_reload_rewrites_only_folders_with_its_orders(spark, warehouse):
    run_batch(warehouse, shop(spark), "2024-01-01 09:00:00")
    other = [("O9", "U1", "1days", "2019-01-01")]
    run_batch(
        warehouse,
        shop(
            spark,
            day=2,
            stg_orders=other,
            stg_line_items_products=[("O9", "shirt", "p1")],
            stg_line_items_prices=[("O9", "1.00", "1")],
        ),
        "2024-01-02 09:00:00",
    )
    first, second = warehouse.folders(1), warehouse.folders(2)
    for fact in ["fact_order", "fact_order_line_item"]:
        assert set(first[fact]) < set(second[fact])
    star = read_star(warehouse)
    assert sorted(r.order_id for r in star.fact_order.collect()) == ["O1", "O2", "O3", "O9"]
    keys = [r.line_item_key for r in star.fact_order_line_item.collect()]
    assert len(keys) == 5 and len(set(keys)) == 5


def test_a_long_folder_list_takes_the_smaller_half_along(spark, warehouse, monkeypatch):
    from bazaarlake.plans import store

    run_batch(warehouse, shop(spark), "2024-01-01 09:00:00")
    lines = warehouse.read("fact_order_line_item")
    folders = warehouse.folders()["fact_order_line_item"]
    folders += warehouse.write("fact_order_line_item", lines.limit(1))
    nothing = lines.filter("false")
    assert warehouse.touched("fact_order_line_item", folders, nothing) == []
    monkeypatch.setattr(store, "MOST_FOLDERS", 1)
    assert len(warehouse.touched("fact_order_line_item", folders, nothing)) == 1


def many_users(spark, day, moved=()):
    users = [
        (f"U{i}", "2020-01-01 01:02:03", f"name {i}", "1 a st", "s", "cebu" if i in moved else "manila", "PH",
         "1990-01-01", "F", "aa", "Gold")
        for i in range(400)
    ]
    return shop(spark, day=day, stg_user_data=users, stg_user_job=[], stg_user_credit_card=[])


def test_a_reload_rewrites_only_the_buckets_of_changed_members(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"), bucket_rows=30)
    few = shop(spark)
    run_batch(warehouse, few, "2024-01-01 09:00:00")
    assert len(warehouse.folders()["dim_customer"]) == 1
    # A load that finds the table larger than its one bucket cuts it.
    run_batch(warehouse, many_users(spark, 2), "2024-01-02 09:00:00")
    second = [f for f in warehouse.folders()["dim_customer"] if not f.endswith("closed")]
    assert len(second) == 16 and all("of" in f.rsplit("=", 1)[1] for f in second)
    run_batch(warehouse, many_users(spark, 3), "2024-01-03 09:00:00")
    second = warehouse.folders(2)["dim_customer"]
    assert warehouse.folders()["dim_customer"] == second
    run_batch(warehouse, many_users(spark, 4, moved={7, 8}), "2024-01-04 09:00:00")
    fourth = warehouse.folders()["dim_customer"]
    new = set(fourth) - set(second)
    assert sum(f.endswith("bucket=closed") for f in new) == 1
    assert 2 <= len(new) <= 3 and len(set(second) - set(fourth)) == len(new) - 1
    closed = [f for f in new if f.endswith("bucket=closed")]
    run_batch(warehouse, many_users(spark, 5, moved={7, 9}), "2024-01-05 09:00:00")
    assert set(closed) < set(warehouse.folders()["dim_customer"])
    star = read_star(warehouse)
    assert_sound(star)
    cities = {}
    for r in star.dim_customer.orderBy("customer_key").collect():
        cities.setdefault(r.user_id, []).append((r.city, r.is_current))
    assert cities["U7"] == [("Manila", False), ("Cebu", True)]
    assert cities["U8"] == [("Manila", False), ("Cebu", False), ("Manila", True)]
    assert cities["U9"] == [("Manila", False), ("Cebu", True)]
    assert cities["U11"] == [("Manila", True)] and len(cities) == 401


def test_filters_open_only_folders_that_may_hold_an_order(spark, tmp_path, monkeypatch):
    """300 folders: every order is found where it is, and few folders are opened besides."""
    from bazaarlake.plans import store

    monkeypatch.setattr(store, "MOST_FOLDERS", 1000)
    warehouse = Warehouse(spark, str(tmp_path / "w"), filter_from=0)
    schema = "line_item_key long, order_id string"
    names = [f"load=0{i:03x}" for i in range(300)]
    folders = [f"{warehouse.root}/fact_order_line_item/{name}" for name in names]
    rows = spark.range(300 * 40).select(
        F.col("id").alias("line_item_key"),
        F.concat(F.lit("O"), F.col("id").cast("string")).alias("order_id"),
        F.format_string("0%03x", F.col("id") % 300).alias("load"),
    )
    rows.repartition("load").write.partitionBy("load").parquet(f"{warehouse.root}/fact_order_line_item")
    known = {"fact_order_line_item": warehouse.filters_of("fact_order_line_item", folders)}
    warehouse.publish({"fact_order_line_item": folders, "filters": known})
    assert len(known["fact_order_line_item"]) == 300
    asked = [0, 1, 299, 300, 4567, 11_999]
    ids = spark.createDataFrame([(f"O{i}",) for i in [*asked, 99_999_999]] + [(None,)], "order_id string")
    opened = warehouse.may_hold("fact_order_line_item", folders, ids)
    holders = {names[i % 300] for i in asked}
    assert holders <= {f.rsplit("/", 1)[1] for f in opened} and len(opened) <= len(holders) + 1
    touched = warehouse.touched("fact_order_line_item", folders, ids)
    assert {f.rsplit("/", 1)[1] for f in touched} == holders
    # No order is missed in any folder.
    everything = rows.select("order_id").filter("line_item_key % 37 = 5")
    assert len(warehouse.may_hold("fact_order_line_item", folders, everything)) == 300
    nothing = spark.createDataFrame([(None,)], "order_id string")
    assert warehouse.may_hold("fact_order_line_item", folders, nothing) == []


def test_filters_follow_the_folders_of_a_load(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"), filter_from=0)
    run_batch(warehouse, shop(spark), "2024-01-01 09:00:00")
    other = dict(
        stg_orders=[("O9", "U1", "1days", "2019-01-01")],
        stg_line_items_products=[("O9", "shirt", "p1")],
        stg_line_items_prices=[("O9", "1.00", "1")],
    )
    run_batch(warehouse, shop(spark, day=2, **other), "2024-01-02 09:00:00")
    run_batch(warehouse, shop(spark, day=3), "2024-01-03 09:00:00")
    folders = warehouse.folders()
    for fact in ["fact_order", "fact_order_line_item"]:
        assert len(warehouse.filters()[fact]) == len(folders[fact]) == 2
    assert sorted(r.order_id for r in read_star(warehouse).fact_order.collect()) == ["O1", "O2", "O3", "O9"]


def test_kept_sums_equal_a_rebuild_after_reloads(spark, warehouse):
    from bazaarlake.plans import sums
    from bazaarlake.plans.sums import KEYS, OrderSums

    run_batch(warehouse, shop(spark), "2024-01-01 09:00:00")
    first = warehouse.lists.read()["sums"]
    other = dict(
        stg_orders=[("O9", "U1", "1days", "2019-01-01"), ("O1", "U1", "3days", "2023-05-01")],
        stg_line_items_products=[("O9", "shirt", "p1"), ("O1", "shirt", "p1")],
        stg_line_items_prices=[("O9", "1.00", "1"), ("O1", "2.00", "5")],
        stg_order_delays=[("O1", 9)],
    )
    run_batch(warehouse, shop(spark, day=2, **other), "2024-01-02 09:00:00")
    only_2019 = dict(other, stg_orders=[("O8", "U2", "1days", "2019-03-01")])
    only_2019.update(stg_line_items_products=[("O8", "cap", "p2")], stg_line_items_prices=[("O8", "4.00", "2")])
    second = warehouse.lists.read()["sums"]
    run_batch(warehouse, shop(spark, day=3, **only_2019), "2024-01-03 09:00:00")
    third = warehouse.lists.read()["sums"]
    # The folder of 2019 is met by no later order of 2023, so its part of the sums stays.
    assert not set(first) & set(second) and set(second) & set(third)
    for version in [1, 2, 3]:
        folders = warehouse.folders(version)["fact_order"]
        kept = warehouse.order_sums(version)
        rebuilt = OrderSums(spark, "", {}, warehouse._named("fact_order", folders))
        for key in KEYS:
            assert rows(kept.by(key)) == rows(rebuilt.by(key))
        star = read_star(warehouse, version)
        for bound in [None, 20230602, 99_999_999]:
            since = star.fact_order.filter("true" if bound is None else f"transaction_date_key >= {bound}")
            count = since.select("customer_key").distinct().count()
            assert kept.customers_since(bound, "n").first().n == count
    # A list without sums is added up from its rows.
    entries = warehouse.lists.read()
    entries.pop("sums")
    warehouse.publish(entries)
    assert rows(warehouse.order_sums().by(sums.DAY)) == rows(warehouse.order_sums(3).by(sums.DAY))


def test_bitmaps_count_every_key_once(spark, tmp_path):
    from bazaarlake.plans import sums

    orders = spark.range(200_000).select(
        F.lit("f").alias("_folder"),
        (F.col("id") % 70_001 - 1).alias("customer_key"),
        (F.col("id") % 90 + 20230101).cast("int").alias("transaction_date_key"),
    )
    counted = sums.customer_days(orders).groupBy("bucket").agg(F.bitmap_or_agg("customers").alias("c"))
    assert counted.agg(F.sum(F.bitmap_count("c"))).first()[0] == 70_001


@pytest.mark.parametrize("first", [20230101, 20230110, 20230118, 20230130])
def test_bitmaps_tell_who_came_again(spark, first):
    """Two orders of a day, orders of two days, orders of one day in two folders."""
    from bazaarlake.plans import sums

    orders = spark.range(40_000).select(
        F.concat(F.lit("f"), F.col("id") % 3).alias("_folder"),
        (F.xxhash64("id") % 30_011).alias("customer_key"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(20)) + 20230101).cast("int").alias("transaction_date_key"),
    )
    kept = sums.OrderSums.__new__(sums.OrderSums)
    kept.days = sums.customer_days(orders)
    found = kept.repeated_since(first).first()
    per = orders.filter(F.col("transaction_date_key") >= first).groupBy("customer_key").count()
    want = per.agg(F.count_if(F.col("count") > 1), F.count("*")).first()
    assert (found.repeated, found.customers) == tuple(want)


def test_shared_user_rows_stay_linear_in_the_input(spark):
    """One (id, name) with 300 keys and 300 profiles: stored once each, expanded only when asked."""
    people = [
        ("U1", f"20{i // 12 + 10}-{i % 12 + 1:02d}-01 00:00:00", "Ann Lee" if i % 2 else "ann lee ", f"{i} st", "s",
         "c", "PH", None, "F", "aa", "Gold")
        for i in range(300)
    ] + [("U2", "2020-01-02 00:00:00", "Bo", "x", "s", "c", "PH", None, "M", "aa", "basic")] * 2
    staged = table(spark, "stg_user_data", people)
    keys = identity.user_identity(staged)
    shared = cleaning.shared_user_data(staged, keys)
    assert shared.classes.count() == 301 and shared.members.count() == 301
    expanded = shared.expanded()
    plain = newest_per(
        cleaning.user_profiles(staged).join(keys.select("user_id", "name", "user_bk"), ["user_id", "name"]),
        ["user_bk", "creation_date", "birthdate", "gender", "street", "state", "city", "country",
         "device_address", "user_type"],
    )
    assert rows(expanded) == rows(plain.select(expanded.columns)) and expanded.count() == 90_001
    counts = {r.user_bk: r.row_count for r in shared.rows_per_key().collect()}
    assert Counter(counts.values()) == {300: 300, 1: 1}
