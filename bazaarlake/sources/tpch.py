"""Staging tables derived from the TPC-H-like driver tables.

The driver tables are clean, so defects (blank ids, missing values, repeated deliveries, mixed
case, text numbers) are derived from their columns by plain expressions. Every row of
``orders``, ``lineitem``, ``customer``, ``supplier`` and ``part`` is delivered. ``batch`` 2
delivers them again, later and with changed attributes.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.lazy import LazyTables
from bazaarlake.sources.schemas import STAGING, conform

FIRST_NOW = "1996-06-01 00:00:00"
SECOND_NOW = "1998-06-15 12:00:00"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(*parts: Column | str) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def _every(key: str, n: int, rest: int = 0) -> Column:
    return F.col(key) % n == rest


def _copies(df: DataFrame, twice: Column) -> DataFrame:
    """Adds ``copy`` 1 to every row and a second row with copy 2 where ``twice`` holds."""
    count = F.when(twice, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return df.withColumn("copy", F.explode(count))


def _deliver(df: DataFrame, table: str, batch: int, ordinal: Column) -> DataFrame:
    """Adds file name, load time and row position."""
    year = 2001 + batch
    copy = F.col("copy") if "copy" in df.columns else F.lit(1)
    loaded = _text(f"{year}-01-0", copy, " 06:00:00").cast("timestamp")
    stamped = df.withColumn("source_filename", _text(f"{table}_", copy, ".csv"))
    stamped = stamped.withColumn("ingestion_date", loaded)
    stamped = stamped.withColumn("ingest_ordinal", ordinal.cast("long"))
    return conform(stamped, STAGING[table])


def _day_stamp(start: str, days: Column, hours: Column) -> Column:
    day = F.date_add(F.lit(start).cast("date"), days.cast("int"))
    clock = F.concat(F.lpad(hours.cast("string"), 2, "0"), F.lit(":30:00"))
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" "), clock).cast("timestamp")


# --- operations -----------------------------------------------------------------------------


def _order_id(key: str) -> Column:
    return _text("ORD", F.col(key))


def stg_orders(spark: SparkSession, sf_dir: str, batch: int = 1) -> DataFrame:
    orders = _copies(driver_table(spark, sf_dir, "orders"), F.col("o_orderstatus") == "P")
    padded = F.col("o_orderpriority") == "3-MEDIUM"
    order_id = _order_id("o_orderkey")
    user_id = _text("USER", F.col("o_custkey"))
    days = F.col("o_orderkey") % 15 + F.col("copy") + (batch - 1)
    rows = orders.select(
        "copy",
        "o_orderkey",
        F.when(padded, _text(" ", order_id, " ")).otherwise(order_id).alias("order_id"),
        F.when(_every("o_orderkey", 211), "  ")
        .when(padded, _text(user_id, "  "))
        .otherwise(user_id)
        .alias("user_id"),
        F.when(_every("o_orderkey", 97), "").otherwise(_text(days, "days")).alias(
            "estimated_arrival"
        ),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
    )
    return _deliver(rows, "stg_orders", batch, F.col("o_orderkey"))


def stg_order_delays(spark: SparkSession, sf_dir: str, batch: int = 1) -> DataFrame:
    low = F.col("o_orderpriority") == "5-LOW"
    rows = driver_table(spark, sf_dir, "orders").select(
        "o_orderkey",
        _order_id("o_orderkey").alias("order_id"),
        F.when(~low, F.col("o_orderkey") % 19 - 3 + 2 * (batch - 1)).alias("delay_in_days"),
    )
    return _deliver(rows, "stg_order_delays", batch, F.col("o_orderkey"))


def _line_position() -> Column:
    """A position of 43 bits, the same for both line files: columns mixed modulo a prime."""
    cents = F.floor(F.col("l_extendedprice") * 100 + 0.5)
    mixed = F.col("l_linenumber").cast("long")
    for part in [F.col("l_partkey"), F.col("l_suppkey"), cents]:
        mixed = (mixed * 1_000_003 + part) % 2_147_483_647
    return mixed * 4096 + (F.floor("l_quantity") * 64 + F.col("l_linenumber")) % 4096


def stg_line_items_products(spark: SparkSession, sf_dir: str, batch: int = 1) -> DataFrame:
    missing = (F.col("l_returnflag") == "R") & _every("l_partkey", 101)
    rows = driver_table(spark, sf_dir, "lineitem").select(
        _text(_order_id("l_orderkey"), " ").alias("order_id"),
        _text("item ", F.col("l_partkey")).alias("product_name"),
        F.when(~missing, _text("p", F.col("l_partkey"))).alias("product_id"),
        _line_position().alias("position"),
    )
    return _deliver(rows, "stg_line_items_products", batch, F.col("position"))


def stg_line_items_prices(spark: SparkSession, sf_dir: str, batch: int = 1) -> DataFrame:
    unpriced = (F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "A")
    price = F.col("l_extendedprice").cast("decimal(18,2)") + (batch - 1)
    rows = driver_table(spark, sf_dir, "lineitem").select(
        _order_id("l_orderkey").alias("order_id"),
        F.when(~unpriced, price).alias("price"),
        F.when(_every("l_partkey", 53), "0")
        .otherwise(_text(F.col("l_quantity").cast("int"), "pieces"))
        .alias("quantity"),
        _line_position().alias("position"),
    )
    return _deliver(rows, "stg_line_items_prices", batch, F.col("position"))


# --- business -------------------------------------------------------------------------------


def stg_product_list(spark: SparkSession, sf_dir: str, batch: int = 1) -> DataFrame:
    part = _copies(driver_table(spark, sf_dir, "part"), F.col("p_brand") == "Brand#7")
    name = _text(F.col("p_name"), " ", F.lower("p_brand"))
    raised = F.when(F.col("p_type") == "PROMO", batch - 1).otherwise(0)
    price = F.col("p_retailprice").cast("decimal(8,2)") + raised + F.col("copy") - 1
    rows = part.select(
        "copy",
        "p_partkey",
        F.when(_every("p_partkey", 401, 400), " n/a ")
        .when(_every("p_size", 2), _text("p", F.col("p_partkey")))
        .otherwise(_text(" P", F.col("p_partkey")))
        .alias("product_id"),
        F.when(_every("p_partkey", 11), _text("men's ", name, " that CAN'T fail, o'malley"))
        .otherwise(name)
        .alias("product_name"),
        _text(F.lower("p_type"), "_size_", F.col("p_size") % 5).alias("product_type"),
        F.when(_every("p_partkey", 97), -price)
        .when(~_every("p_partkey", 89), price)
        .alias("price"),
    )
    return _deliver(rows, "stg_product_list", batch, F.col("p_partkey"))


# --- customers ------------------------------------------------------------------------------


def _user_name() -> Column:
    key = F.col("c_custkey")
    return (
        F.when(_every("c_custkey", 83, 5), F.lit(None).cast("string"))
        .when(_every("c_custkey", 79, 5), "NaN")
        .when(_every("c_custkey", 7), _text("mary-jane o'brien ", key))
        .otherwise(F.lower("c_name"))
    )


def _user_id() -> Column:
    padded = F.col("c_mktsegment") == "HOUSEHOLD"
    user_id = _text("USER", F.col("c_custkey"))
    return F.when(padded, _text(" ", user_id)).otherwise(user_id)


def stg_user_data(spark: SparkSession, sf_dir: str, batch: int = 1) -> DataFrame:
    segment = F.col("c_mktsegment")
    customers = _copies(
        driver_table(spark, sf_dir, "customer"), segment.isin("BUILDING", "MACHINERY")
    )
    nations = driver_table(spark, sf_dir, "nation")
    regions = driver_table(spark, sf_dir, "region")
    placed = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(
        regions, F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    key = F.col("c_custkey")
    moved = F.lit(batch == 2) & (segment == "FURNITURE")
    rows = placed.select(
        "copy",
        "c_custkey",
        _user_id().alias("user_id"),
        _day_stamp("1990-01-01", key % 1700, key % 24).alias("creation_date"),
        _user_name().alias("name"),
        F.when((segment == "MACHINERY") & (F.col("copy") == 2), _text(key, " second ave."))
        .otherwise(_text(key, " main st."))
        .alias("street"),
        F.lower("r_name").alias("state"),
        F.when(_every("c_custkey", 71, 5), "nan")
        .when(moved, _text("new town ", key % 40))
        .otherwise(_text("port-city ", key % 40, " "))
        .alias("city"),
        F.when(_every("c_custkey", 89, 5), "Nan").otherwise(F.col("n_name")).alias("country"),
        F.when(~_every("c_custkey", 61, 5), _day_stamp("1940-01-01", key * 37 % 16000, key % 24))
        .alias("birthdate"),
        F.when(_every("c_custkey", 3), "Male").when(_every("c_custkey", 3, 1), " FEMALE ").alias(
            "gender"
        ),
        F.when(~_every("c_custkey", 29, 5), _text("aa:bb:", key)).alias("device_address"),
        segment.alias("user_type"),
    )
    return _deliver(rows, "stg_user_data", batch, key)


def stg_user_job(spark: SparkSession, sf_dir: str, batch: int = 1) -> DataFrame:
    segment = F.col("c_mktsegment")
    customers = _copies(driver_table(spark, sf_dir, "customer"), segment == "BUILDING")
    key = F.col("c_custkey")
    rows = customers.select(
        "copy",
        "c_custkey",
        F.when((segment == "AUTOMOBILE") & _every("c_nationkey", 2), " ")
        .otherwise(_user_id())
        .alias("user_id"),
        _user_name().alias("name"),
        F.when(_every("c_custkey", 41, 5), "nan")
        .otherwise(_text("sales-lead ", key % 9))
        .alias("job_title"),
        F.when(_every("c_nationkey", 6), "N/A")
        .otherwise(_text("level ", F.col("c_nationkey") % 5 + F.col("copy") - 1))
        .alias("job_level"),
    )
    return _deliver(rows, "stg_user_job", batch, key)


def stg_user_credit_card(spark: SparkSession, sf_dir: str, batch: int = 1) -> DataFrame:
    segment = F.col("c_mktsegment")
    customers = _copies(driver_table(spark, sf_dir, "customer"), segment == "FURNITURE")
    key = F.col("c_custkey")
    rows = customers.select(
        "copy",
        "c_custkey",
        _user_id().alias("user_id"),
        _user_name().alias("name"),
        F.when(~_every("c_custkey", 10, 3), (key + 4_000_000_000 + F.col("copy")).cast("string"))
        .alias("credit_card_number"),
        F.when(~_every("c_custkey", 13), _text(" Bank Of ", F.col("c_nationkey"))).alias(
            "issuing_bank"
        ),
    )
    return _deliver(rows, "stg_user_credit_card", batch, key)


# --- enterprise -----------------------------------------------------------------------------


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = driver_table(spark, sf_dir, "nation")
    regions = driver_table(spark, sf_dir, "region")
    return (
        driver_table(spark, sf_dir, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    )


def stg_merchant_data(spark: SparkSession, sf_dir: str, batch: int = 1) -> DataFrame:
    """Suppliers of nation 3 are delivered twice under two names: one id, two identities."""
    suppliers = _copies(_suppliers(spark, sf_dir), F.col("s_nationkey").isin(3, 4))
    key = F.col("s_suppkey")
    renamed = (F.col("s_nationkey") == 3) & (F.col("copy") == 2)
    moved = F.lit(batch == 2) & (F.col("n_regionkey") == 1)
    rows = suppliers.select(
        "copy",
        "s_suppkey",
        _text("MERCHANT", key, " ").alias("merchant_id"),
        F.when(
            ~_every("s_suppkey", 31, 5), _day_stamp("1988-03-01", key * 7 % 1500, key % 24)
        ).alias("creation_date"),
        F.when(renamed, _text("o'neil & sons ", key))
        .when(_every("s_suppkey", 47, 5), "nan")
        .otherwise(F.lower("s_name"))
        .alias("name"),
        F.when(~_every("s_suppkey", 23, 5), _text(key, " dock rd.")).alias("street"),
        F.lower("r_name").alias("state"),
        F.when(moved, _text("new harbour ", key % 10))
        .otherwise(_text("harbour ", key % 10))
        .alias("city"),
        F.when(_every("s_suppkey", 37, 5), "NAN").otherwise(F.col("n_name")).alias("country"),
        F.when(_every("s_suppkey", 19, 5), " ")
        .when(_every("s_suppkey", 4), _text("-", key % 900 + 100, "-"))
        .otherwise(_text("(0", key % 90 + 10, ") 55", key % 900 + 100, "-", key))
        .alias("contact_number"),
    )
    return _deliver(rows, "stg_merchant_data", batch, key)


def stg_staff(spark: SparkSession, sf_dir: str, batch: int = 1) -> DataFrame:
    """Three members of staff per supplier."""
    suppliers = _suppliers(spark, sf_dir).withColumn(
        "member", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))
    )
    staffed = _copies(
        suppliers.withColumn("staff", F.col("s_suppkey") * 3 + F.col("member")),
        F.col("s_nationkey") == 8,
    )
    key = F.col("staff")
    promoted = F.lit(batch == 2) & (F.col("n_regionkey") == 2)
    rows = staffed.select(
        "copy",
        "staff",
        F.when(F.col("member") == 1, _text("staff", key))
        .otherwise(_text(" STAFF", key))
        .alias("staff_id"),
        F.when(_every("staff", 43, 5), "").otherwise(_text("anna-lee d'arc ", key % 70)).alias(
            "name"
        ),
        F.when(promoted, "senior manager")
        .otherwise(_text("grade ", key % 4 + F.col("copy") - 1))
        .alias("job_level"),
        _text(key, " mill lane").alias("street"),
        F.lower("r_name").alias("state"),
        F.when(_every("staff", 53, 5), "nan").otherwise(_text("mill-town ", key % 12)).alias(
            "city"
        ),
        F.lower("n_name").alias("country"),
        F.when(~_every("staff", 59, 5), _text("[0", key % 90 + 10, "] ", key + 5_550_000)).alias(
            "contact_number"
        ),
        _day_stamp("1985-06-01", key * 5 % 2000, key % 24).alias("creation_date"),
    )
    return _deliver(rows, "stg_staff", batch, key)


def stg_order_merchant(spark: SparkSession, sf_dir: str, batch: int = 1) -> DataFrame:
    """A few ids past the last supplier do not exist and lead to the unknown member."""
    suppliers = driver_table(spark, sf_dir, "supplier").select(F.max("s_suppkey") + 1).scalar()
    orders = _copies(driver_table(spark, sf_dir, "orders"), F.col("o_orderstatus") == "O")
    key = F.col("o_orderkey")
    rows = orders.select(
        "copy",
        "o_orderkey",
        _order_id("o_orderkey").alias("order_id"),
        _text("MERCHANT", key % (suppliers + 3)).alias("merchant_id"),
        _text("STAFF", (key * 7 + F.col("copy")) % (suppliers * 3 + 5)).alias("staff_id"),
    )
    return _deliver(rows, "stg_order_merchant", batch, key)


# --- marketing ------------------------------------------------------------------------------


def stg_campaign(spark: SparkSession, sf_dir: str, batch: int = 1) -> DataFrame:
    """One campaign per brand, each delivered twice; batch 2 adds one and changes discounts."""
    brands = driver_table(spark, sf_dir, "part").select("p_brand").distinct()
    numbered = brands.withColumn("n", F.regexp_extract("p_brand", r"(\d+)", 1).cast("int"))
    if batch == 2:
        late = brands.agg(F.count("*").alias("n")).select(
            F.lit("Brand#").alias("p_brand"), (F.col("n") + 1).cast("int").alias("n")
        )
        numbered = numbered.unionByName(late)
    campaigns = _copies(numbered, F.lit(True))
    n = F.col("n")
    percent = n + F.col("copy") + (batch - 1)
    rows = campaigns.select(
        "copy",
        "n",
        F.when(n % 2 == 0, _text(" brand#", n)).otherwise(_text("Brand#", n)).alias("campaign_id"),
        F.when(n % 4 == 1, _text("don't miss it, we'll save - brand ", n))
        .when(n % 4 == 2, _text("unknown deal ", n))
        .otherwise(_text("mother's day o'clock brand ", n))
        .alias("campaign_name"),
        _text("campaign for \"brand\" ", n).alias("campaign_description"),
        F.when(n % 6 == 0, _text(percent, "%"))
        .when(n % 6 == 1, _text(percent, "%%"))
        .when(n % 6 == 2, _text(percent, "pct"))
        .when(n % 6 == 3, _text(percent, ".5percent"))
        .when(n % 6 == 4, percent.cast("string"))
        .otherwise("none")
        .alias("discount"),
    )
    return _deliver(rows, "stg_campaign", batch, n)


def stg_campaign_transactions(spark: SparkSession, sf_dir: str, batch: int = 1) -> DataFrame:
    """Orders of high priority carry no campaign id; two campaign numbers do not exist."""
    orders = _copies(driver_table(spark, sf_dir, "orders"), F.col("o_orderstatus") == "O")
    key = F.col("o_orderkey")
    number = (key + F.col("copy") * 5) % 27 + 1
    rows = orders.select(
        "copy",
        "o_orderkey",
        F.col("o_orderdate").cast("date").alias("transaction_date"),
        F.when(F.col("o_orderpriority") == "2-HIGH", " ")
        .when(F.col("o_orderpriority") == "1-URGENT", _text("brand#", number))
        .otherwise(_text("BRAND#", number))
        .alias("campaign_id"),
        _order_id("o_orderkey").alias("order_id"),
        _text(key % 15 + 1, "days").alias("estimated_arrival"),
        ((key + F.col("copy") + batch) % 2).cast("int").alias("availed"),
    )
    return _deliver(rows, "stg_campaign_transactions", batch, key)


def staging(spark: SparkSession, sf_dir: str, batch: int = 1) -> LazyTables:
    makers = [
        stg_product_list,
        stg_line_items_products,
        stg_line_items_prices,
        stg_orders,
        stg_order_delays,
        stg_user_data,
        stg_user_job,
        stg_user_credit_card,
        stg_merchant_data,
        stg_order_merchant,
        stg_staff,
        stg_campaign,
        stg_campaign_transactions,
    ]
    return LazyTables({make.__name__: partial(make, spark, sf_dir, batch) for make in makers})
