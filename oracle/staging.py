"""Staging tables from the driver tables, written out as SQL."""

from __future__ import annotations


def _delivered(table: str, b: int, columns: str, source: str, ordinal: str, copied: bool) -> str:
    copy = "copy" if copied else "1"
    year = 2001 + b
    return f"""SELECT {columns},
  '{table}_' || {copy} || '.csv' AS source_filename,
  CAST('{year}-01-0' || {copy} || ' 06:00:00' AS TIMESTAMP) AS ingestion_date,
  CAST({ordinal} AS BIGINT) AS ingest_ordinal
FROM {source}"""


def _twice(table: str, condition: str) -> str:
    return (
        f"(SELECT t.*, 1 AS copy FROM {table} t UNION ALL "
        f"SELECT t.*, 2 AS copy FROM {table} t WHERE {condition}) t"
    )


def _day(start: str, days: str, hours: str) -> str:
    return (
        f"CAST(CAST(DATE '{start}' + CAST({days} AS INTEGER) AS VARCHAR) || ' ' || "
        f"lpad(CAST({hours} AS VARCHAR), 2, '0') || ':30:00' AS TIMESTAMP)"
    )


_USER_ID = "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN ' ' ELSE '' END || 'USER' || c_custkey"
_USER_NAME = (
    "CASE WHEN c_custkey % 83 = 5 THEN NULL WHEN c_custkey % 79 = 5 THEN 'NaN' "
    "WHEN c_custkey % 7 = 0 THEN 'mary-jane o''brien ' || c_custkey ELSE lower(c_name) END"
)
_PRIME = 2147483647
_POSITION = (
    "(((CAST(l_linenumber AS BIGINT) * 1000003 + l_partkey) % {p} * 1000003 + l_suppkey) % {p} "
    "* 1000003 + CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT)) % {p} * 4096 "
    "+ (CAST(floor(l_quantity) AS BIGINT) * 64 + l_linenumber) % 4096"
).format(p=_PRIME)
_PLACED_SUPPLIER = (
    "(SELECT * FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey "
    "LEFT JOIN region ON n_regionkey = r_regionkey)"
)


def staging(b: int) -> dict[str, str]:
    """SQL of the 13 staging tables of batch ``b``."""
    lines = "lineitem"
    t: dict[str, str] = {}
    t["stg_orders"] = _delivered(
        "stg_orders",
        b,
        f"""CASE WHEN o_orderpriority = '3-MEDIUM' THEN ' ORD' || o_orderkey || ' '
       ELSE 'ORD' || o_orderkey END AS order_id,
  CASE WHEN o_orderkey % 211 = 0 THEN '  '
       WHEN o_orderpriority = '3-MEDIUM' THEN 'USER' || o_custkey || '  '
       ELSE 'USER' || o_custkey END AS user_id,
  CASE WHEN o_orderkey % 97 = 0 THEN ''
       ELSE (o_orderkey % 15 + copy + {b - 1}) || 'days' END AS estimated_arrival,
  CAST(o_orderdate AS DATE) AS transaction_date""",
        _twice("orders", "o_orderstatus = 'P'"),
        "o_orderkey",
        True,
    )
    t["stg_order_delays"] = _delivered(
        "stg_order_delays",
        b,
        f"""'ORD' || o_orderkey AS order_id,
  CASE WHEN o_orderpriority <> '5-LOW'
       THEN CAST(o_orderkey % 19 - 3 + {2 * (b - 1)} AS INTEGER) END AS delay_in_days""",
        "orders",
        "o_orderkey",
        False,
    )
    t["stg_line_items_products"] = _delivered(
        "stg_line_items_products",
        b,
        """'ORD' || l_orderkey || ' ' AS order_id, 'item ' || l_partkey AS product_name,
  CASE WHEN NOT (l_returnflag = 'R' AND l_partkey % 101 = 0) THEN 'p' || l_partkey END
    AS product_id""",
        lines,
        _POSITION,
        False,
    )
    t["stg_line_items_prices"] = _delivered(
        "stg_line_items_prices",
        b,
        f"""'ORD' || l_orderkey AS order_id,
  CASE WHEN NOT (l_linenumber = 7 AND l_returnflag = 'A')
       THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) + {b - 1} AS DECIMAL(8,2)) END AS price,
  CASE WHEN l_partkey % 53 = 0 THEN '0'
       ELSE CAST(l_quantity AS INTEGER) || 'pieces' END AS quantity""",
        lines,
        _POSITION,
        False,
    )
    raised = f"CASE WHEN p_type = 'PROMO' THEN {b - 1} ELSE 0 END"
    price = f"CAST(CAST(p_retailprice AS DECIMAL(8,2)) + {raised} + copy - 1 AS DECIMAL(8,2))"
    t["stg_product_list"] = _delivered(
        "stg_product_list",
        b,
        f"""CASE WHEN p_partkey % 401 = 400 THEN ' n/a '
       WHEN p_size % 2 = 0 THEN 'p' || p_partkey ELSE ' P' || p_partkey END AS product_id,
  CASE WHEN p_partkey % 11 = 0
       THEN 'men''s ' || p_name || ' ' || lower(p_brand) || ' that CAN''T fail, o''malley'
       ELSE p_name || ' ' || lower(p_brand) END AS product_name,
  lower(p_type) || '_size_' || (p_size % 5) AS product_type,
  CASE WHEN p_partkey % 97 = 0 THEN -{price}
       WHEN p_partkey % 89 <> 0 THEN {price} END AS price""",
        _twice("part", "p_brand = 'Brand#7'"),
        "p_partkey",
        True,
    )
    placed_customer = (
        "(SELECT * FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey "
        "LEFT JOIN region ON n_regionkey = r_regionkey)"
    )
    t["stg_user_data"] = _delivered(
        "stg_user_data",
        b,
        f"""{_USER_ID} AS user_id,
  {_day('1990-01-01', 'c_custkey % 1700', 'c_custkey % 24')} AS creation_date,
  {_USER_NAME} AS name,
  CASE WHEN c_mktsegment = 'MACHINERY' AND copy = 2 THEN c_custkey || ' second ave.'
       ELSE c_custkey || ' main st.' END AS street,
  lower(r_name) AS state,
  CASE WHEN c_custkey % 71 = 5 THEN 'nan'
       WHEN {b} = 2 AND c_mktsegment = 'FURNITURE' THEN 'new town ' || (c_custkey % 40)
       ELSE 'port-city ' || (c_custkey % 40) || ' ' END AS city,
  CASE WHEN c_custkey % 89 = 5 THEN 'Nan' ELSE n_name END AS country,
  CASE WHEN c_custkey % 61 <> 5
       THEN {_day('1940-01-01', '(c_custkey * 37) % 16000', 'c_custkey % 24')} END AS birthdate,
  CASE c_custkey % 3 WHEN 0 THEN 'Male' WHEN 1 THEN ' FEMALE ' END AS gender,
  CASE WHEN c_custkey % 29 <> 5 THEN 'aa:bb:' || c_custkey END AS device_address,
  c_mktsegment AS user_type""",
        _twice(placed_customer, "c_mktsegment IN ('BUILDING', 'MACHINERY')"),
        "c_custkey",
        True,
    )
    t["stg_user_job"] = _delivered(
        "stg_user_job",
        b,
        f"""CASE WHEN c_mktsegment = 'AUTOMOBILE' AND c_nationkey % 2 = 0 THEN ' '
       ELSE {_USER_ID} END AS user_id,
  {_USER_NAME} AS name,
  CASE WHEN c_custkey % 41 = 5 THEN 'nan' ELSE 'sales-lead ' || (c_custkey % 9) END AS job_title,
  CASE WHEN c_nationkey % 6 = 0 THEN 'N/A'
       ELSE 'level ' || (c_nationkey % 5 + copy - 1) END AS job_level""",
        _twice("customer", "c_mktsegment = 'BUILDING'"),
        "c_custkey",
        True,
    )
    t["stg_user_credit_card"] = _delivered(
        "stg_user_credit_card",
        b,
        f"""{_USER_ID} AS user_id, {_USER_NAME} AS name,
  CASE WHEN c_custkey % 10 <> 3 THEN CAST(c_custkey + 4000000000 + copy AS VARCHAR) END
    AS credit_card_number,
  CASE WHEN c_custkey % 13 <> 0 THEN ' Bank Of ' || c_nationkey END AS issuing_bank""",
        _twice("customer", "c_mktsegment = 'FURNITURE'"),
        "c_custkey",
        True,
    )
    t["stg_merchant_data"] = _delivered(
        "stg_merchant_data",
        b,
        f"""'MERCHANT' || s_suppkey || ' ' AS merchant_id,
  CASE WHEN s_suppkey % 31 <> 5
       THEN {_day('1988-03-01', '(s_suppkey * 7) % 1500', 's_suppkey % 24')} END AS creation_date,
  CASE WHEN s_nationkey = 3 AND copy = 2 THEN 'o''neil & sons ' || s_suppkey
       WHEN s_suppkey % 47 = 5 THEN 'nan' ELSE lower(s_name) END AS name,
  CASE WHEN s_suppkey % 23 <> 5 THEN s_suppkey || ' dock rd.' END AS street,
  lower(r_name) AS state,
  CASE WHEN {b} = 2 AND n_regionkey = 1 THEN 'new harbour ' ELSE 'harbour ' END
    || (s_suppkey % 10) AS city,
  CASE WHEN s_suppkey % 37 = 5 THEN 'NAN' ELSE n_name END AS country,
  CASE WHEN s_suppkey % 19 = 5 THEN ' '
       WHEN s_suppkey % 4 = 0 THEN '-' || (s_suppkey % 900 + 100) || '-'
       ELSE '(0' || (s_suppkey % 90 + 10) || ') 55' || (s_suppkey % 900 + 100) || '-' || s_suppkey
       END AS contact_number""",
        _twice(_PLACED_SUPPLIER, "s_nationkey IN (3, 4)"),
        "s_suppkey",
        True,
    )
    members = (
        f"(SELECT s.*, member, s_suppkey * 3 + member AS staff FROM {_PLACED_SUPPLIER} s "
        "CROSS JOIN (VALUES (0), (1), (2)) m(member))"
    )
    t["stg_staff"] = _delivered(
        "stg_staff",
        b,
        f"""CASE WHEN member = 1 THEN 'staff' || staff ELSE ' STAFF' || staff END AS staff_id,
  CASE WHEN staff % 43 = 5 THEN '' ELSE 'anna-lee d''arc ' || (staff % 70) END AS name,
  CASE WHEN {b} = 2 AND n_regionkey = 2 THEN 'senior manager'
       ELSE 'grade ' || (staff % 4 + copy - 1) END AS job_level,
  staff || ' mill lane' AS street, lower(r_name) AS state,
  CASE WHEN staff % 53 = 5 THEN 'nan' ELSE 'mill-town ' || (staff % 12) END AS city,
  lower(n_name) AS country,
  CASE WHEN staff % 59 <> 5 THEN '[0' || (staff % 90 + 10) || '] ' || (staff + 5550000) END
    AS contact_number,
  {_day('1985-06-01', '(staff * 5) % 2000', 'staff % 24')} AS creation_date""",
        _twice(members, "s_nationkey = 8"),
        "staff",
        True,
    )
    count = "(SELECT max(s_suppkey) + 1 FROM supplier)"
    t["stg_order_merchant"] = _delivered(
        "stg_order_merchant",
        b,
        f"""'ORD' || o_orderkey AS order_id,
  'MERCHANT' || (o_orderkey % ({count} + 3)) AS merchant_id,
  'STAFF' || ((o_orderkey * 7 + copy) % ({count} * 3 + 5)) AS staff_id""",
        _twice("orders", "o_orderstatus = 'O'"),
        "o_orderkey",
        True,
    )
    brands = "SELECT DISTINCT CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INTEGER) AS n FROM part"
    if b == 2:
        brands += " UNION ALL SELECT CAST(count(DISTINCT p_brand) + 1 AS INTEGER) FROM part"
    share = f"(n + copy + {b - 1})"
    t["stg_campaign"] = _delivered(
        "stg_campaign",
        b,
        f"""CASE WHEN n % 2 = 0 THEN ' brand#' || n ELSE 'Brand#' || n END AS campaign_id,
  CASE n % 4 WHEN 1 THEN 'don''t miss it, we''ll save - brand ' || n
       WHEN 2 THEN 'unknown deal ' || n
       ELSE 'mother''s day o''clock brand ' || n END AS campaign_name,
  'campaign for "brand" ' || n AS campaign_description,
  CASE n % 6 WHEN 0 THEN {share} || '%' WHEN 1 THEN {share} || '%%' WHEN 2 THEN {share} || 'pct'
       WHEN 3 THEN {share} || '.5percent' WHEN 4 THEN CAST({share} AS VARCHAR)
       ELSE 'none' END AS discount""",
        f"(SELECT n, copy FROM ({brands}) x CROSS JOIN (VALUES (1), (2)) c(copy))",
        "n",
        True,
    )
    t["stg_campaign_transactions"] = _delivered(
        "stg_campaign_transactions",
        b,
        f"""CAST(o_orderdate AS DATE) AS transaction_date,
  CASE o_orderpriority WHEN '2-HIGH' THEN ' '
       WHEN '1-URGENT' THEN 'brand#' || ((o_orderkey + copy * 5) % 27 + 1)
       ELSE 'BRAND#' || ((o_orderkey + copy * 5) % 27 + 1) END AS campaign_id,
  'ORD' || o_orderkey AS order_id,
  (o_orderkey % 15 + 1) || 'days' AS estimated_arrival,
  CAST((o_orderkey + copy + {b}) % 2 AS INTEGER) AS availed""",
        _twice("orders", "o_orderstatus = 'O'"),
        "o_orderkey",
        True,
    )
    return t
