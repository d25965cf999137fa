"""Operators of the load as SQL over the staging and warehouse tables."""

from __future__ import annotations

from oracle.sqltext import money, ts

LOAD_TIME = "2002-01-05 06:00:00"
_LINEAGE = f"source_filename, {ts('ingestion_date')} AS ingestion_date"

# Texts a CSV reader takes for a missing value.
_MISSING = (
    "'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', "
    "'<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'"
)


def _select(columns: str, table: str) -> str:
    """A table with its columns; names ending in ``:t`` are times, in ``:m`` money."""
    parts = []
    for column in [c.strip() for c in columns.split(",")]:
        if column.endswith(":t"):
            parts.append(f"{ts(column[:-2])} AS {column[:-2]}")
        elif column.endswith(":d"):
            parts.append(f"CAST({column[:-2]} AS VARCHAR) AS {column[:-2]}")
        elif column.endswith(":m"):
            parts.append(f"{money(column[:-2])} AS {column[:-2]}")
        else:
            parts.append(column)
    return f"SELECT {', '.join(parts)} FROM {table}"


def _clean(columns: str, table: str) -> str:
    return _select(f"{columns}, source_filename, ingestion_date:t", table)


_PROFILE = (
    "user_bk, user_id, creation_date:t, name, street, state, city, country, birthdate:t, gender, "
    "device_address, user_type"
)
_VALIDITY = "is_current, effective_date:t, end_date:t"
_DIMENSIONS = {
    "dim_customer": (
        f"customer_key, user_bk, {_VALIDITY}, user_id, name, gender, birthdate:t, "
        "creation_date:t, street, city, state, country, device_address, user_type, job_title, "
        "job_level, credit_card_number, issuing_bank"
    ),
    "dim_merchant": (
        f"merchant_key, merchant_bk, merchant_id, {_VALIDITY}, name, contact_number, street, "
        "city, state, country, creation_date:t"
    ),
    "dim_staff": (
        f"staff_key, staff_bk, {_VALIDITY}, staff_id, name, job_level, street, city, state, "
        "country, contact_number, creation_date:t, staff_attribute_hash"
    ),
    "dim_product": (
        f"product_key, product_bk, {_VALIDITY}, product_id, product_name, product_type, price:m, "
        "product_attribute_hash"
    ),
    "dim_campaign": (
        "campaign_key, campaign_id, campaign_name, campaign_description, discount_value:m"
    ),
    "dim_date": "date_key, full_date:d, day, month, year, month_name, quarter, day_of_week",
    "fact_order": (
        "order_id, customer_key, merchant_key, staff_key, campaign_key, transaction_date_key, "
        "estimated_arrival_date_key, actual_arrival_date_key, availed_flag, "
        "order_total_amount:m, discount_amount:m, net_order_amount:m, number_of_items, "
        "delay_in_days"
    ),
    "fact_order_line_item": (
        "line_item_key, order_id, product_key, quantity, unit_price:m, line_total_amount:m"
    ),
}


def _valid(d: str) -> str:
    return (
        f"o.transaction_date >= {d}.effective_date AND "
        f"({d}.end_date IS NULL OR o.transaction_date < {d}.end_date)"
    )


_VERSIONS = f"""SELECT o.order_id, c.customer_key, m.merchant_key, s.staff_key,
  row_number() OVER (PARTITION BY o.order_id ORDER BY c.effective_date DESC NULLS LAST,
    m.effective_date DESC NULLS LAST, c.customer_key DESC NULLS LAST,
    m.merchant_key DESC NULLS LAST, s.effective_date DESC NULLS LAST,
    s.staff_key DESC NULLS LAST) AS rn
FROM clean_orders_b2 o
LEFT JOIN clean_order_merchant_b2 b ON o.order_id = b.order_id
LEFT JOIN dim_customer_b2 c ON o.user_id = c.user_id AND {_valid('c')}
LEFT JOIN dim_merchant_b2 m ON b.merchant_bk = m.merchant_bk AND {_valid('m')}
LEFT JOIN dim_staff_b2 s ON b.staff_bk = s.staff_bk AND {_valid('s')}"""
_CUSTOMER_CHANGE = " OR ".join(
    f"s.{c} IS DISTINCT FROM d.{c}"
    for c in [
        "name",
        "street",
        "city",
        "state",
        "country",
        "device_address",
        "user_type",
        "job_title",
        "job_level",
        "credit_card_number",
        "issuing_bank",
    ]
)


def _checks(s: str) -> str:
    """The rules of the integrity report over the tables with suffix ``s``."""

    def twice(table: str, column: str, rule: str, where: str = "TRUE") -> str:
        return (
            f"SELECT '{rule} {table}.{column}' AS rule, count(*) AS violations FROM "
            f"(SELECT {column} FROM {table}{s} WHERE {column} IS NOT NULL AND {where} "
            f"GROUP BY {column} HAVING count(*) > 1) x"
        )

    rules = [
        twice(t, c, "unique")
        for t, c in [
            ("dim_product", "product_key"),
            ("dim_merchant", "merchant_key"),
            ("dim_staff", "staff_key"),
            ("dim_customer", "customer_key"),
            ("dim_campaign", "campaign_key"),
            ("dim_campaign", "campaign_id"),
            ("dim_date", "date_key"),
            ("fact_order", "order_id"),
            ("fact_order_line_item", "line_item_key"),
        ]
    ]
    for table, column in [
        ("dim_product", "product_bk"),
        ("dim_merchant", "merchant_bk"),
        ("dim_staff", "staff_bk"),
        ("dim_customer", "user_bk"),
    ]:
        rules.append(
            f"SELECT 'required {table}.{column}', count(*) FROM {table}{s} WHERE {column} IS NULL"
        )
        rules.append(twice(table, column, "one current row", "is_current"))
    for table, column, target, key in [
        ("fact_order", "customer_key", "dim_customer", "customer_key"),
        ("fact_order", "merchant_key", "dim_merchant", "merchant_key"),
        ("fact_order", "staff_key", "dim_staff", "staff_key"),
        ("fact_order", "campaign_key", "dim_campaign", "campaign_key"),
        ("fact_order", "transaction_date_key", "dim_date", "date_key"),
        ("fact_order", "estimated_arrival_date_key", "dim_date", "date_key"),
        ("fact_order", "actual_arrival_date_key", "dim_date", "date_key"),
        ("fact_order_line_item", "product_key", "dim_product", "product_key"),
    ]:
        rules.append(
            f"SELECT 'reference {table}.{column}', count(DISTINCT f.{column}) FROM {table}{s} f "
            f"LEFT JOIN {target}{s} d ON f.{column} = d.{key} WHERE d.{key} IS NULL"
        )
    return " UNION ALL ".join(rules)


# Ingest: format and the columns of each table; ``x`` may be missing text in a CSV.
_FILES = {
    "stg_campaign": ("csv", "campaign_id, campaign_name, campaign_description, discount", ""),
    "stg_campaign_transactions": (
        "csv ,",
        "campaign_id, order_id, estimated_arrival",
        "CAST(transaction_date AS VARCHAR) AS transaction_date, availed",
    ),
    "stg_line_items_prices": ("parquet", "", f"order_id, quantity, {money('price')} AS price"),
    "stg_line_items_products": ("csv |", "order_id, product_name, product_id", ""),
    "stg_merchant_data": (
        "csv ,",
        "merchant_id, name, street, state, city, country, contact_number",
        f"{ts('creation_date')} AS creation_date",
    ),
    "stg_order_delays": ("csv ,", "order_id", "delay_in_days"),
    "stg_order_merchant": ("csv |", "order_id, merchant_id, staff_id", ""),
    "stg_product_list": (
        "csv ,",
        "product_id, product_name, product_type",
        f"{money('price')} AS price",
    ),
    "stg_staff": (
        "parquet",
        "",
        "staff_id, name, job_level, street, state, city, country, contact_number, "
        f"{ts('creation_date')} AS creation_date",
    ),
    "stg_user_credit_card": (
        "csv ;",
        "user_id, name, credit_card_number, issuing_bank",
        "",
    ),
    "stg_user_data": (
        "csv ,",
        "user_id, name, street, state, city, country, gender, device_address, user_type",
        f"{ts('creation_date')} AS creation_date, {ts('birthdate')} AS birthdate",
    ),
    "stg_user_job": ("json", "", "user_id, name, job_title, job_level"),
    "stg_orders": ("csv ;", "", ""),
}


def _present(x: str) -> str:
    return f"CASE WHEN {x} IN ({_MISSING}) THEN NULL ELSE {x} END"


def _ingested(table: str) -> str:
    _, texts, others = _FILES[table]
    columns = [f"{_present(c.strip())} AS {c.strip()}" for c in texts.split(",") if c.strip()]
    columns += [others] if others else []
    return f"SELECT {', '.join(columns)}, '{LOAD_TIME}' AS ingestion_date FROM {table}"


_BAD_DATE = "ingest_ordinal % 131 = 7"
_NO_USER = f"({_present('user_id')} IS NULL OR trim(user_id) = '')"
_NO_ARRIVAL = "NOT regexp_matches(coalesce(estimated_arrival, ''), '[0-9]')"
_SPELLED = (
    f"CASE WHEN {_BAD_DATE} THEN '2021-99-99' WHEN ingest_ordinal % 2 = 0 "
    "THEN strftime(transaction_date, '%-m/%-d/%y') "
    "ELSE CAST(transaction_date AS VARCHAR) END"
)

SQL: dict[str, str] = {
    "clean_orders": _clean(
        "order_id, user_id, estimated_arrival, transaction_date:d", "clean_orders"
    ),
    "clean_order_delays": _clean("order_id, delay_in_days", "clean_order_delays"),
    "clean_campaigns": _clean(
        "campaign_id, campaign_name, campaign_description, discount_value:m", "clean_campaigns"
    ),
    "clean_campaign_transactions": _clean(
        "campaign_id, order_id, transaction_date:d, estimated_arrival, availed",
        "clean_campaign_transactions",
    ),
    "clean_line_prices": _clean(
        "order_id, price:m, quantity, line_total_amount:m, line_item_seq", "clean_line_prices"
    ),
    "clean_line_products": _clean(
        "order_id, product_name, product_id, line_item_seq", "clean_line_products"
    ),
    "clean_merchants": _clean(
        "merchant_bk, merchant_id, creation_date:t, name, street, state, city, country, "
        "contact_number",
        "clean_merchants",
    ),
    "clean_order_merchant": _clean(
        "order_id, merchant_id, merchant_bk, staff_id, staff_bk", "clean_order_merchant"
    ),
    "clean_products": _clean(
        "product_id, product_bk, product_name, product_type, price:m, product_attribute_hash",
        "clean_products",
    ),
    "clean_staff": _clean(
        "staff_bk, staff_id, name, job_level, street, city, state, country, contact_number, "
        "creation_date:t",
        "clean_staff",
    ),
    "clean_user_credit_card": _clean(
        "user_bk, user_id, name, credit_card_number, issuing_bank", "clean_user_credit_card"
    ),
    "clean_user_data": _clean(_PROFILE, "clean_user_data"),
    "clean_user_job": _clean("user_bk, user_id, name, job_title, job_level", "clean_user_job"),
    "customer_source": _select(
        f"{_PROFILE}, job_title, job_level, credit_card_number, issuing_bank", "customer_source"
    ),
    "fact_order_metrics": (
        "SELECT order_id, CAST(number_of_items AS BIGINT) AS number_of_items, "
        f"{money('order_total_amount')} AS order_total_amount FROM order_metrics"
    ),
    "surrogate_keys": (
        "SELECT product_bk, row_number() OVER (ORDER BY product_bk) AS product_key "
        "FROM clean_products"
    ),
    "scd_changes_customer": (
        "SELECT s.user_bk, s.city, d.customer_key AS old_customer_key FROM customer_source_b2 s "
        "LEFT JOIN dim_customer d ON s.user_bk = d.user_bk AND d.is_current "
        f"WHERE d.customer_key IS NULL OR {_CUSTOMER_CHANGE}"
    ),
    "dim_unknown_members": (
        "SELECT 'dim_customer' AS dimension, name FROM dim_customer WHERE customer_key = -1 "
        "UNION ALL SELECT 'dim_merchant', name FROM dim_merchant WHERE merchant_key = -1 "
        "UNION ALL SELECT 'dim_staff', name FROM dim_staff WHERE staff_key = -1 "
        "UNION ALL SELECT 'dim_campaign', campaign_name FROM dim_campaign WHERE campaign_key = -1"
    ),
    "dim_date_span": (
        "SELECT CAST(first AS VARCHAR) AS first_date, CAST(last AS VARCHAR) AS last_date "
        "FROM date_span"
    ),
    "fact_campaign_per_order": "SELECT order_id, campaign_id, availed FROM order_campaigns",
    "fact_as_of_versions": f"SELECT * EXCLUDE (rn) FROM ({_VERSIONS}) x",
    "fact_one_row_per_order": f"SELECT * EXCLUDE (rn) FROM ({_VERSIONS}) x WHERE rn = 1",
    "fact_order_incoming": _select(_DIMENSIONS["fact_order"], "incoming_b2"),
    "fact_lines_matched": _select(
        "order_id, line_item_seq, product_id, product_name, unit_price:m, quantity, "
        "line_total_amount:m",
        "matched_lines",
    ),
    "integrity_report": _checks(""),
    "integrity_report_reload": _checks("_b2"),
    "repeated_business_keys": (
        "SELECT user_bk, count(*) AS row_count FROM clean_user_data GROUP BY user_bk "
        "HAVING count(*) > 1"
    ),
    "batch_row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}_b2" for t in _DIMENSIONS
    ),
    "ingest_row_ordinal": (
        "SELECT count(*) AS row_count, count(*) AS distinct_positions FROM stg_line_items_products"
    ),
    "ingest_file_discovery": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{kind}' AS kind, count(*) AS row_count FROM {t}"
        for t, (kind, _, _) in _FILES.items()
    ),
    "as_of_customer_history": (
        "WITH states AS (SELECT o_custkey, o_orderdate, max(o_orderkey) AS state FROM orders GROUP BY 1, 2) "
        "SELECT CAST(o.o_custkey AS VARCHAR) AS customer, s.state, count(*) AS line_count "
        "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey "
        "ASOF LEFT JOIN states s ON s.o_custkey = o.o_custkey AND s.o_orderdate <= l.l_shipdate GROUP BY 1, 2"
    ),
    "customers_by_month": (
        "SELECT transaction_date_key // 100 AS year_month, count(DISTINCT customer_key) AS customers "
        "FROM fact_order_b2 GROUP BY 1"
    ),
    "ingest_csv_quoted": (
        "SELECT 'C' || doc_id AS campaign_id, lang || ', \"' || source || '\"' AS campaign_name, "
        "md5(nullif(replace(text, '.', '.\"'), '')) AS description_md5, "
        "length(nullif(replace(text, '.', '.\"'), '')) AS description_length, "
        "n_chars % 90 || '%' AS discount FROM documents"
    ),
    "ingest_json_array": (
        "SELECT 'U' || doc_id AS user_id, '{\"}\\\" ' || lang AS name, "
        "md5(replace(text, '.', '}]{[\".')) AS title_md5, "
        "length(replace(text, '.', '}]{[\".')) AS title_length, "
        "CASE WHEN n_chars % 5 <> 0 THEN source END AS job_level FROM documents"
    ),
    "html_table_scan": " UNION ALL ".join(
        f"SELECT 'supplier-' || s_suppkey || '.html' AS source, {n} AS row_number, "
        f"'{field}' AS field_name, {value} AS field_value FROM supplier "
        "JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
        for n, field, value in [
            (1, "name", "s_name || ' & Co'"),
            (2, "nation", "n_name"),
            (3, "region", "r_name"),
        ]
    ),
    "ingest_stg_orders": (
        f"SELECT order_id, user_id, estimated_arrival, CAST(transaction_date AS VARCHAR) "
        f"AS transaction_date, '{LOAD_TIME}' AS ingestion_date FROM stg_orders "
        f"WHERE NOT ({_BAD_DATE}) AND NOT {_NO_USER} AND NOT ({_NO_ARRIVAL})"
    ),
    "ingest_orders_rejected": (
        f"SELECT order_id, user_id, nullif(estimated_arrival, '') AS estimated_arrival, "
        f"{_SPELLED} AS transaction_date, '{LOAD_TIME}' AS ingestion_date, "
        f"concat_ws(', ', CASE WHEN {_NO_USER} THEN 'user_id: string' END, "
        f"CASE WHEN {_NO_ARRIVAL} THEN 'estimated_arrival: numeric' END, "
        f"CASE WHEN {_BAD_DATE} THEN 'transaction_date: datetime' END) AS reject_reason "
        f"FROM stg_orders WHERE {_BAD_DATE} OR {_NO_USER} OR {_NO_ARRIVAL}"
    ),
}
SQL["ingest_staging_counts"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
    + (f" WHERE NOT ({_BAD_DATE}) AND NOT {_NO_USER} AND NOT ({_NO_ARRIVAL})" if t == "stg_orders" else "")
    for t in _FILES
)
SQL.update({f"ingest_{t}": _ingested(t) for t in _FILES if t != "stg_orders"})
for _kind in ["user", "merchant", "staff", "product"]:
    SQL[f"identity_{_kind}"] = (
        "SELECT * EXCLUDE (source_filename, ingestion_date, ingest_ordinal) "
        f"FROM {_kind}_identity"
    )
for _table, _columns in _DIMENSIONS.items():
    SQL[f"{_table}_load"] = _select(_columns, _table)
    SQL[f"{_table}_reload"] = _select(_columns, f"{_table}_b2")
