"""Identity, cleaned and warehouse tables written out as SQL, for one or two batches."""

from __future__ import annotations

from oracle.sqltext import (
    as_is_known,
    digits,
    digits_int,
    filled,
    key,
    lower_known,
    repaired,
    stamp,
    title,
    title_known,
)
from oracle.staging import staging

FIRST_NOW = "1996-06-01 00:00:00"
SECOND_NOW = "1998-06-15 12:00:00"
_START = "TIMESTAMP '1900-01-01 00:00:00'"
_NEWEST = "ingestion_date DESC, source_filename DESC, ingest_ordinal DESC"
_LINEAGE = "source_filename, ingestion_date, ingest_ordinal"


def _newest(keys: str, inner: str, order: str = _NEWEST) -> str:
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} "
        f"ORDER BY {order}) AS rn FROM ({inner}) r) WHERE rn = 1"
    )


def _given(x: str) -> str:
    return f"{x} IS NOT NULL AND trim({x}) <> ''"


def clean_tables(s: str) -> dict[str, str]:
    """Identity and cleaned tables over the staging tables with suffix ``s``."""
    t: dict[str, str] = {}
    t["user_identity"] = _newest(
        "user_bk",
        f"""SELECT trim(user_id) AS user_id,
  md5({filled('user_id')} || '_' || {filled('name')} || '_' || {stamp('birthdate')} || '_' ||
      {filled('gender')} || '_' || {stamp('creation_date')}) AS user_bk,
  {title_known('name')} AS name, {stamp('birthdate')} AS birthdate,
  lower(trim(gender)) AS gender, {stamp('creation_date')} AS creation_date, {_LINEAGE}
FROM stg_user_data{s} WHERE {_given('user_id')}""",
    )
    t["merchant_identity"] = _newest(
        "merchant_bk",
        f"""SELECT md5({filled('merchant_id')} || '_' || {filled('name')} || '_' ||
  {stamp('creation_date')}) AS merchant_bk, trim(merchant_id) AS merchant_id,
  {title_known('name')} AS name, {stamp('creation_date')} AS creation_date, {_LINEAGE}
FROM stg_merchant_data{s} WHERE {_given('merchant_id')}""",
    )
    t["staff_identity"] = _newest(
        "staff_bk",
        f"""SELECT upper(trim(staff_id)) AS staff_id,
  md5({filled('staff_id')} || '_' || {stamp('creation_date')}) AS staff_bk,
  {stamp('creation_date')} AS creation_date, {_LINEAGE}
FROM stg_staff{s} WHERE {_given('staff_id')}""",
    )
    t["product_identity"] = _newest(
        "product_bk",
        f"""SELECT trim(product_id) AS product_id,
  md5({filled('product_id')} || '_' || {filled('product_name')} || '_' ||
      {filled('product_type')}) AS product_bk,
  coalesce(lower(trim(product_name)), 'unknown') AS product_name,
  coalesce(lower(trim(product_type)), 'unknown') AS product_type, {_LINEAGE}
FROM stg_product_list{s} WHERE {_given('product_id')}""",
    )
    t["clean_orders"] = _newest(
        "order_id",
        f"""SELECT trim(order_id) AS order_id, trim(user_id) AS user_id,
  {digits_int('estimated_arrival')} AS estimated_arrival, transaction_date, {_LINEAGE}
FROM stg_orders{s}
WHERE {_given('order_id')} AND {_given('user_id')} AND transaction_date IS NOT NULL""",
    )
    t["clean_order_delays"] = _newest(
        "order_id",
        f"""SELECT trim(order_id) AS order_id, delay_in_days, {_LINEAGE}
FROM stg_order_delays{s} WHERE {_given('order_id')} AND delay_in_days IS NOT NULL""",
    )
    t["clean_campaigns"] = _newest(
        "campaign_id",
        f"""SELECT upper(trim(campaign_id)) AS campaign_id,
  {repaired(title('trim(campaign_name)'))} AS campaign_name,
  trim(campaign_description) AS campaign_description,
  coalesce(TRY_CAST(nullif(regexp_replace(discount, '[^0-9.]', '', 'g'), '') AS DECIMAL(18,4))
    * CAST(0.01 AS DECIMAL(3,2)), 0) AS discount_value, {_LINEAGE}
FROM stg_campaign{s} WHERE {_given('campaign_id')}""",
    )
    t["clean_campaign_transactions"] = _newest(
        "campaign_id, order_id",
        f"""SELECT upper(trim(campaign_id)) AS campaign_id, trim(order_id) AS order_id,
  transaction_date, {digits_int('estimated_arrival')} AS estimated_arrival,
  coalesce(availed = 1, FALSE) AS availed, {_LINEAGE}
FROM stg_campaign_transactions{s} WHERE {_given('order_id')} AND {_given('campaign_id')}""",
    )
    t["clean_line_prices"] = f"""SELECT *, row_number() OVER (PARTITION BY order_id
  ORDER BY ingestion_date, source_filename, ingest_ordinal) AS line_item_seq FROM (
  SELECT order_id, price, quantity, price * quantity AS line_total_amount, {_LINEAGE} FROM (
    SELECT trim(order_id) AS order_id, CAST(coalesce(price, 0.00) AS DECIMAL(18,2)) AS price,
      {digits_int('quantity')} AS quantity, {_LINEAGE}
    FROM stg_line_items_prices{s} WHERE order_id IS NOT NULL) p
  WHERE quantity > 0) q"""
    t["clean_line_products"] = f"""SELECT trim(order_id) AS order_id,
  trim(product_name) AS product_name, upper(trim(product_id)) AS product_id, {_LINEAGE},
  row_number() OVER (PARTITION BY trim(order_id)
    ORDER BY ingestion_date, source_filename, ingest_ordinal) AS line_item_seq
FROM stg_line_items_products{s} WHERE order_id IS NOT NULL"""
    t["clean_products"] = _newest(
        "product_id",
        f"""SELECT *, md5(product_id) AS product_bk,
  md5(coalesce(product_name, '') || coalesce(product_type, '') ||
      coalesce(CAST(price AS VARCHAR), '')) AS product_attribute_hash
FROM (SELECT upper(trim(product_id)) AS product_id,
    {repaired(title('trim(product_name)'))} AS product_name,
    {title("replace(trim(product_type), '_', ' ')")} AS product_type,
    CASE WHEN coalesce(price, 0) < 0 THEN 0.00 ELSE coalesce(price, 0.00) END
      ::DECIMAL(18,2) AS price, {_LINEAGE}
  FROM stg_product_list{s} WHERE {_given('product_id')} AND upper(trim(product_id)) NOT IN
    ('N/A', 'NA', 'UNKNOWN', 'NULL', 'INVALID', 'NOT APPLICABLE')) p""",
    )
    phone = rf"regexp_replace({digits('contact_number')}, '(\d{{3}})(\d{{3}})(\d+)', '\1-\2-\3')"
    t["clean_merchants"] = _newest(
        "merchant_bk, creation_date, street, state, city, country, contact_number",
        f"""SELECT c.*, i.merchant_bk FROM (
  SELECT trim(merchant_id) AS merchant_id, creation_date, {title_known('name')} AS name,
    {title_known('street')} AS street, {title_known('state')} AS state,
    {title_known('city')} AS city, {as_is_known('country')} AS country,
    CASE WHEN contact_number IS NULL OR trim(contact_number) = '' THEN 'Unknown'
         ELSE trim({phone}, '-') END AS contact_number, {_LINEAGE}
  FROM stg_merchant_data{s} WHERE {_given('merchant_id')}) c
JOIN merchant_identity{s} i ON c.merchant_id = i.merchant_id AND c.name = i.name
  AND {stamp('c.creation_date')} = i.creation_date""",
    )
    t["clean_staff"] = _newest(
        "staff_bk, creation_date, job_level, street, state, city, country, contact_number",
        f"""SELECT c.*, i.staff_bk FROM (
  SELECT upper(trim(staff_id)) AS staff_id, {title_known('name')} AS name,
    {title_known('job_level')} AS job_level, {title_known('street')} AS street,
    {title_known('city')} AS city, {title_known('state')} AS state,
    {title_known('country')} AS country, {digits('contact_number')} AS contact_number,
    creation_date, {_LINEAGE}
  FROM stg_staff{s} WHERE {_given('staff_id')}) c
JOIN staff_identity{s} i ON c.staff_id = i.staff_id
  AND {stamp('c.creation_date')} = i.creation_date""",
    )
    t["clean_order_merchant"] = _newest(
        "order_id",
        f"""SELECT c.*, m.merchant_bk, f.staff_bk FROM (
  SELECT trim(order_id) AS order_id, trim(merchant_id) AS merchant_id,
    upper(trim(staff_id)) AS staff_id, {_LINEAGE}
  FROM stg_order_merchant{s} WHERE {_given('order_id')}) c
LEFT JOIN merchant_identity{s} m ON c.merchant_id = m.merchant_id
LEFT JOIN staff_identity{s} f ON c.staff_id = f.staff_id""",
        _NEWEST + ", merchant_bk, staff_bk",
    )
    t["clean_user_data"] = _newest(
        "user_bk, creation_date, birthdate, gender, street, state, city, country, "
        "device_address, user_type",
        f"""SELECT c.*, i.user_bk FROM (
  SELECT trim(user_id) AS user_id, creation_date, {title_known('name')} AS name,
    {title_known('street')} AS street, {title_known('state')} AS state,
    {title_known('city')} AS city, {as_is_known('country')} AS country, birthdate,
    {lower_known('gender')} AS gender,
    {as_is_known('device_address', 'unknown')} AS device_address,
    {lower_known('user_type')} AS user_type, {_LINEAGE}
  FROM stg_user_data{s} WHERE {_given('user_id')}) c
JOIN user_identity{s} i ON c.user_id = i.user_id AND c.name = i.name""",
    )
    t["clean_user_job"] = _newest(
        "user_bk, job_title, job_level",
        f"""SELECT c.*, i.user_bk FROM (
  SELECT trim(user_id) AS user_id, {title_known('name')} AS name,
    {title_known('job_title')} AS job_title, {title_known('job_level')} AS job_level, {_LINEAGE}
  FROM stg_user_job{s} WHERE {_given('user_id')}) c
JOIN user_identity{s} i ON c.user_id = i.user_id AND c.name = i.name""",
    )
    t["clean_user_credit_card"] = _newest(
        "user_bk, credit_card_number, issuing_bank",
        f"""SELECT c.*, i.user_bk FROM (
  SELECT trim(user_id) AS user_id, {title_known('name')} AS name,
    trim(credit_card_number) AS credit_card_number,
    coalesce(lower(trim(issuing_bank)), 'unknown') AS issuing_bank, {_LINEAGE}
  FROM stg_user_credit_card{s}
  WHERE {_given('user_id')} AND {_given('credit_card_number')}) c
JOIN user_identity{s} i ON c.user_id = i.user_id AND c.name = i.name""",
    )
    # One source row per business key for the dimensions.
    job = _newest("user_bk", f"SELECT * FROM clean_user_job{s}")
    card = _newest("user_bk", f"SELECT * FROM clean_user_credit_card{s}")
    t["customer_source"] = f"""SELECT u.* EXCLUDE ({_LINEAGE}),
  coalesce(j.job_title, 'Unknown') AS job_title, coalesce(j.job_level, 'Unknown') AS job_level,
  coalesce(c.credit_card_number, 'Unknown') AS credit_card_number,
  coalesce(c.issuing_bank, 'Unknown') AS issuing_bank
FROM ({_newest('user_bk', f'SELECT * FROM clean_user_data{s}')}) u
LEFT JOIN ({job}) j ON u.user_bk = j.user_bk LEFT JOIN ({card}) c ON u.user_bk = c.user_bk"""
    t["merchant_source"] = _newest("merchant_bk", f"SELECT * FROM clean_merchants{s}")
    t["staff_source"] = f"""SELECT *, md5(coalesce(name, '') || coalesce(job_level, '') ||
  coalesce(street, '') || coalesce(city, '') || coalesce(state, '') || coalesce(country, '') ||
  coalesce(contact_number, '')) AS staff_attribute_hash
FROM ({_newest('staff_bk', f'SELECT * FROM clean_staff{s}')}) n"""
    t["product_source"] = f"SELECT * FROM clean_products{s}"
    t["order_metrics"] = f"""SELECT order_id, sum(quantity) AS number_of_items,
  sum(line_total_amount) AS order_total_amount FROM clean_line_prices{s} GROUP BY order_id"""
    t["order_campaigns"] = _newest(
        "order_id",
        f"SELECT * FROM clean_campaign_transactions{s}",
        f"availed DESC, {_NEWEST}, campaign_id",
    )
    t["date_span"] = f"""SELECT min(d) AS first, max(d) AS last FROM (
  SELECT transaction_date AS d FROM stg_orders{s}
  UNION ALL SELECT transaction_date + coalesce({digits_int('estimated_arrival')}, 0)
    FROM stg_orders{s}
  UNION ALL SELECT CAST(creation_date AS DATE) FROM stg_user_data{s}
  UNION ALL SELECT CAST(creation_date AS DATE) FROM stg_merchant_data{s}
  UNION ALL SELECT CAST(creation_date AS DATE) FROM stg_staff{s}
  UNION ALL SELECT transaction_date FROM stg_campaign_transactions{s}) x"""
    t["calendar"] = f"""SELECT {key('d')} AS date_key, d AS full_date,
  CAST(day(d) AS INTEGER) AS day, CAST(month(d) AS INTEGER) AS month,
  CAST(year(d) AS INTEGER) AS year, rpad(monthname(d), 9, ' ') AS month_name,
  CAST(quarter(d) AS INTEGER) AS quarter, CAST(isodow(d) AS INTEGER) AS day_of_week
FROM (SELECT CAST(unnest(generate_series(CAST(first AS TIMESTAMP),
    CAST(last + 365 AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d FROM date_span{s}) x"""
    return t


# Per type 2 dimension: key, business key, other columns, compared columns, unknown name.
_SCD2 = {
    "dim_customer": (
        "customer_source",
        "customer_key",
        "user_bk",
        "user_id, name, gender, birthdate, creation_date, street, city, state, country, "
        "device_address, user_type, job_title, job_level, credit_card_number, issuing_bank",
        "name, street, city, state, country, device_address, user_type, job_title, job_level, "
        "credit_card_number, issuing_bank",
        {"user_id": "'UNKNOWN'", "name": "'Unknown Customer'"},
    ),
    "dim_merchant": (
        "merchant_source",
        "merchant_key",
        "merchant_bk",
        "merchant_id, name, contact_number, street, city, state, country, creation_date",
        "street, city, state, country, contact_number",
        {"merchant_id": "'UNKNOWN'", "name": "'Unknown Merchant'"},
    ),
    "dim_staff": (
        "staff_source",
        "staff_key",
        "staff_bk",
        "staff_id, name, job_level, street, city, state, country, contact_number, "
        "creation_date, staff_attribute_hash",
        "staff_attribute_hash",
        {
            "staff_id": "'UNKNOWN'",
            "name": "'Unknown Staff'",
            "staff_attribute_hash": "md5('UNKNOWN')",
        },
    ),
    "dim_product": (
        "product_source",
        "product_key",
        "product_bk",
        "product_id, product_name, product_type, price, product_attribute_hash",
        "product_attribute_hash",
        None,
    ),
}


def _first_dimension(name: str) -> str:
    source, key_column, bk, columns, _, unknown = _SCD2[name]
    start = _START if unknown else f"TIMESTAMP '{FIRST_NOW}'"
    rows = (
        f"SELECT row_number() OVER (ORDER BY {bk}) AS {key_column}, {bk}, TRUE AS is_current, "
        f"{start} AS effective_date, CAST(NULL AS TIMESTAMP) AS end_date, {columns} FROM {source}"
    )
    if unknown:
        values = ", ".join(unknown.get(c.strip(), "NULL") for c in columns.split(","))
        rows += (
            f" UNION ALL SELECT -1, 'UNKNOWN', TRUE, {_START}, CAST(NULL AS TIMESTAMP), {values}"
        )
    return rows


def _second_dimension(name: str) -> str:
    source, key_column, bk, columns, compared, unknown = _SCD2[name]
    differ = " OR ".join(
        f"s.{c.strip()} IS DISTINCT FROM d.{c.strip()}" for c in compared.split(",")
    )
    start = _START if unknown else f"TIMESTAMP '{SECOND_NOW}'"
    now = f"TIMESTAMP '{SECOND_NOW}'"
    mine = ", ".join(f"s.{c.strip()}" for c in columns.split(","))
    changes = (
        f"SELECT s.{bk}, {mine}, d.{key_column} AS old_key FROM {source}_b2 s "
        f"LEFT JOIN {name} d ON s.{bk} = d.{bk} AND d.is_current "
        f"WHERE d.{key_column} IS NULL OR {differ}"
    )
    return f"""SELECT d.{key_column}, d.{bk}, d.is_current AND c.old_key IS NULL AS is_current,
  d.effective_date, CASE WHEN c.old_key IS NOT NULL THEN {now} - INTERVAL 1 SECOND
    ELSE d.end_date END AS end_date, {', '.join(f'd.{c.strip()}' for c in columns.split(','))}
FROM {name} d LEFT JOIN ({changes}) c ON d.{key_column} = c.old_key
UNION ALL
SELECT (SELECT max({key_column}) FROM {name}) + row_number() OVER (ORDER BY {bk}), {bk}, TRUE,
  CASE WHEN old_key IS NULL THEN {start} ELSE {now} END, CAST(NULL AS TIMESTAMP), {columns}
FROM ({changes}) x"""


def _fact_order(s: str) -> str:
    """Orders resolved against the dimensions with the same suffix."""

    def valid(d: str) -> str:
        return (
            f"o.transaction_date >= {d}.effective_date AND "
            f"({d}.end_date IS NULL OR o.transaction_date < {d}.end_date)"
        )

    discount = (
        "CASE WHEN coalesce(c.availed, FALSE) THEN CAST(coalesce(m.order_total_amount, 0) AS "
        "DECIMAL(18,2)) * coalesce(cmp.discount_value, 0) ELSE 0 END"
    )
    estimated = "o.transaction_date + o.estimated_arrival"
    inner = f"""SELECT o.order_id, coalesce(cust.customer_key, -1) AS customer_key,
  coalesce(mer.merchant_key, -1) AS merchant_key, coalesce(stf.staff_key, -1) AS staff_key,
  coalesce(cmp.campaign_key, -1) AS campaign_key,
  {key('o.transaction_date')} AS transaction_date_key,
  {key(f'({estimated})')} AS estimated_arrival_date_key,
  {key(f'({estimated} + coalesce(d.delay_in_days, 0))')} AS actual_arrival_date_key,
  coalesce(c.availed, FALSE) AS availed_flag,
  CAST(coalesce(m.order_total_amount, 0) AS DECIMAL(18,2)) AS order_total_amount,
  CAST({discount} AS DECIMAL(18,2)) AS discount_amount,
  CAST(CAST(coalesce(m.order_total_amount, 0) AS DECIMAL(18,2)) - {discount} AS DECIMAL(18,2))
    AS net_order_amount,
  CAST(coalesce(m.number_of_items, 0) AS BIGINT) AS number_of_items,
  coalesce(d.delay_in_days, 0) AS delay_in_days,
  row_number() OVER (PARTITION BY o.order_id ORDER BY cust.effective_date DESC NULLS LAST,
    mer.effective_date DESC NULLS LAST, cust.customer_key DESC NULLS LAST,
    mer.merchant_key DESC NULLS LAST, stf.effective_date DESC NULLS LAST,
    stf.staff_key DESC NULLS LAST) AS rn
FROM clean_orders{s} o
LEFT JOIN clean_order_merchant{s} b ON o.order_id = b.order_id
LEFT JOIN order_campaigns{s} c ON o.order_id = c.order_id
LEFT JOIN clean_order_delays{s} d ON o.order_id = d.order_id
JOIN order_metrics{s} m ON o.order_id = m.order_id
LEFT JOIN dim_customer{s} cust ON o.user_id = cust.user_id AND {valid('cust')}
LEFT JOIN dim_merchant{s} mer ON b.merchant_bk = mer.merchant_bk AND {valid('mer')}
LEFT JOIN dim_staff{s} stf ON b.staff_bk = stf.staff_bk AND {valid('stf')}
LEFT JOIN dim_campaign{s} cmp ON c.campaign_id = cmp.campaign_id"""
    return f"SELECT * EXCLUDE (rn) FROM ({inner}) x WHERE rn = 1"


def _matched_lines(s: str) -> str:
    return f"""SELECT p.order_id, p.line_item_seq, p.product_id, p.product_name,
  l.price AS unit_price, l.quantity, l.line_total_amount
FROM clean_line_products{s} p JOIN clean_line_prices{s} l
  ON p.order_id = l.order_id AND p.line_item_seq = l.line_item_seq
WHERE p.product_id IS NOT NULL"""


def _lines(s: str, first_key: str) -> str:
    return f"""SELECT {first_key} + row_number() OVER (ORDER BY
    left(md5(m.order_id || '/' || (m.line_item_seq // 65536)), 4), m.order_id, m.line_item_seq)
    AS line_item_key, m.order_id, p.product_key, m.quantity, m.unit_price,
  CAST(m.line_total_amount AS DECIMAL(18,2)) AS line_total_amount
FROM matched_lines{s} m JOIN dim_product{s} p ON m.product_id = p.product_id AND p.is_current"""


_KEPT_AT_UPDATE = [
    "customer_key",
    "merchant_key",
    "staff_key",
    "transaction_date_key",
    "estimated_arrival_date_key",
]
_REPLACED = [
    "campaign_key",
    "actual_arrival_date_key",
    "availed_flag",
    "order_total_amount",
    "discount_amount",
    "net_order_amount",
    "number_of_items",
    "delay_in_days",
]


def tables() -> dict[str, str]:
    """Every table of both batches; names of the second end in ``_b2``."""
    t: dict[str, str] = {}
    t.update(staging(1))
    t.update({f"{n}_b2": sql for n, sql in staging(2).items()})
    t.update(clean_tables(""))
    t.update({f"{n}_b2": sql for n, sql in clean_tables("_b2").items()})
    for name in _SCD2:
        t[name] = _first_dimension(name)
        t[f"{name}_b2"] = _second_dimension(name)
    ranked = "row_number() OVER (ORDER BY left(md5(campaign_id), 3), campaign_id)"
    unknown = "SELECT -1, 'UNKNOWN', 'Unknown Campaign', 'Unknown', 0"
    t["dim_campaign"] = f"""SELECT {ranked} AS campaign_key, campaign_id, campaign_name,
  campaign_description, CAST(discount_value AS DECIMAL(18,2)) AS discount_value
FROM clean_campaigns UNION ALL {unknown}"""
    t["dim_campaign_b2"] = f"""SELECT d.campaign_key, d.campaign_id,
  CASE WHEN c.campaign_id IS NULL THEN d.campaign_name ELSE c.campaign_name END AS campaign_name,
  CASE WHEN c.campaign_id IS NULL THEN d.campaign_description ELSE c.campaign_description END
    AS campaign_description,
  CAST(CASE WHEN c.campaign_id IS NULL THEN d.discount_value ELSE c.discount_value END
    AS DECIMAL(18,2)) AS discount_value
FROM dim_campaign d LEFT JOIN clean_campaigns_b2 c ON d.campaign_id = c.campaign_id
UNION ALL
SELECT (SELECT max(campaign_key) FROM dim_campaign) + {ranked}, campaign_id, campaign_name,
  campaign_description, CAST(discount_value AS DECIMAL(18,2))
FROM clean_campaigns_b2 WHERE campaign_id NOT IN (SELECT campaign_id FROM dim_campaign)"""
    t["dim_date"] = "SELECT * FROM calendar"
    t["dim_date_b2"] = """SELECT * FROM calendar UNION ALL
SELECT * FROM calendar_b2 WHERE date_key NOT IN (SELECT date_key FROM calendar)"""
    t["fact_order"] = _fact_order("")
    t["incoming_b2"] = _fact_order("_b2")
    kept = ", ".join(
        f"CASE WHEN o.order_id IS NULL THEN n.{c} ELSE o.{c} END AS {c}" for c in _KEPT_AT_UPDATE
    )
    replaced = ", ".join(
        f"CASE WHEN n.order_id IS NULL THEN o.{c} ELSE n.{c} END AS {c}" for c in _REPLACED
    )
    t["fact_order_b2"] = f"""SELECT coalesce(o.order_id, n.order_id) AS order_id, {kept}, {replaced}
FROM fact_order o FULL JOIN incoming_b2 n ON o.order_id = n.order_id"""
    t["matched_lines"] = _matched_lines("")
    t["matched_lines_b2"] = _matched_lines("_b2")
    t["fact_order_line_item"] = _lines("", "0")
    t["fact_order_line_item_b2"] = f"""SELECT * FROM fact_order_line_item
WHERE order_id NOT IN (SELECT order_id FROM clean_line_products_b2)
UNION ALL {_lines('_b2', '(SELECT max(line_item_key) FROM fact_order_line_item)')}"""
    return t
