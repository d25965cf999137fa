"""The dashboard queries as SQL over the warehouse tables."""

from __future__ import annotations

from oracle.sqltext import cents, mean_int, mean_money, money, percent, ratio

AS_OF = "2002-01-01"

_F = "fact_order f"
_LAST = (
    "(SELECT max(d.full_date) FROM dim_date d JOIN fact_order f "
    "ON d.date_key = f.transaction_date_key)"
)
_DATED = "fact_order f JOIN dim_date d ON f.transaction_date_key = d.date_key"
_CUST = "fact_order f JOIN dim_customer c ON f.customer_key = c.customer_key"
_CAMP = "fact_order f JOIN dim_campaign c ON f.campaign_key = c.campaign_key"
_MER = "fact_order f JOIN dim_merchant m ON f.merchant_key = m.merchant_key"
_STAFF = "fact_order f JOIN dim_staff s ON f.staff_key = s.staff_key"
_LINES = "fact_order_line_item l JOIN dim_product p ON l.product_key = p.product_key"
_KNOWN = "c.campaign_name NOT ILIKE 'unknown%'"
_SEGMENTED = "c.user_type IS NOT NULL AND c.job_level IS NOT NULL"
_NET = "sum(f.net_order_amount)"
_DISCOUNT = "sum(f.discount_amount)"
_N = "count(*)"


def _since(interval: str) -> str:
    return f"d.full_date >= {_LAST} - INTERVAL {interval}"


def _day(x: str) -> str:
    return f"CAST({x} AS VARCHAR) AS full_date"


def _aov(count: str = _N) -> str:
    return mean_money(_NET, count)


def _delay(count: str = _N) -> str:
    return mean_int("sum(f.delay_in_days)", count)


_AVAILED = "count(CASE WHEN f.availed_flag THEN 1 END)"
_ON_TIME = percent("count(CASE WHEN f.delay_in_days <= 0 THEN 1 END)", _N)
_AGE = (
    f"(year(DATE '{AS_OF}') - year(c.birthdate) - CASE WHEN strftime(DATE '{AS_OF}', '%m%d') "
    "< strftime(c.birthdate, '%m%d') THEN 1 ELSE 0 END)"
)
_AGE_GROUP = (
    f"CASE WHEN {_AGE} < 25 THEN 'Under 25' WHEN {_AGE} BETWEEN 25 AND 34 THEN '25-34' "
    f"WHEN {_AGE} BETWEEN 35 AND 44 THEN '35-44' WHEN {_AGE} BETWEEN 45 AND 54 THEN '45-54' "
    "ELSE '55+' END"
)
_AGE_ORDER = (
    f"CASE WHEN {_AGE} < 25 THEN 1 WHEN {_AGE} BETWEEN 25 AND 34 THEN 2 "
    f"WHEN {_AGE} BETWEEN 35 AND 44 THEN 3 WHEN {_AGE} BETWEEN 45 AND 54 THEN 4 ELSE 5 END"
)


def _mean_band(early: str) -> str:
    return (
        f"CASE WHEN avg_delay < 0 THEN '{early}' WHEN avg_delay = 0 THEN 'On-Time' "
        "WHEN avg_delay BETWEEN 1 AND 3 THEN '1-3 Days Late' "
        "WHEN avg_delay BETWEEN 4 AND 7 THEN '4-7 Days Late' ELSE '8+ Days Late' END"
    )


_CUSTOMER_DELAY = (
    "SELECT f.customer_key, avg(f.delay_in_days) AS avg_delay, count(f.order_id) AS order_count "
    "FROM fact_order f GROUP BY f.customer_key"
)
_DELAY_ORDER = (
    "CASE WHEN f.delay_in_days < 0 THEN 'Early Delivery' WHEN f.delay_in_days = 0 THEN 'On-Time' "
    "WHEN f.delay_in_days BETWEEN 1 AND 3 THEN '1-3 Days Late' "
    "WHEN f.delay_in_days BETWEEN 4 AND 7 THEN '4-7 Days Late' "
    "WHEN f.delay_in_days BETWEEN 8 AND 14 THEN '8-14 Days Late' ELSE '15+ Days Late' END"
)
_BASKET = (
    "CASE WHEN f.number_of_items = 1 THEN '1 item' WHEN f.number_of_items = 2 THEN '2 items' "
    "WHEN f.number_of_items = 3 THEN '3 items' "
    "WHEN f.number_of_items BETWEEN 4 AND 5 THEN '4-5 items' "
    "WHEN f.number_of_items BETWEEN 6 AND 10 THEN '6-10 items' ELSE '11+ items' END"
)
_TOP_PRODUCTS = (
    f"SELECT p.product_name, sum(l.line_total_amount) AS revenue FROM {_LINES} "
    "GROUP BY p.product_name ORDER BY revenue DESC NULLS FIRST, p.product_name LIMIT 5"
)
_PAIRS = (
    "fact_order_line_item l1 JOIN fact_order_line_item l2 ON l1.order_id = l2.order_id "
    "JOIN dim_product p1 ON l1.product_key = p1.product_key "
    "JOIN dim_product p2 ON l2.product_key = p2.product_key"
)


def _growth(net: str, before: str) -> str:
    return f"coalesce({ratio(f'100 * ({cents(net)} - {cents(before)})', cents(before))}, 0.0)"


def _monthly(back: str, columns: str) -> str:
    return (
        f"SELECT strftime(d.full_date, '%Y-%m') AS year_month, "
        f"d.month_name || ' ' || d.year AS period, {columns} FROM {_DATED} "
        f"WHERE {_since(back)} GROUP BY ALL"
    )


def _scalar(expression: str, name: str, where: str = "TRUE") -> str:
    return f"SELECT {expression} AS {name} FROM {_F} WHERE {where}"


def _daily(columns: str, back: str = "12 MONTH") -> str:
    return f"SELECT {_day('d.full_date')}, {columns} FROM {_DATED} WHERE {_since(back)} GROUP BY 1"


def _top_campaigns(where: str) -> str:
    return (
        f"SELECT c.campaign_name FROM {_CAMP} WHERE {where} GROUP BY c.campaign_name "
        f"ORDER BY {_NET} DESC NULLS FIRST, c.campaign_name LIMIT 5"
    )


def _scored(table: str, columns: str, group: str, tail: str, where: str = "TRUE") -> str:
    return f"SELECT {columns} FROM {table} WHERE {where} GROUP BY {group} {tail}"


_REVENUE = f"{money(_NET)} AS revenue"

SQL: dict[str, str] = {
    # --- executive overview ---
    "exec_total_revenue": _scalar(money(_NET), "total_revenue"),
    "exec_total_orders": _scalar("count(DISTINCT f.order_id)", "total_orders"),
    "exec_aov": _scalar(_aov(), "average_order_value"),
    "exec_active_customers_30d": (
        f"SELECT count(DISTINCT f.customer_key) AS active_customers FROM {_DATED} "
        f"WHERE {_since('30 DAY')}"
    ),
    "exec_revenue_daily_12m": _daily(_REVENUE),
    "exec_orders_daily_12m": _daily("count(f.order_id) AS orders"),
    "exec_top5_campaigns": _scored(
        _CAMP,
        f"c.campaign_name, {_REVENUE}",
        "c.campaign_name",
        f"ORDER BY {_NET} DESC NULLS FIRST, c.campaign_name LIMIT 5",
        _KNOWN,
    ),
    "exec_top5_products": f"SELECT product_name, {money('revenue')} AS revenue FROM ({_TOP_PRODUCTS}) x",
    "exec_top5_merchants": _scored(
        _MER,
        f"m.name AS merchant, {_REVENUE}",
        "m.name",
        f"ORDER BY {_NET} DESC NULLS FIRST, m.name LIMIT 5",
    ),
    # --- campaign performance ---
    "camp_revenue": _scalar(money(_NET), "campaign_revenue", "f.availed_flag"),
    "camp_conversion_rate": _scalar(percent(_AVAILED, _N), "conversion_rate"),
    "camp_discount_total": _scalar(money(_DISCOUNT), "total_discount", "f.availed_flag"),
    "camp_aov": _scalar(_aov(), "campaign_aov", "f.availed_flag"),
    "camp_top5_revenue": _scored(
        _CAMP,
        f"c.campaign_name, {_REVENUE}",
        "c.campaign_name",
        f"ORDER BY {_NET} DESC NULLS FIRST, c.campaign_name LIMIT 5",
    ),
    "camp_top5_orders": _scored(
        _CAMP,
        "c.campaign_name, count(f.order_id) AS orders",
        "c.campaign_name",
        "ORDER BY orders DESC, c.campaign_name LIMIT 5",
    ),
    "camp_discount_vs_revenue": _scored(
        _CAMP,
        f"c.campaign_name, {mean_money(_DISCOUNT, _N, 6)} AS avg_discount, {_REVENUE}, "
        "count(f.order_id) AS orders",
        "c.campaign_name",
        "",
    ),
    "camp_trend_top5_12m": (
        f"SELECT {_day('d.full_date')}, c.campaign_name, {_REVENUE} FROM {_CAMP} "
        f"JOIN dim_date d ON f.transaction_date_key = d.date_key WHERE {_since('12 MONTH')} "
        f"AND c.campaign_name IN ({_top_campaigns('TRUE')}) GROUP BY d.full_date, c.campaign_name"
    ),
    # --- campaign return ---
    "roi_revenue": _scalar(money(_NET), "campaign_revenue", "f.availed_flag"),
    "roi_discount_cost": _scalar(money(_DISCOUNT), "total_discount_cost", "f.availed_flag"),
    "roi_net_profit": _scalar(
        money(f"{_NET} - {_DISCOUNT}"), "net_campaign_profit", "f.availed_flag"
    ),
    "roi_percentage": _scalar(
        percent(f"{cents(_NET)} - {cents(_DISCOUNT)}", cents(_DISCOUNT)),
        "campaign_roi_pct",
        "f.availed_flag",
    ),
    "roi_aov_ranking": _scored(
        _CAMP,
        f"left(c.campaign_name, 30) AS campaign, {_aov()} AS aov, count(f.order_id) AS orders",
        "c.campaign_name",
        "HAVING count(f.order_id) >= 5 ORDER BY aov DESC, c.campaign_name LIMIT 5",
        f"f.availed_flag AND {_KNOWN}",
    ),
    "roi_conversion_funnel": (
        "SELECT left(campaign_name, 25) AS campaign, total - converted AS not_converted, converted "
        f"FROM (SELECT c.campaign_name, {_AVAILED} AS converted, count(*) AS total FROM {_CAMP} "
        f"WHERE {_KNOWN} GROUP BY c.campaign_name) x WHERE total >= 10 "
        "ORDER BY total DESC, campaign_name LIMIT 10"
    ),
    "roi_discount_efficiency": _scored(
        _CAMP,
        f"left(c.campaign_name, 25) AS campaign, {money(_DISCOUNT)} AS total_discount, {_REVENUE}, "
        "count(f.order_id) AS orders",
        "c.campaign_name",
        f"HAVING count(f.order_id) >= 5 ORDER BY {_NET} DESC, c.campaign_name LIMIT 15",
        _KNOWN,
    ),
    "roi_scorecard": _scored(
        _CAMP,
        f"left(c.campaign_name, 30) AS campaign, {_REVENUE}, count(f.order_id) AS orders, "
        f"{_aov()} AS aov, {money(_DISCOUNT)} AS discount_cost, "
        f"{percent(f'{cents(_NET)} - {cents(_DISCOUNT)}', cents(_DISCOUNT))} AS roi_pct",
        "c.campaign_name",
        f"HAVING count(f.order_id) >= 5 ORDER BY {_NET} DESC, c.campaign_name LIMIT 10",
        f"f.availed_flag AND {_KNOWN}",
    ),
    "roi_response_by_segment": (
        "SELECT u.user_type AS customer_type, left(c.campaign_name, 25) AS campaign, "
        f"count(f.order_id) AS orders FROM {_CAMP} "
        "JOIN dim_customer u ON f.customer_key = u.customer_key "
        f"WHERE f.availed_flag AND {_KNOWN} GROUP BY u.user_type, c.campaign_name "
        "HAVING count(f.order_id) >= 3 "
        "ORDER BY orders DESC, u.user_type ASC NULLS LAST, c.campaign_name LIMIT 30"
    ),
    # --- customer analytics ---
    "cust_total": _scalar("count(DISTINCT f.customer_key)", "total_customers"),
    "cust_repeat_rate_30d": (
        f"SELECT coalesce({percent('count(CASE WHEN n > 1 THEN 1 END)', 'count(*)')}, 0.0) "
        f"AS repeat_purchase_rate FROM (SELECT f.customer_key, count(DISTINCT f.order_id) AS n "
        f"FROM {_DATED} WHERE d.full_date >= (SELECT max(full_date) FROM dim_date) "
        "- INTERVAL 30 DAY GROUP BY f.customer_key) x"
    ),
    "cust_clv": _scalar(_aov("count(DISTINCT f.customer_key)"), "clv"),
    "cust_campaign_response_rate": _scalar(percent(_AVAILED, _N), "campaign_response_rate"),
    "cust_top5_segments": _scored(
        _CUST,
        f"concat(c.user_type, ' - ', c.job_level) AS segment, {_REVENUE}",
        "c.user_type, c.job_level",
        f"ORDER BY {_NET} DESC NULLS FIRST, c.user_type ASC NULLS LAST, "
        "c.job_level ASC NULLS LAST LIMIT 5",
    ),
    "cust_orders_by_type": _scored(
        _CUST, "c.user_type AS customer_type, count(f.order_id) AS orders", "c.user_type", ""
    ),
    "cust_age_groups_spend": (
        f"SELECT {_AGE_GROUP} AS age_group, {money(_NET)} AS total_spending FROM {_CUST} "
        f"WHERE c.birthdate IS NOT NULL GROUP BY 1 ORDER BY {_NET} DESC, 1 LIMIT 5"
    ),
    "cust_response_by_type": _scored(
        _CUST,
        f"c.user_type AS customer_type, {_AVAILED} AS campaign_orders, "
        "count(CASE WHEN NOT f.availed_flag THEN 1 END) AS non_campaign_orders",
        "c.user_type",
        "",
    ),
    "cust_top5_locations": _scored(
        _CUST,
        f"concat(c.city, ', ', c.country) AS location, {_REVENUE}",
        "c.country, c.city",
        f"ORDER BY {_NET} DESC, c.country, c.city LIMIT 5",
        "c.country IS NOT NULL AND c.city IS NOT NULL",
    ),
    # --- customer segmentation ---
    "seg_total": (
        "SELECT count(DISTINCT concat(c.user_type, '-', c.job_level)) AS total_segments "
        f"FROM {_CUST} WHERE {_SEGMENTED}"
    ),
    "seg_diversity_index": (
        f"SELECT {ratio('sum(n * n)', 'sum(n) * sum(n)', 4)} AS diversity_index FROM "
        "(SELECT concat(c.user_type, '-', c.job_level) AS segment, "
        f"count(DISTINCT c.customer_key) AS n FROM {_CUST} WHERE {_SEGMENTED} GROUP BY 1) x"
    ),
    "seg_top_revenue": (
        f"SELECT {money('max(revenue)')} AS top_segment_revenue FROM (SELECT {_NET} AS revenue "
        f"FROM {_CUST} WHERE {_SEGMENTED} GROUP BY concat(c.user_type, '-', c.job_level)) x"
    ),
    "seg_top_orders": (
        "SELECT max(orders) AS top_segment_orders FROM (SELECT count(f.order_id) AS orders "
        f"FROM {_CUST} WHERE {_SEGMENTED} GROUP BY concat(c.user_type, '-', c.job_level)) x"
    ),
    "seg_aov_ranking": _scored(
        _CUST,
        f"concat(c.user_type, ' - ', c.job_level) AS segment, {_aov()} AS aov, "
        "count(f.order_id) AS orders",
        "c.user_type, c.job_level",
        "HAVING count(f.order_id) >= 10 ORDER BY aov DESC, c.user_type, c.job_level LIMIT 5",
        _SEGMENTED,
    ),
    "seg_campaign_usage": _scored(
        _CUST,
        f"concat(c.user_type, ' - ', c.job_level) AS segment, {percent(_AVAILED, _N)} "
        "AS campaign_usage_pct, count(f.order_id) AS total_orders",
        "c.user_type, c.job_level",
        "HAVING count(f.order_id) >= 10 "
        "ORDER BY campaign_usage_pct DESC, c.user_type, c.job_level LIMIT 15",
        _SEGMENTED,
    ),
    "seg_repeat_rate": (
        f"SELECT segment, {percent('count(CASE WHEN n > 1 THEN 1 END)', 'count(*)')} "
        "AS repeat_rate_pct, count(*) AS customers FROM ("
        "SELECT concat(c.user_type, ' - ', c.job_level) AS segment, f.customer_key, "
        f"count(f.order_id) AS n FROM {_CUST} WHERE {_SEGMENTED} "
        "GROUP BY c.user_type, c.job_level, f.customer_key) x GROUP BY segment "
        "HAVING count(*) >= 10"
    ),
    "seg_matrix": _scored(
        _CUST,
        f"concat(c.user_type, ' - ', c.job_level) AS segment, {_REVENUE}, "
        f"count(f.order_id) AS orders, {_aov()} AS aov",
        "c.user_type, c.job_level",
        f"HAVING count(f.order_id) >= 10 ORDER BY {_NET} DESC, c.user_type, c.job_level LIMIT 10",
        _SEGMENTED,
    ),
    "seg_age_gender": (
        f"SELECT {_AGE_GROUP} AS age_group, {_AGE_ORDER} AS age_order, c.gender, "
        f"count(f.order_id) AS orders, {_REVENUE} FROM {_CUST} "
        "WHERE c.birthdate IS NOT NULL AND c.gender IS NOT NULL GROUP BY 1, 2, 3"
    ),
    # --- delivery and logistics ---
    "dlv_on_time_pct": _scalar(_ON_TIME, "on_time_pct"),
    "dlv_avg_delay": _scalar(_delay(), "avg_delay"),
    "dlv_delayed_orders": _scalar("count(*)", "orders_with_delays", "f.delay_in_days > 0"),
    "dlv_worst_delay": _scalar("max(f.delay_in_days)", "max_delay"),
    "dlv_monthly_trend_12m": (
        f"SELECT d.year, d.month, d.month_name, {_delay()} AS avg_delay FROM {_DATED} "
        f"WHERE {_since('12 MONTH')} GROUP BY d.year, d.month, d.month_name"
    ),
    "dlv_top5_merchants_delay": _scored(
        _MER,
        f"m.name AS merchant, {_delay()} AS avg_delay, count(f.order_id) AS orders",
        "m.name",
        "HAVING count(f.order_id) >= 10 ORDER BY avg_delay DESC, m.name LIMIT 5",
    ),
    "dlv_delay_by_country": _scored(
        _CUST,
        f"c.country, {_delay()} AS avg_delay, count(f.order_id) AS orders",
        "c.country",
        "ORDER BY avg_delay DESC, c.country LIMIT 15",
        "c.country IS NOT NULL",
    ),
    "dlv_repeat_vs_delay": (
        f"SELECT {_mean_band('Early')} AS delay_category, count(*) AS repeat_customers, "
        f"{mean_int('sum(order_count)', 'count(*)')} AS avg_orders FROM ({_CUSTOMER_DELAY} "
        "HAVING count(f.order_id) >= 2) x GROUP BY 1"
    ),
    "dlv_delay_distribution": (
        f"SELECT {_DELAY_ORDER} AS delay_range, count(*) AS order_count FROM {_F} GROUP BY 1"
    ),
    # --- geography ---
    "geo_countries": (
        f"SELECT count(DISTINCT c.country) AS total_countries FROM {_CUST} "
        "WHERE c.country IS NOT NULL"
    ),
    "geo_cities": (
        f"SELECT count(DISTINCT c.city) AS total_cities FROM {_CUST} WHERE c.city IS NOT NULL"
    ),
    "geo_avg_delay": _scalar(_delay(), "avg_delay"),
    "geo_on_time_pct": _scalar(_ON_TIME, "on_time_pct"),
    "geo_top5_countries": _scored(
        _CUST,
        f"c.country, {_REVENUE}",
        "c.country",
        f"ORDER BY {_NET} DESC, c.country LIMIT 5",
        "c.country IS NOT NULL",
    ),
    "geo_top10_cities": _scored(
        _CUST,
        f"c.city, c.country, {_REVENUE}",
        "c.city, c.country",
        f"ORDER BY {_NET} DESC, c.city, c.country LIMIT 10",
        "c.city IS NOT NULL",
    ),
    "geo_top10_delay": _scored(
        _CUST,
        f"c.country, {_delay()} AS avg_delay, count(f.order_id) AS orders",
        "c.country",
        "ORDER BY avg_delay DESC, c.country LIMIT 10",
        "c.country IS NOT NULL",
    ),
    "geo_delay_monthly_12m": (
        f"SELECT concat(d.month_name, ' ', d.year) AS month, {_delay()} AS avg_delay "
        f"FROM {_DATED} WHERE {_since('12 MONTH')} GROUP BY d.year, d.month, d.month_name"
    ),
    # --- market baskets ---
    "mb_avg_items": _scalar(mean_int("sum(f.number_of_items)", _N), "avg_items_per_order"),
    "mb_multi_item_pct": _scalar(
        percent("count(CASE WHEN f.number_of_items > 1 THEN 1 END)", _N), "multi_item_orders_pct"
    ),
    "mb_cross_sell_rate": (
        f"SELECT {percent('m.n', 'm.n + s.n')} AS cross_sell_rate_pct FROM "
        "(SELECT count(*) AS n FROM fact_order WHERE number_of_items > 1) m, "
        "(SELECT count(*) AS n FROM fact_order WHERE number_of_items = 1) s"
    ),
    "mb_avg_basket_value": _scalar(_aov(), "avg_basket_value", "f.number_of_items > 1"),
    "mb_type_pairs": (
        "SELECT p1.product_type AS product_a, p2.product_type AS product_b, "
        f"count(*) AS times_bought_together FROM {_PAIRS} WHERE l1.product_key < l2.product_key "
        "AND p1.product_type IS NOT NULL AND p2.product_type IS NOT NULL GROUP BY 1, 2 "
        "HAVING count(*) >= 5 ORDER BY 3 DESC, 1, 2 LIMIT 20"
    ),
    "mb_product_matrix": (
        "SELECT p1.product_name AS product_a, p2.product_name AS product_b, "
        f"count(*) AS co_occurrence FROM {_PAIRS} WHERE l1.product_key < l2.product_key "
        f"AND p1.product_name IN (SELECT product_name FROM ({_TOP_PRODUCTS}) t1) "
        f"AND p2.product_name IN (SELECT product_name FROM ({_TOP_PRODUCTS}) t2) GROUP BY 1, 2 "
        "ORDER BY 3 DESC, 1, 2 LIMIT 15"
    ),
    "mb_basket_sizes": (
        f"SELECT {_BASKET} AS basket_size, count(*) AS order_count FROM {_F} GROUP BY 1"
    ),
    # --- merchants ---
    "mer_total": _scalar("count(DISTINCT f.merchant_key)", "total_merchants"),
    "mer_revenue": _scalar(money(_NET), "total_revenue"),
    "mer_avg_orders": _scalar(
        mean_int("count(f.order_id)", "count(DISTINCT f.merchant_key)"), "avg_orders_per_merchant"
    ),
    "mer_avg_delay": _scalar(_delay(), "avg_delivery_delay"),
    "mer_top5_revenue": _scored(
        _MER,
        f"m.name AS merchant, {_REVENUE}, count(f.order_id) AS orders",
        "m.name",
        f"ORDER BY {_NET} DESC NULLS FIRST, m.name LIMIT 5",
    ),
    "mer_top5_orders": _scored(
        _MER,
        "m.name AS merchant, count(f.order_id) AS orders",
        "m.name",
        "ORDER BY orders DESC, m.name LIMIT 5",
    ),
    "mer_best_on_time": _scored(
        _MER,
        f"m.name AS merchant, {_delay()} AS avg_delay, count(f.order_id) AS orders",
        "m.name",
        "HAVING count(f.order_id) >= 10 ORDER BY avg_delay ASC, m.name LIMIT 5",
    ),
    "mer_worst_delay": _scored(
        _MER,
        f"m.name AS merchant, {_delay()} AS avg_delay, count(f.order_id) AS orders",
        "m.name",
        "HAVING count(f.order_id) >= 10 ORDER BY avg_delay DESC, m.name LIMIT 5",
    ),
    "mer_scorecard": _scored(
        _MER,
        f"m.name AS merchant, count(f.order_id) AS orders, {_REVENUE}, {_aov()} AS aov, "
        f"{_delay()} AS avg_delay, {_ON_TIME} AS on_time_pct",
        "m.name",
        f"HAVING count(f.order_id) >= 5 ORDER BY {_NET} DESC, m.name LIMIT 20",
    ),
    # --- products ---
    "prod_total": "SELECT count(DISTINCT product_key) AS total_products FROM fact_order_line_item",
    "prod_units": (
        "SELECT CAST(sum(quantity) AS BIGINT) AS total_units_sold FROM fact_order_line_item"
    ),
    "prod_revenue": (
        f"SELECT {money('sum(line_total_amount)')} AS total_revenue FROM fact_order_line_item"
    ),
    "prod_avg_unit_price": (
        f"SELECT {mean_money('sum(unit_price)', 'count(*)')} AS avg_unit_price "
        "FROM fact_order_line_item"
    ),
    "prod_top5_revenue": f"SELECT product_name, {money('revenue')} AS revenue FROM ({_TOP_PRODUCTS}) x",
    "prod_revenue_by_type": (
        f"SELECT p.product_type, {money('sum(l.line_total_amount)')} AS revenue FROM {_LINES} "
        "WHERE p.product_type IS NOT NULL GROUP BY p.product_type"
    ),
    "prod_campaign_impact": (
        "SELECT left(p.product_type, 10) AS product_type, "
        + money("sum(CASE WHEN f.availed_flag THEN l.line_total_amount ELSE 0 END)")
        + " AS campaign_revenue, "
        + money("sum(CASE WHEN NOT f.availed_flag THEN l.line_total_amount ELSE 0 END)")
        + f" AS non_campaign_revenue FROM {_LINES} JOIN fact_order f ON l.order_id = f.order_id "
        "WHERE p.product_type IS NOT NULL GROUP BY p.product_type "
        "ORDER BY sum(l.line_total_amount) DESC, p.product_type LIMIT 10"
    ),
    "prod_high_volume_low_revenue": (
        "SELECT left(p.product_name, 25) AS product_name, CAST(sum(l.quantity) AS BIGINT) "
        f"AS volume, {money('sum(l.line_total_amount)')} AS revenue FROM {_LINES} "
        "GROUP BY p.product_name HAVING sum(l.quantity) >= 10 ORDER BY sum(l.quantity) DESC, "
        "sum(l.line_total_amount) ASC, p.product_name LIMIT 5"
    ),
    "prod_types_under_campaigns": (
        "SELECT left(p.product_type, 15) AS product_type, "
        "count(CASE WHEN f.availed_flag THEN 1 END) AS campaign_sales, "
        "count(CASE WHEN NOT f.availed_flag THEN 1 END) AS regular_sales "
        f"FROM {_LINES} JOIN fact_order f ON l.order_id = f.order_id "
        "WHERE p.product_type IS NOT NULL GROUP BY p.product_type"
    ),
    # --- staff ---
    "staff_total": _scalar("count(DISTINCT f.staff_key)", "total_staff"),
    "staff_orders": _scalar("count(f.order_id)", "total_orders_processed"),
    "staff_revenue": _scalar(money(_NET), "revenue_generated"),
    "staff_avg_orders": _scalar(
        mean_int("count(f.order_id)", "count(DISTINCT f.staff_key)"), "avg_orders_per_staff"
    ),
    "staff_top15": _scored(
        _STAFF,
        f"s.name AS staff_name, count(f.order_id) AS orders, {_REVENUE}",
        "s.name",
        "ORDER BY orders DESC, s.name LIMIT 15",
    ),
    "staff_by_job_level": _scored(
        _STAFF,
        f"s.job_level, count(f.order_id) AS orders, {_REVENUE}, {_aov()} AS aov",
        "s.job_level",
        "",
        "s.job_level IS NOT NULL",
    ),
    "staff_by_location": _scored(
        _STAFF,
        "s.city, s.country, count(f.order_id) AS orders",
        "s.city, s.country",
        "ORDER BY orders DESC, s.city, s.country LIMIT 15",
        "s.city IS NOT NULL",
    ),
    "staff_delay_vs_repeat": (
        f"SELECT {_mean_band('Early Delivery')} AS delay_category, "
        f"{mean_int('sum(order_count)', 'count(*)')} AS avg_orders_per_customer, "
        f"count(*) AS number_of_customers FROM ({_CUSTOMER_DELAY}) x GROUP BY 1"
    ),
    # --- time ---
    "time_yoy_growth": (
        f"SELECT {_growth('c.revenue', 'p.revenue')} AS yoy_growth_pct FROM "
        f"(SELECT {_NET} AS revenue FROM {_DATED} WHERE d.year = "
        f"(SELECT max(d.year) FROM {_DATED})) c, (SELECT {_NET} AS revenue FROM {_DATED} "
        f"WHERE d.year = (SELECT max(d.year) FROM {_DATED}) - 1) p"
    ),
    "time_mom_growth": (
        f"SELECT {_growth('c.revenue', 'p.revenue')} AS mom_growth_pct FROM "
        f"(SELECT {_NET} AS revenue FROM {_DATED} CROSS JOIN (SELECT max(d.year) AS y, "
        f"max(d.month) AS m FROM {_DATED}) r WHERE d.year = r.y AND d.month = r.m) c, "
        f"(SELECT {_NET} AS revenue FROM {_DATED} CROSS JOIN (SELECT max(d.year) AS y, "
        f"max(d.month) AS m FROM {_DATED}) r WHERE (d.year = r.y AND d.month = r.m - 1) "
        "OR (d.year = r.y - 1 AND d.month = 12 AND r.m = 1)) p"
    ),
    "time_rev_30d": (
        f"SELECT {money(_NET)} AS current_month_revenue FROM {_DATED} WHERE {_since('30 DAY')}"
    ),
    "time_orders_30d": (
        f"SELECT count(f.order_id) AS current_month_orders FROM {_DATED} "
        f"WHERE {_since('30 DAY')}"
    ),
    "time_revenue_monthly_24m": _monthly("24 MONTH", _REVENUE),
    "time_orders_daily_12m": _daily("count(f.order_id) AS orders"),
    "time_aov_monthly_12m": _monthly("12 MONTH", f"{_aov()} AS average_order_value"),
    "time_seasonality": (
        "SELECT d.month_name, d.month AS month_num, count(f.order_id) AS orders "
        f"FROM {_DATED} GROUP BY d.month, d.month_name"
    ),
    "time_campaign_by_period": (
        f"SELECT strftime(d.full_date, '%Y-%m') AS period, c.campaign_name, {_REVENUE} "
        f"FROM {_CAMP} JOIN dim_date d ON f.transaction_date_key = d.date_key "
        f"WHERE f.availed_flag AND {_since('12 MONTH')} "
        f"AND c.campaign_name IN ({_top_campaigns('f.availed_flag')}) "
        "GROUP BY strftime(d.full_date, '%Y-%m'), c.campaign_name, d.month"
    ),
}
