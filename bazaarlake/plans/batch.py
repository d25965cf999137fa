"""One load of the warehouse: clean, dimensions, line items, orders."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial
from threading import RLock

from pyspark.sql import DataFrame

from bazaarlake.lazy import LazyTables
from bazaarlake.operators import calendar, cleaning, facts, identity, scd
from bazaarlake.plans.store import Warehouse


def clean_sources(staging: Mapping[str, DataFrame]) -> LazyTables:
    """Identity tables and every cleaned table."""

    def with_keys(clean: Callable[..., DataFrame], source: str, *lookups: str) -> DataFrame:
        return clean(staging[source], *[tables[lookup] for lookup in lookups])

    def over(source: str, clean: Callable[..., DataFrame], *lookups: str):
        return partial(with_keys, clean, source, *lookups)

    def customers() -> DataFrame:
        return cleaning.customer_source(
            staging["stg_user_data"],
            staging["stg_user_job"],
            staging["stg_user_credit_card"],
            tables["user_identity"],
        )

    def metrics() -> DataFrame:
        return facts.order_metrics(tables["price_lines"])

    tables = LazyTables(
        {
            "user_identity": over("stg_user_data", identity.user_identity),
            "merchant_identity": over("stg_merchant_data", identity.merchant_identity),
            "staff_identity": over("stg_staff", identity.staff_identity),
            "product_identity": over("stg_product_list", identity.product_identity),
            "orders": over("stg_orders", cleaning.clean_orders),
            "order_delays": over("stg_order_delays", cleaning.clean_order_delays),
            "line_prices": over("stg_line_items_prices", cleaning.clean_line_prices),
            "line_products": over("stg_line_items_products", cleaning.clean_line_products),
            # Not numbered: numbers are given when products and prices are matched.
            "product_lines": over("stg_line_items_products", cleaning.line_products),
            "price_lines": over("stg_line_items_prices", cleaning.line_prices),
            "order_merchant": over(
                "stg_order_merchant",
                cleaning.clean_order_merchant,
                "merchant_identity",
                "staff_identity",
            ),
            "campaigns": over("stg_campaign", cleaning.clean_campaigns),
            "campaign_transactions": over(
                "stg_campaign_transactions", cleaning.clean_campaign_transactions
            ),
            "products": over("stg_product_list", cleaning.clean_products),
            "merchants": over(
                "stg_merchant_data", cleaning.clean_merchants, "merchant_identity"
            ),
            "staff": over("stg_staff", cleaning.clean_staff, "staff_identity"),
            "user_data": over("stg_user_data", cleaning.clean_user_data, "user_identity"),
            "user_job": over("stg_user_job", cleaning.clean_user_job, "user_identity"),
            "user_credit_card": over(
                "stg_user_credit_card", cleaning.clean_user_credit_card, "user_identity"
            ),
            "customer_source": customers,
            "order_metrics": metrics,
        }
    )
    return tables


def load_dimension(
    warehouse: Warehouse,
    table: str,
    old: list[str],
    staging: Mapping[str, DataFrame],
    clean: Mapping[str, DataFrame],
    now: str,
) -> list[str]:
    """Folders of one dimension after the load.

    Of a dimension with versions only the buckets with a change are written anew; closed versions
    go to folders that no load opens for writing again.
    """
    current = warehouse.read_folders(table, old)
    if table in scd.TYPE2:
        kind = scd.TYPE2[table]
        source = kind.one_per_key(clean[kind.source])
        changes = warehouse.stage(
            scd.scd2_changes(current, source, kind.key, kind.bk, kind.tracked), f"{table}_changes"
        )
        return warehouse.rewrite_buckets(
            table,
            old,
            kind.bk,
            scd.scd2_inserts(kind, current, changes, now),
            lambda rows: scd.scd2_apply(kind, rows, changes, now),
        )
    if table == "dim_campaign":
        return warehouse.write(table, scd.load_dim_campaign(current, clean["campaigns"]))
    return warehouse.write(table, calendar.load_dim_date(current, staging))


def incoming_lines(clean: Mapping[str, DataFrame], dim_product: DataFrame) -> DataFrame:
    # The fact has no product name: it is not shuffled with the lines.
    products = clean["product_lines"].drop("product_name")
    matched = facts.match_lines(products, clean["price_lines"])
    return facts.lines_with_product(matched, dim_product)


def incoming_orders(
    clean: Mapping[str, DataFrame], dimensions: Mapping[str, DataFrame], most: int | None = None
) -> DataFrame:
    """Orders of a delivery as fact rows; ``most``: versions a member can have, where known."""
    return facts.build_fact_order(
        clean["orders"],
        clean["order_merchant"],
        facts.campaign_per_order(clean["campaign_transactions"]),
        clean["order_delays"],
        clean["order_metrics"],
        dimensions["dim_customer"],
        dimensions["dim_merchant"],
        dimensions["dim_staff"],
        dimensions["dim_campaign"],
        most,
    )


DIMENSIONS = [
    "dim_campaign",
    "dim_customer",
    "dim_date",
    "dim_merchant",
    "dim_product",
    "dim_staff",
]
FACTS = ["fact_order_line_item", "fact_order"]
# Dimensions a fact is resolved against.
RESOLVED_BY = {
    "fact_order_line_item": ["dim_product"],
    "fact_order": ["dim_campaign", "dim_customer", "dim_merchant", "dim_staff"],
}
_AT_ONCE = 4


class Stored:
    """The newest published version: what a load goes on from."""

    def __init__(self, warehouse: Warehouse):
        self._entries = warehouse.lists.read()
        self.loads = len(warehouse.versions())

    def folders(self, table: str) -> list[str]:
        return self._entries.get(table, [])

    def filters(self, table: str) -> dict[str, dict]:
        return self._entries.get("filters", {}).get(table, {})

    def sums(self) -> dict[str, str]:
        return self._entries.get("sums", {})


class Load:
    """One delivery on its way into the warehouse.

    Each table is written once, when it is first asked for, after the tables it needs; ``publish``
    writes all of them and makes them visible together. ``before`` is what the load goes on from:
    a published version, or a load of which only some tables may be written yet.
    ``now`` is the load time as "yyyy-MM-dd HH:mm:ss".
    """

    def __init__(
        self,
        warehouse: Warehouse,
        staging: Mapping[str, DataFrame],
        now: str,
        before: Stored | Load | None = None,
    ):
        self.warehouse = warehouse
        self.before = Stored(warehouse) if before is None else before
        self.loads = self.before.loads + 1
        self._staging = staging
        self._clean = clean_sources(staging)
        self._now = now
        self._written: dict[str, object] = {}
        self._locks: dict[str, RLock] = defaultdict(RLock)
        self._guard = RLock()

    def _once(self, name: str, make: Callable[[], object]):
        with self._guard:
            lock = self._locks[name]
        with lock:
            if name not in self._written:
                self._written[name] = make()
            return self._written[name]

    def folders(self, table: str) -> list[str]:
        """Folders of a table after this load."""
        return self._once(table, lambda: self._write(table))

    def tables(self, names: Sequence[str]) -> dict[str, DataFrame]:
        """Tables after this load; those that do not need each other are written at the same time."""
        with ThreadPoolExecutor(_AT_ONCE) as pool:
            folders = list(pool.map(self.folders, names))
        return {t: self.warehouse.read_folders(t, f) for t, f in zip(names, folders)}

    def filters(self, table: str) -> dict[str, dict]:
        """Filters of the folders of a fact."""
        return self._once(
            f"filters of {table}",
            lambda: self.warehouse.filters_of(table, self.folders(table), self.before.filters(table)),
        )

    def sums(self) -> dict[str, str]:
        """By name of an order folder: the load its sums are kept with."""
        folders = self.folders("fact_order")
        return self._once("sums", lambda: self.warehouse.sums_of(folders, self.before.sums()))

    def publish(self) -> int:
        """Writes what is not written yet, publishes all tables together and returns the version."""
        return self._once("version", self._publish)

    def _publish(self) -> int:
        if isinstance(self.before, Load):
            self.before.publish()
        self.tables(DIMENSIONS)
        self.tables(FACTS)
        folders = {table: self.folders(table) for table in DIMENSIONS + FACTS}
        known = {table: self.filters(table) for table in FACTS}
        return self.warehouse.publish({**folders, "filters": known, "sums": self.sums()})

    def _write(self, table: str) -> list[str]:
        if table not in FACTS:
            old = self.before.folders(table)
            return load_dimension(self.warehouse, table, old, self._staging, self._clean, self._now)
        dimensions = self.tables(RESOLVED_BY[table])
        write = _load_lines if table == "fact_order_line_item" else _load_orders
        return write(self.warehouse, self.before, self._clean, dimensions)


def run_batch(warehouse: Warehouse, staging: Mapping[str, DataFrame], now: str) -> int:
    """Loads one delivery, publishes all tables together and returns the version.

    ``now`` is the load time as "yyyy-MM-dd HH:mm:ss"; running the same delivery again changes
    nothing but the folders.
    """
    return Load(warehouse, staging, now).publish()


def _load_lines(
    warehouse: Warehouse,
    before: Stored | Load,
    clean: Mapping[str, DataFrame],
    dimensions: Mapping[str, DataFrame],
) -> list[str]:
    """Folders of the line items; only those with an order of this delivery are rewritten."""
    table = "fact_order_line_item"
    old = before.folders(table)
    reloaded = clean["product_lines"].select("order_id")
    if old:
        # Filters, folders and old lines are met by the orders: told apart once.
        reloaded = warehouse.stage(reloaded.distinct(), "reloaded_orders")
    touched = warehouse.touched(table, old, reloaded, before.filters(table))
    lines = facts.replace_lines(
        warehouse.read_folders(table, touched),
        reloaded,
        incoming_lines(clean, dimensions["dim_product"]),
        key_start=facts.highest_key(warehouse.read_folders(table, old), "line_item_key"),
        # Keys need the sizes of all key buckets and then the rows again: matched once, read twice.
        stage=lambda rows: warehouse.stage(rows, "incoming_lines"),
    )
    return [f for f in old if f not in touched] + warehouse.write(table, lines)


def _load_orders(
    warehouse: Warehouse,
    before: Stored | Load,
    clean: Mapping[str, DataFrame],
    dimensions: Mapping[str, DataFrame],
) -> list[str]:
    """Folders of the orders; only those with an order of this delivery are rewritten."""
    table = "fact_order"
    old = before.folders(table)
    # Every load adds one version of a member at most.
    incoming = incoming_orders(clean, dimensions, before.loads + 1)
    if old:
        incoming = warehouse.stage(incoming, "incoming_orders")
    touched = warehouse.touched(table, old, incoming, before.filters(table))
    orders = facts.upsert_fact_order(warehouse.read_folders(table, touched), incoming)
    return [f for f in old if f not in touched] + warehouse.write(table, orders)
