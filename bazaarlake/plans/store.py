"""Warehouse tables as parquet folders named by a versioned list.

A load writes new folders and never touches those in use. When all tables are written, one small
file ``tables.<n>`` names the folders of every table; readers take the highest n. A failed load
leaves the previous list in force and can be run again.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from bazaarlake.plans import filters, sums
from bazaarlake.sources import paths
from bazaarlake.sources.published import Published
from bazaarlake.sources.schemas import STAGING, WAREHOUSE, no_rows

# Past this many folders a load also joins the smaller half of them.
MOST_FOLDERS = 256

# Bytes from which a fact folder gets a filter.
FILTER_FROM = 64 << 20

# Facts are cut by the year of the order; a trailing window then reads one or two folders.
YEARLY = {"fact_order"}

# Open versions of a dimension are cut into buckets of so many rows, up to so many buckets.
BUCKET_ROWS = 1_000_000
MOST_BUCKETS = 256
_BUCKET = re.compile(r"/bucket=(\d+)of(\d+)$")



def _bucket(bk: str, count: int) -> Column:
    return F.pmod(F.xxhash64(bk), F.lit(count)).cast("int")


def _folder_name(folder: str) -> str:
    """The part of a folder that tells it from the others of its table."""
    return folder[folder.index("load=") :].rstrip("/")


class Warehouse:
    """Tables under ``root``. Fact folders of at least ``filter_from`` bytes get a filter of their
    orders; smaller ones are read faster than it. Open versions of a dimension lie in buckets of
    about ``bucket_rows``."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        filter_from: int = FILTER_FROM,
        bucket_rows: int = BUCKET_ROWS,
    ):
        self.spark = spark
        self.filter_from = filter_from
        self.bucket_rows = bucket_rows
        self.root = root.rstrip("/")
        self.lists = Published(spark, self.root)

    # --- reading ---

    def versions(self) -> list[str]:
        """The published lists, oldest first."""
        return self.lists.versions()

    def folders(self, version: int | None = None) -> dict[str, list[str]]:
        """Folders of every table, by default of the latest version (the first is 1)."""
        return self.lists.read(version)

    def read(self, table: str, version: int | None = None) -> DataFrame:
        return self.read_folders(table, self.folders(version).get(table, []))

    def read_folders(
        self, table: str, folders: Sequence[str], with_file: bool = False
    ) -> DataFrame:
        """The table with its fixed schema; ``order_year`` comes along for yearly tables.

        ``with_file`` leaves the scan as it is, so the file of each row can be asked for.
        """
        schema = WAREHOUSE.get(table) or STAGING[table]
        if table in YEARLY:
            schema = StructType([*schema.fields, StructField("order_year", IntegerType())])
        if not folders:
            return no_rows(self.spark, schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}")
        rows = reader.parquet(*folders)
        return rows if with_file else rows.select(*schema.names)

    # --- writing ---

    def write(self, table: str, rows: DataFrame) -> list[str]:
        """Writes rows into new folders and returns them; nothing is visible to readers yet."""
        base = f"{self.root}/{table}"
        folder = f"{base}/load={uuid.uuid4().hex}"
        if table not in YEARLY:
            rows.write.parquet(folder)
            return [folder]
        # Rebalancing splits a year that is too big for one file and joins small ones.
        (
            rows.withColumn("order_year", F.floor(F.col("transaction_date_key") / 10000).cast("int"))
            .hint("rebalance", "order_year")
            .sortWithinPartitions("order_year", "transaction_date_key")
            .write.partitionBy("order_year")
            .parquet(folder)
        )
        return paths.folders_in(self.spark, folder)

    def rewrite_buckets(
        self,
        table: str,
        old: Sequence[str],
        bk: str,
        inserted: DataFrame,
        applied: Callable[[DataFrame], DataFrame],
    ) -> list[str]:
        """Folders of a dimension with versions after a load; only buckets with a change are new.

        Open versions lie in buckets of their business key, closed ones in folders of their own
        that stay as they are. ``inserted`` are the new versions; a changed member has one, so
        their buckets are those to be rewritten, and ``applied`` closes what ends in them. When
        the table has outgrown its buckets four times, a load rewrites all of them into more.
        """
        live = {int(m[1]): folder for folder in old if (m := _BUCKET.search(folder))}
        closed = [folder for folder in old if not _BUCKET.search(folder)]
        count = next((int(_BUCKET.search(folder)[2]) for folder in old if _BUCKET.search(folder)), 1)
        inserted = self.stage(inserted, f"{table}_inserted")
        size = self.read_folders(table, list(live.values())).count() + inserted.count()
        wanted = 1
        while wanted < MOST_BUCKETS and wanted * self.bucket_rows < size:
            wanted *= 2
        if wanted >= 4 * count or not live:
            count, hit = wanted, set(live)
        else:
            hit = {row[0] for row in inserted.select(_bucket(bk, count)).distinct().collect()}
        if not hit and not inserted.take(1):
            return list(old)
        schema = WAREHOUSE[table]
        rewritten = [folder for bucket, folder in live.items() if bucket in hit]
        rows = applied(self.read_folders(table, rewritten)).unionByName(inserted.select(*schema.names))
        name = F.concat(_bucket(bk, count).cast("string"), F.lit(f"of{count}"))
        folder = f"{self.root}/{table}/load={uuid.uuid4().hex}"
        (
            rows.withColumn("bucket", F.when(F.col("is_current"), name).otherwise("closed"))
            .hint("rebalance", "bucket")
            .write.partitionBy("bucket")
            .parquet(folder)
        )
        kept = [folder for folder in live.values() if folder not in rewritten]
        return closed + kept + paths.folders_in(self.spark, folder)

    def stage(self, rows: DataFrame, name: str) -> DataFrame:
        """Rows written to the shared folder and read back: lineage ends there."""
        folder = f"{self.root}/staged/{name}-{uuid.uuid4().hex}"
        rows.write.parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)

    def publish(self, folders: dict[str, list[str]]) -> int:
        """Makes these folders the newest version and returns its number.

        Fails when another writer has published that number meanwhile.
        """
        return self.lists.publish(folders)

    def touched(
        self, table: str, folders: Sequence[str], order_ids: DataFrame, known: Mapping[str, dict] | None = None
    ) -> list[str]:
        """Folders a reload rewrites: those that hold any of the given orders.

        Folders with a filter are opened only if it lets an order through. One scan of the order
        id column of the others for a first part of the orders, and a second one of folders that
        hold none of these; at most one row per folder reaches the driver. When the list has
        grown long, the smaller half of the folders is taken along, so large old ones are left
        alone. ``known`` are the filters of the folders, by default those of the published list.
        """
        if not folders:
            return []
        opened = self.may_hold(table, folders, order_ids, known)
        first = filters.in_first_part()
        taken = self._holders(table, opened, order_ids.filter(first), first)
        rest = [folder for folder in opened if _folder_name(folder) not in taken]
        taken |= self._holders(table, rest, order_ids, F.lit(True))
        if len(folders) > MOST_FOLDERS:
            by_size = sorted(folders, key=lambda folder: paths.size_of(self.spark, folder))
            taken.update(_folder_name(folder) for folder in by_size[: len(folders) // 2])
        return [folder for folder in folders if _folder_name(folder) in taken]

    def _holders(self, table: str, folders: Sequence[str], order_ids: DataFrame, looked_at: Column) -> set[str]:
        """Names of the folders with an order of the given ones among the rows looked at."""
        if not folders:
            return set()
        hit = (
            self._named(table, folders)
            .filter(looked_at)
            .select("order_id", "_folder")
            .join(order_ids.select("order_id").distinct(), "order_id", "left_semi")
            .select("_folder")
            .distinct()
            .collect()
        )
        return {row[0] for row in hit}

    # --- sums ---

    def sums_of(self, folders: Sequence[str], known: Mapping[str, str] | None = None) -> dict[str, str]:
        """By name of an order folder: the load its sums are kept with. New folders get theirs here."""
        known = self.lists.read().get("sums", {}) if known is None else known
        names = {_folder_name(folder) for folder in folders}
        known = {name: load for name, load in known.items() if name in names}
        fresh = [folder for folder in folders if _folder_name(folder) not in known]
        if not fresh:
            return known
        load = sums.build(self._named("fact_order", fresh), f"{self.root}/sums")
        return {**known, **{_folder_name(folder): load for folder in fresh}}

    def order_sums(self, version: int | None = None) -> sums.OrderSums:
        """Sums of the orders of a version; folders of lists without sums are added up now."""
        entries = self.lists.read(version)
        return self.sums_in(entries.get("fact_order", []), entries.get("sums", {}))

    def sums_in(self, folders: Sequence[str], known: Mapping[str, str]) -> sums.OrderSums:
        """Sums of the orders of some folders; ``known`` names the loads they are kept with."""
        loads = {_folder_name(f): known[_folder_name(f)] for f in folders if _folder_name(f) in known}
        rest = [f for f in folders if _folder_name(f) not in known]
        fresh = self._named("fact_order", rest) if rest or not loads else None
        return sums.OrderSums(self.spark, f"{self.root}/sums", loads, fresh)

    def _named(self, table: str, folders: Sequence[str]) -> DataFrame:
        """Rows of some folders with the name of each row's folder."""
        if not folders:
            return self.read_folders(table, folders).withColumn("_folder", F.lit(""))
        # load=.../file, or load=.../order_year=.../file: taken from the end, for every row of facts.
        parts = 2 if table in YEARLY else 1
        name = F.substring_index(F.substring_index("_metadata.file_path", "/", -parts - 1), "/", parts)
        return self.read_folders(table, folders, with_file=True).withColumn("_folder", name)

    # --- filters ---

    def filters(self, version: int | None = None) -> dict[str, dict]:
        """Per table and folder name: what the published list knows of the folder's order ids."""
        return self.lists.read(version).get("filters", {})

    def may_hold(
        self, table: str, folders: Sequence[str], order_ids: DataFrame, known: Mapping[str, dict] | None = None
    ) -> list[str]:
        """Folders without a filter, and those whose filter lets one of the orders through."""
        known = self.filters().get(table, {}) if known is None else known
        facts = filters.names_of(folders, known, _folder_name)
        if not facts:
            return list(folders)
        hit = filters.may_hold(self.spark, facts, order_ids)
        return [f for f in folders if _folder_name(f) not in facts or _folder_name(f) in hit]

    def filters_of(
        self, table: str, folders: Sequence[str], known: Mapping[str, dict] | None = None
    ) -> dict[str, dict]:
        """Filters of these folders: known ones, and new ones for large folders without."""
        known = self.filters().get(table, {}) if known is None else known
        known = filters.names_of(folders, known, _folder_name)
        fresh = [
            folder
            for folder in folders
            if _folder_name(folder) not in known and paths.size_of(self.spark, folder) >= self.filter_from
        ]
        if not fresh:
            return known
        ids = self._named(table, fresh).select("_folder", "order_id")
        return {**known, **filters.build(self.spark, ids, f"{self.root}/filters/{table}")}
