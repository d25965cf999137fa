"""Sets of folders that become visible together: one small list file names the folders of all tables.

Writers put rows into new folders and never touch those in use; publishing a list is a rename, so
readers see the tables of one list or of the next, never a mix. A failed load leaves the previous
list in force.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from bazaarlake.sources import paths


class Published:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def versions(self) -> list[str]:
        """The published lists, oldest first."""
        names = [f for f in paths.files_in(self.spark, self.root) if "/tables." in f]
        names = [f for f in names if not f.endswith(".next")]
        return sorted(names, key=lambda f: int(f.rsplit(".", 1)[1]))

    def read(self, version: int | None = None) -> dict:
        """What a list holds, by default the latest (the first is 1); nothing before the first."""
        lists = self.versions()
        if not lists:
            return {}
        wanted = lists[-1] if version is None else f"{self.root}/tables.{version}"
        return json.loads(paths.read_text(self.spark, wanted))

    def publish(self, entries: dict) -> int:
        """Makes these entries the newest list and returns its number.

        Fails when another writer has published that number meanwhile.
        """
        lists = self.versions()
        number = int(lists[-1].rsplit(".", 1)[1]) + 1 if lists else 1
        paths.write_text(self.spark, f"{self.root}/tables.{number}", json.dumps(entries))
        return number
