"""Every registered query against its SQL on the smallest driver tables."""

import os
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest

import __spark_entry__ as registered
import compare
from bazaarlake.plans import registry, star
from oracle import all_sql

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not there")


def test_every_query_has_sql():
    assert set(registry.queries()) == set(all_sql.oracle_sql())


def test_results_match(spark):
    queries, sql = registry.queries(), all_sql.oracle_sql()
    star.driver_star(spark, SF)
    star.second_star(spark, SF)
    queries["ingest_stg_campaign"](spark, SF)
    local = threading.local()

    def check(name):
        if not hasattr(local, "duck"):
            local.duck = compare.duck(SF)
        try:
            return name, compare.difference(queries[name](spark, SF), local.duck, sql[name])
        except Exception as error:
            return name, str(error)[:500]

    with ThreadPoolExecutor(4) as pool:
        problems = {name: found for name, found in pool.map(check, queries) if found}
    assert problems == {}


def test_entry(spark):
    assert registered.entry(spark).count() > 0
