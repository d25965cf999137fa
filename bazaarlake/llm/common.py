"""Helpers the document operators share: words, hashes, staged tables, bound expressions."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from typing import Any

import numpy as np
import xxhash
from pyspark import cloudpickle
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.session import shared_dir

# Functions of this subpackage travel with the job, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules["bazaarlake.llm"])

# ASCII white space, as a character class body for Java expressions.
SPACE = r"\x20\x09-\x0D"
# Not a letter a-z, a digit or a character beyond ASCII.
NOT_WORD = r"\x00-\x2F\x3A-\x60\x7B-\x7F"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PLAIN = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


# --- JVM side -------------------------------------------------------------------------------


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def split_words(text: Column, gap: str) -> Column:
    """Maximal runs of characters outside the class ``gap``; null and wordless texts give []."""
    pieces = F.split(F.coalesce(text, F.lit("")), f"[{gap}]+")
    return F.filter(pieces, lambda w: w != "")


def no_columns_missing(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns in their types; columns that are absent come as null, others go."""
    return df.select(
        [
            (F.col(f"`{name}`") if name in df.columns else F.lit(None)).cast(kind).alias(name)
            for name, kind in columns.items()
        ]
    )


def stage(df: DataFrame, name: str, *cut_by: str) -> DataFrame:
    """Rows written to the folder all executors share and read back: lineage ends there.

    ``cut_by`` gives each value of these columns a folder of its own, which a filter then finds.
    """
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*cut_by).option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def stage_buckets(df: DataFrame, key: str) -> DataFrame:
    """As ``stage``, in buckets of ``key``: joins on it leave these rows where they are."""
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    folder = f"{shared_dir(spark)}/llm/{spark.sparkContext.applicationId}/{name}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).option("path", folder).option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def forget(*staged: DataFrame) -> None:
    """Deletes the folders of staged tables nothing reads any more."""
    for df in staged:
        spark: SparkSession = df.sparkSession
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for file in df.inputFiles()[:1]:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file).getParent()
            while "=" in folder.getName():
                folder = folder.getParent()
            folder.getFileSystem(conf).delete(folder, True)


def share(spark: SparkSession, value: Any) -> Broadcast[bytes]:
    """A value of this subpackage's own types for all tasks; they get it by ``pickle.loads``.

    Broadcasts name classes by their module, which workers need not have; here classes go along.
    """
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


# --- task side ------------------------------------------------------------------------------


def space_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, as UTF-8."""
    return text.encode("utf-8", "replace").split() if text else []


def plain_words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words of letters, digits and characters beyond ASCII."""
    return text.encode("utf-8", "replace").lower().translate(_PLAIN).split() if text else []


class WordHashes(dict):
    """64-bit hash of a word, remembered per task up to a bound."""

    MOST = 500_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_FINAL = np.uint64(0xC2B2AE3D27D4EB4F)


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` words, from the words' hashes."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(length):
        total *= _FACTOR
        total += hashes[j : j + n]
        total ^= total >> np.uint64(31)
    total *= _FINAL
    total ^= total >> np.uint64(32)
    return total
