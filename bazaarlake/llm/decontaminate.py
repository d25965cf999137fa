"""Benchmark decontamination by suffix arrays over training texts."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.llm.common import forget, plain_words, share, split_words, stage

WINDOW = 10
# Test items are searched in blocks of about this many words (or one item), a few in one pass:
# what is broadcast and held by a task has this bound whatever the benchmark's size.
BLOCK_WORDS = 400_000
BLOCKS_AT_ONCE = 3
# Training words whose suffixes are sorted together: one shard of the search.
SHARD_WORDS = 500_000

_HITS = "array<struct<first:int,last:int>>"
_MATCHES = "array<struct<item_id:string,item_word:int,word:int,words:int>>"


@dataclass
class TestBlock:
    """Windows of some test items, as word numbers of a vocabulary of these items alone."""

    vocabulary: dict[bytes, int] = field(default_factory=dict)
    # Distinct windows by their length, each row with the (item, place) pairs it comes from.
    windows: dict[int, np.ndarray] = field(default_factory=dict)
    origins: dict[int, list[list[tuple[int, int]]]] = field(default_factory=dict)
    item_ids: list[str] = field(default_factory=list)
    items: list[np.ndarray] = field(default_factory=list)

    @classmethod
    def of(cls, items: list[Row], window: int) -> TestBlock:
        block = cls()
        seen: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for item in items:
            words = plain_words(item["text"])
            if not words:
                continue
            # Number 0 is any word the items do not have.
            numbers = [block.vocabulary.setdefault(w, len(block.vocabulary) + 1) for w in words]
            block.item_ids.append(item["item_id"])
            block.items.append(np.array(numbers, np.int64))
            length = min(window, len(numbers))
            for place in range(len(numbers) - length + 1):
                key = tuple(numbers[place : place + length])
                seen.setdefault(key, []).append((len(block.items) - 1, place))
        by_length: dict[int, list[tuple[int, ...]]] = {}
        for key in seen:
            by_length.setdefault(len(key), []).append(key)
        for length, keys in by_length.items():
            block.windows[length] = np.array(sorted(keys), np.int64)
            block.origins[length] = [seen[key] for key in sorted(keys)]
        return block


def _sortable(numbers: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings that sort like the rows."""
    width = numbers.shape[1] * 4
    return np.ascontiguousarray(numbers.astype(">u4")).view(f"S{width}").ravel()


def _search(words: np.ndarray, texts: np.ndarray, block: TestBlock, window: int):
    """Yields (text, place, window length, origins) of every window found in one shard.

    The shard's suffix array holds the suffixes at which a window can begin: those followed by
    words of the items only. It is sorted to the depth of a window, which is all a search needs;
    each test window is then searched for by bisection, and its range lists all its places.
    """
    known = words > 0
    for length, windows in block.windows.items():
        if len(words) < length:
            continue
        runs = np.convolve(known, np.ones(length, np.int64), "valid") == length
        starts = np.flatnonzero(runs & (texts[: len(runs)] == texts[length - 1 :]))
        if not len(starts):
            continue
        suffixes = _sortable(words[starts[:, None] + np.arange(length)])
        order = np.argsort(suffixes, kind="stable")
        ordered = suffixes[order]
        tests = _sortable(windows)
        low = np.searchsorted(ordered, tests, "left")
        high = np.searchsorted(ordered, tests, "right")
        for test in np.flatnonzero(high > low):
            for place in starts[order[low[test] : high[test]]]:
                yield int(texts[place]), int(place), length, block.origins[length][test]


def _extend(words: np.ndarray, end: int, place: int, item: np.ndarray, at: int, length: int) -> int:
    """Length of the longest match that begins at these two places."""
    while at + length < len(item) and place + length < end and words[place + length] == item[at + length]:
        length += 1
    return length


def _matcher(shared, window: int):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: TestBlock = pickle.loads(shared.value)
        number = block.vocabulary.get
        for batch in batches:
            texts = batch.column("text")
            first = 0
            while first < len(texts):
                shard: list[np.ndarray] = []
                size, last = 0, first
                while last < len(texts) and (size < SHARD_WORDS or last == first):
                    words = plain_words(texts[last].as_py())
                    shard.append(np.fromiter((number(w, 0) for w in words), np.int64, len(words)))
                    size += len(words)
                    last += 1
                yield _shard_rows(batch.slice(first, last - first), shard, block, window)
                first = last

    return match


def _shard_rows(batch: pa.RecordBatch, shard: list[np.ndarray], block: TestBlock, window: int):
    lengths = np.array([len(w) for w in shard])
    begins = np.concatenate([[0], np.cumsum(lengths)])
    words = np.concatenate(shard) if len(shard) else np.empty(0, np.int64)
    texts = np.repeat(np.arange(len(shard)), lengths)
    hits: list[list] = [[] for _ in shard]
    matches: list[dict] = [{} for _ in shard]
    for text, place, length, origins in _search(words, texts, block, window):
        at = place - int(begins[text])
        hits[text].append((at, at + length))
        for item, item_word in origins:
            matches[text].setdefault((item, at - item_word), []).append((item_word, at, place, length))
    found = []
    for text, per_item in enumerate(matches):
        rows = []
        for (item, _), places in per_item.items():
            # Along one diagonal only the first window of a run begins a longest match.
            reach = -1
            for item_word, at, place, length in sorted(places):
                if at < reach:
                    continue
                longest = _extend(words, int(begins[text + 1]), place, block.items[item], item_word, length)
                reach = at + longest - length + 1
                rows.append({"item_id": block.item_ids[item], "item_word": item_word, "word": at, "words": longest})
        found.append(sorted(rows, key=lambda r: (r["word"], str(r["item_id"]), r["item_word"])))
    merged = [_merge(rows) for rows in hits]
    columns = {name: batch.column(name) for name in batch.schema.names if name != "text"}
    before = columns.pop("_hits").to_pylist(), columns.pop("_matches").to_pylist()
    all_hits = [_merge([(h["first"], h["last"]) for h in old or []] + new) for old, new in zip(before[0], merged)]
    all_matches = [(old or []) + new for old, new in zip(before[1], found)]
    arrays = [
        *columns.values(),
        batch.column("text"),
        pa.array([[{"first": a, "last": b} for a, b in h] for h in all_hits], _arrow_hits()),
        pa.array(all_matches, _arrow_matches()),
    ]
    return pa.RecordBatch.from_arrays(arrays, [*columns, "text", "_hits", "_matches"])


def _arrow_hits() -> pa.DataType:
    return pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


def _arrow_matches() -> pa.DataType:
    return pa.list_(
        pa.struct([("item_id", pa.string()), ("item_word", pa.int32()), ("word", pa.int32()), ("words", pa.int32())])
    )


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    joined: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if joined and first <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(last, joined[-1][1]))
        else:
            joined.append((first, last))
    return joined


def _n_words(text: Column) -> Column:
    """Words as ``plain_words`` finds them, which do not depend on the case of A-Z."""
    return F.size(split_words(text, r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F")).cast("long")


def _blocks(benchmark: DataFrame, window: int, words: int) -> Iterator[TestBlock]:
    """Test items in blocks of about ``words`` words (or one item), one after the other.

    Spark deals the items to as many blocks as their words fill, by a hash, and writes them to the
    shared folder; one block at a time is then read by the driver and indexed.
    """
    spark = benchmark.sparkSession
    item_id = F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id")
    items = benchmark.select(item_id, F.col("text").cast("string").alias("text")).filter("text is not null")
    total = items.agg(F.sum(_n_words(F.col("text")))).first()[0] or 0
    count = max(1, -(-total // words))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(count)).cast("int").alias("block")
    dealt = stage(items.select("*", block), "items", "block")
    for number in range(count):
        found = dealt.filter(F.col("block") == number).select("item_id", "text").collect()
        if found:
            yield TestBlock.of(sorted(found), window)
    forget(dealt)


def _searched(rows: DataFrame, blocks: Iterator[TestBlock], window: int) -> DataFrame:
    """Rows with the ``_hits`` and ``_matches`` of some blocks, in one pass over the texts."""
    for block in blocks:
        shared = share(rows.sparkSession, block)
        rows = rows.mapInArrow(_matcher(shared, window), T.StructType(rows.schema.fields))
    return rows


def _empty(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_hits", F.lit(None).cast(_HITS)).withColumn("_matches", F.lit(None).cast(_MATCHES))


def _merged(hits: Column) -> Column:
    """Overlapping and touching spans of a list joined."""

    def join(found: Column, hit: Column) -> Column:
        last = F.element_at(found, -1)
        wider = F.struct(last["first"].alias("first"), F.greatest(last["last"], hit["last"]).alias("last"))
        return (
            F.when(F.size(found) == 0, F.array(hit))
            .when(hit["first"] <= last["last"], F.concat(F.slice(found, 1, F.size(found) - 1), F.array(wider)))
            .otherwise(F.concat(found, F.array(hit)))
        )

    return F.aggregate(F.array_sort(hits), F.array().cast(_HITS), join)


def _in_passes(rows: DataFrame, blocks: Iterator[TestBlock], window: int) -> DataFrame:
    """Searches a few blocks at a time: what a pass finds is written, and put together per text.

    A pass holds ``BLOCKS_AT_ONCE`` blocks, however many there are.
    """
    texts = _empty(rows.select(F.md5("text").alias("_text"), "text"))
    parts = []
    while some := list(islice(blocks, BLOCKS_AT_ONCE)):
        found = _searched(texts, iter(some), window).filter(F.size("_hits") > 0)
        parts.append(stage(found.select("_text", "_hits", "_matches").dropDuplicates(["_text"]), "found"))
    together = (
        reduce(DataFrame.unionByName, parts)
        .groupBy("_text")
        .agg(
            _merged(F.flatten(F.collect_list("_hits"))).alias("_hits"),
            F.flatten(F.collect_list("_matches")).alias("_matches"),
        )
        .withColumn("_matches", F.array_sort("_matches", _by_place))
    )
    return rows.withColumn("_text", F.md5("text")).join(together, "_text", "left").drop("_text")


def _by_place(a: Column, b: Column) -> Column:
    def key(m: Column) -> Column:
        return F.struct(m["word"], m["item_id"], m["item_word"])

    return F.when(key(a) < key(b), -1).when(key(a) > key(b), 1).otherwise(0)


def find_matches(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int | None = None
) -> DataFrame:
    """Every row of ``docs`` with ``n_words``, ``n_hit``, ``items``, ``matches``, ``contaminated``.

    Test items are a stated query set, searched for in all training texts block by block
    (of ``block_words`` words, ``BLOCK_WORDS`` when not given). A task sorts its texts into suffix arrays, shard by shard, and
    finds each window of ten item words (a shorter item is one window) by bisection; matches are
    then lengthened to the longest verbatim ones and listed with their places. ``n_hit`` counts
    words inside any window found, ``items`` are the ids of items found, as sorted text.

    Up to ``BLOCKS_AT_ONCE`` blocks are searched in one pass over the texts, without a shuffle.
    A larger benchmark takes a pass for every few blocks; each writes what it finds, and the parts
    are put together by text, so memory and workers of a task do not grow with the benchmark.

    Null and empty texts have no words; items without words are never found; an item with a null
    id counts under its text "null". Repeated items and rows are searched one by one. Without any
    item nothing is hit. Other columns stay, those named like added ones are replaced.
    """
    added = ["n_words", "n_hit", "items", "matches", "contaminated"]
    kept = docs.drop(*added)
    rows = kept.withColumn("text", F.col("text").cast("string"))
    blocks = _blocks(benchmark, window, block_words or BLOCK_WORDS)
    first = list(islice(blocks, BLOCKS_AT_ONCE + 1))
    if len(first) <= BLOCKS_AT_ONCE:
        others = [c for c in rows.columns if c != "text"]
        rows = _searched(_empty(rows.select(*others, "text")), iter(first), window)
    else:
        rows = _in_passes(rows, chain(first, blocks), window)
    hit_words = F.aggregate("_hits", F.lit(0), lambda n, h: n + h["last"] - h["first"])
    return (
        rows.withColumn("n_words", _n_words(F.col("text")))
        .withColumn("n_hit", F.coalesce(hit_words, F.lit(0)).cast("long"))
        .withColumn("matches", F.coalesce("_matches", F.array().cast(_MATCHES)))
        .withColumn("items", F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"]))))
        .withColumn("contaminated", F.col("n_hit") > 0)
        .select(*kept.columns, *added)
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that hold no window of any test item."""
    return find_matches(docs, benchmark, window).filter("not contaminated").select(*docs.columns)
