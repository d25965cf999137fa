"""Records of CSV and JSON files that go on across the places where a file is cut.

A file is read in pieces by many tasks: lines for CSV, the texts between closing braces for a JSON
array. Whether a piece begins inside a quoted field, a string or an object depends on all pieces
before it. Each piece is therefore read as a map from the state it is entered in to the state it
leaves; maps are composed along each block of the file, then along the blocks, which gives every
piece its state without reading the file in order.

Files in which no piece leaves a record open need none of this and are found by one scan. In the
others only places and states are shuffled; the text of a piece moves if it shares its record.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarlake.session import shared_dir

# Separators at which files are cut. A closing brace never follows a backslash in a JSON string.
JSON_CUT = "}"

# Where in a CSV record a line is: at the start of a field, inside a plain field, inside a quoted
# field, or behind a quote that may end it.
_FIELD, _PLAIN, _QUOTED, _BEHIND = 0, 1, 2, 3


def row_position() -> Column:
    """Position of a row in its file, taken at the scan and growing with the file.

    Byte offset of the block plus the row count of the task so far. A task has no more rows than
    bytes, so positions of one block stay below the start of the next.
    """
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return F.col("_metadata.file_block_start") + in_task


def pieces(spark: SparkSession, files: Sequence[str], cut: str) -> DataFrame:
    """``file``, ``name``, ``block``, ``place`` and ``value`` of every text between two cuts."""
    return (
        spark.read.option("lineSep", cut)
        .text(list(files))
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_name").alias("name"),
            F.col("_metadata.file_block_start").alias("block"),
            row_position().alias("place"),
            "value",
        )
        .withColumn("value", F.when(F.col("block") == 0, F.ltrim(F.col("value"), F.lit("\ufeff"))).otherwise(F.col("value")))
    )


# --- maps of pieces -------------------------------------------------------------------------


def csv_left_open(line: Column, separator: str, entered: int) -> Column:
    """Whether a line leaves a quoted field open, entered at a field's start or inside a quoted one.

    A quote opens a field only as its first character; two quotes inside a quoted field stand for
    one; whatever follows a closing quote up to the separator belongs to a plain field.
    """

    def after(state: Column, text: Column) -> Column:
        return (
            F.when((state == _QUOTED) | (text == ""), state)
            .when(F.endswith(text, F.lit(separator)), F.lit(_FIELD))
            .otherwise(F.lit(_PLAIN))
        )

    def step(state: Column, text: Column) -> Column:
        quote = (
            F.when(state == _QUOTED, F.lit(_BEHIND))
            .when(state == _PLAIN, F.lit(_PLAIN))
            .otherwise(F.lit(_QUOTED))
        )
        return after(quote, text)

    parts = F.split(line, '"')
    first = after(F.lit(entered), F.get(parts, F.lit(0)))
    last = F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), first, step)
    unquoted = F.lit(entered == _QUOTED)
    return F.when(F.instr(line, '"') == 0, unquoted).otherwise(last == _QUOTED)


def json_outside(piece: Column) -> tuple[Column, Column, Column]:
    """Whether a piece has an odd number of quotes, and the change of depth, its closing brace
    included, for a piece entered outside and inside a string."""
    plain = F.when(F.instr(piece, "\\") == 0, piece).otherwise(F.regexp_replace(piece, r"(?s)\\.", ""))
    quotes = F.length(plain) - F.length(F.translate(plain, '"', ""))
    odd = quotes % 2 == 1

    def change(text: Column) -> Column:
        opened = F.length(text) - F.length(F.translate(text, "{[", ""))
        return opened - (F.length(text) - F.length(F.translate(text, "}]", "")))

    def depth(rest: int) -> Column:
        parts = F.filter(F.split(plain, '"'), lambda _, i: F.pmod(i, F.lit(2)) == rest)
        # A piece without quotes is outside of strings as a whole, or not at all.
        alone = change(plain) if rest == 0 else F.lit(0)
        return F.when(quotes == 0, alone).otherwise(change(F.array_join(parts, "")))

    from_outside = depth(0) - F.when(odd, 0).otherwise(1)
    from_inside = depth(1) - F.when(odd, 1).otherwise(0)
    return odd, from_outside, from_inside


# --- states along a file --------------------------------------------------------------------


def _flip(a: Column, b: Column) -> Column:
    return a != b


def _running(rows: DataFrame, within: list[str], order: str, closed: str, opened: str) -> DataFrame:
    """Composes maps along ``order``: ``closed`` and ``opened`` become the state after this row
    for a start in the closed and in the open state.

    A map that leaves one state whatever it is entered in sets the state; from there on, and from
    the start before there is one, only the maps that swap both states count.
    """
    so_far = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    swaps = F.sum((F.col(closed) & ~F.col(opened)).cast("int")).over(so_far) % 2 == 1
    rows = rows.withColumn("_swaps", swaps)
    sets = F.when(F.col(closed) == F.col(opened), _flip(F.col(closed), F.col("_swaps")))
    rows = rows.withColumn("_set", F.last(sets, ignorenulls=True).over(so_far))
    return rows.withColumns(
        {
            closed: _flip(F.coalesce("_set", F.lit(False)), F.col("_swaps")),
            opened: _flip(F.coalesce("_set", F.lit(True)), F.col("_swaps")),
        }
    ).drop("_swaps", "_set")


_BLOCK = ["file", "block"]


def csv_maps(lines: DataFrame, separator: str, *kept: str) -> DataFrame:
    """Place of every line, ``kept`` columns, and whether it leaves a quoted field open, entered at
    the start of a field (``closed``) and inside a quoted one (``opened``)."""
    closed = csv_left_open(F.col("value"), separator, _FIELD).alias("closed")
    opened = csv_left_open(F.col("value"), separator, _QUOTED).alias("opened")
    return lines.select(*_BLOCK, "place", *kept, closed, opened)


def csv_states(maps: DataFrame, narrow: DataFrame) -> DataFrame:
    """The places and kept columns of ``maps`` and whether each line leaves a quoted field ``open``.

    ``narrow`` are the maps without further columns; they tell what state blocks are entered in.
    """
    states = _running(maps, _BLOCK, "place", "closed", "opened")
    blocks = (states if maps is narrow else _running(narrow, _BLOCK, "place", "closed", "opened")).groupBy(_BLOCK).agg(
        F.max_by("closed", "place").alias("closed"), F.max_by("opened", "place").alias("opened")
    )
    along = _running(blocks, ["file"], "block", "closed", "opened")
    entered = along.select(
        *_BLOCK,
        F.lag("closed", 1, False).over(Window.partitionBy("file").orderBy("block")).alias("entered"),
    )
    is_open = F.when(F.col("entered"), F.col("opened")).otherwise(F.col("closed"))
    return states.join(entered, _BLOCK).withColumn("open", is_open).drop("closed", "opened", "entered")


def json_maps(parts: DataFrame, *kept: str) -> DataFrame:
    """Place of every piece, ``kept`` columns, and its ``odd``, ``outside`` and ``inside``."""
    odd, outside, inside = json_outside(F.col("value"))
    return parts.select(*_BLOCK, "place", *kept, odd.alias("odd"), outside.alias("outside"), inside.alias("inside"))


def json_states(maps: DataFrame, narrow: DataFrame) -> DataFrame:
    """The places and kept columns of ``maps``, whether the record is ``open`` behind each piece,
    and the ``depth`` there (0 inside a string). ``narrow``: as in ``csv_states``."""
    so_far = Window.partitionBy(_BLOCK).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)

    def in_block(rows: DataFrame) -> DataFrame:
        quotes = F.sum(F.col("odd").cast("int")).over(so_far)
        # In a string behind this piece, and before it, when the block is entered outside of one.
        after = rows.withColumn("within", quotes % 2 == 1).withColumn("before", _flip(F.col("within"), F.col("odd")))
        first = F.when(F.col("before"), F.col("inside")).otherwise(F.col("outside"))
        second = F.when(F.col("before"), F.col("outside")).otherwise(F.col("inside"))
        sums = {"from_outside": F.sum(first).over(so_far), "from_inside": F.sum(second).over(so_far)}
        return after.withColumns(sums).drop("odd", "outside", "inside", "before")

    states = in_block(maps)
    blocks = (states if maps is narrow else in_block(narrow)).groupBy(_BLOCK).agg(
        *[F.max_by(c, "place").alias(c) for c in ("within", "from_outside", "from_inside")]
    )
    along = Window.partitionBy("file").orderBy("block")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    entered = blocks.withColumn(
        "string", F.coalesce(F.sum(F.col("within").cast("int")).over(earlier), F.lit(0)) % 2 == 1
    ).withColumn("change", F.when(F.col("string"), F.col("from_inside")).otherwise(F.col("from_outside")))
    entered = entered.select(
        *_BLOCK, "string", F.coalesce(F.sum("change").over(earlier), F.lit(0)).alias("depth_before")
    )
    inside_now = _flip(F.col("within"), F.col("string"))
    depth = F.col("depth_before") + F.when(F.col("string"), F.col("from_inside")).otherwise(F.col("from_outside"))
    return (
        states.join(entered, _BLOCK)
        .withColumns({"open": inside_now | (depth != 1), "depth": F.when(~inside_now, depth).otherwise(0)})
        .drop("within", "from_outside", "from_inside", "string", "depth_before")
    )


def _block_starts(states: DataFrame) -> DataFrame:
    """Per block: whether it is ``entered`` inside a record, and where that record is ``carried``
    from: the last start in the blocks before."""
    blocks = states.groupBy(_BLOCK).agg(F.max_by("open", "place").alias("open"))
    along = Window.partitionBy("file").orderBy("block")
    entered = blocks.select(*_BLOCK, F.lag("open", 1, False).over(along).alias("entered"))
    last = _starts(states, entered).groupBy(_BLOCK).agg(F.max("own").alias("last"))
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(*_BLOCK, F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    return entered.join(carried, _BLOCK)


def _starts(states: DataFrame, entered: DataFrame) -> DataFrame:
    """Pieces that ``goes_on`` with the record before, and the last start in the block, ``own``."""
    in_block = Window.partitionBy(_BLOCK).orderBy("place")
    lagged = states.withColumn("before", F.lag("open").over(in_block)).join(entered, _BLOCK)
    going = lagged.withColumn("goes_on", F.coalesce("before", "entered"))
    so_far = in_block.rowsBetween(Window.unboundedPreceding, 0)
    own = F.last(F.when(~F.col("goes_on"), F.col("place")), ignorenulls=True).over(so_far)
    return going.withColumn("own", own)


def members(states: DataFrame, blocks: DataFrame) -> DataFrame:
    """``file`` and ``place`` of the pieces that share a record, with the place where it ``starts``."""
    return (
        _starts(states, blocks)
        .filter("goes_on or open")
        .select("file", "place", F.coalesce("own", "carried").alias("starts"))
    )


# --- records --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Found:
    """What a scan says of a file: its name in the scan, whether a record goes on across a cut,
    the place of its first text, and whether it ends inside a record."""

    file: str
    spread: bool
    first: int | None
    broken: bool = False


def _keep(rows: DataFrame, name: str) -> DataFrame:
    spark = rows.sparkSession
    folder = f"{shared_dir(spark)}/records/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def _plain(file: str) -> str:
    """A file's name without percent signs and with one slash behind the scheme."""
    return unquote(re.sub(r"^(\w+):/+", r"\1:/", file))


def _found(scanned: DataFrame, files: Sequence[str]) -> dict[str, Found]:
    """By the given names. One row per file, all of which the driver has listed, is collected."""
    given = {_plain(f): f for f in files}
    found = {given[_plain(f)]: Found(f, s, n, b) for f, s, n, b in scanned.collect()}
    # A file without any piece, an empty one, is not seen by the scan.
    return {f: found.get(f, Found(f, False, None)) for f in files}


def _settled(found: dict[str, Found], ends: Callable[[list[str]], DataFrame]) -> dict[str, Found]:
    """Looks at the end of files whose records go on across cuts."""
    careful = {facts.file: given for given, facts in found.items() if facts.spread}
    if not careful:
        return found
    broken = {careful[file]: bool(wrong) for file, wrong in ends(list(careful.values())).collect()}
    return {f: replace(facts, broken=broken.get(f, facts.broken)) for f, facts in found.items()}


def csv_files(spark: SparkSession, files: Sequence[str], separator: str, cut: str = "\n") -> dict[str, Found]:
    """Per file: whether a quoted field goes on across lines, where the header is, and whether the
    file ends inside a quoted field. One scan; those with such fields get a second one."""
    scanned = (
        pieces(spark, files, cut)
        .groupBy("file")
        .agg(
            F.max(csv_left_open(F.col("value"), separator, _FIELD)),
            F.min(F.when(F.rlike("value", F.lit(r"\S")), F.col("place"))),
            F.lit(False),
        )
    )

    def ends(careful: list[str]) -> DataFrame:
        maps = csv_maps(pieces(spark, careful, cut), separator)
        return csv_states(maps, maps).groupBy("file").agg(F.max_by("open", "place"))

    return _settled(_found(scanned, files), ends)


def json_files(spark: SparkSession, files: Sequence[str]) -> dict[str, Found]:
    """Per array file: whether an object holds braces, and whether the file is not one whole array.

    One scan; files with such objects get a second one.
    """
    odd, outside, _ = json_outside(F.col("value"))
    # An object without inner braces is one piece; the array's own brackets stand at both ends.
    at_start = F.rlike("value", F.lit(r"^\s*\["))
    at_end = F.rlike("value", F.lit(r"^\s*(\[\s*)?\]\s*$"))
    alone = ~odd & ((outside == F.when(at_start, 1).otherwise(0)) | at_end)
    scanned = (
        pieces(spark, files, JSON_CUT)
        .groupBy("file")
        .agg(F.max(~alone), F.min("place"), ~F.max_by(at_end, "place"))
    )

    def ends(careful: list[str]) -> DataFrame:
        # The last piece ends the array and has no brace of its own.
        maps = json_maps(pieces(spark, careful, JSON_CUT))
        return json_states(maps, maps).groupBy("file").agg(F.max_by("depth", "place") != -1)

    return _settled(_found(scanned, files), ends)


# Share of pieces in records of several from which texts are moved by block instead of joined.
MANY = 0.25


def _records(
    parts: DataFrame,
    maps: Callable[..., DataFrame],
    states: Callable[[DataFrame, DataFrame], DataFrame],
    between: str,
) -> DataFrame:
    """``name``, ``file``, ``place`` and ``value`` of every record.

    The maps of all pieces are written once. Where few pieces share a record, these are found by a
    join on their places, small enough to be broadcast, and only they are moved. Where many do,
    all texts are moved once, by block.
    """
    narrow = _keep(maps(parts), "maps")
    blocks = _keep(_block_starts(states(narrow, narrow)), "blocks")
    shared = _keep(members(states(narrow, narrow), blocks), "members")
    if shared.count() > MANY * narrow.count():
        return _assembled(states(maps(parts, "name", "value"), narrow), blocks, between)
    return _joined(parts, shared, between)


def _spelled(pieces_: str, between: str) -> Column:
    return F.array_join(F.transform(F.array_sort(pieces_), lambda p: p["value"]), between).alias("value")


def _joined(parts: DataFrame, shared: DataFrame, between: str) -> DataFrame:
    alone = parts.join(shared.select("file", "place"), ["file", "place"], "left_anti")
    together = (
        parts.join(shared, ["file", "place"])
        .groupBy("file", "starts")
        .agg(F.first("name").alias("name"), F.collect_list(F.struct("place", "value")).alias("pieces"))
    )
    return alone.select("name", "file", "place", "value").unionByName(
        together.select("name", "file", F.col("starts").alias("place"), _spelled("pieces", between))
    )


def _assembled(states: DataFrame, blocks: DataFrame, between: str) -> DataFrame:
    """Records put together inside their blocks; the few that cross one are joined afterwards."""
    started = _starts(states, blocks).withColumn("starts", F.coalesce("own", "carried"))
    inside = (
        started.groupBy("file", "block", "starts")
        .agg(
            F.first("name").alias("name"),
            F.collect_list(F.struct("place", "value")).alias("pieces"),
            F.max(F.col("own").isNull()).alias("continued"),
            F.max_by("open", "place").alias("unfinished"),
        )
        .select(
            "name", "file", "block", "starts", _spelled("pieces", between),
            (F.col("continued") | F.col("unfinished")).alias("crosses"),
        )
    )
    crossing = (
        inside.filter("crosses")
        .groupBy("file", "starts")
        .agg(F.first("name").alias("name"), F.collect_list(F.struct("block", "value")).alias("pieces"))
        .select("name", "file", F.col("starts").alias("place"), _spelled("pieces", between))
    )
    whole = inside.filter("not crosses").select("name", "file", F.col("starts").alias("place"), "value")
    return whole.unionByName(crossing)


def csv_records(spark: SparkSession, files: Sequence[str], separator: str, cut: str = "\n") -> DataFrame:
    """Every record of CSV files as text, line breaks inside quotes included, header lines too."""
    lines = pieces(spark, files, cut)
    return _records(lines, lambda rows, *kept: csv_maps(rows, separator, *kept), csv_states, cut)


def json_objects(spark: SparkSession, files: Sequence[str], spread: bool) -> DataFrame:
    """Every object of JSON array files as text, with the ``place`` it starts at.

    ``spread``: objects may hold braces, in strings or nested objects; otherwise pieces are objects.
    """
    parts = pieces(spark, files, JSON_CUT)
    if spread:
        rows = _records(parts, json_maps, json_states, JSON_CUT)
    else:
        rows = parts.select("name", "file", "place", "value")
    bare = F.regexp_replace("value", r"^[\s,\[]+", "")
    return rows.withColumn("value", F.concat(bare, F.lit(JSON_CUT))).filter(F.startswith("value", F.lit("{")))
