"""Departmental files: discovery by header, scan, row validation, staging load."""

from __future__ import annotations

import csv
import io
import json
import uuid
from collections import defaultdict
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.functions.text import present
from bazaarlake.sources import html, paths, records
from bazaarlake.sources.published import Published
from bazaarlake.sources.schemas import STAGING, no_rows

# File starts read, and tables loaded, at the same time.
_AT_ONCE = 4
SNIFF_BYTES = 1024
HEADER_BYTES = 65_536
DELIMITERS = ",;\t|"
FORMATS = {".csv": "csv", ".parquet": "parquet", ".json": "json", ".html": "html"}

# Texts a CSV reader takes for a missing value (the list in the pandas documentation).
MISSING_TEXTS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# Date spellings found in the files; the second list has two-digit years.
DATE_FORMATS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss", "M/d/yyyy"]
SHORT_YEAR_FORMATS = ["M/d/yy H:mm", "M/d/yy"]
SHORT_YEAR_PIVOT = 2070


@dataclass(frozen=True)
class FileLayout:
    """What is known of a file from its first bytes or its schema."""

    path: str
    format: str
    columns: tuple[str, ...]
    delimiter: str | None = None
    # JSON: one object per line, or an array. CSV: what ends a line.
    lines: bool = True
    line_end: str = "\n"
    # Records go on across the places where the file is cut; the file's name in a scan and the
    # place of its header there.
    spread: bool = False
    scanned: str | None = None
    header_at: int | None = None

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(normal_name(c) for c in self.columns)


@dataclass(frozen=True)
class Ingest:
    """One staging table: where its files lie, what they must hold, how rows are checked."""

    table: str
    folder: str
    required: tuple[str, ...]
    checks: dict[str, str] | None = None


def _columns_of(table: str) -> tuple[str, ...]:
    return tuple(STAGING[table].names[:-3])


def _ingest(table: str, folder: str, **checks: str) -> Ingest:
    return Ingest(table, folder, _columns_of(table), checks)


INGESTS = {
    i.table: i
    for i in [
        _ingest("stg_campaign", "marketing_department"),
        _ingest("stg_campaign_transactions", "marketing_department"),
        _ingest("stg_line_items_prices", "operations_department"),
        _ingest("stg_line_items_products", "operations_department"),
        _ingest("stg_merchant_data", "enterprise_department"),
        _ingest(
            "stg_orders",
            "operations_department",
            order_id="string",
            user_id="string",
            estimated_arrival="numeric",
            transaction_date="datetime",
        ),
        _ingest("stg_order_delays", "operations_department"),
        _ingest("stg_order_merchant", "enterprise_department"),
        _ingest("stg_product_list", "business_department"),
        _ingest("stg_staff", "enterprise_department"),
        _ingest("stg_user_credit_card", "customer_management_department"),
        _ingest("stg_user_data", "customer_management_department"),
        _ingest("stg_user_job", "customer_management_department"),
    ]
}


# --- layout and discovery -------------------------------------------------------------------


def normal_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def detect_delimiter(sample: str) -> str:
    """Delimiter of the first kilobyte; a comma when nothing else fits (one column)."""
    try:
        return csv.Sniffer().sniff(sample, delimiters=DELIMITERS).delimiter
    except csv.Error:
        return ","


def csv_layout(path: str, start: bytes, delimiter: str | None = None) -> FileLayout:
    """Layout from the first bytes of a CSV file; a byte-order mark is dropped."""
    text = start.decode("utf-8-sig", errors="ignore")
    if not text.strip():
        raise ValueError("empty file")
    delimiter = delimiter or detect_delimiter(text[:SNIFF_BYTES])
    header = next(csv.reader(io.StringIO(text, newline=None), delimiter=delimiter))
    named = tuple(c if c.strip() else f"_c{i}" for i, c in enumerate(header))
    line_end = "\n" if "\n" in text or "\r" not in text else "\r"
    return FileLayout(path, "csv", named, delimiter, line_end=line_end)


def json_layout(path: str, start: bytes) -> FileLayout:
    """Layout from the objects that are whole in the first bytes of a JSON file."""
    text = start.decode("utf-8-sig", errors="ignore").lstrip()
    if not text:
        raise ValueError("empty file")
    array = text.startswith("[")
    names: dict[str, None] = {}
    at, decoder = int(array), json.JSONDecoder()
    try:
        while True:
            at += len(text[at:]) - len(text[at:].lstrip(" \t\r\n,"))
            row, at = decoder.raw_decode(text, at)
            names.update(dict.fromkeys(row))
    except (ValueError, TypeError):
        # The end of the array or of the bytes at hand.
        return FileLayout(path, "json", tuple(names), lines=not array)


def json_names(spark: SparkSession, layout: FileLayout) -> tuple[str, ...]:
    """Every field name of a JSON file, found by reading it all."""
    if layout.lines:
        objects = spark.read.text(layout.path).select("value")
    else:
        spread = records.json_files(spark, [layout.path])[layout.path].spread
        objects = records.json_objects(spark, [layout.path], spread).select("value")
    names = objects.select(F.explode(F.json_object_keys("value")).alias("name")).distinct()
    return tuple(sorted(row["name"] for row in names.collect()))


def file_layout(spark: SparkSession, path: str) -> FileLayout:
    ending = "." + path.rsplit(".", 1)[-1].lower()
    if ending not in FORMATS:
        raise ValueError(f"unsupported file format: {ending}")
    kind = FORMATS[ending]
    if kind == "csv":
        return csv_layout(path, paths.head(spark, path, HEADER_BYTES))
    if kind == "parquet":
        return FileLayout(path, kind, tuple(spark.read.parquet(path).columns))
    if kind == "json":
        return json_layout(path, paths.head(spark, path, HEADER_BYTES))
    first = html.table_rows(_pages(spark, [path])).select("header").first()
    if first is None:
        raise ValueError("no table rows")
    return FileLayout(path, kind, tuple(first[0]))


def discover(
    spark: SparkSession, folder: str, required: Sequence[str]
) -> tuple[list[FileLayout], list[tuple[str, str]]]:
    """Files of a folder that hold all required columns, and the others with the reason.

    A file is first judged by its start or schema. A JSON file whose first objects lack a column is
    read for its field names. CSV files and JSON arrays that hold the columns are scanned for
    records that go on across line breaks or braces, and passed over if they end inside one.
    Unreadable files are skipped, not fatal.
    """
    wanted = {c.lower() for c in required}

    def judged(path: str) -> FileLayout | tuple[str, str]:
        try:
            layout = file_layout(spark, path)
            if layout.format == "json" and wanted - set(layout.names):
                if paths.size_of(spark, path) > HEADER_BYTES:
                    layout = replace(layout, columns=json_names(spark, layout))
        except Exception as problem:  # any unreadable file is passed over
            return path, f"cannot load file ({problem})"
        missing = wanted - set(layout.names)
        return (path, f"missing columns {sorted(missing)}") if missing else layout

    with ThreadPoolExecutor(_AT_ONCE) as pool:
        seen = list(pool.map(judged, paths.files_in(spark, folder)))
    valid = [each for each in seen if isinstance(each, FileLayout)]
    skipped = [each for each in seen if not isinstance(each, FileLayout)]
    settled = _with_records(spark, valid)
    skipped += [(each.path, "cannot load file (it ends inside a record)") for each in valid if each.path not in settled]
    return [settled[each.path] for each in valid if each.path in settled], skipped


def _with_records(spark: SparkSession, layouts: Sequence[FileLayout]) -> dict[str, FileLayout]:
    """By path: layouts that know how their records lie; files that end inside one are left out."""
    kinds: dict[tuple, list[FileLayout]] = defaultdict(list)
    settled = {}
    for layout in layouts:
        if layout.format == "csv" or not layout.lines:
            kinds[(layout.format, layout.delimiter, layout.line_end)].append(layout)
        else:
            settled[layout.path] = layout
    for (kind, delimiter, line_end), group in kinds.items():
        files = [each.path for each in group]
        if kind == "csv":
            found = records.csv_files(spark, files, delimiter, line_end)
        else:
            found = records.json_files(spark, files)
        for layout in group:
            facts = found[layout.path]
            if not facts.broken:
                settled[layout.path] = replace(
                    layout, spread=facts.spread, scanned=facts.file, header_at=facts.first
                )
    return settled


# --- scan -----------------------------------------------------------------------------------


def _pages(spark: SparkSession, files: list[str]) -> DataFrame:
    return spark.read.text(files, wholetext=True).select(
        F.col("_metadata.file_name").alias("source"), F.col("value").alias("html")
    )


def _as_text(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _csv_options(layout: FileLayout) -> dict[str, str]:
    return {
        "sep": layout.delimiter,
        "escape": '"',
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }


def _spread_csv(spark: SparkSession, layouts: Sequence[FileLayout]) -> DataFrame:
    """Rows of CSV files whose quoted fields hold line breaks, with their lineage.

    Such records are joined from their lines and parsed one by one; blank ones are passed over.
    """
    layout = layouts[0]
    # One row per file of this layout.
    headers = spark.createDataFrame(
        [(each.scanned, each.header_at) for each in layouts], "file string, place long"
    )
    rows = (
        records.csv_records(spark, [each.path for each in layouts], layout.delimiter, layout.line_end)
        .join(F.broadcast(headers), ["file", "place"], "left_anti")
        .filter(F.rlike("value", F.lit(r"\S")))
        .withColumn("value", F.regexp_replace("value", "\r$", ""))
    )
    by_place = _as_text([f"f{i}" for i in range(len(layout.columns))])
    parsed = F.from_csv("value", by_place.toDDL(), {**_csv_options(layout), "multiLine": "true"})
    return rows.select(
        parsed.alias("row"), F.col("name").alias("source_filename"), F.col("place").alias("ingest_ordinal")
    ).select("row.*", "source_filename", "ingest_ordinal")


def _json_array(spark: SparkSession, layouts: Sequence[FileLayout]) -> DataFrame:
    """Rows of JSON arrays with their lineage; every value as text, nested ones as JSON."""
    layout = layouts[0]
    rows = records.json_objects(spark, [each.path for each in layouts], layout.spread)
    parsed = F.from_json("value", _as_text(layout.columns))
    return rows.select(
        parsed.alias("row"), F.col("name").alias("source_filename"), F.col("place").alias("ingest_ordinal")
    ).select("row.*", "source_filename", "ingest_ordinal")


def scan_group(spark: SparkSession, layouts: Sequence[FileLayout]) -> DataFrame:
    """Files of one layout in one read, columns as text or as typed by the file format.

    Adds ``source_filename`` and ``ingest_ordinal``.
    """
    layout, files = layouts[0], [each.path for each in layouts]
    # Parquet rows know their number in the file; a row may take less than a byte there.
    position = F.col("_metadata.row_index") if layout.format == "parquet" else records.row_position()
    lineage = [
        F.col("_metadata.file_name").alias("source_filename"),
        position.alias("ingest_ordinal"),
    ]
    if layout.format == "html":
        rows = html.table_rows(_pages(spark, files))
        table = html.table_columns(rows, list(layout.names))
        return table.withColumnRenamed("source", "source_filename").withColumnRenamed(
            "row_number", "ingest_ordinal"
        )
    if layout.format == "parquet":
        raw = spark.read.parquet(*files)
        tagged = raw.select("*", *lineage)
    elif layout.format == "json" and layout.lines:
        tagged = spark.read.schema(_as_text(layout.columns)).json(files).select("*", *lineage)
    elif layout.format == "json":
        tagged = _json_array(spark, layouts)
    elif layout.spread:
        tagged = _spread_csv(spark, layouts)
    else:
        by_place = _as_text([f"f{i}" for i in range(len(layout.columns))])
        raw = spark.read.schema(by_place).options(header=True, **_csv_options(layout)).csv(files)
        tagged = raw.select("*", *lineage)
    fields = tagged.columns[:-2]
    wanted: dict[str, str] = {}
    for field, name in zip(fields, layout.names):
        wanted.setdefault(name, field)
    columns = [tagged[f"`{field}`"].alias(name) for name, field in wanted.items()]
    named = tagged.select(*columns, "source_filename", "ingest_ordinal")
    if layout.format != "csv":
        return named
    return named.select(
        [
            F.when(~F.col(c).isin(MISSING_TEXTS), F.col(c)).alias(c) if c in wanted else F.col(c)
            for c in named.columns
        ]
    )


def scan(
    spark: SparkSession, layouts: Sequence[FileLayout], columns: Sequence[str]
) -> list[DataFrame]:
    """One DataFrame per distinct layout, each with the required columns and lineage."""
    groups: dict[tuple, list[FileLayout]] = defaultdict(list)
    for layout in layouts:
        kind = (layout.format, layout.delimiter, layout.columns, layout.lines, layout.line_end, layout.spread)
        groups[kind].append(layout)
    return [
        require(scan_group(spark, group), [*columns, "source_filename", "ingest_ordinal"])
        for group in groups.values()
    ]


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"required columns missing: {missing}")
    return df.select(*columns)


# --- validation -----------------------------------------------------------------------------


def parse_moment(text: Column) -> Column:
    """Timestamp from any of the known spellings, NULL when none fits."""
    full = [F.try_to_timestamp(text, F.lit(f)) for f in DATE_FORMATS]
    short = []
    for spelling in SHORT_YEAR_FORMATS:
        parsed = F.try_to_timestamp(text, F.lit(spelling))
        century = F.when(F.year(parsed) >= SHORT_YEAR_PIVOT, 100).otherwise(0)
        short.append(parsed - F.make_ym_interval(century, F.lit(0)))
    return F.coalesce(*full, *short)


def _moment(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    return parse_moment(F.col(column)) if isinstance(kind, T.StringType) else F.col(column)


def invalid(df: DataFrame, column: str, kind: str) -> Column:
    if kind == "string":
        return ~present(F.col(column).cast("string"))
    if kind == "numeric":
        number = F.regexp_extract(F.col(column).cast("string"), r"(\d+\.?\d*)", 1)
        return number.try_cast("double").isNull()
    if kind == "datetime":
        return _moment(df, column).isNull()
    raise ValueError(f"unknown check {kind}")


def with_reject_reason(df: DataFrame, checks: dict[str, str] | None) -> DataFrame:
    """Adds ``reject_reason``: the failed columns with their checks, NULL for a valid row."""
    failed = [
        F.when(invalid(df, column, kind), F.lit(f"{column}: {kind}"))
        for column, kind in (checks or {}).items()
        if column in df.columns
    ]
    reason = F.concat_ws(", ", *failed) if failed else F.lit("")
    return df.withColumn("reject_reason", F.nullif(reason, F.lit("")))


def typed(df: DataFrame, table: str) -> DataFrame:
    """Columns in their staging types. A date that cannot be read fails the load."""
    columns = []
    for field in STAGING[table].fields:
        value = F.col(field.name)
        is_text = isinstance(df.schema[field.name].dataType, T.StringType)
        if is_text and isinstance(field.dataType, (T.DateType, T.TimestampType)):
            moment = parse_moment(value)
            complaint = F.raise_error(F.concat(F.lit(f"bad date in {field.name}: "), value))
            value = F.when(value.isNotNull(), F.coalesce(moment, complaint.cast("timestamp")))
        if is_text and isinstance(field.dataType, (T.IntegerType, T.LongType)):
            value = F.regexp_replace(value, r"\.0+$", "")
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(columns)


# --- load -----------------------------------------------------------------------------------


def ingest(
    spark: SparkSession, root: str, table: str, load_time: str
) -> tuple[DataFrame, DataFrame]:
    """Valid rows in the staging schema, and rejected rows as text with their reason."""
    job = INGESTS[table]
    layouts, _ = discover(spark, f"{root}/{job.folder}", job.required)
    loaded = F.lit(load_time).cast("timestamp")
    good, bad = [], []
    for rows in scan(spark, layouts, job.required):
        checked = with_reject_reason(rows, job.checks).withColumn("ingestion_date", loaded)
        good.append(typed(checked.filter("reject_reason is null"), table))
        if job.checks:
            as_text = [F.col(c).cast("string").alias(c) for c in job.required]
            bad.append(
                checked.filter("reject_reason is not null").select(
                    *as_text, "source_filename", "ingestion_date", "ingest_ordinal", "reject_reason"
                )
            )
    empty = no_rows(spark, STAGING[table])
    reasons = T.StructType(
        [T.StructField(c, T.StringType()) for c in job.required]
        + STAGING[table].fields[-3:]
        + [T.StructField("reject_reason", T.StringType())]
    )
    no_reject = no_rows(spark, reasons).select(
        *job.required, "source_filename", "ingestion_date", "ingest_ordinal", "reject_reason"
    )
    return (
        reduce(DataFrame.unionByName, good, empty),
        reduce(DataFrame.unionByName, bad, no_reject),
    )


def load_staging(spark: SparkSession, root: str, target: str, load_time: str) -> int:
    """Replaces every staging table with this delivery; rejects go to a table of their own.

    All tables are written into new folders, some at a time, and become visible together.
    """
    load = f"{target.rstrip('/')}/load={uuid.uuid4().hex}"

    def write(table: str) -> dict[str, str]:
        valid, rejected = ingest(spark, root, table, load_time)
        written = {table: f"{load}/{table}"}
        valid.write.parquet(written[table])
        if INGESTS[table].checks:
            written[f"{table}_rejected"] = f"{load}/{table}_rejected"
            rejected.write.parquet(written[f"{table}_rejected"])
        return written

    with ThreadPoolExecutor(_AT_ONCE) as pool:
        folders = {name: folder for written in pool.map(write, INGESTS) for name, folder in written.items()}
    return Published(spark, target).publish(folders)


def read_staging(spark: SparkSession, target: str, version: int | None = None) -> dict[str, DataFrame]:
    """The staging tables of one delivery, by default the latest."""
    folders = Published(spark, target).read(version)
    return {t: spark.read.schema(STAGING[t]).parquet(folders[t]) for t in INGESTS}
