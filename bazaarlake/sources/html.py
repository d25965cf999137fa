"""First table of HTML pages as rows. Work is spread over pages; one page is parsed as a whole."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROW_SCHEMA = "source string, row_number int, header array<string>, cells array<string>"


class _FirstTable(HTMLParser):
    """Collects the cells of the first table; tables inside its cells are left out."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[list[str]] = []
        self.heads: list[bool] = []
        self.depth = 0
        self.done = False
        self.cell: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if self.done:
            return
        if tag == "table":
            self.depth += 1
        elif self.depth == 1 and tag == "tr":
            self._close_cell()
            self.rows.append([])
            self.heads.append(False)
        elif self.depth == 1 and tag in ("td", "th") and self.rows:
            self._close_cell()
            self.cell = []
            self.heads[-1] = self.heads[-1] or tag == "th"

    def handle_endtag(self, tag):
        if self.done or not self.depth:
            return
        if tag == "table":
            if self.depth == 1:
                self._close_cell()
                self.done = True
            self.depth -= 1
        elif self.depth == 1 and tag in ("td", "th", "tr"):
            self._close_cell()

    def handle_data(self, data):
        if self.cell is not None and self.depth == 1:
            self.cell.append(data)

    def _close_cell(self):
        if self.cell is not None:
            self.rows[-1].append(" ".join("".join(self.cell).split()))
            self.cell = None


def first_table(html: str) -> tuple[list[str], list[list[str]]] | None:
    """Header and data rows of the first table, None when the page has none."""
    parser = _FirstTable()
    parser.feed(html)
    parser.close()
    filled = [(row, head) for row, head in zip(parser.rows, parser.heads) if row]
    if not filled:
        return None
    if filled[0][1]:
        return filled[0][0], [row for row, _ in filled[1:]]
    width = max(len(row) for row, _ in filled)
    return [str(i) for i in range(width)], [row for row, _ in filled]


def table_rows(pages: DataFrame, missing: str = "fail") -> DataFrame:
    """Rows of the first table of every page of (source, html).

    A page without a table fails the job, or is left out with ``missing="skip"``.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for source, html in zip(batch["source"], batch["html"]):
                table = first_table(html or "")
                if table is None:
                    if missing == "fail":
                        raise ValueError(f"no table found in {source}")
                    continue
                header, rows = table
                found.extend((source, i, header, row) for i, row in enumerate(rows, start=1))
            yield pd.DataFrame(found, columns=["source", "row_number", "header", "cells"])

    return pages.select("source", "html").mapInPandas(read, ROW_SCHEMA)


def table_columns(rows: DataFrame, names: list[str]) -> DataFrame:
    """Named columns of the extracted rows, found by normalised header; NULL when absent."""
    headers = F.transform("header", lambda h: F.replace(F.lower(F.trim(h)), F.lit(" "), F.lit("_")))
    position = {n: F.array_position(headers, n).cast("int") for n in names}
    return rows.select(
        "source",
        "row_number",
        *[
            F.when(p > 0, F.try_element_at("cells", p)).alias(n)
            for n, p in position.items()
        ],
    )
