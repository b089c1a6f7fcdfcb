"""Workbook tabs as a table of rows, one task per workbook.

A workbook is a zip archive that can only be unpacked as a whole, and its format limits a
tab to 1,048,576 rows, so one task per file is bounded. Rows are streamed out in batches.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta
from itertools import islice
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRID_SCHEMA = "SOURCE_FILE string, SHEET string, ROW_NO int, CELLS array<string>"
BATCH_ROWS = 4096
#: Marker that takes the first row of a tab as its header.
FIRST_ROW = "*"
DAY_ZERO = datetime(1899, 12, 30)
BUILT_IN_DATE_FORMATS = set(range(14, 23)) | {45, 46, 47}


def _tag(element) -> str:
    return element.tag.rsplit("}", 1)[-1]


def _column_index(reference: str) -> int:
    index = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        index = index * 26 + ord(letter) - 64
    return index - 1


def _elements(stream, parent: str, child: str) -> Iterator[ElementTree.Element]:
    """Complete children of the parent, one at a time, freed after use."""
    container = None
    for event, element in ElementTree.iterparse(stream, events=("start", "end")):
        tag = _tag(element)
        if event == "start" and tag == parent:
            container = element
        elif event == "end" and tag == child:
            yield element
            container.clear()


def _written(element) -> str:
    """Text of a string item without its reading aids."""
    texts = []
    for part in element:
        if _tag(part) == "t":
            texts.append(part.text or "")
        elif _tag(part) == "r":
            texts.extend(t.text or "" for t in part if _tag(t) == "t")
    return "".join(texts)


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    with book.open("xl/sharedStrings.xml") as stream:
        return [_written(item) for item in _elements(stream, "sst", "si")]


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Positions of cell styles that show a number as a date."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    dates = set(BUILT_IN_DATE_FORMATS)
    for element in root.iter():
        if _tag(element) == "numFmt":
            code = re.sub(r'"[^"]*"|\[[^\]]*\]', "", element.get("formatCode", "")).lower()
            if re.search(r"[dy]", code):
                dates.add(int(element.get("numFmtId")))
    styles = next((e for e in root.iter() if _tag(e) == "cellXfs"), [])
    return {i for i, style in enumerate(styles) if int(style.get("numFmtId", 0)) in dates}


def _tabs(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    relations = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    targets = {r.get("Id"): r.get("Target") for r in relations}
    tabs = []
    for element in ElementTree.fromstring(book.read("xl/workbook.xml")).iter():
        if _tag(element) == "sheet":
            relation = next(v for k, v in element.attrib.items() if k.endswith("}id"))
            target = targets[relation].lstrip("/")
            tabs.append((element.get("name"), target if target.startswith("xl/") else f"xl/{target}"))
    return tabs


def _cell_text(cell, strings: list[str], date_styles: set[int]) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return "".join(_written(item) for item in cell if _tag(item) == "is")
    value = next((v.text for v in cell if _tag(v) == "v"), None)
    if value is None or kind == "e":
        return None
    if kind == "s":
        return strings[int(value)]
    if kind == "n" and int(cell.get("s", 0)) in date_styles:
        moment = DAY_ZERO + timedelta(days=float(value))
        return moment.strftime("%Y-%m-%d" if float(value).is_integer() else "%Y-%m-%d %H:%M:%S")
    return value


def _rows(book, path, strings, date_styles, first_row, first_column) -> Iterator[tuple[int, list]]:
    number = 0
    with book.open(path) as stream:
        for row in _elements(stream, "sheetData", "row"):
            number = int(row.get("r", number + 1))
            if number < first_row:
                continue
            cells: list[str | None] = []
            for cell in row:
                at = _column_index(cell.get("r")) if cell.get("r") else len(cells) + first_column
                if at >= first_column:
                    cells.extend([None] * (at - first_column - len(cells)))
                    text = (_cell_text(cell, strings, date_styles) or "").strip()
                    cells.append(text or None)
            if any(c is not None for c in cells):
                yield number, cells


def _grid(
    name: str, content: bytes, sheet_pattern: str, first_row: int, first_column: int, marker: str | None = None
) -> Iterator[tuple]:
    """Rows of all matching tabs of one workbook, each with the header above it: the first row that holds the marker."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        strings, date_styles = _shared_strings(book), _date_styles(book)
        for sheet, part in _tabs(book):
            if re.search(sheet_pattern, sheet):
                header = None
                for number, cells in _rows(book, part, strings, date_styles, first_row, first_column):
                    yield name, sheet, number, cells, header
                    if header is None and (marker == FIRST_ROW or marker in cells):
                        header = cells


def read_sheets(
    spark: SparkSession, path: str, sheet_pattern: str = ".*", start_cell: str = "A1", marker: str | None = None
) -> DataFrame:
    """Cells of all tabs that match, as text, from the start cell on; empty cells are null.

    Columns: SOURCE_FILE, SHEET, ROW_NO, CELLS. With a marker, a cell text or FIRST_ROW, also HEADER: the cells of the
    header of the tab in the rows below it, found while the rows stream by, and null in those above.
    """
    names = ["SOURCE_FILE", "SHEET", "ROW_NO", "CELLS", *(["HEADER"] if marker else [])]
    column_letters, first_row = re.match(r"([A-Z]+)(\d+)$", start_cell).groups()
    first_column = _column_index(column_letters)

    def unpack(batches):
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                rows = _grid(name, content, sheet_pattern, int(first_row), first_column, marker)
                while chunk := [row[: len(names)] for row in islice(rows, BATCH_ROWS)]:
                    yield pd.DataFrame(chunk, columns=names)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(unpack, GRID_SCHEMA + (", HEADER array<string>" if marker else ""))


def header_rows(grid: DataFrame, marker: str | None = None) -> DataFrame:
    """Header of each tab: the first row that holds the marker, or the first row of all."""
    candidates = grid if marker is None else grid.filter(F.array_contains("CELLS", marker))
    return candidates.groupBy("SOURCE_FILE", "SHEET").agg(
        F.min("ROW_NO").alias("HEADER_ROW"), F.min_by("CELLS", "ROW_NO").alias("HEADER")
    )


def header_names(grid: DataFrame, marker: str | None = None) -> DataFrame:
    """Distinct column names of all tabs."""
    names = header_rows(grid, marker).select(F.explode("HEADER").alias("NAME"))
    return names.filter("NAME is not null").distinct()


def tabs_without_header(grid: DataFrame, marker: str) -> DataFrame:
    """Tabs that `promote_header` leaves out as no row holds the marker, with their number of rows."""
    marked = F.max(F.array_contains("CELLS", marker).cast("int"))
    tabs = grid.groupBy("SOURCE_FILE", "SHEET").agg(marked.alias("__marked"), F.count(F.lit(1)).alias("LINHAS"))
    return tabs.filter(F.coalesce("__marked", F.lit(0)) == 0).drop("__marked")


def named_cell(name: str) -> Column:
    """Cell under the first header with that name, null where the tab has none."""
    position = F.array_position(F.col("HEADER"), name)
    return F.get(F.col("CELLS"), (position - 1).cast("int"))


def promote_header(
    grid: DataFrame, columns: Sequence[str], marker: str | None = None
) -> DataFrame:
    """Rows below the header as named text columns, with SOURCE_FILE and SHEET.

    Tabs without the marker drop out (see `tabs_without_header`). A column that a tab does not have is null, so tabs
    with different layouts end up in one table. Where the grid was read with its headers nothing is joined, and
    the workbooks are read once.
    """
    if "HEADER" in grid.columns:
        below = grid.filter(F.col("HEADER").isNotNull())
        return below.select("SOURCE_FILE", "SHEET", *[named_cell(c).alias(c) for c in columns])
    headers = header_rows(grid, marker)
    rows = grid.join(headers, ["SOURCE_FILE", "SHEET"]).filter(F.col("ROW_NO") > F.col("HEADER_ROW"))
    return rows.select("SOURCE_FILE", "SHEET", *[named_cell(c).alias(c) for c in columns])
