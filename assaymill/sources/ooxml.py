"""Workbooks and word-processor documents as Spark data sources, read with the standard library.

``xlsx_cells`` gives one row per cell with its physical row, so blank rows, repeated headers and
ragged rows stay what they are; ``docx_paragraphs`` gives paragraphs and table rows in order. One input
partition per (file, sheet) or file.
"""

from __future__ import annotations

import glob
import os
import re
import zipfile
from datetime import datetime, timedelta
from itertools import islice
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

CELLS = "file string, sheet string, excel_row int, column_index int, header string, value string, value_type string, is_formula boolean"
_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_PKG = "{http://schemas.openxmlformats.org/package/2006/relationships}"
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
#: Built-in number formats that show dates.
_DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}


def expand(path: str, suffix: str) -> list[str]:
    path = path.removeprefix("file://")
    if os.path.isdir(path):
        return sorted(glob.glob(f"{path}/**/*{suffix}", recursive=True))
    return sorted(glob.glob(path)) or [path]


def sheet_parts(book: zipfile.ZipFile) -> dict[str, str]:
    """Sheet names in order, each with its part's path."""
    targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")).iter(f"{_PKG}Relationship")}
    sheets = ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_NS}sheet")
    out = {}
    for sheet in sheets:
        target = targets[sheet.get(f"{_REL}id")]
        out[sheet.get("name")] = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    return out


def sheet_names(path: str) -> list[str]:
    with zipfile.ZipFile(path) as book:
        return list(sheet_parts(book))


def _column(reference: str) -> int:
    number = 0
    for letter in re.match(r"[A-Z]+", reference)[0]:
        number = number * 26 + ord(letter) - 64
    return number


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{_NS}t"))


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    own = {int(f.get("numFmtId")) for f in root.iter(f"{_NS}numFmt") if re.search(r"[dmyhs]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", f.get("formatCode", "")), re.I)}
    formats = root.find(f"{_NS}cellXfs")
    return {i for i, xf in enumerate(formats if formats is not None else []) if int(xf.get("numFmtId", 0)) in own | _DATE_FORMATS}


def _value(cell, shared: list[str], dates: set[int]) -> tuple[str | None, str, bool]:
    kind, formula = cell.get("t", "n"), cell.find(f"{_NS}f") is not None
    if kind == "inlineStr":
        inline = cell.find(f"{_NS}is")
        return (_text(inline) if inline is not None else ""), "string", formula
    node = cell.find(f"{_NS}v")
    if node is None or node.text is None:
        return None, "empty", formula
    raw = node.text
    if kind == "s":
        return shared[int(raw)], "string", formula
    if kind == "b":
        return ("true" if raw == "1" else "false"), "boolean", formula
    if kind in ("str", "e"):
        return raw, "string" if kind == "str" else "error", formula
    number = float(raw)
    if int(cell.get("s", 0)) in dates:
        day = datetime(1899, 12, 30) + timedelta(days=number)
        return day.isoformat(timespec="seconds"), "datetime", formula
    if re.fullmatch(r"[+-]?\d+", raw):
        return str(int(raw)), "integer", formula
    return f"{number:.15g}", "number", formula


def sheet_rows(path: str, sheet: str, header: str = "first_row"):
    """(excel_row, [(column_index, header, value, value_type, is_formula)]) of every row that is not blank.

    ``header`` is ``first_row`` (physical row 1) or ``first_nonempty``. Rows are padded to the header's width.
    """
    with zipfile.ZipFile(path) as book:
        names = book.namelist()
        shared = [_text(si) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{_NS}si")] if "xl/sharedStrings.xml" in names else []
        dates = _date_styles(book)
        headers: list[str] | None = None
        with book.open(sheet_parts(book)[sheet]) as part:
            for _, node in ElementTree.iterparse(part):
                if node.tag != f"{_NS}row":
                    continue
                number = int(node.get("r"))
                cells = {_column(c.get("r")): _value(c, shared, dates) for c in node.iter(f"{_NS}c")}
                node.clear()
                filled = any(v[0] is not None and v[0].strip() or v[2] for v in cells.values())
                if headers is None:
                    if header == "first_nonempty" and not filled:
                        continue
                    headers = [(cells.get(i, (None,))[0] or "").strip() for i in range(1, max(cells, default=0) + 1)]
                    continue
                if not filled:
                    continue
                width = max(len(headers), max(cells))
                yield number, [(i, headers[i - 1] if i <= len(headers) else "", *cells.get(i, (None, "empty", False))) for i in range(1, width + 1)]


class _Sheet(InputPartition):
    def __init__(self, path: str, sheet: str | None):
        self.path, self.sheet = path, sheet


class _XlsxReader(DataSourceReader):
    def __init__(self, options):
        self.options = options

    def partitions(self):
        wanted = self.options.get("sheet")
        return [_Sheet(p, s) for p in expand(self.options["path"], ".xlsx") for s in sheet_names(p) if wanted in (None, s)]

    def read(self, partition):
        limit = self.options.get("row_limit")
        for number, cells in islice(sheet_rows(partition.path, partition.sheet, self.options.get("header", "first_row")), int(limit) if limit else None):
            for i, header, value, kind, formula in cells:
                yield os.path.basename(partition.path), partition.sheet, number, i, header, value, kind, formula


class XlsxCells(DataSource):
    @classmethod
    def name(cls):
        return "xlsx_cells"

    def schema(self):
        return CELLS

    def reader(self, schema):
        return _XlsxReader(dict(self.options))


def docx_blocks(path: str):
    """(index, kind, style, text) of paragraphs and table rows, in the document's order."""
    with zipfile.ZipFile(path) as book:
        body = ElementTree.fromstring(book.read("word/document.xml")).find(f"{_W}body")

    def text(node) -> str:
        return "".join(t.text or "" for t in node.iter(f"{_W}t"))

    index = 0
    for block in body:
        if block.tag == f"{_W}p":
            style = block.find(f"{_W}pPr/{_W}pStyle")
            yield index, "paragraph", style.get(f"{_W}val") if style is not None else "", text(block)
            index += 1
        elif block.tag == f"{_W}tbl":
            for row in block.iter(f"{_W}tr"):
                yield index, "table_row", "", " | ".join(text(c) for c in row.iter(f"{_W}tc"))
                index += 1


class _DocxReader(DataSourceReader):
    def __init__(self, options):
        self.options = options

    def partitions(self):
        return [_Sheet(p, None) for p in expand(self.options["path"], ".docx")]

    def read(self, partition):
        for block in docx_blocks(partition.path):
            yield os.path.basename(partition.path), *block


class DocxParagraphs(DataSource):
    @classmethod
    def name(cls):
        return "docx_paragraphs"

    def schema(self):
        return "file string, paragraph_index int, kind string, style string, text string"

    def reader(self, schema):
        return _DocxReader(dict(self.options))


def register(spark: SparkSession) -> None:
    for source in (XlsxCells, DocxParagraphs):
        spark.dataSource.register(source)


def payload_rows(cells: DataFrame) -> DataFrame:
    """One row per physical row, with its ordered payload of cells (an array: headers may repeat)."""
    item = F.struct("column_index", "header", "value", "value_type")
    return cells.groupBy("file", "sheet", "excel_row").agg(F.array_sort(F.collect_list(item)).alias("payload"))  # as wide as a sheet


def records(cells: DataFrame, names: list[str]) -> DataFrame:
    """Rows as columns, ``names[i]`` for column ``i + 1`` (see ``profiling.header_names``)."""
    wide = cells.groupBy("file", "sheet", "excel_row")
    return wide.agg(*(F.max(F.when(F.col("column_index") == i + 1, F.col("value"))).alias(n) for i, n in enumerate(names)))


def workbook_profile(cells: DataFrame) -> DataFrame:
    """Per sheet: rows with data, last physical row, columns, formula cells and formulas with a cached value, and how sure its header is.

    A header is ``high`` where all columns have distinct names, ``medium`` where most have one, else ``low``.
    """
    named = F.nullif(F.trim("header"), F.lit(""))
    by_column = cells.groupBy("file", "sheet", "column_index").agg(
        F.max(named).alias("name"), F.count_distinct("excel_row").alias("rows"), F.max("excel_row").alias("last"), F.count(F.when(F.col("is_formula"), 1)).alias("formulas"),
        F.count(F.when(F.col("is_formula") & F.col("value").isNotNull(), 1)).alias("cached"),
    )
    return by_column.groupBy("file", "sheet").agg(
        F.max("rows").alias("data_rows"), F.max("last").alias("last_row"), F.max("column_index").alias("column_count"), F.sum("formulas").alias("formula_cells"), F.sum("cached").alias("cached_values"),
        F.when(F.count_distinct("name") == F.count(F.lit(1)), "high").when(F.count("name") * 2 > F.count(F.lit(1)), "medium").otherwise("low").alias("header_confidence"),
    )
