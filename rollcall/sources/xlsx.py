"""A Python data source for workbooks: spark.read.format("xlsx").option("path", ...). Standard library only.

Each sheet is a partition; rows stream from the zipped XML, so memory is bounded by the shared strings. Options:
path, skip (names of sheets to leave out, comma-separated), columns (cells of a row, 7 if not given).
"""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Names of the workbook format.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
REL_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
COLUMNS = 7


def sheets(path: str) -> list[tuple[str, str]]:
    """Name and archive member of every sheet, in order."""
    with zipfile.ZipFile(path) as archive:
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(archive.read("xl/_rels/workbook.xml.rels"))}
        book = ElementTree.fromstring(archive.read("xl/workbook.xml"))
    found = []
    for sheet in book.iter(MAIN + "sheet"):
        target = targets[sheet.get(REL_ID)]
        found.append((sheet.get("name"), target.lstrip("/") if target.startswith("/") else "xl/" + target))
    return found


def _text(element: ElementTree.Element) -> str:
    return "".join(t.text or "" for t in element.iter(MAIN + "t"))


def shared_strings(archive: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in archive.namelist():
        return []
    strings = []
    with archive.open("xl/sharedStrings.xml") as file:
        for _, element in ElementTree.iterparse(file):
            if element.tag == MAIN + "si":
                strings.append(_text(element))
                element.clear()
    return strings


def column_number(reference: str) -> int:
    n = 0
    for c in reference:
        if not c.isalpha():
            break
        n = 26 * n + ord(c.upper()) - 64
    return n - 1


def number_text(raw: str) -> str:
    """A numeric cell as text: whole numbers without fraction unless the file writes one."""
    value = float(raw)
    if "." not in raw and "e" not in raw.lower():
        return raw
    return repr(value)


def cell_value(cell: ElementTree.Element, strings: list[str]) -> tuple[str | None, bool]:
    """Text (null if the cell is empty) and whether the cell holds a number."""
    kind, value = cell.get("t"), cell.find(MAIN + "v")
    if kind == "inlineStr":
        inner = cell.find(MAIN + "is")
        return (None if inner is None else _text(inner)), False
    if value is None or value.text is None:
        return None, False
    if kind == "s":
        return strings[int(value.text)], False
    if kind == "b":
        return ("True" if value.text == "1" else "False"), False
    return (value.text, False) if kind in ("str", "e", "d") else (number_text(value.text), True)


def rows(path: str, member: str, columns: int = COLUMNS) -> Iterator[tuple[int, list[str | None], list[bool]]]:
    """(row_index, cells, is_numeric) of every row after the first that has a cell that is not null; row_index counts all rows but the first."""
    with zipfile.ZipFile(path) as archive:
        strings = shared_strings(archive)
        with archive.open(member) as file:
            last = 0
            for _, row in ElementTree.iterparse(file):
                if row.tag != MAIN + "row":
                    continue
                last = int(row.get("r") or last + 1)
                cells: dict[int, tuple[str | None, bool]] = {}
                for i, cell in enumerate(row.findall(MAIN + "c")):
                    cells[column_number(cell.get("r")) if cell.get("r") else i] = cell_value(cell, strings)
                row.clear()
                if last > 1 and any(v is not None for v, _ in cells.values()):
                    held = [cells.get(i, (None, False)) for i in range(columns)]
                    yield last - 1, [v for v, _ in held], [n for _, n in held]


class Sheet(InputPartition):
    def __init__(self, order: int, name: str, member: str):
        super().__init__(order)
        self.order, self.name, self.member = order, name, member


class XlsxReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.skip = [s.strip() for s in options.get("skip", "").split(",") if s.strip()]
        self.columns = int(options.get("columns", COLUMNS))

    def partitions(self) -> list[InputPartition]:
        return [Sheet(i, name, member) for i, (name, member) in enumerate(s for s in sheets(self.path) if s[0] not in self.skip)]

    def read(self, partition: Sheet) -> Iterator[tuple]:
        for index, cells, numeric in rows(self.path, partition.member, self.columns):
            yield partition.order, partition.name, index, cells, numeric


class XlsxSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def schema(self) -> str:
        return "sheet_order int, sheet string, row_index int, cells array<string>, is_numeric array<boolean>"

    def reader(self, schema) -> DataSourceReader:
        return XlsxReader({k.lower(): v for k, v in self.options.items()})


def register(spark: SparkSession) -> None:
    spark.dataSource.register(XlsxSource)
