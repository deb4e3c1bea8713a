"""Workbook cells as a DataFrame: sheet_idx, sheet, row_idx, col_idx, value.

``workbook`` is a data source of Spark: ``spark.read.format("workbook").load(path)`` once ``WorkbookSource`` is registered
(``read_cells`` does that). Each (workbook, sheet) is a partition; a task reads the zip file's directory and its own
sheet's member by ranges. Where the session's ``spark.sql.python.filterPushdown.enabled`` is on (and the option ``pushdown``,
which ``read_cells`` sets by it), filters on path, sheet and sheet_idx leave out whole partitions; a schema of fewer
columns (``.schema("sheet string, value string")``) makes only those. Stores that only Spark opens go by
``binaryFile``, one workbook a task. Values are what Python's ``str`` gives for the cell: whole numbers
without a fraction, ``True``, error codes, dates as ``YYYY-MM-DD HH:MM:SS``.

Sheets are streamed, 10,000 cells at a time; shared strings are held whole by the tasks whose sheets use them.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from itertools import islice
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

from ..plans.ship import ship
from .files import listed, located, opened_by_tasks

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
CELLS = "path string, sheet_idx int, sheet string, row_idx int, col_idx int, value string"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def column_number(ref: str) -> int:
    n = 0
    for c in ref:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def _date_styles(z: zipfile.ZipFile) -> list[bool]:
    """Whether each cell style shows a date."""
    if "xl/styles.xml" not in z.namelist():
        return []
    custom, styles = {}, []
    root = ET.fromstring(z.read("xl/styles.xml"))
    for node in root.iter():
        if _local(node.tag) == "numFmt":
            custom[int(node.get("numFmtId"))] = node.get("formatCode", "")
        elif _local(node.tag) == "cellXfs":
            for xf in node:
                i = int(xf.get("numFmtId", 0))
                code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", custom.get(i, ""))
                styles.append(14 <= i <= 22 or 45 <= i <= 47 or bool(re.search(r"[ymdhs]", code, re.I)))
    return styles


def _number(text: str, is_date: bool) -> str:
    v = float(text)
    if is_date:
        return str(datetime(1899, 12, 30) + timedelta(seconds=round(v * 86400)))
    return str(int(text)) if re.fullmatch(r"-?\d+", text) else str(int(v)) if v.is_integer() and "." not in text and "e" not in text.lower() else str(v)


def sheets_of(z: zipfile.ZipFile) -> list[tuple[int, str, str]]:
    """(place, name, member) of a workbook's sheets: two small members are read."""
    rels = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
    sheets = [n for n in ET.fromstring(z.read("xl/workbook.xml")).iter() if _local(n.tag) == "sheet"]
    targets = [rels[s.get(_REL)] for s in sheets]
    return [(i, s.get("name"), t.lstrip("/") if t.startswith("/") else f"xl/{t}") for i, (s, t) in enumerate(zip(sheets, targets))]


def sheet_cells(z: zipfile.ZipFile, member: str) -> Iterator[tuple[int, int, str]]:
    """(row_idx, col_idx, value) of the cells of one sheet that hold something. Shared strings are read when a cell needs them."""
    shared: list[str] | None = None
    styles = _date_styles(z)
    row_no = -1
    with z.open(member) as f:
        for _, row in ET.iterparse(f):
            if _local(row.tag) != "row":
                continue
            row_no = int(row.get("r")) - 1 if row.get("r") else row_no + 1
            col = -1
            for c in row:
                if _local(c.tag) != "c":
                    continue
                col = column_number(c.get("r")) if c.get("r") else col + 1
                if shared is None and c.get("t") == "s":
                    shared = _shared_strings(z)
                value = _cell(c, shared or [], styles)
                if value is not None:
                    yield row_no, col, value
            row.clear()


def _shared_strings(z: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in z.namelist():
        return []
    return ["".join(t.text or "" for t in _texts(si)) for si in ET.fromstring(z.read("xl/sharedStrings.xml"))]


def workbook_cells(data: bytes) -> Iterator[tuple[int, str, int, int, str]]:
    """(sheet_idx, sheet, row_idx, col_idx, value) of all sheets."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        for i, name, member in sheets_of(z):
            for cell in sheet_cells(z, member):
                yield i, name, *cell


def _texts(node: ET.Element) -> Iterator[ET.Element]:
    """Text runs, without phonetic hints."""
    for child in node:
        if _local(child.tag) == "t":
            yield child
        elif _local(child.tag) == "r":
            yield from (t for t in child if _local(t.tag) == "t")


def _cell(c: ET.Element, shared: list[str], styles: list[bool]) -> str | None:
    kind = c.get("t", "n")
    if kind == "inlineStr":
        return next(("".join(t.text or "" for t in _texts(n)) for n in c if _local(n.tag) == "is"), None)
    v = next((n.text for n in c if _local(n.tag) == "v"), None)
    if v is None:
        return None
    if kind == "s":
        return shared[int(v)]
    if kind == "b":
        return "True" if v == "1" else "False"
    if kind in ("str", "e", "d"):
        return v
    style = int(c.get("s", 0))
    return _number(v, style < len(styles) and styles[style])


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """The cells of one workbook, a folder of them or those that a wildcard names; one task a sheet where tasks can open the store."""
    if opened_by_tasks(path):
        ship(spark)
        spark.dataSource.register(WorkbookSource)
        return spark.read.format("workbook").option("pushdown", spark.conf.get(PUSHDOWN, "false")).load(path)
    return cells_of(spark.read.format("binaryFile").load(path).select("path", "content"))


def cells_of(files: DataFrame) -> DataFrame:
    """The cells of workbooks (path, content)."""

    def unpack(frames):
        import pandas as pd

        columns = [c.split()[0] for c in CELLS.split(", ")]
        for pdf in frames:
            for name, data in zip(pdf.path, pdf.content):
                cells = ((name, *c) for c in workbook_cells(data))
                while lot := list(islice(cells, 100_000)):
                    yield pd.DataFrame(lot, columns=columns)

    ship(files.sparkSession)
    return files.mapInPandas(unpack, CELLS)


class SheetPartition(InputPartition):
    def __init__(self, path: str, sheet_idx: int, sheet: str, member: str):
        super().__init__((path, sheet_idx))
        self.path, self.sheet_idx, self.sheet, self.member = path, sheet_idx, sheet, member


class WorkbookSource(DataSource):
    """Cells of workbooks: path, sheet_idx, sheet, row_idx, col_idx, value."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return CELLS

    def reader(self, schema: StructType) -> WorkbookReader:
        kind = FilteringReader if self.options.get("pushdown", "false") == "true" else WorkbookReader
        return kind(self.options["path"], schema)


class WorkbookReader(DataSourceReader):
    LOT = 10_000

    def __init__(self, path: str, schema: StructType):
        known = {c.split()[0]: c.split()[1] for c in CELLS.split(", ")}
        for f in schema:
            if known.get(f.name) != f.dataType.simpleString():
                raise ValueError(f"a workbook has no column {f.name} {f.dataType.simpleString()}; it has {CELLS}")
        self.pattern, self.columns = path, schema.names
        self.wanted: dict[str, set] = {}

    def partitions(self) -> list[InputPartition]:
        store, _ = located(self.pattern)
        out = []
        for path in listed(self.pattern):
            if path not in self.wanted.get("path", {path}):
                continue
            with store.open_input_file(path) as f, zipfile.ZipFile(f) as z:
                out += [SheetPartition(path, i, name, member) for i, name, member in sheets_of(z) if name in self.wanted.get("sheet", {name}) and i in self.wanted.get("sheet_idx", {i})]
        return out

    def read(self, partition: SheetPartition | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no sheet fits
            return
        store, _ = located(self.pattern)
        kinds = pa.schema([("path", pa.string()), ("sheet_idx", pa.int32()), ("sheet", pa.string()), ("row_idx", pa.int32()), ("col_idx", pa.int32()), ("value", pa.string())])
        with store.open_input_file(partition.path) as f, zipfile.ZipFile(f) as z:
            cells = sheet_cells(z, partition.member)
            while lot := list(islice(cells, self.LOT)):
                made = {"path": partition.path, "sheet_idx": partition.sheet_idx, "sheet": partition.sheet}
                columns = [pa.array([made[c]] * len(lot) if c in made else [cell[("row_idx", "col_idx", "value").index(c)] for cell in lot], kinds.field(c).type) for c in self.columns]
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema([kinds.field(c) for c in self.columns]))


class FilteringReader(WorkbookReader):
    """Spark refuses a reader with ``pushFilters`` where its setting is off, so this is a kind of its own."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Equality and membership of path, sheet and sheet_idx are taken whole; others stay Spark's."""
        for f in filters:
            if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 and f.attribute[0] in ("path", "sheet", "sheet_idx"):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                name = f.attribute[0]
                self.wanted[name] = self.wanted.get(name, values) & values
            else:
                yield f
