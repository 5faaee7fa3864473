"""Workbooks of a landed folder, unpacked in parallel over the files."""

import datetime as dt
import functools
import io
import itertools
import logging
import re
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from xml.etree import ElementTree

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import strata
from strata.fixed_values import LONGEST_TABLE_NAME, NULL_CELLS, WORKBOOK_TYPES
from strata.functions.names import UNIT_SEPARATOR, header_names, table_name
from strata.sources.records import SourceRecord

log = logging.getLogger(__name__)

ROWS_PER_BATCH = 4096
HEADER_SCHEMA = (
    "path string, modified_at timestamp, position int, sheet_name string, "
    "header array<string>, error string"
)
CELL_SCHEMA = "path string, sheet_name string, row_index bigint, cells array<string>"

# Built-in number formats that show a date or time.
DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}


# The unpacking travels with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(strata)


# Inside the tasks: one workbook at a time, its rows as a stream.

Value = bool | int | float | str | dt.datetime | dt.time | None


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _children(node: ElementTree.Element, name: str) -> Iterator[ElementTree.Element]:
    return (child for child in node.iter() if _local(child.tag) == name)


class _Workbook:
    def __init__(self, content: bytes):
        self.zip = zipfile.ZipFile(io.BytesIO(content))
        book = self._xml("xl/workbook.xml")
        targets = {r.get("Id"): r.get("Target") for r in self._xml("xl/_rels/workbook.xml.rels")}
        self.sheets = {}
        for sheet in _children(book, "sheet"):
            link = next(v for k, v in sheet.attrib.items() if _local(k) == "id" and k != "id")
            target = targets[link]
            member = target[1:] if target.startswith("/") else f"xl/{target}"
            self.sheets[sheet.get("name")] = member
        from_1904 = any(p.get("date1904") in ("1", "true") for p in _children(book, "workbookPr"))
        self.day_zero = dt.datetime(1904, 1, 1) if from_1904 else dt.datetime(1899, 12, 30)
        self.date_styles = self._date_styles()
        self.texts = self._shared_texts()

    def _xml(self, member: str) -> ElementTree.Element:
        with self.zip.open(member) as part:
            return ElementTree.parse(part).getroot()

    def _date_styles(self) -> set[int]:
        if "xl/styles.xml" not in self.zip.namelist():
            return set()
        root = self._xml("xl/styles.xml")
        dates = set(DATE_FORMATS)
        for f in _children(root, "numFmt"):
            shown = f.get("formatCode", "").split(";")[0]
            if re.search("[dmyhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.|_.', "", shown).lower()):
                dates.add(int(f.get("numFmtId")))
        formats = next(_children(root, "cellXfs"), ())
        return {i for i, f in enumerate(formats) if int(f.get("numFmtId", 0)) in dates}

    def _shared_texts(self) -> list[str]:
        texts: list[str] = []
        if "xl/sharedStrings.xml" in self.zip.namelist():
            with self.zip.open("xl/sharedStrings.xml") as part:
                for _, node in ElementTree.iterparse(part):
                    if _local(node.tag) == "si":
                        texts.append(_rich_text(node))
                        node.clear()
        return texts

    def _date(self, serial: float) -> dt.datetime | dt.time:
        moment = self.day_zero + dt.timedelta(milliseconds=round(serial * 86_400_000))
        return moment.time() if 0 <= serial < 1 else moment

    def _value(self, cell: ElementTree.Element) -> Value:
        kind = cell.get("t", "n")
        if kind == "inlineStr":
            return _rich_text(cell) or None
        raw = next((c.text for c in cell if _local(c.tag) == "v"), None)
        if not raw:
            return None
        if kind == "s":
            return self.texts[int(raw)] or None
        if kind == "b":
            return raw.strip() == "1"
        if kind != "n":
            return raw
        if int(cell.get("s", 0)) in self.date_styles:
            return self._date(float(raw))
        if raw.lstrip("-").isdigit():
            return int(raw)
        value = float(raw)
        return int(value) if value.is_integer() else value

    def rows(self, sheet: str) -> Iterator[tuple[int, list[Value]]]:
        """Row number from 0 and values up to the last filled cell."""
        number = -1
        with self.zip.open(self.sheets[sheet]) as part:
            for _, node in ElementTree.iterparse(part):
                if _local(node.tag) != "row":
                    continue
                number = int(node.get("r", number + 2)) - 1
                values: list[Value] = []
                for cell in node:
                    place = _column_index(cell.get("r")) if cell.get("r") else len(values)
                    values.extend([None] * (place - len(values)))
                    values.append(self._value(cell))
                while values and values[-1] is None:
                    values.pop()
                yield number, values
                node.clear()

    def header(self, sheet: str, header_row: int) -> list[str | None]:
        """Header cells, filled up to the widest row below."""
        header: list[str | None] = []
        for number, values in self.rows(sheet):
            if number == header_row:
                header = [None if v is None else str(v) for v in values] + header
            if number >= header_row:
                header += [None] * (len(values) - len(header))
        return header


def _text(value: Value) -> str | None:
    if isinstance(value, dt.datetime):
        return value.strftime("%Y-%m-%d %H:%M:%S" if value.time() != dt.time() else "%Y-%m-%d")
    return None if value is None or value in NULL_CELLS else str(value)


def _rich_text(node: ElementTree.Element) -> str:
    phonetic = {id(t) for run in _children(node, "rPh") for t in _children(run, "t")}
    return "".join(t.text or "" for t in _children(node, "t") if id(t) not in phonetic)


def _column_index(reference: str) -> int:
    index = 0
    for letter in reference:
        if not letter.isalpha():
            break
        index = index * 26 + ord(letter.upper()) - ord("A") + 1
    return index - 1


def _files(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, dt.datetime, bytes]]:
    for batch in batches:
        for row in zip(*batch.columns, strict=True):
            yield tuple(value.as_py() for value in row)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    arrays = [
        pa.array([row[i] for row in rows], kind.type) for i, kind in enumerate(schema)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _headers(header_row: int):
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("path", pa.string()),
                ("modified_at", pa.timestamp("us", "UTC")),
                ("position", pa.int32()),
                ("sheet_name", pa.string()),
                ("header", pa.list_(pa.string())),
                ("error", pa.string()),
            ]
        )
        for path, modified_at, content in _files(batches):
            try:
                book = _Workbook(content)
                found = [
                    (path, modified_at, position, sheet, book.header(sheet, header_row), None)
                    for position, sheet in enumerate(book.sheets)
                ]
            except Exception as error:
                reason = f"{type(error).__name__}: {error}"
                found = [(path, modified_at, None, None, None, reason)]
            yield _batch(found, schema)

    return unpack


def _cells(sheet_name: str | None, header_row: int):
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("path", pa.string()),
                ("sheet_name", pa.string()),
                ("row_index", pa.int64()),
                ("cells", pa.list_(pa.string())),
            ]
        )
        for path, _, content in _files(batches):
            book = _Workbook(content)
            for sheet in book.sheets if sheet_name is None else [sheet_name]:
                below = (r for r in book.rows(sheet) if r[0] > header_row)
                while part := list(itertools.islice(below, ROWS_PER_BATCH)):
                    rows = [(path, sheet, n, [_text(v) for v in values]) for n, values in part]
                    yield _batch(rows, schema)

    return unpack


# On the driver: lazy tables.


def _literal_path(path: str) -> str:
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _file_name() -> Column:
    return F.element_at(F.split("path", "/"), -1)


def list_workbooks(spark: SparkSession, folder: str) -> DataFrame:
    """Workbook files of a folder, newest first; contents are not read."""
    extension = F.lower(F.element_at(F.split("path", r"\."), -1))
    types = F.create_map(*[F.lit(t) for pair in WORKBOOK_TYPES.items() for t in pair])
    return (
        spark.read.format("binaryFile")
        .load(folder)
        .select(
            F.col("path").alias("id"),
            _file_name().alias("name"),
            types[extension].alias("mime_type"),
            F.col("modificationTime").alias("modified_at"),
            F.col("length").alias("size"),
        )
        .where(F.col("mime_type").isNotNull())
        .orderBy(F.desc("modified_at"), "name")
    )


FILE_COLUMNS = ["path", "modificationTime", "content"]


def sheet_headers(files: DataFrame, header_row: int = 0) -> DataFrame:
    """One row per sheet with its header cells; a broken file is one row with the
    error. ``files`` has the columns of the ``binaryFile`` reader."""
    return files.select(*FILE_COLUMNS).mapInArrow(_headers(header_row), HEADER_SCHEMA)


def sheet_cells(files: DataFrame, sheet_name: str | None = None, header_row: int = 0) -> DataFrame:
    """Rows below the header as arrays of text, of one or of all sheets."""
    return files.select(*FILE_COLUMNS).mapInArrow(_cells(sheet_name, header_row), CELL_SCHEMA)


def with_columns(cells: DataFrame, header: Sequence[str | None]) -> DataFrame:
    """Rows of one sheet under its headers."""
    return cells.select(
        *[F.get("cells", F.lit(i)).alias(name) for i, name in enumerate(header_names(header))]
    )


def filter_units(
    units: DataFrame, file_filter: str | None = None, sheet_filter: Sequence[str] = ()
) -> DataFrame:
    """Units whose ``file_name`` contains ``file_filter`` and whose ``sheet_name``,
    in lower case and with ``_`` for blanks, contains one of ``sheet_filter``.
    Units without a sheet, which are broken files, stay to be reported."""
    if file_filter:
        units = units.where(F.col("file_name").contains(file_filter))
    if sheet_filter:
        sheet = F.replace(F.lower("sheet_name"), F.lit(" "), F.lit("_"))
        wanted = F.col("sheet_name").isNull()
        for text in sheet_filter:
            wanted = wanted | sheet.contains(text.lower())
        units = units.where(wanted)
    return units


def name_tables(units: DataFrame) -> DataFrame:
    """Add ``table_name``. Of units whose names would be equal, as long ones are cut, the
    first by file and sheet has the plain name, the others end in a hash of both."""
    named = units.withColumn("table_name", table_name(F.col("file_name"), F.col("sheet_name")))
    own = F.struct("file_name", "sheet_name")
    first = named.groupBy("table_name").agg(F.min(own).alias("_first"))
    digest = F.substring(F.md5(F.concat_ws("\n", "file_name", "sheet_name")), 1, 8)
    marked = F.concat_ws(
        "_", F.substring("table_name", 1, LONGEST_TABLE_NAME - 9), digest
    )
    return (
        named.join(first, "table_name", "left")
        .withColumn("table_name", F.when(own != F.col("_first"), marked).otherwise(F.col("table_name")))
        .select(*units.columns, "table_name")
    )


def _open(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(_literal_path(path))


def _sheet(
    spark: SparkSession, path: str, sheet_name: str, header: Sequence[str | None]
) -> DataFrame:
    return with_columns(sheet_cells(_open(spark, path), sheet_name), header)


def read_workbook(
    spark: SparkSession,
    path: str,
    sheet_name: str | int | None = 0,
    header_row: int = 0,
    dtype: dict[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Sheets of one workbook by name: one by position or name, or all for None.
    A sheet asked for by position is called ``Sheet1``. ``dtype`` casts columns."""
    file = _open(spark, path)
    headers = sheet_headers(file, header_row).orderBy("position").collect()
    broken = next((h.error for h in headers if h.error), None)
    if broken:
        raise ValueError(f"{path}: {broken}")
    if isinstance(sheet_name, int):
        chosen = {"Sheet1": headers[sheet_name]}
    elif sheet_name is None:
        chosen = {h.sheet_name: h for h in headers}
    else:
        chosen = {h.sheet_name: h for h in headers if h.sheet_name == sheet_name}
        if not chosen:
            raise ValueError(f"{path} has no sheet {sheet_name!r}")
    sheets = {}
    for name, h in chosen.items():
        df = with_columns(sheet_cells(file, h.sheet_name, header_row), h.header)
        casts = {c: F.col(f"`{c}`").cast(t) for c, t in (dtype or {}).items()}
        sheets[name] = df.withColumns(casts)
    return sheets


@dataclass(frozen=True)
class WorkbookFolder:
    """Sheets of the workbooks in a landed folder, newest file first."""

    spark: SparkSession
    folder: str
    file_filter: str | None = None
    sheet_filter: Sequence[str] = ()
    source_type: str = "workbook_folder"

    def extract(self) -> Iterator[SourceRecord]:
        files = self.spark.read.format("binaryFile").load(self.folder)
        files = files.where(F.col("path").rlike(rf"(?i)\.({'|'.join(WORKBOOK_TYPES)})$"))
        if self.file_filter:
            # Before the contents are read.
            files = files.where(_file_name().contains(self.file_filter))
        sheets = sheet_headers(files).withColumn("file_name", _file_name())
        units = name_tables(filter_units(sheets, sheet_filter=self.sheet_filter))
        found = 0
        # One row per sheet, names and headers only.
        for unit in units.orderBy(F.desc("modified_at"), "path", "position").toLocalIterator():
            found += 1
            if unit.error:
                log.error("%s skipped: %s", unit.file_name, unit.error)
                continue
            yield SourceRecord(
                df=functools.partial(_sheet, self.spark, unit.path, unit.sheet_name, unit.header),
                source_name=f"{unit.file_name}{UNIT_SEPARATOR}{unit.sheet_name}",
                table_name=unit.table_name,
                source_id=unit.path,
                modified_at=unit.modified_at,
            )
        if not found:
            log.warning("no workbook sheet in %s fits the filters", self.folder)
