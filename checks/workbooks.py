"""Small xlsx files, for trying the workbook source."""

import datetime as dt
import io
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

import checks

cloudpickle.register_pickle_by_value(checks)

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
DOCUMENT = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"
STYLES = (
    f'<styleSheet xmlns="{MAIN}"><numFmts count="1">'
    '<numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd\\ hh:mm"/></numFmts>'
    '<cellXfs count="3"><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/></cellXfs>'
    "</styleSheet>"
)


def _letters(index: int) -> str:
    letters = ""
    index += 1
    while index:
        index, rest = divmod(index - 1, 26)
        letters = chr(ord("A") + rest) + letters
    return letters


def _cell(reference: str, value: object, texts: dict[str, int]) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{reference}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, dt.datetime):
        serial = (value - dt.datetime(1899, 12, 30)) / dt.timedelta(days=1)
        style = 1 if serial == int(serial) else 2
        return f'<c r="{reference}" s="{style}"><v>{serial!r}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{reference}"><v>{value!r}</v></c>'
    place = texts.setdefault(str(value), len(texts))
    return f'<c r="{reference}" t="s"><v>{place}</v></c>'


def workbook(sheets: dict[str, list[list]]) -> bytes:
    texts: dict[str, int] = {}
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as book:
        names, links = "", ""
        for n, (name, rows) in enumerate(sheets.items(), 1):
            body = "".join(
                f'<row r="{r}">'
                + "".join(_cell(f"{_letters(c)}{r}", v, texts) for c, v in enumerate(row))
                + "</row>"
                for r, row in enumerate(rows, 1)
            )
            book.writestr(
                f"xl/worksheets/sheet{n}.xml",
                f'<worksheet xmlns="{MAIN}"><sheetData>{body}</sheetData></worksheet>',
            )
            names += f'<sheet name={quoteattr(name)} sheetId="{n}" r:id="rId{n}"/>'
            links += (
                f'<Relationship Id="rId{n}" Type="{DOCUMENT}/worksheet" '
                f'Target="worksheets/sheet{n}.xml"/>'
            )
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{MAIN}" xmlns:r="{DOCUMENT}"><sheets>{names}</sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{PACKAGE}">{links}</Relationships>'
        )
        book.writestr("xl/styles.xml", STYLES)
        items = "".join(f"<si><t>{escape(t)}</t></si>" for t in texts)
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">{items}</sst>')
    return buffer.getvalue()


def packed(df: DataFrame, sheet: str) -> DataFrame:
    """Rows as workbooks, one per Arrow batch, in the columns of ``binaryFile``."""
    names = df.columns

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [list(r) for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            content = workbook({"Notas": [["nota"], ["-"]], sheet: [names, *rows]})
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f"ventas {rows[0][0]}.xlsx"]),
                    pa.array([dt.datetime(2024, 1, 1, tzinfo=dt.UTC)], pa.timestamp("us", "UTC")),
                    pa.array([content], pa.binary()),
                ],
                names=["path", "modificationTime", "content"],
            )

    return df.mapInArrow(pack, "path string, modificationTime timestamp, content binary")
