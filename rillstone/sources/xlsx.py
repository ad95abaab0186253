"""Workbooks without further libraries: a data source for sheets, and a writer with headers coloured by class.

    spark.dataSource.register(XlsxSource)
    spark.read.format("xlsx").option("sheet", "PROYECTOS").load(path)

All columns are text; a sheet is one partition, since its XML is one stream.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from rillstone.storage import write_bytes

_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _column(ref: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def read_rows(path: str, sheet: str | None = None) -> Iterator[list[str | None]]:
    """Rows of a sheet (the first, without a name) as texts."""
    with zipfile.ZipFile(path) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{_NS}t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_NS}si")]
        sheets = {s.get("name"): s.get(_REL) for s in ET.fromstring(z.read("xl/workbook.xml")).iter(f"{_NS}sheet")}
        if sheet is not None and sheet not in sheets:
            raise ValueError(f"no sheet {sheet!r}; there are {', '.join(sheets)}")
        wanted = sheets[sheet] if sheet is not None else next(iter(sheets.values()))
        target = next(r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels")) if r.get("Id") == wanted)
        with z.open(target.lstrip("/") if target.startswith("/") else f"xl/{target}") as f:
            for _, row in ET.iterparse(f):
                if row.tag != f"{_NS}row":
                    continue
                out: list[str | None] = []
                for k, c in enumerate(row.iter(f"{_NS}c")):
                    at = _column(c.get("r")) if c.get("r") else k
                    out += [None] * (at + 1 - len(out))
                    v = c.find(f"{_NS}v")
                    if c.get("t") == "inlineStr":
                        out[at] = "".join(t.text or "" for t in c.iter(f"{_NS}t"))
                    elif v is not None:
                        out[at] = shared[int(v.text)] if c.get("t") == "s" else v.text
                row.clear()
                yield out


def sheet_names(path: str) -> list[str]:
    """Names of a workbook's sheets in order."""
    with zipfile.ZipFile(path) as z:
        return [s.get("name") for s in ET.fromstring(z.read("xl/workbook.xml")).iter(f"{_NS}sheet")]


class _Reader(DataSourceReader):
    def __init__(self, path: str, sheet: str | None, width: int) -> None:
        self.path, self.sheet, self.width = path, sheet, width

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        rows = read_rows(self.path, self.sheet)
        next(rows, None)
        for k, r in enumerate(rows):
            yield (k, *(r + [None] * self.width)[: self.width])


class XlsxSource(DataSource):
    """Format 'xlsx' with the option ``sheet``; the column ``row_index`` keeps the sheet's order."""

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def _header(self) -> list[str]:
        names = [h or f"column_{k}" for k, h in enumerate(next(read_rows(self.options["path"], self.options.get("sheet")), []))]
        return [f"{n}_{k}" if n in names[:k] else n for k, n in enumerate(names)]

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField("row_index", T.LongType()), *(T.StructField(h, T.StringType()) for h in self._header())])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(self.options["path"], self.options.get("sheet"), len(schema.fields) - 1)


#: Header fill, font colour and legend by column class.
STYLES = {
    "proyecto": ("1F4E79", "FFFFFF", "Proyecto"), "vri": ("C55A11", "FFFFFF", "Resultado declarado"), "matching": ("7F7F7F", "FFFFFF", "Enlace calculado"),
    "openalex": ("548235", "FFFFFF", "Enriquecimiento"), "resumenes": ("7030A0", "FFFFFF", "Resumenes y palabras clave"), "otro": ("404040", "FFFFFF", "Otra fuente"),
}


def column_widths(df: DataFrame, sample: int = 200) -> DataFrame:
    """``column, width``: that of the header or of the longest text in a sample of rows plus 2, within 10 and 60."""
    longest = df.limit(sample).agg(*(F.coalesce(F.max(F.length(F.col(f"`{c}`").cast("string"))), F.lit(0)).alias(f"c{k}") for k, c in enumerate(df.columns)))
    rows = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.least(F.lit(60), F.greatest(F.lit(10), F.lit(len(c) + 2), F.col(f"c{k}") + 2)).alias("width")) for k, c in enumerate(df.columns)))).alias("x")
    return longest.select(rows).select("x.*")


def _cells(values: list, row: int, style: list[int] | None = None) -> str:
    def ref(k: int) -> str:
        name, k = "", k + 1
        while k:
            k, r = divmod(k - 1, 26)
            name = chr(65 + r) + name
        return f"{name}{row}"

    out = []
    for k, v in enumerate(values):
        s = f' s="{style[k]}"' if style else ""
        if v is None:
            continue
        if isinstance(v, bool) or not isinstance(v, (int, float)):
            out.append(f'<c r="{ref(k)}" t="inlineStr"{s}><is><t xml:space="preserve">{escape(str(v))}</t></is></c>')
        else:
            out.append(f'<c r="{ref(k)}"{s}><v>{v}</v></c>')
    return f'<row r="{row}">{"".join(out)}</row>'


def write_styled(df: DataFrame, path: str, classes: dict[str, str], title: str = "Datos", most: int = 100_000) -> None:
    """A workbook with headers coloured by class, a frozen filterable header, fitted widths and a legend sheet.

    A workbook is a report: more than ``most`` rows raise a ValueError instead of being cut.
    """
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows do not belong in a workbook")
    widths = {r["column"]: r["width"] for r in column_widths(df).collect()}
    kinds = list(STYLES)
    head = [kinds.index(classes.get(c, "otro")) + 1 for c in df.columns]
    cols = "".join(f'<col min="{k + 1}" max="{k + 1}" width="{widths[c]}" customWidth="1"/>' for k, c in enumerate(df.columns))
    ns = f'xmlns="{_NS[1:-1]}"'
    last = _cells([0] * len(df.columns), max(1, len(rows) + 1)).rsplit('r="', 1)[1].split('"', 1)[0] if df.columns else "A1"
    data = _cells(df.columns, 1, head) + "".join(_cells([v.asDict() if hasattr(v, "asDict") else v for v in r], k + 2) for k, r in enumerate(rows))
    pane = '<sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" state="frozen"/></sheetView></sheetViews>'
    legend = "".join(_cells([k, STYLES[k][2]], i + 1, [i + 1, 0]) for i, k in enumerate(kinds))
    fonts = "".join(f'<font><b/><color rgb="FF{f}"/></font>' for _, f, _ in STYLES.values())
    fills = "".join(f'<fill><patternFill patternType="solid"><fgColor rgb="FF{c}"/></patternFill></fill>' for c, _, _ in STYLES.values())
    xfs = "".join(f'<xf fontId="{k + 1}" fillId="{k + 2}" applyFill="1" applyFont="1"/>' for k in range(len(kinds)))
    office = "http://schemas.openxmlformats.org"
    files = {
        "[Content_Types].xml": f'<Types xmlns="{office}/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
        + "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for k in (1, 2))
        + '<Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{office}/package/2006/relationships"><Relationship Id="r1" Type="{office}/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook {ns} xmlns:r="{office}/officeDocument/2006/relationships"><sheets><sheet name="{escape(title[:31])}" sheetId="1" r:id="r1"/><sheet name="Leyenda" sheetId="2" r:id="r2"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{office}/package/2006/relationships">'
        + "".join(f'<Relationship Id="r{k}" Type="{office}/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in (1, 2))
        + f'<Relationship Id="r3" Type="{office}/officeDocument/2006/relationships/styles" Target="styles.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet {ns}><fonts><font/>{fonts}</fonts><fills><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill>{fills}</fills><borders><border/></borders><cellStyleXfs><xf/></cellStyleXfs><cellXfs><xf/>{xfs}</cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": f'<worksheet {ns}>{pane}<cols>{cols}</cols><sheetData>{data}</sheetData><autoFilter ref="A1:{last}"/></worksheet>',
        "xl/worksheets/sheet2.xml": f"<worksheet {ns}><sheetData>{legend}</sheetData></worksheet>",
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in files.items():
            z.writestr(name, '<?xml version="1.0" encoding="UTF-8"?>' + text)
    write_bytes(df.sparkSession, path, out.getvalue())
