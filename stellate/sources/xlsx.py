"""Excel workbooks (.xlsx) as a distributed source.

Files are loaded with Spark's ``binaryFile`` source (any Hadoop file
system); each workbook is parsed inside a task with the standard library
(an .xlsx file is a zip of XML parts), one workbook per row.  A first pass
reads only the header rows to fix the output schema: every column is text,
headers normalised (lower case, spaces to ``_``).  A header that a sheet
repeats is numbered (``fee``, ``fee.1``); two that collide only after
normalising are an error.  ``infer=True`` then types the columns that hold
only number cells (bigint or double) with one aggregation, and those that hold
dates and no text as timestamps; a column with a text cell stays text, so
``0042`` keeps its zeros.  A number that its cell's format shows as a date is
read as one (``2024-01-31``, with the time of day where it has one).  Sheets are
read as streams, a row at a time.

Options follow the source jobs: ``sheet`` is the 0-based sheet position
(default 1, the second sheet) and ``header_row`` the 0-based row holding
the column names.  Rows before the header are skipped; empty rows too.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.functions.schema import infer_types, normal_name
from stellate.session import dealt

NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
      "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
      "rel": "http://schemas.openxmlformats.org/package/2006/relationships"}
#: Numbers of the built-in number formats that show dates or times.
DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, *range(27, 37), 45, 46, 47, *range(50, 59)}
#: Rows of a sheet that are handed on at once.
ROWS = 10_000
#: Rows of a workbook that is written (Excel holds 1,048,576 a sheet).
FILE_ROWS = 20_000
_REF = re.compile(r"([A-Z]+)(\d+)")


class _Number(str):
    """Text of a cell that the workbook holds as a number."""


class _Date(str):
    """Text of a cell that the workbook holds as a number shown as a date."""


def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _is_date(code: str) -> bool:
    """Whether a number format shows a date or a time: a y, m, d, h or s outside quotes, escapes and brackets."""
    return bool(re.search("[ymdhs]", re.sub(r'"[^"]*"|\\.|_.|\[[^\]]*\]', "", code.split(";")[0].lower())))


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    """Numbers of the cell styles that show dates."""
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ET.fromstring(z.read("xl/styles.xml"))
    own = {int(f.get("numFmtId")): _is_date(f.get("formatCode")) for f in root.iterfind("m:numFmts/m:numFmt", NS)}
    shown = [int(x.get("numFmtId", 0)) for x in root.iterfind("m:cellXfs/m:xf", NS)]
    return {i for i, n in enumerate(shown) if own.get(n, n in DATE_FORMATS)}


def _as_date(serial: str, epoch: dt.datetime) -> _Date:
    """A serial day number as text; without a time of day where it has none."""
    when = epoch + dt.timedelta(milliseconds=round(float(serial) * 86_400_000))
    return _Date(when.strftime("%Y-%m-%d" if when.time() == dt.time() else "%Y-%m-%d %H:%M:%S"))


def _workbook(content: bytes, sheet: int):
    """(archive, name of the sheet's part, day 0 of its serial dates)."""
    z = zipfile.ZipFile(io.BytesIO(content))
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    rid = list(wb.find("m:sheets", NS))[sheet].get(f"{{{NS['r']}}}id")
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    target = next(r.get("Target") for r in rels if r.get("Id") == rid).lstrip("/")
    pr = wb.find("m:workbookPr", NS)
    late = pr is not None and pr.get("date1904") in ("1", "true")
    return z, target if target.startswith("xl/") else f"xl/{target}", dt.datetime(1904, 1, 1) if late else dt.datetime(1899, 12, 30)


def _shared_strings(z: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in z.namelist():
        return []
    out = []
    with z.open("xl/sharedStrings.xml") as f:
        for _, si in ET.iterparse(f):
            if si.tag == f"{{{NS['m']}}}si":
                out.append("".join(t.text or "" for t in si.iter(f"{{{NS['m']}}}t")))
                si.clear()
    return out


def _sheet_rows(content: bytes, sheet: int):
    """(row number, {column: cell text}) of one sheet, read as a stream: a row at a time is held."""
    z, part, epoch = _workbook(content, sheet)
    shared, dates = _shared_strings(z), _date_styles(z)
    tag = f"{{{NS['m']}}}"
    at = -1
    with z.open(part) as f:
        parents = []
        for event, row in ET.iterparse(f, events=("start", "end")):
            if event == "start":
                if row.tag == tag + "sheetData":
                    parents.append(row)
                continue
            if row.tag != tag + "row":
                continue
            at = int(row.get("r")) - 1 if row.get("r") else at + 1
            cells: dict[int, str | None] = {}
            for j, c in enumerate(row.findall("m:c", NS)):
                ref = c.get("r")
                col = _col_index(_REF.match(ref).group(1)) if ref else j
                t = c.get("t")
                if t == "inlineStr":
                    val = "".join(x.text or "" for x in c.iter(tag + "t"))
                else:
                    v = c.find("m:v", NS)
                    val = None if v is None else v.text
                    if val is not None and t == "s":
                        val = shared[int(val)]
                    elif val is not None and t == "b":
                        val = "True" if val == "1" else "False"
                    elif val is not None and t in (None, "n"):
                        val = _as_date(val, epoch) if int(c.get("s", 0)) in dates else _Number(val)
                cells[col] = val
            yield at, cells
            row.clear()
            for p in parents:
                p.clear()


def _headers(cells: dict[int, str | None], width: int) -> list[str]:
    """Column names of a header row's cells."""
    seen: dict[str, int] = {}
    names = []
    for j in range(width):
        h = cells.get(j)
        raw = f"unnamed:_{j}" if h is None else str(h)
        n = seen.get(raw, 0)
        seen[raw] = n + 1
        names.append(normal_name(f"{raw}.{n}" if n else raw))
    dup = sorted({n for n in names if names.count(n) > 1})
    if dup:
        raise ValueError(f"headers collide after normalising: {dup}")
    return names


def _profile(content: bytes, sheet: int, header_row: int) -> tuple[list[str], list[str], list[str]]:
    """(headers, those of columns with a text cell, with a date): a pass that holds one row."""
    head: dict[int, str | None] = {}
    width, text, dates = 0, set(), set()
    for at, cells in _sheet_rows(content, sheet):
        width = max(width, max(cells, default=-1) + 1)
        if at == header_row:
            head = cells
        elif at > header_row:
            text |= {j for j, v in cells.items() if v and not isinstance(v, (_Number, _Date))}
            dates |= {j for j, v in cells.items() if isinstance(v, _Date)}
    if not head:
        return [], [], []
    names = _headers(head, width)
    return names, [names[j] for j in sorted(text)], [names[j] for j in sorted(dates)]


def _files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
                 .option("recursiveFileLookup", True).load(path).select("path", "content"))


def read_xlsx(spark: SparkSession, path: str, sheet: int = 1, header_row: int = 0,
              glob: str = "*.xlsx", infer: bool = False) -> DataFrame:
    """Rows of one sheet of every workbook under ``path`` (text columns).

    With ``infer`` the columns of number cells are typed from their content
    (``functions.schema.infer_types``: bigint or double).
    """
    files = _files(spark, path, glob)

    def header_pass(batches):
        for pdf in batches:
            found = [_profile(c, sheet, header_row) for c in pdf["content"]]
            yield pd.DataFrame({"path": pdf["path"], **{n: [f[i] for f in found] for i, n in enumerate(("headers", "texts", "dates"))}})

    heads = files.mapInPandas(
        header_pass, "path string, headers array<string>, texts array<string>, dates array<string>").collect()
    columns: list[str] = []
    for h in sorted(heads, key=lambda r: r["path"]):       # one short list per file
        for c in h["headers"]:
            if c not in columns:
                columns.append(c)
    if not columns:
        raise ValueError(f"no header row found in {path}")
    schema = ", ".join(f"`{c}` string" for c in columns)
    headers = {h["path"]: list(h["headers"]) for h in heads}

    def rows_pass(batches):
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                names = headers[path]
                out = []
                for at, cells in _sheet_rows(content, sheet):
                    if at > header_row and any(v not in (None, "") for v in cells.values()):
                        rec = dict.fromkeys(columns)
                        rec.update((names[j], v) for j, v in cells.items())
                        out.append(rec)
                    if len(out) == ROWS:
                        yield pd.DataFrame(out, columns=columns)
                        out = []
                if out:
                    yield pd.DataFrame(out, columns=columns)

    out = files.mapInPandas(rows_pass, schema)
    if not infer:
        return out
    texts = {c for h in heads for c in h["texts"]}
    dates = {c for h in heads for c in h["dates"]} - texts
    typed = infer_types(out, [c for c in columns if c not in texts and c not in dates])
    return typed.withColumns({c: F.col(f"`{c}`").cast("timestamp") for c in dates}) if dates else typed


# ---- fixture writer ------------------------------------------------------------------------

def _esc(s: str) -> str:
    return s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;")


def _letters(j: int) -> str:
    s = ""
    j += 1
    while j:
        j, r = divmod(j - 1, 26)
        s = chr(65 + r) + s
    return s


def _sheet_xml(rows: list[list]) -> str:
    out = []
    for i, row in enumerate(rows):
        cells = []
        for j, v in enumerate(row):
            ref = f"{_letters(j)}{i + 1}"
            if v is None or (isinstance(v, float) and pd.isna(v)):
                continue
            if isinstance(v, (int, float)) and not isinstance(v, bool):
                cells.append(f'<c r="{ref}"><v>{v!r}</v></c>')
            else:
                cells.append(f'<c r="{ref}" t="inlineStr"><is><t>{_esc(str(v))}</t></is></c>')
        out.append(f'<row r="{i + 1}">{"".join(cells)}</row>')
    return (f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{NS["m"]}">'
            f'<sheetData>{"".join(out)}</sheetData></worksheet>')


def workbook_bytes(sheets: list[tuple[str, list[list]]]) -> bytes:
    """A minimal .xlsx with the given (name, rows) sheets."""
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml",
                   '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/'
                   'package/2006/content-types"><Default Extension="xml" ContentType="application/xml"/>'
                   '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.'
                   'relationships+xml"/></Types>')
        z.writestr("xl/workbook.xml",
                   f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{NS["m"]}" xmlns:r="{NS["r"]}">'
                   "<sheets>" + "".join(f'<sheet name="{_esc(n)}" sheetId="{i + 1}" r:id="rId{i + 1}"/>'
                                        for i, (n, _) in enumerate(sheets)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels",
                   f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{NS["rel"]}">' +
                   "".join(f'<Relationship Id="rId{i + 1}" Type="http://schemas.openxmlformats.org/'
                           f'officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{i + 1}.xml"/>'
                           for i in range(len(sheets))) + "</Relationships>")
        for i, (_, rows) in enumerate(sheets):
            z.writestr(f"xl/worksheets/sheet{i + 1}.xml", _sheet_xml(rows))
    return buf.getvalue()


def write_xlsx(df: DataFrame, path: str, header_row: int = 0, sheet: int = 1) -> None:
    """Workbooks of at most ``FILE_ROWS`` rows under a local or mounted folder ``path``.

    The data goes to sheet ``sheet`` (earlier sheets hold a note), after
    ``header_row`` filler rows.  Python file IO: the folder must be visible
    to the executors (local mode, or a mounted shared file system).
    """
    import os
    import uuid
    local = path[5:] if path.startswith("file:") else path
    os.makedirs(local, exist_ok=True)
    cols = df.columns

    def put(rows):
        filler = [[f"note {i}"] for i in range(header_row)]
        sheets = [(f"Notes{i}", [["generated"]]) for i in range(sheet)] + [("Data", [*filler, list(cols), *rows])]
        name = os.path.join(local, f"part-{uuid.uuid4().hex}.xlsx")
        with open(name, "wb") as f:
            f.write(workbook_bytes(sheets))
        return pd.DataFrame({"file": [name], "rows": [len(rows)]})

    def write(batches):
        rows = []
        for pdf in batches:
            rows.extend(pdf.astype(object).where(pdf.notna(), None).values.tolist())
            while len(rows) > FILE_ROWS:
                yield put(rows[:FILE_ROWS])
                rows = rows[FILE_ROWS:]
        if rows:
            yield put(rows)

    dealt(df, FILE_ROWS).mapInPandas(write, "file string, rows long").collect()
