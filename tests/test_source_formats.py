"""Dates of workbooks, CSV files matched by name, and inputs that must fail instead of losing rows."""

import io
import os
import zipfile

import pytest

from conftest import rows
from stellate.session import scratch_dir
from stellate.sources.files import read_csv_by_name
from stellate.sources.geo_text import read_kml
from stellate.sources.xlsx import NS, _is_date, read_xlsx, workbook_bytes


def folder(spark, name, **files):
    path = scratch_dir(spark, name)
    local = path[5:] if path.startswith("file:") else path
    for file, content in files.items():
        full = os.path.join(local, file.replace("__", "."))
        os.makedirs(os.path.dirname(full), exist_ok=True)
        with open(full, "wb") as f:
            f.write(content if isinstance(content, bytes) else content.encode())
    return path


def styled(sheet_rows, formats, date1904=False):
    """A workbook with one sheet, its cells' styles 1, 2, ... showing ``formats`` (numbers of built-in ones, or codes)."""
    plain = zipfile.ZipFile(io.BytesIO(workbook_bytes([("Data", [["x"]])])))
    own = "".join(f'<numFmt numFmtId="{200 + i}" formatCode="{c.replace(chr(34), "&quot;")}"/>' for i, c in enumerate(formats) if isinstance(c, str))
    xfs = "".join(f'<xf numFmtId="{c if isinstance(c, int) else 200 + i}"/>' for i, c in enumerate(formats))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for n in plain.namelist():
            text = plain.read(n).decode()
            if n == "xl/workbook.xml" and date1904:
                text = text.replace("<sheets>", '<workbookPr date1904="1"/><sheets>')
            if n == "xl/worksheets/sheet1.xml":
                text = f'<worksheet xmlns="{NS["m"]}"><sheetData>{sheet_rows}</sheetData></worksheet>'
            z.writestr(n, text)
        z.writestr("xl/styles.xml", f'<styleSheet xmlns="{NS["m"]}"><numFmts>{own}</numFmts><cellXfs><xf numFmtId="0"/>{xfs}</cellXfs></styleSheet>')
    return out.getvalue()


HEAD = '<row r="1">' + "".join(f'<c t="inlineStr"><is><t>{h}</t></is></c>' for h in ("Day", "At", "Money", "Id")) + "</row>"
BODY = ('<row r="2"><c r="A2" s="1"><v>45322</v></c><c r="B2" s="2"><v>45322.75</v></c><c r="C2" s="3"><v>12.5</v></c><c r="D2"><v>7</v></c></row>'
        '<row r="4"><c r="A4" s="1"><v>1</v></c><c r="C4" s="3"><v>3</v></c></row>'
        '<row r="5"><c r="B5" s="2"><v>60.5</v></c><c r="D5"><v>8</v></c></row>')
FORMATS = [14, "yyyy\\-mm\\-dd hh:mm", '#,##0.00 "days"']


def test_workbook_dates_and_blanks(spark):
    path = folder(spark, "dates", book__xlsx=styled(HEAD + BODY, FORMATS))
    df = read_xlsx(spark, path, sheet=0)
    assert rows(df) == [(None, "1900-02-28 12:00:00", None, "8"), ("1899-12-31", None, "3", None),
                        ("2024-01-31", "2024-01-31 18:00:00", "12.5", "7")]
    typed = read_xlsx(spark, path, sheet=0, infer=True)
    assert [t for _, t in typed.dtypes] == ["timestamp", "timestamp", "double", "bigint"]
    assert str(typed.where("id = 7").first().at) == "2024-01-31 18:00:00"
    late = folder(spark, "dates1904", book__xlsx=styled(HEAD + BODY, FORMATS, date1904=True))
    assert read_xlsx(spark, late, sheet=0).where("id = '7'").first().day == "2028-02-01"


def test_date_formats():
    for code in ("d/m/yy", "[$-409]mmm-yy;@", "h:mm AM/PM", "[h]:mm:ss", 'yyyy"y"', "ss.0"):
        assert _is_date(code), code
    for code in ("General", "0.00", '#,##0 "days"', "0%", "[Red]0.0", "\\d0", "_d0", "0;d"):
        assert not _is_date(code), code


def test_csv_files_are_matched_by_name(spark):
    path = folder(spark, "named", **{"one__csv": "a,b\n1,2\n3,4\n", "two__csv": "b,a\n5,6\n", "deep/three__csv": 'C c,a,b\n7,8,"9,"\n',
                                     "four__csv": "a,b\n", "five__csv": "b,a\n10,11\n"})
    got = rows(read_csv_by_name(spark, path).select("a", "b", "c_c"))
    assert got == sorted([("1", "2", None), ("3", "4", None), ("6", "5", None), ("8", "9,", "7"), ("11", "10", None)], key=str)
    with pytest.raises(ValueError, match="repeated"):
        read_csv_by_name(spark, folder(spark, "twice", x__csv="a,A\n1,2\n"))
    with pytest.raises(FileNotFoundError):
        read_csv_by_name(spark, folder(spark, "none", x__txt="a\n"))


def test_a_placemark_without_a_polygon_fails(spark):
    kml = "<kml><Document><Placemark><name>p</name><Point><coordinates>1,2</coordinates></Point></Placemark></Document></kml>"
    with pytest.raises(Exception, match="no polygon in Placemark p"):
        read_kml(spark, folder(spark, "points", x__kml=kml)).collect()


def test_a_dbf_that_does_not_fit_its_shapes_fails(spark):
    from stellate.operators.geometry import GEOM_TYPE
    from stellate.sources.shapefile import read_shapefile, write_shapefile
    square = [[[[0.0, 0.0], [0.0, 1.0], [1.0, 1.0], [1.0, 0.0], [0.0, 0.0]]]]
    path = scratch_dir(spark, "short")
    write_shapefile(spark.createDataFrame([("a", square), ("b", square)], f"NAME string, geometry {GEOM_TYPE}").coalesce(1), path)
    local = path[5:] if path.startswith("file:") else path
    dbf = next(os.path.join(local, f) for f in os.listdir(local) if f.endswith(".dbf"))
    with open(dbf, "rb") as f:
        whole = f.read()
    assert read_shapefile(spark, path).count() == 2
    with open(dbf, "wb") as f:
        f.write(whole[:4] + (1).to_bytes(4, "little") + whole[8:])
    with pytest.raises(Exception, match="zip"):
        read_shapefile(spark, path).collect()
    with open(dbf, "wb") as f:
        f.write(whole.replace(b"a", b"\xe9"))
    with pytest.raises(Exception, match="utf-8|codec"):
        read_shapefile(spark, path).collect()


def test_a_partition_is_written_as_several_shapefiles(spark, monkeypatch):
    from stellate.operators.geometry import GEOM_TYPE
    from stellate.sources import shapefile
    monkeypatch.setattr(shapefile, "FILE_ROWS", 20)
    monkeypatch.setattr(shapefile, "ROWS", 7)
    square = [[[[0.0, 0.0], [0.0, 1.0], [1.0, 1.0], [1.0, 0.0], [0.0, 0.0]]]]
    given = [(f"n{i}", None if i % 9 == 0 else square) for i in range(90)]
    path = scratch_dir(spark, "several-shp")
    shapefile.write_shapefile(spark.createDataFrame(given, f"NAME string, geometry {GEOM_TYPE}").coalesce(1), path)
    names = [f for f in os.listdir(path.removeprefix("file:")) if f.endswith(".shp")]
    assert len(names) >= 5
    got = shapefile.read_shapefile(spark, path).collect()
    assert sorted((r.NAME, r.geometry) for r in got if r.geometry) == sorted(x for x in given if x[1])
    assert len(got) == 90


def test_a_partition_is_written_as_several_workbooks(spark, monkeypatch):
    from stellate.sources import xlsx
    monkeypatch.setattr(xlsx, "FILE_ROWS", 20)
    given = [(str(i), f"name {i}") for i in range(90)]
    path = scratch_dir(spark, "several-xlsx")
    xlsx.write_xlsx(spark.createDataFrame(given, "`Cust Key` string, name string").coalesce(1), path, header_row=2)
    assert len(os.listdir(path.removeprefix("file:"))) >= 5
    assert rows(read_xlsx(spark, path, header_row=2)) == sorted(given)
