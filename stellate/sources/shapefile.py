"""ESRI shapefiles (.shp geometry + .dbf attributes) as a distributed source.

Both parts are loaded with ``binaryFile`` and paired by their path without
extension (a join, not a driver loop); each pair is decoded inside a task
with ``struct``.  Attributes come out as text (trimmed), geometry in the
``GEOM_TYPE`` layout with ring order and orientation as stored (shells
clockwise, holes counter-clockwise, per the format).  A hole goes to the
smallest shell around it, whatever the order of the rings; one that no shell
holds becomes a shell.  Polygon, PolygonZ and PolygonM records are read; a
null shape gives a null geometry, any other kind fails, as does a .shp
without its .dbf.  Records are decoded one by one and handed on in blocks, so a
task holds its files' bytes and one block of rows.
"""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.operators.geometry import GEOM_TYPE
from stellate.session import dealt

POLYGON_TYPES = (5, 15, 25)
#: Rows that are handed on at once, and shapes in a file that is written.
ROWS = 2_000
FILE_ROWS = 20_000


def _ring_area2(pts: np.ndarray) -> float:
    x, y = pts[:, 0], pts[:, 1]
    return float(np.sum(x[:-1] * y[1:] - x[1:] * y[:-1]))


def _holds(shell: np.ndarray, ring: np.ndarray) -> bool:
    """Whether most vertices and edge midpoints of ``ring`` lie inside ``shell`` (they may touch)."""
    p = np.vstack([ring[:-1], (ring[:-1] + ring[1:]) / 2])
    inside = np.zeros(len(p), bool)
    for (x1, y1), (x2, y2) in zip(shell[:-1], shell[1:]):
        crosses = (y1 > p[:, 1]) != (y2 > p[:, 1])
        if crosses.any():
            inside[crosses] ^= p[crosses, 0] < x1 + (p[crosses, 1] - y1) * (x2 - x1) / (y2 - y1)
    return 2 * int(inside.sum()) > len(p)


def _polygons(rings: list[np.ndarray]) -> list:
    areas = [_ring_area2(r) for r in rings]
    shells = [i for i, a in enumerate(areas) if a <= 0]
    polys = {i: [rings[i].tolist()] for i in shells}
    for i, ring in enumerate(rings):
        if i in polys:
            continue
        around = [s for s in shells if _holds(rings[s], ring)]
        if around:
            polys[min(around, key=lambda s: -areas[s])].append(ring.tolist())
        else:
            polys[i] = [ring.tolist()]
    return [polys[i] for i in sorted(polys)]


def parse_shp(content: bytes) -> list:
    """Geometries of a .shp file, in record order."""
    return list(shapes(content))


def shapes(content: bytes) -> Iterator[list | None]:
    """The geometries of a .shp file one by one."""
    pos = 100
    n = len(content)
    while pos + 8 <= n:
        _num, words = struct.unpack(">ii", content[pos:pos + 8])
        rec = content[pos + 8:pos + 8 + 2 * words]
        pos += 8 + 2 * words
        stype = struct.unpack("<i", rec[:4])[0] if len(rec) >= 4 else 0
        if stype == 0:
            yield None
            continue
        if stype not in POLYGON_TYPES:
            raise ValueError(f"shape type {stype} is no polygon")
        nparts, npoints = struct.unpack("<ii", rec[36:44])
        parts = list(struct.unpack(f"<{nparts}i", rec[44:44 + 4 * nparts]))
        pts = np.frombuffer(rec, dtype="<f8", count=2 * npoints, offset=44 + 4 * nparts).reshape(-1, 2)
        yield _polygons([pts[a:b] for a, b in zip(parts, parts[1:] + [npoints])])


def dbf_fields(content: bytes) -> list[tuple[str, str, int, int]]:
    """(name, type letter, length, decimals) of every .dbf field."""
    hlen = struct.unpack("<H", content[8:10])[0]
    fields = []
    pos = 32
    while pos < hlen - 1 and content[pos] != 0x0D:
        name = content[pos:pos + 11].split(b"\x00", 1)[0].decode("latin-1")
        fields.append((name, chr(content[pos + 11]), content[pos + 16], content[pos + 17]))
        pos += 32
    return fields


def spark_type(kind: str, decimals: int) -> str:
    """Spark type for a .dbf field type (numbers typed, everything else text)."""
    if kind in ("N", "F"):
        return "bigint" if kind == "N" and decimals == 0 else "double"
    if kind == "L":
        return "boolean"
    return "string"


def records(content: bytes, encoding: str = "utf-8") -> Iterator[list[str | None] | None]:
    """The records of a .dbf file as text, one by one; deleted records are None.

    Text that isn't in ``encoding`` is an error: replaced characters would pass as names.
    """
    nrec, hlen, rlen = struct.unpack("<IHH", content[4:12])
    fields = [(name, length) for name, _k, length, _d in dbf_fields(content)]
    for i in range(nrec):
        rec = content[hlen + i * rlen: hlen + (i + 1) * rlen]
        if not rec or rec[:1] == b"*":
            yield None
            continue
        vals, p = [], 1
        for _name, length in fields:
            raw = rec[p:p + length].decode(encoding).strip()
            vals.append(raw if raw != "" else None)
            p += length
        yield vals


def _pairs(spark: SparkSession, path: str) -> DataFrame:
    def part(ext):
        glob = "*." + "".join(f"[{c}{c.upper()}]" for c in ext)
        return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
                     .option("recursiveFileLookup", True).load(path)
                     .select(F.regexp_replace("path", rf"(?i)\.{ext}$", "").alias("base"),
                             F.col("content").alias(ext)))
    lone = F.raise_error(F.concat(F.lit("no .dbf beside "), F.col("base"))).cast("binary")
    return part("shp").join(part("dbf"), "base", "left").withColumn("dbf", F.coalesce("dbf", lone))


def read_shapefile(spark: SparkSession, path: str, typed: bool = False, encoding: str = "utf-8") -> DataFrame:
    """Attributes (text, or typed from the .dbf field types with ``typed``) and geometry.

    A .dbf whose records don't go one to one with the shapes is an error.
    """
    pairs = _pairs(spark, path)

    def header_pass(batches):
        for pdf in batches:
            f = [dbf_fields(c) for c in pdf["dbf"]]
            yield pd.DataFrame({"base": pdf["base"], "fields": [[x[0] for x in ff] for ff in f],
                                "types": [[spark_type(x[1], x[3]) for x in ff] for ff in f]})

    heads = pairs.select("base", "dbf").mapInPandas(
        header_pass, "base string, fields array<string>, types array<string>").collect()
    columns: list[str] = []
    types: dict[str, str] = {}
    for h in sorted(heads, key=lambda r: r["base"]):
        for c, t in zip(h["fields"], h["types"]):
            if c not in columns:
                columns.append(c)
                types[c] = t
            elif types[c] != t:
                types[c] = "string"          # files disagree: keep text
    schema = ", ".join([f"`{c}` string" for c in columns] + [f"geometry {GEOM_TYPE}"])

    def rows_pass(batches):
        for pdf in batches:
            for shp, dbf in zip(pdf["shp"], pdf["dbf"]):
                names = [f[0] for f in dbf_fields(dbf)]
                both = zip(shapes(shp), records(dbf, encoding), strict=True)
                rows = ({**dict.fromkeys(columns), **dict(zip(names, rec)), "geometry": geom}
                        for geom, rec in both if rec is not None)
                while out := list(islice(rows, ROWS)):
                    yield pd.DataFrame(out, columns=columns + ["geometry"])

    out = pairs.mapInPandas(rows_pass, schema)
    if not typed:
        return out
    return out.select(*[(F.col(f"`{c}`").try_cast(types[c]) if types[c] != "string" else F.col(f"`{c}`")).alias(c)
                        for c in columns], "geometry")


# ---- fixture writer --------------------------------------------------------------------------

def _shp_bytes(geoms: list) -> tuple[bytes, bytes]:
    recs, index = [], []
    offset = 50
    allpts = []
    for i, g in enumerate(geoms):
        rings = [np.asarray(r, dtype=float) for poly in (g or []) for r in poly]
        if not rings:
            content = struct.pack("<i", 0)
        else:
            pts = np.vstack(rings)
            allpts.append(pts)
            parts = np.cumsum([0] + [len(r) for r in rings[:-1]]).astype(int)
            content = (struct.pack("<i4d", 5, pts[:, 0].min(), pts[:, 1].min(), pts[:, 0].max(), pts[:, 1].max())
                       + struct.pack("<ii", len(rings), len(pts)) + struct.pack(f"<{len(rings)}i", *parts)
                       + pts.astype("<f8").tobytes())
        recs.append(struct.pack(">ii", i + 1, len(content) // 2) + content)
        index.append(struct.pack(">ii", offset, len(content) // 2))
        offset += 4 + len(content) // 2
    allp = np.vstack(allpts) if allpts else np.zeros((1, 2))
    bbox = (allp[:, 0].min(), allp[:, 1].min(), allp[:, 0].max(), allp[:, 1].max())

    def header(length_words):
        return (struct.pack(">i5ii", 9994, 0, 0, 0, 0, 0, length_words) + struct.pack("<ii", 1000, 5)
                + struct.pack("<4d", *bbox) + struct.pack("<4d", 0, 0, 0, 0))
    body = b"".join(recs)
    idx = b"".join(index)
    return header(50 + len(body) // 2) + body, header(50 + len(idx) // 2) + idx


def _dbf_bytes(columns: list[str], rows: list[list]) -> bytes:
    texts = [["" if v is None else str(v) for v in r] for r in rows]
    widths = [max([1] + [len(t[j].encode()) for t in texts]) for j in range(len(columns))]
    too_long = [c for c, w in zip(columns, widths) if w > 254 or len(c.encode()) > 10]
    if too_long:
        raise ValueError(f"a .dbf holds names of 10 bytes and values of 254; too long in {too_long}")
    # integer columns are declared numeric (N, 0 decimals), the rest text (C)
    kinds = [b"N" if rows and all(r[j] is None or (isinstance(r[j], int) and not isinstance(r[j], bool))
                                  for r in rows) else b"C" for j in range(len(columns))]
    hlen = 32 + 32 * len(columns) + 1
    rlen = 1 + sum(widths)
    head = struct.pack("<BBBBIHH20x", 3, 124, 1, 1, len(rows), hlen, rlen)
    fields = b"".join(struct.pack("<11sc4xBB14x", c.encode(), k, w, 0)
                      for c, k, w in zip(columns, kinds, widths))
    body = b"".join(b" " + b"".join(t[j].encode().ljust(widths[j]) for j in range(len(columns)))
                    for t in texts)
    return head + fields + b"\r" + body + b"\x1a"


def write_shapefile(df: DataFrame, path: str, geom: str = "geometry") -> None:
    """.shp/.shx/.dbf sets of at most ``FILE_ROWS`` shapes under a local or mounted folder.

    Shells are written clockwise and holes counter-clockwise (the format's
    convention).  Python file IO: the folder must be visible to executors.
    """
    local = path[5:] if path.startswith("file:") else path
    os.makedirs(local, exist_ok=True)
    attrs = [c for c in df.columns if c != geom]

    def orient(g):
        if g is None:
            return None
        out = []
        for poly in g:
            rings = []
            for k, r in enumerate(poly):
                a = np.array([[float(p[0]), float(p[1])] for p in r])
                cw = _ring_area2(a) < 0
                rings.append((a if cw == (k == 0) else a[::-1]).tolist())
            out.append(rings)
        return out

    def put(geoms, rows):
        base = os.path.join(local, f"part-{uuid.uuid4().hex}")
        shp, shx = _shp_bytes(geoms)
        for ext, data in (("shp", shp), ("shx", shx), ("dbf", _dbf_bytes(attrs, rows))):
            with open(f"{base}.{ext}", "wb") as f:
                f.write(data)
        return pd.DataFrame({"file": [base], "rows": [len(rows)]})

    def write(batches):
        geoms, rows = [], []
        for pdf in batches:
            geoms.extend(orient(g) for g in pdf[geom])
            rows.extend(pdf[attrs].astype(object).where(pdf[attrs].notna(), None).values.tolist())
            while len(rows) > FILE_ROWS:
                yield put(geoms[:FILE_ROWS], rows[:FILE_ROWS])
                geoms, rows = geoms[FILE_ROWS:], rows[FILE_ROWS:]
        if rows:
            yield put(geoms, rows)

    dealt(df, FILE_ROWS).mapInPandas(write, "file string, rows long").collect()
