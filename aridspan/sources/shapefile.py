"""Polygons from shapefiles: the public layout of .shp, .dbf and .prj, read with struct.

Region sets are small reference data (tens of polygons); their files are fetched through Spark's file
source, so any store will do, and parsed on the driver up to a stated size.
"""

from __future__ import annotations

import struct

from pyspark.sql import DataFrame, SparkSession

from aridspan.schemas import REGIONS

POLYGON_TYPES = {5, 15, 25}
MAX_BYTES = 256 << 20


def polygons(shp: bytes) -> list[list[list[tuple[float, float]]]]:
    """The rings of each record, without the closing point; null shapes have none."""
    out, at = [], 100
    while at + 8 <= len(shp):
        words = struct.unpack_from(">i", shp, at + 4)[0]
        body = at + 8
        kind = struct.unpack_from("<i", shp, body)[0]
        if kind == 0:
            out.append([])
        elif kind in POLYGON_TYPES:
            parts, points = struct.unpack_from("<ii", shp, body + 36)
            starts = [*struct.unpack_from(f"<{parts}i", shp, body + 44), points]
            xy = struct.unpack_from(f"<{2 * points}d", shp, body + 44 + 4 * parts)
            pairs = list(zip(xy[::2], xy[1::2]))
            rings = [pairs[a:b] for a, b in zip(starts, starts[1:])]
            out.append([r[:-1] if len(r) > 1 and r[0] == r[-1] else r for r in rings])
        else:
            raise ValueError(f"shape type {kind} is not a polygon")
        at = body + 2 * words
    return out


def attributes(dbf: bytes, encoding: str = "utf-8") -> list[dict[str, str]]:
    """The records as texts by field; deleted ones stay, as their shapes do."""
    count, head, size = struct.unpack_from("<IHH", dbf, 4)
    fields, at = [], 32
    while dbf[at] != 0x0D:
        fields.append((dbf[at : at + 11].split(b"\0")[0].decode(), dbf[at + 16]))
        at += 32
    out = []
    for i in range(count):
        at, row = head + i * size + 1, {}
        for name, width in fields:
            row[name] = dbf[at : at + width].decode(encoding, "replace").strip()
            at += width
        out.append(row)
    return out


def srid(prj: str | None) -> int:
    """4326 or 3857, by the names that projection files use; 4326 where there is none."""
    text = (prj or "").lower().replace("_", " ")
    if "mercator" in text:
        return 3857
    if not text or "wgs 1984" in text or "wgs 84" in text:
        return 4326
    raise ValueError("this projection is not known")


def _content(spark: SparkSession, path: str, needed: bool = True) -> bytes | None:
    folder, name = path.rsplit("/", 1)
    files = spark.read.format("binaryFile").option("pathGlobFilter", name).load(folder)
    sizes = [r.length for r in files.select("length").collect()]
    if not sizes:
        if needed:
            raise FileNotFoundError(path)
        return None
    if sizes[0] > MAX_BYTES:
        raise ValueError(f"{path} has {sizes[0]} bytes; at most {MAX_BYTES} are read on the driver")
    return bytes(files.select("content").first().content)


def read_regions(spark: SparkSession, path: str, name_column: str) -> DataFrame:
    """schemas.REGIONS of a shapefile (path ends in .shp), named by a column of its table."""
    stem = path.removesuffix(".shp")
    prj, cpg = _content(spark, f"{stem}.prj", False), _content(spark, f"{stem}.cpg", False)
    code = srid(prj.decode("utf-8", "replace") if prj else None)
    shapes = polygons(_content(spark, path))
    names = [r[name_column] for r in attributes(_content(spark, f"{stem}.dbf"), (cpg or b"utf-8").decode().strip() or "utf-8")]
    rows = [(i, name, code, rings) for i, (name, rings) in enumerate(zip(names, shapes))]
    return spark.createDataFrame(rows, REGIONS)
