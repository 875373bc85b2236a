"""A table of what grid files hold, by which files are left unopened: their names' fields, axes, span of days, calendar and
units, from headers alone.

``refresh`` keeps it under a folder, a version for each change: files whose path, length and time of change are known are not
opened again, those that are gone leave it, and those of other experiments are told by their names and never opened.
``pruned`` picks the files that a question needs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

from aridspan.config import Bounds
from aridspan.functions.units import mm_factor
from aridspan.shipping import ship
from aridspan.sources.grid_files import all_of, dates, header, listed_files, name_fields, with_identity
from aridspan.sources.ranges import opened

KINDS = {
    "path": StringType(), "length": LongType(), "modified": TimestampType(), "variable": StringType(), "model": StringType(), "experiment": StringType(),
    "run": StringType(), "grid_label": StringType(), "file_year": IntegerType(), "file_id": StringType(), "calendar": StringType(), "units": StringType(),
    "first_day": DateType(), "last_day": DateType(), "n_days": IntegerType(), "south": DoubleType(), "north": DoubleType(), "west": DoubleType(),
    "east": DoubleType(), "n_lat": IntegerType(), "n_lon": IntegerType(), "error": StringType(),
}
FILES = StructType([StructField(name, kind) for name, kind in KINDS.items()])
#: What tells whether a file is the one that was scanned.
IDENTITY = ["path", "length", "modified"]


def described(path: str, variable: str) -> dict[str, object]:
    """The columns of FILES that a file's header gives."""
    data = opened(path)
    with data.handle:
        dataset = header(data, {variable, "time", "lat", "lon"})
        if variable not in dataset.variables:
            raise ValueError(f"the file has no variable {variable!r}")
        units = dataset.variables[variable].attributes.get("units")
        mm_factor(variable, units)
        days, calendar = dates(dataset.variables["time"])
        lat, lon = (all_of(dataset.variables[n]).astype(float) for n in ("lat", "lon"))
    out = {"variable": variable, "calendar": calendar, "units": None if units is None else str(units), "n_days": len(days), "n_lat": len(lat), "n_lon": len(lon)}
    if days:
        out |= {"first_day": min(days), "last_day": max(days)}
    for low, high, axis in (("south", "north", lat), ("west", "east", lon)):
        if len(axis):
            out |= {low: float(axis.min()), high: float(axis.max())}
    return out


def scan(files: DataFrame, variable: str = "pr", experiments: Sequence[str] | None = None) -> DataFrame:
    """FILES for files (path, length, modified) that executors can open; experiments: files of others have no row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in (batch.slice(i, 1) for i in range(batch.num_rows)):
                path = one.column("path")[0].as_py()
                fields = name_fields(path, variable)
                if experiments is not None and fields["experiment"] not in experiments:
                    continue
                try:
                    fields |= described(path, variable)
                except Exception as error:  # noqa: BLE001  one file's trouble is a row, not the end
                    fields["error"] = f"{type(error).__name__}: {error}"
                yield with_identity({c: one.column(c) for c in IDENTITY}, 1, fields, FILES)

    ship(files.sparkSession)
    spread = files.select(*IDENTITY).repartition(max(1, files.sparkSession.sparkContext.defaultParallelism * 4), "path")
    return spread.mapInArrow(rows, FILES)


def latest(spark: SparkSession, place: str) -> tuple[int, DataFrame]:
    """The number of the latest whole version under a folder and its table; 0 and none if there is no version."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(place)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{place}/version-*/_SUCCESS"))
    number = max((int(x.getPath().getParent().getName().split("-")[1]) for x in found or ()), default=0)
    rows = spark.read.schema(FILES).parquet(f"{place}/version-{number:08d}") if number else spark.createDataFrame([], FILES)
    return number, rows


def refresh(spark: SparkSession, root: str, place: str, variable: str = "pr", experiments: Sequence[str] | None = None) -> DataFrame:
    """The catalogue of the files under root as it is now, kept under place; a change is a new version there. One writer at
    a time: of two that write the same version the second fails."""
    number, old = latest(spark, place)
    old = old.filter(F.col("variable").eqNullSafe(variable) | F.col("error").isNotNull())
    there = listed_files(spark, root)
    known = old.join(there, IDENTITY, "left_semi")
    fresh = scan(there.join(old, IDENTITY, "left_anti"), variable, experiments)
    target = f"{place}/version-{number + 1:08d}"
    known.unionByName(fresh).write.parquet(target)
    return spark.read.schema(FILES).parquet(target)


def pruned(
    files: DataFrame, variable: str = "pr", experiments: Sequence[str] | None = None, bounds: Bounds | None = None, years: tuple[int, int] | None = None
) -> DataFrame:
    """The rows of a catalogue that can hold a day of years (first, last) and a cell of the box, of some experiments."""
    out = files.filter(F.col("error").isNull() & (F.col("variable") == variable))
    if experiments is not None:
        out = out.filter(F.col("experiment").isin(list(experiments)))
    if bounds is not None:
        out = out.filter((F.col("north") >= bounds.south) & (F.col("south") <= bounds.north) & (F.col("east") >= bounds.west) & (F.col("west") <= bounds.east))
    if years is not None:
        out = out.filter((F.year("last_day") >= years[0]) & (F.year("first_day") <= years[1]))
    return out
