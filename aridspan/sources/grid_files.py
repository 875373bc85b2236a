"""Gridded files as rows of the daily grid.

``read_files`` lists files through Spark's own file source. Mounted files are read by ranges of bytes: a task gets a file
and one of its blocks of days, reads the header, and fetches and unpacks what meets its days and the box, so
neither the file nor the whole variable is ever held. Files of other stores come as whole values of Spark's file
source (up to 2 GB each), unless ``ranges=True`` says that pyarrow opens them on the executors too. One pass gives
rows and rejects. A task gives a row for each day and latitude, with the values along it as a list; Spark makes them
rows of cells, so that a file's names cross from Python once for hundreds of cells. ``gridnc`` is the same as a data
source for mounted files: one partition for each file and block of days, with coordinate filters pushed into the reader.
Precipitation is in millimetres a day from here on, whatever its files' units.
"""

from __future__ import annotations

import datetime as dt
import re
from calendar import monthrange
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThanOrEqual, InputPartition, LessThanOrEqual
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from aridspan.config import Bounds
from aridspan.functions.attributes import described, of_variable
from aridspan.functions.names import EXPERIMENT, FILE_NAME, path_model
from aridspan.functions.units import mm_factor
from aridspan.schemas import GRID_DAILY, REJECTS
from aridspan.shipping import ship
from aridspan.sources import hdf5, netcdf3, ranges
from aridspan.sources.ranges import opened

CALENDARS = {"gregorian": "standard", "proleptic_gregorian": "standard", "365_day": "noleap"}


#: Bytes of a file that make up one block of days, and bytes of values that are held at a time.
BLOCK_BYTES, SLAB_BYTES = 64 << 20, 32 << 20


def decode(data: bytes, wanted: set[str] | None = None) -> netcdf3.Dataset:
    """A file's bytes as a dataset, of the classic or of the HDF5-based format; wanted: variables that are needed."""
    return header(data, wanted).loaded()


def header(data: bytes | ranges.Ranged, wanted: set[str] | None = None) -> netcdf3.Dataset:
    """The same with values left in the file."""
    return netcdf3.opened(data) if data[:3] == b"CDF" else hdf5.opened(data, wanted)


def all_of(variable: netcdf3.Variable) -> np.ndarray:
    return variable.values.read() if isinstance(variable.values, ranges.Stored) else variable.values


def dates(variable: netcdf3.Variable) -> tuple[list[dt.date], str]:
    """The day of each time and the calendar; a day that is no date (30 February) becomes its month's last."""
    units, calendar = str(variable.attributes.get("units", "days since 1950-01-01")), str(variable.attributes.get("calendar", "standard")).lower()
    calendar = CALENDARS.get(calendar, calendar)
    year, month, day = map(int, re.search(r"days since (\d+)-(\d+)-(\d+)", units).groups())
    out: list[dt.date] = []
    for n in np.floor(all_of(variable).astype(float)).astype(int).tolist():
        if calendar == "standard":
            out.append(dt.date(year, month, day) + dt.timedelta(days=n))
            continue
        lengths = [30] * 12 if calendar == "360_day" else [31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]
        whole = sum(lengths)
        at = sum(lengths[: month - 1]) + day - 1 + n
        y, rest = year + at // whole, at % whole
        m = 0
        while rest >= lengths[m]:
            rest -= lengths[m]
            m += 1
        out.append(dt.date(y, m + 1, min(rest + 1, monthrange(y, m + 1)[1])))
    return out, calendar


def days_before(day: dt.date, n: int, calendar: str) -> str:
    """The date, as of a calendar, n days before a day."""
    if calendar == "standard":
        return str(day - dt.timedelta(days=n))
    lengths = [30] * 12 if calendar == "360_day" else [31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]
    at, month = sum(lengths[: day.month - 1]) + day.day - 1 - n, 0
    year, at = day.year + at // sum(lengths), at % sum(lengths)
    while at >= lengths[month]:
        at -= lengths[month]
        month += 1
    return f"{year:04d}-{month + 1:02d}-{at + 1:02d}"


Box = dict[str, tuple[float, float]]


class Slabs:
    """A variable of a file by days. box: bounds of lat and lon, ends included; stride: every stride-th cell of that box
    along both axes. What the header does not allow raises here."""

    def __init__(self, dataset: netcdf3.Dataset, variable: str, box: Box | None = None, stride: int = 1) -> None:
        if variable not in dataset.variables:
            raise ValueError(f"the file has no variable {variable!r}")
        self.variable = v = dataset.variables[variable]
        self.factor = mm_factor(variable, v.attributes.get("units"))
        self.fill = [np.atleast_1d(v.attributes[a]) for a in ("_FillValue", "missing_value") if a in v.attributes]
        self.order = [v.dimensions.index(d) for d in ("time", "lat", "lon")]
        self.days, self.calendar = dates(dataset.variables["time"])
        self.axes, self.keep = [], []
        for name in ("lat", "lon"):
            axis = all_of(dataset.variables[name]).astype(float)
            low, high = (box or {}).get(name, (-np.inf, np.inf))
            keep = np.flatnonzero((axis >= low) & (axis <= high))[::stride]
            self.axes.append(axis[keep])
            self.keep.append(keep)

    def day_range(self, block: int, blocks: int) -> tuple[int, int]:
        """The days of one of blocks, whose edges are edges of what is unpacked together."""
        n, piece = len(self.days), self.variable.values.pieces[self.order[0]]
        pieces = -(-n // piece)
        return min(n, pieces * block // blocks * piece), min(n, pieces * (block + 1) // blocks * piece)

    def read(self, first: int, last: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(number of the day, latitudes, values by latitude and longitude, where they are missing) of days first to last - 1;
        a day may come in several bands of latitudes."""
        if not all(len(k) for k in self.keep):
            return
        stored = self.variable.values
        step, rows, _ = (stored.pieces[o] for o in self.order)
        wide = int(self.keep[1][-1] - self.keep[1][0] + 1) if len(self.keep[1]) else 0
        rows *= max(1, SLAB_BYTES // (step * rows * max(1, wide) * stored.dtype.itemsize))
        x = self.keep[1] - self.keep[1].min()
        columns = slice(int(self.keep[1].min()), int(self.keep[1].max()) + 1)
        for day in range(first, last, step):
            days = slice(day, min(last, day + step))
            for top in range(int(self.keep[0].min()) // rows * rows, int(self.keep[0].max()) + 1, rows):
                mine = (self.keep[0] >= top) & (self.keep[0] < top + rows)
                y = self.keep[0][mine]
                if not len(y):
                    continue
                region: list = [None] * len(self.order)
                for o, part in zip(self.order, (days, slice(int(y.min()), int(y.max()) + 1), columns)):
                    region[o] = part
                raw = np.moveaxis(stored.read(tuple(region)), self.order, [0, 1, 2])[:, y - y.min()][:, :, x]
                missing = np.isnan(raw) if raw.dtype.kind == "f" else np.zeros(raw.shape, bool)
                for fills in self.fill:
                    for f in fills.astype(raw.dtype):
                        missing |= raw == f
                for i in range(days.stop - days.start):
                    yield day + i, self.axes[0][mine], raw[i].astype("f8") * self.factor, missing[i]


def day_lines(slabs: Slabs, first: int, last: int) -> Iterator[tuple[dict[str, pa.Array], int]]:
    """Columns of a row for each latitude of a day, with lists lon and value along it, and the number of rows."""
    lon = pa.array(slabs.axes[1])
    width = len(lon)
    for day, lat, values, missing in slabs.read(first, last):
        n = len(lat)
        offsets = pa.array(np.arange(n + 1, dtype=np.int32) * width)
        lists = {
            "lon": pa.ListArray.from_arrays(offsets, pa.array(np.tile(slabs.axes[1], n))),
            "value": pa.ListArray.from_arrays(offsets, pa.array(values.reshape(-1), mask=missing.reshape(-1))),
        }
        yield lists | {"lat": pa.array(lat)} | day_columns(slabs, day, n), n


def day_columns(slabs: Slabs, day: int, n: int) -> dict[str, pa.Array]:
    return {
        "calendar": pa.repeat(pa.scalar(slabs.calendar), n), "day": pa.repeat(pa.scalar(slabs.days[day], pa.date32()), n),
        "day_ordinal": pa.repeat(pa.scalar(day, pa.int32()), n),
    }


def day_cells(slabs: Slabs, first: int, last: int) -> Iterator[tuple[dict[str, pa.Array], int]]:
    """Columns of a row for each cell of a day, and the number of rows."""
    for day, lat, values, missing in slabs.read(first, last):
        n = values.size
        cells = {"lat": pa.array(np.repeat(lat, values.shape[1])), "lon": pa.array(np.tile(slabs.axes[1], len(lat)))}
        yield cells | {"value": pa.array(values.reshape(-1), mask=missing.reshape(-1))} | day_columns(slabs, day, n), n


def name_fields(path: str, variable: str | None = None) -> dict[str, object]:
    """What a path says about its file. Folders named variable/model/experiment come first, then the parts of the file's
    name; of a name of another form the third part is the model, and a year of four digits at its end counts."""
    *folders, name = path.split("/")
    m = re.match(FILE_NAME, name)
    keys = ("variable", "model", "experiment", "run", "grid_label", "file_year")
    fields = dict(zip(keys, m.groups()[:6])) if m else dict.fromkeys(keys)
    at = next((i for i, f in enumerate(folders) if i and re.fullmatch(EXPERIMENT, f)), None)
    if at is not None:
        fields |= {"experiment": folders[at], "model": folders[at - 1]}
    if not m:
        stem = name.rsplit(".", 1)[0]
        parts, year = stem.split("_"), re.search(r"_(\d{4})(?:_v[\d.]+)?$", stem)
        fields["model"] = fields["model"] or (parts[2] if len(parts) > 2 else None)
        fields["variable"], fields["file_year"] = variable, year and year[1]
    fields["file_year"] = int(fields["file_year"]) if fields["file_year"] else None
    return fields | {"file_id": name}


def with_identity(columns: dict[str, pa.Array], n: int, fields: dict[str, object], schema: StructType) -> pa.RecordBatch:
    """A batch of n rows by schema: the columns, and the file's fields repeated; what neither has is null."""
    arrays = []
    for f in schema.fields:
        kind = to_arrow_type(f.dataType)
        arrays.append(columns[f.name] if f.name in columns else pa.repeat(pa.scalar(fields.get(f.name), kind), n))
    return pa.RecordBatch.from_arrays(arrays, schema.names)


def listed_files(spark: SparkSession, root: str, pattern: str = "*.nc") -> DataFrame:
    """path, length, modified of all files under root; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def mounted(spark: SparkSession, root: str) -> bool:
    """Whether root is on a file system that the machines mount."""
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme() == "file"


def found_files(spark: SparkSession, root: str, experiments: list[str]) -> DataFrame:
    """model, variable, experiment, year, file (schemas.FOUND_FILES) of files named by their folders variable/model/experiment."""
    at = lambda i: F.element_at(F.split("path", "/"), i)
    rows = listed_files(spark, root).select(
        path_model(F.col("path"), at(-2)).alias("model"), at(-4).alias("variable"), at(-2).alias("experiment"),
        F.regexp_extract("path", r"_(\d{4})(?:_v[\d.]+)?\.nc$", 1).try_cast("int").alias("year"), at(-1).alias("file"),
    )
    return rows.filter(F.col("experiment").isin(experiments))


def read_files(
    spark: SparkSession, root: str, variable: str = "pr", bounds: Bounds | None = None, files: DataFrame | None = None, ranges: bool | None = None
) -> DataFrame:
    """The daily grid (schemas.GRID_DAILY) of all files under root within bounds, and error: a file that cannot be read
    has rows with its file_id and error alone, see parts_of. files: only these (path, length), as listed_files gives or
    file_catalogue.pruned picks them; ranges: whether pyarrow can open them on the executors (default: mounted files)."""
    ship(spark)
    box = {"lat": (bounds.south, bounds.north), "lon": (bounds.west, bounds.east)} if bounds else None
    stride = bounds.stride if bounds else 1
    if mounted(spark, root) if ranges is None else ranges:
        listed = (files if files is not None else listed_files(spark, root)).select("path", F.ceil(F.col("length") / F.lit(BLOCK_BYTES)).cast("int").alias("blocks"))
        blocks = listed.withColumn("blocks", F.greatest("blocks", F.lit(1)))
        parts = blocks.select("path", "blocks", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        parts = parts.repartition(max(1, spark.sparkContext.defaultParallelism * 4), "path", "block")
    else:
        parts = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.nc").load(root).select("path", "content")
        parts = parts if files is None else parts.join(files.select("path"), "path", "left_semi")
    lists = {"lon": ArrayType(DoubleType()), "value": ArrayType(DoubleType())}
    schema = StructType([*(StructField(f.name, lists.get(f.name, f.dataType)) for f in GRID_DAILY.fields), StructField("error", StringType())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 1) for i in range(batch.num_rows)):
                path, handle = part.column("path")[0].as_py(), None
                fields = name_fields(path, variable)
                try:
                    block, blocks = (part.column(c)[0].as_py() if c in batch.schema.names else at for c, at in (("block", 0), ("blocks", 1)))
                    if "content" in batch.schema.names:
                        data = part.column("content")[0].as_py()
                    else:
                        data = opened(path)
                        handle = data.handle
                    slabs = Slabs(header(data, {variable, "time", "lat", "lon"}), variable, box, stride)
                    for columns, n in day_lines(slabs, *slabs.day_range(block, blocks)):
                        yield with_identity(columns, n, fields, schema)
                except Exception as error:  # noqa: BLE001  one file's trouble is a row, not the end
                    bad = name_fields(path) | {"error": f"{type(error).__name__}: {error}"}
                    yield with_identity({}, 1, bad, schema)
                finally:
                    if handle is not None:
                        handle.close()

    # by place in the list: zipped lists would make an object of each cell
    lines = parts.mapInArrow(rows, schema).withColumnsRenamed({"lon": "lons", "value": "values"})
    cells = lines.select("*", F.posexplode_outer("values").alias("at", "value"))
    return described(cells.withColumn("lon", F.get("lons", F.col("at"))).select(*GRID_DAILY.names, "error"), of_variable(variable))


def parts_of(read: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The daily grid and the rejects (schemas.REJECTS) of what read_files gave, or of a table that it was written to. A
    file with an error in any of its blocks is left out of the grid, and is one row of the rejects."""
    rejects = read.filter("error IS NOT NULL").groupBy("file_id").agg(F.min("error").alias("error")).select(*REJECTS.names)
    grid = read.filter("error IS NULL").select(*GRID_DAILY.names)
    return grid.join(rejects.select("file_id"), "file_id", "left_anti").select(*GRID_DAILY.names), rejects


def read_grid(spark: SparkSession, root: str, variable: str = "pr", bounds: Bounds | None = None) -> tuple[DataFrame, DataFrame]:
    """The daily grid of all files under root, and file_id and error of files that could not be read; plans that use
    both write read_files first, so that files are decoded once."""
    return parts_of(read_files(spark, root, variable, bounds))


class _File(InputPartition):
    def __init__(self, path: str, block: int = 0, blocks: int = 1) -> None:
        self.path, self.block, self.blocks = path, block, blocks


class GridReader(DataSourceReader):
    def __init__(self, root: str, variable: str, skip: bool) -> None:
        self.root, self.variable, self.skip = root, variable, skip
        self.bounds: Box = {}
        self.year: int | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = f.attribute[0] if len(f.attribute) == 1 else None
            low, high = self.bounds.get(name, (-np.inf, np.inf))
            if name in ("lat", "lon") and isinstance(f, GreaterThanOrEqual):
                self.bounds[name] = (max(low, float(f.value)), high)
            elif name in ("lat", "lon") and isinstance(f, LessThanOrEqual):
                self.bounds[name] = (low, min(high, float(f.value)))
            elif name == "file_year" and isinstance(f, EqualTo) and self.year is None:
                self.year = int(f.value)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        found = [p for p in sorted(Path(self.root).rglob("*.nc")) if self.year is None or name_fields(str(p))["file_year"] == self.year]
        sizes = [(str(p), 1 if self.skip else max(1, -(-p.stat().st_size // BLOCK_BYTES))) for p in found]
        return [_File(p, i, n) for p, n in sizes for i in range(n)]

    def read(self, partition: _File | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no file is left
            return
        data = opened(partition.path)
        held = []
        try:
            slabs = Slabs(header(data, {self.variable, "time", "lat", "lon"}), self.variable, self.bounds)
            fields = name_fields(partition.path, self.variable)
            found = (with_identity(columns, n, fields, GRID_DAILY) for columns, n in day_cells(slabs, *slabs.day_range(partition.block, partition.blocks)))
            held.append(next(found, None))
        except Exception:
            data.handle.close()
            if self.skip:
                return
            raise
        with data.handle:
            yield from (b for b in chain(held, found) if b is not None)


class GridSource(DataSource):
    """register(spark); spark.read.format("gridnc").option("variable", "pr").load(folder), a folder that all machines
    mount. Option errors: ``raise`` at a file that cannot be read, or ``skip`` it."""

    @classmethod
    def name(cls) -> str:
        return "gridnc"

    def schema(self) -> StructType:
        about = of_variable(self.options.get("variable", "pr"))
        return StructType([StructField(f.name, f.dataType, True, about if f.name == "value" else None) for f in GRID_DAILY.fields])

    def reader(self, schema: StructType) -> GridReader:
        return GridReader(self.options["path"].removeprefix("file://"), self.options.get("variable", "pr"), self.options.get("errors", "raise") == "skip")


def register(spark: SparkSession) -> SparkSession:
    """Makes the format gridnc known, here and on the executors, and lets filters reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    ship(spark).dataSource.register(GridSource)
    return spark
