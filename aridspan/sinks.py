"""Where results go: Parquet by experiment, attributes, reports as CSV, Markdown and text, and NetCDF files of an ensemble or
of the daily grid on a folder that all machines mount.

A NetCDF file is laid out first, header and axes, under a name that is not yet its own; tasks then write their slabs (a
latitude of an ensemble, a day of the daily grid) where these belong, which a task that runs again does once more; when all
are written the file takes its name. No task or driver holds more than a slab.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aridspan.functions.attributes import attributes_of
from aridspan.operators.catalog import HEADER
from aridspan.shipping import kept, ship
from aridspan.sources import netcdf3
from aridspan.sources.grid_files import days_before
from aridspan.sources.ranges import Ranged

def write_ensemble(ensemble: DataFrame, path: str) -> None:
    """One folder for each experiment; those of this run replace their own and leave others alone."""
    ensemble.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("experiment").parquet(path)


def write_attributes(attributes: DataFrame, path: str) -> None:
    attributes.write.mode("overwrite").parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """A report as a single CSV with a header."""
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def text_table(report: DataFrame) -> str:
    """A report as right-aligned text, with all of its rows."""
    return report.toPandas().to_string(index=False)


def markdown(report: DataFrame) -> str:
    """The catalogue report (catalog.report) with its header."""
    lines = [r.line for r in report.orderBy("model", "experiment", "run").select("line").collect()]
    return "\n".join([*HEADER, *lines])


Axes = dict[str, np.ndarray]


def lay_out(part: Path, axes: Axes, about: dict[str, dict], variable: str, attributes: dict) -> None:
    """A file of its final size with header and axes; variable goes over all axes, about: attributes by variable."""
    dims = tuple(axes)
    variables = {name: ((name,), np.dtype("f8"), about.get(name, {})) for name in dims} | {variable: (dims, np.dtype("f8"), about.get(variable, {}))}
    head, begins, size = netcdf3.laid_out({n: len(a) for n, a in axes.items()}, variables, attributes)
    part.parent.mkdir(parents=True, exist_ok=True)
    with open(part, "wb") as out:
        out.write(head)
        for name, axis in axes.items():
            out.seek(begins[name])
            out.write(axis.astype(">f8").tobytes())
        out.truncate(size)


class SlabFile:
    """A file that lay_out has made, open for slabs: entries along its variable's first axis."""

    def __init__(self, part: str, variable: str) -> None:
        self.handle = open(part, "r+b")  # noqa: SIM115
        dataset = netcdf3.opened(Ranged(self.handle, os.path.getsize(part)))
        self.values = dataset.variables[variable].values
        self.axes = [dataset.variables[d].values.read() for d in dataset.variables[variable].dimensions]

    def write(self, at: float, others: list[np.ndarray], values: np.ndarray) -> None:
        """The slab at a value of the first axis: NaN but for values at places of the other axes."""
        slab = np.full([len(a) for a in self.axes[1:]], np.nan)
        slab[tuple(np.searchsorted(a, x) for a, x in zip(self.axes[1:], others))] = values
        self.handle.seek(self.values.begin + int(np.searchsorted(self.axes[0], at)) * self.values.step)
        self.handle.write(slab.astype(">f8").tobytes())

    def close(self) -> None:
        self.handle.flush()
        os.fsync(self.handle.fileno())
        self.handle.close()


def write_slabs(rows: DataFrame, variable: str | None, slab: str, others: list[str], factor: float = 1.0) -> DataFrame:
    """Writes rows (part, variable, value, and the axes slab and others) into the files part; returns a row (part, n) for
    each slab. variable: of all rows, if there is no such column."""
    n_parts = max(1, rows.sparkSession.sparkContext.defaultParallelism * 4)
    named = rows if variable is None else rows.withColumn("variable", F.lit(variable))
    ranged = named.select("part", "variable", slab, *others, "value").repartitionByRange(n_parts, "part", slab).sortWithinPartitions("part", slab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, path, key, held = None, None, None, []

        def put() -> pa.RecordBatch:
            frame = pd.concat(held)
            file.write(key[1], [frame[o].to_numpy(float) for o in others], frame["value"].to_numpy(float) * factor)
            return pa.RecordBatch.from_pydict({"part": [path], "n": [len(frame)]})

        for batch in batches:
            for new, frame in batch.to_pandas().groupby(["part", slab], sort=False):
                if new != key:
                    if key is not None:
                        yield put()
                    if path != new[0]:
                        if file is not None:
                            file.close()
                        file, path = SlabFile(new[0], frame["variable"].iloc[0]), new[0]
                    key, held = new, []
                held.append(frame)
        if key is not None:
            yield put()
            file.close()

    ship(rows.sparkSession)
    return ranged.mapInArrow(run, "part string, n long")


def axis_of(rows: DataFrame, name: str) -> np.ndarray:
    """The sorted values of an axis, which is as long as a grid is high or wide."""
    return np.array([r[0] for r in rows.select(name).distinct().orderBy(name).collect()], dtype=float)


def write_netcdf(ensemble: DataFrame, experiment: str, variable: str, target: str | Path, attributes: dict[str, str]) -> None:
    """One experiment's grid as a classic NetCDF file, with the attributes of the column value; cells without a value are NaN."""
    rows = ensemble.filter(F.col("experiment") == experiment).select("lat", "lon", "value")
    target = Path(target)
    part = target.with_suffix(".part")
    axes = {"lat": axis_of(rows, "lat"), "lon": axis_of(rows, "lon")}
    own = {"units": attributes.get("units", "days")} | attributes_of(rows)
    lay_out(part, axes, {"lat": {"units": "degrees_north"}, "lon": {"units": "degrees_east"}, variable: own}, variable, dict(attributes))
    write_slabs(rows.withColumn("part", F.lit(str(part.resolve()))), variable, "lat", ["lon"]).count()
    part.replace(target)


def write_daily(grid: DataFrame, folder: str, units: str = "kg m-2 s-1", factor: float = 1.0 / 86_400.0) -> DataFrame:
    """Writes the daily grid as classic NetCDF files variable/model/experiment/name.nc under folder, which all machines
    mount; returns file, n_days of what was written. Values are multiplied by factor to be in units; missing cells and
    days of a file are NaN."""
    keys = ["variable", "model", "experiment", "run", "grid_label", "file_year", "calendar"]
    name = F.concat_ws("_", "variable", F.lit("day"), "model", "experiment", "run", "grid_label", F.col("file_year").cast("string"))
    part = F.concat_ws("/", F.lit(folder.rstrip("/")), "variable", "model", "experiment", F.concat(name, F.lit(".part")))
    rows = grid.select(part.alias("part"), *keys, "day", F.col("day_ordinal").cast("double").alias("time"), "lat", "lon", "value")
    axes = rows.groupBy("part", *keys).agg(
        F.min("day").alias("since"), *(F.sort_array(F.collect_set(a)).alias(a) for a in ("time", "lat", "lon"))
    )

    def laid(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for r in frame.itertuples():
                since = days_before(r.since, int(min(r.time)), r.calendar)
                about = {
                    "time": {"units": f"days since {since}", "calendar": r.calendar},
                    "lat": {"units": "degrees_north"}, "lon": {"units": "degrees_east"}, r.variable: {"units": units},
                }
                lay_out(Path(r.part), {a: np.asarray(getattr(r, a), dtype=float) for a in ("time", "lat", "lon")}, about, r.variable, {})
            yield pd.DataFrame({"part": frame["part"], "n_days": frame["time"].map(len).astype("int64")})

    def named(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            targets = [Path(p).with_suffix(".nc") for p in frame["part"]]
            for p, target in zip(frame["part"], targets):
                if Path(p).exists():  # a task that runs again finds it done
                    Path(p).replace(target)
            yield pd.DataFrame({"file": [t.name for t in targets], "n_days": frame["n_days"]})

    ship(grid.sparkSession)
    found = kept(axes.mapInPandas(laid, "part string, n_days long"), "files-laid-out")
    kept(write_slabs(rows, None, "time", ["lat", "lon"], factor), "slabs-written")
    return found.mapInPandas(named, "file string, n_days long")
