"""Runs the indices that a configuration names; one that fails does not stop the others."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aridspan import sinks
from aridspan.config import IndexConfig
from aridspan.functions.geometry import to_degrees
from aridspan.functions.names import status_row
from aridspan.operators import alignment, ensemble, grid, indices, inventory, regions
from aridspan.sources import file_catalogue, grid_files


@dataclass
class Outcome:
    """Ensemble tables by index, and what went wrong by index."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)

    def report(self) -> list[str]:
        return [f"{name.upper()}: {self.errors.get(name, 'done')}" for name in dict.fromkeys((*self.tables, *self.errors))]

    def carry_out(self, write: Callable[[str, DataFrame], None]) -> Outcome:
        """Writes each table; one that fails is reported, and the next is written."""
        for name, table in self.tables.items():
            try:
                write(name, table)
            except Exception as error:  # noqa: BLE001  reported by index
                self.errors[name] = f"{type(error).__name__}: {error}"
        return self


def index_files(daily: DataFrame, name: str, config: IndexConfig, boundary: str = "file") -> DataFrame:
    """schemas.INDEX_FILE: each file's mean over its periods, without files that have no value at all."""
    spec = indices.spec_of(name, config.thresholds.get(name))
    rows = grid.in_box(grid.require_variable(daily), config.bounds).filter(F.col("experiment").isin(config.experiments))
    return ensemble.time_mean(indices.index_by_period(rows, spec, config.periods.get(name, "YS"), boundary))


def run_index(daily: DataFrame, name: str, config: IndexConfig, ensemble_by: str = "files", boundary: str = "file") -> DataFrame:
    """experiment, index_name, lat, lon, value, n_files: one lazy plan over all files and experiments."""
    files = index_files(daily, name, config, boundary)
    return ensemble.ensemble_mean(files, ensemble_by).select("experiment", F.lit(name).alias("index_name"), "lat", "lon", "value", "n_files")


def run_indices(daily: DataFrame, config: IndexConfig) -> Outcome:
    """The configured indices; each plan is analysed here and runs when its table is used (see Outcome.carry_out)."""
    out = Outcome()
    for name in config.indices:
        try:
            out.tables[name] = run_index(daily, name, config)
        except Exception as error:  # noqa: BLE001  reported by index
            out.errors[name] = f"{type(error).__name__}: {error}"
    return out


def land(spark: SparkSession, data: str, config: IndexConfig, out: str, variable: str = "pr") -> tuple[DataFrame, DataFrame]:
    """The daily grid and the rejects of the files under data, decoded once and kept as a table under out, by experiment
    and model. Of mounted files a catalogue is kept there too, and only those of the configured experiments and box are opened; their cells
    meet by the labels of their common axes."""
    files = file_catalogue.refresh(spark, data, f"{out}/_catalogue", variable, config.experiments) if grid_files.mounted(spark, data) else None
    picked = None if files is None else file_catalogue.pruned(files, variable, config.experiments, config.bounds)
    read = grid_files.read_files(spark, data, variable, config.bounds, picked)
    path = f"{out}/_daily"
    read.write.mode("overwrite").partitionBy("experiment", "model").parquet(path)
    daily, rejects = grid_files.parts_of(spark.read.schema(read.schema).parquet(path))
    if files is not None:
        axes = alignment.axes_of_files(picked)
        daily = alignment.on_labels(daily, *axes) if axes and config.bounds.stride == 1 else daily
        rejects = rejects.unionByName(files.filter("error IS NOT NULL").select(*rejects.columns)).distinct()
    return daily, rejects


def summary_lines(found: DataFrame, rejects: DataFrame, config: IndexConfig) -> list[str]:
    """Each model's number of files in each experiment that could be used, a line for each model."""
    counted = inventory.count_by_model_experiment(found, config.experiments, rejects).collect()  # one row for each model
    return [f"{r.model:30}" + "".join(f" {e}: {r[e]:2d}" for e in config.experiments) for r in counted]


def file_lines(found: DataFrame, config: IndexConfig) -> list[str]:
    """For each experiment its number of files, and each model's in a line of its own; found: as grid_files.found_files."""
    counted = found.groupBy("experiment", "model").agg(F.count("*").alias("n_files"))
    rows = inventory.with_presence(counted).select("experiment", "n_files", status_row(F.col("model"), F.col("n_files"), F.col("status")).alias("line"))
    by: dict[str, list] = {e: [] for e in config.experiments}
    for r in rows.orderBy("line").collect():  # one row for each model
        by[r.experiment].append(r)
    lines = []
    for experiment, models in by.items():
        lines += [f"{experiment}: {sum(m.n_files for m in models)} files" if models else f"{experiment}: no files found, skipped", *(m.line for m in models)]
    return lines


def run_files(spark: SparkSession, data: str, config: IndexConfig, out: str) -> list[str]:
    """From files to one NetCDF file with attributes for each index and experiment, ``index/index_ensemble_mean_experiment.nc``
    under out (a folder that the driver mounts), beside the same as a table; returns what is to be said about it."""
    began = time.monotonic()
    found = grid_files.found_files(spark, data, config.experiments)
    lines = file_lines(found, config)
    daily, rejects = land(spark, data, config, out)
    lines += [f"{r.file_id}: {r.error}" for r in rejects.orderBy("file_id").collect()]  # a row for each bad file

    def write(name: str, files: DataFrame) -> None:
        spec = indices.spec_of(name, config.thresholds.get(name))
        files.write.mode("overwrite").parquet(f"{out}/_files/{name}")  # for both the means and their attributes
        files = ensemble.drop_empty_files(spark.read.schema(files.schema).parquet(f"{out}/_files/{name}"))
        means = ensemble.ensemble_mean(files).withColumn("index_name", F.lit(name))
        sinks.write_ensemble(means, f"{out}/{name}/table")
        about = f"Threshold: {spec.threshold:g} mm/day, Aggregation: {config.periods.get(name, 'YS')}"
        about = {r.experiment: r.attributes for r in ensemble.attributes(files, f"{spec.title} ({name.upper()})", about).collect()}
        for experiment in config.experiments:
            if experiment in about:
                sinks.write_netcdf(means, experiment, spec.output, f"{out}/{name}/{name}_ensemble_mean_{experiment}.nc", about[experiment])
            else:
                lines.append(f"{name.upper()}: no valid output for {experiment}, skipped")

    done = Outcome()
    for name in config.indices:
        try:
            done.tables[name] = index_files(daily, name, config)
        except Exception as error:  # noqa: BLE001  reported by index
            done.errors[name] = f"{type(error).__name__}: {error}"
    return [*lines, *done.carry_out(write).report(), *summary_lines(found, rejects, config), f"Completed in {time.monotonic() - began:.1f} seconds"]


def region_table(files: DataFrame, shapes: DataFrame, experiment: str, weight: str = "none") -> DataFrame:
    """region_id, name, value, rank of shapes (schemas.REGIONS) by their mean over the files of one experiment."""
    shapes = shapes.withColumn("rings", to_degrees(F.col("rings"), F.col("srid")))
    files = files.filter(F.col("experiment") == experiment)
    means = regions.region_mean(files, regions.cell_region(files, shapes), weight)
    return regions.rank_regions(regions.with_names(means.select("region_id", "value"), shapes))


def run_regions(spark: SparkSession, data: str, shapes: DataFrame, config: IndexConfig, out: str, name: str = "cdd", experiment: str = "historical") -> DataFrame:
    """Bioregion, Max_CDD_days (by the index's output), largest first: an index over files by region, also written as a
    CSV under out."""
    daily, _ = land(spark, data, config, out)
    path = f"{out}/_files/{name}"
    index_files(daily, name, config).write.mode("overwrite").parquet(path)
    files = ensemble.drop_empty_files(spark.read.parquet(path))
    if files.isEmpty():
        raise RuntimeError("no file could be processed")
    table = region_table(files, shapes, experiment)
    spec = indices.spec_of(name)
    label = {"max_cdd": "Max_CDD_days", "max_cwd": "Max_CWD_days"}.get(spec.output, f"{spec.output}_days")
    shown = table.orderBy("rank").select(F.col("name").alias("Bioregion"), F.col("value").alias(label))
    sinks.write_report(shown, f"{out}/regions_{name}")
    return shown
