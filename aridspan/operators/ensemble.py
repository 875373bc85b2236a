"""Means over time and over an ensemble: first within each file, then over files or over models. ``MeanTable`` keeps an
ensemble's mean up to date as files come, change and go."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aridspan.functions.attributes import reduced
from aridspan.schemas import INDEX_FILE


def time_mean(index: DataFrame) -> DataFrame:
    """experiment, model, file_id, lat, lon, value: the mean of a cell's periods within a file, nulls skipped."""
    return reduced(index.groupBy("experiment", "model", "file_id", "lat", "lon").agg(F.avg("value").alias("value")), index, "time: mean")


def drop_empty_files(index_file: DataFrame) -> DataFrame:
    """Without the files whose every cell is null."""
    good = index_file.groupBy("file_id").agg(F.count("value").alias("n")).filter("n > 0").select("file_id")
    return index_file.join(good, "file_id", "left_semi")


def ensemble_mean(index_file: DataFrame, by: str = "files") -> DataFrame:
    """experiment, lat, lon, value, n_files. by: ``files`` weighs each file alike, so a model with more files weighs
    more; ``models`` first takes each model's mean."""
    rows, weight = index_file, F.count("value")
    if by == "models":
        rows = index_file.groupBy("experiment", "model", "lat", "lon").agg(F.avg("value").alias("value"), F.count("value").alias("n"))
        weight = F.sum("n")
    elif by != "files":
        raise ValueError(f"unknown ensemble {by!r}")
    return reduced(rows.groupBy("experiment", "lat", "lon").agg(F.avg("value").alias("value"), weight.alias("n_files")), index_file, "model: mean")


@dataclass
class MeanTable:
    """The mean over files of an ensemble, kept under a folder: each file's values, in groups by a hash of file_id, and sums
    and counts by group. A file is known by its file_id: one that comes again replaces itself, and nothing is subtracted.
    A change reads the files of its groups and no others; the mean reads GROUPS rows for each cell at most. One writer at a
    time; a change that fails half-way is repaired by carrying it out again."""

    spark: SparkSession
    folder: str
    groups: int = 64

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _files(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _group(self, file_id: str = "file_id"):
        return F.pmod(F.xxhash64(F.col(file_id).cast("string")), F.lit(self.groups)).cast("int")

    def _write(self, rows: DataFrame, name: str, *by: str) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(f"{self.folder}/{name}")

    def put(self, files: DataFrame) -> None:
        """Adds or replaces files (schemas.INDEX_FILE)."""
        rows = files.select(*INDEX_FILE.names).withColumn("grp", self._group())
        self._write(rows.withColumn("file", F.col("file_id")), "files", "grp", "file")
        self._sum([r.grp for r in rows.select("grp").distinct().collect()])

    def withdraw(self, file_ids: list[str]) -> None:
        """Takes files out; one that is not there is no error."""
        escape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        named = self.spark.createDataFrame([(f,) for f in file_ids], "file_id string").withColumn("grp", self._group()).collect()
        for r in named:
            self._files().delete(self._path(f"files/grp={r.grp}/file={escape(r.file_id)}"), True)
        self._sum(sorted({r.grp for r in named}))

    def _sum(self, groups: list[int]) -> None:
        for g in groups:  # those that a change has left without a file
            if not self._files().globStatus(self._path(f"files/grp={g}/file=*")):
                self._files().delete(self._path(f"sums/grp={g}"), True)
                self._files().delete(self._path(f"files/grp={g}"), True)
        held = self._read("files")
        if held is not None:
            sums = held.filter(F.col("grp").isin(groups)).groupBy("grp", "experiment", "lat", "lon").agg(F.sum("value").alias("total"), F.count("value").alias("n"))
            self._write(sums, "sums", "grp")

    def _read(self, name: str) -> DataFrame | None:
        return self.spark.read.parquet(f"{self.folder}/{name}") if self._files().globStatus(self._path(f"{name}/grp=*")) else None

    def mean(self) -> DataFrame:
        """experiment, lat, lon, value, n_files, as ensemble_mean by files."""
        sums = self._read("sums")
        if sums is None:
            return self.spark.createDataFrame([], "experiment string, lat double, lon double, value double, n_files long")
        whole = sums.groupBy("experiment", "lat", "lon").agg(F.sum("total").alias("total"), F.sum("n").alias("n_files"))
        return whole.select("experiment", "lat", "lon", (F.col("total") / F.nullif("n_files", F.lit(0))).alias("value"), "n_files")


def models_included(index_file: DataFrame) -> DataFrame:
    """experiment, models: the distinct models, sorted and joined."""
    return index_file.groupBy("experiment").agg(F.array_join(F.array_sort(F.collect_set("model")), ", ").alias("models"))


def attributes(index_file: DataFrame, title: str, description: str, units: str = "days", created_by: str = "aridspan") -> DataFrame:
    """experiment, attributes: what describes each experiment's output."""
    pairs = [
        F.lit("title"), F.concat(F.lit(f"Ensemble mean of {title} - "), F.col("experiment")),
        F.lit("description"), F.lit(description), F.lit("units"), F.lit(units),
        F.lit("models_included"), F.col("models"), F.lit("created_by"), F.lit(created_by),
    ]
    return models_included(index_file).select("experiment", F.create_map(*pairs).alias("attributes"))
