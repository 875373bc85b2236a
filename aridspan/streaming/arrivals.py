"""Indices over grid rows as they arrive.

Heavy-rain days are a windowed count that a watermark closes. Indices by period keep a state table: each micro-batch adds
the day bits of what it brought, under its number, so that a batch that runs again writes the same rows; the bits of a
file's days merge whatever batches brought them, in any order, once or twice. ``index_so_far`` reads the indices off
that table, and ``fold_state`` makes one batch of many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aridspan.functions.attributes import MM_A_DAY, described
from aridspan.operators import indices
from aridspan.operators.spells import merged_bits
from aridspan.schemas import GRID_DAILY


def arrivals(spark: SparkSession, path: str, files_per_batch: int = 64) -> DataFrame:
    """The daily grid of precipitation in Parquet files under path, as they appear."""
    return described(spark.readStream.schema(GRID_DAILY).option("maxFilesPerTrigger", files_per_batch).parquet(path), MM_A_DAY)


def heavy_days(stream: DataFrame, threshold: float = 10.0, window: str = "30 days", late: str = "60 days") -> DataFrame:
    """experiment, model, run, lat, lon, start, n_days: days at or over the threshold in tumbling windows; days that come later
    than the watermark allows are left out."""
    keys = ("experiment", "model", "run", "lat", "lon")
    timed = stream.withColumn("at", F.col("day").cast("timestamp")).withWatermark("at", late)
    counted = timed.groupBy(*keys, F.window("at", window)).agg(F.count_if(F.col("value") >= threshold).alias("n_days"))
    return counted.select(*keys, F.col("window.start").cast("date").alias("start"), "n_days")


def index_files(stream: DataFrame, name: str, target: str, checkpoint: str, period: str = "YS", **trigger) -> StreamingQuery:
    """Adds each batch's state (indices.index_state) under target, by batch; trigger: as DataStreamWriter.trigger."""
    spec = indices.spec_of(name)

    def write(batch: DataFrame, number: int) -> None:
        indices.index_state(batch, spec, period).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger or {"availableNow": True}).start()


def index_so_far(spark: SparkSession, name: str, target: str, period: str = "YS") -> DataFrame:
    """The index (as indices.index_by_period) of all that has arrived under target; a period whose days are not all there is
    missing, if the index says so."""
    state = spark.read.option("recursiveFileLookup", True).parquet(target)
    return indices.index_of_state(state, indices.spec_of(name), period)


def fold_state(spark: SparkSession, target: str, folded: str) -> None:
    """Writes the state under target, a row for each file, cell and period, to another folder, for use in its place between
    runs of a stream (as ``batch=folded`` of a new target)."""
    state = spark.read.option("recursiveFileLookup", True).parquet(target)
    merged_bits(state, indices.FILE_PERIOD).write.mode("overwrite").parquet(f"{folded}/batch=folded")
