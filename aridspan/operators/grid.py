"""Projections and filters over the daily grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aridspan.config import Bounds
from aridspan.functions.attributes import MM_A_DAY, attributes_of, described
from aridspan.schemas import GRID_DAILY, GRID_PARTITIONS

#: Seconds of a day: kg m-2 s-1 to mm a day.
FLUX_TO_MM = 86_400.0


def require_variable(grid: DataFrame, variable: str = "pr") -> DataFrame:
    """The rows of one variable; files without it have none and so drop out of all that follows."""
    if "variable" not in grid.columns or "value" not in grid.columns:
        raise ValueError("the grid has no columns variable and value")
    return grid.filter(F.col("variable") == variable)


def files_without(grid: DataFrame, variable: str = "pr") -> DataFrame:
    """file_id of files that do not hold the variable."""
    return grid.groupBy("file_id").agg(F.max(F.col("variable") == variable).alias("has")).filter("NOT has").select("file_id")


def nan_to_null(grid: DataFrame, column: str = "value") -> DataFrame:
    """Missing values as nulls, so that they compare false and aggregates skip them."""
    return described(grid.withColumn(column, F.when(~F.isnan(column), F.col(column))), attributes_of(grid, column), column)


def convert_units(grid: DataFrame, factor: float = FLUX_TO_MM) -> DataFrame:
    """From the flux to millimetres a day."""
    return described(grid.withColumn("value", F.col("value") * F.lit(factor)), MM_A_DAY)


def in_box(grid: DataFrame, bounds: Bounds) -> DataFrame:
    """Cells with both coordinates between the bounds, ends included, whatever their order in the file."""
    return grid.filter(F.col("lat").between(bounds.south, bounds.north) & F.col("lon").between(bounds.west, bounds.east))


def every_nth(grid: DataFrame, stride: int, lat_index: str = "lat_idx", lon_index: str = "lon_idx") -> DataFrame:
    """Every stride-th cell along both axes."""
    return grid if stride == 1 else grid.filter((F.pmod(lat_index, F.lit(stride)) == 0) & (F.pmod(lon_index, F.lit(stride)) == 0))


def null_guard(grid: DataFrame) -> DataFrame:
    """The rows of files that have any value at all."""
    good = grid.groupBy("file_id").agg(F.count("value").alias("n")).filter("n > 0").select("file_id")
    return grid.join(good, "file_id", "left_semi")


def write_grid(grid: DataFrame, path: str) -> None:
    """Stores the grid so that variable, experiment, model and year prune folders, and boxes prune row groups."""
    columns = [F.col(c).cast(GRID_DAILY[c].dataType) for c in GRID_DAILY.names]
    rows = grid.select(*columns).repartition(*GRID_PARTITIONS).sortWithinPartitions(*GRID_PARTITIONS, "lat", "lon", "day_ordinal")
    rows.write.mode("overwrite").partitionBy(*GRID_PARTITIONS).parquet(path)
