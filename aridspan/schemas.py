"""The tables of the engine; readers and operators state these and infer nothing."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, DataType, DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

STRING, DOUBLE, INT, LONG, DATE = StringType(), DoubleType(), IntegerType(), LongType(), DateType()


def table(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


GRID_DAILY = table(
    model=STRING, experiment=STRING, variable=STRING, run=STRING, grid_label=STRING, file_year=INT, file_id=STRING,
    calendar=STRING, lat=DOUBLE, lon=DOUBLE, day=DATE, day_ordinal=INT, value=DOUBLE,
)
INDEX_PERIOD = table(experiment=STRING, model=STRING, file_id=STRING, lat=DOUBLE, lon=DOUBLE, period_start=DATE, value=DOUBLE)
INDEX_FILE = table(experiment=STRING, model=STRING, file_id=STRING, lat=DOUBLE, lon=DOUBLE, value=DOUBLE)
INDEX_ENSEMBLE = table(experiment=STRING, index_name=STRING, lat=DOUBLE, lon=DOUBLE, value=DOUBLE, n_files=LONG)
POINT = table(x=DOUBLE, y=DOUBLE)
REGIONS = table(region_id=INT, name=STRING, srid=INT, rings=ArrayType(ArrayType(POINT)))
CELL_REGION = table(lat=DOUBLE, lon=DOUBLE, region_id=INT)
TOWNS = table(
    city=STRING, city_ascii=STRING, lat=DOUBLE, lng=DOUBLE, country=STRING, iso2=STRING, iso3=STRING, admin_name=STRING,
    capital=STRING, population=LONG,
)
CATALOG = table(model=STRING, experiment=STRING, run=STRING, variables=ArrayType(STRING))
EXPECTED_FILES = table(model=STRING, variable=STRING, experiment=STRING, year=INT)
FOUND_FILES = table(model=STRING, variable=STRING, experiment=STRING, year=INT, file=STRING)
FILE_NAME = table(variable=STRING, model=STRING, experiment=STRING, run=STRING, grid_label=STRING, year=INT, version=STRING)
REJECTS = table(file_id=STRING, error=STRING)

#: How the daily grid is stored: the columns that queries prune by.
GRID_PARTITIONS = ("variable", "experiment", "model", "file_year")
