"""Attributes of a column (units, standard_name, long_name, cell_methods) as its metadata in Spark's schema: readers set them,
filters, projections, joins, unions and Parquet keep them, indices check them, and sinks write them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from aridspan.functions.units import PRECIPITATION

#: What values of precipitation are in the daily grid.
MM_A_DAY = {"units": "mm/day", "standard_name": "precipitation_flux", "cell_methods": "time: mean"}


def of_variable(variable: str) -> dict[str, str]:
    """What the readers make of a variable; nothing is known of others than precipitation."""
    return dict(MM_A_DAY) if variable in PRECIPITATION else {}


def attributes_of(df: DataFrame, column: str = "value") -> dict[str, str]:
    return dict(df.schema[column].metadata)


def described(df: DataFrame, attributes: dict[str, str], column: str = "value") -> DataFrame:
    """df with a column's attributes replaced."""
    return df.withMetadata(column, attributes)


def reduced(df: DataFrame, source: DataFrame, method: str, column: str = "value") -> DataFrame:
    """df, whose column was made of source's: with its attributes, and one cell method more."""
    kept = attributes_of(source, column)
    if not kept:
        return df
    return described(df, kept | {"cell_methods": " ".join(filter(None, (kept.get("cell_methods"), method)))}, column)


def require_units(df: DataFrame, units: str, column: str = "value") -> DataFrame:
    """df; an error unless its column says that it is in these units."""
    found = attributes_of(df, column).get("units")
    if found != units:
        raise ValueError(f"{column} is in {found or 'units that nobody has stated'}, and {units} is needed")
    return df
