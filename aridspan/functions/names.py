"""Names of files and requests, and the words and signs of reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values of the reports
COMPLETE, PARTIAL, EXCESS, MISSING = "✅", "⚠️", "🔴", "❌ MISSING"

#: Names of experiments.
EXPERIMENT = r"historical|ssp\d+"
#: variable_day_model_experiment_run_grid_year[_version].nc; a model's name may hold underscores, so the
#: experiment anchors the expression.
FILE_NAME = rf"^([^_]+)_day_(.+)_({EXPERIMENT})_(r\d+i\d+p\d+f\d+)_([^_]+)_(\d{{4}})(?:_(v[\d.]+))?\.nc$"


def file_name(variable: Column, model: Column, experiment: Column, run: Column, label: Column, year: Column, version: str | None = None) -> Column:
    tail = f"_{version}.nc" if version else ".nc"
    return F.concat(F.concat_ws("_", variable, F.lit("day"), model, experiment, run, label, year.cast("string")), F.lit(tail))


def parsed_name(name: Column) -> Column:
    """The fields of a file name as a struct; null where the name has another form."""
    part = lambda i: F.regexp_extract(name, FILE_NAME, i)
    fields = F.struct(
        part(1).alias("variable"), part(2).alias("model"), part(3).alias("experiment"), part(4).alias("run"),
        part(5).alias("grid_label"), part(6).cast("int").alias("year"), F.nullif(part(7), F.lit("")).alias("version"),
    )
    return F.when(F.rlike(name, F.lit(FILE_NAME)), fields)


def path_model(path: Column, experiment: Column) -> Column:
    """The folder above the first folder named as the experiment; else the third part of the file's name."""
    folders = F.slice(F.split(path, "/"), F.lit(1), F.greatest(F.lit(0), F.size(F.split(path, "/")) - 1))
    at = F.array_position(folders, experiment)
    stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")
    return F.when(at > 1, F.get(folders, (at - 2).cast("int"))).otherwise(F.get(F.split(stem, "_"), F.lit(2)))


def request_url(base: Column, model: Column, experiment: Column, run: Column, variable: Column, file: Column, year: Column, bounds) -> Column:
    """A subset request for one file and year; bounds: config.Bounds."""
    return F.concat(
        F.concat_ws("/", F.rtrim(base, F.lit("/")), model, experiment, run, variable, file),
        F.format_string(
            f"?var=%s&north={bounds.north:g}&west={bounds.west:g}&east={bounds.east:g}&south={bounds.south:g}&horizStride={bounds.stride}"
            "&time_start=%d-01-01T12:00:00Z&time_end=%d-12-31T12:00:00Z&accept=netcdf4&addLatLon=true",
            variable, year, year,
        ),
    )


def ratio(found: Column, expected: Column) -> Column:
    return F.format_string("%d/%d", found, expected)


def status(found: Column, expected: Column) -> Column:
    """Complete, or the ratio behind the sign of too few or too many."""
    return (
        F.when(found == expected, F.lit(COMPLETE))
        .when(found < expected, F.concat(F.lit(PARTIAL + " "), ratio(found, expected)))
        .otherwise(F.concat(F.lit(EXCESS + " "), ratio(found, expected)))
    )


def overall_sign(found: Column, expected: Column) -> Column:
    return F.when(found == expected, F.lit(COMPLETE)).when(found > expected, F.lit(EXCESS)).otherwise(F.lit(PARTIAL))


def presence(count: Column, least: int = 1) -> Column:
    return F.when(count >= least, F.lit(COMPLETE)).otherwise(F.lit(MISSING))


def percent(found: Column, expected: Column) -> Column:
    """found of expected in hundredths; 0 where nothing is expected."""
    return F.when(expected > 0, F.try_divide(found, expected) * 100).otherwise(F.lit(0.0))


def status_row(name: Column, count: Column, sign: Column) -> Column:
    """A line of the console report: name in 30, count in 12 characters."""
    return F.concat(F.rpad(name, 30, " "), F.lit(" "), F.lpad(count.cast("string"), 12, " "), F.lit(" "), sign)


def or_dash(text: Column, dash: str = "—") -> Column:
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(dash))


def title_case(text: Column) -> Column:
    """The first letter in upper case, all others in lower case."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substring(text, 2, 1 << 30)))


def tokens(text: Column) -> Column:
    """The parts of a text between runs of white space, without empty ones."""
    return F.filter(F.split(text, r"\s+"), lambda t: t != "")
