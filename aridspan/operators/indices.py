"""Precipitation indices by cell and calendar period, from a registry that can be added to. The grid's value must say that it
is in mm/day (functions.attributes), as what the readers give does."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aridspan.functions.attributes import described, require_units
from aridspan.functions.periods import day_in_period, day_number, expected_days, period_start
from aridspan.operators.spells import day_bits, longest_run, merged_bits, spells_of


@dataclass(frozen=True)
class IndexSpec:
    """An index: its condition on a day, whether it takes the longest run or the count of such days, and whether a
    period with a missing day is missing (any) or only lacks that day (skip)."""

    name: str
    output: str
    compare: str
    threshold: float
    reducer: str  # run or count
    missing: str  # any or skip
    title: str = ""

    def hit(self, value: Column) -> Column:
        t = F.lit(float(self.threshold))
        return {"<": value < t, "<=": value <= t, ">": value > t, ">=": value >= t}[self.compare]

    def attributes(self) -> dict[str, str]:
        """Of the index's values."""
        return {"units": "days", "long_name": self.title or self.name, "cell_methods": "time: maximum" if self.reducer == "run" else "time: sum"}


REGISTRY: dict[str, IndexSpec] = {}


def register(spec: IndexSpec) -> IndexSpec:
    REGISTRY[spec.name] = spec
    return spec


CDD = register(IndexSpec("cdd", "max_cdd", "<", 1.0, "run", "any", "Max Consecutive Dry Days"))
CWD = register(IndexSpec("cwd", "max_cwd", ">", 1.0, "run", "any", "Max Consecutive Wet Days"))
R10MM = register(IndexSpec("r10mm", "r10mm", ">=", 10.0, "count", "skip", "Days with 10 mm of rain or more"))


def spec_of(name: str, threshold: float | None = None) -> IndexSpec:
    if name not in REGISTRY:
        raise KeyError(f"index {name!r} is not registered")
    return REGISTRY[name] if threshold is None else replace(REGISTRY[name], threshold=threshold)


def index_by_period(grid: DataFrame, spec: IndexSpec, period: str = "YS", boundary: str = "file", form: str = "bits") -> DataFrame:
    """experiment, model, file_id, lat, lon, period_start, value. boundary: ``file`` treats each file alone, so a season
    that spans two files gives two rows; ``series`` joins the files of a model and experiment (file_id is then null)."""
    require_units(grid, "mm/day")
    keys = ["experiment", "model", *(["file_id"] if boundary == "file" else []), "lat", "lon", "period_start"]
    rows = grid.withColumn("period_start", period_start(F.col("day"), period))
    order = "day_ordinal"
    if boundary == "series":
        rows, order = rows.withColumn("_day", day_in_period(F.col("day"), F.col("period_start"), F.col("calendar"))), "_day"
    hit = spec.hit(F.col("value"))
    if spec.reducer == "count":
        found = rows.groupBy(*keys).agg(F.count_if(hit).cast("int").alias("run"), F.count("value").alias("n_valid"), F.max("calendar").alias("calendar"))
    else:
        found = longest_run(rows, [*keys, "calendar"], hit, order, form=form)
    value = F.col("run").cast("double")
    if spec.missing == "any":
        value = F.when(F.col("n_valid") >= expected_days(F.col("period_start"), period, F.col("calendar")), value)
    out = found.withColumn("value", value)
    if boundary == "series":
        out = out.withColumn("file_id", F.lit(None).cast("string"))
    return described(out.select("experiment", "model", "file_id", "lat", "lon", "period_start", "value"), spec.attributes())


#: What one series is in the three uses of an index's state.
FILE_PERIOD = ["experiment", "model", "file_id", "lat", "lon", "period_start", "calendar"]
SERIES = ["experiment", "model", "lat", "lon"]


def whole_series(grid: DataFrame, spec: IndexSpec) -> DataFrame:
    """experiment, model, lat, lon, value, n_valid: an index over all days of a series, whatever files they lie in, without
    periods: a run may be longer than a year, and passes from one file to the next."""
    rows = require_units(grid, "mm/day").withColumn("_number", day_number(F.col("day"), F.col("calendar")))
    found = spells_of(day_bits(rows, SERIES, spec.hit(F.col("value")), "_number"), SERIES)
    value = F.col("n_hits" if spec.reducer == "count" else "longest").cast("double")
    return described(found.select(*SERIES, F.when(F.col("n_valid") > 0, value).alias("value"), "n_valid"), spec.attributes())


def index_state(grid: DataFrame, spec: IndexSpec, period: str = "YS") -> DataFrame:
    """FILE_PERIOD and the words of spells.day_bits: what is known about each file and period from some of its days. States of
    other days of the same file, in any order, and repeated ones merge with it, see index_of_state."""
    rows = require_units(grid, "mm/day").withColumn("period_start", period_start(F.col("day"), period))
    return day_bits(rows, FILE_PERIOD, spec.hit(F.col("value")))


def index_of_state(state: DataFrame, spec: IndexSpec, period: str = "YS") -> DataFrame:
    """The same as index_by_period with boundary ``file`` of all rows whose states are in state."""
    found = spells_of(merged_bits(state, FILE_PERIOD), FILE_PERIOD)
    value = F.col("n_hits" if spec.reducer == "count" else "longest").cast("double")
    if spec.missing == "any":
        value = F.when(F.col("n_valid") >= expected_days(F.col("period_start"), period, F.col("calendar")), value)
    return described(found.select("experiment", "model", "file_id", "lat", "lon", "period_start", value.alias("value")), spec.attributes())
