"""Inventories: which files are expected and found, what to fetch, and how complete it all is.

Lists of models, experiments and variables come from a configuration and are small by nature; what is
found grows with the store and is counted before it is joined.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aridspan.config import DownloadConfig
from aridspan.functions import names

KEYS = ("model", "variable", "experiment")


def expected_years(models: DataFrame, variables: DataFrame, ranges: DataFrame) -> DataFrame:
    """model, variable, experiment, year: each model with each variable and each year of each experiment (ranges:
    experiment, start, end)."""
    spans = ranges.select("experiment", F.explode(F.sequence("start", "end")).alias("year"))
    return models.select("model").crossJoin(variables.select("variable")).crossJoin(spans).select(*KEYS, "year")


def with_grid_label(rows: DataFrame, labels: DataFrame, default: str) -> DataFrame:
    """Adds grid_label: the model's own (labels: model, grid_label), else the default."""
    return rows.join(labels.select("model", "grid_label"), "model", "left").withColumn("grid_label", F.coalesce("grid_label", F.lit(default)))


def with_time_range(experiments: DataFrame, ranges: DataFrame, fallback: tuple[int, int]) -> DataFrame:
    """experiment, start, end: the experiment's own range, else the fallback."""
    own = ranges.select("experiment", F.col("start").alias("_s"), F.col("end").alias("_e"))
    return experiments.join(own, "experiment", "left").select(
        "experiment", F.coalesce("_s", F.lit(fallback[0])).alias("start"), F.coalesce("_e", F.lit(fallback[1])).alias("end")
    )


def expected_files(spark: SparkSession, config: DownloadConfig, strict: bool = False) -> DataFrame:
    """What a configuration asks for, with each file's two possible names. strict: an experiment without a time range
    is an error instead of taking the fallback."""
    if strict and (lost := [e for e in config.experiments if e not in config.time_ranges]):
        raise KeyError(f"no time range for {', '.join(lost)}")
    if config.fallback_range is None and any(e not in config.time_ranges for e in config.experiments):
        raise KeyError("an experiment has no time range and there is no fallback")
    ranges = spark.createDataFrame(
        [(e, *(config.time_ranges.get(e) or config.fallback_range)) for e in config.experiments], "experiment string, start int, end int"
    )
    models = spark.createDataFrame([(m,) for m in config.models], "model string")
    variables = spark.createDataFrame([(v,) for v in config.variables], "variable string")
    labels = spark.createDataFrame(list(config.grid_labels.items()), "model string, grid_label string")
    rows = with_grid_label(expected_years(models, variables, ranges), labels, config.grid_label_default)
    make = lambda version: names.file_name(
        F.col("variable"), F.col("model"), F.col("experiment"), F.lit(config.run), F.col("grid_label"), F.col("year"), version
    )
    return rows.withColumn("versioned", make("v1.1")).withColumn("plain", make(None))


def plan_downloads(expected: DataFrame, found: DataFrame, config: DownloadConfig, base: str) -> DataFrame:
    """Requests for what is not there yet, in order of preference: model, ..., year, priority, file, url."""
    todo = work_list(expected, found)
    ranked = todo.select("*", F.posexplode(F.array("versioned", "plain")).alias("priority", "file")).drop("versioned", "plain")
    url = names.request_url(
        F.lit(base), F.col("model"), F.col("experiment"), F.lit(config.run), F.col("variable"), F.col("file"), F.col("year"), config.bounds
    )
    return ranked.withColumn("url", url)


def work_list(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Expected files of which no version is found."""
    return expected.join(found.select(*KEYS, "year").distinct(), [*KEYS, "year"], "left_anti")


def pick_version(candidates: DataFrame, keys: Sequence[str], file: str = "file", priority: str = "priority") -> DataFrame:
    """For each key the available candidate of the best priority."""
    return candidates.groupBy(*keys).agg(F.min_by(file, priority).alias(file))


def verify(expected: DataFrame, found: DataFrame) -> DataFrame:
    """model, variable, experiment, found, expected: what is expected and not there counts 0."""
    want = expected.groupBy(*KEYS).agg(F.count("*").alias("expected"))
    have = found.groupBy(*KEYS).agg(F.count("*").alias("found"))
    return want.join(have, list(KEYS), "left").select(*KEYS, F.coalesce("found", F.lit(0)).cast("long").alias("found"), F.col("expected").cast("long").alias("expected"))


def detail(checked: DataFrame) -> DataFrame:
    """Adds each row's status."""
    return checked.withColumn("status", names.status(F.col("found"), F.col("expected")))


def totals(checked: DataFrame, *keys: str, more: Iterable[Column] = ()) -> DataFrame:
    """Sums over all but keys, their ratio, sign and percentage; more: further aggregates."""
    sums = checked.groupBy(*keys).agg(F.sum("found").cast("long").alias("found"), F.sum("expected").cast("long").alias("expected"), *more)
    f, e = F.col("found"), F.col("expected")
    return sums.withColumns({"total": names.ratio(f, e), "overall": names.overall_sign(f, e), "percent": names.percent(f, e)})


def detail_report(checked: DataFrame, expected_by_experiment: dict[str, int]) -> DataFrame:
    """The wide report: a column of statuses for each experiment, named with its expected count, Total and Overall."""
    cells = (F.any_value(F.when(F.col("experiment") == e, F.col("status")), True).alias(f"{e} ({n})") for e, n in expected_by_experiment.items())
    shown = ("model", "variable", *(f"`{e} ({n})`" for e, n in expected_by_experiment.items()))
    rows = totals(detail(checked), "model", "variable", more=cells).select(*shown, F.col("total").alias("Total"), F.col("overall").alias("Overall"))
    return rows.withColumnsRenamed({"model": "Model", "variable": "Variable"})


def in_config_order(report: DataFrame, config: DownloadConfig) -> DataFrame:
    """The wide report in the order in which the configuration lists models and variables."""
    at = lambda column, names_: F.array_position(F.array(*map(F.lit, names_)), F.col(column))
    return report.orderBy(at("Model", config.models), at("Variable", config.variables))


def scenario_matrix(checked: DataFrame, experiments: Sequence[str]) -> DataFrame:
    """Model and a percentage, to one place, for each experiment; holes are 0."""
    shares = totals(checked, "model", "experiment").select("model", "experiment", F.bround("percent", 1).alias("percent"))
    wide = shares.groupBy("model").pivot("experiment", sorted(experiments)).agg(F.first("percent")).fillna(0.0)
    return wide.withColumnRenamed("model", "Model").orderBy("Model")


def overall(checked: DataFrame) -> DataFrame:
    """One row: found, expected, percent, percent as text to two places."""
    sums = checked.agg(F.coalesce(F.sum("found"), F.lit(0)).cast("long").alias("found"), F.coalesce(F.sum("expected"), F.lit(0)).cast("long").alias("expected"))
    share = names.percent(F.col("found"), F.col("expected"))
    return sums.withColumn("percent", share).withColumn("completion", F.concat(F.format_string("%.2f", F.col("percent").cast("double")), F.lit("%")))


def count_by_model(files: DataFrame, least: int = 1) -> DataFrame:
    """model, n_files, status, by model."""
    return with_presence(files.groupBy("model").agg(F.count("*").alias("n_files")), least).orderBy("model")


def with_presence(counted: DataFrame, least: int = 1) -> DataFrame:
    """Adds status to counted (n_files)."""
    return counted.withColumn("status", names.presence(F.col("n_files"), least))


def count_by_model_experiment(files: DataFrame, experiments: Sequence[str], rejects: DataFrame | None = None) -> DataFrame:
    """model and the number of files in each experiment, by model; rejects (file_id): files (file) that do not count."""
    if rejects is not None:
        files = files.join(rejects.select(F.col("file_id").alias("file")).distinct(), "file", "left_anti")
    return files.groupBy("model").pivot("experiment", list(experiments)).count().fillna(0).orderBy("model")
