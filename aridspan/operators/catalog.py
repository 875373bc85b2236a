"""The catalogue: models, experiments, runs and variables as one flat table, read from XML documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aridspan.functions.names import or_dash


def references(documents: DataFrame) -> DataFrame:
    """url, position, name of each catalogRef of XML documents (url, xml): its name, or its title where the name is
    empty; references with neither drop out."""
    each = documents.select("url", F.posexplode(F.expr(r"regexp_extract_all(xml, '<(?:\\w+:)?catalogRef\\b[^>]*>', 0)")).alias("position", "tag"))
    attribute = lambda a: F.nullif(F.regexp_extract("tag", rf"\s{a}\s*=\s*[\"']([^\"']*)[\"']", 1), F.lit(""))
    return each.select("url", "position", F.coalesce(attribute("name"), attribute("xlink:title")).alias("name")).filter("name IS NOT NULL")


def datasets(documents: DataFrame) -> DataFrame:
    """url, position, name of each dataset, in document order and with repeats."""
    each = documents.select("url", F.posexplode(F.expr(r"regexp_extract_all(xml, '<(?:\\w+:)?dataset\\b[^>]*>', 0)")).alias("position", "tag"))
    name = F.nullif(F.regexp_extract("tag", r"\sname\s*=\s*[\"']([^\"']*)[\"']", 1), F.lit(""))
    return each.select("url", "position", name.alias("name")).filter("name IS NOT NULL")


def files(documents: DataFrame) -> DataFrame:
    """url, position, name of every file that the documents of a variable name, all versions; order by url and position."""
    return datasets(documents)


def file_list(documents: DataFrame) -> DataFrame:
    """url, files: the names of files() in the document's order, with repeats; a document without files has none."""
    named = files(documents).groupBy("url").agg(F.array_sort(F.collect_list(F.struct("position", "name"))).alias("rows"))
    names = F.transform(F.coalesce("rows", F.array().cast("array<struct<position:int,name:string>>")), lambda r: r["name"])
    return documents.select("url").join(named, "url", "left").select("url", names.alias("files"))


def xpath_names(documents: DataFrame) -> DataFrame:
    """url, names: of all references that have one, by XPath."""
    return documents.select("url", F.expr("xpath(xml, \"//*[local-name()='catalogRef']/@name\")").alias("names"))


def run_variables(documents: DataFrame) -> DataFrame:
    """url, variables: the sub-catalogues' names, or the first parts of the datasets' names where there are none."""
    subs = references(documents).groupBy("url").agg(F.array_sort(F.collect_set("name")).alias("a"))
    first = F.get(F.split("name", "_"), F.lit(0))
    prefixes = datasets(documents).groupBy("url").agg(F.array_sort(F.collect_set(first)).alias("b"))
    return documents.select("url").join(subs, "url", "left").join(prefixes, "url", "left").select("url", F.coalesce("a", "b").alias("variables"))


def models(catalog: DataFrame) -> DataFrame:
    return catalog.select("model").distinct().orderBy("model")


def experiments(catalog: DataFrame, model: str) -> DataFrame:
    return catalog.filter(F.col("model") == model).select("experiment").distinct().orderBy("experiment")


def runs(catalog: DataFrame, model: str, experiment: str) -> DataFrame:
    return catalog.filter((F.col("model") == model) & (F.col("experiment") == experiment)).select("run").distinct().orderBy("run")


def variables(catalog: DataFrame, model: str, experiment: str, run: str) -> DataFrame:
    rows = catalog.filter((F.col("model") == model) & (F.col("experiment") == experiment) & (F.col("run") == run))
    return rows.select(F.explode("variables").alias("variable")).distinct().orderBy("variable")


def info(catalog: DataFrame, model: str) -> DataFrame:
    """experiment, run, variables (joined, or a dash) of a model; raises if it is unknown."""
    rows = catalog.filter(F.col("model") == model)
    if rows.isEmpty():
        raise LookupError(f"model {model!r} is not in the catalogue")
    return rows.select("experiment", "run", or_dash(F.array_join(F.array_sort("variables"), ", ")).alias("variables"))


def variable_list(text: Column) -> Column:
    """A text of names and commas as an array without blanks."""
    return F.filter(F.transform(F.split(text, ","), lambda v: F.trim(v)), lambda v: v != "")


def flatten(nested: DataFrame) -> DataFrame:
    """model, experiment, run, variables of nested (model, tree: map of experiment to map of run to variables)."""
    scenario = nested.select("model", F.explode("tree").alias("experiment", "runs"))
    return scenario.select("model", "experiment", F.explode("runs").alias("run", "variables"))


def report(catalog: DataFrame) -> DataFrame:
    """line: a Markdown row for each model, experiment and run."""
    line = F.format_string("| %s | %s | %s | %s |", "model", "experiment", "run", F.array_join("variables", ", "))
    return catalog.select("model", "experiment", "run", line.alias("line"))


HEADER = ("| Model | Scenario | Ensemble | Variables |", "| --- | --- | --- | --- |")
