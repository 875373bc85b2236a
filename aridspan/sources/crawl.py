"""The remote catalogue as a table: its documents are fetched level by level, models, experiments, runs and variables.

A level's documents are fetched in tasks by way of a work table (see work), so that none is fetched twice; levels are
small (some thousand documents in all).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aridspan.operators import catalog
from aridspan.shipping import ship
from aridspan.sources.tables import fetch_documents
from aridspan.sources.work import WorkTable, candidates, document, host_of


def document_url(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *parts, "catalog.xml"])


def fetched(work: WorkTable, urls: DataFrame) -> DataFrame:
    """url, xml of those of urls (url) that can be fetched; the others stay in the work table with their errors."""
    work.add(urls.selectExpr("url AS key", f"{host_of('url')} AS host", "url AS payload"))
    done = work.run(document).filter("state = 'done'").select(F.col("key").alias("url"), F.col("result").alias("xml"))
    return done.join(urls.select("url").distinct(), "url", "left_semi")


def below(parents: DataFrame, documents: DataFrame, name: str) -> DataFrame:
    """parents (url and what led there) with a column name for each reference of their documents, and its own url."""
    refs = catalog.references(documents).select("url", F.col("name").alias(name)).distinct()
    return parents.join(refs, "url").withColumn("url", F.concat(F.regexp_replace("url", "catalog[.]xml$", ""), F.col(name), F.lit("/catalog.xml")))


def crawl(spark: SparkSession, base: str, out: str, models: list[str] | None = None, again: bool = False, **limits) -> DataFrame:
    """model, experiment, run, variables (schemas.CATALOG) of the catalogue at base, also written to out; models: only these. A
    crawl that was broken off goes on, one that was done fetches nothing, unless again: then each document is asked for
    anew, by its validators. Documents that cannot be fetched leave out what is below them and are written to out
    as failures (url, error); only without the first is there no result. limits: as of WorkTable."""
    work = WorkTable(ship(spark), f"{out}/_work", **limits)
    if again:
        work.add(work.current(), again=True)
    level = spark.createDataFrame([(document_url(base),)], "url string")
    for name in ("model", "experiment", "run"):
        documents = fetched(work, level)
        if name == "model" and documents.isEmpty():
            raise OSError(f"{document_url(base)}: {work.current().first().error}")
        level = below(level, documents, name)
        if name == "model" and models:
            level = level.filter(F.col("model").isin(models))
    variables = catalog.run_variables(fetched(work, level))
    table = level.join(variables, "url").select("model", "experiment", "run", F.coalesce("variables", F.array().cast("array<string>")).alias("variables"))
    table.write.mode("overwrite").parquet(f"{out}/catalog")
    work.current().filter("state = 'failed'").select(F.col("key").alias("url"), "error").write.mode("overwrite").parquet(f"{out}/failures")
    return spark.read.parquet(f"{out}/catalog")


def download(plan: DataFrame, root: str, work: WorkTable) -> DataFrame:
    """Carries out inventory.plan_downloads under root, a folder that all machines mount: for each model, variable,
    experiment and year the candidates by priority until one succeeds. Returns these, file and error. By way of a work table:
    what fails is tried again, and a run that was broken off goes on."""
    keys = ["variable", "model", "experiment", "year"]
    target = F.concat_ws("/", F.lit(root.rstrip("/")), "variable", "model", "experiment", "file")
    jobs = plan.withColumn("key", F.concat_ws("/", *(F.col(k).cast("string") for k in keys))).groupBy("key", *keys).agg(
        F.sort_array(F.collect_list(F.struct("priority", "url", target.alias("target")))).alias("tries")
    )
    payload = F.to_json(F.transform("tries", lambda t: F.array(t["url"], t["target"])))
    rows = jobs.select("key", *keys, F.get("tries", 0)["url"].alias("url"), payload.alias("payload"))
    work.add(rows.selectExpr("key", f"{host_of('url')} AS host", "payload"), again=True)
    found = work.run(candidates).select("key", "state", "result", "error")
    file = F.when(F.col("state") == "done", F.col("result"))
    return rows.join(found, "key").select("model", "variable", "experiment", "year", file.alias("file"), F.when(F.col("state") != "done", F.regexp_replace("error", r"^\w+: ", "")).alias("error"))


def files(spark: SparkSession, base: str, model: str, experiment: str, run: str, variable: str) -> list[str]:
    """The names of all files, all versions, in the order of the document and with repeats."""
    url = ship(spark).createDataFrame([(document_url(base, model, experiment, run, variable),)], "url string")
    documents = fetch_documents(url).cache()
    bad = documents.filter("error IS NOT NULL").first()
    if bad:
        raise OSError(f"{bad.url}: {bad.error}")
    return [r.name for r in catalog.files(documents).orderBy("url", "position").collect()]
